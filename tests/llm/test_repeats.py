"""Repeated windows: long words, long texts, small blocks, and the way without bitmaps."""

import random
import subprocess
import sys

import pytest

from tarnwork.llm import substring_dedup
from tarnwork.llm.common import Words

from . import brute


def removed(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = sorted(substring_dedup.remove_repeats(docs).collect())
    return [(r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in rows]


def thue_morse(n, swap):
    return "".join("ab"[bin(k).count("1") % 2 ^ swap] for k in range(n))


def test_words_that_polynomials_confuse(spark):
    one, two = thue_morse(1024, 0), thue_morse(1024, 1)
    for seed in (0, 1):
        h = Words([f"{one} {two}".encode()]).hashes(seed)
        assert h[0] != h[1]
    same = " ".join(f"w{k}" for k in range(34))
    texts = [f"{one} {same}", f"{two} {same}", thue_morse(64, 0) + " " + same, thue_morse(64, 1) + " " + same]
    assert removed(spark, texts) == brute.repeats(texts)


@pytest.fixture
def texts():
    r = random.Random(5)
    word = lambda: f"w{r.randint(0, 400)}"
    passages = [" ".join(word() for _ in range(n)) for n in (34, 35, 36, 80)]
    out = ["", None, " \n ", passages[1]]
    for k in range(60):
        out.append("\t".join(x for i in range(3) for x in (" ".join(word() for _ in range(r.randint(0, 60))), r.choice(passages))))
    return [*out, out[-1], out[-1], " ".join(str(k % 50) for k in range(3000))]


@pytest.mark.parametrize("bits, block", [(28, 1 << 19), (4, 1 << 19), (28, 300), (4, 500)])
def test_without_bitmaps_and_in_blocks(spark, monkeypatch, texts, bits, block):
    monkeypatch.setattr(substring_dedup, "MAX_BITS", bits)
    monkeypatch.setattr(substring_dedup, "BLOCK", block)
    assert removed(spark, texts) == brute.repeats(texts)


def test_ends_when_nothing_is_left(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup.Candidates, "exceptions", None)  # is not come to
    texts = [" ".join(f"{k}-{i}" for i in range(100)) for k in range(20)]
    assert removed(spark, texts) == brute.repeats(texts)


LONG = """
import resource, sys
from tarnwork.llm import quality, simhash, substring_dedup, toxicity
from tarnwork.llm.common import Words
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
text = b" ".join(b"word%d" % (k * 7919 % 100_003) for k in range(5_000_000))
assert len(text) > 45_000_000
if sys.argv[1] == "windows":
    w = Words([text])
    assert sum(len(x[0]) for x in substring_dedup.Scan(35, []).whole(w, [])) == 5_000_000 - 34
elif sys.argv[1] == "fingerprint":
    simhash.fingerprints([text])
else:
    quality.features([text])
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


@pytest.mark.parametrize("what", ["windows", "fingerprint", "features"])
def test_memory_of_a_long_text(what):
    out = subprocess.run([sys.executable, "-c", LONG, what], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) < 1000, out.stdout
