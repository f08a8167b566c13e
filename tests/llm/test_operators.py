"""Parts of the operators, each against a plain version or on held-out rows."""

import itertools
import random

import duckdb
import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarnwork.llm import bpe, quality_rules, secrets, sharding, simhash, substring_dedup, toxicity
from tarnwork.llm import queries as Q
from tarnwork.llm.common import Words
from tests.test_queries import connected, rows

from . import brute

PATH = public_tokenizers.path("byte_bpe_50k.json")
LOADED = Tokenizer.from_file(PATH), bpe.load(PATH)


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_sql(spark, data, name):
    got, want = Q.QUERIES[name](spark, data).toPandas(), connected(data).sql(Q.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


@pytest.fixture(scope="module")
def tokenizer():
    return LOADED


def same(tokenizer, text):
    library, own = tokenizer
    ids = np.frombuffer(own.encode(text), np.uint32).astype(np.int64)
    want = library.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == want, text
    assert own.decode(ids)[0].tobytes().decode("utf-8", "replace") == library.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_bpe_any_text(text):
    same(LOADED, text)


def test_bpe(tokenizer):
    r = random.Random(1)
    parts = ["the", "ing", " ", "qu", "\n", "é", "1", "!!", "==", "tion", "a", "b", "ß", "日", "<|endoftext|>", "  ", "'ll", "aa", "ab"]
    for text in ["", "a" * 3000, "ab" * 2000, "<|endoftext|>", "😀é" * 300, *("".join(r.choices(parts, k=r.randint(1, 60))) for _ in range(800))]:
        same(tokenizer, text)


def test_bpe_forgets(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    for _ in range(2):
        same(tokenizer, "one two three four five six seven eight nine ten one two")


@pytest.mark.parametrize("shape", ["random", "cluster", "chain", "same", "none"])
def test_vantage_points(shape):
    r = np.random.default_rng(4)
    draw = lambda n: r.integers(0, 1 << 62, n, dtype=np.uint64) * np.uint64(4) + r.integers(0, 4, n, dtype=np.uint64)
    flip = lambda x: x ^ (np.uint64(1) << r.integers(0, 64, len(x)).astype(np.uint64))
    x = draw(1500)
    if shape == "cluster":
        x = np.concatenate([x, flip(flip(flip(np.full(1500, x[0]))))])
    elif shape == "chain":
        c = [x[0]]
        for _ in range(600):
            c.append(flip(flip(c[-1:] if isinstance(c[-1:], np.ndarray) else np.array(c[-1:], np.uint64)))[0])
        x = np.concatenate([x, np.array(c, np.uint64)])
    elif shape == "same":
        x = x[:1]
    elif shape == "none":
        x = x[:0]
    x = np.unique(x)
    tree, forest = simhash.TopTree.over(x[::5], 4), simhash.Forest(len(x))
    shards: dict = {}
    for at, shard, home in tree.deal(x, 3):
        shards[shard] = (x[at], home)
    assert sum(int(h.sum()) for _, h in shards.values()) == len(x)
    for values, home in shards.values():
        a, b = simhash.shard_links(values[home], values, 3)
        assert len(a) < max(1, len(values))
        forest.link(np.searchsorted(x, a), np.searchsorted(x, b))
    assert (forest.roots(np.arange(len(x))) == brute.components(x)).all()


@pytest.mark.parametrize("skewed", [False, True])
def test_bounded_shards(spark, monkeypatch, skewed):
    """With small bounds no group exceeds them, and links are those of all pairs."""
    from tarnwork.llm.common import Scratch

    for name, value in (("SHARD_ROWS", 60), ("QUERY_ROWS", 150), ("SAMPLE", 64)):
        monkeypatch.setattr(simhash, name, value)
    r = np.random.default_rng(6)
    x = r.integers(0, 1 << 63, 900, dtype=np.uint64)
    flips = lambda n: np.bitwise_or.reduce(np.uint64(1) << r.integers(0, 64, (4, n)).astype(np.uint64), axis=0)
    x = np.concatenate([x, (x[:1] if skewed else x[:300]) ^ flips(300), x[:1] ^ flips(300) if skewed else x[:0]])
    x = np.unique(x)
    docs, scratch = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long").repartition(3), Scratch(spark)
    groups = simhash.bounded_shards(docs, 3, scratch).groupBy("shard", "piece").agg(F.sum(F.col("home").cast("int")).alias("home"), F.sum(F.col("asks").cast("int")).alias("asks")).collect()
    assert max(g.home for g in groups) <= 60 and max(g.asks for g in groups) <= 250 and len(groups) > 32
    edges, forest = simhash.links(docs, scratch, 3).toPandas(), simhash.Forest(len(x))
    forest.link(*(np.searchsorted(x, edges[c].to_numpy().view(np.uint64)) for c in "ab"))
    assert (forest.roots(np.arange(len(x))) == brute.components(x)).all()


def test_fingerprints_in_blocks(monkeypatch):
    r = random.Random(8)
    texts = [" ".join(f"W{r.randint(0, 30)}" for _ in range(n)) for n in (0, 1, 2, 3, 4, 50, 400, 1000)] + ["  a\tb ", "x" * 500 + " y " + "z" * 90]
    for size, rows in ((1 << 19, 1 << 16), (20, 7), (1, 1)):
        monkeypatch.setattr(simhash, "BLOCK_BYTES", size)
        monkeypatch.setattr(simhash, "BLOCK_ROWS", rows)
        assert simhash.fingerprints([t.encode() for t in texts]).tolist() == [brute.fingerprint(t) for t in texts]


def test_components(spark, tmp_path):
    from tarnwork.llm.common import Scratch

    r = random.Random(2)
    edges = [(k, k + 1) for k in range(100)] + [(200, k) for k in range(201, 400)] + [(r.randint(500, 900), r.randint(500, 900)) for _ in range(250)] + [(-3, 7), (-(1 << 62), 1 << 62), (5, 5)]
    got = {x.node: x.root for x in simhash.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()}
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in parent if x != 5 or find(5) != 5 or any(5 in e and e != (5, 5) for e in edges)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abc ", max_size=300), min_size=1, max_size=6), st.integers(2, 12))
def test_windows_through_levels(texts, window):
    """Levels with exact sets in place of bitmaps leave exactly the windows that are repeated."""
    raw = [t.encode() for t in texts]
    w = Words(raw)
    h = substring_dedup.runs(w.hashes(), window)
    alive = np.flatnonzero(np.repeat(w.first[1:], w.counts) - np.arange(len(w.starts)) >= window)
    scan = substring_dedup.Scan(window, [])
    for level in substring_dedup.levels(window):
        at = scan.anchor(h, level, alive)
        value, n = np.unique(h[level][np.unique(at)], return_counts=True)
        alive = alive[np.isin(h[level][at], value[n > 1])]
    gone = np.zeros(len(w.starts) + window, int)
    for a in alive:
        gone[a : a + window] = 1
    assert [int(gone[a:b].sum()) for a, b in zip(w.first, w.first[1:])] == [x[1] for x in brute.repeats(texts, window)]


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 1 << 30))
def test_permutation(n, key):
    p = sharding.Permutation(n, key)
    x = np.arange(n)
    assert sorted(p(x)) == x.tolist() and (p(p(x), back=True) == x).all()


def test_secret_network():
    net = secrets.train()
    x, y = secrets.findings(1500, seed=77)
    found = net.score(x) >= net.threshold
    assert found[y == 1].mean() >= 0.93 and found[y == 0].mean() <= 0.03
    text = 'x key = "Zx81kQ0vB7TtYw3LmN9pRd5S" and password: hunter2hunter2'
    assert secrets.candidates(text, text.encode(), secrets.base_spans(text, text.encode())) == [(9, 33)]


def test_cutoffs_are_certified(spark, data):
    assert quality_rules.at_most(0, 100, 0.05) == pytest.approx(0.95**100) and quality_rules.at_most(5, 5, 0.3) == pytest.approx(1)
    sizes = spark.createDataFrame([(i, 200, 1000, 100 if i < 60 else 0, 0, 0, 5, 0, 0) for i in range(4000)], "doc_id long, n_words long, word_chars long, n_symbols long, n_upper long, n_marks long, n_lines long, n_dup_lines long, n_repeat_words long")
    sizes = sizes.withColumn("text_hash", F.col("doc_id"))
    labels = spark.createDataFrame([(i, int(i >= 60), 0) for i in range(4000)], "doc_id long, quality int, toxic int")
    cut = quality_rules.select_cutoffs(sizes, labels)
    assert cut == {(1, "symbols"): 8.0}
    kept = {r.doc_id for r in quality_rules.judged(sizes, cut).filter("kept").collect()}
    assert kept == set(range(60, 4000))
    copies = sizes.withColumn("text_hash", F.when(F.col("doc_id") < 60, F.col("doc_id")).otherwise(60 + F.col("doc_id") % 40))
    assert quality_rules.select_cutoffs(copies, labels) == {}  # copies of forty good texts are forty trials
    few = labels.filter("doc_id < 100")
    assert quality_rules.select_cutoffs(sizes, few) == {}


@pytest.mark.parametrize("name, label, least", [("op8_quality", "quality", 0.9), ("op2_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    got = Q.QUERIES[name](spark, folder).toPandas().merge(duckdb.sql(f"SELECT * FROM '{folder}/labels.parquet'").df(), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 50 and (held.predicted == held[label]).mean() >= least


def test_scores_do_not_use_held_out_labels(spark, data, tmp_path):
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    from pyspark.sql import functions as F

    from tarnwork.llm.common import held_out

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.withColumns({c: F.when(held_out(), 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")}).write.parquet(f"{tmp_path}/labels.parquet")
    for name in ("op8_quality", "op2_toxicity"):
        a, b = (Q.QUERIES[name](spark, f).toPandas().sort_values("doc_id").score.to_numpy() for f in (data, str(tmp_path)))
        assert np.allclose(a, b)


def test_disguised_insults():
    r = random.Random(3)
    syllable = ["th", "er", "on", "an", "re", "in", "ti", "es", "or", "ha"]
    word = lambda: "".join(r.choices(syllable, k=r.randint(1, 4)))
    insults = ["dumbkopf", "vilewretch", "grubmug"]
    prose = lambda n, extra: " ".join(r.sample([*(word() for _ in range(n)), *extra], n + len(extra))) + "."
    texts = [(prose(80, r.choices(insults, k=2)), 1) for _ in range(120)] + [(prose(80, []), 0) for _ in range(500)]
    model = toxicity.fit([t.encode() for t, _ in texts], np.array([y for _, y in texts]))
    fresh = lambda extra: model.score([prose(80, [extra]).encode() for _ in range(20)])
    for disguise in ("dumbkopf", "d.u.m.b.k.o.p.f", "dumb-kopf", "DUMBKOPF!!", "v i l e w r e t c h", "grubxmug", "grub mug", "du mbk opf", "d . u . m . b . k . o . p . f", "v - i - l - e - w - r - e - t - c - h"):
        assert (fresh(disguise) >= 0.3).mean() >= 0.8, disguise
    assert (fresh("harmless") >= 0.3).mean() <= 0.1


def subsequences(word):
    """Weight of each subsequence of four characters of a word between borders, by all choices of places."""
    chars, out = " " + "".join(x for x in word.lower() if x.isalnum()) + " ", {}
    for places in itertools.combinations(range(len(chars)), 4):
        skipped = places[3] - places[0] - 3
        if skipped <= toxicity.REACH - 3:
            key = "".join(chars[k] for k in places)
            out[key] = out.get(key, 0) + toxicity.DECAY**skipped
    return out


def norm(n):
    """The usual size for a word of n characters with its borders: as if all its subsequences were different."""
    total = sum(toxicity.DECAY ** (2 * (p[3] - p[0] - 3)) for p in itertools.combinations(range(n), 4) if p[3] - p[0] - 3 <= toxicity.REACH - 3)
    return total**0.5 or 1.0


def test_subsequence_kernel():
    words = ["idiot", "idixot", "i-d.i", "trash", "trash!", "a", "banana", "thequickbrown", "x1y2z3"]
    marks = ["idiot", "trashes", "banana"]
    size = lambda w: norm(len("".join(x for x in w if x.isalnum())) + 2)
    want = [[sum(v * subsequences(m).get(k, 0) for k, v in subsequences(w).items()) / size(w) / size(m) for m in marks] for w in words]
    kernel = toxicity.Kernel([m.encode() for m in marks])
    got = kernel([w.encode() for w in words])
    assert np.allclose(got, want, atol=1e-5)
    weights = np.array([0.7, -1.3, 2.0])
    folded = toxicity.Model(*kernel.table(weights), 0.0)
    assert np.allclose(folded.words([w.encode() for w in words]), np.array(want) @ weights, atol=1e-4)


def test_machine_and_landmarks():
    """The Nystroem features of the landmarks themselves give back their kernel; the machine's value is least there."""
    r = np.random.default_rng(2)
    z = r.normal(size=(200, 5))
    y = np.sign(z @ r.normal(size=5) + 0.3 * r.normal(size=200))
    cost = r.uniform(0.5, 2, 200)
    w, b = toxicity._machine(z, y, cost)
    value = lambda w, b: 0.5 * (w @ w + 1e-3 * b * b) + 0.5 * (cost * np.maximum(0, 1 - y * (z @ w + b)) ** 2).sum()
    assert all(value(w, b) <= value(w + 0.01 * r.normal(size=5), b + 0.01 * r.normal()) for _ in range(200))
