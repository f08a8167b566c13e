"""Near-duplicates against all pairs of documents, compared as sets of five-word shingles."""

import random

import numpy as np

import corpus_pipeline
from tarnwork.llm import near

from . import brute


def shingles(text):
    w = brute.words((text or "").translate(brute.UPPER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())


def kept(rows):
    """doc_ids that stay: the least of each component of pairs with a similarity of 0.8 or more."""
    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if label[a] != label[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    return sorted(min(i for (i, _), x in zip(rows, label) if x == c) for c in set(label))


def test_near_copies(spark, tmp_path):
    r = random.Random(8)
    text = lambda n: [f"w{r.randint(0, 5000)}" for _ in range(n)]
    rows, passage = [("", 0), (" \n", 0)], text(150)
    for n in (3, 5, 8, 60, 200, 3000):
        base = text(n)
        for cut in (0, 1, 2, 4, 8, n // 60, n // 45, n // 40, n // 30):
            copy = list(base)
            for k in r.sample(range(n), min(cut, n)):
                copy[k] = f"x{r.randint(0, 5000)}"
            rows.append((" ".join(copy), 0))
    rows += [(" ".join(text(30) + passage + text(40)), 0) for _ in range(60)]  # alike in one passage only
    base = text(120)
    for _ in range(150):  # a large group around the limit
        copy = list(base)
        for k in r.sample(range(120), r.randint(1, 4)):
            copy[k] = f"y{r.randint(0, 5000)}"
        rows.append((" ".join(copy), 0))
    rows = [(i, t) for i, (t, _) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = kept(rows)
    assert sorted(x.doc_id for x in corpus_pipeline.near_stage(spark, docs, "").collect()) == want
    prints = np.array([brute.fingerprint(t) for _, t in rows], np.uint64)
    assert len(want) < len(set(brute.components(prints)))  # fingerprints of op10 miss most of them


def test_wide_bitmaps_rule_out_only_unlike_sets():
    r, texts = random.Random(9), ["", "a", "a b c d e f"]
    for n in (300, 515, 700, 4000, 20_000):  # sizes on both sides of the widths
        base = [f"w{r.randint(0, 9999)}" for _ in range(n)]
        for part in (0, 0.01, 0.02, 0.024, 0.03, 0.1, 1):
            texts.append(" ".join(f"x{r.randint(0, 9999)}" if r.random() < part else w for w in base))
        texts.append(" ".join(base[: int(n * 0.81)]))
    value, first = near.shingle_sets([t.encode() for t in texts])
    _, sizes, _, wide = near.summaries(value, first)
    sets = [value[a:b] for a, b in zip(first[:-1], first[1:])]
    alike = 0
    for a in range(len(texts)):
        for b in range(a):
            both, either = len(np.intersect1d(sets[a], sets[b])), max(1, len(np.union1d(sets[a], sets[b])))
            is_similar = near.similar(sets[a].tobytes(), sets[b].tobytes())
            if near.may_be_similar(wide[a], sizes[a], wide[b], sizes[b]):
                assert both / either >= 0.7  # the bitmaps leave only pairs close to the limit
            else:
                assert not is_similar
            alike += is_similar
    assert alike >= 10
