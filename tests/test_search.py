"""Vector and fingerprint searches against brute force."""

import numpy as np
import pytest

from tarnwork.operators import search


@pytest.fixture(scope="module")
def vectors(spark):
    r = np.random.default_rng(2)
    centres = r.normal(size=(12, 24))
    x = centres[r.integers(0, 12, 1500)] + r.normal(scale=0.6, size=(1500, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, [0.0] * 24), (2001, None), (2002, x[3].tolist()), (2003, x[3].tolist())]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4), x


def pairs(df):
    return {(r.query_id, r["rank"]): r.vec_id for r in df.collect()}


def test_exact_and_indexed(spark, vectors, monkeypatch):
    df, x = vectors
    unit = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32).astype(float)
    queries = df.filter("vec_id % 20 = 0")
    got = pairs(search.cosine_topk(df, queries, 5))
    assert len(got) == 5 * 75 and got[(20, 1)] == max(range(1500), key=lambda j: -2 if j == 20 else unit[20] @ unit[j])
    monkeypatch.setattr(search, "BLOCK_BYTES", 2000)
    assert pairs(search.cosine_topk(df, queries, 5)) == got
    centres = search.fit_cells(df, 12)
    assert pairs(search.ann_topk(df, queries, 5, centres, 12)) == got
    monkeypatch.setattr(search, "CELL_ROWS", 20)  # cells in several parts
    assert pairs(search.ann_topk(df, queries, 5, centres, 12)) == got
    near = pairs(search.ann_topk(df, queries, 5, centres, 6))
    hit = {(q, v) for (q, _), v in near.items()} & {(q, v) for (q, _), v in got.items()}
    assert len(hit) >= 0.9 * len(got)
    assert pairs(search.cosine_topk(df, df.filter("vec_id in (3, 2002)"), 2)) == {(3, 1): 2002, (3, 2): 2003, (2002, 1): 3, (2002, 2): 2003}


def test_recall_of_the_query(spark, data):
    from tarnwork.plans.queries import QUERIES

    exact, near = ({(r.query_id, r.vec_id) for r in QUERIES[n](spark, data).collect()} for n in ("cosine_topk", "ann_topk"))
    assert len(exact & near) >= 0.9 * len(exact)


def test_simhash_pairs(spark):
    r = np.random.default_rng(5)
    h = r.integers(0, 1 << 62, 300)
    for k in range(200):
        h = np.append(h, h[k] ^ np.bitwise_or.reduce([1 << int(b) for b in r.integers(0, 63, 1 + k % 5)]))
    h = np.append(h, h[:20])
    d = spark.createDataFrame([(i, int(v)) for i, v in enumerate(h)], "doc_id long, simhash long")
    first = {}
    for i, v in enumerate(h.tolist()):
        first.setdefault(v, i)
    for most in (0, 1, 3):
        want = {(a, b, bin(u ^ v).count("1")) for u, a in first.items() for v, b in first.items() if a < b and bin(u ^ v).count("1") <= most}
        assert {tuple(x) for x in search.near_by_simhash(d, most).collect()} == want
