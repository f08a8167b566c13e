"""Every query on awkward and on empty tables, against plain versions."""

import zlib
from collections import Counter

import numpy as np
import pytest

from tarnwork.llm import queries as Q

from . import brute


def run(spark, name, folder):
    return [r.asDict() for r in Q.QUERIES[name](spark, folder).collect()]


def tally(rows):
    return Counter(map(repr, rows))


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert run(spark, name, empty_dir) == []


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_one_row_for_each_row(spark, edge_dir, edges, name):
    got = run(spark, name, edge_dir)
    assert tally(r["doc_id"] for r in got) == tally(i for i, _, _ in edges)


def test_exact(spark, edge_dir, edges):
    groups = brute.exact([(i, t) for i, t, _ in edges])
    want = [(i, *groups[n], brute.sha(n)) for i, t, _ in edges for n in [(t or "").translate(brute.UPPER)]]
    got = run(spark, "op1_exact_dedup", edge_dir)
    assert tally((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == tally(want)
    kept = [r for r in got if r["kept"]]
    assert Counter(r["text_sha256"] for r in kept) == Counter({r["text_sha256"]: 1 for r in got}) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_substrings(spark, edge_dir, edges):
    got = run(spark, "op4_substring_dedup", edge_dir)
    want = [(i, *x) for (i, _, _), x in zip(edges, brute.repeats([t for _, t, _ in edges]))]
    assert tally((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == tally(want)


def test_rules(spark, edge_dir, edges):
    got = run(spark, "op5_quality_rules", edge_dir)
    want = [(i, *brute.measures(t)) for i, t, _ in edges]
    assert tally((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got) == tally(want)
    assert all(r["kept"] == (not r["base_failed"]) for r in got)  # too few labels to certify a cutoff


def test_secrets(spark, edge_dir, edges):
    got = run(spark, "op3_secrets", edge_dir)
    base = [brute.base_secrets(t) for _, t, _ in edges]
    assert tally((r["doc_id"], r["base_sha256"]) for r in got) == tally((i, brute.sha(",".join(b))) for (i, _, _), b in zip(edges, base))
    ten = next(r for r in got if r["doc_id"] == 10)
    assert (ten["n_assign"], ten["n_access"], ten["n_hex"]) == (1, 1, 1) and set(base[[i for i, _, _ in edges].index(10)]) <= set(ten["spans"].split(","))


def test_mixture(spark, edge_dir, edges):
    got = run(spark, "op7_mixture", edge_dir)
    sizes = Counter()
    for _, t, s in edges:
        sizes[s] += len(brute.words(t))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: k % 3 + 1.0 for k, s in enumerate(order)}
    total, full = float(sum(sizes.values())), set()
    while True:  # share by weight, cap, share the rest again
        left = total - sum(3 * sizes[s] for s in full)
        share = {s: 3.0 * sizes[s] if s in full else left * weight[s] / sum(weight[x] for x in order if x not in full) for s in order}
        over = {s for s in order if share[s] > 3 * sizes[s]}
        if not over:
            break
        full |= over
    targets = Counter((len(brute.words(t)), sizes[s], round(share[s], 6)) for _, t, s in edges)
    assert Counter((r["size"], r["source_size"], round(r["target"], 6)) for r in got) == targets
    taken = Counter()
    for r in got:
        taken[round(r["target"], 6)] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["position"] is None) == (r["taken"] == 0)
    same = Counter(round(share[s], 6) for s in order)
    assert all(abs(n - t * same[t]) <= same[t] for t, n in taken.items())
    assert tally(run(spark, "op7_mixture", edge_dir)) == tally(got)


def test_sharding(spark, edge_dir, edges):
    got = run(spark, "op9_sharding", edge_dir)
    assert tally((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == tally((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in edges)
    shards = Counter(r["shard"] for r in got)
    assert max(shards.values()) - min(shards.get(k, 0) for k in range(16)) <= 1
    assert sorted((r["shard"], r["slot"]) for r in got) == sorted((k, s) for k, n in shards.items() for s in range(n))
    assert {r["row_number"] for r in got} == set(range(len(edges)))


def test_simhash(spark, edge_dir, edges):
    prints = [brute.fingerprint(t) for _, t, _ in edges]
    label = brute.components(prints)
    least = {c: min((i for (i, _, _), x in zip(edges, label) if x == c and i is not None), default=None) for c in label}
    got = run(spark, "op10_simhash", edge_dir)
    assert tally((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == tally((i, f"{p:016x}", least[c]) for (i, _, _), p, c in zip(edges, prints, label))


@pytest.mark.parametrize("name", ["op2_toxicity", "op8_quality"])
def test_scores(spark, edge_dir, edges, name):
    got = run(spark, name, edge_dir)
    assert all(0 <= r["score"] <= 1 and not np.isnan(r["score"]) and r["predicted"] == (r["score"] >= (0.3 if name == "op2_toxicity" else 0.7)) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
