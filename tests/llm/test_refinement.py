"""Exact deduplication: how much the refinement leaves, and the way without a broadcast."""

from collections import Counter

import pytest

import corpus_pipeline
from tarnwork.llm import exact_dedup
from tarnwork.llm.common import Scratch

from . import brute


@pytest.mark.parametrize("n", [2_000, 200_000])
def test_rows_left_open(spark, n):
    """Of texts of one length all but those that have an equal are settled by their prefixes, at any size."""
    docs = spark.range(n).selectExpr("id AS doc_id", f"lpad(string(id % {n - n // 100}), 12, '0') AS text")
    rows = exact_dedup.signed(docs, Scratch(spark), ["doc_id"])
    assert rows.filter("open").count() == 2 * (n // 100)


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_with_and_without_broadcast(spark, monkeypatch, edges, edge_dir, most):
    monkeypatch.setattr(exact_dedup, "BROADCAST_KEYS", most)
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    groups = brute.exact([(i, t) for i, t, _ in edges])
    got = exact_dedup.exact_groups(docs).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == Counter((i, *groups[(t or "").translate(brute.UPPER)]) for i, t, _ in edges)
    kept = [r.doc_id for r in corpus_pipeline.exact_stage(spark, docs, edge_dir).collect()]
    assert Counter(kept) == Counter(k for k, _ in groups.values())
