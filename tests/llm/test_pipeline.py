"""Stages of the pipeline against plain versions, each on its own input."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tarnwork.llm import mixture, quality

from . import brute
from .test_near import kept


@pytest.fixture(scope="module")
def stages(spark, data, tmp_path_factory):
    top, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{data}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, data).write.parquet(f"{top}/{k}")
        after = spark.read.parquet(f"{top}/{k}")
        out.append((docs.toPandas(), after.toPandas()))
        docs = after
    return out


def test_stages(spark, data, stages):
    before, after = stages[0]
    model = quality.train(spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet"))
    score = model.score(quality.features([(t or "").encode() for t in before.text]))
    assert set(after.doc_id) == set(before.doc_id[score >= corpus_pipeline.KEEP_SCORE]) and len(after) < len(before)
    before, after = stages[1]
    assert sorted(after.doc_id) == sorted(k for k, _ in brute.exact(list(zip(before.doc_id, before.text))).values())
    before, after = stages[2]
    assert sorted(after.doc_id) == kept(list(zip(before.doc_id, before.text)))
    before, after = stages[3]
    sizes = {i: len(brute.words(t)) for i, t in zip(before.doc_id, before.text)}
    copies = Counter(after.doc_id)
    assert max(copies.values()) <= 3 and set(copies) <= set(sizes)
    per_source = Counter()
    for i, s in zip(after.doc_id, after.source):
        per_source[s] += sizes[i]
    assert abs(sum(per_source.values()) - sum(sizes.values())) <= 0.1 * sum(sizes.values())
    for b, a in stages[:4]:
        assert list(a.columns) == list(b.columns)
    before, after = stages[4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert len(after) == len(before) and (after.decoded == after.text).all()
    assert all(np.array_equal(i, tokenizer.encode(t, add_special_tokens=False).ids) for i, t in zip(after.ids, after.text))


def test_run(spark, data, stages):
    got = corpus_pipeline.run(spark, data).toPandas()
    assert sorted(got.doc_id) == sorted(stages[4][1].doc_id)


def test_awkward_tables(spark, edge_dir, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, edge_dir)
        assert after.columns[: len(docs.columns)] == docs.columns, name
        if stage is corpus_pipeline.encoding_stage:
            assert after.columns[len(docs.columns) :] == ["ids_", "decoded"] and after.select("ids").distinct().collect() == [("?",)]
            after = after.select(docs.columns)
        assert after.exceptAll(docs).filter("text is not null").select("doc_id", "text").distinct().join(docs, ["doc_id", "text"], "left_anti").count() == 0
    assert {r.doc_id for r in corpus_pipeline.run(spark, edge_dir).select("doc_id").collect()} <= {r.doc_id for r in docs.collect()}
    exact = corpus_pipeline.exact_stage(spark, docs, edge_dir).toPandas()
    assert Counter(len(g) for _, g in exact.groupby(exact.text.fillna("").map(lambda t: t.translate(brute.UPPER)))) == {1: exact.text.fillna("").map(lambda t: t.translate(brute.UPPER)).nunique()}


def test_mixing_keeps_rows_apart(spark):
    """One id and text in two sources, a null id beside one that is called null, and rows that differ in another column only."""
    rows = [("1", "a b c d", "s0", "x"), ("1", "a b c d", "s1", "x"), (None, "e f g h", "s0", "x"), ("null", "e f g h", "s0", "x"), ("2", "i j k l", "s0", "x"), ("2", "i j k l", "s0", "y"), ("3", "m n o p", None, None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string, other string").repartition(2)
    got = {tuple(r) for r in mixture.mixed_documents(docs, weights=(1.0, 1.0, 1.0)).collect()}
    assert got <= set(rows)
    assert Counter((r.doc_id, r.source_size) for r in mixture.mix(docs).collect()) == Counter((i, {"s0": 20}.get(s, 4)) for i, _, s, _ in rows)
    even = spark.createDataFrame([(i, "a b c d", s, "x") for i in ("1", None, "null") for s in ("s0", "s1", None)], docs.schema)
    assert Counter(tuple(r) for r in mixture.mixed_documents(even, weights=(1.0, 1.0, 1.0)).collect()) == Counter(tuple(r) for r in even.collect())


def test_quality_stage_keeps_a_clashing_column(spark, data):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{data}/documents.parquet").withColumn("quality_score", F.lit("mine"))
    assert corpus_pipeline.quality_stage(spark, docs, data).select("quality_score").distinct().collect() == [("mine",)]
