"""Rows that models are fitted on."""

import zlib

import numpy as np
import pytest

from tarnwork.llm import quality, toxicity


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.mark.parametrize("usable", [40, 400])
def test_mostly_null_labels(spark, usable):
    labels = spark.range(4000).selectExpr("id AS doc_id", f"CASE WHEN id < {usable} THEN int(id % 2) END AS quality")
    docs = labels.selectExpr("doc_id", "concat('text ', doc_id) AS text")
    rows = quality.training_texts(docs, labels, "quality", "doc_id", "text", 20).collect()
    assert len(rows) == 20 and all(int(r.text.split()[1]) < usable and not held(int(r.text.split()[1])) for r in rows)


def test_repeated_ids_and_long_texts_stay_bounded(spark):
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    flood = spark.range(5000).selectExpr("1L AS doc_id", "concat('row ', id) AS text").unionByName(spark.range(2000).selectExpr("3L AS doc_id", "'same' AS text"))
    assert not held(1) and not held(3)
    rows = quality.training_texts(flood, labels, "quality", "doc_id", "text", 300).collect()
    assert len(rows) == 300 == len({r.text for r in rows})
    rows = quality.training_texts(flood, labels, "quality", "doc_id", "text", 300, 400).collect()
    assert 40 < len(rows) < 80 and sum(len(r.text) for r in rows) <= 400
    assert toxicity.train(flood, labels.withColumnRenamed("quality", "toxic"), sample=50) is not None


def test_prior_is_of_all_documents(spark):
    """A kind of junk that no drawn row shows counts."""
    r = np.random.default_rng(3)
    prose = lambda: " ".join("".join(r.choice(list("abcdefghij"), 6)) for _ in range(60)) + "."
    rows = [(i, prose()) for i in range(1200)] + [(i, " ".join(["###!!!"] * 60)) for i in range(1200, 2400)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, 1) for i in range(600)], "doc_id long, quality int")
    model = quality.train(docs, labels, sample=300)
    assert 0.45 <= model.prior <= 0.62
    score = model.score(quality.features([t.encode() for _, t in rows]))
    assert (score[:1200] >= 0.7).mean() > 0.97 and (score[1200:] >= 0.7).mean() < 0.02
