"""Whole jobs over a small store: outcomes, idempotence, failures, retries."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tarnwork.functions import models
from tarnwork.operators import stages, tables
from tarnwork.plans.job import Settings, Store, document_status, readiness, run_job, status_counts
from tests.test_extract import docx, pdf, pptx, xlsx

FILES = {
    "a": ("PDF", "Maintenance", lambda: pdf([(["Two lines.", "Of text."], True)])),
    "b": ("PDF", "Maintenance", lambda: pdf([(["Plain text only document."] * 30, False)])),
    "c": ("DOCX", "Construction", lambda: docx([(0, "intro"), (1, "A"), (0, "body")], 0)),
    "d": ("PPT", "Construction", pptx),
    "e": ("EXCEL", "BusinessIntelligence", xlsx),
    "f": ("PDF", "Maintenance", lambda: b"broken"),
    "g": ("PDF", "Maintenance", lambda: pdf([(["changed"], False)])),
    "h": ("TXT", "Maintenance", lambda: b"text"),
    "i": ("PDF", "Maintenance", lambda: pdf([([], False)])),
}


class Fails:
    def __call__(self, texts):
        raise ValueError("no vectors today")


class FailsOnce:
    """Times out until a file is there, which the first failure makes."""

    def __init__(self, flag):
        self.flag = flag

    def __call__(self, texts):
        if not os.path.exists(self.flag):
            open(self.flag, "w").close()
            raise TimeoutError("slow")
        return models.HashingEmbedder(32)(texts)


@pytest.fixture
def place(spark, tmp_path):
    objects, rows = tmp_path / "objects", []
    for k, (doc, (kind, kb, make)) in enumerate(FILES.items()):
        content = make()
        key = f"raw/{kb.lower()}/documents/{doc}.bin"
        (objects / key).parent.mkdir(parents=True, exist_ok=True)
        (objects / key).write_bytes(content)
        digest = hashlib.sha256(b"other" if doc == "g" else content).hexdigest().upper()
        rows.append((doc, kind, digest, doc, f"s3://any/{key}", kb, "NEW", k))
    rows.append(("z", "PDF", "0", "z", "s3://any/raw/none.pdf", "Maintenance", "NEW", 99))
    d = spark.createDataFrame(rows, "doc_id string, doc_type string, doc_hash string, doc_name string, s3_url string, knowledge_base_type string, status string, k int")
    d = d.withColumns({"created_at": F.timestamp_seconds("k"), **{n: F.lit(None).cast("string") for n in ("author", "source", "version", "last_error", "created_by", "updated_by")}, "updated_at": F.lit(None).cast("timestamp")})
    store = Store(spark, f"file://{tmp_path}/store")
    store.replace_documents(d)
    return store, f"file://{objects}"


def settings(**more):
    return Settings(dimension=32, embedder=lambda: models.HashingEmbedder(32), sleep=lambda s: None, **more)


def test_job(spark, place):
    store, objects = place
    done = []
    out = run_job(spark, store, objects, None, 100, settings(), done.append)
    assert (out.status, out.error_message) == ("COMPLETED", None) and done == [out]
    assert out.processed == ["a", "b", "c", "d", "e", "i"] and out.failed == ["f", "g", "h", "z"] and out.skipped == 1
    docs = {r.doc_id: r for r in store.read("documents").collect()}
    assert docs["a"].last_error is None and docs["a"].updated_at is not None
    assert '"failed_node":"parse_pdf"' in docs["f"].last_error and "hash" in docs["g"].last_error and "TXT" in docs["h"].last_error and "no object" in docs["z"].last_error
    chunks, vectors = store.read("document_chunks"), store.read("embeddings")
    assert chunks.count() == vectors.count() == chunks.select("doc_id", "chunk_hash").distinct().count() > 5
    assert chunks.filter("doc_id = 'a'").filter(F.col("content").contains("Image of ")).count() == 1
    assert not chunks.filter("doc_id = 'i'").count() and out.images == 3
    assert document_status(store.read("documents"), "a").first().status == "EMBEDDED" and status_counts(store.read("documents")).count() >= 4
    # Nothing is pending; putting documents back and running again adds no rows.
    assert run_job(spark, store, objects, None, 1, settings()).processed == []
    store.replace_documents(store.read("documents").withColumn("status", F.lit("NEW")))
    n = chunks.count()
    again = run_job(spark, store, objects, "Construction", 100, settings())
    assert again.processed == ["c", "d"] and store.read("document_chunks").count() == n == store.read("embeddings").count()
    assert readiness(spark, store, objects)["ready"] and not readiness(spark, store, objects + "x")["ready"]


def test_failing_and_slow_models(spark, place, tmp_path):
    store, objects = place
    out = run_job(spark, store, objects, "BusinessIntelligence", 1, Settings(dimension=32, embedder=Fails, sleep=lambda s: None))
    assert out.failed == ["e"] and '"failed_node":"embed_chunks"' in store.read("documents").filter("doc_id = 'e'").first().last_error
    pauses, flag = [], str(tmp_path / "flag")
    out = run_job(spark, store, objects, "Construction", 1, Settings(dimension=32, embedder=lambda: FailsOnce(flag), sleep=pauses.append))
    assert out.processed == ["c"] and len(pauses) == 1 and 0.5 <= pauses[0] < 1
    with pytest.raises(ValueError):
        run_job(spark, store, objects, "Other")


def test_status_write_is_retried_and_stuck_documents_return(spark, place, monkeypatch):
    from tarnwork.plans.job import requeue

    store, objects = place
    write, calls = store.replace_documents, []

    def flaky(rows):
        calls.append(1)
        if len(calls) == 2:  # the first write is the claim
            raise ConnectionError("store away")
        write(rows)

    monkeypatch.setattr(store, "replace_documents", flaky)
    slept = []
    done = run_job(spark, store, objects, max_documents=1, settings=Settings(sleep=slept.append))
    assert done.status == "COMPLETED" and len(calls) == 3 and len(slept) == 1

    def broken(rows):
        calls.append(1)
        if len(calls) > 4:
            raise ValueError("no")
        write(rows)

    monkeypatch.setattr(store, "replace_documents", broken)
    assert run_job(spark, store, objects, max_documents=1, settings=Settings(sleep=slept.append)).status == "CRASHED"
    monkeypatch.setattr(store, "replace_documents", write)
    assert store.read("documents").filter("status = 'PROCESSING'").count() == 1
    assert requeue(store) == 1 and requeue(store) == 0 and store.read("documents").filter("status = 'PROCESSING'").count() == 0


def test_tables(spark):
    rows = spark.createDataFrame([("d", "h", 2, "late"), ("d", "h", 1, "early"), ("d", "i", 3, "x")], "doc_id string, chunk_hash string, block_no int, content string").withColumn("chunk_no", F.lit(0))
    assert sorted(r.content for r in stages.distinct_chunks(rows).collect()) == ["early", "x"]
    assert tables.absent(rows, rows.filter("chunk_hash = 'h'"), ["doc_id", "chunk_hash"]).count() == 1
    bad = spark.createDataFrame([("PDF", "Maintenance"), ("TXT", "Maintenance"), ("PDF", None)], "doc_type string, knowledge_base_type string")
    assert [r[0] is None for r in bad.select(tables.invalid(bad)).collect()] == [True, False, False]


def test_registry_settings_and_log(spark, place):
    import io
    import json

    from tarnwork.plans.config import log_to, settings_from
    from tarnwork.plans.job import job_status

    store, objects = place
    stream = io.StringIO()
    log_to(stream)
    out = run_job(spark, store, objects, "BusinessIntelligence", 1, settings())
    assert [r.status for r in job_status(store.jobs(), out.job_id).collect()] == ["COMPLETED"]
    events = [json.loads(line) for line in stream.getvalue().splitlines()]
    assert [e["event"] for e in events] == ["job_start", "job_end"] and events[1]["job_id"] == out.job_id
    spark.conf.set("spark.tarnwork.chunk_overlap", "7")
    got = settings_from(spark, {"TARNWORK_CHUNK_SIZE": "50", "TARNWORK_CHUNK_OVERLAP": "9", "TARNWORK_BACKOFF_CAP": "2.5"})
    assert (got.chunk_size, got.chunk_overlap, got.backoff_cap) == (50, 7, 2.5)
    spark.conf.unset("spark.tarnwork.chunk_overlap")


def test_created_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS made")
    tables.create_tables(spark, "made")
    assert spark.table("made.embeddings").schema["vector"].dataType.simpleString() == "array<float>" and spark.table("made.documents").isEmpty()
    for t in ("documents", "document_chunks", "embeddings"):
        spark.sql(f"DROP TABLE made.{t}")
    spark.sql("DROP DATABASE made")


def test_objects(spark, place, monkeypatch):
    from tarnwork.sources import objects as store_of

    store, root = place
    documents = store.read("documents")
    by_path = {r.doc_id: r.content for r in store_of.with_content(documents, root).collect()}
    assert by_path["f"] == b"broken" and by_path["z"] is None and len(by_path) == len(FILES) + 1
    monkeypatch.setattr(store_of, "BY_PATH", 2)
    assert {r.doc_id: r.content for r in store_of.with_content(documents, root).collect()} == by_path
    none = store_of.with_content(documents.filter("doc_id = 'z'"), root).collect()
    assert [r.content for r in none] == [None]
    assert store_of.list_objects(spark, root, "raw/construction").count() == 2


def test_sql_functions(spark):
    from tarnwork.functions.register import register

    register(spark)
    row = spark.sql("SELECT normalize_text(' A  b ') AS n, text_simhash('a b') AS s, split_chunks('aaaa. bbbb. cccc.', 12, 6) AS c").first()
    assert row.n == "a b" and row.s > 0 and row.c == ["aaaa. bbbb.", "bbbb. cccc."]
    body = "one. <TABLE_REFERENCE>a. b.</TABLE_REFERENCE> two! three <IMAGE_REFERENCE src='x'></IMAGE_REFERENCE> four. <SPEAKER_NOTES>open"
    from tarnwork.functions import text

    d = spark.createDataFrame([(body,)], "body string")
    assert d.selectExpr("split_chunks(body, 20, 6) AS c").first().c == d.select(text.split_text(text.spans(F.col("body")), 20, 6).alias("c")).first().c
