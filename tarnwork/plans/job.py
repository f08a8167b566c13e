"""A job over a batch of queued documents: claim, verify, extract, summarise, assemble, chunk, embed, status.

Everything is one set of DataFrames; each stage's result is written under the store's work folder before the next one
reads it, so lost executors cost a stage's tasks and nothing is computed twice. Errors are rows. Stages that call
Python take their retryable failures again, up to the retry budget of a document, with growing pauses in between.
"""

from __future__ import annotations

import logging
import random
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import models, resilience
from ..functions.keys import check_request
from ..functions.resilience import BACKOFF_BASE, BACKOFF_CAP, MAX_RETRIES
from ..operators import stages, tables
from ..sources.objects import with_content, write_images


JOBS = "job_id string, status string, processed array<string>, failed array<string>, skipped int, elapsed_ms long, chunks long, images long, error_type string, error_message string"
log = logging.getLogger("tarnwork")


@dataclass
class Settings:
    chunk_size: int = stages.CHUNK_SIZE
    chunk_overlap: int = stages.CHUNK_OVERLAP
    dimension: int = models.DIMENSION
    max_retries: int = MAX_RETRIES
    backoff_base: float = BACKOFF_BASE
    backoff_cap: float = BACKOFF_CAP
    summarizer: Callable = models.OfflineSummarizer
    embedder: Callable = models.HashingEmbedder
    sleep: Callable[[float], None] = field(default=time.sleep, repr=False)


class Store:
    """Tables documents, document_chunks, embeddings and images below a folder; one writer."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def read(self, table: str) -> DataFrame:
        schema = {"documents": tables.DOCUMENTS, "document_chunks": tables.CHUNKS, "embeddings": tables.EMBEDDINGS}[table]
        path = self._current() if table == "documents" else self.path(table)
        return self.spark.read.schema(schema).parquet(path) if path and self._exists(path) else self.spark.createDataFrame([], schema)

    def append(self, table: str, rows: DataFrame, keys: list[str]) -> None:
        """Insert rows whose key is not stored yet; doing it again changes nothing."""
        schema = {"document_chunks": tables.CHUNKS, "embeddings": tables.EMBEDDINGS}[table]
        audit = {"created_at": F.current_timestamp(), "updated_at": F.current_timestamp(), "created_by": F.lit("ingestion"), "updated_by": F.lit("ingestion")}
        tables.absent(rows, self.read(table), keys).withColumns(audit).select([f.name for f in schema.fields]).write.mode("append").parquet(self.path(table))

    def record(self, summary: JobSummary) -> None:
        """Add a job to the registry."""
        self.spark.createDataFrame([tuple(asdict(summary).values())], JOBS).coalesce(1).write.mode("append").parquet(self.path("jobs"))

    def jobs(self) -> DataFrame:
        return self.spark.read.schema(JOBS).parquet(self.path("jobs")) if self._exists(self.path("jobs")) else self.spark.createDataFrame([], JOBS)

    def _versions(self) -> list[str]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path("documents"))
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if self._exists(f"{s.getPath()}/_SUCCESS")) if fs.exists(p) else []

    def _current(self) -> str | None:
        versions = self._versions()
        return f"{self.path('documents')}/{versions[-1]}" if versions else None

    def replace_documents(self, rows: DataFrame) -> None:
        """Write a new version of the queue; readers take the newest complete one."""
        versions = self._versions()
        n = int(versions[-1][1:]) + 1 if versions else 0
        rows.select([f.name for f in tables.DOCUMENTS.fields]).write.mode("overwrite").parquet(f"{self.path('documents')}/v{n:08d}")


@dataclass
class JobSummary:
    job_id: str
    status: str
    processed: list[str]
    failed: list[str]
    skipped: int
    elapsed_ms: int
    chunks: int = 0
    images: int = 0
    error_type: str | None = None
    error_message: str | None = None


def with_retries(rows: DataFrame, stage: Callable[[DataFrame], DataFrame], key: list[str], write: Callable[[DataFrame], DataFrame], settings: Settings) -> DataFrame:
    """stage(rows) with failed rows that may be retried taken again; each result has error, and retry_count of how often."""
    done, todo = None, rows
    for attempt in range(settings.max_retries + 1):
        out = write(stage(todo).withColumn("retry_count", F.lit(attempt)))
        again = F.coalesce(F.col("error.retryable"), F.lit(False)) if attempt < settings.max_retries else F.lit(False)
        finished = out.filter(~again)
        done = finished if done is None else done.unionByName(finished)
        failed = out.filter(again).select(*key).distinct()
        if attempt == settings.max_retries or failed.isEmpty():
            return done
        settings.sleep(min(settings.backoff_cap, settings.backoff_base * 2**attempt) * random.uniform(0.5, 1.0))
        todo = rows.join(failed, key, "left_semi")
    return done


def attempted(do: Callable[[], None], settings: Settings) -> None:
    """do(), again after failures that may pass, as often and as late as stages are."""
    for attempt in range(settings.max_retries + 1):
        try:
            return do()
        except Exception as e:
            # What Spark's writers raise comes wrapped; the store's own failures are told by their Java names.
            passing = resilience.classify(e) or any(name in str(e) for name in ("java.io.IOException", "TimeoutException", "ConnectException"))
            if attempt == settings.max_retries or not passing:
                raise
            log.warning("write_retry", extra={"fields": {"attempt": attempt + 1, "error": type(e).__name__}})
            settings.sleep(min(settings.backoff_cap, settings.backoff_base * 2**attempt) * random.uniform(0.5, 1.0))


def requeue(store: Store) -> int:
    """Put documents that a crashed job left in PROCESSING back to NEW; only while no job runs. Chunks and vectors that it stored are found again by their keys."""
    documents = store.read("documents")
    stuck = F.col("status") == "PROCESSING"
    n = documents.filter(stuck).count()
    if n:
        store.replace_documents(documents.withColumn("status", F.when(stuck, "NEW").otherwise(F.col("status"))))
    return n


def run_job(spark: SparkSession, store: Store, objects: str, knowledge_base: str | None = None, max_documents: int = 1, settings: Settings | None = None, on_complete: Callable[[JobSummary], None] | None = None) -> JobSummary:
    """Take up to max_documents pending documents through all stages. objects is the root folder of the object store."""
    check_request(knowledge_base, max_documents)
    settings, job, began = settings or Settings(), uuid.uuid4().hex, time.monotonic()
    spark.sparkContext.setJobDescription(f"ingestion {job}")
    elapsed = lambda: int((time.monotonic() - began) * 1000)
    try:
        result = _run(spark, store, objects, knowledge_base, max_documents, settings, job)
        row = stages.summary(result, max_documents).first()
        out = JobSummary(job, "COMPLETED", row.processed, row.failed, row.skipped, elapsed(), row.chunks, row.images)
    except Exception as e:
        out = JobSummary(job, "CRASHED", [], [], 0, elapsed(), error_type=type(e).__name__, error_message=str(e))
    finally:
        spark.sparkContext.setJobDescription(None)
    store.record(out)
    log.info("job_end", extra={"fields": asdict(out)})
    if on_complete:
        on_complete(out)
    return out


def _run(spark: SparkSession, store: Store, objects: str, knowledge_base: str | None, most: int, settings: Settings, job: str) -> DataFrame:
    steps = iter(range(1_000_000))

    def write(df: DataFrame) -> DataFrame:
        path = f"{store.folder}/work/{job}/{next(steps)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    documents = store.read("documents")
    claimed = write(stages.claim(documents, knowledge_base, most))
    log.info("job_start", extra={"fields": {"job_id": job, "knowledge_base": knowledge_base, "max_documents": most}})
    store.replace_documents(documents.withColumn("status", F.when(F.col("doc_id").isin([r.doc_id for r in claimed.select("doc_id").collect()]), "PROCESSING").otherwise(F.col("status"))))  # at most 100 ids
    ready = stages.verified(with_content(claimed, objects))
    extracted = with_retries(ready, lambda d: stages.extract(d), ["doc_id"], write, settings)
    blocks, images = stages.blocks_of(extracted), stages.images_of(extracted)
    write_images(images, claimed, store.path("images"))
    summaries = write(models.summarize(images, settings.summarizer))
    chunks = write(stages.fingerprinted(stages.chunked(stages.assemble(blocks, summaries), size=settings.chunk_size, overlap=settings.chunk_overlap)))
    distinct = stages.distinct_chunks(chunks)
    store.append("document_chunks", distinct, ["doc_id", "chunk_hash"])
    kept = tables.reconciled(distinct, store.read("document_chunks"))
    vectors = with_retries(kept.select("doc_id", "chunk_id", "content"), lambda d: stages.embedded(d, settings.embedder, settings.dimension), ["chunk_id"], write, settings)
    store.append("embeddings", vectors.filter("error is null"), ["chunk_id"])
    errors = extracted.select("doc_id", "error", "retry_count").unionByName(vectors.select("doc_id", "error", "retry_count"))
    tries = errors.groupBy("doc_id").agg(F.max("retry_count").alias("retry_count"))
    outcome = write(stages.outcomes(claimed, errors, chunks, images).join(tries, "doc_id", "left"))
    attempted(lambda: store.replace_documents(stages.updated(store.read("documents"), outcome)), settings)
    return outcome


def job_status(jobs: DataFrame, job_id: str) -> DataFrame:
    return jobs.filter(F.col("job_id") == job_id)


def document_status(documents: DataFrame, doc_id: str) -> DataFrame:
    return documents.filter(F.col("doc_id") == doc_id).select("doc_id", "status", "last_error", "updated_at")


def status_counts(documents: DataFrame) -> DataFrame:
    return documents.groupBy("knowledge_base_type", "status").count()


def readiness(spark: SparkSession, store: Store, objects: str) -> dict[str, bool]:
    """Which of the things that a job needs can be reached."""
    checks = {"store": lambda: store.read("documents").limit(1).count() >= 0, "objects": lambda: store._exists(objects), "spark": lambda: spark.range(1).count() == 1}
    out = {}
    for name, check in checks.items():
        try:
            out[name] = bool(check())
        except Exception:  # a check that can't be made has failed
            out[name] = False
    return {**out, "ready": all(out.values())}
