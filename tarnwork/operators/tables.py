"""Schemas of the stored tables, and idempotent writes to them without a table format: anti-join and append, one writer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import DOC_TYPES, KNOWLEDGE_BASES

STATUSES = ("NEW", "PROCESSING", "EMBEDDED", "FAILED")
_AUDIT = [T.StructField("created_at", T.TimestampType()), T.StructField("updated_at", T.TimestampType()), T.StructField("created_by", T.StringType()), T.StructField("updated_by", T.StringType())]
_TEXT = lambda *names: [T.StructField(n, T.StringType()) for n in names]
DOCUMENTS = T.StructType([*_TEXT("doc_id", "doc_type", "doc_hash", "doc_name", "author", "source", "version", "s3_url", "knowledge_base_type", "status", "last_error"), *_AUDIT])
CHUNKS = T.StructType([*_TEXT("chunk_id", "doc_id", "content", "normalized_content", "chunk_hash"), T.StructField("chunk_simhash", T.LongType()), T.StructField("section", T.StringType()), T.StructField("page", T.IntegerType()), *_AUDIT])
EMBEDDINGS = T.StructType([*_TEXT("embedding_id", "chunk_id"), T.StructField("vector", T.ArrayType(T.FloatType(), False)), *_AUDIT])


def chunk_id(doc_id: Column, chunk_hash: Column) -> Column:
    """A deterministic id, so that a retried task writes the same one."""
    return F.sha2(F.concat(doc_id.cast("string"), F.lit("\u0000"), chunk_hash).cast("binary"), 256)


def embedding_id(chunk: Column) -> Column:
    return F.sha2(chunk.cast("binary"), 256)


def first_of(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order: what an insert that ignores conflicts keeps."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__first", F.row_number().over(first)).filter("__first = 1").drop("__first")


def absent(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the stored table doesn't have."""
    return rows.join(stored.select(*keys), keys, "left_anti")


def reconciled(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """rows with the stored chunk_id; rows that aren't stored are dropped."""
    return rows.drop("chunk_id").join(stored.select("doc_id", "chunk_hash", "chunk_id"), ["doc_id", "chunk_hash"])


def orphans_removed(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Cascade of a delete: chunks whose document is gone are dropped."""
    return chunks.join(documents.select("doc_id"), "doc_id", "left_semi")


def invalid(documents: DataFrame) -> Column:
    """Why a queued row can't be processed, or null."""
    one_of = lambda c, values: ~F.coalesce(F.col(c).isin(*values), F.lit(False))
    return F.when(one_of("doc_type", DOC_TYPES), F.concat(F.lit("unsupported doc_type: "), F.coalesce("doc_type", F.lit("null")))).when(
        one_of("knowledge_base_type", KNOWLEDGE_BASES), F.concat(F.lit("unknown knowledge base: "), F.coalesce("knowledge_base_type", F.lit("null")))
    )


def create_tables(spark, database: str = "default") -> None:
    """Empty tables of the three schemas, if they are missing; chunks are bucketed by document for joins without a shuffle."""
    for name, schema, spec in (("documents", DOCUMENTS, "PARTITIONED BY (knowledge_base_type)"), ("document_chunks", CHUNKS, "CLUSTERED BY (doc_id) INTO 32 BUCKETS"), ("embeddings", EMBEDDINGS, "CLUSTERED BY (chunk_id) INTO 32 BUCKETS")):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet {spec}")
