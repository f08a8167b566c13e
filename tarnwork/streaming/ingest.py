"""The chunk pipeline over a stream of document files: available now, idempotent by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import stages, tables


def stream_documents(spark: SparkSession, folder: str, schema, files_a_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(folder)


def ingest_batch(batch: DataFrame, target: str, size: int, overlap: int) -> None:
    """Chunk a batch and append the chunks that the target doesn't have; a repeated batch adds nothing."""
    spark = batch.sparkSession
    blocks = batch.select(F.col("doc_id").cast("string").alias("doc_id"), F.lit(0).alias("block_no"), F.lit(1).alias("page"), F.lit("page-1").alias("section"), "text")
    rows = stages.distinct_chunks(stages.fingerprinted(stages.chunked(blocks, size=size, overlap=overlap)))
    rows = rows.select("chunk_id", "doc_id", "chunk_no", "content", "chunk_hash", "chunk_simhash", "section", "page")
    p = spark._jvm.org.apache.hadoop.fs.Path(target)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        rows = tables.absent(rows, spark.read.schema(rows.schema).parquet(target), ["doc_id", "chunk_hash"])
    rows.write.mode("append").parquet(target)


def ingest_stream(spark: SparkSession, folder: str, schema, target: str, checkpoint: str, files_a_batch: int = 1, size: int = stages.CHUNK_SIZE, overlap: int = stages.CHUNK_OVERLAP) -> None:
    """Take all files that are there now, so many a batch, and stop; a next call takes what came since."""
    stream = stream_documents(spark, folder, schema, files_a_batch)
    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda batch, _: ingest_batch(batch, target, size, overlap)).start()
    query.awaitTermination()
