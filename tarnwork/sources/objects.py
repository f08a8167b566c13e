"""Object store as files: binary reads by key, listings, and image writes partitioned by knowledge base."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import parse_object_url, segment


def list_objects(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """path, length, modificationTime of all objects below a prefix; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root.rstrip('/')}/{prefix}".rstrip("/"))
    return files.select("path", "length", "modificationTime")


#: So many documents, a job's worth, have their objects opened by path; for more, all of the store is read and joined.
BY_PATH = 1000


def with_content(documents: DataFrame, root: str) -> DataFrame:
    """documents with content of the object that s3_url names below root; null where there is none. root/<key> holds s3://<any bucket>/<key>."""
    spark, root = documents.sparkSession, root.rstrip("/")
    named = documents.withColumn("__key", parse_object_url(F.col("s3_url")).getField("key"))
    keys = [r[0] for r in named.select("__key").filter("__key != ''").distinct().limit(BY_PATH + 1).collect()]
    reader = spark.read.format("binaryFile")
    if len(keys) > BY_PATH:
        files = reader.option("recursiveFileLookup", "true").load(root)
    else:
        there = [f"{root}/{k}" for k in keys if _is_file(spark, f"{root}/{k}")]
        if not there:
            return named.drop("__key").withColumn("content", F.lit(None).cast("binary"))
        files = reader.load(there)
    # The part of a file's path below the root, whatever scheme and slashes it is listed with.
    top = root.split("://")[-1].removeprefix("file:").lstrip("/")
    keyed = files.select(F.substring_index("path", f"{top}/", -1).alias("__key"), "content")
    return named.join(keyed, "__key", "left").drop("__key")


def _is_file(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def write_images(images: DataFrame, documents: DataFrame, path: str) -> None:
    """Append images (doc_id, page, image_index, url, content) as a table partitioned by knowledge base."""
    kb = documents.select(F.col("doc_id").cast("string").alias("doc_id"), segment(F.col("knowledge_base_type")).alias("kb"))
    images.join(kb, "doc_id").write.mode("append").partitionBy("kb").parquet(path)
