"""Object keys and URLs as native column functions, and the request check."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Knowledge bases and their key segments.
KNOWLEDGE_BASES = {"Maintenance": "maintenance", "Construction": "construction", "BusinessIntelligence": "businessintelligence"}
DOC_TYPES = ("PDF", "EXCEL", "PPT", "DOCX")


def segment(kb: Column) -> Column:
    """Key segment of a knowledge base; null for an unknown one."""
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in KNOWLEDGE_BASES.items() for x in pair)), kb)


def documents_prefix(kb: Column) -> Column:
    return F.concat(F.lit("raw/"), segment(kb), F.lit("/documents"))


def images_prefix(kb: Column) -> Column:
    return F.concat(F.lit("raw/"), segment(kb), F.lit("/images"))


def image_key(kb: Column, doc_id: Column, page: Column, index: Column, ext: Column) -> Column:
    return F.concat(images_prefix(kb), F.lit("/"), doc_id.cast("string"), F.lit("/"), page.cast("string"), F.lit("_"), index.cast("string"), F.lit("."), ext)


def object_url(bucket: Column, key: Column) -> Column:
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), key)


def parse_object_url(url: Column) -> Column:
    """struct<bucket, key, error>: error is set unless the scheme is s3 (in any case) and a bucket is named; query and fragment are no part of the key."""
    pattern = r"^(?i:s3)://([^/?#]+)(?:/+([^?#]*))?.*$"
    bucket = F.regexp_extract(url, pattern, 1)
    bad = F.coalesce(bucket == "", F.lit(True))
    error = F.when(bad, F.concat(F.lit("ValueError: not an object URL: "), F.coalesce(url, F.lit("null"))))
    return F.struct(F.when(~bad, bucket).alias("bucket"), F.when(~bad, F.regexp_extract(url, pattern, 2)).alias("key"), error.alias("error"))


def check_request(knowledge_base: str | None, max_documents: int) -> None:
    """Raise ValueError unless the request is one that a job takes."""
    if knowledge_base is not None and knowledge_base not in KNOWLEDGE_BASES:
        raise ValueError(f"unknown knowledge base: {knowledge_base}")
    if not 1 <= max_documents <= 100:
        raise ValueError(f"max_documents must be 1 to 100, not {max_documents}")
