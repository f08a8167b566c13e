"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash. Native.

Two texts are equal when identical after lower-casing A-Z. A first scan writes each row's length and the hash of its
first PREFIX characters. Lengths that occur once are settled by counting lengths; of the rest, pairs of length and
prefix that occur once by counting pairs; only rows of the pairs that are left are grouped by the hash of their whole
content, in a second scan. Pairs are broadcast to it while they are at most BROADCAST_KEYS, so that it hashes their rows
alone. Of more pairs it hashes all rows, and the hashes, not the texts, are joined with the pairs.

Null text counts as empty, and empty texts are equal to each other. Of equal texts the row with the largest doc_id
stays (null is least); of repeated rows with that doc_id one stays. Texts of any length are hashed whole. An empty
table gives an empty result. Only the named columns are read by exact_groups, so others can have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ascii_lower, text_or_empty

#: Pairs of length and prefix, or lengths, that are broadcast at most (16 bytes each).
BROADCAST_KEYS = 1_000_000
PREFIX = 256


def _checked(keys: DataFrame) -> tuple[DataFrame, bool]:
    """keys, to be broadcast if they are few enough, and whether they are."""
    few = keys.count() <= BROADCAST_KEYS
    return (F.broadcast(keys) if few else keys), few


def refined(docs: DataFrame, scratch: Scratch, text: str = "text") -> tuple[DataFrame, DataFrame, bool]:
    """docs with __norm, the normalised text, __length and __prefix; pairs of the latter two that several rows have; whether they are few."""
    norm = docs.withColumn("__norm", ascii_lower(text_or_empty(text)))
    keyed = norm.withColumns({"__length": F.octet_length("__norm").cast("long"), "__prefix": F.xxhash64(F.substring("__norm", 1, PREFIX))})
    slim = scratch.write(keyed.select("__length", "__prefix"))
    lengths, _ = _checked(scratch.write(slim.groupBy("__length").count().filter("count > 1").select("__length")))
    pairs = scratch.write(slim.join(lengths, "__length", "left_semi").groupBy("__length", "__prefix").count().filter("count > 1").select("__length", "__prefix"))
    return keyed, *_checked(pairs)


def signed(docs: DataFrame, scratch: Scratch, columns: list[str], text: str = "text", digest_all: bool = False) -> DataFrame:
    """columns of docs, whether the row may have an equal (open), and its full hash (sha), null where the refinement needs none unless digest_all."""
    keyed, pairs, few = refined(docs, scratch, text)
    marked = pairs.withColumn("__found", F.lit(True))
    open_, sha = F.coalesce("__found", F.lit(False)), F.sha2(F.col("__norm").cast("binary"), 256)
    if few:
        return keyed.join(marked, ["__length", "__prefix"], "left").select(*columns, open_.alias("open"), (sha if digest_all else F.when(open_, sha)).alias("sha"))
    # Hashes before the join, so that texts are not shuffled, unless columns have them.
    hashed = keyed.select(*columns, "__length", "__prefix", sha.alias("sha"))
    return hashed.join(marked, ["__length", "__prefix"], "left").select(*columns, open_.alias("open"), (F.col("sha") if digest_all else F.when(open_, F.col("sha"))).alias("sha"))


def exact_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text", digest_all: bool = False) -> DataFrame:
    """One row per row of df: doc_id, keep_id, group_size, kept, text_sha256 (null where the refinement needed none, unless digest_all)."""
    scratch = Scratch(df.sparkSession)
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    hashed = scratch.write(signed(rows, scratch, ["doc_id"], digest_all=digest_all).select("doc_id", "open", F.col("sha").alias("text_sha256"), F.monotonically_increasing_id().alias("row")))
    opened = hashed.filter("open")
    groups = scratch.write(
        opened.groupBy("text_sha256").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size"))
        .select("text_sha256", F.col("keep.doc_id").alias("keep_id"), F.col("keep.row").alias("keep_row"), "group_size"),
        rows=hashed.count(),
    )
    scratch.keep(hashed, groups)
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    grouped = opened.join(groups, "text_sha256").withColumn("kept", F.col("row") == F.col("keep_row")).select(columns)
    alone = hashed.filter("not open").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    return grouped.unionByName(alone)


def exact_dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df that stay, with all their columns."""
    scratch = Scratch(df.sparkSession)
    packed = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("__row"), F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("__text"))
    rows = signed(packed, scratch, ["__row", "__id"], "__text")
    unpack = lambda x: x.select(*(F.col("__row").getField(c).alias(c) for c in df.columns))
    opened = rows.filter("open").select("__row", "__id", F.col("sha").alias("__sha"))
    per_id = opened.groupBy("__sha", "__id").agg(F.count("*").alias("n"))
    keep = scratch.write(per_id.groupBy("__sha").agg(F.max(F.struct("__id", "n")).alias("k")).select(F.col("__sha").alias("__k"), F.col("k.__id").alias("__keep"), F.col("k.n").alias("__n")), rows=df.count())
    stays = opened.join(keep, (F.col("__sha") == F.col("__k")) & F.col("__id").eqNullSafe(F.col("__keep")))
    out = rows.filter("not open").select("__row")
    if keep.filter("__n > 1").isEmpty():
        return unpack(out.unionByName(stays.select("__row")))
    once = stays.filter("__n > 1").groupBy("__sha").agg(F.min_by("__row", F.to_json("__row")).alias("__row"))
    return unpack(out.unionByName(stays.filter("__n = 1").select("__row")).unionByName(once.select("__row")))
