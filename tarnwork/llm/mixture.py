"""Mixing sources to target weights as a time-varying curriculum. Native.

Sources share the words of all documents by weight; no target exceeds cap times its source, and what that leaves
over goes to the others by weight (one water level, found by a prefix sum over sources ordered by the level at
which each is full). A source's weight runs linearly over training time; its integral, scaled to the target, is
the source's cumulative demand. Documents of a source stand in a fixed pseudo-random order; their cumulative words
are inverted through that demand, which gives each a training position in [0, 1]; the output is range-sorted by it.

Cumulative words come from three levels, so that no task gets a whole source: sums of blocks of small buckets of a
source and their prefix, that of the buckets of a block, and a running sum in each bucket. Only the sources themselves
are ranked in one task, one row a source.

A document without words (null or blank text) has size 0 and nothing is taken of it. Null is a source of its own,
last. Rows with one id and text in several sources, or with an id that is null and one that is called null, stay
apart. Repeated rows count as often as they occur; which of several identical rows a boundary falls into makes no
difference to the result. A table without rows gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, text_or_empty, word_array

#: Rows of a source in one bucket, about.
BUCKET_ROWS = 500
#: Buckets of a block.
BLOCK_BUCKETS = 1000
CAP = 3
WEIGHTS = (1.0, 2.0, 3.0)
#: Start and end of a source's weight over training, as multiples of it, repeating by source.
RAMPS = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def _cycled(values: tuple[float, ...], rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (rank % len(values)).cast("int") + 1)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, n_docs, rank, target from rows (source, size). One row a source, null included."""
    by_name, by_level = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("level", "rank").rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    ranked = sums.withColumn("rank", F.row_number().over(by_name) - 1).withColumn("weight", _cycled(weights, F.col("rank")))
    filled = ranked.withColumn("level", cap * F.col("source_size") / F.col("weight")).withColumns(
        {
            "total": F.sum("source_size").over(all_rows).cast("double"),
            "full": F.coalesce(F.sum(cap * F.col("source_size")).over(by_level), F.lit(0)).cast("double"),
            "open": F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(by_level), F.lit(0.0)),
        }
    )
    # With the sources before this one full, the rest share what is left at this level; the first level that this one isn't full at holds.
    tried = filled.withColumn("tried", (F.col("total") - F.col("full")) / F.col("open"))
    held = tried.withColumn("held", F.min(F.when(F.col("tried") < F.col("level"), F.struct("level", "rank", "tried"))).over(all_rows).getField("tried"))
    target = F.least(cap * F.col("source_size").cast("double"), F.coalesce(F.col("held"), F.col("level")) * F.col("weight"))
    return held.select("source", "source_size", "n_docs", "rank", target.alias("target"))


def _key(doc_id: str, text: str, source: str, others: list[str]) -> Column:
    """What orders the rows of a source: only rows that are alike in all of these share it. Nulls differ from every text."""
    flagged = lambda c, mark: F.coalesce(F.concat(F.lit(mark), F.col(f"`{c}`").cast("string")), F.lit("null"))
    rest = [F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in others))).cast("binary"))] if others else []
    return F.md5(F.concat_ws(":", flagged(source, "s"), flagged(doc_id, "i"), F.md5(text_or_empty(f"`{text}`").cast("binary")), *rest).cast("binary"))


def _before(sums: DataFrame) -> DataFrame:
    """(rank, bucket, offset): words of a source before a bucket, from (rank, bucket, words). Through blocks of buckets, so that no task gets all buckets of a source."""
    sums = sums.withColumn("block", F.floor(F.col("bucket") / BLOCK_BUCKETS))
    earlier = lambda by, of: F.coalesce(F.sum("words").over(Window.partitionBy(*by).orderBy(of).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = sums.groupBy("rank", "block").agg(F.sum("words").alias("words")).select("rank", "block", earlier(["rank"], "block").alias("of_block"))
    inside = sums.select("rank", "block", "bucket", earlier(["rank", "block"], "bucket").alias("in_block"))
    return inside.join(blocks, ["rank", "block"]).select("rank", "bucket", (F.col("of_block") + F.col("in_block")).alias("offset"))


def placed(df: DataFrame, scratch: Scratch, key: Column, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per row of df: doc_id, source, size, order_key (key), source_size, target, rank, before (words of the source before it), taken."""
    size = F.size(word_array(text_or_empty(f"`{text}`"))).cast("long")
    sized = scratch.write(df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"), size.alias("size"), key.alias("order_key")))
    n = sized.count()
    targets = scratch.write(source_targets(sized, weights, cap), rows=1)
    hashed, buckets = F.conv(F.substring("order_key", 1, 8), 16, 10).cast("long"), F.ceil(F.col("n_docs") / BUCKET_ROWS).cast("long")
    t = targets.withColumnRenamed("source", "t_source")
    rows = sized.join(t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    rows = scratch.write(rows.withColumn("bucket", F.floor(hashed * buckets / F.lit(1 << 32)).cast("long")))
    offsets = scratch.write(_before(rows.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))), rows=n)
    scratch.keep(rows, offsets)
    within = Window.partitionBy("rank", "bucket").orderBy("order_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumn("before", F.sum("size").over(within) - F.col("size")).join(offsets, ["rank", "bucket"])
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")
    return (
        summed.withColumn("before", F.col("before") + F.col("offset")).withColumn("passes", passes)
        .withColumn("extra", F.least(F.greatest(rest - F.col("before"), F.lit(0)), F.col("size")))
        .withColumn("taken", F.col("passes") * F.col("size") + F.col("extra"))
        .drop("bucket", "offset", "n_docs")
    )


def position(words: Column, ramps: tuple[tuple[float, float], ...] = RAMPS) -> Column:
    """Training time in [0, 1] at which a source's cumulative demand reaches so many words: the integral of a linear weight, inverted."""
    a, b = _cycled(tuple(x for x, _ in ramps), F.col("rank")), _cycled(tuple(x for _, x in ramps), F.col("rank"))
    share = F.least(words / F.col("target"), F.lit(1.0))
    return F.when(F.col("target") > 0, share * (a + b) / (a + F.sqrt(a * a + share * (b * b - a * a))))


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per row of df with what the mix takes of it and its first training position (null if nothing is taken), in order of position."""
    rows = placed(df, Scratch(df.sparkSession), _key(doc_id, text, source, []), doc_id, text, source, weights, cap)
    first = F.when(F.col("taken") > 0, position(F.col("before")))
    return rows.select("doc_id", "size", "source_size", "target", "taken", first.alias("position")).repartitionByRange(F.col("position"), F.col("doc_id")).sortWithinPartitions("position", "doc_id")


def mixed_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The rows of df as the mix takes them: as many whole copies as passes (the last if at least half of it is taken), range-sorted by training position."""
    scratch = Scratch(df.sparkSession)
    key = _key(doc_id, text, source, [c for c in df.columns if c not in (doc_id, text, source)])
    rows = placed(df, scratch, key, doc_id, text, source, weights, cap)
    copies = F.col("passes") + F.when((F.col("extra") > 0) & (2 * F.col("extra") >= F.col("size")), 1).otherwise(0)
    copied = rows.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0)).filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1)))
    plan = scratch.write(copied.select("order_key", position(F.col("before") + F.col("copy") * F.col("source_size")).alias("position")))
    packed = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("__row"), key.alias("order_key"))
    if not rows.groupBy("order_key").count().filter("count > 1").isEmpty():  # rows that are alike in every column: one of them stands for all
        packed = packed.groupBy("order_key").agg(F.first("__row").alias("__row"))
    joined = packed.join(plan, "order_key").repartitionByRange(F.col("position"), F.col("order_key")).sortWithinPartitions("position", "order_key")
    return joined.select(*(F.col("__row").getField(c).alias(c) for c in df.columns))
