"""Operator 10 at five-word shingles and a Jaccard similarity of SIMILARITY or more: every such pair is linked, and no other.

Fingerprints of five-word shingles go through the vantage-point trees of operator 10, and the links found are verified
by the exact similarity of the sets of shingles. A radius that held all pairs of similarity 0.8 (about 13 of 64 bits)
would overlap every shard, and the operator's own radius holds few of them; so the links are completed exactly.

A text's set holds the hashes of its shingles of SHINGLE words (ASCII white space, A-Z lower-cased); texts with fewer
words are one shingle, null and blank texts the empty set, and equal sets are one node. Candidates come from prefix
filtering: in any common order of all shingles, two sets of n and m shingles that are similar enough share one of the
first n - ceil(SIMILARITY n) + 1 of the one and of the other. The order is by hash, with the shingles of many sets
(at most COMMON of them, more only cost time) last, so that common passages make no candidates. Sets that share a
shingle there are compared by parity bitmaps, whose differing bits never outnumber the shingles that only one of two
sets has: this drops no pair that is similar enough. Bitmaps of fixed width come first; those of long sets fill up, so
candidates are compared again by bitmaps as wide as the sets, which are a small part of the sets' size. What is left is
compared by whole sets, in two turns: first the
links of the trees and those of a few neighbours under each shingle, then every candidate pair whose sets are still in
different components. So a large group of near copies costs rows in proportion to its size. Sets under one shingle are
dealt to blocks of at most about BLOCK_SETS, and pairs of blocks to different tasks, so that no task gets them all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import simhash
from .common import Scratch, Words, add_columns, mix, text_or_empty

SHINGLE = 5
#: Similarity as a ratio of whole numbers, so that sizes and overlaps are compared exactly.
OF, ALL = 4, 5
#: Shingles that go last, of those that more than OFTEN sets would be found by.
COMMON, OFTEN = 100_000, 20
#: 64-bit words of a bitmap; candidate rows of a part, about; sets of a block under one shingle, about; neighbours of the first turn.
BITS, PART_ROWS, BLOCK_SETS, NEIGHBOURS = 8, 20_000, 5_000, 4


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one text after the other, and where each text starts."""
    w = Words([t.lower() for t in texts])  # of bytes: A-Z only
    h, n = w.hashes(), len(w.starts)
    doc = np.repeat(np.arange(len(texts)), w.counts)
    left = np.minimum(w.first[1:][doc] - np.arange(n), shingle)  # words of the shingle that starts here
    value = np.zeros(n, np.uint64)
    for k in range(shingle - 1, -1, -1):
        at = np.flatnonzero(left > k)
        value[at] = mix(value[at] + h[at + k])
    # Shorter ones count only where the whole text is one.
    stays = (left == shingle) | (np.arange(n) == w.first[:-1][doc])
    value, doc = value[stays], doc[stays]
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return value[new], np.concatenate([[0], np.cumsum(np.bincount(doc[new], minlength=len(texts)))])


def prefixes(value: np.ndarray, first: np.ndarray, common: np.ndarray) -> list[np.ndarray]:
    """Of each set the shingles that it can be found by; common is sorted."""
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    late = common[np.minimum(np.searchsorted(common, value), len(common) - 1)] == value if len(common) else np.zeros(len(value), bool)
    order = np.lexsort((value, late, doc))
    take = np.arange(len(value)) - first[doc] < (n - (OF * n + ALL - 1) // ALL + 1)[doc]
    return np.split(value[order][take], np.cumsum(np.bincount(doc[take], minlength=len(n)))[:-1])


def set_names(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set, 0 of empty ones."""
    n = np.diff(first)
    name, full = np.zeros(len(n), np.uint64), np.flatnonzero(n)
    if len(full):
        name[full] = mix(np.add.reduceat(mix(value), first[:-1][full]) + n[full].astype(np.uint64))
    return name


def summaries(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(name, size, bitmap, wide bitmap) of each set; a wide one has a bit or more for each shingle."""
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    at = mix(value ^ np.uint64(1))
    widths = 64 * BITS << np.ceil(np.log2(np.maximum(1, n / (64 * BITS)))).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(widths)])
    wide = _parity(starts[doc] + (at & (widths[doc] - 1).astype(np.uint64)).astype(np.int64), starts[-1])
    narrow = _parity(doc * 64 * BITS + (at % np.uint64(64 * BITS)).astype(np.int64), len(n) * 64 * BITS)
    return set_names(value, first), n, narrow.reshape(len(n), 8 * BITS), [wide[a:b].tobytes() for a, b in zip(starts[:-1] // 8, starts[1:] // 8)]


def _parity(places: np.ndarray, width: int) -> np.ndarray:
    """Packed bits: whether a place occurs an odd number of times."""
    times = np.zeros(width, np.uint8)
    np.add.at(times, places, 1)  # wraps at 256, which keeps the parity
    return np.packbits(times & 1)


def may_be_similar(a: bytes, n: int, b: bytes, m: int) -> bool:
    """False only where the sizes n and m of two sets or their wide bitmaps rule the similarity out."""
    if ALL * min(n, m) < OF * max(n, m):
        return False
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) != len(y):  # a width is twice the next one, so halves fold into it
        if len(x) < len(y):
            x, y = y, x
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return (OF + ALL) * int(np.bitwise_count(x ^ y).sum(dtype=np.int64)) <= (ALL - OF) * (n + m)


def close(keys: np.ndarray, names: np.ndarray, sizes: np.ndarray, bits: np.ndarray, roots: np.ndarray | None, blocks: np.ndarray | None = None, across: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of names under one key whose sizes and bitmaps allow the similarity: those of different roots, and of different blocks where across says so; without roots only those of near neighbours."""
    within = np.zeros(len(keys), np.int64) if roots is None else roots
    order = np.lexsort((names, within, keys))
    keys, names, sizes, bits, within = keys[order], names[order], sizes[order], bits[order], within[order]
    end, at = np.searchsorted(keys, keys, "right"), np.arange(len(keys))
    if roots is None:
        end, partner = np.minimum(end, at + 1 + NEIGHBOURS), at + 1
    else:  # past the rows of one's own root
        new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (within[1:] != within[:-1])])) if len(keys) else at
        partner = np.repeat(np.append(new[1:], len(keys)), np.diff(np.append(new, len(keys))))
        blocks, across = blocks[order], across[order]
    found, step = [], 0
    while len(at := at[partner[at] + step < end[at]]):
        for k in range(0, len(at), 1 << 18):
            a = at[k : k + (1 << 18)]
            b = partner[a] + step
            fit = (ALL * np.minimum(sizes[a], sizes[b]) >= OF * np.maximum(sizes[a], sizes[b])) & (names[a] != names[b])
            if roots is not None:
                fit &= ~across[a] | (blocks[a] != blocks[b])
            a, b = a[fit], b[fit]
            fit = (OF + ALL) * np.bitwise_count(bits[a] ^ bits[b]).sum(1, dtype=np.int64) <= (ALL - OF) * (sizes[a] + sizes[b])
            a, b = names[a[fit]], names[b[fit]]
            if len(a):
                found.append(np.unique(np.column_stack([np.minimum(a, b), np.maximum(a, b)]), axis=0))
        step += 1
    pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
    return pairs[:, 0], pairs[:, 1]


def similar(a: bytes, b: bytes) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return ALL * both >= OF * (len(x) + len(y) - both)


def _tree_links(printed: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of sets whose fingerprints are equal or linked by vantage-point trees, as many as connect all of these."""
    first = scratch.write(printed.groupBy("print").agg(F.min("fp").alias("first")))
    edges = simhash.links(first.select(F.col("print").alias("fp")), scratch)
    of = lambda c: first.select(F.col("print").alias(c), F.col("first").alias(f"of_{c}"))
    linked = edges.join(of("a"), "a").join(of("b"), "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    equal = printed.select("print", "fp").distinct().join(first, "print").filter("fp <> first").select(F.col("first").alias("a"), F.col("fp").alias("b"))
    return scratch.write(linked.unionByName(equal))


def near_links(df: DataFrame, printed: DataFrame, scratch: Scratch, text: str) -> DataFrame:
    """Edges (a, b) that connect what pairs of similar sets connect. printed: text_hash, fp, n, bits and print of the rows of df, and wide."""
    texts = df.select(text_or_empty(f"`{text}`").alias("text"))
    fields = [T.StructField("fp", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType(), False))]

    def keys(common: np.ndarray) -> DataFrame:
        def make():
            def batch(t: list[bytes]) -> list:
                value, first = shingle_sets(t)
                return [set_names(value, first).view(np.int64), pa.array([k.view(np.int64) for k in prefixes(value, first, common)], pa.list_(pa.int64()))]

            return batch

        return add_columns(texts, fields, make).select("fp", F.explode("keys").alias("key"))

    often = keys(np.zeros(0, np.uint64)).groupBy("key").count().filter(F.col("count") > OFTEN).orderBy(F.desc("count"), "key").limit(COMMON)
    common = np.sort(np.array([r.key for r in often.collect()], np.int64).view(np.uint64))
    found = scratch.write(keys(common))
    shared = scratch.write(found.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low < high").select("key"))
    members = scratch.write(found.join(shared, "key").distinct())
    scratch.drop(found, shared)
    sets = scratch.write(printed.select("fp", "n", "bits").join(members.select("fp").distinct(), "fp", "left_semi").dropDuplicates(["fp"]))

    def blocked(of: DataFrame, rooted: bool) -> DataFrame:
        """of with block, the part that a row goes to, and whether only pairs of different blocks are asked for there."""
        large = scratch.write(of.groupBy("key").agg(F.ceil(F.count("*") / F.lit(BLOCK_SETS)).cast("int").alias("blocks")).filter("blocks > 1"))
        dealt = of.join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)) if rooted else F.col("block")
        both = dealt.withColumn("other", other).withColumn("across", F.col("block") != F.col("other"))
        return both.withColumn("key", F.when(F.col("blocks") > 1, F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))).otherwise(F.col("key"))).drop("blocks", "other")

    def pairs(of: DataFrame, rooted: bool) -> DataFrame:
        parts = max(256, of.count() // PART_ROWS)

        def within(table: pa.Table) -> pa.Table:
            bits = np.frombuffer(b"".join(table["bits"].to_pylist()), np.uint64).reshape(-1, BITS)
            own = [np.asarray(table[c]) for c in ("root", "block")] + [np.asarray(table["across"]).astype(bool)] if rooted else [None]
            a, b = close(*(np.asarray(table[c]) for c in ("key", "fp", "n")), bits, *own)
            return pa.table({"a": a, "b": b})

        # Bitmaps join last, so that only rows that are compared carry them.
        return blocked(of, rooted).join(sets, "fp").withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts))).groupBy("part").applyInArrow(within, "a long, b long").distinct()

    def checked(candidates: DataFrame) -> DataFrame:
        """Candidates whose whole sets are similar."""
        ends = lambda pairs: pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).distinct()
        given = scratch.write(candidates)
        mapped = scratch.write(printed.select("fp", "n", "wide").join(ends(given), "fp", "left_semi").dropDuplicates(["fp"]))
        of = lambda c: mapped.select(F.col("fp").alias(c), F.col("n").alias(f"n_{c}"), F.col("wide").alias(f"of_{c}"))

        def possible(batches):
            for x in batches:
                fit = [may_be_similar(*row) for row in zip(*(x.column(c).to_pylist() for c in ("of_a", "n_a", "of_b", "n_b")))]
                yield x.select(["a", "b"]).filter(pa.array(fit, pa.bool_()))

        candidates = scratch.write(given.join(of("a"), "a").join(of("b"), "b").select("a", "b", "n_a", "n_b", "of_a", "of_b").mapInArrow(possible, "a long, b long"))
        scratch.drop(given, mapped)
        one = scratch.write(printed.join(ends(candidates), "fp", "left_semi").groupBy("fp").agg(F.min("text_hash").alias("text_hash")))
        own = texts.withColumn("text_hash", F.xxhash64("text")).join(one, "text_hash").dropDuplicates(["fp"]).select("fp", "text")

        def whole():
            def batch(t: list[bytes]) -> list:
                value, first = shingle_sets(t)
                return [[value[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]]

            return batch

        shingles = scratch.write(add_columns(own, [T.StructField("shingles", T.BinaryType())], whole).select("fp", "shingles"))
        side = lambda c: shingles.select(F.col("fp").alias(c), F.col("shingles").alias(f"of_{c}"))

        def keep(batches):
            for x in batches:
                fit = [similar(a, b) for a, b in zip(x.column("of_a").to_pylist(), x.column("of_b").to_pylist())]
                yield x.select(["a", "b"]).filter(pa.array(fit, pa.bool_()))

        found = scratch.write(candidates.join(side("a"), "a").join(side("b"), "b").select("a", "b", "of_a", "of_b").mapInArrow(keep, "a long, b long"))
        scratch.drop(candidates, one, shingles)
        return found

    linked = checked(pairs(members, False).unionByName(_tree_links(printed, scratch)).distinct())
    roots = scratch.write(simhash.components(linked, scratch))
    rooted = scratch.write(members.join(roots, F.col("fp") == F.col("node"), "left").select("key", "fp", F.coalesce("root", "fp").alias("root")))
    scratch.drop(members)
    apart = scratch.write(rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("key"))
    return linked.unionByName(checked(pairs(scratch.write(rooted.join(apart, "key", "left_semi")), True)))


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df without all but one of each component of similar texts, as simhash.keep_one chooses it."""
    scratch = Scratch(df.sparkSession)
    slim = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(text_or_empty(f"`{text}`")).alias("text_hash"), F.col(f"`{text}`").alias("text"))
    fields = [T.StructField("fp", T.LongType()), T.StructField("n", T.LongType()), T.StructField("bits", T.BinaryType()), T.StructField("wide", T.BinaryType()), T.StructField("print", T.LongType())]

    def make():
        def batch(t: list[bytes]) -> list:
            name, n, bits, wide = summaries(*shingle_sets(t))
            return [name.view(np.int64), n, [x.tobytes() for x in bits], wide, simhash.fingerprints(t, SHINGLE).view(np.int64)]

        return batch

    printed = scratch.write(add_columns(slim, fields, make).drop("text"))
    edges = scratch.write(near_links(df, printed, scratch, text))
    scratch.keep(printed, edges)
    return simhash.keep_first(df, simhash.named(printed, edges, scratch), doc_id, text)
