"""SimHash near-duplicates: fingerprints that differ in few bits, found exactly with vantage-point trees.

Fingerprints are 64 majority bits over XXH64 (seed 42) of word shingles. Equal fingerprints are first reduced to one
row. A vantage-point tree over a bounded sample (SAMPLE rows) cuts the Hamming space into shards; a fingerprint is
at home in one shard, and is also sent as a query to each shard that its ball of the link radius overlaps, by the
triangle inequality. Shards that are home to more than SHARD_ROWS are cut again, in rounds, by trees of their own, until
none is; the queries of a shard are dealt to pieces of about QUERY_ROWS, each of which meets all of the shard's home
fingerprints. So no task gets more than a fixed number of rows, however many there are. In a piece, a vantage-point
tree over the home fingerprints answers all queries exactly: a branch is skipped when the distance to its vantage
point and the radius rule it out. No candidate is capped. A piece returns a spanning forest of the links that it found,
never all pairs. Components come from alternating large-star and small-star steps over those edges, each written to
the shared folder.

Words are split at ASCII white space after lower-casing A-Z; texts with fewer words than a shingle are one shingle;
null and blank texts have fingerprint zero and link like any other. Repeated rows give repeated rows in one
component. A component is named by its smallest doc_id; null doc_ids are ignored for that. An empty table gives an
empty result. Only the named columns are read by near_duplicates; the others can have any name.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, add_columns, mix, text_or_empty

SEED = 42
RADIUS = 3
#: Fingerprints that the top tree is built from.
SAMPLE = 4096
#: Levels of the top tree, and of the trees that cut a shard again.
TOP_LEVELS, MORE_LEVELS = 5, 3
#: Home fingerprints of a shard at most; queries of a piece, about; sampled rows that a shard is cut by, about.
SHARD_ROWS, QUERY_ROWS, SHARD_SAMPLE = 50_000, 200_000, 256
LEAF = 64
#: Bytes of a text that are cut into words at a time; shingles that are counted together.
BLOCK_BYTES, BLOCK_ROWS = 1 << 19, 1 << 16
_BLANK = re.compile(rb"[ \t-\r]")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _shingles(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles, a block of the text at a time."""
    digest, text, at, words, short = xxhash.xxh64_intdigest, text.translate(_LOWER), 0, [], True
    while at < len(text):
        cut = _BLANK.search(text, at + BLOCK_BYTES) if len(text) - at > BLOCK_BYTES else None
        end = cut.start() if cut else len(text)
        words += text[at:end].split()
        at = end
        if len(words) >= shingle:
            short = False
            yield np.array([digest(b" ".join(s), SEED) for s in zip(*(words[k:] for k in range(shingle)))], np.uint64)
            words = words[len(words) - shingle + 1 :]
    if short and words:
        yield np.array([digest(b" ".join(words), SEED)], np.uint64)


def _bits(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(texts: list[bytes], shingle: int = 3) -> np.ndarray:
    """A 64-bit fingerprint for each text."""
    votes, counts, waiting, rows = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64), [], 0

    def count() -> None:
        some, parts = np.array([k for k, _ in waiting]), [h for _, h in waiting]
        sizes = np.array([len(h) for h in parts])
        np.add.at(votes, some, np.add.reduceat(_bits(np.concatenate(parts)), np.cumsum(sizes) - sizes, axis=0, dtype=np.int32))
        np.add.at(counts, some, sizes)
        waiting.clear()

    for k, t in enumerate(texts):
        for h in _shingles(t, shingle):
            waiting.append((k, h))
            rows += len(h)
            if rows >= BLOCK_ROWS:  # some at a time, so that the bits stay in the cache
                count()
                rows = 0
    if waiting:
        count()
    return np.packbits(2 * votes > counts[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0] if len(texts) else np.zeros(0, np.uint64)


def with_fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint_bits", shingle: int = 3) -> DataFrame:
    """df with the fingerprint as a signed 64-bit number."""
    return add_columns(df, [T.StructField(name, T.LongType())], lambda: lambda texts: [fingerprints(texts, shingle).view(np.int64)], text)


def distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class TopTree:
    """Vantage points and radii of a complete binary tree in heap order; its leaves are the shards."""

    def __init__(self, points: np.ndarray, radii: np.ndarray):
        self.points, self.radii, self.leaves = points, radii, len(points)

    @classmethod
    def over(cls, sample: np.ndarray, depth: int) -> TopTree:
        """Cuts of a sample in half, about; both sides of each get a point of it while it has two."""
        points, radii, groups = np.zeros(1 << depth, np.uint64), np.full(1 << depth, 31, np.int16), {1: sample}
        for node in range(1, 1 << depth):
            own, inside = groups.pop(node), np.zeros(0, bool)
            if len(own):
                # A point far from the middle of its group cuts it into the most even shells; any point is right.
                tries = own[np.linspace(0, len(own) - 1, min(8, len(own))).astype(int)]
                v = tries[int(np.argmax([distance(own, v).std() for v in tries]))]
                d = distance(own, v).astype(np.int16)
                points[node], radii[node] = v, max(0, min(int(np.median(d)), int(d.max()) - 1))
                inside = d <= radii[node]
            groups[2 * node], groups[2 * node + 1] = own[inside], own[~inside]
        return cls(points, radii)

    def deal(self, x: np.ndarray, radius: int, home: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """(rows of x, shard, whether the shard is their home) for all shards that the rows' balls overlap. home: rows that are at home in this tree at all."""
        todo = [(1, np.arange(len(x)), np.ones(len(x), bool) if home is None else home)]
        while todo:
            node, rows, home = todo.pop()
            if node >= self.leaves:
                yield rows, node - self.leaves, home
                continue
            d, r = distance(x[rows], self.points[node]).astype(np.int16), self.radii[node]
            for child, hit, own in ((2 * node, d <= r + radius, d <= r), (2 * node + 1, d > r - radius, d > r)):
                if hit.any():
                    todo.append((child, rows[hit], (home & own)[hit]))


class Forest:
    """Union-find over sorted values; a root is the least of its tree."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        r = self.parent[x]
        while True:
            up = self.parent[r]
            if np.array_equal(up, r):
                self.parent[x] = r
                return r
            r = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            if not apart.any():
                return
            low, high = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
            a, b = low, high
            # Each root takes the least of its partners; the others are linked in the next turn.
            np.minimum.at(self.parent, high, low)


def search(home: np.ndarray, queries: np.ndarray, radius: int, found) -> None:
    """Call found(home rows, query rows) with every pair within radius, through a vantage-point tree over home."""
    todo = [(np.arange(len(home)), np.arange(len(queries)))]
    turn = 0
    while todo:
        h, q = todo.pop()
        if not len(h) or not len(q):
            continue
        split = None
        if len(h) > LEAF:
            for _ in range(4):
                turn += 1
                v = home[h[(turn * 7919) % len(h)]]
                d = distance(home[h], v).astype(np.int16)
                r = int(np.median(d))
                if r >= d.max():
                    r = int(d.max()) - 1
                if (d <= r).any():
                    split = d <= r
                    break
        if split is None:
            step = max(1, (1 << 20) // len(h))
            for k in range(0, len(q), step):
                a, b = np.nonzero(distance(home[h][:, None], queries[q[k : k + step]][None, :]) <= radius)
                if len(a):
                    found(h[a], q[k + b])
            continue
        dq = distance(queries[q], v).astype(np.int16)
        todo.append((h[split], q[dq <= r + radius]))
        todo.append((h[~split], q[dq > r - radius]))


def shard_links(home: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (least of the tree, value) of a spanning forest of the links between home fingerprints and queries."""
    values = np.unique(np.concatenate([home, queries]))
    at, to, forest = np.searchsorted(values, home), np.searchsorted(values, queries), Forest(len(values))
    search(home, queries, radius, lambda a, b: forest.link(at[a], to[b]))
    roots = forest.roots(np.arange(len(values)))
    other = roots != np.arange(len(values))
    return values[roots[other]], values[other]


_DEALT = "shard long, fp long, home boolean"


def _dealt(x: np.ndarray, tree: TopTree, radius: int, home: np.ndarray | None, parent: int) -> Iterator[pa.RecordBatch]:
    for rows, leaf, own in tree.deal(x, radius, home):
        # A shard's name is a hash of its parent's and its number; shards that share one by chance are only searched together.
        shard = mix(np.array([(parent * tree.leaves + leaf) % (1 << 64)], np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(shard, len(rows))), pa.array(x[rows].view(np.int64)), pa.array(own)], names=["shard", "fp", "home"])


def _cut(rows: DataFrame, over: DataFrame, radius: int, scratch: Scratch) -> DataFrame:
    """rows of the shards in over (shard, n), each cut by a tree of its own."""
    sampled = rows.filter("home").join(over, "shard").filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 31)) < F.lit(float(SHARD_SAMPLE << 31)) / F.col("n"))

    def build(table: pa.Table) -> pa.Table:
        tree = TopTree.over(np.sort(np.asarray(table["fp"]).view(np.uint64)), MORE_LEVELS)
        return pa.table({"shard": table["shard"][:1], "points": [tree.points.view(np.int64)], "radii": [tree.radii]}, schema=pa.schema([("shard", pa.int64()), ("points", pa.list_(pa.int64())), ("radii", pa.list_(pa.int16()))]))

    trees = scratch.write(sampled.select("shard", "fp").groupBy("shard").applyInArrow(build, "shard long, points array<long>, radii array<short>"))

    def deal(batches):
        for b in batches:
            shard, x, home = np.asarray(b.column(0)), np.asarray(b.column(1)).view(np.uint64), np.asarray(b.column(2).to_numpy(zero_copy_only=False), dtype=bool)
            for s, first in zip(*np.unique(shard, return_index=True)):
                tree = TopTree(np.array(b.column(3)[first].as_py(), np.int64).view(np.uint64), np.array(b.column(4)[first].as_py(), np.int16))
                own = shard == s
                yield from _dealt(x[own], tree, radius, home[own], int(s))

    return scratch.write(rows.join(trees, "shard").select("shard", "fp", "home", "points", "radii").mapInArrow(deal, _DEALT))


def bounded_shards(distinct: DataFrame, radius: int, scratch: Scratch) -> DataFrame:
    """(shard, piece, fp, home, asks): each fingerprint at home in one shard, in all its pieces, and asking once in each shard that its ball overlaps."""
    sample = np.array([r.fp for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], np.int64).view(np.uint64)
    tree, done = TopTree.over(sample, TOP_LEVELS), []

    def deal(batches):
        for b in batches:
            yield from _dealt(np.asarray(b.column("fp")).view(np.uint64), tree, radius, None, 0)

    rows = scratch.write(distinct.select("fp").mapInArrow(deal, _DEALT))
    while True:
        over = scratch.write(rows.filter("home").groupBy("shard").agg(F.count("*").alias("n")).filter(F.col("n") > SHARD_ROWS), rows=1)
        if over.isEmpty():
            done.append(rows)
            break
        done.append(scratch.write(rows.join(over, "shard", "left_anti")))
        cut = _cut(rows.join(over, "shard", "left_semi"), over, radius, scratch)
        scratch.drop(rows)
        rows = cut
    whole = done[0]
    for x in done[1:]:
        whole = whole.unionByName(x)
    sizes = scratch.write(whole.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(QUERY_ROWS)).cast("int").alias("pieces"), F.max("home").alias("lived")).filter("lived").drop("lived"), rows=1)
    own = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    with_own = whole.join(sizes, "shard").withColumn("own", own)
    pieces = F.explode(F.when(F.col("home"), F.sequence(F.lit(0), F.col("pieces") - 1)).otherwise(F.array("own"))).alias("piece")
    return with_own.select("shard", pieces, "fp", "home", "own").select("shard", "piece", "fp", "home", (F.col("piece") == F.col("own")).alias("asks"))


def links(distinct: DataFrame, scratch: Scratch, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that connect what links within radius connect, from distinct fingerprints (fp long)."""

    def within(table: pa.Table) -> pa.Table:
        fp, home, asks = np.asarray(table["fp"]).view(np.uint64), np.asarray(table["home"]), np.asarray(table["asks"])
        a, b = shard_links(fp[home.astype(bool)], fp[asks.astype(bool)], radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return bounded_shards(distinct, radius, scratch).groupBy("shard", "piece").applyInArrow(within, "a long, b long")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the least node reachable. Alternating large and small stars."""
    given = edges = scratch.write(edges)
    n = edges.count()
    both = lambda e: e.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(e.select(F.col("b").alias("x"), F.col("a").alias("y")))
    edges, before = scratch.write(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), rows=n), None
    scratch.drop(given)
    while True:
        sides = both(edges)
        least = scratch.write(sides.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("k"), F.least("x", "m").alias("m")), rows=n)
        large = scratch.write(sides.filter("y > x").join(least, F.col("x") == F.col("k")).select(F.col("m").alias("a"), F.col("y").alias("b")).distinct(), rows=n)
        # Small stars: of each node's lesser neighbours, all point to the least, and so does the node.
        lower = scratch.write(large.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("k"), "m"), rows=n)
        small = large.join(lower, F.col("b") == F.col("k"))
        was, edges = edges, scratch.write(small.select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).filter("a < b").distinct(), rows=n)
        scratch.drop(was, least, large, lower)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = RADIUS) -> DataFrame:
    """One row per row of df: doc_id, text_hash, fp (signed fingerprint), root (least fingerprint of the component), component_id, and component_rows, the rows of the component."""
    scratch = Scratch(df.sparkSession)
    slim = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(text_or_empty(f"`{text}`")).alias("text_hash"), F.col(f"`{text}`").alias("text"))
    printed = scratch.write(with_fingerprint(slim, "text", "fp", shingle).drop("text"))
    return named(printed, lambda distinct: links(distinct, scratch, radius), scratch)


def named(printed: DataFrame, edges: DataFrame | Callable[[DataFrame], DataFrame], scratch: Scratch) -> DataFrame:
    """printed (a scratch table with doc_id, text_hash, fp) with root, component_id and component_rows by edges (a, b) of fp, or what makes them of distinct fp."""
    distinct = scratch.write(printed.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), rows=printed.count())
    n = distinct.count()
    roots = scratch.write(components(edges(distinct) if callable(edges) else edges, scratch), rows=n)
    rooted = scratch.write(distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "least", "n"), rows=n)
    groups = scratch.write(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("component_rows")), rows=n)
    by_print = scratch.write(rooted.select("fp", "root").join(groups, "root"), rows=n)
    scratch.keep(printed, by_print)
    return printed.select("doc_id", "text_hash", "fp").join(by_print, "fp")


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = RADIUS) -> DataFrame:
    """The rows of df without all but one of each component: the row with the smallest doc_id stays (null is last; of several, the least text hash)."""
    return keep_first(df, near_duplicates(df, doc_id, text, shingle, radius), doc_id, text)


def keep_first(df: DataFrame, groups: DataFrame, doc_id: str, text: str) -> DataFrame:
    """keep_one for given groups: doc_id, text_hash and root of each row of df."""
    scratch = Scratch(df.sparkSession)
    groups = scratch.write(groups)
    rows = groups.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "n")).alias("s")
    stays = scratch.write(rows.groupBy("root").agg(first).select(F.col("s.doc_id").alias("__keep"), F.col("s.text_hash").alias("__hash"), F.col("s.n").alias("__n")), rows=groups.count())
    packed = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("__row"), F.col(f"`{doc_id}`").alias("__id"), F.xxhash64(text_or_empty(f"`{text}`")).alias("__text"))
    kept = packed.join(stays, F.col("__id").eqNullSafe(F.col("__keep")) & (F.col("__text") == F.col("__hash")))
    unpack = lambda x: x.select(*(F.col("__row").getField(c).alias(c) for c in df.columns))
    if stays.filter("__n > 1").isEmpty():
        return unpack(kept)
    once = kept.filter("__n > 1").groupBy("__id", "__text").agg(F.min_by("__row", F.to_json("__row")).alias("__row"))
    return unpack(kept.filter("__n = 1").select("__row").unionByName(once.select("__row")))
