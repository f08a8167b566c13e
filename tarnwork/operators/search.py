"""Lookups that the stored indexes are for: cosine top-k over vectors, near duplicates by 63-bit simhash."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.ship import ship

#: First bit and width of bands that cover 63 bits.
BANDS = ((0, 11), (11, 11), (22, 11), (33, 10), (43, 10), (53, 10))
#: Bytes of query vectors that are sent to the executors at once.
BLOCK_BYTES = 16 << 20


def cosine_topk(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, vec_id, sim (9 decimals), rank: the k nearest other vectors by cosine (ties by id), exactly.

    A stated set of queries against all vectors: queries go to the executors in blocks of a checked size, vectors are
    multiplied with a block batch by batch, and a partition keeps k candidates a query, so little is shuffled.
    Null and zero vectors have no direction and are left out.
    """
    ship(vectors.sparkSession)
    usable = lambda df: df.filter(F.exists(F.col(vector), lambda x: x != 0)).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    asked, out = usable(queries), None
    n, size = asked.agg(F.count("*"), F.coalesce(F.sum(F.size("v") * 8 + 8), F.lit(0))).first()
    blocks = max(1, -(-size // BLOCK_BYTES))
    for b in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow()
        local = usable(vectors).mapInArrow(_nearest(np.asarray(block["vec_id"]), _rows(block["v"].combine_chunks()), k), "query_id long, vec_id long, sim double")
        out = local if out is None else out.unionByName(local)
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("sim"), "vec_id")))
    return ranked.filter(F.col("rank") <= k)


#: Vectors that cells are fitted on, and rows of a cell that one task gets.
ANN_SAMPLE, CELL_ROWS = 20_000, 50_000


def fit_cells(vectors: DataFrame, cells: int, id_col: str = "vec_id", vector: str = "embedding", sample: int = ANN_SAMPLE, rounds: int = 12) -> np.ndarray:
    """Centres of cells on the unit sphere, by k-means over at most sample vectors chosen by a hash of their id."""
    usable = vectors.filter(F.exists(F.col(vector), lambda x: x != 0)).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    got = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()
    x = _rows(got["v"].combine_chunks())
    centres = x[:cells].copy()
    for _ in range(rounds):
        near = np.argmax(x @ centres.T, axis=1)
        for c in range(len(centres)):
            if (near == c).any():
                mean = x[near == c].mean(0)
                centres[c] = mean / (np.linalg.norm(mean) or 1.0)
    return centres


def ann_topk(vectors: DataFrame, queries: DataFrame, k: int, centres: np.ndarray, probes: int, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, vec_id, sim, rank: the k nearest other vectors among those in the cells next to a query.

    Every vector is indexed: it goes to its nearest centre's cell. A cell over CELL_ROWS is dealt to several tasks, and
    its queries to each of them, so no task gets an unbounded cell and no row is left out. With probes = all cells the
    result is exact; recall at fewer probes is to be measured against cosine_topk.
    """
    ship(vectors.sparkSession)
    usable = lambda df: df.filter(F.exists(F.col(vector), lambda x: x != 0)).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))

    def cells(n: int):
        def run(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                near = np.argsort(-(_rows(b.column("v")) @ centres.T), axis=1, kind="stable")[:, :n]
                at = np.repeat(np.arange(b.num_rows), near.shape[1])
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), pa.array(near.reshape(-1).astype(np.int32))], names=["vec_id", "v", "cell"])

        return run

    placed = usable(vectors).mapInArrow(cells(1), "vec_id long, v array<double>, cell int")
    sizes = {r.cell: r["count"] for r in placed.groupBy("cell").count().collect()}  # one row a centre
    parts = F.element_at(F.array(*(F.lit(-(-sizes.get(c, 1) // CELL_ROWS)) for c in range(len(centres)))), F.col("cell") + 1)
    rows = placed.withColumn("part", F.pmod(F.xxhash64("vec_id"), parts).cast("int"))
    asked = usable(queries).mapInArrow(cells(min(probes, len(centres))), "vec_id long, v array<double>, cell int").withColumn("part", F.explode(F.sequence(F.lit(0), parts.cast("int") - 1)))

    def within(own: pa.Table, asked: pa.Table) -> pa.Table:
        if not own.num_rows or not asked.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "sim": pa.array([], pa.float64())})
        find = _nearest(np.asarray(asked["vec_id"]), _rows(asked["v"].combine_chunks()), k)
        return pa.Table.from_batches(list(find(own.select(["vec_id", "v"]).to_batches())))

    found = rows.groupBy("cell", "part").cogroup(asked.groupBy("cell", "part")).applyInArrow(within, "query_id long, vec_id long, sim double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("sim"), "vec_id")))
    return ranked.filter(F.col("rank") <= k)


def _rows(column) -> np.ndarray:
    """Unit vectors of a list column."""
    flat = np.asarray(column.flatten(), dtype=float).reshape(len(column), -1) if len(column) else np.zeros((0, 1))
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _nearest(ids: np.ndarray, queries: np.ndarray, k: int):
    def run(batches):
        best_id, best = np.zeros((len(ids), 0), np.int64), np.zeros((len(ids), 0))
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                own = np.asarray(some.column("vec_id"))
                if not len(ids) or not len(own):
                    continue
                sims = np.round(queries @ _rows(some.column("v")).T, 9)
                sims[ids[:, None] == own[None, :]] = -np.inf
                best = np.concatenate([best, sims], axis=1)
                best_id = np.concatenate([best_id, np.broadcast_to(own, sims.shape)], axis=1)
                order = np.lexsort((best_id, -best), axis=1)[:, :k]
                best, best_id = np.take_along_axis(best, order, 1), np.take_along_axis(best_id, order, 1)
        keep = np.isfinite(best)
        asked = np.broadcast_to(ids[:, None], best.shape)
        yield pa.RecordBatch.from_arrays([pa.array(asked[keep]), pa.array(best_id[keep]), pa.array(best[keep])], names=["query_id", "vec_id", "sim"])

    return run


def near_by_simhash(rows: DataFrame, most: int = 3, id_col: str = "doc_id", hash_col: str = "simhash") -> DataFrame:
    """a, b, distance of pairs of distinct hashes within so many bits, each hash named by its least id. Members keep their hash.

    Bits that differ lie in at most so many of the six bands, so the other bands agree: pairs meet in a join on each
    choice of that many bands (about 31 bits of 63 for three), which stays selective for billions of hashes. Equal
    hashes are one row before the join.
    """
    if not 0 <= most < len(BANDS):
        raise ValueError(f"bands answer up to {len(BANDS) - 1} bits")
    masks = [sum(((1 << n) - 1) << at for at, n in chosen) for chosen in combinations(BANDS, len(BANDS) - most)]
    distinct = rows.groupBy(hash_col).agg(F.min(id_col).alias("id")).withColumnRenamed(hash_col, "h").filter(F.col("h").isNotNull())
    keyed = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col("h").bitwiseAND(m).alias("v")) for k, m in enumerate(masks)))).alias("key")
    left = distinct.select("id", "h", keyed)
    right = left.select(F.col("id").alias("id2"), F.col("h").alias("h2"), F.col("key").alias("key2"))
    pairs = left.join(right, (F.col("key") == F.col("key2")) & (F.col("id") < F.col("id2")))
    apart = F.col("h").bitwiseXOR(F.col("h2"))
    # A pair that agrees in more bands than needed meets for several choices and counts for the first of them.
    first = F.array_min(F.array(*(F.when(apart.bitwiseAND(m) == 0, F.lit(k)) for k, m in enumerate(masks))))
    return pairs.filter((F.bit_count(apart) <= most) & (first == F.col("key.k"))).select(F.col("id").alias("a"), F.col("id2").alias("b"), F.bit_count(apart).cast("int").alias("distance"))
