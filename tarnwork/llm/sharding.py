"""Sharding by a Feistel permutation of global row numbers, with cycle walking.

Rows are numbered without gaps in the order of (doc_id, checksum, hash of the text): a range sort, counts of its
partitions, and an offset for each. A keyed Feistel network permutes the smallest even-bit domain that holds the
numbers; a value outside the range is permuted again until it falls inside, which is a permutation of the range.
The permuted number p gives shard p mod n and slot p div n, so shard sizes differ by one at most, slots have no
gaps, and the place of any row can be computed, or inverted, without looking at others (law: rows).

Null text counts as empty (size 1). Identical rows get numbers of their own, in any order. An empty table gives an
empty result. The order in which rows arrive has no influence. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mix, text_or_empty

ROUNDS = 6
KEY = 0x5EED


class Permutation:
    """A keyed permutation of range(n)."""

    def __init__(self, n: int, key: int = KEY):
        self.n = n
        self.half = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = [mix(np.array([(key << 8) + r + 1], np.uint64))[0] for r in range(ROUNDS)]

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        return mix(x ^ key) & self.mask

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in reversed(self.keys) if back else self.keys:
            if back:
                left, right = right ^ self._round(left, k), left
            else:
                left, right = right, left ^ self._round(right, k)
        return left << self.half | right

    def __call__(self, numbers: np.ndarray, back: bool = False) -> np.ndarray:
        x = self._once(numbers.astype(np.uint64), back)
        while (out := x >= np.uint64(self.n)).any():
            x[out] = self._once(x[out], back)
        return x.astype(np.int64)


def shard(df: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text", key: int = KEY) -> DataFrame:
    """doc_id, size, text_crc32, row_number, shard, slot for each row."""
    scratch = Scratch(df.sparkSession)
    body = text_or_empty(text)
    rows = df.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(body).alias("hash"))
    order = ["doc_id", "text_crc32", "hash"]
    part = F.spark_partition_id().alias("part")
    sorted_rows = scratch.write(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("*", part, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at")).drop("hash"))
    counts = sorted(map(tuple, sorted_rows.groupBy("part").count().collect()))  # one row a partition
    offsets, n = {}, 0
    for p, c in counts:
        offsets[p], n = n, n + c
    fields = "doc_id {}, size long, text_crc32 long, row_number long, shard int, slot long".format(rows.schema["doc_id"].dataType.simpleString())

    def run(batches):
        permute = Permutation(n, key)
        for b in batches:
            if b.num_rows:
                first = np.array([offsets[p] for p in b.column("part").to_pylist()], np.int64)
                number = first + np.asarray(b.column("at"), dtype=np.int64)
                place = permute(number)
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(number), pa.array((place % shards).astype(np.int32)), pa.array(place // shards)], names=["doc_id", "size", "text_crc32", "row_number", "shard", "slot"])

    return sorted_rows.mapInArrow(run, fields)
