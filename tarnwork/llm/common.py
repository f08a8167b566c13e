"""Shared pieces of the training-data operators: scratch tables, Arrow batching, words as arrays.

A word is a run of bytes other than space and 0x09-0x0D, which is the same in UTF-8 as in code points.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.ship import shared_folder, ship

#: Text that one call of a batch function sees, in bytes; a longer document comes alone.
BATCH_BYTES = 2 << 20
#: Small rows in one file of a scratch table.
ROWS_A_FILE = 100_000
#: ASCII white space, the only separators of words.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z only; lower() would also change other letters."""
    return F.translate(text, UPPER, LOWER)


def word_array(text: Column) -> Column:
    """The words of a text, in order, natively."""
    return F.array_remove(F.split(F.translate(text, SPACES[1:], " " * 5), " "), "")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels no model may see."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Scratch:
    """Tables written once into the shared folder: they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession):
        ship(spark)
        self.spark, self.top = spark, f"{shared_folder(spark)}/tarnwork-{uuid.uuid4().hex}"
        self.n, self.tables = 0, []

    def write(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        """rows: at most so many are to come, all small; then no more files than they need are written."""
        path = f"{self.top}/{self.n}"
        self.n += 1
        if rows is not None:
            df = df.coalesce(max(12, rows // ROWS_A_FILE))
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((table, path))
        return table

    def drop(self, *used: DataFrame) -> None:
        """Remove tables that nothing reads any more."""
        for table, path in self.tables:
            if any(table is x for x in used):
                p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        self.tables = [(t, p) for t, p in self.tables if not any(t is x for x in used)]

    def keep(self, *needed: DataFrame) -> None:
        """Remove all tables but those that are still to be read."""
        self.drop(*(t for t, _ in self.tables if not any(t is x for x in needed)))


def unused(columns: list[str], name: str) -> str:
    """A column name that none of columns has, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def pieces(batches: Iterator[pa.RecordBatch], text: int, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds a bounded number of text bytes."""
    for b in batches:
        if not b.num_rows:
            continue
        sizes = np.asarray(pc.binary_length(b.column(text)).fill_null(0), dtype=np.int64)
        cum, at = np.concatenate([[0], np.cumsum(sizes)]), 0
        while at < b.num_rows:
            end = max(at + 1, int(np.searchsorted(cum, cum[at] + most, "right")) - 1)
            yield b.slice(at, end - at)
            at = end


def texts_of(batch: pa.RecordBatch, text: int) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [x or b"" for x in batch.column(text).cast(pa.binary()).to_pylist()]


def add_columns(df: DataFrame, fields: list[T.StructField], make: Callable[[], Callable[[list[bytes]], list]], text: str = "text", most: int = BATCH_BYTES) -> DataFrame:
    """df with columns that make()(texts) gives for each bounded batch of whole texts.

    A column of df that has the name of a new one is replaced.
    """
    ship(df.sparkSession)
    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    names = [f.name for f in kept] + ([] if text in [f.name for f in kept] else [text])
    at, n_kept = names.index(text), len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        fn = make()
        types = [to_arrow_type(f.dataType) for f in fields]
        for b in pieces(batches, at, most):
            got = [pa.array(x, type=t) if not isinstance(x, pa.Array) else x.cast(t) for x, t in zip(fn(texts_of(b, at)), types, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:n_kept], *got], names=[*names[:n_kept], *(f.name for f in fields)])

    return df.select(*(F.col(f"`{n}`") for n in names)).mapInArrow(run, T.StructType([*kept, *fields]))


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Zero to eight low bytes of a 64-bit number.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_ROUND = np.uint64(0xD6E8FEB86659FD93)
#: Words that are hashed at a time; bytes beyond which a word goes to a library's hash.
BLOCK_WORDS, LONG_WORD = 1 << 19, 256


class Words:
    """The words of some documents: byte ranges in one buffer, and for each document its range of words."""

    def __init__(self, texts: list[bytes]):
        self.buffer = b"\n".join([*texts, b"\n" * 8])
        self.offsets = np.concatenate([[0], np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))])
        self.bytes = np.frombuffer(self.buffer, np.uint8, int(self.offsets[-1]))
        blank = _IS_SPACE[self.bytes]
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if len(blank) and not blank[0]:
            edge = np.concatenate([[0], edge])
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes: their number, then eight bytes after the other, mixed in one by one, so that no words but by chance share one."""
        data = np.ndarray((len(self.buffer) - 7,), "<u8", self.buffer, strides=(1,))
        out = np.empty(len(self.starts), np.uint64)
        for k in range(0, len(out), BLOCK_WORDS):
            at, size = self.starts[k : k + BLOCK_WORDS], self.ends[k : k + BLOCK_WORDS] - self.starts[k : k + BLOCK_WORDS]
            h = mix(mix(size.astype(np.uint64) + np.uint64(seed << 48)) ^ (data[at] & _LOW[np.minimum(size, 8)]))
            rows, done = np.flatnonzero((size > 8) & (size <= LONG_WORD)), 8
            while len(rows):
                h[rows] = mix(h[rows] * _ROUND + (data[at[rows] + done] & _LOW[np.minimum(size[rows] - done, 8)]))
                done += 8
                rows = rows[size[rows] > done]
            for i in np.flatnonzero(size > LONG_WORD).tolist():
                h[i] = xxhash.xxh64_intdigest(memoryview(self.buffer)[at[i] : at[i] + size[i]], seed)
            out[k : k + BLOCK_WORDS] = h
        return out


def per_document(values: np.ndarray, first: np.ndarray, how: np.ufunc, empty: float) -> np.ndarray:
    """how over each document's range of values; empty where it has none."""
    counts = np.diff(first)
    out = np.full(len(counts), empty, np.float64)
    full = counts > 0
    if full.any():
        out[full] = how.reduceat(values, first[:-1][full])
    return out
