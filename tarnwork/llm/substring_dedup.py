"""Substring deduplication by level-wise doubling of window lengths.

Every word of a window (35 words) whose sequence also starts somewhere else is removed. Levels are runs of 16, 32
and then 35 words; hashes of one level are put together to those of the next, and only windows that are repeated at
one length are looked at in the next, until the full length decides.

At a level of length L, a window stands on its anchor, the leftmost least hash of the runs of L words inside it. Equal
windows have equal anchors, so a window whose anchor hash occurs at one place only is no candidate any more; and
few runs are anchors (about one in eleven words at 16), so little is counted. Where no hash occurs twice, nothing is
left and the levels end. Hashes that occur twice or more are told to the next level as a bitmap, which is broadcast
while 16 bits a hash fit into 2**MAX_BITS (32 MB); bits that hashes share only let a window through to be judged by the
next level. Beyond that, places of anchors are joined with the hashes, and what stays is joined to the texts. The last
level counts whole windows by 64 and 32 bits of two hashes of the words under different seeds; windows seen once are
looked up by the same 96 bits. Texts are scanned in blocks of words, so a long one takes no more memory than its words.

Null and blank texts have no words. Texts with fewer words than a window keep all. Repeated rows repeat all their
windows. Long texts are windowed whole; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ship import ship
from .common import Scratch, Words, mix, pieces, text_or_empty, texts_of

WINDOW = 35
MIN_BITS, MAX_BITS = 16, 28
#: Words of a batch that are looked at together.
BLOCK = 1 << 19
_BLANKS = bytes(32 if k in b"\t\n\x0b\x0c\r" else k for k in range(256))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def levels(window: int) -> list[int]:
    """Run lengths: powers of two from half the largest that fits up to it, then the window."""
    top = 1 << (window.bit_length() - 1)
    return sorted({max(1, top // 2), top, window})


def _doubled(h: np.ndarray, apart: int, valid: int) -> np.ndarray:
    """Hash of the run at i and the run at i + apart, as one; the tail, where there is no second run, is left out."""
    return mix(h[:valid] * _STEP + h[apart : apart + valid])


def runs(h: np.ndarray, window: int) -> dict[int, np.ndarray]:
    """Hashes of runs for each level, from those of words; a run may cross documents, callers leave such windows out."""
    out, length = {1: h}, 1
    top = 1 << (window.bit_length() - 1)
    while length < top:
        n = max(0, len(h) - 2 * length + 1)
        out[2 * length] = _doubled(out[length], length, n)
        length *= 2
    if window > top:
        out[window] = _doubled(out[top], window - top, max(0, len(h) - window + 1))
    return {k: out[k] for k in levels(window)}


def anchors(h: np.ndarray, width: int, n: int) -> np.ndarray:
    """For windows 0..n-1, the leftmost place of the least of h[i : i + width]. Never decreases."""
    at, span = np.arange(len(h)), 1
    value = h
    while span < width:
        step = min(span, width - span)
        m = len(value) - step
        right = value[step:] < value[:m]
        value, at = np.where(right, value[step:], value[:m]), np.where(right, at[step:], at[:m])
        span += step
    return at[:n]


class Bitmap:
    """Membership of hashes in a set, with false positives."""

    def __init__(self, bits: np.ndarray, size: int):
        self.bits, self.mask = bits, np.uint64((1 << size) - 1)

    def hit(self, h: np.ndarray) -> np.ndarray:
        k = h & self.mask
        return ((self.bits[(k >> np.uint64(3)).astype(np.int64)] >> (k & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def bitmap(values: DataFrame, n: int):
    """(broadcast bytes, size) of a bitmap over the long column value, 16 bits a value; None if it would be too large to broadcast."""
    size = max(MIN_BITS, (16 * max(n, 1) - 1).bit_length())
    if size > MAX_BITS:
        return None
    bit = F.col("value").bitwiseAND((1 << size) - 1) + 1
    rows = values.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()  # 4 KB each
    buffer = bytearray(1 << (size - 3))
    for part, bits in rows:
        at = (part - 1) * 4096
        buffer[at : at + 4096] = bits[: len(buffer) - at]
    return values.sparkSession.sparkContext.broadcast(bytes(buffer)), size


def _loaded(m) -> Bitmap | None:
    return m and Bitmap(np.frombuffer(m[0].value, np.uint8), m[1])


class Scan:
    """Windows of a batch of texts that are still candidates after some levels, each by its bitmap or, where that is None, by the places of its anchors that a column lists."""

    def __init__(self, window: int, maps: list):
        self.window, self.levels = window, levels(window)
        self.maps = [_loaded(m) for m in maps]

    def blocks(self, w: Words, listed: list):
        """(start of the block in the batch's words, run hashes from there, candidate windows from there). listed: for each level without a bitmap, each document's places."""
        h, n, listed = w.hashes(), len(w.starts), iter(listed)
        places = [None if m else np.sort(np.concatenate([np.zeros(0, np.int64), *(np.array(p or (), np.int64) + a for p, a in zip(next(listed), w.first))])) for m in self.maps]
        for base in range(0, n, BLOCK):
            own = np.arange(base, min(n, base + BLOCK))
            alive = np.flatnonzero(w.first[np.searchsorted(w.first, own, "right")] - own >= self.window)
            if not len(alive):
                continue
            r = runs(h[base : base + BLOCK + self.window - 1], self.window)
            for length, m, p in zip(self.levels, self.maps, places):
                at = self.anchor(r, length, alive)
                if m:
                    alive = alive[m.hit(r[length][at])]
                elif len(p):
                    alive = alive[p[np.minimum(np.searchsorted(p, at + base), len(p) - 1)] == at + base]
                else:
                    alive = alive[:0]
            if len(alive):
                yield base, r, alive

    def anchor(self, h: dict, length: int, windows: np.ndarray) -> np.ndarray:
        if not len(windows):
            return windows
        return anchors(h[length], self.window - length + 1, int(windows[-1]) + 1)[windows]

    def anchored(self, w: Words, listed: list, level: int):
        """(hash, place in the batch's words) of the anchors of candidate windows, each once."""
        last = -1
        for base, r, alive in self.blocks(w, listed):
            at = self.anchor(r, level, alive)
            at = at[np.flatnonzero(np.diff(at, prepend=last - base))]
            if len(at):
                last = int(at[-1]) + base
                yield r[level][at], at + base

    def whole(self, w: Words, listed: list):
        """(hash, second hash, place in the batch's words) of the candidate windows."""
        other = None
        for base, r, alive in self.blocks(w, listed):
            other = w.hashes(1) if other is None else other
            second = runs(other[base : base + BLOCK + self.window - 1], self.window)[self.window][alive]
            yield r[self.window][alive], (second >> np.uint64(32)).astype(np.uint32).view(np.int32), alive + base


def _joined(parts: list) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*parts)]


class Candidates:
    """The documents and what is known of their windows: a bitmap for each level, or None where a column lists places."""

    def __init__(self, df: DataFrame, window: int, scratch: Scratch):
        keyed = df.select(F.col("doc_id"), F.xxhash64("doc_id", "text").alias("row_hash"), "text")
        self.df, self.window, self.scratch, self.maps, self.id_type = keyed, window, scratch, [], keyed.schema["doc_id"].dataType.simpleString()

    def columns(self) -> list[str]:
        return [f"places_{k}" for k, m in enumerate(self.maps) if m is None]

    def scanned(self, columns: list[str], fields: str, make) -> DataFrame:
        """What make(scan, words, listed places, batch) yields for bounded batches of whole texts; columns come before the text."""
        maps, window, names, at = list(self.maps), self.window, self.columns(), len(columns)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scan = Scan(window, maps)
            for b in pieces(batches, at):
                yield from make(scan, Words(texts_of(b, at)), [b.column(at + 1 + k).to_pylist() for k in range(len(names))], b)

        return self.df.select(*columns, "text", *names).mapInArrow(run, fields)

    def refine(self) -> bool:
        """One level more; False if no window is left."""
        level = levels(self.window)[len(self.maps)]

        def count(scan, w, listed, _):
            for h, _ in scan.anchored(w, listed, level):
                value, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n.astype(np.int32))], names=["value", "n"])

        found = self.scratch.write(self.scanned([], "value long, n int", count).groupBy("value").agg(F.sum("n").alias("n")).filter("n > 1").select("value"))
        n = found.count()
        if not n:
            return False
        m = bitmap(found, n)
        if m is None:

            def locate(scan, w, listed, b):
                for h, at in scan.anchored(w, listed, level):
                    doc = np.searchsorted(w.first, at, "right") - 1
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), b.column(1).take(pa.array(doc)), pa.array((at - w.first[doc]).astype(np.int32)), pa.array(h.view(np.int64))], names=["doc_id", "row_hash", "place", "value"])

            placed = self.scratch.write(self.scanned(["doc_id", "row_hash"], f"doc_id {self.id_type}, row_hash long, place int, value long", locate))
            listed = self.scratch.write(placed.join(found, "value", "left_semi").groupBy("doc_id", "row_hash").agg(F.collect_set("place").alias("places")))
            self.df = self.scratch.write(self.attached(listed, f"places_{len(self.maps)}"))
        self.maps.append(m)
        return True

    def attached(self, listed: DataFrame, name: str) -> DataFrame:
        """df with the places of (doc_id, row_hash, places)."""
        e = listed.select(F.col("doc_id").alias("e_id"), F.col("row_hash").alias("e_hash"), F.col("places").alias(name))
        return self.df.join(e, F.col("doc_id").eqNullSafe(F.col("e_id")) & (F.col("row_hash") == F.col("e_hash")), "left").drop("e_id", "e_hash")

    def exceptions(self) -> DataFrame:
        """(doc_id, row_hash, places) of candidate windows that are not repeated."""

        def count(scan, w, listed, _):
            parts = list(scan.whole(w, listed))
            if not parts:
                return
            value, second, _ = _joined(parts)
            order = np.lexsort((second, value))
            value, second = value[order], second[order]
            new = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (second[1:] != second[:-1])]))
            n = np.diff(np.append(new, len(value)))
            yield pa.RecordBatch.from_arrays([pa.array(value[new].view(np.int64)), pa.array(second[new]), pa.array(n.astype(np.int32))], names=["value", "second", "n"])

        counted = self.scanned([], "value long, second int, n int", count).groupBy("value", "second").agg(F.sum("n").alias("n"))
        once = self.scratch.write(counted.filter("n = 1").select("value", "second"))
        single = bitmap(once.select("value"), once.count())

        def locate(scan, w, listed, b):
            few = _loaded(single)
            for h, second, at in scan.whole(w, listed):
                hit = few.hit(h) if few else np.ones(len(h), bool)
                h, second, at = h[hit], second[hit], at[hit]
                doc = np.searchsorted(w.first, at, "right") - 1
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), b.column(1).take(pa.array(doc)), pa.array((at - w.first[doc]).astype(np.int32)), pa.array(h.view(np.int64)), pa.array(second)], names=["doc_id", "row_hash", "place", "value", "second"])

        placed = self.scanned(["doc_id", "row_hash"], f"doc_id {self.id_type}, row_hash long, place int, value long, second int", locate)
        return self.scratch.write(placed.join(once, ["value", "second"], "left_semi").groupBy("doc_id", "row_hash").agg(F.collect_list("place").alias("places")))


def _kept(w: Words, gone: np.ndarray) -> list[bytes]:
    """Words that stay of each document, joined by one space: their bytes with the one after each, blanks as spaces."""
    stay = np.flatnonzero(~gone)
    edge = np.zeros(len(w.bytes) + 1, np.int8)
    edge[w.starts[stay]] += 1
    edge[w.ends[stay] + 1] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
    data = w.buffer.translate(_BLANKS)
    kept = np.frombuffer(data, np.uint8, len(w.bytes))[inside].tobytes()
    cum = np.concatenate([[0], np.cumsum(np.where(gone, 0, w.ends - w.starts + 1))])[w.first].tolist()
    return [kept[a : max(a, b - 1)] for a, b in zip(cum, cum[1:])]


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of df: doc_id, n_words, n_removed, kept_text (the words that stay, joined by one space)."""
    ship(df.sparkSession)
    scratch = Scratch(df.sparkSession)
    found = Candidates(df.select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(f"`{text}`").alias("text")), window, scratch)
    left = all(found.refine() for _ in levels(window)[:-1])
    if left:
        once = found.exceptions()
        found.df = found.attached(once, "once")
        if None not in found.maps:
            scratch.keep(once)

    def run(scan, w, listed, b):
        repeated = np.zeros(len(w.starts), bool)
        if left:
            for base, _, alive in scan.blocks(w, listed):
                repeated[alive + base] = True
            for k, p in enumerate(b.column(1).to_pylist()):
                if p:
                    repeated[w.first[k] + np.array(p)] = False
        change, at = np.zeros(len(w.starts) + window + 1, np.int32), np.flatnonzero(repeated)
        change[at] += 1
        change[at + window] -= 1
        gone = np.cumsum(change)[: len(w.starts)] > 0
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[w.first])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(w.counts.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array(_kept(w, gone), pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])

    return found.scanned(["doc_id", "once"] if left else ["doc_id"], f"doc_id {found.id_type}, n_words long, n_removed long, kept_text string", run)
