"""Quality classifier by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are labelled good documents; no other label is read. The unlabelled sample is drawn from all
documents without looking at labels. The share of good documents (the class prior) is estimated from the scores that a
first positive-against-unlabelled model gives to all documents that are not held out: the least ratio of the two
score distributions over all thresholds, with a margin for sampling error. A small network then minimises the unbiased
risk, whose estimate for negatives is not allowed below zero. Its output is turned into a probability by the same
risk: a logistic slope and shift fitted on positives, unlabelled rows and the prior.

Features are computed from the whole text only: shares of character classes, lengths and repetition of words,
repeated word sequences and lines. Null and blank texts have all features zero and get a score like any other.
Repeated rows give equal scores. Without any usable good label every score is 0.5. A column that has the name of the score is replaced.

SAMPLE bounds the rows of each kind (labelled, unlabelled) that the model is fitted on, after the join of labels and texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, Words, add_columns, held_out, mix, per_document, text_or_empty

SAMPLE = 8000
#: Bytes of the texts of a kind that the driver may be sent, where a model is fitted on texts.
SAMPLE_BYTES = 6 << 20
SEED = 7
BLOCK_BYTES = 1 << 20
#: Bins of the scores from which the class prior is read.
BINS = 70
_CLASSES = 9


def _character_classes() -> np.ndarray:
    c = np.full(256, 8, np.uint8)
    for k, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>", b"|", b"!", b".,;:?'\"()-", b"\n")):
        c[list(chars)] = k
    return c


_CLASS = _character_classes()
_MARK = np.isin(np.arange(_CLASSES), (3, 5)).astype(np.int64)


def _class_counts(w: Words) -> np.ndarray:
    """Bytes of each class in each text, a block at a time."""
    out = np.zeros((len(w.counts), _CLASSES))
    for k in range(0, len(w.bytes), BLOCK_BYTES):
        some = _CLASS[w.bytes[k : k + BLOCK_BYTES]]
        low, high = np.searchsorted(w.offsets, [k, k + len(some)], ("right"))
        doc = np.repeat(np.arange(low - 1, min(high, len(w.counts))), np.diff(np.clip(w.offsets[low - 1 : high + 1], k, k + len(some))))
        low = low - 1
        n = int(doc[-1]) - low + 1
        out[low : low + n] += np.bincount((doc - low) * _CLASSES + some, minlength=n * _CLASSES).reshape(n, _CLASSES)
    return out


def features(texts: list[bytes]) -> np.ndarray:
    """A row of numbers for each text."""
    n, w = len(texts), Words(texts)
    lengths = np.diff(w.offsets) - 1
    classes = _class_counts(w)
    classes[:, 7] -= 1  # the line feed between documents
    per_char = classes / np.maximum(lengths, 1)[:, None]
    count = np.maximum(w.counts, 1)
    total = lambda x: per_document(x, w.first, np.add, 0.0) / count
    marked = _MARK[_CLASS[w.bytes[w.ends - 1]]]
    shape = [np.log1p(w.counts) / 5, total(w.ends - w.starts) / 10, total(marked)]
    own = w.hashes()
    doc = np.repeat(np.arange(n, dtype=np.int32), w.counts)
    same = np.zeros(len(own), np.int64)
    same[1:] = own[1:] == own[:-1]
    shape.append(total(same))
    for k in range(0, len(own), BLOCK_BYTES):  # a word in its document
        own[k : k + BLOCK_BYTES] = mix(own[k : k + BLOCK_BYTES] ^ mix(doc[k : k + BLOCK_BYTES].astype(np.uint64) + np.uint64(1)))

    def distinct(x: np.ndarray) -> np.ndarray:
        """Different values of each document among its words. They hold the document, so equal ones are of one."""
        order = np.argsort(x)
        x, of = x[order], doc[order]
        new = np.ones(len(x), bool)
        new[1:] = x[1:] != x[:-1]
        return np.bincount(of[new], minlength=n) / count

    words = distinct(own)
    four = np.zeros(len(own), np.uint64)
    if len(own) > 3:
        for k in range(0, len(own) - 3, BLOCK_BYTES):
            x = own[k : k + BLOCK_BYTES + 3]
            four[k : k + len(x) - 3] = mix(x[:-3] + mix(x[1:-2] + mix(x[2:-1] + mix(x[3:]))))
        four[-3:] = own[-3:]
    out = np.column_stack([per_char, shape[0], shape[1], words, distinct(four), shape[3], shape[2]])
    out[w.counts == 0] = 0
    return out


N_FEATURES = _CLASSES + 6


class Model:
    """A network of one hidden layer over standardised features, and a calibration of its output."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: list[np.ndarray], calibration: tuple[float, float] = (1.0, 0.0)):
        self.mean, self.scale, self.weights, self.calibration = mean, scale, weights, calibration

    def raw(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh(np.clip((x - self.mean) / self.scale, -6, 6) @ w1 + b1) @ w2 + b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        a, b = self.calibration
        return 1 / (1 + np.exp(-np.clip(a * self.raw(x) + b, -30, 30)))


def _fit(pos: np.ndarray, unl: np.ndarray, prior: float | None, epochs: int = 60, hidden: int = 24) -> Model:
    """Minimise the non-negative risk with the given prior; without one, tell positives from unlabelled rows."""
    rng = np.random.default_rng(SEED)
    both = np.concatenate([pos, unl])
    model = Model(both.mean(0), both.std(0) + 1e-6, [rng.normal(0, 0.3, (both.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 0.3, hidden), np.zeros(1)])
    std = lambda x: np.clip((x - model.mean) / model.scale, -6, 6)
    pos, unl, w = std(pos), std(unl), model.weights
    m, v, step = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w], 0
    batches = max(1, len(unl) // 256)
    for _ in range(epochs):
        ps, us = np.array_split(rng.permutation(len(pos)), batches), np.array_split(rng.permutation(len(unl)), batches)
        for p, u in zip(ps, us):
            if not len(p) or not len(u):
                continue
            x = np.concatenate([pos[p], unl[u]])
            hid = np.tanh(x @ w[0] + w[1])
            out = hid @ w[2] + w[3][0]
            s, k = 1 / (1 + np.exp(-np.clip(out, -30, 30))), len(p)
            as_good, as_bad = (s - 1), s  # slopes of the logistic loss as a positive and as a negative
            if prior is None:
                g = np.concatenate([as_good[:k] / k, as_bad[k:] / len(u)])
            else:
                loss = np.logaddexp(0, out)
                negative = loss[k:].mean() - prior * loss[:k].mean()
                g = np.concatenate([-prior * as_bad[:k] / k, as_bad[k:] / len(u)])
                if negative < 0:  # overfitted: step back
                    g = -g
                else:
                    g[:k] += prior * as_good[:k] / k
            back = np.outer(g, w[2]) * (1 - hid * hid)
            grads = [x.T @ back + 1e-4 * w[0], back.sum(0), hid.T @ g + 1e-4 * w[2], np.array([g.sum()])]
            step += 1
            for i, d in enumerate(grads):
                m[i], v[i] = 0.9 * m[i] + 0.1 * d, 0.999 * v[i] + 0.001 * d * d
                w[i] -= 0.01 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return model


def class_prior(pos: np.ndarray, cuts: np.ndarray, above: np.ndarray, n: int) -> float:
    """Share of positives among n unlabelled rows, of which so many score above each cut: the least ratio of the two shares, with margins for sampling."""
    p = 1 - np.searchsorted(np.sort(pos), cuts, "left") / len(pos)
    eps = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(pos)) + 1 / np.sqrt(max(n, 1)))
    return float(np.clip(np.min((above / max(n, 1) + eps / 2) / np.maximum(p, 1e-9)), 0.05, 0.99))


def _posterior(pos: np.ndarray, unl: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and shift that make outputs probabilities of being good, from positives, unlabelled rows and the prior alone: the unbiased logistic risk, which is convex here."""
    a, b, shrink = 1.0, 0.0, 1e-3
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * unl + b, -30, 30)))
        s = p * (1 - p) + 1e-9
        g = np.array([(p * unl).mean() - prior * pos.mean() + shrink * (a - 1), p.mean() - prior + shrink * b])
        h = np.array([[(s * unl * unl).mean() + shrink, (s * unl).mean()], [(s * unl).mean(), s.mean() + shrink]])
        d = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a - d[0], b - d[1]
        if np.abs(d).max() < 1e-8:
            break
    return float(a), float(b)


def _calibrated(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic calibration by Newton steps."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        s = p * (1 - p) + 1e-9
        g = np.array([((p - y) * raw).sum() + 1e-2 * (a - 1), (p - y).sum()])
        h = np.array([[(s * raw * raw).sum() + 1e-2, (s * raw).sum()], [(s * raw).sum(), s.sum() + 1e-6]])
        d = np.linalg.solve(h, g)
        a, b = a - d[0], b - d[1]
        if np.abs(d).max() < 1e-8:
            break
    return float(a), float(b)


def lowest(df: DataFrame, by: list[str], sample: int) -> DataFrame:
    """At most sample rows of df, those whose hashes of by are the lowest. Of many rows first the share that must hold them, so that tasks send few."""
    place, n = F.xxhash64(*by, F.lit(SEED)), df.count()
    if n > 8 * sample:
        df = df.filter(F.pmod(place, F.lit(1 << 40)) < int((1 << 40) * 8 * sample / n))
    return df.orderBy(F.pmod(place, F.lit(1 << 40)), *by).limit(sample)


def usable(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str) -> DataFrame:
    """(text_hash, y, bytes) of each different text that has a label of a row that is not held out; the least label of several."""
    known = labels.select(F.col("doc_id").alias("l_id"), F.col(label).cast("int").alias("y")).filter(F.col("y").isNotNull() & F.col("l_id").isNotNull() & ~held_out("l_id")).groupBy("l_id").agg(F.min("y").alias("y"))
    body = text_or_empty(f"`{text}`")
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(body).alias("text_hash"), F.octet_length(body).cast("long").alias("bytes")).filter(F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    return slim.join(known, F.col("doc_id") == F.col("l_id")).groupBy("text_hash").agg(F.min("y").alias("y"), F.max("bytes").alias("bytes"))


def fitting(of: list, most: int | None) -> list:
    """Of rows with bytes those that fit into so many bytes, in their order; a text that does not fit is passed over."""
    out, total = [], 0
    for r in of:
        if most is None or total + r.bytes <= most:
            total += r.bytes
            out.append(r)
    return out


def training_texts(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str, sample: int, most: int | None = None, only: int | None = None) -> DataFrame:
    """(y, text, text_hash) of at most sample different labelled texts (with one value of the label only, if given), of most bytes together: those with the lowest hashes, so the same in any order. Bounds hold after the join, whatever ids repeat."""
    scratch = Scratch(docs.sparkSession)
    known = usable(docs, labels, label, doc_id, text)
    known = scratch.write(known if only is None else known.filter(F.col("y") == only))
    chosen = fitting(lowest(known, ["text_hash"], sample).collect(), most)
    scratch.keep()
    # At most sample rows of two short values: safe to broadcast at any input size.
    wanted = docs.sparkSession.createDataFrame([(r.text_hash, r.y) for r in chosen], "text_hash long, y int")
    body = docs.select(text_or_empty(f"`{text}`").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    return body.join(F.broadcast(wanted), "text_hash").dropDuplicates(["text_hash"]).select("y", "text", "text_hash")


def _matrix(df: DataFrame, *more: str) -> tuple[np.ndarray, list]:
    """Features of the rows' texts, in the order of text_hash, and other columns."""
    field = T.StructField("features", T.ArrayType(T.DoubleType(), False))
    got = add_columns(df, [field], lambda: lambda t: [pa.array(list(features(t)))], "text").select("text_hash", *more, "features").toArrow().sort_by("text_hash")
    return np.asarray(got["features"].combine_chunks().flatten()).reshape(-1, N_FEATURES), [got[c].to_pylist() for c in more]


def _above(docs: DataFrame, model: Model, cuts: np.ndarray, doc_id: str, text: str) -> tuple[np.ndarray, int]:
    """How many of all documents that are not held out score at least each cut, and their number."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(f"`{text}`").alias("text")).filter(~held_out("doc_id")).select("text")
    bins = add_columns(rows, [T.StructField("bin", T.IntegerType())], lambda: lambda t: [np.searchsorted(cuts, model.raw(features(t)), "right").astype(np.int32)], "text")
    counts = np.zeros(len(cuts) + 1, np.int64)
    for k, n in bins.groupBy("bin").count().collect():  # at most BINS + 2 rows
        counts[k] = n
    return counts[::-1].cumsum()[::-1][1:], int(counts.sum())


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model | None:
    """Fit on at most sample labelled good texts and as many unlabelled ones; the class prior is of all documents. None if there is no labelled positive."""
    x, (y,) = _matrix(training_texts(docs, labels, label, doc_id, text, sample, only=1), "y")
    if not len(x):
        return None
    body = text_or_empty(f"`{text}`")
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(body).alias("text_hash")).filter(~held_out("doc_id"))
    # Drawn by row, so that copies weigh as often as they occur: the lowest hashes of rows.
    drawn = lowest(slim, ["doc_id", "text_hash"], sample).groupBy("text_hash").count()
    wanted = docs.sparkSession.createDataFrame([(r["text_hash"], r["count"]) for r in drawn.collect()], "text_hash long, times long")
    texts = docs.select(body.alias("text")).withColumn("text_hash", F.xxhash64("text")).join(F.broadcast(wanted), "text_hash").dropDuplicates(["text_hash"])
    u, (times,) = _matrix(texts, "times")
    u = np.repeat(u, times, axis=0)
    first = _fit(x, u, None, epochs=15)
    raw = first.raw(x)
    cuts = np.quantile(raw, np.linspace(0.0, 0.7, BINS + 1))
    prior = class_prior(raw, cuts, *_above(docs, first, cuts, doc_id, text))
    model = _fit(x, u, prior)
    model.calibration = _posterior(model.raw(x), model.raw(u), prior)
    model.prior = prior
    return model


def score_quality(docs: DataFrame, model: Model | None, text: str = "text", name: str = "score") -> DataFrame:
    """docs with a score, 0 to 1, from the whole text."""
    return add_columns(docs, [T.StructField(name, T.DoubleType())], lambda: lambda t: [np.full(len(t), 0.5) if model is None else model.score(features(t))], text)
