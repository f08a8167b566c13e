"""Secret scans: base patterns, and a character convolutional network over every candidate with its context.

Candidates are the base matches and every run of CANDIDATE_CHARS token characters or more that mixes letters with digits,
or cases with symbols, outside of base matches. A numpy network with one convolution over character classes, which
tell the candidate from its context, global pooling and a dense layer scores each candidate with CONTEXT characters on
either side; of one beyond SPAN characters all windows and parts are scored, and the highest score counts. It is trained
on labelled findings: examples in seeded formats of credentials and passwords, and look-alikes (words, numbers,
addresses, dates, links, plain identifiers), each in a context of words, with or without a cue. A part of them is held
back; on it scores are calibrated, and the threshold is the largest whose recall has an exact lower confidence bound of
at least RECALL. Base matches always stay and get a score too; the network adds spans of kind "model".

Spans are in code points, end exclusive. Per kind, base matches are the leftmost ones that don't overlap; a match
that fails its length test is dropped after it has used up its characters. Added spans never overlap a base span.
Null and empty texts have no spans. Repeated rows give equal spans. Very long texts are scanned whole.
"""

from __future__ import annotations

import math
import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns

#: The base patterns, with the group and length that count.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "model")
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

CANDIDATE_CHARS = 8
CANDIDATE = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9+/_=.@#$%^&*!~-]*[A-Za-z0-9=])?")
_MIXED = re.compile(r"(?=.*[A-Za-z])(?:(?=.*[0-9])|(?=.*[a-z])(?=.*[A-Z])(?=.*[^A-Za-z0-9]))")
CONTEXT, SPAN = 24, 48
#: What long candidates are also cut at, into parts of so many characters at least.
PART, PART_CHARS = re.compile(r"[A-Za-z0-9]+"), 16
LENGTH = CONTEXT + SPAN + CONTEXT
RECALL, MISS = 0.95, 0.05
#: Classes of a candidate's characters; those of its context come after them.
_KINDS = 17


def _class_table() -> np.ndarray:
    t = np.full(128, 15, np.uint8)
    groups = ["aeiou", "bcdf", "ghjklmn", "pqrstvwxyz", "AEIOU", "BCDF", "GHJKLMNPQRSTVWXYZ", "01234", "56789", "=:", "\"'", "-_", "+/", ".@", " \n\t"]
    for k, g in enumerate(groups):
        for c in g:
            t[ord(c)] = k
    return t


_TABLE = _class_table()


def encode(text: str, start: int, end: int) -> np.ndarray:
    """Character classes of at most SPAN characters of a candidate and their surroundings; 16 is beyond the text."""
    out = np.full(LENGTH, 16, np.uint8)
    out[:CONTEXT] += _KINDS
    out[CONTEXT + SPAN :] += _KINDS
    left, right = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    for at, part, shift in ((CONTEXT - len(left), left, _KINDS), (CONTEXT, text[start:end], 0), (CONTEXT + SPAN, right, _KINDS)):
        code = np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32)
        out[at : at + len(code)] = np.where(code < 128, _TABLE[np.minimum(code, 127)], 15) + shift
    return out


def views(text: str, start: int, end: int) -> list[np.ndarray]:
    """All that is scored of a candidate: itself, or of one beyond SPAN overlapping windows over all of it and its parts between separators."""
    if end - start <= SPAN:
        return [encode(text, start, end)]
    parts = [m.span() for m in PART.finditer(text, start, end) if PART_CHARS <= m.end() - m.start() <= SPAN and _MIXED.match(m[0])]
    return [encode(text, a, b) for a, b in [*((a, a + SPAN) for a in [*range(start, end - SPAN, SPAN // 2), end - SPAN]), *parts]]


#: Weight decay.
DECAY = 1e-4


class Network:
    """One-hot classes, convolution of width 5, ReLU, maximum and mean over places, dense, sigmoid."""

    WIDTH, FILTERS = 5, 24

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.w = [rng.normal(0, 0.2, (self.WIDTH * 2 * _KINDS, self.FILTERS)), np.zeros(self.FILTERS), rng.normal(0, 0.2, 2 * self.FILTERS), np.zeros(1)]
        self.calibration, self.threshold = (1.0, 0.0), 0.5

    def _columns(self, x: np.ndarray) -> np.ndarray:
        hot = np.eye(2 * _KINDS, dtype=np.float32)[x]
        n = x.shape[1] - self.WIDTH + 1
        return np.concatenate([hot[:, k : k + n] for k in range(self.WIDTH)], axis=2)

    def forward(self, x: np.ndarray):
        # A one-hot row times the filters is a row of them.
        filters, n = self.w[0].reshape(self.WIDTH, 2 * _KINDS, self.FILTERS).astype(np.float32), x.shape[1] - self.WIDTH + 1
        act = sum(filters[k][x[:, k : k + n]] for k in range(self.WIDTH)) + self.w[1].astype(np.float32)
        act = np.maximum(act, 0)
        pooled = np.concatenate([act.max(1), act.mean(1)], axis=1)
        return act, pooled, pooled @ self.w[2] + self.w[3][0]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0), *(self.forward(x[k : k + 256])[2] for k in range(0, len(x), 256))])

    def score(self, x: np.ndarray) -> np.ndarray:
        a, b = self.calibration
        return 1 / (1 + np.exp(-np.clip(a * self.raw(x) + b, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, seed: int = 5) -> None:
        rng, step = np.random.default_rng(seed), 0
        m, v = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for k in range(0, len(x), 64):
                i = order[k : k + 64]
                (act, pooled, out), cols = self.forward(x[i]), self._columns(x[i])
                g = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[i]) / len(i)
                gp = np.outer(g, self.w[2]).astype(np.float32)
                ga = np.repeat(gp[:, None, self.FILTERS :] / act.shape[1], act.shape[1], axis=1)
                np.put_along_axis(ga, act.argmax(1)[:, None, :], np.take_along_axis(ga, act.argmax(1)[:, None, :], 1) + gp[:, None, : self.FILTERS], 1)
                ga *= act > 0
                grads = [cols.reshape(-1, cols.shape[2]).T @ ga.reshape(-1, self.FILTERS) + DECAY * self.w[0], ga.sum((0, 1)), pooled.T @ g + DECAY * self.w[2], np.array([g.sum()])]
                step += 1
                for j, d in enumerate(grads):
                    m[j], v[j] = 0.9 * m[j] + 0.1 * d, 0.999 * v[j] + 0.001 * d * d
                    self.w[j] = self.w[j] - 0.01 * (m[j] / (1 - 0.9**step)) / (np.sqrt(v[j] / (1 - 0.999**step)) + 1e-8)


def findings(n: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """n labelled findings: half are credentials, half look-alikes, each in a context of words."""
    r = random.Random(seed)
    syllables = ["the", "an", "er", "on", "ti", "re", "in", "es", "ou", "st", "que", "la", "ment", "ción", "sch", "ung", "en", "é", "ich", "ar"]
    plain_syllables = ["the", "an", "er", "on", "ti", "re", "in", "es", "ou", "st", "que", "la", "ment", "ion", "sch", "ung"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    ascii_word = lambda a=1, b=4: "".join(r.choice(plain_syllables) for _ in range(r.randint(a, b)))
    pick = lambda chars, a, b: "".join(r.choice(chars) for _ in range(r.randint(a, b)))
    low, up, num, hexa, marks = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef", "!@#$%^&*_-+."
    # Long random keys are told by themselves, short ones and passwords by a cue before them.
    keys = [
        lambda: pick(hexa, 32, 48), lambda: pick(hexa.upper(), 32, 48), lambda: "AKIA" + pick(up + num, 16, 16), lambda: pick(low + up + num, 20, 48),
        lambda: pick(low + up + num + "+/", 24, 46) + r.choice(["", "=", "=="]), lambda: pick(low, 2, 4) + "_" + pick(low + up + num, 24, 40),
        lambda: "x" + pick(low + up + num + "-_", 20, 38) + "1a", lambda: pick(low + num, 24, 40),
    ]
    short = [
        lambda: "a" + pick(low + up + num + marks, 6, 14) + "7K", lambda: pick(low + up + num, 8, 18) + "3f", lambda: pick(hexa, 8, 30) + "a1",
        lambda: ascii_word(2, 3).capitalize() + pick(marks, 1, 1) + pick(num, 1, 4) + pick(low, 0, 2), lambda: pick(up + num, 8, 14) + "B2",
    ]
    plain = [
        lambda: "-".join(ascii_word() for _ in range(r.randint(2, 6))) + str(r.randint(1, 99)), lambda: "_".join(ascii_word() for _ in range(r.randint(2, 6))) + "_v" + str(r.randint(1, 9)),
        lambda: "/".join(ascii_word() for _ in range(r.randint(2, 6))) + "/" + str(r.randint(1, 2030)), lambda: ascii_word(3, 6) + str(r.randint(0, 9)),
        lambda: f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}T{r.randint(10, 23)}-{ascii_word()}", lambda: ascii_word() * 4 + pick(num, 1, 3), lambda: "".join(ascii_word().capitalize() for _ in range(r.randint(2, 5))) + pick(num, 1, 2),
        lambda: pick(num, 8, 19) + r.choice("ABX"), lambda: (ascii_word() + str(r.randint(0, 9))) * r.randint(2, 4), lambda: ascii_word(2, 3) + "=" * 6 + pick(num, 1, 2), lambda: r.choice(low) * r.randint(8, 30) + pick(num, 1, 3),
        lambda: f"{ascii_word()}.{ascii_word()}{pick(num, 0, 3)}@{ascii_word()}{pick(num, 1, 2)}.com", lambda: f"www.{ascii_word()}{pick(num, 1, 3)}.org/{ascii_word()}", lambda: f"{ascii_word(2, 3)}.v{r.randint(1, 9)}.{r.randint(0, 20)}.tar.gz",
        lambda: f"{pick(hexa, 8, 8)}-{pick(hexa, 4, 4)}-{pick(hexa, 4, 4)}-{pick(hexa, 4, 4)}-{pick(hexa, 12, 12)}", lambda: f"{ascii_word().capitalize()}-{ascii_word()}.{ascii_word().capitalize()}", lambda: f"{r.choice(up)}{r.choice(up)}{pick(num, 6, 12)}",
        lambda: f"{ascii_word(2, 3)}{pick('#$%&*', 3, 3)}{pick(num, 1, 2)}", lambda: f"{pick(num, 1, 3)}.{pick(num, 3, 3)}.{pick(num, 2, 3)}-{r.choice(low)}", lambda: pick(up + num, 8, 12) + "C4",
    ]
    lead = ["key = ", "key: ", "auth ", "bearer ", "credential=", "credentials: ", "pwd=", "pwd: ", "private_key: ", "passphrase: ", "pass: ", "login ", "PIN="]
    none = ["id = ", "", "", "", "", "see ", "file ", "", "ref ", "order ", "by ", "at "]
    x, y = np.zeros((n, LENGTH), np.uint8), np.zeros(n)
    for k in range(n):
        y[k] = k % 2
        if k % 2:
            cued = r.random() < 0.6
            value, cue = r.choice(short if cued else keys)(), r.choice(lead if cued or r.random() < 0.4 else none)
        else:
            value, cue = r.choice(plain)(), r.choice(none if r.random() < 0.9 else lead)
        before = " ".join(word() for _ in range(r.randint(0, 5))) + " " + cue + r.choice(["", "", "", '"', "'"])
        after = r.choice(["", "", '"', "'", ".", ",", "***", "!!"]) + " " + " ".join(word() for _ in range(r.randint(0, 5)))
        x[k] = encode(before + value + after, len(before), len(before) + min(SPAN, len(value)))
    return x, y


def _lower_bound(k: int, n: int, miss: float) -> float:
    """Exact lower confidence bound of a rate of which k of n were seen, by bisection."""
    def tail(p: float) -> float:
        return sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k, n + 1))

    low, high = 1e-9, 1 - 1e-9
    for _ in range(50):
        mid = (low + high) / 2
        low, high = (mid, high) if tail(mid) < miss else (low, mid)
    return low


_trained: dict[int, Network] = {}


def train(n: int = 5000) -> Network:
    """The network, its calibration and its threshold; the same every time."""
    if n not in _trained:
        x, y = findings(n)
        cut = n * 3 // 4
        net = Network()
        net.fit(x[:cut], y[:cut])
        net.calibration = _calibrated(net.raw(x[cut:]), y[cut:])
        held, truth = net.score(x[cut:]), y[cut:] == 1
        good = np.sort(held[truth])
        keep = 0  # the bound falls as more are missed
        while keep + 1 < len(good) and _lower_bound(len(good) - keep - 1, len(good), MISS) >= RECALL:
            keep += 1
        net.threshold = float(good[keep])
        _trained[n] = net
    return _trained[n]


def _calibrated(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic slope and shift by Newton steps, towards shares that no finite number of findings makes 0 or 1."""
    n = y.sum()
    goal, a, b = np.where(y == 1, (n + 1) / (n + 2), 1 / (len(y) - n + 2)), 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        s = p * (1 - p) + 1e-9
        g, h = np.array([((p - goal) * raw).sum(), (p - goal).sum()]), np.array([[(s * raw * raw).sum() + 1e-6, (s * raw).sum()], [(s * raw).sum(), s.sum() + 1e-6]])
        d = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a - d[0], b - d[1]
        if np.abs(d).max() < 1e-8:
            break
    return float(a), float(b)


#: Bytes as letters of a kind, for quick tests that rule matches out: hexadecimal digits; token characters, digits among them.
_HEXA = bytes(104 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
_TOKEN = re.compile(rb"[A-Za-z0-9+/_=.@#$%^&*!~-]{8,}")
_SHAPE = bytes(100 if chr(c) in "0123456789" else 108 if c < 128 and chr(c).isalpha() else 115 if chr(c) in "+/_=.@#$%^&*!~-" else 32 for c in range(256))
#: Digits beside letters or symbols, or symbols between letters: what no candidate is without.
_LIKELY = re.compile(rb"[ls]d|d[ls]|ls+l")


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base matches, sorted. raw is the text in UTF-8, for quick tests that rule matches out."""
    out, low = [], raw.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if b"AKIA" in raw:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    if b"h" * 32 in raw.translate(_HEXA):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    return sorted(out)


def candidates(text: str, raw: bytes, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs of token characters that mix letters with digits, or cases with symbols, without what base spans cover."""
    if not _LIKELY.search(raw.translate(_SHAPE)) or not any(_MIXED.match(m[0].decode()) for m in _TOKEN.finditer(raw)):
        return []
    out, at = [], 0
    for a, b in [*((a, b) for a, _, b in base), (len(text), len(text))]:
        if a > at:
            out += [m.span() for m in CANDIDATE.finditer(text, at, a) if m.end() - m.start() >= CANDIDATE_CHARS and _MIXED.match(m[0])]
        at = max(at, b)
    return out


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))


def find_secrets(df: DataFrame, net: Network | None = None, text: str = "text") -> DataFrame:
    """df with spans: array of (kind, start, end, score of the network), by start, then kind."""
    net = net or train()

    def make():
        def batch(texts: list[bytes]) -> list[list]:
            rows, windows, first = [], [], []  # first: of each candidate's windows
            for t in texts:
                s = t.decode("utf-8", "replace")
                base = base_spans(s, t)
                more = candidates(s, t, base)
                rows.append((base, more, len(first)))
                for a, b in [(a, b) for a, _, b in base] + more:
                    first.append(len(windows))
                    windows += views(s, a, b)
            scores = np.maximum.reduceat(np.concatenate([net.score(np.array(windows[k : k + 4096])) for k in range(0, len(windows), 4096)]), first) if windows else np.zeros(0)
            out = []
            for base, more, at in rows:
                own = [(a, k, b, scores[at + i]) for i, (a, k, b) in enumerate(base)]
                own += [(a, 3, b, x) for (a, b), x in zip(more, scores[at + len(base) :]) if x >= net.threshold]
                out.append([{"kind": KINDS[k], "start": a, "end": b, "score": float(x)} for a, k, b, x in sorted(own)])
            return [out]

        return batch

    return add_columns(df, [T.StructField("spans", SPANS)], make, text)


def joined(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(df: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans, and the scores that the network gives to all spans, in their order."""
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = joined(F.filter("spans", lambda s: s["kind"] != "model"))
    return df.withColumns({"n_assign": count("assign"), "n_access": count("access"), "n_hex": count("hex"), "base_sha256": F.sha2(base.cast("binary"), 256), "spans": joined(F.col("spans")), "scores": F.transform("spans", lambda s: F.round(s["score"], 6))})
