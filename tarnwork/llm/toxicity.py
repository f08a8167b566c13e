"""Toxicity by a string-kernel support vector machine with Nystroem landmarks.

The kernel compares two texts by the subsequences of four characters that words of theirs share, each weighted by DECAY
for every character that it skips, up to two (so it tolerates gaps and inserted characters); word borders are
characters, marks inside a word are dropped, and a word's part is divided by its usual size for the word's length. Two
or three short pieces in a row, and runs of single letters, are also read as one word, so that spaces inside an insult
are gaps too. Landmarks are words; the machine (squared hinge) works in the Nystroem features that they span, and its
rows are labelled sentences. Its weights are folded back into one number for each subsequence of the landmarks, so that
a sentence's margin is a sum over its subsequences, exactly the machine's value.

Training takes the distinct sentences of labelled documents. A sentence that a clean document has is clean. Of the
others those are toxic rows that have a word which SENTENCES of them share and no clean one has, and the likeliest one
of each toxic document (multiple-instance training), by evidence (smoothed log odds of subsequences between sentences of
either kind) at first, then anew by the machine's margins. Clean rows are drawn, the hardest ones included, and toxic
words, also with inserted characters, and the harmless ones that are most like them are sentences of one word besides.
A document's score is calibrated from the highest part that a word has in a margin, the sum of such parts beyond 1 and
its length, on a quarter of the documents that the machine does not see.

SAMPLE and quality.SAMPLE_BYTES bound the labelled texts that the model is fitted on, ROWS the sentences of either kind;
held-out rows are never used. Null and blank texts have no word and get the score of a document without any sign of
toxicity. Repeated rows get equal scores; very long texts are scored whole. Without toxic labels every score is 0. A
column named score is replaced.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import quality
from .common import Words, add_columns, mix, per_document

SAMPLE = 2500
LANDMARKS = 320
#: A word in so many distinct sentences of toxic documents, and in none of clean ones, is a positive.
SENTENCES = 4
#: Toxic sentences, and clean ones, that the machine is trained on at most.
ROWS = 1200
INSERTED = 4
#: How many pieces in a row are joined, and letters of each at most.
PIECES = {2: 4, 3: 3}
DECAY = 0.5
REACH = 5
_SIZE = 48
#: Bytes that begin a letter or digit, and marks that end a sentence.
_LETTER = np.array([chr(k).isalnum() if k < 128 else k >= 0xC0 for k in range(256)])
_STOP = np.isin(np.arange(256), list(b".!?"))
_COMBOS = [c for c in combinations(range(1, REACH + 1), 3)]


def _letter_table() -> np.ndarray:
    """Class of each code point below 65536: 0 a border (space), 1 to 26 a to z, 27 to 46 other letters, 47 digits, 255 dropped."""
    t = np.full(65536, 255, np.uint8)
    for k in range(65536):
        c = chr(k)
        if c.isdigit():
            t[k] = 47
        elif c.isalpha():
            t[k] = 27 + k % 20
    t[ord(" ")] = 0
    t[ord("a") : ord("z") + 1] = np.arange(1, 27)
    return t


_table: np.ndarray | None = None


def _classes(words: list[bytes]) -> np.ndarray:
    """Character classes of words, with a border before, between and after them; a word without letters is two borders in a row."""
    global _table
    if _table is None:
        _table = _letter_table()
    code = np.frombuffer((b" " + b" ".join(words) + b" ").decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32)
    c = np.where(code < 65536, _table[np.minimum(code, 65535)], 27 + (code % 20).astype(np.uint8)).astype(np.uint8)
    return c[c != 255].astype(np.int32)


class Subsequences:
    """Codes of all subsequences of some words, one combination of offsets at a time."""

    def __init__(self, words: list[bytes]):
        c = _classes(words)
        self.n = n = len(c)
        border = np.flatnonzero(c == 0)
        self.first = border  # the last border starts no word
        reach = np.zeros(n, np.int32)  # steps to the next border
        nxt = np.append(border[1:], n - 1)
        lengths = np.diff(np.append(border, n))
        reach[:] = np.repeat(nxt, lengths) - np.arange(n)
        self.reach, self.c = reach, np.concatenate([c, np.zeros(REACH, np.int32)])
        size = np.maximum(lengths[:-1] + 1, 2).astype(np.int64)  # letters and both borders
        self.norm = _norms(int(size.max()) + 1 if len(size) else 2)[size]

    def each(self):
        """(codes, weight, places) where the subsequence at a place stays in its word."""
        n, c = self.n, self.c
        for a, b, d in _COMBOS:
            at = np.flatnonzero(self.reach >= d)
            yield ((c[at] * _SIZE + c[at + a]) * _SIZE + c[at + b]) * _SIZE + c[at + d], DECAY ** (d - 3), at

    def margins(self, table: np.ndarray) -> np.ndarray:
        """Normalised sum of the table over each word's subsequences."""
        n, c = self.n, self.c
        total, code2, code3, last = np.zeros(n, np.float32), None, None, (0, 0)
        for a, b, d in _COMBOS:  # in order, so that what combinations begin with is made once
            if last[0] != a:
                code2 = (c[:n] * _SIZE + c[a : n + a]) * _SIZE
            if last != (a, b):
                code3 = (code2 + c[b : n + b]) * _SIZE
            last = a, b
            total += np.where(self.reach >= d, table[code3 + c[d : n + d]], np.float32(0)) * np.float32(DECAY ** (d - 3))
        cum = np.concatenate([[0.0], np.cumsum(total, dtype=np.float64)])
        return (cum[self.first[1:]] - cum[self.first[:-1]]) / self.norm

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, code, weight) of all subsequences, sorted by word."""
        word, code, weight = [], [], []
        owner = np.repeat(np.arange(len(self.first)), np.diff(np.append(self.first, self.n)))
        for k, w, at in self.each():
            word.append(owner[at]), code.append(k), weight.append(w / self.norm[owner[at]])
        word, code, weight = map(np.concatenate, (word, code, weight))
        order = np.argsort(word, kind="stable")
        return word[order], code[order], weight[order]


def _norms(longest: int) -> np.ndarray:
    """Root of the sum of squared weights for words of so many characters, borders included; 1 where there are none."""
    n = np.arange(longest + 1)
    total = sum(np.maximum(n - d, 0) * DECAY ** (2 * (d - 3)) for _, _, d in _COMBOS)
    return np.sqrt(np.where(total > 0, total, 1.0))


class Kernel:
    """Kernel of words against landmarks, and the way back from landmark weights to subsequences."""

    def __init__(self, landmarks: list[bytes]):
        word, code, weight = Subsequences(landmarks).entries()
        self.codes, at = np.unique(code, return_inverse=True)
        self.rows = np.zeros((len(self.codes), len(landmarks)), np.float32)
        np.add.at(self.rows, (at, word), weight)  # of landmarks only

    def __call__(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros((len(words), self.rows.shape[1]), np.float32)
        for k in range(0, len(words), 60):
            word, code, weight = Subsequences(words[k : k + 60]).entries()
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            hit = self.codes[at] == code
            word, at, weight = word[hit], at[hit], weight[hit]
            if len(word):
                first = np.flatnonzero(np.diff(word, prepend=-1))
                out[word[first] + k] = np.add.reduceat(weight[:, None].astype(np.float32) * self.rows[at], first, axis=0)
        return out

    def table(self, landmark_weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.codes, self.rows @ landmark_weights


def _machine(z: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared-hinge machine by Newton steps; cost weighs each row."""
    z1 = np.column_stack([z, np.ones(len(z))])
    w, ridge = np.zeros(z1.shape[1]), np.append(np.ones(z.shape[1]), 1e-3)
    for _ in range(25):
        margin = y * (z1 @ w)
        active = margin < 1
        g = ridge * w - z1[active].T @ (cost[active] * y[active] * (1 - margin[active]))
        h = np.diag(ridge) + (z1[active] * cost[active, None]).T @ z1[active]
        step = np.linalg.solve(h, g)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


class Terms:
    """Words of some texts, and what short pieces in a row spell together: the different terms, and each occurrence with the word where it starts."""

    def __init__(self, w: Words):
        h = w.hashes()
        lettered = np.concatenate([[0], np.cumsum(_LETTER[w.bytes], dtype=np.int32)])
        letters = lettered[w.ends] - lettered[w.starts]
        doc = np.repeat(np.arange(len(w.counts)), w.counts)
        with_letters = np.flatnonzero(letters)  # marks between pieces are skipped
        h_, doc_, size = h[with_letters], doc[with_letters], letters[with_letters]
        single = size == 1
        groups = []  # (place of the first piece among words with letters, how many pieces)
        for many in PIECES:
            n = max(0, len(h_) - many + 1)
            ok = doc_[:n] == doc_[many - 1 :]
            for k in range(many):
                ok &= size[k : k + n] <= PIECES[many]
            groups.append((np.flatnonzero(ok), many))
        same = doc_[1:] == doc_[:-1]
        run = np.flatnonzero(single & ~np.concatenate([[False], single[:-1] & same])[: len(single)])
        stop = np.flatnonzero(single & ~np.concatenate([single[1:] & same, [False]])[: len(single)]) + 1
        keys, places, pieces = [h], [np.arange(len(h))], [np.ones(len(h), np.int64)]
        for at, many in groups:
            key = mix(h_[at] + np.uint64(many))
            for k in range(1, many):
                key = mix(key * np.uint64(3) + h_[at + k])
            keys.append(key), places.append(at), pieces.append(np.full(len(at), many))
        for a, b in zip(run.tolist(), stop.tolist()):
            if b - a > 3:
                keys.append(mix(h_[a:b] * (2 * np.arange(b - a, dtype=np.uint64) + np.uint64(5))).sum(keepdims=True)), places.append(np.array([a])), pieces.append(np.array([b - a]))
        key, place, many = map(np.concatenate, (keys, places, pieces))
        self.hashes, first, self.term = np.unique(key, return_index=True, return_inverse=True)
        place_, many_ = place[first], many[first]
        start, end, data = w.starts, w.ends, w.buffer
        self.words: list[bytes] = [b""] * len(first)
        for m in (1, 2, 3):
            at = np.flatnonzero(many_ == m)
            parts = [place_[at]] if m == 1 else [with_letters[place_[at] + k] for k in range(m)]
            cut = [[data[a:b] for a, b in zip(start[x].tolist(), end[x].tolist())] for x in parts]
            for k, x in zip(at.tolist(), cut[0] if m == 1 else map(b"".join, zip(*cut))):
                self.words[k] = x
        for k in np.flatnonzero(many_ > 3).tolist():
            self.words[k] = b"".join(data[start[x] : end[x]] for x in with_letters[place_[k] : place_[k] + many_[k]].tolist())
        own = many == 1
        self.start = np.where(own, place, with_letters[np.where(own, 0, place)] if len(with_letters) else place)


def sentence_numbers(w: Words) -> np.ndarray:
    """The sentence of each word: one ends with a mark or a line, and with its document."""
    ends = _STOP[w.bytes[w.ends - 1]] | (w.bytes[w.ends] == 10)
    last = w.first[1:][w.counts > 0] - 1
    ends[last] = True
    return np.concatenate([[0], np.cumsum(ends)[:-1]]) if len(ends) else np.zeros(0, np.int64)


class Model:
    """Values of subsequences, a bias, and a calibration from a document's margins and length to a probability."""

    def __init__(self, codes: np.ndarray, values: np.ndarray, bias: float):
        self.codes, self.values, self.bias = codes.astype(np.int32), values.astype(np.float32), bias
        self.calibration = np.array([4.0, 0.0, 0.0, -2.0])
        self._dense = None

    def __getstate__(self):
        return {**self.__dict__, "_dense": None}

    def words(self, words: list[bytes]) -> np.ndarray:
        """Each word's part of a sentence's margin."""
        if self._dense is None:
            self._dense = np.zeros(_SIZE**4, np.float32)
            self._dense[self.codes] = self.values
        return np.concatenate([np.zeros(0), *(Subsequences(words[k : k + 20_000]).margins(self._dense) for k in range(0, len(words), 20_000))])

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """(highest part of a word in a sentence's margin, log of words, log of the sum of parts beyond 1) of each text."""
        w = Words(texts)
        out = np.column_stack([np.full(len(texts), -2.0), np.zeros((len(texts), 2))])
        if not len(w.starts):
            return out
        t = Terms(w)
        part = self.words(t.words)[t.term]
        doc = np.searchsorted(w.first, t.start, "right") - 1
        np.maximum.at(out[:, 0], doc, part)
        np.add.at(out[:, 2], doc, np.maximum(part - 1, 0))
        # A part of 1 is a whole margin; what goes beyond it counts in the sum alone.
        return np.column_stack([np.clip(out[:, 0], -2, 1), np.log1p(w.counts), np.log1p(out[:, 2])])

    def score(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.documents(texts) @ self.calibration[:-1] + self.calibration[-1], -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x1 = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(x1.shape[1]), np.array([1e-2] * x.shape[1] + [1e-4])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        s = p * (1 - p) + 1e-9
        step = np.linalg.solve((x1 * s[:, None]).T @ x1 + np.diag(ridge), x1.T @ (p - y) + ridge * w)
        w = w - np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


class Corpus:
    """Distinct sentences of the training documents, whether a clean document has them, which toxic documents do, and their terms."""

    def __init__(self, texts: list[bytes], y: np.ndarray):
        terms: dict[int, int] = {}
        self.words: list[bytes] = []
        known: dict[int, int] = {}
        clean: list[bool] = []
        pairs, entries = [], []
        for k in range(0, len(texts), 200):
            w = Words(texts[k : k + 200])
            if not len(w.starts):
                continue
            t, number = Terms(w), sentence_numbers(w)
            for h, x in zip(t.hashes.tolist(), t.words):
                if h not in terms:
                    terms[h] = len(self.words)
                    self.words.append(x)
            term = np.array([terms[h] for h in t.hashes.tolist()])[t.term]
            # A sentence by the hash of its words, in any order.
            first = np.flatnonzero(np.diff(number, prepend=-1))
            names = np.add.reduceat(mix(w.hashes(1)), first).tolist()
            doc = np.searchsorted(w.first, first, "right") - 1 + k
            ids, fresh = np.zeros(len(names), np.int64), np.zeros(len(names), bool)
            for i, (name, d) in enumerate(zip(names, doc.tolist())):
                if name not in known:
                    known[name], fresh[i] = len(clean), True
                    clean.append(False)
                ids[i] = known[name]
                clean[known[name]] |= bool(y[d] == 0)
            toxic = y[doc] == 1
            pairs.append(np.column_stack([doc[toxic], ids[toxic]]))
            of = number[t.start]
            new = fresh[of]
            entries.append(np.unique(np.column_stack([ids[of[new]], term[new]]), axis=0))
        self.clean = np.array(clean, bool)
        entries = np.concatenate([np.zeros((0, 2), np.int64), *entries])
        entries = entries[np.lexsort((entries[:, 1], entries[:, 0]))]
        self.sentence, self.term = entries[:, 0], entries[:, 1]
        self.first = np.searchsorted(self.sentence, np.arange(len(clean) + 1))
        pairs = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *pairs]), axis=0)
        self.pairs = pairs[~self.clean[pairs[:, 1]]] if len(pairs) else pairs
        self.in_toxic, self.in_clean = (np.bincount(self.term[self.clean[self.sentence] == v], minlength=len(self.words)).astype(float) for v in (False, True))

    def highest(self, value: np.ndarray) -> np.ndarray:
        """The highest value of each sentence's terms."""
        return np.maximum.reduceat(value[self.term], self.first[:-1]) if len(self.clean) else np.zeros(0)

    def best(self, value: np.ndarray, sentences: np.ndarray) -> np.ndarray:
        """The term of the highest value in each of some sentences."""
        return np.array([self.term[a + int(np.argmax(value[self.term[a:b]]))] for a, b in zip(self.first[sentences].tolist(), self.first[sentences + 1].tolist())], np.int64)


def _evidence(c: Corpus) -> np.ndarray:
    """Smoothed log odds of each term's subsequences between sentences that are clean and those that are not."""
    t, n = np.zeros(_SIZE**4, np.float32), np.zeros(_SIZE**4, np.float32)
    for k in range(0, len(c.words), 20_000):
        s = Subsequences(c.words[k : k + 20_000])
        owner = np.repeat(np.arange(len(s.first)), np.diff(np.append(s.first, s.n))) + k
        owner = np.minimum(owner, len(c.words) - 1)
        for code, weight, at in s.each():
            u = owner[at]
            np.add.at(t, code, np.float32(weight) * c.in_toxic[u].astype(np.float32))
            np.add.at(n, code, np.float32(weight) * c.in_clean[u].astype(np.float32))
    n_toxic, n_clean = int((~c.clean).sum()), int(c.clean.sum())
    share = n_toxic / max(n_toxic + n_clean, 1)
    # In place: the tables are large, and so is the driver's share of memory that they would take.
    for table, mean, total in ((t, 4 * share, n_toxic + 4), (n, 4 * (1 - share), n_clean + 4)):
        table += np.float32(max(mean, 1e-3))
        table /= np.float32(total)
        np.log(table, out=table)
    t -= n
    return np.concatenate([np.zeros(0), *(Subsequences(c.words[k : k + 20_000]).margins(t) for k in range(0, len(c.words), 20_000))])


def _inserted(word: bytes, rng: np.random.Generator) -> list[bytes]:
    """The word with a letter more, at INSERTED places between its characters."""
    chars = word.decode("utf-8", "replace")
    return [(chars[:k] + chr(rng.integers(97, 123)) + chars[k:]).encode() for k in (max(1, len(chars) * i // (INSERTED + 1)) for i in range(1, INSERTED + 1))]


def fit(texts: list[bytes], y: np.ndarray, seed: int = 13) -> Model:
    """A model from labelled documents; y is 1 for toxic."""
    rng = np.random.default_rng(seed)
    # A quarter of either kind is for calibration; a single document of its kind serves for both.
    aside = np.zeros(len(y), bool)
    for v in (0, 1):
        aside[np.flatnonzero(y == v)[3::4]] = True
    seen = np.flatnonzero(~aside)
    c = Corpus([texts[k] for k in seen], y[seen])
    value = _evidence(c)
    of_sentence = c.highest(value)
    sure = np.zeros(len(c.clean), bool)
    strong = (c.in_clean == 0) & (c.in_toxic >= SENTENCES)
    sure[c.sentence[strong[c.term]]] = True
    sure = np.flatnonzero(sure & ~c.clean)
    sure = rng.permutation(sure)[:ROWS]
    negative = np.flatnonzero(c.clean)
    model = None
    for _ in range(3):
        order = np.lexsort((-of_sentence[c.pairs[:, 1]], c.pairs[:, 0]))
        witness = c.pairs[order][np.flatnonzero(np.diff(c.pairs[order][:, 0], prepend=-1))][:, 1]
        good = np.unique(np.concatenate([witness, sure]))
        good = np.sort(rng.permutation(good)[:ROWS])
        hard = negative[np.argsort(-of_sentence[negative], kind="stable")[: ROWS // 4]]
        bad = np.unique(np.concatenate([hard, rng.permutation(negative)[: ROWS - len(hard)]]))
        tops, often = np.unique(c.best(value, good), return_counts=True)
        tops = tops[np.argsort(-often, kind="stable")]
        third = LANDMARKS // 3
        # Landmarks: the words that toxic sentences are known by, those of the hardest clean ones, and any.
        usual = np.unique(c.best(value, hard)) if len(hard) else hard
        others = np.unique(np.concatenate([c.term[c.first[k] : c.first[k + 1]] for k in bad.tolist()])) if len(bad) else bad
        marks = [c.words[k] for k in np.concatenate([tops[:third], rng.permutation(usual)[:third], rng.permutation(others)[:third]]).tolist()]
        kernel = Kernel(marks)
        own = kernel(marks)
        eig, vec = np.linalg.eigh((own + own.T) / 2)
        keep = eig > 1e-4 * eig.max()
        root = (vec[:, keep] / np.sqrt(eig[keep])).astype(np.float32)
        # A sentence's features are the sum of its terms'. Its toxic word, also disguised, and the likest harmless ones are sentences of one word besides.
        rows = np.concatenate([good, bad])
        used, at = np.unique(np.concatenate([c.term[c.first[k] : c.first[k + 1]] for k in rows.tolist()]), return_inverse=True)
        z = np.concatenate([kernel([c.words[k] for k in used[i : i + 6000].tolist()]) @ root for i in range(0, len(used), 6000)]).astype(np.float32)
        z = np.add.reduceat(z[at], np.concatenate([[0], np.cumsum((c.first[rows + 1] - c.first[rows]))[:-1]]), axis=0)
        shown = [x for k in tops[: ROWS // 4].tolist() for x in (c.words[k], *_inserted(c.words[k], rng))]
        harmless = [c.words[k] for k in usual.tolist()]
        z = np.concatenate([z, kernel(shown + harmless) @ root]).astype(np.float64)
        target = np.concatenate([np.ones(len(good)), -np.ones(len(bad)), np.ones(len(shown)), -np.ones(len(harmless))])
        cost = np.concatenate([np.ones(len(good) + len(bad)), np.repeat(np.sqrt(np.sort(often)[::-1][: ROWS // 4]), 1 + INSERTED), np.ones(len(harmless))])
        cost[target > 0] *= len(bad) / max(cost[target > 0].sum(), 1e-9) * 0.5
        w, bias = _machine(z, target, cost)
        model = Model(*kernel.table(root @ w), bias)
        value = model.words(c.words)
        of_sentence = np.add.reduceat(value[c.term], c.first[:-1]) + bias
    rest = np.flatnonzero(aside) if 0 < (y[aside] == 1).sum() < aside.sum() else np.arange(len(y))
    f = np.concatenate([model.documents([texts[k] for k in rest[i : i + 200]]) for i in range(0, len(rest), 200)])
    model.calibration = _logistic(f, y[rest].astype(float))
    return model


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model | None:
    """Fit on at most sample different labelled texts of quality.SAMPLE_BYTES together; None if none of them is toxic, or all are."""
    got = quality.training_texts(docs, labels, label, doc_id, text, sample, quality.SAMPLE_BYTES).toArrow().sort_by("text_hash")
    texts, y = [t.encode() for t in got["text"].to_pylist()], np.array(got["y"].to_pylist())
    return fit(texts, y) if 0 < (y == 1).sum() < len(y) else None


def score_toxicity(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """docs with score, 0 to 1, from the whole text."""
    return add_columns(docs, [T.StructField("score", T.DoubleType())], lambda: lambda t: [np.zeros(len(t)) if model is None else model.score(t)], text)
