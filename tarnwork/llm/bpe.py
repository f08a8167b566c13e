"""Byte-level BPE: exact encoding by backtracking over longest matches, decoding by an offset table.

Per pre-token, an Aho-Corasick automaton finds the longest token at every byte. The encoder takes the longest
one and steps back to shorter ones where the pair with the token before it could not stand next to each other
after merging; a sequence whose neighbours are all compatible is the one that merging gives, so each byte is
visited a bounded number of times. Decoding gathers bytes from one blob through an offset table.

Null text counts as empty; empty text gives no ids and an empty decoded text. Texts of any length are encoded
whole. Repeated rows give repeated rows. Columns named ids or decoded are replaced.
"""

from __future__ import annotations

import json

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns

#: Fixed value of the public tokenizer's byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Encoded pre-tokens that a worker remembers, twice: those of late, and the as many before them.
REMEMBERED = 200_000


def _byte_of_char() -> dict[str, int]:
    """The printable stand-in that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteBpe:
    """Tables of one tokenizer file, and the encoder and decoder over them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        char, vocab = _byte_of_char(), spec["model"]["vocab"]
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special = {k.encode(): v for k, v in special.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.words = regex.compile(PATTERN)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        raw = lambda t: bytes(char[c] for c in t)
        # Ranks: the 256 bytes, then one token for each merge in order.
        tokens = [bytes([b]) for b in range(256)]
        rank = {t: r for r, t in enumerate(tokens)}
        self.parts = [(r, r) for r in range(256)]
        self.pairs: dict[tuple[int, int], int] = {}
        for left, right in merges:
            a, b = rank[raw(left)], rank[raw(right)]
            whole = tokens[a] + tokens[b]
            if whole not in rank:
                rank[whole] = len(tokens)
                tokens.append(whole)
                self.parts.append((a, b))
            self.pairs[a, b] = rank[whole]
        id_of = {raw(t): i for t, i in vocab.items() if t not in special}
        self.ids = [id_of[t] for t in tokens]
        self.packed = [np.uint32(i).tobytes() for i in self.ids]
        self.lengths = [len(t) for t in tokens]
        self.automaton = ahocorasick.Automaton()
        for t, r in rank.items():
            self.automaton.add_word(t.decode("latin-1"), r)
        self.automaton.make_automaton()
        self.shorter = [self._longest_proper_prefix(t, rank) for t in tokens]
        # Offset table by id, for decoding.
        by_id = id_of | self.special
        size = max(by_id.values()) + 1
        at = [b""] * size
        for t, i in by_id.items():
            at[i] = t
        self.blob = np.frombuffer(b"".join(at), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum([len(t) for t in at])]).astype(np.int64)
        self.compatible: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    @staticmethod
    def _longest_proper_prefix(token: bytes, rank: dict[bytes, int]) -> int:
        return next((rank[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in rank), -1)

    def _fits(self, a: int, b: int) -> bool:
        """Whether merging leaves a border between tokens a and b when they are neighbours.

        Undo the merges that made both in reverse order; at each moment the two parts at the border must not
        form a merge that ranks before those still to be undone.
        """
        key, parts, pairs, bar, good = a << 20 | b, self.parts, self.pairs, 1 << 62, True
        while True:
            made = pairs.get((a, b))
            if made is not None and made < bar:
                good = False
                break
            # The later of the two merges is undone first; a byte (its own part) can't be undone.
            whole_a, whole_b = parts[a][1] == a, parts[b][0] == b
            if whole_a and whole_b:
                break
            if not whole_a and (a > b or whole_b):
                bar, a = a, parts[a][1]
            else:  # of equal ranks the right token's merge is undone first, as merging goes from the left
                bar, b = b + 1, parts[b][0]
        if len(self.compatible) > 1_000_000:
            self.compatible.clear()
        self.compatible[key] = good
        return good

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ranks of one pre-token's tokens."""
        n, lengths = len(piece), self.lengths
        longest = [-1] * n
        for end, r in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - lengths[r]] = r  # matches come by their end, so the last is the longest
        if lengths[longest[0]] == n:
            return [longest[0]]
        out: list[int] = []
        shut, at, token, last = set(), 0, longest[0], -1
        shorter, seen, fits = self.shorter, self.compatible.get, self._fits
        while at < n:
            end = at + lengths[token]
            good = end not in shut
            if good and last >= 0 and (good := seen(last << 20 | token)) is None:
                good = fits(last, token)
            if good:
                out.append(token)
                at, last = end, token
                token = longest[at] if at < n else -1
            elif shorter[token] >= 0:
                token = shorter[token]
            else:  # no encoding has a border here: the token before gets shorter
                shut.add(at)
                token = out.pop()
                at -= lengths[token]
                last = out[-1] if out else -1
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text as packed 32-bit numbers."""
        packed = []
        for part in self.cut.split(text) if self.cut else [text]:
            if (whole := self.special.get(part.encode())) is not None:
                packed.append(np.uint32(whole).tobytes())
                continue
            pieces = self.words.findall(part)
            got = list(map(self.known.get, pieces))
            if None in got:
                if len(self.known) >= REMEMBERED:
                    self.known, self.before = {}, self.known
                for k, x in enumerate(got):
                    if x is None:
                        got[k] = self._remember(pieces[k])
            packed += got
        return b"".join(packed)

    def _remember(self, piece: str) -> bytes:
        if (x := self.known.get(piece)) is None:
            x = self.before.get(piece)
            if x is None:
                packed = self.packed
                x = b"".join([packed[r] for r in self.encode_piece(piece.encode())])
            if len(piece) <= 64:  # so that what is kept stays small
                self.known[piece] = x
        return x

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of a run of ids, and where each id's bytes end."""
        start = self.offset[ids]
        sizes = self.offset[ids + 1] - start
        ends = np.cumsum(sizes)
        return self.blob[np.repeat(start - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)], ends


_loaded: dict[str, ByteBpe] = {}


def load(path: str) -> ByteBpe:
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def encode_and_decode(df: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """df with the token ids, array<int>, and the decoded string of each whole text.

    tokenizer: path of a byte-level BPE file in the tokenizers library's format, present on every executor.
    """

    def make():
        bpe = load(tokenizer)

        def batch(texts: list[bytes]) -> list[pa.Array]:
            packed = [bpe.encode(t.decode("utf-8", "replace")) for t in texts]
            numbers = np.frombuffer(b"".join(packed), np.uint32).astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int64)
            data, ends = bpe.decode(numbers)
            ends = np.concatenate([[0], ends])[bounds]
            data = data.tobytes()
            texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            return [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(numbers.astype(np.int32))), pa.array(texts, pa.string())]

        return batch

    return add_columns(df, [T.StructField(ids, T.ArrayType(T.IntegerType(), False)), T.StructField(decoded, T.StringType())], make, text)


def digests(df: DataFrame) -> DataFrame:
    """n_tokens and the digests of ids and decoded text."""
    return df.withColumns(
        {
            "n_tokens": F.size("ids").cast("long"),
            "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256),
            "decoded_sha256": F.sha2(F.col("decoded").cast("binary"), 256),
        }
    )
