"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def exact(rows):
    """keep_id and size by normalised text."""
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(UPPER), []).append(i)
    return {k: (max((i for i in v if i is not None), default=None), len(v)) for k, v in groups.items()}


def repeats(texts, window=35):
    """(n_words, n_removed, sha of what stays) for each text."""
    lists, count, out = [words(t) for t in texts], Counter(), []
    for w in lists:
        count.update(tuple(w[k : k + window]) for k in range(len(w) - window + 1))
    for w in lists:
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = True
        out.append((len(w), int(gone.sum()), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def measures(text):
    text = text or ""
    w = words(text)
    count, gone = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7)), np.zeros(len(w), bool)
    for k in range(len(w) - 7):
        if count[tuple(w[k : k + 8])] > 1:
            gone[k : k + 8] = True
    lines = [x for x in text.split("\n") if words(x)]
    n = int(gone.sum())
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), n, len(w) < 20 or 100 * n > 30 * len(w)


def fingerprint(text, shingle=3):
    w = words((text or "").translate(UPPER))
    grams = [" ".join(w[k : k + shingle]) for k in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, radius=3):
    """Component number of each fingerprint, by comparing all pairs."""
    p, label = np.array(prints, np.uint64), np.arange(len(prints))
    changed = True
    near = [np.flatnonzero(np.bitwise_count(p ^ x) <= radius) for x in p]
    while changed:
        changed = False
        for k, n in enumerate(near):
            low = label[n].min()
            if (label[n] != low).any():
                label[n], changed = low, True
    return label


def base_secrets(text):
    text, out = text or "", []
    for k, (kind, pattern, group, least) in enumerate([
        ("assign", re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8), ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
    ]):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text) if len(m[group]) >= least]
    return [s for _, _, s in sorted(out)]
