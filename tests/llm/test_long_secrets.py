"""Keys inside long runs of token characters."""

import random

from tarnwork.llm import secrets

WORDS = ["build", "artifacts", "shared", "releases", "current", "public", "assets", "images", "reports", "archive", "storage", "backup"]


def runs(n, key):
    """Paths of over 100 characters that hold digits; with a key in the middle, or without."""
    r = random.Random(9)
    path = lambda: "/".join(r.choice(WORDS) for _ in range(7))
    chars = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    for _ in range(n):
        yield f"{path()}/{''.join(r.choice(chars) for _ in range(32)) + '/' if key else ''}{path()}-{r.randint(1, 9)}"


def found(spark, texts):
    rows = secrets.find_secrets(spark.createDataFrame([(f"see {t} there",) for t in texts], "text string")).collect()
    return [any(s["kind"] == "model" and s["start"] <= 4 and s["end"] >= 4 + len(t) for s in r["spans"]) for r, t in zip(rows, texts)]


def test_key_in_the_middle(spark):
    with_key, without = list(runs(60, True)), list(runs(60, False))
    assert min(map(len, with_key)) > 100
    assert sum(found(spark, with_key)) >= 57
    assert sum(found(spark, without)) <= 3
