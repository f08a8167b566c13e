"""The engine's text functions under names that SQL can use."""

from __future__ import annotations

import itertools
import re

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.ship import ship
from . import text

#: The column functions' patterns, so that SQL and columns agree; a group around the block lets split() keep it.
_PARTS = re.compile(f"(?s)({text.TAG_BLOCK.removeprefix('(?s)')})".replace("\\1", "\\2"))
_STOP = re.compile(rf"(?<=[.!?]){text.SPACE}+")


def _chunks(body: str, size: int, overlap: int) -> list[str]:
    parts = _PARTS.split(body)  # plain, block, its tag, plain, block, ...
    texts, protected = [], []
    for plain, block in itertools.zip_longest(parts[0::3], parts[1::3]):
        own = list(filter(None, map(str.strip, _STOP.split(plain.strip()))))
        texts += own + [block] * (block is not None)
        protected += [False] * len(own) + [True] * (block is not None)
    ranges = text.pack_lengths(list(map(len, texts)), protected, size, overlap)
    return [" ".join(itertools.islice(texts, a, b)) for a, b in ranges]


@F.pandas_udf(T.ArrayType(T.StringType()))
def split_chunks(body: pd.Series, size: pd.Series, overlap: pd.Series) -> pd.Series:
    return pd.Series([None if b is None else _chunks(b, int(n), int(o)) for b, n, o in zip(body, size, overlap)])


@F.pandas_udf(T.LongType())
def text_simhash(body: pd.Series) -> pd.Series:
    return body.map(lambda t: None if t is None else text.simhash_of(text.normalized(t).split()))


def register(spark: SparkSession) -> None:
    """Make normalize_text, text_simhash and split_chunks(text, size, overlap) known to the session's SQL."""
    ship(spark)
    spark.udf.register("normalize_text", text.normalize)
    spark.udf.register("text_simhash", text_simhash)
    spark.udf.register("split_chunks", split_chunks)
