"""Quality rules with risk-controlled thresholds. Native.

Each document gets a few measures. Per stratum (documents of similar length) and rule, cutoffs are tried from the most
lenient to the strictest on different texts of labelled good documents; a cutoff is certified when the exact binomial
probability of so few false rejections, if the true rate were RULE_RISK, is below CONFIDENCE_MISS shared equally among
all strata and rules (Bonferroni), and the first one that is not certified ends the sequence (so trying many costs no
confidence).
Rates of rules add up, so all rules together reject at most RISK of a stratum's good documents, with that confidence.
Of the certified cutoffs the most lenient one that rejects nearly as many labelled bad documents as the strictest is
taken; a stratum with too few labels gets no cutoff and rejects nothing.

Null and blank texts have all measures zero and fail the base rule (fewer than 20 words). Rows are judged each on its
own, so repeated rows agree. Very long texts are measured whole. Empty tables give no rows; without labels only the
base rule holds. Only the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, UPPER, Scratch, held_out, text_or_empty, word_array

RISK = 0.05
CONFIDENCE_MISS = 0.05
#: Upper ends of the strata, in words.
STRATA = (100, 400)
REPEAT_WINDOW = 8
#: Cutoffs of the rules, in percent, from lenient to strict.
CUTOFFS = (90, 80, 70, 60, 50, 45, 40, 35, 30, 25, 20, 17, 14, 12, 10, 8, 7, 6, 5, 4, 3)
_RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "shouting": ("n_upper", "word_chars"),
    "marks": ("n_marks", "word_chars"),
    "lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def measures(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash and the measures of each row of df, from array functions alone."""
    k = REPEAT_WINDOW
    at = lambda a, i: F.get(a, i)
    body = df.select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(f"`{text}`").alias("text"))
    lined = body.select("*", word_array(F.col("text")).alias("words"), F.filter(F.split("text", "\n"), lambda x: F.translate(x, SPACES, "") != "").alias("lines"))
    counted = lined.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "words", F.size("words").cast("long").alias("n_words"),
        _without(F.col("text"), SPACES).cast("long").alias("word_chars"),
        (F.length("text") - _without(F.col("text"), "#*$%&|<>")).cast("long").alias("n_symbols"),
        (F.length("text") - _without(F.col("text"), UPPER)).cast("long").alias("n_upper"),
        (F.length("text") - _without(F.col("text"), "!?")).cast("long").alias("n_marks"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    # Hashes of words, put together to those of runs of 2, 4 and 8 words: windows of REPEAT_WINDOW, a power of two.
    hashed, run = counted.withColumn("windows", F.when(F.col("n_words") >= k, F.transform("words", lambda x: F.xxhash64(x)))).drop("words"), 1
    while run < k:
        apart = run
        hashed = hashed.withColumn("windows", F.transform("windows", lambda x, i: F.xxhash64(x, at(F.col("windows"), i + apart))))  # noqa: B023
        run *= 2
    hashed = hashed.withColumn("windows", F.slice("windows", F.lit(1), F.greatest(F.col("n_words").cast("int") - (k - 1), F.lit(0))))
    # Windows found twice: sort them with their places, and keep those with an equal neighbour.
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = hashed.withColumn("sorted", F.when(again, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("windows")
    twin = lambda x, i: F.coalesce(at(F.col("sorted"), i + 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.when(i > 0, at(F.col("sorted"), i - 1)["h"]) == x["h"], F.lit(False))
    found = ordered.withColumn("places", F.sort_array(F.transform(F.filter("sorted", twin), lambda x: x["i"]))).drop("sorted")
    fresh = F.transform("places", lambda p, i: F.least(F.lit(k), F.coalesce(at(F.col("places"), i + 1) - p, F.lit(k))))
    covered = F.aggregate(fresh, F.lit(0).cast("long"), lambda a, x: a + x)
    return found.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("places")


def _stratum() -> Column:
    return F.size(F.filter(F.array(*map(F.lit, STRATA)), lambda x: F.col("n_words") >= x))


def _percent(rule: str) -> Column:
    part, whole = _RULES[rule]
    return F.when(F.col(whole) > 0, 100.0 * F.col(part) / F.col(whole)).otherwise(0.0)


def at_most(k: int, n: int, rate: float) -> float:
    """Probability of k or fewer of n, exactly."""
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(rate) + (n - i) * math.log1p(-rate) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))


def select_cutoffs(measured: DataFrame, labels: DataFrame, label: str = "quality", risk: float = RISK, miss: float = CONFIDENCE_MISS) -> dict[tuple[int, str], float]:
    """Certified cutoffs by stratum and rule, from labelled documents that are not held out."""
    known = labels.filter(~held_out("doc_id")).groupBy("doc_id").agg(F.min(label).alias("good")).filter("good is not null")
    rules = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), _percent(r).alias("value")) for r in _RULES)))
    # Copies are one trial: the exact tests take rows to be drawn independently.
    named = measured.join(known, "doc_id").filter("n_words >= 20").drop("doc_id")
    by_text = [F.first(c).alias(c) for c in named.columns if c not in ("text_hash", "good")]  # alike for equal texts
    rows = named.groupBy("text_hash").agg(F.min("good").alias("good"), *by_text).select(_stratum().alias("stratum"), "good", rules.alias("r"))
    above = F.size(F.filter(F.array(*map(F.lit, CUTOFFS)), lambda c: F.col("r.value") > c)).alias("above")
    # At most strata * rules * cutoffs * 2 rows.
    histogram = rows.groupBy("stratum", F.col("r.rule").alias("rule"), above, (F.col("good") == 1).alias("good")).count().collect()
    cells: dict[tuple[int, str], dict[bool, list[int]]] = {}
    for stratum, rule, n_above, good, n in histogram:
        cells.setdefault((stratum, rule), {True: [0] * (len(CUTOFFS) + 1), False: [0] * (len(CUTOFFS) + 1)})[good][n_above] += n
    tests, out = (len(STRATA) + 1) * len(_RULES), {}
    for cell, counts in cells.items():
        n = sum(counts[True])
        # CUTOFFS fall, so a value above m of them is above the last m: cutoff number c rejects values with m >= len - c.
        rejected = lambda good, c: sum(counts[good][len(CUTOFFS) - c :])  # noqa: B023, E731
        certified = []
        for c in range(len(CUTOFFS)):
            if n == 0 or at_most(rejected(True, c), n, risk / len(_RULES)) > miss / tests:
                break
            certified.append(c)
        if certified and (most := rejected(False, certified[-1])):
            out[cell] = float(CUTOFFS[next(c for c in certified if rejected(False, c) >= 0.98 * most)])
    return out


def judged(measured: DataFrame, cutoffs: dict[tuple[int, str], float]) -> DataFrame:
    """measured with base_failed and kept."""
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    over = F.lit(False)
    for (stratum, rule), cutoff in sorted(cutoffs.items()):
        over = over | ((_stratum() == stratum) & (_percent(rule) > cutoff))
    return measured.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & ~over)


def apply_rules(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Measures and verdict of each row of df."""
    measured = Scratch(df.sparkSession).write(measures(df, doc_id, text))
    return judged(measured, select_cutoffs(measured, labels))
