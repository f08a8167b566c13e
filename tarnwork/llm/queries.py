"""Queries opN_<name> over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, mixture, quality, quality_rules, secrets, sharding, simhash, substring_dedup, toxicity
from .common import held_out


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_docs(spark, sf_dir), digest_all=True)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_docs(spark, sf_dir).select("doc_id", "text"))
    return secrets.digests(found).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "scores")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(_docs(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.apply_rules(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_and_decode(_docs(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.digests(encoded).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(_docs(spark, sf_dir))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(_docs(spark, sf_dir))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(_docs(spark, sf_dir))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component_rows")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_exact_dedup, op2_toxicity, op3_secrets, op4_substring_dedup, op5_quality_rules, op6_bpe, op7_mixture, op8_quality, op9_sharding, op10_simhash)}

def _sharding_sql() -> str:
    """CRC-32 by its table over the bytes, and the Feistel rounds and walks as a recursion."""
    table = "range(256)"
    for _ in range(8):
        table = f"list_transform({table}, lambda x: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    keys, rounds, size = [int(k) for k in sharding.Permutation(2).keys], sharding.ROUNDS, "18446744073709551616::UHUGEINT"
    return f"""WITH RECURSIVE c AS (SELECT {table} AS t), l AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda p: CAST('0x' || p AS BIGINT)) AS bytes FROM documents),
d AS (SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(xor(list_reduce(bytes, lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS BIGINT) AS text_crc32 FROM l, c),
n AS (SELECT count(*)::UBIGINT AS n, greatest(1, (length(bin(greatest(1, count(*) - 1))) + 1) // 2)::UBIGINT AS half FROM documents), r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_number FROM documents),
f AS (SELECT doc_id, row_number, n, half, (1::UBIGINT << half) - 1 AS mask, row_number::UBIGINT >> half AS a, row_number::UBIGINT & ((1::UBIGINT << half) - 1) AS b, 0 AS k FROM r, n
UNION ALL SELECT doc_id, row_number, n, half, mask, b, xor(a, xor(z, z >> 31) & mask), k + 1 FROM (SELECT *, CAST(xor(y, y >> 27)::UHUGEINT * 10723151780598845931 % {size} AS UBIGINT) AS z FROM
  (SELECT *, CAST(xor(x, x >> 30)::UHUGEINT * 13787848793156543929 % {size} AS UBIGINT) AS y FROM (SELECT *, xor(b, ({keys}::UBIGINT[])[k % {rounds} + 1]) AS x FROM f WHERE k = 0 OR k % {rounds} > 0 OR (a << half | b) >= n)))),
p AS (SELECT doc_id, row_number, CAST(a << half | b AS BIGINT) AS place FROM f WHERE k > 0 AND k % {rounds} = 0 AND (a << half | b) < n)
SELECT d.doc_id, d.size, d.text_crc32, 'rows' AS law, CAST(place % 16 AS INT) AS shard, place // 16 AS slot, CAST(NULL AS INT) AS grown_shard, row_number FROM d JOIN p ON d.doc_id = p.doc_id"""


ORACLES: dict[str, str] = {
    "op9_sharding": _sharding_sql(),
    "op1_exact_dedup": """WITH g AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size, doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256 FROM g""",
    "op4_substring_dedup": r"""WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d), h AS (SELECT doc_id, i, w[i] AS word, CASE WHEN i + 34 <= len(w) THEN md5(array_to_string(w[i:i + 34], ' ')) END AS k FROM p),
f AS (SELECT doc_id, i, word, CASE WHEN k IS NOT NULL AND count(*) OVER (PARTITION BY k) > 1 THEN 1 ELSE 0 END AS again FROM h),
g AS (SELECT doc_id, i, word, sum(again) OVER (PARTITION BY doc_id ORDER BY i ROWS 34 PRECEDING) > 0 AS gone FROM f),
a AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept FROM g GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN a ON d.doc_id = a.doc_id""".replace("\\\\", "\\"),
    "op7_mixture": r"""WITH z AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size, md5(coalesce('s' || source, 'null') || ':' || coalesce('i' || doc_id, 'null') || ':' || md5(coalesce(text, ''))) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM z GROUP BY source), r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s), w AS (SELECT *, [1.0::DOUBLE, 2.0, 3.0][rank % 3 + 1] AS weight FROM r),
l AS (SELECT *, 3 * source_size / weight AS level FROM w), t AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS total, CAST(coalesce(sum(3 * source_size) OVER b, 0) AS DOUBLE) AS filled, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS free FROM l WINDOW b AS (ORDER BY level, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
h AS (SELECT arg_min((total - filled) / free, (level, rank)) AS held FROM t WHERE (total - filled) / free < level),
g AS (SELECT source, source_size, rank, weight, least(3 * CAST(source_size AS DOUBLE), coalesce(held, level) * weight) AS target FROM t LEFT JOIN h ON true),
c AS (SELECT z.doc_id, z.size, g.source_size, g.target, g.rank, CAST(coalesce(sum(z.size) OVER (PARTITION BY g.rank ORDER BY z.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before, CASE WHEN g.source_size > 0 THEN CAST(floor(g.target / g.source_size) AS BIGINT) ELSE 0 END AS passes FROM z JOIN g ON z.source IS NOT DISTINCT FROM g.source),
e AS (SELECT *, passes * size + least(greatest(CAST(round(target - passes * source_size) AS BIGINT) - before, 0), size) AS taken, [1.5::DOUBLE, 1.0, 0.5][rank % 3 + 1] AS a, [0.5::DOUBLE, 1.0, 1.5][rank % 3 + 1] AS b, CASE WHEN target > 0 THEN least(before / target, 1.0) END AS share FROM c)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken, CASE WHEN taken > 0 THEN share * (a + b) / (a + sqrt(a * a + share * (b * b - a * a))) END AS position FROM e""",
}
