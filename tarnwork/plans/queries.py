"""Registry of the engine's own queries over the test tables, and their SQL."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import keys, models, resilience, text
from ..operators import search, stages, tables
from ..streaming.ingest import ingest_stream
from .ship import shared_folder, ship
from .spread import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql:
            ORACLES[fn.__name__] = sql
        return run

    return add


# Queue: the test tables have none, so it is derived from documents and labels, alike on both sides.
_NORM = r"trim(regexp_replace(lower(text), '\s+', ' ', 'g'))"
_SQL_QUEUE = """q AS (SELECT d.doc_id, d.text, d.source, ['Maintenance','Construction','BusinessIntelligence'][1 + CAST(substr(d.source, 4) AS INT) % 3] AS kb,
  ['PDF','EXCEL','PPT','DOCX'][1 + d.doc_id % 4] AS doc_type, CASE WHEN l.doc_id IS NULL THEN 'NEW' WHEN l.quality = 0 THEN 'FAILED' ELSE 'EMBEDDED' END AS status,
  TIMESTAMP '2024-01-01' + to_seconds(d.doc_id) AS created_at FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def queue(read) -> DataFrame:
    pick = lambda values, n: F.element_at(F.array(*map(F.lit, values)), n.cast("int") + 1)
    labels = read("labels").select(F.col("doc_id").alias("l_id"), "quality")
    d = read("documents").join(labels, F.col("doc_id") == F.col("l_id"), "left")
    return d.select(
        "doc_id", "text", "source",
        pick(keys.KNOWLEDGE_BASES, F.substring("source", 4, 10).cast("int") % 3).alias("knowledge_base_type"),
        pick(keys.DOC_TYPES[:1] + ("EXCEL", "PPT", "DOCX"), F.col("doc_id") % 4).alias("doc_type"),
        F.when(F.col("l_id").isNull(), "NEW").when(F.col("quality") == 0, "FAILED").otherwise("EMBEDDED").alias("status"),
        F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00")) + F.col("doc_id")).alias("created_at"),
    )


# Text functions.


@_query(f"SELECT doc_id, sha256({_NORM}) AS chunk_hash, length({_NORM}) AS n FROM documents")
def normalize_hash(read, spark, sf_dir):
    d = read("documents").select("doc_id", text.normalize("text").alias("norm"))
    return d.select("doc_id", text.content_hash(F.col("norm")).alias("chunk_hash"), F.length("norm").cast("long").alias("n"))


@_query(f"SELECT doc_id, sha256({_NORM}) AS chunk_hash FROM documents")
def normalize_hash_native(read, spark, sf_dir):
    return read("documents").select("doc_id", text.content_hash(text.normalize_native(F.col("text"))).alias("chunk_hash"))


_SQL_PIECES = r"""p AS (SELECT doc_id, lang, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x, chr(32) || chr(10))), lambda x: x <> '') AS spans FROM documents)"""


@_query(f"WITH {_SQL_PIECES} SELECT doc_id, len(spans) AS n_spans, CAST(list_sum(list_transform(spans, lambda x: length(x))) AS BIGINT) AS chars, md5(array_to_string(spans, '|')) AS digest FROM p")
def sentence_spans(read, spark, sf_dir):
    d = read("documents").select("doc_id", text.sentences(F.col("text")).alias("s"))
    return d.select("doc_id", F.size("s").cast("long").alias("n_spans"), F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("chars"), F.md5(F.array_join("s", "|")).alias("digest"))


# Packing as a recursion over span numbers: sums[k] is the length of the first k - 1 spans with a space after each.
_SQL_CHUNKS = f"""{_SQL_PIECES}, w AS (SELECT doc_id, lang, spans, list_prepend(0::HUGEINT, list_transform(spans, lambda x, i: list_sum(list_transform(spans[1:i], lambda y: length(y) + 1)))) AS sums FROM p WHERE len(spans) > 0),
r AS (SELECT doc_id, 1 AS i, 1 AS s, NULL::INT AS a, NULL::INT AS b FROM w
  UNION ALL SELECT doc_id, i + 1, CASE WHEN over THEN s + len(list_filter(sums[s:i - 1], lambda v: sums[i] - v > 100)) ELSE s END, CASE WHEN over THEN s END, CASE WHEN over THEN i END
  FROM (SELECT r.doc_id, r.i, r.s, w.sums, sums[i + 1] - sums[s] > 800 AND i > s AS over FROM r JOIN w ON r.doc_id = w.doc_id WHERE r.i <= len(w.spans))),
c AS (SELECT doc_id, a, b FROM r WHERE a IS NOT NULL UNION ALL SELECT r.doc_id, r.s, r.i FROM r JOIN w ON r.doc_id = w.doc_id WHERE r.i = len(w.spans) + 1 AND r.s < r.i),
chunks AS (SELECT c.doc_id, w.lang, row_number() OVER (PARTITION BY c.doc_id ORDER BY c.a, c.b) - 1 AS chunk_no, array_to_string(w.spans[c.a:c.b - 1], ' ') AS content FROM c JOIN w ON c.doc_id = w.doc_id),
hashed AS (SELECT *, sha256(trim(regexp_replace(lower(content), '\\s+', ' ', 'g'))) AS chunk_hash FROM chunks)"""


def _chunks(read, native: bool = False) -> DataFrame:
    return stages.chunked(spread(read("documents").select("doc_id", "lang", "text"), "doc_id"), native=native)


def _hashed(read) -> DataFrame:
    return _chunks(read).withColumn("chunk_hash", text.content_hash(text.normalize("content")))


@_query(f"WITH RECURSIVE {_SQL_CHUNKS} SELECT doc_id, chunk_no, length(content) AS n_chars, md5(content) AS digest FROM chunks")
def chunk_documents(read, spark, sf_dir):
    return _chunks(read, native=True).select("doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), F.length("content").cast("long").alias("n_chars"), F.md5("content").alias("digest"))


@_query(f"WITH RECURSIVE {_SQL_CHUNKS} SELECT doc_id, chunk_no, md5(content) AS digest FROM chunks")
def chunk_documents_arrow(read, spark, sf_dir):
    return _chunks(read).select("doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), F.md5("content").alias("digest"))


@_query(f"WITH RECURSIVE {_SQL_CHUNKS} SELECT lang, count(*) AS chunks, count(DISTINCT chunk_hash) AS distinct_chunks, count(DISTINCT doc_id) AS docs, CAST(sum(length(content)) AS BIGINT) AS chars FROM hashed GROUP BY lang")
def chunk_stats(read, spark, sf_dir):
    # Two light aggregations: by hash and document first, so that distinct counts expand only what that leaves.
    per_hash = _hashed(read).groupBy("lang", "chunk_hash", "doc_id").agg(F.count("*").alias("n"), F.sum(F.length("content")).alias("chars"))
    return per_hash.groupBy("lang").agg(F.sum("n").alias("chunks"), F.countDistinct("chunk_hash").alias("distinct_chunks"), F.countDistinct("doc_id").alias("docs"), F.sum("chars").alias("chars"))


@_query(f"WITH RECURSIVE {_SQL_CHUNKS} SELECT doc_id, chunk_hash, min(chunk_no) AS chunk_no, count(*) AS copies FROM hashed GROUP BY doc_id, chunk_hash")
def chunk_dedup(read, spark, sf_dir):
    return _hashed(read).groupBy("doc_id", "chunk_hash").agg(F.min("chunk_no").cast("long").alias("chunk_no"), F.count("*").alias("copies"))


_SQL_SIMHASH = f"""t AS (SELECT doc_id, ('0x' || substr(md5(token), 17, 16))::UBIGINT AS h FROM (SELECT doc_id, unnest(string_split({_NORM}, ' ')) AS token FROM documents)),
bits AS (SELECT doc_id, b, sum(CASE WHEN (h >> b) & 1 = 1 THEN 1 ELSE 0 END) * 2 > count(*) AS up FROM t, (SELECT unnest(range(63)) AS b) GROUP BY doc_id, b),
s AS (SELECT doc_id, CAST(sum(CASE WHEN up THEN 1::HUGEINT << b ELSE 0 END) AS BIGINT) AS simhash FROM bits GROUP BY doc_id)"""


def _simhashes(read) -> DataFrame:
    return spread(read("documents").select("doc_id", "text"), "doc_id").select("doc_id", text.simhash(text.normalize("text")).alias("simhash"))


@_query(f"WITH {_SQL_SIMHASH} SELECT doc_id, simhash FROM s")
def simhash_docs(read, spark, sf_dir):
    return _simhashes(read)


@_query(f"WITH {_SQL_SIMHASH}, u AS (SELECT min(doc_id) AS id, simhash AS h FROM s GROUP BY simhash) SELECT x.id AS a, y.id AS b, CAST(bit_count(xor(x.h, y.h)) AS INT) AS distance FROM u x JOIN u y ON x.id < y.id WHERE bit_count(xor(x.h, y.h)) <= 3")
def near_dup_simhash(read, spark, sf_dir):
    return search.near_by_simhash(_simhashes(read))


_TAGGED = ("'Intro of ' || page_id || '. See below! <SPEAKER_NOTES>' || url || ' a. b</SPEAKER_NOTES> Tail one. Tail two? <TABLE_REFERENCE id=\"1\">x,y. z</TABLE_REFERENCE> <IMAGE_REFERENCE> open'")


def _tagged(read) -> DataFrame:
    return read("pages").select("page_id", F.concat(F.lit("Intro of "), F.col("page_id").cast("string"), F.lit(". See below! <SPEAKER_NOTES>"), F.col("url"), F.lit(' a. b</SPEAKER_NOTES> Tail one. Tail two? <TABLE_REFERENCE id="1">x,y. z</TABLE_REFERENCE> <IMAGE_REFERENCE> open')).alias("text"))


@_query(rf"""WITH t AS (SELECT page_id, {_TAGGED} AS text FROM pages), m AS (SELECT page_id, text, regexp_extract_all(text, '<SPEAKER_NOTES[^>]*>.*?</SPEAKER_NOTES>|<TABLE_REFERENCE[^>]*>.*?</TABLE_REFERENCE>|<IMAGE_REFERENCE[^>]*>.*?</IMAGE_REFERENCE>') AS tags,
  regexp_replace(text, '<SPEAKER_NOTES[^>]*>.*?</SPEAKER_NOTES>|<TABLE_REFERENCE[^>]*>.*?</TABLE_REFERENCE>|<IMAGE_REFERENCE[^>]*>.*?</IMAGE_REFERENCE>', chr(1), 'g') AS gaps FROM t)
SELECT page_id, len(tags) AS n_protected, array_to_string(tags, '|') AS blocks, len(list_filter(list_transform(string_split_regex(regexp_replace(gaps, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')) AS n_plain FROM m""")
def tag_atomize(read, spark, sf_dir):
    s = _tagged(read).select("page_id", text.spans(F.col("text")).alias("s"))
    tags = F.transform(F.filter("s", lambda x: x["protected"]), lambda x: x["text"])
    return s.select("page_id", F.size(tags).cast("long").alias("n_protected"), F.array_join(tags, "|").alias("blocks"), F.size(F.filter("s", lambda x: ~x["protected"])).cast("long").alias("n_plain"))


# Queue, keys and stored tables.


@_query(f"WITH {_SQL_QUEUE} SELECT CAST(doc_id AS VARCHAR) AS doc_id, doc_type, kb AS knowledge_base_type FROM q WHERE status = 'NEW' ORDER BY created_at, q.doc_id LIMIT 100")
def claim_pending(read, spark, sf_dir):
    return _claimable(read).transform(stages.claim, None, 100).select("doc_id", "doc_type", "knowledge_base_type")


@_query(f"WITH {_SQL_QUEUE} SELECT CAST(doc_id AS VARCHAR) AS doc_id, doc_type, kb AS knowledge_base_type FROM q WHERE status = 'NEW' AND kb = 'Construction' ORDER BY created_at, q.doc_id LIMIT 10")
def claim_by_kb(read, spark, sf_dir):
    return _claimable(read).transform(stages.claim, "Construction", 10).select("doc_id", "doc_type", "knowledge_base_type")


def _claimable(read) -> DataFrame:
    return queue(read).withColumns({"doc_hash": F.lit(None).cast("string"), "doc_name": F.col("source"), "s3_url": F.lit(None).cast("string")})


@_query(f"WITH {_SQL_QUEUE}, f AS (SELECT doc_id, doc_type, sha256(text) AS own, CASE WHEN doc_id % 10 = 3 THEN sha256('other') WHEN doc_id % 10 = 4 THEN upper(sha256(text)) ELSE sha256(text) END AS stated FROM q) SELECT doc_id, own = lower(stated) AS ok FROM f")
def verify_integrity(read, spark, sf_dir):
    content = F.col("text").cast("binary")
    stated = F.when(F.col("doc_id") % 10 == 3, F.sha2(F.lit("other").cast("binary"), 256)).when(F.col("doc_id") % 10 == 4, F.upper(F.sha2(content, 256))).otherwise(F.sha2(content, 256))
    rows = queue(read).withColumns({"content": content, "doc_hash": stated, "s3_url": F.lit("s3://b/k")})
    return stages.verified(rows).select("doc_id", F.col("error").isNull().alias("ok"))


@_query(f"""WITH {_SQL_QUEUE} SELECT doc_id, 'raw/' || lower(kb) || '/documents' AS documents_prefix, 'raw/' || lower(kb) || '/images/' || doc_id || '/4_2.png' AS image_key,
  CASE WHEN doc_id % 7 = 0 THEN NULL ELSE 'bucket' || doc_id % 3 END AS bucket, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE 'raw/' || lower(kb) || '/documents/' || doc_id || '.pdf' END AS key, doc_id % 7 = 0 AS bad FROM q""")
def store_keys(read, spark, sf_dir):
    kb, doc = F.col("knowledge_base_type"), F.col("doc_id").cast("string")
    q = queue(read).withColumn("url", F.when(F.col("doc_id") % 7 == 0, F.lit("https://nope.example.com/x")).otherwise(keys.object_url(F.concat(F.lit("bucket"), (F.col("doc_id") % 3).cast("string")), F.concat(keys.documents_prefix(kb), F.lit("/"), doc, F.lit(".pdf")))))
    u = keys.parse_object_url(F.col("url"))
    return q.select("doc_id", keys.documents_prefix(kb).alias("documents_prefix"), keys.image_key(kb, F.col("doc_id"), F.lit(4), F.lit(2), F.lit("png")).alias("image_key"), u["bucket"].alias("bucket"), u["key"].alias("key"), u["error"].isNotNull().alias("bad"))


# Documents with labels are the stored ones; a source stands for the document whose chunks they are.


@_query(f"WITH h AS (SELECT source AS doc_id, sha256({_NORM}) AS chunk_hash, doc_id AS n FROM documents), stored AS (SELECT doc_id, chunk_hash FROM h WHERE n IN (SELECT doc_id FROM labels)), fresh AS (SELECT doc_id, chunk_hash, min(n) AS n FROM h GROUP BY doc_id, chunk_hash) SELECT doc_id, chunk_hash, n FROM fresh f WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.doc_id = f.doc_id AND s.chunk_hash = f.chunk_hash)")
def insert_if_absent(read, spark, sf_dir):
    h = read("documents").select(F.col("source").alias("doc_id"), text.content_hash(text.normalize(F.col("text"))).alias("chunk_hash"), F.col("doc_id").alias("n"))
    stored = h.join(read("labels").select(F.col("doc_id").alias("n")), "n", "left_semi")
    return tables.absent(tables.first_of(h, ["doc_id", "chunk_hash"], ["n"]), stored, ["doc_id", "chunk_hash"]).select("doc_id", "chunk_hash", "n")


@_query(f"WITH h AS (SELECT doc_id, sha256({_NORM}) AS chunk_hash FROM documents) SELECT h.doc_id, h.chunk_hash, 'stored-' || h.doc_id AS chunk_id FROM h WHERE doc_id IN (SELECT doc_id FROM labels)")
def reconcile_ids(read, spark, sf_dir):
    h = read("documents").select("doc_id", text.content_hash(text.normalize(F.col("text"))).alias("chunk_hash"), F.lit("new").alias("chunk_id"))
    stored = h.join(read("labels").select("doc_id"), "doc_id", "left_semi").withColumn("chunk_id", F.concat(F.lit("stored-"), F.col("doc_id").cast("string")))
    return tables.reconciled(h, stored).select("doc_id", "chunk_hash", "chunk_id")


@_query("SELECT vec_id, label FROM embeddings e WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = e.vec_id)")
def orphan_cleanup(read, spark, sf_dir):
    return tables.orphans_removed(read("embeddings").select(F.col("vec_id").alias("doc_id"), "label"), read("labels")).select(F.col("doc_id").alias("vec_id"), "label")


@_query("SELECT count(*) AS n FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def embedded_semi(read, spark, sf_dir):
    docs = read("documents").filter("lang = 'en'").select(F.col("doc_id").alias("vec_id"))
    return read("embeddings").join(docs, "vec_id", "left_semi").agg(F.count("*").alias("n"))


# Extraction shapes.


@_query("""SELECT page_id, 'See <IMAGE_REFERENCE src="' || url || '" page="1" index="1">' || chr(10) || CASE WHEN page_id % 3 = 0 THEN '[image summary unavailable]' ELSE 'Summary ' || page_id END || chr(10) || '</IMAGE_REFERENCE> and <IMAGE_REFERENCE src="' || url || '" page="2" index="1">'
  || chr(10) || '[image summary unavailable]' || chr(10) || '</IMAGE_REFERENCE> but <IMAGE_REFERENCE src="k" page="1" index="1">kept</IMAGE_REFERENCE>' AS text FROM pages""")
def splice_summaries(read, spark, sf_dir):
    pages = read("pages").select(F.col("page_id").alias("doc_id"), "url")
    first, second = (text.image_placeholder(F.lit(p), F.lit(1), F.col("url")) for p in (1, 2))
    blocks = pages.select("doc_id", F.concat(F.lit("See "), first, F.lit(" and "), second, F.lit(' but <IMAGE_REFERENCE src="k" page="1" index="1">kept</IMAGE_REFERENCE>')).alias("text"))
    summaries = pages.filter("doc_id % 3 != 0").select("doc_id", F.lit(1).alias("page"), F.lit(1).alias("image_index"), F.concat(F.lit("Summary "), F.col("doc_id").cast("string")).alias("summary"))
    return stages.assemble(blocks, summaries).select(F.col("doc_id").alias("page_id"), "text")


@_query("""WITH n AS (SELECT o_orderstatus AS sheet, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS n, o_orderkey || ',' || o_custkey || ',' || o_orderpriority AS csv FROM orders)
SELECT sheet, (n - 1) // 50 AS block, sheet || ':rows-' || min(n) || '-' || max(n) AS section, '<TABLE_REFERENCE>' || chr(10) || 'o_orderkey,o_custkey,o_orderpriority' || chr(10) || string_agg(csv, chr(10) ORDER BY n) || chr(10) || '</TABLE_REFERENCE>' AS text FROM n GROUP BY sheet, (n - 1) // 50""")
def table_blocks_50(read, spark, sf_dir):
    columns = ["o_orderkey", "o_custkey", "o_orderpriority"]
    number = F.row_number().over(Window.partitionBy("o_orderstatus").orderBy("o_orderkey"))
    rows = read("orders").select("o_orderstatus", *columns).withColumn("n", number)
    return stages.row_blocks(rows, F.col("o_orderstatus"), F.col("n"), columns)


@_query("""WITH l AS (SELECT conv_id, turn, role = 'user' AS h, text FROM conversations), n AS (SELECT *, coalesce(sum(h::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), 0) AS g FROM l),
s AS (SELECT conv_id, g, coalesce(max(CASE WHEN h THEN text END), 'section-1') AS section, string_agg(text, chr(10) ORDER BY turn) FILTER (NOT h) AS body FROM n GROUP BY conv_id, g)
SELECT conv_id, section, row_number() OVER (PARTITION BY conv_id ORDER BY g) AS page, body FROM s WHERE body IS NOT NULL""")
def section_grouping(read, spark, sf_dir):
    rows = stages.sections(read("conversations"), ["conv_id"], "turn", F.col("role") == "user", F.col("text"))
    return rows.select("conv_id", "section", F.col("page").cast("long").alias("page"), "body")


# Status and retries.


@_query(f"WITH {_SQL_QUEUE} SELECT kb AS knowledge_base_type, status, count(*) AS n, count(DISTINCT doc_type) AS types FROM q GROUP BY kb, status")
def status_rollup(read, spark, sf_dir):
    return queue(read).groupBy("knowledge_base_type", "status").agg(F.count("*").alias("n"), F.countDistinct("doc_type").alias("types"))


@_query(f"WITH {_SQL_QUEUE} SELECT 'COMPLETED' AS status, CAST(count(*) FILTER (status = 'EMBEDDED') AS BIGINT) AS processed, CAST(count(*) FILTER (status = 'FAILED') AS BIGINT) AS failed, 1 AS skipped FROM q WHERE status <> 'NEW'")
def job_summary(read, spark, sf_dir):
    done = queue(read).filter("status != 'NEW'").select(F.col("doc_id").cast("string").alias("doc_id"), "status", F.lit(0).alias("chunks"), F.lit(0).alias("images"))
    s = stages.summary(done, 1_000_000_000)
    return s.select("status", F.size("processed").cast("long").alias("processed"), F.size("failed").cast("long").alias("failed"), "skipped")


@_query("""WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt FROM events WHERE event_type = 'error')
SELECT event_id, attempt, CASE WHEN attempt - 1 < 3 THEN 'parse_pdf' ELSE 'failure_handler' END AS target, least(30.0, pow(2.0, attempt - 1)) AS pause FROM e""")
def retry_simulation(read, spark, sf_dir):
    attempt = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    e = read("events").filter("event_type = 'error'").select("event_id", "user_id", "ts").withColumn("attempt", attempt)
    return e.select("event_id", "attempt", resilience.route(F.lit(True), F.col("attempt") - 1, F.lit(3), F.lit("parse_pdf")).alias("target"), resilience.backoff(F.col("attempt")).alias("pause"))


@_query("""SELECT event_id, '{"type":"' || event_type || '","message":"user ' || user_id || '","failed_node":"embed_chunks","retry_count":' || event_id % 4 || '}' AS last_error FROM events""")
def last_error_json(read, spark, sf_dir):
    error = F.struct(F.col("event_type").alias("type"), F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("message"), F.lit("embed_chunks").alias("failed_node"))
    return read("events").select("event_id", stages.last_error(error, F.col("event_id") % 4).alias("last_error"))


@_query("SELECT doc_id, 'data:image/png;base64,' || base64(encode(lang || source)) AS url FROM documents")
def image_data_url(read, spark, sf_dir):
    return read("documents").select("doc_id", models.data_url(F.concat("lang", "source").cast("binary")).alias("url"))


# Vectors.


@_query("""WITH s AS (SELECT q.vec_id AS query_id, e.vec_id, round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 9) AS sim FROM embeddings q JOIN embeddings e ON q.vec_id <> e.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rank FROM s) SELECT query_id, vec_id, round(sim, 6) AS sim, rank FROM r WHERE rank <= 10""")
def cosine_topk(read, spark, sf_dir):
    vectors = read("embeddings")
    top = search.cosine_topk(vectors, vectors.filter("vec_id % 20 = 0"), 10)
    return top.select("query_id", "vec_id", F.round("sim", 6).alias("sim"), F.col("rank").cast("long").alias("rank"))


@_query()
def ann_topk(read, spark, sf_dir):
    """The same search through an index of cells: every vector is indexed, a query looks into the nearest 12 of 16 cells (recall 0.9 and more; these vectors are nearly unclustered)."""
    vectors = read("embeddings")
    centres = search.fit_cells(vectors, 16)
    top = search.ann_topk(vectors, vectors.filter("vec_id % 20 = 0"), 10, centres, 12)
    return top.select("query_id", "vec_id", F.round("sim", 6).alias("sim"), F.col("rank").cast("long").alias("rank"))


@_query()
def embed_batches(read, spark, sf_dir):
    chunks = stages.distinct_chunks(stages.fingerprinted(_chunks(read).withColumn("block_no", F.lit(0))))
    return stages.embedded(chunks, dimension=models.DIMENSION).select("doc_id", "chunk_id", "embedding_id", F.size("vector").alias("n"), F.col("error").isNull().alias("ok"))


@_query(f"WITH RECURSIVE {_SQL_CHUNKS} SELECT CAST(doc_id AS VARCHAR) AS doc_id, chunk_hash, min(chunk_no) AS chunk_no FROM hashed GROUP BY doc_id, chunk_hash")
def stream_ingest(read, spark, sf_dir):
    """The stream twice over the same files: the second run finds nothing new, and the table equals a batch run's."""
    top = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    # A stream reads folders; the test tables have documents as one file or as a folder.
    pattern = f"{sf_dir}/documents.parquet*"
    for _ in range(2):
        ingest_stream(spark, pattern, read("documents").schema, f"{top}/chunks", f"{top}/state", 8)
    return spark.read.parquet(f"{top}/chunks").select("doc_id", "chunk_hash", F.col("chunk_no").cast("long").alias("chunk_no"))


# Files: made from the test tables, then read back by the extractors.


def _files(rows: DataFrame, key: str, build, kind: str, kb: str = "Maintenance") -> DataFrame:
    """Files that build(frame) makes for each key, verified and extracted: doc_id, block_no, page, section, text."""

    def one(name, frame):
        import pandas as pd

        return pd.DataFrame({"doc_id": [str(name[0])], "content": [build(frame)]})

    made = rows.groupBy(key).applyInPandas(one, "doc_id string, content binary")
    queued = made.select("doc_id", F.lit(kind).alias("doc_type"), F.lit(kb).alias("knowledge_base_type"), F.sha2("content", 256).alias("doc_hash"), F.lit("s3://documents/f").alias("s3_url"), "content")
    return stages.blocks_of(stages.extract(stages.verified(queued)))


@_query("""WITH l AS (SELECT conv_id, turn, role = 'user' AS h, trim(text, ' ' || chr(10)) AS text FROM conversations WHERE trim(text, ' ' || chr(10)) <> ''), n AS (SELECT *, coalesce(sum(h::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), 0) AS g FROM l),
s AS (SELECT conv_id, g, coalesce(max(CASE WHEN h THEN text END), 'section-1') AS section, string_agg(text, chr(10) ORDER BY turn) FILTER (NOT h) AS body FROM n GROUP BY conv_id, g)
SELECT CAST(conv_id AS VARCHAR) AS doc_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY g) AS INT) AS page, section, body AS text FROM s WHERE body IS NOT NULL""")
def extract_docx(read, spark, sf_dir):
    def build(frame):
        from ..sources import build as make

        f = frame.sort_values("turn")
        return make.docx([(role == "user", t or "") for role, t in zip(f.role, f.text)])

    return _files(read("conversations"), "conv_id", build, "DOCX").select("doc_id", "page", "section", "text")


@_query("""SELECT CAST(conv_id AS VARCHAR) AS doc_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INT) AS page, trim(coalesce(text, ''), ' ' || chr(10)) || CASE WHEN trim(coalesce(text, ''), ' ' || chr(10)) = '' THEN '' ELSE chr(10) END || '<SPEAKER_NOTES>' || role || '</SPEAKER_NOTES>' AS text FROM conversations""")
def extract_pptx(read, spark, sf_dir):
    def build(frame):
        from ..sources import build as make

        f = frame.sort_values("turn")
        return make.pptx([([t or ""], role, []) for role, t in zip(f.role, f.text)])

    return _files(read("conversations"), "conv_id", build, "PPT").select("doc_id", "page", "text")


@_query("""WITH n AS (SELECT o_custkey % 20 AS book, row_number() OVER (PARTITION BY o_custkey % 20 ORDER BY o_orderkey) AS n, o_orderkey || ',' || o_custkey || ',' || o_orderpriority AS csv FROM orders)
SELECT CAST(book AS VARCHAR) AS doc_id, 'orders:rows-' || min(n) || '-' || max(n) AS section, '<TABLE_REFERENCE>' || chr(10) || 'o_orderkey,o_custkey,o_orderpriority' || chr(10) || string_agg(csv, chr(10) ORDER BY n) || chr(10) || '</TABLE_REFERENCE>' AS text FROM n GROUP BY book, (n - 1) // 50""")
def extract_xlsx(read, spark, sf_dir):
    def build(frame):
        from ..sources import build as make

        f = frame.sort_values("o_orderkey")
        return make.xlsx({"orders": [["o_orderkey", "o_custkey", "o_orderpriority"], *f[["o_orderkey", "o_custkey", "o_orderpriority"]].values.tolist()]})

    rows = read("orders").select((F.col("o_custkey") % 20).alias("book"), "o_orderkey", "o_custkey", "o_orderpriority")
    return _files(rows, "book", build, "EXCEL").select("doc_id", "section", "text")


@_query("""SELECT CAST(page_id AS VARCHAR) AS doc_id, 'page-1' AS section, url || chr(10) || 'Page (' || page_id || ')' || CASE WHEN page_id % 2 = 0 THEN chr(10) || '<IMAGE_REFERENCE src="s3://documents/raw/maintenance/images/' || page_id || '/1_1.png" page="1" index="1"></IMAGE_REFERENCE>' ELSE '' END AS text FROM pages""")
def extract_pdf(read, spark, sf_dir):
    def build(frame):
        from ..sources import build as make

        return make.pdf([([frame.url.iloc[0], f"Page ({frame.page_id.iloc[0]})"], frame.page_id.iloc[0] % 2 == 0)])

    return _files(read("pages").select("page_id", "url"), "page_id", build, "PDF").select("doc_id", "section", "text")
