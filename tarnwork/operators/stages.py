"""Stages of the ingestion as DataFrame transformations: claim, verify, extract, assemble, chunk, embed, status."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import keys, models, text
from ..functions.resilience import ERROR, captured
from ..plans.ship import ship
from .tables import chunk_id, embedding_id, first_of

CHUNK_SIZE, CHUNK_OVERLAP = 800, 100
METADATA = ("doc_id", "doc_hash", "doc_name", "s3_url", "doc_type", "knowledge_base_type")


def pending(documents: DataFrame, knowledge_base: str | None = None) -> DataFrame:
    rows = documents.filter(F.col("status") == "NEW")
    return rows.filter(F.col("knowledge_base_type") == knowledge_base) if knowledge_base else rows


def claim(documents: DataFrame, knowledge_base: str | None = None, most: int = 1) -> DataFrame:
    """The oldest pending documents (ties by doc_id), their metadata only. One driver owns the queue."""
    return pending(documents, knowledge_base).orderBy("created_at", "doc_id").limit(most).select(F.col("doc_id").cast("string").alias("doc_id"), *METADATA[1:])


def verified(documents: DataFrame) -> DataFrame:
    """documents (with content, doc_hash, doc_type) with error: unknown type, missing content, or another hash than stated."""
    error = lambda message: F.struct(F.lit("ValueError").alias("type"), message.alias("message"), F.lit("select_parser").alias("failed_node"), F.lit(False).alias("retryable"))
    missing = F.struct(F.lit("FileNotFoundError").alias("type"), F.concat(F.lit("no object at "), F.coalesce("s3_url", F.lit("null"))).alias("message"), F.lit("select_parser").alias("failed_node"), F.lit(False).alias("retryable"))
    same = F.lower(F.sha2(F.col("content"), 256)) == F.lower("doc_hash")
    return documents.withColumn(
        "error",
        F.when(~F.coalesce(F.col("doc_type").isin(*keys.DOC_TYPES), F.lit(False)), error(F.concat(F.lit("unsupported doc_type: "), F.coalesce("doc_type", F.lit("null")))))
        .when(F.col("content").isNull(), missing)
        .when(~F.coalesce(same, F.lit(False)), error(F.lit("content hash differs from doc_hash"))).cast(ERROR),
    )


def extract(documents: DataFrame, bucket: str = "documents") -> DataFrame:
    """doc_id, blocks (block_no, page, section, text), images (page, image_index, url, content), error: one row a document.

    documents has doc_id, doc_type, knowledge_base_type, content and error; rows with an error pass through.
    """
    ship(documents.sparkSession)
    schema = f"doc_id string, blocks array<struct<block_no:int,page:int,section:string,text:string>>, images array<struct<page:int,image_index:int,url:string,content:binary>>, error {ERROR}"

    def run(frames):
        from ..sources.extract import EXTRACTORS, Extracted

        for f in frames:
            out = []
            for doc, kind, kb, content, error in zip(f.doc_id, f.doc_type, f.knowledge_base_type, f.content, f.error):
                if error is not None:
                    out.append((doc, [], [], error))
                    continue
                prefix = f"s3://{bucket}/raw/{keys.KNOWLEDGE_BASES.get(kb, 'unknown')}/images/{doc}"
                got = Extracted(lambda page, index, ext, prefix=prefix: f"{prefix}/{page}_{index}.{ext}")
                try:
                    EXTRACTORS[kind](bytes(content), got)
                    blocks = [{"block_no": k, "page": p, "section": s, "text": t} for k, (p, s, t) in enumerate(got.blocks)]
                    images = [{"page": p, "image_index": i, "url": got.url_of(p, i, ext), "content": data} for p, i, ext, data in got.images]
                    out.append((doc, blocks, images, None))
                except Exception as e:  # errors are data: one bad file fails one document
                    node = {"PDF": "parse_pdf", "DOCX": "parse_docx", "PPT": "parse_pptx", "EXCEL": "parse_excel"}.get(kind, "select_parser")
                    out.append((doc, [], [], captured(e, node)))
            yield pd.DataFrame(out, columns=["doc_id", "blocks", "images", "error"])

    return documents.select(F.col("doc_id").cast("string").alias("doc_id"), "doc_type", "knowledge_base_type", "content", "error").mapInPandas(run, schema)


def blocks_of(extracted: DataFrame) -> DataFrame:
    return extracted.filter("error is null").select("doc_id", F.explode("blocks").alias("b")).select("doc_id", "b.*")


def images_of(extracted: DataFrame) -> DataFrame:
    return extracted.filter("error is null").select("doc_id", F.explode("images").alias("i")).select("doc_id", "i.*")


def assemble(blocks: DataFrame, summaries: DataFrame) -> DataFrame:
    """blocks with image summaries spliced in; documents without images go through unchanged."""
    entry = F.struct(F.concat_ws(":", "page", "image_index").alias("key"), "summary")
    by_doc = summaries.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(entry)).alias("summaries"))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return blocks.join(by_doc, "doc_id", "left").withColumn("text", text.splice(F.col("text"), F.coalesce("summaries", empty))).drop("summaries")


def chunked(blocks: DataFrame, body: str = "text", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, native: bool = False) -> DataFrame:
    """blocks with one row a chunk: chunk_no and content. Blocks without text give no rows; chunks never span blocks.

    Packing runs in Arrow batches over span lengths (about twice as fast as the native fold at sf0.1), or natively.
    """
    ship(blocks.sparkSession)
    spanned = blocks.withColumn("__spans", text.spans(F.coalesce(F.col(body), F.lit(""))))
    if native:
        packed = spanned.withColumn("__ranges", text.pack(F.col("__spans"), size, overlap))
        chunks = text.chunks_of(F.col("__spans"), F.col("__ranges"))
    else:
        packed, chunks = spanned, text.split_text(F.col("__spans"), size, overlap)
    kept = [c for c in blocks.columns if c != body]
    return packed.select(*kept, F.posexplode(chunks).alias("chunk_no", "content")).filter(F.col("content") != "")


def fingerprinted(chunks: DataFrame) -> DataFrame:
    """chunks with normalized_content, chunk_hash, chunk_simhash and chunk_id."""
    ship(chunks.sparkSession)
    norm = chunks.withColumn("normalized_content", text.normalize("content"))
    hashed = norm.withColumn("chunk_hash", text.content_hash(F.col("normalized_content"))).withColumn("chunk_simhash", text.simhash("normalized_content"))
    return hashed.withColumn("chunk_id", chunk_id(F.col("doc_id"), F.col("chunk_hash")))


def distinct_chunks(chunks: DataFrame) -> DataFrame:
    """The first of each document's chunks with one hash."""
    return first_of(chunks, ["doc_id", "chunk_hash"], ["block_no", "chunk_no"])


def embedded(chunks: DataFrame, make: Callable = models.HashingEmbedder, dimension: int = models.DIMENSION) -> DataFrame:
    """doc_id, chunk_id, embedding_id, vector, error of distinct chunks."""
    rows = chunks.select("doc_id", "chunk_id", embedding_id(F.col("chunk_id")).alias("embedding_id"), "content")
    return models.embed(rows, "content", make, dimension=dimension).drop("content")


def outcomes(claimed: DataFrame, errors: DataFrame, chunks: DataFrame, images: DataFrame) -> DataFrame:
    """doc_id, status, chunks (produced), stored (distinct), images, error for each claimed document."""
    counts = chunks.groupBy("doc_id").agg(F.count("*").alias("chunks"), F.countDistinct("chunk_hash").alias("stored"))
    seen = images.groupBy("doc_id").agg(F.count("*").alias("images"))
    first = errors.filter("error is not null").groupBy("doc_id").agg(F.min_by("error", F.col("error.failed_node")).alias("error"))
    rows = claimed.select("doc_id").join(counts, "doc_id", "left").join(seen, "doc_id", "left").join(first, "doc_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.select("doc_id", F.when(F.col("error").isNull(), "EMBEDDED").otherwise("FAILED").alias("status"), zero("chunks"), zero("stored"), zero("images"), "error")


def last_error(error: Column, retry_count: Column) -> Column:
    """JSON of the last error, or null."""
    body = F.struct(error["type"].alias("type"), error["message"].alias("message"), error["failed_node"].alias("failed_node"), retry_count.alias("retry_count"))
    return F.when(error.isNotNull(), F.to_json(body))


def updated(documents: DataFrame, outcome: DataFrame, now: Column | None = None) -> DataFrame:
    """documents with the status, last_error and updated_at of the outcomes."""
    now = F.current_timestamp() if now is None else now
    o = outcome.select("doc_id", F.col("status").alias("__status"), last_error(F.col("error"), F.coalesce("retry_count", F.lit(0)) if "retry_count" in outcome.columns else F.lit(0)).alias("__error"))
    hit = F.col("__status").isNotNull()
    joined = documents.join(o, "doc_id", "left")
    return joined.withColumns({"status": F.coalesce("__status", "status"), "last_error": F.when(hit, F.col("__error")).otherwise(F.col("last_error")), "updated_at": F.when(hit, now).otherwise(F.col("updated_at"))}).select(documents.columns)


def summary(outcome: DataFrame, asked: int) -> DataFrame:
    """One row for a job: status, processed and failed documents, skipped (1 if the queue ran out), counts."""
    ids = lambda s: F.array_sort(F.collect_list(F.when(F.col("status") == s, F.col("doc_id"))))
    return outcome.agg(F.lit("COMPLETED").alias("status"), ids("EMBEDDED").alias("processed"), ids("FAILED").alias("failed"), (F.count("*") < asked).cast("int").alias("skipped"), F.coalesce(F.sum("chunks"), F.lit(0)).alias("chunks"), F.coalesce(F.sum("images"), F.lit(0)).alias("images"))


def sections(lines: DataFrame, group: list[str], order: str, heading: Column, line: Column) -> DataFrame:
    """Lines joined under the last heading before them: group, section, page (counts sections that have text), body.

    Headings without text below them vanish; lines before the first heading are in section-1.
    """
    running = Window.partitionBy(*group).orderBy(order)
    numbered = lines.withColumn("__h", heading).withColumn("__no", F.sum(F.col("__h").cast("int")).over(running))
    label = F.max(F.when(F.col("__h"), line)).over(Window.partitionBy(*group, "__no"))
    body = numbered.withColumn("__label", F.coalesce(F.when(F.col("__no") > 0, label), F.lit("section-1"))).withColumn("__line", line).filter("not __h")
    joined = body.groupBy(*group, "__no").agg(F.first("__label").alias("section"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("__line").alias("t")))), lambda x: x["t"]), "\n").alias("body"))
    return joined.withColumn("page", F.row_number().over(Window.partitionBy(*group).orderBy("__no"))).drop("__no")


def row_blocks(rows: DataFrame, sheet: Column, number: Column, columns: list[str], size: int = 50) -> DataFrame:
    """sheet, block, section, text: rows (numbered from 1 in their sheet) in blocks of so many, as CSV under the header in a table tag."""
    csv = F.array_join(F.array(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), ",")
    grouped = rows.select(sheet.alias("sheet"), number.alias("n"), csv.alias("csv")).groupBy("sheet", F.floor((F.col("n") - 1) / size).alias("block"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "csv"))), lambda x: x["csv"]), "\n")
    made = grouped.agg(F.min("n").alias("a"), F.max("n").alias("b"), body.alias("body"))
    section = F.concat(F.col("sheet").cast("string"), F.lit(":rows-"), F.col("a").cast("string"), F.lit("-"), F.col("b").cast("string"))
    return made.select("sheet", "block", section.alias("section"), text.table_block(F.concat(F.lit(",".join(columns) + "\n"), F.col("body"))).alias("text"))
