"""Content items to chunks: sections, paragraphs with sentence overlap, tables whole, short neighbours merged.

Texts are cut by array expressions. The merge reads the parts of each document once, in order, and keeps only the length
of the run it is in, so neither memory nor time depends on how many parts a document has or how far its tables lie apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window

from loomgraph.functions import text as T
from loomgraph.functions.ids import chunk_id

MIN_CHUNK = 300


def _paragraphs(body: Column) -> Column:
    """ARRAY<STRUCT<heading, p>>: the paragraphs of a text under their headings; null for null."""
    return F.flatten(F.transform(T.sections(body), lambda s: F.transform(T.paragraphs(s["body"]), lambda p: F.struct(s["heading"].alias("heading"), p.alias("p")))))


def _with_tail() -> Column:
    """ARRAY<STRUCT<h, t>> of column ps of ``_paragraphs``: each text after the first with the overlap in front."""
    return F.transform("ps", lambda x, i: F.struct(x["heading"].alias("h"), F.when(i == 0, x["p"]).otherwise(F.concat_ws(" ", F.nullif(T.overlap_tail(F.get(F.col("ps"), i - 1)["p"]), F.lit("")), x["p"])).alias("t")))


def item_chunks(items: DataFrame) -> DataFrame:
    """(doc_id, filename, seq, part, page_num, section_heading, content_type, text, raw_table) of content items.

    ``items`` has doc_id, filename, seq (its order), page_num, content_type, text, raw_table. Each
    paragraph after an item's first begins with the last two sentences of the one before.
    """
    base = ["doc_id", "filename", "seq", "page_num", "content_type"]
    tables = items.filter("content_type = 'table'").select(*base, F.lit(0).alias("part"), F.lit("").alias("section_heading"), "text", "raw_table")
    texts = items.filter("content_type <> 'table' and text is not null")
    para = texts.select(*base, _paragraphs(F.col("text")).alias("ps"))
    # of an exploded column, unlike an expression, Spark asks beforehand whether it is empty and so parses each text again
    flat = para.select(*base, F.posexplode(_with_tail()).alias("part", "x"))
    out = flat.select(*base, "part", F.col("x.h").alias("section_heading"), F.col("x.t").alias("text"), F.lit(None).cast("array<array<string>>").alias("raw_table"))
    return out.unionByName(tables.select(*out.columns))


def item_sizes(items: DataFrame) -> DataFrame:
    """Adds parts: (section_heading, n) of the chunks that ``item_chunks`` makes of each item, in order, n being the length.

    An item's parts depend on its own row alone, so its text need not go further than this.
    """
    table = F.col("content_type") == "table"
    whole = F.array(F.struct(F.lit("").alias("h"), F.col("text").alias("t")))
    size = lambda x: F.struct(x["h"].alias("section_heading"), F.coalesce(F.length(x["t"]), F.lit(0)).alias("n"))
    para = items.withColumn("ps", _paragraphs(F.when(~table, F.col("text"))))
    return para.withColumn("parts", F.transform(F.when(table, whole).otherwise(_with_tail()), size)).drop("ps")


def _numbered(parts: DataFrame, least: int) -> DataFrame:
    """Adds chunk_index to (doc_id, seq, part, content_type, n, ...): a text run shorter than ``least`` takes in the next text part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, index, size, after_text = object(), 0, 0, False
        for b in batches:
            out = []
            for d, kind, n in zip(*(b.column(c).to_pylist() for c in ("doc_id", "content_type", "n")), strict=True):
                text = kind is not None and kind != "table"
                if d != doc:
                    doc, index, size = d, 0, n
                elif text and after_text and size < least:
                    size += 2 + n
                else:
                    index, size = index + 1, n
                after_text = text
                out.append(index)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int32())], names=[*b.schema.names, "chunk_index"])

    ordered = parts.repartition("doc_id").sortWithinPartitions("doc_id", "seq", "part")
    return ordered.mapInArrow(run, StructType([*parts.schema.fields, StructField("chunk_index", IntegerType())]))


def merged_sizes(parts: DataFrame, least: int = MIN_CHUNK) -> DataFrame:
    """What ``merge_short`` gives for parts of length ``n``, with n_chars in place of the text."""
    first = F.min_by(F.struct("page_num", "section_heading", "content_type"), F.struct("seq", "part")).alias("first")
    runs = _numbered(parts, least).groupBy("doc_id", "chunk_index").agg(first, (F.sum("n") + (F.count("*") - 1) * 2).cast("int").alias("n_chars"))
    return runs.select(chunk_id("doc_id", "chunk_index").alias("chunk_id"), "chunk_index", "doc_id", "first.*", "n_chars")


def merge_short(chunks: DataFrame, least: int = MIN_CHUNK) -> DataFrame:
    """Chunks of a document in order, short text neighbours joined by a blank line; numbered from 0.

    A merged chunk keeps the file name, page and heading of its first part. Tables end a run.
    """
    part = F.struct("seq", "part", "filename", "page_num", "section_heading", "content_type", "text", "raw_table")
    sized = chunks.withColumn("n", F.coalesce(F.length("text"), F.lit(0)))
    # every part adds two characters at least, so a run has few parts
    runs = _numbered(sized, least).groupBy("doc_id", "chunk_index").agg(F.sort_array(F.collect_list(part)).alias("cs"))
    first = F.col("cs")[0]
    return runs.select(
        chunk_id("doc_id", "chunk_index").alias("chunk_id"), "chunk_index", "doc_id", first["filename"].alias("filename"), first["page_num"].alias("page_num"), first["section_heading"].alias("section_heading"),
        first["content_type"].alias("content_type"), F.array_join(F.transform("cs", lambda c: c["text"]), "\n\n").alias("text"), first["raw_table"].alias("raw_table"),
    )


def chunk_items(items: DataFrame, least: int = MIN_CHUNK) -> DataFrame:
    return merge_short(item_chunks(items), least)


def item_order(items: DataFrame) -> DataFrame:
    """Adds seq: by page, text before tables, then as they came (``pos``)."""
    w = Window.partitionBy("doc_id").orderBy("page_num", F.when(F.col("content_type") == "table", 1).otherwise(0), "pos")
    return items.withColumn("seq", F.row_number().over(w))


def document_rollup(items: DataFrame) -> DataFrame:
    return items.groupBy("doc_id").agg(F.max("page_num").alias("page_count"), F.count("*").alias("item_count"), F.count_if(F.col("content_type") == "table").alias("table_count"))


def scanned(pages: DataFrame, least: int = 100) -> DataFrame:
    """(doc_id, scanned): fewer than ``least`` characters a page on average; no page at all is scanned too."""
    return pages.groupBy("doc_id").agg((F.coalesce(F.avg(F.coalesce(F.length("text"), F.lit(0))), F.lit(0.0)) < least).alias("scanned"))


def summary(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("content_type").agg(F.count("*").alias("chunks"), F.count_distinct("section_heading").alias("headings"))
