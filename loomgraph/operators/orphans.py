"""Entities without any edge, the chunks that name them, and what a second extraction connects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.graph import Graph, unconnected
from loomgraph.operators.ontology import PREDICATES, TYPES

MIN_TEXT, MIN_CONFIDENCE = 50, 0.6


def orphan_chunks(extractions: DataFrame, triples: DataFrame, chunks: DataFrame, orphans: DataFrame) -> DataFrame:
    """Chunks that name an orphan (``orphans`` has name): names found, triples the chunk had, its text ('' if it is gone)."""
    names = orphans.filter("trim(name) <> ''").select("name").distinct()
    hit = extractions.join(names, "name", "left_semi").groupBy("chunk_id", "doc_id", "filename").agg(F.array_sort(F.collect_set("name")).alias("orphan_entities"))
    n = triples.groupBy("chunk_id").agg(F.count_distinct("triple_id").alias("original_triple_count"))
    t = chunks.groupBy("chunk_id").agg(F.max("text").alias("text"))
    return hit.join(n, "chunk_id", "left").join(t, "chunk_id", "left").select("chunk_id", "doc_id", "filename", "orphan_entities", F.coalesce("original_triple_count", F.lit(0)).alias("original_triple_count"), F.coalesce("text", F.lit("")).alias("text"))


def orphan_report(found: DataFrame, top: int = 10) -> DataFrame:
    """Orphans by file, most first, with how many chunks had no triple and some."""
    g = found.groupBy("filename").agg(F.sum(F.size("orphan_entities")).alias("orphans"), F.count_if(F.col("original_triple_count") == 0).alias("without_triples"), F.count_if(F.col("original_triple_count") > 0).alias("with_triples"))
    return g.orderBy(F.col("orphans").desc(), F.col("filename").asc_nulls_last()).limit(top)


def usable(found: DataFrame, first: int | None = None) -> DataFrame:
    """Chunks worth a second pass: more than ``MIN_TEXT`` characters; the first ``first`` by id."""
    u = found.filter(F.length("text") > MIN_TEXT)
    return u if first is None else u.orderBy("chunk_id").limit(first)


def accepted(triples: DataFrame) -> DataFrame:
    """Triples of a second pass: stricter than the first (exact predicate, capital first letters, both types known)."""
    name = lambda c: (F.length(c) >= 4) & F.col(c).rlike(r"^\p{Lu}")
    return triples.filter((F.col("confidence") >= MIN_CONFIDENCE) & F.col("predicate").isin(*PREDICATES) & name("subject") & name("object") & F.col("subject_type").isin(*TYPES) & F.col("object_type").isin(*TYPES))


def repair_stats(before: Graph, after: Graph, source: str) -> DataFrame:
    """One row: orphans before and after, edges that the pass made."""
    counts = {"orphans_before": unconnected(before), "orphans_after": unconnected(after), "new_edges": after.relations.filter(F.col("source") == source)}
    one = None
    for name, df in counts.items():
        c = df.select(F.lit(name).alias("what")).groupBy("what").agg(F.count("*").alias("n"))
        one = c if one is None else one.unionByName(c)
    return one.agg(*[F.coalesce(F.max(F.when(F.col("what") == n, F.col("n"))), F.lit(0)).alias(n) for n in counts])
