"""Queries on spelling variants of names: problem 4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import variants
from loomgraph.session import table


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = variants.linked_pairs(variants.groups(table(spark, d, "extractions")))
    return pairs.select(F.col("a").alias("extraction_id_a"), F.col("b").alias("extraction_id_b"))


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    """Rows with the smallest row id of their group, and how many spellings the group has."""
    g = variants.groups(table(spark, d, "extractions"))
    sizes = g.groupBy("group").agg(F.min("row").alias("group_id"), F.count_distinct("name").alias("spellings"))
    return g.join(sizes, "group").select(F.col("row").alias("extraction_id"), "group_id", "spellings")


QUERIES = {f.__name__: f for f in (p4_found, p4_groups)}
SQL: dict[str, str] = {}
