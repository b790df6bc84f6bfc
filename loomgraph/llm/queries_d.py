"""Queries on markup residue: problem 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import markup
from loomgraph.session import table


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").filter("content_type = 'text'")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.found(_texts(spark, d)).withColumnRenamed("doc", "chunk_id")


def p7_clean(spark: SparkSession, d: str) -> DataFrame:
    return markup.clean(_texts(spark, d)).withColumnRenamed("doc", "chunk_id")


def p7_labels(spark: SparkSession, d: str) -> DataFrame:
    """Blocks by label, and how many of them hold markup."""
    b = markup.blocks(_texts(spark, d))
    return b.groupBy("label").agg(F.count("*").alias("blocks"), F.count_if(F.size("kinds") > 0).alias("marked"))


QUERIES = {f.__name__: f for f in (p7_found, p7_clean, p7_labels)}
SQL: dict[str, str] = {}
