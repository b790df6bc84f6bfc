"""Queries on personal information: problem 10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import personal
from loomgraph.session import table


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return personal.spans(table(spark, d, "documents")).select(F.col("doc").alias("doc_id"), "start_pos", "kind").distinct()


def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    return personal.redact(table(spark, d, "documents")).withColumnRenamed("doc", "doc_id")


QUERIES = {f.__name__: f for f in (p10_found, p10_redacted)}
SQL: dict[str, str] = {}
