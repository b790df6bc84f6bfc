"""Queries on damaged pages: problem 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import scanned
from loomgraph.session import table


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").filter("content_type = 'text'")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return scanned.damage(_texts(spark, d))


def p2_clean(spark: SparkSession, d: str) -> DataFrame:
    return scanned.repair(_texts(spark, d))


def p2_kinds(spark: SparkSession, d: str) -> DataFrame:
    return scanned.damage(_texts(spark, d)).groupBy("kind").agg(F.count("*").alias("lines"))


QUERIES = {f.__name__: f for f in (p2_found, p2_clean, p2_kinds)}
SQL: dict[str, str] = {}
