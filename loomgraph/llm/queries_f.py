"""Queries on mixtures: problem 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomgraph.llm import mixing
from loomgraph.session import table


#: Vocabulary of a public tokenizer; another file is named by the setting ``loomgraph.tokenizer``.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), spark.conf.get("loomgraph.tokenizer", TOKENIZER))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.actual_shares(p9_mix(spark, d), table(spark, d, "mix_targets"))


QUERIES = {f.__name__: f for f in (p9_mix, p9_shares)}
SQL: dict[str, str] = {}
