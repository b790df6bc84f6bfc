"""Shared pieces of the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lines_of(c: Column) -> Column:
    """Lines between line feeds, empty ones included; null stays null."""
    return F.split(c, "\n", -1)


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Arrow batches through ``fn``; a batch without rows to give gives none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                out = fn(pdf)
                if len(out):
                    yield out

    return df.mapInPandas(run, schema)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if its scan has fewer parts than there are cores (a table of one small file).

    A large table has more parts than that and is left as it is; so is whatever has been shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    return df.repartition(cores) if df._jdf.toJavaRDD().getNumPartitions() < cores else df
