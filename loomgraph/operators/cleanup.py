"""Finding and marking what does not belong in a graph."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.ontology import PREDICATES, TYPES

#: Fixed: spellings of types and what they should be.
TYPE_FIXES = {"Organization": "Organisation", "organisation": "Organisation", "environmentalIndicator": "EnvironmentalIndicator", "governmentagency": "GovernmentAgency"}


def unknown_type(type_: Column) -> Column:
    """A null type is not selected, as in three-valued logic."""
    return ~type_.isin(*TYPES)


def unknown_relation(rel: Column) -> Column:
    return ~rel.isin(*[p.upper() for p in PREDICATES])


def noise_name(name: Column, words: int | None = None) -> Column:
    """Shorter than four, ASCII small letter in front, a line break, a full stop at the end; with ``words`` also more blank-parted words than that."""
    c = (F.length(name) < 4) | name.rlike("^[a-z]") | name.contains("\n") | name.endswith(".")
    return c if words is None else c | (F.size(F.split(name, " ")) > words)


def fixed_type(type_: Column) -> Column:
    out = type_
    for a, b in TYPE_FIXES.items():
        out = F.when(type_ == a, b).otherwise(out)
    return out


def self_loops(relations: DataFrame) -> DataFrame:
    return relations.filter("src = dst")


def flag(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Adds flagged and flag_reason; a later rule that holds overwrites the reason of an earlier one."""
    reason = F.lit(None).cast("string")
    for name, rule in rules:
        reason = F.when(rule, F.lit(name)).otherwise(reason)
    return df.withColumn("flag_reason", reason).withColumn("flagged", F.col("flag_reason").isNotNull())


def unflag(df: DataFrame, reason: str) -> DataFrame:
    hit = F.coalesce(F.col("flag_reason") == reason, F.lit(False))
    return df.withColumn("flagged", F.col("flagged") & ~hit).withColumn("flag_reason", F.when(~hit, F.col("flag_reason")))


def flagged_counts(df: DataFrame, kind: str) -> DataFrame:
    return df.groupBy(F.lit(kind).alias("kind"), "flagged").agg(F.count("*").alias("cnt"))


def sample(df: DataFrame, keys: list[str], limit: int = 50) -> DataFrame:
    """At most ``limit`` rows to look at, the first by ``keys``; 50 of marked nodes, 20 of new edges are usual."""
    return df.orderBy(*keys).limit(limit)


def run_script(tables: dict[str, DataFrame], steps: list[tuple[str, Callable[[dict[str, DataFrame]], DataFrame]]]) -> dict[str, DataFrame]:
    """Applies steps (name of a table, its new state from all tables) one after the other."""
    now = dict(tables)
    for name, step in steps:
        now[name] = step(now)
    return now
