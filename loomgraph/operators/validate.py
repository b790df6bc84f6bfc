"""Cleaning of extracted names and triples (7a) and their check against the ontology (7b)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.ontology import PREDICATES, TYPES, constraints

MIN_EXTRACT_CONFIDENCE, MIN_CONFIDENCE = 0.6, 0.5
#: Beginnings of sentences that are no names.
BOILERPLATE = ["External assurance was not sought", "This report", "The following", "As at", "Not applicable", "See above", "Refer to"]


def name_reason(name: Column) -> Column:
    """The first rule that a name breaks; '' if none."""
    words = F.size(F.filter(F.split(name, r"(?U)\s+"), lambda x: x != ""))
    r = (
        F.when(name.isNull(), "not_a_string").when(F.length(name) < 4, "too_short").when(F.length(name) > 60, "too_long").when(name.rlike(r"^\p{Ll}"), "starts_lowercase")
        .when(words >= 9, "too_many_words").when(name.endswith("."), "ends_with_period").when(name.contains("\n"), "contains_newline")
    )
    for b in sorted(BOILERPLATE):
        r = r.when(name.startswith(b), f"boilerplate:{b[:30]}")
    return r.otherwise("")


def _lit(s: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), s)


def triple_reason(subject: Column, subject_type: Column, predicate: Column, obj: Column, object_type: Column, confidence: Column, types: list[str] = TYPES, predicates: list[str] = PREDICATES) -> Column:
    """The first rule that a triple breaks; '' if none. Empty types pass; null confidence counts as 0."""
    p = F.coalesce(predicate, F.lit(""))
    bad = lambda t: (F.coalesce(t, F.lit("")) != "") & ~t.isin(*types)
    s, o = name_reason(subject), name_reason(obj)
    return (
        F.when(~F.upper(p).isin(*[x.upper() for x in predicates]), _lit(p, "invalid_predicate:")).when(F.coalesce(confidence, F.lit(0.0)) < MIN_EXTRACT_CONFIDENCE, "low_confidence")
        .when(s != "", _lit(s, "bad_subject:")).when(o != "", _lit(o, "bad_object:"))
        .when(bad(subject_type), _lit(subject_type, "invalid_subject_type:")).when(bad(object_type), _lit(object_type, "invalid_object_type:")).otherwise("")
    )


def canonicalise(triples: DataFrame, cmap: DataFrame) -> DataFrame:
    """Subject and object replaced by their canonical name, id and type where the surface is known (surface, canonical_id, canonical_name, type)."""
    out = triples
    for role in ("subject", "object"):
        m = cmap.select(F.col("surface").alias(f"{role}_surface"), F.col("canonical_id").alias("_id"), F.col("canonical_name").alias("_name"), F.col("type").alias("_type"))
        out = out.withColumn(f"{role}_surface", F.trim(role)).join(m, f"{role}_surface", "left")
        out = out.withColumn(role, F.coalesce("_name", f"{role}_surface")).withColumn(f"{role}_canonical_id", F.col("_id")).withColumn(f"{role}_type", F.coalesce("_type", F.col(f"{role}_type"))).drop("_id", "_name", "_type")
    return out


def check(triples: DataFrame, ontology: dict | None = None) -> DataFrame:
    """Adds ontology_valid and violation; the predicate is compared as it is written. Drops low confidence."""
    c = F.broadcast(constraints(triples.sparkSession, ontology))  # one row a predicate of the ontology file
    t = triples.filter(F.coalesce("confidence", F.lit(0.0)) >= MIN_CONFIDENCE).join(c, F.col("predicate") == F.col("rule"), "left")
    known = F.col("rule").isNotNull()
    inside = lambda role, allowed: F.coalesce(F.array_contains(allowed, F.col(f"{role}_type")), F.lit(False))
    s, o = inside("subject", "subjects"), inside("object", "objects")
    says = lambda role: F.concat(F.lit(f"{role.capitalize()} type '"), F.coalesce(f"{role}_type", F.lit("")), F.lit("' not allowed for '"), F.col("predicate"), F.lit("'"))
    text = F.when(~known, F.concat(F.lit("Unknown predicate: '"), F.coalesce("predicate", F.lit("")), F.lit("'"))).when(~(s & o), F.concat_ws("; ", F.when(~s, says("subject")), F.when(~o, says("object"))))
    return t.withColumn("ontology_valid", known & s & o).withColumn("violation", text).drop("rule", "subjects", "objects")


def top_counts(df: DataFrame, what: Column, k: int, name: str = "value") -> DataFrame:
    """The ``k`` most frequent values, ties by value."""
    return df.groupBy(what.alias(name)).agg(F.count("*").alias("cnt")).orderBy(F.col("cnt").desc(), F.col(name).asc_nulls_last()).limit(k)


def emptied(triples: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Keys whose triples all broke a rule (column ``reason``)."""
    return triples.groupBy(key).agg(F.count("*").alias("before"), F.count_if(F.col("reason") == "").alias("after")).filter("after = 0").select(key, "before")


def report(checked: DataFrame, top: int = 20) -> str:
    """Validation report as text, from counts only."""
    n = checked.agg(F.count("*").alias("n"), F.count_if("ontology_valid").alias("ok")).first()
    lines = [f"Triples kept: {n.n}", f"Valid: {n.ok}", f"Flagged: {n.n - n.ok}", ""]
    return "\n".join(lines + [f"{r.cnt:>8}  {r.violation}" for r in top_counts(checked.filter("violation is not null"), F.col("violation"), top, "violation").collect()])
