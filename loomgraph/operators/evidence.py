"""Evidence behind a result: nodes and edges of its rows, documents, routing of questions, reports."""

from __future__ import annotations

import re
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fixed: column names of results and the node types they stand for.
NODE_COLUMNS = {"initiative": "Initiative", "division": "Division", "division_a": "Division", "division_b": "Division", "topic_a": "Topic", "topic_b": "Topic", "topic": "Topic", "issue": "Issue"}
WRITE_WORDS = "CREATE MERGE DELETE SET REMOVE DROP DETACH CALL".split()


def nodes_of(rows: DataFrame) -> DataFrame:
    """Distinct (id, type, label) of a result's named columns and of its doc_ids."""
    out = None
    for c, kind in NODE_COLUMNS.items():
        if c in rows.columns:
            n = rows.filter(F.col(c).isNotNull()).select(F.lit(kind).alias("type"), F.col(c).cast("string").alias("label"))
            out = n if out is None else out.unionByName(n)
    if "doc_ids" in rows.columns:
        n = rows.select(F.lit("Document").alias("type"), F.explode(F.transform("doc_ids", lambda x: x.cast("string"))).alias("label"))
        out = n if out is None else out.unionByName(n)
    if out is None:
        out = rows.select(F.lit("").alias("type"), F.lit("").alias("label")).limit(0)
    return out.filter("label <> ''").distinct().select(F.concat_ws(":", "type", "label").alias("id"), "type", "label")


def edges_of(rows: DataFrame) -> DataFrame:
    """Distinct (source, target, type): pairs of topics or divisions of a row, and documents of what they support."""
    out = []
    for a, b, kind in (("topic_a", "topic_b", "CO_OCCURS"), ("division_a", "division_b", "SHARES_LEARNING_WITH")):
        if {a, b} <= set(rows.columns):
            out.append(rows.select(F.concat(F.lit(NODE_COLUMNS[a] + ":"), a).alias("source"), F.concat(F.lit(NODE_COLUMNS[b] + ":"), b).alias("target"), F.lit(kind).alias("type")))
    if "doc_ids" in rows.columns:
        for c, kind in NODE_COLUMNS.items():
            if c in rows.columns:
                out.append(rows.select(F.explode(F.transform("doc_ids", lambda x: F.concat(F.lit("Document:"), x.cast("string")))).alias("source"), F.concat(F.lit(kind + ":"), F.col(c)).alias("target"), F.lit("EVIDENCES").alias("type")))
    if not out:
        return rows.select(F.lit("").alias("source"), F.lit("").alias("target"), F.lit("").alias("type")).limit(0)
    e = out[0]
    for x in out[1:]:
        e = e.unionByName(x)
    return e.filter("source is not null and target is not null").distinct()


def envelope(query_id: str, params: dict, rows: DataFrame, documents: DataFrame, limit: int = 200) -> dict:
    """What stands behind a result, for a reader: at most ``limit`` rows, their nodes, edges and documents (id, title, date)."""
    top = rows.limit(limit)
    got = [r.asDict(recursive=True) for r in top.collect()]
    nodes = [r.asDict() for r in nodes_of(top).collect()]
    ids = sorted({n["label"] for n in nodes if n["type"] == "Document"})
    known = {str(r.id): {"doc_id": str(r.id), "title": r.title, "date": r.date} for r in documents.filter(F.col("id").cast("string").isin(ids)).select("id", "title", "date").collect()} if ids else {}
    return {
        "generated_at": datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"), "query_id": query_id, "parameters": params, "row_count": len(got), "rows": got, "nodes": nodes,
        "edges": [r.asDict() for r in edges_of(top).collect()], "documents": [known.get(i, {"doc_id": i, "title": "Unknown", "date": ""}) for i in ids], "why_these_results": f"Rows of {query_id} and the documents that support them.",
    }


def route(question: str) -> tuple[str, str]:
    """(intent, query id) by the first rule whose words stand in the question. The words and ids are fixed values."""
    q = question.lower()
    for words, intent, query in (
        (("cross", "across division", "multi-division", "between division"), "cross-division", "cross_division_initiatives"),
        (("shared learning",), "shared-learnings", "shared_learnings_between_divisions"),
        (("co-occur", "co occur", "topic"), "topic-cooccurrence", "topic_co_occurrence"),
        (("filing", "metadata", "documentation", "gap"), "filing-health", "filing_health_by_division_time"),
        (("issue", "trend", "over time"), "issues-trend", "recurring_issues_over_time"),
    ):
        if any(w in q for w in words):
            return intent, query
    return "general-explore", "topic_co_occurrence"


def infer_limit(question: str, default: int) -> int:
    """The first number of one to three digits, if it lies between 1 and 500."""
    m = re.search(r"\b(\d{1,3})\b", question)
    return int(m[1]) if m and 1 <= int(m[1]) <= 500 else default


def is_read_only(statement: str) -> bool:
    """No word of the statement changes data; words inside string literals count too."""
    return re.search(rf"\b(?:{'|'.join(WRITE_WORDS)})\b", statement, re.IGNORECASE) is None


def statement_of(reply: str) -> str:
    """The statement in a model's reply: thoughts cut off, fenced block, else from the first MATCH on."""
    r = re.sub(r"(?s)^.*</think>", "", reply)
    r = re.sub(r"(?s)<think>.*$", "", r).strip()
    if m := re.search(r"```(?:\w+)?\s*(.*?)```", r, re.DOTALL):
        return m[1].strip()
    m = re.search(r"\bMATCH\b.*", r, re.DOTALL | re.IGNORECASE)
    return (m[0] if m else r).strip()


def search_term(question: str) -> str:
    """The first word with a capital, else the first thirty characters."""
    return next((w for w in question.split() if w[:1].isupper()), question[:30])


def insights(sections: list[tuple[str, DataFrame]], limit: int = 20) -> str:
    """Markdown report: each section a table of at most ``limit`` rows."""
    out = ["# Insights", ""]
    for title, df in sections:
        out += [f"## {title}", ""]
        rows = df.limit(limit).collect()
        if not rows:
            out += ["No rows.", ""]
            continue
        out += ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
        out += ["| " + " | ".join(", ".join(map(str, v)) if isinstance(v, list) else str(v) for v in r) + " |" for r in rows] + [""]
    return "\n".join(out)


# ---- shapes for showing ----------------------------------------------------------------------------
def as_list(rows: DataFrame, label: str, score: str, *order: str) -> DataFrame:
    """(rank, line) in the order given: ``1. label (score)``."""
    w = Window.orderBy(*[F.col(c) for c in order] or [F.col(score).desc(), F.col(label)])  # rows of a result for a reader, with a limit behind them
    return rows.withColumn("rank", F.row_number().over(w)).select("rank", F.concat_ws("", F.col("rank").cast("string"), F.lit(". "), F.col(label).cast("string"), F.lit(" ("), F.col(score).cast("string"), F.lit(")")).alias("line"))


def as_graph(rows: DataFrame, source: str = "topic_a", target: str = "topic_b", weight: str = "count") -> tuple[DataFrame, DataFrame]:
    """Nodes (id, label) and edges (source, target, label) of rows with both ends."""
    end = lambda c: F.trim(F.col(c).cast("string"))
    e = rows.select(end(source).alias("source"), end(target).alias("target"), F.coalesce(F.col(weight).cast("string"), F.lit("")).alias("label")).filter("source <> '' and target <> ''")
    return e.select(F.explode(F.array("source", "target")).alias("id")).distinct().select("id", F.col("id").alias("label")), e


def as_timeline(rows: DataFrame, x: str = "year", y: str = "doc_count", series: str | None = "division") -> DataFrame:
    """(series, x, y, step): points of each series in order; one series '' where there is none."""
    s = F.coalesce(F.col(series).cast("string"), F.lit("")) if series and series in rows.columns else F.lit("")
    p = rows.select(s.alias("series"), F.col(x).cast("string").alias("x"), F.col(y).cast("double").alias("y"))
    return p.withColumn("step", F.row_number().over(Window.partitionBy("series").orderBy("x", "y")))


def chat_evidence(rows: DataFrame, limit: int = 10) -> DataFrame:
    """(evidence, location) of the first rows with evidence; the columns may bear a prefix ``r.``."""
    pick = lambda c: F.col(c) if c in rows.columns else F.col(f"`r.{c}`") if f"r.{c}" in rows.columns else F.lit(None).cast("string")
    said = rows.select(pick("evidence").cast("string").alias("evidence"), pick("source_doc").cast("string").alias("doc"), pick("source_page").cast("string").alias("page")).filter("trim(evidence) <> ''")
    return said.select("evidence", F.when(F.coalesce(F.col("doc"), F.lit("")) != "", F.concat(F.col("doc"), F.lit(" p."), F.coalesce("page", F.lit("")))).otherwise("").alias("location")).limit(limit)


def highlight(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """Adds ``highlighted``: the edge (source, target) is one of ``pairs`` in either direction."""
    p = pairs.select(F.col("source").alias("_s"), F.col("target").alias("_t"))
    both = p.unionByName(p.select(F.col("_t").alias("_s"), F.col("_s").alias("_t"))).distinct().withColumn("_hit", F.lit(True))
    return edges.join(both, (F.col("source") == F.col("_s")) & (F.col("target") == F.col("_t")), "left").withColumn("highlighted", F.coalesce("_hit", F.lit(False))).drop("_s", "_t", "_hit")


def orphan_text(names: int, chunks: DataFrame, top: int = 10) -> str:
    """The report on chunks with names that have no relation (orphan_entities, original_triple_count, filename)."""
    n = chunks.agg(F.count("*").alias("n"), F.count_if(F.col("original_triple_count") == 0).alias("zero")).first()
    best = chunks.groupBy("filename").agg(F.sum(F.size("orphan_entities")).alias("k")).orderBy(F.desc("k"), F.col("filename").asc_nulls_last()).limit(top).collect()
    rule = "=" * 60
    return "\n".join(["Chunks with unconnected names", rule, f"  names without a relation: {names}", f"  chunks that hold one:     {n.n}", f"    without any triple:     {n.zero}", f"    with some triples:      {n.n - n.zero}", "", f"First {top} files:", *[f"  {r.k:>5}  {r.filename}" for r in best], rule])
