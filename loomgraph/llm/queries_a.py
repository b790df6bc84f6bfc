"""Queries whose cases have an exact definition: problems 1, 5, 6 and 8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import components, leakage, repeated_lines, splitting
from loomgraph.session import table


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").filter("content_type = 'text'")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    state, _ = repeated_lines.update(None, _texts(spark, d).select("filename", "chunk_id", "text"))
    return state.removable().select(F.col("doc").alias("chunk_id"), "line_no").distinct()


def p1_clean(spark: SparkSession, d: str) -> DataFrame:
    """Every text chunk; those without filename, in which no line is found, as they were."""
    docs = _texts(spark, d).select("filename", "chunk_id", "text")
    state, _ = repeated_lines.update(None, docs)
    return repeated_lines.without_lines(docs.distinct(), state.removable()).select("chunk_id", "text")


def _batches(spark: SparkSession, d: str) -> list[DataFrame]:
    """Rows of before 2021, of 2021 and 2022, and of after, with those of no date in the first."""
    docs = _texts(spark, d).select("filename", "chunk_id", "text", "loaded_at")
    return [docs.filter(c) for c in ("loaded_at < '2021-01-01' or loaded_at is null", "loaded_at >= '2021-01-01' and loaded_at < '2023-01-01'", "loaded_at >= '2023-01-01'")]


def p1_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The lines of p1_found, but from three batches merged one after the other."""
    state = None
    for batch in _batches(spark, d):
        state, _ = repeated_lines.update(state, batch)
    return state.removable().select(F.col("doc").alias("chunk_id"), "line_no").distinct()


def p1_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    """Documents that the last of the three batches makes one rebuild, by source."""
    first, second, third = _batches(spark, d)
    state, _ = repeated_lines.update(None, first.unionByName(second))
    _, rebuild = repeated_lines.update(state, third)
    return rebuild.groupBy(F.col("source").alias("filename")).agg(F.count("*").alias("rebuilt"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    name = F.trim(F.regexp_replace(F.lower("canonical_name"), r"(?U)\s+", " "))
    rows = table(spark, d, "canonical_map").select("map_id", F.col("canonical_id").alias("cid"), name.alias("cname"))
    g = components.group_rows(rows, "map_id", [["cid"], ["cname"]])
    return g.select(F.col("node").alias("map_id"), F.col("group").alias("group_id"))


def p5_sizes(spark: SparkSession, d: str) -> DataFrame:
    return p5_found(spark, d).groupBy("group_id").agg(F.count("*").alias("n")).groupBy(F.col("n").alias("size")).agg(F.count("*").alias("groups"))


def p6_pieces(spark: SparkSession, d: str) -> DataFrame:
    big = _texts(spark, d).filter(F.length("text") > splitting.LIMIT).select("chunk_id", "section_heading", "text").distinct()
    return splitting.split_texts(big)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_pieces(spark, d).filter("piece_no = 2").select("chunk_id").distinct()


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))


def p8_clean(spark: SparkSession, d: str) -> DataFrame:
    out = leakage.decontaminate(table(spark, d, "documents"), table(spark, d, "eval_items"))
    return out.withColumnRenamed("doc", "doc_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_clean, p1_incremental, p1_rebuilt, p5_found, p5_sizes, p6_found, p6_pieces, p8_found, p8_clean)}

_WS = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_P1 = rf"""with t as (select distinct filename, chunk_id, text from chunks where content_type = 'text' and filename is not null and chunk_id is not null),
  l as (select filename, chunk_id, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) line_no from t where text is not null),
  k as (select filename, chunk_id, line_no, trim(regexp_replace(regexp_replace(lower(line), '\p{{Nd}}+', '0', 'g'), '{_WS}', ' ', 'g')) k from l where length(regexp_replace(line, '[^\p{{L}}]', '', 'g')) >= 10),
  n as (select filename, count(distinct chunk_id) total from t group by 1),
  bad as (select filename, k from k join n using (filename) group by filename, k, total having count(distinct chunk_id) >= 5 and count(distinct chunk_id) >= 0.2 * total),
  found as (select distinct filename, chunk_id, cast(line_no as int) line_no from k join bad using (filename, k))"""
_P5 = rf"""with recursive r as (select distinct map_id, canonical_id c, trim(regexp_replace(lower(canonical_name), '{_WS}', ' ', 'g')) n from canonical_map where map_id is not null),
  e as (select map_id a, min(map_id) over (partition by c) b from r where c is not null union select map_id, min(map_id) over (partition by n) from r where n is not null),
  s as (select a, b from e where a <> b union select b, a from e where a <> b),
  reach(a, b) as (select map_id, map_id from r union select reach.a, s.b from reach join s on reach.b = s.a),
  g as (select a as map_id, min(b) as group_id from reach group by a)"""
_P8 = r"""with grams as (select id, kind, array_to_string(w[i:i + 11], ' ') g from (
    select id, kind, w, unnest(generate_series(1, len(w) - 11)) i from (
      select item_id id, 'i' kind, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') w from eval_items
      union all select doc_id, 'd', regexp_extract_all(lower(text), '[\p{L}\p{N}]+') from documents)))
  select distinct d.id as doc_id, i.id as item_id from grams d join grams i on d.g = i.g and d.kind = 'd' and i.kind = 'i'"""
SQL = {
    "p1_found": _P1 + " select distinct chunk_id, line_no from found",
    "p1_clean": _P1
    + ", gone as (select chunk_id, list(distinct line_no) g from found group by 1), u as (select distinct filename, chunk_id, text from chunks where content_type = 'text') select distinct chunk_id, text from (select filename, u.chunk_id, case when g is null then text else coalesce(array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: not list_contains(g, i)), chr(10)), '') end as text from u left join gone using (chunk_id))",
    "p1_incremental": _P1 + " select distinct chunk_id, line_no from found",
    "p5_found": _P5 + " select map_id, group_id from g",
    "p5_sizes": _P5 + ", c as (select group_id, count(*) n from g group by 1) select n as size, count(*) as groups from c group by 1",
    "p6_found": "select distinct chunk_id from chunks where content_type = 'text' and length(text) > 1500",
    "p8_found": _P8,
}
