"""Queries over the agency tables: canonical documents, blank rates, the labelled graph, payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.operators import agency as A
from loomgraph.session import table

#: Canonical column: column of the raw table.
DOCUMENTS = {"doc_id": "doc_ref", "title": "headline", "text": "body_text", "division": "division_name", "date": "filed_on", "doc_type": "doc_kind", "source_uri": "source_uri"}


def _documents(s: SparkSession, d: str) -> DataFrame:
    raw = table(s, d, "agency_documents")
    return A.canonical_documents(raw, DOCUMENTS, F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def _graph(s: SparkSession, d: str) -> A.Agency:
    docs = _documents(s, d)
    ini = table(s, d, "agency_initiatives").groupBy(F.col("init_code").alias("initiative_id")).agg(F.min("initiative_name").alias("name"), F.min("initiative_desc").alias("description"))
    links = A.project(table(s, d, "agency_doc_initiatives"), {"doc_id": "doc_ref", "initiative_id": "init_code"}, A.CANONICAL["doc_initiatives"]).distinct()
    return A.load(docs, docs.select(F.lit("").alias("division_id"), F.lit("").alias("name")).limit(0), ini, links)


def canonical_documents(s, d):
    return _documents(s, d)


def derived_divisions(s, d):
    return A.derived_divisions(_documents(s, d))


def blank_rates(s, d):
    return A.blank_rates(table(s, d, "agency_documents").select(*DOCUMENTS.values()))


def agency_nodes(s, d):
    out = None
    for label, df in _graph(s, d).nodes.items():
        n = df.agg(F.count("*").alias("cnt")).select(F.lit(label).alias("label"), "cnt")
        out = n if out is None else out.unionByName(n)
    return out


def agency_edges(s, d):
    return _graph(s, d).edges.groupBy("type").agg(F.count("*").alias("cnt"))


def first_documents(s, d):
    """The first thirty documents with text, by id."""
    return _documents(s, d).filter("doc_id <> '' and text <> ''").orderBy("doc_id").limit(30).select("doc_id", "title")


def _payloads(s: SparkSession, d: str) -> DataFrame:
    """Links as payloads: the division is a topic, the code an initiative without a description."""
    li = table(s, d, "agency_doc_initiatives").distinct()
    one = lambda v: F.array(F.struct(v.alias("name")))
    rel = F.struct(F.lit("Document").alias("source_type"), F.lit("").alias("source_id"), F.lit("").alias("source_value"), F.lit("ABOUT").alias("rel"), F.lit("Initiative").alias("target_type"), F.lit("name").alias("target_key"), F.col("init_code").alias("target_value"))
    e = F.struct(F.array(F.struct(F.col("init_code").alias("name"), F.lit(" ").alias("description"))).alias("initiatives"), one(F.substring("doc_ref", 1, 4)).alias("topics"))
    return li.select("link_id", F.to_json(F.struct(F.lit(" ").alias("doc_id"), e.alias("entities"), F.array(rel).alias("relations"))).alias("json"), F.col("doc_ref").alias("doc_id"))


def payload_relations(s, d):
    p = A.parse_payload(_payloads(s, d)).select("p.*").select("doc_id", F.explode("relations").alias("r"))
    return p.groupBy("r.rel", "r.target_type", "r.target_value").agg(F.count("*").alias("cnt"))


def payload_topics(s, d):
    return A.parse_payload(_payloads(s, d)).select(F.explode("p.topics").alias("topic")).groupBy("topic").agg(F.count("*").alias("cnt"))


def payload_graph(s, d):
    """Nodes and edges after payloads have been laid over the graph."""
    g = A.apply_payload(_graph(s, d), A.parse_payload(_payloads(s, d)))
    n = None
    for label, df in g.nodes.items():
        c = df.agg(F.count("*").alias("cnt")).select(F.lit("node").alias("what"), F.lit(label).alias("kind"), "cnt")
        n = c if n is None else n.unionByName(c)
    return n.unionByName(g.edges.groupBy(F.lit("edge").alias("what"), F.col("type").alias("kind")).agg(F.count("*").alias("cnt")))


QUERIES = {f.__name__: f for f in (canonical_documents, derived_divisions, blank_rates, agency_nodes, agency_edges, first_documents, payload_relations, payload_topics, payload_graph)}
QUERIES["canonicalize_documents"] = QUERIES.pop("canonical_documents")

_WS = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _sq(c: str) -> str:
    return f"coalesce(trim(regexp_replace({c}, '{_WS}', ' ', 'g')), '')"


_SLUG = "coalesce(nullif(trim(regexp_replace(lower({}), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'unknown')"
_G = f"""with c as (select {', '.join(f'{_sq(v)} as {k}' for k, v in DOCUMENTS.items())}, strftime(loaded_at, '%Y-%m-%d %H:%M:%S.%f') q from agency_documents),
  d as (select * exclude (q, n) from (select *, row_number() over (partition by doc_id order by length(q), q, title, text) n from c) where n = 1 and text <> ''),
  dv as (select distinct 'division_' || {_SLUG.format('division')} division_id, division as name from d where division <> ''),
  l as (select distinct {_sq('doc_ref')} doc_id, {_sq('init_code')} initiative_id from agency_doc_initiatives), good as (select * from l where initiative_id <> '' and doc_id in (select doc_id from d)),
  ini as (select distinct init_code id from agency_initiatives where init_code <> '' union select initiative_id from good),
  cr as (select distinct doc_id, 'division_' || {_SLUG.format('division')} division from d where division <> ''),
  ow as (select distinct initiative_id from good join cr using (doc_id)) """
SQL = {
    "canonicalize_documents": _G + "select * from d",
    "derived_divisions": _G + "select * from dv",
    "blank_rates": " union all ".join(f"select '{c}' as \"column\", coalesce(round_even(avg(case when trim(coalesce({c}, '')) = '' then 1.0 else 0.0 end), 4), 1.0) as blank_rate from agency_documents" for c in DOCUMENTS.values()),
    "agency_nodes": _G + "select 'Document' as label, count(*) as cnt from d union all select 'Division', count(distinct division_id) from dv union all select 'Initiative', count(*) from ini",
    "agency_edges": _G + "select 'CREATED_BY' as type, count(*) as cnt from cr union all select 'ABOUT', count(*) from good union all select 'OWNED_BY', count(*) from ow",
    "first_documents": _G + "select doc_id, title from d where doc_id <> '' order by doc_id limit 30",
    "payload_relations": "select 'ABOUT' as rel, 'Initiative' as target_type, trim(init_code) as target_value, count(*) as cnt from (select distinct * from agency_doc_initiatives) where trim(init_code) <> '' group by 3",
    "payload_topics": "select trim(substr(doc_ref, 1, 4)) as topic, count(*) as cnt from (select distinct * from agency_doc_initiatives) where trim(substr(doc_ref, 1, 4)) <> '' group by 1",
}
