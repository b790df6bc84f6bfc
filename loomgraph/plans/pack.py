"""The pack of named analytic queries over a labelled graph, and their registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomgraph.functions.text import year_of
from loomgraph.operators.agency import Agency, co_occurrence_edges, owners, shared_learning_edges
from loomgraph.session import materialize, table


@dataclass(frozen=True)
class QuerySpec:
    query_id: str
    title: str
    description: str
    parameters: dict[str, dict]
    build: Callable[[Agency, dict], DataFrame]
    columns: tuple[str, ...]
    shape: str = "table"


REGISTRY: dict[str, QuerySpec] = {}


def register_query(spec: QuerySpec) -> QuerySpec:
    REGISTRY[spec.query_id] = spec
    return spec


def run_query(g: Agency, query_id: str, params: dict | None = None) -> DataFrame:
    """Unknown ids raise KeyError; parameters not given take their default."""
    spec = REGISTRY[query_id]
    return spec.build(g, {k: v.get("default") for k, v in spec.parameters.items()} | (params or {}))


def least(df: DataFrame, keys: list[str], value: str, k: int, out: str) -> DataFrame:
    """(keys, out): the ``k`` least values of each group; only ``k`` rows a group are ever gathered."""
    d = df.select(*keys, value).filter(F.col(value).isNotNull()).distinct()
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(value))
    return d.withColumn("_n", n).filter(F.col("_n") <= k).groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias(out))


def _names(g: Agency, label: str, key: str, out: str) -> DataFrame:
    return g.nodes[label].select(F.col("id").alias(key), F.col("name").alias(out))


def _docs(g: Agency, kind: str, key: str) -> DataFrame:
    return g.out(kind).select(F.col("src").alias("doc_id"), F.col("dst").alias(key))


def _by_division(g: Agency) -> DataFrame:
    return _docs(g, "CREATED_BY", "division")


def cross_division_initiatives(g: Agency, p: dict) -> DataFrame:
    about = materialize(_docs(g, "ABOUT", "initiative_id").join(_by_division(g), "doc_id"), "about")  # read four times below
    per = about.groupBy("initiative_id").agg(F.count_distinct("doc_id").alias("doc_count"))
    own = g.out("OWNED_BY").select(F.col("src").alias("initiative_id"), F.col("dst").alias("division"))
    div = about.select("initiative_id", "division").unionByName(own).distinct().join(_names(g, "Division", "division", "name"), "division").filter("trim(name) <> ''")
    names = div.select("initiative_id", "name").distinct().groupBy("initiative_id").agg(F.array_sort(F.collect_list("name")).alias("divisions"))
    out = per.join(names.filter(F.size("divisions") > 1), "initiative_id").join(least(about, ["initiative_id"], "doc_id", 10, "doc_ids"), "initiative_id").join(_names(g, "Initiative", "initiative_id", "initiative"), "initiative_id")
    out = out.select("initiative_id", "initiative", "divisions", F.size("divisions").cast("bigint").alias("division_count"), "doc_count", "doc_ids")
    return out.orderBy(F.desc("division_count"), F.desc("doc_count"), F.col("initiative").asc_nulls_last(), "initiative_id").limit(p["limit"])


def shared_learnings(g: Agency, p: dict) -> DataFrame:
    """Learnings are reduced per division before divisions meet; documents come from a table of a few a division and learning."""
    cap = materialize(_docs(g, "CAPTURES", "learning").join(_by_division(g), "doc_id"), "captures")
    pair = shared_learning_edges(g).withColumnRenamed("count", "shared_learnings")
    per = cap.select("division", "learning").distinct()
    both = materialize(per.select(F.col("division").alias("src"), "learning").join(per.select(F.col("division").alias("dst"), "learning"), "learning").filter("src < dst"), "both")
    texts = both.join(g.nodes["Learning"].select(F.col("id").alias("learning"), F.col("name").alias("text")), "learning")
    sample = least(texts, ["src", "dst"], "text", 5, "sample_learnings")
    few = least(cap, ["division", "learning"], "doc_id", 5, "docs").select("division", "learning", F.explode("docs").alias("doc_id"))
    side = lambda s: least(both.join(few, (few["division"] == both[s]) & (few["learning"] == both["learning"])).select("src", "dst", "doc_id"), ["src", "dst"], "doc_id", 5, f"docs_{s}")
    out = pair.join(sample, ["src", "dst"]).join(side("src"), ["src", "dst"]).join(side("dst"), ["src", "dst"])
    out = out.join(_names(g, "Division", "src", "division_a"), "src").join(_names(g, "Division", "dst", "division_b"), "dst")
    out = out.select("division_a", "division_b", "shared_learnings", "sample_learnings", F.concat("docs_src", "docs_dst").alias("doc_ids"))
    return out.orderBy(F.desc("shared_learnings"), "division_a", "division_b").limit(p["limit"])


def topic_co_occurrence(g: Agency, p: dict) -> DataFrame:
    """The top pairs are chosen first; documents are looked up for those alone."""
    e = co_occurrence_edges(g).join(_names(g, "Topic", "src", "topic_a"), "src").join(_names(g, "Topic", "dst", "topic_b"), "dst")
    top = e.orderBy(F.desc("count"), "topic_a", "topic_b").limit(p["limit"])
    m = _docs(g, "MENTIONS", "topic")
    t = F.broadcast(top.select("src", "dst"))  # as many rows as the limit
    docs = m.join(t, m["topic"] == t["src"]).select("src", "dst", "doc_id").join(m.select("doc_id", F.col("topic").alias("dst")), ["doc_id", "dst"])
    out = top.join(least(docs, ["src", "dst"], "doc_id", 10, "doc_ids"), ["src", "dst"])
    return out.select("topic_a", "topic_b", "count", "score", "doc_ids").orderBy(F.desc("count"), "topic_a", "topic_b")


def _blank(c: str) -> Column:
    return F.avg(F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) == "", 1.0).otherwise(0.0))


def filing_health(g: Agency, p: dict) -> DataFrame:
    d = g.nodes["Document"].withColumnRenamed("id", "doc_id").join(_by_division(g), "doc_id", "left").join(_names(g, "Division", "division", "dname"), "division", "left")
    d = d.withColumn("division", F.coalesce("dname", F.lit("Unknown"))).withColumn("year", year_of("date"))
    rates = [F.round(_blank(c), 3).alias(f"missing_{c}_rate") for c in ("title", "doc_type", "source_uri")]
    out = d.groupBy("division", "year").agg(F.count("*").alias("doc_count"), *rates).join(least(d, ["division", "year"], "doc_id", 10, "doc_ids"), ["division", "year"])
    return out.select("division", "year", "doc_count", "missing_title_rate", "missing_doc_type_rate", "missing_source_uri_rate", "doc_ids").orderBy("division", "year").limit(p["limit"])


def recurring_issues(g: Agency, p: dict) -> DataFrame:
    """Documents reach an issue by a learning or by an initiative; the two ways are joined as rows, not multiplied."""
    to = lambda kind, label: _docs(g, kind, "via").join(g.out("ADDRESSES").join(g.nodes[label].select(F.col("id").alias("src")), "src", "left_semi").select(F.col("src").alias("via"), F.col("dst").alias("issue_id")), "via").select("issue_id", "doc_id")
    pairs = to("CAPTURES", "Learning").unionByName(to("ABOUT", "Initiative")).distinct()
    d = materialize(pairs.join(g.nodes["Document"].select(F.col("id").alias("doc_id"), year_of("date").alias("year")), "doc_id").join(_names(g, "Issue", "issue_id", "issue"), "issue_id").select("year", "issue", "doc_id"), "issues")
    out = d.groupBy("year", "issue").agg(F.count("*").alias("doc_count")).join(least(d, ["year", "issue"], "doc_id", 10, "doc_ids"), ["year", "issue"])
    return out.select("year", "issue", "doc_count", "doc_ids").orderBy("year", F.desc("doc_count"), "issue").limit(p["limit"])


def _limit(default: int, most: int) -> dict:
    return {"limit": {"type": "integer", "default": default, "min": 1, "max": most}}


register_query(QuerySpec("cross_division_initiatives", "Initiatives across divisions", "Initiatives that documents of several divisions are about.", _limit(15, 100), cross_division_initiatives, ("initiative_id", "initiative", "divisions", "division_count", "doc_count", "doc_ids")))
register_query(QuerySpec("shared_learnings_between_divisions", "Learnings in common", "Pairs of divisions whose documents capture the same learnings.", _limit(20, 100), shared_learnings, ("division_a", "division_b", "shared_learnings", "sample_learnings", "doc_ids")))
register_query(QuerySpec("topic_co_occurrence", "Topics that occur together", "Pairs of topics by documents that mention both.", _limit(25, 200), topic_co_occurrence, ("topic_a", "topic_b", "count", "score", "doc_ids"), "graph"))
register_query(QuerySpec("filing_health_by_division_time", "Completeness of filing", "Documents and missing metadata by division and year.", _limit(200, 2000), filing_health, ("division", "year", "doc_count", "missing_title_rate", "missing_doc_type_rate", "missing_source_uri_rate", "doc_ids"), "timeline"))
register_query(QuerySpec("recurring_issues_over_time", "Issues by year", "Documents that reach an issue, by year.", _limit(100, 1000), recurring_issues, ("year", "issue", "doc_count", "doc_ids"), "timeline"))


def dashboard_counts(g: Agency) -> DataFrame:
    """One row with the number of nodes of six labels."""
    labels = {"Document": "total_documents", "Division": "total_divisions", "Initiative": "total_initiatives", "Topic": "total_topics", "Issue": "total_issues", "Learning": "total_learnings"}
    one = None
    for label in labels:
        n = g.nodes[label].select(F.lit(label).alias("label"))
        one = n if one is None else one.unionByName(n)
    return one.agg(*[F.count_if(F.col("label") == k).alias(v) for k, v in labels.items()])


def top_topics(g: Agency, limit: int = 15) -> DataFrame:
    n = _docs(g, "MENTIONS", "topic_id").groupBy("topic_id").agg(F.count("*").alias("doc_count"))
    return n.join(_names(g, "Topic", "topic_id", "topic"), "topic_id").select("topic", "doc_count").orderBy(F.desc("doc_count"), "topic").limit(limit)


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """Adds rank, from 1, in the order given; for results already limited."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("bigint"))


# ---- test tables as a labelled graph ------------------------------------------------------------
def order_graph(spark: SparkSession, d: str) -> Agency:
    """Orders as documents, nations as divisions, parts as topics, brands as initiatives, suppliers of returned goods as learnings, part types as issues."""
    t = lambda n: table(spark, d, n)
    o, li, part = t("orders"), t("lineitem"), t("part")
    key = F.col("o_orderkey")
    doc = o.select(
        key.alias("id"), F.when(key % 10 == 0, "").otherwise(F.concat(F.lit("Order "), key.cast("string"))).alias("title"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority")).alias("doc_type"), F.when(key % 7 == 0, "").otherwise(F.concat(F.lit("order:"), key.cast("string"))).alias("source_uri"),
    )
    div = t("nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"))
    lp = li.select("l_orderkey", "l_partkey").join(part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand"), "l_partkey")
    name = lambda c: part.select(F.col(c).alias("id"), F.col(c).alias("name")).distinct()
    issue = name("p_type")
    learn = li.filter("l_returnflag = 'R' and l_quantity >= 47").select("l_orderkey", F.col("l_suppkey").cast("string").alias("l_suppkey")).distinct()
    ln = learn.select(F.col("l_suppkey").alias("id")).distinct().withColumn("name", F.concat(F.lit("Supplier "), "id"))
    numbered = issue.withColumn("n", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("id")) - 1)  # one row a part type
    e = lambda df, kind, a, b: df.select(F.lit(kind).alias("type"), F.col(a).cast("string").alias("src"), F.col(b).cast("string").alias("dst")).distinct()
    by = o.select("o_orderkey", "o_custkey").join(t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    edges = e(by, "CREATED_BY", "o_orderkey", "c_nationkey").unionByName(e(lp, "MENTIONS", "l_orderkey", "p_name")).unionByName(e(lp, "ABOUT", "l_orderkey", "p_brand")).unionByName(e(learn, "CAPTURES", "l_orderkey", "l_suppkey"))
    edges = edges.unionByName(e(ln.join(F.broadcast(numbered.withColumnRenamed("id", "issue")), F.col("id").cast("bigint") % 6 == F.col("n")), "ADDRESSES", "id", "issue")).unionByName(e(part, "ADDRESSES", "p_brand", "p_type"))
    g = Agency({"Document": doc.withColumn("id", F.col("id").cast("string")), "Division": div, "Initiative": name("p_brand"), "Topic": name("p_name"), "Issue": issue, "Learning": ln}, edges)
    g.edges = edges.unionByName(owners(g))
    return g


def _flat(df: DataFrame) -> DataFrame:
    """Arrays as text, so that results compare."""
    return df.select([F.array_join(F.transform(F.col(f.name), lambda x: x.cast("string")), "|").alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name) for f in df.schema.fields])


def _pack(query_id: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: _flat(run_query(order_graph(spark, d), query_id))


def initiative_owner(spark: SparkSession, d: str) -> DataFrame:
    return owners(order_graph(spark, d)).select(F.col("src").alias("initiative_id"), F.col("dst").alias("division_id"))


def shares_learning_with(spark: SparkSession, d: str) -> DataFrame:
    return shared_learning_edges(order_graph(spark, d)).select(F.col("src").alias("division_a"), F.col("dst").alias("division_b"), F.col("count").alias("cnt"))


def co_occurs_with(spark: SparkSession, d: str) -> DataFrame:
    return co_occurrence_edges(order_graph(spark, d)).select(F.col("src").alias("topic_a"), F.col("dst").alias("topic_b"), F.col("count").alias("cnt"), "score")


def entity_options(spark: SparkSession, d: str) -> DataFrame:
    """Values and labels to choose from, falsy ones dropped after the limit."""
    o = order_graph(spark, d).nodes["Document"].select(F.col("id").alias("value"), F.coalesce(F.nullif("title", F.lit("")), "id").alias("label"))
    return o.orderBy("label", "value").limit(300).filter("value <> '' and label <> ''")


def evidence_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents behind the top topic pairs."""
    g = order_graph(spark, d)
    ids = run_query(g, "topic_co_occurrence", {"limit": 5}).select(F.explode("doc_ids").alias("id")).distinct()
    return g.nodes["Document"].join(ids, "id", "left_semi").select(F.col("id").alias("doc_id"), "title", "date")


def evidence_nodes(spark: SparkSession, d: str) -> DataFrame:
    from loomgraph.operators.evidence import nodes_of

    return nodes_of(run_query(order_graph(spark, d), "topic_co_occurrence"))


def ranked_topics(spark: SparkSession, d: str) -> DataFrame:
    return ranked(top_topics(order_graph(spark, d)), F.desc("doc_count"), F.col("topic"))


QUERIES = {
    "topic_co_occurrence": _pack("topic_co_occurrence"),
    "cross_division_initiatives": _pack("cross_division_initiatives"),
    "shared_learnings": _pack("shared_learnings_between_divisions"),
    "filing_health": _pack("filing_health_by_division_time"),
    "recurring_issues": _pack("recurring_issues_over_time"),
    "dashboard_counts": lambda s, d: dashboard_counts(order_graph(s, d)),
    "top_topics": lambda s, d: top_topics(order_graph(s, d)),
    "ranked_topics": ranked_topics,
    "initiative_owner": initiative_owner,
    "shares_learning_with": shares_learning_with,
    "co_occurs_with": co_occurs_with,
    "entity_options": entity_options,
    "evidence_documents": evidence_documents,
    "evidence_nodes": evidence_nodes,
}

_G = """with doc as (select cast(o_orderkey as varchar) id, case when o_orderkey % 10 = 0 then '' else 'Order ' || o_orderkey end title, strftime(o_orderdate, '%Y-%m-%d') date,
    case when o_orderstatus = 'P' then '' else o_orderpriority end doc_type, case when o_orderkey % 7 = 0 then '' else 'order:' || o_orderkey end source_uri from orders),
  created as (select cast(o_orderkey as varchar) doc, cast(c_nationkey as varchar) division, n_name from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey),
  mentions as (select distinct cast(l_orderkey as varchar) doc, p_name topic from lineitem join part on l_partkey = p_partkey),
  about as (select distinct cast(l_orderkey as varchar) doc, p_brand initiative from lineitem join part on l_partkey = p_partkey),
  captures as (select distinct cast(l_orderkey as varchar) doc, cast(l_suppkey as varchar) learning from lineitem where l_returnflag = 'R' and l_quantity >= 47),
  issues as (select p_type, row_number() over (order by p_type) - 1 n from (select distinct p_type from part)),
  addresses as (select distinct 'l' || learning via, p_type issue from captures join issues on cast(learning as bigint) % 6 = n union select distinct 'i' || p_brand, p_type from part),
  pairs as (select a.topic topic_a, b.topic topic_b, count(*) n, array_to_string(list_sort(list(distinct a.doc))[1:10], '|') doc_ids from mentions a join mentions b on a.doc = b.doc and a.topic < b.topic group by 1, 2),
  abdiv as (select a.doc, initiative, division, n_name from about a join created c on a.doc = c.doc),
  ldiv as (select distinct division, n_name, learning, cp.doc from captures cp join created c on cp.doc = c.doc),
  topc as (select * from pairs order by n desc, topic_a, topic_b limit 25) """
SQL = {
    "topic_co_occurrence": _G + "select topic_a, topic_b, n as count, cast(n as double) as score, doc_ids from topc",
    "cross_division_initiatives": _G
    + """select initiative as initiative_id, initiative, array_to_string(list_sort(list(distinct n_name)), '|') as divisions, count(distinct n_name) as division_count, count(distinct doc) as doc_count,
      array_to_string(list_sort(list(distinct doc))[1:10], '|') as doc_ids from abdiv group by initiative having count(distinct n_name) > 1 order by division_count desc, doc_count desc, initiative limit 15""",
    "shared_learnings": _G
    + """, dl as (select distinct division, n_name, learning from ldiv),
      p as (select a.division x, b.division y, a.n_name division_a, b.n_name division_b, a.learning from dl a join dl b on a.learning = b.learning and a.division < b.division),
      s as (select x, y, division_a, division_b, count(*) shared_learnings, array_to_string(list_sort(list('Supplier ' || learning))[1:5], '|') sample_learnings from p group by all order by shared_learnings desc, division_a, division_b limit 20),
      da as (select s.x, s.y, list_sort(list(distinct l.doc))[1:5] d from s join p on s.x = p.x and s.y = p.y join ldiv l on l.division = s.x and l.learning = p.learning group by 1, 2),
      db as (select s.x, s.y, list_sort(list(distinct l.doc))[1:5] d from s join p on s.x = p.x and s.y = p.y join ldiv l on l.division = s.y and l.learning = p.learning group by 1, 2)
      select division_a, division_b, shared_learnings, sample_learnings, array_to_string(da.d || db.d, '|') as doc_ids from s join da using (x, y) join db using (x, y)""",
    "filing_health": _G
    + """select coalesce(n_name, 'Unknown') as division, substr(date, 1, 4) as year, count(*) as doc_count, round(avg(case when title = '' then 1.0 else 0.0 end), 3) as missing_title_rate,
      round(avg(case when coalesce(doc_type, '') = '' then 1.0 else 0.0 end), 3) as missing_doc_type_rate, round(avg(case when source_uri = '' then 1.0 else 0.0 end), 3) as missing_source_uri_rate,
      array_to_string(list_sort(list(distinct id))[1:10], '|') as doc_ids from doc left join created on id = doc group by 1, 2 order by 1, 2 limit 200""",
    "recurring_issues": _G
    + """, r as (select distinct issue, doc from captures join addresses on via = 'l' || learning union select distinct issue, doc from about join addresses on via = 'i' || initiative)
      select substr(date, 1, 4) as year, issue, count(*) as doc_count, array_to_string(list_sort(list(distinct id))[1:10], '|') as doc_ids from r join doc on r.doc = id group by 1, 2 order by year, doc_count desc, issue limit 100""",
    "dashboard_counts": _G
    + """select (select count(*) from doc) as total_documents, (select count(*) from nation) as total_divisions, (select count(distinct p_brand) from part) as total_initiatives, (select count(distinct p_name) from part) as total_topics,
      (select count(*) from issues) as total_issues, (select count(distinct learning) from captures) as total_learnings""",
    "top_topics": _G + "select topic, count(*) as doc_count from mentions group by topic order by doc_count desc, topic limit 15",
    "ranked_topics": _G + "select topic, count(*) as doc_count, row_number() over (order by count(*) desc, topic) as rank from mentions group by topic order by doc_count desc, topic limit 15",
    "initiative_owner": _G + "select initiative as initiative_id, division as division_id from (select initiative, division, row_number() over (partition by initiative order by count(distinct doc) desc, division) n from abdiv group by 1, 2) where n = 1",
    "shares_learning_with": _G + ", dl as (select distinct division, learning from ldiv) select a.division as division_a, b.division as division_b, count(*) as cnt from dl a join dl b on a.learning = b.learning and a.division < b.division group by 1, 2",
    "co_occurs_with": _G + "select topic_a, topic_b, n as cnt, cast(n as double) as score from pairs",
    "entity_options": _G + "select id as value, case when title = '' then id else title end as label from doc order by label, value limit 300",
    "evidence_documents": _G + "select distinct id as doc_id, title, date from doc where id in (select unnest(string_split(doc_ids, '|')) from (select * from pairs order by n desc, topic_a, topic_b limit 5))",
    "evidence_nodes": _G
    + """, x as (select 'Topic' type, topic_a label from topc union select 'Topic', topic_b from topc union select 'Document', unnest(string_split(doc_ids, '|')) from topc)
      select distinct type || ':' || label as id, type, label from x""",
}
