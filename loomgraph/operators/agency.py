"""Raw tables to canonical ones, canonical ones to a labelled graph, extraction payloads into it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomgraph.functions.ids import division_id, stable_id
from loomgraph.functions.text import squeeze

#: Fixed: the columns of each canonical table.
CANONICAL = {
    "documents": ["doc_id", "title", "text", "division", "date", "doc_type", "source_uri"],
    "divisions": ["division_id", "name"],
    "initiatives": ["initiative_id", "name", "description"],
    "doc_initiatives": ["doc_id", "initiative_id"],
}
#: Fixed: (source type, relation, target type) that a payload may hold.
RELATIONS = [("Document", "ABOUT", "Initiative"), ("Document", "MENTIONS", "Topic"), ("Document", "CAPTURES", "Learning"), ("Learning", "RELATES_TO", "Topic"), ("Learning", "ADDRESSES", "Issue"), ("Initiative", "ADDRESSES", "Issue"), ("Initiative", "RESULTED_IN", "Outcome")]


def project(raw: DataFrame, columns: dict[str, str], target: list[str]) -> DataFrame:
    """Target columns from the mapped ones as squeezed strings; '' where nothing is mapped or present."""
    have = set(raw.columns)
    return raw.select([(squeeze(F.col(f"`{columns[t]}`").cast("string")) if columns.get(t) in have else F.lit("")).alias(t) for t in target])


def canonical_documents(raw: DataFrame, columns: dict[str, str], seq: Column) -> DataFrame:
    """Documents with an id (of the title, else of the text, where blank), the first of each id, without blank texts.

    The first of an id is chosen before blank texts go: a blank first delivery hides a later one.
    """
    d = project(raw.withColumn("_seq", seq), columns | {"_seq": "_seq"}, CANONICAL["documents"] + ["_seq"])
    made = stable_id("doc", F.when(F.col("title") != "", F.col("title")).otherwise(F.substring("text", 1, 120)))
    d = d.withColumn("doc_id", F.when(F.col("doc_id") != "", F.col("doc_id")).otherwise(made))
    w = Window.partitionBy("doc_id").orderBy(F.length("_seq"), "_seq", "title", "text")
    return d.withColumn("_n", F.row_number().over(w)).filter("_n = 1 and text <> ''").select(*CANONICAL["documents"])


def derived_divisions(documents: DataFrame) -> DataFrame:
    return documents.filter("division <> ''").select(division_id("division").alias("division_id"), F.col("division").alias("name")).distinct()


def blank_rates(df: DataFrame, digits: int = 4) -> DataFrame:
    """(column, blank_rate) in one pass, rounded half to even; an empty table is all blank."""
    blank = [F.avg(F.when(F.trim(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) == "", 1.0).otherwise(0.0)).alias(c) for c in df.columns]
    one = df.agg(*blank)
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.bround(F.coalesce(F.col(f"`{c}`"), F.lit(1.0)), digits).alias("blank_rate")) for c in df.columns])).alias("x")
    return one.select(kv).select("x.*")


def schema_report(name: str, df: DataFrame | None, required: list[str], expected: list[str]) -> dict:
    """Missing columns and blank rates of a canonical table; status ok if nothing is missing."""
    if df is None:
        return {"table": name, "exists": False, "missing_required": required, "missing_expected": expected, "blank_rates": {}, "status": "issues"}
    miss_r, miss_e = [c for c in required if c not in df.columns], [c for c in expected if c not in df.columns]
    rates = {r["column"]: r["blank_rate"] for r in blank_rates(df).collect()}  # a row a column
    return {"table": name, "exists": True, "missing_required": miss_r, "missing_expected": miss_e, "blank_rates": rates, "status": "ok" if not (miss_r or miss_e) else "issues"}


@dataclass
class Agency:
    """Node tables by label (id, name and more) and one edge table (type, src, dst)."""

    nodes: dict[str, DataFrame] = field(default_factory=dict)
    edges: DataFrame | None = None

    def out(self, kind: str) -> DataFrame:
        return self.edges.filter(F.col("type") == kind).select("src", "dst").distinct()


def _edge(df: DataFrame, kind: str, src: str, dst: str) -> DataFrame:
    return df.select(F.lit(kind).alias("type"), F.col(src).cast("string").alias("src"), F.col(dst).cast("string").alias("dst"))


def load(documents: DataFrame, divisions: DataFrame, initiatives: DataFrame, links: DataFrame) -> Agency:
    """Nodes and edges of the four canonical tables; a division of the table wins over one derived from a document,
    an initiative that only a link names is made without a name, a link to no document is dropped."""
    docs = documents.filter("doc_id <> ''")
    own = divisions.filter("division_id <> ''").select(F.col("division_id").alias("id"), "name")
    derived = derived_divisions(docs).select(F.col("division_id").alias("id"), "name")
    derived = derived.groupBy("id").agg(F.min("name").alias("name"))
    div = own.dropDuplicates(["id"]).unionByName(derived.join(own.select("id"), "id", "left_anti"))
    ini = initiatives.filter("initiative_id <> ''").select(F.col("initiative_id").alias("id"), "name", "description").dropDuplicates(["id"])
    good = links.filter("doc_id <> '' and initiative_id <> ''").join(docs.select("doc_id").distinct(), "doc_id", "left_semi").distinct()
    extra = good.select(F.col("initiative_id").alias("id")).distinct().join(ini.select("id"), "id", "left_anti")
    ini = ini.unionByName(extra.select("id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("description")))
    e = _edge(docs.filter("division <> ''").withColumn("d", division_id("division")), "CREATED_BY", "doc_id", "d").unionByName(_edge(good, "ABOUT", "doc_id", "initiative_id"))
    g = Agency({"Document": docs.withColumnRenamed("doc_id", "id"), "Division": div, "Initiative": ini}, e)
    g.edges = e.unionByName(owners(g))
    return g


def owners(g: Agency) -> DataFrame:
    """OWNED_BY: the division with most documents about the initiative, ties to the least id."""
    n = g.out("ABOUT").select(F.col("src").alias("doc"), F.col("dst").alias("initiative")).join(g.out("CREATED_BY").select(F.col("src").alias("doc"), F.col("dst").alias("division")), "doc")
    per = n.groupBy("initiative", "division").agg(F.count_distinct("doc").alias("n"))
    best = per.groupBy("initiative").agg(F.min_by("division", F.struct(-F.col("n"), "division")).alias("division"))
    return _edge(best, "OWNED_BY", "initiative", "division")


def shared_learning_edges(g: Agency) -> DataFrame:
    """(src, dst, count): divisions with a learning in common, each pair once; learnings are reduced per division first."""
    per = g.out("CAPTURES").select(F.col("src").alias("doc"), F.col("dst").alias("learning")).join(g.out("CREATED_BY").select(F.col("src").alias("doc"), F.col("dst").alias("division")), "doc").select("division", "learning").distinct()
    o = per.select(F.col("division").alias("b"), "learning")
    return per.join(o, "learning").filter("division < b").groupBy(F.col("division").alias("src"), F.col("b").alias("dst")).agg(F.count("*").alias("count"))


def co_occurrence_edges(g: Agency) -> DataFrame:
    """(src, dst, count, score): topics of one document."""
    m = g.out("MENTIONS").select(F.col("src").alias("doc"), F.col("dst").alias("t"))
    o = m.select("doc", F.col("t").alias("u"))
    return m.join(o, "doc").filter("t < u").groupBy(F.col("t").alias("src"), F.col("u").alias("dst")).agg(F.count("*").alias("count")).withColumn("score", F.col("count").cast("double"))


PAYLOAD = (
    "doc_id string, entities struct<initiatives:array<struct<name:string,description:string>>,topics:array<struct<name:string>>,issues:array<struct<name:string>>,learnings:array<struct<text:string>>,outcomes:array<struct<name:string>>>, "
    "relations array<struct<source_type:string,source_id:string,source_value:string,rel:string,target_type:string,target_key:string,target_value:string>>, confidence map<string,string>"
)


def parse_payload(df: DataFrame, json: str = "json", doc: str = "doc_id") -> DataFrame:
    """Payload struct ``p``: blank names dropped, relations without relation, target value or type dropped, id from the row where it has none."""
    p = df.withColumn("_p", F.from_json(json, PAYLOAD))
    text = lambda arr, f: F.filter(F.transform(F.coalesce(arr, F.array()), lambda x: F.trim(F.coalesce(x[f], F.lit("")))), lambda x: x != "")
    e = F.col("_p.entities")
    ini = F.filter(F.transform(F.coalesce(e["initiatives"], F.array()), lambda x: F.struct(F.trim(F.coalesce(x["name"], F.lit(""))).alias("name"), F.trim(F.coalesce(x["description"], F.lit(""))).alias("description"))), lambda x: x["name"] != "")
    names = ["source_type", "source_id", "source_value", "rel", "target_type", "target_key", "target_value"]
    rel = F.transform(F.coalesce(F.col("_p.relations"), F.array()), lambda x: F.struct(*[F.trim(F.coalesce(x[n], F.lit(""))).alias(n) for n in names]))
    rel = F.filter(rel, lambda x: (x["rel"] != "") & (x["target_value"] != "") & (x["target_type"] != ""))
    own = F.coalesce(F.nullif(F.trim("_p.doc_id"), F.lit("")), F.col(doc).cast("string"))
    return p.select(F.col(doc).alias("row"), F.struct(own.alias("doc_id"), ini.alias("initiatives"), text(e["topics"], "name").alias("topics"), text(e["issues"], "name").alias("issues"), text(e["learnings"], "text").alias("learnings"), text(e["outcomes"], "name").alias("outcomes"), rel.alias("relations")).alias("p"))


def apply_payload(g: Agency, parsed: DataFrame) -> Agency:
    """Entities of payloads as nodes (a description only over another if it is not blank), whitelisted relations as edges between nodes that exist."""
    rows = parsed.select("p.*")
    nodes = dict(g.nodes)
    for label, col in (("Topic", "topics"), ("Issue", "issues"), ("Learning", "learnings"), ("Outcome", "outcomes")):
        new = rows.select(F.explode(col).alias("name")).distinct().withColumn("id", stable_id(label.lower(), "name")).select("id", "name")
        old = nodes.get(label)
        nodes[label] = new if old is None else old.unionByName(new.join(old.select("id"), "id", "left_anti"), allowMissingColumns=True)
    new = rows.select(F.explode("initiatives").alias("x")).select("x.*").withColumn("id", stable_id("initiative", "name")).groupBy("id").agg(F.min("name").alias("name"), F.max("description").alias("new"))
    old = nodes.get("Initiative")
    if old is None:
        nodes["Initiative"] = new.select("id", "name", F.col("new").alias("description"))
    else:
        o = old.select("id", F.col("name").alias("o_name"), "description")
        nodes["Initiative"] = o.join(new, "id", "full_outer").select("id", F.coalesce("name", "o_name").alias("name"), F.when(F.col("new") != "", F.col("new")).otherwise(F.col("description")).alias("description"))
    r = rows.select("doc_id", F.explode("relations").alias("r")).select("doc_id", "r.*")
    made = None
    for source, rel, target in RELATIONS:
        own = r.filter((F.col("source_type") == source) & (F.col("rel") == rel) & (F.col("target_type") == target))
        value = F.when(F.col("source_value") != "", F.col("source_value")).otherwise(F.coalesce(F.nullif(F.col("source_id"), F.lit("")), F.col("doc_id")))
        src = F.coalesce(F.nullif(F.col("source_id"), F.lit("")), F.col("doc_id")) if source == "Document" else stable_id(source.lower(), value)
        e = own.select(F.lit(rel).alias("type"), src.alias("src"), stable_id(target.lower(), "target_value").alias("dst"))
        e = e.join(nodes[source].select(F.col("id").cast("string").alias("src")), "src", "left_semi").join(nodes[target].select(F.col("id").alias("dst")), "dst", "left_semi")
        made = e if made is None else made.unionByName(e)
    made = made.select("type", "src", "dst")
    return Agency(nodes, (made if g.edges is None else g.edges.unionByName(made)).distinct())
