"""A property graph as two tables, and the ways it is changed and read.

``entities``: id, name, type, aliases. ``relations``: src, rel, dst and properties, one row for
each (src, rel, dst). Nothing is updated in place: an upsert is a new table from the old and the new rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomgraph.functions.ids import entity_id
from loomgraph.functions.text import relation_name


@dataclass
class Graph:
    entities: DataFrame
    relations: DataFrame


def _first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def first_wins(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return _first(df, keys, [F.col(o).asc_nulls_first() for o in order])


def last_wins(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return _first(df, keys, [F.col(o).desc_nulls_last() for o in order])


def node_key(canonical_id: Column, type_: Column, name: Column) -> Column:
    """The canonical id, trimmed and in lower case; a digest of type and name where there is none."""
    c = F.lower(F.regexp_replace(canonical_id, r"^\s+|\s+$", ""))
    return F.when(F.coalesce(c, F.lit("")) != "", c).otherwise(entity_id(F.coalesce(F.nullif(F.trim(type_), F.lit("")), F.lit("entity")), name))


def registry(cmap: DataFrame, triples: DataFrame) -> DataFrame:
    """Nodes, the first registration winning: map rows by id, then triples by time, subject before object."""
    from_map = cmap.filter("canonical_id is not null and canonical_name is not null").select(
        F.lit(0).alias("part"), F.lit(None).cast("timestamp_ntz").alias("at"), F.lpad(F.col("map_id").cast("string"), 20, "0").alias("seq"), F.lit(0).alias("pos"),
        node_key(F.col("canonical_id"), F.col("type"), F.col("canonical_name")).alias("id"), F.col("canonical_name").alias("name"), F.col("type"), F.col("surface"),
    )

    def end(role: str, pos: int) -> DataFrame:
        return triples.filter(f"{role} is not null").select(
            F.lit(1).alias("part"), F.col("loaded_at").alias("at"), F.col("triple_id").alias("seq"), F.lit(pos).alias("pos"),
            node_key(F.col(f"{role}_canonical_id"), F.col(f"{role}_type"), F.col(role)).alias("id"), F.col(role).alias("name"), F.col(f"{role}_type").alias("type"), F.col(f"{role}_surface").alias("surface"),
        )

    rows = from_map.unionByName(end("subject", 0)).unionByName(end("object", 1))
    # the earliest registration by an aggregate, so that a hot entity is combined before it is shuffled
    first = F.min_by(F.struct("name", "type"), F.struct("part", F.coalesce("at", F.lit("1970-01-01").cast("timestamp_ntz")), "seq", "pos"))
    return rows.groupBy("id").agg(first.alias("f"), F.array_sort(F.array_compact(F.collect_set("surface"))).alias("aliases")).select("id", "f.name", "f.type", "aliases")


def edges_of(triples: DataFrame) -> DataFrame:
    """Edges of all triples, not yet merged."""
    t = triples.filter("subject is not null and object is not null")
    return t.select(
        node_key(F.col("subject_canonical_id"), F.col("subject_type"), F.col("subject")).alias("src"),
        relation_name("predicate").alias("rel"),
        node_key(F.col("object_canonical_id"), F.col("object_type"), F.col("object")).alias("dst"),
        "predicate", F.coalesce("confidence", F.lit(0.0)).alias("confidence"), "evidence", F.col("filename").alias("source_doc"), F.coalesce("page_num", F.lit(0)).alias("source_page"),
        "chunk_id", F.coalesce("ontology_valid", F.lit(False)).alias("ontology_valid"), F.coalesce("violation", F.lit("")).alias("violation"), "triple_id", "loaded_at",
    )


EDGE = ["src", "rel", "dst"]


def merge_edges_last(edges: DataFrame) -> DataFrame:
    """One edge for each (src, rel, dst): the last triple's properties stay."""
    props = [c for c in edges.columns if c not in EDGE]
    order = F.struct(F.coalesce("loaded_at", F.lit("1970-01-01").cast("timestamp_ntz")), "triple_id")
    return edges.groupBy(*EDGE).agg(F.max_by(F.struct(*props), order).alias("p")).select(*EDGE, "p.*")


def merge_edges_first(edges: DataFrame) -> DataFrame:
    props = [c for c in edges.columns if c not in EDGE]
    order = F.struct(F.coalesce("loaded_at", F.lit("1970-01-01").cast("timestamp_ntz")), "triple_id")
    return edges.groupBy(*EDGE).agg(F.min_by(F.struct(*props), order).alias("p")).select(*EDGE, "p.*")


def upsert_nodes(old: DataFrame, new: DataFrame, overwrite: bool = True) -> DataFrame:
    """New nodes over old ones, or only those that are not there yet."""
    if overwrite:
        return new.unionByName(old.join(new.select("id"), "id", "left_anti"), allowMissingColumns=True)
    return old.unionByName(new.join(old.select("id"), "id", "left_anti"), allowMissingColumns=True)


def upsert_edges(old: DataFrame, new: DataFrame, overwrite: bool = True, source: str | None = None) -> DataFrame:
    """As ``upsert_nodes``; ``source`` tags edges that are created."""
    if source is not None:
        new = new.withColumn("source", F.lit(source))
    if overwrite:
        return new.unionByName(old.join(new.select(*EDGE), EDGE, "left_anti"), allowMissingColumns=True)
    return old.unionByName(new.join(old.select(*EDGE), EDGE, "left_anti"), allowMissingColumns=True)


def only_connected(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """Edges whose two ends exist."""
    ids = entities.select("id")
    return edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")


def ends(relations: DataFrame) -> DataFrame:
    """(id, other, rel, out) for both ends of every edge; a loop once."""
    fwd = relations.select(F.col("src").alias("id"), F.col("dst").alias("other"), "rel", F.lit(True).alias("out"))
    bwd = relations.filter("src <> dst").select(F.col("dst").alias("id"), F.col("src").alias("other"), "rel", F.lit(False).alias("out"))
    return fwd.unionByName(bwd)


def degree_undirected(g: Graph) -> DataFrame:
    """(id, name, type, degree) of every node; a loop counts once, an unconnected node 0."""
    d = ends(g.relations).groupBy("id").agg(F.count("*").alias("degree"))
    return g.entities.join(d, "id", "left").select("id", "name", "type", F.coalesce("degree", F.lit(0)).alias("degree"))


def degree_in_out(g: Graph) -> DataFrame:
    """(id, name, type, out, in, total); a loop counts on both sides."""
    one = g.relations.select(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(g.relations.select(F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    d = one.groupBy("id").agg(F.sum("o").alias("out"), F.sum("i").alias("in"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return g.entities.join(d, "id", "left").select("id", "name", "type", zero("out").alias("out"), zero("in").alias("in"), (zero("out") + zero("in")).alias("total"))


def unconnected(g: Graph) -> DataFrame:
    """Nodes without any edge."""
    return g.entities.join(ends(g.relations).select("id").distinct(), "id", "left_anti")


def neighbours(g: Graph, ids: DataFrame) -> DataFrame:
    """One hop in both directions from the nodes of ``ids`` (id)."""
    e = g.entities
    n = ids.join(e.select("id", F.col("name").alias("entity"), F.col("type").alias("entity_type")), "id")
    r = g.relations.select("src", "dst", "predicate", "confidence", "evidence", "ontology_valid")
    fwd = n.join(r, n["id"] == r["src"]).select("id", "entity", "entity_type", F.lit("→").alias("direction"), "predicate", F.col("dst").alias("other"), "confidence", "evidence", "ontology_valid")
    bwd = n.join(r.filter("src <> dst"), n["id"] == F.col("dst")).select("id", "entity", "entity_type", F.lit("←").alias("direction"), "predicate", F.col("src").alias("other"), "confidence", "evidence", "ontology_valid")
    o = e.select(F.col("id").alias("other"), F.col("name").alias("related"), F.col("type").alias("related_type"))
    return fwd.unionByName(bwd).join(o, "other")


def expand(g: Graph, seeds: DataFrame, depth: int = 2) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges on undirected trails of at most ``depth`` edges (an edge once a trail) from the seeds (id).

    One join a hop against the frontier only; every edge on a trail has an end within depth - 1 of a seed.
    """
    near = seeds.select("id").distinct()
    frontier = near
    found = None
    both = ends(g.relations)
    for _ in range(depth):
        hop = both.join(frontier, "id").select("id", "other", "rel", "out")
        e = hop.select(F.when(F.col("out"), F.col("id")).otherwise(F.col("other")).alias("src"), "rel", F.when(F.col("out"), F.col("other")).otherwise(F.col("id")).alias("dst"))
        found = e if found is None else found.unionByName(e)
        nxt = hop.select(F.col("other").alias("id")).distinct()
        frontier = nxt.join(near, "id", "left_anti")
        near = near.unionByName(frontier)
    return g.entities.join(near, "id", "left_semi"), found.distinct()


def one_row(nodes: DataFrame, edges: DataFrame, label: str = "type") -> DataFrame:
    """One row (nodes, relationships) of an expanded neighbourhood, for a reader; it holds all of both, so it is for what a screen shows."""
    props = [c for c in nodes.columns if c not in ("id", label)]
    n = nodes.agg(F.sort_array(F.collect_list(F.struct(F.col("id").cast("string").alias("element_id"), F.array(label).alias("labels"), F.to_json(F.struct(*props)).alias("props")))).alias("nodes"))
    more = [c for c in edges.columns if c not in ("src", "rel", "dst")]
    r = edges.agg(F.sort_array(F.collect_list(F.struct(F.col("rel").alias("type"), F.col("src").cast("string").alias("start"), F.col("dst").cast("string").alias("end"), (F.to_json(F.struct(*more)) if more else F.lit("{}")).alias("props")))).alias("relationships"))
    return n.withColumn("_k", F.lit(1)).join(r.withColumn("_k", F.lit(1)), "_k").drop("_k")  # one row on either side


def merge_duplicates(g: Graph, mapping: DataFrame) -> Graph:
    """Nodes ``dup`` of ``mapping`` (dup, canonical) give their edges and aliases to ``canonical``; loops that arise stay."""
    m = mapping.select("dup", "canonical")
    moved = g.entities.join(m, g.entities["id"] == m["dup"], "left").withColumn("id", F.coalesce("canonical", "id")).withColumn("own", F.col("dup").isNull())
    ents = moved.groupBy("id").agg(F.max_by(F.struct("name", "type"), F.struct("own", "name")).alias("k"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("aliases")))).alias("aliases")).select("id", "k.name", "k.type", "aliases")
    r = g.relations
    s = m.select(F.col("dup").alias("src"), F.col("canonical").alias("s2"))
    d = m.select(F.col("dup").alias("dst"), F.col("canonical").alias("d2"))
    r = r.join(s, "src", "left").join(d, "dst", "left").withColumn("src", F.coalesce("s2", "src")).withColumn("dst", F.coalesce("d2", "dst")).drop("s2", "d2")
    return Graph(ents, merge_edges_last(r.select(*g.relations.columns)))


def delete_nodes(g: Graph, ids: DataFrame) -> Graph:
    """Without the nodes of ``ids`` (id) and their edges."""
    i = ids.select("id")
    r = g.relations.join(i.withColumnRenamed("id", "src"), "src", "left_anti").join(i.withColumnRenamed("id", "dst"), "dst", "left_anti")
    return Graph(g.entities.join(i, "id", "left_anti"), r.select(*g.relations.columns))


def delete_edges(g: Graph, rels: list[str]) -> Graph:
    """Without the edges of the relations named."""
    return Graph(g.entities, g.relations.filter(~F.col("rel").isin(rels)))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that stand more than once: empty where the key is unique."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")
