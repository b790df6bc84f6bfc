"""Queries over the entity graph built from canonical map and validated triples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.operators import cleanup as C
from loomgraph.operators import graph as G
from loomgraph.operators.orphans import repair_stats
from loomgraph.session import table


def _tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, d, "canonical_map"), table(spark, d, "validated_triples")


def entity_graph(spark: SparkSession, d: str) -> G.Graph:
    cmap, triples = _tables(spark, d)
    return G.Graph(G.registry(cmap, triples), G.merge_edges_last(G.edges_of(triples)))


def _flat(df: DataFrame) -> DataFrame:
    return df.select([F.array_join(f.name, "|").alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name) for f in df.schema.fields])


def nodes_by_type(g: G.Graph) -> DataFrame:
    return g.entities.groupBy("type").agg(F.count("*").alias("cnt"))


def rels_by_type(g: G.Graph) -> DataFrame:
    return g.relations.groupBy("rel").agg(F.count("*").alias("cnt"))


def totals(g: G.Graph) -> DataFrame:
    n = lambda df, what: df.agg(F.count("*").alias("cnt")).select(F.lit(what).alias("what"), "cnt")
    return n(g.entities, "nodes").unionByName(n(g.relations, "relations"))


def most_connected(g: G.Graph, limit: int = 20) -> DataFrame:
    return G.degree_undirected(g).orderBy(F.desc("degree"), "id").limit(limit).select("id", "name", "type", "degree")


def busiest(g: G.Graph, limit: int = 10) -> DataFrame:
    return G.degree_in_out(g).orderBy(F.desc("total"), "id").limit(limit)


def around_busiest(g: G.Graph, limit: int = 3) -> DataFrame:
    """Relations of the nodes that carry one of the busiest names; a name may stand for several nodes."""
    names = busiest(g, limit).select("name").distinct()
    ids = g.entities.join(F.broadcast(names), "name", "left_semi").select("id")  # at most ``limit`` names
    out = G.neighbours(g, ids)
    return out.select("entity", "entity_type", "direction", "predicate", "related", "related_type", "confidence", "evidence", "ontology_valid")


def contained_names(g: G.Graph) -> DataFrame:
    """(id_a, id_b, name_a, name_b, type): nodes of one type of which one name lies inside the other, any case.

    The shorter name is looked up by its rarest three letters among the letter triples of all
    names of its type, so only names that share them are compared.
    """
    n = g.entities.filter("name <> '' and type is not null").select("id", "name", "type", F.lower("name").alias("low"))
    grams = lambda k: F.transform(F.sequence(F.lit(1), F.length("low") - (k - 1)), lambda i: F.substring(F.col("low"), i, F.lit(k)))
    of = lambda k: n.filter(F.length("low") >= k).select("id", "name", "type", "low", F.explode(F.array_distinct(grams(k))).alias("gram"))
    tri = of(3)
    seen = tri.groupBy("type", "gram").agg(F.count("*").alias("n"))
    rare = tri.join(seen, ["type", "gram"]).groupBy("id", "name", "type", "low").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    short = n.filter("length(low) < 3").withColumn("gram", F.col("low"))
    inner = rare.unionByName(short.select(*rare.columns)).select(F.col("id").alias("i"), F.col("name").alias("n2"), "type", F.col("low").alias("in"), "gram")
    outer = tri.unionByName(of(2)).unionByName(of(1))
    hit = outer.join(inner, ["type", "gram"]).filter("id <> i and contains(low, `in`)")
    first = F.col("id") < F.col("i")
    w = lambda a, b: F.when(first, F.col(a)).otherwise(F.col(b))
    return hit.select(w("id", "i").alias("id_a"), w("i", "id").alias("id_b"), w("name", "n2").alias("name_a"), w("n2", "name").alias("name_b"), "type").distinct()


def duplicate_candidates(g: G.Graph, limit: int = 20) -> DataFrame:
    return contained_names(g).orderBy("type", "name_a", "name_b", "id_a", "id_b").limit(limit).select("name_a", "name_b", "type")


def case_duplicates(g: G.Graph) -> DataFrame:
    """(dup, canonical): nodes of one type whose names agree without case; the least id stays."""
    key = ["type", "low"]
    n = g.entities.filter("name is not null and type is not null").select("id", "type", F.lower(F.trim("name")).alias("low"))
    least = n.groupBy(*key).agg(F.min("id").alias("canonical"), F.count("*").alias("n")).filter("n > 1")
    return n.join(least, key).filter("id <> canonical").select(F.col("id").alias("dup"), "canonical")


# ---- fixed templates of questions ---------------------------------------------------------------
#: name: (relations, whether undirected, condition on the first or the second node, its parameter)
TEMPLATES = {
    "nl_operates": (["OPERATES"], "a"), "nl_heads": (["HEADED_BY"], "b"), "nl_enforces": (["ENFORCES", "REGULATES"], "a"), "nl_collaborators": (["COLLABORATES_WITH"], "either"), "nl_measures": (["MEASURES"], ""),
    "nl_located": (["LOCATED_IN"], "b"), "nl_targets": (["SET_TARGET", "TARGETS"], "a"), "nl_emits": (["EMITS"], ""), "nl_technologies": (None, "technology"),
}


def template(g: G.Graph, name: str, term: str) -> DataFrame:
    """(a, rel, b, b_type, evidence, confidence) of one of the fixed questions; names are matched by a part of them, with case."""
    rels, which = TEMPLATES[name]
    e = g.entities
    a = e.select(F.col("id").alias("src"), F.col("name").alias("a"), F.col("type").alias("a_type"))
    b = e.select(F.col("id").alias("dst"), F.col("name").alias("b"), F.col("type").alias("b_type"))
    r = g.relations if rels is None else g.relations.filter(F.col("rel").isin(rels))
    if which in ("either", "technology"):
        back = r.filter("src <> dst").withColumn("_s", F.col("dst")).withColumn("dst", F.col("src")).withColumn("src", F.col("_s")).drop("_s")
        r = r.unionByName(back)
    j = r.join(a, "src").join(b, "dst")
    if which == "technology":
        j = j.filter((F.col("b_type") == "Technology") & F.col("a").contains(term))
    elif which in ("a", "either"):
        j = j.filter(F.col("a").contains(term))
    elif which == "b":
        j = j.filter(F.col("b").contains(term))
    return j.select("a", "rel", "b", "b_type", "evidence", "confidence")


def name_search(g: G.Graph, term: str, limit: int = 20) -> DataFrame:
    return g.entities.filter(F.col("name").contains(term)).orderBy("name", "id").limit(limit).select("name", "type", "aliases")


# ---- registered queries --------------------------------------------------------------------------
_TERM = {"nl_located": "holt"}


def _on(fn: Callable[[G.Graph], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: _flat(fn(entity_graph(spark, d)))


def _edge_rows(df: DataFrame) -> DataFrame:
    return df.select("src", "rel", "dst", "predicate", "confidence", "evidence", "source_doc", "source_page", "chunk_id", "ontology_valid", "violation", "triple_id")


def edge_upsert_last(spark: SparkSession, d: str) -> DataFrame:
    return _edge_rows(G.merge_edges_last(G.edges_of(_tables(spark, d)[1])))


def edge_upsert_first(spark: SparkSession, d: str) -> DataFrame:
    """Triples since 2024 as a repair pass on those before: edges that exist stay as they are."""
    t = _tables(spark, d)[1]
    old = G.merge_edges_last(G.edges_of(t.filter("loaded_at < '2024-01-01' or loaded_at is null"))).withColumn("source", F.lit(None).cast("string"))
    new = G.merge_edges_first(G.edges_of(t.filter("loaded_at >= '2024-01-01'")))
    out = G.upsert_edges(old, new, overwrite=False, source="reextraction_pass")
    return out.select("src", "rel", "dst", "triple_id", "source")


def repair_summary(spark: SparkSession, d: str) -> DataFrame:
    return edge_upsert_first(spark, d).filter("source = 'reextraction_pass'").groupBy("rel").agg(F.count("*").alias("cnt"))


def repair_statistics(spark: SparkSession, d: str) -> DataFrame:
    cmap, t = _tables(spark, d)
    nodes = G.registry(cmap, t)
    old = G.merge_edges_last(G.edges_of(t.filter("loaded_at < '2024-01-01' or loaded_at is null"))).withColumn("source", F.lit(None).cast("string"))
    new = G.merge_edges_first(G.edges_of(t.filter("loaded_at >= '2024-01-01'")))
    after = G.upsert_edges(old, new, overwrite=False, source="reextraction_pass")
    return repair_stats(G.Graph(nodes, old), G.Graph(nodes, after), "reextraction_pass")


def expand_depth2(spark: SparkSession, d: str) -> DataFrame:
    """Edges within two steps of the most connected node."""
    g = entity_graph(spark, d)
    return G.expand(g, most_connected(g, 1).select("id"), 2)[1]


def expand_nodes(spark: SparkSession, d: str) -> DataFrame:
    g = entity_graph(spark, d)
    return G.expand(g, most_connected(g, 1).select("id"), 2)[0].select("id", "name", "type")


def noise_nodes(g: G.Graph) -> DataFrame:
    e = g.entities.select("id", "name", C.noise_name(F.col("name")).alias("hard"), C.noise_name(F.col("name"), 9).alias("soft"))
    return e.filter("hard or soft")


def flagged_relations(g: G.Graph) -> DataFrame:
    rules = [("unknown_relation", C.unknown_relation(F.col("rel"))), ("low_confidence", F.col("confidence") < 0.6), ("self_loop", F.expr("src = dst"))]
    return C.flag(g.relations, rules)


def merged_graph(spark: SparkSession, d: str) -> DataFrame:
    """Edges after nodes whose names differ by case only have been merged."""
    g = entity_graph(spark, d)
    return G.merge_duplicates(g, case_duplicates(g)).relations.select("src", "rel", "dst", "triple_id")


def hard_cleanup(spark: SparkSession, d: str) -> DataFrame:
    """Totals after nodes of unknown type or with noise for a name, unknown relations and loops are gone."""
    g = entity_graph(spark, d)
    g = G.Graph(g.entities.withColumn("type", C.fixed_type(F.col("type"))), g.relations)
    bad = g.entities.filter(C.unknown_type(F.col("type")) | C.noise_name(F.col("name"))).select("id")
    g = G.delete_nodes(g, bad)
    return totals(G.Graph(g.entities, g.relations.filter(~C.unknown_relation(F.col("rel")) & (F.col("src") != F.col("dst")))))


QUERIES = {
    "node_registry": _on(lambda g: g.entities.select("id", "name", "type")),
    "alias_sets": _on(lambda g: g.entities.select("id", "aliases")),
    "nodes_by_type": _on(nodes_by_type),
    "rels_by_type": _on(rels_by_type),
    "graph_totals": _on(totals),
    "edge_upsert_last": edge_upsert_last,
    "edge_upsert_first": edge_upsert_first,
    "repair_summary": repair_summary,
    "repair_statistics": repair_statistics,
    "degree_undirected": _on(lambda g: G.degree_undirected(g).select("id", "degree")),
    "degree_out_in": _on(lambda g: G.degree_in_out(g).select("id", "out", "in", "total")),
    "smoke_q1": _on(lambda g: busiest(g).select("name", "type", "out", "in", "total")),
    "smoke_q2": _on(around_busiest),
    "duplicate_candidates": _on(duplicate_candidates),
    "contained_names": _on(contained_names),
    "orphan_nodes": _on(lambda g: G.unconnected(g).select("id", "name", "type")),
    "connected_edges": _on(lambda g: G.only_connected(g.relations, g.entities.filter("type is not null")).select("src", "rel", "dst")),
    "expand_depth2": expand_depth2,
    "expand_nodes": expand_nodes,
    "self_loops": _on(lambda g: C.self_loops(g.relations).select("src", "rel", "dst")),
    "casing_fix": _on(lambda g: g.entities.withColumn("type", C.fixed_type(F.col("type"))).groupBy("type").agg(F.count("*").alias("cnt"))),
    "unknown_types": _on(lambda g: g.entities.filter(C.unknown_type(F.col("type"))).groupBy("type").agg(F.count("*").alias("cnt"))),
    "noise_nodes": _on(noise_nodes),
    "flag_relations": _on(lambda g: flagged_relations(g).select("src", "rel", "dst", "flagged", "flag_reason")),
    "flagged_counts": _on(lambda g: C.flagged_counts(flagged_relations(g), "relations")),
    "unflag_relations": _on(lambda g: C.unflag(flagged_relations(g), "low_confidence").groupBy("flagged", "flag_reason").agg(F.count("*").alias("cnt"))),
    "merge_duplicates": merged_graph,
    "hard_cleanup": hard_cleanup,
    "evidence_chain": _on(lambda g: template(g, "nl_enforces", "").orderBy(F.desc("confidence"), "a", "b", "rel").limit(20).select("a", "rel", "b", "confidence")),
    "name_search": _on(lambda g: name_search(g, "Air")),
    "nl_degree": _on(lambda g: most_connected(g).select("name", "type", "degree")),
    **{n: _on(lambda g, n=n: template(g, n, _TERM.get(n, "a"))) for n in TEMPLATES},
}


def _key(cid: str, type_: str, name: str) -> str:
    c = rf"lower(regexp_replace({cid}, '^\s+|\s+$', '', 'g'))"
    return f"case when coalesce({c}, '') <> '' then {c} else lower(coalesce(nullif(trim({type_}), ''), 'entity')) || '_' || substr(md5(lower({name})), 1, 8) end"


_REL = "case when regexp_replace(trim(coalesce(predicate, '')), '[^a-zA-Z0-9_]', '_', 'g') = '' then 'RELATED_TO' when regexp_matches(regexp_replace(trim(predicate), '[^a-zA-Z0-9_]', '_', 'g'), '^[0-9]') then 'REL_' || upper(regexp_replace(trim(predicate), '[^a-zA-Z0-9_]', '_', 'g')) else upper(regexp_replace(trim(predicate), '[^a-zA-Z0-9_]', '_', 'g')) end"
_T0 = "timestamp '1970-01-01'"


def _ends(role: str, pos: int) -> str:
    return f"select 1, coalesce(loaded_at, {_T0}), triple_id, {pos}, {_key(f'{role}_canonical_id', f'{role}_type', role)}, {role}, {role}_type, {role}_surface from t where {role} is not null"


_G = f"""with t as (select distinct * from validated_triples), m as (select distinct * from canonical_map),
  regs as (select 0 part, {_T0} ats, lpad(cast(map_id as varchar), 20, '0') seq, 0 pos, {_key('canonical_id', 'type', 'canonical_name')} id, canonical_name as name, type, surface from m where canonical_id is not null and canonical_name is not null
    union all {_ends('subject', 0)} union all {_ends('object', 1)}),
  firsts as (select id, name, type, row_number() over (partition by id order by part, ats, seq, pos) n from regs),
  al as (select id, coalesce(array_to_string(list_sort(list(distinct surface) filter (where surface is not null)), '|'), '') aliases from regs group by id),
  nodes as (select f.id, f.name, f.type, aliases from firsts f join al using (id) where n = 1),
  e0 as (select {_key('subject_canonical_id', 'subject_type', 'subject')} src, {_REL} rel, {_key('object_canonical_id', 'object_type', 'object')} dst, predicate, coalesce(confidence, 0) confidence, evidence, filename source_doc,
    coalesce(page_num, 0) source_page, chunk_id, coalesce(ontology_valid, false) ontology_valid, coalesce(violation, '') violation, triple_id, coalesce(loaded_at, {_T0}) ats from t where subject is not null and object is not null),
  edges as (select * exclude (n, ats) from (select *, row_number() over (partition by src, rel, dst order by ats desc, triple_id desc) n from e0) where n = 1),
  ends as (select src id, dst other, rel, true o from edges union all select dst, src, rel, false from edges where src <> dst),
  du as (select nodes.id, name, type, count(other) degree from nodes left join ends on nodes.id = ends.id group by all),
  dio as (select nodes.id, name, type, (select count(*) from edges where src = nodes.id) "out", (select count(*) from edges where dst = nodes.id) "in" from nodes),
  q1 as (select *, "out" + "in" total from dio order by total desc, id limit 10),
  flagged as (select *, case when src = dst then 'self_loop' when confidence < 0.6 then 'low_confidence' when rel not in ({', '.join(f"'{p.upper()}'" for p in C.PREDICATES)}) then 'unknown_relation' end flag_reason from edges),
  olds as (select *, row_number() over (partition by src, rel, dst order by ats desc, triple_id desc) n from e0 where ats < timestamp '2024-01-01'),
  news as (select *, row_number() over (partition by src, rel, dst order by ats, triple_id) n from e0 where ats >= timestamp '2024-01-01'),
  repaired as (select src, rel, dst, triple_id, cast(null as varchar) source from olds where n = 1 union all
    select src, rel, dst, triple_id, 'reextraction_pass' from news where n = 1 and not exists (select 1 from olds o where o.src = news.src and o.rel = news.rel and o.dst = news.dst)),
  seed as (select id from du order by degree desc, id limit 1),
  near as (select id from seed union select other from ends join seed using (id)),
  within as (select distinct case when o then ends.id else other end src, rel, case when o then other else ends.id end dst from ends join near using (id)),
  pair as (select a.id id_a, b.id id_b, a.name name_a, b.name name_b, a.type from nodes a join nodes b on a.type = b.type and a.id < b.id where a.name <> '' and b.name <> '' and (contains(lower(a.name), lower(b.name)) or contains(lower(b.name), lower(a.name)))),
  fixed as (select id, name, case type {' '.join(f"when '{a}' then '{b}'" for a, b in C.TYPE_FIXES.items())} else type end type from nodes),
  dups as (select id dup, canonical from (select id, min(id) over (partition by type, lower(trim(name))) canonical from nodes where name is not null and type is not null) where id <> canonical),
  moved as (select coalesce(a.canonical, src) src, rel, coalesce(b.canonical, dst) dst, triple_id, ats from (select e.*, coalesce(t.loaded_at, {_T0}) ats from edges e join (select distinct triple_id, loaded_at from t) t using (triple_id)) e left join dups a on src = a.dup left join dups b on dst = b.dup)
"""  # fmt: skip
_TYPES = ", ".join(f"'{x}'" for x in C.TYPES)


def _noise(c: str, words: bool) -> str:
    return rf"(length({c}) < 4 or regexp_matches({c}, '^[a-z]') or contains({c}, chr(10)) or suffix({c}, '.')" + (f" or len(string_split({c}, ' ')) > 9)" if words else ")")


def _template_sql(name: str) -> str:
    rels, which = TEMPLATES[name]
    term = _TERM.get(name, "a")
    r = "edges" if rels is None else f"(select * from edges where rel in ({', '.join(f"'{x}'" for x in rels)}))"
    if which in ("either", "technology"):
        r = f"(select src, rel, dst, evidence, confidence from {r} union all select dst, rel, src, evidence, confidence from {r} where src <> dst)"
    cond = {"technology": f"b.type = 'Technology' and contains(a.name, '{term}')", "a": f"contains(a.name, '{term}')", "either": f"contains(a.name, '{term}')", "b": f"contains(b.name, '{term}')", "": "true"}[which]
    return _G + f"select a.name as a, r.rel, b.name as b, b.type as b_type, r.evidence, r.confidence from {r} r join nodes a on a.id = r.src join nodes b on b.id = r.dst where {cond}"


SQL = {
    "node_registry": _G + "select id, name, type from nodes",
    "alias_sets": _G + "select id, aliases from nodes",
    "nodes_by_type": _G + "select type, count(*) as cnt from nodes group by type",
    "rels_by_type": _G + "select rel, count(*) as cnt from edges group by rel",
    "graph_totals": _G + "select 'nodes' as what, count(*) as cnt from nodes union all select 'relations', count(*) from edges",
    "edge_upsert_last": _G + "select * from edges",
    "edge_upsert_first": _G + "select * from repaired",
    "repair_summary": _G + "select rel, count(*) as cnt from repaired where source is not null group by rel",
    "repair_statistics": _G + "select (select count(*) from nodes where id not in (select src from olds union select dst from olds)) as orphans_before, (select count(*) from nodes where id not in (select src from repaired union select dst from repaired)) as orphans_after, (select count(*) from repaired where source is not null) as new_edges",
    "degree_undirected": _G + "select id, degree from du",
    "degree_out_in": _G + 'select id, "out", "in", "out" + "in" as total from dio',
    "smoke_q1": _G + 'select name, type, "out", "in", total from q1',
    "smoke_q2": _G
    + """, top as (select distinct name from (select * from q1 order by total desc, id limit 3)), ids as (select * from nodes where name in (select name from top))
      select n.name as entity, n.type as entity_type, '→' as direction, predicate, o.name as related, o.type as related_type, confidence, evidence, ontology_valid from ids n join edges on src = n.id join nodes o on o.id = dst
      union all select n.name, n.type, '←', predicate, o.name, o.type, confidence, evidence, ontology_valid from ids n join edges on dst = n.id and src <> dst join nodes o on o.id = src""",
    "duplicate_candidates": _G + "select name_a, name_b, type from pair order by type, name_a, name_b, id_a, id_b limit 20",
    "contained_names": _G + "select * from pair",
    "orphan_nodes": _G + "select id, name, type from du where degree = 0",
    "connected_edges": _G + "select src, rel, dst from edges where src in (select id from nodes where type is not null) and dst in (select id from nodes where type is not null)",
    "expand_depth2": _G + "select * from within",
    "expand_nodes": _G + "select id, name, type from nodes where id in (select src from within union select dst from within union select id from seed)",
    "self_loops": _G + "select src, rel, dst from edges where src = dst",
    "casing_fix": _G + "select type, count(*) as cnt from fixed group by type",
    "unknown_types": _G + f"select type, count(*) as cnt from nodes where type not in ({_TYPES}) group by type",
    "noise_nodes": _G + f"select id, name, {_noise('name', False)} as hard, {_noise('name', True)} as soft from nodes where {_noise('name', True)}",
    "flag_relations": _G + "select src, rel, dst, flag_reason is not null as flagged, flag_reason from flagged",
    "flagged_counts": _G + "select 'relations' as kind, flag_reason is not null as flagged, count(*) as cnt from flagged group by all",
    "unflag_relations": _G + "select flag_reason is not null and flag_reason <> 'low_confidence' as flagged, nullif(flag_reason, 'low_confidence') as flag_reason, count(*) as cnt from flagged group by all",
    "merge_duplicates": _G + "select src, rel, dst, triple_id from (select *, row_number() over (partition by src, rel, dst order by ats desc, triple_id desc) n from moved) where n = 1",
    "hard_cleanup": _G
    + f""", good as (select id from fixed where not coalesce(type not in ({_TYPES}), false) and not coalesce({_noise('name', False)}, false)) select 'nodes' as what, count(*) as cnt from good
      union all select 'relations', count(*) from edges where src in (select id from good) and dst in (select id from good) and src <> dst and rel in ({', '.join(f"'{p.upper()}'" for p in C.PREDICATES)})""",
    "evidence_chain": _G + "select a.name as a, rel, b.name as b, confidence from edges join nodes a on a.id = src join nodes b on b.id = dst where rel in ('ENFORCES', 'REGULATES') order by confidence desc, a, b, rel limit 20",
    "name_search": _G + "select name, type, aliases from nodes where contains(name, 'Air') order by name, id limit 20",
    "nl_degree": _G + "select name, type, degree from du order by degree desc, id limit 20",
    **{n: _template_sql(n) for n in TEMPLATES},
}
