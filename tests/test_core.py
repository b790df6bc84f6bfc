"""Hand-computed cases of the core operators."""

import json
import random

import pytest
from pyspark.sql import functions as F

from loomgraph.functions import ids as I
from loomgraph.functions import text as T
from loomgraph.operators import agency as A
from loomgraph.operators import chunking as K
from loomgraph.operators import cleanup as C
from loomgraph.operators import evidence as E
from loomgraph.operators import graph as G
from loomgraph.operators import orphans as O
from loomgraph.operators import resolve as R
from loomgraph.operators import review as RV
from loomgraph.operators import validate as V
from loomgraph.plans import pack
from loomgraph.plans import pipeline_queries as Q
from loomgraph.sources import files as S
from loomgraph.sources.store import GraphStore
from loomgraph.streaming.incremental import process_new, windowed_counts


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first().y


# ---- functions -----------------------------------------------------------------------------------
def test_ids(spark):
    r = spark.createDataFrame([("GovernmentAgency", "National Environment Agency")], "t string, n string").select(I.entity_id("t", "n").alias("e"), I.stable_id("topic", F.lit("Café  au lait!")).alias("s"), I.stable_id("topic", F.lit("")).alias("u"), I.division_id(F.lit("Arts & Co")).alias("d")).first()
    assert r.e == "governmentagency_223f3380"
    assert r.s.startswith("topic_cafe_au_lait_") and len(r.s.rsplit("_", 1)[1]) == 10
    assert r.u == "topic_unknown" and r.d == "division_arts_co"


def test_text_functions(spark):
    assert one(spark, "One. Two! 3? four", T.sentences) == ["One.", "Two!", "3?", "four"]
    assert one(spark, "10. 9.", T.sentences) == ["10.", "9."]
    assert one(spark, "a\n\n\nb \n\n \n\nc", T.paragraphs) == ["a", "b", "c"]
    assert [tuple(x) for x in one(spark, "pre\n# H one\nbody\n## Two\n\nmore", T.sections)] == [("", "pre"), ("H one", "body"), ("Two", "more")]
    assert one(spark, "A. B. C.", T.overlap_tail) == "B. C." and one(spark, "Only.", T.overlap_tail) == "Only."
    assert one(spark, "a  b\n", T.squeeze) == "a b" and one(spark, None, T.squeeze) == ""
    assert one(spark, "1st rule", T.relation_name) == "REL_1ST_RULE" and one(spark, " ", T.relation_name) == "RELATED_TO" and one(spark, "3d-x", T.label_name) == "T_3d_x"
    assert one(spark, [["h", None], ["a", "b", "c"], ["d"]], T.table_markdown, "array<array<string>>") == "| h |  |\n| --- | --- |\n| a | b |\n| d |  |"
    assert one(spark, "", T.year_of) == "Unknown" and one(spark, "2021-03", T.year_of) == "2021" and one(spark, "03/04/2019", T.parsed_year) == 2019
    assert one(spark, "x</think> y", T.without_thoughts) == "y" and one(spark, "y <think> z", T.without_thoughts) == "y"


@pytest.mark.parametrize(("reply", "want"), [('{"a": 1}', '{"a": 1}'), ('text ```json\n{"a": 2}\n``` more', '{"a": 2}'), ('so {"a": {"b": 3}} then', '{"a": {"b": 3}}'), ("none", None), ("{bad}", None)])
def test_json_blocks(spark, reply, want):
    assert T.json_block(reply) == want and one(spark, reply, T.extract_json) == want and one(spark, reply, T.extract_json_fenced) == want


# ---- chunks ----------------------------------------------------------------------------------------
def items(spark, rows):
    return spark.createDataFrame([("d", "f", i + 1, 1, k, t, None) for i, (k, t) in enumerate(rows)], "doc_id string, filename string, seq int, page_num int, content_type string, text string, raw_table array<array<string>>")


def merge_by_hand(parts, least=300):
    out = []
    for kind, t in parts:
        if out and kind != "table" and out[-1][0] != "table" and len(out[-1][1]) < least:
            out[-1] = (out[-1][0], out[-1][1] + "\n\n" + t)
        else:
            out.append((kind, t))
    return out


def test_short_chunks_merge_until_a_table(spark):
    parts = [("text", "a" * 100), ("text", "b" * 150), ("text", "c" * 80), ("text", "d" * 400), ("table", "|t|"), ("text", "e" * 10), ("table", "|u|"), ("table", "|v|"), ("text", "f"), ("text", "g")]
    got = [(r.content_type, r.text) for r in K.chunk_items(items(spark, parts)).orderBy("chunk_index").collect()]
    assert got == merge_by_hand(parts)
    assert [len(t) for k, t in got[:2]] == [334, 400]
    ids = [r.chunk_index for r in K.chunk_items(items(spark, parts)).orderBy("chunk_index").collect()]
    assert ids == list(range(len(got)))


def test_chunks_of_several_documents_merge_across_batches(spark):
    r = random.Random(5)
    docs = {f"d{k}": [("table", "|t|") if r.random() < 0.1 else ("text", "x" * r.choice([1, 2, 120, 297, 298, 299, 300, 301])) for _ in range(60)] for k in range(5)}
    flat = [(d, "f", i + 1, 1, k, t, None) for d, parts in docs.items() for i, (k, t) in enumerate(parts)]
    df = spark.createDataFrame(r.sample(flat, len(flat)), "doc_id string, filename string, seq int, page_num int, content_type string, text string, raw_table array<array<string>>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = K.chunk_items(df).orderBy("doc_id", "chunk_index").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [(r.doc_id, r.chunk_index, r.content_type, r.text) for r in got] == [(d, i, k, t) for d, parts in docs.items() for i, (k, t) in enumerate(merge_by_hand(parts))]


CHUNKS = "chunk_id string, chunk_index int, doc_id string, filename string, page_num int, section_heading string, content_type string, text string, raw_table array<array<string>>, loaded_at string"


def held(spark, run):
    """Most bytes that a stage of ``run`` holds or spills, and what it returns."""
    sc, gateway = spark.sparkContext._jsc.sc(), spark.sparkContext._gateway

    def stages():
        sc.listenerBus().waitUntilEmpty()
        every = sc.statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return {x.stageId(): x.peakExecutionMemory() + x.memoryBytesSpilled() for x in (every.apply(i) for i in range(every.size()))}

    before, out = stages(), run()
    return max(n for k, n in stages().items() if k not in before), out


def test_merged_chunks_without_a_table_between_them(spark, tmp_path):
    """One page of many texts and no table: what a stage holds follows the texts, not their number times their length."""
    r = random.Random(3)
    texts = ["".join(r.choices("abcdefghij ", k=r.choice([200, 700]))).strip() + "." for _ in range(2000)]
    spark.createDataFrame([(f"c{i}", i, "d", "f", 1, "", "text", t, None, "") for i, t in enumerate(texts)], CHUNKS).write.parquet(f"{tmp_path}/chunks.parquet")
    most, got = held(spark, lambda: Q.merged_chunks(spark, str(tmp_path)).orderBy("chunk_index").collect())
    assert [r.n_chars for r in got] == [len(t) for _, t in merge_by_hand([("text", t) for t in texts])]
    assert most < 1 << 29


def test_merged_chunks_of_odd_rows_as_in_sql(spark, tmp_path):
    from tools.compare import differs, duck

    short, long = "Alpha beta. Gamma delta.", "Long words here. " * 30
    rows = [
        ("c1", 0, "d", "f", 1, "", "text", short, None, "1"),
        ("c1", 0, "d", "f", 1, "", "text", short, None, "2"),  # a second delivery
        ("c2", 1, "d", "f", 1, "", "text", f"{short}\n\n{short}\n# Head\nbody", None, "1"),
        ("c3", 2, "d", "f", 1, "", "table", None, [["a", "b"]], "1"),
        ("c3", 2, "d", "f", 1, "", "table", None, [["a"], ["b"]], "1"),  # another table under the same id
        ("c3", 2, "d", "f", 1, "", "table", "", [["a"], ["b", None]], "1"),
        ("c4", 3, "d", "f", None, "", "text", long, None, "1"),
        ("c5", 4, "d", "f", None, "", "text", None, None, "1"),
        ("c6", 5, "d", "f", None, "", "text", "", None, "1"),
        ("c7", 6, "d", "f", None, "", "text", "# Only a heading\n", None, "1"),
        ("c8", 7, "d", "f", None, "", None, short, None, "1"),
        ("c9", None, "d", "f", 2, "", "figure", short, None, "1"),
        (None, 9, "e", "g", 1, "", "text", "# No id\n" + long, None, "1"),
        ("ca", 9, "e", "g", 1, "", "text", "# An id\nfew words", None, "1"),
        ("cb", 0, "e", "g", 1, "", "text", f"{long}\n\ntail", None, "1"),
        ("cc", 0, None, "g", 1, "", "text", short, None, "1"),
    ]
    spark.createDataFrame(rows, CHUNKS).write.parquet(f"{tmp_path}/chunks.parquet")
    assert differs(spark, duck(str(tmp_path)), str(tmp_path), "merged_chunks") == ""


def test_overlap_is_by_item(spark):
    x = K.item_chunks(items(spark, [("text", "A. B. C.\n\nD."), ("text", "E.\n\nF."), ("text", "# Empty\n"), ("text", None)]))
    assert [r.text for r in x.orderBy("seq", "part").collect()] == ["A. B. C.", "B. C. D.", "E.", "E. F."]


def test_scanned(spark):
    p = spark.createDataFrame([("a", "x" * 200), ("b", "x"), ("b", None)], "doc_id string, text string")
    assert {r.doc_id: r.scanned for r in K.scanned(p).collect()} == {"a": False, "b": True}


# ---- cleaning --------------------------------------------------------------------------------------
@pytest.mark.parametrize(
    ("name", "want"),
    [(None, "not_a_string"), ("abc", "too_short"), ("Abcd", ""), ("A" * 60, ""), ("A" * 61, "too_long"), ("élan vital", "starts_lowercase"), ("A b c d e f g h", ""), ("A b c d e f g h i", "too_many_words"), ("Name.", "ends_with_period"), ("Na\nme", "contains_newline"), ("This report on", "boilerplate:This report")],
)
def test_name_reasons(spark, name, want):
    assert one(spark, name, V.name_reason) == want


def test_first_broken_rule_and_case_of_predicates(spark):
    rows = [("Body One", "Organisation", "owns", "Plant Two", "Facility", 0.1), ("Body One", "Organisation", "OPERATES", "Plant Two", "Facility", 0.9), ("Body One", "", "operates", "Plant Two", "Nope", 0.9), ("Body One", "Person", "operates", "Plant Two", "Metric", 0.9)]
    df = spark.createDataFrame(rows, "subject string, subject_type string, predicate string, object string, object_type string, confidence double")
    c = [F.col(x) for x in ("subject", "subject_type", "predicate", "object", "object_type", "confidence")]
    assert [r.x for r in df.select(V.triple_reason(*c).alias("x")).collect()] == ["invalid_predicate:owns", "", "invalid_object_type:Nope", ""]
    got = {r.predicate + (r.object_type or ""): (r.ontology_valid, r.violation) for r in V.check(df).collect()}
    assert got["OPERATESFacility"] == (False, "Unknown predicate: 'OPERATES'")
    assert got["operatesMetric"][1] == "Subject type 'Person' not allowed for 'operates'; Object type 'Metric' not allowed for 'operates'"
    assert "Flagged: 3" in V.report(V.check(df))


# ---- graph -----------------------------------------------------------------------------------------
EDGE = "src string, rel string, dst string, predicate string, confidence double, evidence string, source_doc string, source_page int, chunk_id string, ontology_valid boolean, violation string, triple_id string, loaded_at timestamp_ntz"


def graph(spark, edges, nodes="abcd"):
    import datetime as dt

    e = spark.createDataFrame([(s, r, d, r.lower(), 0.5, f"e{i}", "f", 1, "c", True, "", f"t{i}", dt.datetime(2024, 1, 1 + i)) for i, (s, r, d) in enumerate(edges)], EDGE)
    n = spark.createDataFrame([(x, f"Name {x}", "Organisation", [x.upper()]) for x in nodes], "id string, name string, type string, aliases array<string>")
    return G.Graph(n, e)


def test_last_and_first_write_and_idempotence(spark):
    g = graph(spark, [("a", "R", "b"), ("a", "R", "b"), ("b", "S", "c")])
    last, first = G.merge_edges_last(g.relations), G.merge_edges_first(g.relations)
    assert {r.evidence for r in last.collect()} == {"e1", "e2"} and {r.evidence for r in first.collect()} == {"e0", "e2"}
    twice = G.upsert_edges(last, last)
    assert sorted(map(tuple, twice.select(last.columns).collect())) == sorted(map(tuple, last.collect()))
    repair = G.upsert_edges(last, first.withColumn("evidence", F.lit("new")), overwrite=False, source="pass")
    assert {r.evidence for r in repair.collect()} == {"e1", "e2"}
    assert {r.n for r in [G.duplicate_keys(last, "src", "rel", "dst").agg(F.count("*").alias("n")).first()]} == {0}


def test_degrees_of_a_loop_and_of_nothing(spark):
    g = graph(spark, [("a", "R", "a"), ("a", "R", "b")])
    assert {r.id: r.degree for r in G.degree_undirected(g).collect()} == {"a": 2, "b": 1, "c": 0, "d": 0}
    assert {r.id: r.total for r in G.degree_in_out(g).collect()} == {"a": 3, "b": 1, "c": 0, "d": 0}
    assert {r.id for r in G.unconnected(g).collect()} == {"c", "d"}


def test_expand_merge_delete(spark):
    g = graph(spark, [("a", "R", "b"), ("c", "R", "b"), ("c", "S", "d"), ("d", "S", "d")])
    nodes, edges = G.expand(g, spark.createDataFrame([("a",)], "id string"), 2)
    assert {r.id for r in nodes.collect()} == {"a", "b", "c"} and {(r.src, r.dst) for r in edges.collect()} == {("a", "b"), ("c", "b")}
    alone, none = G.expand(graph(spark, [("a", "R", "b")]), spark.createDataFrame([("d",)], "id string"), 2)
    assert {r.id for r in alone.collect()} == {"d"} and none.count() == 0
    m = G.merge_duplicates(g, spark.createDataFrame([("c", "a")], "dup string, canonical string"))
    assert {(r.src, r.rel, r.dst) for r in m.relations.collect()} == {("a", "R", "b"), ("a", "S", "d"), ("d", "S", "d")}
    assert {r.id: r.aliases for r in m.entities.collect()}["a"] == ["A", "C"]
    d = G.delete_nodes(g, spark.createDataFrame([("b",)], "id string"))
    assert {(r.src, r.dst) for r in d.relations.collect()} == {("c", "d"), ("d", "d")}
    assert G.delete_edges(g, ["S"]).relations.count() == 2 and C.self_loops(g.relations).count() == 1


def test_flags(spark):
    df = spark.createDataFrame([("Abcd", 0.9), ("abcd", 0.1), ("Abc", 0.9)], "name string, c double")
    f = C.flag(df, [("noise", C.noise_name(F.col("name"))), ("weak", F.col("c") < 0.5)])
    assert [(r.flagged, r.flag_reason) for r in f.collect()] == [(False, None), (True, "weak"), (True, "noise")]
    assert [r.flagged for r in C.unflag(f, "weak").collect()] == [False, False, True]


def test_store(spark, tmp_path):
    g = graph(spark, [("a", "R", "b")])
    s = GraphStore(spark, str(tmp_path))
    first = s.save(g)
    s.save(G.Graph(g.entities, g.relations.limit(0)))
    assert s.load().relations.count() == 0 and s.load(first).relations.count() == 1
    assert s.run(lambda g, n: g.entities.limit(n), n=2).count() == 2


# ---- resolution ------------------------------------------------------------------------------------
def test_links_in_every_type_election_and_collision(spark):
    e = spark.createDataFrame([(1, "NEB", "Body", ["Northern Estuary Board"]), (2, "Northern Estuary Board", "Body", None), (3, "NEB", "Place", []), (4, "Lone", "Place", [])], "seq int, name string, type string, aliases array<string>")
    e = e.withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))
    f = R.surfaces(e)
    links = R.alias_links(e, f)
    assert [tuple(r) for r in links.collect()] == [("Body", "NEB", "Northern Estuary Board")]
    m = {r.surface: (r.canonical_name, r.type) for r in R.canonical_map(f, links).collect()}
    assert m == {"NEB": ("NEB", "Place"), "Northern Estuary Board": ("Northern Estuary Board", "Body"), "Lone": ("Lone", "Place")}


def test_long_chain_settles(spark):
    names = [f"n{i:03d}" for i in range(60)]
    f = spark.createDataFrame([("t", n, 1) for n in names], "type string, name string, seen int")
    l = spark.createDataFrame([("t", a, b) for a, b in zip(names, names[1:], strict=False)], "type string, a string, b string")
    assert {r.root for r in R.clusters(f, l).collect()} == {"n000"}


# ---- agency ----------------------------------------------------------------------------------------
def test_mapping_ids_and_order_of_rules(spark):
    raw = spark.createDataFrame([("1", "X", "T1", "  "), ("2", "X", "T2", "later text"), ("3", "", "Some title", "t  x"), ("4", "Y", "", "y")], "q string, id_col string, title_col string, body_col string")
    d = A.canonical_documents(raw, {"doc_id": "id_col", "title": "title_col", "text": "body_col"}, F.col("q"))
    got = {r.doc_id: (r.title, r.text, r.division) for r in d.collect()}
    assert "X" not in got and got["Y"] == ("", "y", "")
    assert [k for k in got if k.startswith("doc_some_title_")] and len(got) == 2


def test_blank_rates(spark):
    df = spark.createDataFrame([("a", " "), (None, "b"), ("c", "d")], "x string, y string")
    assert {r["column"]: r.blank_rate for r in A.blank_rates(df).collect()} == {"x": 0.3333, "y": 0.3333}
    assert {r.blank_rate for r in A.blank_rates(df.limit(0)).collect()} == {1.0}
    assert A.schema_report("t", df, ["x", "z"], ["y"])["missing_required"] == ["z"] and A.schema_report("t", None, ["x"], [])["status"] == "issues"


def test_load_and_payload(spark):
    docs = spark.createDataFrame([("d1", "t", "x", "Arts"), ("d2", "t", "x", "Arts"), ("d3", "t", "x", "Parks")], "doc_id string, title string, text string, division string")
    div = spark.createDataFrame([("DIV_A", "Arts")], "division_id string, name string")
    ini = spark.createDataFrame([("I1", "One", "old")], "initiative_id string, name string, description string")
    links = spark.createDataFrame([("d1", "I1"), ("d2", "I1"), ("d3", "I1"), ("d3", "I9"), ("zz", "I1")], "doc_id string, initiative_id string")
    g = A.load(docs, div, ini, links)
    assert g.nodes["Division"].count() == 3 and {r.id for r in g.nodes["Initiative"].collect()} == {"I1", "I9"}
    assert {(r.src, r.dst) for r in g.out("OWNED_BY").collect()} == {("I1", "division_arts"), ("I9", "division_parks")}
    p = {"doc_id": "", "entities": {"topics": [{"name": " Water "}, {"name": ""}], "learnings": [{"text": "L"}], "initiatives": [{"name": "New", "description": ""}]}, "relations": [
        {"source_type": "Document", "rel": "MENTIONS", "target_type": "Topic", "target_value": "Water"}, {"source_type": "Document", "rel": "MENTIONS", "target_type": "Topic", "target_value": " "}, {"source_type": "Learning", "source_value": "L", "rel": "RELATES_TO", "target_type": "Topic", "target_value": "Water"},
        {"source_type": "Topic", "rel": "MENTIONS", "target_type": "Document", "target_value": "x"}]}
    parsed = A.parse_payload(spark.createDataFrame([("d1", json.dumps(p))], "doc_id string, json string"))
    r = parsed.first().p
    assert r.doc_id == "d1" and r.topics == ["Water"] and len(r.relations) == 3
    g2 = A.apply_payload(A.apply_payload(g, parsed), parsed)
    assert sorted((x.type) for x in g2.edges.filter("type in ('MENTIONS', 'RELATES_TO')").collect()) == ["MENTIONS", "RELATES_TO"]
    assert g2.nodes["Topic"].count() == 1 and g2.nodes["Initiative"].count() == 3


# ---- registry, evidence, review, orphans ---------------------------------------------------------------
def test_registry(spark):
    assert {"cross_division_initiatives", "shared_learnings_between_divisions", "topic_co_occurrence", "filing_health_by_division_time", "recurring_issues_over_time"} <= set(pack.REGISTRY)
    seen = {}
    pack.register_query(pack.QuerySpec("probe", "", "", {"limit": {"default": 15}}, lambda g, p: seen.update(p), ()))
    pack.run_query(None, "probe")
    assert seen == {"limit": 15}
    pack.run_query(None, "probe", {"limit": 3})
    assert seen == {"limit": 3}
    with pytest.raises(KeyError):
        pack.run_query(None, "nothing")
    pack.REGISTRY.pop("probe")


def test_least_keeps_few(spark):
    df = spark.range(100).selectExpr("id % 2 as k", "cast(id as string) as v")
    assert {r.k: r.o for r in pack.least(df, ["k"], "v", 3, "o").collect()} == {0: ["0", "10", "12"], 1: ["1", "11", "13"]}


def test_evidence(spark):
    rows = spark.createDataFrame([("A", "B", 2, ["d1", "d2"])], "topic_a string, topic_b string, count int, doc_ids array<string>")
    docs = spark.createDataFrame([("d1", "One", "2020")], "id string, title string, date string")
    e = E.envelope("topic_co_occurrence", {"limit": 1}, rows, docs)
    assert len(e["nodes"]) == 4 and {x["type"] for x in e["edges"]} == {"CO_OCCURS", "EVIDENCES"} and {d["title"] for d in e["documents"]} == {"One", "Unknown"}
    assert "| A | B | 2 | d1, d2 |" in E.insights([("Topics", rows), ("None", rows.limit(0))]) and "No rows." in E.insights([("None", rows.limit(0))])


def test_routing_and_guards():
    assert E.route("Which initiatives cross divisions?")[1] == "cross_division_initiatives" and E.route("metadata gaps")[0] == "filing-health" and E.route("hello")[0] == "general-explore"
    assert E.infer_limit("top 12 topics", 5) == 12 and E.infer_limit("in 2020", 5) == 5 and E.infer_limit("top 900", 5) == 5
    assert E.is_read_only("MATCH (n)-[:SET_TARGET]->() RETURN n") and not E.is_read_only("MATCH (n) SET n.x = 1") and not E.is_read_only("match (n) where n.x = 'delete' return n")
    assert E.statement_of("<think>x</think>```text\nMATCH (n) RETURN n\n```") == "MATCH (n) RETURN n" and E.statement_of("Sure: MATCH (n) RETURN n") == "MATCH (n) RETURN n"
    assert E.search_term("what does Alpha do") == "Alpha"


def test_review(spark):
    rows = [(1, "d", "ENQUEUE", None, "", None, "{}", "1"), (2, "d", "ENQUEUE", None, "", None, "{}", "2"), (3, "e", "ENQUEUE", None, "", None, "{}", "3"), (1, None, "APPROVE", " ", "", '{"a":1}', None, "4"), (2, None, "whatever", "ann", "", None, None, "5")]
    ev = spark.createDataFrame(rows, RV.EVENTS)
    got = {r.pending_id: (r.status, r.reviewer, r.extraction_json) for r in RV.latest(ev).collect()}
    assert got == {1: ("APPROVED", "unknown", '{"a":1}'), 2: ("REJECTED", "ann", "{}"), 3: ("PENDING", None, "{}")}
    assert [r.pending_id for r in RV.listing(ev).collect()] == [3] and RV.counts_by_document(ev).first().pending == 1 and RV.audit(ev).count() == 2


def test_orphans(spark):
    ex = spark.createDataFrame([("c1", "d", "f", "Alone"), ("c1", "d", "f", "Other"), ("c2", "d", "f", "Alone")], "chunk_id string, doc_id string, filename string, name string")
    tr = spark.createDataFrame([("t1", "c1")], "triple_id string, chunk_id string")
    ch = spark.createDataFrame([("c1", "x" * 60)], "chunk_id string, text string")
    o = O.orphan_chunks(ex, tr, ch, spark.createDataFrame([("Alone",), (" ",)], "name string"))
    assert {r.chunk_id: (r.orphan_entities, r.original_triple_count, len(r.text)) for r in o.collect()} == {"c1": (["Alone"], 1, 60), "c2": (["Alone"], 0, 0)}
    r = O.orphan_report(o).first()
    assert (r.orphans, r.without_triples, r.with_triples) == (2, 1, 1) and O.usable(o).count() == 1


def test_known_entities_of_all_types(spark, tmp_path):
    rows = [(1, "a", "r1", "Act", "Regulation"), (2, "b", "p1", "Bo", "Person"), (3, "a", "o1", "Cy", "Organisation"), (4, "d", "n1", "Di", None), (5, "e", "r1", "Later", "Regulation"), (6, "f", None, "No id", "Person"), (7, "g", "x1", None, "Person"), (2, "b", "p1", "Bo", "Person")]
    spark.createDataFrame(rows, "map_id bigint, surface string, canonical_id string, canonical_name string, type string").write.parquet(f"{tmp_path}/canonical_map.parquet")
    got = Q.QUERIES["known_entities"](spark, str(tmp_path))
    assert [tuple(r) for r in got.collect()] == [("r1", "Act (Regulation)"), ("p1", "Bo (Person)"), ("o1", "Cy (Organisation)"), ("n1", "Di")]
    assert R.hint(got).first().hint == "Act (Regulation)\nBo (Person)\nCy (Organisation)\nDi" and R.hint(got.limit(0)).first().hint == ""


def test_usable_chunks_are_not_capped(spark, monkeypatch):
    found = spark.range(25).select(F.col("id").cast("string").alias("chunk_id"), F.when(F.col("id") == 7, F.lit("x" * 50)).otherwise(F.lit("y" * 51)).alias("text"))
    monkeypatch.setattr(Q, "_orphan_chunks", lambda s, d: found)
    got = {r.chunk_id: r.n_chars for r in Q.QUERIES["usable_chunks"](spark, "").collect()}
    assert got == {str(i): 51 for i in range(25) if i != 7}


# ---- sources and streaming -------------------------------------------------------------------------
def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"chunk_id": "1", "text": "a"}\n\n{bad\n{"text": "no key"}\n')
    df = S.read_lines(spark, str(tmp_path), S.CHUNK, strict=False, needs="chunk_id")
    assert [r.chunk_id for r in df.collect()] == ["1"]
    with pytest.raises(Exception):
        S.read_lines(spark, str(tmp_path), S.CHUNK).collect()


def test_extraction_triples(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text(json.dumps({"chunk_id": "c", "triples": [{"subject": "A", "confidence": "0.7"}, {"subject": "B", "confidence": "high"}, {"subject": "C"}]}) + "\n")
    got = S.triples_of(S.read_lines(spark, str(tmp_path), S.RAW_EXTRACTION)).orderBy("pos").collect()
    assert [(r.subject, r.confidence) for r in got] == [("A", 0.7), ("B", None), ("C", 0.0)]


def test_files_pages_and_hooks(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"first page text that is long enough|two")
    (tmp_path / "b.PDF").write_bytes(b" ")
    (tmp_path / "c.txt").write_bytes(b"no")
    f = S.scan_binary(spark, str(tmp_path))
    assert {r.filename for r in f.collect()} == {"a.pdf", "b.PDF"}
    assert S.unseen(f, f.filter("filename = 'a.pdf'")).count() == 1

    def pages(data, name):
        if not data.strip():
            raise ValueError
        return [{"page_num": i + 1, "text": t} for i, t in enumerate(data.decode().split("|"))]

    items = S.extract_pages(f, pages, tables=lambda d, n: [{"page_num": 1, "raw_table": [["h"], ["v"]]}], ocr=lambda d, n: [{"page_num": 1, "text": "read by eye"}], least=5)
    got = {(r.filename, r.content_type, r.extraction_method): r.text for r in items.collect()}
    assert got[("b.PDF", "text", "ocr")] == "read by eye" and got[("a.pdf", "table", "text")] == "| h |\n| --- |\n| v |" and items.count() == 5
    r = S.complete_with(spark.createDataFrame([("hi",), ("boom",)], "p string"), "p", lambda p: {"hi": "there"}[p]).collect()
    assert [x.reply for x in r] == ["there", None]


def test_csv_and_mapping(spark, tmp_path):
    (tmp_path / "docs.csv").write_text('id,body\n1,"a, ""b""\nc"\n,\n')
    assert [tuple(r) for r in S.read_csv(spark, str(tmp_path / "docs.csv")).collect()] == [("1", 'a, "b"\nc'), ("", "")]
    assert S.read_csv(spark, str(tmp_path / "none.csv"), ["id"]).count() == 0
    (tmp_path / "m.json").write_text(json.dumps({"documents": {"file": "docs.csv", "columns": {"doc_id": "id"}}}))
    assert S.load_mapping(str(tmp_path / "m.json"))["documents"]["file"] == "docs.csv"
    (tmp_path / "bad.json").write_text("{}")
    with pytest.raises(ValueError):
        S.load_mapping(str(tmp_path / "bad.json"))
    assert S.resolve_file("docs.csv", str(tmp_path)) == str(tmp_path / "docs.csv")
    with pytest.raises(FileNotFoundError):
        S.resolve_file("docs.none", str(tmp_path))
    n = S.write_canonical({"documents": S.read_csv(spark, str(tmp_path / "docs.csv"))}, str(tmp_path))
    assert n == {"documents": 2} and json.loads((tmp_path / "canonicalization_summary.json").read_text()) == n


def test_incremental(spark, tmp_path):
    src, sink, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    (tmp_path / "in").mkdir()
    work = lambda df: df.select("chunk_id", F.length("text").alias("n"))
    for n, keys in enumerate((["1", "2", "2"], ["2", "3"])):
        (tmp_path / "in" / f"{n}.json").write_text("\n".join(json.dumps({"chunk_id": k, "text": k}) for k in keys))
        process_new(spark, src, "chunk_id string, text string", work, sink, ck).awaitTermination()
    assert sorted(r.chunk_id for r in spark.read.parquet(sink).collect()) == ["1", "2", "3"]


def test_windows(spark):
    df = spark.sql("select timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id * 3) as ts from range(10)")
    assert sorted(r.n for r in windowed_counts(df, "ts", "10 minutes").collect()) == [3, 3, 4]
    assert windowed_counts(df, "ts", "10 minutes", "5 minutes").count() > 3
