import json

import pytest
from pyspark.sql import functions as F

from loomgraph.operators import cleanup as C
from loomgraph.operators import evidence as E
from loomgraph.operators import graph as G
from loomgraph.operators import prompts as P
from loomgraph.operators import review as R
from loomgraph.sources import files as S

PAYLOAD = json.dumps({"doc_id": " d1 ", "entities": {"topics": [{"name": "Water "}, "x"], "learnings": [{"text": "t"}], "odd": 3}, "relations": [{"source_type": "Document", "rel": "MENTIONS", "target_value": ""}, None]})


def test_review_is_written_as_events(spark, tmp_path):
    put = spark.createDataFrame([(1, PAYLOAD, "2024-01-01"), (2, '{"doc_id": " "}', "2024-01-01"), (3, '{"doc_id": "d3"}', "2024-01-02"), (4, None, "2024-01-02")], "pending_id bigint, payload string, created_at string")
    path = str(tmp_path / "events")
    R.append(R.enqueue(put), path)
    R.append(R.edit(spark.createDataFrame([(3, '{"doc_id": "d3", "edited": 1}', "2024-01-03")], "pending_id bigint, payload string, created_at string")), path)
    R.append(R.decide(spark.createDataFrame([(1, "approve", "", "fine", "2024-01-04")], "pending_id bigint, action string, reviewer string, notes string, created_at string")), path)
    now = {r.pending_id: r for r in R.latest(R.load(spark, path)).collect()}
    assert set(now) == {1, 3} and now[1].status == "APPROVED" and now[1].reviewer == "unknown" and now[1].doc_id == "d1"
    assert now[3].status == "PENDING" and json.loads(now[3].extraction_json)["edited"] == 1
    assert [r.pending_id for r in R.listing(R.load(spark, path)).collect()] == [3]
    state = R.latest(R.load(spark, path))
    assert {(r.entity_type, r.name, r.text) for r in R.entities_of(state).collect()} == {("topics", "Water", None), ("learnings", None, "t")}
    assert [(r.pending_id, r.rel, r.target_value) for r in R.relations_of(state).collect()] == [(1, "MENTIONS", None)]
    assert R.audit(R.load(spark, path)).count() == 2


def test_prompts(spark):
    df = spark.createDataFrame([("d", "Some {text}", None, ["A", "B"], [("q1", "a" * 500)] * 4), ("e", None, "Name (Type)", [], None)], "id string, text string, known string, names array<string>, history array<struct<question:string,answer:string>>")
    a, b = df.select(
        P.triple_prompt(F.col("text"), ["T1", "T2"], ["p1"], F.col("known")).alias("triple"), P.payload_prompt(F.col("id"), F.col("text")).alias("payload"), P.repair_prompt(F.col("text"), F.col("names"), ["T1"], ["p1"]).alias("repair"),
        P.query_prompt(F.lit("Why?"), "(:A)-[:B]->(:C)", F.col("history")).alias("query"), P.answer_prompt(F.lit("Why?"), F.array_repeat(F.lit("row"), 50), F.col("history")).alias("answer"),
    ).collect()
    assert a.triple.endswith("Some {text}") and "T1 | T2" in a.triple and "already in use" not in a.triple and "Name (Type)" in b.triple
    assert "document d and" in a.payload and "relation yet: A, B" in a.repair and b.repair.endswith("Text:\n")
    assert a.query.count("Q: q1") == P.TURNS and a.query.count("a" * 200) == 3 and "a" * 201 not in a.query and "Earlier" not in b.query
    assert a.answer.count("row\n") + a.answer.endswith("row") == P.SHOWN_ROWS + 0 and "a" * 300 in a.answer


def test_hooks():
    with pytest.raises(RuntimeError):
        P.llm()
    P.set_llm(str.upper)
    assert P.llm()("x") == "X"
    P.set_llm(None)
    with pytest.raises(RuntimeError):
        P.embedder()


def test_shapes(spark):
    rows = spark.createDataFrame([("a", "b", 3, "2020"), ("a", " ", 2, "2021"), ("c", "a", 1, None)], "topic_a string, topic_b string, count int, year string")
    assert [r.line for r in E.as_list(rows, "topic_a", "count").orderBy("rank").collect()] == ["1. a (3)", "2. a (2)", "3. c (1)"]
    nodes, edges = E.as_graph(rows)
    assert {r.id for r in nodes.collect()} == {"a", "b", "c"} and edges.count() == 2
    assert [(r.series, r.x, r.step) for r in E.as_timeline(rows, "year", "count", None).orderBy("step").collect()] == [("", None, 1), ("", "2020", 2), ("", "2021", 3)]
    ev = spark.createDataFrame([("said", "f.pdf", 3), (" ", "f.pdf", 1), (None, None, None), ("more", "", 2)], "`r.evidence` string, `r.source_doc` string, `r.source_page` int")
    assert {(r.evidence, r.location) for r in E.chat_evidence(ev).collect()} == {("said", "f.pdf p.3"), ("more", "")}
    marked = E.highlight(spark.createDataFrame([("a", "b"), ("b", "c")], "source string, target string"), spark.createDataFrame([("b", "a"), ("b", "a")], "source string, target string"))
    assert {(r.source, r.highlighted) for r in marked.collect()} == {("a", True), ("b", False)}
    chunks = spark.createDataFrame([("f", ["x", "y"], 0), ("g", ["x"], 2), (None, ["z"], 1)], "filename string, orphan_entities array<string>, original_triple_count int")
    text = E.orphan_text(9, chunks)
    assert "chunks that hold one:     3" in text and "without any triple:     1" in text and text.index("  f") < text.index("  g")


def test_one_row_subgraph(spark):
    nodes = spark.createDataFrame([("1", "N", "Type"), ("2", "M", None)], "id string, name string, type string")
    edges = spark.createDataFrame([("1", "R", "2")], "src string, rel string, dst string")
    r = G.one_row(nodes, edges).collect()
    assert len(r) == 1 and [n.element_id for n in r[0].nodes] == ["1", "2"] and r[0].relationships[0].asDict() == {"type": "R", "start": "1", "end": "2", "props": "{}"}
    empty = G.one_row(nodes.limit(0), edges.limit(0)).collect()
    assert len(empty) == 1 and not empty[0].nodes and not empty[0].relationships


def test_script_samples_and_map(spark, tmp_path):
    t = spark.range(100).toDF("id")
    now = C.run_script({"a": t}, [("b", lambda x: x["a"].filter("id < 60")), ("a", lambda x: x["b"].filter("id >= 55"))])
    assert now["a"].count() == 5 and now["b"].count() == 60
    assert [r.id for r in C.sample(t, ["id"], 3).collect()] == [0, 1, 2] and C.sample(t, ["id"]).count() == 50
    (tmp_path / "map.json").write_text(json.dumps({"NEA": {"canonical_id": "x", "canonical_name": "N", "type": None}, "": {}}))
    got = S.read_map(spark, str(tmp_path / "map.json"))
    assert {(r.surface, r.canonical_id) for r in got.collect()} == {("NEA", "x"), ("", None)}
    S.write_map(got, str(tmp_path / "lines"))
    assert {tuple(r) for r in S.read_map_lines(spark, str(tmp_path / "lines")).collect()} == {tuple(r) for r in got.collect()}


def test_a_cluster_without_shared_folder_is_refused(monkeypatch):
    from loomgraph import session

    class Sc:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Spark:
        conf, sparkContext = Conf(), Sc()

    with pytest.raises(RuntimeError):
        session.shared_dir(Spark())
