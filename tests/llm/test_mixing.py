import random

from loomgraph.llm import mixing as M
from loomgraph.llm.queries_f import TOKENIZER


def test_schedule_stays_within_one_block():
    r = random.Random(4)
    for _ in range(20):
        need = {f"s{i}": r.randint(1, 1000) for i in range(r.randint(1, 9))}
        k = M.whole_weights(need, 500)
        assert sum(k.values()) == 500
        done = dict.fromkeys(k, 0)
        for s, i, t in M.schedule(k):
            assert done[s] == i
            done[s] += 1
            assert all(abs(done[x] - k[x] * (t + 1) / 500) < 1 for x in k)
        assert done == k


def test_plan():
    assert M.plan({"a": 100, "b": 100}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 1}) == {"a": 100, "b": 100}
    p = M.plan({"a": 1000, "b": 10}, {"a": 0.9, "b": 0.1}, {"a": 1, "b": 3})
    assert p["b"] <= 30 and abs(p["b"] / sum(p.values()) - 0.1) < 0.01
    p = M.plan({"a": 1000, "b": 10}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 3}, total_tokens=400)
    assert p == {"b": 30, "a": 370}
    assert M.plan({}, {"a": 1.0}, {}) == {} and M.plan({"a": 5}, {"a": 0.0}, {}) == {}


def docs(spark):
    r = random.Random(2)
    rows = [(i, " ".join(["word"] * r.randint(5, 60)), r.choice(["big"] * 6 + ["mid"] * 3 + ["tiny"]), 1) for i in range(400)]
    rows += [(900, None, "big", 1), (901, "", "big", 1), (902, "x y", None, 1), (903, "x y", "unnamed", 1), rows[0], rows[1]]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, source string, slot int")


def test_mix(spark):
    rows, d = docs(spark)
    t = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("tiny", 0.15, 4), ("absent", 0.05, 3)], "source string, target_share double, max_repeats int")
    out = M.mix(d, t, TOKENIZER, block_tokens=64, period=200)
    got = out.collect()
    assert len({(r.doc_id, r["pass"]) for r in got}) == len(got)
    source = {r[0]: r[2] for r in rows}
    assert all(source[r.doc_id] == r.source for r in got)
    caps = {"big": 1, "mid": 2, "tiny": 4}
    assert all(r["pass"] < caps[r.source] for r in got)
    shares = {r.source: r for r in M.actual_shares(out, t).collect()}
    assert shares["absent"].share == 0.0 and shares["absent"].tokens == 0
    for s, w in (("big", 0.5), ("mid", 0.3), ("tiny", 0.15)):
        assert abs(shares[s].share - w / 0.95) < 0.03
    assert {tuple(r) for r in got} == {tuple(r) for r in M.mix(d, t, TOKENIZER, block_tokens=64, period=200).collect()}


def test_empty(spark):
    _, d = docs(spark)
    none = spark.createDataFrame([], "source string, target_share double, max_repeats int")
    assert M.mix(d, none, TOKENIZER).count() == 0
    t = spark.createDataFrame([("big", None, None), (None, 0.5, 1)], "source string, target_share double, max_repeats int")
    out = M.mix(d, t, TOKENIZER)
    assert out.count() == 0 and M.actual_shares(out, t).collect()[0].share == 0.0
