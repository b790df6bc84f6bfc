import random
import re

from loomgraph.llm import repeated_lines as R

SCHEMA = "filename string, chunk_id string, text string, source string, doc int, n string"


def key(line):
    return re.sub(r"\s+", " ", re.sub(r"\d+", "0", line.lower())).strip()


def brute(rows):
    docs = {(f, c): t for f, c, t in rows if f and c}
    total, seen = {}, {}
    for (f, c), t in docs.items():
        total[f] = total.get(f, 0) + 1
        for n, line in enumerate((t or "").split("\n") if t is not None else [], 1):
            if sum(x.isalpha() for x in line) >= 10:
                seen.setdefault((f, key(line)), set()).add(c)
    bad = {k for k, v in seen.items() if len(v) >= 5 and len(v) >= 0.2 * total[k[0]]}
    return {(c, n) for (f, c), t in docs.items() if t is not None for n, line in enumerate(t.split("\n"), 1) if (f, key(line)) in bad}


def rows(seed=1):
    r = random.Random(seed)
    notice = ["All  rights RESERVED 2019", "all rights reserved 7", "ALL RIGHTS\tRESERVED 2021 "]
    out = []
    for f, n in (("a", 40), ("b", 6), ("c", 30)):
        for i in range(n):
            lines = [f"body {''.join(r.choices('abcdefghijk', k=14))} {i}" for _ in range(r.randint(0, 3))]
            if r.random() < (0.5 if f != "c" else 0.1):
                lines.insert(r.randint(0, len(lines)), r.choice(notice))
            if r.random() < 0.6:
                lines.append("- 7 -")  # too few letters
            out.append((f, f"{f}{i}", r.choice(["\n", "\n"]).join(lines)))
    out += [("a", "a900", None), ("a", "a901", ""), (None, "z1", "All rights reserved 1"), ("a", None, "All rights reserved 1"), *out[:5]]
    return out


def frame(spark, data):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in data], SCHEMA)


def found(state):
    return {(r.doc, r.line_no) for r in state.removable().collect()}


def test_against_brute_force(spark):
    state, rebuild = R.update(None, frame(spark, rows()))
    want = brute(rows())
    assert want and found(state) == want
    assert {r.doc for r in rebuild.collect()} == {d for d, _ in want}


def test_batches_equal_one_and_name_what_changed(spark, tmp_path):
    data = rows(2)
    first, _ = R.update(None, frame(spark, data[:45]))
    first.save(str(tmp_path / "v1"))
    first = R.LineState.load(spark, str(tmp_path / "v1"))
    before = found(first)
    second, rebuild = R.update(first, frame(spark, data[30:]))  # some are delivered again
    assert found(second) == brute(data)
    changed = {d for d, _ in found(second) ^ before}
    assert changed <= {r.doc for r in rebuild.collect()}


def test_clean_text_keeps_the_rest(spark):
    data = [("s", str(i), f"first {i}\nSubscribe to our bulletin\n\nlast") for i in range(6)] + [("s", "n", None), ("s", "e", "")]
    df = frame(spark, data)
    state, _ = R.update(None, df)
    out = {r.chunk_id: r.text for r in R.without_lines(df, state.removable()).collect()}
    assert out["0"] == "first 0\n\nlast" and out["n"] is None and out["e"] == ""
    assert R.without_lines(df, state.removable()).columns == df.columns


def test_empty_and_long(spark):
    state, rebuild = R.update(None, frame(spark, []))
    assert found(state) == set() and rebuild.count() == 0
    state, _ = R.update(None, frame(spark, [("s", str(i), "word " * 100_000 + "\nshared line of text") for i in range(5)]))
    assert found(state) == {(str(i), n) for i in range(5) for n in (1, 2)}


def test_clean_query_keeps_chunks_without_filename(spark, tmp_path):
    from loomgraph.llm.queries_a import QUERIES

    text = "body {}\nSubscribe to our bulletin"
    rows = [("s", str(i), "text", text.format(i)) for i in range(6)] + [(None, "a", "text", text.format("a")), (None, "n", "text", None), ("s", "t", "table", "cells")]
    spark.createDataFrame(rows, "filename string, chunk_id string, content_type string, text string").write.parquet(f"{tmp_path}/chunks.parquet")
    out = {r.chunk_id: r.text for r in QUERIES["p1_clean"](spark, str(tmp_path)).collect()}
    assert out == {str(i): f"body {i}" for i in range(6)} | {"a": text.format("a"), "n": None}
