import textwrap

from loomgraph.llm import scanned as S

SCHEMA = "chunk_id string, doc_id string, filename string, page_num int, section_heading string, text string, line_no int"
WORDS = (
    "the river report describes monitoring of water quality near every station while the committee reviewed drainage measures and harmonised collection across several districts "
    "in response to resident feedback before the following season and the flood-risk register was completed with support from neighbouring authorities throughout the period"
)


def clean(n=12):
    return [(f"c{i}", "clean", "clean-file-2020.pdf", i, "Overview", (WORDS + ". ") * 3, 0) for i in range(n)]


def page(i, lines):
    return (f"p{i}", "scan", "marsh-review-2011.pdf", i, "Overview", "\n".join(lines), 0)


BODY = textwrap.wrap(WORDS + ". " + WORDS + ".", 60)


def fixture():
    pages = []
    for i in range(1, 9):
        pages.append(page(i, ["Marsh Review 2012" if i % 2 else f"MARSH REVIEW 2012    {i}", *BODY, f"- {i} -" if i < 5 else f"Page {i} of 9"]))
    pages[2] = page(3, ["Marsh Revicw 2012", "the river report describes moni-", "toring of water quality near every", "station while the comrnittee reviewed the flood-", "risk register and harm¬", "onised collection across s e v e r a l", "districts.", "iii"])
    pages[3] = page(4, ["Overview and overview", "support from neighbouring auth-", "4", "MARSH REVIEW 2012", "orities throughout the period", "in response to resldent feedback. The wat\u00ad", "er quality report."])
    return clean() + pages + [pages[0], ("n", "scan", "marsh-review-2011.pdf", 9, None, None, 0), ("e", "scan", None, None, "", "", 0), (None, "scan", None, None, "", "x", 0)]


def found(spark, rows):
    return {(r.chunk_id, r.line_no, r.kind) for r in S.damage(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_damage(spark):
    got = found(spark, fixture())
    assert not {g for g in got if g[0].startswith("c")}
    three = {(n, k) for c, n, k in got if c == "p3"}
    assert three == {(1, "header"), (2, "hyphen"), (4, "misread"), (5, "hyphen"), (6, "misread"), (8, "pagenum")}
    four = {(n, k) for c, n, k in got if c == "p4"}
    assert {(1, "header"), (2, "hyphen"), (3, "pagenum"), (4, "header"), (6, "hyphen")} <= four and (5, "misread") not in four
    for i in (1, 2, 5, 8):
        last = 2 + len(BODY)
        assert {(n, k) for c, n, k in got if c == f"p{i}"} == {(1, "header"), (last, "pagenum")}


def test_repair(spark):
    out = {r.chunk_id: r.text for r in S.repair(spark.createDataFrame(fixture(), SCHEMA)).collect()}
    assert out["p3"] == "the river report describes monitoring of water quality near every station while the committee reviewed the flood-risk register and harmonised collection across several districts."
    assert out["p4"].startswith("support from neighbouring authorities throughout the period in response") and "water quality report." in out["p4"]
    assert out["p1"] == " ".join(BODY)


def test_skeletons_agree():
    for bad, good in (("rec0rded", "recorded"), ("cornmittee", "committee"), ("frarriework", "framework"), ("acccptecl", "accepted"), ("9roiip", "group"), ("ırıspection", "inspection"), ("penallies", "penalties"), ("ﬁeld", "field")):
        assert S.skeleton_of(bad) == S.skeleton_of(good), bad


def test_column_skeleton_is_the_same(spark):
    rows = [("Rec0rded ÁRNE ﬁeld quarter1y",), ("mnudhe 159",)]
    for r in spark.createDataFrame(rows, "t string").select("t", S.skeleton("t").alias("s")).collect():
        assert r.s == S.skeleton_of(r.t)


def test_empty_and_only_clean(spark):
    assert found(spark, []) == set()
    assert found(spark, clean(3)) == set()
    assert S.repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_only_scanned_long_text(spark):
    rows = [page(i, ["Marsh Review 2012", *BODY * 300, "inter-", "esting end.", str(i)]) for i in range(1, 4)]
    got = found(spark, rows)
    assert {k for *_, k in got} == {"header", "hyphen", "pagenum"} and ("p1", 2 + len(BODY) * 300, "hyphen") in got


def test_repair_keeps_all_else(spark):
    rows = fixture()
    out = [(r.chunk_id, r.text) for r in S.repair(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert len(out) == len({(r[0], r[5]) for r in rows})
    assert {("n", None), ("e", ""), (None, "x")} <= set(out) and {(r[0], r[5]) for r in clean()} <= set(out)


def test_long_and_misprinted_titles(spark):
    """No length keeps a running head in the text, nor does a letter too many or too few in one word."""
    head = "Annual Review of the " + "Upper and Lower Marsh Drainage " * 6 + "District"
    rows = [page(i, [head, *BODY, f"- {i} -"]) for i in range(1, 9)]
    rows[3] = page(4, [head.replace("Annual", "Anual"), *BODY, "- 4 -"])
    rows[4] = page(5, [head.replace("District", "Districtx"), *BODY, "- 5 -"])
    got = found(spark, clean() + rows)
    assert len(head) > 200 and {(c, n) for c, n, k in got if k == "header"} == {(f"p{i}", 1) for i in range(1, 9)}
