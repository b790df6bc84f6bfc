import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomgraph.llm import splitting as S

words = st.lists(st.sampled_from(["alpha", "beta.", "gamma", "\n", "\n\n", "# Head\n", "- item ", "x" * 70, "é́", "。"]), max_size=150)


@settings(max_examples=150, deadline=None)
@given(words, st.integers(20, 120), st.integers(0, 15))
def test_round_trip_and_limit(parts, limit, overlap):
    text = " ".join(parts)
    got = S.spans(text, limit, overlap)
    assert "".join(text[s:e] for _, s, e in got) == text
    assert all(e - o <= limit and s - o <= overlap for o, s, e in got)
    assert all(s < e for _, s, e in got)


def test_cuts_at_headings_and_sentences():
    text = "# One\n" + "Sentence one is here. " * 20 + "\n\n# Two\n" + "Another sentence stands. " * 20
    got = S.spans(text, 600, 60)
    assert text[got[1][1] :].startswith(("# Two", "Sentence"))
    assert any(text[s:].startswith("# Two") for _, s, _ in got)
    for _, s, _ in got[1:]:
        assert text[s - 1].isspace()
    for o, s, _ in got[1:]:
        assert o < s and text[o - 1].isspace()


def test_no_piece_spans_two_oversized_sections():
    text = "# One\n" + "Sentence one is here. " * 30 + "\n\n# Two\n" + "Another sentence stands. " * 30 + "\n\n# Three\nShort.\n\n# Four\nShort too.\n"
    got = [text[s:e] for _, s, e in S.spans(text, 600, 60)]
    assert not [p for p in got if "# Two" in p[1:]] and got[-1] == "# Three\nShort.\n\n# Four\nShort too.\n"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 400), min_size=1, max_size=12))
def test_a_heading_inside_a_piece_begins_a_whole_section(sizes):
    parts = [f"# H{i}\n" + "word " * (n // 5) + "\n" for i, n in enumerate(sizes)]
    text = "".join(parts)
    starts = [sum(map(len, parts[:i])) for i in range(len(parts) + 1)]
    for _, s, e in S.spans(text, 200, 20):
        inner = [x for x in starts if s < x < e]
        if inner:
            assert s in starts and e in starts


def test_no_boundary_and_marks():
    assert [e - s for _, s, e in S.spans("x" * 3200)] == [1300, 1300, 600]
    text = "é" * 2000
    assert all(text[s] != "́" for _, s, _ in S.spans(text))


def test_fence_stays_whole():
    code = "```\n" + "line of code\n\n" * 20 + "```\n"
    text = "Intro. " * 60 + "\n\n" + code + "\nOutro. " * 60
    assert any(code.strip() in text[s:e] for _, s, e in S.spans(text, 600, 50))


def test_frame(spark):
    rows = [("a", "Head", "w " * 1000, 1), ("b", None, None, 2), ("c", "", "", 3), ("d", "x", "short", 4)]
    df = spark.createDataFrame(rows, "chunk_id string, section_heading string, text string, start bigint")
    out = S.split_texts(df)
    got = out.collect()
    assert {r.chunk_id for r in got} == {"a", "d"}
    a = sorted((r for r in got if r.chunk_id == "a"), key=lambda r: r.piece_no)
    assert "".join(r.piece[r.n_overlap :] for r in a) == "w " * 1000
    assert all(len(r.piece) <= 1500 and r.section_heading == "Head" and r.pieces == len(a) for r in a)
    assert S.split_texts(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        S.split_texts(df.withColumnRenamed("start", "piece"))
