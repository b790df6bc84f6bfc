import random

from loomgraph.llm import leakage as L


def grams(text, k):
    w = L.words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def test_automaton_against_grams():
    r = random.Random(3)
    for k in (2, 4, 7):
        items = [[r.choice("abcde") for _ in range(r.randint(1, 40))] for _ in range(8)]
        sam = L.SuffixAutomaton(items, k)
        own = [{tuple(x[i : i + k]) for i in range(len(x) - k + 1)} for x in items]
        for _ in range(30):
            doc = [r.choice("abcdef") for _ in range(60)]
            got = set()
            for i, n, key in sam.runs(doc):
                run = tuple(doc[i - n + 1 : i + 1])
                assert n >= k and any(" ".join(run) in " ".join(x) for x in items)
                got |= set(sam.items[key])
            assert got == {j for j in range(8) if own[j] & {tuple(doc[i : i + k]) for i in range(len(doc) - k + 1)}}


def corpus(seed=1):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, "t", " ".join(r.choices(vocab, k=40))) for i in range(12)] + [(12, "t", None), (13, "t", "too short"), (0, "t", None)]
    docs = []
    for d in range(60):
        body = r.choices(vocab, k=80)
        if d % 3 == 0:
            src = items[r.randrange(12)][2].split()
            a, n = r.randrange(25), r.choice([5, 11, 12, 15])
            body[20:20] = [x.upper() + "," for x in src[a : a + n]]
        docs.append((d, " ".join(body), "x"))
    return docs + [(100, None, "x"), (101, "", "x"), docs[0], docs[3]], items


def test_leaks_against_brute_force(spark):
    docs, items = corpus()
    d = spark.createDataFrame(docs, "doc_id bigint, text string, item string")
    i = spark.createDataFrame(items, "item_id bigint, task string, text string")
    got = {(r.doc, r.item) for r in L.leaks(d, i).collect()}
    want = {(a, b) for a, t, _ in docs if t for b, _, x in items if x and grams(t, 12) & grams(x, 12)}
    assert want and got == want


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items = corpus(2)
    d = spark.createDataFrame(docs, "doc_id bigint, text string, item string")
    i = spark.createDataFrame(items, "item_id bigint, task string, text string")
    one = {tuple(r) for r in L.leaks(d, i).collect()}
    keys = [k for k, _ in L.item_blocks(i, "item_id", "text", 90)]
    assert len(keys) > 4 and len(sum(keys, [])) == 13
    monkeypatch.setattr(L.item_blocks, "__defaults__", (90,))
    assert {tuple(r) for r in L.leaks(d, i).collect()} == one


def test_spans_are_cut_out(spark):
    item = " ".join(f"k{i}" for i in range(20))
    docs = [(1, f"Before this. {item}. After that.", 0), (2, item, 0), (3, "clean text", 0), (4, None, 0)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, coverage int")
    i = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    got = {r.doc: r for r in L.decontaminate(d, i, max_coverage=0.8).collect()}
    assert got[1].text == "Before this. . After that." and not got[1].dropped
    assert got[2].dropped and got[2].text is None and got[2].coverage == 1.0
    assert got[3].text == "clean text" and got[4].text is None and len(got) == 4


def test_empty(spark):
    d = spark.createDataFrame([], "doc_id bigint, text string")
    i = spark.createDataFrame([], "item_id bigint, text string")
    assert L.leaks(d, i).count() == 0 and L.decontaminate(d, i).count() == 0
