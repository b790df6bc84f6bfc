import random

from loomgraph.llm import components as C


def brute(pairs):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    return {x: root(x) for x in list(up)}


def run(spark, pairs):
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    return {r.node: r.group for r in C.components(df).collect()}


def test_random_graphs(spark):
    r = random.Random(5)
    for n, m in ((30, 20), (200, 180)):
        pairs = [(r.randrange(n), r.randrange(n)) for _ in range(m)]
        pairs = [(a, b) for a, b in pairs if a != b]
        assert run(spark, pairs) == brute(pairs)


def test_long_chain_star_nulls_loops_repeats(spark):
    chain = [(i, i + 1) for i in range(64)]
    r = random.Random(1)
    r.shuffle(chain)
    assert set(run(spark, chain).values()) == {0}
    assert run(spark, [(1000, i) for i in range(50)])[1000] == 0
    assert run(spark, [(3, 3), (None, 4), (5, None), (7, 6), (6, 7), (7, 6)]) == {7: 6, 6: 6}
    assert run(spark, []) == {}


def test_rows_by_keys(spark):
    rows = [(1, "x", None), (2, "x", "n"), (3, None, "n"), (4, None, None), (5, "y", "m"), (5, "y", "m"), (None, "x", "n"), (9, "y", None)]
    df = spark.createDataFrame(rows, "id bigint, k string, l string")
    got = {r.node: r.group for r in C.group_rows(df, "id", [["k"], ["l"]]).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 9: 5}
