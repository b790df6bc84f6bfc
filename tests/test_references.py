import datetime as dt

from loomgraph.operators import references as R


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def make(spark, refs, par):
    r = spark.createDataFrame([("t", "f", k, "g", key, t) for k, key, t in refs], R.REFS)
    p = spark.createDataFrame([("g", *x) for x in par], R.PARENTS)
    return r, p


def keys(df):
    return sorted(r.ref_key for r in df.collect())


REFS = [("1", "a", day(0)), ("2", "a", day(1)), ("3", "a", day(5)), ("4", "a", day(7)), ("5", "b", day(3)), ("6", "b", None), ("7", "z", day(9)), ("7", "z", day(9))]
PAR = [("a", day(1), day(5)), ("a", day(6), None), ("b", day(2), None)]


def test_orphans_at_their_own_time(spark):
    a = R.advance(R.OrphanState.empty(spark), *make(spark, REFS, PAR))
    # 1 comes before its parent, 3 at the very time of the deletion, 6 has no time, 7 no parent (delivered twice)
    assert keys(a.orphans) == ["1", "3", "6", "7"]
    assert keys(a.state.pending) == ["7"]
    counts = {(r.month, r.orphans) for r in R.orphan_counts(a.orphans).collect()}
    assert counts == {("2024-01", 3), (None, 1)}


def test_batches_resolve_and_reopen(spark):
    first = R.advance(R.OrphanState.empty(spark), *make(spark, REFS[:2], PAR[:1]))
    assert keys(first.orphans) == ["1"]
    assert keys(first.state.pending) == ["1", "2"]  # the only parent known has ended
    second = R.advance(first.state, *make(spark, [], [("a", day(6), None)]))
    assert keys(second.resolved) == ["1", "2"] and keys(second.state.pending) == []
    third = R.advance(second.state, *make(spark, [], [("a", day(6), day(8))]))
    assert keys(third.reopened) == ["1", "2"] and keys(third.state.pending) == ["1", "2"]
    assert {r.since for r in third.state.pending.collect()} == {day(8)}


def test_two_batches_equal_one(spark, tmp_path):
    one = R.advance(R.OrphanState.empty(spark), *make(spark, REFS, PAR))
    a = R.advance(R.OrphanState.empty(spark), *make(spark, REFS[:4], PAR[:2]))
    a.state.save(str(tmp_path / "s"))
    b = R.advance(R.OrphanState.load(spark, str(tmp_path / "s")), *make(spark, REFS[4:], PAR[2:]))
    assert keys(one.orphans) == sorted(keys(a.orphans) + keys(b.orphans))
    assert keys(one.state.pending) == keys(b.state.pending)


def test_empty_extra_columns_and_dirty_keys(spark):
    df = spark.createDataFrame([(1, "  A\t", day(1), "x", "y"), (2, " ", day(1), "x", "y"), (3, None, day(1), "x", "y")], "id int, ref string, loaded_at timestamp_ntz, key string, target string")
    r = R.references(df, "t", "ref", "id", "g")
    assert [(x.ref_key, x.key) for x in r.collect()] == [("1", "a")]
    par = spark.createDataFrame([("A ", day(3), day(2), 1), ("a", None, None, 1)], "ref string, loaded_at timestamp_ntz, deleted_at timestamp_ntz, day int")
    assert R.parents(par, "g", "ref").count() == 0
    e = R.advance(R.OrphanState.empty(spark), spark.createDataFrame([], R.REFS), spark.createDataFrame([], R.PARENTS))
    assert e.orphans.count() == e.resolved.count() == e.reopened.count() == 0
    assert R.pending_snapshots(r, R.parents(par, "g", "ref")).collect()[0].waiting == 1


def test_a_bulk_load_is_split_and_counts_the_same(spark, monkeypatch):
    """One key and day with most of the references."""
    refs = [(str(i), "a", day(3) + dt.timedelta(minutes=i % 700)) for i in range(900)] + REFS
    par = [("a", day(3) + dt.timedelta(minutes=m), day(3) + dt.timedelta(minutes=m + 7)) for m in range(0, 700, 20)] + PAR[2:]
    whole = sorted((r.ref_key, r.open) for r in R._sweep(*make(spark, refs, par)).collect())
    monkeypatch.setattr(R, "HOT", 50)
    assert sorted((r.ref_key, r.open) for r in R._sweep(*make(spark, refs, par)).collect()) == whole
    assert {o for _, o in whole} == {0, 1}
