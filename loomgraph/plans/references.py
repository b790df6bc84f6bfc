"""Queries on references to records that do not exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.operators import references as R
from loomgraph.session import materialize, table

FIELDS = [
    ("agency_doc_initiatives", "doc_ref", "link_id", "agency_documents", "doc_ref"),
    ("agency_doc_initiatives", "init_code", "link_id", "agency_initiatives", "init_code"),
    ("validated_triples", "subject_canonical_id", "triple_id", "canonical_map", "canonical_id"),
]


def _inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    refs = par = None
    for t, field, key, target, target_field in FIELDS:
        r = R.references(table(spark, d, t), t, field, key, target)
        p = R.parents(table(spark, d, target), target, target_field)
        refs, par = (r, p) if refs is None else (refs.unionByName(r), par.unionByName(p))
    return refs, par


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    refs, par = _inputs(spark, d)
    return R.advance(R.OrphanState.empty(spark), refs, par).orphans.select("ref_table", "ref_field", "ref_key").distinct()


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    refs, par = _inputs(spark, d)
    return R.orphan_counts(R.advance(R.OrphanState.empty(spark), refs, par).orphans)


def p3_pending(spark: SparkSession, d: str) -> DataFrame:
    """References that wait for a parent after all batches, counted per table and field."""
    refs, par = _inputs(spark, d)
    state = R.advance(R.OrphanState.empty(spark), refs, par).state
    return state.pending.groupBy("ref_table", "ref_field").agg(F.count("*").alias("waiting"))


def _kept(state: R.OrphanState) -> R.OrphanState:
    """The state as written tables, as between two runs."""
    return R.OrphanState(materialize(state.parents, "parents"), materialize(state.refs, "refs"), materialize(state.pending, "pending"))


#: Times at which the batches of p3_incremental end; what has no time comes with the first.
CUTS = ("2021-06-01", "2023-01-01")


def p3_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The orphans of p3_found from three batches, by the time at which references and parents were loaded."""
    refs, par = _inputs(spark, d)
    state, found = R.OrphanState.empty(spark), None
    for i in range(len(CUTS) + 1):
        when = lambda c: (F.lit(True) if i == 0 else F.col(c) >= CUTS[i - 1]) & (F.lit(True) if i == len(CUTS) else F.col(c) < CUTS[i]) | (F.col(c).isNull() if i == 0 else F.lit(False))  # noqa: E731, B023
        step = R.advance(state, refs.filter(when("t")), par.filter(when("loaded_at")))
        orphans = materialize(step.orphans.select("ref_table", "ref_field", "ref_key"), "orphans")
        found = orphans if found is None else found.unionByName(orphans)
        state = _kept(step.state)
    return found.distinct()


def p3_reopened(spark: SparkSession, d: str) -> DataFrame:
    """What waits after references came first, their parents later and the deletions last, with what each batch resolved or reopened."""
    refs, par = _inputs(spark, d)
    first = R.advance(R.OrphanState.empty(spark), refs, par.limit(0))
    second = R.advance(_kept(first.state), refs.limit(0), par.withColumn("deleted_at", F.lit(None).cast("timestamp_ntz")))
    third = R.advance(_kept(second.state), refs.limit(0), par.filter("deleted_at is not null"))
    part = lambda df, name: df.groupBy("ref_table", "ref_field").agg(F.count("*").alias(name))
    keys = ["ref_table", "ref_field"]
    out = part(refs.distinct(), "references").join(part(second.resolved, "resolved"), keys, "left").join(part(third.reopened, "reopened"), keys, "left").join(part(third.state.pending, "waiting"), keys, "left")
    return out.select(*keys, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("references", "resolved", "reopened", "waiting")])


def p3_snapshots(spark: SparkSession, d: str) -> DataFrame:
    return R.pending_snapshots(*_inputs(spark, d))


QUERIES = {"p3_found": p3_found, "p3_report": p3_report, "p3_pending": p3_pending, "p3_snapshots": p3_snapshots, "p3_incremental": p3_incremental, "p3_reopened": p3_reopened}

_KEY = r"regexp_replace(lower({}), '^[\s\x0b\x{{85}}\x{{a0}}]+|[\s\x0b\x{{85}}\x{{a0}}]+$', '', 'g')"
_REFS = " union all ".join(
    f"select distinct '{t}' ref_table, '{f}' ref_field, cast({k} as varchar) ref_key, '{g}' target, {_KEY.format(f)} k, loaded_at t from {t}" for t, f, k, g, _ in FIELDS
)
_PARENTS = " union all ".join(f"select distinct '{g}' target, {_KEY.format(gf)} k, loaded_at, deleted_at from {g}" for *_, g, gf in FIELDS)
_WITH = f"with refs as (select * from ({_REFS}) where k <> ''), par as (select * from ({_PARENTS}) where k <> ''), "
_ORPHANS = (
    _WITH + "orphans as (select * from refs r where not exists (select 1 from par p where p.target = r.target and p.k = r.k and p.loaded_at <= r.t and (p.deleted_at is null or p.deleted_at > r.t)))"
)
SQL = {
    "p3_found": _ORPHANS + " select distinct ref_table, ref_field, ref_key from orphans",
    "p3_incremental": _ORPHANS + " select distinct ref_table, ref_field, ref_key from orphans",
    "p3_reopened": _WITH
    + """h as (select r.*, exists (select 1 from par p where p.target = r.target and p.k = r.k) known, exists (select 1 from par p where p.target = r.target and p.k = r.k and p.deleted_at is null) held from refs r)
    select ref_table, ref_field, count(*) as "references", count(*) filter (where known) as resolved, count(*) filter (where known and not held) as reopened, count(*) filter (where not held) as waiting from h group by all""",
    "p3_report": _ORPHANS + " select ref_table, ref_field, strftime(t, '%Y-%m') as month, count(*) as orphans from orphans group by all",
    "p3_pending": _WITH
    + "open as (select * from refs r where not exists (select 1 from par p where p.target = r.target and p.k = r.k and p.deleted_at is null)) select ref_table, ref_field, count(*) as waiting from open group by all",
    "p3_snapshots": _WITH
    + """bounds as (select min(m) lo, max(m) hi from (select date_trunc('month', t) m from refs union all select date_trunc('month', loaded_at) from par union all select date_trunc('month', deleted_at) from par)),
    mon as (select unnest(generate_series(lo, hi, interval 1 month)) m from bounds),
    used as (
      select distinct r.ref_table, r.ref_field, date_trunc('month', r.t) m from refs r
      union select distinct r.ref_table, r.ref_field, date_trunc('month', p.loaded_at) from par p join refs r on p.target = r.target and p.k = r.k
      union select distinct r.ref_table, r.ref_field, date_trunc('month', p.deleted_at) from par p join refs r on p.target = r.target and p.k = r.k where p.deleted_at is not null),
    cover as (select r.ref_table, r.ref_field, r.ref_key, r.t, mon.m,
        exists (select 1 from par p where p.target = r.target and p.k = r.k and p.loaded_at < mon.m + interval 1 month and (p.deleted_at is null or p.deleted_at >= mon.m + interval 1 month)) held
      from refs r, mon where r.t < mon.m + interval 1 month)
    select u.ref_table, u.ref_field, strftime(u.m, '%Y-%m') as month, count(*) filter (where not held) as waiting
    from used u left join cover c on c.ref_table = u.ref_table and c.ref_field = u.ref_field and c.m = u.m group by all""",
}
