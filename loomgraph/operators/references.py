"""References to records that do not exist: incremental state of pending orphans.

State is three tables. ``parents`` is the index of target keys with the periods they hold,
``refs`` holds every reference seen, ``pending`` the references that wait for a parent.
``advance`` takes one batch of new references, new parents and deletions: references probe
the parent index at their own time, arriving parents resolve those that wait, and the end of
the last parent's period opens its references again.

A key may hold a third of all rows. No step collects a key into one task: periods and
references become events, and the number of parents that hold at an event is a two-level
prefix sum, first over (key, day) totals, then over the events of one (key, day). A (key, day)
with more than ``HOT`` references, as a bulk load makes it, is split into parts by the
references' own keys; its parents' events go to each part.

Defined results: null and blank reference values are no references; a reference without a time
is an orphan (no parent can be shown to hold then), of period null; a parent without
``loaded_at`` never holds; a parent whose ``deleted_at`` is not after ``loaded_at`` never
holds; repeated rows count once. Empty tables give empty results. Columns other than those
named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

REFS = T.StructType(
    [
        T.StructField("ref_table", T.StringType()),
        T.StructField("ref_field", T.StringType()),
        T.StructField("ref_key", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("t", T.TimestampNTZType()),
    ]
)
PARENTS = T.StructType(
    [
        T.StructField("target", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
        T.StructField("deleted_at", T.TimestampNTZType()),
    ]
)


#: References of one key and day that one task takes.
HOT = 100_000


def norm_key(c: Column) -> Column:
    """Key compared without case and surrounding white space; blank becomes null."""
    k = F.regexp_replace(F.lower(c), r"(?U)^\s+|\s+$", "")
    return F.when(k != "", k)


def references(df: DataFrame, table: str, field: str, row_key: str, target: str, time: str = "loaded_at") -> DataFrame:
    """Reference rows of one field, repeated deliveries once."""
    return df.select(
        F.lit(table).alias("ref_table"),
        F.lit(field).alias("ref_field"),
        F.col(row_key).cast("string").alias("ref_key"),
        F.lit(target).alias("target"),
        norm_key(F.col(field)).alias("key"),
        F.col(time).cast("timestamp_ntz").alias("t"),
    ).filter("key is not null")


def parents(df: DataFrame, target: str, field: str, loaded: str = "loaded_at", deleted: str = "deleted_at") -> DataFrame:
    """Periods in which a key of the target table holds."""
    return df.select(
        F.lit(target).alias("target"),
        norm_key(F.col(field)).alias("key"),
        F.col(loaded).cast("timestamp_ntz").alias("loaded_at"),
        F.col(deleted).cast("timestamp_ntz").alias("deleted_at"),
    ).filter("key is not null and loaded_at is not null and (deleted_at is null or deleted_at > loaded_at)")


def _sweep(refs: DataFrame, par: DataFrame) -> DataFrame:
    """Every reference with ``open``, the number of parent periods that hold at its time."""
    k = ["target", "key"]
    par = par.distinct()
    none = F.lit(None).cast("string")
    blank = [none.alias("ref_table"), none.alias("ref_field"), none.alias("ref_key")]
    starts = par.select(*k, F.col("loaded_at").alias("t"), F.lit(1).alias("d"), F.lit(False).alias("is_ref"), *blank)
    ends = par.filter("deleted_at is not null").select(*k, F.col("deleted_at").alias("t"), F.lit(-1).alias("d"), F.lit(False).alias("is_ref"), *blank)
    asks = refs.distinct().select(*k, "t", F.lit(0).alias("d"), F.lit(True).alias("is_ref"), "ref_table", "ref_field", "ref_key")
    ev = starts.unionByName(ends).unionByName(asks).withColumn("day", F.to_date("t"))
    # level 1: what is open when a day begins; a (key, day) total is one row whatever the key's size
    w1 = Window.partitionBy(*k).orderBy(F.col("day").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    totals = ev.groupBy(*k, "day").agg(F.sum("d").alias("net"), F.count_if("is_ref").alias("asked"))
    days = totals.select(*k, "day", F.coalesce(F.sum("net").over(w1), F.lit(0)).alias("before"))
    # level 2: within one day of one key, or a part of it; changes at the very time come before the references
    hot = totals.filter(F.col("asked") > HOT).select(*[F.col(c).alias(f"_{c}") for c in k], F.col("day").alias("_day"), F.ceil(F.col("asked") / HOT).cast("int").alias("parts"))
    at = [F.col(c) == F.col(f"_{c}") for c in k] + [F.col("day").eqNullSafe(F.col("_day"))]
    parted = ev.join(F.broadcast(hot), at, "left").drop(*[f"_{c}" for c in k], "_day")  # at most a row for HOT references
    own = F.when(F.col("parts").isNull(), F.array(F.lit(0))).when(F.col("is_ref"), F.array(F.pmod(F.xxhash64("ref_table", "ref_field", "ref_key"), F.col("parts").cast("bigint")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    parted = parted.withColumn("part", F.explode(own)).drop("parts")
    w2 = Window.partitionBy(*k, "day", "part").orderBy("t", F.col("is_ref").cast("int")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inner = parted.withColumn("within", F.sum("d").over(w2)).filter("is_ref")
    d = days.select(*[F.col(c).alias(f"_{c}") for c in k], F.col("day").alias("_day"), "before")
    return inner.join(d, at, "left").select("ref_table", "ref_field", "ref_key", *k, "t", F.when(F.col("t").isNull(), F.lit(0)).otherwise(F.col("within") + F.col("before")).alias("open"))


@dataclass
class OrphanState:
    """Tables of the state; all may be written with ``save`` and read again with ``load``."""

    parents: DataFrame
    refs: DataFrame
    pending: DataFrame

    @staticmethod
    def empty(spark: SparkSession) -> OrphanState:
        refs = spark.createDataFrame([], REFS)
        return OrphanState(spark.createDataFrame([], PARENTS), refs, refs.withColumn("since", F.col("t")))

    def save(self, path: str) -> None:
        """Each call needs a new folder: a table cannot be overwritten while it is read."""
        for name in ("parents", "refs", "pending"):
            getattr(self, name).write.parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> OrphanState:
        return OrphanState(*(spark.read.parquet(f"{path}/{n}") for n in ("parents", "refs", "pending")))


@dataclass
class Advance:
    """What a batch changed: ``orphans`` of its references at their own time, ``resolved`` and ``reopened`` ones of before."""

    state: OrphanState
    orphans: DataFrame
    resolved: DataFrame
    reopened: DataFrame


def advance(state: OrphanState, new_refs: DataFrame, changes: DataFrame, upto: Column | None = None) -> Advance:
    """Apply a batch. ``changes`` holds parents' periods: new ones, or known ones now with ``deleted_at``.

    ``upto`` is the time as of which references wait or are resolved; by default the end of all
    periods known, that is whether any known parent still holds. Only keys touched by the batch
    are looked at; everything else passes through.
    """
    p = ["target", "key", "loaded_at"]
    changes = changes.select(*p, "deleted_at").distinct()
    # a deletion closes the period that is known under the same key and start
    par = state.parents.unionByName(changes).groupBy(*p).agg(F.max("deleted_at").alias("deleted_at"))
    new_refs = new_refs.select(*[f.name for f in REFS]).distinct()
    index = par.join(new_refs.select("target", "key").distinct(), ["target", "key"], "left_semi")
    orphans = _sweep(new_refs, index).filter("open <= 0").drop("open")

    holds = F.col("deleted_at").isNull() if upto is None else (F.col("loaded_at") <= upto) & (F.col("deleted_at").isNull() | (F.col("deleted_at") > upto))
    refs = state.refs.unionByName(new_refs).distinct()
    touched = changes.select("target", "key").unionByName(new_refs.select("target", "key")).distinct()
    live = par.filter(holds).select("target", "key").distinct()
    waiting = refs.join(touched, ["target", "key"], "left_semi").join(live, ["target", "key"], "left_anti")
    ident = ["ref_table", "ref_field", "ref_key", "target", "key", "t"]
    old = state.pending
    still = old.join(touched, ["target", "key"], "left_anti")
    lasts = par.filter("deleted_at is not null").groupBy("target", "key").agg(F.max("deleted_at").alias("ended"))
    now = waiting.join(lasts, ["target", "key"], "left").select(*ident, F.greatest("t", "ended").alias("since"))
    was = old.select(*ident)
    resolved = _minus(was.join(touched, ["target", "key"], "left_semi"), waiting, ident)
    reopened = _minus(waiting.join(state.refs, ident, "left_semi"), was, ident)
    return Advance(OrphanState(par, refs, still.unionByName(now)), orphans, resolved, reopened)


def _minus(a: DataFrame, b: DataFrame, ident: list[str]) -> DataFrame:
    """Rows of ``a`` that are not in ``b``; nulls are equal."""
    b = b.select(*[F.col(c).alias(f"_{c}") for c in ident])
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) if c == "t" else F.col(c) == F.col(f"_{c}") for c in ident]
    return a.join(b, on, "left_anti")


def orphan_counts(orphans: DataFrame) -> DataFrame:
    """Orphans per table, field and month of the reference's time."""
    return orphans.groupBy("ref_table", "ref_field", F.date_format("t", "yyyy-MM").alias("month")).agg(F.count("*").alias("orphans"))


def pending_snapshots(refs: DataFrame, par: DataFrame) -> DataFrame:
    """References waiting at the end of each month, per table and field.

    Waiting turns on or off only where the number of open periods of a key leaves or reaches
    zero; those turns are weighted with the references seen so far, by (key, day) totals.
    """
    k = ["target", "key"]
    par = par.distinct()
    day = lambda c: F.to_date(c)
    ev = (
        par.select(*k, day("loaded_at").alias("day"), F.lit(1).alias("d"))
        .unionByName(par.filter("deleted_at is not null").select(*k, day("deleted_at").alias("day"), F.lit(-1).alias("d")))
        .groupBy(*k, "day")
        .agg(F.sum("d").alias("d"))
    )
    months = ev.groupBy(*k, F.trunc("day", "month").alias("month")).agg(F.sum("d").alias("d"))
    seen = refs.distinct().filter("t is not null").groupBy(*k, "ref_table", "ref_field", F.trunc(day("t"), "month").alias("month")).agg(F.count("*").alias("n"))
    fields = seen.select(*k, "ref_table", "ref_field").distinct()
    f = ["ref_table", "ref_field", *k]
    steps = (
        months.join(fields, k).select(*f, "month", "d", F.lit(0).cast("bigint").alias("n"))
        .unionByName(seen.select(*f, "month", F.lit(0).cast("bigint").alias("d"), "n"))
        .groupBy(*f, "month").agg(F.sum("d").alias("d"), F.sum("n").alias("n"))
    )
    w = Window.partitionBy(*f).orderBy("month")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = steps.select(*f, "month", F.when(F.sum("d").over(run) > 0, F.lit(0)).otherwise(F.sum("n").over(run)).alias("waiting"))
    change = at.select(*f[:2], "month", (F.col("waiting") - F.coalesce(F.lag("waiting").over(w), F.lit(0))).alias("c"))
    per = change.groupBy(*f[:2], "month").agg(F.sum("c").alias("c"))  # one row a month from here on
    return per.select(*f[:2], F.date_format("month", "yyyy-MM").alias("month"), F.sum("c").over(Window.partitionBy(*f[:2]).orderBy("month")).alias("waiting"))
