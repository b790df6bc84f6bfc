"""Lines repeated across the documents of one source, counted incrementally.

Only sources that a batch touches are counted again and compared; the state of all others passes
through unread but for the filter on the source (a saved state is laid out by source).

State: ``lines`` (documents per source and line), ``sources`` (documents per source) and
``occurrences`` (where each countable line stands). ``update`` merges a batch as a delta: its
own counts are added to the tables, the lines whose status changed (crossed the threshold, or
fell below it because the source grew) are found from the tables alone, and only documents
with such a line are named for rebuilding.

Lines travel as two 64-bit hashes, never as text. Counts are sums of partial sums, so neither
a hot source nor a hot line ends in one task.

Defined results: rows without source or document id are ignored; null and empty texts count
as documents without lines; a document delivered again, in the batch or later, counts once
per line and once per source; a source of a single document can't reach ``min_docs``. Columns
other than those named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm.common import lines_of
from loomgraph.session import broadcast_if_small, materialize

MIN_DOCS, MIN_SHARE, MIN_LETTERS = 5, 0.2, 10
#: Excessive lines are broadcast up to this many (some 60 bytes each), joined by shuffle beyond.
BROADCAST_ROWS = 400_000
LINE = ["source", "h1", "h2"]


def line_key(line: Column) -> Column:
    """Lower case, each run of digits as one digit, each run of white space as one blank, trimmed."""
    c = F.regexp_replace(F.lower(line), r"\p{Nd}+", "0")
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def occurrences(docs: DataFrame, source: str, doc: str, text: str, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(source, doc, line_no, h1, h2) of every line with enough letters."""
    lines = docs.select(F.col(source).alias("source"), F.col(doc).alias("doc"), F.posexplode(lines_of(F.col(text))).alias("pos", "line"))
    enough = F.col("line").rlike(r"(?:\p{L}[^\p{L}]*+){%d}" % min_letters)
    return lines.filter(enough).select("source", "doc", (F.col("pos") + 1).alias("line_no"), line_key(F.col("line")).alias("k")).select("source", "doc", "line_no", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit("second"), "k").alias("h2"))


@dataclass
class LineState:
    lines: DataFrame
    sources: DataFrame
    occurrences: DataFrame
    docs: DataFrame

    @staticmethod
    def empty(spark: SparkSession) -> LineState:
        return LineState(
            spark.createDataFrame([], "source string, h1 bigint, h2 bigint, n bigint"),
            spark.createDataFrame([], "source string, n bigint"),
            spark.createDataFrame([], "source string, doc string, line_no int, h1 bigint, h2 bigint"),
            spark.createDataFrame([], "source string, doc string"),
        )

    def save(self, path: str) -> None:
        """Each call needs a new folder: a table cannot be overwritten while it is read."""
        for name in ("lines", "sources", "occurrences", "docs"):
            getattr(self, name).sortWithinPartitions("source").write.parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LineState:
        return LineState(*(spark.read.parquet(f"{path}/{n}") for n in ("lines", "sources", "occurrences", "docs")))

    def excessive(self, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
        total = self.sources.select("source", F.col("n").alias("total"))
        return self.lines.filter(F.col("n") >= min_docs).join(total, "source").filter(F.col("n") >= F.col("total") * min_share).select(*LINE)

    def removable(self, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
        """(source, doc, line_no) of each line to be removed."""
        bad = materialize(self.excessive(min_docs, min_share), "excessive")
        return self.occurrences.join(broadcast_if_small(bad, BROADCAST_ROWS), LINE, "left_semi").select("source", "doc", "line_no").distinct()


def _sum(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.unionByName(b).groupBy(*keys).agg(F.sum("n").alias("n"))


def _split(table: DataFrame, touched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the sources touched, and the others."""
    return table.join(touched, "source", "left_semi"), table.join(touched, "source", "left_anti")


def update(state: LineState | None, docs: DataFrame, source: str = "filename", doc: str = "chunk_id", text: str = "text", min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> tuple[LineState, DataFrame]:
    """The state after the batch, and the (source, doc) to rebuild because a line of theirs changed status."""
    spark = docs.sparkSession
    docs = docs.filter(F.col(source).isNotNull() & F.col(doc).isNotNull())
    names = docs.select(F.col(source).alias("source"), F.col(doc).cast("string").alias("doc")).distinct()
    occ = occurrences(docs.withColumn(doc, F.col(doc).cast("string")), source, doc, text)
    if state is not None:  # what was delivered before is no news
        names = names.join(state.docs, ["source", "doc"], "left_anti")
        occ = occ.join(state.docs, ["source", "doc"], "left_anti")
    occ = materialize(occ, "occurrences")
    delta = occ.select(*LINE, "doc").distinct().groupBy(*LINE).agg(F.count("*").alias("n"))
    grown = names.groupBy("source").agg(F.count("*").alias("n"))
    if state is None:
        new = LineState(delta, grown, occ, names)
        return new, new.removable(min_docs, min_share).select("source", "doc").distinct()
    touched = broadcast_if_small(materialize(grown.select("source"), "touched"), BROADCAST_ROWS)
    lines, other_lines = _split(state.lines, touched)
    sources, other_sources = _split(state.sources, touched)
    old = LineState(lines, sources, *(_split(t, touched)[0] for t in (state.occurrences, state.docs)))
    mine = LineState(materialize(_sum(lines, delta, LINE), "lines"), _sum(sources, grown, ["source"]), old.occurrences.unionByName(occ), old.docs.unionByName(names))
    new = LineState(mine.lines.unionByName(other_lines), mine.sources.unionByName(other_sources), state.occurrences.unionByName(occ), state.docs.unionByName(names))
    before, after = materialize(old.excessive(min_docs, min_share), "before"), materialize(mine.excessive(min_docs, min_share), "after")
    changed = before.join(after, LINE, "left_anti").unionByName(after.join(before, LINE, "left_anti"))
    # lines already excessive also go from the documents that just arrived
    fresh = occ.join(after, LINE, "left_semi").select("source", "doc")
    rebuild = mine.occurrences.join(changed, LINE, "left_semi").select("source", "doc").unionByName(fresh).distinct()
    return new, rebuild


def without_lines(docs: DataFrame, removable: DataFrame, doc: str = "chunk_id", text: str = "text") -> DataFrame:
    """``docs`` with the named lines taken out of ``text``; all else, null texts too, as it was."""
    gone = removable.groupBy(F.col("doc").alias("_doc")).agg(F.collect_set("line_no").alias("_gone"))
    kept = F.array_join(F.filter(lines_of(F.col(text)), lambda line, i: ~F.array_contains("_gone", i + 1)), "\n")
    j = docs.join(gone, F.col(doc).cast("string") == F.col("_doc"), "left")
    return j.withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(kept)).drop("_doc", "_gone")
