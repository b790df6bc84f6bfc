"""Mixing sources to target weights.

Sizes are tokens of a public tokenizer. Each source's documents, in hash order, fill blocks of
``block_tokens``; block i of a source with weight w may not start before slot i/w and must end
by slot (i+1)/w, and of the blocks released the one with the earliest deadline goes first. At
every point of the mixture each source is then less than one block from its target. Weights are
multiples of 1/``period``, so the schedule repeats after ``period`` slots; that one table (at
most ``period`` rows, whatever the size of the data) is made on the driver and joined.

Positions inside a source are two-level prefix sums (hash bucket, then document), so a source
with a third of all documents is spread over ``buckets`` tasks.

Without ``total_tokens`` the mixture is the largest that meets all shares within the caps; with
it, sources that run out under their cap stop there and the others take their part.

Defined results: documents without source, id or text, or of sources not named, are left out; a
repeated row counts once; an empty text has no tokens and is never scheduled; a named source
without tokens gets share 0 and its weight goes to the others in proportion; null or negative
shares count as 0, null caps as 1; without any token the mixture is empty. Of a source named
twice the larger share and cap hold. Columns other than those named are ignored.
"""

from __future__ import annotations

import heapq
import math
import os

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomgraph.llm.common import map_rows, spread
from loomgraph.session import materialize

BLOCK_TOKENS, PERIOD, BUCKETS = 2048, 10_000, 4096
_MIX = "doc_id {}, source string, pass int, n_tokens bigint, slot bigint, position bigint"
_LOADED: dict = {}


def token_counts(docs: DataFrame, tokenizer: str, doc: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, source, n_tokens) of each distinct document; ``tokenizer`` is a vocabulary file that all executors can read."""
    kind = {f.name: f.dataType.simpleString() for f in docs.schema.fields}[doc]

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        if tokenizer not in _LOADED:
            _LOADED[tokenizer] = Tokenizer.from_file(tokenizer)
            _LOADED[tokenizer].encode_special_tokens = True
        t = _LOADED[tokenizer]
        n: list[int] = []
        texts = list(pdf["t"])
        for i in range(0, len(texts), 64):
            n += [len(e) for e in t.encode_batch(texts[i : i + 64], add_special_tokens=False)]
        return pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "n_tokens": n})

    d = docs.select(F.col(doc).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("t")).filter("doc_id is not null and source is not null and t is not null")
    return map_rows(spread(d), fn, f"doc_id {kind}, source string, n_tokens bigint").groupBy("doc_id", "source").agg(F.max("n_tokens").alias("n_tokens"))


def plan(totals: dict[str, int], shares: dict[str, float], caps: dict[str, int], total_tokens: int | None = None) -> dict[str, int]:
    """Tokens to take of each source."""
    live = {s: w for s, w in shares.items() if w > 0 and totals.get(s, 0) > 0 and caps.get(s, 1) > 0}
    if not live:
        return {}
    room = {s: totals[s] * caps.get(s, 1) for s in live}
    weight = sum(live.values())
    if total_tokens is None:
        n = min(room[s] * weight / w for s, w in live.items())
        return {s: math.floor(n * w / weight) for s, w in live.items()}
    need, left, open_ = {}, float(total_tokens), dict(live)
    while open_:  # those that run out first, the rest shares what is left
        weight = sum(open_.values())
        out = [s for s, w in open_.items() if left * w / weight > room[s]]
        if not out:
            return need | {s: math.floor(left * w / weight) for s, w in open_.items()}
        for s in out:
            need[s] = room[s]
            left -= room[s]
            del open_[s]
    return need


def whole_weights(need: dict[str, int], period: int = PERIOD) -> dict[str, int]:
    """Slots of each source in a period, by largest remainders; at least one each."""
    total = sum(need.values())
    exact = {s: n * period / total for s, n in need.items()}
    k = {s: max(1, math.floor(x)) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (k[s] - exact[s], s)):
        if sum(k.values()) >= period:
            break
        k[s] += 1
    while sum(k.values()) > period:
        s = max(k, key=lambda s: (k[s] - exact[s], k[s], s))
        k[s] -= 1
    return k


def schedule(k: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, block of the period, slot): released blocks, earliest deadline first."""
    period = sum(k.values())
    waiting = [(0, s, 0) for s in k]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out = []
    for t in range(period):
        while waiting and waiting[0][0] <= t:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * period // k[s]), s, i))
        deadline, s, i = heapq.heappop(ready)
        assert t < deadline
        out.append((s, i, t))
        if i + 1 < k[s]:
            heapq.heappush(waiting, ((i + 1) * period // k[s], s, i + 1))
    return out


def _targets(targets: DataFrame) -> tuple[dict[str, float], dict[str, int]]:
    """Shares and caps; one row a named source."""
    rows = targets.filter("source is not null").groupBy("source").agg(F.max("target_share").alias("w"), F.max("max_repeats").alias("r")).collect()
    return {r.source: max(0.0, r.w or 0.0) for r in rows}, {r.source: 1 if r.r is None else r.r for r in rows}


def mix(docs: DataFrame, targets: DataFrame, tokenizer: str, total_tokens: int | None = None, block_tokens: int = BLOCK_TOKENS, period: int = PERIOD, buckets: int = BUCKETS, doc: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mixture: (doc_id, source, pass, n_tokens, slot, position); its order is slot, source, position."""
    spark = docs.sparkSession
    shares, caps = _targets(targets)
    kind = {f.name: f.dataType.simpleString() for f in docs.schema.fields}[doc]
    named = docs.filter(F.col(source).isin(sorted(shares))) if shares else docs.limit(0)
    counts = materialize(token_counts(named, tokenizer, doc, source, text).filter("n_tokens > 0"), "tokens")
    totals = {r.source: r.n for r in counts.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    need = {s: n for s, n in plan(totals, shares, caps, total_tokens).items() if n > 0}
    if not need:
        return spark.createDataFrame([], _MIX.format(kind))
    k = whole_weights(need, max(period, len(need)))
    span = sum(k.values())
    slots = spark.createDataFrame(schedule(k), "source string, ordinal bigint, at bigint")
    facts = spark.createDataFrame([(s, need[s], totals[s], k[s], -(-need[s] // totals[s])) for s in need], "source string, need bigint, total bigint, k bigint, passes bigint")

    h = counts.join(F.broadcast(facts), "source").withColumn("h", F.xxhash64("doc_id")).withColumn("bucket", F.pmod("h", F.lit(buckets)))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = h.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("n")).select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = h.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(offsets, ["source", "bucket"])
    placed = placed.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("passes") - 1)))
    placed = placed.withColumn("position", F.col("offset") + F.col("within") + F.col("pass") * F.col("total")).filter("position < need")
    placed = placed.withColumn("block", F.floor(F.col("position") / block_tokens)).withColumn("ordinal", F.col("block") % F.col("k"))
    out = placed.join(F.broadcast(slots), ["source", "ordinal"])
    slot = F.floor(F.col("block") / F.col("k")) * span + F.col("at")
    return out.select("doc_id", "source", F.col("pass").cast("int").alias("pass"), "n_tokens", slot.cast("bigint").alias("slot"), "position")


def actual_shares(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, tokens, share, documents, most_repeats) of every named source."""
    per = mixture.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count_distinct("doc_id").alias("documents"), (F.max("pass") + 1).alias("most_repeats"))
    named = targets.filter("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    j = named.join(per, "source", "left").withColumn("all", F.sum("tokens").over(Window.partitionBy(F.lit(0))))  # a row a named source
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return j.select("source", "target_share", "max_repeats", zero("tokens"), F.coalesce(F.col("tokens") / F.col("all"), F.lit(0.0)).alias("share"), zero("documents"), zero("most_repeats"))
