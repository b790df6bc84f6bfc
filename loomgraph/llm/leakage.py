"""Passages of held-out test items inside a corpus.

The items' words are read into a generalised suffix automaton, and the words of every document
stream through it: at each word the automaton knows the longest run ending there that some item
has too. A run of ``min_words`` is looked up in the automaton's state for exactly that length,
which names all items that hold it. The automaton is the broadcast; items are taken in blocks of
at most ``BLOCK_WORDS`` words, one automaton a block, so its size has a bound whatever the number
of items. Documents are never shuffled.

Defined results: null and empty texts, and items of fewer than ``min_words`` words, match
nothing; repeated rows give the same pairs once; rows without id pair as null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import map_rows, spread

MIN_WORDS = 12
#: Words of one block of items; an automaton has at most twice as many states.
BLOCK_WORDS = 500_000
MAX_COVERAGE = 0.5
_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers."""

    def __init__(self, items: list[list[str]], k: int):
        self.k = k
        self.ids: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        for item in items:
            last = 0
            for w in item:
                last = self._extend(last, self.ids.setdefault(w, len(self.ids)))
        # of each state: the one that stands for the run of exactly k words that ends there
        self.top = [0] * len(self.len)
        for s in sorted(range(1, len(self.len)), key=self.len.__getitem__):
            if self.len[s] >= k:
                self.top[s] = s if self.len[self.link[s]] < k else self.top[self.link[s]]
        # of those: the items that hold the run; no more entries than there are words
        self.items: dict[int, list[int]] = {}
        for n, item in enumerate(items):
            for _, _, s in self.runs(item):
                held = self.items.setdefault(s, [])
                if not held or held[-1] != n:
                    held.append(n)

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.len.append(length)
        self.link.append(link)
        self.next.append(edges)
        return len(self.len) - 1

    def _clone(self, p: int, q: int, c: int) -> int:
        new = self._state(self.len[p] + 1, self.link[q], dict(self.next[q]))
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        self.link[q] = new
        return new

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.len[q] == self.len[last] + 1 else self._clone(last, q, c)
        cur = self._state(self.len[last] + 1, 0, {})
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._clone(p, q, c)
        return cur

    def runs(self, tokens: list[str]) -> Iterator[tuple[int, int, int]]:
        """(index of the last word, words matched, key of ``items``) wherever a run of at least k words ends."""
        ids, nxt, link, lens, top, k = self.ids.get, self.next, self.link, self.len, self.top, self.k
        s = n = 0
        for i, w in enumerate(tokens):
            c = ids(w)
            if c is None:
                s = n = 0
                continue
            while c not in nxt[s]:
                s = link[s]
                if s < 0:
                    break
                n = lens[s]
            if s < 0:
                s = n = 0
                continue
            s, n = nxt[s][c], n + 1
            if n >= k:
                yield i, n, top[s]


def item_blocks(items: DataFrame, key: str, text: str, block_words: int = BLOCK_WORDS) -> Iterator[tuple[list, list[list[str]]]]:
    """Keys and words of the items, block by block; one block at a time is in the driver's memory."""
    keys: list = []
    held: list[list[str]] = []
    size = 0
    for r in items.select(key, text).distinct().filter(F.col(text).isNotNull()).toLocalIterator():
        w = words(r[1])
        if held and size + len(w) > block_words:
            yield keys, held
            keys, held, size = [], [], 0
        keys.append(r[0])
        held.append(w)
        size += len(w)
    if held:
        yield keys, held


def _per_block(docs: DataFrame, items: DataFrame, item: str, item_text: str, k: int, fn, schema: str) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    out = None
    docs = spread(docs)
    for keys, held in item_blocks(items, item, item_text):
        shared = sc.broadcast((keys, SuffixAutomaton(held, k)))
        part = map_rows(docs, lambda pdf, shared=shared: fn(pdf, *shared.value), schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def leaks(docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Distinct (doc, item) that share a run of at least ``min_words`` consecutive words, with the longest run matched in the document."""
    kind = {f.name: f.dataType.simpleString() for f in docs.schema.fields}[doc]
    ikind = {f.name: f.dataType.simpleString() for f in items.schema.fields}[item]

    def fn(pdf: pd.DataFrame, keys: list, sam: SuffixAutomaton) -> pd.DataFrame:
        rows = []
        for d, t in zip(pdf["d"], pdf["t"], strict=True):
            if not t:
                continue
            longest: dict[int, int] = {}
            for _, n, run in sam.runs(words(t)):
                longest[run] = max(n, longest.get(run, 0))
            best: dict[int, int] = {}
            for run, n in longest.items():
                for i in sam.items[run]:
                    best[i] = max(n, best.get(i, 0))
            rows += [(d, keys[i], n) for i, n in best.items()]
        return pd.DataFrame(rows, columns=["doc", "item", "longest"])

    found = _per_block(docs.select(F.col(doc).alias("d"), F.col(text).alias("t")), items, item, item_text, min_words, fn, f"doc {kind}, item {ikind}, longest int")
    return found.groupBy("doc", "item").agg(F.max("longest").alias("longest"))


def leaked_spans(docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, start, end): code points, from 0, of every stretch of words that lies in a leaked run; stretches of one block of items do not overlap."""
    kind = {f.name: f.dataType.simpleString() for f in docs.schema.fields}[doc]

    def fn(pdf: pd.DataFrame, keys: list, sam: SuffixAutomaton) -> pd.DataFrame:
        rows = []
        for d, t in zip(pdf["d"], pdf["t"], strict=True):
            if not t:
                continue
            at = [m.span() for m in _WORD.finditer(t)]
            tokens = [t[a:b].lower() for a, b in at]
            open_ = None
            for i, n, _ in sam.runs(tokens):
                a, b = i - n + 1, i
                if open_ and a <= open_[1] + 1:
                    open_ = (min(open_[0], a), b)
                else:
                    if open_:
                        rows.append((d, at[open_[0]][0], at[open_[1]][1]))
                    open_ = (a, b)
            if open_:
                rows.append((d, at[open_[0]][0], at[open_[1]][1]))
        return pd.DataFrame(rows, columns=["doc", "start", "end"])

    return _per_block(docs.select(F.col(doc).alias("d"), F.col(text).alias("t")), items, item, item_text, min_words, fn, f"doc {kind}, start int, end int")


def decontaminate(docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", max_coverage: float = MAX_COVERAGE, **kw) -> DataFrame:
    """Documents with leaked stretches cut out; ``dropped`` marks those covered beyond ``max_coverage``, whose text becomes null.

    Columns: doc, coverage (leaked characters / all), dropped, text. Every document appears.
    """
    sp = leaked_spans(docs, items, doc, text, **kw).groupBy("doc").agg(F.collect_set(F.struct("start", "end")).alias("cuts"))
    kind = {f.name: f.dataType.simpleString() for f in docs.schema.fields}[doc]
    j = docs.select(F.col(doc).alias("doc"), F.col(text).alias("t")).distinct().join(sp, "doc", "left")

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for d, t, cuts in zip(pdf["doc"], pdf["t"], pdf["cuts"], strict=True):
            if t is None or cuts is None or not len(cuts):
                out.append((d, 0.0, False, t))
                continue
            parts, at, gone = [], 0, 0
            for c in sorted(cuts, key=lambda c: c["start"]):
                if c["end"] <= at:
                    continue
                parts.append(t[at : c["start"]] if c["start"] > at else "")
                gone += c["end"] - max(at, c["start"])
                at = c["end"]
            cover = gone / len(t)
            out.append((d, cover, cover > max_coverage, None if cover > max_coverage else "".join(parts) + t[at:]))
        return pd.DataFrame(out, columns=["doc", "coverage", "dropped", "text"])

    return map_rows(j, fn, f"doc {kind}, coverage double, dropped boolean, text string")
