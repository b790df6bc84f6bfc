"""Oversized texts cut into pieces at natural boundaries.

A text is parsed into a tree of spans: headed sections by level, blocks between blank lines
(fenced code and tables whole), list items and lines, sentences, words. Whole siblings are
merged as long as they fit, and only a node that is too large is descended into; what is left of
it is not merged with the sibling behind it.
The spans partition the text; every piece after the first also repeats up to ``overlap``
characters before it, from a natural boundary on.

Defined results: a null or empty text has no piece; a text within the limit is one piece; a run
without any boundary is cut at the limit, but never before a combining mark; repeated rows give
repeated pieces (deduplicate before). All other columns, whatever their names, pass through.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left

import pandas as pd
from pyspark.sql import DataFrame

from loomgraph.llm.common import map_rows

LIMIT, OVERLAP = 1500, 200

_HEADING = re.compile(
    r"^(?:(#{1,6})[ \t]+\S.*|(={2,6})[ \t]*\S.*?[ \t]*={2,6}[ \t]*|<h([1-6])[^>\n]*>.*|\\(part|chapter|section|subsection|subsubsection)\*?\{.*|\S.*\n(={3,}|-{3,})[ \t]*)$",
    re.MULTILINE | re.IGNORECASE,
)
_LATEX = ["part", "chapter", "section", "subsection", "subsubsection"]
_BLANK = re.compile(r"\n[ \t\r\f\v]*\n\s*")
_FENCE = re.compile(r"^(```|~~~).*?^\1[ \t]*$\n?|^\{\|.*?^\|\}[ \t]*$\n?|<pre\b.*?</pre>|<table\b.*?</table>|\\begin\{(\w+\*?)\}.*?\\end\{\2\}", re.MULTILINE | re.DOTALL | re.IGNORECASE)
_LINE = re.compile(r"\r\n|\n|\r|\x85| | ")
_SENTENCE = re.compile(r"(?<=[.!?。！？…])[\"'”’)\]]*\s+|[。！？]")
_SPACE = re.compile(r"\s+")


def _level(m: re.Match) -> int:
    if m[1] or m[2]:
        return len(m[1] or m[2])
    if m[3]:
        return int(m[3])
    if m[4]:
        return _LATEX.index(m[4].lower()) + 1
    return 1 if m[5][0] == "=" else 2


def _cuts(start: int, end: int, points: list[int]) -> list[tuple[int, int]]:
    at = [start, *[p for p in points if start < p < end], end]
    return [(x, y) for x, y in zip(at, at[1:], strict=False) if x < y]


class _Tree:
    """Children of spans, found level by level only where they are asked for."""

    def __init__(self, text: str):
        self.text = text
        self.heads = [(m.start(), _level(m)) for m in _HEADING.finditer(text)]
        self.fences = [m.span() for m in _FENCE.finditer(text)]

    def _free(self, points: list[int]) -> list[int]:
        """Points that do not lie inside a fenced block."""
        if not self.fences:
            return points
        starts = [s for s, _ in self.fences]
        out = []
        for p in points:
            i = bisect_left(starts, p) - 1
            if i < 0 or p >= self.fences[i][1]:
                out.append(p)
        return out

    def children(self, start: int, end: int, depth: int) -> tuple[list[tuple[int, int]], int]:
        """Spans of the first level, from ``depth`` on, that divides this span; and the level after it."""
        while depth < 11:
            if depth < 6:
                points = [p for p, level in self.heads if level == depth + 1 and start < p < end]
                points = self._free(points)
            elif depth == 6:
                points = self._free([m.end() for m in _BLANK.finditer(self.text, start, end)] + [x for f in self.fences for x in f])
            else:
                rx = {7: _LINE, 8: _SENTENCE, 9: _SPACE}.get(depth)
                points = [m.end() for m in rx.finditer(self.text, start, end)] if rx else []
            spans = _cuts(start, end, sorted(set(points)))
            depth += 1
            if len(spans) > 1:
                return spans, depth
        return [], depth


def _hard(text: str, start: int, end: int, limit: int) -> list[tuple[int, int]]:
    out = []
    while end - start > limit:
        cut = start + limit
        while cut > start + 1 and (unicodedata.combining(text[cut]) or text[cut] in "‍️" or text[cut - 1] == "‍"):
            cut -= 1
        if cut == start + 1:
            cut = start + limit
        out.append((start, cut))
        start = cut
    return [*out, (start, end)]


def spans(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(start of the repeated part, start, end) of each piece, from 0; start..end partition the text."""
    if not text:
        return []
    if len(text) <= limit:
        return [(0, 0, len(text))]
    room = limit - overlap
    tree = _Tree(text)

    def pieces(start: int, end: int, depth: int) -> list[tuple[int, int]]:
        first = limit if start == 0 else room
        if end - start <= first:
            return [(start, end)]
        kids, below = tree.children(start, end, depth)
        if not kids:
            head = _hard(text, start, end, room)
            return head
        merged: list[tuple[int, int]] = []
        whole = False  # the last piece is a run of whole siblings
        for s, e in kids:
            if e - s > (limit if s == 0 else room):
                merged += pieces(s, e, below)
                whole = False
            elif whole and e - merged[-1][0] <= (limit if merged[-1][0] == 0 else room):
                merged[-1] = (merged[-1][0], e)
            else:
                merged.append((s, e))
                whole = True
        return merged

    out = []
    for s, e in pieces(0, len(text), 0):
        out.append((_back(text, s, overlap) if out else s, s, e))
    return out


def _back(text: str, at: int, overlap: int) -> int:
    """Where the repeated part before ``at`` begins: the earliest sentence or line start in reach, else word start."""
    low = max(0, at - overlap)
    for rx in (_LINE, _SENTENCE, _SPACE):
        for m in rx.finditer(text, max(0, low - 2), at):
            if low <= m.end() < at:
                return m.end()
    cut = low
    while cut < at and (unicodedata.combining(text[cut]) or text[cut] in "‍️"):
        cut += 1
    return cut


def split_texts(df: DataFrame, text: str = "text", limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """One row a piece with all columns but ``text``, and piece_no, pieces, start_pos (from 1), n_overlap, piece."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be below the limit")
    keep = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != text]
    clash = {"piece_no", "pieces", "start_pos", "n_overlap", "piece"} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} would be overwritten; rename them first")

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, extra = [], []
        for i, t in enumerate(pdf[text]):
            if not t:
                continue
            found = spans(t, limit, overlap)
            for n, (o, s, e) in enumerate(found):
                rows.append(i)
                extra.append((n + 1, len(found), s + 1, s - o, t[o:e]))
        out = pdf.drop(columns=[text]).iloc[rows].reset_index(drop=True)
        for k, name in enumerate(("piece_no", "pieces", "start_pos", "n_overlap", "piece")):
            out[name] = [x[k] for x in extra]
        return out

    return map_rows(df, fn, ", ".join([*keep, "piece_no int, pieces int, start_pos int, n_overlap int, piece string"]))
