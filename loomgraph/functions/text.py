"""Scalar text functions as column expressions; JSON blocks by pandas UDF."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SENTENCE_GAP = r"(?<=[.!?])\s+"
HEADING = r"(?md)^(#{1,6})\s+(.+)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squeeze(c: Column | str) -> Column:
    """Any white space to single blanks, ends trimmed, null to ''."""
    return F.coalesce(F.trim(F.regexp_replace(_c(c), r"(?U)\s+", " ")), F.lit(""))


def sentences(c: Column | str) -> Column:
    return F.filter(F.transform(F.split(F.trim(_c(c)), SENTENCE_GAP), lambda x: F.trim(x)), lambda x: x != "")


def paragraphs(c: Column | str) -> Column:
    return F.filter(F.transform(F.split(_c(c), r"\n{2,}"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), lambda x: x != "")


def sections(c: Column | str) -> Column:
    """ARRAY<STRUCT<heading, body>>: the part before the first heading has heading ''; heading lines leave the body."""
    mark = "\u0001"
    marked = F.regexp_replace(_c(c), HEADING, mark + "$2\u0002")
    parts = F.split(marked, mark)
    split = F.transform(parts, lambda p, i: F.when(i == 0, F.struct(F.lit("").alias("heading"), p.alias("body"))).otherwise(F.struct(F.trim(F.substring_index(p, "\u0002", 1)).alias("heading"), F.element_at(F.split(p, "\u0002", 2), 2).alias("body"))))
    return F.transform(split, lambda s: F.struct(s["heading"].alias("heading"), F.regexp_replace(s["body"], r"(?U)^\s+|\s+$", "").alias("body")))


def overlap_tail(previous: Column | str) -> Column:
    """Last two sentences at most."""
    s = sentences(previous)
    return F.array_join(F.slice(s, F.greatest(F.lit(1), F.size(s) - 1), 2), " ")


def year_of(date: Column | str) -> Column:
    """First four characters, 'Unknown' for null or blank."""
    d = _c(date)
    return F.when(d.isNull() | (F.trim(d) == ""), "Unknown").otherwise(F.substring(d, 1, 4))


def parsed_year(date: Column | str) -> Column:
    """Four digits in front, else the year of a few written forms, else null."""
    d = F.trim(_c(date))
    forms = [F.year(F.to_date(F.try_to_timestamp(d, F.lit(f)))) for f in ("dd/MM/yyyy", "dd-MM-yyyy", "d MMM yyyy", "MMM d, yyyy")]
    return F.coalesce(F.when(d.rlike(r"^\d{4}"), F.substring(d, 1, 4).cast("int")), *forms)


def relation_name(c: Column | str) -> Column:
    """Upper-case word characters; a leading digit gets REL_, nothing becomes RELATED_TO."""
    n = F.upper(F.regexp_replace(F.trim(F.coalesce(_c(c), F.lit(""))), "[^a-zA-Z0-9_]", "_"))
    return F.when(n == "", "RELATED_TO").when(n.rlike("^[0-9]"), F.concat(F.lit("REL_"), n)).otherwise(n)


def label_name(c: Column | str) -> Column:
    """As ``relation_name`` without upper case; T_ and Unknown."""
    n = F.regexp_replace(F.trim(F.coalesce(_c(c), F.lit(""))), "[^a-zA-Z0-9_]", "_")
    return F.when(n == "", "Unknown").when(n.rlike("^[0-9]"), F.concat(F.lit("T_"), n)).otherwise(n)


def strip_legal(c: Column | str) -> Column:
    """Lower-case name without company suffixes; a helper that clustering does not use."""
    return F.trim(F.lower(F.regexp_replace(_c(c), r"(?i)[,\s]+(?:pte\.?\s*ltd|ltd|limited|inc|llc|corp|corporation|co)\.?\s*$", "")))


def table_markdown(raw: Column | str) -> Column:
    """ARRAY<ARRAY<STRING>> as a Markdown table: first row the header, other rows cut or filled to its width."""
    rows = F.transform(_c(raw), lambda r: F.transform(r, lambda x: F.trim(F.coalesce(x, F.lit("")))))
    width = F.size(rows[0])
    line = lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |"))
    body = F.transform(F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0))), lambda r: line(F.slice(F.concat(r, F.array_repeat(F.lit(""), width)), 1, width)))
    rule = line(F.array_repeat(F.lit("---"), width))
    return F.when(F.size(_c(raw)) > 0, F.array_join(F.concat(F.array(line(rows[0]), rule), body), "\n"))


def without_thoughts(c: Column | str) -> Column:
    """Drop everything up to </think>; of an unclosed <think> keep what stands before it."""
    closed = F.regexp_replace(_c(c), r"(?s)^.*</think>", "")
    return F.trim(F.regexp_replace(closed, r"(?s)<think>.*$", ""))


def braces(c: Column | str) -> Column:
    """From the first { to the last }; '' if there is none."""
    return F.regexp_extract(_c(c), r"(?s)\{.*\}", 0)


_FENCE = re.compile(r"```(?:json)?\s*(\{.*?\})\s*```", re.DOTALL)


def _balanced(text: str) -> str | None:
    start = text.find("{")
    depth = 0
    for i in range(start, len(text)) if start >= 0 else ():
        depth += (text[i] == "{") - (text[i] == "}")
        if depth == 0:
            return text[start : i + 1]
    return None


def json_block(text: str | None, fence_first: bool = False) -> str | None:
    """The JSON object in a reply: whole, fenced, or the first balanced braces; null if none parses."""
    t = (text or "").strip()
    fenced = _FENCE.search(t)
    whole = t if t.startswith("{") and t.endswith("}") else None
    for x in (fenced and fenced[1], whole, _balanced(t)) if fence_first else (whole, fenced and fenced[1], _balanced(t)):
        if x:
            try:
                return x if isinstance(json.loads(x), dict) else None
            except ValueError:
                continue
    return None


@F.pandas_udf(StringType())
def extract_json(s: pd.Series) -> pd.Series:
    return s.map(json_block)


@F.pandas_udf(StringType())
def extract_json_fenced(s: pd.Series) -> pd.Series:
    return s.map(lambda t: json_block(t, fence_first=True))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Of unit vectors: their dot product."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
