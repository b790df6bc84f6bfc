"""Identifiers. All but the slug are built from digests that the JVM computes."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_id(filename: Column | str) -> Column:
    """Document id of a source file: eight hex digits over its full name."""
    return F.substring(F.md5(_c(filename)), 1, 8)


def chunk_id(doc_id: Column | str, index: Column | str) -> Column:
    return F.substring(F.md5(F.concat(_c(doc_id), F.lit(":"), _c(index).cast("string"))), 1, 12)


def entity_id(type_: Column | str, name: Column | str) -> Column:
    """lower(type) and eight hex digits over the lower-case name."""
    return F.concat(F.lower(_c(type_)), F.lit("_"), F.substring(F.md5(F.lower(_c(name))), 1, 8))


def triple_id(chunk: Column | str, subject: Column | str, predicate: Column | str, obj: Column | str) -> Column:
    return F.substring(F.md5(F.concat_ws(":", _c(chunk), _c(subject), _c(predicate), _c(obj))), 1, 12)


def slug_of(text: str | None) -> str:
    t = unicodedata.normalize("NFKD", " ".join((text or "").split())).encode("ascii", "ignore").decode().lower()
    return re.sub(r"[^a-z0-9]+", "_", t).strip("_") or "unknown"


@F.pandas_udf(StringType())
def slugify(s: pd.Series) -> pd.Series:
    """Compatibility decomposition, ASCII letters and digits, the rest as single underscores."""
    return s.map(slug_of)


def stable_id(prefix: str, value: Column | str) -> Column:
    """prefix, slug of at most forty characters, ten hex digits over the value itself."""
    v = F.coalesce(_c(value), F.lit(""))
    s = F.when(v == "", F.lit("unknown")).otherwise(F.concat(F.substring(slugify(v), 1, 40), F.lit("_"), F.substring(F.sha1(v), 1, 10)))
    return F.concat(F.lit(prefix + "_"), s)


def division_id(name: Column | str) -> Column:
    return F.concat(F.lit("division_"), slugify(_c(name)))
