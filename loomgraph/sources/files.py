"""Readers and writers: page extractions, JSON lines, canonical CSV, mappings, hooks for what is not Spark's.

Reading PDF pages, tables, scanned images and asking a language model are hooks: plain functions
that run inside Arrow batches on the executors. Everything else is a schema and a Spark reader.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions.text import table_markdown

ITEM = "doc_id string, filename string, page_num int, content_type string, text string, raw_table array<array<string>>, extraction_method string"
EXTRACTION = f"doc_id string, filename string, filepath string, extraction_method string, checksum string, page_count int, item_count int, table_count int, content array<struct<{', '.join(f.replace(' ', ':', 1) for f in ITEM.split(', '))}>>"
CHUNK = "chunk_id string, chunk_index int, doc_id string, filename string, page_num int, section_heading string, content_type string, text string, raw_table array<array<string>>"
_TRIPLE = "subject:string,subject_type:string,predicate:string,object:string,object_type:string,evidence:string,confidence:string"
RAW_EXTRACTION = f"chunk_id string, doc_id string, filename string, page_num int, section_heading string, entities array<struct<name:string,type:string,aliases:array<string>>>, triples array<struct<{_TRIPLE}>>, error string"
CANONICAL_MAP = "surface string, canonical_id string, canonical_name string, type string"


# ---- documents --------------------------------------------------------------------------------
def scan_binary(spark: SparkSession, path: str, glob: str = "*.[pP][dD][fF]") -> DataFrame:
    """(path, filename, doc_id, checksum, content) of the files of a folder."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return f.select("path", name.alias("filename"), F.substring(F.md5(name), 1, 8).alias("doc_id"), F.md5("content").alias("checksum"), "content")


def unseen(files: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """Files whose keys (document and checksum by default) are not among those done."""
    return files.join(done.select(*(keys or ("doc_id", "checksum"))).distinct(), list(keys or ("doc_id", "checksum")), "left_anti")


def extract_pages(files: DataFrame, pages: Callable[[bytes, str], list[dict]], tables: Callable[[bytes, str], list[dict]] | None = None, ocr: Callable[[bytes, str], list[dict]] | None = None, least: int = 100) -> DataFrame:
    """Content items of files by hooks that give {page_num, text} and {page_num, raw_table}.

    A file of fewer than ``least`` characters a page is read by ``ocr``. A hook that fails gives no
    items of its own; blank pages and empty tables give none.
    """

    def safe(fn, data: bytes, name: str) -> list[dict]:
        try:
            return list(fn(data, name)) if fn else []
        except Exception:
            return []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, name, data in zip(pdf["doc_id"], pdf["filename"], pdf["content"], strict=True):
                got, method = safe(pages, data, name), "text"
                if ocr and sum(len(p.get("text") or "") for p in got) < least * max(1, len(got)):
                    got, method = safe(ocr, data, name), "ocr"
                rows += [(doc, name, p["page_num"], "text", p["text"], None, method) for p in got if (p.get("text") or "").strip()]
                rows += [(doc, name, t["page_num"], "table", None, t["raw_table"], method) for t in safe(tables, data, name) if t.get("raw_table")]
            yield pd.DataFrame(rows, columns=["doc_id", "filename", "page_num", "content_type", "text", "raw_table", "extraction_method"])

    items = files.select("doc_id", "filename", "content").mapInPandas(run, ITEM)
    return items.withColumn("text", F.coalesce("text", table_markdown("raw_table")))


def complete_with(df: DataFrame, prompt: str, complete: Callable[[str], str], out: str = "reply") -> DataFrame:
    """Adds the reply of a language model to each prompt; a call that fails leaves null."""

    @F.pandas_udf("string")
    def ask(s: pd.Series) -> pd.Series:
        def one(p):
            try:
                return complete(p)
            except Exception:
                return None

        return s.map(one)

    return df.withColumn(out, ask(F.col(prompt)))


# ---- JSON -------------------------------------------------------------------------------------
def read_extractions(spark: SparkSession, path: str) -> DataFrame:
    """One JSON file a document."""
    return spark.read.schema(EXTRACTION).option("multiLine", True).json(path)


def read_lines(spark: SparkSession, path: str, schema: str, strict: bool = True, needs: str | None = None) -> DataFrame:
    """JSON lines; strict ones fail on a bad line, others leave it out, and rows without ``needs`` too."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    df = spark.read.schema(schema + ", _corrupt_record string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    df = df.filter(F.coalesce(F.col("_corrupt_record"), F.lit("")) == "").drop("_corrupt_record")
    return df if needs is None else df.filter(F.col(needs).isNotNull())


def write_lines(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


MAP_ENTRY = "canonical_id string, canonical_name string, type string"


def read_map(spark: SparkSession, path: str) -> DataFrame:
    """(surface, canonical_id, canonical_name, type) of JSON files that hold one object, surface to entry."""
    doc = spark.read.text(path, wholetext=True)
    entries = F.from_json("value", f"map<string,struct<{', '.join(f.replace(' ', ':') for f in MAP_ENTRY.split(', '))}>>")
    return doc.select(F.explode(entries).alias("surface", "e")).select("surface", "e.*")


def write_map(cmap: DataFrame, path: str) -> None:
    """JSON lines, one object of one surface a line; a map of any size is written in parts, and ``read_map_lines`` reads it back."""
    cmap.select(F.to_json(F.map_from_arrays(F.array("surface"), F.array(F.struct("canonical_id", "canonical_name", "type")))).alias("value")).write.mode("overwrite").text(path)


def read_map_lines(spark: SparkSession, path: str) -> DataFrame:
    entries = F.from_json("value", f"map<string,struct<{', '.join(f.replace(' ', ':') for f in MAP_ENTRY.split(', '))}>>")
    return spark.read.text(path).select(F.explode(entries).alias("surface", "e")).select("surface", "e.*")


def triples_of(extractions: DataFrame) -> DataFrame:
    """Triples with the chunk they come from; confidence that is no number becomes null."""
    t = extractions.select("chunk_id", "doc_id", "filename", "page_num", "section_heading", F.posexplode("triples").alias("pos", "t"))
    return t.select("chunk_id", "doc_id", "filename", "page_num", "section_heading", "pos", "t.*").withColumn("confidence", F.expr("try_cast(coalesce(confidence, '0') as double)"))


# ---- CSV and mappings -------------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All strings, nothing taken for missing; a missing file is an empty frame of ``columns``."""
    if columns is not None and not path.startswith(("hdfs:", "s3", "gs:", "abfs")) and not Path(path.removeprefix("file://")).exists():
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("inferSchema", False).csv(path)
    return df.na.fill("")


def load_mapping(path: str) -> dict:
    """{table: {file, columns: {target: source}}} of a JSON or YAML file; documents is required."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        m = json.loads(text)
    except ValueError:
        import yaml

        m = yaml.safe_load(text)
    if not isinstance(m, dict) or "documents" not in m:
        raise ValueError("a mapping needs the table documents")
    for name, part in m.items():
        if not isinstance(part, dict) or not part.get("file") or not isinstance(part.get("columns"), dict):
            raise ValueError(f"{name} needs file and columns")
    return m


def resolve_file(name: str, *folders: str) -> str:
    """The file itself if absolute, else in the first folder that has it, else here."""
    for p in [Path(name)] if Path(name).is_absolute() else [*(Path(f) / name for f in folders), Path(name)]:
        if p.exists():
            return str(p)
    raise FileNotFoundError(name)


def write_canonical(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """CSV of each table and a summary of row counts beside them."""
    counts = {}
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/{name}")
        counts[name] = df.count()
    Path(folder, "canonicalization_summary.json").write_text(json.dumps(counts), encoding="utf-8")
    return counts
