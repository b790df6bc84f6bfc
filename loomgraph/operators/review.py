"""Review of extracted payloads as append-only events; what stands now is the last event of each item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "pending_id bigint, doc_id string, action string, reviewer string, notes string, edited_json string, extraction_json string, created_at string"


def latest(events: DataFrame) -> DataFrame:
    """Current state of each pending item: PENDING until it is reviewed; APPROVE approves, anything else rejects."""
    enq = events.filter("action = 'ENQUEUE'").groupBy("pending_id").agg(F.min_by(F.struct("doc_id", "extraction_json"), "created_at").alias("e"), F.min("created_at").alias("created_at"))
    edit = events.filter("action = 'EDIT' or edited_json is not null").groupBy("pending_id").agg(F.max_by("edited_json", "created_at").alias("edited"))
    last = events.filter("action not in ('ENQUEUE', 'EDIT')").groupBy("pending_id").agg(F.max_by(F.struct("action", F.coalesce(F.nullif(F.trim("reviewer"), F.lit("")), F.lit("unknown")).alias("reviewer")), "created_at").alias("r"), F.max("created_at").alias("at"))
    j = enq.join(edit, "pending_id", "left").join(last, "pending_id", "left")
    status = F.when(F.col("r").isNull(), "PENDING").when(F.upper("r.action") == "APPROVE", "APPROVED").otherwise("REJECTED")
    return j.select("pending_id", F.col("e.doc_id").alias("doc_id"), status.alias("status"), F.coalesce("edited", "e.extraction_json").alias("extraction_json"), F.col("r.reviewer").alias("reviewer"), "created_at", F.coalesce("at", "created_at").alias("updated_at"))


def listing(events: DataFrame, status: str = "PENDING") -> DataFrame:
    return latest(events).filter(F.col("status") == status).orderBy("created_at", "pending_id")


def counts_by_document(events: DataFrame) -> DataFrame:
    return latest(events).filter("status = 'PENDING'").groupBy("doc_id").agg(F.count("*").alias("pending"))


def audit(events: DataFrame) -> DataFrame:
    return events.filter("action <> 'ENQUEUE'").select("pending_id", F.coalesce(F.nullif(F.trim("reviewer"), F.lit("")), F.lit("unknown")).alias("reviewer"), "action", "notes", "created_at")


# ---- writing: every change is one more event ---------------------------------------------------
def _events(df: DataFrame, action: str, **given: str) -> DataFrame:
    """Rows of the event schema, null where neither ``given`` nor the column is there."""
    cols = []
    for field in EVENTS.split(", "):
        name, kind = field.split(" ")
        source = given.get(name, name if name in df.columns else None)
        cols.append((F.lit(action) if name == "action" else F.col(source) if source else F.lit(None)).cast(kind).alias(name))
    return df.select(*cols)


def enqueue(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Events that put payloads (pending_id, payload, created_at) up for review; a payload without doc_id is refused as null."""
    doc = F.trim(F.get_json_object(payload, "$.doc_id"))
    return _events(payloads.withColumn("doc_id", doc).filter("doc_id <> ''"), "ENQUEUE", extraction_json=payload)


def edit(changes: DataFrame, payload: str = "payload") -> DataFrame:
    """Events that replace the payload of (pending_id, payload, created_at); the status stays."""
    return _events(changes, "EDIT", edited_json=payload)


def decide(decisions: DataFrame) -> DataFrame:
    """Events of decisions (pending_id, action, reviewer, notes, created_at): APPROVE in any case approves, all else rejects."""
    out = _events(decisions.drop("edited_json"), "")
    return out.drop("action").join(decisions.select("pending_id", "created_at", F.upper("action").alias("action")).distinct(), ["pending_id", "created_at"]).select(*out.columns)


def entities_of(state: DataFrame) -> DataFrame:
    """(pending_id, entity_type, name, description, text, raw_json): entities of the payloads that stand now."""
    kinds = F.from_json(F.get_json_object("extraction_json", "$.entities"), "map<string,string>")  # a kind that is no list has no items
    x = state.select("pending_id", F.explode(kinds).alias("entity_type", "items")).select("pending_id", "entity_type", F.explode(F.from_json("items", "array<string>")).alias("raw_json")).filter("raw_json like '{%'")
    part = lambda k: F.nullif(F.trim(F.get_json_object("raw_json", f"$.{k}")), F.lit("")).alias(k)
    return x.select("pending_id", "entity_type", part("name"), part("description"), part("text"), "raw_json")


def relations_of(state: DataFrame) -> DataFrame:
    """(pending_id, source_type, source_id, rel, target_type, target_key, target_value, raw_json) of the payloads that stand now."""
    x = state.select("pending_id", F.explode(F.from_json(F.get_json_object("extraction_json", "$.relations"), "array<string>")).alias("raw_json")).filter("raw_json like '{%'")
    part = lambda k: F.nullif(F.trim(F.get_json_object("raw_json", f"$.{k}")), F.lit("")).alias(k)
    return x.select("pending_id", *[part(k) for k in ("source_type", "source_id", "rel", "target_type", "target_key", "target_value")], "raw_json")


def append(events: DataFrame, path: str) -> None:
    events.write.mode("append").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(path)
