"""Types, predicates and which types a predicate allows.

The names are fixed values; the allowed types of each predicate are this project's own default,
replaced by any ontology file of the same shape.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

#: Fixed values.
TYPES = "GovernmentAgency Regulation Policy Programme Pollutant WasteType Facility Organisation Person EnvironmentalIndicator ClimateEvent GeographicArea Standard Technology Disease Vector DateOrPeriod Metric".split()
#: Fixed values.
PREDICATES = "regulates enforces implements operates located_in targets measures set_target emits treats_or_processes causes transmits affects collaborates_with funded_by succeeded_by complies_with achieved_metric occurred_during headed_by".split()
_BODY = ["GovernmentAgency", "Organisation"]
_RULE = ["Regulation", "Policy", "Standard", "Programme"]
ALLOWED = {
    "regulates": (_BODY + _RULE, ["Pollutant", "WasteType", "Facility", "Organisation", "Technology"]),
    "enforces": (_BODY, _RULE),
    "implements": (_BODY + ["Facility"], _RULE),
    "operates": (_BODY, ["Facility", "Programme", "Technology"]),
    "located_in": (_BODY + ["Facility", "ClimateEvent"], ["GeographicArea"]),
    "targets": (_BODY + _RULE, ["Pollutant", "WasteType", "Disease", "Vector", "EnvironmentalIndicator", "Metric"]),
    "measures": (_BODY + ["Facility", "Technology"], ["EnvironmentalIndicator", "Metric", "Pollutant"]),
    "set_target": (_BODY + _RULE, ["Metric", "EnvironmentalIndicator"]),
    "emits": (["Facility", "Organisation", "Technology"], ["Pollutant", "WasteType"]),
    "treats_or_processes": (["Facility", "Technology", "Organisation"], ["WasteType", "Pollutant"]),
    "causes": (["Pollutant", "WasteType", "Vector", "ClimateEvent"], ["Disease", "ClimateEvent"]),
    "transmits": (["Vector"], ["Disease"]),
    "affects": (["Pollutant", "ClimateEvent", "Disease", "WasteType", "Policy"], ["GeographicArea", "EnvironmentalIndicator", "Organisation", "Metric"]),
    "collaborates_with": (_BODY + ["Person"], _BODY + ["Person"]),
    "funded_by": (["Programme", "Facility", "Technology"], _BODY),
    "succeeded_by": (_BODY + _RULE, _BODY + _RULE),
    "complies_with": (_BODY + ["Facility"], ["Regulation", "Standard", "Policy"]),
    "achieved_metric": (_BODY + ["Facility", "Programme"], ["Metric", "EnvironmentalIndicator"]),
    "occurred_during": (["ClimateEvent", "Disease", "Programme"], ["DateOrPeriod"]),
    "headed_by": (_BODY, ["Person"]),
}


def default() -> dict:
    """The ontology in the shape of its file."""
    return {
        "entity_types": [{"type": t, "description": "", "examples": []} for t in TYPES],
        "relationship_types": [{"predicate": p, "description": "", "allowed_subject_types": s, "allowed_object_types": o} for p, (s, o) in ALLOWED.items()],
    }


def load(path: str | None = None) -> dict:
    if path is None:
        return default()
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def constraints(spark: SparkSession, ontology: dict | None = None) -> DataFrame:
    """(rule, subjects, objects), one row a predicate; some tens of rows."""
    o = ontology or default()
    rows = [(r["predicate"], r["allowed_subject_types"], r["allowed_object_types"]) for r in o["relationship_types"]]
    return spark.createDataFrame(rows, "rule string, subjects array<string>, objects array<string>")
