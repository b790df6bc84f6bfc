"""Graphs kept as Parquet: every save is a new snapshot, and a pointer names the current one."""

from __future__ import annotations

import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from loomgraph.operators.graph import Graph


class GraphStore:
    """Snapshots below one folder; readers of the one before are not disturbed by a save."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, Path(path)

    def save(self, g: Graph) -> str:
        name = f"v{time.time_ns()}"
        g.entities.write.parquet(str(self.path / name / "entities"))
        g.relations.write.parquet(str(self.path / name / "relations"))
        (self.path / "CURRENT").write_text(name)
        return name

    def load(self, name: str | None = None) -> Graph:
        d = self.path / (name or (self.path / "CURRENT").read_text())
        return Graph(self.spark.read.parquet(str(d / "entities")), self.spark.read.parquet(str(d / "relations")))

    def run(self, query, **params) -> DataFrame:
        """A query is a function of a graph."""
        return query(self.load(), **params)
