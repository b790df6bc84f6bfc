"""Sessions, shared storage and lineage cuts.

Intermediate tables go to the folder the cluster names in ``spark.checkpoint.dir``.
Only a local session without that setting (a test) gets a folder of its own; on a cluster its absence is an error.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_written: list[tuple[SparkSession, str]] = []


def local_session(cores: int | str = 8, memory: str = "8g", partitions: int = 8) -> SparkSession:
    """Session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("loomgraph")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share; a temporary one where the session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        sc = spark.sparkContext
        named = sc.getCheckpointDir()
        if not named:
            if not sc.master.startswith(("local[", "local-cluster")) and sc.master != "local":
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="loomgraph-"))
            named = sc.getCheckpointDir()
    return named.rstrip("/")


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loomgraph-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def release(df: DataFrame) -> None:
    """Delete what ``materialize`` wrote for ``df``, once nothing reads it any more."""
    if path := getattr(df, "_written_to", None):
        discard(df.sparkSession, path)


def discard(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            discard(spark, path)
        except Exception:  # the session may have ended
            return


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only when a count proves the bound; otherwise the join shuffles.

    ``df`` should be materialised, since it is counted.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
