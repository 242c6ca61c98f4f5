"""Session defaults and the shared scratch location."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    # Wall-clock data: no zone shifting between reader, engine and oracle.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesces small shuffles, splits skewed join
    # partitions and turns a join into a broadcast only once the side's real
    # size is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.showConsoleProgress": "false",
}


# Lists that note the scratch paths handed out, innermost last.
_OWNERS: list[list[str]] = []


def build_session(app: str = "switchflow", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """SparkSession with the library's defaults; `conf` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the cluster's shared folder (`spark.checkpoint.dir`).

    Without that setting it is a folder below the warehouse, which executors share too.
    """
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for owner in _OWNERS:
        owner.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Owner of the scratch paths handed out inside: they are removed when it ends.

    Results that read them must be consumed by then.
    """
    own: list[str] = []
    _OWNERS.append(own)
    try:
        yield
    finally:
        _OWNERS.remove(own)
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        for path in own:
            at = hadoop(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialize(df: DataFrame, label: str = "frame") -> DataFrame:
    """Write the frame to the shared folder and go on from the written copy.

    For frames that are read several times (iterative fits, exact order statistics):
    the lineage is cut, the copy survives the loss of executors, and as Parquet it
    still prunes columns and carries sizes for the join planner.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
