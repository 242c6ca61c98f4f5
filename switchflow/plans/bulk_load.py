"""Bulk load: every pending extract of a folder, in batches, then the audit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from switchflow.operators.quality import verification_report
from switchflow.schema import MANIFEST
from switchflow.sources.frames import write_snapshot
from switchflow.sources.manifest import read_manifest, remaining_files
from switchflow.sources.raw import list_inputs, raw_line_counts
from switchflow.sources.staging import load_batches, read_staging


def run_bulk_load(
    spark: SparkSession,
    raw_path: str,
    staging_path: str,
    manifest_path: str,
    snapshot_path: str | None = None,
    batch_size: int | None = None,
    now: dt.datetime | None = None,
) -> list[str]:
    """Load what the manifest does not list yet; returns the names loaded."""
    pending = remaining_files(list_inputs(spark, raw_path), read_manifest(spark, manifest_path))
    files = [(r["path"], r["length"]) for r in pending.select("path", "length").orderBy("path").collect()]  # names and sizes only
    loaded = load_batches(spark, files, staging_path, manifest_path, batch_size, now)
    if snapshot_path and loaded:
        stamp = (now or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")
        names = spark.createDataFrame([(n,) for n in loaded], MANIFEST)
        live = read_manifest(spark, manifest_path).join(names, "source_file", "left_semi")
        write_snapshot(read_staging(spark, staging_path, live), snapshot_path, stamp)
    return loaded


def audit(spark: SparkSession, raw_path: str, staging_path: str, manifest_path: str) -> DataFrame:
    """One row per completed file: missing, null dates, count mismatch."""
    manifest = read_manifest(spark, manifest_path)
    return verification_report(read_staging(spark, staging_path, manifest), manifest, raw_line_counts(spark, raw_path))


def reload(spark: SparkSession, paths: Sequence[str], staging_path: str, manifest_path: str, now: dt.datetime | None = None) -> list[str]:
    """Load files again, all at once; readers see their earlier rows until the new ones are complete."""
    return load_batches(spark, [(p, 0) for p in paths], staging_path, manifest_path, len(paths), now, again=True)
