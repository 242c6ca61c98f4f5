"""File-stream ingest: each new extract once, checked, conformed and upserted."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from switchflow.functions.dates import local_now
from switchflow.operators.conform import conform
from switchflow.operators.quality import GATE_COLUMNS, assert_ids, refused_files
from switchflow.schema import LOADS
from switchflow.session import materialize
from switchflow.sources.manifest import commit
from switchflow.sources.raw import CSV_GLOB, headers, lacking_files, read_raw
from switchflow.sources.staging import base_name, new_load, replace_sources, write_load

# Schema the binary file source insists on.
_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_stream(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    checkpoint_path: str,
    manifest_path: str | None = None,
    lookup: DataFrame | None = None,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
    now: dt.datetime | None = None,
    max_files_per_trigger: int = 100,
    rejected_path: str | None = None,
) -> StreamingQuery:
    """Pick up new CSV files, run the id gate, and load each file that passes it.

    The stream only discovers files (their bytes are not read by it); every batch
    reads its files by header name. Without a manifest each file's partition is
    replaced. With one, every batch writes a load of its own and one commit makes it the
    live one. Either way a batch that is run again after a failure, or a replay with a
    fresh checkpoint, changes nothing that readers see.

    The gate (given a lookup) judges every file alone. With `rejected_path` refused files
    go there as (source_file, reason, unknown_ids, blank_measures, refused_at) and the
    others of the batch are loaded, so the stream goes on; a file refused again replaces
    its row. Without it a refused file fails the batch, and every restart will try again.
    Processes what is there and stops; start it again for later files.
    """

    def refuse(paths: list[str]) -> list[str]:
        """Write down the files that the gate refuses and return the others."""
        none = F.lit(None).cast("long")
        lacking = lacking_files(headers(spark, paths), paths, GATE_COLUMNS)
        refused = materialize(lacking.select("source_file", "reason", none.alias("unknown_ids"), none.alias("blank_measures")), "refused-files")
        names = {r["source_file"] for r in refused.collect()}  # files of this batch
        whole = [p for p in paths if base_name(p) not in names]
        if whole:
            refused = refused.unionByName(refused_files(conform(read_raw(spark, whole, now)), lookup))
            refused = materialize(refused, "refused-files")
            names = {r["source_file"] for r in refused.select("source_file").collect()}
        if names:
            stamp = F.lit(now).cast("timestamp_ntz") if now is not None else local_now()
            replace_sources(refused.withColumn("refused_at", stamp), rejected_path)
        return [p for p in paths if base_name(p) not in names]

    def load(batch: DataFrame, _epoch: int) -> None:
        paths = [r["path"] for r in batch.select("path").orderBy("path").collect()]  # file names only
        if paths and lookup is not None and rejected_path:
            paths = refuse(paths)
        if not paths:
            return
        rows = conform(read_raw(spark, paths, now, required=GATE_COLUMNS if lookup is not None else ()))
        if lookup is not None and not rejected_path:
            assert_ids(rows, lookup)
        rows = enrich(rows) if enrich else rows
        if not manifest_path:
            replace_sources(rows, output_path)
            return
        name = new_load()
        write_load(rows, output_path, name)
        commit(spark, manifest_path, spark.createDataFrame([(base_name(p), name) for p in paths], LOADS), taken="replace")

    found = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("pathGlobFilter", CSV_GLOB)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(input_path)
        .select(F.col("path"))
    )
    return (
        found.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
