"""Staging and enriched tables: Parquet, one partition per source file and load.

A load writes new partitions beside the ones before and never touches those. The manifest
is written last, in one step, and tells which load of a file is live: readers see the old
rows until then, whatever becomes of the load, and the new ones from then on.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchflow.operators.conform import align, conform
from switchflow.schema import STAGING
from switchflow.sources.manifest import commit, read_manifest, remaining_files, version
from switchflow.sources.raw import read_raw

# Bytes of CSV in a batch: a batch is one write, and one new file in the manifest.
BATCH_BYTES = 1 << 38


def base_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def append_staging(df: DataFrame, path: str) -> None:
    """Add conformed rows. Input splits belong to one file each, so no shuffle is needed."""
    align(df).write.mode("append").partitionBy("source_file").parquet(path)


def replace_sources(df: DataFrame, path: str) -> None:
    """Replace the partitions of the source files in `df`, and only those, for tables without loads.

    Readers meanwhile see a partition go and come; use `write_load` where that matters.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_file").parquet(path)


def batches(files: Sequence[tuple[str, int]], batch_size: int | None = None, batch_bytes: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Paths in batches of `batch_size` files, or else of `batch_bytes`; at least one file each."""
    batch, size = [], 0
    for path, length in files:
        if batch and (len(batch) == batch_size if batch_size else size + length > batch_bytes):
            yield batch
            batch, size = [], 0
        batch.append(path)
        size += length
    if batch:
        yield batch


def new_load() -> str:
    return uuid.uuid4().hex


def write_load(df: DataFrame, path: str, load: str) -> None:
    """Write the rows of a load beside those of other loads; nobody sees them before `load` is in the manifest."""
    df.withColumn("load", F.lit(load)).write.mode("append").partitionBy("source_file", "load").parquet(path)


def load_batches(
    spark: SparkSession,
    files: Sequence[tuple[str, int]],
    staging_path: str,
    manifest_path: str,
    batch_size: int | None = None,
    now: dt.datetime | None = None,
    on_batch: Callable[[DataFrame, list[str]], None] | None = None,
    again: bool = False,
) -> list[str]:
    """Load files (path, bytes) in all-or-nothing batches; returns the names loaded.

    Files already in the manifest are skipped, or with `again` replaced by this load. A
    batch that fails leaves the manifest as it was: none of its rows are visible, and
    those of an earlier load stay so. Later batches do not run. A file that another run
    has loaded meanwhile is left to that run.
    """
    if not files:
        return []
    seen = version(spark, manifest_path)
    todo = spark.createDataFrame([(base_name(p), p, n) for p, n in files], "source_file string, path string, length long")
    if not again:
        todo = remaining_files(todo, read_manifest(spark, manifest_path))
    pending = [(r["path"], r["length"]) for r in todo.orderBy("path").collect()]  # names and sizes of what is left
    loaded: list[str] = []
    for batch in batches(pending, batch_size):
        names, load = [base_name(f) for f in batch], new_load()
        rows = conform(read_raw(spark, batch, now))
        if on_batch:
            on_batch(rows, names)
        write_load(rows, staging_path, load)
        done = spark.createDataFrame([(n, load) for n in names], "source_file string, load string")
        added = commit(spark, manifest_path, done, seen, "replace" if again else "skip")
        loaded += [r["source_file"] for r in added.orderBy("source_file").collect()]  # of this batch
    return loaded


def live_rows(spark: SparkSession, path: str, manifest: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of the live loads, in the columns of `schema`; none where nothing has been written yet."""
    try:
        rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("load", T.StringType())])).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    live = manifest.select(F.col("source_file").alias("_file"), F.col("load").alias("_load"))
    return rows.join(live, (rows.source_file == F.col("_file")) & (rows.load == F.col("_load")), "left_semi").select(*schema.names)


def read_staging(spark: SparkSession, path: str, manifest: DataFrame | None = None, schema: T.StructType = STAGING) -> DataFrame:
    """Staged rows, limited to completed files, and to their live loads, if a manifest is given.

    A manifest without the column `load` belongs to a table without loads. The schema is
    stated: partition names such as `201801` stay text.
    """
    if manifest is not None and "load" in manifest.columns:
        return live_rows(spark, path, manifest, schema)
    rows = spark.read.schema(schema).parquet(path).select(*schema.names)
    return rows if manifest is None else rows.join(manifest.select("source_file"), "source_file", "left_semi").select(*schema.names)


def remove_dead_loads(spark: SparkSession, path: str, manifest: DataFrame, older_than: dt.timedelta = dt.timedelta(days=7)) -> int:
    """Delete partitions whose load is not live, of files written long enough ago; returns their number.

    Younger ones may belong to a load under way, or to a reader of the manifest before.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    part = F.regexp_extract("path", r"^(.*/source_file=[^/]*/load=([^/]*))/[^/]*$", 1)
    load = F.regexp_extract("path", r"/load=([^/]*)/[^/]*$", 1)
    written = files.select(part.alias("part"), load.alias("load"), "modificationTime").groupBy("part", "load").agg(F.max("modificationTime").alias("at"))
    late = dt.datetime.now(dt.timezone.utc) - older_than
    dead = written.filter(F.col("at") < F.lit(late)).join(manifest.filter("load IS NOT NULL").select("load"), "load", "left_anti")
    n, fs = 0, None
    for (folder,) in dead.select("part").toLocalIterator():
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = fs or at.getFileSystem(spark._jsc.hadoopConfiguration())
        n += fs.delete(at, True)
    return n


def upsert_by_source(
    staging: DataFrame, target_path: str, source_files: str | Sequence[str] | DataFrame,
    enrich: Callable[[DataFrame], DataFrame] | None = None, load: str | None = None,
) -> None:
    """Rebuild the rows of one or many files in the target, in one write; running it twice changes nothing.

    Many files are best given as a frame with a column `source_file`. With a load the
    rows come beside those of other loads, else they replace the files' partitions.
    """
    if isinstance(source_files, DataFrame):
        # A list of file names: broadcast, so that the rows keep their splits and no task gets a whole file.
        names = F.broadcast(source_files.select("source_file").distinct())
        rows = staging.join(names, "source_file", "left_semi").select(*staging.columns)
    else:
        names = [source_files] if isinstance(source_files, str) else list(source_files)
        rows = staging.filter(staging.source_file.isin(names))
    rows = enrich(rows) if enrich else rows
    if load:
        write_load(rows, target_path, load)
    else:
        replace_sources(rows, target_path)
