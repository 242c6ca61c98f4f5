"""The list of completed files: what readers may see and loaders may skip.

The list is a log of numbered commits. A commit names a folder of (source_file, load)
rows, written by the executors before; of several commits with one file the last one
tells which load of it is live. Commits are put in place only if their number is free, so
two runs never both believe to have written the same one, and a run learns what others
have committed since it looked. Every COMPACT_EVERY commits the list is written anew as
one folder, so reading it never opens more than that many, however long the history.

The store must rename a file without replacing another one, as HDFS does; two runs on a
store that can't (plain object stores) need a lock of their own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from switchflow.schema import LOADS, MANIFEST

COMPACT_EVERY = 20
_LOG = "_log"


class AlreadyProcessed(ValueError):
    """The file is in the manifest already."""


class Conflict(RuntimeError):
    """Another run has committed one of the files since this one looked."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _entries(spark: SparkSession, path: str) -> tuple[list[tuple[int, str]], list[tuple[int, str]]]:
    """(number, name) of the commits and of the compactions in the log, ascending."""
    fs, log = _files(spark, path), _path(spark, f"{path}/{_LOG}")
    if not fs.exists(log):
        return [], []
    names = [s.getPath().getName() for s in fs.listStatus(log)]
    of = lambda kind: sorted((int(n.split(".")[0]), n) for n in names if n.endswith(f".{kind}"))
    return of("commit"), of("whole")


def _folder(spark: SparkSession, path: str, entry: str) -> str:
    """The folder that an entry names. Entries are a line of text."""
    stream = _files(spark, path).open(_path(spark, f"{path}/{_LOG}/{entry}"))
    try:
        return json.loads(bytes(stream.readAllBytes()))["names"]
    finally:
        stream.close()


def _put(spark: SparkSession, path: str, entry: str, folder: str) -> bool:
    """Write an entry unless there is one of its name."""
    jvm = spark._jvm
    fs = _files(spark, path)
    draft, place = _path(spark, f"{path}/{_LOG}/.{uuid.uuid4().hex}"), _path(spark, f"{path}/{_LOG}/{entry}")
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps({"names": folder}).encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(place), spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
            raise
        fs.delete(draft, False)
        return False
    return True


def version(spark: SparkSession, path: str) -> int:
    """Number of the last commit; 0 before the first."""
    commits, wholes = _entries(spark, path)
    return max([n for n, _ in (*commits[-1:], *wholes[-1:])], default=0)


def _rows(spark: SparkSession, path: str, parts: Sequence[tuple[int, str]]) -> DataFrame:
    """Live (source_file, load) of log entries (number, entry name): the last one wins."""
    folders = {_folder(spark, path, entry): n for n, entry in parts}
    if not folders:
        return spark.createDataFrame([], LOADS)
    found = spark.read.schema(LOADS).parquet(*[f"{path}/{f}" for f in folders])
    order = F.create_map(*[F.lit(x) for pair in folders.items() for x in pair])
    numbered = found.withColumn("_n", order[F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)])
    last = F.max_by(F.struct("load"), "_n").alias("x")  # in a struct: a load may be null
    return numbered.filter(F.col("source_file").isNotNull()).groupBy("source_file").agg(last).select("source_file", "x.load")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, load) of the completed files, each once; empty before the first load.

    load names the partition of the file that is live; it is null for files that were
    only marked as done.
    """
    commits, wholes = _entries(spark, path)
    base = wholes[-1:]
    return _rows(spark, path, base + [c for c in commits if not base or c[0] > base[0][0]])


def _since(spark: SparkSession, path: str, seen: int) -> DataFrame | None:
    """What was committed after `seen`; all of the list, where the log does not go back that far."""
    commits, wholes = _entries(spark, path)
    later = [c for c in commits if c[0] > seen]
    if len(later) < max([n for n, _ in (*commits[-1:], *wholes[-1:])], default=0) - seen:
        return read_manifest(spark, path)
    return _rows(spark, path, later) if later else None


def commit(spark: SparkSession, path: str, done: DataFrame, seen: int | None = None, taken: str = "raise") -> DataFrame:
    """Add (source_file, load) rows in one commit and return those that were added.

    seen: the version the caller has looked at. taken: what to do about files that others
    have committed since: "raise" Conflict, "skip" them, or "replace" the others' loads.
    """
    seen = version(spark, path) if seen is None else seen
    while True:
        now = version(spark, path)
        others = _since(spark, path, seen) if now > seen and taken != "replace" else None
        if others is not None:
            hit = done.join(others.select("source_file"), "source_file", "left_semi").select("source_file").head(1)
            if hit and taken == "raise":
                raise Conflict(f"{hit[0][0]} was loaded by another run")
            if hit:
                done = remaining_files(done, others)
        folder = f"names-{uuid.uuid4().hex}"
        done.select(*LOADS.names).coalesce(1).write.parquet(f"{path}/{folder}")
        added = spark.read.schema(LOADS).parquet(f"{path}/{folder}")
        if _put(spark, path, f"{now + 1:020d}.commit", folder):
            if (now + 1) % COMPACT_EVERY == 0:
                compact(spark, path)
            return added
        # Another run was faster: look at what it has committed, and try the next number.
        _files(spark, path).delete(_path(spark, f"{path}/{folder}"), True)


def compact(spark: SparkSession, path: str) -> None:
    """Write the whole list as one folder, and drop what the compaction before has replaced.

    What was live between the two stays for readers that are still at it.
    """
    commits, wholes = _entries(spark, path)
    if not commits:
        return
    folder = f"names-{uuid.uuid4().hex}"
    base = wholes[-1:]
    own = base + [c for c in commits if not base or c[0] > base[0][0]]
    _rows(spark, path, own).write.parquet(f"{path}/{folder}")
    if not _put(spark, path, f"{own[-1][0]:020d}.whole", folder) or not base:
        return
    fs = _files(spark, path)
    for n, entry in [*[c for c in commits if c[0] <= base[0][0]], *wholes[:-1]]:
        gone = _folder(spark, path, entry)
        fs.delete(_path(spark, f"{path}/{_LOG}/{entry}"), False)
        fs.delete(_path(spark, f"{path}/{gone}"), True)


def remaining_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that are not in the manifest (also: downloads still to be made)."""
    return files.join(manifest.select("source_file"), "source_file", "left_anti")


def add_done(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """Manifest rows plus the newly completed ones, each file once."""
    return manifest.select("source_file").union(done.select("source_file")).dropDuplicates(["source_file"])


def mark_done(spark: SparkSession, names: Sequence[str], path: str) -> None:
    """Add names without a load of their own; those already listed stay as they are."""
    seen = version(spark, path)
    done = spark.createDataFrame([(n,) for n in sorted(set(names))], MANIFEST)
    left = remaining_files(done, read_manifest(spark, path)).withColumn("load", F.lit(None).cast("string"))
    commit(spark, path, left, seen, "skip")


def already_processed(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose name is in the manifest, spaces and letter case aside."""
    clean = F.lower(F.trim("source_file"))
    known = manifest.select(clean.alias("_name")).distinct()
    return files.join(known, clean == F.col("_name"), "left_semi")


def assert_new(files: DataFrame, manifest: DataFrame) -> None:
    """Raise if any of the files was processed before."""
    hit = already_processed(files, manifest).select("source_file").head(1)
    if hit:
        raise AlreadyProcessed(f"{hit[0][0]} has already been processed; remove it from the manifest to run it again")
