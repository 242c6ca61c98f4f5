"""Raw monthly CSV extracts: listing, reading by header name, lineage, line counts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from switchflow.functions.dates import local_now
from switchflow.functions.text import clean_name_list
from switchflow.operators.conform import blanks_to_null, clean_names
from switchflow.operators.reshape import stack
from switchflow.sources.records import read_records, record_counts

CSV_GLOB = "*.[cC][sS][vV]"


def list_inputs(spark: SparkSession, path: str) -> DataFrame:
    """CSV files of a folder: path, source_file, modified, length. Contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", CSV_GLOB).load(path)
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("source_file"),
        F.col("modificationTime").alias("modified"),
        "length",
    )


def newest_file(files: DataFrame) -> DataFrame:
    """The file changed last; by name, descending, where times are equal or unknown."""
    order = [F.col("modified").desc_nulls_last()] if "modified" in files.columns else []
    return files.orderBy(*order, F.col("source_file").desc()).limit(1)


def headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, header): the first line of each file that is not blank; files without one give no row.

    One job for any number of files. Lines are compared by their place, so only the
    first of each task is kept before the shuffle.
    """
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), "value")
    lines = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), place.alias("at"))
    first = lines.filter(F.trim("at.value") != "").groupBy("path").agg(F.min("at").alias("at"))
    return first.select("path", F.col("at.value").alias("header"))


def read_raw(
    spark: SparkSession,
    paths: str | Sequence[str],
    now: dt.datetime | None = None,
    multi_line: bool = False,
    required: Sequence[str] = (),
) -> DataFrame:
    """CSV files as strings with cleaned names and lineage; '' and `NA` are null.

    Spark applies one header to all files of a read, by position, so files whose
    columns are ordered differently would be swapped silently. Files are therefore
    read in one group per distinct header and put together by column name. Blank lines
    before the header are passed over; a file without any other line has no rows.
    `required` names (cleaned) columns that every file must have.
    `multi_line` allows line breaks inside quotes (see `sources.records`).
    """
    if isinstance(paths, str):
        paths = [r["path"] for r in list_inputs(spark, paths).select("path").orderBy("path").collect()]
    if not paths:
        raise FileNotFoundError("no CSV files found")
    found = headers(spark, paths)
    if required:
        require_headers(found, paths, required)
    groups = []
    if multi_line:
        groups = read_records(spark, paths)
    else:
        # One row per distinct header; file names only.
        for group in found.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("header").collect():
            raw = spark.read.csv([unquote(p) for p in group["paths"]], header=True, inferSchema=False, quote='"', escape='"')
            groups.append(raw.select(*[F.col(f"`{c}`") for c in raw.columns], F.col("_metadata.file_path").alias("_path")))
    frames = []
    for tagged in groups:
        text = clean_names(tagged.drop("_path"))
        frames.append(blanks_to_null(tagged.toDF(*text.columns, "_path"), text.columns))
    if not frames:
        frames = [spark.createDataFrame([], "_path string")]
    return with_lineage(stack(frames), now)


def header_names(found: DataFrame) -> DataFrame:
    """`found` (path, header) with names: the column names, cleaned, read from the line as CSV."""
    width = found.select(F.max(F.regexp_count("header", F.lit(","))) + 1).first()[0] or 1
    # Commas inside quotes leave fields at the end without a value.
    fields = [f"c{i}" for i in range(width)]
    parsed = F.from_csv("header", ", ".join(f"{c} string" for c in fields), {"quote": '"', "escape": '"'})
    lines = found.select("header").distinct().select("header", parsed.alias("c")).select("header", F.array(*[f"c.{c}" for c in fields]).alias("c"))
    rows = [(r["header"], clean_name_list([n for n in r["c"] if n is not None])) for r in lines.collect()]  # a few distinct header lines
    return found.join(found.sparkSession.createDataFrame(rows, "header string, names array<string>"), "header").select("path", "header", "names")


def lacking_files(found: DataFrame, paths: Sequence[str], required: Sequence[str]) -> DataFrame:
    """(source_file, reason) of files that lack a required column; a file without a header lacks them all."""
    named = header_names(found).withColumn("absent", F.array_except(F.array(*map(F.lit, required)), "names"))
    say = F.concat(F.lit("missing required columns: "), F.array_join("absent", ", "), F.lit(" in a file with the header "), F.substring("header", 1, 200))
    bad = named.filter(F.size("absent") > 0).select(file_name(F.col("path")).alias("source_file"), say.alias("reason"))
    asked = found.sparkSession.createDataFrame([(p.rstrip("/").rsplit("/", 1)[-1],) for p in paths], "source_file string")
    empty = asked.join(found.select(file_name(F.col("path")).alias("source_file")), "source_file", "left_anti")
    return bad.union(empty.select("source_file", F.lit(f"missing required columns: {', '.join(required)} in an empty file")))


def require_headers(found: DataFrame, paths: Sequence[str], required: Sequence[str]) -> None:
    """Raise if a file lacks a required column; a file without a header lacks them all."""
    bad = lacking_files(found, paths, required).select("reason").head(1)
    if bad:
        raise ValueError(bad[0][0])


def file_name(path: Column) -> Column:
    """Base name of an encoded path, where a plus sign is a plus sign."""
    return F.url_decode(F.replace(F.element_at(F.split(path, "/"), -1), F.lit("+"), F.lit("%2B")))


def with_lineage(df: DataFrame, now: dt.datetime | None = None, path_col: str = "_path") -> DataFrame:
    """Tag rows with `source_file` (base name) and `date_imported` (naive local time)."""
    stamp = F.lit(now).cast("timestamp_ntz") if now is not None else local_now()
    name = file_name(F.col(path_col))
    return df.withColumns({"source_file": name, "date_imported": stamp}).drop(path_col)


def raw_record_counts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Records minus the header per file; line breaks inside quotes belong to their record."""
    counts = record_counts(spark, paths)
    return counts.select(file_name(F.col("path")).alias("source_file"), (F.col("n") - 1).alias("raw_count"))


def raw_line_counts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines minus the header per file, blank lines aside. A line break inside quotes counts as a line."""
    if isinstance(paths, str):
        lines = spark.read.option("pathGlobFilter", CSV_GLOB).text(paths)
    else:
        lines = spark.read.text(list(paths))
    name = file_name(F.col("_metadata.file_path"))
    counts = lines.filter(F.trim("value") != "").select(name.alias("source_file")).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("source_file", F.greatest(F.lit(0).cast("long"), F.col("n") - 1).alias("raw_count"))
