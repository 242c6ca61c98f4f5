"""CSV records with line breaks inside quotes, found without one task per file.

Spark's own reader takes a file with such records as a whole, in one task. Here files are
read as lines, in splits. A line break belongs to a record when the quotes before it are
odd in number, so the parity of quotes per split, summed up over the splits of a file,
tells every split whether it starts inside a record. Each split is then read in its
order by one task, without a shuffle of lines; only the pieces of records that cross
the end of a split are brought together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from switchflow.session import materialize

_SPLIT = ["path", "block"]


def _scan(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, block, line, value): the lines of the files, in their order within each split."""
    return spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), "value"
    )


def _carries(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, int], int]:
    """Per split: 1 if it starts inside a record (the quotes of the splits before it are odd)."""
    splits = _scan(spark, paths).groupBy(*_SPLIT).agg((F.sum(F.regexp_count("value", F.lit('"'))) % 2).alias("odd"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    carried = splits.select(*_SPLIT, F.coalesce(F.sum("odd").over(before) % 2, F.lit(0)).alias("carry"))
    return {(r["path"], r["block"]): int(r["carry"]) for r in carried.collect()}  # one small row per split of a file


_PLACED = "path string, block long, line long, value string, piece boolean, starts boolean"


def _placed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, block, line, value, piece, starts): records put together within each split, without a shuffle.

    A row is a record that lies in its split (line: its first line), or, with `piece`,
    the part in one split of a record that crosses the split's end or comes from before
    it. starts: the record begins on this row's line.
    """
    carries = _carries(spark, paths)

    def place(batches):
        import pandas as pd

        key, odd, rec = None, 0, None  # rec: [first line, starts here, lines]
        for b in batches:
            out = []
            for path, block, line, value in zip(b["path"].tolist(), b["block"].tolist(), b["line"].tolist(), b["value"].tolist()):
                if (path, block) != key:
                    if rec is not None:  # goes on in the next split
                        out.append((key[0], key[1], rec[0], "\n".join(rec[2]), True, rec[1]))
                    key, odd = (path, block), carries.get((path, block), 0)
                    rec = [line, False, []] if odd else None
                opens = value.count('"') % 2
                if not odd:
                    if opens:
                        rec = [line, True, [value]]
                    elif value.strip(" ") != "":
                        out.append((path, block, line, value, False, True))
                else:
                    rec[2].append(value)
                    if opens:
                        out.append((path, block, rec[0], "\n".join(rec[2]), not rec[1], rec[1]))
                        rec = None
                odd ^= opens
            yield pd.DataFrame(out, columns=["path", "block", "line", "value", "piece", "starts"])
        if rec is not None:
            yield pd.DataFrame([(key[0], key[1], rec[0], "\n".join(rec[2]), True, rec[1])], columns=["path", "block", "line", "value", "piece", "starts"])

    return _scan(spark, paths).mapInPandas(place, _PLACED)


def record_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, block, line, value): one row per record, its line breaks as line feeds, at the place of its first line.

    Blank lines between records are left out. A quote that is never closed makes one
    record of all that follows in its file.
    """
    placed = materialize(_placed(spark, paths), "csv-lines")
    whole = placed.filter("NOT piece").select("path", "block", "line", "value")
    # Pieces: at most two a split. One that does not start its record belongs to the last record started before it.
    pieces = placed.filter("piece")
    upto = Window.partitionBy("path").orderBy("block", "line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = F.struct(F.col("block").alias("block"), F.col("line").alias("line"))
    keyed = pieces.withColumn("head", F.last(F.when(F.col("starts"), at), ignorenulls=True).over(upto))
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "value")))  # the pieces of one record
    joined = keyed.groupBy("path", "head").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
    return whole.union(joined.select("path", "head.block", "head.line", "value"))


def record_counts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, n): records per file, the header among them."""
    return _placed(spark, paths).filter("starts").groupBy("path").agg(F.count(F.lit(1)).alias("n"))


def read_records(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """A frame of strings (columns as named, _path) for each distinct header of the files."""
    found = materialize(record_lines(spark, paths), "csv-records")
    place = F.struct("block", "line", "value")
    heads = materialize(found.groupBy("path").agg(F.min(place).alias("h")).select("path", "h.block", "h.line", F.col("h.value").alias("header")), "csv-headers")
    out = []
    for (header,) in heads.select("header").distinct().orderBy("header").collect():  # a few distinct headers
        width = header.count(",") + 1
        fields = ", ".join(f"c{i} string" for i in range(width))
        options = {"quote": '"', "escape": '"'}
        names = [n for n in spark.createDataFrame([(header,)], "h string").select(F.from_csv("h", fields, options).alias("c")).select("c.*").first() if n is not None]
        rows = found.join(heads.filter(F.col("header") == header).select("path", F.col("block").alias("_b"), F.col("line").alias("_l")), "path")
        rows = rows.filter((F.col("block") != F.col("_b")) | (F.col("line") != F.col("_l")))
        fields = ", ".join(f"c{i} string" for i in range(len(names)))
        parsed = rows.select("path", F.from_csv("value", fields, options).alias("c")).select(*[F.col(f"c.c{i}") for i in range(len(names))], "path")
        out.append(parsed.toDF(*names, "_path"))
    return out
