"""Lookup reloads, snapshots, exports, saved frames and the analytical view."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from switchflow.functions.dates import fin_quarter, fin_year
from switchflow.schema import VIEW_COLUMNS


def reload_lookup(df: DataFrame, path: str) -> int:
    """Replace a lookup table and return its new row count."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.parquet(path).count()


def save_frame(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate frame and go on from the written copy."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return load_frame(df.sparkSession, path)


def load_frame(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_snapshot(df: DataFrame, path: str, stamp: str) -> str:
    """CSV copy of what was loaded, null as empty; returns the folder written."""
    target = f"{path.rstrip('/')}/snapshot_{stamp}.csv"
    df.write.mode("errorifexists").csv(target, header=True, emptyValue="", nullValue="")
    return target


def export_results(frames: Mapping[str, DataFrame], path: str) -> dict[str, str]:
    """Write each result set as CSV below `path`; returns the folders by name."""
    out = {}
    for name, frame in frames.items():
        out[name] = f"{path.rstrip('/')}/{name}.csv"
        frame.write.mode("overwrite").option("partitionOverwriteMode", "static").csv(
            out[name], header=True, emptyValue="", nullValue=""
        )
    return out


def with_calendar(df: DataFrame, date: str = "stat_date") -> DataFrame:
    """Date, Year, Month and the two financial-year labels of the view."""
    return df.withColumn(date, F.col(date).cast("date")).withColumns(
        {"Year": F.year(date), "Month": F.month(date), "FinYear": fin_year(date), "FinYearQuarter": fin_quarter(date)}
    )


def read_view(
    spark: SparkSession, table: str | None = None, path: str | None = None, jdbc: Mapping[str, str] | None = None
) -> DataFrame:
    """The 20 named columns of the enriched view, from a table, a folder or JDBC."""
    if jdbc is not None:
        source = spark.read.format("jdbc").options(**jdbc).load()
    elif path is not None:
        source = spark.read.parquet(path)
    elif table is not None:
        source = spark.table(table)
    else:
        raise ValueError("give a table, a path or JDBC options")
    return source.select(*VIEW_COLUMNS)
