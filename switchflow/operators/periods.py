"""Latest rows, latest and previous periods, trailing windows, period change.

"Latest" is always a one-row aggregate used as a scalar subquery: Spark runs it once
and pushes the resulting equality into the scan of the main query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchflow.functions.dates import month_start, year_month
from switchflow.functions.stats import total
from switchflow.operators.trends import transfers_of
from switchflow.schema import EXCLUDED_FINYEARS


def exclude_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Drop rows whose value is listed; a null value is dropped as well."""
    return df.filter(~F.col(col).isin(*values))


def report_facts(df: DataFrame, excluded: Sequence[str] = EXCLUDED_FINYEARS) -> DataFrame:
    """The report's fact frame: month label, latest-month flag, excluded years out.

    The flag looks at all rows, before the exclusion.
    """
    flagged = flag_latest_month(df).withColumn("YearMonth", year_month("stat_date"))
    return exclude_values(flagged, "FinYear", excluded)


def _latest_year_month(df: DataFrame, year: str, month: str) -> tuple[Column, Column]:
    top = df.filter(F.col(year).isNotNull() & F.col(month).isNotNull()).agg(F.max(F.struct(year, month)).alias("m"))
    return top.select(F.col("m")[year]).scalar(), top.select(F.col("m")[month]).scalar()


def is_latest_month(df: DataFrame, year: str = "Year", month: str = "Month") -> Column:
    y, m = _latest_year_month(df, year, month)
    return (F.col(year) == y) & (F.col(month) == m)


def flag_latest_month(df: DataFrame, year: str = "Year", month: str = "Month") -> DataFrame:
    """Mark rows of the greatest Year and, in it, the greatest Month."""
    return df.withColumn("is_latest_month", is_latest_month(df, year, month))


def latest_month_rows(df: DataFrame, year: str = "Year", month: str = "Month") -> DataFrame:
    """Only the rows of the latest month; the filter reaches the scan."""
    return df.filter(is_latest_month(df, year, month))


def latest_per_key(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows carrying their key's greatest `ts`; ties are all kept.

    Aggregate plus semi join instead of a window: the maximum is combined on the map
    side, and a hot key's rows are never sorted in one task.
    """
    newest = df.groupBy(F.col(key).alias("_k")).agg(F.max(ts).alias("_t"))
    return df.join(newest, F.col(key).eqNullSafe(F.col("_k")) & (F.col(ts) == F.col("_t")), "left_semi")


def latest_change(df: DataFrame, value: str = "stat_value") -> DataFrame:
    """Last month against the month before it: one row with % change and direction."""
    monthly = transfers_of(df).groupBy(month_start("stat_date").alias("month")).agg(total(value).alias("v"))
    last_two = monthly.orderBy(F.col("month").desc()).limit(2)
    one = last_two.agg(
        F.max("month").alias("month"),
        F.max_by("v", "month").alias("transfers"),
        F.when(F.count(F.lit(1)) == 2, F.min_by("v", "month")).alias("previous"),
    )
    change = F.round((F.col("transfers") - F.col("previous")) / F.col("previous") * 100, 1)
    return one.withColumn("pct_change", F.when(F.col("previous") != 0, change)).withColumn(
        "direction",
        F.when(F.col("pct_change") > 0, "increase").when(F.col("pct_change").isNotNull(), "decrease"),
    )


def previous_period(df: DataFrame, period: str = "YearMonth") -> DataFrame:
    """Latest period and the greatest period below it: one row."""
    latest = df.agg(F.max(period)).scalar()
    return df.filter(F.col(period) < latest).agg(F.max(period).alias("previous")).withColumn("latest", latest)


def last_12_months(df: DataFrame, date: str = "stat_date", of: DataFrame | None = None) -> DataFrame:
    """Rows from 12 months before the last date up to it, both ends included.

    The last date is taken over `of` (default: all of `df`), so a caller can filter
    `df` without moving the window.
    """
    last = (of if of is not None else df).agg(F.max(date).alias("d"))
    return df.filter(F.col(date).between(last.select(F.add_months("d", -12)).scalar(), last.scalar()))
