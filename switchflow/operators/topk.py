"""Top-k entities, their monthly series, and display order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from switchflow.functions.dates import month_start
from switchflow.functions.stats import total
from switchflow.operators.periods import last_12_months
from switchflow.operators.trends import transfers_of
from switchflow.session import materialize

ENTITY = {"from": "FRMP_Retailer_name", "to": "NEWFRMP_Retailer_name"}


def trailing_moves(df: DataFrame, side: str, transfer_type: str | None = None) -> DataFrame:
    """Movements of the last 12 months that have an entity on the given side."""
    rows = transfers_of(last_12_months(df)).filter(F.col(ENTITY[side]).isNotNull())
    return rows.filter(F.col("transfer_type") == transfer_type) if transfer_type else rows


def top_k(df: DataFrame, entity: str, k: int, value: str = "stat_value", alias: str = "total") -> DataFrame:
    """The k largest entities by summed value; ties go by name."""
    sums = df.groupBy(entity).agg(total(value).alias(alias))
    return sums.orderBy(F.col(alias).desc(), F.col(entity)).limit(k)


def top_k_totals(
    df: DataFrame, side: str = "from", k: int = 10, shown: int = 5, transfer_type: str | None = None
) -> DataFrame:
    """First rows of the top-k list with their totals and 1-based position."""
    rows = top_k(trailing_moves(df, side, transfer_type), ENTITY[side], k, alias="transfers")
    return numbered(rows, [F.col("transfers").desc(), F.col(ENTITY[side])], "position", start=1).filter(F.col("position") <= shown)


def top_k_series(
    df: DataFrame, side: str = "from", k: int = 10, transfer_type: str | None = None, alias: str = "transfers"
) -> DataFrame:
    """Monthly series of the k largest entities over the last 12 months.

    Facts are summed to (month, entity) once; the ranking and the series both come
    from that result.
    """
    entity = ENTITY[side]
    monthly = (
        trailing_moves(df, side, transfer_type)
        .groupBy(month_start("stat_date").alias("year_month"), entity)
        .agg(total("stat_value").alias(alias))
    )
    best = top_k(monthly, entity, k, value=alias, alias="_total").select(entity)
    # k rows by construction, so this side is safe to broadcast.
    return monthly.join(F.broadcast(best), entity, "left_semi")


def numbered(df: DataFrame, order: Sequence, alias: str, start: int = 0) -> DataFrame:
    """Number the rows of a list that is short by construction (a limit, the ends of a few flows)."""
    return df.withColumn(alias, F.row_number().over(Window.orderBy(*order)) + (start - 1))


def positions(df: DataFrame, order: Sequence, alias: str, start: int = 0) -> DataFrame:
    """Number the rows 0, 1, 2, ... in the given total order.

    A window without partitions would pull all rows into one task. This is a range
    partitioned sort, written, and a count per partition.
    """
    ordered = materialize(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "positions")
    # The number's upper bits are the sorted partition, the lower ones the row in it: both as written.
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = ordered.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row per partition; Spark sends it along when its size allows.
    offsets = materialize(sizes.select("_p", before.alias("_before")), "offsets")
    return ordered.join(offsets, part == F.col("_p")).select(*df.columns, (F.col("_before") + row + start).alias(alias))


def order_by_measure(df: DataFrame, measure: str, name: str, alias: str = "sort_ix") -> DataFrame:
    """Display position of each category, smallest measure first, ties by name."""
    return positions(df, [F.col(measure), F.col(name)], alias, start=1).withColumn(alias, F.col(alias).cast("int"))


def order_with_totals_last(df: DataFrame, name: str, total_names: Sequence[str]) -> DataFrame:
    """Alphabetical order with the total rows pinned to the bottom."""
    return df.orderBy(F.col(name).isin(*total_names), F.col(name))
