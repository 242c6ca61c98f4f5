"""Weekly movements, rates, lagged offers: the frame the offer study works on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchflow.functions.dates import week_start
from switchflow.functions.stats import strict_mean, strict_sum, total
from switchflow.operators.joins import left_join_nullsafe
from switchflow.operators.reshape import min_group_size
from switchflow.operators.trends import base_of, transfers_of
from switchflow.schema import CHANGE_CODES

LAGS = (1, 2, 4, 8)
CELL = ("date", "retailer")


def daily_transfers(df: DataFrame, year: int = 2022, codes: Sequence[str] = CHANGE_CODES) -> DataFrame:
    """Daily movements from `year` on whose reason is a change of retailer."""
    rows = transfers_of(df).filter((F.col("Year") >= year) & F.col("crcode").isin(*[str(c) for c in codes]))
    return rows.select(
        F.col("stat_date").cast("date").alias("transfer_date"),
        "Year",
        "Month",
        F.col("stat_value").alias("transfers_count"),
        F.col("FRMP_Retailer_name").alias("from_retailer"),
        F.col("NEWFRMP_Retailer_name").alias("to_retailer"),
        F.col("crcode").alias("reason_code"),
    )


def customer_base(df: DataFrame, year: int = 2022) -> DataFrame:
    """Customers per entity and month from `year` on."""
    rows = base_of(df).filter(F.year("stat_date") >= year)
    return rows.groupBy("Year", "Month", F.col("FRMP_Retailer_name").alias("retailer")).agg(
        total("stat_value").alias("customer_count")
    )


def weekly_transfers(daily: DataFrame) -> DataFrame:
    """Sum and mean per row for each Monday week, year, month and losing entity.

    A week across a month end gives two rows, because the base it is compared with
    is monthly. The mean is over rows, not days; a null count makes both null.
    """
    return daily.groupBy(
        week_start("transfer_date").alias("date"), "Year", "Month", F.col("from_retailer").alias("retailer")
    ).agg(
        strict_sum("transfers_count").alias("total_transfers_out"),
        strict_mean("transfers_count").alias("avg_daily_transfers"),
    )


def transfer_rates(weekly: DataFrame, base: DataFrame) -> DataFrame:
    """Movements as % of the customer base; null where the base is absent or 0."""
    joined = left_join_nullsafe(weekly, base, ["Year", "Month", "retailer"])
    n = F.col("customer_count")
    return joined.withColumns(
        {
            "transfer_rate": F.when(n > 0, F.col("total_transfers_out") / n * 100),
            "avg_daily_transfer_rate": F.when(n > 0, F.col("avg_daily_transfers") / n * 100),
        }
    )


def lagged_wide(snapshots: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """Snapshots of the same week and of each lag side by side, keyed by week.

    Every snapshot is sent to the weeks it is a lag of, and one grouping lays the
    lags out as columns: one shuffle in place of a join per lag.
    """
    metrics = [c for c in snapshots.columns if c not in CELL]
    shifted = snapshots.select(
        F.explode(F.array(F.lit(0), *[F.lit(n) for n in lags])).alias("_lag"), F.col("date").alias("_at"), "retailer",
        F.struct(*metrics).alias("_m"),
    ).select(F.expr("date_add(_at, 7 * _lag)").alias("date"), "retailer", "_lag", "_m")
    # A (week, retailer) cell has one snapshot per lag, so `max` picks just that one.
    wide = shifted.groupBy(*CELL).agg(
        *[F.max(F.when(F.col("_lag") == n, F.col("_m"))).alias(f"_m{n}") for n in (0, *lags)]
    )
    return wide.selectExpr(
        *CELL,
        *[f"_m0.{c} AS {c}" for c in metrics],
        *[f"_m{n}.{c} AS {c}_lag{n}w" for n in lags for c in metrics],
    )


def attach_lags(weekly: DataFrame, snapshots: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """Weekly rows with the offers of the same week and of 1, 2, 4 and 8 weeks before."""
    return left_join_nullsafe(weekly, lagged_wide(snapshots, lags), list(CELL))


def analysis_dataset(
    weekly: DataFrame,
    base: DataFrame,
    snapshots: DataFrame,
    lags: Sequence[int] = LAGS,
    min_rows: int = 100,
    faithful_fanout: bool = False,
) -> DataFrame:
    """Master frame: rates, current and lagged offers, entities with enough rows.

    By default a week split over two months stays two rows. The original chained one
    join per lag on (week, retailer) alone, which repeats such rows; with
    `faithful_fanout` each of the m rows of a cell appears m ** len(lags) times, and
    the repeats count towards `min_rows`.

    Neither the base nor the lags add rows, so the row-count filter runs first.
    """
    rows = weekly
    if faithful_fanout:
        size = rows.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_n"))
        copies = F.sequence(F.lit(1), F.pow("_n", F.lit(len(lags))).cast("int"))
        rows = left_join_nullsafe(rows, size, list(CELL)).withColumn("_copy", F.explode(copies)).drop("_n", "_copy")
    kept = min_group_size(rows, ["retailer"], min_rows)
    rated = transfer_rates(kept, base).filter(F.col("customer_count").isNotNull())
    return attach_lags(rated, snapshots, lags)
