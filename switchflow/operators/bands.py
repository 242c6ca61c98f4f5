"""Price bands, threshold curves and class effects on the master frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchflow.functions.labels import (
    BASELINE_BAND,
    LAG_LABELS,
    TOP_BAND,
    band_order,
    contract_class,
    contract_detail_class,
    incentive_class,
    price_band,
    solar_class,
)
from switchflow.functions.stats import exact_median
from switchflow.operators.joins import left_join_nullsafe
from switchflow.operators.reshape import stack

RATE = "transfer_rate"


def _mean_median_count(df: DataFrame, keys: Sequence[str], value: str, mean: str, median: str, n: str) -> DataFrame:
    sums = df.groupBy(*keys).agg(F.avg(value).alias(mean), F.count(F.lit(1)).alias(n))
    return left_join_nullsafe(sums, exact_median(df, keys, value, median), keys).select(*keys, mean, median, n)


def segment_by_band(df: DataFrame, price_col: str, value_col: str = RATE, lag_label: str | None = None) -> DataFrame:
    """Mean, median and row count of a value per price band."""
    rows = df.filter(F.col(price_col).isNotNull()).select(price_band(price_col).alias("price_group"), value_col)
    out = _mean_median_count(rows, ["price_group"], value_col, "avg_value", "median_value", "n_retailer_weeks")
    out = out.withColumn("band_ix", band_order("price_group"))
    return out.withColumn("lag", F.lit(lag_label)) if lag_label is not None else out


def segment_all_lags(
    df: DataFrame, lags: Sequence[int] = (0, 2, 4, 8), price: str = "price_vs_market", value_col: str = RATE
) -> DataFrame:
    """`segment_by_band` for several lags from one pass: lags are rows, not scans."""
    present = [n for n in lags if _lag_column(price, n) in df.columns]
    pairs = F.array(
        *[F.struct(F.lit(n).alias("lag_weeks"), F.col(_lag_column(price, n)).alias("price")) for n in present]
    )
    long = df.select(value_col, F.explode(pairs).alias("p")).select(value_col, "p.*").filter(F.col("price").isNotNull())
    rows = long.select("lag_weeks", price_band("price").alias("price_group"), value_col)
    keys = ["lag_weeks", "price_group"]
    out = _mean_median_count(rows, keys, value_col, "avg_value", "median_value", "n_retailer_weeks")
    names = F.create_map(*[F.lit(x) for n in present for x in (n, LAG_LABELS.get(n, f"{n} Weeks Ago (Lag {n}w)"))])
    return out.withColumn("lag", names[F.col("lag_weeks")]).withColumn("band_ix", band_order("price_group"))


def _lag_column(name: str, weeks: int) -> str:
    return name if weeks == 0 else f"{name}_lag{weeks}w"


def segment_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Band summaries of single lags put below each other."""
    return stack(frames)


def vs_baseline(
    df: DataFrame, group: str = "lag", band: str = "price_group", value: str = "avg_value", baseline: str = BASELINE_BAND
) -> DataFrame:
    """Difference and % difference of each row to its group's baseline row.

    A group without that row gives nulls.
    """
    base = df.filter(F.col(band) == baseline).groupBy(group).agg(F.max(value).alias("avg_baseline"))
    joined = left_join_nullsafe(df, base, [group])
    gap = F.col(value) - F.col("avg_baseline")
    return joined.withColumn("difference_from_baseline", gap).withColumn(
        "pct_difference", F.when(F.col("avg_baseline") != 0, gap / F.col("avg_baseline") * 100)
    )


def strongest_lag(df: DataFrame, band: str = TOP_BAND, group: str = "lag") -> DataFrame:
    """Lags ordered by how far the given band lies above the baseline."""
    rows = df.filter(F.col("price_group") == band).select(group, "difference_from_baseline", "pct_difference")
    return rows.orderBy(F.col("difference_from_baseline").desc_nulls_last(), F.col(group))


def price_bucket(price: str, width: int = 2):
    """Nearest multiple of `width`, halves to even; adding 0.0 turns -0.0 into 0.0."""
    return F.bround(F.col(price) / width) * width + F.lit(0.0)


def threshold_curve(
    df: DataFrame, value_col: str = RATE, price: str = "price_vs_market", limit: float = 20, min_rows: int = 10
) -> DataFrame:
    """Mean value per 2 % price bucket within ±limit; thin buckets are left out."""
    rows = df.filter(F.col(price).between(-limit, limit) & F.col(value_col).isNotNull())
    out = rows.groupBy(price_bucket(price).alias("price_bucket")).agg(
        F.avg(value_col).alias("avg_value"), F.count(F.lit(1)).alias("n_observations")
    )
    return out.filter(F.col("n_observations") >= min_rows)


def threshold_by_entity(
    df: DataFrame, entity: str = "retailer", size: str = "cprg_retailer_size", min_rows: int = 3
) -> DataFrame:
    """Price curve of each entity with its size; buckets of fewer rows are left out."""
    rows = df.filter(F.col("price_vs_market").isNotNull() & F.col(RATE).isNotNull() & F.col(size).isNotNull())
    out = rows.groupBy(entity, size, price_bucket("price_vs_market").alias("price_bucket")).agg(
        F.avg(RATE).alias("avg_transfer_rate"), F.count(F.lit(1)).alias("n")
    )
    return out.filter(F.col("n") >= min_rows)


def class_effect(df: DataFrame, kind: str) -> DataFrame:
    """Mean rate and row count per class of contract term, solar or incentive share."""
    column, label = {
        "contract": ("avg_contract_term", contract_class),
        "solar": ("pct_solar_available", solar_class),
        "incentive": ("pct_with_incentive", incentive_class),
    }[kind]
    name = f"{kind}_category"
    rows = df.filter(F.col(column).isNotNull() & F.col(RATE).isNotNull()).select(label(column).alias(name), RATE)
    if kind == "contract":
        return _mean_median_count(rows, [name], RATE, "avg_transfer_rate", "median_transfer_rate", "n_weeks")
    return rows.groupBy(name).agg(F.avg(RATE).alias("avg_transfer_rate"), F.count(F.lit(1)).alias("n_weeks"))


def contract_investigation(df: DataFrame) -> DataFrame:
    """Five measures per finer contract class, on movements rather than rates."""
    key = "contract_category"
    rows = df.withColumn(key, contract_detail_class("avg_contract_term"))
    sums = rows.groupBy(key).agg(
        F.avg("total_transfers_out").alias("avg_transfers"),
        F.avg("price_vs_market").alias("avg_price_vs_market"),
        F.avg(F.col("pct_guaranteed_discount") + F.col("pct_conditional_discount")).alias("avg_discount_pct"),
        F.count(F.lit(1)).alias("n_weeks"),
    )
    medians = exact_median(rows, [key], "total_transfers_out", "median_transfers")
    return left_join_nullsafe(sums, medians, [key])


def fee_points(df: DataFrame) -> DataFrame:
    """Rate against both fees, complete rows only."""
    cols = [RATE, "avg_annual_fee", "avg_late_fee"]
    return df.select("date", "retailer", *cols).dropna(subset=cols)
