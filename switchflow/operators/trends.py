"""Sums by period: with totals, by entity, by day, and their shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchflow.functions.dates import month_start, year_month
from switchflow.functions.stats import total
from switchflow.operators.joins import join_nullsafe
from switchflow.schema import CUSTOMER_BASE, TRANSFERS, VIEW_COLUMNS

TOTAL = "Total"

# What the report groups by; ids and codes that its names and classes were made from are left out.
SUM_KEYS = tuple(
    c for c in VIEW_COLUMNS if c not in ("id_mts2", "stat_value", "lnsp", "lr", "frmp", "newfrmp", "crcode", "ESC_FRMP", "ESC_NEWFRMP")
)


def measure(df: DataFrame, code: str) -> DataFrame:
    """Rows of one measure code."""
    return df.filter(F.col("stat_shortcut") == code)


def transfers_of(df: DataFrame) -> DataFrame:
    return measure(df, TRANSFERS)


def base_of(df: DataFrame) -> DataFrame:
    return measure(df, CUSTOMER_BASE)


def period_columns(grain: str, date: str = "stat_date") -> list[Column]:
    """Grouping columns of a grain: day, month, quarter or finyear."""
    if grain == "day":
        return [F.col(date)]
    if grain == "month":
        return [month_start(date).alias(date)]
    if grain == "quarter":
        return [F.col("FinYearQuarter")]
    if grain == "finyear":
        return [F.col("FinYear")]
    raise ValueError(f"unknown grain: {grain}")


def period_names(grain: str, date: str = "stat_date") -> list[str]:
    return {
        "day": [date],
        "month": ["YearMonth", date],
        "quarter": ["FinYearQuarter"],
        "finyear": ["FinYear"],
    }[grain]


def sum_by(df: DataFrame, grain: str, by: Sequence[str], value: str = "stat_value", alias: str = "transfers") -> DataFrame:
    """Sum per period and category. Month labels are made after the aggregation."""
    sums = df.groupBy(*period_columns(grain), *by).agg(total(value).alias(alias))
    if grain != "month":
        return sums
    return sums.select(year_month("stat_date").alias("YearMonth"), "stat_date", *by, alias)


def partial_sums(df: DataFrame, *by: str) -> DataFrame:
    """Enriched rows summed to what the report groups by: (by, SUM_KEYS, stat_value, n_rows).

    Every frame of the report is made of sums, so it is the same from these rows as from
    the facts, also when they are sums of several files put together.
    """
    return df.groupBy(*by, *SUM_KEYS).agg(F.sum("stat_value").alias("stat_value"), F.count(F.lit(1)).alias("n_rows"))


def trend(
    df: DataFrame, grain: str, category: str = "FRMP_Retailer_size", value: str = "stat_value", alias: str = "transfers"
) -> DataFrame:
    """Sum per period and category, plus a `Total` series.

    The facts are summed once to (period, category); the totals come from grouping
    sets over that small result, so facts are neither scanned nor expanded twice.
    `is_total` tells the total from a null (or an actual `Total`) category.
    """
    fine = sum_by(transfers_of(df), grain, [category], value, alias)
    return add_totals(fine, period_names(grain), category, alias)


def add_totals(fine: DataFrame, periods: Sequence[str], category: str, alias: str) -> DataFrame:
    keys = [F.col(p) for p in periods]
    sets = fine.groupingSets([[*keys, F.col(category)], keys], *keys, F.col(category))
    out = sets.agg(F.sum(alias).alias(alias), F.grouping(category).alias("_g"))
    return out.select(
        *periods,
        F.when(F.col("_g") == 1, TOTAL).otherwise(F.col(category)).alias(category),
        alias,
        (F.col("_g") == 1).alias("is_total"),
    )


def trend_all_grains(
    df: DataFrame, category: str = "FRMP_Retailer_size", value: str = "stat_value", alias: str = "transfers"
) -> DataFrame:
    """Month, quarter and financial-year trends with totals from one scan.

    A month lies in one quarter and one financial year, so all six groupings are
    grouping sets over the monthly sums. `grain` and `period` name each row's group.
    """
    facts = transfers_of(df)
    monthly = (
        facts.groupBy(month_start("stat_date").alias("month"), "FinYearQuarter", "FinYear", category)
        .agg(total(value).alias(alias))
        .withColumn("month", year_month("month"))
    )
    grains = ["month", "FinYearQuarter", "FinYear"]
    cols = [F.col(c) for c in [*grains, category]]
    sets = [[F.col(g), F.col(category)] for g in grains] + [[F.col(g)] for g in grains]
    out = monthly.groupingSets(sets, *cols).agg(
        F.sum(alias).alias(alias),
        F.grouping(category).alias("_g"),
        *[F.grouping(g).alias(f"_g_{g}") for g in grains],
    )
    name = F.when(F.col("_g_month") == 0, "month").when(F.col("_g_FinYearQuarter") == 0, "quarter").otherwise("finyear")
    return out.select(
        name.alias("grain"),
        F.coalesce("month", "FinYearQuarter", "FinYear").alias("period"),
        F.when(F.col("_g") == 1, TOTAL).otherwise(F.col(category)).alias(category),
        alias,
        (F.col("_g") == 1).alias("is_total"),
    )


def entity_trend(
    df: DataFrame, entity: str, grain: str, value: str = "stat_value", alias: str = "transfers"
) -> DataFrame:
    """Sum per entity and period; rows without an entity are dropped."""
    return sum_by(transfers_of(df).filter(F.col(entity).isNotNull()), grain, [entity], value, alias)


def share_of_total(
    df: DataFrame, grain: str, category: str = "transfer_type", value: str = "stat_value", alias: str = "transfers"
) -> DataFrame:
    """Sum per period and category with the period total and the % share."""
    fine = sum_by(transfers_of(df).filter(F.col(category).isNotNull()), grain, [category], value, alias)
    return with_share(fine, period_names(grain), alias)


def with_share(df: DataFrame, keys: Sequence[str], value: str, total_alias: str = "total", pct_alias: str = "pct") -> DataFrame:
    """Add the group total of `value` and the row's percentage of it.

    The total is an aggregate joined back rather than a window, so the rows of one
    group never have to meet in one task. Without keys it is a scalar subquery.
    """
    if keys:
        sums = df.groupBy(*keys).agg(F.sum(value).alias(total_alias))
        joined = join_nullsafe(df, sums, keys, "left")
    else:
        joined = df.withColumn(total_alias, df.agg(F.sum(value)).scalar())
    whole = F.col(total_alias)
    return joined.withColumn(pct_alias, F.when(whole != 0, F.col(value) / whole * 100))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values in order."""
    return df.filter(F.col(col).isNotNull()).select(col).distinct().orderBy(col)


def coverage(df: DataFrame, date: str = "stat_date") -> DataFrame:
    """Row count (of the facts, also from `partial_sums`), first and last date, label of the latest month: one row."""
    d = F.col(date)
    return df.agg(
        (total("n_rows") if "n_rows" in df.columns else F.count(F.lit(1))).alias("total_records"),
        F.min(d).alias("first_date"),
        F.max(d).alias("last_date"),
        F.date_format(F.max(d), "MMMM yyyy").alias("latest_month"),
    )
