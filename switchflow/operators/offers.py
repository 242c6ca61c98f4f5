"""Offers: relevance, latest sighting, validity interval, weekly snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchflow.functions.labels import CONDITIONAL, GUARANTEED, NO_DISCOUNT, contract_years, offer_category
from switchflow.functions.stats import average_rank, weighted_quantiles
from switchflow.operators.joins import active_sums, dense_grid, join_nullsafe, left_join_nullsafe
from switchflow.operators.periods import latest_per_key
from switchflow.session import materialize

PRICE = "total_bill_pre_transaction"

# The metric columns of a snapshot, in output order.
SNAPSHOT_METRICS = (
    "n_offers", "median_price", "min_price", "max_price", "pct_guaranteed_discount",
    "pct_conditional_discount", "pct_no_discount", "avg_contract_term", "pct_solar_available",
    "pct_with_incentive", "avg_annual_fee", "avg_late_fee", "vic_median", "cprg_retailer_size",
    "price_vs_market", "is_above_market", "price_competitiveness_rank",
)


def filter_offers(df: DataFrame, year: int = 2022, offer_type: str = "market offer", cust_type: str = "res") -> DataFrame:
    """Offers sighted from January of `year` on, of one type and customer class.

    The year test is a date range, so it can be pushed into the scan.
    """
    return df.filter(
        (F.col("identifier_date") >= F.make_date(F.lit(year), F.lit(1), F.lit(1)))
        & (F.col("offer_type") == offer_type)
        & (F.col("cust_type") == cust_type)
    )


def offer_end_date(df: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """End of the month of the last sighting; null where that is the data's last date.

    The last date is taken over `of` (default: `df`), so a caller can pass rows that are cheaper to read.
    """
    last = (of if of is not None else df).agg(F.max("identifier_date")).scalar()
    seen = F.col("identifier_date")
    return df.withColumn("end_date", F.when(seen == last, F.lit(None)).otherwise(F.last_day(seen)).cast("date"))


def prepare_offers(df: DataFrame) -> DataFrame:
    """Latest sightings with end date and offer class."""
    latest = latest_per_key(df, "offer_id", "identifier_date")
    dates = {c: F.col(c).cast("date") for c in ("identifier_date", "start_date")}
    # The last date of all sightings is a latest one: a scan finds it, without the join. Texts need not sort as dates do.
    of = df if isinstance(df.schema["identifier_date"].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)) else latest
    dated = offer_end_date(latest.withColumns(dates), of.withColumns(dates))
    return dated.withColumn("offer_category", offer_category("has_discount", "has_disc_conditional"))


def price_cells(
    offers: DataFrame, start: dt.date | str | Column, end: dt.date | str | Column, keys: Sequence[str] = ("retailer",)
) -> DataFrame:
    """Number of active offers per Monday, key and price: what the snapshot's medians and price range need."""
    return active_sums(offers, start, end, [*keys, PRICE]).withColumnRenamed("n", "n_offers")


def offer_sums(
    offers: DataFrame, start: dt.date | str | Column, end: dt.date | str | Column, keys: Sequence[str] = ("retailer",)
) -> DataFrame:
    """Counts and sums of the active offers per Monday, key and retailer size: what the snapshot's other measures need.

    Without the price among the keys these are few rows, summed on the map side.
    """
    kind, incentive = F.col("offer_category"), F.col("has_incentive")

    def share(condition: Column, name: str) -> dict[str, Column]:
        return {f"{name}_yes": condition.cast("int"), f"{name}_n": condition.isNotNull().cast("int")}

    def mean(value: Column, name: str) -> dict[str, Column]:
        return {f"{name}_sum": value, f"{name}_n": value.isNotNull().cast("int")}

    solar = F.coalesce(F.col("solar_offer").isin("Yes", "Optional"), F.lit(False))
    sums = {
        **share(kind == GUARANTEED, "guaranteed"),
        **share(kind == CONDITIONAL, "conditional"),
        **share(kind == NO_DISCOUNT, "no_discount"),
        **mean(contract_years("contract_term"), "term"),
        **share(solar, "solar"),
        **share(incentive == "Yes", "incentive"),
        **mean(F.col("total_annual_fee"), "annual_fee"),
        **mean(F.col("total_late_payment_fee"), "late_fee"),
    }
    # The retailer's size is a key, as a smallest value can't be taken off again.
    return active_sums(offers, start, end, [*keys, "cprg_retailer_size"], sums).withColumnRenamed("n", "n_offers")


def snapshot_metrics(sums: DataFrame, prices: DataFrame, keys: Sequence[str] = ("date", "retailer")) -> DataFrame:
    """Count, price range, class shares, terms and fees per cell, from `offer_sums` and `price_cells`."""
    pct = lambda name: (F.sum(f"{name}_yes") / F.nullif(F.sum(f"{name}_n"), F.lit(0)) * 100)
    mean = lambda name: F.sum(f"{name}_sum") / F.nullif(F.sum(f"{name}_n"), F.lit(0))
    measures = sums.groupBy(*keys).agg(
        F.sum("n_offers").alias("n_offers"),
        pct("guaranteed").alias("pct_guaranteed_discount"),
        pct("conditional").alias("pct_conditional_discount"),
        pct("no_discount").alias("pct_no_discount"),
        mean("term").alias("avg_contract_term"),
        pct("solar").alias("pct_solar_available"),
        pct("incentive").alias("pct_with_incentive"),
        mean("annual_fee").alias("avg_annual_fee"),
        mean("late_fee").alias("avg_late_fee"),
        F.min("cprg_retailer_size").alias("cprg_retailer_size"),
    )
    span = prices.groupBy(*keys).agg(F.min(PRICE).alias("min_price"), F.max(PRICE).alias("max_price"))
    return left_join_nullsafe(measures, span, keys)


def market_median(offers: DataFrame, start: dt.date | str | Column, end: dt.date | str | Column) -> DataFrame:
    """Median price of all active offers per week."""
    return weighted_quantiles(active_sums(offers, start, end, [PRICE]), ["date"], PRICE, "n", {"vic_median": 0.5})


def price_vs_market(df: DataFrame) -> DataFrame:
    """Distance of the median price to the market's in %, and the above-market flag."""
    price, market = F.col("median_price"), F.col("vic_median")
    distance = F.when(market != 0, (price - market) / market * 100)
    return df.withColumn("price_vs_market", distance).withColumn("is_above_market", price > market)


def offer_snapshots(
    offers: DataFrame, start: dt.date | str | Column, end: dt.date | str | Column, dense: bool = True
) -> DataFrame:
    """One row per (Monday, retailer) with the metrics of the offers active that day.

    Sweeps over the offers' first and last Mondays sum them to (Monday, retailer) and
    count them per price, without a row per offer and week; the written counts give the
    price range and both medians, the written sums every other measure. `dense` adds the
    empty cells (`n_offers` = 0) of every retailer.
    """
    cell = ["date", "retailer"]
    prices = materialize(price_cells(offers, start, end), "price-cells")
    sums = materialize(offer_sums(offers, start, end), "offer-sums")
    medians = [
        weighted_quantiles(prices, keys, PRICE, "n_offers", {name: 0.5}, written=True)
        for keys, name in ((cell, "median_price"), (["date"], "vic_median"))
    ]
    cells = left_join_nullsafe(snapshot_metrics(sums, prices, cell), medians[0], cell)
    cells = left_join_nullsafe(cells, medians[1], ["date"])
    # A grid cell of an unknown retailer never matches an offer.
    cells = price_vs_market(cells.filter(F.col("retailer").isNotNull()))
    if dense:
        grid = dense_grid(offers.select("retailer").distinct(), start, end)
        cells = join_nullsafe(grid, cells, cell, "left").fillna(0, subset=["n_offers"])
    # A week holds one row per retailer, so this window's groups are even and bounded.
    ranked = average_rank(cells, ["date"], "median_price", "price_competitiveness_rank")
    return ranked.select(*cell, *SNAPSHOT_METRICS)
