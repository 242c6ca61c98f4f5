"""Query registry: a Spark callable per name and, where SQL can say it, the oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.views import FX_OFFERS, FX_RAW, FX_TRANSFERS, spark_view
from switchflow.functions.dates import year_month
from switchflow.sources.frames import with_calendar

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Study window over the test tables.
START, END, YEAR = "1995-01-02", "2001-12-31", 1995


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its oracle SQL if there is one."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to six places, so summation order cannot show in a comparison."""
    return df.selectExpr(*[f"round(`{n}`, {digits}) AS `{n}`" if t == "double" else f"`{n}`" for n, t in df.dtypes])


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched movements with calendar labels."""
    return with_calendar(spark_view(spark, sf_dir, FX_TRANSFERS))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfers(spark, sf_dir).withColumn("YearMonth", year_month("stat_date"))


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(spark, sf_dir, FX_OFFERS)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(spark, sf_dir, FX_RAW)


# --- SQL building blocks -------------------------------------------------------

_Y0 = "(year(stat_date) - CASE WHEN month(stat_date) < 7 THEN 1 ELSE 0 END)"
FIN_YEAR = f"CAST({_Y0} AS VARCHAR) || '-' || lpad(CAST(({_Y0} + 1) % 100 AS VARCHAR), 2, '0')"
FIN_QUARTER = (
    f"{FIN_YEAR} || ' Q' || CASE WHEN month(stat_date) IN (7,8,9) THEN '1' WHEN month(stat_date) IN (10,11,12) THEN '2' "
    "WHEN month(stat_date) IN (1,2,3) THEN '3' ELSE '4' END"
)

T = (
    f"WITH t0 AS ({FX_TRANSFERS}), t AS (SELECT *, strftime(stat_date, '%Y-%m') AS YearMonth, "
    f"CAST(date_trunc('month', stat_date) AS DATE) AS month_start, "
    f"{FIN_YEAR} AS FinYear, {FIN_QUARTER} AS FinYearQuarter FROM t0), m AS (SELECT * FROM t WHERE stat_shortcut = 'M57A')"
)

EDGES = (
    T
    + """, edges AS (
 SELECT FRMP_Retailer_name, NEWFRMP_Retailer_name, FRMP_Retailer_size, NEWFRMP_Retailer_size, CAST(sum(stat_value) AS BIGINT) AS transfers
 FROM m WHERE stat_date = (SELECT max(stat_date) FROM m) AND FRMP_Retailer_name IS NOT NULL AND NEWFRMP_Retailer_name IS NOT NULL
 GROUP BY ALL)"""
)

OFFERS = f"""WITH o0 AS ({FX_OFFERS}),
latest AS (SELECT * EXCLUDE (mx) FROM (SELECT *, max(identifier_date) OVER (PARTITION BY offer_id) AS mx FROM o0) WHERE identifier_date = mx),
offers AS (SELECT *,
 CASE WHEN identifier_date = (SELECT max(identifier_date) FROM latest) THEN NULL ELSE last_day(identifier_date) END AS end_date,
 CASE WHEN has_discount = 1 AND has_disc_conditional = 1 THEN 'Market offers with' || chr(10) || 'conditional discounts'
  WHEN has_discount = 1 AND has_disc_conditional = 0 THEN 'Market offers with' || chr(10) || 'guaranteed discounts'
  WHEN has_discount = 0 AND has_disc_conditional = 0 THEN 'Market offers without' || chr(10) || 'discounts' ELSE 'Other' END AS offer_category
 FROM latest),
weeks AS (SELECT CAST(d AS DATE) AS date FROM generate_series(DATE '{START}', DATE '{END}', INTERVAL 7 DAY) g(d)),
active AS (SELECT w.date, o.* FROM weeks w JOIN offers o ON o.start_date <= w.date AND (o.end_date IS NULL OR o.end_date >= w.date))"""

SNAPSHOTS = (
    OFFERS
    + """,
cells0 AS (SELECT date, retailer, count(*) AS n_offers,
 median(total_bill_pre_transaction) AS median_price, min(total_bill_pre_transaction) AS min_price, max(total_bill_pre_transaction) AS max_price,
 avg(CASE WHEN has_discount = 1 AND has_disc_conditional = 0 THEN 1.0 ELSE 0.0 END) * 100 AS pct_guaranteed_discount,
 avg(CASE WHEN has_discount = 1 AND has_disc_conditional = 1 THEN 1.0 ELSE 0.0 END) * 100 AS pct_conditional_discount,
 avg(CASE WHEN has_discount = 0 AND has_disc_conditional = 0 THEN 1.0 ELSE 0.0 END) * 100 AS pct_no_discount,
 avg(CASE contract_term WHEN '1 year' THEN 1.0 WHEN '2 year' THEN 2.0 ELSE 0.0 END) AS avg_contract_term,
 avg(CASE WHEN solar_offer IN ('Yes', 'Optional') THEN 1.0 ELSE 0.0 END) * 100 AS pct_solar_available,
 avg(CASE WHEN has_incentive = 'Yes' THEN 1.0 WHEN has_incentive IS NOT NULL THEN 0.0 END) * 100 AS pct_with_incentive,
 avg(total_annual_fee) AS avg_annual_fee, avg(total_late_payment_fee) AS avg_late_fee, min(cprg_retailer_size) AS cprg_retailer_size
 FROM active GROUP BY date, retailer),
market AS (SELECT date, median(total_bill_pre_transaction) AS vic_median FROM active GROUP BY date),
cells AS (SELECT g.date, g.retailer, coalesce(c.n_offers, 0) AS n_offers, c.* EXCLUDE (date, retailer, n_offers),
  CASE WHEN c.n_offers IS NOT NULL THEN k.vic_median END AS vic_median
 FROM (SELECT date, retailer FROM weeks CROSS JOIN (SELECT DISTINCT retailer FROM offers) r) g
 LEFT JOIN cells0 c ON g.date = c.date AND g.retailer = c.retailer LEFT JOIN market k ON g.date = k.date),
snap AS (SELECT *, (median_price - vic_median) / vic_median * 100 AS price_vs_market, median_price > vic_median AS is_above_market,
 CASE WHEN median_price IS NOT NULL THEN rank() OVER (PARTITION BY date ORDER BY median_price NULLS LAST)
  + (count(*) OVER (PARTITION BY date, median_price) - 1) / 2.0 END AS price_competitiveness_rank FROM cells)"""
)

_WEEKLY = f"""
daily AS (SELECT stat_date AS transfer_date, Year, Month, stat_value AS transfers_count, FRMP_Retailer_name AS from_retailer,
 NEWFRMP_Retailer_name AS to_retailer, crcode AS reason_code FROM m WHERE Year >= {YEAR} AND crcode IN ('1000','1010','1020','1030','1040')),
base AS (SELECT Year, Month, FRMP_Retailer_name AS retailer, CAST(sum(stat_value) AS BIGINT) AS customer_count
 FROM t WHERE stat_shortcut = 'M71' AND year(stat_date) >= {YEAR} GROUP BY ALL),
weekly AS (SELECT CAST(date_trunc('week', transfer_date) AS DATE) AS date, Year, Month, from_retailer AS retailer,
 CAST(sum(transfers_count) AS BIGINT) AS total_transfers_out, avg(transfers_count) AS avg_daily_transfers FROM daily GROUP BY ALL),
rates AS (SELECT w.*, b.customer_count,
 CASE WHEN b.customer_count > 0 THEN w.total_transfers_out / b.customer_count * 100 END AS transfer_rate,
 CASE WHEN b.customer_count > 0 THEN w.avg_daily_transfers / b.customer_count * 100 END AS avg_daily_transfer_rate
 FROM weekly w LEFT JOIN base b ON w.Year = b.Year AND w.Month = b.Month AND w.retailer IS NOT DISTINCT FROM b.retailer)"""

WEEKLY = T + "," + _WEEKLY

METRICS = (
    "n_offers", "median_price", "min_price", "max_price", "pct_guaranteed_discount", "pct_conditional_discount",
    "pct_no_discount", "avg_contract_term", "pct_solar_available", "pct_with_incentive", "avg_annual_fee", "avg_late_fee",
    "vic_median", "cprg_retailer_size", "price_vs_market", "is_above_market", "price_competitiveness_rank",
)
LAGS = (1, 2, 4, 8)

_LAG_JOINS = " ".join(
    f"LEFT JOIN snap s{n} ON r.date = s{n}.date + {7 * n} AND r.retailer IS NOT DISTINCT FROM s{n}.retailer" for n in (0, *LAGS)
)
_LAG_COLUMNS = ", ".join(
    [f"s0.{c}" for c in METRICS] + [f"s{n}.{c} AS {c}_lag{n}w" for n in LAGS for c in METRICS]
)

# Both preludes start with WITH; the second one continues the first.
STUDY = (
    SNAPSHOTS
    + ", "
    + T.removeprefix("WITH ")
    + ","
    + _WEEKLY
    + f""",
kept AS (SELECT * FROM rates WHERE coalesce(retailer, '?') IN (SELECT coalesce(retailer, '?') FROM rates GROUP BY retailer HAVING count(*) >= 100)
 AND customer_count IS NOT NULL),
data AS (SELECT r.*, {_LAG_COLUMNS} FROM kept r {_LAG_JOINS})"""
)


def sql_rounded(prelude: str, source: str, columns: dict[str, str] | list[str], doubles: set[str] | frozenset[str]) -> str:
    """SELECT with the double columns rounded to six places."""
    names = list(columns)
    parts = [f"round({c}, 6) AS {c}" if c in doubles else c for c in names]
    return f"{prelude} SELECT {', '.join(parts)} FROM {source}"
