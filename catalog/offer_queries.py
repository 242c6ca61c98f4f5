"""Offers, weekly snapshots, rates, lags, bands and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import linear_sql
from catalog.registry import (
    END,
    METRICS,
    OFFERS,
    SNAPSHOTS,
    START,
    STUDY,
    WEEKLY,
    YEAR,
    offers,
    query,
    sql_rounded,
    transfers,
)
from switchflow.functions.labels import LAG_LABELS
from switchflow.functions.stats import average_rank_large
from switchflow.operators import bands, describe, joins, models, reshape, study
from switchflow.operators import offers as offer_ops
from switchflow.operators import periods
from switchflow.plans.offer_study import study_dataset
from switchflow.session import materialize

DOUBLES = frozenset(METRICS) - {"n_offers", "cprg_retailer_size", "is_above_market"}


def prepared(spark, d):
    return offer_ops.prepare_offers(offers(spark, d))


def held_offers(spark, d):
    """Prepared offers, written once: a snapshot reads them for each of its measures."""
    return materialize(prepared(spark, d), "offers")


def snapshots(spark, d):
    return offer_ops.offer_snapshots(held_offers(spark, d), START, END)


def rates(spark, d):
    facts = transfers(spark, d)
    return study.transfer_rates(study.weekly_transfers(study.daily_transfers(facts, YEAR)), study.customer_base(facts, YEAR))


def data(spark, d):
    return study_dataset(transfers(spark, d), held_offers(spark, d), START, END, YEAR)


def saved(spark, d):
    """The master frame, written once: exact medians read their input twice."""
    return materialize(data(spark, d), "study")


# --- offers ------------------------------------------------------------------------

_OFFER_COLS = "offer_id, retailer, identifier_date, start_date, total_bill_pre_transaction"


@query(
    "relevant_offers",
    f"{OFFERS} SELECT {_OFFER_COLS} FROM o0 WHERE year(identifier_date) >= 1997 AND offer_type = 'market offer' AND cust_type = 'res'",
)
def relevant_offers(spark, d):
    return offer_ops.filter_offers(offers(spark, d), year=1997).select(*_OFFER_COLS.split(", "))


@query("latest_offers", f"{OFFERS} SELECT {_OFFER_COLS} FROM latest")
def latest_offers(spark, d):
    return periods.latest_per_key(offers(spark, d), "offer_id", "identifier_date").select(*_OFFER_COLS.split(", "))


@query("offer_end_dates", f"{OFFERS} SELECT offer_id, identifier_date, CAST(end_date AS DATE) AS end_date, 'electricity' AS Fuel FROM offers")
def offer_end_dates(spark, d):
    return reshape.with_constant(prepared(spark, d), "Fuel", "electricity").select("offer_id", "identifier_date", "end_date", "Fuel")


@query("offer_categories", f"{OFFERS} SELECT offer_category, has_discount, has_disc_conditional, count(*) AS n FROM offers GROUP BY ALL")
def offer_categories(spark, d):
    keys = ["offer_category", "has_discount", "has_disc_conditional"]
    return prepared(spark, d).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query("active_offers", f"{OFFERS} SELECT date, retailer, count(*) AS n, CAST(sum(offer_id) AS BIGINT) AS ids FROM active GROUP BY ALL")
def active_offers(spark, d):
    """Number of active offers and sum of their ids, without a row per offer and week."""
    active = joins.active_sums(prepared(spark, d), START, END, ["retailer"], {"ids": F.col("offer_id")})
    return active.select("date", "retailer", "n", F.col("ids").cast("long").alias("ids"))


@query("active_offer_rows", f"{OFFERS} SELECT date, count(DISTINCT offer_id) AS offers, count(*) AS n FROM active GROUP BY ALL")
def active_offer_rows(spark, d):
    """One row per offer and Monday, for measures that can't be summed."""
    active = joins.active_on(prepared(spark, d), START, END)
    return active.groupBy("date").agg(F.countDistinct("offer_id").alias("offers"), F.count(F.lit(1)).alias("n"))


@query("dense_grid", f"{OFFERS} SELECT date, retailer FROM weeks CROSS JOIN (SELECT DISTINCT retailer FROM offers) r")
def dense_grid(spark, d):
    return joins.dense_grid(prepared(spark, d).select("retailer").distinct(), START, END)


@query("market_median", f"{OFFERS} SELECT date, round(median(total_bill_pre_transaction), 6) AS vic_median FROM active GROUP BY date")
def market_median(spark, d):
    return offer_ops.market_median(prepared(spark, d), START, END)


@query("offer_snapshots", sql_rounded(SNAPSHOTS, "snap", ["date", "retailer", *METRICS], DOUBLES))
def offer_snapshots(spark, d):
    return snapshots(spark, d)


@query(
    "price_rank",
    f"""{OFFERS}, p AS (SELECT retailer, total_late_payment_fee FROM offers)
SELECT retailer, total_late_payment_fee, fee_rank, count(*) AS n FROM (SELECT *,
 CASE WHEN total_late_payment_fee IS NOT NULL THEN rank() OVER (PARTITION BY retailer ORDER BY total_late_payment_fee NULLS LAST)
  + (count(*) OVER (PARTITION BY retailer, total_late_payment_fee) - 1) / 2.0 END AS fee_rank FROM p) GROUP BY ALL""",
)
def price_rank(spark, d):
    """Tie-averaged ranks where ties are the rule."""
    rows = prepared(spark, d).select("retailer", "total_late_payment_fee")
    ranked = average_rank_large(rows, ["retailer"], "total_late_payment_fee", "fee_rank")
    return ranked.groupBy(*ranked.columns).agg(F.count(F.lit(1)).alias("n"))


# --- weekly movements ---------------------------------------------------------------

@query("daily_transfers", f"{WEEKLY} SELECT * REPLACE (CAST(transfers_count AS INT) AS transfers_count) FROM daily")
def daily_transfers(spark, d):
    return study.daily_transfers(transfers(spark, d), YEAR)


@query("customer_base", f"{WEEKLY} SELECT * FROM base")
def customer_base(spark, d):
    return study.customer_base(transfers(spark, d), YEAR)


@query(
    "weekly_transfers",
    f"{WEEKLY} SELECT date, Year, Month, retailer, total_transfers_out, round(avg_daily_transfers, 6) AS avg_daily_transfers FROM weekly",
)
def weekly_transfers(spark, d):
    return study.weekly_transfers(study.daily_transfers(transfers(spark, d), YEAR))


_RATE_COLS = [
    "date", "Year", "Month", "retailer", "total_transfers_out", "avg_daily_transfers", "customer_count", "transfer_rate",
    "avg_daily_transfer_rate",
]
_RATE_DOUBLES = {"avg_daily_transfers", "transfer_rate", "avg_daily_transfer_rate"}


@query("transfer_rates", sql_rounded(WEEKLY, "rates", _RATE_COLS, _RATE_DOUBLES))
def transfer_rates(spark, d):
    return rates(spark, d)


_WIDE = [*_RATE_COLS, *METRICS, *[f"{c}_lag{n}w" for n in (1, 2, 4, 8) for c in METRICS]]
_WIDE_DOUBLES = {c for c in _WIDE if c.split("_lag")[0] in DOUBLES} | _RATE_DOUBLES


@query("analysis_dataset", sql_rounded(STUDY, "data", _WIDE, _WIDE_DOUBLES))
def analysis_dataset(spark, d):
    return data(spark, d)


_FAN_COLS = "date, Year, Month, retailer, round(transfer_rate, 6) AS transfer_rate, round(price_vs_market, 6) AS price_vs_market, round(price_vs_market_lag8w, 6) AS price_vs_market_lag8w"
_FAN_SQL = (
    STUDY
    + ", "
    + ", ".join(
        f"c{n} AS (SELECT r.date, r.retailer, s.price_vs_market AS p FROM rates r LEFT JOIN snap s ON r.date = s.date + {7 * n} AND r.retailer IS NOT DISTINCT FROM s.retailer)"
        for n in (0, 1, 2, 4, 8)
    )
    + """, fan AS (SELECT r.*, s.price_vs_market, c8.p AS price_vs_market_lag8w FROM rates r
 LEFT JOIN snap s ON r.date = s.date AND r.retailer IS NOT DISTINCT FROM s.retailer
 LEFT JOIN c1 ON r.date = c1.date AND r.retailer IS NOT DISTINCT FROM c1.retailer
 LEFT JOIN c2 ON r.date = c2.date AND r.retailer IS NOT DISTINCT FROM c2.retailer
 LEFT JOIN c4 ON r.date = c4.date AND r.retailer IS NOT DISTINCT FROM c4.retailer
 LEFT JOIN c8 ON r.date = c8.date AND r.retailer IS NOT DISTINCT FROM c8.retailer)"""
    + f""" SELECT {_FAN_COLS} FROM fan WHERE customer_count IS NOT NULL
 AND coalesce(retailer, '?') IN (SELECT coalesce(retailer, '?') FROM fan GROUP BY retailer HAVING count(*) >= 100)"""
)


@query("analysis_fanout", _FAN_SQL)
def analysis_fanout(spark, d):
    frame = study_dataset(transfers(spark, d), held_offers(spark, d), START, END, YEAR, faithful_fanout=True)
    return frame.select("date", "Year", "Month", "retailer", "transfer_rate", "price_vs_market", "price_vs_market_lag8w")


# --- bands and curves ----------------------------------------------------------------

def _band(col: str) -> str:
    return (
        f"CASE WHEN {col} > 10 THEN 'Much higher (>10%)' WHEN {col} > 5 THEN 'Moderately higher (5-10%)' WHEN {col} > -5 THEN 'Near average (±5%)' "
        f"WHEN {col} > -10 THEN 'Moderately lower (5-10%)' ELSE 'Much lower (<-10%)' END"
    )


_IX = (
    "CAST(CASE price_group WHEN 'Much lower (<-10%)' THEN 1 WHEN 'Moderately lower (5-10%)' THEN 2 WHEN 'Near average (±5%)' THEN 3 "
    "WHEN 'Moderately higher (5-10%)' THEN 4 ELSE 5 END AS INT) AS band_ix"
)


def _segment(col: str, value: str) -> str:
    return (
        f"SELECT {_band(col)} AS price_group, avg({value}) AS avg_value, median({value}) AS median_value, count(*) AS n_retailer_weeks "
        f"FROM data WHERE {col} IS NOT NULL GROUP BY 1"
    )


_SEG_OUT = f"price_group, round(avg_value, 6) AS avg_value, round(median_value, 6) AS median_value, n_retailer_weeks, {_IX}"


@query("segment_by_band", f"{STUDY} SELECT {_SEG_OUT} FROM ({_segment('price_vs_market', 'transfer_rate')})")
def segment_by_band(spark, d):
    return bands.segment_by_band(saved(spark, d), "price_vs_market")


@query(
    "segment_by_band_absolute",
    f"{STUDY} SELECT {_SEG_OUT}, '4 Weeks Ago (Lag 4w)' AS lag FROM ({_segment('price_vs_market_lag4w', 'total_transfers_out')})",
)
def segment_by_band_absolute(spark, d):
    return bands.segment_by_band(saved(spark, d), "price_vs_market_lag4w", "total_transfers_out", LAG_LABELS[4])


def _lag_col(n: int) -> str:
    return "price_vs_market" if n == 0 else f"price_vs_market_lag{n}w"


_SEGMENTS = STUDY + ", seg AS (" + " UNION ALL ".join(
    f"SELECT CAST({n} AS INT) AS lag_weeks, '{LAG_LABELS[n]}' AS lag, * FROM ({_segment(_lag_col(n), 'transfer_rate')})" for n in (0, 2, 4, 8)
) + ")"


@query("segment_all_lags", f"{_SEGMENTS} SELECT lag_weeks, lag, {_SEG_OUT} FROM seg")
def segment_all_lags(spark, d):
    return bands.segment_all_lags(saved(spark, d))


@query("segment_stacked", f"{_SEGMENTS} SELECT lag, {_SEG_OUT} FROM seg WHERE lag_weeks <= 2")
def segment_stacked(spark, d):
    """Single-lag summaries put below each other by column name."""
    frame = saved(spark, d)
    return bands.segment_union([bands.segment_by_band(frame, _lag_col(n), lag_label=LAG_LABELS[n]) for n in (0, 2)])


_DIFF = (
    _SEGMENTS
    + """, diff AS (SELECT lag, price_group, avg_value, b.avg_baseline, avg_value - b.avg_baseline AS difference_from_baseline,
 (avg_value - b.avg_baseline) / b.avg_baseline * 100 AS pct_difference FROM seg LEFT JOIN
 (SELECT lag, avg_value AS avg_baseline FROM seg WHERE price_group = 'Near average (±5%)') b USING (lag))"""
)


@query(
    "vs_baseline",
    f"""{_DIFF} SELECT lag, price_group, round(avg_value, 6) AS avg_value, round(avg_baseline, 6) AS avg_baseline,
 round(difference_from_baseline, 6) AS difference_from_baseline, round(pct_difference, 6) AS pct_difference FROM diff""",
)
def vs_baseline(spark, d):
    out = bands.vs_baseline(bands.segment_all_lags(saved(spark, d)))
    return out.select("lag", "price_group", "avg_value", "avg_baseline", "difference_from_baseline", "pct_difference")


@query(
    "strongest_lag",
    f"""{_DIFF} SELECT lag, round(difference_from_baseline, 6) AS difference_from_baseline, round(pct_difference, 6) AS pct_difference
FROM diff WHERE price_group = 'Much higher (>10%)' ORDER BY 2 DESC""",
)
def strongest_lag(spark, d):
    return bands.strongest_lag(bands.vs_baseline(bands.segment_all_lags(saved(spark, d))))


def _threshold(value: str) -> str:
    return f"""{STUDY} SELECT round_even(price_vs_market / 2, 0) * 2 + 0.0 AS price_bucket, round(avg({value}), 6) AS avg_value, count(*) AS n_observations
FROM data WHERE price_vs_market BETWEEN -20 AND 20 AND {value} IS NOT NULL GROUP BY 1 HAVING count(*) >= 10"""


@query("threshold_curve", _threshold("transfer_rate"))
def threshold_curve(spark, d):
    return bands.threshold_curve(data(spark, d))


@query("threshold_curve_absolute", _threshold("total_transfers_out"))
def threshold_curve_absolute(spark, d):
    return bands.threshold_curve(data(spark, d), "total_transfers_out")


@query(
    "threshold_by_entity",
    f"""{STUDY} SELECT retailer, cprg_retailer_size, round_even(price_vs_market / 2, 0) * 2 + 0.0 AS price_bucket, round(avg(transfer_rate), 6) AS avg_transfer_rate, count(*) AS n
FROM data WHERE price_vs_market IS NOT NULL AND transfer_rate IS NOT NULL AND cprg_retailer_size IS NOT NULL GROUP BY ALL HAVING count(*) >= 3""",
)
def threshold_by_entity(spark, d):
    return bands.threshold_by_entity(data(spark, d))


@query(
    "contract_effect",
    f"""{STUDY} SELECT CASE WHEN avg_contract_term = 0 THEN 'No fixed term' WHEN avg_contract_term < 0.75 THEN 'Short-term / flexible'
 WHEN avg_contract_term <= 1.25 THEN '1-year typical' ELSE 'Longer term (1.5–2 yrs)' END AS contract_category,
 round(avg(transfer_rate), 6) AS avg_transfer_rate, round(median(transfer_rate), 6) AS median_transfer_rate, count(*) AS n_weeks
FROM data WHERE avg_contract_term IS NOT NULL AND transfer_rate IS NOT NULL GROUP BY 1""",
)
def contract_effect(spark, d):
    return bands.class_effect(saved(spark, d), "contract")


def _class_sql(name: str, col: str, low: str, mid: str, high: str) -> str:
    return f"""{STUDY} SELECT CASE WHEN {col} < 10 THEN '{low}' WHEN {col} < 50 THEN '{mid}' ELSE '{high}' END AS {name},
 round(avg(transfer_rate), 6) AS avg_transfer_rate, count(*) AS n_weeks FROM data WHERE {col} IS NOT NULL AND transfer_rate IS NOT NULL GROUP BY 1"""


@query("solar_effect", _class_sql("solar_category", "pct_solar_available", "No solar options", "Some solar options", "Mostly solar-friendly offers"))
def solar_effect(spark, d):
    return bands.class_effect(data(spark, d), "solar")


@query("incentive_effect", _class_sql("incentive_category", "pct_with_incentive", "No incentives", "Some incentives", "Most offers include incentives"))
def incentive_effect(spark, d):
    return bands.class_effect(data(spark, d), "incentive")


_MODEL = (
    STUDY
    + """, model AS (SELECT *, ln(customer_count) AS log_customer_size FROM data WHERE price_vs_market IS NOT NULL AND avg_contract_term IS NOT NULL
 AND pct_solar_available IS NOT NULL AND pct_with_incentive IS NOT NULL AND pct_guaranteed_discount IS NOT NULL AND avg_annual_fee IS NOT NULL
 AND avg_late_fee IS NOT NULL AND customer_count IS NOT NULL)"""
)


@query(
    "contract_investigation",
    f"""{_MODEL} SELECT CASE WHEN avg_contract_term < 0.1 THEN 'No fixed term (0)' WHEN avg_contract_term < 0.5 THEN 'Mostly flexible (<0.5)'
 WHEN avg_contract_term < 1.5 THEN 'Mostly 1-year (0.5-1.5)' ELSE 'Long term (>1.5)' END AS contract_category,
 round(avg(total_transfers_out), 6) AS avg_transfers, round(median(total_transfers_out), 6) AS median_transfers,
 round(avg(price_vs_market), 6) AS avg_price_vs_market, round(avg(pct_guaranteed_discount + pct_conditional_discount), 6) AS avg_discount_pct,
 count(*) AS n_weeks FROM model GROUP BY 1""",
)
def contract_investigation(spark, d):
    return bands.contract_investigation(fitted_frame(spark, d))


@query(
    "fee_points",
    f"""{STUDY} SELECT date, retailer, round(transfer_rate, 6) AS transfer_rate, round(avg_annual_fee, 6) AS avg_annual_fee, round(avg_late_fee, 6) AS avg_late_fee
FROM data WHERE transfer_rate IS NOT NULL AND avg_annual_fee IS NOT NULL AND avg_late_fee IS NOT NULL""",
)
def fee_points(spark, d):
    return bands.fee_points(data(spark, d))


@query(
    "complete_cases",
    f"{STUDY} SELECT retailer, count(*) AS n FROM data WHERE price_vs_market IS NOT NULL AND price_vs_market_lag8w IS NOT NULL GROUP BY 1",
)
def complete_cases(spark, d):
    rows = models.complete_cases(data(spark, d), ["price_vs_market", "price_vs_market_lag8w"])
    return rows.groupBy("retailer").agg(F.count(F.lit(1)).alias("n"))


_DESCRIBED = ["transfer_rate", "price_vs_market", "avg_contract_term", "n_offers"]


@query(
    "describe_columns",
    f"{STUDY} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, round(CAST(min({c}) AS DOUBLE), 6) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q1, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median, "
        f"round(avg({c}), 6) AS mean, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q3, round(CAST(max({c}) AS DOUBLE), 6) AS max, count(*) - count({c}) AS n_null FROM data"
        for c in _DESCRIBED
    ),
)
def describe_columns(spark, d):
    return describe.describe_columns(saved(spark, d), _DESCRIBED)


# --- models -----------------------------------------------------------------------------

_MODEL_COLS = ["date", "retailer", "customer_count", "total_transfers_out", *models.PREDICTORS]


@query(
    "model_frame",
    sql_rounded(_MODEL, "(SELECT * REPLACE (CAST(total_transfers_out AS DOUBLE) AS total_transfers_out) FROM model)", _MODEL_COLS, set(models.PREDICTORS)),
)
def model_frame(spark, d):
    return models.model_frame(data(spark, d))


def fitted_frame(spark, d):
    """The model frame, written once: fits read it many times."""
    return materialize(models.model_frame(data(spark, d)), "model")


@query(
    "regression_simple",
    f"""{_MODEL} SELECT 'log_customer_size' AS variable, round(regr_slope(total_transfers_out, log_customer_size), 6) AS coefficient,
 round(regr_r2(total_transfers_out, log_customer_size), 6) AS r_squared, count(*) AS n FROM model""",
)
def regression_simple(spark, d):
    fit = models.ols(fitted_frame(spark, d), terms=["log_customer_size"])
    table = models.ols_table(spark, fit).select("variable", "coefficient")
    return table.withColumns({"r_squared": F.lit(float(fit.r2)), "n": F.lit(fit.n).cast("long")})


# Two predictors have a closed form: centred cross products and a 2 × 2 inverse.
_TWO = (
    _MODEL
    + """, s AS (SELECT count(*) AS n, regr_sxx(total_transfers_out, price_vs_market) AS s11, regr_sxx(total_transfers_out, log_customer_size) AS s22,
 regr_sxy(price_vs_market, log_customer_size) AS s12, regr_sxy(total_transfers_out, price_vs_market) AS s1y, regr_sxy(total_transfers_out, log_customer_size) AS s2y,
 regr_syy(total_transfers_out, price_vs_market) AS syy FROM model),
b AS (SELECT *, s11 * s22 - s12 * s12 AS det, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM s),
v AS (SELECT *, syy - b1 * s1y - b2 * s2y AS rss, (syy - b1 * s1y - b2 * s2y) / (n - 3) AS s2 FROM b)"""
)
_PAIR = ["price_vs_market", "log_customer_size"]


@query(
    "regression_pair",
    f"""{_TWO} SELECT 'price_vs_market' AS variable, round(b1, 6) AS coefficient, round(sqrt(s2 * s22 / det), 6) AS std_error, round(b1 / sqrt(s2 * s22 / det), 6) AS t_value FROM v
UNION ALL SELECT 'log_customer_size', round(b2, 6), round(sqrt(s2 * s11 / det), 6), round(b2 / sqrt(s2 * s11 / det), 6) FROM v""",
)
def regression_pair(spark, d):
    table = models.ols_table(spark, models.ols(fitted_frame(spark, d), terms=_PAIR))
    return table.select("variable", "coefficient", "std_error", "t_value")


@query(
    "fit_quality_pair",
    f"{_TWO} SELECT round(1 - rss / syy, 6) AS r_squared, round(1 - (rss / (n - 3)) / (syy / (n - 1)), 6) AS adj_r_squared, n FROM v",
)
def fit_quality_pair(spark, d):
    return models.fit_quality(spark, models.ols(fitted_frame(spark, d), terms=_PAIR))


@query(
    "vif_pair",
    f"""{_MODEL}, c AS (SELECT 1 / (1 - power(corr(price_vs_market, log_customer_size), 2)) AS f FROM model)
SELECT variable, round(f, 6) AS vif, f > 5 AS moderate, f > 10 AS high FROM c, (VALUES ('price_vs_market'), ('log_customer_size')) t(variable)""",
)
def vif_pair(spark, d):
    return models.vif(spark, fitted_frame(spark, d), _PAIR)


@query(
    "compare_nested_pair",
    f"""{_TWO}, w AS (SELECT *, syy - s1y * s1y / s11 AS rss1 FROM v)
SELECT n - 2 AS residual_df_1, n - 3 AS residual_df_2, round(rss1, 4) AS rss_1, round(rss, 4) AS rss_2, CAST(1 AS BIGINT) AS df,
 round((rss1 - rss) / (rss / (n - 3)), 6) AS f_value FROM w""",
)
def compare_nested_pair(spark, d):
    frame = fitted_frame(spark, d)
    out = models.compare_nested(spark, *models.nested(frame, _PAIR[:1], _PAIR))
    return out.withColumns({c: F.round(c, 4) for c in ("rss_1", "rss_2")}).drop("p_value")


@query(
    "r2_of_formula",
    f"""{_MODEL} SELECT round(1 - sum(power(total_transfers_out - 5 * log_customer_size, 2)) / (var_pop(total_transfers_out) * count(*)), 6) AS r_squared FROM model""",
)
def r2_of_formula(spark, d):
    frame = models.model_frame(data(spark, d))
    return models.r2_of(frame.select(F.col("total_transfers_out").alias("label"), (5 * F.col("log_customer_size")).alias("prediction")))


def as_digits(df, *columns):
    """Doubles as text with six significant digits, so that ways of summing do not show."""
    return df.withColumns({c: F.format_string("%.5e", c) for c in columns})


def coefficients(spark, d, terms):
    table = models.ols_table(spark, models.ols(fitted_frame(spark, d), terms=terms))
    return as_digits(table, "coefficient", "std_error", "t_value")


@query("regression_table", linear_sql.table_sql(_MODEL, models.PREDICTORS))
def regression_table(spark, d):
    return coefficients(spark, d, models.PREDICTORS)


@query("regression_table_9", linear_sql.table_sql(_MODEL, models.PREDICTORS_9))
def regression_table_9(spark, d):
    return coefficients(spark, d, models.PREDICTORS_9)


@query("regression_top_significant", linear_sql.table_sql(_MODEL, models.PREDICTORS, only="WHERE p_value < 0.05 ORDER BY abs(t_value) DESC LIMIT 3"))
def regression_top_significant(spark, d):
    """The three most significant variables: with equal degrees of freedom those of the greatest t."""
    table = models.ols_table(spark, models.ols(fitted_frame(spark, d)))
    return as_digits(models.top_significant(table, 3), "coefficient", "std_error", "t_value")


@query("vif", linear_sql.vif_sql(_MODEL, models.PREDICTORS))
def vif(spark, d):
    return as_digits(models.vif(spark, fitted_frame(spark, d)), "vif")


@query("polynomial_table", linear_sql.table_sql(_MODEL, models.POLYNOMIAL))
def polynomial_table(spark, d):
    return coefficients(spark, d, models.POLYNOMIAL)


@query("interaction_table", linear_sql.table_sql(_MODEL, models.INTERACTIONS))
def interaction_table(spark, d):
    return coefficients(spark, d, models.INTERACTIONS)


@query("interaction_table_9", linear_sql.table_sql(_MODEL, models.INTERACTIONS_9))
def interaction_table_9(spark, d):
    """The older interaction model, without customer size."""
    return coefficients(spark, d, models.INTERACTIONS_9)


@query("compare_nested", linear_sql.nested_sql(_MODEL, models.PREDICTORS_9, models.POLYNOMIAL_9))
def compare_nested(spark, d):
    frame = fitted_frame(spark, d)
    return as_digits(models.compare_nested(spark, *models.nested(frame, models.PREDICTORS_9, models.POLYNOMIAL_9)), "rss_1", "rss_2", "f_value").drop("p_value")


@query(
    "linear_models",
    linear_sql.models_sql(_MODEL, {"linear": models.PREDICTORS, "linear_9": models.PREDICTORS_9, "polynomial": models.POLYNOMIAL, "polynomial_9": models.POLYNOMIAL_9,
                                   "interaction": models.INTERACTIONS, "interaction_9": models.INTERACTIONS_9}),
)
def linear_models(spark, d):
    """Fit quality of all six linear formulas from one scan of the model frame."""
    formulas = {"linear": models.PREDICTORS, "linear_9": models.PREDICTORS_9, "polynomial": models.POLYNOMIAL, "polynomial_9": models.POLYNOMIAL_9,
                "interaction": models.INTERACTIONS, "interaction_9": models.INTERACTIONS_9}
    sums = models.formula_moments(models.model_frame(data(spark, d)), list(formulas.values()))
    rows = [(name, fit.n, len(fit.terms), fit.r2, fit.rss) for name, terms in formulas.items() for fit in [models.ols(sums, terms=terms)]]
    return as_digits(spark.createDataFrame(rows, "model string, n long, n_terms long, r_squared double, rss double"), "r_squared", "rss")


@query("forest_importance")
def forest_importance(spark, d):
    return models.forest(fitted_frame(spark, d)).importance()


@query("boosted_importance")
def boosted_importance(spark, d):
    return models.gain_importance(spark, models.boosted(fitted_frame(spark, d)))


@query("leaderboard")
def leaderboard(spark, d):
    """All five models at their defaults."""
    from switchflow.plans.offer_study import study_models

    return study_models(data(spark, d))["leaderboard"]
