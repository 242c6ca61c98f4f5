"""Offer study: how offers in the market relate to customers leaving."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from switchflow.operators import bands, models
from switchflow.operators.offers import offer_snapshots
from switchflow.operators.study import (
    LAGS,
    analysis_dataset,
    customer_base,
    daily_transfers,
    weekly_transfers,
)
from switchflow.session import materialize


def study_dataset(
    facts: DataFrame,
    offers: DataFrame,
    start: dt.date | str | Column,
    end: dt.date | str | Column,
    year: int = 2022,
    lags: Sequence[int] = LAGS,
    min_rows: int = 100,
    faithful_fanout: bool = False,
) -> DataFrame:
    """Master frame from enriched movements and prepared offers."""
    # Written: its rows and its entities' row counts are read apart, each of them would join the facts anew.
    weekly = materialize(weekly_transfers(daily_transfers(facts, year)), "weekly")
    base = customer_base(facts, year)
    # Empty cells carry only nulls into the left joins of the lags, apart from their
    # offer count, so the dense grid is kept.
    snapshots = offer_snapshots(offers, start, end)
    return analysis_dataset(weekly, base, snapshots, lags, min_rows, faithful_fanout)


def study_tables(data: DataFrame) -> dict[str, DataFrame]:
    """Descriptive result frames of the study. Pass a saved master frame."""
    segments = bands.segment_all_lags(data)
    differences = bands.vs_baseline(segments)
    return {
        "segments": segments,
        "differences": differences,
        "strongest_lag": bands.strongest_lag(differences),
        "threshold": bands.threshold_curve(data),
        "threshold_by_entity": bands.threshold_by_entity(data),
        "contract": bands.class_effect(data, "contract"),
        "solar": bands.class_effect(data, "solar"),
        "incentive": bands.class_effect(data, "incentive"),
        "contract_detail": bands.contract_investigation(data),
        "fees": bands.fee_points(data),
    }


def study_models(data: DataFrame, trees: int = 500, rounds: int = 100) -> dict[str, DataFrame]:
    """Fit all five models; returns coefficient, importance and leaderboard frames."""
    spark = data.sparkSession
    frame = materialize(models.model_frame(data), "model")
    # One scan serves the three linear models, the inflation factors and the nested pair.
    sums = models.formula_moments(frame, (models.PREDICTORS, models.POLYNOMIAL, models.INTERACTIONS, models.PREDICTORS_9, models.POLYNOMIAL_9))
    linear = models.ols(sums, terms=models.PREDICTORS)
    poly = models.ols(sums, terms=models.POLYNOMIAL)
    inter = models.ols(sums, terms=models.INTERACTIONS)
    rf = models.forest(frame, trees=trees)
    gbt = models.boosted(frame, rounds=rounds)

    scores = {
        "Linear Regression": linear.r2,
        "Polynomial Regression": poly.r2,
        "Interaction Model": inter.r2,
        "Random Forest": models.r2_of(rf.predictions()).head()[0],
        "Boosted Trees": models.r2_of(models.predictions(gbt, frame)).head()[0],
    }
    return {
        "coefficients": models.ols_table(spark, linear),
        "fit_quality": models.fit_quality(spark, linear),
        "vif": models.vif(spark, sums),
        "nested": models.compare_nested(spark, *models.nested(sums, models.PREDICTORS_9, models.POLYNOMIAL_9)),
        "forest_importance": rf.importance(),
        "boosted_importance": models.gain_importance(spark, gbt),
        "leaderboard": models.leaderboard(spark, scores),
    }
