"""Six-number summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchflow.functions.stats import exact_quantiles

# Quartile columns of a summary.
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Min, quartiles, mean, max and null count of each column: a row per column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("v")) for c in columns])
    long = df.select(F.explode(pairs).alias("p")).select("p.*")
    sums = long.groupBy("variable").agg(
        F.min("v").alias("min"),
        F.avg("v").alias("mean"),
        F.max("v").alias("max"),
        F.count_if(F.col("v").isNull()).alias("n_null"),
    )
    quartiles = exact_quantiles(long, ["variable"], "v", QUARTILES)
    return sums.join(quartiles, "variable", "left").select(
        "variable", "min", "q1", "median", "mean", "q3", "max", "n_null"
    )
