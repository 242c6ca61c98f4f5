"""Aggregate expressions, and exact order statistics that survive hot groups.

The built-in exact `median` keeps every value of a group in one buffer. A group here
can hold a large part of the table (all offers of one week, one price band), so the
quantiles and `average_rank_large` below work on running counts, whose groups are cut
when they are large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from switchflow.operators.joins import join_nullsafe
from switchflow.operators.running import RUN_ROWS, around_ranks, with_running
from switchflow.session import materialize


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(c: Column | str) -> Column:
    """Sum that skips nulls and is 0 when there is nothing to add."""
    return F.coalesce(F.sum(_col(c)), F.lit(0))


def strict_sum(c: Column | str) -> Column:
    """Sum that is null as soon as one value is null."""
    c = _col(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def strict_mean(c: Column | str) -> Column:
    """Mean that is null as soon as one value is null."""
    c = _col(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.avg(c))


def pct(condition: Column) -> Column:
    """Percentage of rows where the condition holds; null conditions are skipped."""
    return F.avg(condition.cast("double")) * 100


def pct_in(c: Column | str, values: Sequence[str]) -> Column:
    """Percentage of rows whose value is listed; a null value counts as not listed."""
    return pct(F.coalesce(_col(c).isin(*values), F.lit(False)))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], rows: int = RUN_ROWS) -> DataFrame:
    """Exact interpolated quantiles per group, one column per entry of `probs`.

    Values are counted (on the map side first), the counts written and summed up in the
    order of the values; the wanted ranks are then picked. Of more than `rows` counts only
    those near the ranks are ordered, see `around_ranks` and `with_running`.
    Nulls and NaN have no rank; groups without any other value do not appear.
    """
    return weighted_quantiles(df.withColumn("_c", F.lit(1)), keys, value, "_c", probs, rows)


def weighted_quantiles(
    cells: DataFrame, keys: Sequence[str], value: str, count: str, probs: dict[str, float], rows: int = RUN_ROWS, written: bool = False
) -> DataFrame:
    """`exact_quantiles` of values that are counted already.

    `written`: `cells` is a written frame; a large one is then read as it is, not counted and written once more.
    """
    keys = list(keys)
    if not keys:
        return weighted_quantiles(cells.withColumn("_all", F.lit(0)), ["_all"], value, count, probs, rows, written).drop("_all")
    v = _col(value).cast("double")
    own = cells.select(*keys, v.alias("_at"), _col(count).cast("long").alias("_c")).filter(F.col("_at").isNotNull() & ~F.isnan("_at"))
    large = written and cells.count() > rows
    if not large:
        own = materialize(own.groupBy(*keys, "_at").agg(F.sum("_c").alias("_c")), "counted")
        large = own.count() > rows
    pos = {name: (F.col("_n") - 1) * F.lit(float(p)) for name, p in probs.items()}
    ranks = [end(p) + 1 for p in pos.values() for end in (F.floor, F.ceil)]
    ranked = around_ranks(own, keys, "_at", "_c", ranks, rows=rows) if large else with_running(own, keys, "_at", "_c", rows=rows)

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((F.col("_to") >= rank) & (F.col("_to") - F.col("_c") < rank), F.col("_at")))

    found = []
    for i, p in enumerate(pos.values()):
        found += [at_rank(F.floor(p) + 1).alias(f"_lo{i}"), at_rank(F.ceil(p) + 1).alias(f"_hi{i}")]
    hits = ranked.groupBy(*keys, "_n").agg(*found)
    between = [F.col(f"_lo{i}") + (p - F.floor(p)) * (F.col(f"_hi{i}") - F.col(f"_lo{i}")) for i, p in enumerate(pos.values())]
    return hits.select(*keys, *[c.alias(name) for c, name in zip(between, pos)])


def exact_median(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    return exact_quantiles(df, keys, value, {alias: 0.5})


def average_rank(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """Rank of `value` inside each group, ties sharing their mean rank; null stays null.

    One window: for groups that are bounded by construction (a row per entity). For
    groups that can run hot use `average_rank_large`.
    """
    order = W.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last())
    ties = F.count(F.lit(1)).over(W.partitionBy(*keys, value))
    return df.withColumn(alias, F.when(F.col(value).isNotNull(), F.rank().over(order) + (ties - 1) / 2.0))


def average_rank_large(df: DataFrame, keys: Sequence[str], value: str, alias: str, rows: int = RUN_ROWS) -> DataFrame:
    """`average_rank` that never brings a large group together.

    Ranks are found on counted values, so ties collapse on the map side; a value's
    running count less the middle of its ties is its rank. `rows`: see `with_running`.
    """
    keys = list(keys)
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    ranked = with_running(materialize(counted, "counted"), keys, value, "_c", rows=rows)
    ranks = ranked.select(*keys, value, (F.col("_to") - (F.col("_c") - 1) / 2.0).alias(alias))
    return join_nullsafe(df, ranks, [*keys, value], "left")
