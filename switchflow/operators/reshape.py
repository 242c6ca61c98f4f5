"""Stacking, pivoting, unpivoting, key-first rows, group-size filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchflow.operators.joins import semi_keep

TOTAL_IN = "Total In"
TOTAL_OUT = "Total Out"


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames matched by column name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def suffix_columns(df: DataFrame, suffix: str, keep: Sequence[str]) -> DataFrame:
    """Append a suffix to every column that is not a key."""
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(c + suffix) for c in df.columns])


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def first_by_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key in the stated order.

    `min` of a struct is combined on the map side, so a hot key does not gather its
    rows. Columns outside `order` break ties, which makes the choice repeatable.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    picked = df.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_row"))
    return picked.select(*[F.col(c) if c == key else F.col("_row")[c].alias(c) for c in df.columns])


def min_group_size(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Rows of groups with at least n rows; null keys form a group."""
    big = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= n)
    return semi_keep(df, big, keys)


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of `a` that are not in `b`."""
    return a.subtract(b)


def unify_ids(df: DataFrame, id_columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Turn several id columns into rows (id_type, id), blanks dropped."""
    values = [F.col(c).alias(c) for c in id_columns]
    long = df.unpivot([F.col(k) for k in keep], values, "id_type", "id")
    return long.filter(F.length(F.trim("id")) > 0)


def flow_matrix_long(
    edges: DataFrame, source: str, target: str, value: str, totals: bool = True
) -> DataFrame:
    """From-to matrix in long form with row, column and grand totals.

    The edges are summed first; the totals are a cube over that small result.
    """
    fine = edges.groupBy(source, target).agg(F.sum(value).alias(value))
    if not totals:
        return fine
    cube = fine.cube(source, target).agg(
        F.sum(value).alias(value), F.grouping(source).alias("_gs"), F.grouping(target).alias("_gt")
    )
    return cube.select(
        F.when(F.col("_gs") == 1, TOTAL_IN).otherwise(F.col(source)).alias(source),
        F.when(F.col("_gt") == 1, TOTAL_OUT).otherwise(F.col(target)).alias(target),
        value,
        ((F.col("_gs") + F.col("_gt")) > 0).alias("is_total"),
    )


def flow_matrix(
    edges: DataFrame, source: str, target: str, value: str, columns: Sequence[str] | None = None, totals: bool = True
) -> DataFrame:
    """Wide from-to matrix: a row per source, a column per target, absent cells 0.

    Column names are metadata, so they have to be known on the driver: give them in
    `columns`, or they are read first. Spark's `spark.sql.pivotMaxValues` guards that
    list; for more targets than that use `flow_matrix_long`.
    """
    fine = edges.groupBy(source, target).agg(F.sum(value).alias(value))
    if columns is None:
        limit = int(edges.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
        found = fine.select(target).filter(F.col(target).isNotNull()).distinct().limit(limit + 1).collect()
        if len(found) > limit:
            raise ValueError(f"more than {limit} matrix columns; use flow_matrix_long")
        columns = sorted(r[0] for r in found)
    columns = list(columns)
    pivoted = fine.groupBy(source).pivot(target, columns).agg(F.sum(value))
    wide = pivoted.select(source, *[F.coalesce(_named(c), F.lit(0)).alias(c) for c in columns])
    if not totals:
        return wide
    row_sum: Column = reduce(lambda a, b: a + b, [_named(c) for c in columns], F.lit(0).cast("long"))
    wide = wide.withColumn(TOTAL_OUT, row_sum)
    sums = wide.agg(*[F.coalesce(F.sum(_named(c)), F.lit(0)).alias(c) for c in [*columns, TOTAL_OUT]])
    bottom = sums.select(F.lit(TOTAL_IN).alias(source), *[_named(c) for c in [*columns, TOTAL_OUT]])
    return wide.unionByName(bottom)


def _named(column: str) -> Column:
    """A column whose name may hold dots, spaces or backticks."""
    return F.col("`" + column.replace("`", "``") + "`")


def with_intensity(matrix: DataFrame, value: str, is_total: str = "is_total", alias: str = "intensity") -> DataFrame:
    """Cell shade: value over the greatest cell, clamped to [0, 1]; totals stay null."""
    greatest = matrix.filter(~F.col(is_total)).agg(F.max(value)).scalar()
    shade = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(value) / greatest))
    return matrix.withColumn(
        alias, F.when(~F.col(is_total), F.when((greatest > 0) & F.col(value).isNotNull(), shade).otherwise(0.0))
    )
