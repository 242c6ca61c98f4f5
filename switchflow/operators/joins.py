"""Join operators. No side is force-broadcast: sizes are Spark's to check.

AQE turns a join into a broadcast only when the measured side is below
`spark.sql.autoBroadcastJoinThreshold`, and splits skewed partitions of a shuffled
join, so a lookup that grows and a key that runs hot both keep working.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchflow.functions.dates import first_monday_from


def join_nullsafe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi join where null keys match each other; right key columns are dropped."""
    keys = list(keys)
    side = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = None
    for k in keys:
        test = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        condition = test if condition is None else condition & test
    joined = left.join(side, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{k}" for k in keys])


def left_join_nullsafe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return join_nullsafe(left, right, keys, "left")


def semi_keep(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in `wanted`; nulls match nulls."""
    return join_nullsafe(df, wanted.select(*keys).distinct(), keys, "left_semi")


def anti_drop(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in `known` (a null key never occurs)."""
    return df.join(known.select(*keys).distinct(), list(keys), "left_anti")


def full_zero_fill(left: DataFrame, right: DataFrame, keys: Sequence[str], fill: Sequence[str]) -> DataFrame:
    """Full outer join on null-safe keys; measures missing on a side become 0."""
    keys = list(keys)
    side = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = None
    for k in keys:
        test = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        condition = test if condition is None else condition & test
    joined = left.join(side, condition, "full")
    rest = [c for c in [*left.columns, *right.columns] if c not in keys]
    return joined.select(
        *[F.coalesce(F.col(k), F.col(f"_r_{k}")).alias(k) for k in keys],
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in fill else F.col(c) for c in rest],
    )


def left_default_zero(left: DataFrame, right: DataFrame, keys: Sequence[str], fill: Sequence[str]) -> DataFrame:
    """Left join; the named right-hand measures default to 0."""
    joined = left_join_nullsafe(left, right, keys)
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in fill})


def _date(d: dt.date | str | Column) -> Column:
    return d if isinstance(d, Column) else F.to_date(F.lit(str(d)))


def mondays_between(first: Column, last: Column) -> Column:
    """Array of Mondays in [first, last]; empty when there is none."""
    start = first_monday_from(first)
    return F.when(start <= last, F.sequence(start, last, F.expr("interval 7 days"))).otherwise(
        F.array().cast("array<date>")
    )


def dense_grid(keys: DataFrame, start: dt.date | str | Column, end: dt.date | str | Column) -> DataFrame:
    """Every Monday of [start, end] for every row of `keys`.

    The weeks are generated next to each key (one narrow step), not cross joined.
    """
    return keys.select(F.explode(mondays_between(_date(start), _date(end))).alias("date"), *keys.columns)


def active_on(
    intervals: DataFrame,
    start: dt.date | str | Column,
    end: dt.date | str | Column,
    from_col: str = "start_date",
    to_col: str = "end_date",
) -> DataFrame:
    """One row per (interval, Monday) with from <= Monday and (to null or to >= Monday).

    A range join against a calendar plans as a nested loop. The calendar is regular,
    so each interval generates just the Mondays it covers: linear in the output,
    and the caller goes on with equi keys. Open intervals stop at `end`.
    """
    lo = F.greatest(F.col(from_col), _date(start))
    hi = F.least(F.coalesce(F.col(to_col), _date(end)), _date(end))
    known = intervals.filter(F.col(from_col).isNotNull())
    return known.select(F.explode(mondays_between(lo, hi)).alias("date"), *intervals.columns)


_WHOLE = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def active_sums(
    intervals: DataFrame,
    start: dt.date | str | Column,
    end: dt.date | str | Column,
    keys: Sequence[str],
    sums: dict[str, Column] | None = None,
    from_col: str = "start_date",
    to_col: str = "end_date",
) -> DataFrame:
    """(date, keys, n, sums): number and sums of the intervals of `active_on` for every Monday that has any.

    A sweep: an interval adds itself at its first Monday and takes itself off a week
    after its last one. The changes are summed per key and Monday, on the map side first,
    and running totals over a key's Mondays give its state from each change to the next.
    What is read and moved depends on the number of intervals, not on their length; a key
    has a row per Monday at the end. Sums of whole numbers run in longs, the others in
    decimals of ten places, so taking off leaves no trace; a null adds nothing.
    """
    keys, sums = list(keys), sums or {}
    lo = F.greatest(F.col(from_col), _date(start))
    hi = F.least(F.coalesce(F.col(to_col), _date(end)), _date(end))
    first, gone = first_monday_from(lo), F.date_add(F.trunc(hi, "week"), 7)
    # Counts and flags need no decimals: long sums are as exact and far cheaper to add and run.
    whole = {f.name for f in intervals.select(*[c.alias(n) for n, c in sums.items()]).schema if isinstance(f.dataType, _WHOLE)}
    kind = {name: "long" if name in whole else "decimal(28,10)" for name in sums}
    exact = [F.coalesce(c.cast(kind[name]), F.lit(0).cast(kind[name])).alias(name) for name, c in sums.items()]
    spans = intervals.filter(F.col(from_col).isNotNull()).select(*keys, first.alias("_first"), gone.alias("_gone"), *exact).filter("_first < _gone")
    ends = F.array(F.struct(F.col("_first").alias("date"), F.lit(1).alias("_by")), F.struct(F.col("_gone").alias("date"), F.lit(-1).alias("_by")))
    events = spans.select(*keys, *sums, F.explode(ends).alias("e")).select(*keys, *sums, "e.*")
    by = F.col("_by")
    changes = events.groupBy(*keys, "date").agg(F.sum(by).alias("n"), *[F.sum(F.when(by > 0, F.col(c)).otherwise(-F.col(c))).alias(c) for c in sums])
    mondays = Window.partitionBy(*keys).orderBy("date")  # a row per Monday at most
    upto = mondays.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = changes.select(*keys, "date", F.lead("date").over(mondays).alias("_until"), *[F.sum(c).over(upto).alias(c) for c in ("n", *sums)])
    weeks = F.sequence(F.col("date"), F.date_add("_until", -7), F.expr("interval 7 days"))
    return states.filter("n > 0").select(F.explode(weeks).alias("date"), *keys, "n", *[F.col(c).cast("double").alias(c) for c in sums])


def unique_lookup(lookup: DataFrame, key: str) -> DataFrame:
    """The lookup, failing at run time if a key maps to more than one row."""
    rest = [c for c in lookup.columns if c != key]
    one = lookup.filter(F.col(key).isNotNull()).distinct().groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct(*rest)).alias("_row")
    )
    checked = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit(f"lookup has several rows for {key} "), F.col(key))))
    return one.select(checked.otherwise(F.col(key)).alias(key), *[F.col("_row")[c].alias(c) for c in rest])


def enrich(facts: DataFrame, entities: DataFrame, codes: DataFrame) -> DataFrame:
    """Attach entity columns to both ends of a movement and its reason group.

    `entities`: id, licence_common_id, retailer_name, retailer_size (one row per id).
    `codes`: crc_code, reporting_group (one row per code).
    """
    people = unique_lookup(entities.select("id", "licence_common_id", "retailer_name", "retailer_size"), "id")

    def side(id_name: str, prefix: str) -> DataFrame:
        return people.select(
            F.col("id").alias(id_name),
            F.col("licence_common_id").alias(f"ESC_{prefix}"),
            F.col("retailer_name").alias(f"{prefix}_Retailer_name"),
            F.col("retailer_size").alias(f"{prefix}_Retailer_size"),
        )

    reasons = unique_lookup(codes.select("crc_code", "reporting_group"), "crc_code").select(
        F.col("crc_code").alias("crcode"), F.col("reporting_group").alias("transfer_type")
    )
    # Lookups are broadcast: a few codes and a null-heavy key would put whole groups of facts in one task.
    return (
        facts.join(F.broadcast(side("frmp", "FRMP")), "frmp", "left")
        .join(F.broadcast(side("newfrmp", "NEWFRMP")), "newfrmp", "left")
        .join(F.broadcast(reasons), "crcode", "left")
    )
