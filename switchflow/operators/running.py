"""Running totals in the order of a value, also of groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from switchflow.operators.joins import join_nullsafe, left_join_nullsafe
from switchflow.session import materialize

# Rows of one group that a task may order.
RUN_ROWS = 1_000_000
# Halvings of a sorted list of cuts: enough for a million of them.
HALVINGS = 20
# Cells of all groups' histograms together, and the most and least of one group.
HISTOGRAM, MOST_BINS, LEAST_BINS = 1 << 18, 1024, 8


def smaller(cuts: Column, value: Column) -> Column:
    """How many of the sorted cuts lie below the value, by halving; 0 for nulls."""

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        open_, below = s["lo"] < s["hi"], F.get(cuts, mid) < value
        return F.struct(F.when(open_ & below, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(open_ & ~below, mid).otherwise(s["hi"]).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), start, halve, lambda s: s["lo"])
    return F.when(cuts.isNotNull() & value.isNotNull(), found).otherwise(F.lit(0))


def with_running(
    cells: DataFrame, keys: Sequence[str], order: str, count: str, upto: str = "_to", whole: str = "_n", rows: int = RUN_ROWS
) -> DataFrame:
    """cells with `upto`, the sum of `count` over the rows of the same keys up to this one, and `whole`, over all of them.

    `cells` holds each (keys, order) once and is read several times: pass a written
    frame. `order` is a number; nulls come first. Groups of up to `rows` rows are ordered
    in one sort. A larger group is cut at values that a sketch spaces evenly, every piece
    is ordered on its own and starts from the totals of the pieces below it, one row per
    piece of a large group, so no task ever orders more. Only the large groups are cut;
    the others are still ordered in one sort.
    """
    keys = list(keys)
    if not keys:
        out = with_running(cells.withColumn("_all", F.lit(0)), ["_all"], order, count, upto, whole, rows)
        return out.drop("_all")
    current = (W.unboundedPreceding, W.currentRow)

    def one_sort(df: DataFrame) -> DataFrame:
        group = W.partitionBy(*keys)
        return df.withColumn(upto, F.sum(count).over(group.orderBy(order).rowsBetween(*current))).withColumn(whole, F.sum(count).over(group))

    n = cells.count()  # of a written frame: read from its footers
    if n <= rows:
        return one_sort(cells)
    large = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size")).filter(F.col("_size") > rows).drop("_size")
    large = F.broadcast(materialize(large, "large-groups"))  # at most n / rows of them
    small = one_sort(join_nullsafe(cells, large, keys, "left_anti"))
    big = join_nullsafe(cells, large, keys, "left_semi")
    parts = 2 * -(-n // rows)
    spaced = F.percentile_approx(order, [i / parts for i in range(1, parts)], 20 * parts)
    cuts = materialize(big.groupBy(*keys).agg(spaced.alias("_cuts")), "cuts")
    placed = left_join_nullsafe(big, cuts, keys).withColumn("_k", smaller(F.col("_cuts"), F.col(order))).drop("_cuts")
    totals = placed.groupBy(*keys, "_k").agg(F.sum(count).alias("_t"))
    group = W.partitionBy(*keys)
    before = F.coalesce(F.sum("_t").over(group.orderBy("_k").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = materialize(totals.withColumn("_o", before).withColumn(whole, F.sum("_t").over(group)).drop("_t"), "offsets")
    inside = W.partitionBy(*keys, "_k").orderBy(order).rowsBetween(*current)
    summed = placed.withColumn("_s", F.sum(count).over(inside))
    joined = join_nullsafe(summed, offsets, [*keys, "_k"], "inner")
    pieces = joined.withColumn(upto, F.col("_o") + F.col("_s")).select(*cells.columns, upto, whole)
    return small.select(*cells.columns, upto, whole).unionByName(pieces)


def around_ranks(
    cells: DataFrame, keys: Sequence[str], order: str, count: str, ranks: Sequence[Column], upto: str = "_to", whole: str = "_n",
    rows: int = RUN_ROWS,
) -> DataFrame:
    """Those rows of `with_running` that hold the ranks (functions of `whole`), and rows near them.

    Nothing but the bins that hold a rank is ordered: a histogram of each group, between
    its least and its greatest value, is summed on the map side, and says which bins these
    are and what lies below them. Values that crowd into a bin are only more rows to
    order, by `with_running`. Groups too many for a histogram go there whole. `cells` is a
    written frame without nulls and NaN in `order`; repeated (keys, order) are added up.
    """
    keys = list(keys)
    span = materialize(cells.groupBy(*keys).agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"), F.sum(count).alias(whole)), "span")
    bins = min(MOST_BINS, HISTOGRAM // max(span.count(), 1))
    if bins < LEAST_BINS:
        once = materialize(cells.groupBy(*keys, order).agg(F.sum(count).alias(count)), "counted")
        return with_running(once, keys, order, count, upto, whole, rows)
    width = F.col("_hi") - F.col("_lo")
    place = F.least(F.floor((F.col(order) - F.col("_lo")) / width * bins), F.lit(bins - 1))
    spread = (width > 0) & (width < float("inf"))
    # Broadcast: the bound on the histogram bounds the groups.
    placed = join_nullsafe(cells, F.broadcast(span), keys, "inner").withColumn("_b", F.when(spread, place).otherwise(0)).drop("_lo", "_hi")
    below = W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = placed.groupBy(*keys, whole, "_b").agg(F.sum(count).alias("_t")).withColumn("_s", F.sum("_t").over(below))
    holds = F.lit(False)
    for rank in ranks:
        holds |= (F.col("_s") >= rank) & (F.col("_s") - F.col("_t") < rank)
    wanted = materialize(sums.filter(holds).select(*keys, "_b", (F.col("_s") - F.col("_t")).alias("_below")), "bins")
    near = join_nullsafe(placed, F.broadcast(wanted), [*keys, "_b"], "inner")
    near = materialize(near.groupBy(*keys, "_b", "_below", whole, order).agg(F.sum(count).alias(count)), "near")
    ranked = with_running(near, [*keys, "_b"], order, count, "_upto", "_in_bin", rows)
    return ranked.select(*keys, order, count, (F.col("_below") + F.col("_upto")).alias(upto), whole)
