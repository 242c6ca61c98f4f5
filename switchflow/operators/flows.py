"""Flow networks between entities and sizes, net change, in/out activity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchflow.functions.dates import month_start
from switchflow.functions.labels import movement_type, size_index
from switchflow.functions.stats import total
from switchflow.operators.joins import left_join_nullsafe
from switchflow.operators.periods import latest_month_rows
from switchflow.operators.topk import numbered
from switchflow.operators.trends import base_of, transfers_of, with_share
from switchflow.schema import SIZES

FROM, TO = "FRMP_Retailer_name", "NEWFRMP_Retailer_name"
FROM_SIZE, TO_SIZE = "FRMP_Retailer_size", "NEWFRMP_Retailer_size"


def current_fin_year(df: DataFrame) -> Column:
    return transfers_of(df).agg(F.max("FinYear")).scalar()


def flows(df: DataFrame, at: str = "latest_date") -> DataFrame:
    """Edge list (from, to, both sizes, sum); rows without both names are dropped.

    `latest_date` takes the last day of the current financial year, which is what
    the report charts; `latest_month` takes that day's whole month.
    """
    moves = transfers_of(df)
    # Greatest year first, then its greatest date: one aggregate, run once.
    last = moves.agg(F.max(F.struct("FinYear", "stat_date"))["stat_date"].alias("d"))
    if at == "latest_date":
        moves = moves.filter(F.col("stat_date") == last.scalar())
    elif at == "latest_month":
        moves = moves.filter(
            F.col("stat_date").between(
                last.select(F.trunc("d", "month")).scalar(), last.select(F.last_day("d")).scalar()
            )
        )
    else:
        raise ValueError(f"unknown moment: {at}")
    named = moves.filter(F.col(FROM).isNotNull() & F.col(TO).isNotNull())
    return named.groupBy(FROM, TO, FROM_SIZE, TO_SIZE).agg(total("stat_value").alias("transfers"))


def _ends(side: str) -> tuple[str, str, str, str]:
    """(ranked name, ranked size, other name, other size) for a side."""
    if side == "from":
        return FROM, FROM_SIZE, TO, TO_SIZE
    if side == "to":
        return TO, TO_SIZE, FROM, FROM_SIZE
    raise ValueError(f"unknown side: {side}")


def largest_nodes(edges: DataFrame, side: str = "from", k: int = 5) -> DataFrame:
    """The k largest (name, size) nodes of a side by volume; ties by name, then size."""
    name, size, _, _ = _ends(side)
    sums = edges.groupBy(name, size).agg(F.sum("transfers").alias("total"))
    return sums.orderBy(F.col("total").desc(), F.col(name), F.col(size).asc_nulls_last()).limit(k)


def top_flows(edges: DataFrame, side: str = "from", k: int = 5) -> DataFrame:
    """Edges of the k largest nodes of a side."""
    name = _ends(side)[0]
    # k rows by construction, so broadcasting them is safe.
    return edges.join(F.broadcast(largest_nodes(edges, side, k).select(name).distinct()), name, "left_semi")


def flow_nodes(edges: DataFrame, side: str = "from", k: int = 5) -> DataFrame:
    """Nodes (index, label, size, side, total) of the top-k sub-network.

    Losing nodes come first, then gaining ones, each by volume and then by name.
    """
    name, size, other, other_size = _ends(side)
    sub = top_flows(edges, side, k)
    ranked = largest_nodes(edges, side, k).select(
        F.col(name).alias("label"), F.col(size).alias("size"), "total", F.lit(side).alias("side")
    )
    others = sub.groupBy(F.col(other).alias("label")).agg(
        F.min(other_size).alias("size"), F.sum("transfers").alias("total")
    )
    others = others.select("label", "size", "total", F.lit("to" if side == "from" else "from").alias("side"))
    order = [(F.col("side") == "to"), F.col("total").desc(), F.col("label"), F.col("size").asc_nulls_last()]
    return numbered(ranked.unionByName(others), order, "index").select("index", "label", "size", "side", "total")


def flow_links(edges: DataFrame, side: str = "from", k: int = 5) -> DataFrame:
    """Links (source, target, value, opacity) of the top-k sub-network by node index."""
    name, size, _, _ = _ends(side)
    nodes = flow_nodes(edges, side, k)

    def ends(which: str, prefix: str) -> DataFrame:
        # A ranked node is a (name, size) pair, the other side is one node per name.
        cols = [F.col("index").alias(prefix), F.col("label").alias(FROM if which == "from" else TO)]
        if which == side:
            cols.append(F.col("size").alias(size))
        return nodes.filter(F.col("side") == which).select(*cols)

    sub = top_flows(edges, side, k)
    from_keys, to_keys = ([FROM, size], [TO]) if side == "from" else ([FROM], [TO, size])
    linked = left_join_nullsafe(sub, ends("from", "source"), from_keys)
    linked = left_join_nullsafe(linked, ends("to", "target"), to_keys)
    greatest = sub.agg(F.max("transfers")).scalar()
    return linked.select(
        "source",
        "target",
        F.col(FROM).alias("from_label"),
        F.col(TO).alias("to_label"),
        F.col("transfers").alias("value"),
        F.greatest(F.lit(0.2), F.col("transfers") / greatest).alias("opacity"),
    )


def flow_graph(edges: DataFrame, side: str = "from", k: int = 5) -> tuple[DataFrame, DataFrame]:
    """Node table and link table of the top-k sub-network."""
    return flow_nodes(edges, side, k), flow_links(edges, side, k)


def size_flows(df: DataFrame, fin_year: str | None = None, fallback: bool = False) -> DataFrame:
    """Sum per month, from-size and to-size in one financial year (default: current).

    With `fallback`, an empty result is replaced by the last day's movements.
    """
    sized = transfers_of(df).filter(F.col(FROM_SIZE).isin(*SIZES) & F.col(TO_SIZE).isin(*SIZES))
    year = F.lit(fin_year) if fin_year else current_fin_year(df)
    keys = [FROM_SIZE, TO_SIZE]
    out = (
        sized.filter(F.col("FinYear") == year)
        .groupBy(month_start("stat_date").alias("stat_date"), *keys)
        .agg(total("stat_value").alias("transfers"))
    )
    if fallback and out.isEmpty():
        last_day = transfers_of(df).agg(F.max("stat_date")).scalar()
        out = (
            sized.filter(F.col("stat_date") == last_day)
            .groupBy("stat_date", *keys)
            .agg(total("stat_value").alias("transfers"))
        )
    return out


def size_flow_graph(movements: DataFrame) -> DataFrame:
    """Links between size nodes: 0-2 on the losing side, 3-5 on the gaining side."""
    return movements.select(
        "stat_date",
        size_index(FROM_SIZE, "from").alias("source"),
        size_index(TO_SIZE, "to").alias("target"),
        F.col("transfers").alias("value"),
        movement_type(FROM_SIZE, TO_SIZE).alias("movement_type"),
    )


def movement_table(movements: DataFrame) -> DataFrame:
    """Per month: label `A → B`, value, and its share of the month (1 decimal)."""
    shared = with_share(movements, ["stat_date"], "transfers")
    return shared.select(
        "stat_date",
        F.concat_ws(" → ", FROM_SIZE, TO_SIZE).alias("movement"),
        "transfers",
        F.round("pct", 1).alias("pct"),
    )


def size_flow_summary(movements: DataFrame) -> DataFrame:
    """Year totals per size pair with movement class and share (1 decimal)."""
    sums = movements.groupBy(FROM_SIZE, TO_SIZE).agg(F.sum("transfers").alias("total"))
    shared = with_share(sums, [], "total", total_alias="whole")
    return shared.select(
        FROM_SIZE, TO_SIZE, "total", movement_type(FROM_SIZE, TO_SIZE).alias("movement_type"), F.round("pct", 1).alias("pct")
    )


def net_change(df: DataFrame) -> DataFrame:
    """Per entity in the latest month: out, in and in − out.

    Each summed edge counts once as out and once as in, so one pass and one
    aggregation replace the two sums and the full join. A movement with an unknown
    source stays as an out-only row with a null entity; an unknown target is no entity.
    """
    edges = transfers_of(latest_month_rows(df)).groupBy(FROM, TO).agg(total("stat_value").alias("v"))
    ends = F.array(
        F.struct(F.col(FROM).alias("retailer"), F.col("v").alias("out"), F.lit(0).cast("long").alias("in"), F.lit(True).alias("keep")),
        F.struct(F.col(TO).alias("retailer"), F.lit(0).cast("long").alias("out"), F.col("v").alias("in"), F.col(TO).isNotNull().alias("keep")),
    )
    sides = edges.select(F.explode(ends).alias("e")).select("e.*").filter("keep")
    sums = sides.groupBy("retailer").agg(F.sum("out").alias("out"), F.sum("in").alias("in_transfers"))
    return sums.withColumn("net_absolute", (F.col("in_transfers") - F.col("out")).cast("double"))


def previous_base(df: DataFrame) -> DataFrame:
    """Customer base per entity in the month before the latest one."""
    ym = F.col("YearMonth")
    # The months are few: the latest one and the one before it come from one list of them.
    months = df.select("Year", "Month", "YearMonth").distinct()
    ends = months.agg(F.max(F.struct("Year", "Month", "YearMonth")).alias("l"), F.collect_set("YearMonth").alias("every"))
    previous = ends.select(F.array_max(F.filter("every", lambda m: m < F.col("l.YearMonth")))).scalar()
    rows = base_of(df).filter((ym == previous) & F.col(FROM).isNotNull())
    return rows.groupBy(F.col(FROM).alias("retailer")).agg(total("stat_value").alias("active_nmis"))


def net_change_rate(df: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Net change as % of the previous month's base; 0 where there is no base."""
    joined = left_join_nullsafe(net_change(df), base if base is not None else previous_base(df), ["retailer"])
    active = F.coalesce("active_nmis", F.lit(0))
    rate = F.when(active > 0, F.col("net_absolute") / active * 100).otherwise(0.0)
    return joined.withColumn("active_nmis", active).withColumn("net_rate", rate)


def in_out_activity(df: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """In and out totals per named entity; rates are null where there is no base."""
    rows = net_change_rate(df, base).filter(F.length("retailer") > 0)
    per = F.when(F.col("active_nmis") > 0, F.col("active_nmis") / 100)
    return rows.select(
        "retailer",
        "out",
        "in_transfers",
        (F.col("out") + F.col("in_transfers")).alias("total_activity"),
        (F.col("out") / per).alias("out_rate"),
        (F.col("in_transfers") / per).alias("in_rate"),
        ((F.col("out") + F.col("in_transfers")) / per).alias("total_rate"),
    )


def in_out_rates(df: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """The normalised frame: entities with a base, smallest total rate first."""
    return in_out_activity(df, base).filter(F.col("total_rate").isNotNull()).orderBy("total_rate", "retailer")


def axis_bound(df: DataFrame, columns: Sequence[str], unit: int, alias: str = "axis_max") -> DataFrame:
    """Greatest value of the columns rounded up to a multiple of `unit`: one row."""
    peak = F.greatest(*[F.max(c) for c in columns]) if len(columns) > 1 else F.max(columns[0])
    return df.agg((F.ceil(peak / unit) * unit).cast("long").alias(alias))
