"""Trends, shares, periods, top-k and flows over the movement view."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import EDGES, T, labelled, query, transfers
from switchflow.operators import flows, joins, periods, reshape, topk, trends
from switchflow.session import materialize

S, FROM, TO = "FRMP_Retailer_size", "FRMP_Retailer_name", "NEWFRMP_Retailer_name"
NATIONS = [f"NATION_{i}" for i in range(25)]


# --- sums by period with a Total series -----------------------------------------

def _trend_sql(period: str) -> str:
    return f"""{T}
SELECT {period}, {S}, CAST(sum(stat_value) AS BIGINT) AS transfers, FALSE AS is_total FROM m GROUP BY {period}, {S}
UNION ALL
SELECT {period}, 'Total', CAST(sum(stat_value) AS BIGINT), TRUE FROM m GROUP BY {period}"""


@query(
    "trend_month",
    f"""{T}
SELECT YearMonth, month_start AS stat_date, {S}, CAST(sum(stat_value) AS BIGINT) AS transfers, FALSE AS is_total FROM m GROUP BY ALL
UNION ALL
SELECT YearMonth, month_start, 'Total', CAST(sum(stat_value) AS BIGINT), TRUE FROM m GROUP BY ALL""",
)
def trend_month(spark, d):
    return trends.trend(transfers(spark, d), "month")


@query(
    "trend_from_sums",
    f"""{T}
SELECT YearMonth, month_start AS stat_date, {S}, CAST(sum(stat_value) AS BIGINT) AS transfers, FALSE AS is_total FROM m GROUP BY ALL
UNION ALL
SELECT YearMonth, month_start, 'Total', CAST(sum(stat_value) AS BIGINT), TRUE FROM m GROUP BY ALL""",
)
def trend_from_sums(spark, d):
    """The monthly trend from partial sums, kept apart for two sets of files and put together."""
    facts = transfers(spark, d)
    parts = [trends.partial_sums(facts.filter(F.col("Month") % 2 == i)) for i in (0, 1)]
    return trends.trend(materialize(parts[0].union(parts[1]), "sums"), "month")


@query("trend_quarter", _trend_sql("FinYearQuarter"))
def trend_quarter(spark, d):
    return trends.trend(transfers(spark, d), "quarter")


@query("trend_finyear", _trend_sql("FinYear"))
def trend_finyear(spark, d):
    return trends.trend(transfers(spark, d), "finyear")


def _grains_sql() -> str:
    parts = []
    for grain, col in (("month", "YearMonth"), ("quarter", "FinYearQuarter"), ("finyear", "FinYear")):
        parts.append(f"SELECT '{grain}' AS grain, {col} AS period, {S}, CAST(sum(stat_value) AS BIGINT) AS transfers, FALSE AS is_total FROM m GROUP BY {col}, {S}")
        parts.append(f"SELECT '{grain}', {col}, 'Total', CAST(sum(stat_value) AS BIGINT), TRUE FROM m GROUP BY {col}")
    return f"{T} " + " UNION ALL ".join(parts)


@query("trend_all_grains", _grains_sql())
def trend_all_grains(spark, d):
    return trends.trend_all_grains(transfers(spark, d))


def _entity_sql(cols: str) -> str:
    return f"{T} SELECT {cols}, {FROM}, CAST(sum(stat_value) AS BIGINT) AS transfers FROM m WHERE {FROM} IS NOT NULL GROUP BY ALL"


@query("entity_month", _entity_sql("YearMonth, month_start AS stat_date"))
def entity_month(spark, d):
    return trends.entity_trend(transfers(spark, d), FROM, "month")


@query("entity_quarter", _entity_sql("FinYearQuarter"))
def entity_quarter(spark, d):
    return trends.entity_trend(transfers(spark, d), FROM, "quarter")


@query("entity_finyear", _entity_sql("FinYear"))
def entity_finyear(spark, d):
    return trends.entity_trend(transfers(spark, d), FROM, "finyear")


_LATEST = "Year = (SELECT max(Year) FROM t) AND Month = (SELECT max(Month) FROM t WHERE Year = (SELECT max(Year) FROM t))"


@query(
    "daily_trend",
    f"""{T}, l AS (SELECT * FROM m WHERE {_LATEST})
SELECT stat_date, {S}, CAST(sum(stat_value) AS BIGINT) AS transfers, FALSE AS is_total FROM l GROUP BY ALL
UNION ALL SELECT stat_date, 'Total', CAST(sum(stat_value) AS BIGINT), TRUE FROM l GROUP BY stat_date""",
)
def daily_trend(spark, d):
    return trends.trend(periods.latest_month_rows(transfers(spark, d)), "day")


@query(
    "coverage",
    f"{T} SELECT count(*) AS total_records, min(stat_date) AS first_date, max(stat_date) AS last_date, strftime(max(stat_date), '%B %Y') AS latest_month FROM t",
)
def coverage(spark, d):
    return trends.coverage(transfers(spark, d))


@query("distinct_entities", f"{T} SELECT DISTINCT {FROM} FROM t WHERE {FROM} IS NOT NULL ORDER BY 1")
def distinct_entities(spark, d):
    return trends.distinct_sorted(transfers(spark, d), FROM)


@query(
    "measure_split",
    f"{T} SELECT id_mts2, stat_date, {FROM}, CAST(stat_value AS INT) AS stat_value FROM t WHERE stat_shortcut = 'M71'",
)
def measure_split(spark, d):
    return trends.base_of(transfers(spark, d)).select("id_mts2", "stat_date", FROM, "stat_value")


# --- shares ---------------------------------------------------------------------

def _share_sql(out: str, part: str) -> str:
    return f"""{T}, g AS (SELECT {out}, transfer_type, CAST(sum(stat_value) AS BIGINT) AS transfers FROM m WHERE transfer_type IS NOT NULL GROUP BY ALL)
SELECT *, CAST(sum(transfers) OVER (PARTITION BY {part}) AS BIGINT) AS total,
 round(transfers / sum(transfers) OVER (PARTITION BY {part}) * 100, 6) AS pct FROM g"""


@query("type_share_month", _share_sql("YearMonth, month_start AS stat_date", "stat_date"))
def type_share_month(spark, d):
    return trends.share_of_total(transfers(spark, d), "month")


@query("type_share_quarter", _share_sql("FinYearQuarter", "FinYearQuarter"))
def type_share_quarter(spark, d):
    return trends.share_of_total(transfers(spark, d), "quarter")


@query("type_share_finyear", _share_sql("FinYear", "FinYear"))
def type_share_finyear(spark, d):
    return trends.share_of_total(transfers(spark, d), "finyear")


# --- latest, previous, trailing --------------------------------------------------

@query(
    "latest_month_flag",
    f"""{T} SELECT coalesce({_LATEST}, FALSE) AS is_latest_month, stat_shortcut, count(*) AS n, CAST(sum(stat_value) AS BIGINT) AS stat_value
FROM t GROUP BY ALL""",
)
def latest_month_flag(spark, d):
    flagged = periods.flag_latest_month(transfers(spark, d))
    return flagged.groupBy("is_latest_month", "stat_shortcut").agg(
        F.count(F.lit(1)).alias("n"), F.sum("stat_value").alias("stat_value")
    )


@query(
    "latest_change",
    f"""{T}, g AS (SELECT month_start AS month, CAST(sum(stat_value) AS BIGINT) AS transfers FROM m GROUP BY ALL),
c AS (SELECT month, transfers, lag(transfers) OVER (ORDER BY month) AS previous FROM g),
p AS (SELECT *, round((transfers - previous) / previous * 100, 1) AS pct_change FROM c ORDER BY month DESC LIMIT 1)
SELECT *, CASE WHEN pct_change > 0 THEN 'increase' ELSE 'decrease' END AS direction FROM p""",
)
def latest_change(spark, d):
    return periods.latest_change(transfers(spark, d))


@query(
    "previous_period",
    f"{T} SELECT max(YearMonth) AS previous, (SELECT max(YearMonth) FROM t) AS latest FROM t WHERE YearMonth < (SELECT max(YearMonth) FROM t)",
)
def previous_period(spark, d):
    return periods.previous_period(labelled(spark, d))


_TRAIL = "stat_date BETWEEN (SELECT CAST(max(stat_date) - INTERVAL 12 MONTH AS DATE) FROM t) AND (SELECT max(stat_date) FROM t)"


@query("last_12_months", f"{T} SELECT id_mts2, stat_date, stat_shortcut, CAST(stat_value AS INT) AS stat_value FROM t WHERE {_TRAIL}")
def last_12_months(spark, d):
    return periods.last_12_months(transfers(spark, d)).select("id_mts2", "stat_date", "stat_shortcut", "stat_value")


@query(
    "exclude_finyears",
    f"""{T} SELECT FinYear, stat_shortcut, count(*) AS n FROM t WHERE FinYear NOT IN ('1994-95', '1995-96', '1996-97') GROUP BY ALL""",
)
def exclude_finyears(spark, d):
    kept = periods.exclude_values(transfers(spark, d), "FinYear", ["1994-95", "1995-96", "1996-97"])
    return kept.groupBy("FinYear", "stat_shortcut").agg(F.count(F.lit(1)).alias("n"))


@query(
    "report_facts",
    f"""{T} SELECT YearMonth, {_LATEST} AS is_latest_month, count(*) AS n FROM t
WHERE FinYear NOT IN ('2017-18', '2018-19', '2019-20') GROUP BY ALL""",
)
def report_facts(spark, d):
    return periods.report_facts(transfers(spark, d)).groupBy("YearMonth", "is_latest_month").agg(F.count(F.lit(1)).alias("n"))


# --- top-k ----------------------------------------------------------------------

def _topk_sql(entity: str, k: int, alias: str, extra: str = "") -> str:
    return f"""{T}, w AS (SELECT * FROM m WHERE {_TRAIL} AND {entity} IS NOT NULL {extra}),
best AS (SELECT {entity} FROM w GROUP BY {entity} ORDER BY sum(stat_value) DESC, {entity} LIMIT {k})
SELECT month_start AS year_month, {entity}, CAST(sum(stat_value) AS BIGINT) AS {alias} FROM w
WHERE {entity} IN (SELECT {entity} FROM best) GROUP BY ALL"""


@query("move_in_top5", _topk_sql(TO, 5, "move_ins", "AND transfer_type = 'Move-in'"))
def move_in_top5(spark, d):
    return topk.top_k_series(transfers(spark, d), "to", 5, "Move-in", alias="move_ins")


@query("losing_top10", _topk_sql(FROM, 10, "transfers"))
def losing_top10(spark, d):
    return topk.top_k_series(transfers(spark, d), "from", 10)


@query("gaining_top10", _topk_sql(TO, 10, "transfers"))
def gaining_top10(spark, d):
    return topk.top_k_series(transfers(spark, d), "to", 10)


def _totals_sql(entity: str) -> str:
    return f"""{T}, w AS (SELECT * FROM m WHERE {_TRAIL} AND {entity} IS NOT NULL),
best AS (SELECT {entity}, CAST(sum(stat_value) AS BIGINT) AS transfers FROM w GROUP BY {entity} ORDER BY 2 DESC, 1 LIMIT 10)
SELECT *, CAST(row_number() OVER (ORDER BY transfers DESC, {entity}) AS INT) AS position FROM best ORDER BY position LIMIT 5"""


@query("losing_totals", _totals_sql(FROM))
def losing_totals(spark, d):
    return topk.top_k_totals(transfers(spark, d), "from")


@query("gaining_totals", _totals_sql(TO))
def gaining_totals(spark, d):
    return topk.top_k_totals(transfers(spark, d), "to")


# --- flows ----------------------------------------------------------------------

def held_edges(spark, d):
    """The edge list, written once: node and link tables use it many times."""
    return materialize(flows.flows(transfers(spark, d)), "edges")


@query("flow_edges", f"{EDGES} SELECT * FROM edges")
def flow_edges(spark, d):
    return flows.flows(transfers(spark, d))


@query(
    "flow_edges_month",
    f"""{T} SELECT FRMP_Retailer_name, NEWFRMP_Retailer_name, FRMP_Retailer_size, NEWFRMP_Retailer_size, CAST(sum(stat_value) AS BIGINT) AS transfers
FROM m WHERE month_start = (SELECT max(month_start) FROM m) AND {FROM} IS NOT NULL AND {TO} IS NOT NULL GROUP BY ALL""",
)
def flow_edges_month(spark, d):
    return flows.flows(transfers(spark, d), at="latest_month")


def _topflows_sql(name: str, size: str) -> str:
    return f""", best AS (SELECT {name}, {size}, sum(transfers) AS total FROM edges GROUP BY ALL ORDER BY total DESC, {name}, {size} NULLS LAST LIMIT 5),
sub AS (SELECT * FROM edges WHERE {name} IN (SELECT {name} FROM best))"""


_TOP_FROM = EDGES + _topflows_sql(FROM, "FRMP_Retailer_size")
_TOP_TO = EDGES + _topflows_sql(TO, "NEWFRMP_Retailer_size")


@query("top_flows_from", f"{_TOP_FROM} SELECT * FROM sub")
def top_flows_from(spark, d):
    return flows.top_flows(flows.flows(transfers(spark, d)), "from")


@query("top_flows_to", f"{_TOP_TO} SELECT * FROM sub")
def top_flows_to(spark, d):
    return flows.top_flows(flows.flows(transfers(spark, d)), "to")


def _nodes_sql(side: str) -> str:
    ranked, rsize, other, osize = (
        (FROM, "FRMP_Retailer_size", TO, "NEWFRMP_Retailer_size") if side == "from" else (TO, "NEWFRMP_Retailer_size", FROM, "FRMP_Retailer_size")
    )
    opposite = "to" if side == "from" else "from"
    return f"""{_TOP_FROM if side == "from" else _TOP_TO},
nodes0 AS (SELECT {ranked} AS label, {rsize} AS size, CAST(total AS BIGINT) AS total, '{side}' AS side FROM best
 UNION ALL SELECT {other}, min({osize}), CAST(sum(transfers) AS BIGINT), '{opposite}' FROM sub GROUP BY {other}),
nodes AS (SELECT CAST(row_number() OVER (ORDER BY side, total DESC, label, size NULLS LAST) - 1 AS INT) AS "index", label, size, side, total FROM nodes0)"""


@query("flow_nodes_from", f"{_nodes_sql('from')} SELECT * FROM nodes")
def flow_nodes_from(spark, d):
    return flows.flow_nodes(held_edges(spark, d), "from")


@query("flow_nodes_to", f"{_nodes_sql('to')} SELECT * FROM nodes")
def flow_nodes_to(spark, d):
    return flows.flow_nodes(held_edges(spark, d), "to")


def _links_sql(side: str) -> str:
    return f"""{_nodes_sql(side)} SELECT a."index" AS source, b."index" AS target, {FROM} AS from_label, {TO} AS to_label, transfers AS value,
 round(greatest(0.2, transfers / (SELECT max(transfers) FROM sub)), 6) AS opacity
FROM sub LEFT JOIN nodes a ON a.side = 'from' AND a.label = {FROM} LEFT JOIN nodes b ON b.side = 'to' AND b.label = {TO}"""


@query("flow_links_from", _links_sql("from"))
def flow_links_from(spark, d):
    return flows.flow_links(held_edges(spark, d), "from")


@query("flow_links_to", _links_sql("to"))
def flow_links_to(spark, d):
    return flows.flow_links(held_edges(spark, d), "to")


_CUBE = f"""{EDGES}, c AS (SELECT CASE WHEN grouping({FROM}) = 1 THEN 'Total In' ELSE {FROM} END AS {FROM},
 CASE WHEN grouping({TO}) = 1 THEN 'Total Out' ELSE {TO} END AS {TO}, CAST(sum(transfers) AS BIGINT) AS transfers,
 grouping({FROM}) + grouping({TO}) > 0 AS is_total FROM edges GROUP BY CUBE ({FROM}, {TO}))"""


@query("flow_matrix_long", f"{_CUBE} SELECT * FROM c")
def flow_matrix_long(spark, d):
    return reshape.flow_matrix_long(flows.flows(transfers(spark, d)), FROM, TO, "transfers")


@query(
    "flow_matrix_wide",
    f"""{EDGES}, r AS (SELECT {FROM}, {', '.join(f"CAST(coalesce(sum(transfers) FILTER ({TO} = '{n}'), 0) AS BIGINT) AS " + '"' + n + '"' for n in NATIONS)},
 CAST(sum(transfers) AS BIGINT) AS "Total Out" FROM edges GROUP BY GROUPING SETS (({FROM}), ()))
SELECT * REPLACE (coalesce({FROM}, 'Total In') AS {FROM}) FROM r""",
)
def flow_matrix_wide(spark, d):
    """The wide matrix, every cell of it, with stated columns."""
    return reshape.flow_matrix(held_edges(spark, d), FROM, TO, "transfers", columns=NATIONS)


@query(
    "flow_matrix_ordered",
    f"{_CUBE} SELECT {FROM}, {TO}, transfers FROM c WHERE {TO} = 'Total Out' ORDER BY {FROM} = 'Total In', {FROM}",
)
def flow_matrix_ordered(spark, d):
    long = reshape.flow_matrix_long(flows.flows(transfers(spark, d)), FROM, TO, "transfers")
    rows = long.filter(F.col(TO) == reshape.TOTAL_OUT).select(FROM, TO, "transfers")
    return topk.order_with_totals_last(rows, FROM, [reshape.TOTAL_IN])


@query(
    "flow_intensity",
    f"""{_CUBE} SELECT *, CASE WHEN NOT is_total THEN round(least(1.0, greatest(0.0, transfers / (SELECT max(transfers) FROM c WHERE NOT is_total))), 6) END AS intensity FROM c""",
)
def flow_intensity(spark, d):
    long = reshape.flow_matrix_long(flows.flows(transfers(spark, d)), FROM, TO, "transfers")
    return reshape.with_intensity(long, "transfers")


# --- size movements ---------------------------------------------------------------

SIZE_FLOWS = f"""{T}, sf AS (SELECT month_start AS stat_date, FRMP_Retailer_size, NEWFRMP_Retailer_size, CAST(sum(stat_value) AS BIGINT) AS transfers FROM m
 WHERE FinYear = (SELECT max(FinYear) FROM m) AND FRMP_Retailer_size IN ('Small','Medium','Large') AND NEWFRMP_Retailer_size IN ('Small','Medium','Large') GROUP BY ALL)"""
_MOVE = """CASE WHEN FRMP_Retailer_size = NEWFRMP_Retailer_size THEN 'Same Size'
 WHEN (FRMP_Retailer_size = 'Small' AND NEWFRMP_Retailer_size <> 'Small') OR (FRMP_Retailer_size = 'Medium' AND NEWFRMP_Retailer_size = 'Large') THEN 'Moving Up' ELSE 'Moving Down' END"""


@query("size_flows", f"{SIZE_FLOWS} SELECT * FROM sf")
def size_flows(spark, d):
    return flows.size_flows(transfers(spark, d))


@query(
    "size_flows_fallback",
    f"""{T} SELECT stat_date, FRMP_Retailer_size, NEWFRMP_Retailer_size, CAST(sum(stat_value) AS BIGINT) AS transfers FROM m
WHERE stat_date = (SELECT max(stat_date) FROM m) AND FRMP_Retailer_size IN ('Small','Medium','Large') AND NEWFRMP_Retailer_size IN ('Small','Medium','Large') GROUP BY ALL""",
)
def size_flows_fallback(spark, d):
    return flows.size_flows(transfers(spark, d), fin_year="1900-01", fallback=True)


@query(
    "size_flow_graph",
    f"""{SIZE_FLOWS} SELECT stat_date,
 CAST(CASE FRMP_Retailer_size WHEN 'Small' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END AS INT) AS source,
 CAST(CASE NEWFRMP_Retailer_size WHEN 'Small' THEN 3 WHEN 'Medium' THEN 4 ELSE 5 END AS INT) AS target,
 transfers AS value, {_MOVE} AS movement_type FROM sf""",
)
def size_flow_graph(spark, d):
    return flows.size_flow_graph(flows.size_flows(transfers(spark, d)))


@query(
    "size_movements",
    f"""{SIZE_FLOWS} SELECT stat_date, FRMP_Retailer_size || ' → ' || NEWFRMP_Retailer_size AS movement, transfers,
 round(transfers / sum(transfers) OVER (PARTITION BY stat_date) * 100, 1) AS pct FROM sf""",
)
def size_movements(spark, d):
    return flows.movement_table(flows.size_flows(transfers(spark, d)))


@query(
    "size_summary",
    f"""{SIZE_FLOWS}, y AS (SELECT FRMP_Retailer_size, NEWFRMP_Retailer_size, CAST(sum(transfers) AS BIGINT) AS total FROM sf GROUP BY ALL)
SELECT FRMP_Retailer_size, NEWFRMP_Retailer_size, total, {_MOVE} AS movement_type, round(total / (SELECT sum(total) FROM y) * 100, 1) AS pct FROM y""",
)
def size_summary(spark, d):
    return flows.size_flow_summary(flows.size_flows(transfers(spark, d)))


# --- net change --------------------------------------------------------------------

NET = f"""{T}, l AS (SELECT * FROM m WHERE {_LATEST}),
o AS (SELECT {FROM} AS retailer, sum(stat_value) AS out FROM l GROUP BY 1),
i AS (SELECT {TO} AS retailer, sum(stat_value) AS in_transfers FROM l WHERE {TO} IS NOT NULL GROUP BY 1),
net AS (SELECT coalesce(o.retailer, i.retailer) AS retailer, CAST(coalesce(out, 0) AS BIGINT) AS out, CAST(coalesce(in_transfers, 0) AS BIGINT) AS in_transfers,
 CAST(coalesce(in_transfers, 0) - coalesce(out, 0) AS DOUBLE) AS net_absolute FROM o FULL JOIN i ON o.retailer = i.retailer),
prev AS (SELECT {FROM} AS retailer, CAST(sum(stat_value) AS BIGINT) AS active_nmis FROM t WHERE stat_shortcut = 'M71' AND {FROM} IS NOT NULL
 AND YearMonth = (SELECT max(YearMonth) FROM t WHERE YearMonth < (SELECT max(YearMonth) FROM t WHERE {_LATEST})) GROUP BY 1),
rate AS (SELECT net.*, coalesce(active_nmis, 0) AS active_nmis,
 CASE WHEN coalesce(active_nmis, 0) > 0 THEN net_absolute / active_nmis * 100 ELSE 0.0 END AS net_rate FROM net LEFT JOIN prev ON net.retailer = prev.retailer)"""


@query("net_change", f"{NET} SELECT * FROM net")
def net_change(spark, d):
    return flows.net_change(transfers(spark, d))


@query("net_change_joined", f"{NET} SELECT retailer, out, in_transfers FROM net")
def net_change_joined(spark, d):
    """The same two sides by a full join with zero fill."""
    rows = trends.transfers_of(periods.latest_month_rows(transfers(spark, d)))
    out = rows.groupBy(F.col(FROM).alias("retailer")).agg(F.sum("stat_value").alias("out"))
    into = rows.filter(F.col(TO).isNotNull()).groupBy(F.col(TO).alias("retailer")).agg(F.sum("stat_value").alias("in_transfers"))
    return joins.full_zero_fill(out, into, ["retailer"], ["out", "in_transfers"])


@query("net_change_rate", f"{NET} SELECT retailer, out, in_transfers, net_absolute, active_nmis, round(net_rate, 6) AS net_rate FROM rate")
def net_change_rate(spark, d):
    return flows.net_change_rate(labelled(spark, d))


# The default base is the month before the latest one. In the test tables the base
# rows end years earlier, so the activity queries take each entity's whole base.
_ACTIVITY = f"""{NET}, whole AS (SELECT {FROM} AS retailer, sum(stat_value) AS active_nmis FROM t WHERE stat_shortcut = 'M71' AND {FROM} NOT LIKE '%2%' GROUP BY 1),
act AS (SELECT retailer, out, in_transfers, net_absolute, CAST(coalesce(active_nmis, 0) AS BIGINT) AS active_nmis,
 CASE WHEN active_nmis > 0 THEN net_absolute / active_nmis * 100 ELSE 0.0 END AS net_rate,
 out + in_transfers AS total_activity, CASE WHEN active_nmis > 0 THEN out / (active_nmis / 100.0) END AS out_rate,
 CASE WHEN active_nmis > 0 THEN in_transfers / (active_nmis / 100.0) END AS in_rate,
 CASE WHEN active_nmis > 0 THEN (out + in_transfers) / (active_nmis / 100.0) END AS total_rate FROM net LEFT JOIN whole USING (retailer) WHERE length(retailer) > 0)"""


def whole_base(facts):
    """Each entity's base over all months; entities with a 2 in their name have none."""
    rows = trends.base_of(facts).filter(~F.col(FROM).contains("2"))
    return rows.groupBy(F.col(FROM).alias("retailer")).agg(F.sum("stat_value").alias("active_nmis"))


@query(
    "net_change_rate_of_base",
    f"{_ACTIVITY} SELECT retailer, out, in_transfers, net_absolute, active_nmis, round(net_rate, 6) AS net_rate FROM act",
)
def net_change_rate_of_base(spark, d):
    facts = transfers(spark, d)
    return flows.net_change_rate(facts, whole_base(facts)).filter("retailer IS NOT NULL")


@query(
    "in_out_activity",
    f"{_ACTIVITY} SELECT retailer, out, in_transfers, total_activity, round(out_rate, 6) AS out_rate, round(in_rate, 6) AS in_rate, round(total_rate, 6) AS total_rate FROM act",
)
def in_out_activity(spark, d):
    facts = transfers(spark, d)
    return flows.in_out_activity(facts, whole_base(facts))


@query(
    "in_out_rates",
    f"{_ACTIVITY} SELECT retailer, active, round(total_rate, 6) AS total_rate, CAST(row_number() OVER (ORDER BY total_rate, retailer) AS INT) AS place FROM (SELECT *, total_activity AS active FROM act) WHERE total_rate IS NOT NULL",
)
def in_out_rates(spark, d):
    """The normalised frame in its own order."""
    facts = transfers(spark, d)
    rows = flows.in_out_rates(facts, whole_base(facts)).select("retailer", F.col("total_activity").alias("active"), "total_rate")
    return topk.order_by_measure(rows, "total_rate", "retailer", "place")


@query(
    "in_out_ordered",
    f"{_ACTIVITY} SELECT retailer, total_activity, CAST(row_number() OVER (ORDER BY total_activity, retailer) AS INT) AS sort_ix FROM act",
)
def in_out_ordered(spark, d):
    facts = transfers(spark, d)
    rows = flows.in_out_activity(facts, whole_base(facts)).select("retailer", "total_activity")
    return topk.order_by_measure(rows, "total_activity", "retailer")


@query("axis_bound", f"{NET} SELECT CAST(ceil(greatest(max(in_transfers), max(out)) / 1000) * 1000 AS BIGINT) AS axis_max FROM net")
def axis_bound(spark, d):
    return flows.axis_bound(flows.net_change(transfers(spark, d)), ["in_transfers", "out"], 1000)


@query(
    "min_group_rows",
    f"""{T}, n AS (SELECT {FROM} AS retailer, count(*) AS c FROM m GROUP BY 1)
SELECT retailer, c AS n FROM n WHERE c >= (SELECT 2000 * count(*) / 60000 FROM lineitem)""",
)
def min_group_rows(spark, d):
    """Entities with enough movements; the threshold grows with the table."""
    rows = trends.transfers_of(transfers(spark, d)).select(F.col(FROM).alias("retailer"))
    least = 2000 * spark.read.parquet(f"{d}/lineitem.parquet").count() / 60000
    return reshape.min_group_size(rows, ["retailer"], least).groupBy("retailer").agg(F.count(F.lit(1)).alias("n"))
