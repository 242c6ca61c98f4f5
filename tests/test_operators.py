import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalog import offer_queries
from catalog.registry import END, START, labelled, transfers
from switchflow.functions.labels import BASELINE_BAND, BANDS
from switchflow.operators import bands, conform, describe, flows, joins, lookups, offers, periods, quality, reshape, study, topk, trends
from switchflow.plans.monthly import report
from switchflow.schema import STAGING
from tests.conftest import rows

D = dt.date


def facts(spark, data):
    """data: date, code, value, from, to, from size, to size, type."""
    df = spark.createDataFrame(
        data,
        "stat_date date, stat_shortcut string, stat_value int, FRMP_Retailer_name string, NEWFRMP_Retailer_name string, "
        "FRMP_Retailer_size string, NEWFRMP_Retailer_size string, transfer_type string",
    )
    from switchflow.functions.dates import year_month
    from switchflow.sources.frames import with_calendar

    return with_calendar(df).withColumn("YearMonth", year_month("stat_date"))


MOVES = [
    (D(2025, 9, 30), "M71", 1000, "A", None, "Small", None, None),
    (D(2025, 9, 30), "M71", 500, "B", None, "Large", None, None),
    (D(2025, 10, 1), "M57A", 10, "A", "B", "Small", "Large", "Move-in"),
    (D(2025, 10, 31), "M57A", 5, "A", "C", "Small", "Medium", "Other"),
    (D(2025, 10, 31), "M57A", 3, "B", "A", "Large", "Small", None),
    (D(2025, 10, 31), "M57A", 2, None, "A", None, "Small", "Other"),
    (D(2025, 10, 31), "M57A", 4, "B", None, "Large", None, "Other"),
    (D(2025, 10, 31), "M57A", None, "C", "B", "Medium", "Large", "Other"),
    (D(2024, 10, 31), "M57A", 7, "A", "B", "Small", "Large", "Move-in"),
    (D(2024, 10, 30), "M57A", 9, "A", "B", "Small", "Large", "Move-in"),
]


def test_total_is_the_sum_of_its_parts(spark, sf):
    for grain, keys in (("month", ["YearMonth"]), ("quarter", ["FinYearQuarter"]), ("finyear", ["FinYear"])):
        out = trends.trend(transfers(spark, sf), grain)
        parts = out.filter("NOT is_total").groupBy(*keys).agg(F.sum("transfers").alias("parts"))
        wrong = out.filter("is_total").join(parts, keys).filter("parts <> transfers")
        assert wrong.isEmpty()


def test_total_row_differs_from_a_null_or_total_category(spark):
    df = facts(spark, [(D(2025, 1, 1), "M57A", 1, "x", "y", size, None, None) for size in ("Total", None, "Small")])
    got = rows(trends.trend(df, "finyear").select("FRMP_Retailer_size", "transfers", "is_total"))
    assert got == [(None, 1, False), ("Small", 1, False), ("Total", 1, False), ("Total", 3, True)]


def test_trend_reads_the_facts_once(spark, sf):
    plan = trends.trend_all_grains(transfers(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1


def test_unused_columns_and_the_other_measure_are_not_read(spark, sf):
    plan = trends.trend(transfers(spark, sf), "month")._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan
    for column in ("l_extendedprice", "l_returnflag", "s_name", "c_name"):
        assert column not in plan


def test_latest_month_is_found_in_one_pass(spark, sf):
    """Year and month are two scalars of one aggregate; Spark merges them."""
    plan = periods.latest_month_rows(transfers(spark, sf))._jdf.queryExecution().optimizedPlan().toString()
    assert "mergedValue" in plan


def test_shares_sum_to_100(spark, sf):
    out = trends.share_of_total(transfers(spark, sf), "month").groupBy("YearMonth").agg(F.sum("pct").alias("p"))
    assert out.filter("abs(p - 100) > 1e-9").isEmpty()


def test_latest_month_and_change(spark):
    df = facts(spark, MOVES)
    assert rows(periods.flag_latest_month(df).filter("is_latest_month").select("stat_date").distinct()) == [(D(2025, 10, 1),), (D(2025, 10, 31),)]
    got = periods.latest_change(df).head()
    assert (got["month"], got["transfers"], got["previous"], got["pct_change"], got["direction"]) == (D(2025, 10, 1), 24, 16, 50.0, "increase")
    assert tuple(periods.previous_period(df).head()) == ("2025-09", "2025-10")


def test_latest_change_of_a_single_month(spark):
    got = periods.latest_change(facts(spark, MOVES[2:3])).head()
    assert got["transfers"] == 10 and got["previous"] is None and got["direction"] is None


def test_trailing_year_is_inclusive_and_clamped(spark):
    df = facts(spark, MOVES)
    assert D(2024, 10, 31) in {r[0] for r in periods.last_12_months(df).select("stat_date").collect()}
    assert D(2024, 10, 30) not in {r[0] for r in periods.last_12_months(df).select("stat_date").collect()}
    leap = facts(spark, [(d, "M57A", 1, "A", "B", None, None, None) for d in (D(2024, 2, 29), D(2023, 2, 28), D(2023, 2, 27))])
    assert {r[0] for r in periods.last_12_months(leap).select("stat_date").collect()} == {D(2024, 2, 29), D(2023, 2, 28)}


def test_latest_per_key_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, None, "d"), (3, 1, "e")], "k int, t int, x string")
    assert rows(periods.latest_per_key(df, "k", "t")) == [(1, 5, "a"), (1, 5, "b"), (3, 1, "e")]


def test_top_k_ties_go_by_name(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "n string, v int")
    assert [r[0] for r in topk.top_k(df, "n", 2, "v").orderBy(F.desc("total"), "n").collect()] == ["c", "a"]


def test_flows_take_one_day_by_default(spark):
    df = facts(spark, MOVES)
    assert rows(flows.flows(df).select("FRMP_Retailer_name", "NEWFRMP_Retailer_name", "transfers")) == [("A", "C", 5), ("B", "A", 3), ("C", "B", 0)]
    month = flows.flows(df, "latest_month").agg(F.sum("transfers")).head()[0]
    assert month == 18


def test_node_and_link_tables_agree(spark, sf):
    edges = flows.flows(transfers(spark, sf), "latest_month")
    for side in ("from", "to"):
        nodes, links = flows.flow_graph(edges, side, 5)
        index = {r["index"]: r for r in nodes.collect()}
        assert sorted(index) == list(range(len(index)))
        got = links.collect()
        assert len(got) == flows.top_flows(edges, side, 5).count()
        for r in got:
            assert index[r["source"]]["label"] == r["from_label"] and index[r["target"]]["label"] == r["to_label"]
            assert 0.2 <= r["opacity"] <= 1.0


def test_net_change(spark):
    got = rows(flows.net_change(facts(spark, MOVES)))
    assert got == [(None, 2, 0, -2.0), ("A", 15, 5, -10.0), ("B", 7, 10, 3.0), ("C", 0, 5, 5.0)]


def test_in_equals_out_over_known_ends(spark, sf):
    df = transfers(spark, sf)
    known = df.filter("FRMP_Retailer_name IS NOT NULL AND NEWFRMP_Retailer_name IS NOT NULL")
    sums = flows.net_change(known).agg(F.sum("in_transfers"), F.sum("out")).head()
    assert sums[0] == sums[1] > 0


def test_rates_use_the_previous_base(spark):
    got = {r["retailer"]: (r["active_nmis"], r["net_rate"]) for r in flows.net_change_rate(facts(spark, MOVES)).collect()}
    assert got == {None: (0, 0.0), "A": (1000, -1.0), "B": (500, 0.6), "C": (0, 0.0)}
    act = rows(flows.in_out_activity(facts(spark, MOVES)).select("retailer", "total_activity", "out_rate", "in_rate"))
    assert act == [("A", 20, 1.5, 0.5), ("B", 17, 1.4, 2.0), ("C", 5, None, None)]
    assert [r["retailer"] for r in flows.in_out_rates(facts(spark, MOVES)).collect()] == ["A", "B"]


def test_size_flows_fall_back_to_the_last_day(spark):
    df = facts(spark, MOVES)
    assert flows.size_flows(df, "1900-01").isEmpty()
    got = rows(flows.size_flows(df, "1900-01", fallback=True).select("stat_date", "FRMP_Retailer_size", "transfers"))
    assert got == [(D(2025, 10, 31), "Large", 3), (D(2025, 10, 31), "Medium", 0), (D(2025, 10, 31), "Small", 5)]


def test_matrix_wide_and_long_agree(spark):
    edges = spark.createDataFrame([("a", "x y", 1), ("a", "b.c", 2), ("b", "x y", 4)], "f string, t string, v int")
    wide = reshape.flow_matrix(edges, "f", "t", "v")
    assert wide.columns == ["f", "b.c", "x y", "Total Out"]
    assert rows(wide) == [("Total In", 2, 5, 7), ("a", 2, 1, 3), ("b", 0, 4, 4)]
    long = {(r[0], r[1]): r[2] for r in reshape.flow_matrix_long(edges, "f", "t", "v").collect()}
    for r in wide.collect():
        for c in wide.columns[1:]:
            assert long.get((r[0], c), 0) == r[c]
    shade = rows(reshape.with_intensity(reshape.flow_matrix_long(edges, "f", "t", "v"), "v").filter("NOT is_total").select("v", "intensity"))
    assert shade == [(1, 0.25), (2, 0.5), (4, 1.0)]


def test_matrix_totals_last(spark):
    edges = spark.createDataFrame([("b", "x", 1), ("z", "x", 2)], "f string, t string, v int")
    out = topk.order_with_totals_last(reshape.flow_matrix(edges, "f", "t", "v"), "f", ["Total In"])
    assert [r[0] for r in out.collect()] == ["b", "z", "Total In"]


def test_positions_number_every_row_once(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), "id").repartition(5)
    got = topk.positions(df, ["a", "id"], "ix").orderBy("a", "id").collect()
    assert [r["ix"] for r in got] == list(range(1000))


def test_first_by_key_and_group_size(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z"), (None, 3, "w")], "k string, o int, v string")
    assert rows(reshape.first_by_key(df, "k", ["o"])) == [(None, 3, "w"), ("a", 1, "y")]
    assert reshape.min_group_size(df.unionAll(df.limit(1)), ["k"], 3).count() == 3
    assert reshape.min_group_size(df, ["k"], 2).count() == 4


def test_null_keys_match(spark):
    a = spark.createDataFrame([(1, None), (1, "x")], "k int, n string")
    b = spark.createDataFrame([(1, None, 5), (2, "x", 6)], "k int, n string, v int")
    assert rows(joins.left_join_nullsafe(a, b, ["k", "n"])) == [(1, None, 5), (1, "x", None)]


def test_full_zero_fill(spark):
    a = spark.createDataFrame([("x", 1)], "k string, p int")
    b = spark.createDataFrame([("y", 2)], "k string, q int")
    assert rows(joins.full_zero_fill(a, b, ["k"], ["p", "q"])) == [("x", 1, 0), ("y", 0, 2)]


def test_interval_explode_equals_the_range_join(spark, sf):
    prepared = offer_queries.prepared(spark, sf)
    fast = joins.active_on(prepared, START, END)
    weeks = spark.sql(f"SELECT explode(sequence(DATE '{START}', DATE '{END}', INTERVAL 7 DAYS)) AS date")
    slow = weeks.join(prepared, (prepared.start_date <= weeks.date) & (prepared.end_date.isNull() | (prepared.end_date >= weeks.date)))
    cols = ["date", "offer_id", "retailer", "total_bill_pre_transaction"]
    assert fast.count() == slow.count()
    assert fast.select(*cols).exceptAll(slow.select(*cols)).isEmpty()
    assert "NestedLoop" not in offers.offer_snapshots(prepared, START, END)._jdf.queryExecution().executedPlan().toString()


def test_the_sweep_equals_the_rows_of_every_week(spark):
    """Open and closed, touching, empty and unknown intervals, with nulls among what is summed."""
    import random

    rng = random.Random(6)
    day = lambda n: D(2022, 1, 1) + dt.timedelta(days=n)
    data = [(rng.choice("ab") if rng.random() < 0.9 else None, day(rng.randint(-50, 200)) if rng.random() < 0.95 else None, day(rng.randint(-60, 260)) if rng.random() < 0.7 else None,
             rng.choice([None, 0.1, 0.2, 1e6])) for _ in range(400)]
    intervals = spark.createDataFrame(data, "k string, start_date date, end_date date, v double")
    swept = joins.active_sums(intervals, "2022-01-03", "2022-06-30", ["k"], {"v": F.col("v")})
    long = joins.active_on(intervals, "2022-01-03", "2022-06-30").groupBy("date", "k").agg(F.count("*").alias("n"), F.coalesce(F.sum("v"), F.lit(0.0)).alias("v"))
    near = lambda df: rows(df.select("date", "k", "n", F.round("v", 6).alias("v")))
    assert near(swept) == near(long) and swept.count() > 40



def test_active_sums_add_counts_in_longs(spark):
    """Whole-number sums need no decimals; they stay exact, the others keep their decimals."""
    import re

    D2 = dt.date
    data = [("a", D2(2022, 1, 3), D2(2022, 1, 20), 1, 0.1), ("a", D2(2022, 1, 10), None, 0, None), ("b", None, None, 1, 2.0), (None, D2(2022, 1, 4), D2(2022, 1, 5), None, 0.2)]
    intervals = spark.createDataFrame(data, "k string, start_date date, end_date date, yes int, v double")
    swept = joins.active_sums(intervals, "2022-01-03", "2022-01-31", ["k"], {"yes": F.col("yes"), "big": F.col("yes").cast("long") * 10**17, "v": F.col("v")})
    assert dict(swept.dtypes)["yes"] == "double" and swept.filter("k = 'a' AND date = '2022-01-10'").select("n", "yes", "big", "v").first() == (2, 1.0, 1e17, 0.1)
    plan = swept._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal(28,10)" in plan and not re.search(r"cast\(yes#\d+ as decimal", plan)

def test_no_cartesian_products_in_the_study(spark, sf):
    plan = offer_queries.data(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


OFFERS = [
    # id, retailer, seen, start, price, discount, conditional, term, solar, incentive, fee, late, size
    (1, "A", D(2022, 1, 20), D(2022, 1, 1), 100.0, 1, 0, "1 year", "Yes", "Yes", 10.0, None, "Small"),
    (1, "A", D(2022, 1, 10), D(2022, 1, 1), 999.0, 1, 0, "1 year", "Yes", "Yes", 10.0, None, "Small"),
    (2, "A", D(2022, 2, 20), D(2022, 1, 11), 200.0, 0, 0, None, None, None, 20.0, 5.0, "Small"),
    (3, "B", D(2022, 2, 20), D(2022, 1, 3), 300.0, 1, 1, "2 year", "No", "No", None, 7.0, "Large"),
]
OFFER_SCHEMA = (
    "offer_id int, retailer string, identifier_date date, start_date date, total_bill_pre_transaction double, has_discount int, "
    "has_disc_conditional int, contract_term string, solar_offer string, has_incentive string, total_annual_fee double, "
    "total_late_payment_fee double, cprg_retailer_size string"
)


def test_snapshots_by_hand(spark):
    prepared = offers.prepare_offers(spark.createDataFrame(OFFERS, OFFER_SCHEMA))
    ends = {r["offer_id"]: r["end_date"] for r in prepared.collect()}
    assert ends == {1: D(2022, 1, 31), 2: None, 3: None}
    snap = {(r["date"], r["retailer"]): r for r in offers.offer_snapshots(prepared, "2022-01-03", "2022-02-14").collect()}
    assert len(snap) == 14
    first = snap[D(2022, 1, 3), "A"]
    assert (first["n_offers"], first["median_price"], first["vic_median"], first["price_vs_market"]) == (1, 100.0, 200.0, -50.0)
    both = snap[D(2022, 1, 17), "A"]
    assert (both["n_offers"], both["median_price"], both["min_price"], both["max_price"], both["vic_median"]) == (2, 150.0, 100.0, 200.0, 200.0)
    assert (both["pct_guaranteed_discount"], both["pct_solar_available"], both["pct_with_incentive"], both["avg_contract_term"]) == (50.0, 50.0, 100.0, 0.5)
    assert (both["avg_late_fee"], both["is_above_market"], both["price_competitiveness_rank"]) == (5.0, False, 1.0)
    assert snap[D(2022, 2, 7), "A"]["n_offers"] == 1
    empty = offers.offer_snapshots(prepared.filter("retailer = 'B'"), "2021-12-20", "2022-01-03").filter("date < '2022-01-03'").collect()
    assert [(r["n_offers"], r["median_price"], r["vic_median"], r["price_competitiveness_rank"]) for r in empty] == [(0, None, None, None)] * 2


def test_the_last_sighting_is_found_by_a_scan(spark):
    prepared = offers.prepare_offers(spark.createDataFrame(OFFERS, OFFER_SCHEMA))
    assert prepared._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 1
    texts = spark.createDataFrame(OFFERS, OFFER_SCHEMA).withColumn("identifier_date", F.col("identifier_date").cast("string"))
    assert rows(offers.prepare_offers(texts)) == rows(prepared)
    unseen = offers.prepare_offers(spark.createDataFrame([(7, "A", None, *OFFERS[0][3:])], OFFER_SCHEMA))
    assert unseen.isEmpty()


def test_snapshots_equal_those_of_the_rows_of_every_week(spark):
    """Prices repeat and are null, as are retailers and sizes; a retailer has several sizes."""
    import random

    rng = random.Random(11)
    some = lambda *values: rng.choice(values)
    day = lambda n: D(2022, 1, 1) + dt.timedelta(days=n)
    data = [
        (i, some("A", "B", "C", None), day(rng.randint(20, 90)), day(rng.randint(-20, 60)), some(None, 50.0, 60.0, 70.5, float(i)), some(0, 1, None), some(0, 1), some("1 year", "2 year", None),
         some("Yes", "No", None), some("Yes", "No", None), some(None, 10.5, 20.25), some(None, 5.0), some("Small", "Large", None))
        for i in range(200)
    ]
    prepared = offers.prepare_offers(spark.createDataFrame(data, OFFER_SCHEMA))
    cells = offers.price_cells(prepared, "2022-01-03", "2022-03-28")
    assert cells.columns == ["date", "retailer", offers.PRICE, "n_offers"]
    assert offers.offer_sums(prepared, "2022-01-03", "2022-03-28").count() < cells.count()
    active = joins.active_on(prepared, "2022-01-03", "2022-03-28").filter("retailer IS NOT NULL")
    yes = lambda c: f"avg(CAST({c} AS DOUBLE)) * 100"
    kind = "offer_category = 'Market offers with\nguaranteed discounts'"
    wanted = active.groupBy("date", "retailer").agg(
        F.count("*"), F.round(F.expr(f"median({offers.PRICE})"), 6), F.min(offers.PRICE), F.max(offers.PRICE), F.round(F.expr(yes(kind)), 6),
        F.round(F.expr("avg(CASE contract_term WHEN '1 year' THEN 1.0D WHEN '2 year' THEN 2.0D ELSE 0.0D END)"), 6), F.round(F.expr(yes("has_incentive = 'Yes'")), 6),
        F.round(F.avg("total_annual_fee"), 6), F.round(F.avg("total_late_payment_fee"), 6), F.min("cprg_retailer_size"),
    )
    got = offers.offer_snapshots(prepared, "2022-01-03", "2022-03-28").filter("n_offers > 0").select(
        "date", "retailer", "n_offers", F.round("median_price", 6), "min_price", "max_price", F.round("pct_guaranteed_discount", 6), F.round("avg_contract_term", 6),
        F.round("pct_with_incentive", 6), F.round("avg_annual_fee", 6), F.round("avg_late_fee", 6), "cprg_retailer_size",
    )
    assert rows(got) == rows(wanted) and got.count() > 25


def test_the_study_joins_its_facts_once(spark, sf):
    """Weekly rows are written: their number per entity is not counted from the facts again."""
    plan = offer_queries.data(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan and plan.count("orders.parquet") == 1


def study_frames(spark):
    daily = spark.createDataFrame(
        [
            (D(2022, 1, 31), 2022, 1, 10, "A", "B", "1000"), (D(2022, 2, 1), 2022, 2, 20, "A", "B", "1000"),
            (D(2022, 2, 1), 2022, 2, 40, "A", "B", "1010"), (D(2022, 2, 8), 2022, 2, None, "A", "B", "1000"),
            (D(2022, 2, 8), 2022, 2, 5, None, "B", "1000"),
        ],
        "transfer_date date, Year int, Month int, transfers_count int, from_retailer string, to_retailer string, reason_code string",
    )
    base = spark.createDataFrame([(2022, 1, "A", 1000), (2022, 2, "A", 0), (2022, 2, None, 50)], "Year int, Month int, retailer string, customer_count long")
    return study.weekly_transfers(daily), base


def test_weekly_rates(spark):
    weekly, base = study_frames(spark)
    got = rows(study.transfer_rates(weekly, base).select("date", "Month", "retailer", "total_transfers_out", "avg_daily_transfers", "transfer_rate"))
    assert got == [
        (D(2022, 1, 31), 1, "A", 10, 10.0, 1.0),
        (D(2022, 1, 31), 2, "A", 60, 30.0, None),
        (D(2022, 2, 7), 2, None, 5, 5.0, 10.0),
        (D(2022, 2, 7), 2, "A", None, None, None),
    ]


def test_split_weeks_multiply_only_when_asked(spark):
    weekly, base = study_frames(spark)
    snaps = offers.offer_snapshots(offers.prepare_offers(spark.createDataFrame(OFFERS, OFFER_SCHEMA)), "2022-01-03", "2022-02-14")
    plain = study.analysis_dataset(weekly, base, snaps, min_rows=1)
    assert plain.count() == 4
    row = plain.filter("Month = 1").head()
    assert (row["n_offers"], row["n_offers_lag2w"], row["n_offers_lag4w"], row["n_offers_lag8w"]) == (2, 2, 1, None)
    fan = study.analysis_dataset(weekly, base, snaps, min_rows=1, faithful_fanout=True)
    assert fan.filter("date = '2022-01-31'").count() == 32 and fan.filter("date = '2022-02-07'").count() == 2
    assert study.analysis_dataset(weekly, base, snaps, min_rows=5, faithful_fanout=True).count() == 33
    assert study.analysis_dataset(weekly, base, snaps, min_rows=4).isEmpty()


def test_bands_and_missing_baseline(spark):
    df = spark.createDataFrame(
        [("x", 11.0, 5.0, 1.0), ("x", 0.0, -20.0, 3.0), ("x", -0.5, -20.0, None), ("x", None, 12.0, 7.0)],
        "retailer string, price_vs_market double, price_vs_market_lag2w double, transfer_rate double",
    )
    seg = bands.segment_all_lags(df, lags=(0, 2))
    got = rows(seg.select("lag_weeks", "band_ix", "avg_value", "median_value", "n_retailer_weeks"))
    assert got == [(0, 3, 3.0, 3.0, 2), (0, 5, 1.0, 1.0, 1), (2, 1, 3.0, 3.0, 2), (2, 3, 1.0, 1.0, 1), (2, 5, 7.0, 7.0, 1)]
    lonely = bands.vs_baseline(seg.filter(F.col("price_group") != BASELINE_BAND))
    assert {r["difference_from_baseline"] for r in lonely.collect()} == {None}
    first = bands.strongest_lag(bands.vs_baseline(seg)).collect()
    assert [(r["difference_from_baseline"]) for r in first] == [6.0, -2.0]
    one = bands.segment_by_band(df, "price_vs_market", lag_label="x")
    assert {r["price_group"] for r in one.collect()} == {BANDS[2], BANDS[4]}


def test_buckets_round_half_to_even(spark):
    df = spark.createDataFrame([(v, 1.0) for v in (5.0, -1.0, 1.0, 3.0, 20.0, 20.5)], "price_vs_market double, transfer_rate double")
    got = rows(bands.threshold_curve(df, min_rows=1))
    assert [(b, n) for b, _, n in got] == [(0.0, 2), (4.0, 2), (20.0, 1)]
    assert rows(bands.threshold_curve(df, min_rows=2))[0][0] == 0.0


def test_describe(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, 3.0)], "a double, b double")
    got = {r["variable"]: tuple(r)[1:] for r in describe.describe_columns(df, ["a", "b"]).collect()}
    assert got["a"] == (1.0, 1.5, 2.0, pytest.approx(7 / 3), 3.0, 4.0, 0) and got["b"] == (3.0, 3.0, 3.0, 3.0, 3.0, 3.0, 2)


def test_conform_fixes_the_schema(spark):
    raw = spark.createDataFrame([("1.9", "1/01/2018 0:00", "Yes", "gone")], "ID_MTS2 string, `STAT DATE` string, MDP string, Extra string")
    got = conform.conform(raw)
    assert got.schema.names == STAGING.names and [f.dataType for f in got.schema] == [f.dataType for f in STAGING]
    row = got.head()
    assert (row["id_mts2"], row["stat_date"], row["mdp"], row["frmp"]) == (1, dt.datetime(2018, 1, 1), 1, None)
    with pytest.raises(ValueError, match="nope"):
        conform.require_columns(raw, ["MDP", "nope"])


LOOKUP = [("P1", "P1", "L1"), (" P2 ", "C2", None), ("", " ", "L3"), (None, "C4", "L4"), ("P2", None, "L9")]


def test_entity_lookup(spark):
    df = spark.createDataFrame(LOOKUP, "PARTICIPANTID string, CORPORATIONID string, `ESC RetailerCommonID` string")
    assert rows(lookups.build_entity_lookup(df)) == [("C2", None), ("C4", "L4"), ("P1", "L1"), ("P2", None), ("P2", "L9")]
    with pytest.raises(ValueError):
        lookups.build_entity_lookup(df.drop("CORPORATIONID"))


def test_enrich_refuses_an_ambiguous_lookup(spark):
    moves = spark.createDataFrame([("P1", "P2", "1000"), (None, "P9", "1")], "frmp string, newfrmp string, crcode string")
    codes = spark.createDataFrame([("1000", "Change Retailer")], "crc_code string, reporting_group string")
    people = spark.createDataFrame([("P1", "L1", "One", "Small"), ("P2", "L2", "Two", "Large")], "id string, licence_common_id string, retailer_name string, retailer_size string")
    got = rows(joins.enrich(moves, people, codes).select("FRMP_Retailer_name", "NEWFRMP_Retailer_size", "transfer_type"))
    assert got == [(None, None, None), ("One", "Large", "Change Retailer")]
    doubled = people.union(spark.createDataFrame([("P1", "L7", "Uno", "Small")], people.schema))
    with pytest.raises(Exception, match="several rows"):
        joins.enrich(moves, doubled, codes).collect()


def ids(spark, data):
    return spark.createDataFrame(data, "stat_shortcut string, nmiclasscode string, frmp string, newfrmp string")


def test_id_gate(spark, tmp_path):
    lookup = spark.createDataFrame([(" P1 ", "L"), ("P2", None), ("", "L")], "id string, licence_common_id string")
    good = [("M57A", "SMALL", "P1", "P2"), ("M57A", "SMALL", " P2", ""), ("M71", "SMALL", "P1", "ZZ"), ("M57A", "LARGE", "ZZ", "ZZ"), ("M99", "SMALL", "ZZ", None)]
    quality.assert_ids(ids(spark, good), lookup)
    assert quality.missing_ids(ids(spark, good), lookup).isEmpty()
    bad = good + [("M57A", "SMALL", "X1", "X2"), ("M71", "SMALL", "X1", None)]
    assert rows(quality.missing_ids(ids(spark, bad), lookup)) == [("M57A", "FRMP", "X1"), ("M57A", "NEWFRMP", "X2"), ("M71", "FRMP", "X1")]
    with pytest.raises(quality.ValidationError):
        quality.assert_ids(ids(spark, bad), lookup, str(tmp_path / "missing"))
    assert spark.read.csv(str(tmp_path / "missing"), header=True).count() == 3
    blank = good + [("M71", "SMALL", " ", None)]
    assert quality.missing_ids(ids(spark, blank), lookup).isEmpty()
    with pytest.raises(quality.ValidationError):
        quality.assert_ids(ids(spark, blank), lookup)
    with pytest.raises(ValueError, match="nmiclasscode"):
        quality.missing_ids(ids(spark, good).drop("nmiclasscode"), lookup)


def test_report_has_every_frame(spark, sf):
    out = report(labelled(spark, sf))
    for name, frame in out.items():
        assert frame.columns, name
    assert out["size_summary"].agg(F.sum("total")).head()[0] > 0
