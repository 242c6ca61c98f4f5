import datetime as dt
import statistics

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from switchflow.functions import dates, labels, stats, text
from tests.conftest import rows


def one(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("c"))).collect()]


def test_clean_names():
    assert text.clean_name_list(["ESC RetailerCommonID", "STAT_DATE", "a b", "a-b", "% used", "2nd", ""]) == [
        "esc_retailer_common_id", "stat_date", "a_b", "a_b_2", "percent_used", "x2nd", "x",
    ]


def test_clean_names_avoid_made_up_collisions():
    out = text.clean_name_list(["a", "a_2", "A"])
    assert len(set(out)) == 3 and out[:2] == ["a", "a_2"]


def test_mixed_dates(spark):
    values = ["1/01/2018 0:00", " 2018/02/01 00:00:00 ", "2018-02-01 07:08:09", "31/02/2018 0:00", "", "NA", None, "2018", "7/10/2018 2:30"]
    d = dt.datetime
    assert one(spark, values, text.parse_mixed_ts) == [
        d(2018, 1, 1), d(2018, 2, 1), d(2018, 2, 1, 7, 8, 9), None, None, None, None, None, d(2018, 10, 7, 2, 30),
    ]


def test_dates_do_not_depend_on_the_session_zone(spark):
    """2:30 on this day does not exist in Melbourne; a wall clock keeps it."""
    spark.conf.set("spark.sql.session.timeZone", "Australia/Melbourne")
    try:
        assert one(spark, ["7/10/2018 2:30"], text.parse_mixed_ts) == [dt.datetime(2018, 10, 7, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_lenient_int(spark):
    values = ["1.9", "7d", "1e3", " 7 ", "-1.9", "", None, "99999999999", ".5", "abc", "+4"]
    assert one(spark, values, text.to_int) == [1, None, 1000, 7, -1, None, None, None, 0, None, 4]


def test_bits(spark):
    values = ["Yes", " t ", "TRUE", "1", "y", "f", "No", "0", "n", "false", "x", "", None]
    assert one(spark, values, text.to_bit) == [1, 1, 1, 1, 1, 0, 0, 0, 0, 0, None, None, None]


def test_strip_quotes(spark):
    assert one(spark, ["'a'", '"b', "c"], text.strip_quotes) == ["a", "b", "c"]


def test_financial_year(spark):
    days = [dt.date(2017, 7, 1), dt.date(2018, 6, 30), dt.date(1999, 12, 31), dt.date(2018, 8, 31), dt.date(2019, 3, 31)]
    assert one(spark, days, dates.fin_year, "date") == ["2017-18", "2017-18", "1999-00", "2018-19", "2018-19"]
    assert one(spark, days, dates.fin_quarter, "date") == ["2017-18 Q1", "2017-18 Q4", "1999-00 Q2", "2018-19 Q1", "2018-19 Q3"]
    assert one(spark, ["2017-18 Q1", "2017-18 Q2", "2017-18 Q3"], dates.is_half_year_quarter) == [True, False, True]


def test_mondays(spark):
    days = [dt.date(2022, 1, 3), dt.date(2022, 1, 4), dt.date(2022, 1, 9)]
    assert one(spark, days, dates.first_monday_from, "date") == [dt.date(2022, 1, 3), dt.date(2022, 1, 10), dt.date(2022, 1, 10)]
    assert one(spark, days, dates.week_start, "date") == [dt.date(2022, 1, 3)] * 3


def test_local_now(spark):
    import zoneinfo

    got = spark.range(1).select(dates.local_now()).head()[0]
    want = dt.datetime.now(zoneinfo.ZoneInfo("Australia/Melbourne")).replace(tzinfo=None)
    assert abs((got - want).total_seconds()) < 60 and got.microsecond == 0


def test_price_band_edges(spark):
    lower, mid_low, near, mid_high, upper = labels.BANDS
    values = [10.01, 10.0, 5.01, 5.0, 0.0, -4.99, -5.0, -10.0, -11.0]
    assert one(spark, values, labels.price_band, "double") == [
        upper, mid_high, mid_high, near, near, near, mid_low, lower, lower,
    ]


def test_contract_classes(spark):
    values = [0.0, 0.74, 0.75, 1.25, 1.26]
    assert one(spark, values, labels.contract_class, "double") == [
        "No fixed term", "Short-term / flexible", "1-year typical", "1-year typical", "Longer term (1.5–2 yrs)",
    ]


def test_offer_category(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 1), (None, 1), (1, None)], "d int, c int")
    got = [r[0] for r in df.select(labels.offer_category("d", "c")).collect()]
    assert got == [labels.CONDITIONAL, labels.GUARANTEED, labels.NO_DISCOUNT, "Other", "Other", "Other"]


def test_movement_type_and_size_index(spark):
    df = spark.createDataFrame([("Small", "Large"), ("Large", "Medium"), ("Medium", "Medium"), ("Medium", "Large")], "a string, b string")
    got = [tuple(r) for r in df.select(labels.movement_type("a", "b"), labels.size_index("a"), labels.size_index("b", "to")).collect()]
    assert got == [("Moving Up", 0, 5), ("Moving Down", 2, 4), ("Same Size", 1, 4), ("Moving Up", 1, 5)]
    assert one(spark, ["Huge", None], labels.size_index) == [None, None]


def test_strict_sum_and_total(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2), ("c", None)], "k string, v int")
    got = rows(df.groupBy("k").agg(stats.strict_sum("v").alias("s"), stats.strict_mean("v").alias("m"), stats.total("v").alias("t")))
    assert got == [("a", None, None, 1), ("b", 2, 2.0, 2), ("c", None, None, 0)]


def test_pct(spark):
    df = spark.createDataFrame([("Yes",), ("No",), (None,), ("Yes",)], "c string")
    got = df.agg(stats.pct(F.col("c") == "Yes"), stats.pct_in("c", ["Yes"])).head()
    assert got[0] == pytest.approx(200 / 3) and got[1] == 50.0


@settings(max_examples=12, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e6, 1e6))),
        min_size=1, max_size=60,
    ),
    st.sampled_from([0.5, 0.25, 0.1, 0.9]),
)
def test_exact_quantiles_match_numpy(spark, data, p):
    df = spark.createDataFrame(data, "k string, v double")
    got = {r["k"]: r["q"] for r in stats.exact_quantiles(df, ["k"], "v", {"q": p}).collect()}
    want = {}
    for k in {k for k, _ in data}:
        values = [v for kk, v in data if kk == k and v is not None]
        if values:
            want[k] = float(np.quantile(values, p))
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("limit", [700, 5000, 10**6])
def test_exact_quantiles_with_a_hot_group(spark, limit):
    """Groups cut into pieces give what whole ones do."""
    rng = np.random.default_rng(7)
    hot = rng.gamma(2.0, 50.0, 40_000)
    small = np.round(rng.normal(0, 3, 501))
    df = spark.createDataFrame([("hot", float(v)) for v in hot] + [("small", float(v)) for v in small], "k string, v double").repartition(6)
    probs = {"q1": 0.25, "med": 0.5, "q3": 0.75}
    got = {r["k"]: r for r in stats.exact_quantiles(df, ["k"], "v", probs, rows=limit).collect()}
    for k, values in (("hot", hot), ("small", small)):
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.quantile(values, p), rel=1e-12)
    assert stats.exact_quantiles(df, [], "v", {"m": 0.5}, rows=limit).head()[0] == pytest.approx(
        statistics.median(np.concatenate([hot, small]))
    )


def test_average_rank_both_ways(spark):
    rng = np.random.default_rng(3)
    data = [("a", float(v)) for v in rng.integers(0, 40, 300)] + [("b", 1.0), ("b", None), (None, 2.0), (None, 2.0), (None, 1.0)]
    df = spark.createDataFrame(data, "k string, v double")
    window = rows(stats.average_rank(df, ["k"], "v", "r"))
    assert window == rows(stats.average_rank_large(df, ["k"], "v", "r", rows=8))
    assert window == rows(stats.average_rank_large(df, ["k"], "v", "r"))
    a = sorted(v for k, v in data if k == "a")
    for k, v, r in window:
        if k == "a":
            places = [i + 1 for i, x in enumerate(a) if x == v]
            assert r == sum(places) / len(places)
    assert ("b", None, None) in window and (None, 2.0, 2.5) in window


def test_running_totals_in_one_sort_or_in_pieces(spark):
    from switchflow.operators import running
    from switchflow.session import materialize

    rng = np.random.default_rng(2)
    hot = [("hot", float(v), int(c)) for v, c in zip(rng.permutation(3000), rng.integers(1, 9, 3000))]
    cells = materialize(spark.createDataFrame([*hot, ("hot", None, 4), ("few", 2.0, 3), ("few", 1.0, 1), (None, 5.0, 7)], "k string, v double, c long"))
    whole = running.with_running(cells, ["k"], "v", "c")
    assert rows(whole) == rows(running.with_running(cells, ["k"], "v", "c", rows=40))
    upto, got = 0, {(r.k, r.v): (r._to, r._n) for r in whole.collect()}
    for _, v, c in sorted([*hot, ("hot", -1.0, 4)], key=lambda x: x[1]):
        upto += c
        assert got["hot", None if v < 0 else v] == (upto, 4 + sum(c for *_, c in hot))
    assert got["few", 2.0] == (4, 4) and got[None, 5.0] == (7, 7)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") <= 1
    cuts = F.array(*[F.lit(float(x)) for x in (1, 2, 2, 5)])
    got = spark.createDataFrame([(0.5,), (1.0,), (2.5,), (9.0,), (None,)], "v double").select(running.smaller(cuts, F.col("v")))
    assert [r[0] for r in got.collect()] == [0, 0, 3, 4, 0]


def test_weighted_quantiles_equal_those_of_repeated_values(spark):
    from switchflow.functions import stats

    df = spark.range(900).selectExpr("id % 4 AS k", "CAST((id * 37) % 53 AS DOUBLE) AS v")
    cells = df.groupBy("k", "v").count()
    probs = {"a": 0.1, "m": 0.5, "z": 0.93}
    assert sorted(stats.weighted_quantiles(cells, ["k"], "v", "count", probs).collect()) == sorted(stats.exact_quantiles(df, ["k"], "v", probs).collect())
    assert stats.weighted_quantiles(cells, [], "v", "count", probs).collect() == stats.exact_quantiles(df, [], "v", probs).collect()


def test_scratch_folders_go_with_their_owner(spark):
    import os

    from switchflow.session import materialize, scratch, scratch_path

    with scratch(spark):
        held = materialize(spark.range(3))
        folder = os.path.dirname(held.inputFiles()[0].removeprefix("file://"))
        assert held.count() == 3 and os.path.isdir(folder)
    assert not os.path.exists(folder)
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_running_totals_cut_only_the_large_groups(spark):
    from switchflow.operators import running
    from switchflow.session import materialize

    rng = np.random.default_rng(5)
    hot = [("hot", float(v), int(c)) for v, c in zip(rng.permutation(300), rng.integers(1, 9, 300))]
    cold = [(f"c{i % 7}", float(i), 1 + i % 3) for i in range(60)]
    cells = materialize(spark.createDataFrame([*hot, *cold, (None, 1.0, 2), (None, 3.0, 5)], "k string, v double, c long"))
    cut = running.with_running(cells, ["k"], "v", "c", rows=40)
    assert rows(cut) == rows(running.with_running(cells, ["k"], "v", "c"))
    got = {(r.k, r.v): (r._to, r._n) for r in cut.collect()}
    assert got[None, 3.0] == (7, 7) and got["c0", 56.0] == (sum(1 + i % 3 for i in range(0, 57, 7)),) * 2
    # The groups within the bound are ordered in one sort, apart from the cut ones.
    assert "LeftAnti" in cut._jdf.queryExecution().executedPlan().toString()


def test_quantiles_order_only_the_rows_near_them(spark):
    """Even, crowded, equal and infinite values; null keys; the rest of the rows only counted."""
    from switchflow.functions import stats
    from switchflow.operators import running
    from switchflow.session import materialize

    rng = np.random.default_rng(8)
    inf = float("inf")
    data = [("even", float(v), 1 + v % 3) for v in range(2000)] + [("even", float(v), 2) for v in range(0, 2000, 7)]
    data += [("crowded", 1e9, 1), *[("crowded", float(v), 1) for v in rng.normal(0, 1, 900)], ("wide", -1e308, 3), ("wide", 1e308, 2), ("wide", 5.0, 1)]
    data += [("equal", 4.0, 9), ("ends", -inf, 1), *[("ends", float(v), 1) for v in range(10)], ("ends", inf, 1), (None, 3.0, 2), (None, 8.0, 2), (None, None, 9), ("gone", float("nan"), 1)]
    cells = materialize(spark.createDataFrame([(k, v, int(c)) for k, v, c in data], "k string, v double, c long"))
    probs = {"a": 0.1, "m": 0.5, "z": 0.93}
    plain = rows(stats.weighted_quantiles(cells, ["k"], "v", "c", probs))
    assert rows(stats.weighted_quantiles(cells, ["k"], "v", "c", probs, rows=1000, written=True)) == plain
    assert rows(stats.weighted_quantiles(cells, ["k"], "v", "c", probs, rows=40)) == plain
    long = {}
    for k, v, c in data:
        if v is not None and v == v:
            long.setdefault(k, []).extend([v] * int(c))
    assert len(plain) == 6
    for k, *got in plain:
        if k not in ("ends", "wide"):
            assert np.allclose(got, np.quantile(long[k], list(probs.values())))
    whole = stats.weighted_quantiles(cells, [], "v", "c", probs)
    assert whole.collect() == stats.weighted_quantiles(cells, [], "v", "c", probs, rows=50, written=True).collect()
    known = materialize(cells.filter("v IS NOT NULL AND NOT isnan(v)"))
    near = running.around_ranks(known, ["k"], "v", "c", [F.floor((F.col("_n") - 1) * 0.5) + 1])
    assert near.filter("k = 'even'").count() < 10 and near.filter("k = 'even' AND _to >= _n / 2 AND _to - c < _n / 2").count() == 1


def test_quantiles_of_more_groups_than_a_histogram_has_room_for(spark, monkeypatch):
    from switchflow.functions import stats
    from switchflow.operators import running
    from switchflow.session import materialize

    cells = materialize(spark.range(900).selectExpr("id % 90 AS k", "CAST((id * 37) % 53 AS DOUBLE) AS v", "id % 3 + 1 AS c"))
    plain = rows(stats.weighted_quantiles(cells, ["k"], "v", "c", {"m": 0.5}))
    monkeypatch.setattr(running, "HISTOGRAM", 256)
    assert rows(stats.weighted_quantiles(cells, ["k"], "v", "c", {"m": 0.5}, rows=20, written=True)) == plain and len(plain) == 90
