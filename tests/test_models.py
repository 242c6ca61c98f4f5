import numpy as np
import pytest
from pyspark.sql import functions as F

from switchflow.functions import special
from switchflow.operators import forest, models, moments, topk
from tests.conftest import rows


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(11)
    n = 400
    a, b, c = rng.normal(0, 2, n), rng.normal(1, 1, n), rng.normal(0, 1, n)
    y = 2 * a - 3 * b + 5 + rng.normal(0, 0.5, n)
    data = np.column_stack([a, b, c, 2 * a, y])
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], "a double, b double, c double, a2 double, y double")
    return df.cache(), data


def lstsq(x, y):
    design = np.column_stack([np.ones(len(y)), *x])
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    rss = float(((y - design @ beta) ** 2).sum())
    cov = rss / (len(y) - design.shape[1]) * np.linalg.inv(design.T @ design)
    return beta, np.sqrt(np.diag(cov)), rss


def test_ols_matches_numpy(spark, sample):
    df, m = sample
    fit = models.ols(df, "y", ["a", "b", "c"])
    beta, se, rss = lstsq([m[:, 0], m[:, 1], m[:, 2]], m[:, 4])
    table = {r["variable"]: r for r in models.ols_table(spark, fit).collect()}
    for i, name in enumerate("abc", start=1):
        assert table[name]["coefficient"] == pytest.approx(beta[i], rel=1e-6, abs=1e-9)
        assert table[name]["std_error"] == pytest.approx(se[i], rel=1e-6)
        assert table[name]["t_value"] == pytest.approx(beta[i] / se[i], rel=1e-5, abs=1e-6)
    assert table["a"]["significant"] == "YES" and table["b"]["direction"] == "Negative (-)"
    assert [r["variable"] for r in models.top_significant(models.ols_table(spark, fit), 2).collect()] and fit.rss == pytest.approx(rss, rel=1e-6)
    tss = float(((m[:, 4] - m[:, 4].mean()) ** 2).sum())
    q = models.fit_quality(spark, fit).head()
    assert q["r_squared"] == pytest.approx(1 - rss / tss) and q["n"] == 400
    assert q["adj_r_squared"] == pytest.approx(1 - (rss / 396) / (tss / 399))


def test_collinear_and_constant_terms_are_dropped(spark, sample):
    df, _ = sample
    fit = models.ols(df.withColumn("k", F.lit(1.0)), "y", ["a", "a2", "k", "b"])
    assert fit.terms == ["a", "b"] and fit.dropped == ["a2", "k"]
    assert list(fit.coefficients) == pytest.approx([2, -3], abs=0.1)
    assert fit.intercept == pytest.approx(5, abs=0.15)


def test_vif(spark, sample):
    df, m = sample
    near = df.withColumn("n", F.col("a") + 0.1 * F.col("c"))
    got = {r["variable"]: r for r in models.vif(spark, near, ["a", "b", "n"], "y").collect()}
    x = np.column_stack([m[:, 0], m[:, 1], m[:, 0] + 0.1 * m[:, 2]])
    want = np.diag(np.linalg.inv(np.corrcoef(x, rowvar=False)))
    assert [got[v]["vif"] for v in ("a", "b", "n")] == pytest.approx(list(want), rel=1e-6)
    assert got["a"]["high"] and not got["b"]["moderate"]


def test_terms():
    assert models.expand_terms(["p*q", "p*r", "q*p", "s"]) == ["p", "q", "r", "s", "p:q", "p:r"]
    assert len(models.expand_terms(models.INTERACTIONS)) == 11


def test_polynomial_and_nested_comparison(spark, sample):
    df, m = sample
    small = models.ols(df, "y", ["a"])
    large = models.ols(df, "y", ["a", "b", "b^2", "a*c"])
    assert large.terms == ["a", "b", "b^2", "c", "a:c"]
    got = models.compare_nested(spark, small, large).head()
    _, _, rss1 = lstsq([m[:, 0]], m[:, 4])
    _, _, rss2 = lstsq([m[:, 0], m[:, 1], m[:, 1] ** 2, m[:, 2], m[:, 0] * m[:, 2]], m[:, 4])
    assert (got["residual_df_1"], got["residual_df_2"], got["df"]) == (398, 394, 4)
    assert got["f_value"] == pytest.approx((rss1 - rss2) / 4 / (rss2 / 394), rel=1e-4)


def test_one_scan_for_all_formulas(spark, sample, monkeypatch):
    """Every formula from one table is what it is from a table of its own, on its own complete rows."""
    df, _ = sample
    holes = df.withColumn("b", F.when(F.col("a") < 2, F.col("b"))).withColumn("c", F.when(F.col("b") > 0, F.col("c")).otherwise(F.lit(float("nan"))))
    holes = holes.withColumn("far", F.col("a") * 1e-3 + 1e6)
    formulas = (["a"], ["a", "b"], ["a", "b^2", "a*c"], ["far", "b"], ["a", "a2", "b"])
    reads = []
    sums = models.formula_moments(holes, formulas, "y")
    monkeypatch.setattr(models, "collect_moments", lambda *a: reads.append(a))
    fits = [models.ols(sums, "y", f) for f in formulas]
    small, large = models.nested(sums, ["a"], ["a", "b", "c"], "y")
    assert not reads and small.n == large.n < fits[0].n == 400
    data = holes.toPandas()
    for f, fit in zip(formulas, fits):
        columns = [np.prod([data[c] for c in moments.base_columns(t)], axis=0) if ":" in t else data[t[:-2]] ** 2 if t.endswith("^2") else data[t] for t in fit.terms]
        keep = ~np.isnan(np.column_stack([*columns, data.y])).any(axis=1)
        beta, se, rss = lstsq([np.asarray(c)[keep] for c in columns], data.y.to_numpy()[keep])
        assert fit.n == keep.sum() and list(fit.coefficients) == pytest.approx(list(beta[1:]), rel=1e-6)
        assert list(fit.std_errors) == pytest.approx(list(se[1:]), rel=1e-5) and fit.rss == pytest.approx(rss, rel=1e-6)


def test_p_values(spark, sample):
    """Published points of the t and F tables, and an exact form for whole degrees of freedom."""
    t = [(12.706, 1, 0.05), (2.571, 5, 0.05), (2.228, 10, 0.05), (2.750, 30, 0.01), (1.980, 120, 0.05), (1.960, 10**7, 0.05), (0.0, 4, 1.0)]
    got = spark.createDataFrame(t, "t double, df long, p double").select(special.t_p_value(F.col("t"), F.col("df")).alias("g"), "p").collect()
    assert all(r.g == pytest.approx(r.p, abs=4e-4) for r in got), got
    f = [(161.45, 1, 1, 0.05), (4.965, 1, 10, 0.05), (3.326, 5, 10, 0.05), (5.636, 5, 10, 0.01), (2.978, 10, 10, 0.05), (1.931, 20, 30, 0.05),
         (2.549, 20, 30, 0.01), (6.608, 1, 5, 0.05), (1.910, 10, 120, 0.05), (1.752, 12, 10**6, 0.05)]
    got = spark.createDataFrame(f, "f double, a long, b long, p double").select(special.f_p_value(F.col("f"), F.col("a"), F.col("b")).alias("g"), "p").collect()
    assert all(r.g == pytest.approx(r.p, abs=4e-4) for r in got), got
    exact = spark.createDataFrame([(x / 7, n) for x in range(1, 30) for n in (2, 6, 40)], "f double, n long")  # 2 and n: (1 + 2 f / n) ** (-n / 2)
    for r in exact.withColumn("g", special.f_p_value(F.col("f"), F.lit(2), F.col("n"))).collect():
        assert r.g == pytest.approx((1 + 2 * r.f / r.n) ** (-r.n / 2), rel=1e-10)
    df, _ = sample
    found = models.compare_nested(spark, models.ols(df, "y", ["a"]), models.ols(df, "y", ["a", "b"])).head()
    t = {r["variable"]: r for r in models.ols_table(spark, models.ols(df, "y", ["a", "b"])).collect()}["b"]
    assert found["f_value"] == pytest.approx(t["t_value"] ** 2, rel=1e-6) and found["p_value"] == pytest.approx(t["p_value"], rel=1e-4, abs=1e-12)


def test_trees_find_what_matters(spark, sample):
    df, _ = sample
    rf = models.forest(df, "y", ["a", "b", "c"], trees=20, per_split=2)
    gbt = models.boosted(df, "y", ["a", "b", "c"], rounds=8, depth=3)
    for pred in (rf.predictions(), models.predictions(gbt, df, "y")):
        assert pred.count() == 400 and models.r2_of(pred).head()[0] > 0.6
    assert [r["variable"] for r in models.gain_importance(spark, gbt).collect()][-1] == "c"
    perm = models.permutation_importance(gbt, df, "y").collect()
    assert [r["variable"] for r in perm][-1] == "c" and perm[0]["importance"] > 50
    best = models.leaderboard(spark, {"x": 0.1, "y": 0.9, "z": 0.5})
    assert [r[0] for r in best.collect()] == ["y", "z", "x"]


def test_model_frame_keeps_a_zero_base(spark):
    cols = ["price_vs_market", "price_competitiveness_rank", "avg_contract_term", "pct_solar_available", "pct_with_incentive",
            "pct_guaranteed_discount", "pct_conditional_discount", "avg_annual_fee", "avg_late_fee"]
    base = spark.range(3).select(
        F.current_date().alias("date"), F.lit("A").alias("retailer"), F.lit(5).alias("total_transfers_out"),
        F.when(F.col("id") < 2, F.col("id")).alias("customer_count"), *[F.lit(1).alias(c) for c in cols],
    )
    got = rows(models.model_frame(base).select("customer_count", "log_customer_size"))
    assert got == [(0, None), (1, 0.0)]


def plain_tree(x, y, w, min_node):
    """(feature, cut, left part, right part) or a mean, by trying every cut of every feature."""
    n, s = w.sum(), (w * y).sum()
    best = None
    if n > min_node:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for lo, hi in zip(values, values[1:]):
                at = x[:, f] <= lo
                gain = (w * y)[at].sum() ** 2 / w[at].sum() + (w * y)[~at].sum() ** 2 / w[~at].sum() - s * s / n
                if gain > (best[0] if best else 1e-9):
                    best = (gain, f, (lo + hi) / 2)
    if best is None:
        return s / n
    _, f, cut = best
    at = x[:, f] <= cut
    return f, cut, plain_tree(x[at], y[at], w[at], min_node), plain_tree(x[~at], y[~at], w[~at], min_node)


def test_a_tree_takes_the_best_cuts():
    rng = np.random.default_rng(4)
    for n in (2, 30, 200):
        x = np.column_stack([rng.normal(0, 1, n), rng.integers(0, 6, n), rng.normal(0, 1, n)])
        y, w = x[:, 0] * 3 + x[:, 1] + rng.normal(0, 1, n), rng.integers(1, 4, n).astype(float)
        tree = forest.grow(x, y, w, 3, 5, np.random.default_rng(0))
        plain, got = plain_tree(x, y, w, 5), forest.descend(tree, x)
        for row, vote in zip(x, got):
            node = plain
            while isinstance(node, tuple):
                node = node[2] if row[node[0]] <= node[1] else node[3]
            assert vote == pytest.approx(node)


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(8)
    a, b, noise = rng.normal(0, 1, 1500), rng.integers(0, 9, 1500).astype(float), rng.normal(0, 1, 1500)
    y = 4 * a + b + rng.normal(0, 1, 1500)
    return spark.createDataFrame([tuple(map(float, r)) for r in np.column_stack([a, b, noise, y])], "a double, b double, noise double, y double")


@pytest.mark.parametrize("local_rows", [10**6, 300])
def test_forest_votes_and_importance(spark, noisy, local_rows, monkeypatch):
    """The same with nodes that a task grows to their end and with nodes split by groupings."""
    monkeypatch.setattr(forest.grow_forest, "__defaults__", (*forest.grow_forest.__defaults__[:-1], local_rows))
    more = noisy.limit(50).drop("y")
    fit = models.forest(noisy, "y", ["a", "b", "noise"], trees=40, per_split=2, others=more)
    votes = fit.votes
    assert votes.count() == 40 * 1550 and votes.groupBy("tree", "_r", "_new").count().count() == 40 * 1550
    assert votes.filter("seen AND shuffled IS NOT NULL").count() == 0 and votes.filter("NOT _new AND NOT seen AND size(shuffled) <> 3").count() == 0
    unseen = votes.filter("NOT seen AND NOT _new").count() / (40 * 1500)
    assert unseen == pytest.approx(0.368, abs=0.01)
    fitted, held = (models.r2_of(p).head()[0] for p in (fit.predictions(), fit.out_of_bag()))
    assert 0.85 < held < fitted and fitted > 0.95
    assert fit.predictions(new=True).count() == 50
    rise = {r["variable"]: r["importance"] for r in fit.importance().collect()}
    assert rise["a"] > 40 and rise["b"] > 20 and abs(rise["noise"]) < 4


def test_a_forest_does_not_depend_on_partitions(spark):
    df = spark.range(400).selectExpr("CAST(id % 17 AS DOUBLE) AS a", "CAST(id % 5 AS DOUBLE) AS b", "CAST((id * 37) % 101 AS DOUBLE) AS y")
    fits = [rows(models.forest(df.repartition(n), "y", ["a", "b"], trees=5, per_split=1).votes.select("tree", "_r", "vote")) for n in (3, 8)]
    assert fits[0] == fits[1]


def test_a_forest_of_few_and_odd_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, None, 4.0), (3.0, float("nan"), 4.0), (4.0, 2.0, None), (1.0, 5.0, 6.0)], "a double, b double, y double")
    fit = models.forest(df, "y", ["a", "b"], trees=6)
    assert fit.predictions().count() == 2 and {r["label"] for r in fit.predictions().collect()} == {3.0, 6.0}
    with pytest.raises(ValueError, match="two complete rows"):
        models.forest(df.limit(1), "y", ["a", "b"])


def test_no_model_is_shipped(spark, noisy):
    """Growing five times the trees sends nothing larger to the tasks."""
    plan = models.forest(noisy, "y", ["a", "b", "noise"], trees=3).votes._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan


def test_nested_fits_use_the_same_rows(spark):
    df = spark.range(60).selectExpr("CAST(id AS DOUBLE) AS a", "CASE WHEN id % 4 > 0 THEN CAST(id * id % 11 AS DOUBLE) END AS b", "CAST(id * 3 + id % 7 AS DOUBLE) AS y")
    small, large = models.ols(df, "y", ["a"]), models.ols(df, "y", ["a", "b"])
    with pytest.raises(ValueError, match="60 and 45 rows"):
        models.compare_nested(spark, small, large)
    small, large = models.nested(df, ["a"], ["a", "b"], "y")
    assert (small.n, large.n) == (45, 45) and models.compare_nested(spark, small, large).head()["df"] == 1


def test_positions_are_long(spark):
    got = topk.positions(spark.range(50).repartition(7), [F.col("id").desc()], "at")
    assert dict(got.dtypes)["at"] == "bigint" and {r["id"]: r["at"] for r in got.collect()} == {i: 49 - i for i in range(50)}
