"""Regression, tree and boosting models on the master frame, and their diagnostics.

Linear models are solved from one table of moments, trees are fitted on the cluster; only
per-variable results (a row per coefficient or feature) come back to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchflow.functions.special import f_p_value, t_p_value
from switchflow.operators.forest import ForestFit, grow_forest
from switchflow.operators.moments import Moments, MomentTable, collect_moments, term_column
from switchflow.operators.topk import positions
from switchflow.session import materialize

TARGET = "total_transfers_out"

# Predictors of the linear model; the older variant has no customer size.
PREDICTORS_9 = (
    "price_vs_market", "price_competitiveness_rank", "pct_guaranteed_discount",
    "pct_conditional_discount", "avg_contract_term", "pct_solar_available",
    "pct_with_incentive", "avg_annual_fee", "avg_late_fee",
)
PREDICTORS = (*PREDICTORS_9, "log_customer_size")

# Terms of the polynomial model (`^2` is a square) and its older variant.
POLYNOMIAL = (
    "price_vs_market", "price_vs_market^2", "pct_guaranteed_discount", "pct_guaranteed_discount^2",
    "pct_conditional_discount", "pct_conditional_discount^2", "avg_contract_term", "avg_contract_term^2",
    "pct_with_incentive", "pct_with_incentive^2", "avg_annual_fee", "avg_annual_fee^2",
    "avg_late_fee", "log_customer_size",
)
POLYNOMIAL_9 = (*POLYNOMIAL[:-1], "pct_solar_available")

# Terms of the interaction model (`a*b` is a, b and their product).
INTERACTIONS = (
    "price_vs_market*pct_conditional_discount", "price_vs_market*avg_contract_term",
    "pct_with_incentive*avg_contract_term", "pct_guaranteed_discount*pct_with_incentive",
    "log_customer_size*price_vs_market",
)
INTERACTIONS_9 = (
    "price_vs_market", "pct_guaranteed_discount", "pct_conditional_discount", "avg_contract_term",
    "pct_with_incentive", "avg_annual_fee", "avg_late_fee", *INTERACTIONS[:-1],
)

# Features of the tree models.
TREE_FEATURES = (
    "price_vs_market", "pct_guaranteed_discount", "pct_conditional_discount", "avg_contract_term",
    "pct_solar_available", "pct_with_incentive", "avg_annual_fee", "avg_late_fee", "log_customer_size",
)

# Readings of a significant coefficient by variable and sign (0 = either).
READINGS = {
    ("price_vs_market", 0): "Higher prices → More transfers",
    ("price_competitiveness_rank", 0): "Higher rank (more expensive) → More transfers",
    ("avg_contract_term", 1): "Longer contracts → More transfers",
    ("avg_contract_term", -1): "Longer contracts → Fewer transfers (retention)",
    ("pct_with_incentive", -1): "More incentives → Fewer transfers (retention)",
    ("pct_with_incentive", 1): "More incentives → More transfers",
    ("pct_guaranteed_discount", -1): "More guaranteed discounts → Fewer transfers",
    ("pct_conditional_discount", -1): "More conditional discounts → Fewer transfers",
    ("avg_annual_fee", 1): "Higher annual fees → More transfers",
    ("avg_late_fee", 1): "Higher late fees → More transfers",
}

# Memory for the split statistics of one pass: more nodes per pass, fewer passes.
NODE_MEMORY_MB = 1024

# Rows per partition of a tree fit's input, and its fewest partitions. The number follows
# the rows alone, as bagging draws per partition.
TREE_ROWS, TREE_PARTITIONS = 200_000, 8

# Smallest share of a predictor's variance that the earlier ones may leave unexplained.
ALIAS_TOLERANCE = 1e-7


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a null (or NaN) in any of the columns."""
    return df.dropna(subset=list(columns))


def model_frame(df: DataFrame) -> DataFrame:
    """Complete rows as doubles, with the log of the customer count.

    Only the columns the models use are kept, so the wide lag columns are pruned. A
    count of 0 has no logarithm: its row stays, with a null log.
    """
    needed = [
        "price_vs_market", "avg_contract_term", "pct_solar_available", "pct_with_incentive",
        "pct_guaranteed_discount", "avg_annual_fee", "avg_late_fee", "customer_count",
    ]
    rows = complete_cases(df, needed)
    doubles = [F.col(c).cast("double").alias(c) for c in (TARGET, *PREDICTORS_9)]
    return rows.select("date", "retailer", "customer_count", *doubles, F.log("customer_count").alias("log_customer_size"))


def expand_terms(terms: Sequence[str]) -> list[str]:
    """Main effects before products, each once: `a*b` becomes a, b and `a:b`."""
    mains: list[str] = []
    products: list[str] = []
    for term in terms:
        parts = term.split("*")
        mains += [p for p in parts if p not in mains]
        if len(parts) == 2:
            key = ":".join(sorted(parts))
            products += [key] if key not in products else []
    return mains + products


def _design(df: DataFrame, y: str, terms: Sequence[str]) -> DataFrame:
    """(features, label) rows of a formula; incomplete rows are left out."""
    names = [f"_t{i}" for i in range(len(terms))]
    flat = df.select(F.col(y).cast("double").alias("label"), *[term_column(t).cast("double").alias(n) for t, n in zip(terms, names)])
    return VectorAssembler(inputCols=names, outputCol="features").transform(flat.dropna()).select("features", "label")


def _correlation(m: Moments) -> np.ndarray:
    """Correlation matrix; NaN for a term that is constant but for rounding."""
    spread = np.diag(m.cross).copy()
    spread[spread <= 1e-14 * m.n * m.mean**2] = np.nan
    scale = np.sqrt(spread)
    return m.cross / np.outer(scale, scale)


def aliased_terms(corr: np.ndarray, tolerance: float = ALIAS_TOLERANCE) -> list[int]:
    """Positions explained by earlier ones (or constant), as a sequential fit drops them."""
    kept: list[int] = []
    dropped: list[int] = []
    for j in range(corr.shape[0]):
        if not np.isfinite(corr[j, j]) or (kept and not np.all(np.isfinite(corr[j, kept]))):
            dropped.append(j)
            continue
        unexplained = 1.0
        if kept:
            inner = corr[np.ix_(kept, kept)]
            cross = corr[kept, j]
            unexplained = 1.0 - float(cross @ np.linalg.solve(inner, cross))
        (kept if unexplained > tolerance else dropped).append(j)
    return dropped


@dataclass
class LinearFit:
    """A least-squares fit with the terms that could be estimated."""

    terms: list[str]
    dropped: list[str]
    n: int
    intercept: float
    coefficients: np.ndarray
    std_errors: np.ndarray
    rss: float
    tss: float

    @property
    def residual_df(self) -> int:
        return self.n - len(self.terms) - 1

    @property
    def r2(self) -> float:
        return 1 - self.rss / self.tss if self.tss > 0 else float("nan")

    @property
    def adjusted_r2(self) -> float:
        return 1 - (self.rss / self.residual_df) / (self.tss / (self.n - 1)) if self.tss > 0 and self.residual_df > 0 else float("nan")


def formula_moments(df: DataFrame, formulas: Sequence[Sequence[str]], y: str = TARGET) -> MomentTable:
    """What every one of the formulas needs, from one scan."""
    return collect_moments(df, [y, *(t for f in formulas for t in expand_terms(f))])


def _table(data: DataFrame | MomentTable, formulas: Sequence[Sequence[str]], y: str) -> MomentTable:
    return data if isinstance(data, MomentTable) else formula_moments(data, formulas, y)


def nested(data: DataFrame | MomentTable, small: Sequence[str], large: Sequence[str], y: str = TARGET) -> tuple[LinearFit, LinearFit]:
    """A nested pair fitted on the same rows: those complete in the terms of both."""
    table = _table(data, (small, large), y)
    both = [*expand_terms(small), *expand_terms(large)]
    return ols(table, y, small, both), ols(table, y, large, both)


def ols(data: DataFrame | MomentTable, y: str = TARGET, terms: Sequence[str] = PREDICTORS, whole: Sequence[str] = ()) -> LinearFit:
    """Ordinary least squares by the normal equations; aliased terms are dropped.

    Give a table of moments to fit many formulas from one scan. `whole`: further terms
    that a row must have values in.
    """
    terms = expand_terms(terms)
    m = _table(data, (terms, whole), y).of([*terms, y], whole)
    out = set(aliased_terms(_correlation(m)[:-1, :-1])) if m.n else set(range(len(terms)))
    kept, dropped = ([t for i, t in enumerate(terms) if (i in out) == gone] for gone in (False, True))
    own = m.of([*kept, y])
    # Solved in standardized terms: their scales may lie far apart.
    scale = np.sqrt(np.diag(own.cross)[:-1])
    inverse = np.linalg.inv(own.cross[:-1, :-1] / np.outer(scale, scale))
    beta = inverse @ (own.cross[:-1, -1] / scale)
    tss = float(own.cross[-1, -1])
    rss = max(0.0, tss - float(beta @ (own.cross[:-1, -1] / scale)))
    df = m.n - len(kept) - 1
    errors = np.sqrt(np.diag(inverse) * rss / df) / scale if df > 0 else np.full(len(kept), np.nan)
    coefficients = beta / scale
    return LinearFit(kept, dropped, m.n, float(own.mean[-1] - coefficients @ own.mean[:-1]), coefficients, errors, rss, tss)


def _reading(term: str, estimate: float, significant: bool) -> str:
    if not significant:
        return "See coefficient"
    sign = 1 if estimate > 0 else -1
    return READINGS.get((term, 0)) or READINGS.get((term, sign)) or "See coefficient"


def ols_table(spark, fit: LinearFit, level: float = 0.05) -> DataFrame:
    """Coefficient table without the intercept, most significant first."""
    rows = [
        (t, float(c), float(e), float(c / e) if e > 0 else float("inf"), fit.residual_df, _reading(t, c, True))
        for t, c, e in zip(fit.terms, fit.coefficients, fit.std_errors)
    ]
    names = "variable string, coefficient double, std_error double, t_value double, df long, reading string"
    found = spark.createDataFrame(rows, names).withColumn("p_value", t_p_value(F.col("t_value"), F.col("df")))
    significant = F.coalesce(F.col("p_value") < level, F.lit(False))
    return found.select(
        "variable", "coefficient", "std_error", "t_value", "p_value",
        F.when(significant, "YES").otherwise("NO").alias("significant"),
        F.when(F.col("coefficient") > 0, "Positive (+)").otherwise("Negative (-)").alias("direction"),
        F.when(significant, F.col("reading")).otherwise("See coefficient").alias("interpretation"),
    ).orderBy("p_value", "variable")


def top_significant(table: DataFrame, k: int = 10) -> DataFrame:
    """The k most significant variables."""
    return table.filter(F.col("significant") == "YES").orderBy("p_value", "variable").limit(k)


def fit_quality(spark, fit: LinearFit) -> DataFrame:
    return spark.createDataFrame([(fit.r2, fit.adjusted_r2, fit.n)], "r_squared double, adj_r_squared double, n long")


def vif(spark, data: DataFrame | MomentTable, terms: Sequence[str] = PREDICTORS, y: str = TARGET) -> DataFrame:
    """Variance inflation factor per predictor, flagged above 5 and above 10."""
    terms = expand_terms(terms)
    corr = _correlation(_table(data, (terms,), y).of([*terms, y]))[:-1, :-1]
    out = set(aliased_terms(corr))
    keep = [i for i in range(len(terms)) if i not in out]
    factors = np.diag(np.linalg.inv(corr[np.ix_(keep, keep)]))
    rows = [(terms[i], float(f), bool(f > 5), bool(f > 10)) for i, f in zip(keep, factors)]
    return spark.createDataFrame(rows, "variable string, vif double, moderate boolean, high boolean")


def compare_nested(spark, small: LinearFit, large: LinearFit) -> DataFrame:
    """F statistic of a nested pair with its degrees of freedom and p-value; both must be fitted on the same number of rows."""
    if small.n != large.n:
        raise ValueError(f"the models were fitted on {small.n} and {large.n} rows; fit both on the complete rows of all terms")
    extra = small.residual_df - large.residual_df
    if extra > 0 and large.residual_df > 0 and large.rss > 0:
        f = (small.rss - large.rss) / extra / (large.rss / large.residual_df)
    else:
        f = None
    rows = [(small.residual_df, large.residual_df, small.rss, large.rss, extra, f)]
    found = spark.createDataFrame(rows, "residual_df_1 long, residual_df_2 long, rss_1 double, rss_2 double, df long, f_value double")
    return found.withColumn("p_value", f_p_value(F.col("f_value"), F.col("df"), F.col("residual_df_2")))


@dataclass
class TreeFit:
    """A fitted tree ensemble with its features."""

    model: object
    features: list[str]


def _tree_design(df: DataFrame, y: str, features: Sequence[str], parts: int | None) -> DataFrame:
    """The design matrix in partitions whose number and order follow from the rows' own values.

    Bagging draws per partition, so a fit depends on where rows are; placed like this it
    is the same on any number of cores.
    """
    design = _design(df, y, features)
    parts = parts or max(TREE_PARTITIONS, -(-design.count() // TREE_ROWS))
    values = design.withColumn("_v", vector_to_array("features"))
    h = F.xxhash64("_v", "label")
    return values.repartition(parts, h).sortWithinPartitions(h, "_v", "label").select("features", "label")


def forest(
    df: DataFrame, y: str = TARGET, features: Sequence[str] = TREE_FEATURES, trees: int = 500, per_split: int = 3,
    min_node: int = 5, seed: int = 123, others: DataFrame | None = None,
) -> ForestFit:
    """Random forest on the complete rows; nodes of five draws or fewer are not split, depth has no limit.

    The fit holds the votes of all trees, so in-sample and out-of-bag predictions and the
    importance come from one growth. `others`: rows without a target that get predictions.
    """

    def flat(rows: DataFrame, label: Column) -> DataFrame:
        x = F.array(*[term_column(t).cast("double") for t in features])
        whole = rows.select(label.cast("double").alias("label"), x.alias("x"))
        return whole.filter(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))

    own = flat(df, F.col(y)).filter(F.col("label").isNotNull() & ~F.isnan("label"))
    further = None if others is None else flat(others, F.col(y) if y in others.columns else F.lit(None))
    return grow_forest(own, features, trees, per_split, min_node, seed, further)


def boosted(
    df: DataFrame, y: str = TARGET, features: Sequence[str] = TREE_FEATURES, rounds: int = 100, depth: int = 6,
    rate: float = 0.1, seed: int = 123, parts: int | None = None,
) -> TreeFit:
    """Gradient-boosted trees on squared error."""
    gbt = GBTRegressor(
        maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed, lossType="squared",
        maxMemoryInMB=NODE_MEMORY_MB,
    )
    return TreeFit(gbt.fit(_tree_design(df, y, features, parts)), list(features))


def predictions(fit: TreeFit, df: DataFrame, y: str = TARGET) -> DataFrame:
    return fit.model.transform(_design(df, y, fit.features)).select("label", "prediction")


def r2_of(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """In-sample R² = 1 − residual / total sum of squares: one row."""
    miss = F.col(label) - F.col(prediction)
    spread = F.var_pop(label) * F.count(label)
    return pred.agg(F.when(spread > 0, 1 - F.sum(miss * miss) / spread).alias("r_squared"))


def gain_importance(spark, fit: TreeFit) -> DataFrame:
    """Share of the total gain per feature, greatest first."""
    rows = [(f, float(v)) for f, v in zip(fit.features, fit.model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "variable string, importance double").orderBy(F.desc("importance"), "variable")


def permutation_importance(fit: TreeFit, df: DataFrame, y: str = TARGET, seed: int = 123) -> DataFrame:
    """Rise of the mean squared error, in %, when one feature is shuffled.

    Rows get a position in a hashed order, and feature j of row i is taken from row
    (i + shift_j) mod n, with a different shift per feature. Every value moves by one
    shuffle keyed by position (evenly spread), then all variants are scored at once.
    In-sample, so an approximation of an out-of-bag figure.
    """
    features = list(fit.features)
    spark = df.sparkSession
    flat = df.select(
        F.col(y).cast("double").alias("label"), *[term_column(t).cast("double").alias(f"_t{i}") for i, t in enumerate(features)]
    ).dropna()
    names = [f"_t{i}" for i in range(len(features))]
    spread = flat.withColumn("_h", F.xxhash64("label", *names, F.lit(seed)))
    rows = materialize(positions(spread, ["_h", "label", *names], "_i").drop("_h"), "shuffle")
    n = rows.count()
    if n < 2:
        raise ValueError("at least two rows are needed to shuffle a feature")
    shifts = [1 + (seed * 7919 + (j + 1) * (n // (len(features) + 1) or 1)) % (n - 1) for j in range(len(features))]
    moved = rows.select(
        F.explode(
            F.array(*[F.struct(((F.col("_i") + s) % n).alias("_i"), F.lit(j).alias("j"), F.col(names[j]).alias("v")) for j, s in enumerate(shifts)])
        ).alias("m")
    ).select("m.*")
    wide = moved.groupBy("_i").agg(*[F.max(F.when(F.col("j") == j, F.col("v"))).alias(f"_s{j}") for j in range(len(features))])
    joined = rows.join(wide, "_i")
    variants = F.array(
        *[
            F.struct(F.lit(j).alias("j"), *[(F.col(f"_s{i}") if i == j else F.col(names[i])).alias(names[i]) for i in range(len(features))])
            for j in range(-1, len(features))
        ]
    )
    long = joined.select("label", F.explode(variants).alias("x")).select("label", "x.*")
    scored = fit.model.transform(VectorAssembler(inputCols=names, outputCol="features").transform(long))
    miss = F.col("label") - F.col("prediction")
    mse = scored.groupBy("j").agg(F.avg(miss * miss).alias("mse"))
    base = mse.filter(F.col("j") == -1).agg(F.max("mse")).scalar()
    label = spark.createDataFrame(list(enumerate(features)), "j int, variable string")
    return (
        mse.join(label, "j")
        .select("variable", F.when(base > 0, (F.col("mse") - base) / base * 100).alias("importance"))
        .orderBy(F.desc("importance"), "variable")
    )


def leaderboard(spark, scores: dict[str, float]) -> DataFrame:
    """Models by R², best first."""
    rows = [(k, float(v)) for k, v in scores.items()]
    return spark.createDataFrame(rows, "model string, r_squared double").orderBy(F.desc("r_squared"), "model")
