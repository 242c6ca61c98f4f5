"""Quality rules whose cutoffs come from labelled documents with a guarantee, with DataFrame functions only.

A rule rejects documents whose statistic exceeds a cutoff. For each rule and stratum the
lowest cutoff is taken for which the number of good labelled documents above it proves,
by the exact binomial bound, that at most `alpha` of all good documents lie above it.
Cutoffs are tested from the mildest on and the test ends at the first failure, so trying
many costs nothing; over rules and strata both error rates are divided (Bonferroni).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from switchflow.llm.common import bind, whole_text, words
from switchflow.session import materialize

WINDOW = 5
STEPS = 1000  # cutoffs tried per rule, evenly over 0 to 1
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "upper": ("n_upper", "word_chars"),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


def repeated_words(ws: Column) -> Column:
    """Words inside a window of five words that the text holds twice or more."""

    def covered(q: Column) -> Column:
        # q: (hash, position) in order; a window is repeated if a neighbour has its hash
        same = F.filter(q, lambda e, j: F.coalesce(F.get(q, j - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(q, j + 1)["h"] == e["h"], F.lit(False)))
        starts = F.sort_array(F.transform(same, lambda e: e["i"]))
        none = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("p"))
        more = lambda s, p: F.struct((s["n"] + F.least(F.lit(WINDOW), p - s["p"])).alias("n"), p.alias("p"))
        return F.aggregate(starts, none, more, lambda s: s["n"])

    def of(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(bind(pairs, covered))

    windows = F.transform(F.sequence(F.lit(1), F.size(ws) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(ws, i, WINDOW)))
    return F.when(F.size(ws) <= WINDOW, F.lit(0)).otherwise(bind(windows, of))


def measure(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """docs without its text, with the counts named in COUNTS (long). Rows are not moved.

    Null text has no words; every count of an empty text is 0. Columns of docs that
    have the name of a count are replaced.
    """
    text = whole_text(text_column)
    kept = [c for c in docs.columns if c not in (*COUNTS, text_column)]
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_words = bind(
        words(text),
        lambda w: F.struct(F.size(w).alias("n_words"), F.length(F.concat_ws("", w)).alias("word_chars"), repeated_words(w).alias("n_repeat_words")),
    )
    of_lines = bind(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    counted = docs.select(
        *kept,
        of_words.alias("__words"),
        of_lines.alias("__lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).alias("n_upper"),
    )
    at = {"n_words": "__words.n_words", "word_chars": "__words.word_chars", "n_repeat_words": "__words.n_repeat_words", "n_lines": "__lines.n_lines", "n_dup_lines": "__lines.n_dup_lines"}
    return counted.select(*kept, *[F.col(at.get(c, c)).cast("long").alias(c) for c in COUNTS])


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def step_of(rule: str) -> Column:
    """The statistic of a rule in steps, rounded up: a cutoff of j steps rejects what lies above j."""
    part, whole = RULES[rule]
    return F.when(F.col(whole) > 0, F.least(F.ceil(F.col(part) * STEPS / F.col(whole)), F.lit(STEPS))).otherwise(F.lit(0)).cast("int")


def most_allowed(n: Column, alpha: Column, delta: Column) -> Column:
    """Largest k for which a Binomial(n, alpha) is at most k with a probability of delta or less; -1 if there is none.

    The distribution function is summed term by term, in logarithms, up to its mean.
    """
    logit = F.log(alpha / (1 - alpha))
    start = F.struct((n * F.log(1 - alpha)).alias("logp"), F.lit(0.0).alias("cdf"), F.lit(-1).cast("long").alias("k"))

    def step(s: Column, i: Column) -> Column:
        cdf = s["cdf"] + F.exp(s["logp"])
        return F.struct(
            (s["logp"] + F.log(F.greatest(n - i, F.lit(1)) / (i + 1.0)) + logit).alias("logp"),
            cdf.alias("cdf"),
            F.when(cdf <= delta, i).otherwise(s["k"]).alias("k"),
        )

    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.ceil(n * alpha).cast("long")), start, step, lambda s: s["k"])


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: Column, alpha: float = 0.04, delta: float = 0.05) -> DataFrame:
    """(stratum, n_good, then a cutoff in steps for each rule): STEPS, which rejects nothing, where the labels prove no less.

    alpha: the share of good documents that all rules together may reject in a stratum.
    delta: the chance that this fails in any stratum. Good are documents whose labels
    all say quality 1; rows with a null id or label take no part. Labelled documents
    are counted by step first, so a stratum is never gathered.
    """
    good = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("__quality")).filter("__quality = 1")
    steps = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), step_of(r).alias("step")) for r in RULES]))
    own = measured.withColumn("__stratum", stratum).join(good.select("doc_id"), "doc_id", "left_semi")
    counts = own.select("__stratum", steps.alias("x")).groupBy(F.col("__stratum").alias("stratum"), "x.rule", "x.step").agg(F.count("*").alias("n"))
    counts = materialize(counts, "rule-steps")  # at most rules * (STEPS + 1) rows per stratum
    strata = counts.select(F.countDistinct("stratum").alias("strata"))
    group = Window.partitionBy("stratum", "rule")
    above = F.coalesce(F.sum("n").over(group.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = counts.select("stratum", "rule", "step", above.alias("above"), F.sum("n").over(group).alias("n_good"))
    n_strata = max(1, strata.first()[0])
    per_rule, per_test = alpha / len(RULES), delta / (len(RULES) * n_strata)
    allowed = ranked.groupBy("stratum").agg(F.max("n_good").alias("n_good"))
    allowed = allowed.select("stratum", "n_good", most_allowed(F.col("n_good"), F.lit(per_rule), F.lit(per_test)).alias("allowed"))
    chosen = ranked.drop("n_good").join(allowed, "stratum")
    lowest = [
        F.coalesce(F.min(F.when((F.col("rule") == r) & (F.col("above") <= F.col("allowed")), F.col("step"))), F.lit(STEPS)).alias(f"cut_{r}") for r in RULES
    ]
    return chosen.groupBy("stratum").agg(F.max("n_good").alias("n_good"), *lowest)


def apply_rules(docs: DataFrame, labels: DataFrame, stratum_column: str = "lang", alpha: float = 0.04, delta: float = 0.05) -> DataFrame:
    """(doc_id, the counts, base_failed, kept): one row for each row of docs.

    kept is false for the base rule and for a statistic above its stratum's cutoff. A
    null stratum is a stratum of its own; one without labels keeps all that the base
    rule keeps. Nulls and empty texts have no words and fail the base rule. Repeated
    rows each come back; an empty table gives an empty result; labels may be empty.
    """
    stratum = F.coalesce(F.col(stratum_column).cast("string"), F.lit(""))
    measured = materialize(measure(docs.select("doc_id", stratum_column, "text")), "rule-counts")
    cuts = materialize(cutoffs(measured, labels.select("doc_id", "quality"), stratum, alpha, delta), "rule-cutoffs")
    joined = measured.withColumn("stratum", stratum).join(cuts, "stratum", "left")
    above = [F.coalesce(step_of(r) > F.col(f"cut_{r}"), F.lit(False)) for r in RULES]
    rejected = base_failed()
    for a in above:
        rejected = rejected | a
    return joined.select("doc_id", *COUNTS, base_failed().alias("base_failed"), (~rejected).alias("kept"))
