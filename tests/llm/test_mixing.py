import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from switchflow.llm import mixing
from tests.llm.cases import ODD, SCHEMA, documents, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Exact targets by rounds of clamping; None comes last."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, held = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        free = sum(weight[s] for s in names if s not in held)
        left = total - sum(2 * sizes[s] for s in held)
        share = {s: Fraction(2 * sizes[s]) if s in held else left * weight[s] / free for s in names}
        above = {s for s in names if share[s] > 2 * sizes[s]}
        if not above:
            return share
        held |= above


def check(docs, got):
    sizes = {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text or ""))
    want, taken, rows = targets(sizes), {}, got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(want[r.source]), rel=1e-12)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.whole * r.size + r.last
        taken[r.source] = taken.get(r.source, 0) + r.taken
    return want, taken, rows


def test_targets_and_taken_words(spark):
    docs = documents(spark, ODD).withColumn("size", F.lit("clash")).withColumn("target", F.lit(1))
    want, taken, rows = check(docs, mixing.mix(docs))
    # Two rows of one id and text may lose a word at the edge.
    assert all(int(want[s]) - 1 <= taken[s] <= want[s] for s in want)
    sizes = sorted((r.doc_id or -1, r.size) for r in rows)
    assert sizes == sorted((r.doc_id or -1, len(WORD.findall(r.text or ""))) for r in docs.collect())


def test_hot_source_and_small_sources(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 40), None, "hot" if i % 3 else f"s{i % 40}") for i in range(3000)] + [(9000, None, None, "none"), (9001, "x", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want, taken, _ = check(docs, mixing.mix(docs))
    assert all(taken[s] == int(want[s]) for s in want)
    again = mixing.mix(docs.orderBy(F.desc("text")).repartition(7)).select("doc_id", "taken")
    assert again.exceptAll(mixing.mix(docs).select("doc_id", "taken")).count() == 0
    other = mixing.mix(docs, seed=5).select("doc_id", "taken")
    assert other.exceptAll(again).count() > 0


def test_repeated_rows_at_the_edge(spark):
    docs = spark.createDataFrame([(None, "a b c", None, "x")] * 500 + [(1, "a " * 4000, None, "y")], SCHEMA)
    want, taken, _ = check(docs, mixing.mix(docs))
    assert all(0 <= want[s] - taken[s] <= 500 for s in want)


def test_no_words_and_no_rows(spark):
    docs = spark.createDataFrame([(1, None, None, "x"), (2, " ", None, None)], SCHEMA)
    assert [(r.size, r.target, r.taken) for r in mixing.mix(docs).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.sample(docs).count() == 0
    assert mixing.mix(empty(spark)).count() == 0 and mixing.sample(empty(spark)).count() == 0


def test_the_sample_holds_the_words_taken(spark):
    docs = documents(spark, ODD).withColumn("repetition", F.lit("clash"))
    words = lambda df: {r.doc_id: r.n for r in df.groupBy("doc_id").agg(F.sum("n").alias("n")).collect() if r.n}
    out = mixing.sample(docs)
    assert sorted(out.columns) == sorted(docs.columns)
    assert words(out.select("doc_id", mixing.n_words(F.col("text")).alias("n"))) == words(mixing.mix(docs).select("doc_id", F.col("taken").alias("n")))


def test_water_filling_in_many_rounds(spark):
    sizes = {f"s{i:02d}": 3**i for i in range(12)}
    sources = spark.createDataFrame([(s, n, (3, 1, 2)[i % 3]) for i, (s, n) in enumerate(sizes.items())], "s string, source_size long, weight int")
    got = {r.s: r.target for r in mixing.water_fill(sources, 1.5 * sum(sizes.values())).collect()}
    assert got == pytest.approx({s: float(t) for s, t in targets(sizes).items()})


def test_plan_has_no_python(spark):
    text = mixing.mix(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text
