import zlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

from switchflow.llm import quality_model as qm
from switchflow.llm.common import table
from switchflow.llm.queries import QUERIES
from tests.llm.cases import ODD, documents, empty

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op5_quality_classifier"](spark, SF).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall()
    assert len(got) == table(spark, SF, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    held = [(got[i].score, got[i].predicted, y) for i, y in labels if i in got and got[i].held_out]
    assert np.mean([p == y for _, p, y in held]) >= 0.95
    good, bad = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    assert np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good]) >= 0.97


def test_held_out_labels_are_not_used(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.withColumn("quality", F.when(qm.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = qm.fit(docs, labels), qm.fit(docs, turned)
    assert np.allclose(a.weights, b.weights) and np.allclose(a.values, b.values)


def test_isotonic_is_the_best_ascending_fit():
    y, w = np.array([0.0, 0.4, 0.2, 0.9, 0.3, 1.0]), np.array([1.0, 2.0, 2.0, 1.0, 3.0, 1.0])
    assert np.allclose(qm.isotonic(y, w), [0, 0.3, 0.3, 0.45, 0.45, 1.0])


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, qm.N_STATS)) * 0.5
    phi = qm.features(x, np.zeros(qm.N_STATS), np.ones(qm.N_STATS))[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * qm.LENGTH_SCALE**2))
    assert np.abs(phi @ phi.T - kernel).mean() < 0.06


def test_odd_rows(spark):
    docs = documents(spark, ODD).withColumn("score", F.lit("clash"))
    model = qm.fit(docs, spark.createDataFrame([(None, 1), (4, None)], "doc_id long, quality int"))
    got = qm.with_score(docs, model).collect()
    assert len(got) == docs.count() and all(r.score == 0.5 for r in got)
    labels = spark.createDataFrame([(i * 3 + 1, i % 2) for i in range(20)] + [(4, 0), (4, 1)], "doc_id long, quality int")
    model = qm.fit(docs, labels, fit_rows=5)
    assert all(0 <= r.score <= 1 for r in qm.with_score(docs, model).collect())
    assert qm.with_score(docs, model, keep_above=2.0).count() == 0
    assert qm.with_score(empty(spark), qm.fit(empty(spark), labels)).count() == 0
    assert all(np.isfinite(qm.statistics(t)).all() for t in (b"", b" ", b"a", b"\n\n", "é".encode() * 9, b"x" * 10**6))
