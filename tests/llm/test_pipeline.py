"""Each stage against a plain version on its own input."""

import corpus_pipeline as cp
import __spark_entry__ as entry
from pyspark.sql import functions as F
from switchflow.llm import queries
from switchflow.session import materialize
from tests.llm.cases import ODD, documents
from tests.llm.test_decontaminate import plain as plain_leaks
from tests.llm.test_decontaminate import words
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_stages(spark):
    sf = "/root/testdata/sf0.01"
    first = docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = {}
    for name, stage in cp.STAGES:
        steps[name] = docs
        docs = materialize(stage(spark, docs, sf), "step")
        if name != "best-fit packing":
            assert docs.columns == first.columns
    steps["end"] = docs
    texts = {n: {r.doc_id: r.text for r in d.select("doc_id", "text").collect()} for n, d in steps.items() if n != "end"}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    gone = set(texts["quality classifier"]) - set(texts["SimHash near-dedup"])
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in gone for i in good) <= 0.02 * len(good) and sum(i in gone for i, q in labels.items() if q == 0) >= 0.8 * (len(labels) - len(good))
    # Near-duplicates: of every component of fingerprints the smallest id is left.
    before, after = texts["SimHash near-dedup"], texts["benchmark decontamination"]
    ids = sorted(before)
    label = plain_components([plain_fingerprint(before[i]) for i in ids], lambda x, y: (x ^ y).bit_count() <= 3)
    smallest = {}
    for i, of in zip(ids, label, strict=True):
        smallest.setdefault(of, i)
    assert set(after) == set(smallest.values()) and len(after) < len(before)
    leaks = plain_leaks_of(after, spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect())
    assert set(after) - set(texts["PII"]) == leaks
    left = texts["best-fit packing"] if "best-fit packing" in texts else {}
    assert set(left) == set(texts["PII"])
    packed = docs.groupBy("doc_id").agg(F.sum("n_tokens")).collect()
    assert {r.doc_id for r in packed} == set(left)


def plain_leaks_of(docs, items):
    grams = {}
    for item, text in items:
        for i in range(len(words(text)) - 4):
            grams.setdefault(tuple(words(text)[i : i + 5]), set()).add((item, text))
    out = set()
    for doc, text in docs.items():
        ws = words(text)
        near = set().union(*(grams.get(tuple(ws[i : i + 5]), set()) for i in range(len(ws) - 4))) if len(ws) > 4 else set()
        out |= {k[0] for k in plain_leaks([(doc, text)], list(near))}
    return out


def test_odd_rows_pass_every_stage(spark, sf):
    docs = documents(spark, ODD).withColumn("n_chars", F.length("text")).withColumn("score", F.lit(1)).withColumn("component_id", F.lit(2))
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf).count() == 0
        out.collect()
    assert cp.pack(spark, docs, sf).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_all_are_registered():
    names = entry.queries()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert "pipeline" in names and set(queries.ORACLE) <= set(entry.oracle_sql())
