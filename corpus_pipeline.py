"""Training-data pipeline: quality, near-duplicates, benchmark leaks, personal data, packing.

Every stage takes all that the one before kept and works on whole texts. Stages before
the last return the columns of `documents`; the last returns where each document's
tokens go. Nulls, repeats, empty texts and further columns are treated as the
operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from switchflow.llm import decontaminate, packing, pii, quality_model, simhash
from switchflow.llm.common import settled, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at its threshold or above."""
    model = quality_model.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return quality_model.with_score(docs, model, name="__score", keep_above=quality_model.THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHashes a chain of steps of 3 bits or fewer joins."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates; n_chars follows the text."""
    out = pii.replace_pii(docs, counts=False)
    if "n_chars" in out.columns:
        kind = out.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(kind)))
    return out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, piece, bin, offset, n_tokens) of all documents."""
    return packing.pack(packing.with_lengths(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("best-fit packing", pack),
]

# Model fits, fingerprints and packing have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again; what a stage wrote on its way is removed."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settled(spark, partial(stage, spark, docs, sf_dir), "pipeline")
    return docs
