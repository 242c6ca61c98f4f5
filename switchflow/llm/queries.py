"""The registered queries of the operators, with SQL where DuckDB can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from switchflow.llm import (
    centroids,
    chat,
    decontaminate,
    mixing,
    packing,
    periodic,
    pii,
    quality_model,
    rules,
    secrets,
    simhash,
    suffix_dedup,
    token_store,
)
from switchflow.llm.common import table, whole_text
from switchflow.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn

    return add


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bin, piece and offset of every document."""
    return packing.pack(packing.with_lengths(table(spark, sf_dir, "documents")))


@query("op2_secret_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_random")


@query(
    "op3_preference_format",
    """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, conv_id // 2 AS pair_id, conv_id % 2 AS side, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM t),
same AS (SELECT a.pair_id, a.pos, a.role = b.role AND a.text = b.text AS eq
 FROM o a JOIN o b ON a.pair_id = b.pair_id AND a.pos = b.pos AND a.side = 0 AND b.side = 1),
prefix AS (SELECT pair_id, CAST(coalesce(min(CASE WHEN NOT eq THEN pos END) - 1, max(pos)) AS BIGINT) AS n FROM same GROUP BY pair_id),
r AS (SELECT o.*, coalesce(p.n, 0) AS n, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS seg
 FROM o LEFT JOIN prefix p USING (pair_id)),
c AS (SELECT *, CAST(sum(length(seg)) OVER (PARTITION BY conv_id ORDER BY pos) AS BIGINT) AS hi FROM r WHERE pos > n),
s AS (SELECT conv_id, string_agg(seg, '' ORDER BY pos) AS body,
  coalesce(string_agg((hi - length(text) - 11) || ':' || hi, ',' ORDER BY pos) FILTER (role = 'assistant'), '') AS mask
 FROM c GROUP BY conv_id),
p AS (SELECT pair_id, coalesce(string_agg(seg, '' ORDER BY pos) FILTER (side = 0 AND pos <= n), '') AS prompt,
  max(n) AS n_prompt_turns, max(CASE WHEN side = 0 THEN conv_id END) AS chosen_id, max(CASE WHEN side = 1 THEN conv_id END) AS rejected_id
 FROM r GROUP BY pair_id)
SELECT pair_id, chosen_id, rejected_id, n_prompt_turns, prompt,
 CASE WHEN chosen_id IS NOT NULL THEN coalesce(a.body, '') END AS chosen, CASE WHEN rejected_id IS NOT NULL THEN coalesce(b.body, '') END AS rejected,
 CASE WHEN chosen_id IS NOT NULL THEN coalesce(a.mask, '') END AS chosen_mask, CASE WHEN rejected_id IS NOT NULL THEN coalesce(b.mask, '') END AS rejected_mask
FROM p LEFT JOIN s a ON a.conv_id = chosen_id LEFT JOIN s b ON b.conv_id = rejected_id
""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k and 2k + 1 are the chosen and the rejected one of pair k."""
    return chat.pair_up(table(spark, sf_dir, "conversations"), F.expr("conv_id div 2"), F.expr("conv_id % 2 = 0"))


@query("op8_token_store")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document read back by key from a freshly written store."""
    docs = table(spark, sf_dir, "documents")
    store = token_store.write_store(docs, scratch_path(spark, "token-store"))
    found = store.lookup(docs.select("doc_id"), with_ids=False)
    return found.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@query("op9_simhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op10_quality_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op5_quality_classifier")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality_model.with_score(docs, model).drop("text")
    at_least = F.col("score") >= quality_model.THRESHOLD
    return scored.select("doc_id", quality_model.held_out(F.col("doc_id")).alias("held_out"), "score", at_least.cast("int").alias("predicted"))


@query("op7_pii_surrogates")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    return pii.replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op4_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item, the similarity and the place."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


@query("op6_suffix_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_source_mix", mixing.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op12_centroid_clusters", centroids.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.with_inertia(*centroids.cluster(table(spark, sf_dir, "embeddings")))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", periodic.made_periodic(F.col("doc_id"), whole_text()).alias("text"))
    found = periodic.find_runs(docs).withColumn("most", periodic.longest(F.col("runs")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"most.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * most.length div most.period").alias("exponent_milli"),
        F.sha2(periodic.runs_text(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
