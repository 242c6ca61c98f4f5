"""Monthly run: newest extract -> gate -> staging -> enriched table -> report frames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchflow.operators import flows, periods, reshape, topk, trends
from switchflow.operators.conform import conform
from switchflow.operators.joins import enrich
from switchflow.operators.quality import GATE_COLUMNS, assert_ids
from switchflow.schema import EXCLUDED_FINYEARS, LOADS, VIEW_COLUMNS
from switchflow.session import materialize
from switchflow.sources.frames import load_frame, with_calendar, write_snapshot
from switchflow.sources.manifest import assert_new, commit, read_manifest, version
from switchflow.sources.raw import list_inputs, newest_file, read_raw
from switchflow.sources.staging import live_rows, new_load, read_staging, upsert_by_source, write_load


@dataclass
class Paths:
    """Where a deployment keeps its tables (folders the whole cluster can reach)."""

    raw: str
    staging: str
    manifest: str
    enriched: str
    entities: str
    codes: str
    snapshots: str | None = None
    missing_ids: str | None = None
    sums: str | None = None


def run_month(spark: SparkSession, paths: Paths, source_file: str | None = None, now: dt.datetime | None = None) -> str:
    """Load the newest extract (or `source_file`) and refresh its enriched rows.

    The id gate runs first and stops the run, also for an extract without the columns
    it checks; nothing is written then. Returns the name of the file loaded.
    `source_file` repeats or completes a chosen file, so it may be in the manifest
    already. Both tables get the rows as a load of their own, and one commit makes both
    visible: until then, and if the run fails, readers see what they saw before.
    """
    files = list_inputs(spark, paths.raw)
    seen = version(spark, paths.manifest)
    manifest = read_manifest(spark, paths.manifest)
    if source_file is None:
        chosen = newest_file(files)
        assert_new(chosen, manifest)
    else:
        chosen = files.filter(F.col("source_file") == source_file)
    found = chosen.select("path", "source_file").head(1)
    if not found:
        raise FileNotFoundError(f"no CSV file to load in {paths.raw}")
    path, name = found[0]

    rows = conform(read_raw(spark, [path], now, required=GATE_COLUMNS))
    entities, codes = load_frame(spark, paths.entities), load_frame(spark, paths.codes)
    assert_ids(rows, entities, paths.missing_ids)
    load = new_load()
    write_load(rows, paths.staging, load)
    done = spark.createDataFrame([(name, load)], LOADS)
    staged = read_staging(spark, paths.staging, done)
    if paths.snapshots:
        stamp = (now or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")
        write_snapshot(staged, paths.snapshots, f"{name}_{stamp}")
    upsert_by_source(staged, paths.enriched, name, lambda df: enrich(with_calendar(df), entities, codes), load)
    commit(spark, paths.manifest, done, seen, "raise" if source_file is None else "replace")
    return name


def report(
    facts: DataFrame, excluded: Sequence[str] = EXCLUDED_FINYEARS, hold: Callable[[DataFrame], DataFrame] = materialize
) -> dict[str, DataFrame]:
    """All result frames of the monthly report, by name.

    The edge list and the size movements feed several frames each, so they are
    computed once and held (written to the shared folder unless `hold` does
    otherwise). Everything else is lazy.
    """
    df = periods.report_facts(facts, excluded)
    edges = hold(flows.flows(df))
    sizes = hold(flows.size_flows(df))
    daily = periods.latest_month_rows(df)
    out = {
        "coverage": trends.coverage(df),
        "latest_change": periods.latest_change(df),
        "trend_all": trends.trend_all_grains(df),
        "daily_trend": trends.trend(daily, "day"),
        "move_in_top5": topk.top_k_series(df, "to", 5, "Move-in"),
        "losing_top10": topk.top_k_series(df, "from", 10),
        "gaining_top10": topk.top_k_series(df, "to", 10),
        "losing_totals": topk.top_k_totals(df, "from"),
        "gaining_totals": topk.top_k_totals(df, "to"),
        "flow_edges": edges,
        "flow_matrix": reshape.with_intensity(
            reshape.flow_matrix_long(edges, flows.FROM, flows.TO, "transfers"), "transfers"
        ),
        "size_flows": sizes,
        "size_movements": flows.movement_table(sizes),
        "size_summary": flows.size_flow_summary(sizes),
        "net_change": flows.net_change_rate(df),
        "in_out": flows.in_out_activity(df),
        "in_out_rates": flows.in_out_rates(df),
    }
    for grain in ("month", "quarter", "finyear"):
        out[f"trend_{grain}"] = trends.trend(df, grain)
        out[f"entity_{grain}"] = trends.entity_trend(df, flows.FROM, grain)
        out[f"type_share_{grain}"] = trends.share_of_total(df, grain)
    for side in ("from", "to"):
        out[f"nodes_{side}"], out[f"links_{side}"] = flows.flow_graph(edges, side)
    return out


# Files whose partitions are named in a filter; more of them are joined.
NAMED_FILES = 1000


def refresh_sums(spark: SparkSession, paths: Paths) -> int:
    """Add the partial sums of live loads that have none yet; returns the number of files summed.

    Only the partitions of those files are read. Sums keep the load they were made from,
    so a file that is loaded again is summed again and its earlier sums are dead.
    """
    live = read_manifest(spark, paths.manifest).filter("load IS NOT NULL")
    try:
        have = spark.read.schema(LOADS).parquet(paths.sums).select("source_file", "load").distinct()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        have = spark.createDataFrame([], LOADS)
    todo = materialize(live.join(have, ["source_file", "load"], "left_anti"), "sums-due")
    n = todo.count()
    if not n:
        return 0
    rows = spark.read.schema(_enriched_schema(spark, paths, load=True)).parquet(paths.enriched)
    if n <= NAMED_FILES:
        rows = rows.filter(F.col("load").isin([r["load"] for r in todo.collect()]))  # prunes partitions
    rows = rows.join(todo, ["source_file", "load"], "left_semi")
    trends.partial_sums(rows, "source_file", "load").write.mode("append").partitionBy("source_file", "load").parquet(paths.sums)
    return n


def _enriched_schema(spark: SparkSession, paths: Paths, load: bool = False) -> T.StructType:
    """Columns of the enriched table; partition names such as `201801` are text."""
    found = [f for f in spark.read.parquet(paths.enriched).schema if f.name not in ("source_file", "load")]
    return T.StructType([*found, *(LOADS.fields if load else LOADS.fields[:1])])


def monthly_report(spark: SparkSession, paths: Paths) -> dict[str, DataFrame]:
    """Report frames of the live loads of completed files.

    With `paths.sums` they are made from partial sums per file, and of the enriched facts
    only those of files without sums are read; else from all facts.
    """
    manifest = read_manifest(spark, paths.manifest)
    if not paths.sums:
        return report(live_rows(spark, paths.enriched, manifest, _enriched_schema(spark, paths)).select(*VIEW_COLUMNS))
    refresh_sums(spark, paths)
    found = _enriched_schema(spark, paths)
    kinds = {f.name: f for f in found}
    shape = T.StructType([*[kinds[c] for c in trends.SUM_KEYS], T.StructField("stat_value", T.LongType()), T.StructField("n_rows", T.LongType()), LOADS.fields[0]])
    return report(live_rows(spark, paths.sums, manifest, shape))
