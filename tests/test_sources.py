import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from switchflow.operators.quality import ValidationError
from switchflow.plans import bulk_load, monthly
from switchflow.session import materialize, scratch_path
from switchflow.sources import frames, manifest, raw, staging
from switchflow.streaming.ingest import ingest_stream
from tests.conftest import rows

NOW = dt.datetime(2025, 11, 25, 9, 30)
HEADER = "ID_MTS2,STAT_DATE,STAT_SHORTCUT,STAT_VALUE,NMICLASSCODE,FRMP,NEWFRMP,CRCODE"
LINES = ["1,1/10/2025 0:00,M57A,10,SMALL,P1,P2,1000", "2,2025/10/02 00:00:00,M57A,NA,SMALL, P2 ,,1010", "3,31/10/2025 0:00,M71,500,SMALL,P1,,"]


def put(path, name, lines=LINES, header=HEADER):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join([header, *lines]) + "\n")
    return str(path / name)


def test_list_and_newest(spark, tmp_path):
    old, new = put(tmp_path / "in", "b.csv"), put(tmp_path / "in", "a.CSV")
    put(tmp_path / "in", "notes.txt")
    os.utime(old, (1_000_000, 1_000_000))
    files = raw.list_inputs(spark, str(tmp_path / "in"))
    assert rows(files.select("source_file")) == [("a.CSV",), ("b.csv",)]
    assert raw.newest_file(files).head()["source_file"] == "a.CSV"
    assert raw.newest_file(files.drop("modified")).head()["source_file"] == "b.csv"
    os.utime(new, (1_000_000, 1_000_000))
    assert raw.newest_file(raw.list_inputs(spark, str(tmp_path / "in"))).head()["source_file"] == "b.csv"


def test_files_are_read_by_their_own_header(spark, tmp_path):
    put(tmp_path / "in", "one file.csv", ["1,a", "2,NA", '3,"x ""y"", z"'], "ID_MTS2,FRMP")
    put(tmp_path / "in", "two.csv", ["b,4", ",5"], "FRMP,ID_MTS2")
    got = raw.read_raw(spark, str(tmp_path / "in"), NOW)
    assert rows(got.select("id_mts2", "frmp", "source_file", "date_imported")) == [
        ("1", "a", "one file.csv", NOW), ("2", None, "one file.csv", NOW), ("3", 'x "y", z', "one file.csv", NOW),
        ("4", "b", "two.csv", NOW), ("5", None, "two.csv", NOW),
    ]
    assert rows(raw.raw_line_counts(spark, str(tmp_path / "in"))) == [("one file.csv", 3), ("two.csv", 2)]
    with pytest.raises(FileNotFoundError):
        raw.read_raw(spark, [])


def names_of(spark, path):
    return rows(manifest.read_manifest(spark, path).select("source_file"))


def test_manifest(spark, tmp_path):
    path = str(tmp_path / "manifest")
    assert manifest.read_manifest(spark, path).isEmpty()
    manifest.mark_done(spark, ["a.csv", "a.csv"], path)
    manifest.mark_done(spark, ["b.csv", "a.csv"], path)
    done = manifest.read_manifest(spark, path)
    assert rows(done) == [("a.csv", None), ("b.csv", None)]
    files = spark.createDataFrame([("a.csv",), ("c.csv",)], "source_file string")
    assert rows(manifest.remaining_files(files, done)) == [("c.csv",)]
    manifest.assert_new(files.filter("source_file = 'c.csv'"), done)
    with pytest.raises(manifest.AlreadyProcessed, match="A.CSV"):
        manifest.assert_new(spark.createDataFrame([(" A.CSV ",)], "source_file string"), done)


def test_commits_see_each_other(spark, tmp_path):
    path = str(tmp_path / "manifest")
    load = lambda *pairs: spark.createDataFrame(list(pairs), "source_file string, load string")
    manifest.commit(spark, path, load(("a", "1")))
    seen = manifest.version(spark, path)
    manifest.commit(spark, path, load(("b", "2"), ("c", "2")))
    with pytest.raises(manifest.Conflict, match="b was loaded"):
        manifest.commit(spark, path, load(("b", "3"), ("d", "3")), seen)
    assert rows(manifest.commit(spark, path, load(("b", "4"), ("d", "4")), seen, "skip")) == [("d", "4")]
    assert rows(manifest.commit(spark, path, load(("c", "5")), seen, "replace")) == [("c", "5")]
    assert rows(manifest.read_manifest(spark, path)) == [("a", "1"), ("b", "2"), ("c", "5"), ("d", "4")]
    assert manifest.version(spark, path) == 4


def test_a_number_is_given_once(spark, tmp_path, monkeypatch):
    """Two runs that find the same number free: the later one takes the next and looks again."""
    path = str(tmp_path / "manifest")
    load = lambda *pairs: spark.createDataFrame(list(pairs), "source_file string, load string")
    put, between = manifest._put, []

    def late(session, where, entry, folder):
        if not between:
            between.append(entry)
            manifest.commit(session, where, load(("a", "other"), ("z", "other")))
        return put(session, where, entry, folder)

    monkeypatch.setattr(manifest, "_put", late)
    added = manifest.commit(spark, path, load(("a", "own"), ("b", "own")), 0, "skip")
    assert rows(added) == [("b", "own")] and manifest.version(spark, path) == 2
    assert rows(manifest.read_manifest(spark, path)) == [("a", "other"), ("b", "own"), ("z", "other")]


def test_the_log_is_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "COMPACT_EVERY", 3)
    path = str(tmp_path / "manifest")
    for i in range(10):
        done = spark.createDataFrame([(f"f{i}", str(i)), ("again", str(i))], "source_file string, load string")
        manifest.commit(spark, path, done)
    want = sorted([(f"f{i}", str(i)) for i in range(10)] + [("again", "9")])
    assert rows(manifest.read_manifest(spark, path)) == want and manifest.version(spark, path) == 10
    commits, wholes = manifest._entries(spark, path)
    assert [n for n, _ in wholes] == [6, 9] and [n for n, _ in commits] == [7, 8, 9, 10]
    assert len([n for n in os.listdir(path) if n.startswith("names-")]) == 6
    with pytest.raises(manifest.Conflict):  # older than the log: the whole list tells
        manifest.commit(spark, path, spark.createDataFrame([("f2", "x")], "source_file string, load string"), 1)


def test_a_failed_reload_changes_nothing(spark, tmp_path):
    a = put(tmp_path / "in", "a.csv")
    paths = dict(staging_path=str(tmp_path / "staging"), manifest_path=str(tmp_path / "manifest"))
    bulk_load.run_bulk_load(spark, str(tmp_path / "in"), **paths, now=NOW)
    count = lambda: staging.read_staging(spark, paths["staging_path"], manifest.read_manifest(spark, paths["manifest_path"])).count()
    held = staging.read_staging(spark, paths["staging_path"], manifest.read_manifest(spark, paths["manifest_path"]))
    put(tmp_path / "in", "a.csv", LINES[:1])
    staging.write_load(held.limit(1), paths["staging_path"], "half")  # a load that ended before its commit
    assert count() == 3
    assert bulk_load.reload(spark, [a], **paths, now=NOW) == ["a.csv"]
    assert count() == 1 and held.count() == 3  # a reader of the manifest before still reads what it read
    live = manifest.read_manifest(spark, paths["manifest_path"])
    assert staging.remove_dead_loads(spark, paths["staging_path"], live) == 0
    assert staging.remove_dead_loads(spark, paths["staging_path"], live, dt.timedelta(0)) == 2
    assert count() == 1 and staging.read_staging(spark, paths["staging_path"]).count() == 1


def test_stream_goes_on_after_a_refused_file(spark, tmp_path):
    lookup = spark.createDataFrame([("P1",), ("P2",)], "id string")
    put(tmp_path / "in", "good.csv")
    put(tmp_path / "in", "bad.csv", ["9,1/11/2025 0:00,M57A,1,SMALL,UNKNOWN,P1,1000", "8,1/11/2025 0:00,M71,1,SMALL,,,"])
    put(tmp_path / "in", "lacks.csv", header=HEADER.replace(",FRMP,", ',"FRMP, old",'))
    (tmp_path / "in" / "blank.csv").write_text("\n")
    args = dict(input_path=str(tmp_path / "in"), output_path=str(tmp_path / "out"), manifest_path=str(tmp_path / "manifest"), now=NOW)

    def run(state):
        ingest_stream(spark, checkpoint_path=str(tmp_path / state), lookup=lookup, rejected_path=str(tmp_path / "refused"), **args).awaitTermination()
        live = staging.read_staging(spark, args["output_path"], manifest.read_manifest(spark, args["manifest_path"]))
        return rows(live.groupBy("source_file").count()), {r["source_file"]: r for r in spark.read.parquet(str(tmp_path / "refused")).collect()}

    for state in ("s1", "s2"):
        loaded, refused = run(state)
        assert loaded == [("good.csv", 3)] and sorted(refused) == ["bad.csv", "blank.csv", "lacks.csv"]
    assert (refused["bad.csv"]["unknown_ids"], refused["bad.csv"]["blank_measures"], refused["bad.csv"]["refused_at"]) == (1, 1, NOW)
    assert "frmp" in refused["lacks.csv"]["reason"] and "empty" in refused["blank.csv"]["reason"]
    assert names_of(spark, args["manifest_path"]) == [("good.csv",)]
    put(tmp_path / "in", "later.csv")
    assert run("s1")[0] == [("good.csv", 3), ("later.csv", 3)]


def test_records_with_line_breaks_over_many_splits(spark, tmp_path):
    import csv
    import random

    rng = random.Random(9)
    folder, want = tmp_path / "in", {}
    folder.mkdir()
    for f in range(3):
        records = [[str(i), "".join(rng.choices(["a", "b", ",", '"', "\n", "\n\n", " "], k=rng.randint(1, 60))) + "z", "x" * rng.randint(1, 9)] for i in range(200)]
        records[0][1] = "a\nb" * 200  # longer than several splits
        with open(folder / f"f{f}.csv", "w", newline="") as out:
            csv.writer(out, lineterminator="\n").writerows([["ID_MTS2", "Note", "FRMP"], *records])
            out.write("\n \n")
        want[f"f{f}.csv"] = records
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        files = [str(folder / n) for n in want]
        got = raw.read_raw(spark, files, NOW, multi_line=True).select("source_file", "id_mts2", "note", "frmp").collect()
        counts = {r["source_file"]: r["raw_count"] for r in raw.raw_record_counts(spark, files).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert counts == {n: 200 for n in want}
    assert sorted(tuple(r) for r in got) == sorted((n, r[0], r[1].strip(" "), r[2]) for n, records in want.items() for r in records)  # text is trimmed


def test_quoted_header_names(spark, tmp_path):
    a = put(tmp_path / "in", "a.csv", ["1,2,3"], 'ID_MTS2,"Name, long","say ""x"""')
    b = put(tmp_path / "in", "b.csv", ["1"], "ID_MTS2")
    found = raw.header_names(raw.headers(spark, [a, b])).select("names")
    assert sorted(len(r["names"]) for r in found.collect()) == [1, 3]
    raw.require_headers(raw.headers(spark, [a, b]), [a, b], ["id_mts2"])
    with pytest.raises(ValueError, match="name_long"):
        raw.require_headers(raw.headers(spark, [a, b]), [a, b], ["name_long"])


def test_bulk_load_is_all_or_nothing_and_repeatable(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "a.csv")
    put(source, "b.csv", LINES[:1])
    put(source, "c.csv", LINES[:2])
    paths = dict(staging_path=str(tmp_path / "staging"), manifest_path=str(tmp_path / "manifest"))
    calls = []

    def fail_second(_rows, names):
        calls.append(names)
        if len(calls) == 2:
            raise RuntimeError("broken batch")

    files = [(str(source / n), 100) for n in ("a.csv", "b.csv", "c.csv")]
    with pytest.raises(RuntimeError):
        staging.load_batches(spark, files, **paths, batch_size=2, now=NOW, on_batch=fail_second)
    assert names_of(spark, paths["manifest_path"]) == [("a.csv",), ("b.csv",)]

    loaded = bulk_load.run_bulk_load(spark, str(source), **paths, snapshot_path=str(tmp_path / "snap"), batch_size=2, now=NOW)
    assert loaded == ["c.csv"]
    assert bulk_load.run_bulk_load(spark, str(source), **paths) == []
    staged = staging.read_staging(spark, paths["staging_path"], manifest.read_manifest(spark, paths["manifest_path"]))
    assert rows(staged.groupBy("source_file").count()) == [("a.csv", 3), ("b.csv", 1), ("c.csv", 2)]
    assert spark.read.csv(str(tmp_path / "snap" / "*"), header=True).count() == 2

    report = {r["source_file"]: r for r in bulk_load.audit(spark, str(source), **paths).collect()}
    assert not any(r["is_missing"] or r["has_mismatch"] for r in report.values())
    assert all(r["has_null_dates"] for r in report.values())  # two date columns are absent


def spaced(path):
    path.mkdir(exist_ok=True)
    (path / "blank.csv").write_text("\n  \n" + "\n".join([HEADER, "", *LINES[:2]]) + "\n")
    (path / "plain.csv").write_text("\n".join([HEADER, LINES[2]]) + "\n")
    (path / "empty.csv").write_text("\n")  # Spark does not list files of no bytes
    (path / "header.csv").write_text(HEADER + "\n")


def test_no_file_is_lost_to_blank_lines(spark, tmp_path):
    spaced(tmp_path / "in")
    paths = dict(staging_path=str(tmp_path / "staging"), manifest_path=str(tmp_path / "manifest"))
    assert sorted(bulk_load.run_bulk_load(spark, str(tmp_path / "in"), **paths)) == ["blank.csv", "empty.csv", "header.csv", "plain.csv"]
    staged = staging.read_staging(spark, paths["staging_path"], manifest.read_manifest(spark, paths["manifest_path"]))
    assert rows(staged.groupBy("source_file").count()) == [("blank.csv", 2), ("plain.csv", 1)]
    report = {r["source_file"]: r for r in bulk_load.audit(spark, str(tmp_path / "in"), **paths).collect()}
    assert not any(r["has_mismatch"] for r in report.values())
    gone = {r["source_file"]: r for r in bulk_load.audit(spark, str(tmp_path / "in"), paths["staging_path"], paths["manifest_path"]).collect()}
    assert gone["empty.csv"]["is_missing"] and gone["empty.csv"]["raw_count"] is None


def test_a_file_without_staged_rows_is_a_mismatch(spark, tmp_path):
    put(tmp_path / "in", "a.csv")
    put(tmp_path / "in", "b.csv")
    paths = dict(staging_path=str(tmp_path / "staging"), manifest_path=str(tmp_path / "manifest"))
    staging.load_batches(spark, [(str(tmp_path / "in" / "a.csv"), 1)], **paths, now=NOW)
    manifest.mark_done(spark, ["b.csv"], paths["manifest_path"])
    report = {r["source_file"]: r for r in bulk_load.audit(spark, str(tmp_path / "in"), **paths).collect()}
    assert report["b.csv"]["has_mismatch"] and report["b.csv"]["is_missing"] and not report["a.csv"]["has_mismatch"]


def test_stream_keeps_files_with_blank_lines(spark, tmp_path):
    spaced(tmp_path / "in")
    ingest_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "manifest"), now=NOW).awaitTermination()
    assert rows(staging.read_staging(spark, str(tmp_path / "out")).groupBy("source_file").count()) == [("blank.csv", 2), ("plain.csv", 1)]
    assert manifest.read_manifest(spark, str(tmp_path / "manifest")).count() == 4


def test_headers_take_one_job_for_any_number_of_files(spark, tmp_path):
    for i in range(12):
        put(tmp_path / "in", f"f{i}.csv")
    found = raw.headers(spark, [str(tmp_path / "in" / f"f{i}.csv") for i in range(12)])
    assert found.count() == 12 and found.select("header").distinct().count() == 1


def test_batches_by_bytes():
    files = [("a", 5), ("b", 5), ("c", 20), ("d", 1)]
    assert list(staging.batches(files, batch_bytes=10)) == [["a", "b"], ["c"], ["d"]]
    assert list(staging.batches(files, batch_size=3)) == [["a", "b", "c"], ["d"]]


@pytest.mark.parametrize("absent", ["STAT_SHORTCUT", "FRMP", "NMICLASSCODE"])
def test_extracts_without_the_gate_columns_are_refused(spark, tmp_path, absent):
    lookups_at(spark, tmp_path)
    where = monthly.Paths(raw=str(tmp_path / "in"), **{k: str(tmp_path / k) for k in ("staging", "manifest", "enriched", "entities", "codes")})
    put(tmp_path / "in", "m.csv", header=HEADER.replace(f",{absent},", ",OTHER,"))
    with pytest.raises(ValueError, match=absent.lower()):
        monthly.run_month(spark, where, now=NOW)
    assert manifest.read_manifest(spark, where.manifest).isEmpty() and not os.path.exists(where.staging)
    put(tmp_path / "in", "whole.csv")  # a good file beside it does not help
    lookup = spark.read.parquet(f"{tmp_path}/entities")
    with pytest.raises(Exception, match=absent.lower()):
        ingest_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), where.manifest, lookup, now=NOW).awaitTermination()
    assert manifest.read_manifest(spark, where.manifest).isEmpty()


def test_rows_outside_the_manifest_stay_invisible(spark, tmp_path):
    path = str(tmp_path / "staging")
    rows_in = spark.createDataFrame([("x.csv", 1), ("201801", 2)], "source_file string, id_mts2 int")
    staging.append_staging(rows_in, path)
    done = spark.createDataFrame([("201801",)], "source_file string")
    got = staging.read_staging(spark, path, done)
    assert [(r["source_file"], r["id_mts2"]) for r in got.collect()] == [("201801", 2)]


def lookups_at(spark, base):
    spark.createDataFrame(
        [("P1", "L1", "One", "Small"), ("P2", "L2", "Two", "Large")], "id string, licence_common_id string, retailer_name string, retailer_size string"
    ).write.parquet(f"{base}/entities")
    spark.createDataFrame([("1000", "Change Retailer"), ("1010", "Move-in")], "crc_code string, reporting_group string").write.parquet(f"{base}/codes")


def test_monthly_run(spark, tmp_path):
    lookups_at(spark, tmp_path)
    where = monthly.Paths(
        raw=str(tmp_path / "in"), snapshots=str(tmp_path / "snap"), missing_ids=str(tmp_path / "missing"),
        **{k: str(tmp_path / k) for k in ("staging", "manifest", "enriched", "entities", "codes")},
    )
    first = put(tmp_path / "in", "m_202509.csv", [line.replace("/10/", "/09/").replace("31/09", "30/09") for line in LINES])
    os.utime(first, (1_000_000, 1_000_000))
    assert monthly.run_month(spark, where, now=NOW) == "m_202509.csv"
    with pytest.raises(manifest.AlreadyProcessed):
        monthly.run_month(spark, where, now=NOW)
    put(tmp_path / "in", "m_202510.csv")
    assert monthly.run_month(spark, where, now=NOW) == "m_202510.csv"
    frames_out = monthly.monthly_report(spark, where)
    assert frames_out["coverage"].head()["total_records"] == 6
    assert frames_out["net_change"].filter("retailer = 'One'").head()["active_nmis"] == 500
    again = monthly.run_month(spark, where, source_file="m_202509.csv", now=dt.datetime(2025, 12, 1))
    assert again == "m_202509.csv"
    assert monthly.monthly_report(spark, where)["coverage"].head()["total_records"] == 6

    put(tmp_path / "in", "m_202511.csv", ["9,1/11/2025 0:00,M57A,1,SMALL,UNKNOWN,P1,1000"])
    os.utime(str(tmp_path / "in" / "m_202511.csv"), (3_000_000_000, 3_000_000_000))
    with pytest.raises(ValidationError):
        monthly.run_month(spark, where, now=NOW)
    assert staging.read_staging(spark, where.staging).filter("source_file = 'm_202511.csv'").isEmpty()
    assert manifest.read_manifest(spark, where.manifest).count() == 2


def test_report_from_partial_sums(spark, tmp_path):
    """Every frame is that of the full scan, and the facts of files that are summed are not read again."""
    import shutil

    lookups_at(spark, tmp_path)
    where = monthly.Paths(raw=str(tmp_path / "in"), **{k: str(tmp_path / k) for k in ("staging", "manifest", "enriched", "entities", "codes")})
    summed = monthly.Paths(**{**where.__dict__, "sums": str(tmp_path / "sums")})
    months = {"m_202508.csv": "/08/", "m_202509.csv": "/09/", "m_202510.csv": "/10/"}

    def add(name):
        put(tmp_path / "in", name, [line.replace("/10/", months[name]).replace("31/09", "30/09") for line in LINES * 2])
        monthly.run_month(spark, where, source_file=name, now=NOW)

    for name in list(months)[:2]:
        add(name)
    assert monthly.refresh_sums(spark, summed) == 2 and monthly.refresh_sums(spark, summed) == 0
    add("m_202510.csv")
    whole = {k: [tuple(r) for r in v.collect()] for k, v in monthly.monthly_report(spark, where).items()}
    for name in list(months)[:2]:
        shutil.rmtree(tmp_path / "enriched" / f"source_file={name}")
    got = {k: [tuple(r) for r in v.collect()] for k, v in monthly.monthly_report(spark, summed).items()}
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert {k: sorted(v, key=key) for k, v in got.items()} == {k: sorted(v, key=key) for k, v in whole.items()}
    assert whole["coverage"][0][0] == 18
    monthly.run_month(spark, where, source_file="m_202510.csv", now=NOW)  # loaded again: summed again, counted once
    assert monthly.monthly_report(spark, summed)["coverage"].head()["total_records"] == 18


def test_stream_ingest(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "a.csv")
    args = dict(input_path=str(source), output_path=str(tmp_path / "out"), manifest_path=str(tmp_path / "manifest"), now=NOW)

    def run(state):
        ingest_stream(spark, checkpoint_path=str(tmp_path / state), **args).awaitTermination()
        live = staging.read_staging(spark, args["output_path"], manifest.read_manifest(spark, args["manifest_path"]))
        return rows(live.groupBy("source_file").count())

    assert run("s1") == [("a.csv", 3)]
    assert run("s1") == [("a.csv", 3)]
    put(source, "b.csv", ["P1,7"], "FRMP,ID_MTS2")
    assert run("s1") == [("a.csv", 3), ("b.csv", 1)]
    assert run("s2") == [("a.csv", 3), ("b.csv", 1)]
    assert names_of(spark, args["manifest_path"]) == [("a.csv",), ("b.csv",)]


def test_stream_stops_at_the_id_gate(spark, tmp_path):
    put(tmp_path / "in", "a.csv")
    lookup = spark.createDataFrame([("P1",)], "id string")
    with pytest.raises(Exception, match="unknown ids"):
        ingest_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), lookup=lookup).awaitTermination()
    assert not (tmp_path / "out").exists()


def test_lookup_reload_export_and_frames(spark, tmp_path):
    a = spark.createDataFrame([("x", None)], "id string, v string")
    b = spark.createDataFrame([("y", "1"), ("z", "2")], "id string, v string")
    path = str(tmp_path / "lookup")
    assert (frames.reload_lookup(a, path), frames.reload_lookup(b, path)) == (1, 2)
    assert rows(frames.load_frame(spark, path)) == [("y", "1"), ("z", "2")]
    out = frames.export_results({"a": a, "b": b}, str(tmp_path / "out"))
    assert rows(spark.read.csv(out["a"], header=True)) == [("x", None)]
    assert rows(frames.save_frame(b, str(tmp_path / "f")).filter(F.col("id") == "z")) == [("z", "2")]
    with pytest.raises(ValueError):
        frames.read_view(spark)


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    df = spark.range(3).withColumn("v", F.lit(None).cast("string"))
    kept = materialize(df)
    assert kept.dtypes == df.dtypes and kept.count() == 3


def test_upsert_and_enrich_keep_groups_out_of_one_task(spark, tmp_path):
    """few files and codes, many null ids: no join may hash the facts by them, whatever the size estimates."""
    from switchflow.operators import joins

    facts = spark.createDataFrame(
        [(f"extract_{y}.csv", "P1" if y % 2 else None, "C1", "1010", y) for y in range(2000, 2006)],
        "source_file string, frmp string, newfrmp string, crcode string, n int",
    )
    people = spark.createDataFrame([("P1", "L1", "One", "Small"), ("C1", "K1", "Group", "Large")], "id string, licence_common_id string, retailer_name string, retailer_size string")
    codes = spark.createDataFrame([("1010", "Change Retailer")], "crc_code string, reporting_group string")
    target = str(tmp_path / "out")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joins.enrich(facts, people, codes)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        staging.upsert_by_source(facts, target, facts.select("source_file"), lambda df: joins.enrich(df, people, codes))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    out = spark.read.parquet(target)
    assert out.count() == 6 and out.filter("FRMP_Retailer_name = 'One'").count() == 3 and out.filter("transfer_type IS NULL").count() == 0


def test_quoted_records_across_splits_without_a_shuffle_of_lines(spark, tmp_path):
    from switchflow.sources import records

    lines = ['"a","b"']
    for i in range(60):
        lines.append(f'{i},"x\n\n""{i}"", y\nz"' if i % 3 else f"{i},plain")
    lines.append('99,"never closed\nto the end')
    path = tmp_path / "q"
    path.mkdir()
    (path / "q.csv").write_text("\n".join(lines) + "\n")
    files = [str(path / "q.csv")]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    try:
        got = [r.value for r in records.record_lines(spark, files).orderBy("block", "line").collect()]
        n = records.record_counts(spark, files).first()["n"]
        plan = records._placed(spark, files)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == lines and n == len(lines)
    assert "Exchange" not in plan
