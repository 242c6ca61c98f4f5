"""Conforming, validation, lookups, loading and streaming over the raw view."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from catalog.registry import FIN_QUARTER, FIN_YEAR, query, raw
from catalog.views import FX_ENTITY_SOURCE, FX_RAW, spark_view, table
from switchflow.functions.dates import LOCAL_ZONE, local_now
from switchflow.operators import conform as conforming
from switchflow.operators import joins, lookups, quality, reshape
from switchflow.plans import bulk_load
from switchflow.schema import STAGING, VIEW_COLUMNS
from switchflow.session import materialize, scratch_path
from switchflow.sources import frames, manifest, staging
from switchflow.sources import raw as raw_source
from switchflow.streaming.ingest import ingest_stream

NOW = dt.datetime(2025, 11, 25, 9, 30, 0)

# What the raw view has to become: conformed by plain SQL.
_NUM = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _int_sql(col: str) -> str:
    return f"CASE WHEN regexp_matches(trim({col}), '{_NUM}') THEN TRY_CAST(trunc(TRY_CAST(trim({col}) AS DOUBLE)) AS INT) END"


_DATE = "CAST(try_strptime(trim(\"STAT_DATE\"), ['%d/%m/%Y %H:%M', '%Y/%m/%d %H:%M:%S']) AS TIMESTAMP)"
_BIT = "CASE WHEN lower(trim(\"NEWLR\")) IN ('1','true','t','yes','y') THEN 1 WHEN lower(trim(\"NEWLR\")) IN ('0','false','f','no','n') THEN 0 END"


def _text(col: str) -> str:
    return f"nullif(nullif(trim({col}), ''), 'NA')"


_ID, _VALUE = _int_sql('"ID MTS2"'), _int_sql('"STAT_VALUE"')
_FRMP, _NEWFRMP = _text('"FRMP"'), _text('"NEWFRMP"')
RAW = f"WITH raw AS ({FX_RAW})"
CONF = f"""{RAW}, conf AS (SELECT {_ID} AS id_mts2, {_DATE} AS stat_date, "STAT_SHORTCUT" AS stat_shortcut, {_VALUE} AS stat_value,
 "NMIClassCode" AS nmiclasscode, {_FRMP} AS frmp, {_NEWFRMP} AS newfrmp, CAST({_BIT} AS INT) AS newlr, "CRCode" AS crcode, "SOURCE FILE" AS source_file FROM raw)"""

# `NMIClassCode` cleans to three words; extracts spell the column in capitals.
_RENAMED = {"NMIClassCode": "NMICLASSCODE", "CRCode": "CRCODE"}


def extract(spark, d):
    """The raw view with the column spelling of a real extract."""
    return raw(spark, d).withColumnsRenamed(_RENAMED)


def conformed(spark, d):
    """Staging rows straight from the raw view."""
    clean = conforming.clean_names(extract(spark, d))
    tagged = conforming.blanks_to_null(clean, ["frmp", "newfrmp"]).withColumn("date_imported", F.lit(NOW).cast("timestamp_ntz"))
    return conforming.align(conforming.convert_types(tagged), STAGING)


# --- conforming ---------------------------------------------------------------------

@query(
    "clean_names",
    f"""{RAW} SELECT "STAT_SHORTCUT" AS stat_shortcut, "NMIClassCode" AS nmi_class_code, "CRCode" AS cr_code, "SOURCE FILE" AS source_file,
 "Extra Column" AS extra_column, count(*) AS n FROM raw GROUP BY ALL""",
)
def clean_names(spark, d):
    clean = conforming.clean_names(raw(spark, d))
    return clean.groupBy("stat_shortcut", "nmi_class_code", "cr_code", "source_file", "extra_column").agg(F.count(F.lit(1)).alias("n"))


@query("mixed_dates", f"{RAW} SELECT \"STAT_DATE\" AS text, {_DATE} AS parsed FROM raw")
def mixed_dates(spark, d):
    return raw(spark, d).select(F.col("STAT_DATE").alias("text"), conforming.parse_mixed_ts(F.col("STAT_DATE")).alias("parsed"))


@query("lenient_integers", f"{RAW} SELECT \"ID MTS2\" AS text, {_ID} AS number FROM raw")
def lenient_integers(spark, d):
    return raw(spark, d).select(F.col("ID MTS2").alias("text"), conforming.to_int(F.col("ID MTS2")).alias("number"))


@query("text_to_bit", f"{RAW} SELECT \"NEWLR\" AS text, CAST({_BIT} AS INT) AS bit, count(*) AS n FROM raw GROUP BY ALL")
def text_to_bit(spark, d):
    bits = raw(spark, d).select(F.col("NEWLR").alias("text"), conforming.to_bit(F.col("NEWLR")).alias("bit"))
    return bits.groupBy("text", "bit").agg(F.count(F.lit(1)).alias("n"))


_STAGED = {
    "id_mts2": "INT", "stat_date": "TIMESTAMP", "stat_shortcut": "VARCHAR", "stat_value": "INT", "nmiclasscode": "VARCHAR", "frmp": "VARCHAR",
    "newfrmp": "VARCHAR", "newlr": "INT", "crcode": "VARCHAR", "source_file": "VARCHAR",
}
_SQL_TYPES = {"int": "INT", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


def _staging_sql() -> str:
    parts = []
    for f in STAGING:
        if f.name in _STAGED:
            parts.append(f.name)
        elif f.name == "date_imported":
            parts.append(f"TIMESTAMP '{NOW}' AS date_imported")
        else:
            parts.append(f"CAST(NULL AS {_SQL_TYPES[f.dataType.simpleString()]}) AS {f.name}")
    return f"{CONF} SELECT {', '.join(parts)} FROM conf"


@query("conform_to_staging", _staging_sql())
def conform_to_staging(spark, d):
    return conformed(spark, d)


@query(
    "stack_frames",
    f"""{CONF} SELECT source_file, frmp, CAST(NULL AS INT) AS stat_value, count(*) AS n FROM conf WHERE stat_shortcut = 'M71' GROUP BY ALL
UNION ALL SELECT source_file, NULL, CAST(stat_value AS INT), count(*) FROM conf WHERE stat_shortcut = 'M57A' GROUP BY ALL""",
)
def stack_frames(spark, d):
    rows = conformed(spark, d)
    a = rows.filter("stat_shortcut = 'M71'").groupBy("source_file", "frmp").agg(F.count(F.lit(1)).alias("n"))
    b = rows.filter("stat_shortcut = 'M57A'").groupBy("stat_value", "source_file").agg(F.count(F.lit(1)).alias("n"))
    return reshape.stack([a, b])


@query("suffixed_columns", f"{CONF} SELECT source_file, count(*) AS n_lag1w, CAST(sum(stat_value) AS BIGINT) AS v_lag1w FROM conf GROUP BY 1")
def suffixed_columns(spark, d):
    sums = conformed(spark, d).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.sum("stat_value").alias("v"))
    return reshape.suffix_columns(sums, "_lag1w", ["source_file"])


# --- lookups and the id gate ---------------------------------------------------------

_LOOKUP = f"""src AS ({FX_ENTITY_SOURCE}),
lookup AS (SELECT DISTINCT id, licence_common_id FROM (
 SELECT trim(participant_id) AS id, trim(licence) AS licence_common_id FROM src UNION ALL SELECT trim(corporation_id), trim(licence) FROM src) WHERE id <> '')"""


def entity_source(spark, d):
    return spark_view(spark, d, FX_ENTITY_SOURCE).toDF("PARTICIPANTID", "CORPORATIONID", "ESC RetailerCommonID")


@query("entity_lookup", f"WITH {_LOOKUP} SELECT * FROM lookup")
def entity_lookup(spark, d):
    return lookups.build_entity_lookup(entity_source(spark, d))


@query(
    "unify_ids",
    f"""WITH src AS ({FX_ENTITY_SOURCE}) SELECT licence AS licence_common_id, id_type, id FROM (
 SELECT licence, 'participant_id' AS id_type, participant_id AS id FROM src UNION ALL SELECT licence, 'corporation_id', corporation_id FROM src) WHERE trim(id) <> ''""",
)
def unify_ids(spark, d):
    source = spark_view(spark, d, FX_ENTITY_SOURCE).withColumnRenamed("licence", "licence_common_id")
    return reshape.unify_ids(source, ["participant_id", "corporation_id"], ["licence_common_id"])


_CODES = """codes0 AS (SELECT concat(' ', CAST(1000 + 10 * l_linenumber AS VARCHAR(4)), ' ') AS "CRC_Code", CASE WHEN l_linenumber < 5 THEN 'Change' ELSE 'Move' END AS "Event",
 l_returnflag AS "Sub_event", l_linestatus AS "Description", CAST(NULL AS VARCHAR(9)) AS "Further_details", CAST(l_orderkey AS VARCHAR(20)) AS "Version",
 CASE WHEN l_linenumber = 7 THEN 'Other' WHEN l_linenumber < 5 THEN 'Change Retailer' ELSE 'Move-in' END AS "Reporting_group", l_orderkey AS k FROM lineitem
 UNION ALL SELECT ' ', 'x', 'x', 'x', 'x', 'x', 'x', CAST(0 AS BIGINT) FROM region)"""


def code_source(spark, d):
    sql = _CODES.removeprefix("codes0 AS (").removesuffix(")")
    return spark_view(spark, d, sql)


@query(
    "code_lookup",
    f"""WITH {_CODES}, c AS (SELECT trim("CRC_Code") AS crc_code, trim("Event") AS event, trim("Sub_event") AS sub_event, trim("Description") AS description,
 trim("Further_details") AS further_details, trim("Version") AS version, trim("Reporting_group") AS reporting_group, k FROM codes0)
SELECT * EXCLUDE (k, rn) FROM (SELECT *, row_number() OVER (PARTITION BY crc_code ORDER BY k, event, sub_event, description, further_details, version, reporting_group) AS rn
 FROM c WHERE crc_code <> '') WHERE rn = 1""",
)
def code_lookup(spark, d):
    return lookups.build_code_lookup(code_source(spark, d), order=["k"])


@query(
    "first_by_key",
    """SELECT s_nationkey, s_suppkey, s_name FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS rn FROM supplier) WHERE rn = 1""",
)
def first_by_key(spark, d):
    return reshape.first_by_key(table(spark, d, "supplier"), "s_nationkey", ["s_acctbal"]).select("s_nationkey", "s_suppkey", "s_name")


_CHECKED = """ids AS (SELECT DISTINCT stat_shortcut, 'FRMP' AS id_type, trim(frmp) AS missing_id FROM conf WHERE nmiclasscode = 'SMALL'
 UNION SELECT DISTINCT stat_shortcut, 'NEWFRMP', trim(newfrmp) FROM conf WHERE nmiclasscode = 'SMALL' AND stat_shortcut = 'M57A')"""


@query(
    "missing_ids",
    f"{CONF}, {_LOOKUP}, {_CHECKED} SELECT * FROM ids WHERE missing_id <> '' AND missing_id NOT IN (SELECT id FROM lookup) ORDER BY ALL",
)
def missing_ids(spark, d):
    return quality.missing_ids(conformed(spark, d), entity_lookup(spark, d))


@query(
    "id_gate",
    f"""{CONF}, {_LOOKUP}, {_CHECKED} SELECT count(*) > 0 AS refused, count(*) AS n_reported, (SELECT count(DISTINCT stat_shortcut) FROM ids WHERE id_type = 'FRMP' AND coalesce(missing_id, '') = '') AS n_blank
 FROM ids WHERE missing_id <> '' AND missing_id NOT IN (SELECT id FROM lookup)""",
)
def id_gate(spark, d):
    """The gate's verdict and the size of the report it leaves behind."""
    rows, path = conformed(spark, d), scratch_path(spark, "missing-ids")
    try:
        quality.assert_ids(rows, entity_lookup(spark, d), path)
        refused = False
    except quality.ValidationError:
        refused = True
    report = spark.read.csv(path, header=True, schema="stat_shortcut string, id_type string, missing_id string")
    blank = quality.blank_ids(quality.checked_ids(rows)).agg(F.count(F.lit(1))).scalar()
    return report.agg(F.lit(refused).alias("refused"), F.count(F.lit(1)).alias("n_reported"), blank.alias("n_blank"))


# --- audit ---------------------------------------------------------------------------

_MANIFEST = """manifest AS (SELECT DISTINCT source_file FROM conf WHERE source_file <> 'extract_1996.csv' UNION SELECT 'extract_1900.csv')"""


def some_done(spark, d):
    """A manifest that misses one loaded file and lists one that is not there."""
    names = extract(spark, d).select(F.col("SOURCE FILE").alias("source_file")).distinct().filter("source_file <> 'extract_1996.csv'")
    ghost = table(spark, d, "region").select(F.lit("extract_1900.csv").alias("source_file")).distinct()
    return names.union(ghost)


def raw_counts(spark, d):
    """Raw counts that disagree for one file and lack another."""
    counts = extract(spark, d).groupBy(F.col("SOURCE FILE").alias("source_file")).agg(F.count(F.lit(1)).alias("raw_count"))
    more = F.when(F.col("source_file") == "extract_1997.csv", 1).otherwise(0)
    return counts.filter("source_file <> 'extract_1998.csv'").withColumn("raw_count", F.col("raw_count") + more)


_RAWC = """rawc AS (SELECT source_file, count(*) + CASE WHEN source_file = 'extract_1997.csv' THEN 1 ELSE 0 END AS raw_count
 FROM conf WHERE source_file <> 'extract_1998.csv' GROUP BY 1)"""


@query(
    "verify_presence",
    f"{CONF}, {_MANIFEST} SELECT source_file, n AS row_count, n IS NULL AS is_missing FROM manifest LEFT JOIN (SELECT source_file, count(*) AS n FROM conf GROUP BY 1) USING (source_file)",
)
def verify_presence(spark, d):
    return quality.verify_presence(conformed(spark, d), some_done(spark, d))


# Files from 1996 on have the other two dates too; one of them has every date.
_DATED = """dated AS (SELECT source_file, CASE WHEN source_file = 'extract_1997.csv' THEN coalesce(stat_date, TIMESTAMP '1997-01-01') ELSE stat_date END AS stat_date,
 CASE WHEN source_file >= 'extract_1996' THEN 1 END AS p, CASE WHEN source_file >= 'extract_1996' AND (source_file = 'extract_1997.csv' OR stat_value % 3 = 0) THEN 1 END AS q FROM conf)"""


def dated(spark, d):
    rows, late = conformed(spark, d), F.col("source_file") >= "extract_1996"
    whole, day = F.col("source_file") == "extract_1997.csv", F.lit("1997-01-01 00:00:00").cast(rows_type(rows, "stat_date"))
    return rows.withColumns(
        {
            "stat_date": F.when(whole, F.coalesce("stat_date", day)).otherwise(F.col("stat_date")),
            "processingdt": F.when(late, day),
            "maintcreatedt": F.when(late & (whole | (F.col("stat_value") % 3 == 0)), day),
        }
    )


def rows_type(rows, column):
    return rows.schema[column].dataType


@query(
    "verify_dates",
    f"{CONF}, {_DATED} SELECT source_file, count(*) AS row_count, count(*) - count(stat_date) AS stat_date_nulls, count(*) - count(p) AS processingdt_nulls, count(*) - count(q) AS maintcreatedt_nulls FROM dated GROUP BY 1",
)
def verify_dates(spark, d):
    return quality.verify_dates(dated(spark, d))


@query(
    "verify_counts",
    f"{CONF}, {_RAWC} SELECT source_file, row_count, raw_count, row_count - raw_count AS diff FROM (SELECT source_file, count(*) AS row_count FROM conf GROUP BY 1) LEFT JOIN rawc USING (source_file)",
)
def verify_counts(spark, d):
    return quality.verify_counts(conformed(spark, d), raw_counts(spark, d))


@query(
    "verification_report",
    f"""{CONF}, {_MANIFEST}, {_RAWC}, {_DATED}, a AS (SELECT source_file, count(*) AS row_count, count(stat_date) < count(*) OR count(p) < count(*) OR count(q) < count(*) AS nulls FROM dated GROUP BY 1),
c AS (SELECT * FROM rawc UNION ALL SELECT 'extract_1900.csv', 7)
SELECT source_file, row_count, raw_count, row_count IS NULL AS is_missing, coalesce(nulls, FALSE) AS has_null_dates,
 coalesce(coalesce(row_count, 0) <> raw_count, FALSE) AS has_mismatch, coalesce(row_count, 0) - raw_count AS diff FROM manifest LEFT JOIN a USING (source_file) LEFT JOIN c USING (source_file)""",
)
def verification_report(spark, d):
    """One file is clean, one has no staged rows though its raw copy has lines."""
    ghost = table(spark, d, "region").select(F.lit("extract_1900.csv").alias("source_file"), F.lit(7).cast("long").alias("raw_count")).distinct()
    return quality.verification_report(dated(spark, d), some_done(spark, d), raw_counts(spark, d).union(ghost))


@query("converted_types", f"{CONF} SELECT CAST(year(stat_date) AS INT) AS yr, count(*) AS n, CAST(sum(stat_value) AS BIGINT) AS v, count(frmp) AS n_from FROM conf GROUP BY ALL")
def converted_types(spark, d):
    """Types are parsed for the typed columns that a frame has, here two of them."""
    some = conforming.clean_names(extract(spark, d).select("STAT_DATE", "STAT_VALUE", "FRMP"))
    rows = conforming.convert_types(conforming.blanks_to_null(some))
    return rows.groupBy(F.year("stat_date").alias("yr")).agg(F.count(F.lit(1)).alias("n"), F.sum("stat_value").alias("v"), F.count("frmp").alias("n_from"))


@query("required_columns", f"{CONF} SELECT stat_shortcut, count(*) AS n, 'frmp, nmiclasscode' AS refused FROM conf GROUP BY ALL")
def required_columns(spark, d):
    """A frame with the gate's columns passes; one without two of them is refused, by name."""
    rows, refused = conformed(spark, d), None
    conforming.require_columns(rows, quality.GATE_COLUMNS)
    try:
        conforming.require_columns(rows.drop("frmp", "nmiclasscode"), quality.GATE_COLUMNS)
    except ValueError as e:
        refused = str(e).rpartition(": ")[2]
    return rows.groupBy("stat_shortcut").agg(F.count(F.lit(1)).alias("n")).withColumn("refused", F.lit(refused))


@query("import_stamp", f"{CONF} SELECT source_file, count(*) AS n, TRUE AS one_stamp, TRUE AS local_time FROM conf GROUP BY ALL")
def import_stamp(spark, d):
    """Rows of a load carry one stamp: the wall clock of the zone, without a zone, to the second."""
    rows = extract(spark, d).select(F.col("SOURCE FILE").alias("source_file")).withColumn("at", local_now())
    here = F.from_utc_timestamp(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), LOCAL_ZONE).cast("timestamp_ntz")
    near = F.abs(F.timestamp_diff("SECOND", F.col("at"), here)) < 600
    whole = F.col("at") == F.date_trunc("second", "at")
    return rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), (F.countDistinct("at") == 1).alias("one_stamp"), F.bool_and(near & whole).alias("local_time"))


# --- manifest --------------------------------------------------------------------------

_FILES = f"{RAW}, files AS (SELECT DISTINCT \"SOURCE FILE\" AS source_file FROM raw), done AS (SELECT source_file FROM files WHERE source_file < 'extract_1998')"


def files_of(spark, d):
    return extract(spark, d).select(F.col("SOURCE FILE").alias("source_file")).distinct()


def done_of(spark, d):
    return files_of(spark, d).filter("source_file < 'extract_1998'")


@query("manifest_remaining", f"{_FILES} SELECT source_file FROM files EXCEPT SELECT source_file FROM done")
def manifest_remaining(spark, d):
    return manifest.remaining_files(files_of(spark, d), done_of(spark, d))


@query("manifest_difference", f"{_FILES} SELECT source_file FROM files EXCEPT SELECT source_file FROM done")
def manifest_difference(spark, d):
    return reshape.set_difference(files_of(spark, d), done_of(spark, d))


@query("manifest_add", f"{_FILES} SELECT source_file FROM done UNION SELECT source_file FROM files WHERE source_file < 'extract_1999'")
def manifest_add(spark, d):
    return manifest.add_done(done_of(spark, d), files_of(spark, d).filter("source_file < 'extract_1999'"))


@query("already_processed", f"{_FILES} SELECT upper(source_file) || ' ' AS source_file FROM done")
def already_processed(spark, d):
    messy = files_of(spark, d).select(F.concat(F.upper("source_file"), F.lit(" ")).alias("source_file"))
    return manifest.already_processed(messy, done_of(spark, d))


@query("semi_keep", f"{CONF} SELECT source_file, count(*) AS n FROM conf WHERE source_file < 'extract_1998' GROUP BY 1")
def semi_keep(spark, d):
    return joins.semi_keep(conformed(spark, d), done_of(spark, d), ["source_file"]).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))


@query("anti_drop", f"{CONF} SELECT source_file, count(*) AS n FROM conf WHERE source_file >= 'extract_1998' GROUP BY 1")
def anti_drop(spark, d):
    return joins.anti_drop(conformed(spark, d), done_of(spark, d), ["source_file"]).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))


# --- tables, loads, stream ---------------------------------------------------------------

_BY_FILE = "source_file, count(*) AS n, CAST(sum(stat_value) AS BIGINT) AS v, count(stat_date) AS n_dates"


def by_file(df):
    return df.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.sum("stat_value").alias("v"), F.count("stat_date").alias("n_dates"))


@query("staging_visible", f"{CONF}, {_MANIFEST} SELECT {_BY_FILE} FROM conf WHERE source_file IN (SELECT source_file FROM manifest) GROUP BY 1")
def staging_visible(spark, d):
    """Rows of files outside the manifest are on disk but not visible."""
    path = scratch_path(spark, "staging")
    staging.append_staging(conformed(spark, d), path)
    return by_file(staging.read_staging(spark, path, some_done(spark, d)))


@query("staging_replaced", f"{CONF} SELECT {_BY_FILE} FROM conf GROUP BY 1")
def staging_replaced(spark, d):
    """Loading everything and then one file again leaves each row once."""
    path = scratch_path(spark, "staging")
    rows = conformed(spark, d)
    staging.replace_sources(rows, path)
    staging.replace_sources(rows.filter("source_file = 'extract_1997.csv'"), path)
    return by_file(staging.read_staging(spark, path))


def write_extracts(spark, d) -> str:
    """The raw view as CSV files; half the rows in files of another column order."""
    path = scratch_path(spark, "extracts")
    rows = extract(spark, d).drop("SOURCE FILE")
    even = F.coalesce(F.col("STAT_VALUE").rlike("[02468]$"), F.lit(False))
    rows.filter(even).write.csv(path, header=True, mode="append")
    rows.filter(~even).select(*rows.columns[::-1]).write.csv(path, header=True, mode="append")
    return path


_TOTALS = """CAST(year(stat_date) AS INT) AS yr, stat_shortcut, count(*) AS n, CAST(sum(stat_value) AS BIGINT) AS v, CAST(sum(newlr) AS BIGINT) AS bits,
 count(frmp) AS n_from, count(newfrmp) AS n_to"""


def totals(df):
    return df.groupBy(F.year("stat_date").alias("yr"), "stat_shortcut").agg(
        F.count(F.lit(1)).alias("n"), F.sum("stat_value").alias("v"), F.sum("newlr").alias("bits"),
        F.count("frmp").alias("n_from"), F.count("newfrmp").alias("n_to"),
    )


@query("read_raw_csv", f"{CONF} SELECT {_TOTALS} FROM conf GROUP BY ALL")
def read_raw_csv(spark, d):
    """CSV files with two column orders, read by name and conformed."""
    return totals(conforming.conform(raw_source.read_raw(spark, write_extracts(spark, d), NOW)))


@query("read_quoted_breaks", f"{CONF} SELECT {_TOTALS}, (SELECT count(*) FROM conf) AS n_records, (SELECT count(*) FROM conf) AS n_notes FROM conf GROUP BY ALL")
def read_quoted_breaks(spark, d):
    """CSV files whose records have line breaks, quotes and commas inside quotes."""
    path = scratch_path(spark, "quoted")
    rows = extract(spark, d).drop("SOURCE FILE")
    note = F.concat(F.lit("first, line\nsecond ""line"" of "), F.coalesce(F.col("`ID MTS2`").cast("string"), F.lit("none")), F.lit("\n\nlast"))
    rows.withColumn("Note", note).write.csv(path, header=True, quoteAll=True, escape='"')
    files = [r["path"] for r in raw_source.list_inputs(spark, path).select("path").collect()]
    text = materialize(raw_source.read_raw(spark, files, NOW, multi_line=True), "quoted")
    n = raw_source.raw_record_counts(spark, files).agg(F.sum("raw_count")).scalar()
    whole = text.agg(F.count_if(F.col("note").rlike(r"(?s)^first, line\nsecond .* of .*\n\nlast$"))).scalar()
    return totals(conforming.conform(text)).withColumn("n_records", n).withColumn("n_notes", whole)


@query("bulk_load", f"{CONF} SELECT {_TOTALS} FROM conf GROUP BY ALL")
def bulk(spark, d):
    """Batches of files into staging; a second run finds nothing left to do."""
    source, base = write_extracts(spark, d), scratch_path(spark, "bulk")
    for _ in range(2):
        bulk_load.run_bulk_load(spark, source, f"{base}/staging", f"{base}/manifest", batch_size=1, now=NOW)
    return totals(staging.read_staging(spark, f"{base}/staging", manifest.read_manifest(spark, f"{base}/manifest")))


@query(
    "bulk_audit",
    f"{CONF} SELECT FALSE AS is_missing, TRUE AS has_null_dates, FALSE AS has_mismatch, count(*) AS row_count FROM conf",
)
def bulk_audit(spark, d):
    source, base = write_extracts(spark, d), scratch_path(spark, "audit")
    bulk_load.run_bulk_load(spark, source, f"{base}/staging", f"{base}/manifest", now=NOW, batch_size=50)
    out = bulk_load.audit(spark, source, f"{base}/staging", f"{base}/manifest")
    return out.groupBy("is_missing", "has_null_dates", "has_mismatch").agg(F.sum("row_count").alias("row_count"))


def write_spaced(spark, d) -> str:
    """The raw view as CSV files that start with a blank line, a file with a header alone, and one with a blank line alone."""
    path = scratch_path(spark, "spaced")
    rows = extract(spark, d).drop("SOURCE FILE")
    header = F.lit(",".join(rows.columns))
    line = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in rows.columns])
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    lines = rows.select(F.explode(F.when(first, F.array(F.lit(""), header, line)).otherwise(F.array(line))).alias("line"))
    plain = {"sep": "\x01", "emptyValue": "", "quote": ""}
    one = table(spark, d, "region").limit(1)
    for frame in (lines, one.select(header.alias("line")), one.select(F.lit("").alias("line"))):
        frame.write.options(**plain).csv(path, mode="append")
    return path


@query("bulk_load_spaced", f"{CONF} SELECT {_TOTALS} FROM conf GROUP BY ALL")
def bulk_load_spaced(spark, d):
    """No row is lost to blank first lines, empty files or header-only files."""
    source, base = write_spaced(spark, d), scratch_path(spark, "bulk")
    bulk_load.run_bulk_load(spark, source, f"{base}/staging", f"{base}/manifest", now=NOW)
    return totals(staging.read_staging(spark, f"{base}/staging", manifest.read_manifest(spark, f"{base}/manifest")))


@query("bulk_audit_spaced", f"{CONF} SELECT FALSE AS has_mismatch, count(*) AS row_count FROM conf")
def bulk_audit_spaced(spark, d):
    source, base = write_spaced(spark, d), scratch_path(spark, "audit")
    bulk_load.run_bulk_load(spark, source, f"{base}/staging", f"{base}/manifest", now=NOW)
    out = bulk_load.audit(spark, source, f"{base}/staging", f"{base}/manifest")
    return out.groupBy("has_mismatch").agg(F.sum("row_count").alias("row_count"))


@query("stream_ingest", f"{CONF} SELECT {_TOTALS} FROM conf GROUP BY ALL")
def stream_ingest(spark, d):
    """The file stream, run twice and then replayed from the start: each row once."""
    source, base = write_extracts(spark, d), scratch_path(spark, "stream")
    for run in ("a", "a", "b"):
        ingest_stream(spark, source, f"{base}/out", f"{base}/state-{run}", now=NOW).awaitTermination()
    return totals(staging.read_staging(spark, f"{base}/out"))


@query("failed_reload", f"{CONF} SELECT {_TOTALS} FROM conf GROUP BY ALL")
def failed_reload(spark, d):
    """All files loaded, then again by a run that fails half way: readers still see the first load, and no row twice."""
    source, base = write_extracts(spark, d), scratch_path(spark, "reload")
    bulk_load.run_bulk_load(spark, source, f"{base}/staging", f"{base}/manifest", now=NOW)
    rows = conforming.conform(raw_source.read_raw(spark, source, NOW))
    broken = F.when(F.col("stat_value") % 97 == 13, F.raise_error(F.lit("the disk is full"))).otherwise(F.col("stat_value"))
    try:
        staging.write_load(rows.filter("stat_value < 40"), f"{base}/staging", "half")  # what had come through
        staging.write_load(rows.withColumn("stat_value", broken.cast("int")), f"{base}/staging", "half")
        raise AssertionError("the second load should have failed")
    except PySparkException:
        pass
    return totals(staging.read_staging(spark, f"{base}/staging", manifest.read_manifest(spark, f"{base}/manifest")))


@query("reloaded", f"{CONF} SELECT {_TOTALS} FROM conf GROUP BY ALL")
def reloaded(spark, d):
    """Files loaded short of half their rows, then replaced by the whole ones under the same names, and dead loads removed."""
    source, base = write_extracts(spark, d), scratch_path(spark, "reload")
    paths = [r["path"] for r in raw_source.list_inputs(spark, source).select("path").collect()]
    rows = conforming.conform(raw_source.read_raw(spark, paths, NOW)).filter("stat_value % 2 = 0")
    staging.write_load(rows, f"{base}/staging", "short")
    done = raw_source.list_inputs(spark, source).select("source_file", F.lit("short").alias("load"))
    manifest.commit(spark, f"{base}/manifest", done)
    bulk_load.reload(spark, paths, f"{base}/staging", f"{base}/manifest", NOW)
    live = manifest.read_manifest(spark, f"{base}/manifest")
    staging.remove_dead_loads(spark, f"{base}/staging", live, dt.timedelta(0))
    return totals(staging.read_staging(spark, f"{base}/staging").filter("source_file IS NOT NULL"))


@query("two_loaders", f"{CONF} SELECT {_TOTALS} FROM conf GROUP BY ALL")
def two_loaders(spark, d):
    """A second run loads everything while the first one is at its first batch: each file is visible once."""
    source, base = write_extracts(spark, d), scratch_path(spark, "loaders")
    files = [(r["path"], 1) for r in raw_source.list_inputs(spark, source).orderBy("path").collect()]
    where = (f"{base}/staging", f"{base}/manifest")
    second = []

    def meanwhile(_rows, _names):
        if not second:
            second.extend(bulk_load.run_bulk_load(spark, source, *where, now=NOW))

    first = staging.load_batches(spark, files, *where, now=NOW, on_batch=meanwhile)
    if first or len(second) != len(files):
        raise AssertionError("the second run should have all files")
    return totals(staging.read_staging(spark, where[0], manifest.read_manifest(spark, where[1])))


@query("stream_quarantine", f"""{CONF}, bad AS (SELECT 1 AS n) SELECT {_TOTALS}, (SELECT CAST(5 AS BIGINT) FROM bad) AS unknown_ids, 'missing required columns: frmp' AS lacking FROM conf GROUP BY ALL""")
def stream_quarantine(spark, d):
    """Good extracts in a batch with one of five unknown ids and one without a column: both are refused, the rest is loaded."""
    source, base = scratch_path(spark, "extracts"), scratch_path(spark, "quarantine")
    # The gate looks at small customers alone: rows without a losing id are made large ones.
    blank = F.coalesce(F.trim("FRMP").isin("", "NA"), F.lit(True))
    rows = extract(spark, d).drop("SOURCE FILE").withColumn("NMICLASSCODE", F.when(blank, "LARGE").otherwise(F.col("NMICLASSCODE")))
    rows.write.csv(source, header=True)
    lookup = rows.select(F.explode(F.array("FRMP", "NEWFRMP")).alias("id")).distinct()
    table(spark, d, "region").limit(1).select(F.explode(F.sequence(F.lit(1), F.lit(5))).alias("i")).select(
        F.lit("1/10/2025 0:00").alias("STAT_DATE"), F.lit("M71").alias("STAT_SHORTCUT"), F.lit(7).alias("STAT_VALUE"), F.lit("SMALL").alias("NMICLASSCODE"), F.concat(F.lit("nobody "), "i").alias("FRMP")
    ).coalesce(1).write.csv(source, header=True, mode="append")
    rows.limit(1).select("STAT_DATE", "STAT_SHORTCUT", "NMICLASSCODE").coalesce(1).write.csv(source, header=True, mode="append")
    ingest_stream(spark, source, f"{base}/out", f"{base}/state", f"{base}/manifest", lookup, now=NOW, rejected_path=f"{base}/refused").awaitTermination()
    refused = spark.read.parquet(f"{base}/refused")
    lacking = F.regexp_extract("reason", "^(missing required columns: [a-z_, ]*) in a file", 1)
    said = materialize(refused.agg(F.max("unknown_ids").alias("unknown_ids"), F.max(lacking).alias("lacking"), F.count("*").alias("n")), "refused")
    if said.head()["n"] != 2:
        raise AssertionError("two files should have been refused")
    loaded = totals(staging.read_staging(spark, f"{base}/out", manifest.read_manifest(spark, f"{base}/manifest")))
    return loaded.withColumn("unknown_ids", said.select("unknown_ids").scalar()).withColumn("lacking", said.select("lacking").scalar())


@query("reload_lookup", f"WITH {_LOOKUP} SELECT id, licence_common_id, (SELECT count(*) FROM lookup) AS n FROM lookup")
def reload_lookup(spark, d):
    path = scratch_path(spark, "lookup")
    lookup = entity_lookup(spark, d)
    frames.reload_lookup(lookup.limit(3), path)
    n = frames.reload_lookup(lookup, path)
    return frames.load_frame(spark, path).withColumn("n", F.lit(n).cast("long"))


@query("saved_frame", f"{CONF} SELECT {_BY_FILE} FROM conf GROUP BY 1")
def saved_frame(spark, d):
    return frames.save_frame(by_file(conformed(spark, d)), scratch_path(spark, "frame"))


@query("snapshot_csv", f"{CONF} SELECT source_file, count(*) AS n, count(frmp) AS n_from, count(processingdt) AS n_processing FROM (SELECT *, NULL AS processingdt FROM conf) GROUP BY 1")
def snapshot_csv(spark, d):
    """Nulls leave as empty fields and come back as nulls."""
    path = frames.write_snapshot(conformed(spark, d), scratch_path(spark, "snapshots"), "20251125_093000")
    back = spark.read.csv(path, header=True)
    return back.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.count("frmp").alias("n_from"), F.count("processingdt").alias("n_processing")
    )


@query("exported_results", f"{CONF} SELECT source_file, CAST(count(*) AS VARCHAR) AS n FROM conf GROUP BY 1")
def exported_results(spark, d):
    counts = conformed(spark, d).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
    paths = frames.export_results({"counts": counts}, scratch_path(spark, "results"))
    return spark.read.csv(paths["counts"], header=True)


_PEOPLE = """SELECT concat('P', CAST(s_suppkey AS VARCHAR(20))) AS id, concat('L', CAST(s_nationkey AS VARCHAR(20))) AS licence_common_id, n_name AS retailer_name,
 CASE s_nationkey % 4 WHEN 0 THEN 'Small' WHEN 1 THEN 'Medium' WHEN 2 THEN 'Large' END AS retailer_size FROM supplier JOIN nation ON s_nationkey = n_nationkey
 UNION ALL SELECT concat('C', CAST(n_nationkey AS VARCHAR(20))), concat('K', CAST(n_regionkey AS VARCHAR(20))), concat('Group ', n_name),
 CASE n_regionkey WHEN 0 THEN 'Small' WHEN 1 THEN 'Large' END FROM nation WHERE n_nationkey <> 9"""
_VIEW_KEYS = """Year, Month, FinYear, FinYearQuarter, stat_shortcut, crcode, ESC_FRMP, ESC_NEWFRMP, FRMP_Retailer_name, NEWFRMP_Retailer_name,
 FRMP_Retailer_size, NEWFRMP_Retailer_size, transfer_type"""
_VIEW_SQL = f"""{CONF}, people AS ({_PEOPLE}), v AS (SELECT conf.* REPLACE (CAST(stat_date AS DATE) AS stat_date), CAST(year(stat_date) AS INT) AS Year, CAST(month(stat_date) AS INT) AS Month,
 {FIN_YEAR} AS FinYear, {FIN_QUARTER} AS FinYearQuarter, f.licence_common_id AS ESC_FRMP, f.retailer_name AS FRMP_Retailer_name, f.retailer_size AS FRMP_Retailer_size,
 t.licence_common_id AS ESC_NEWFRMP, t.retailer_name AS NEWFRMP_Retailer_name, t.retailer_size AS NEWFRMP_Retailer_size,
 CASE WHEN crcode IN ('1010','1020','1030','1040') THEN 'Change Retailer' WHEN crcode IN ('1050','1060') THEN 'Move-in' ELSE 'Other' END AS transfer_type
 FROM conf LEFT JOIN people f ON f.id = conf.frmp LEFT JOIN people t ON t.id = conf.newfrmp)
SELECT {_VIEW_KEYS}, count(*) AS n, CAST(sum(stat_value) AS BIGINT) AS v, CAST(sum(id_mts2) AS BIGINT) AS ids, min(stat_date) AS first_date, max(stat_date) AS last_date,
 count(frmp) AS n_from, count(newfrmp) AS n_to, min(frmp) AS min_from, max(newfrmp) AS max_to, CAST(0 AS BIGINT) AS n_lnsp, CAST(0 AS BIGINT) AS n_lr FROM v GROUP BY ALL"""


def people(spark, d):
    return spark_view(spark, d, _PEOPLE)


def view_totals(df):
    """Every column of the view: the labels as keys, the rest summed or counted."""
    keys = [c.strip() for c in _VIEW_KEYS.split(",")]
    count = {"n_from": "frmp", "n_to": "newfrmp", "n_lnsp": "lnsp", "n_lr": "lr"}
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("stat_value").alias("v"), F.sum("id_mts2").alias("ids"),
        F.min("stat_date").alias("first_date"), F.max("stat_date").alias("last_date"),
        F.min("frmp").alias("min_from"), F.max("newfrmp").alias("max_to"), *[F.count(c).alias(n) for n, c in count.items()],
    )


@query("enriched_view", _VIEW_SQL)
def enriched_view(spark, d):
    """Movements with names, sizes and reason groups, read through the 20-column view."""
    full = joins.enrich(frames.with_calendar(conformed(spark, d)), people(spark, d), code_lookup(spark, d))
    full.createOrReplaceTempView("switchflow_enriched")
    return view_totals(frames.read_view(spark, table="switchflow_enriched").select(*VIEW_COLUMNS))


@query("upsert_by_source", _VIEW_SQL)
def upsert_by_source(spark, d):
    """All files' rows enriched and written, then one file's again: the result is that of once."""
    base = scratch_path(spark, "upsert")
    staging.replace_sources(conformed(spark, d), f"{base}/staging")
    staged = staging.read_staging(spark, f"{base}/staging")
    persons, codes = people(spark, d), code_lookup(spark, d)
    names = staged.select("source_file").distinct()
    for files in (names, "extract_1997.csv"):
        staging.upsert_by_source(staged, f"{base}/out", files, lambda df: joins.enrich(frames.with_calendar(df), persons, codes))
    return view_totals(frames.read_view(spark, path=f"{base}/out"))


@query("listed_files", f"{CONF} SELECT count(*) AS n_rows, 3 AS n_files, TRUE AS all_csv, 1 AS n_newest, TRUE AS newest_came_last FROM conf")
def listed_files(spark, d):
    """Two files, and later a third one: three are listed, with all rows, and the third is the newest."""
    path, rows = scratch_path(spark, "listed"), extract(spark, d).withColumn("even", F.coalesce(F.col("STAT_VALUE").rlike("[02468]$"), F.lit(False)))
    rows.filter("even").repartition(2).write.csv(path, header=True)
    before = raw_source.list_inputs(spark, path).select("source_file").collect()  # two names
    time.sleep(1.1)  # file times may have whole seconds
    rows.filter("NOT even").repartition(1).write.csv(path, header=True, mode="append")
    files = raw_source.list_inputs(spark, path)
    newest = raw_source.newest_file(files)
    late = ~F.col("source_file").isin([r[0] for r in before])
    n_rows = raw_source.raw_line_counts(spark, path).agg(F.sum("raw_count")).scalar()
    return files.agg(
        n_rows.alias("n_rows"),
        F.count(F.lit(1)).cast("int").alias("n_files"),
        F.bool_and(F.col("source_file").endswith(".csv")).alias("all_csv"),
        newest.agg(F.count(F.lit(1))).scalar().cast("int").alias("n_newest"),
        newest.agg(F.bool_and(late)).scalar().alias("newest_came_last"),
    )
