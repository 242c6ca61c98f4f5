"""The library's inputs expressed over the driver's star-schema tables.

Each view exists once as SQL text that Spark and DuckDB both run; `spark_view` runs it
on Spark. Nothing here is materialised: queries on top prune columns and push filters
through the view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FX_TRANSFERS = """
SELECT l_orderkey*10+l_linenumber AS id_mts2, CAST(l_shipdate AS DATE) AS stat_date,
 CAST(year(l_shipdate) AS INT) AS Year, CAST(month(l_shipdate) AS INT) AS Month,
 'M57A' AS stat_shortcut, CAST(l_quantity AS INT) AS stat_value,
 CAST(1000+10*l_linenumber AS VARCHAR(4)) AS crcode,
 CASE WHEN fn.n_nationkey=24 THEN NULL ELSE fn.n_name END AS FRMP_Retailer_name,
 CASE WHEN tn.n_nationkey=23 THEN NULL ELSE tn.n_name END AS NEWFRMP_Retailer_name,
 CASE fn.n_nationkey % 4 WHEN 0 THEN 'Small' WHEN 1 THEN 'Medium' WHEN 2 THEN 'Large' END AS FRMP_Retailer_size,
 CASE tn.n_nationkey % 4 WHEN 0 THEN 'Small' WHEN 1 THEN 'Medium' WHEN 2 THEN 'Large' END AS NEWFRMP_Retailer_size,
 CASE l_returnflag WHEN 'A' THEN 'Change Retailer' WHEN 'N' THEN 'Move-in' ELSE 'Other' END AS transfer_type
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey
 JOIN supplier ON l_suppkey=s_suppkey
 JOIN nation fn ON c_nationkey=fn.n_nationkey JOIN nation tn ON s_nationkey=tn.n_nationkey
UNION ALL
SELECT o_orderkey*10 AS id_mts2, CAST(last_day(CAST(o_orderdate AS DATE)) AS DATE) AS stat_date,
 CAST(year(o_orderdate) AS INT), CAST(month(o_orderdate) AS INT),
 'M71', 500, NULL, CASE WHEN n_nationkey=24 THEN NULL ELSE n_name END, NULL,
 CASE n_nationkey % 4 WHEN 0 THEN 'Small' WHEN 1 THEN 'Medium' WHEN 2 THEN 'Large' END, NULL, NULL
FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey
"""

FX_OFFERS = """
SELECT l_orderkey AS offer_id, n_name AS retailer, CAST(l_shipdate AS DATE) AS identifier_date,
 CAST(l_shipdate AS DATE) - CAST(l_quantity AS INT) AS start_date,
 l_extendedprice AS total_bill_pre_transaction,
 CASE WHEN l_discount>0.02 THEN 1 ELSE 0 END AS has_discount, CASE WHEN l_tax>0.04 THEN 1 ELSE 0 END AS has_disc_conditional,
 CASE l_linenumber % 4 WHEN 0 THEN '1 year' WHEN 1 THEN '2 year' WHEN 2 THEN 'None' END AS contract_term,
 CASE l_returnflag WHEN 'A' THEN 'Yes' WHEN 'N' THEN 'Optional' ELSE 'No' END AS solar_offer,
 CASE WHEN l_linestatus='O' THEN 'Yes' ELSE 'No' END AS has_incentive,
 l_tax*1000 AS total_annual_fee, CASE WHEN l_linenumber=3 THEN NULL ELSE l_quantity END AS total_late_payment_fee,
 CASE n_nationkey % 4 WHEN 0 THEN 'Small' WHEN 1 THEN 'Medium' WHEN 2 THEN 'Large' END AS cprg_retailer_size,
 CASE WHEN l_linenumber=7 THEN 'standing offer' ELSE 'market offer' END AS offer_type,
 CASE WHEN l_returnflag='R' THEN 'sme' ELSE 'res' END AS cust_type
FROM lineitem JOIN supplier ON l_suppkey=s_suppkey JOIN nation ON s_nationkey=n_nationkey
"""

# Raw monthly extract: every column is text, with the shapes real files have (two
# date forms, blanks, markers, decimals in integers, spellings of yes and no).
FX_RAW = """
SELECT
 CASE l_linenumber WHEN 1 THEN CAST(l_orderkey AS VARCHAR(20))
  WHEN 2 THEN concat(' ', CAST(l_orderkey AS VARCHAR(20)), '.9 ')
  WHEN 3 THEN concat(CAST(l_linenumber AS VARCHAR(20)), 'e2')
  WHEN 4 THEN concat(CAST(l_orderkey AS VARCHAR(20)), 'd')
  WHEN 5 THEN '' WHEN 6 THEN 'NA' ELSE concat('-', CAST(l_orderkey AS VARCHAR(20)), '.5') END AS "ID MTS2",
 CASE WHEN l_suppkey % 17 = 0 THEN concat('31/02/', CAST(year(l_shipdate) AS VARCHAR(4)), ' 0:00')
  WHEN l_suppkey % 17 = 1 THEN ' '
  WHEN l_linenumber % 2 = 0 THEN concat(CAST(day(l_shipdate) AS VARCHAR(2)), '/', lpad(CAST(month(l_shipdate) AS VARCHAR(2)), 2, '0'), '/', CAST(year(l_shipdate) AS VARCHAR(4)), ' ', CAST(l_linenumber AS VARCHAR(2)), ':05')
  ELSE concat(CAST(year(l_shipdate) AS VARCHAR(4)), '/', lpad(CAST(month(l_shipdate) AS VARCHAR(2)), 2, '0'), '/', lpad(CAST(day(l_shipdate) AS VARCHAR(2)), 2, '0'), ' 00:0', CAST(l_linenumber AS VARCHAR(2)), ':09') END AS "STAT_DATE",
 CASE WHEN l_linenumber=5 THEN 'M71' ELSE 'M57A' END AS "STAT_SHORTCUT",
 CASE WHEN l_linenumber=6 THEN 'x' ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR(20)) END AS "STAT_VALUE",
 CASE WHEN l_returnflag='R' THEN 'LARGE' ELSE 'SMALL' END AS "NMIClassCode",
 CASE WHEN l_suppkey % 13 = 0 THEN '' WHEN l_suppkey % 13 = 1 THEN concat(' P', CAST(l_suppkey AS VARCHAR(20))) ELSE concat('P', CAST(l_suppkey AS VARCHAR(20))) END AS "FRMP",
 CASE WHEN l_suppkey % 11 = 0 THEN 'NA' WHEN l_linenumber=2 THEN concat('X', CAST(l_suppkey % 5 AS VARCHAR(20))) ELSE concat('C', CAST(l_suppkey % 25 AS VARCHAR(20))) END AS "NEWFRMP",
 CASE l_linenumber WHEN 1 THEN 'Yes' WHEN 2 THEN ' t ' WHEN 3 THEN '1' WHEN 4 THEN 'FALSE' WHEN 5 THEN 'n' WHEN 6 THEN '0' ELSE 'maybe' END AS "NEWLR",
 CAST(1000+10*l_linenumber AS VARCHAR(4)) AS "CRCode",
 concat('extract_', CAST(year(l_shipdate) AS VARCHAR(4)), '.csv') AS "SOURCE FILE",
 l_linestatus AS "Extra Column"
FROM lineitem
"""

# Source sheet of the entity lookup, one row per supplier.
FX_ENTITY_SOURCE = """
SELECT CASE WHEN s_suppkey % 9 = 0 THEN '  ' ELSE concat('P', CAST(s_suppkey AS VARCHAR(20)), ' ') END AS participant_id,
 CASE WHEN s_suppkey % 9 = 0 AND s_nationkey = 3 THEN NULL WHEN s_suppkey % 4 = 0 THEN concat('P', CAST(s_suppkey AS VARCHAR(20))) ELSE concat(' C', CAST(s_nationkey AS VARCHAR(20))) END AS corporation_id,
 CASE WHEN s_nationkey = 7 THEN NULL ELSE concat('L', CAST(s_nationkey AS VARCHAR(20))) END AS licence
FROM supplier
"""

# Schemas of the driver's tables, so a read needs no job to find them.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def spark_view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a view text on Spark over the tables of `sf_dir`."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if t in sql}
    for name, frame in used.items():
        sql = _named(sql, name)
    return spark.sql(_spark_quotes(sql), **used)


def _named(sql: str, name: str) -> str:
    """`FROM lineitem` and `JOIN lineitem` become `{lineitem}` frame parameters."""
    import re

    return re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", sql)


def _spark_quotes(sql: str) -> str:
    """Quoted identifiers: standard SQL's double quotes are backticks in Spark."""
    return sql.replace('"', "`")
