"""Fixed schemas and fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _TS = T.StringType(), T.IntegerType(), T.TimestampNTZType()

# Staging columns in table order. Bits stay 1/0/null integers.
STAGING = T.StructType(
    [
        T.StructField("id_mts2", _I),
        T.StructField("stat_date", _TS),
        T.StructField("stat_shortcut", _S),
        T.StructField("stat_name", _S),
        T.StructField("stat_value", _I),
        T.StructField("stat_vis", _S),
        T.StructField("processingdt", _TS),
        T.StructField("maintcreatedt", _TS),
        T.StructField("jurisdictioncode", _S),
        T.StructField("nmiclasscode", _S),
        T.StructField("tierstatus", _S),
        T.StructField("lnsp", _S),
        T.StructField("lr", _S),
        T.StructField("frmp", _S),
        T.StructField("newlr", _I),
        T.StructField("newfrmp", _S),
        T.StructField("crstatuscode", _S),
        T.StructField("crcode", _S),
        T.StructField("mdp", _I),
        T.StructField("mpb", _I),
        T.StructField("objectioncode", _S),
        T.StructField("misc1", _S),
        T.StructField("misc2", _I),
        T.StructField("misc3", _I),
        T.StructField("date_imported", _TS),
        T.StructField("source_file", _S),
    ]
)

DATE_COLUMNS = ("stat_date", "processingdt", "maintcreatedt")
INT_COLUMNS = ("id_mts2", "stat_value")
BIT_COLUMNS = ("newlr", "mdp", "mpb", "misc2", "misc3")

# Columns of the analytical view, in order.
VIEW_COLUMNS = (
    "id_mts2", "stat_date", "Year", "Month", "FinYear", "FinYearQuarter",
    "stat_shortcut", "stat_value", "lnsp", "lr", "frmp", "newfrmp", "crcode",
    "ESC_FRMP", "ESC_NEWFRMP", "FRMP_Retailer_name", "NEWFRMP_Retailer_name",
    "FRMP_Retailer_size", "NEWFRMP_Retailer_size", "transfer_type",
)

# Measure codes. Daily movement counts and month-end customer base.
TRANSFERS = "M57A"
CUSTOMER_BASE = "M71"

# Entity sizes in their natural order.
SIZES = ("Small", "Medium", "Large")

# Reason codes that are a change of retailer.
CHANGE_CODES = ("1000", "1010", "1020", "1030", "1040")

# Financial years left out of the report (incomplete history).
EXCLUDED_FINYEARS = ("2017-18", "2018-19", "2019-20")

MANIFEST = T.StructType([T.StructField("source_file", _S)])
LOADS = T.StructType([*MANIFEST.fields, T.StructField("load", _S)])

# Source and built columns of the two lookups.
ENTITY_SOURCE_COLUMNS = ("PARTICIPANTID", "CORPORATIONID", "ESC RetailerCommonID")
CODE_SOURCE_COLUMNS = (
    "CRC_Code", "Event", "Sub_event", "Description", "Further_details", "Version", "Reporting_group",
)
