"""Bring raw string frames into the fixed staging schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchflow.functions.text import blank_to_null, clean_name_list, parse_mixed_ts, to_bit, to_int
from switchflow.schema import BIT_COLUMNS, DATE_COLUMNS, INT_COLUMNS, STAGING


def clean_names(df: DataFrame) -> DataFrame:
    """Rename all columns to unique snake case."""
    return df.toDF(*clean_name_list(df.columns))


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame itself, or an error naming the columns it lacks."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing required columns: {', '.join(absent)}")
    return df


def blanks_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Trim text columns; empty text and `NA` become null."""
    names = df.columns if columns is None else columns
    return df.withColumns({c: blank_to_null(F.col(c)) for c in names})


def convert_types(df: DataFrame) -> DataFrame:
    """Parse the date, integer and bit columns that are present."""
    present = set(df.columns)
    made = {c: parse_mixed_ts(F.col(c)) for c in DATE_COLUMNS if c in present}
    made |= {c: to_int(F.col(c)) for c in INT_COLUMNS if c in present}
    made |= {c: to_bit(F.col(c)) for c in BIT_COLUMNS if c in present}
    return df.withColumns(made) if made else df


def align(df: DataFrame, schema: T.StructType = STAGING) -> DataFrame:
    """Columns of the schema in its order: absent ones null, others dropped."""
    return df.select(
        *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def conform(raw: DataFrame, schema: T.StructType = STAGING) -> DataFrame:
    """Cleaned names, parsed types, fixed columns: one narrow projection."""
    return align(convert_types(clean_names(raw)), schema)
