"""Build the entity lookup and the reason-code lookup from their source sheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchflow.operators.conform import require_columns
from switchflow.operators.reshape import first_by_key, unify_ids
from switchflow.schema import CODE_SOURCE_COLUMNS, ENTITY_SOURCE_COLUMNS


def build_entity_lookup(df: DataFrame) -> DataFrame:
    """Distinct (id, licence_common_id) from participant and corporation ids.

    Rows without a licence are kept: their ids are still known ids.
    """
    participant, corporation, licence = ENTITY_SOURCE_COLUMNS
    require_columns(df, ENTITY_SOURCE_COLUMNS)
    text = df.select(
        F.trim(F.col(participant).cast("string")).alias("participant_id"),
        F.trim(F.col(corporation).cast("string")).alias("corporation_id"),
        F.trim(F.col(f"`{licence}`").cast("string")).alias("licence_common_id"),
    )
    long = unify_ids(text, ["participant_id", "corporation_id"], ["licence_common_id"])
    return long.select("id", "licence_common_id").distinct()


def build_code_lookup(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Trimmed reason codes, blank codes dropped, the first row per code.

    Spark rows carry no position, so "first" follows `order` and then all columns.
    """
    require_columns(df, CODE_SOURCE_COLUMNS)
    named = df.select(
        *[F.trim(F.col(c).cast("string")).alias(c.lower()) for c in CODE_SOURCE_COLUMNS],
        *[F.col(c).alias(f"_order_{i}") for i, c in enumerate(order)],
    )
    kept = named.filter(F.length("crc_code") > 0)
    picked = first_by_key(kept, "crc_code", [f"_order_{i}" for i in range(len(order))])
    return picked.select(*[c.lower() for c in CODE_SOURCE_COLUMNS])
