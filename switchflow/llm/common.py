"""What the operators share: reading tables, words, frames that are written once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from switchflow.session import scratch, scratch_path

# White space that parts words: space and the control characters 9 to 13.
BLANK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Array of words: runs without white space."""
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bind(value: Column, body) -> Column:
    """body(value) with the value computed once, also where the body uses it many times."""
    return F.transform(F.array(value), body)[0]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_hash(column: str = "text") -> Column:
    """64 bits that stand for a text, with the id, where rows have to be known again."""
    return F.xxhash64(whole_text(column))


def settled(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What make() gives, written; what it wrote on the way is removed."""
    path = scratch_path(spark, label)
    with scratch(spark):
        out = make()
        schema = out.schema
        out.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


# A bitmap has at least 2 ** 15 bits, one of Spark's bitmaps, and at most 2 ** 28 (32 MB).
SMALLEST, LARGEST = 15, 28


def may_be_among(df: DataFrame, key: Column, keys: DataFrame, mark: str) -> DataFrame:
    """df with the boolean column `mark`: never false for rows whose 64-bit key is among those of `keys` (a column h).

    The keys set the bits of a bitmap of bounded size, which every task gets; df is not
    moved. 32 bits a key let about a 32nd of other rows pass, until the bitmap is as
    large as it may be. `keys` is read twice: pass a written frame.
    """
    n = keys.count()
    bits = min(LARGEST, max(SMALLEST, (32 * n).bit_length()))
    slot = lambda h: F.shiftrightunsigned(h, 64 - bits)
    part, at = F.shiftright(slot(F.col("h")), SMALLEST), slot(F.col("h")).bitwiseAND((1 << SMALLEST) - 1)
    maps = keys.groupBy(part.alias("__part")).agg(F.bitmap_construct_agg(at).alias("__bits"))
    placed = df.withColumn("__slot", slot(key))
    joined = placed.join(F.broadcast(maps), F.shiftright("__slot", SMALLEST) == F.col("__part"), "left")
    place = F.col("__slot").bitwiseAND((1 << SMALLEST) - 1).cast("int")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.expr("shiftright(__byte, __place) & 1")
    marked = joined.withColumns({"__byte": byte, "__place": place % 8}).withColumn(mark, F.coalesce(bit == 1, F.lit(False)))
    return marked.drop("__slot", "__part", "__bits", "__byte", "__place")
