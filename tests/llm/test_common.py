from pyspark.sql import functions as F

from switchflow.llm import common
from switchflow.session import materialize


def test_a_bitmap_marks_all_its_keys_and_few_others(spark):
    df = spark.range(20000).withColumn("h", F.xxhash64("id")).withColumn("__bits", F.lit("clash"))
    for n in (0, 1, 3000):
        keys = materialize(spark.range(n).select(F.xxhash64("id").alias("h")))
        got = common.may_be_among(df.select("id", "h"), F.col("h"), keys, "may")
        assert got.columns == ["id", "h", "may"] and got.count() == 20000
        marked = {r.id for r in got.filter("may").collect()}
        assert set(range(n)) <= marked and len(marked) - n < 0.06 * 20000 if n else not marked


def test_settled_frames_stay_and_what_led_to_them_goes(spark):
    import os

    way = []

    def make():
        way.append(materialize(spark.range(5), "way"))
        return way[0].filter("id > 1")

    out = common.settled(spark, make, "end")
    assert out.count() == 3 and not os.path.exists(way[0].inputFiles()[0].removeprefix("file://"))
