"""Property checks: the skew-proof helpers equal the plain window formulation."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from gatewise.functions.derive import epoch_seconds
from gatewise.operators.common import gap_group_ids, next_capture_time


def _random_rows(seed, n=400):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 2, 8, 0, 0)
    rows = []
    for i in range(n):
        # one hot key holds most rows; many rows share seconds
        key = 1 if rnd.random() < 0.7 else rnd.randint(2, 6)
        t = base + dt.timedelta(seconds=rnd.choice([0, 1, 2, 3, 5, 9, 30, 31, 600, 601, 3600]) + rnd.randint(0, 4))
        rows.append((key, f"c{i:04d}", t))
    return rows


def test_next_capture_time_equals_lead(spark):
    for seed in range(3):
        df = spark.createDataFrame(_random_rows(seed), "k long, capture_id string, capture_time timestamp_ntz")
        ours = next_capture_time(df, ["k"]).select("capture_id", "next_capture_time")
        w = Window.partitionBy("k").orderBy("capture_time", "capture_id")
        plain = df.select("capture_id", F.lead("capture_time").over(w).alias("next_capture_time"))
        assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def test_gap_groups_equal_running_sum(spark):
    for seed in range(3):
        df = spark.createDataFrame(_random_rows(seed), "k long, capture_id string, capture_time timestamp_ntz")
        ours = gap_group_ids(df, ["k"], gap_seconds=2).select("capture_id", "group_id")
        w = Window.partitionBy("k").orderBy("capture_time", "capture_id")
        prev = F.lag("capture_time").over(w)
        flagged = df.withColumn("f", F.when(epoch_seconds("capture_time") - epoch_seconds(prev) > 2, 1).otherwise(0))
        wr = Window.partitionBy("k").orderBy("capture_time").rangeBetween(Window.unboundedPreceding, 0)
        plain = flagged.select("capture_id", F.sum("f").over(wr).cast("long").alias("group_id"))
        assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def test_previous_time_equals_lag(spark):
    from gatewise.operators.common import previous_time
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 2, 8, 0, 0)
    rows = [(1 if rnd.random() < 0.7 else 2, i,
             base + dt.timedelta(seconds=rnd.choice([0, 1, 5, 60]), microseconds=rnd.choice([0, 0, 250000, 999999])))
            for i in range(300)]
    df = spark.createDataFrame(rows, "k long, i int, t timestamp_ntz")
    ours = previous_time(df, ["k"], "t", "i", out="p").select("i", "p")
    plain = df.select("i", F.lag("t").over(Window.partitionBy("k").orderBy("t", "i")).alias("p"))
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0
