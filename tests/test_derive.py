"""Offset bins, business day, bands: table-driven cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gatewise.functions import derive as d

OFFSETS = [0, 1, -1, 4, -4, 5, -5, 14, -14, 15, -15, 16, -16, 29, -29, 30, -30, 59, -59, 60, -60, 61, -61]

# SQL rule 1: truncating division; 0..15 (other capture) -> (d div 5 + 1) * 5 ...
V1_OTHER = {0: 5, 1: 5, -1: -5, 4: 5, -4: -5, 5: 10, -5: -10, 14: 15, -14: -15, 15: 20, -15: -20,
            16: 30, -16: -30, 29: 30, -29: -30, 30: 45, -30: -45, 59: 60, -59: -60, 60: 75, -60: -75,
            61: None, -61: None}
# SQL rule 2: d = 0 is always bin 0
V2_OTHER = {**V1_OTHER, 0: 0}
# per-profile floor rule: negatives floor
FLOOR_OTHER = {0: 5, 1: 5, -1: -5, 4: 5, -4: -5, 5: 10, -5: -5, 14: 15, -14: -15, 15: 20, -15: -15,
               16: 30, -16: -30, 29: 30, -29: -30, 30: 45, -30: -30, 59: 60, -59: -60, 60: 75, -60: -60,
               61: None, -61: None}


def _bins(spark, rule, values, flag):
    df = spark.createDataFrame([(v, flag) for v in values], "d_min long, f boolean")
    out = df.select("d_min", rule("d_min", "f").alias("b")).collect()
    return {r.d_min: r.b for r in out}


def test_v1_bins_other_capture(spark):
    assert _bins(spark, d.offset_bin_v1, OFFSETS, False) == V1_OTHER


def test_v1_same_time_is_zero(spark):
    assert _bins(spark, d.offset_bin_v1, [0], True) == {0: 0}


def test_new_bins(spark):
    assert _bins(spark, d.offset_bin_new, OFFSETS, False) == V2_OTHER


def test_floor_bins(spark):
    assert _bins(spark, d.offset_bin_floor, OFFSETS, False) == FLOOR_OTHER
    assert _bins(spark, d.offset_bin_floor, [0], True) == {0: 0}


@pytest.mark.parametrize("minutes,expected", [
    (0.0, 0), (0.5, 5), (5.0, 10), (14.99, 15), (15.0, 20), (15.5, None), (16.0, 30), (60.0, 75),
    (-0.5, -5), (-5.0, -5), (-15.0, -15), (-15.5, None), (-16.0, -30), (-60.0, -60)])
def test_fractional_bins(spark, minutes, expected):
    df = spark.createDataFrame([(minutes,)], "d_frac double")
    assert df.select(d.offset_bin_fractional("d_frac").alias("b")).first().b == expected


def test_business_day_boundaries(spark):
    df = spark.createDataFrame([("2024-01-02 05:59:59",), ("2024-01-02 06:00:00",), ("2024-01-02 00:00:00",)],
                               "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    got = [str(r.b) for r in df.select(d.business_day("t").alias("b")).collect()]
    assert got == ["2024-01-01", "2024-01-02", "2024-01-01"]


def test_minute_boundaries(spark):
    df = spark.createDataFrame([("2024-01-02 00:00:59", "2024-01-02 00:01:01")], "a string, b string") \
        .select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    r = df.select((d.minute_index("b") - d.minute_index("a")).alias("m")).first()
    assert r.m == 1  # one boundary crossed although only 2 s elapsed


def test_age_band_and_group_type(spark):
    df = spark.createDataFrame([(a,) for a in [0, 20, 21, 39, 40, 65, 66, -1]], "age int")
    assert [r.b for r in df.select(d.age_band("age").alias("b")).collect()] == \
        ["0-20", "0-20", "21-39", "21-39", "40-65", "40-65", "65+", None]
    sizes = spark.createDataFrame([(n,) for n in [1, 2, 5, 6, 40]], "group_size long")
    assert [r.g for r in sizes.select(d.group_type().alias("g")).collect()] == ["1", "2", "5", "5+", "5+"]


def test_period_flag(spark):
    df = spark.createDataFrame([(f"2024-01-02 {h:02d}:30:00",) for h in [0, 4, 5, 12, 13, 18, 19, 23]], "t string")
    got = [r.p for r in df.select(d.period_flag(F.col("t").cast("timestamp_ntz")).alias("p")).collect()]
    assert got == ["EM", "EM", "AM", "AM", "PM", "PM", "EV", "EV"]
