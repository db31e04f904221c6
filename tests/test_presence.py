"""Counts from the presence bitmaps equal those from the visitor index."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gatewise.operators import footfall as ff
from gatewise.operators import presence as pr
from gatewise.plans.catalog import Footfall

SF = "/root/testdata/sf0.001"


def same(a, b):
    b = b.select(*a.columns)
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def index(spark):
    """The visitor index, with rows of missing profiles and of missing demographics."""
    index = Footfall(spark, SF).index
    odd = index.limit(40).withColumn("profile_id", F.lit(None).cast("long"))
    odd = odd.unionByName(index.limit(30).withColumn("member_tier", F.lit(None).cast("string")).withColumn(
        "gender", F.lit(None).cast("int")))
    return index.unionByName(odd.withColumn("region_id", F.concat(F.lit("odd"), F.col("region_id"))))


def test_numbers_are_dense_per_day(index):
    people = pr.numbered_people(index)
    per = people.groupBy("date_casino").agg(F.min("number").alias("lo"), F.max("number").alias("hi"),
                                            F.count("*").alias("n"), F.countDistinct("number").alias("d"),
                                            F.countDistinct("profile_id").alias("p")).collect()
    assert per and all(r.lo == 0 and r.hi == r.n - 1 and r.d == r.n == r.p for r in per)


def test_every_level_equals_the_direct_count(spark, index, tmp_path):
    path = str(tmp_path / "presence")
    pr.presence(index).write.parquet(path)
    rows = spark.read.parquet(path)
    same(pr.visits_hourly(rows), ff.visits_hourly(index))
    same(pr.visits_hourly_casino(rows), ff.visits_hourly_casino(index))
    same(pr.visits_hourly_sector(rows), ff.visits_hourly_sector(index))
    same(pr.daily_sector_distinct(rows), ff.daily_sector_distinct(index))
    same(pr.daily_sector_rollup(rows), ff.daily_sector_rollup(ff.visits_daily_region(index)))


def test_a_cell_of_few_visitors_is_a_small_row(spark):
    """Visitors far apart in the numbering cost a word each, and a full cell a word for 64."""
    def rows(n, step, hour):
        return spark.range(0, n, step).select(
            F.lit("2024-01-02").cast("date").alias("date_casino"), F.col("id").alias("profile_id"),
            F.lit(f"2024-01-02 {hour}:00:00").cast("timestamp_ntz").alias("date_hour"), F.lit("3").alias("region_type"),
            F.lit("5").alias("region_id"), F.lit("ZONE 5").alias("region_name"), F.lit(1).alias("gender"),
            F.lit("30-39").alias("Age_range"), F.lit(2).alias("profile_type"), F.lit(None).cast("string").alias("member_tier"),
            F.lit("Music").alias("sector"))
    index = rows(6400, 1, "10").unionByName(rows(6400, 640, "11"))
    table = pr.presence(index)
    assert table.schema["present"].dataType.simpleString() == "bigint"
    words = {r[0].hour: r[1] for r in table.groupBy("date_hour").count().collect()}
    assert words[10] == 100 and words[11] <= 10
    got = {r.date_hour.hour: r.visitor_num for r in pr.visits_hourly(table).where("region_id = '5'").collect()}
    assert got == {10: 6400, 11: 10}


def test_staged_days_are_few_files(spark, tmp_path):
    """A layer's files do not multiply with its tasks: small days are written by one task each."""
    events = spark.range(0, 4000, 1, 16).select(
        F.col("id").alias("event_id"),
        F.timestamp_add("HOUR", F.col("id") % 900, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"),
        (F.col("id") % 50).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"),
        F.lit('{"k": 5}').alias("props"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    f = Footfall(spark, str(tmp_path))
    detail = f.layer("detail", lambda: ff.capture_detail(f.captures_raw).repartition(8))
    assert detail.count() == 4000
    assert len(detail.inputFiles()) == detail.select("date_casino").distinct().count() > 5
