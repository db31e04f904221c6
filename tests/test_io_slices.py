"""I/O helpers and day-sliced processing with partition pruning."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatewise.operators import footfall as ff
from gatewise.sources import tables as tb

from .conftest import capture, captures_df


def test_csv_round_trip_with_formats(spark, tmp_path):
    schema = T.StructType([T.StructField("camera_id", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("installed", T.TimestampNTZType())])
    df = spark.createDataFrame([(1, "CAM 1", dt.datetime(2024, 1, 2, 3, 4, 5))], schema)
    path = str(tmp_path / "cams")
    tb.write_csv(df, path, "yyyy/MM/dd HH:mm:ss")
    text = spark.read.text(path).collect()
    assert any("2024/01/02 03:04:05" in r.value for r in text)
    back = tb.read_csv(spark, path, schema, "yyyy/MM/dd HH:mm:ss").collect()
    assert back[0].installed == dt.datetime(2024, 1, 2, 3, 4, 5) and back[0].camera_id == 1


def test_create_if_absent_and_insert_by_name(spark, tmp_path):
    schema = T.StructType([T.StructField("ID", T.LongType()), T.StructField("date_time", T.TimestampNTZType())])
    tb.create_table_if_absent(spark, "stream_data_t", schema, str(tmp_path / "sd"))
    tb.create_table_if_absent(spark, "stream_data_t", schema, str(tmp_path / "sd"))   # no error on rerun
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2), 7, "extra")], "date_time timestamp_ntz, ID long, x string")
    tb.insert_by_name(df, "stream_data_t")
    rows = spark.table("stream_data_t").collect()
    assert [(r.ID, r.date_time) for r in rows] == [(7, dt.datetime(2024, 1, 2))]


def test_day_slice_prunes_and_matches_full_run(spark, tmp_path):
    rows = [capture(1, "2023-11-20 10:00:00", region="ZONE 5"), capture(1, "2024-01-05 10:00:00", region="ZONE 5"),
            capture(2, "2024-01-04 10:00:00", region="CASINO 1", sector="Casino"),
            capture(2, "2024-01-05 10:00:00", region="CASINO 1", sector="Casino"),
            capture(3, "2023-10-01 10:00:00", region="ZONE 6"), capture(3, "2024-01-05 11:00:00", region="ZONE 6")]
    stay = ff.stay_time(ff.capture_detail(captures_df(spark, rows)))
    path = str(tmp_path / "stay")
    stay.write.partitionBy("date_casino").parquet(path)
    stored = spark.read.parquet(path)
    sliced = ff.new_or_return(stored, days=["2024-01-05"])
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_casino" in plan and "2023-11-05" in plan
    full = ff.new_or_return(stored).where(F.col("date_casino") == "2024-01-05")
    assert sliced.exceptAll(full).count() == 0 and full.exceptAll(sliced).count() == 0
    got = {r.profile_id: (r.is_return_zone, r.is_return_casino) for r in sliced.collect()}
    assert got == {1: (1, 0), 2: (0, 1), 3: (0, 0)}


def test_write_slices_spread_and_sorted(spark, tmp_path):
    import glob
    import os
    df = spark.range(0, 2000).select((F.col("id") % 2).cast("string").alias("d"), F.col("id").alias("v"))
    path = str(tmp_path / "spread")
    tb.write_slices(df.repartition(16), path, "d", add_batch_time=False, files_per_slice=3, sort_within=["v"])
    for part in ("d=0", "d=1"):
        files = glob.glob(os.path.join(path, part, "*.parquet"))
        assert 1 <= len(files) <= 3
        for f in files:   # each file is sorted by v
            vs = [r.v for r in spark.read.parquet(f).collect()]
            assert vs == sorted(vs)
    assert spark.read.parquet(path).count() == 2000


def test_materialize_cuts_lineage_and_preview(spark):
    df = spark.range(0, 50).withColumn("x", F.col("id") * 2)
    m = tb.materialize(df, "unit")
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" in plan and "Range" not in plan
    assert m.count() == 50
    prev = tb.ingest_preview(m.select("id", "x", (F.col("x") + 1).alias("y"), F.lit(1).alias("z")), 3)
    assert prev.columns == ["id", "x", "y"] and prev.count() == 3
