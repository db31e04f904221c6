"""Metamorphic checks of the slice runner: day-by-day runs equal one run over
all days, and rerunning a day leaves every table unchanged."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from gatewise.plans.warehouse import run_footfall
from gatewise.sources import testdata as td

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def _table(spark, root, name):
    return spark.read.parquet(f"{root}/{name}").drop("batch_time")


def test_day_by_day_equals_full_run(spark, tmp_path):
    raw = td.captures_raw(td.read_table(spark, SF, "events"))
    full_root, daily_root = str(tmp_path / "full"), str(tmp_path / "daily")
    run_footfall(spark, raw, full_root)
    days = sorted(r.d for r in raw.select(F.to_date(F.col("capture_time") - F.expr("INTERVAL 6 HOURS"))
                                          .alias("d")).distinct().collect())
    for day in days:
        run_footfall(spark, raw, daily_root, [day])
    run_footfall(spark, raw, daily_root, [days[2]])          # rerun one slice
    for name in ["capture_detail", "stay_time", "new_or_return", "visitor_index", "visits_daily",
                 "visits_daily_casino", "daily_sector", "visits_hourly", "visits_hourly_sector", "path_offsets",
                 "path_offsets_carry", "path_daily", "path_offsets_nearest", "companion_groups",
                 "companion_group_sizes"]:
        a, b = _table(spark, full_root, name), _table(spark, daily_root, name)
        b = b.select(*a.columns)
        assert a.count() > 0, name
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_run_events_matches_lazy_jobs(spark, tmp_path):
    from gatewise.operators import events as ev
    events = td.read_table(spark, "/root/testdata/sf0.01", "events")
    raw = td.captures_raw(events)
    cams, elist = td.camera_dim(raw), td.event_list(events)
    from gatewise.plans.warehouse import run_events
    out = run_events(spark, raw, cams, elist, str(tmp_path / "ev"))
    cal = ev.event_calendar(elist)
    det = ev.event_capture_detail(raw, cams, cal)
    lazy = ev.event_summary(ev.event_conversion(det, cal), ev.event_pre_post(det, cal))
    stored = out["event_summary"].select(*lazy.columns)
    assert stored.count() > 0
    assert stored.exceptAll(lazy).count() == 0 and lazy.exceptAll(stored).count() == 0


def test_run_events_by_titles_equals_full_run(spark, tmp_path):
    from gatewise.operators import events as ev
    from gatewise.plans.warehouse import run_events
    events = td.read_table(spark, "/root/testdata/sf0.01", "events")
    raw = td.captures_raw(events)
    cams, elist = td.camera_dim(raw), td.event_list(events)
    full = run_events(spark, raw, cams, elist, str(tmp_path / "full"))
    titles = ev.event_calendar(elist).select("Title")
    first = titles.where(F.xxhash64("Title") % 2 == 0)
    second = titles.join(first, on="Title", how="left_anti")
    part_root = str(tmp_path / "parts")
    run_events(spark, raw, cams, elist, part_root, titles=first)
    out = run_events(spark, raw, cams, elist, part_root, titles=second)
    for name in ["event_pre_post", "event_conversion", "event_summary"]:
        a = full[name]
        b = spark.read.parquet(f"{part_root}/{name}").drop("batch_time").select(*a.columns)
        assert a.count() > 0, name
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    assert out["event_summary"].count() > 0


def test_a_slice_without_captures_is_emptied(spark, tmp_path):
    raw = td.captures_raw(td.read_table(spark, SF, "events"))
    root = str(tmp_path / "w")
    days = sorted(r.d for r in raw.select(F.to_date(F.col("capture_time") - F.expr("INTERVAL 6 HOURS"))
                                          .alias("d")).distinct().collect())
    run_footfall(spark, raw, root)
    business = F.to_date(F.col("capture_time") - F.expr("INTERVAL 6 HOURS"))
    tables = run_footfall(spark, raw.where(business != F.lit(days[1])), root, [days[1]])
    for name in ["capture_detail", "stay_time", "new_or_return", "visitor_index", "visits_daily", "visits_daily_casino",
                 "daily_sector", "visits_hourly", "path_offsets", "path_offsets_carry", "path_daily"]:
        stored = _table(spark, root, name)
        assert stored.where(F.col("date_casino") == F.lit(days[1])).count() == 0, name
        assert stored.count() > 0, name
        assert tables[name].count() == 0, name


def test_the_day_filter_reaches_the_scan(spark, tmp_path):
    from gatewise.operators import footfall as ff
    path = str(tmp_path / "raw")
    td.captures_raw(td.read_table(spark, SF, "events")).write.parquet(path)
    plan = ff.capture_detail(spark.read.parquet(path), ["2024-01-02"])._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(capture_time" in pushed and "LessThan(capture_tim" in pushed


def test_a_missing_profile_is_nobody_in_every_cube(spark):
    from gatewise.operators import footfall as ff
    row = ("2024-01-02 10:00:00", None, "3", "5", "ZONE 5", 1, "21-39", 2, None, "Music", 60.0, 0, 0)
    index = spark.createDataFrame([row], "h string, profile_id long, region_type string, region_id string, region_name string, "
                                  "gender int, Age_range string, profile_type int, member_tier string, sector string, "
                                  "stay_time double, is_return_zone int, is_return_casino int").selectExpr(
        "cast(h as timestamp_ntz) date_hour", "cast(h as timestamp_ntz) date_casino_hour", "* EXCEPT (h)",
        "date'2024-01-02' date_casino")
    for cube in (ff.visits_daily_region(index), ff.visits_daily_all(index), ff.visits_daily_sector(index),
                 ff.daily_sector_distinct(index)):
        assert [r.visitor_num for r in cube.collect()] == [0]
