"""Scratch-script cases (min per bucket, centring, gaps) and the event calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gatewise.operators import events as ev
from gatewise.operators import misc as ms
from gatewise.operators import paths as pa
from gatewise.operators import footfall as ff

from .conftest import capture, captures_df


def test_min_per_time_bucket(spark):
    # 8 rows (user, region, diff) in one 10-minute bucket -> minimum 3, 5, 7, 9
    rows = [("A", "zone1", 3, 1), ("A", "zone1", 4, 2), ("A", "zone2", 5, 3), ("A", "zone2", 6, 4),
            ("b", "zone1", 7, 5), ("b", "zone1", 8, 6), ("b", "zone2", 9, 7), ("b", "zone2", 10, 8)]
    df = spark.createDataFrame(rows, "user string, region string, diff int, rid int") \
        .withColumn("t", F.lit("2024-01-02 10:04:00").cast("timestamp_ntz"))
    out = ms.min_per_time_bucket(df, "user", "region", "diff", "t", "rid").orderBy("diff").collect()
    assert [r.diff for r in out] == [3, 5, 7, 9]
    assert out[0].z0_time == dt.datetime(2024, 1, 2, 10, 0)


def test_group_center_range(spark):
    df = spark.createDataFrame([(g, v) for g, v in zip("AABBAAB", [10, 20, 30, 40, 50, 60, 70])],
                               "group string, value int")
    out = ms.group_center_range(df, "group", "value").orderBy("value").collect()
    assert [r.centered for r in out] == [-25.0, -15.0, -16.666667, -6.666667, 15.0, 25.0, 23.333333]
    assert [r.range for r in out] == [50, 50, 40, 40, 50, 50, 40]


def test_time_gaps(spark):
    times = ["2023-10-01 08:30", "2023-10-01 09:45", "2023-10-01 09:58", "2023-10-01 10:38"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(times)], "k int, i int, t string") \
        .withColumn("t", F.col("t").cast("timestamp_ntz"))
    out = ms.time_gaps(df, ["k"], "t", "i").orderBy("t").collect()
    assert [r.time_diff for r in out] == [None, 4500.0, 780.0, 2400.0]
    assert out[0].new_time == dt.datetime(2023, 10, 1, 10, 0)


def test_region_runs(spark):
    rows = [capture(1, "2024-01-02 08:00:00", region="ZONE 5"), capture(1, "2024-01-02 08:01:00", region="ZONE 5"),
            capture(1, "2024-01-02 08:02:00", region="ZONE 6"), capture(1, "2024-01-02 08:03:00", region="ZONE 5")]
    out = ms.region_runs(captures_df(spark, rows)).orderBy("capture_time").collect()
    assert [(str(r.capture_time)[11:], r.region_name) for r in out] == \
        [("08:01:00", "ZONE 5"), ("08:02:00", "ZONE 6"), ("08:03:00", "ZONE 5")]


def _events(spark):
    rows = [("Show D", "2024-01-02 14:00:00", "2024-01-02 16:00:00"),
            ("Show A", "2024-01-02 19:00:00", "2024-01-02 22:00:00"),
            ("Show E", "2024-01-02 20:30:00", "2024-01-02 21:30:00"),
            ("Expo B", "2024-01-03 10:00:00", "2024-01-05 17:30:00"),
            ("Late C", "2024-01-04 23:00:00", "2024-01-05 01:30:00")]
    return (spark.createDataFrame(rows, "Title string, s string, e string")
            .select("Title", F.col("s").cast("timestamp_ntz").alias("StartDtm"),
                    F.col("e").cast("timestamp_ntz").alias("EndDtm"), F.lit("Hall").alias("Venue"),
                    F.lit("concert").alias("EventType"), F.lit("Pop").alias("Genre"),
                    F.col("s").cast("timestamp_ntz").alias("InsertDtm")))


def test_event_calendar(spark):
    cal = {r.Title: r for r in ev.event_calendar(_events(spark)).collect()}
    # Show A and Show E share (date, EV): the earlier start is kept
    assert "Show A_2024-01-02" in cal and "Show E_2024-01-02" not in cal
    assert "Show D_2024-01-02" in cal and cal["Show D_2024-01-02"].Period_Flag == "PM"
    # a three-day expo: day 0 ends one second before start + 1 day; last day ends at EndDtm
    b0, b2 = cal["Expo B_2024-01-03"], cal["Expo B_2024-01-05"]
    assert b0.EndDtm_ == dt.datetime(2024, 1, 4, 9, 59, 59)
    assert b2.StartDtm_ == dt.datetime(2024, 1, 5, 10, 0) and b2.EndDtm_ == dt.datetime(2024, 1, 5, 17, 30)
    # the 2024-01-05 EV slot: Late C day 1 starts 23:00 after its end 01:30 (kept as in the reference)
    c1 = cal["Late C_2024-01-05"]
    assert c1.StartDtm_ == dt.datetime(2024, 1, 5, 23, 0) and c1.EndDtm_ == dt.datetime(2024, 1, 5, 1, 30)


def test_event_windows(spark):
    cal = ev.event_calendar(_events(spark)).where(F.col("Title") == "Show D_2024-01-02")
    cams = spark.createDataFrame([("0", "Gate 0", "Arena"), ("1", "Gate 1", "Casino Entrance")],
                                 "camera_id string, group string, business_sector string")
    times = {"13:30:00": -1, "12:30:00": -2, "10:00:00": -4, "09:59:00": None, "15:00:00": 0,
             "16:30:00": 1, "17:00:00": 2, "20:00:00": 4, "20:01:00": None}
    rows = [capture(i + 1, f"2024-01-02 {t}", camera=0, cid=t) for i, t in enumerate(times)]
    det = ev.event_capture_detail(captures_df(spark, rows), cams, cal)
    got = {str(r.capture_time)[11:]: r.time_window for r in det.collect()}
    assert got == times


def test_path_bins_on_captures(spark):
    # one profile: base at 10:00:00, sightings 4 min and 20 min later in other zones
    rows = [capture(1, "2024-01-02 10:00:00", region="ZONE 5", cid="a"),
            capture(1, "2024-01-02 10:04:00", region="ZONE 6", cid="b"),
            capture(1, "2024-01-02 10:20:00", region="ZONE 7", cid="c")]
    det = ff.capture_detail(captures_df(spark, rows))
    out = pa.path_offsets_nearest(det).where(F.col("z0_time") == "2024-01-02 10:00:00") \
        .where(F.col("region_name") == "ZONE 5").collect()
    got = {r.off_bin: r.area_at_off for r in out}
    assert got == {0: "ZONE 5", 5: "ZONE 6", 30: "ZONE 7"}
    carry = pa.path_offsets_carry(det).where(F.col("region_name") == "ZONE 7").collect()
    got = {r.off_bin: r.area_at_off for r in carry}
    # last capture: no later sighting -> positive bins carry its own area; both earlier
    # sightings (16 and 20 boundary minutes back) fall in bin -30, the nearer one wins;
    # other negative bins stay empty because an earlier sighting exists
    assert got[15] == "ZONE 7" and got[60] == "ZONE 7" and got[-30] == "ZONE 6"
    assert -15 not in got and -60 not in got


def test_run_dates_reach_the_day_before_an_event_to_come(spark):
    import datetime as dt
    today = spark.sql("SELECT current_date() AS d").first().d
    day = dt.timedelta(days=1)
    for shift, want in ((-1, [-2, -1, 0]), (0, [-1, 0]), (1, [0]), (2, [])):
        cal = spark.createDataFrame([("E", today + shift * day)], "Title string, CDate date")
        got = sorted(r.CDate for r in ev.event_run_dates(cal).collect())
        assert got == [today + x * day for x in want]


def test_null_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(None, 1.0, 1), (None, 3.0, 2), ("a", 5.0, 3)], "g string, v double, i int")
    got = {r.i: (r.centered, r.range) for r in ms.group_center_range(df, "g", "v").collect()}
    assert got == {1: (-1.0, 2.0), 2: (1.0, 2.0), 3: (0.0, 0.0)}
    timed = df.selectExpr("g", "i", "timestamp_seconds(i * 10) AS t")
    gaps = {r.i: r.time_diff for r in ms.time_gaps(timed, ["g"], "t", "i").collect()}
    assert gaps == {1: None, 2: 10.0, 3: None}
