"""Hand-made cases for the remaining semantic traps."""

from __future__ import annotations

from pyspark.sql import functions as F

from gatewise.operators import events as ev
from gatewise.operators import footfall as ff

from .conftest import capture, captures_df


def test_gap_of_exactly_two_seconds_stays_in_group(spark):
    rows = [capture(i + 1, f"2024-01-02 08:00:{s:02d}", region="CASINO 1", camera=1, sector="Casino")
            for i, s in enumerate([0, 2, 4, 7])]
    got = {r.profile_id: r.group_id for r in ff.companion_groups(captures_df(spark, rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 1}


def test_summary_joins_null_and_empty_tier(spark):
    keys = "date string, hour_window int, event_name string, Age_range string, member_tier string, " \
           "profile_type int, gender int, group string"
    conv = spark.createDataFrame([("2024-01-02", 1, "E_2024-01-02", "21-39", None, 2, 1, "all", 3, 1)],
                                 keys + ", visition_num long, casino_converted_visition_num long") \
        .withColumn("date", F.col("date").cast("date"))
    pp = spark.createDataFrame([("2024-01-02", "E_2024-01-02", "21-39", 1, 2, "", "all", 1, 2, 60.0, 1, 30.0)],
                               "date string, event_name string, Age_range string, gender int, profile_type int, "
                               "member_tier string, group string, hour_window int, pre_visition_num long, "
                               "pre_stay_time double, post_visition_num long, post_stay_time double") \
        .withColumn("date", F.col("date").cast("date"))
    out = ev.event_summary(conv, pp).collect()
    assert len(out) == 1 and out[0].member_tier is None and out[0].pre_stay_time == 60.0


def _one_event(spark, start, end):
    return (spark.createDataFrame([("Show", start, end)], "Title string, s string, e string")
            .select("Title", F.col("s").cast("timestamp_ntz").alias("StartDtm"),
                    F.col("e").cast("timestamp_ntz").alias("EndDtm"), F.lit("Hall").alias("Venue"),
                    F.lit("concert").alias("EventType"), F.lit("Pop").alias("Genre"),
                    F.col("s").cast("timestamp_ntz").alias("InsertDtm")))


def test_pre_post_without_matches_is_zero(spark):
    cal = ev.event_calendar(_one_event(spark, "2024-01-02 14:00:00", "2024-01-02 16:00:00"))
    cams = spark.createDataFrame([("0", "Gate 0", "Arena")], "camera_id string, group string, business_sector string")
    # one attendee seen only during the event: nothing before the start or after the end
    rows = [capture(1, "2024-01-02 15:00:00", camera=0, cid="a"), capture(1, "2024-01-02 15:10:00", camera=0, cid="b")]
    det = ev.event_capture_detail(captures_df(spark, rows), cams, cal)
    out = ev.event_pre_post(det, cal).where((F.col("group") == "all") & (F.col("hour_window") == 1)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.pre_visition_num, r.pre_stay_time, r.post_visition_num, r.post_stay_time) == (0, 0.0, 0, 0.0)


def test_window_edges_inclusive(spark):
    cal = ev.event_calendar(_one_event(spark, "2024-01-02 14:00:00", "2024-01-02 16:00:00"))
    cams = spark.createDataFrame([("0", "Gate 0", "Arena")], "camera_id string, group string, business_sector string")
    rows = [capture(1, "2024-01-02 13:00:00", camera=0, cid="a"),   # exactly start - 1 h
            capture(1, "2024-01-02 14:30:00", camera=0, cid="b"),
            capture(1, "2024-01-02 17:00:00", camera=0, cid="c")]   # exactly end + 1 h
    det = ev.event_capture_detail(captures_df(spark, rows), cams, cal)
    r = ev.event_pre_post(det, cal).where((F.col("group") == "all") & (F.col("hour_window") == 1)).first()
    # a: 13:00 -> next 14:30 = 5400 s counted before; c: 17:00 (no next) = 0 s counted after
    assert (r.pre_visition_num, r.pre_stay_time, r.post_visition_num, r.post_stay_time) == (1, 5400.0, 1, 0.0)


def test_missing_camera_and_missing_profile_are_keys_of_their_own(spark):
    """A window takes NULL as one key: no row of it may get lost or stay without its follower."""
    from gatewise.operators import footfall as ff

    rows = [capture(1, "2024-01-03 10:00:00", region="Entrances 1", camera=None, cid="a"),
            capture(2, "2024-01-03 10:00:01", region="Entrances 1", camera=None, cid="b"),
            capture(3, "2024-01-03 10:00:30", region="Entrances 1", camera=7, cid="c"),
            capture(None, "2024-01-03 11:00:00", cid="d"), capture(None, "2024-01-03 11:00:04", cid="e")]
    df = captures_df(spark, rows)
    groups = ff.companion_groups_by_camera(df).collect()
    assert sorted((r.profile_id, r.group_id) for r in groups) == [(1, 1), (2, 1), (3, 1)]
    detail = {r.capture_id: r.next_capture_time for r in ff.capture_detail(df).collect()}
    assert str(detail["d"]) == "2024-01-03 11:00:04" and detail["e"] is None
