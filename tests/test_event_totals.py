"""Group totals of the event jobs: a visitor counts once per camera group and
once for 'all', whatever the number of groups; the load time of the slim copy."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gatewise.operators import events as ev
from gatewise.sources import tables as tb
from tests.conftest import capture, captures_df, ts

CAMERAS = [("0", "North", "Arena"), ("1", "South", "Arena"), ("2", None, "Arena"), ("3", "Doors", "Casino Entrance")]


@pytest.fixture(scope="module")
def show(spark):
    """Calendar and capture detail of one event (14:00-16:00) with visitors in one or more groups."""
    listed = spark.createDataFrame([("Show", ts("2024-01-02 14:00:00"), ts("2024-01-02 16:00:00"))],
                                   "Title string, StartDtm timestamp_ntz, EndDtm timestamp_ntz")
    calendar = ev.event_calendar(listed.select(
        "*", F.lit("Hall").alias("Venue"), F.lit("concert").alias("EventType"), F.lit("Pop").alias("Genre"),
        F.col("StartDtm").alias("InsertDtm")))
    rows = [capture(1, "2024-01-02 13:30:00", camera=0, cid="a"), capture(1, "2024-01-02 13:40:00", camera=1, cid="b"),
            capture(1, "2024-01-02 13:45:00", camera=1, cid="c"), capture(1, "2024-01-02 15:00:00", camera=0, cid="d"),
            capture(1, "2024-01-02 18:00:00", camera=3, cid="e"),
            capture(2, "2024-01-02 13:50:00", camera=1, cid="f"), capture(2, "2024-01-02 16:30:00", camera=1, cid="g"),
            capture(3, "2024-01-02 13:55:00", camera=2, cid="h"),
            capture(1, "2024-01-01 12:00:00", camera=0, cid="i"), capture(1, "2024-01-01 12:10:00", camera=1, cid="j"),
            capture(2, "2024-01-01 12:20:00", camera=1, cid="k")]
    cameras = spark.createDataFrame(CAMERAS, "camera_id string, group string, business_sector string")
    detail = ev.event_capture_detail(captures_df(spark, rows), cameras, calendar)
    return tb.materialize(detail, "totals-detail"), tb.materialize(calendar, "totals-calendar")


def by_group(df, *measures):
    return {r["group"]: tuple(r[m] for m in measures) for r in df.where("hour_window = 1").collect()}


def test_a_visitor_of_two_groups_counts_once_for_all(show):
    got = by_group(ev.event_pre_post(*show), "pre_visition_num", "pre_stay_time", "post_visition_num", "post_stay_time")
    # seconds to the next capture: a 600, b 300, c 4500 (visitor 1), f 9600 (visitor 2); g and h have none
    assert got == {"North": (1, 600.0, 0, 0.0), "South": (2, 14400.0, 1, 0.0), None: (1, 0.0, 0, 0.0),
                   "Doors": (0, 0.0, 0, 0.0), "all": (3, 15000.0, 1, 0.0)}


def test_totals_of_the_second_variant(show):
    got = by_group(ev.event_pre_post_v2(*show), "pre_visition_num", "pre_stay_time", "post_visition_num")
    # its dates start on the day before, one in number here: i (600 s to j), j and k
    assert got == {"North": (1, 600.0, 0), "South": (2, 0.0, 0), "all": (2, 600.0, 0)}


def test_converted_visitors_count_once_for_all(show):
    got = by_group(ev.event_conversion(*show), "visition_num", "casino_converted_visition_num")
    assert got == {"North": (1, 1), "South": (2, 1), None: (1, 0), "all": (3, 1)}


def test_joined_rows_are_read_once_and_reduced_before_they_are_doubled(show):
    plan = ev.event_pre_post(*show)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2  # attendees with their windows, these with the captures
    doubled = plan.index("Generate explode(array(group")
    assert "Aggregate" in plan[doubled:plan.index("Join Inner")]


def test_event_without_captures_has_no_totals(show):
    detail, calendar = show
    none = detail.where("false")
    for job in (ev.event_pre_post, ev.event_pre_post_v2, ev.event_conversion):
        assert job(none, calendar).count() == 0


def test_slim_copy_carries_its_load_time(spark, tmp_path):
    rows = captures_df(spark, [capture(1, "2024-01-02 13:30:00", cid="a"), capture(None, "2024-01-02 13:31:00", cid="b")])
    out = tb.slim_copy(rows, f"{tmp_path}/slim", F.lit("2024-01-03 06:00:00").cast("timestamp_ntz"))
    assert out.columns == [*tb.SLIM_COLUMNS, "batch_time"]
    assert {(r.profile_id, r.batch_time) for r in out.collect()} == {(1, dt.datetime(2024, 1, 3, 6)), (None, dt.datetime(2024, 1, 3, 6))}
    now = tb.slim_copy(rows, f"{tmp_path}/slim")
    assert now.count() == 2 and now.select("batch_time").distinct().count() == 1


def test_captures_are_joined_once_for_all_hour_windows(show):
    """Neither the hour windows nor a capture's repetition for several events multiply the joined rows."""
    detail, calendar = show
    for job in (ev.event_pre_post, ev.event_pre_post_v2):
        plan = job(detail, calendar)._jdf.queryExecution().optimizedPlan().toString()
        joins = plan[plan.index("Join Inner"):]
        assert "hour_window" not in joins
        assert "sum(" in joins  # stays are added up per second first
    conversion = ev.event_conversion(detail, calendar)._jdf.queryExecution().optimizedPlan().toString()
    assert "hour_window" not in conversion[conversion.index("Join "):]


def test_repeated_captures_count_each_time(show):
    detail, calendar = show
    for job, c in ((ev.event_pre_post, "pre_stay_time"), (ev.event_pre_post_v2, "pre_stay_time")):
        single, twice = (by_group(job(x, calendar), c) for x in (detail, detail.unionByName(detail)))
        assert twice == {g: (2 * n,) for g, (n,) in single.items()}


def test_later_windows_hold_the_visitors_of_earlier_ones(spark, show):
    detail, calendar = show
    rows = {(r["group"], r["hour_window"]): r["visition_num"] for r in ev.event_conversion(detail, calendar).collect()}
    assert {k: v for k, v in rows.items() if k[0] == "all"} == {("all", h): 3 for h in (1, 2, 4)}
    only = detail.where("time_window = -1 and event_name is not null").withColumn("time_window", F.lit(-2))
    assert {r["hour_window"] for r in ev.event_conversion(only, calendar).collect()} == {2, 4}
    both = detail.where("event_name is null").unionByName(only)
    assert {r["hour_window"] for r in ev.event_pre_post(both.unionByName(only), calendar).collect()} <= {2, 4}
