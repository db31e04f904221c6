"""Footfall jobs on hand-made rows: lead boundaries, stays, flags, groups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gatewise.operators import footfall as ff

from .conftest import capture, captures_df


def _by_cid(df, col):
    return {r.capture_id: r[col] for r in df.select("capture_id", col).collect()}


def test_next_capture_respects_midnight_and_six(spark):
    rows = [capture(1, "2024-01-02 23:59:00", cid="a"), capture(1, "2024-01-03 00:01:00", cid="b"),
            capture(1, "2024-01-03 05:59:59", cid="c"), capture(1, "2024-01-03 06:00:00", cid="d"),
            capture(1, "2024-01-03 06:00:00", cid="e"), capture(1, "2024-01-03 06:00:05", cid="f")]
    det = ff.capture_detail(captures_df(spark, rows))
    nxt = _by_cid(det, "next_capture_time")
    assert nxt["a"] is None                      # midnight splits the business day
    assert nxt["b"] == dt.datetime(2024, 1, 3, 5, 59, 59)
    assert nxt["c"] is None                      # 06:00 starts the next business day
    assert nxt["d"] == dt.datetime(2024, 1, 3, 6, 0, 0)   # tie at the same second, ordered by id
    assert nxt["e"] == dt.datetime(2024, 1, 3, 6, 0, 5)
    assert nxt["f"] is None
    bd = _by_cid(det, "date_casino")
    assert str(bd["c"]) == "2024-01-02" and str(bd["d"]) == "2024-01-03"


def test_days_filter_equals_union_of_single_days(spark):
    rows = [capture(p, f"2024-01-0{d} {h:02d}:{m:02d}:00", region=r)
            for p in (1, 2) for d in (2, 3, 4) for h in (7, 23) for m in (0, 10)
            for r in (["CASINO 1"] if m == 0 else ["ZONE 5"])]
    raw = captures_df(spark, rows)
    whole = ff.capture_detail(raw).drop("date_casino")
    parts = None
    for day in ["2024-01-02", "2024-01-03", "2024-01-04"]:
        one = ff.capture_detail(raw, days=[day]).drop("date_casino")
        parts = one if parts is None else parts.unionByName(one)
    assert whole.exceptAll(parts).count() == 0 and parts.exceptAll(whole).count() == 0


def test_repartitioned_input_changes_nothing(spark):
    rows = [capture(p, f"2024-01-02 {h:02d}:{m:02d}:{s:02d}", region=f"ZONE {5 + (m % 3)}")
            for p in (1, 2, 3) for h in (8, 9) for m in (0, 7, 14) for s in (0, 30)]
    raw = captures_df(spark, rows)
    a = ff.stay_time(ff.capture_detail(raw))
    b = ff.stay_time(ff.capture_detail(raw.repartition(7, "capture_id")))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stay_time_and_short_flag(spark):
    rows = [capture(1, "2024-01-02 10:00:00", cid="a"), capture(1, "2024-01-02 10:15:00", cid="b"),
            capture(2, "2024-01-02 10:00:00", cid="c"), capture(2, "2024-01-02 10:14:59", cid="d")]
    stay = ff.stay_time(ff.capture_detail(captures_df(spark, rows)))
    got = {r.profile_id: (r.capture_count, r.stay_time) for r in stay.collect()}
    assert got == {1: (2, 900.0), 2: (2, 899.0)}
    nor = {r.profile_id: r.is_less15min_visitor for r in ff.new_or_return(stay).collect()}
    assert nor == {1: 0, 2: 1}                   # exactly 900 s is not short


def test_return_flags_bounds(spark):
    rows = [
        # zone visits: 2024-01-01 then 2024-03-01 (exactly 2 months) then 2024-05-02 (> 2 months)
        capture(1, "2024-01-01 10:00:00", region="ZONE 5"), capture(1, "2024-03-01 10:00:00", region="ZONE 5"),
        capture(1, "2024-05-02 10:00:00", region="ZONE 5"),
        # casino visits: 01-10, 01-12 (2 days later), 01-15 (3 days later)
        capture(2, "2024-01-10 10:00:00", region="CASINO 1", sector="Casino"),
        capture(2, "2024-01-12 10:00:00", region="CASINO 1", sector="Casino"),
        capture(2, "2024-01-15 10:00:00", region="CASINO 1", sector="Casino"),
    ]
    nor = ff.new_or_return(ff.stay_time(ff.capture_detail(captures_df(spark, rows))))
    got = {(r.profile_id, str(r.date_casino)): (r.is_return_zone, r.is_return_casino) for r in nor.collect()}
    assert got[(1, "2024-01-01")] == (0, 0)
    assert got[(1, "2024-03-01")] == (1, 0)      # d - 2 months is inclusive
    assert got[(1, "2024-05-02")] == (0, 0)
    assert got[(2, "2024-01-10")] == (0, 0)
    assert got[(2, "2024-01-12")] == (0, 1)      # d - 2 days is inclusive
    assert got[(2, "2024-01-15")] == (0, 0)


def test_companion_groups_gap_rule(spark):
    # FIXTURES case: 08:00:00, :01, :02, :05, :06 -> groups 1,1,1,2,2 per camera (first gap opens 1)
    times = ["08:00:00", "08:00:01", "08:00:02", "08:00:05", "08:00:06"]
    rows = [capture(i + 1, f"2024-01-02 {t}", region="CASINO 1", camera=1, sector="Casino")
            for i, t in enumerate(times)]
    raw = captures_df(spark, rows)
    by_cam = {r.profile_id: r.group_id for r in ff.companion_groups_by_camera(raw, region_prefix="CASINO").collect()}
    assert by_cam == {1: 1, 2: 1, 3: 1, 4: 2, 5: 2}
    shared = {r.profile_id: r.group_id for r in ff.companion_groups(raw).collect()}
    assert shared == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1}   # first group is 0 across cameras


def test_companion_groups_keep_latest_per_hour(spark):
    rows = [capture(1, "2024-01-02 08:00:00", region="CASINO 1", sector="Casino", cid="x"),
            capture(1, "2024-01-02 08:30:00", region="CASINO 2", sector="Casino", cid="y"),
            capture(1, "2024-01-02 09:10:00", region="ZONE 5", cid="z")]
    out = ff.companion_groups(captures_df(spark, rows)).collect()
    assert [(r.region_name, str(r.capture_time)) for r in out] == [("CASINO 2", "2024-01-02 08:30:00")]


def test_group_sizes_buckets(spark):
    rows = [capture(p, "2024-01-02 08:00:00", region="CASINO 1", sector="Casino") for p in range(1, 7)]
    rows += [capture(10, "2024-01-02 09:00:00", region="CASINO 1", sector="Casino")]
    sizes = ff.companion_group_sizes(ff.companion_groups(captures_df(spark, rows)))
    got = {(r.region_id, r.group_type): r.group_visitor_num for r in sizes.collect()}
    assert got == {("1", "5+"): 6, ("1", "1"): 1, ("all", "5+"): 6, ("all", "1"): 1}


def test_daily_cube_counts(spark):
    rows = [capture(1, "2024-01-02 10:00:00", region="ZONE 5"), capture(1, "2024-01-02 10:20:00", region="ZONE 5"),
            capture(2, "2024-01-02 10:00:00", region="ZONE 5"), capture(2, "2024-01-02 10:05:00", region="ZONE 5"),
            capture(2, "2024-01-03 10:00:00", region="ZONE 5")]
    det = ff.capture_detail(captures_df(spark, rows))
    stay = ff.stay_time(det)
    idx = ff.visitor_index(det, stay)
    cube = ff.visits_daily_region(idx).where(F.col("date_casino") == "2024-01-03").collect()
    assert len(cube) == 1
    r = cube[0]
    assert (r.visitor_num, r.return_zone_visitor_num, r.new_zone_visitor_num) == (1, 1, 0)
    allr = ff.visits_daily_all(idx).where(F.col("date_casino") == "2024-01-02").collect()[0]
    assert (allr.visitor_num, allr.less15min_region_visitor_num, allr.new_zone_visitor_num) == (2, 1, 2)
    assert allr.new_zone_less15min_num == 1 and allr.return_zone_stay_time is None


def test_casino_cubes_mixed_rule(spark):
    # day 1: CASINO 1 once; day 2: CASINO 1 again (a return within 2 days) and CASINO 2 (first visit)
    rows = [capture(1, "2024-01-02 09:00:00", region="CASINO 1", sector="Casino", cid="a"),
            capture(1, "2024-01-03 10:00:00", region="CASINO 1", sector="Casino", cid="b"),
            capture(1, "2024-01-03 10:10:00", region="CASINO 1", sector="Casino", cid="c"),
            capture(1, "2024-01-03 10:20:00", region="CASINO 2", sector="Casino", cid="d"),
            capture(1, "2024-01-03 10:25:00", region="CASINO 2", sector="Casino", cid="e")]
    det = ff.capture_detail(captures_df(spark, rows))
    idx = ff.visitor_index(det, ff.stay_time(det))
    day2 = F.col("date_casino") == "2024-01-03"
    by_region = {r.region_id: (r.return_casino_visitor_num, r.new_casino_visitor_num, r.stay_time)
                 for r in ff.visits_daily_casino_region(idx).where(day2).collect()}
    assert by_region == {"1": (1, 0, 1200.0), "2": (0, 1, 300.0)}
    r = ff.visits_daily_casino_all(idx).where(day2).collect()[0]
    # visitors: the profile has a return flag somewhere that day -> returning, not new
    assert (r.visitor_num, r.return_casino_visitor_num, r.new_casino_visitor_num) == (1, 1, 0)
    # stay: split by each row's own flag
    assert (r.stay_time, r.return_casino_stay_time, r.new_casino_stay_time) == (1500.0, 1200.0, 300.0)
    assert (r.less15min_casino_visitor_num, r.return_casino_less15min_num, r.new_casino_less15min_num) == (0, 0, 0)
