"""The minute sweep of Q21 / Q22 against the bin rules and plain loops."""

from __future__ import annotations

import datetime as dt
import random

from gatewise.functions import derive as d
from gatewise.operators import paths as pa
from pyspark.sql import functions as F


def test_frames_are_the_bin_rules(spark):
    rows = spark.range(-61, 62).select(F.col("id").alias("d_min"), (F.col("id") == 0).alias("same_time"))
    for rule in (d.offset_bin_v1, d.offset_bin_new):
        for r in rows.select("d_min", rule().alias("bin")).collect():
            frame = [b for b, (lo, hi) in pa.BIN_MINUTES.items() if lo <= abs(r.d_min) <= hi]
            want = frame[0] * (1 if r.d_min > 0 else -1) if frame else 0 if r.d_min == 0 else None
            assert (r.bin if r.bin in pa.BINS else None) == want


def _sightings(n, seed):
    rnd = random.Random(seed)
    start = dt.datetime(2024, 1, 2, 10)
    days = [dt.date(2024, 1, 2), dt.date(2024, 1, 3), None]
    return [(rnd.choice([1, 1, 1, 2, None]), rnd.choice(days[:2] + days[:1] * 3 + days[2:]),
             start + dt.timedelta(seconds=rnd.randint(0, 9000)), rnd.choice(["A", "B", None]), rnd.choice(["X", "Y"]))
            for _ in range(n)]


def test_sweep_against_loops(spark):
    rows = _sightings(400, 3)
    frame = spark.createDataFrame(rows, "profile_id long, date_casino date, capture_time timestamp_ntz, area string, "
                                        "area_h string")
    frame = frame.where("profile_id is not null and date_casino is not null").select(
        "*", d.minute_index("capture_time").alias("minute"), d.epoch_seconds("capture_time").alias("second"))
    seen = [(p, day, int((t - dt.datetime(1970, 1, 1)).total_seconds()), t, a, h) for p, day, t, a, h in rows
            if p is not None and day is not None]
    first_null = lambda x: (x is not None, x or "")
    got = pa.minute_sweep(frame, keep_seconds=True).collect()
    assert {(r.profile_id, r.date_casino, r.minute) for r in got} == {(x[0], x[1], x[2] // 60) for x in seen}
    assert len(got) == len({(x[0], x[1], x[2] // 60) for x in seen})
    for r in got:
        mine = [x for x in seen if x[:2] == (r.profile_id, r.date_casino)]
        gaps = [x[2] // 60 - r.minute for x in mine]
        assert bool(r.any_ahead) == any(0 < g <= 60 for g in gaps)
        assert bool(r.any_behind) == any(-60 <= g < 0 for g in gaps)
        assert {(x.s, x.a, x.h) for x in r.seconds} == {(x[2], x[4], x[5]) for x, g in zip(mine, gaps) if g == 0}
        for b, (lo, hi) in pa.BIN_MINUTES.items():
            for side, sign in ((r.ahead, 1), (r.behind, -1)):
                near = [(sign * x[2], x[3], first_null(x[4]), first_null(x[5]), x) for x, g in zip(mine, gaps)
                        if lo <= sign * g <= hi]
                hit = side[f"b{b}"]
                assert (hit is None) == (not near)
                if near:
                    x = min(near)[4]
                    assert (hit.s, hit.t, hit.a, hit.h) == (sign * x[2], x[3], x[4], x[5])


def test_no_pairs_and_no_copies(spark):
    """The plan joins captures with minutes only: no row is sent to several buckets."""
    detail = spark.createDataFrame([], "profile_id long, date_casino date, capture_time timestamp_ntz, member_tier string, "
                                       "age int, gender int, profile_type int, region_name string, "
                                       "region_name_heatmap string, region_type string, property string")
    for job in (pa.path_offsets, pa.path_offsets_carry):
        out = job(detail)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Generate") == 1 and out.count() == 0
