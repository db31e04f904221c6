"""Path offset jobs: where a visitor was within +-60 minutes of each capture.

The SQL variants (Q21, Q22) bin whole minutes: :func:`minute_sweep` passes once
over the minutes of a profile-day with a RANGE frame per bin.

The per-profile variants (Q23, Q24) bin elapsed seconds by a band self-join:
both sides carry the epoch second; the right side is replicated to the
neighbouring buckets of width ``W`` so an equi-join on (profile, day, bucket)
finds every pair with ``|pos2 - pos1| <= W``, which a filter then enforces
exactly. The join key includes the bucket, so a profile with many captures is
spread over its hours. The sightings side keeps one or two rows a second,
which bounds each capture's partners by the distinct seconds in two hours.

"Nearest" picks use a total order (|delta|, then time, then id/area), so
every result is reproducible; the reference leaves ties to chance. The
per-profile variants (Q23, Q24) keep visitors without a member tier as their
own group (a NULL group key), where the reference's frame grouping drops them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewise.functions import derive as d

BINS = d.TARGET_BINS


def band_join(left: DataFrame, right: DataFrame, keys: Sequence[str], lpos: str, rpos: str,
              width: int) -> DataFrame:
    """All (left, right) pairs with equal ``keys`` and ``|rpos - lpos| <= width``.

    An equi-join on (keys, bucket), the right side sent to three buckets. The
    output keeps ``_jb`` (the left row's bucket, a function of its position):
    grouping keys that contain ``keys`` and ``_jb`` need no further shuffle.
    """
    lb = left.withColumn("_jb", F.floor(F.col(lpos) / F.lit(width)).cast("long"))
    rb = (right.withColumn("_b", F.floor(F.col(rpos) / F.lit(width)).cast("long"))
          .withColumn("_jb", F.explode(F.array(F.col("_b") - 1, F.col("_b"), F.col("_b") + 1)))
          .drop("_b"))
    return (lb.join(rb, on=[*keys, "_jb"], how="inner")
            .where(F.abs(F.col(rpos) - F.col(lpos)) <= width))


# Minute differences (first, last) of each bin of the SQL path jobs, as
# ``d.offset_bin_v1`` and ``d.offset_bin_new`` give them; 15 and 60 are in no
# listed bin. A negative bin mirrors its positive one.
BIN_MINUTES = {5: (1, 4), 10: (5, 9), 15: (10, 14), 30: (16, 29), 45: (30, 44), 60: (45, 59)}
REACH = 60   # minutes


def _recoded(detail: DataFrame) -> DataFrame:
    """Captures of the SQL path jobs: areas recoded (BW, CASINO, else name),
    minute and second numbers. Rows without a profile or day pair with
    nothing, not even themselves, and go."""
    return (detail.where(F.col("profile_id").isNotNull() & F.col("date_casino").isNotNull())
            .select("profile_id", "date_casino", "capture_time", "member_tier", "age", "gender", "profile_type",
                    d.path_area("region_name").alias("area"), d.path_area("region_name_heatmap").alias("area_h"),
                    d.minute_index("capture_time").alias("minute"), d.epoch_seconds("capture_time").alias("second")))


def minute_sweep(sightings: DataFrame, keep_seconds: bool = False) -> DataFrame:
    """One row per (profile, day, minute) with a sighting, and what lies around it.

    In a later bin the nearest sighting is the first one of its minutes, in an
    earlier bin the last one, whichever second of the minute asks. So each
    minute keeps its first and last sighting, and one ordered pass over the
    minutes takes the least of them over a RANGE frame per bin: no pair of
    captures is formed and no row is sent to a second place. A profile-day
    has at most 1,440 minutes, however many captures it holds.

    ``ahead`` / ``behind``: bin -> (seconds, time, area, heatmap area), NULL
    where the bin is empty (seconds are negated in ``behind``);
    ``any_ahead`` / ``any_behind``: whether any sighting lies within the reach;
    ``seconds`` (with ``keep_seconds``): the distinct sightings of the minute.
    """
    key = ["profile_id", "date_casino", "minute"]
    seen = [F.col("capture_time").alias("t"), F.col("area").alias("a"), F.col("area_h").alias("h")]
    first, last = F.struct(F.col("second").alias("s"), *seen), F.struct((-F.col("second")).alias("s"), *seen)
    minutes = sightings.groupBy(*key).agg(
        F.min(first).alias("_first"), F.min(last).alias("_last"),
        *([F.collect_set(first).alias("seconds")] if keep_seconds else []))
    order = Window.partitionBy("profile_id", "date_casino").orderBy("minute")
    ahead = [F.min("_first").over(order.rangeBetween(lo, hi)).alias(f"b{b}") for b, (lo, hi) in BIN_MINUTES.items()]
    behind = [F.min("_last").over(order.rangeBetween(-hi, -lo)).alias(f"b{b}") for b, (lo, hi) in BIN_MINUTES.items()]
    return minutes.select(
        *key, F.struct(*ahead).alias("ahead"), F.struct(*behind).alias("behind"),
        (F.lead("minute").over(order) - F.col("minute") <= REACH).alias("any_ahead"),
        (F.col("minute") - F.lag("minute").over(order) <= REACH).alias("any_behind"),
        *(["seconds"] if keep_seconds else []))


def path_offsets(detail: DataFrame) -> DataFrame:
    """Q21: per capture, the offset bins (boundary minutes, first SQL rule) at
    which the same profile was seen within +-60 minutes of the business day;
    distinct profiles per hour, area, bin and demographics. ``area_at_off`` is
    the own area for bin 0, else the area of the group's nearest sighting
    (|seconds|, then time, then area).

    Another second of the capture's own minute is in bin 5, before or after it."""
    rows = _recoded(detail)
    sweep = minute_sweep(rows, keep_seconds=True)
    near = (rows.distinct().join(sweep, on=["profile_id", "date_casino", "minute"], how="inner"))
    own = F.col("second")

    def entry(b: int, x: F.Column, gap: F.Column) -> F.Column:
        return F.when(x.isNotNull(), F.struct(
            F.lit(b).cast("long").alias("off_bin"),
            F.struct(gap.alias("k1"), x["t"].alias("k2"), x["a"].alias("a"), x["h"].alias("h")).alias("pick")))

    same_minute = F.array_min(F.transform(
        F.filter("seconds", lambda x: x["t"] != F.col("capture_time")),
        lambda x: F.struct(F.abs(x["s"] - own).alias("s"), x["t"].alias("t"), x["a"].alias("a"), x["h"].alias("h"))))
    bins = F.array(
        F.struct(F.lit(0).cast("long").alias("off_bin"),
                 F.struct(F.lit(0).cast("long").alias("k1"), F.col("capture_time").alias("k2"),
                          F.col("area").alias("a"), F.col("area_h").alias("h")).alias("pick")),
        entry(5, same_minute, same_minute["s"]),
        *[entry(b, F.col(f"ahead.b{b}"), F.col(f"ahead.b{b}.s") - own) for b in BIN_MINUTES],
        *[entry(-b, F.col(f"behind.b{b}"), own + F.col(f"behind.b{b}.s")) for b in BIN_MINUTES])
    keys = ["date_casino", "date_hour", "region_name", "region_name_heatmap", "z0_time", "off_bin",
            "member_tier", "profile_type", "age_range", "gender"]
    per_profile = (near.select(
        "date_casino", F.date_format("capture_time", "HH:00").alias("date_hour"),
        F.col("area").alias("region_name"), F.col("area_h").alias("region_name_heatmap"),
        d.hour_start("capture_time").alias("z0_time"), "member_tier", "profile_type",
        d.age_band("age").alias("age_range"), "gender", "profile_id",
        F.explode(F.filter(bins, lambda x: x.isNotNull())).alias("_e"))
        .select("*", "_e.off_bin", F.col("_e.pick").alias("_pick")).drop("_e")
        .groupBy(*keys, "profile_id").agg(F.min("_pick").alias("_pick")))
    g = per_profile.groupBy(*keys).agg(F.count(F.lit(1)).alias("visitor_num"), F.min("_pick").alias("_pick"))
    zero = F.col("off_bin") == 0
    return g.select(
        "date_casino", "date_hour", "visitor_num", "region_name", "region_name_heatmap", "z0_time",
        "off_bin",
        F.when(zero, F.col("region_name")).otherwise(F.col("_pick.a")).alias("area_at_off"),
        F.when(zero, F.col("region_name_heatmap")).otherwise(F.col("_pick.h")).alias("area_at_off_heatmap"),
        "member_tier", "profile_type", "age_range", "gender")


def path_offsets_carry(detail: DataFrame) -> DataFrame:
    """Q22: 13 fixed bins per capture (second SQL rule, d = 0 always bin 0).

    Bin 0 is the own area; a bin with a sighting takes the nearest one's
    area; a positive (negative) bin without a sighting carries the own area
    when the capture has no later (earlier) sighting at all; otherwise the bin
    is dropped. Distinct profiles per (hour, own area, bin, area at bin,
    demographics).

    Nothing here depends on the second of a capture, so the captures side is
    distinct minutes (and areas and attributes) too.
    """
    rows = _recoded(detail)
    asked = rows.select("profile_id", "date_casino", "minute", "area", "area_h", "member_tier", "profile_type",
                        d.age_band("age").alias("age_range"), "gender",
                        d.hour_start("capture_time").alias("z0_time")).distinct()
    near = asked.join(minute_sweep(rows), on=["profile_id", "date_casino", "minute"], how="inner")

    def entry(b: int, hit: F.Column, seen: F.Column) -> F.Column:
        area = F.when(hit.isNotNull(), hit["a"]).when(~F.coalesce(seen, F.lit(False)), F.col("area"))
        area_h = F.when(hit.isNotNull(), hit["h"]).when(~F.coalesce(seen, F.lit(False)), F.col("area_h"))
        return F.struct(F.lit(b).cast("long").alias("off_bin"), area.alias("area_at_off"),
                        area_h.alias("area_at_off_heatmap"))

    bins = F.array(
        F.struct(F.lit(0).cast("long").alias("off_bin"), F.col("area").alias("area_at_off"),
                 F.col("area_h").alias("area_at_off_heatmap")),
        *[entry(b, F.col(f"ahead.b{b}"), F.col("any_ahead")) for b in BIN_MINUTES],
        *[entry(-b, F.col(f"behind.b{b}"), F.col("any_behind")) for b in BIN_MINUTES])
    keys = ["date_casino", "date_hour", "off_bin", "area_at_off", "area_at_off_heatmap", "region_name",
            "z0_time", "member_tier", "profile_type", "age_range", "gender"]
    return (near.select(
        "date_casino", F.date_format("z0_time", "HH:00").alias("date_hour"), F.col("area").alias("region_name"),
        "z0_time", "member_tier", "profile_type", "age_range", "gender", "profile_id",
        F.explode(F.filter(bins, lambda x: x["area_at_off"] != "")).alias("_e"))
        .select("*", "_e.*").drop("_e")
        .groupBy(*keys).agg(F.countDistinct("profile_id").alias("visitor_num")))


NEAREST_COLUMNS = ["date", "date_hour", "profile_id", "region_name", "z0_time", "off_bin", "area_at_off",
                   "member_tier", "age_range", "gender"]


def _calendar_sides(detail: DataFrame, per_row_attrs: bool, keep_per_second: int):
    """Captures (v1) and sightings (v2) of the per-profile jobs.

    Sightings keep only the ``keep_per_second`` smallest capture ids of each
    (profile, date, second): the nearest pick orders by (|delta|, time, id),
    so a larger id of the same second can never win. This bounds each
    capture's partners by the distinct seconds within two hours.
    """
    base = detail.select("profile_id", F.to_date("capture_time").alias("date"), "capture_time", "capture_id",
                         "region_name", "member_tier", "age", "gender")
    if not per_row_attrs:
        # the first capture of the profile-day stands for its attributes
        first = (base.groupBy("profile_id", "date")
                 .agg(F.min_by(F.struct("member_tier", "age", "gender"),
                               F.struct("capture_time", "capture_id")).alias("_f")))
        base = (base.drop("member_tier", "age", "gender")
                .join(first, on=["profile_id", "date"], how="inner")
                .select("*", "_f.member_tier", "_f.age", "_f.gender").drop("_f"))
    v1 = base.withColumn("s1", d.epoch_seconds("capture_time"))
    w = Window.partitionBy("profile_id", "date", "capture_time").orderBy("capture_id")
    v2 = (detail.select("profile_id", F.to_date("capture_time").alias("date"), F.col("capture_time").alias("ct2"),
                        F.col("capture_id").alias("cid2"), F.col("region_name").alias("area2"))
          .withColumn("_rk", F.row_number().over(w.partitionBy("profile_id", "date", "ct2").orderBy("cid2")))
          .where(F.col("_rk") <= keep_per_second).drop("_rk")
          .withColumn("s2", d.epoch_seconds("ct2")))
    return v1, v2


def _nearest(pairs: DataFrame, diff: F.Column, band: str) -> DataFrame:
    """Per (date, hour, profile, own area, hour start, bin, attributes): area of
    the pair with the least |diff|, then earliest own capture, then earliest
    sighting (the reference's two nested arg-mins merged into one)."""
    keys = ["date", "date_hour", "profile_id", "region_name", "z0_time", "off_bin", "member_tier",
            "age_range", "gender"]
    pick = F.struct(F.abs(diff).alias("k0"), F.col("capture_time").alias("k1"), F.col("capture_id").alias("k2"),
                    F.col("ct2").alias("k3"), F.col("cid2").alias("k4"), F.col("area2").alias("a"))
    out = (pairs.select("date", F.date_format("capture_time", "HH:00").alias("date_hour"), "profile_id",
                        "region_name", d.hour_start("capture_time").alias("z0_time"), "off_bin",
                        "member_tier", d.age_band("age", default=band).alias("age_range"), "gender",
                        "_jb", pick.alias("_p"))
           .groupBy(*keys, "_jb").agg(F.min("_p").alias("_p")))
    return out.select(*[c if c != "area_at_off" else F.col("_p.a").alias("area_at_off")
                        for c in NEAREST_COLUMNS])


def path_offsets_nearest(detail: DataFrame) -> DataFrame:
    """Q23: per calendar day and profile, every capture within +-60 minutes
    (elapsed time); minutes = floor of elapsed minutes; bins by floor division
    (own capture -> 0); nearest sighting per bin. The first capture's age,
    tier and gender stand for the profile-day; bad ages give ''.

    Bin 0 comes only from the capture itself, so self rows are added
    directly and the join keeps other captures only (two smallest ids per
    second suffice: one of them is not the capture itself)."""
    v1, v2 = _calendar_sides(detail, per_row_attrs=False, keep_per_second=2)
    pairs = band_join(v1, v2, ["profile_id", "date"], "s1", "s2", 3600)
    pairs = (pairs.where(F.col("capture_id") != F.col("cid2"))
             .withColumn("d_min", F.floor((F.col("s2") - F.col("s1")) / F.lit(60)).cast("long"))
             .withColumn("is_self", F.lit(False))
             .withColumn("off_bin", d.offset_bin_floor("d_min", "is_self"))
             .where(F.col("off_bin").isin(BINS)))
    selfs = (v1.withColumn("_jb", F.floor(F.col("s1") / F.lit(3600)).cast("long"))
             .withColumn("ct2", F.col("capture_time")).withColumn("cid2", F.col("capture_id"))
             .withColumn("area2", F.col("region_name")).withColumn("s2", F.col("s1"))
             .withColumn("d_min", F.lit(0).cast("long")).withColumn("is_self", F.lit(True))
             .withColumn("off_bin", F.lit(0).cast("long")))
    return _nearest(pairs.unionByName(selfs), F.col("d_min"), "")


def path_offsets_fractional(detail: DataFrame) -> DataFrame:
    """Q24: as Q23 on fractional minutes (seconds / 60), each capture with its
    own attributes; profile-days with a single capture give no rows; values
    between 15 and 16 minutes get no bin. Any same-second pair is bin 0, so
    one sighting (the smallest id) per second is kept."""
    v1, v2 = _calendar_sides(detail, per_row_attrs=True, keep_per_second=1)
    multi = (v1.groupBy("profile_id", "date").agg(F.count(F.lit(1)).alias("_n"))
             .where(F.col("_n") >= 2).drop("_n"))
    v1 = v1.join(multi, on=["profile_id", "date"], how="left_semi")
    pairs = band_join(v1, v2, ["profile_id", "date"], "s1", "s2", 3600)
    frac = (F.col("s2") - F.col("s1")) / F.lit(60.0)
    pairs = (pairs.withColumn("d_frac", frac)
             .withColumn("off_bin", d.offset_bin_fractional("d_frac"))
             .where(F.col("off_bin").isin(BINS)))
    return _nearest(pairs, F.col("s2") - F.col("s1"), "")


def path_daily(index: DataFrame) -> DataFrame:
    """Q25: distinct profiles per business day x area x demographics; area
    recoded (gaming floor -> CASINO, BW prefix -> BW); sector recoded."""
    return (index.select("date_casino", "region_type",
                         d.daily_path_area("region_name", "region_type").alias("region_name"),
                         "gender", "Age_range", "profile_type", "member_tier",
                         d.recoded_sector("region_type", "sector").alias("sector"), "profile_id")
            .groupBy("date_casino", "region_type", "region_name", "gender", "Age_range", "profile_type",
                     "member_tier", "sector")
            .agg(F.countDistinct("profile_id").alias("visitor_num")))
