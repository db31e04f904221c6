"""Footfall warehouse jobs: capture detail, per-profile facts and visitor cubes.

Every job takes DataFrames and returns a DataFrame covering *all* days of its
input at once (the reference runs one day per call); day-level slicing is a
filter on ``date_casino`` (or ``date``) and writing is left to
``gatewise.sources.tables.write_slices``.

Conventions kept from the reference
- Business day = ``to_date(capture_time - 6 h)`` (column ``date_casino``).
- An unmatched LEFT JOIN side reads as 0 in flags (``coalesce(..., 0)``).
- ``sum(case ...)`` stays NULL without matches.

Intended meaning instead of a default-value artefact
- The "all"/"sector" cubes count *matched* profiles in their conditional
  distinct counts; the reference also counts the default id 0 of unmatched
  rows as one extra value.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewise.functions import derive as d
from gatewise.operators.common import (gap_group_ids, latest_per, next_capture_time,
                                       ratio_round2)

DEMO = ["gender", "Age_range", "profile_type", "member_tier"]
SHORT = d.SHORT_STAY_SECONDS


def _days(df: DataFrame, days: Iterable | None, column: str = "date_casino") -> DataFrame:
    if days is None:
        return df
    return df.where(F.col(column).isin([F.lit(x).cast("date") for x in days]))


def _stay_seconds() -> F.Column:
    nxt = F.coalesce(F.col("next_capture_time"), F.col("capture_time"))
    return d.epoch_seconds(nxt) - d.epoch_seconds("capture_time")


# ---------------------------------------------------------------------------
# Q01 capture detail
# ---------------------------------------------------------------------------
def capture_detail(captures_raw: DataFrame, days: Iterable | None = None) -> DataFrame:
    """Q01: captures + property, region_type, next capture of the same profile.

    The next capture is looked up within (business day, calendar date,
    profile), so it never crosses 06:00 or midnight. Optional pass-through
    columns of the raw table are kept.
    """
    df = captures_raw
    if days is not None:
        days = [x if isinstance(x, dt.date) else dt.date.fromisoformat(str(x)) for x in days]
        # business days run from 06:00 to 06:00: a range on the stored column
        # reaches the scan, the exact days are kept after it
        if days:
            opens = [dt.datetime.combine(x, dt.time(6)) for x in (min(days), max(days) + dt.timedelta(days=1))]
            df = df.where((F.col("capture_time") >= F.lit(opens[0]).cast("timestamp_ntz"))
                          & (F.col("capture_time") < F.lit(opens[1]).cast("timestamp_ntz")))
    df = df.withColumn("date_casino", d.business_day("capture_time"))
    df = _days(df, days)
    df = df.withColumn("_cal", F.to_date("capture_time"))
    df = next_capture_time(df, ["date_casino", "_cal", "profile_id"])
    extra = [c for c in captures_raw.columns
             if c not in {"profile_id", "person_id", "profile_type", "member_tier", "age", "gender",
                          "capture_id", "region_id", "region_name", "sector", "region_name_heatmap",
                          "camera_id", "capture_time", "batch_time"}]
    return df.select(
        "profile_id", "person_id", "profile_type", "member_tier", *extra, "age", "gender",
        "capture_id", "region_id", "region_name", "sector", "region_name_heatmap",
        d.region_type("region_name").alias("region_type"),
        d.region_property("region_name").alias("property"),
        "camera_id", "capture_time", "next_capture_time", "date_casino")


# ---------------------------------------------------------------------------
# Q05 / Q06 / Q07 stay time
# ---------------------------------------------------------------------------
STAY_KEYS = ["date", "date_casino", "profile_id", "region_id", "region_name", "region_type",
             "member_tier", "gender", "Age_range", "profile_type"]


def stay_time(detail: DataFrame) -> DataFrame:
    """Q05: per (date, business date, profile, region, attributes): capture
    count and stay seconds (sum of seconds to the next capture, 0 when none)."""
    return (detail
            .select(F.to_date("capture_time").alias("date"), "date_casino", "profile_id",
                    "region_id", "region_name", "region_type", "member_tier", "gender",
                    d.age_band("age").alias("Age_range"), "profile_type", "camera_id",
                    _stay_seconds().alias("_secs"))
            .groupBy(*STAY_KEYS)
            .agg(F.count("camera_id").alias("capture_count"),
                 F.sum("_secs").cast("double").alias("stay_time")))


def stay_time_filled(detail: DataFrame) -> DataFrame:
    """Q06 (older variant): longest single gap per group; a group whose longest
    gap is 0 gets the (date, business date, region) mean instead, where the
    mean is round(sum of per-profile longest gaps / distinct profiles, 2),
    half-to-even on the exact quotient, over captures that have a next
    capture (0 when the region has none)."""
    base = detail.select(F.to_date("capture_time").alias("date"), "date_casino", "profile_id",
                         "region_id", "region_name", "region_type", "member_tier", "gender",
                         d.age_band("age").alias("Age_range"), "profile_type", "camera_id",
                         "next_capture_time", _stay_seconds().alias("_secs"))
    per_profile = (base.where(F.col("next_capture_time").isNotNull())
                   .groupBy("date", "date_casino", "region_id", "profile_id")
                   .agg(F.max("_secs").alias("_p")))
    region_mean = (per_profile.groupBy("date", "date_casino", "region_id")
                   .agg(ratio_round2(F.sum("_p"), F.count("profile_id")).alias("_avg")))
    grouped = (base.groupBy(*STAY_KEYS)
               .agg(F.count("camera_id").alias("capture_count"), F.max("_secs").alias("_mx")))
    # region means are an aggregate of the input itself: counting them first
    # would cost a pass, so AQE sizes this join at run time
    out = grouped.join(region_mean, on=["date", "date_casino", "region_id"], how="left")
    filled = F.when(F.col("_mx") == 0, F.coalesce(F.col("_avg"), F.lit(0.0))) \
        .otherwise(F.col("_mx").cast("double"))
    return out.select(*STAY_KEYS, "capture_count", filled.alias("stay_time"))


def stay_time_segments(captures_raw: DataFrame) -> DataFrame:
    """Q07: gaps-and-islands stay per (profile, date, business date, region).

    Captures of a profile on a (date, business date), in (time, capture id)
    order, form segments: a new segment starts where the region differs from
    the previous capture's. A segment's stay is the next segment's start minus
    its own (NULL for the last); the result keeps the longest stay per region,
    and a missing stay takes the mean of that (date, business date, region),
    else 0.

    No window spans a whole profile-day: the previous capture's region comes
    from a window over one second (or the last capture of the previous
    distinct second), and the next segment start from a window over one
    second or over distinct start seconds (at most 86,400 per profile-day).
    """
    keys = ["profile_id", "date", "date_casino"]
    base = captures_raw.select(
        "profile_id", "profile_type", "member_tier", d.age_band("age").alias("Age_range"),
        "gender", "region_id", "region_name", "capture_time", "capture_id",
        F.to_date("capture_time").alias("date"), d.business_day("capture_time").alias("date_casino"))
    t = "capture_time"
    # 1) inside one second (ordered by capture id): region changes and whether
    #    a later change follows in the same second
    w_sec = Window.partitionBy(*keys, t).orderBy("capture_id")
    prev_in = F.lag("region_id").over(w_sec)
    rows = (base
            .withColumn("_is_first", prev_in.isNull())
            .withColumn("_changed", prev_in.isNotNull() & (prev_in != F.col("region_id")))
            .withColumn("_later", F.max(F.col("_changed").cast("int"))
                        .over(w_sec.rowsBetween(1, Window.unboundedFollowing)) == 1))
    # 2) per second: first and last region, any inner change; then over the
    #    distinct seconds: does the second open a segment, and the next second
    #    that holds a segment start
    secs = (rows.groupBy(*keys, t)
            .agg(F.min_by("region_id", "capture_id").alias("_first_region"),
                 F.max_by("region_id", "capture_id").alias("_last_region"),
                 F.max(F.col("_changed").cast("int")).alias("_inner")))
    w = Window.partitionBy(*keys).orderBy(t)
    prev_last = F.lag("_last_region").over(w)
    secs = secs.withColumn("_first_start", prev_last.isNull() | (prev_last != F.col("_first_region")))
    has_start = F.col("_first_start") | (F.col("_inner") == 1)
    secs = (secs.withColumn("_next_sec", F.min(F.when(has_start, F.col(t)))
                            .over(w.rowsBetween(1, Window.unboundedFollowing)))
            .select(*keys, t, "_first_start", "_next_sec"))
    # 3) segment starts carry the stay to the following start; one aggregate
    #    per (profile-day, region) takes the longest stay and the first
    #    capture's attributes
    rows = rows.join(secs, on=[*keys, t], how="inner")
    is_start = F.when(F.col("_is_first"), F.col("_first_start")).otherwise(F.col("_changed"))
    next_start = F.when(F.col("_later"), F.col(t)).otherwise(F.col("_next_sec"))
    stay = F.when(is_start, (d.epoch_seconds(next_start) - d.epoch_seconds(t)).cast("double"))
    order = F.struct("capture_time", "capture_id")
    res = (rows.withColumn("_stay", stay)
           .groupBy(*keys, "region_id")
           .agg(F.max("_stay").alias("stay_time"),
                *[F.min_by(c, order).alias(c) for c in ["profile_type", "Age_range", "gender", "region_name"]],
                F.min_by("member_tier", F.when(F.col("member_tier").isNotNull(), order)).alias("member_tier")))
    means = res.groupBy("date", "date_casino", "region_id").agg(F.avg("stay_time").alias("_mean"))
    res = res.join(means, on=["date", "date_casino", "region_id"], how="inner")
    return res.select(
        "profile_id", "date", "date_casino", "region_id",
        F.coalesce(F.col("stay_time"), F.col("_mean"), F.lit(0.0)).alias("stay_time"),
        "profile_type", "member_tier", "Age_range", "gender", "region_name",
        F.lit("").alias("region_type"))


# ---------------------------------------------------------------------------
# Q08 new or returning visitor
# ---------------------------------------------------------------------------
def _return_flags(stay: DataFrame) -> DataFrame:
    """Per (profile, region, business date): was the profile seen in the same
    region on a type '3' row within [d - 2 months, d), or a type '4' row within
    [d - 2 days, d)? One RANGE window over distinct visit days, no self-join."""
    visits = (stay.select("profile_id", "region_id", "date_casino",
                          (F.col("region_type") == "3").alias("_t3"),
                          (F.col("region_type") == "4").alias("_t4"))
              .groupBy("profile_id", "region_id", "date_casino")
              .agg(F.max("_t3").alias("_t3"), F.max("_t4").alias("_t4"))
              .withColumn("_dn", d.day_index("date_casino")))
    w = (Window.partitionBy("profile_id", "region_id").orderBy("_dn")
         .rangeBetween(Window.unboundedPreceding, -1))
    last3 = F.max(F.when(F.col("_t3"), F.col("date_casino"))).over(w)
    last4 = F.max(F.when(F.col("_t4"), F.col("date_casino"))).over(w)
    return visits.select(
        "profile_id", "region_id", "date_casino",
        F.when(last3 >= F.add_months("date_casino", -2), 1).otherwise(0).alias("is_return_zone"),
        F.when(last4 >= F.date_sub("date_casino", 2), 1).otherwise(0).alias("is_return_casino"))


def stay_with_flags(stay: DataFrame, days: Iterable | None = None) -> DataFrame:
    """Stay rows (of ``days``, default all) with both return flags.

    With ``days`` only the look-back the flags need is read: business dates
    from two months before the first day up to the last day (on a table
    partitioned by ``date_casino`` this prunes partitions)."""
    if days is not None:
        ds = sorted(str(x) for x in days)
        lo = F.add_months(F.lit(ds[0]).cast("date"), -2)
        stay = stay.where((F.col("date_casino") >= lo) & (F.col("date_casino") <= F.lit(ds[-1]).cast("date")))
    flags = _return_flags(stay)
    out = stay.join(flags, on=["profile_id", "region_id", "date_casino"], how="left")
    return _days(out, days)


def new_or_return(stay: DataFrame, days: Iterable | None = None) -> DataFrame:
    """Q08: each stay row + is_return_zone, is_return_casino, is_less15min_visitor."""
    s = stay_with_flags(stay, days)
    return s.select(
        "date", "date_casino", "profile_id", "region_id", "region_name", "region_type", "gender",
        "Age_range", "profile_type", "member_tier",
        F.coalesce("is_return_zone", F.lit(0)).alias("is_return_zone"),
        F.coalesce("is_return_casino", F.lit(0)).alias("is_return_casino"),
        F.when(F.col("stay_time") < SHORT, 1).otherwise(0).alias("is_less15min_visitor"))


# ---------------------------------------------------------------------------
# Q09 visitor index (hour grain)
# ---------------------------------------------------------------------------
INDEX_KEYS = ["date_hour", "date_casino_hour", "profile_id", "region_id", "region_name", "region_type",
              "gender", "Age_range", "profile_type", "member_tier", "sector"]


def visitor_index(detail: DataFrame, stay: DataFrame, nor: DataFrame | None = None) -> DataFrame:
    """Q09: hour-grain profile facts.

    Detail rows are reduced to distinct hour rows first, then joined once to a
    per-(date, business date, profile, region) table with the longest stay
    (from ``stay``) and both return flags (from ``nor``, the Q08 table). That
    table is one aggregate over the union of the two inputs (no join between
    them); several rows of one key collapse by ``max``, as the reference's
    fan-out + ``max`` does. Unmatched keys read as 0.
    """
    if nor is None:
        nor = new_or_return(stay)
    keys = ["date", "date_casino", "profile_id", "region_id"]
    null_d = F.lit(None).cast("double")
    null_i = F.lit(None).cast("int")
    both = (stay.select(*keys, F.col("stay_time").cast("double").alias("_stay"),
                        null_i.alias("_rz"), null_i.alias("_rc"))
            .unionByName(nor.select(*keys, null_d.alias("_stay"),
                                    F.col("is_return_zone").cast("int").alias("_rz"),
                                    F.col("is_return_casino").cast("int").alias("_rc"))))
    keyed = both.groupBy(*keys).agg(F.max("_stay").alias("_stay"), F.max("_rz").alias("is_return_zone"),
                                    F.max("_rc").alias("is_return_casino"))
    hours = (detail.select(d.hour_start("capture_time").alias("date_hour"),
                           d.business_hour_start("capture_time").alias("date_casino_hour"),
                           "profile_id", "region_id", "region_name", "region_type", "gender",
                           d.age_band("age").alias("Age_range"), "profile_type", "member_tier",
                           "sector", "date_casino")
             .distinct()
             .withColumn("date", F.to_date("date_hour")))
    j = hours.join(keyed, on=keys, how="left")
    st = F.coalesce(F.col("_stay"), F.lit(0.0))
    short = F.when(st < SHORT, 1).otherwise(0)
    return j.select(*INDEX_KEYS, st.alias("stay_time"),
                    short.alias("is_less_15min_region"), short.alias("is_less_15min_casino"),
                    F.coalesce("is_return_zone", F.lit(0)).alias("is_return_zone"),
                    F.coalesce("is_return_casino", F.lit(0)).alias("is_return_casino"),
                    "date_casino")


# ---------------------------------------------------------------------------
# Q10 - Q16 daily cubes
# ---------------------------------------------------------------------------
def by_profile_day(index: DataFrame) -> DataFrame:
    """Hash-partition the hour-grain index on (business day, profile).

    The index holds at most 24 x regions rows per (day, profile), so no
    partition key is hot; every later aggregate or join whose keys include
    both columns then runs without another shuffle."""
    return index.repartition("date_casino", "profile_id")


def _tab_profile(index: DataFrame, with_sector: bool = True) -> DataFrame:
    """Per (date, business date, profile, region, attributes, flags): the
    longest hourly stay ``stay_time_p`` and the three short-stay flags."""
    keys = ["date", "date_casino", "profile_id", "region_type", "region_id", "region_name", *DEMO,
            "is_return_zone", "is_return_casino"] + (["sector"] if with_sector else [])
    p = F.max("stay_time")
    return (by_profile_day(index).withColumn("date", F.to_date("date_hour"))
            .groupBy(*keys)
            .agg(p.alias("stay_time_p"))
            .withColumn("is_less_15min_region",
                        F.when((F.col("region_type") == "3") & (F.col("stay_time_p") < SHORT), 1).otherwise(0))
            .withColumn("is_less_15min_casino",
                        F.when((F.col("region_type") == "4") & (F.col("stay_time_p") < SHORT), 1).otherwise(0))
            .withColumn("is_less_15min_all", F.when(F.col("stay_time_p") < SHORT, 1).otherwise(0)))


def _by_flag_cube(tab: DataFrame, keys: list, ret: F.Column, short: F.Column, names: dict) -> DataFrame:
    """Distinct-profile measures under a return flag ``ret`` and a short-stay
    flag ``short``, as one aggregate per (keys, profile) and one per keys
    (no row expansion for the several conditional distinct counts)."""
    per = (tab.withColumn("_r", ret).withColumn("_s", short)
           .groupBy(*keys, "profile_id")
           .agg(F.sum("stay_time_p").alias("_stay"),
                F.max("_s").alias("_any_s"),
                F.max(F.when(F.col("_r") == 1, 1).otherwise(0)).alias("_r1"),
                F.max(F.when(F.col("_r") == 0, 1).otherwise(0)).alias("_r0"),
                F.max(F.when((F.col("_r") == 1) & (F.col("_s") == 1), 1).otherwise(0)).alias("_r1s"),
                F.max(F.when((F.col("_r") == 0) & (F.col("_s") == 1), 1).otherwise(0)).alias("_r0s"),
                F.sum(F.when(F.col("_r") == 1, F.col("stay_time_p"))).alias("_st1"),
                F.sum(F.when(F.col("_r") == 0, F.col("stay_time_p"))).alias("_st0")))
    # a missing profile is nobody: its time counts, but not as a visitor
    cnt = lambda c: F.sum(F.when(F.col("profile_id").isNull(), 0).otherwise(F.col(c))).cast("long")
    return per.groupBy(*keys).agg(
        F.count("profile_id").alias("visitor_num"),
        F.sum("_stay").alias("stay_time"),
        cnt("_any_s").alias(names["less"]),
        cnt("_r1").alias(names["ret"]),
        cnt("_r0").alias(names["new"]),
        F.sum("_st1").alias(names["ret_stay"]),
        F.sum("_st0").alias(names["new_stay"]),
        cnt("_r1s").alias(names["ret_less"]),
        cnt("_r0s").alias(names["new_less"]))


ZONE_NAMES = dict(less="less15min_region_visitor_num", ret="return_zone_visitor_num",
                  new="new_zone_visitor_num", ret_stay="return_zone_stay_time",
                  new_stay="new_zone_stay_time", ret_less="return_zone_less15min_num",
                  new_less="new_zone_less15min_num")
CASINO_NAMES = dict(less="less15min_casino_visitor_num", ret="return_casino_visitor_num",
                    new="new_casino_visitor_num", ret_stay="return_casino_stay_time",
                    new_stay="new_casino_stay_time", ret_less="return_casino_less15min_num",
                    new_less="new_casino_less15min_num")
DAILY_COLUMNS = ["date_casino", "region_type", "region_id", "region_name", *DEMO, "sector",
                 "visitor_num", "stay_time", *ZONE_NAMES.values()]
CASINO_COLUMNS = ["date_casino", "region_type", "region_id", "region_name", *DEMO,
                  "visitor_num", "stay_time", *CASINO_NAMES.values()]


def visits_daily_region(index: DataFrame) -> DataFrame:
    """Q10: per business day x region x demographics; zone flags for type '3',
    casino flags for type '4'; sector recoded to 'Gaming' for type '4'."""
    tab = _tab_profile(index).withColumn("sector", d.recoded_sector("region_type", "sector"))
    rt = F.col("region_type")
    ret = F.when(rt == "3", F.col("is_return_zone")).when(rt == "4", F.col("is_return_casino"))
    # region_type is a group key, so inside a '3' (or '4') group the typed
    # short-stay flag equals the type-free one the visitor count uses.
    keys = ["date_casino", "region_type", "region_id", "region_name", *DEMO, "sector"]
    out = _by_flag_cube(tab, keys, ret, F.col("is_less_15min_all"), ZONE_NAMES)
    typed = (rt == "3") | (rt == "4")
    for k in ["ret", "new", "ret_stay", "new_stay", "ret_less", "new_less"]:
        out = out.withColumn(ZONE_NAMES[k], F.when(typed, F.col(ZONE_NAMES[k])))
    return out.select(*DAILY_COLUMNS)


def _profile_level(tab: DataFrame, keys: list, ret_cols: list) -> DataFrame:
    """Rows per (keys, profile) with the profile's whole-day flags:
    ``_short`` = total stay of the business day < 15 min,
    ``_new`` = no return flag set on any of the profile's rows."""
    per = (tab.groupBy(*keys, "date_casino", "profile_id")
           .agg(F.sum("stay_time_p").alias("_stay"),
                *[F.sum(c).alias(f"_{c}") for c in ret_cols]))
    prof = (per.groupBy("date_casino", "profile_id")
            .agg(F.sum("_stay").alias("_tot"),
                 sum((F.sum(f"_{c}") for c in ret_cols), F.lit(0)).alias("_rsum")))
    # a missing profile is nobody: its rows meet no profile-day, only their time counts
    return (per.join(prof, on=["date_casino", "profile_id"], how="left")
            .withColumn("_short", F.coalesce(F.col("_tot") < SHORT, F.lit(False)))
            .withColumn("_new", F.coalesce(F.col("_rsum") == 0, F.lit(False))))


def _all_cube(tab: DataFrame, keys: list) -> DataFrame:
    per = _profile_level(tab, keys, ["is_return_zone", "is_return_casino"])
    ret = ~F.col("_new")
    someone = F.col("profile_id").isNotNull()
    ones = lambda c: F.sum(F.when(c & someone, 1).otherwise(0)).cast("long")
    out = per.groupBy("date_casino", *keys).agg(
        F.count("profile_id").alias("visitor_num"),
        F.sum("_stay").alias("stay_time"),
        ones(F.col("_short")).alias("less15min_region_visitor_num"),
        ones(ret).alias("return_zone_visitor_num"),
        ones(F.col("_new")).alias("new_zone_visitor_num"),
        F.sum(F.when(ret, F.col("_stay"))).alias("return_zone_stay_time"),
        F.sum(F.when(F.col("_new"), F.col("_stay"))).alias("new_zone_stay_time"),
        ones(ret & F.col("_short")).alias("return_zone_less15min_num"))
    return out.withColumn("new_zone_less15min_num",
                          F.col("less15min_region_visitor_num") - F.col("return_zone_less15min_num"))


def visits_daily_all(index: DataFrame) -> DataFrame:
    """Q11: region/sector 'all' per business day x demographics; short stay
    and new/return are decided on the profile's whole day."""
    out = _all_cube(_tab_profile(index), DEMO)
    return out.select("date_casino", F.lit("all").alias("region_type"), F.lit("all").alias("region_id"),
                      F.lit("all").alias("region_name"), *DEMO, F.lit("all").alias("sector"),
                      *[c for c in DAILY_COLUMNS if c not in
                        {"date_casino", "region_type", "region_id", "region_name", "sector", *DEMO}])


def visits_daily_sector(index: DataFrame) -> DataFrame:
    """Q12: Q11 measures by region_type and recoded sector (region 'all')."""
    tab = _tab_profile(index).withColumn("sector", d.recoded_sector("region_type", "sector"))
    out = _all_cube(tab, [*DEMO, "region_type", "sector"])
    return out.select("date_casino", "region_type", F.lit("all").alias("region_id"),
                      F.lit("all").alias("region_name"), *DEMO, "sector",
                      *[c for c in DAILY_COLUMNS if c not in
                        {"date_casino", "region_type", "region_id", "region_name", "sector", *DEMO}])


def visits_daily(index: DataFrame) -> DataFrame:
    """Q10 + Q11 + Q12 as one table (the reference's three inserts)."""
    return (visits_daily_region(index).unionByName(visits_daily_all(index))
            .unionByName(visits_daily_sector(index)))


def visits_daily_casino_region(index: DataFrame) -> DataFrame:
    """Q13: Q10 measures on type '4' rows with casino flags, no sector."""
    tab = _tab_profile(index, with_sector=False).where(F.col("region_type") == "4")
    keys = ["date_casino", "region_type", "region_id", "region_name", *DEMO]
    out = _by_flag_cube(tab, keys, F.col("is_return_casino"), F.col("is_less_15min_casino"), CASINO_NAMES)
    return out.select(*CASINO_COLUMNS)


def visits_daily_casino_all(index: DataFrame) -> DataFrame:
    """Q14: type '4', region 'all'. New/return visitors by the profile-level
    test (no casino return flag on any row), short stay by the profile's total
    casino stay, but stay time and short-stay splits by the row flag."""
    tab = _tab_profile(index, with_sector=False).where(F.col("region_type") == "4")
    keys = ["region_type", *DEMO]
    per = (tab.groupBy(*keys, "date_casino", "profile_id")
           .agg(F.sum("stay_time_p").alias("_stay"),
                F.sum(F.when(F.col("is_return_casino") == 1, F.col("stay_time_p"))).alias("_st1"),
                F.sum(F.when(F.col("is_return_casino") == 0, F.col("stay_time_p"))).alias("_st0"),
                F.max(F.when(F.col("is_return_casino") == 1, 1).otherwise(0)).alias("_r1"),
                F.max(F.when(F.col("is_return_casino") == 0, 1).otherwise(0)).alias("_r0"),
                F.sum("is_return_casino").alias("_rs")))
    prof = (per.groupBy("date_casino", "profile_id")
            .agg(F.sum("_stay").alias("_tot"), F.sum("_rs").alias("_rsum")))
    per = (per.join(prof, on=["date_casino", "profile_id"], how="inner")
           .withColumn("_short", F.col("_tot") < SHORT).withColumn("_new", F.col("_rsum") == 0))
    ones = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    out = per.groupBy("date_casino", *keys).agg(
        F.count(F.lit(1)).alias("visitor_num"),
        F.sum("_stay").alias("stay_time"),
        ones(F.col("_short")).alias("less15min_casino_visitor_num"),
        ones(~F.col("_new")).alias("return_casino_visitor_num"),
        ones(F.col("_new")).alias("new_casino_visitor_num"),
        F.sum("_st1").alias("return_casino_stay_time"),
        F.sum("_st0").alias("new_casino_stay_time"),
        ones(F.col("_short") & (F.col("_r1") == 1)).alias("return_casino_less15min_num"),
        ones(F.col("_short") & (F.col("_r0") == 1)).alias("new_casino_less15min_num"))
    return out.select("date_casino", "region_type", F.lit("all").alias("region_id"),
                      F.lit("all").alias("region_name"), *DEMO, *CASINO_COLUMNS[8:])


def visits_daily_casino(index: DataFrame) -> DataFrame:
    """Q13 + Q14 as one table."""
    return visits_daily_casino_region(index).unionByName(visits_daily_casino_all(index))


def daily_sector_rollup(daily_region: DataFrame) -> DataFrame:
    """Q15: sum of region-level daily visitor counts by region and sector."""
    return (daily_region.where(F.col("region_id") != "all")
            .groupBy("date_casino", "region_id", "region_name", "sector")
            .agg(F.sum("visitor_num").cast("long").alias("visitor_num")))


def daily_sector_distinct(index: DataFrame) -> DataFrame:
    """Q16: distinct profiles per business day and recoded sector (region 'all')."""
    return (index.select("date_casino", d.recoded_sector("region_type", "sector").alias("sector"),
                         "profile_id")
            .groupBy("date_casino", "sector")
            .agg(F.countDistinct("profile_id").alias("visitor_num"))
            .select("date_casino", F.lit("all").alias("region_id"), F.lit("all").alias("region_name"),
                    "sector", "visitor_num"))


def daily_sector(index: DataFrame) -> DataFrame:
    """Q15 + Q16 as one table."""
    return daily_sector_rollup(visits_daily_region(index)).unionByName(daily_sector_distinct(index))


# ---------------------------------------------------------------------------
# Q17 - Q19 hourly cubes
# ---------------------------------------------------------------------------
HOURLY_COLUMNS = ["date_casino", "date_hour", "region_type", "region_id", "region_name", *DEMO,
                  "sector", "visitor_num"]


def _hour_people(index: DataFrame, levels: list, demo: bool = True) -> DataFrame:
    """Visitors per hour at several levels in one pass over the index.

    Each row of the index turns into one row per level (``levels``: region_id,
    region_name, sector); the different (level, profile) rows are found inside
    the profile's partition, and counted by one shuffle on the levels' keys. A
    missing profile is nobody."""
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), *[c.alias(n) for c, n in zip(
        cs, ["region_id", "region_name", "sector"], strict=True)]) for i, cs in enumerate(levels)])).alias("_c")
    keys = ["date_casino", "date_hour", "region_type", "region_id", "region_name", *DEMO, "sector"]
    rows = (by_profile_day(index)
            .withColumn("sector", d.recoded_sector("region_type", "sector"))
            .select("date_casino", "date_hour", "region_type", *DEMO, "profile_id", cells)
            .select("date_casino", "date_hour", "region_type", *DEMO, "profile_id", "_c.*"))
    if demo:
        return rows.distinct().groupBy(*keys).agg(F.count("profile_id").alias("visitor_num"))
    # the region level counts a profile once per type and demographics, the level of all once
    whole = F.col("level") == 0
    once = [F.when(whole, F.col(c)).alias(c) for c in ["region_type", *DEMO]]
    return (rows.select("date_casino", "date_hour", "region_id", "region_name", "sector", "level", "profile_id", *once)
            .distinct().groupBy("date_casino", "date_hour", "region_id", "region_name", "sector")
            .agg(F.count("profile_id").alias("visitor_num")))


def visits_hourly(index: DataFrame) -> DataFrame:
    """Q17: distinct visitors per hour x demographics at three levels: region;
    region_type with region and sector 'all'; region_type + recoded sector."""
    all_, sector = F.lit("all"), F.col("sector")
    out = _hour_people(index, [(F.col("region_id"), F.col("region_name"), sector), (all_, all_, all_), (all_, all_, sector)])
    return out.select(*HOURLY_COLUMNS)


def visits_hourly_casino(index: DataFrame) -> DataFrame:
    """Q18: type '4' only, levels region and 'all' (no sector column)."""
    all_, none = F.lit("all"), F.lit("")
    out = _hour_people(index.where(F.col("region_type") == "4"),
                       [(F.col("region_id"), F.col("region_name"), none), (all_, all_, none)])
    return out.select(*[c for c in HOURLY_COLUMNS if c != "sector"])


def visits_hourly_sector(index: DataFrame) -> DataFrame:
    """Q19: visitors of Q17's regions summed over the demographics, by sector,
    and distinct profiles per recoded sector with region 'all'."""
    all_, sector = F.lit("all"), F.col("sector")
    return _hour_people(index, [(F.col("region_id"), F.col("region_name"), sector), (all_, all_, sector)], demo=False)


# ---------------------------------------------------------------------------
# Q02 / Q03 / Q04 / Q20 companion groups
# ---------------------------------------------------------------------------
def companion_groups(captures_raw: DataFrame, days: Iterable | None = None,
                     region_prefix: str = d.CASINO_PREFIX) -> DataFrame:
    """Q02: people entering together on gaming-floor regions.

    Keep each profile's latest capture per calendar hour, then over the
    distinct seconds of each calendar date a gap of more than 2 s opens a new
    group; ``group_id`` is the running gap count (first group 0), shared by
    all cameras.
    """
    df = (captures_raw.where(F.col("region_name").startswith(region_prefix))
          .select("profile_id", "camera_id", "region_id", "region_name", "capture_time", "capture_id",
                  F.to_date("capture_time").alias("date"), d.hour_start("capture_time").alias("date_hour")))
    df = _days(df, days, "date")
    latest = latest_per(df, ["date_hour", "profile_id"], [F.col("capture_time"), F.col("capture_id")])
    grouped = gap_group_ids(latest, ["date"], gap_seconds=d.GROUP_GAP_SECONDS, first_starts_group=False)
    return grouped.select("date_hour", d.business_hour_start("capture_time").alias("date_casino_hour"),
                          "profile_id", "region_id", "region_name", "group_id", "capture_time")


def companion_groups_by_camera(captures_raw: DataFrame, days: Iterable | None = None,
                               region_prefix: str = "Entrances") -> DataFrame:
    """Q03: companion groups per camera: per (calendar date, camera) a gap of
    more than 2 s opens a group (ids start at 1), then each profile's latest
    capture per calendar hour is kept (ties: lowest camera, then highest
    capture id). ``camera_id`` is kept because ids repeat across cameras."""
    df = (captures_raw.where(F.col("region_name").startswith(region_prefix))
          .select("profile_id", "camera_id", "region_id", "region_name", "capture_time", "capture_id",
                  F.to_date("capture_time").alias("date"), d.hour_start("capture_time").alias("date_hour")))
    df = _days(df, days, "date")
    grouped = gap_group_ids(df, ["date", "camera_id"], gap_seconds=d.GROUP_GAP_SECONDS, first_starts_group=True)
    latest = latest_per(grouped, ["date_hour", "profile_id"],
                        [F.col("capture_time"), -F.col("camera_id"), F.col("capture_id")])
    return latest.select("profile_id", "date_hour",
                         (F.col("date_hour") - F.expr("INTERVAL 6 HOURS")).alias("date_casino_hour"),
                         "region_id", "region_name", "camera_id", "group_id", "capture_time")


def companion_group_binned(groups_by_camera: DataFrame) -> DataFrame:
    """Q04: group size (distinct profiles) per (hour, business hour, camera,
    group) with the size label 1..5 / 5+."""
    return (groups_by_camera.groupBy("date_hour", "date_casino_hour", "camera_id", "group_id")
            .agg(F.countDistinct("profile_id").alias("group_size"))
            .withColumn("group_type", d.group_type("group_size")))


def companion_group_sizes(groups: DataFrame) -> DataFrame:
    """Q20: group size per (date, business date, group, region); sum of sizes
    per size label and region, plus region 'all' (sizes still per region)."""
    sizes = (groups.select(F.to_date("date_hour").alias("date"), F.to_date("date_casino_hour").alias("date_casino"),
                           "group_id", "region_id", "region_name", "profile_id")
             .groupBy("date", "date_casino", "group_id", "region_id", "region_name")
             .agg(F.countDistinct("profile_id").alias("group_size"))
             .withColumn("group_type", d.group_type("group_size")))
    l1 = (sizes.groupBy("date", "date_casino", "region_id", "region_name", "group_type")
          .agg(F.sum("group_size").cast("long").alias("group_visitor_num")))
    l2 = (sizes.groupBy("date", "date_casino", "group_type")
          .agg(F.sum("group_size").cast("long").alias("group_visitor_num"))
          .select("date", "date_casino", F.lit("all").alias("region_id"), F.lit("all").alias("region_name"),
                  "group_type", "group_visitor_num"))
    return l1.unionByName(l2)
