"""Event warehouse jobs: calendar, captures around events, pre/post visits,
conversion to the casino entrance, joined summary, run dates and reports.

The reference runs one event title (or one date) per call; these jobs handle
every event of the calendar in one plan, keyed by ``event_name``. The event
calendar and the camera table are dimensions joined on keys that are hot on
the capture side (a date, a camera). All joins are plain equi-joins: Spark
broadcasts a side by its size in bytes and splits skewed partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewise.functions import derive as d
from gatewise.operators.common import next_capture_time

DEMO = ["Age_range", "gender", "profile_type", "member_tier"]
ARENA = "Arena"
CASINO_ENTRANCE = "Casino Entrance"


def _hours(ts: F.Column, h: int) -> F.Column:
    return F.timestamp_add("HOUR", F.lit(h), ts)


def first_per(df: DataFrame, keys: list, order: list) -> DataFrame:
    """Keep the row with the least ``order`` per key (``LIMIT 1 BY``), as a
    ``min_by`` aggregate that combines map-side."""
    payload = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*payload), F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload])


# ---------------------------------------------------------------------------
# Q26 camera alias map
# ---------------------------------------------------------------------------
def camera_alias_map(camera: DataFrame, zone_cameras: DataFrame, zones: DataFrame) -> DataFrame:
    """Q26: (property, alias, camera_name) of every camera mapped to a zone;
    camera ids are compared as text on both sides."""
    alias = (zone_cameras.join(zones, on="zone_id", how="inner")
             .select("property", "alias", F.col("camera_id").cast("string").alias("camera_id")))
    cams = camera.select(F.col("camera_id").cast("string").alias("camera_id"), "camera_name")
    return cams.join(alias, on="camera_id", how="inner").select("property", "alias", "camera_name")


# ---------------------------------------------------------------------------
# Q27 event calendar
# ---------------------------------------------------------------------------
CALENDAR_COLUMNS = ["CDate", "Title", "Venue", "EventType", "Genre", "StartDtm", "EndDtm", "StartDtm_",
                    "EndDtm_", "Period_Flag", "InsertDtm"]


def event_calendar(event_list: DataFrame) -> DataFrame:
    """Q27: one row per event day; day k starts at StartDtm + k days (the
    start's time of day) and ends at EndDtm on the last day, else one second
    before StartDtm + (k + 1) days. Title gets '_' + date; the start hour
    gives the band EM/AM/PM/EV; one event is kept per (date, band): earliest
    start, then title, then end."""
    n = F.datediff(F.to_date("EndDtm"), F.to_date("StartDtm"))
    days = F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    ex = event_list.withColumn("_n", n).withColumn("num", F.explode(days))
    start_ = F.when(F.col("num") == 0, F.col("StartDtm")) \
        .otherwise(F.timestamp_add("DAY", F.col("num"), F.col("StartDtm")))
    end_ = F.when(F.col("num") == F.col("_n"), F.col("EndDtm")) \
        .otherwise(F.timestamp_add("SECOND", F.lit(-1),
                                   F.timestamp_add("DAY", F.col("num") + 1, F.col("StartDtm"))))
    ex = (ex.withColumn("StartDtm_", start_).withColumn("EndDtm_", end_)
          .withColumn("CDate", F.to_date("StartDtm_"))
          .withColumn("Title", F.concat(F.col("Title"), F.lit("_"), F.col("CDate").cast("string")))
          .withColumn("Period_Flag", d.period_flag("StartDtm_"))
          .select(*CALENDAR_COLUMNS))
    return first_per(ex, ["CDate", "Period_Flag"], [F.col("StartDtm_"), F.col("Title"), F.col("EndDtm_")]) \
        .select(*CALENDAR_COLUMNS)


# ---------------------------------------------------------------------------
# Q28 event capture detail
# ---------------------------------------------------------------------------
EVENT_DETAIL_COLUMNS = ["profile_id", "age", "Age_range", "gender", "profile_type", "member_tier", "capture_time",
                        "next_capture_time", "group", "business_sector", "camera_id", "event_name", "CDate",
                        "StartDtm_event", "EndDtm_event", "time_window"]


def event_capture_detail(captures: DataFrame, camera_dim: DataFrame, calendar: DataFrame) -> DataFrame:
    """Q28: captures + next capture (same calendar date and profile) + camera
    group/sector; every event of the capture's date is joined (several events
    on a date give several rows). Inside [start - 4 h, end + 4 h] at an Arena
    camera the event fields and ``time_window`` are set: -1/-2/-4 for up to
    60/120/240 boundary minutes before the start, 0 during, 1/2/4 after the
    end (first matching rule wins)."""
    t1 = (captures.select("profile_id", "age", d.age_band("age").alias("Age_range"), "gender", "profile_type",
                          "member_tier", "capture_time", "capture_id", "camera_id",
                          F.to_date("capture_time").alias("_cal")))
    t1 = next_capture_time(t1, ["_cal", "profile_id"])
    t1 = t1.withColumn("camera_id", F.col("camera_id").cast("string"))
    cam = camera_dim.select(F.col("camera_id").cast("string").alias("camera_id"), "group", "business_sector")
    j = t1.join(cam, on="camera_id", how="inner")
    cal = calendar.select(F.col("CDate").alias("_cal"), "Title", "CDate", "StartDtm_", "EndDtm_")
    j = j.join(cal, on="_cal", how="left")
    inside = (F.col("capture_time").between(_hours(F.col("StartDtm_"), -4), _hours(F.col("EndDtm_"), 4))
              & (F.col("business_sector") == ARENA))
    ev = F.when(inside, F.col("Title"))
    ds = d.minute_index("capture_time") - d.minute_index("StartDtm_")
    de = d.minute_index("capture_time") - d.minute_index("EndDtm_")
    on = ev.isNotNull()
    tw = (F.when(on & (ds < 0) & (ds > -60), -1)
          .when(on & (ds <= -60) & (ds > -120), -2)
          .when(on & (ds <= -120) & (ds >= -240), -4)
          .when(on & ((ds == 0) | (de == 0) | F.col("capture_time").between(F.col("StartDtm_"), F.col("EndDtm_"))), 0)
          .when(on & (de > 0) & (de < 60), 1)
          .when(on & (de >= 60) & (de < 120), 2)
          .when(on & (de >= 120) & (de <= 240), 4))
    return j.select("profile_id", "age", "Age_range", "gender", "profile_type", "member_tier", "capture_time",
                    "next_capture_time", "group", "business_sector", "camera_id",
                    ev.alias("event_name"), F.when(inside, F.col("CDate")).alias("CDate"),
                    F.when(inside, F.col("StartDtm_")).alias("StartDtm_event"),
                    F.when(inside, F.col("EndDtm_")).alias("EndDtm_event"),
                    tw.cast("int").alias("time_window"))


# ---------------------------------------------------------------------------
# Q29 / Q30 pre and post visits
# ---------------------------------------------------------------------------
PRE_POST_COLUMNS = ["date", "event_name", *DEMO, "group", "hour_window", "pre_visition_num", "pre_stay_time",
                    "post_visition_num", "post_stay_time"]


def _least_window() -> F.Column:
    """The shortest hour window h whose ``time_window`` -h..h holds a row; longer ones hold it too."""
    tw = F.abs("time_window")
    return F.least(*[F.when(tw <= h, h) for h in d.HOUR_WINDOWS])


def _attendees(detail: DataFrame) -> DataFrame:
    """(event_name, profile_id, _least): the least of the hour windows 1, 2, 4
    within which the profile was captured around the event."""
    return (detail.where(F.col("event_name").isNotNull()).withColumn("_least", _least_window())
            .where(F.col("_least").isNotNull())
            .groupBy("event_name", "profile_id").agg(F.min("_least").alias("_least")))


def _event_days(calendar: DataFrame, first: F.Column, last: F.Column, count_from: F.Column | None = None) -> DataFrame:
    """Calendar rows exploded to dates ``first + i`` for i in 0..(last - count_from)."""
    count_from = first if count_from is None else count_from
    n = F.datediff(last, count_from)
    return (calendar.withColumn("_first", first)
            .withColumn("_i", F.explode(F.when(n >= 0, F.sequence(F.lit(0), n))
                                        .otherwise(F.array().cast("array<int>"))))
            .withColumn("join_date", F.date_add("_first", F.col("_i")))
            .drop("_first", "_i"))


def _stay_rows(detail: DataFrame) -> DataFrame:
    """Stay seconds per profile, demographics, group and capture time: rows
    that agree in these fall into the same windows, so they are added up before
    they are joined."""
    nxt = F.coalesce(F.col("next_capture_time"), F.col("capture_time"))
    stay = (d.epoch_seconds(nxt) - d.epoch_seconds("capture_time")).cast("double")
    return (detail.groupBy("profile_id", *DEMO, "group", "capture_time").agg(F.sum(stay).alias("_stay"))
            .withColumn("join_date", F.to_date("capture_time")))


def _before(h: int) -> F.Column:
    return _hours(F.col("StartDtm_"), -h)


def _after(h: int) -> F.Column:
    return _hours(F.col("EndDtm_"), h)


def _by_window(rows: DataFrame, keys: list[str], flags: dict, sums: dict, most: dict | None = None) -> DataFrame:
    """``_per_group_and_all`` of ``keys`` and the hour window, where the columns
    of ``flags``, ``sums`` and ``most`` are functions of the window.

    A row is joined once, not once per window: the windows are columns until
    the rows are reduced to totals."""
    most = most or {}
    reduced = rows.groupBy(*keys, "group", "profile_id", "_least").agg(*[
        x.alias(f"{c}_{h}") for h in d.HOUR_WINDOWS for x, c in [
            *[(F.max(f(h)), c) for c, f in flags.items()], *[(F.sum(f(h)), c) for c, f in sums.items()],
            *[(F.max(f(h)), c) for c, f in most.items()]]])
    per = [[f"{c}_{h}" for c in part for h in d.HOUR_WINDOWS] for part in (flags, sums, most)]
    windows = [F.struct(F.lit(h).alias("hour_window"), *[F.col(f"{c}_{h}").alias(c) for c in [*flags, *sums, *most]])
               for h in d.HOUR_WINDOWS]
    # a profile has one least window per event, so the totals of the least windows add up
    return (_totals(reduced, [*keys, "_least"], *per)
            .select(*keys, "group", F.explode(F.filter(F.array(*windows), lambda x: x["hour_window"] >= F.col("_least"))).alias("_w"))
            .groupBy(*keys, "group", "_w.hour_window")
            .agg(*[F.sum(f"_w.{c}").alias(c) for c in [*flags, *sums]], *[F.max(f"_w.{c}").alias(c) for c in most]))


def _per_group_and_all(rows: DataFrame, keys: list[str], flags: dict[str, F.Column]) -> DataFrame:
    """Per ``keys`` and camera group, and per ``keys`` over all groups (group
    'all'): the profiles with at least one row of each of ``flags``.

    The joined rows are read once and reduced to (keys, group, profile)."""
    reduced = rows.groupBy(*keys, "group", "profile_id").agg(*[F.max(x).alias(c) for c, x in flags.items()])
    return _totals(reduced, keys, list(flags), [], [])


def _totals(reduced: DataFrame, keys: list[str], flags: list[str], sums: list[str], most: list[str]) -> DataFrame:
    """Totals per group and of group 'all' from one row per (keys, group,
    profile); only these few rows are doubled for the total, where a profile
    counts once however many groups it was seen in."""
    once = (reduced.withColumn("group", F.explode(F.array(F.col("group"), F.lit("all"))))
            .groupBy(*keys, "group", "profile_id")
            .agg(*[F.max(c).alias(c) for c in [*flags, *most]], *[F.sum(c).alias(c) for c in sums]))
    return once.groupBy(*keys, "group").agg(
        *[F.sum(F.when(F.col(c), 1).otherwise(0)).cast("long").alias(c) for c in flags],
        *[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in most])


def event_pre_post(detail: DataFrame, calendar: DataFrame) -> DataFrame:
    """Q29: for attendees of each event (per hour window h), distinct visitors
    and stay seconds in [start - h, start] and in [end, end + h], per
    demographics and camera group (plus group 'all'). Rows of the capture
    detail are taken as they are (a capture repeated for several events of
    its date counts once per repetition, as in the reference). No match
    gives 0."""
    cal = calendar.select(F.col("Title").alias("event_name"), F.col("CDate").alias("date"), "StartDtm_", "EndDtm_")
    days = _event_days(cal, F.to_date(_hours(F.col("StartDtm_"), -4)), F.to_date(_hours(F.col("EndDtm_"), 4)))
    # the calendar is a dimension; one event may hold most attendees
    win = _attendees(detail).join(days, on="event_name", how="inner")
    rows = win.join(_stay_rows(detail), on=["profile_id", "join_date"], how="inner")
    t = F.col("capture_time")
    pre = lambda h: t.between(_before(h), F.col("StartDtm_"))
    post = lambda h: t.between(F.col("EndDtm_"), _after(h))
    out = _by_window(rows, ["date", "event_name", *DEMO], {"pre_visition_num": pre, "post_visition_num": post},
                     {"pre_stay_time": lambda h: F.when(pre(h), F.col("_stay")).otherwise(0.0),
                      "post_stay_time": lambda h: F.when(post(h), F.col("_stay")).otherwise(0.0)})
    return out.select(*PRE_POST_COLUMNS)


def event_pre_post_v2(detail: DataFrame, calendar: DataFrame) -> DataFrame:
    """Q30: six-branch variant. Counts captures at or before start - h and at
    or after end + h; when start - h falls on an earlier date (end + h on a
    later date) than the event date, every joined capture counts. Dates run
    from the day before the start, as many as [start - 4 h, end + 4 h] spans."""
    cal = calendar.select(F.col("Title").alias("event_name"), F.col("CDate").alias("date"), "StartDtm_", "EndDtm_")
    days = _event_days(cal, F.to_date(F.date_sub(F.to_date("StartDtm_"), 1)),
                       F.to_date(_hours(F.col("EndDtm_"), 4)),
                       count_from=F.to_date(_hours(F.col("StartDtm_"), -4)))
    # the calendar is a dimension; one event may hold most attendees
    win = _attendees(detail).join(days, on="event_name", how="inner")
    rows = win.join(_stay_rows(detail), on=["profile_id", "join_date"], how="inner")
    t = F.col("capture_time")
    pre = lambda h: t <= _before(h)
    post = lambda h: t >= _after(h)
    g = _by_window(rows, ["date", "event_name", *DEMO], {"_n": lambda h: F.lit(True), "_npre": pre, "_npost": post},
                   {"_pre_st": lambda h: F.when(pre(h), F.col("_stay")).otherwise(0.0),
                    "_post_st": lambda h: F.when(post(h), F.col("_stay")).otherwise(0.0),
                    "_all_st": lambda h: F.col("_stay")},
                   {"_pre_d": lambda h: F.to_date(_before(h)), "_post_d": lambda h: F.to_date(_after(h))})
    pre_all = F.col("_pre_d") < F.col("date")
    post_all = F.col("_post_d") > F.col("date")
    return g.select(
        "date", "event_name", *DEMO, "group", "hour_window",
        F.when(pre_all, F.col("_n")).otherwise(F.col("_npre")).cast("long").alias("pre_visition_num"),
        F.when(pre_all, F.col("_all_st")).otherwise(F.col("_pre_st")).alias("pre_stay_time"),
        F.when(post_all, F.col("_n")).otherwise(F.col("_npost")).cast("long").alias("post_visition_num"),
        F.when(post_all, F.col("_all_st")).otherwise(F.col("_post_st")).alias("post_stay_time"))


# ---------------------------------------------------------------------------
# Q31 conversion, Q32 summary
# ---------------------------------------------------------------------------
CONVERSION_COLUMNS = ["date", "hour_window", "event_name", "Age_range", "member_tier", "profile_type", "gender",
                      "group", "visition_num", "casino_converted_visition_num"]


def event_conversion(detail: DataFrame, calendar: DataFrame) -> DataFrame:
    """Q31: attendees (profile, date, hour window, demographics, camera group)
    and whether each was seen at a 'Casino Entrance' camera on the same date
    (dates from the day before the start to the day after the end); distinct
    visitors and converted visitors by group and 'all'."""
    cal = calendar.select(F.col("Title").alias("event_name"), "StartDtm_", "EndDtm_")
    days = (_event_days(cal, F.date_sub(F.to_date("StartDtm_"), 1), F.date_add(F.to_date("EndDtm_"), 1))
            .select("event_name", F.col("join_date").alias("date")))
    seen = ["profile_id", F.to_date("capture_time").alias("date"), "event_name", *DEMO, "group"]
    att = (detail.where(F.col("event_name").isNotNull()).select(*seen, _least_window().alias("_least"))
           .where(F.col("_least").isNotNull())
           .groupBy("profile_id", "date", "event_name", *DEMO, "group").agg(F.min("_least").alias("_least")))
    # only events of the given calendar (the detail carries every event of a date)
    att = att.join(cal.select("event_name").distinct(), on="event_name", how="inner")
    casino = (detail.where(F.col("business_sector") == CASINO_ENTRANCE)
              .select("profile_id", F.to_date("capture_time").alias("date")).distinct()
              .withColumn("_seen", F.lit(1)))
    # an attendee date outside the event's dates cannot convert
    in_days = days.withColumn("_in", F.lit(1))
    f = (att.join(in_days, on=["event_name", "date"], how="left")
         .join(casino, on=["profile_id", "date"], how="left"))
    converted = F.col("_in").isNotNull() & F.col("_seen").isNotNull()
    within = {h: F.col("_least") <= h for h in d.HOUR_WINDOWS}
    totals = _per_group_and_all(f, ["date", "event_name", *DEMO], {
        **{f"_n_{h}": x for h, x in within.items()}, **{f"_converted_{h}": x & converted for h, x in within.items()}})
    windows = F.array(*[F.struct(F.lit(h).alias("hour_window"), F.col(f"_n_{h}").alias("visition_num"),
                                 F.col(f"_converted_{h}").alias("casino_converted_visition_num")) for h in within])
    out = totals.select("date", "event_name", *DEMO, "group",
                        F.explode(F.filter(windows, lambda x: x["visition_num"] > 0)).alias("_w")).select("*", "_w.*")
    return out.select(*CONVERSION_COLUMNS)


SUMMARY_COLUMNS = [*CONVERSION_COLUMNS, "post_stay_time", "post_visition_num", "pre_stay_time", "pre_visition_num"]


def event_summary(conversion: DataFrame, pre_post: DataFrame) -> DataFrame:
    """Q32: conversion joined with pre/post measures on eight keys; the tier
    matches when both are NULL or '' (``coalesce(tier, '')``)."""
    keys = ["date", "hour_window", "event_name", "Age_range", "group", "profile_type", "gender"]
    t2 = pre_post.select(*keys, F.coalesce("member_tier", F.lit("")).alias("_tier"),
                         "post_stay_time", "post_visition_num", "pre_stay_time", "pre_visition_num")
    t1 = conversion.withColumn("_tier", F.coalesce("member_tier", F.lit("")))
    return t1.join(t2, on=[*keys, "_tier"], how="inner").select(*SUMMARY_COLUMNS)


# ---------------------------------------------------------------------------
# Q33 run dates, Q34 hourly visitors, Q35 reports
# ---------------------------------------------------------------------------
def event_run_dates(calendar: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """Q33: dates to process: each event date and the days before and after,
    up to today, distinct. With ``titles`` (a one-column DataFrame of event
    names) only those events count; it is applied as a semi-join."""
    cal = calendar
    if titles is not None:
        cal = cal.join(titles.select(F.col(titles.columns[0]).alias("Title")), on="Title", how="left_semi")
    return (cal.select(F.explode(F.array(F.date_sub("CDate", 1), F.col("CDate"), F.date_add("CDate", 1)))
                       .alias("CDate"))
            .where(F.col("CDate") <= F.current_date())
            .distinct())


def latest_events(calendar: DataFrame, n: int = 7) -> DataFrame:
    """Q33: the ``n`` most recent event titles up to today (ties by title);
    the limit is the feature of this report."""
    return (calendar.where(F.col("CDate") <= F.current_date())
            .select(F.col("Title").alias("event_name"), "CDate").distinct()
            .orderBy(F.col("CDate").desc(), F.col("event_name").desc())
            .limit(n).select("event_name"))


def hourly_visitors(detail: DataFrame) -> DataFrame:
    """Q34: distinct persons per calendar hour and region; the 'casino' hour
    labels are the capture time plus 6 hours, as in the handler demo."""
    plus6 = F.col("capture_time") + F.expr("INTERVAL 6 HOURS")
    return (detail.select(F.date_format("capture_time", "yyyy-MM-dd HH:00:00").alias("date"),
                          F.date_format("capture_time", "HH:00").alias("date_hour"),
                          F.date_format(plus6, "yyyy-MM-dd HH:00:00").alias("date_casino"),
                          F.date_format(plus6, "HH:00").alias("date_casino_hour"),
                          "region_id", "region_name", "region_type", "person_id")
            .groupBy("date", "region_id", "region_name", "region_type", "date_hour", "date_casino",
                     "date_casino_hour")
            .agg(F.countDistinct("person_id").alias("visitors_num")))


def conversion_table(summary: DataFrame) -> DataFrame:
    """The conversion table shape built from the event summary (Q32)."""
    return summary.select(
        F.col("date").alias("event_date"), F.md5("event_name").alias("event_id"), "event_name", "group",
        F.col("hour_window").cast("byte").alias("time_window_hours"), F.col("gender").cast("byte").alias("gender"),
        "Age_range", F.col("profile_type").cast("long").alias("profile_type"), "member_tier",
        F.col("visition_num").cast("int").alias("visit_count"),
        F.col("casino_converted_visition_num").cast("int").alias("casino_converted_people"),
        F.col("pre_stay_time").cast("double").alias("pre_event_casino_staytime"),
        F.col("post_stay_time").cast("double").alias("post_event_casino_staytime"),
        F.col("pre_visition_num").cast("int").alias("pre_visit_count"),
        F.col("post_visition_num").cast("int").alias("post_visit_count"))


def _stat_rows(df: DataFrame, counted: dict[str, str], aggregates: dict[str, F.Column], missing: str | None,
               top: tuple[str, int] | None = None) -> DataFrame:
    """(stat, key, value) rows from one pass over ``df`` with grouping sets:
    a row count per value of each column of ``counted`` (column -> stat), and
    the ``aggregates`` of the whole table. ``missing`` stands for NULL keys;
    with ``top`` (column, n) only that column's n commonest values are kept,
    ties by value."""
    cols = list(counted)
    everything = (1 << len(cols)) - 1
    bits = {c: everything - (1 << (len(cols) - 1 - i)) for i, c in enumerate(cols)}
    grouped = df.groupingSets([*[[F.col(c)] for c in cols], []], *[F.col(c) for c in cols]).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).cast("double").alias("_n"),
        *[x.cast("double").alias(f"_{stat}") for stat, x in aggregates.items()])
    out = F.array(*[F.struct(F.lit(stat).alias("stat"), F.lit("").alias("key"), F.col(f"_{stat}").alias("value"))
                    for stat in aggregates])
    for c, stat in counted.items():
        key = F.col(c).cast("string")
        if missing is not None:
            key = F.coalesce(key, F.lit(missing))
        out = F.when(F.col("_set") == bits[c], F.array(F.struct(
            F.lit(stat).alias("stat"), key.alias("key"), F.col("_n").alias("value")))).otherwise(out)
    if top is not None:
        # a distributed top-k: every task keeps its own first rows
        one = F.col("_set") == bits[top[0]]
        grouped = grouped.where(~one).unionByName(
            grouped.where(one).orderBy(F.col("_n").desc(), F.col(top[0])).limit(top[1]))
    return grouped.select(F.explode(out).alias("s")).select("s.*")


def conversion_stats(conversion: DataFrame, top: int = 5) -> DataFrame:
    """Q35: the conversion table report as (stat, key, value) rows: row count,
    rows of the ``top`` events (ties by name), rows per time window, gender
    and profile type, and four averages."""
    counted = {"event_name": "top_event_rows", "time_window_hours": "rows_by_time_window", "gender": "rows_by_gender",
               "profile_type": "rows_by_profile_type"}
    averages = {f"avg_{c}": F.avg(c) for c in ("visit_count", "casino_converted_people", "pre_event_casino_staytime",
                                               "post_event_casino_staytime")}
    return _stat_rows(conversion, counted, {"rows": F.count(F.lit(1)), **averages}, None, ("event_name", top))


def conversion_preview(conversion: DataFrame, n: int = 3) -> DataFrame:
    """Q35: the first ``n`` rows of the conversion table, by all its columns (the limit is the report)."""
    return conversion.orderBy(*conversion.columns).limit(n)


def capture_stats(captures: DataFrame) -> DataFrame:
    """Q35 (capture side): tier and gender value counts, min/max age and the
    number of distinct cameras, as (stat, key, value) rows."""
    rows = captures.select("member_tier", "gender", "age", "camera_id")
    return _stat_rows(rows, {"member_tier": "member_tier_counts", "gender": "gender_counts"},
                      {"min_age": F.min("age"), "max_age": F.max("age"), "distinct_cameras": F.countDistinct("camera_id")},
                      "NULL")
