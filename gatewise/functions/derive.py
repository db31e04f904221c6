"""Column expressions shared by the jobs.

Everything here is a built-in Spark expression (no Python UDF), so it stays
inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------
# A business day runs 06:00 to 05:59 (capture time minus 21600 seconds).
BUSINESS_DAY_OFFSET_HOURS = 6
# Stays shorter than this many seconds count as "less than 15 minutes".
SHORT_STAY_SECONDS = 15 * 60
# Offset bins (minutes) kept by the path jobs.
TARGET_BINS = [-60, -45, -30, -15, -10, -5, 0, 5, 10, 15, 30, 45, 60]
# Event hour windows (hours before start / after end).
HOUR_WINDOWS = [1, 2, 4]
# Age bands: 0-20, 21-39, 40-65, above 65.
AGE_BANDS = [(0, 20, "0-20"), (21, 39, "21-39"), (40, 65, "40-65")]
AGE_BAND_OVER = (65, "65+")
# Prefixes that classify a region name.
CASINO_PREFIX = "CASINO"
BW_PREFIX = "BW"
# Hour bands of an event start: EM 0-4, AM 5-12, PM 13-18, EV 19-24.
PERIOD_BANDS = [(0, 4, "EM"), (5, 12, "AM"), (13, 18, "PM"), (19, 24, "EV")]
# Companion groups: a gap of more than this many seconds starts a new group.
GROUP_GAP_SECONDS = 2
# Group size labels 1..5, then 5+.
GROUP_SIZE_LABELS = ["1", "2", "3", "4", "5"]
GROUP_SIZE_OVER = "5+"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def business_day(ts="capture_time") -> Column:
    """Business date of a wall-clock timestamp (day starts at 06:00)."""
    return F.to_date(col(ts) - F.expr(f"INTERVAL {BUSINESS_DAY_OFFSET_HOURS} HOURS"))


def business_hour_start(ts="capture_time") -> Column:
    """Start of the hour of ``ts - 6 h`` (the reference's ``date_casino_hour``)."""
    return hour_start(col(ts) - F.expr(f"INTERVAL {BUSINESS_DAY_OFFSET_HOURS} HOURS"))


def hour_start(ts="capture_time") -> Column:
    """Start of the hour of a wall-clock (NTZ) timestamp, built from its
    fields, so no session time zone takes part."""
    c = col(ts)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0))


def epoch_seconds(ts="capture_time") -> Column:
    """Whole seconds since 1970-01-01 00:00:00 of a wall-clock timestamp,
    from its date and time fields (independent of the session time zone)."""
    c = col(ts)
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock timestamp (field based)."""
    c = col(ts)
    whole_minutes = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long") * 1440 \
        + F.hour(c) * 60 + F.minute(c)
    micros_in_minute = (F.extract(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("long")
    return whole_minutes * 60_000_000 + micros_in_minute


def minute_index(ts="capture_time") -> Column:
    """Minute number since the epoch; differences count minute boundaries crossed."""
    return F.floor(epoch_seconds(ts) / F.lit(60)).cast("long")


def day_index(d) -> Column:
    """Days since the epoch of a date column."""
    return F.datediff(col(d), F.lit("1970-01-01").cast("date"))


def age_band(age="age", default=None) -> Column:
    """Age band label; ages outside every band give ``default`` (NULL in SQL jobs)."""
    a = col(age)
    expr = None
    for lo, hi, label in AGE_BANDS:
        cond = a.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    expr = expr.when(a > AGE_BAND_OVER[0], AGE_BAND_OVER[1])
    return expr.otherwise(F.lit(default).cast("string"))


def region_type(region_name="region_name") -> Column:
    """'4' for gaming-floor regions (name starts with CASINO), else '3'."""
    return F.when(col(region_name).startswith(CASINO_PREFIX), "4").otherwise("3")


def region_property(region_name="region_name") -> Column:
    """'BW' when the region name starts with BW, else 'GF'."""
    return F.when(col(region_name).startswith(BW_PREFIX), "BW").otherwise("GF")


def recoded_sector(rtype="region_type", sector="sector") -> Column:
    """Sector label used by the cubes: gaming-floor regions become 'Gaming'."""
    return F.when(col(rtype) == "4", "Gaming").otherwise(col(sector))


def path_area(name, prop="property", rtype="region_type") -> Column:
    """Area label of the path jobs: BW property -> 'BW', gaming floor -> 'CASINO'."""
    return (F.when(col(prop) == "BW", "BW")
            .when(col(rtype) == "4", "CASINO")
            .otherwise(col(name)))


def daily_path_area(name="region_name", rtype="region_type") -> Column:
    """Area label of the daily path cube: gaming floor first, then BW prefix."""
    return (F.when(col(rtype) == "4", "CASINO")
            .when(col(name).startswith(BW_PREFIX), "BW")
            .otherwise(col(name)))


def period_flag(ts) -> Column:
    """EM / AM / PM / EV band of the hour of ``ts``."""
    h = F.hour(col(ts))
    expr = None
    for lo, hi, label in PERIOD_BANDS:
        cond = h.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def group_type(size="group_size") -> Column:
    """Group size label '1'..'5', larger groups '5+'."""
    s = col(size)
    expr = None
    for i, label in enumerate(GROUP_SIZE_LABELS, start=1):
        expr = F.when(s == i, label) if expr is None else expr.when(s == i, label)
    return expr.otherwise(GROUP_SIZE_OVER)


def _tdiv(x: Column, n: int) -> Column:
    """Integer division truncating toward zero (SQL ``intDiv`` / Spark ``div``)."""
    return (x / F.lit(n)).cast("long")


def offset_bin_v1(d="d_min", same_time="same_time") -> Column:
    """Offset bin of the first SQL path job.

    ``d`` counts minute boundaries between the two captures. First matching
    rule wins: a different capture 0..15 minutes later -> (d div 5 + 1) * 5;
    -15..-1 -> (d div 5 - 1) * 5; 16..60 -> (d div 15 + 1) * 15;
    -60..-16 -> (d div 15 - 1) * 15; d = 0 (same time) -> 0. Division
    truncates toward zero, so |15| -> 20 and |60| -> 75, which the bin list
    later removes.
    """
    dd = col(d)
    return (F.when((~col(same_time)) & dd.between(0, 15), (_tdiv(dd, 5) + 1) * 5)
            .when((dd >= -15) & (dd < 0), (_tdiv(dd, 5) - 1) * 5)
            .when(dd.between(16, 60), (_tdiv(dd, 15) + 1) * 15)
            .when(dd.between(-60, -16), (_tdiv(dd, 15) - 1) * 15)
            .when(dd == 0, F.lit(0).cast("long")))


def offset_bin_new(d="d_min", same_time="same_time") -> Column:
    """Offset bin of the second SQL path job: d = 0 is always bin 0."""
    dd = col(d)
    return (F.when((~col(same_time)) & dd.between(1, 15), (_tdiv(dd, 5) + 1) * 5)
            .when(dd.between(-15, -1), (_tdiv(dd, 5) - 1) * 5)
            .when(dd.between(16, 60), (_tdiv(dd, 15) + 1) * 15)
            .when(dd.between(-60, -16), (_tdiv(dd, 15) - 1) * 15)
            .when(dd == 0, F.lit(0).cast("long")))


def offset_bin_floor(d="d_min", is_self="is_self") -> Column:
    """Offset bin of the per-profile scan: floor division on elapsed minutes.

    Own capture -> 0; 0..15 -> (d // 5 + 1) * 5; -15..-1 -> (d // 5) * 5;
    16..60 -> (d // 15 + 1) * 15; -60..-16 -> (d // 15) * 15.
    """
    dd = col(d)
    fl5 = F.floor(dd / F.lit(5)).cast("long")
    fl15 = F.floor(dd / F.lit(15)).cast("long")
    return (F.when(col(is_self) & (dd == 0), F.lit(0).cast("long"))
            .when(dd.between(0, 15), (fl5 + 1) * 5)
            .when((dd >= -15) & (dd < 0), fl5 * 5)
            .when(dd.between(16, 60), (fl15 + 1) * 15)
            .when(dd.between(-60, -16), fl15 * 15))


def offset_bin_fractional(d="d_frac") -> Column:
    """Offset bin on fractional minutes: 0 exact; (0,15]; [-15,0); [16,60]; [-60,-16].

    Values strictly between 15 and 16 (or -16 and -15) get no bin.
    """
    dd = col(d)
    fl5 = F.floor(dd / F.lit(5.0)).cast("long")
    fl15 = F.floor(dd / F.lit(15.0)).cast("long")
    return (F.when(dd == 0, F.lit(0).cast("long"))
            .when((dd > 0) & (dd <= 15), (fl5 + 1) * 5)
            .when((dd >= -15) & (dd < 0), fl5 * 5)
            .when((dd >= 16) & (dd <= 60), (fl15 + 1) * 15)
            .when((dd >= -60) & (dd <= -16), fl15 * 15))
