"""Run the warehouse jobs in build order and replace table slices.

``run_footfall`` / ``run_events`` are the user-facing equivalent of running
the reference's jobs for a list of dates: each layer is computed for the
requested business days (all days when ``days`` is None), written to
``<root>/<table>`` replacing exactly those slices (dynamic partition
overwrite on the slice column), and read back for the next job, so every job
reads a stored, partition-pruned table and lineage stays short. Jobs that
need history (return flags) read it from the stored table.

Slice keys: business day (``date_casino``) for the footfall layers and
cubes; calendar date (``date``) for the calendar-day jobs (path offsets per
profile, companion groups) and the event capture detail; event name for the
event result tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewise.operators import events as ev
from gatewise.operators import footfall as ff
from gatewise.operators import paths as pa
from gatewise.sources.tables import replace_slices


def _dates(days: Iterable | None) -> list[dt.date] | None:
    if days is None:
        return None
    return sorted({d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)) for d in days})


def _store(spark: SparkSession, df: DataFrame, root: str, table: str, slice_col: str,
           slices: Iterable | None = None) -> DataFrame:
    """Replace the named slices (None: all) in ``<root>/<table>``, emptying
    those that ``df`` has no row for, and read the table back (with the written schema, so a table whose slices are all empty
    still reads as an empty table)."""
    path = f"{root.rstrip('/')}/{table}"
    replace_slices(df, path, slice_col, slices, add_batch_time=True)
    return _read(spark, path, df.schema)


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def _between(col: str, lo: dt.date, hi: dt.date):
    return (F.col(col) >= F.lit(lo)) & (F.col(col) <= F.lit(hi))


def during(first: dt.date | None, last: dt.date | None):
    """Captures of the calendar dates ``first`` to ``last``, as a range on the
    stored column that reaches the scan; no dates: no rows."""
    if first is None or last is None:
        return F.lit(False)
    t = F.col("capture_time")
    return ((t >= F.lit(dt.datetime.combine(first, dt.time())).cast("timestamp_ntz"))
            & (t < F.lit(dt.datetime.combine(last + dt.timedelta(days=1), dt.time())).cast("timestamp_ntz")))


def run_footfall(spark: SparkSession, captures_raw: DataFrame, root: str,
                 days: Iterable | None = None) -> dict[str, DataFrame]:
    """Build detail -> stay -> new/return -> index -> cubes and path tables for
    ``days`` (business dates). Returns the stored tables, read back."""
    ds = _dates(days)
    out: dict[str, DataFrame] = {}

    def store(name, df, slice_col="date_casino"):
        t = _store(spark, df, root, name, slice_col, ds)
        return t if ds is None else t.where(F.col(slice_col).isin(ds))

    detail_all = _store(spark, ff.capture_detail(captures_raw, ds), root, "capture_detail", "date_casino", ds)
    detail = detail_all if ds is None else detail_all.where(F.col("date_casino").isin(ds))
    out["capture_detail"] = detail
    stay = store("stay_time", ff.stay_time(detail))
    stay_history = _read(spark, f"{root.rstrip('/')}/stay_time", stay.schema)
    out["stay_time"] = stay
    nor = store("new_or_return", ff.new_or_return(stay_history, ds))
    out["new_or_return"] = nor
    index = store("visitor_index", ff.visitor_index(detail, stay, nor))
    out["visitor_index"] = index
    out["visits_daily"] = store("visits_daily", ff.visits_daily(index))
    out["visits_daily_casino"] = store("visits_daily_casino", ff.visits_daily_casino(index))
    out["daily_sector"] = store("daily_sector", ff.daily_sector(index))
    out["visits_hourly"] = store("visits_hourly", ff.visits_hourly(index))
    out["visits_hourly_casino"] = store("visits_hourly_casino", ff.visits_hourly_casino(index))
    out["visits_hourly_sector"] = store("visits_hourly_sector", ff.visits_hourly_sector(index))
    out["path_offsets"] = store("path_offsets", pa.path_offsets(detail))
    out["path_offsets_carry"] = store("path_offsets_carry", pa.path_offsets_carry(detail))
    out["path_daily"] = store("path_daily", pa.path_daily(index))
    # calendar-date jobs: a calendar date d is business days d - 1 (00:00-05:59) and d
    if ds is None:
        cal_detail = detail_all
    else:
        cal_detail = (detail_all.where(_between("date_casino", ds[0] - dt.timedelta(days=1), ds[-1]))
                      .where(F.to_date("capture_time").isin(ds)))
    out["path_offsets_nearest"] = store("path_offsets_nearest", pa.path_offsets_nearest(cal_detail), "date")
    # companion groups are per calendar date; business day d needs calendar
    # dates d and d + 1, both computed whole from the raw captures
    cal_days = None if ds is None else sorted(set(ds) | {d + dt.timedelta(days=1) for d in ds})
    groups = ff.companion_groups(captures_raw, cal_days).withColumn("date", F.to_date("date_hour"))
    stored_groups = _store(spark, groups, root, "companion_groups", "date", cal_days)
    if ds is not None:
        stored_groups = stored_groups.where(F.to_date("date_casino_hour").isin(ds))
    out["companion_groups"] = stored_groups
    out["companion_group_sizes"] = store("companion_group_sizes", ff.companion_group_sizes(stored_groups))
    return out


def run_events(spark: SparkSession, captures: DataFrame, camera_dim: DataFrame, event_list: DataFrame,
               root: str, titles: DataFrame | None = None) -> dict[str, DataFrame]:
    """Event calendar (truncate and load), event capture detail (sliced by
    calendar date), pre/post, conversion and summary (sliced by event).

    With ``titles`` (a one-column DataFrame of calendar titles) only those
    events are processed, as in the reference's per-title runs: the capture
    detail is rebuilt for their dates (the day before to the day after,
    selected by a semi-join, not a driver-side list) against the whole
    calendar, because every event of a date joins its captures; the event
    tables replace only the slices of the chosen events."""
    cal = ev.event_calendar(event_list)
    cal_path = f"{root.rstrip('/')}/event_calendar"
    cal.write.mode("overwrite").parquet(cal_path)
    cal = spark.read.parquet(cal_path)
    chosen = cal
    caps = captures
    days = names = None
    if titles is not None:
        chosen = cal.join(titles.select(F.col(titles.columns[0]).alias("Title")), on="Title", how="left_semi")
        dates = ev.event_run_dates(chosen).select(F.col("CDate").alias("_d"))
        # the chosen events and their dates (a few per event), as slice names
        names = [r[0] for r in chosen.select("Title").distinct().collect()]
        days = [r[0] for r in dates.collect()]
        caps = (captures.where(during(min(days, default=None), max(days, default=None)))
                .withColumn("_d", F.to_date("capture_time")).join(dates, on="_d", how="left_semi").drop("_d"))
    detail = ev.event_capture_detail(caps, camera_dim, cal).withColumn("date", F.to_date("capture_time"))
    detail = _store(spark, detail, root, "event_capture_detail", "date", days).drop("date")
    pre_post = _store(spark, ev.event_pre_post(detail, chosen), root, "event_pre_post", "event_name", names)
    conversion = _store(spark, ev.event_conversion(detail, chosen), root, "event_conversion", "event_name", names)
    summary = _store(spark, ev.event_summary(conversion, pre_post), root, "event_summary", "event_name", names)
    return {"event_calendar": cal, "event_capture_detail": detail, "event_pre_post": pre_post,
            "event_conversion": conversion, "event_summary": summary}
