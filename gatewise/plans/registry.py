"""Query registry: job name -> Spark callable and DuckDB twin.

Helper columns a job carries for partitioning are part of its output and of
its twin alike, so names and values compare one to one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gatewise.operators import footfall as ff
from gatewise.operators import events as ev
from gatewise.operators import misc as ms
from gatewise.operators import paths as pa
from gatewise.operators import presence as pr
from gatewise.sources import testdata as td
from gatewise.plans import duckdb_twins as tw
from gatewise.plans.catalog import Footfall

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


DETAIL_COLS = ("profile_id, person_id, profile_type, member_tier, age, gender, capture_id, region_id, "
               "region_name, sector, region_name_heatmap, region_type, property, camera_id, capture_time, "
               "next_capture_time, date_casino")


@register("q01_capture_detail", tw.table("detail", DETAIL_COLS))
def q01(spark, sf_dir):
    return ff.capture_detail(Footfall(spark, sf_dir).captures_raw)


@register("q02_companion_groups", tw.table("q02"))
def q02(spark, sf_dir):
    return ff.companion_groups(Footfall(spark, sf_dir).captures_raw)


@register("q05_stay_time", tw.table("stay"))
def q05(spark, sf_dir):
    return ff.stay_time(Footfall(spark, sf_dir).detail)


@register("q08_new_or_return", tw.table("q08"))
def q08(spark, sf_dir):
    return ff.new_or_return(Footfall(spark, sf_dir).stay)


@register("q09_visitor_index", tw.table("q09"))
def q09(spark, sf_dir):
    f = Footfall(spark, sf_dir)
    return ff.visitor_index(f.detail, f.stay, f.new_or_return)


@register("q10_visits_daily_region", tw.table("q10"))
def q10(spark, sf_dir):
    return ff.visits_daily_region(Footfall(spark, sf_dir).index)


@register("q11_visits_daily_all", tw.table("q11"))
def q11(spark, sf_dir):
    return ff.visits_daily_all(Footfall(spark, sf_dir).index)


@register("q12_visits_daily_sector", tw.table("q12"))
def q12(spark, sf_dir):
    return ff.visits_daily_sector(Footfall(spark, sf_dir).index)


@register("q13_visits_daily_casino_region", tw.table("q13"))
def q13(spark, sf_dir):
    return ff.visits_daily_casino_region(Footfall(spark, sf_dir).index)


@register("q14_visits_daily_casino_all", tw.table("q14"))
def q14(spark, sf_dir):
    return ff.visits_daily_casino_all(Footfall(spark, sf_dir).index)


@register("q15_daily_sector_rollup", tw.table("q15"))
def q15(spark, sf_dir):
    return pr.daily_sector_rollup(Footfall(spark, sf_dir).presence)


@register("q16_daily_sector_distinct", tw.table("q16"))
def q16(spark, sf_dir):
    return pr.daily_sector_distinct(Footfall(spark, sf_dir).presence)


@register("q17_visits_hourly", tw.table("q17"))
def q17(spark, sf_dir):
    return pr.visits_hourly(Footfall(spark, sf_dir).presence)


@register("q18_visits_hourly_casino", tw.table("q18"))
def q18(spark, sf_dir):
    return pr.visits_hourly_casino(Footfall(spark, sf_dir).presence)


@register("q19_visits_hourly_sector", tw.table("q19"))
def q19(spark, sf_dir):
    return pr.visits_hourly_sector(Footfall(spark, sf_dir).presence)


@register("q20_companion_group_sizes", tw.table("q20"))
def q20(spark, sf_dir):
    return ff.companion_group_sizes(Footfall(spark, sf_dir).companion_groups)


@register("q21_path_offsets", tw.table("q21"))
def q21(spark, sf_dir):
    return pa.path_offsets(Footfall(spark, sf_dir).detail)


@register("q22_path_offsets_carry", tw.table("q22"))
def q22(spark, sf_dir):
    return pa.path_offsets_carry(Footfall(spark, sf_dir).detail)


@register("q23_path_offsets_nearest", tw.table("q23"))
def q23(spark, sf_dir):
    return pa.path_offsets_nearest(Footfall(spark, sf_dir).detail)


@register("q24_path_offsets_fractional", tw.table("q24"))
def q24(spark, sf_dir):
    return pa.path_offsets_fractional(Footfall(spark, sf_dir).detail)


@register("q25_path_daily", tw.table("q25"))
def q25(spark, sf_dir):
    return pa.path_daily(Footfall(spark, sf_dir).index)


@register("q26_camera_alias_map", tw.table("q26"))
def q26(spark, sf_dir):
    cam, zc, zones = td.camera_tables(Footfall(spark, sf_dir).captures_raw)
    return ev.camera_alias_map(cam, zc, zones)


@register("q27_event_calendar", tw.table("calendar"))
def q27(spark, sf_dir):
    return ev.event_calendar(Footfall(spark, sf_dir).event_list)


@register("q28_event_capture_detail", tw.table("q28"))
def q28(spark, sf_dir):
    f = Footfall(spark, sf_dir)
    return ev.event_capture_detail(f.captures_raw, f.camera_dim, f.event_calendar)


@register("q29_event_pre_post", tw.table("q29"))
def q29(spark, sf_dir):
    f = Footfall(spark, sf_dir)
    return ev.event_pre_post(f.event_detail, f.event_calendar)


@register("q30_event_pre_post_v2", tw.table("q30"))
def q30(spark, sf_dir):
    f = Footfall(spark, sf_dir)
    return ev.event_pre_post_v2(f.event_detail, f.event_calendar)


@register("q31_event_conversion", tw.table("q31"))
def q31(spark, sf_dir):
    f = Footfall(spark, sf_dir)
    return ev.event_conversion(f.event_detail, f.event_calendar)


@register("q32_event_summary", tw.table("q32"))
def q32(spark, sf_dir):
    f = Footfall(spark, sf_dir)
    return ev.event_summary(f.event_conversion, f.event_pre_post)


@register("q33_event_run_dates", tw.table("q33"))
def q33(spark, sf_dir):
    return ev.event_run_dates(Footfall(spark, sf_dir).event_calendar)


@register("q33_latest_events", tw.table("q33_latest"))
def q33b(spark, sf_dir):
    return ev.latest_events(Footfall(spark, sf_dir).event_calendar, 7)


@register("q34_hourly_visitors", tw.table("q34"))
def q34(spark, sf_dir):
    return ev.hourly_visitors(Footfall(spark, sf_dir).detail)


@register("q35_conversion_stats", tw.table("q35"))
def q35(spark, sf_dir):
    return ev.conversion_stats(ev.conversion_table(Footfall(spark, sf_dir).event_summary))


@register("q35_capture_stats", tw.table("q35_captures"))
def q35b(spark, sf_dir):
    return ev.capture_stats(Footfall(spark, sf_dir).captures_raw)


@register("q35_conversion_preview", tw.table("q35_preview"))
def q35c(spark, sf_dir):
    return ev.conversion_preview(ev.conversion_table(Footfall(spark, sf_dir).event_summary))


# The adapter names no region 'Entrances ...'; the per-camera grouping runs on
# the gaming-floor regions (prefix CASINO) of the test data instead.
@register("q03_companion_groups_by_camera", tw.table("q03"))
def q03(spark, sf_dir):
    return ff.companion_groups_by_camera(Footfall(spark, sf_dir).captures_raw)


@register("q04_companion_group_binned", tw.table("q04"))
def q04(spark, sf_dir):
    return ff.companion_group_binned(
        ff.companion_groups_by_camera(Footfall(spark, sf_dir).captures_raw))


@register("q06_stay_time_filled", tw.table("q06"))
def q06(spark, sf_dir):
    return ff.stay_time_filled(Footfall(spark, sf_dir).detail)


@register("q07_stay_time_segments", tw.table("q07"))
def q07(spark, sf_dir):
    return ff.stay_time_segments(Footfall(spark, sf_dir).captures_raw)


# --------------------------------------------------------------------------- stream
def _run_stream(spark, sf_dir):
    from gatewise.sources.tables import scratch_path
    from gatewise.streaming import ingest as si
    events = td.read_table(spark, sf_dir, "events")
    src = scratch_path(spark, "stream-src")
    td.stream_records(events).write.mode("overwrite").text(src)
    tables = si.StreamTables(table=scratch_path(spark, "stream-table"), checkpoint=scratch_path(spark, "stream-ckpt"))
    q = si.start_ingest(si.file_source(spark, src), tables)
    q.awaitTermination()
    return q, tables


@register("q36_stream_ingest", tw.table("q36"))
def q36(spark, sf_dir):
    return _stored(spark, _run_stream(spark, sf_dir)[1])


def _stored(spark, tables):
    from gatewise.streaming import ingest as si
    return si.read_table(spark, tables.table)


def _stream_table(spark, sf_dir):
    """The stored stream table (the stream runs once per session and input)."""
    f = Footfall(spark, sf_dir)
    return f.layer("stream_table", lambda: _stored(spark, _run_stream(spark, sf_dir)[1]))


@register("q37_latest_n", tw.table("q37_latest"))
def q37(spark, sf_dir):
    from gatewise.streaming import ingest as si
    return si.latest_n(_stream_table(spark, sf_dir), 10)


@register("q37_row_count", tw.table("q37_count"))
def q37b(spark, sf_dir):
    from gatewise.streaming import ingest as si
    return si.row_count(_stream_table(spark, sf_dir))


@register("q44_stream_stats", tw.table("q44"))
def q44(spark, sf_dir):
    from gatewise.streaming import ingest as si
    totals = si.ProgressTotals()
    spark.streams.addListener(totals)
    try:
        q, tables = _run_stream(spark, sf_dir)
        batches = totals.of(q)
    finally:
        spark.streams.removeListener(totals)
    return si.stream_stats(batches, si.read_counts(spark, tables.table), _stored(spark, tables))


# --------------------------------------------------------------------------- ingest
def _string_ingest(spark, sf_dir):
    from gatewise.sources import tables as tb
    source = td.read_table(spark, sf_dir, "customer")
    path = tb.scratch_path(spark, "sheet")
    tb.export_csv(source, path)
    return source, tb.string_ingest(spark, path)


@register("q38_string_ingest", tw.table("q38"))
def q38(spark, sf_dir):
    return _string_ingest(spark, sf_dir)[1]


@register("q39_ingest_audit", tw.table("q39"))
def q39(spark, sf_dir):
    from gatewise.sources import tables as tb
    source, stored = _string_ingest(spark, sf_dir)
    return tb.ingest_audit(source, stored)


@register("q39_ingest_preview", tw.table("q39_preview"))
def q39b(spark, sf_dir):
    from gatewise.sources import tables as tb
    return tb.ingest_preview(_string_ingest(spark, sf_dir)[1])


@register("q38_workbook_ingest", tw.table("q38"))
def q38b(spark, sf_dir):
    """Q38 from xlsx: the customers as workbooks, stored, then read again."""
    from gatewise.sources import spreadsheet as sh
    from gatewise.sources.tables import materialize
    return sh.read_workbooks(materialize(sh.to_workbooks(td.read_table(spark, sf_dir, "customer")), "workbooks"))


@register("q40_slim_copy", tw.table("q40"))
def q40(spark, sf_dir):
    import pyspark.sql.functions as F
    from gatewise.sources import tables as tb
    return tb.slim_copy(Footfall(spark, sf_dir).captures_raw, tb.scratch_path(spark, "slim"),
                        F.lit(tw.LOADED_AT).cast("timestamp_ntz"))


# --------------------------------------------------------------------------- misc
@register("q41_region_runs", tw.table("q41"))
def q41(spark, sf_dir):
    return ms.region_runs(Footfall(spark, sf_dir).captures_raw)


@register("q42_group_center_range", tw.table("q42"))
def q42(spark, sf_dir):
    import pyspark.sql.functions as F
    e = td.read_table(spark, sf_dir, "events").withColumn("cam", F.get_json_object("props", "$.k").cast("int"))
    out = ms.group_center_range(e, "event_type", "value")
    out = ms.time_gaps(out, ["user_id"], "ts", "event_id")
    out = ms.score_pass(out, "value", "cam")
    return out.select("event_id", "user_id", "event_type", "value", "ts", "centered", "range", "time_diff",
                      "new_time", "score_total", "score_pass")


@register("q43_min_per_time_bucket", tw.table("q43"))
def q43(spark, sf_dir):
    return ms.min_per_time_bucket(td.read_table(spark, sf_dir, "events"), "user_id", "event_type", "value", "ts",
                                  "event_id")
