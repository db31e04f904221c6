"""Stand-in inputs built from the shared test tables.

The test tables have no camera captures, so the ``events`` table is mapped
onto the capture schema with a fixed, integer-only rule (the same rule is
written as a DuckDB CTE in ``gatewise.plans.duckdb_twins``). The adapters only
shape rows; every job does its own work on them and makes no use of how they
were built.

Mapping (``events`` -> ``captures_raw``):
- capture_id = event_id (as text); profile_id = user_id + 1; person_id = 'P' || profile_id
- capture_time = 2024-01-01 00:00:00 + ((whole epoch seconds of ts) - 1704067200) div 6 seconds
  (the clock is compressed six-fold so paths within +-60 minutes occur)
- camera_id = k of ``props``; region number n = camera_id % 10
- region_name: n in 0..3 -> 'CASINO n', n = 4 -> 'BW n', n = 9 -> 'Entrances 9', else 'ZONE n';
  region_name_heatmap = 'MAP ' || region_name; sector Casino / Halls / Music alike
- age = 15 + (user_id * 7) % 60; gender = 1 + user_id % 2; profile_type = 1 + user_id % 4
- member_tier only for profile_type 1: Basic, Silver, Gold, Diamond by (user_id div 4) % 4
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewise.functions.derive import epoch_seconds

# Fixed values of the mapping.
CLOCK_BASE = "2024-01-01 00:00:00"
CLOCK_BASE_EPOCH = 1704067200
CLOCK_COMPRESSION = 6
TIERS = ["Basic", "Silver", "Gold", "Diamond"]
ARENA_SECTORS = ["Arena", "Casino Entrance", "Retail"]  # by camera_id % 3
EVENT_SOURCE_TYPE = "signup"   # rows of this type become events


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _camera(props="props"):
    return F.get_json_object(F.col(props), "$.k").cast("int")


def _region_name(n):
    return (F.when(n <= 3, F.concat(F.lit("CASINO "), n.cast("string")))
            .when(n == 4, F.concat(F.lit("BW "), n.cast("string")))
            .when(n == 9, F.concat(F.lit("Entrances "), n.cast("string")))
            .otherwise(F.concat(F.lit("ZONE "), n.cast("string"))))


def _sector(n):
    return F.when(n <= 3, "Casino").when(n == 4, "Halls").otherwise("Music")


def _compressed_time(ts="ts"):
    secs = F.floor((epoch_seconds(ts) - F.lit(CLOCK_BASE_EPOCH)) / F.lit(CLOCK_COMPRESSION)).cast("long")
    return F.timestamp_add("SECOND", secs, F.lit(CLOCK_BASE).cast("timestamp_ntz"))


def captures_raw(events: DataFrame) -> DataFrame:
    """Raw captures (the capture input schema) from ``events``."""
    uid = F.col("user_id")
    n = (F.col("camera_id") % 10)
    ptype = (uid % 4 + 1).cast("int")
    tier = F.when(ptype == 1, F.element_at(F.array(*[F.lit(t) for t in TIERS]),
                                            ((uid / 4).cast("long") % 4 + 1).cast("int")))
    return (events
            .select(uid, "event_id", "ts", _camera().alias("camera_id"))
            .select(
                (uid + 1).alias("profile_id"),
                F.concat(F.lit("P"), (uid + 1).cast("string")).alias("person_id"),
                ptype.alias("profile_type"),
                tier.alias("member_tier"),
                (F.lit(15) + (uid * 7) % 60).cast("int").alias("age"),
                (uid % 2 + 1).cast("int").alias("gender"),
                F.col("event_id").cast("string").alias("capture_id"),
                F.col("camera_id"),
                n.cast("string").alias("region_id"),
                _region_name(n).alias("region_name"),
                _sector(n).alias("sector"),
                F.concat(F.lit("MAP "), _region_name(n)).alias("region_name_heatmap"),
                _compressed_time().alias("capture_time"),
            ))


def camera_dim(captures: DataFrame) -> DataFrame:
    """Event camera dimension: group 'Gate n' (camera_id % 7), sector by camera_id % 3."""
    cams = captures.select("camera_id").distinct()
    m3 = F.col("camera_id") % 3
    return cams.select(
        F.col("camera_id").cast("string").alias("camera_id"),
        F.concat(F.lit("Gate "), (F.col("camera_id") % 7).cast("string")).alias("group"),
        F.when(m3 == 0, ARENA_SECTORS[0]).when(m3 == 1, ARENA_SECTORS[1])
        .otherwise(ARENA_SECTORS[2]).alias("business_sector"),
    )


def camera_tables(captures: DataFrame):
    """(camera, zone_cameras, zones) for the alias map: zone = camera_id % 10."""
    cams = captures.select("camera_id").distinct()
    camera = cams.select(F.col("camera_id"),
                         F.concat(F.lit("CAM "), F.col("camera_id").cast("string")).alias("camera_name"))
    zone_cameras = cams.select((F.col("camera_id") % 10).alias("zone_id"), "camera_id")
    zid = F.col("zone_id")
    zones = (zone_cameras.select("zone_id").distinct()
             .select(zid, F.when(zid == 4, "BW").otherwise("GF").alias("property"),
                     _region_name(zid).alias("alias")))
    return camera, zone_cameras, zones


def event_list(events: DataFrame) -> DataFrame:
    """Event list input (Title, StartDtm, EndDtm, Venue, EventType, Genre, InsertDtm) derived from ``events``.

    Each ``signup`` row becomes one event starting at
    its compressed time (to the minute) and lasting 60 + 2 * floor(value)
    minutes, so some events cross midnight and span two dates.
    """
    t = _compressed_time()
    start = F.timestamp_add("SECOND", -F.second(t), t)   # whole seconds -> start of the minute
    dur = (F.lit(60) + F.floor(F.col("value")).cast("long") * 2)
    return (events
            .where(F.col("event_type") == EVENT_SOURCE_TYPE)
            .select(
                F.concat(F.lit("Event "), F.col("event_id").cast("string")).alias("Title"),
                start.alias("StartDtm"),
                F.timestamp_add("MINUTE", dur, start).alias("EndDtm"),
                F.lit("Hall").alias("Venue"),
                F.lit("concert").alias("EventType"),
                F.lit("Pop").alias("Genre"),
                start.alias("InsertDtm"),
            ))


def stream_records(events: DataFrame) -> DataFrame:
    """JSON text records ``{"date_time": "...", "ID": n}`` for the stream job."""
    return events.select(
        F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date_time"),
                           F.col("event_id").alias("ID"))).alias("value"))


def load_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captures_raw(read_table(spark, sf_dir, "events"))
