"""Small row-window jobs from the reference's scratch scripts.

The scratch scripts work on one small frame in memory; these versions run on
any table of the same shape, with per-key windows instead of one global
order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewise.functions.derive import epoch_micros, epoch_seconds
from gatewise.operators.common import join_null_safe, previous_time


def region_runs(captures: DataFrame) -> DataFrame:
    """Q41: per (profile, calendar date) in time order, keep the captures whose
    region differs from the next capture's (the last capture, with no next,
    is kept): the entries of consecutive runs collapsed to one row each.

    The next capture is found within (profile, date, second) first and
    otherwise from the first capture of the next distinct second, so no
    window holds more than one second of one profile.
    """
    keys = ["profile_id", "date"]
    df = captures.select("profile_id", "capture_time", "capture_id", "region_name",
                         F.to_date("capture_time").alias("date"))
    w_sec = Window.partitionBy(*keys, "capture_time").orderBy("capture_id")
    df = (df.withColumn("_in", F.lead(F.struct("capture_time", "region_name")).over(w_sec))
          .withColumn("_first", F.lag("capture_id").over(w_sec).isNull()))
    firsts = df.where(F.col("_first")).select(*keys, "capture_time",
                                               F.struct("capture_time", "region_name").alias("_f"))
    w = Window.partitionBy(*keys).orderBy("capture_time")
    firsts = firsts.withColumn("_next_sec", F.lead("_f").over(w)).drop("_f")
    nxt = F.coalesce(F.col("_in"), F.col("_next_sec"))
    out = (df.join(firsts, on=[*keys, "capture_time"], how="left")
           .withColumn("next_capture_time", nxt["capture_time"])
           .withColumn("next_region_name", nxt["region_name"]))
    return (out.where(F.col("next_region_name").isNull() | (F.col("region_name") != F.col("next_region_name")))
            .select("profile_id", "date", "capture_time", "capture_id", "region_name", "next_capture_time",
                    "next_region_name"))


def group_center_range(df: DataFrame, group: str, value: str) -> DataFrame:
    """Q42 (part 1): value minus its group mean (rounded to 6 decimals), and
    the group's max - min.

    Group statistics are an aggregate (partial per task, no window over a
    whole group) joined back; AQE broadcasts them when small at run time and
    splits a skewed group's partition otherwise."""
    stats = df.groupBy(group).agg(F.avg(value).alias("_mean"),
                                  (F.max(value) - F.min(value)).alias("range"))
    return (join_null_safe(df, stats, [group])
            .withColumn("centered", F.round(F.col(value) - F.col("_mean"), 6)).drop("_mean"))


def time_gaps(df: DataFrame, keys: Sequence[str], time: str, tiebreak: str) -> DataFrame:
    """Q42 (part 2): seconds since the previous row of the same key (NULL for
    the first; previous by time, then ``tiebreak``) and the time shifted by
    1 h 30 min. The previous row is found without a window over a whole key
    (see ``previous_time``)."""
    with_prev = previous_time(df, keys, time, tiebreak, out="_prev")
    gap = epoch_micros(time) - epoch_micros("_prev")
    return (with_prev.withColumn("time_diff", gap / F.lit(1_000_000.0)).drop("_prev")
            .withColumn("new_time", F.col(time) + F.expr("INTERVAL 1 HOURS 30 MINUTES")))


def score_pass(df: DataFrame, a: str, b: str, threshold: float = 150) -> DataFrame:
    """Q42 (part 3): derived total of two columns and a 0/1 pass flag (> threshold)."""
    total = F.col(a) + F.col(b)
    return df.withColumn("score_total", total).withColumn("score_pass", (total > threshold).cast("int"))


def min_per_time_bucket(df: DataFrame, user: str, region: str, diff: str, time: str,
                        tiebreak: str, minutes: int = 10) -> DataFrame:
    """Q43: floor ``time`` to ``minutes`` and keep the row of least ``diff``
    per (user, region, bucket) (ties: least ``tiebreak``), via ``min_by``."""
    step = 60 * minutes
    bucket = F.timestamp_add("SECOND", F.floor(epoch_seconds(time) / F.lit(step)).cast("long") * step,
                             F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    d = df.withColumn("z0_time", bucket)
    return (d.groupBy(user, region, "z0_time")
            .agg(F.min_by(F.struct(diff, tiebreak), F.struct(diff, tiebreak)).alias("_r"))
            .select(user, region, F.col(f"_r.{diff}").alias(diff), "z0_time", F.col(f"_r.{tiebreak}").alias(tiebreak)))
