"""Building blocks shared by several jobs.

The two ordered-window helpers never place all rows of one profile (or one
day) in a single window partition: they work on the *distinct seconds* of a
key, which is bounded by 86,400 per key and day however many rows the key
holds, and join the answer back on (key, second).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewise.functions.derive import epoch_seconds


def next_capture_time(df: DataFrame, keys: Sequence[str], time: str = "capture_time",
                      tiebreak: str = "capture_id", out: str = "next_capture_time") -> DataFrame:
    """``lead(time)`` over ``partitionBy(keys).orderBy(time, tiebreak)``, skew-proof.

    For second-resolution times the lead of a row is its own time when a later
    row (by ``tiebreak``) shares the second, else the next distinct second of
    the key. A window over (key, second) finds the former and marks the last
    row of each second; a window over those last rows only (at most 86,400
    per key and day) finds the next second, joined back on (key, second),
    which reuses the rows' partitioning.
    """
    keys = list(keys)
    w_sec = Window.partitionBy(*keys, time).orderBy(tiebreak)
    rows = df.withColumn("_in", F.lead(time).over(w_sec))
    seconds = rows.where(F.col("_in").isNull()).select(*keys, time)
    seconds = seconds.withColumn("_next_t", F.lead(time).over(Window.partitionBy(*keys).orderBy(time)))
    joined = join_null_safe(rows, seconds, [*keys, time], how="left")  # a missing key is one key, as in a window
    return joined.withColumn(out, F.coalesce(F.col("_in"), F.col("_next_t"))).drop("_in", "_next_t")


def previous_time(df: DataFrame, keys: Sequence[str], time: str, tiebreak: str,
                  out: str = "_prev_time") -> DataFrame:
    """``lag(time)`` over ``partitionBy(keys).orderBy(time, tiebreak)`` for
    times of any resolution, without a window over a whole key: inside one
    (key, whole second) the previous row comes from a window over that
    second; the first row of a second takes the last time of the key's
    previous distinct second (a window over at most 86,400 seconds per key
    and day), joined back on (key, second)."""
    keys = list(keys)
    sec = epoch_seconds(time)
    rows = df.withColumn("_sec", sec)
    w_sec = Window.partitionBy(*keys, "_sec").orderBy(time, tiebreak)
    rows = rows.withColumn("_prev_in", F.lag(time).over(w_sec))
    lasts = (rows.groupBy(*keys, "_sec")
             .agg(F.max_by(F.col(time), F.struct(time, tiebreak)).alias("_last"))
             .withColumn("_prev_sec", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_sec")))
             .drop("_last"))
    joined = join_null_safe(rows, lasts, [*keys, "_sec"])
    return (joined.withColumn(out, F.coalesce(F.col("_prev_in"), F.col("_prev_sec")))
            .drop("_sec", "_prev_in", "_prev_sec"))


def gap_group_ids(df: DataFrame, keys: Sequence[str], time: str = "capture_time",
                  gap_seconds: int = 2, first_starts_group: bool = False,
                  out: str = "group_id") -> DataFrame:
    """Gaps-and-islands id per key: a gap of more than ``gap_seconds`` opens a group.

    The id is a running count of gaps over the key's distinct seconds (rows
    sharing a second always share a group, as with a RANGE frame). With
    ``first_starts_group`` the first second counts as a gap, so ids start at 1;
    otherwise they start at 0. Returns ``df`` with ``out`` joined on
    (keys, time).
    """
    keys = list(keys)
    secs = df.select(*keys, time).distinct()
    w = Window.partitionBy(*keys).orderBy(time)
    prev = F.lag(time).over(w)
    gap = epoch_seconds(time) - epoch_seconds(prev)
    flag = (F.when(prev.isNull(), F.lit(1 if first_starts_group else 0))
            .when(gap > gap_seconds, 1).otherwise(0))
    secs = (secs.withColumn("_new", flag)
            .withColumn(out, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
            .drop("_new"))
    return join_null_safe(df, secs, [*keys, time])


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the row with the greatest ``order`` per key (``row_number() = 1``).

    Written as a ``max_by`` aggregate, which combines map-side, so a hot key
    is reduced before the shuffle instead of being sorted in one task.
    """
    payload = [c for c in df.columns if c not in keys]
    picked = (df.groupBy(*keys)
              .agg(F.max_by(F.struct(*payload), F.struct(*order)).alias("_row")))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload])


def ratio_round2(total: Column, count: Column) -> Column:
    """round(total / count, 2) half-to-even, in exact integer arithmetic."""
    scaled = total.cast("long") * 100
    q = F.floor(scaled / count).cast("long")
    r = scaled - q * count
    up = F.when(r * 2 > count, 1).when((r * 2 == count) & (q % 2 != 0), 1).otherwise(0)
    return ((q + up) / F.lit(100.0)).cast("double")


def join_null_safe(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL matches NULL; the keys come from ``rows``."""
    renamed = other.select(*[F.col(c).alias(f"_other_{c}" if c in keys else c) for c in other.columns])
    on = [rows[k].eqNullSafe(renamed[f"_other_{k}"]) for k in keys]
    return rows.join(renamed, on=on, how=how).drop(*[f"_other_{k}" for k in keys])
