"""Presence bitmaps: distinct visitors at several levels from one stored table.

Everybody seen on a business day gets a dense number of that day, people of
the same demographics next to each other. A presence row holds, for one hour,
region, sector and demographics, the visitors whose numbers fall into one
range of 64 as the bits of a long. Distinct counts of coarser levels are such
words combined with OR, so a roll-up never shuffles the visitors again.

Because neighbours in the numbering share their demographics, the visitors of
a full cell lie in few ranges; a cell of few visitors costs a word for each at
most, so the table never has more rows than the index, and every row is small.
A missing profile is nobody: its cell exists with an empty word and counts 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewise.functions import derive as d
from gatewise.operators.footfall import DEMO, HOURLY_COLUMNS, by_profile_day

#: Hash cells that share out the people of a day and demographics while they are numbered.
CELLS = 64
#: Numbers of one range: the bits of a long.
WORD = 64
#: What a presence row is about; ``range`` and ``present`` follow.
CELL_KEYS = ["date_casino", "date_hour", "region_type", "region_id", "region_name", *DEMO, "sector"]


def numbered_people(index: DataFrame) -> DataFrame:
    """(date_casino, profile_id, number): numbers from 0 without gaps per
    business day, ordered by demographics (a profile's smallest) first.

    People are numbered inside hash cells of a day and demographics, and the
    cells of a day (at most CELLS per demographics) are laid one after the
    other, so no window holds all people of a day.
    """
    people = (by_profile_day(index.where(F.col("profile_id").isNotNull()).select("date_casino", "profile_id", *DEMO))
              .groupBy("date_casino", "profile_id").agg(F.min(F.struct(*DEMO)).alias("_demo"))
              .withColumn("_cell", F.pmod(F.xxhash64("profile_id"), F.lit(CELLS)).cast("int")))
    cell = ["date_casino", "_demo", "_cell"]
    inside = people.withColumn("_place", F.row_number().over(Window.partitionBy(*cell).orderBy("profile_id")) - 1)
    before = Window.partitionBy("date_casino").orderBy("_demo", "_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (people.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    # the demographics may be null in part, never as a whole
    return inside.join(starts, cell).select("date_casino", "profile_id", (F.col("_start") + F.col("_place")).alias("number"))


def presence(index: DataFrame) -> DataFrame:
    """One row per (CELL_KEYS, range): ``present``, the visitors as the bits of
    a long (none, in range 0, where a cell holds missing profiles only)."""
    rows = by_profile_day(index.select("date_casino", "profile_id", "date_hour", "region_type", "region_id", "region_name",
                                       *DEMO, d.recoded_sector("region_type", "sector").alias("sector")))
    numbered = rows.join(numbered_people(index), ["date_casino", "profile_id"], "left")
    at = F.col("number")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (at % WORD).cast("int"))
    # single bits are moved to their word: the people of a range are spread over all tasks
    spread = numbered.select(*CELL_KEYS, F.coalesce(F.floor(at / WORD), F.lit(0)).alias("range"),
                             F.coalesce(bit, F.lit(0)).alias("present")).repartition(*CELL_KEYS, "range")
    return rolled_up(spread, CELL_KEYS)


def rolled_up(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Presence of coarser cells: words of one range combined with OR."""
    return rows.groupBy(*keys, "range").agg(F.bit_or("present").alias("present"))


def visitors(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct visitors per ``keys``, which together with the range name a row once."""
    return rows.groupBy(*keys).agg(F.sum(F.bit_count("present")).alias("visitor_num"))


def _level(keys: list[str], **labels: Column) -> list[Column]:
    return [labels[c].alias(c) if c in labels else F.col(c) for c in keys]


def visits_hourly(rows: DataFrame) -> DataFrame:
    """Q17 from the presence table: region level as stored, sectors by OR over
    their regions, everything by OR over the sectors."""
    hour = ["date_casino", "date_hour", "region_type", *DEMO]
    sectors = rolled_up(rows, [*hour, "sector"])
    whole = rolled_up(sectors, hour)
    every = {"region_id": F.lit("all"), "region_name": F.lit("all")}
    parts = [visitors(rows, CELL_KEYS),
             visitors(sectors, [*hour, "sector"]).select(*_level(HOURLY_COLUMNS, **every)),
             visitors(whole, hour).select(*_level(HOURLY_COLUMNS, **every, sector=F.lit("all")))]
    return parts[0].select(*HOURLY_COLUMNS).unionByName(parts[2]).unionByName(parts[1])


def visits_hourly_casino(rows: DataFrame) -> DataFrame:
    """Q18 from the presence table: gaming-floor regions, and all of them together."""
    floor = rows.where(F.col("region_type") == "4")
    hour = ["date_casino", "date_hour", "region_type", *DEMO]
    columns = [c for c in HOURLY_COLUMNS if c != "sector"]
    every = {"region_id": F.lit("all"), "region_name": F.lit("all")}
    region = visitors(floor, [c for c in CELL_KEYS if c != "sector"])  # type '4' has one sector
    return region.select(*columns).unionByName(visitors(rolled_up(floor, hour), hour).select(*_level(columns, **every)))


def visits_hourly_sector(rows: DataFrame) -> DataFrame:
    """Q19 from the presence table: region visitors summed over the
    demographics, and distinct visitors per sector."""
    keys = ["date_casino", "date_hour", "region_id", "region_name", "sector"]
    hour = ["date_casino", "date_hour", "sector"]
    every = visitors(rolled_up(rows, hour), hour)
    return visitors(rows, keys).unionByName(
        every.select(*_level(keys, region_id=F.lit("all"), region_name=F.lit("all")), "visitor_num"))


def daily_sector_rollup(rows: DataFrame) -> DataFrame:
    """Q15 from the presence table: visitors of a day per region, type and
    demographics (OR over the hours), summed by region and sector."""
    day = rolled_up(rows.where(F.col("region_id") != "all"), [c for c in CELL_KEYS if c != "date_hour"])
    return visitors(day, ["date_casino", "region_id", "region_name", "sector"])


def daily_sector_distinct(rows: DataFrame) -> DataFrame:
    """Q16 from the presence table: distinct visitors per business day and sector."""
    found = visitors(rolled_up(rows, ["date_casino", "sector"]), ["date_casino", "sector"])
    return found.select("date_casino", F.lit("all").alias("region_id"), F.lit("all").alias("region_name"), "sector",
                        "visitor_num")
