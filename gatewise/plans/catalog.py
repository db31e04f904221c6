"""Job composition in build order over the shared test tables.

``Footfall(spark, sf_dir)`` exposes every warehouse layer. As in the
reference (which stores each layer as a table and lets the next job read it),
layers are *staged*: built once per session and input folder, written as
parquet under the shared checkpoint folder (``spark.checkpoint.dir``),
business-day layers partitioned by ``date_casino``, and read back. A
registered query then runs exactly one job on its staged inputs, and the
written layers cut lineage, so a lost executor only recomputes one layer.

``staged=False`` builds everything as one lazy plan instead (tests).
Nothing here collects data to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gatewise.operators import events as ev
from gatewise.operators import footfall as ff
from gatewise.operators import presence as pr
from gatewise.sources import testdata as td
from gatewise.sources.tables import input_stamp, scratch_path

# (application id, input folder, its stamp, layer) -> parquet path
_STAGED: dict[tuple[str, str, str, str], str] = {}
# (application id, path) -> DataFrame reading it: staged layers never change,
# so the file listing and footer schema are resolved once per session
_READS: dict[tuple[str, str], DataFrame] = {}

# layer -> partition column of its staged table
PARTITIONS = {"detail": "date_casino", "stay": "date_casino", "new_or_return": "date_casino",
              "index": "date_casino", "presence": "date_casino"}


class Footfall:
    def __init__(self, spark: SparkSession, sf_dir: str, staged: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.staged = staged
        self._lazy: dict[str, DataFrame] = {}
        # a changed input gets layers of its own
        self.stamp = input_stamp(spark, f"{sf_dir.rstrip('/')}/events.parquet") if staged else ""

    # staging ------------------------------------------------------------------
    def _key(self, name: str) -> tuple[str, str, str, str]:
        return (self.spark.sparkContext.applicationId, self.sf_dir.rstrip("/"), self.stamp, name)

    def is_staged(self, name: str) -> bool:
        return self._key(name) in _STAGED

    def layer(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if not self.staged:
            if name not in self._lazy:
                self._lazy[name] = build()
            return self._lazy[name]
        key = self._key(name)
        if key not in _STAGED:
            path = scratch_path(self.spark, f"layer-{name}")
            df, part = build(), PARTITIONS.get(name)
            if part:
                # a task gets few days, a large day several tasks: files grow with the rows, not with tasks x days
                df = df.hint("rebalance", part)
            writer = df.write.mode("overwrite")
            (writer.partitionBy(part) if part else writer).parquet(path)
            _STAGED[key] = path
        rkey = (key[0], _STAGED[key])
        if rkey not in _READS:
            _READS[rkey] = self.spark.read.parquet(_STAGED[key])
        return _READS[rkey]

    # inputs -------------------------------------------------------------------
    @property
    def events(self) -> DataFrame:
        return td.read_table(self.spark, self.sf_dir, "events")

    @property
    def captures_raw(self) -> DataFrame:
        return self.layer("captures_raw", lambda: td.captures_raw(self.events))

    # footfall chain -----------------------------------------------------------
    @property
    def detail(self) -> DataFrame:
        return self.layer("detail", lambda: ff.capture_detail(self.captures_raw))

    @property
    def stay(self) -> DataFrame:
        return self.layer("stay", lambda: ff.stay_time(self.detail))

    @property
    def new_or_return(self) -> DataFrame:
        return self.layer("new_or_return", lambda: ff.new_or_return(self.stay))

    @property
    def index(self) -> DataFrame:
        return self.layer("index", lambda: ff.visitor_index(self.detail, self.stay, self.new_or_return))

    @property
    def presence(self) -> DataFrame:
        return self.layer("presence", lambda: pr.presence(self.index))

    @property
    def companion_groups(self) -> DataFrame:
        return self.layer("companion_groups", lambda: ff.companion_groups(self.captures_raw))

    # events chain ---------------------------------------------------------------
    @property
    def event_list(self) -> DataFrame:
        return self.layer("event_list", lambda: td.event_list(self.events))

    @property
    def camera_dim(self) -> DataFrame:
        return self.layer("camera_dim", lambda: td.camera_dim(self.captures_raw))

    @property
    def event_calendar(self) -> DataFrame:
        return self.layer("event_calendar", lambda: ev.event_calendar(self.event_list))

    @property
    def event_detail(self) -> DataFrame:
        return self.layer("event_detail",
                          lambda: ev.event_capture_detail(self.captures_raw, self.camera_dim, self.event_calendar))

    @property
    def event_pre_post(self) -> DataFrame:
        return self.layer("event_pre_post", lambda: ev.event_pre_post(self.event_detail, self.event_calendar))

    @property
    def event_conversion(self) -> DataFrame:
        return self.layer("event_conversion", lambda: ev.event_conversion(self.event_detail, self.event_calendar))

    @property
    def event_summary(self) -> DataFrame:
        return self.layer("event_summary", lambda: ev.event_summary(self.event_conversion, self.event_pre_post))

    LAYERS = ["captures_raw", "detail", "stay", "new_or_return", "index", "presence", "companion_groups", "event_list",
              "camera_dim", "event_calendar", "event_detail", "event_pre_post", "event_conversion", "event_summary",
              "stream_table"]

    @property
    def stream_table(self) -> DataFrame:
        from gatewise.plans.registry import _stream_table
        return _stream_table(self.spark, self.sf_dir)

    def stage_all(self, on_layer: Callable[[str, float], None] | None = None) -> None:
        """Stage every layer in build order, reporting (layer, seconds)."""
        import time
        for name in self.LAYERS:
            t0 = time.perf_counter()
            getattr(self, name)
            if on_layer:
                on_layer(name, time.perf_counter() - t0)
