"""JSON record stream into a table (Structured Streaming).

``{"date_time": "YYYY-MM-DD HH:MM:SS", "ID": n}`` records are decoded with an
explicit schema; a time that does not parse falls back to the load time and
is flagged; undecodable records are kept as kind bad instead of stopping the
stream. Each micro-batch is a slice that one commit makes visible, so a batch
replayed after a failure replaces its first attempt (checkpointed offsets +
idempotent sink = effectively once); runs of small batches are merged.

Sources: a Kafka topic (``format("kafka")``; the connector jar must be on
the classpath) or a folder of JSON-lines files (tests).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from gatewise.sources.versioned import SliceTable

RECORD_SCHEMA = T.StructType([
    T.StructField("date_time", T.StringType(), True),
    T.StructField("ID", T.LongType(), True),
])
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Read from the earliest offset; how much one micro-batch takes is the caller's
# choice (``maxOffsetsPerTrigger``), as it depends on the cluster.
KAFKA_DEFAULTS = {"startingOffsets": "earliest"}


def kafka_source(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Stream of message values (as text) from a Kafka topic."""
    opts = {**KAFKA_DEFAULTS, **options, "kafka.bootstrap.servers": servers, "subscribe": topic}
    return (spark.readStream.format("kafka").options(**opts).load()
            .select(F.col("value").cast("string").alias("value")))


def to_records(df: DataFrame, key: str | None = None, order: list[str] | None = None) -> DataFrame:
    """Rows -> topic records: ``value`` = JSON of all columns (times as
    'YYYY-MM-DD HH:MM:SS'), optional ``key`` column as text.

    A topic keeps the order of a key's records only as they were sent. With
    ``order`` (columns, then all others as tie-break) the records of a key
    come together in one task, sorted, and ``value`` gets ``seq``, the record's
    number within the key from 0: a consumer sees gaps and repeats by it. A
    key's records then go through one task, as they go to one topic partition.
    """
    cols = [F.date_format(F.col(f.name), TIME_FORMAT).alias(f.name)
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(f.name)
            for f in df.schema.fields]
    named = [F.col(key).cast("string").alias("key")] if key else []
    if not order:
        return df.select(F.to_json(F.struct(*cols)).alias("value"), *named)
    if not key:
        raise ValueError("an order needs a key: a topic has none across its partitions")
    within = Window.partitionBy(key).orderBy(*order, *[c for c in df.columns if c not in (key, *order)])
    return (df.withColumn("_seq", F.row_number().over(within) - 1)   # shuffles by key, sorts by key and order
            .select(F.to_json(F.struct(*cols, F.col("_seq").cast("long").alias("seq"))).alias("value"), *named))


def write_topic(df: DataFrame, servers: str, topic: str, key: str | None = None, order: list[str] | None = None) -> None:
    """Publish ``df`` to a Kafka topic (acks=all, idempotent producer), a key's
    records in ``order``; needs the Kafka connector on the classpath."""
    (to_records(df, key, order).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic)
     .option("kafka.acks", "all").option("kafka.enable.idempotence", "true").save())


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of JSON-lines text from a folder (new files are new records);
    a micro-batch takes all new files unless the caller sets a limit."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def decode(values: DataFrame) -> DataFrame:
    """Text -> (date_time, ID, time_was_defaulted, _bad, _raw)."""
    rec = F.from_json(F.col("value"), RECORD_SCHEMA)
    # the exact format decides validity; the wall-clock value is taken without
    # any session time zone (a zoned parse could shift DST-gap times)
    valid = F.try_to_timestamp(rec["date_time"], F.lit(TIME_FORMAT)).isNotNull()
    parsed = F.when(valid, rec["date_time"].try_cast("timestamp_ntz"))
    return values.select(
        F.coalesce(parsed, F.current_timestamp().cast("timestamp_ntz")).alias("date_time"),
        rec["ID"].alias("ID"),
        parsed.isNull().alias("time_was_defaulted"),
        (rec.isNull() | rec["ID"].isNull()).alias("_bad"),
        F.col("value").alias("_raw"))


#: The sink's columns: a batch's rows lie in the slice ``block`` of their batch
#: until a merge puts them into the slice of the first batch of a longer run.
SINK_SCHEMA = T.StructType([
    T.StructField("date_time", T.TimestampNTZType()), T.StructField("ID", T.LongType()),
    T.StructField("time_was_defaulted", T.BooleanType()), T.StructField("raw", T.StringType()),
    T.StructField("kind", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("block", T.LongType())])


@dataclass
class StreamTables:
    """Sink folder (a :class:`SliceTable` by block) and checkpoint."""
    table: str
    checkpoint: str


def sink_table(spark: SparkSession, path: str) -> SliceTable:
    return SliceTable(spark, path, SINK_SCHEMA, "block")


def append_batch(batch: DataFrame, batch_id: int, path: str, fanout: int = 10, levels: int = 3) -> None:
    """Add one batch to the sink by one commit. A batch that comes again
    replaces itself, so the table stays the same.

    Every ``fanout`` batches the blocks before the newest become one, every
    ``fanout ** 2`` batches ten such ones do, and so on up to ``levels``: a row
    is rewritten ``levels`` times at most, and n batches leave about
    ``fanout * levels + n / fanout ** levels`` blocks. A merge is one commit as
    well; it leaves the newest batch alone, the only one that can come again.
    Files of replaced blocks stay for readers until the next merge but one.
    """
    sink = sink_table(batch.sparkSession, path)
    sink.replace(batch.withColumn("batch_id", F.lit(batch_id)).withColumn("block", F.lit(batch_id)), [batch_id])
    span = max((fanout ** i for i in range(1, levels + 1) if batch_id and batch_id % fanout ** i == 0), default=0)
    if not span:
        return
    first = batch_id - span
    blocks = [r["slice"] for r in sink.live().where(F.col("slice").between(first, batch_id - 1)).collect()]  # few
    if len(blocks) > 1:
        merged = sink.read().where(F.col("block").between(first, batch_id - 1))
        sink.replace(merged.withColumn("block", F.lit(min(blocks))), blocks)
    sink.vacuum(keep=2 * fanout)


def start_ingest(values: DataFrame, tables: StreamTables, trigger: dict | None = None) -> StreamingQuery:
    """Q36: decode every micro-batch and add it to the sink: decoded rows as
    kind good, undecodable records as kind bad."""
    decoded = decode(values).select(
        "date_time", "ID", "time_was_defaulted",
        F.when(F.col("_bad"), F.col("_raw")).alias("raw"),
        F.when(F.col("_bad"), "bad").otherwise("good").alias("kind"))

    writer = (decoded.writeStream.foreachBatch(lambda batch, batch_id: append_batch(batch, batch_id, tables.table))
              .option("checkpointLocation", tables.checkpoint))
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Decoded rows of the sink."""
    return sink_table(spark, path).read().where(F.col("kind") == "good").select("date_time", "ID", "time_was_defaulted")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Undecodable records of the sink, as received."""
    return (sink_table(spark, path).read().where(F.col("kind") == "bad")
            .select(F.col("raw").alias("value"), "batch_id"))


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows that the sink holds per batch, good and bad ones (batch_id, rows)."""
    return sink_table(spark, path).read().groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))


def latest_n(table: DataFrame, n: int = 10) -> DataFrame:
    """Q37: the newest ``n`` rows by ID, then by time (top-k; the limit is the feature)."""
    return table.orderBy(F.col("ID").desc(), F.col("date_time").desc(), F.col("time_was_defaulted")).limit(n)


def row_count(table: DataFrame) -> DataFrame:
    """Q37: stored row count."""
    return table.agg(F.count(F.lit(1)).alias("row_count"))


@dataclass
class Report:
    """What a run has done up to a moment (the reference's 10-second lines)."""
    elapsed_seconds: float
    batches: int
    consumed_rows: int
    rows_per_second: float


class ProgressTotals(StreamingQueryListener):
    """Running totals of every micro-batch of the queries of a session, and a
    report per query at least ``every`` seconds after the one before and at its
    end. ``recentProgress`` keeps only the latest progress; a listener sees all.

    Spark calls a listener after every batch, and now and then while a query
    is idle, so a report comes with the first such call once it is due.
    ``tell`` gets each report (say, a logger or a table writer); the reports
    of a run are kept too, see :meth:`reports`.
    """

    def __init__(self, every: float = 10.0, tell: Callable[[str, Report], None] | None = None,
                 clock: Callable[[], float] = time.monotonic):
        self.every, self.tell, self.clock = every, tell, clock
        self.seen: dict[str, dict[int, tuple[int, float]]] = {}   # run -> batch -> (rows, seconds)
        self.told: dict[str, list[Report]] = {}
        self.times: dict[str, tuple[float, float]] = {}           # run -> (start, latest report)
        self.ended: set[str] = set()

    def _report(self, run: str, due: float) -> None:
        now = self.clock()
        start, latest = self.times.setdefault(run, (now, now))
        if now - latest < due:
            return
        done = self.seen.get(run, {}).values()
        rows, elapsed = sum(n for n, _ in done), now - start
        report = Report(elapsed, len(done), rows, rows / elapsed if elapsed else 0.0)
        self.times[run] = (start, now)
        self.told.setdefault(run, []).append(report)
        if self.tell:
            self.tell(run, report)

    def onQueryStarted(self, event):
        run, now = str(event.runId), self.clock()
        self.seen.setdefault(run, {})
        self.times[run] = (now, now)

    def onQueryProgress(self, event):
        p = event.progress
        rows = int(p.numInputRows)
        if rows:
            seconds = rows / p.processedRowsPerSecond if p.processedRowsPerSecond else 0.0
            self.seen.setdefault(str(p.runId), {})[int(p.batchId)] = (rows, seconds)
        self._report(str(p.runId), self.every)

    def onQueryIdle(self, event):
        self._report(str(event.runId), self.every)

    def onQueryTerminated(self, event):
        self._report(str(event.runId), 0.0)
        self.ended.add(str(event.runId))

    def _await(self, query: StreamingQuery, seconds: float = 60.0) -> str:
        """The run of ``query``, once its end has arrived here (if it has ended)."""
        run, limit = str(query.runId), time.monotonic() + seconds
        while not query.isActive and run not in self.ended:
            if time.monotonic() > limit:
                raise RuntimeError("no end of the query was reported: was the listener added before it started?")
            time.sleep(0.05)
        return run

    def of(self, query: StreamingQuery) -> dict[int, tuple[int, float]]:
        """Rows and seconds of each batch of ``query``. Events arrive one
        after the other, the end of a run last, so all batches are known when
        the end of an ended run is."""
        return dict(self.seen.get(self._await(query), {}))

    def reports(self, query: StreamingQuery) -> list[Report]:
        """The reports of ``query``; the last one of an ended run holds its totals."""
        return list(self.told.get(self._await(query), []))


def stream_stats(batches: dict[int, tuple[int, float]], written: DataFrame, stored: DataFrame) -> DataFrame:
    """Q44: one row: batches, consumed_rows (as the query reports them),
    written_rows (good and bad, by batch), stored_rows (the decoded table's).
    ``written`` is :func:`read_counts` of the sink."""
    sunk = written.select(F.col("rows").alias("written_rows"), F.lit(0).cast("long").alias("stored_rows"))
    held = stored.select(F.lit(0).cast("long").alias("written_rows"), F.lit(1).cast("long").alias("stored_rows"))
    return sunk.unionByName(held).agg(
        F.coalesce(F.sum("written_rows"), F.lit(0)).alias("written_rows"),
        F.coalesce(F.sum("stored_rows"), F.lit(0)).alias("stored_rows")).select(
        F.lit(len(batches)).cast("long").alias("batches"),
        F.lit(sum(rows for rows, _ in batches.values())).cast("long").alias("consumed_rows"), "written_rows", "stored_rows")


def rate_report(batches: dict[int, tuple[int, float]]) -> str:
    """Rows per second of a run, for a log: a measurement, no checked result."""
    rows, seconds = (sum(x[i] for x in batches.values()) for i in (0, 1))
    return f"{rows} rows in {len(batches)} batches, {rows / seconds if seconds else 0.0:.0f} rows/s"
