"""Table reads and writes: slice-replacing writer, string ingest, audit, copy.

Writes are whole-DataFrame distributed writes; nothing is batched through
the driver. Replacing a slice (the reference's "delete where key, insert") is
a dynamic partition overwrite on the slice column, which swaps exactly the
partitions present in the new data and is idempotent on rerun.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatewise.session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def write_slices(df: DataFrame, path: str, slice_col: str | list[str], add_batch_time: bool = True,
                 files_per_slice: int | None = None, max_records_per_file: int = 5_000_000,
                 sort_within: list[str] | None = None) -> None:
    """Replace the slices (partitions of ``slice_col``) present in ``df``.

    Rows are not funnelled into one task per slice (a day can be terabytes):
    each task writes its own files for the slices it holds, capped at
    ``max_records_per_file`` rows per file. With ``files_per_slice`` the rows
    are first spread over that many hash buckets per slice, bounding the file
    count per slice instead. ``sort_within`` orders rows inside each file
    (the reference's ordered table), which tightens parquet min/max statistics.
    """
    cols = [slice_col] if isinstance(slice_col, str) else list(slice_col)
    out = df.withColumn("batch_time", F.current_timestamp()) if add_batch_time else df
    if files_per_slice:
        spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_slice))
        out = out.repartition(*[F.col(c) for c in cols], spread)
    if sort_within:
        out = out.sortWithinPartitions(*cols, *sort_within)
    (out.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*cols).parquet(path))


def _status(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, time changed) of what lies directly under ``path``; nothing if it is absent."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return []
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in store.listStatus(folder))


def input_stamp(spark: SparkSession, path: str) -> str:
    """Digest of the files of a table: it changes when the table is replaced."""
    return hashlib.sha256(repr(_status(spark, path)).encode()).hexdigest()


def replace_slices(df: DataFrame, path: str, slice_col: str, slices: Iterable | None = None, **options) -> None:
    """Replace slices by ``df``, also by nothing: of the named ``slices`` (None:
    of the whole table), those that ``df`` has no row for are removed.

    The new rows are written first; a slice whose files are the same
    afterwards got none, and goes.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    named = None if slices is None else {_folder(spark, slice_col, x) for x in slices}
    old = {name for name, _, _ in _status(spark, path) if name.startswith(f"{slice_col}=")}
    before = {x: _status(spark, f"{path}/{x}") for x in (old if named is None else old & named)}
    write_slices(df, path, slice_col, **options)
    jvm = spark._jvm
    for name, files in before.items():
        if _status(spark, f"{path}/{name}") == files:
            folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _folder(spark: SparkSession, slice_col: str, value: object) -> str:
    """Folder name of a partition value, escaped as Spark writes it."""
    if value is None or value == "":
        return f"{slice_col}=__HIVE_DEFAULT_PARTITION__"
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{slice_col}={escape(str(value))}"


def truncate_and_load(df: DataFrame, path: str) -> None:
    """Replace the whole table (the reference's ``truncate`` + insert)."""
    df.write.mode("overwrite").parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back, cutting
    lineage (survives executor loss, unlike a local checkpoint)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def create_table_if_absent(spark: SparkSession, name: str, schema: T.StructType, path: str,
                           partition_by: list[str] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` a parquet table at ``path`` (catalog entry only)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{part} LOCATION '{path}'")


def insert_by_name(df: DataFrame, table: str) -> None:
    """Append ``df`` to a catalog table matching columns by name (extra columns
    are dropped, missing ones fail), like the reference's insert-select."""
    target = df.sparkSession.table(table).columns
    df.select(*target).write.insertInto(table)   # positional, after selecting by name


#: CSV that gives every text back: blanks kept, quotes doubled, line ends and
#: backslashes inside quotes left alone. A file is then read by one task.
CSV_WRITE = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"',
             "quoteAll": "true"}
CSV_READ = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"',
            "multiLine": "true"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, time_format: str = "yyyy-MM-dd HH:mm:ss",
             date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Read a CSV dimension with an explicit schema; timestamp and date
    columns are parsed with the given formats (no inference)."""
    return (spark.read.options(**CSV_READ).option("timestampNTZFormat", time_format)
            .option("timestampFormat", time_format).option("dateFormat", date_format)
            .schema(schema).csv(path))


def write_csv(df: DataFrame, path: str, time_format: str = "yyyy-MM-dd HH:mm:ss") -> None:
    """Write CSV with a header, timestamps formatted as text with ``time_format``."""
    out = df.select([F.date_format(F.col(f.name), time_format).alias(f.name)
                     if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(f.name)
                     for f in df.schema.fields])
    out.write.mode("overwrite").options(**CSV_WRITE).csv(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Write ``df`` as text CSV with a header (every value as its string form)."""
    (df.select([F.col(c).cast("string").alias(c) for c in df.columns])
     .write.mode("overwrite").options(**CSV_WRITE).csv(path))


def string_ingest(spark: SparkSession, path: str) -> DataFrame:
    """Q38: read a CSV folder with every column as text; NULL -> ''.

    Column names come from the header; no type inference (the reference's
    spreadsheet loader reads ``dtype=str`` and fills NULL with '')."""
    header = spark.read.options(**CSV_READ).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
    df = spark.read.options(**CSV_READ).schema(schema).csv(path)
    return df.select([F.coalesce(F.col(c), F.lit("")).alias(c) for c in header])


def ingest_audit(source: DataFrame, stored: DataFrame) -> DataFrame:
    """Q39: one-row load report: source rows, stored rows, complete flag."""
    tagged = (source.select(F.lit(1).alias("_src"))
              .unionByName(stored.select(F.lit(0).alias("_src"))))
    return (tagged.agg(F.sum("_src").cast("long").alias("source_rows"),
                       F.sum(1 - F.col("_src")).cast("long").alias("stored_rows"))
            .select(F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
                    F.coalesce("stored_rows", F.lit(0)).alias("stored_rows"))
            .withColumn("complete", F.col("source_rows") == F.col("stored_rows")))


def ingest_preview(stored: DataFrame, n: int = 3) -> DataFrame:
    """Q39: the first ``n`` rows, by all columns, of the first three columns (the limit is the report)."""
    return stored.orderBy(*stored.columns).select(*stored.columns[:3]).limit(n)


SLIM_COLUMNS = ["profile_id", "region_id", "region_name", "capture_time", "age", "member_tier", "gender"]


def slim_copy(captures: DataFrame, path: str, loaded_at: Column | None = None) -> DataFrame:
    """Q40: full reload of the narrow capture projection (overwrite), with the
    time of the load as its eighth column ``batch_time``: ``loaded_at``, or
    the current time (one value per load)."""
    loaded_at = F.current_timestamp() if loaded_at is None else loaded_at
    truncate_and_load(captures.select(*SLIM_COLUMNS, loaded_at.alias("batch_time")), path)
    return captures.sparkSession.read.parquet(path)
