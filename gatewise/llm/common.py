"""Shared helpers of the training-data operators.

Conventions of every operator in this package:

- a null text counts as the empty text unless the operator says otherwise;
- extra columns of the input are ignored, or carried through untouched where
  the operator returns whole rows; columns are picked by name, and helper
  columns get names that the input does not use;
- repeated rows are separate rows: each gets its own output row;
- an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewise.session import ship
from gatewise.sources.tables import scratch_path

#: Rows of an Arrow batch that are turned into Python objects at once.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back: it is
    computed once, and a lost executor re-reads files instead of lineage."""
    ship(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package's own intermediate results that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), null texts as empty texts."""
    ship(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not use (in any letter case)."""
    used = {c.lower() for c in docs.columns}
    while name.lower() in used:
        name = f"_{name}"
    return name


def slices(batch, rows: int = SLICE_ROWS) -> Iterator:
    """Pieces of an Arrow record batch of at most ``rows`` rows."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5: remainder 0 marks held-out documents.

    A null id has no text; it counts as the empty text (crc32 0, held out).
    """
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def text_key(text: Column) -> Column:
    """Digest that identifies a text, for joins that must not move texts."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def keep_rows(docs: DataFrame, winners: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` named by ``winners`` (doc_id, text_sha256), each name once.

    Rows that repeat both id and text are combined before they are shuffled,
    so a row repeated very often does not meet in one task.
    """
    key, digest = fresh(docs, "winner_id"), fresh(docs, "winner_sha256")
    keyed = (docs.withColumn(key, F.col(f"`{id_col}`")).withColumn(digest, text_key(F.col(f"`{text_col}`")))
             .dropDuplicates([key, digest]))
    named = winners.select(F.col("doc_id").alias("w_id"), F.col("text_sha256").alias("w_sha"))
    hit = keyed[key].eqNullSafe(named["w_id"]) & (keyed[digest] == named["w_sha"])
    return keyed.join(named, hit, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def sum_vectors(parts: DataFrame) -> DataFrame:
    """Sum the equally long ``values`` (array of double) of each ``key``.

    Rows meet by key, and a task holds one running vector per key it owns, so
    any number of partial vectors is summed in the memory of the result.
    """
    import numpy as np
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        sums: dict = {}
        for batch in batches:
            for key, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                vector = values.values.to_numpy(zero_copy_only=False)
                if key in sums:
                    sums[key] += vector
                else:
                    sums[key] = vector.astype(np.float64)
        for key, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([key], batch.schema.field(0).type), pa.array([vector], pa.list_(pa.float64()))],
                names=["key", "values"])

    rows = parts.select("key", "values")
    return rows.repartition("key").mapInArrow(run, rows.schema)
