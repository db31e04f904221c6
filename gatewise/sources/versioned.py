"""Versioned slices: a table whose slices change all at once.

Every write goes to a folder of its own (``data/version=N``, partitioned by
the slice column) and becomes visible by one rename: the commit ``commits/N``
appears, a small table with the live version of every slice. A reader takes
the newest commit and keeps, of all data, the rows whose slice lives in their
version. So a run that dies before the rename leaves the old slices as they
were, and one that dies after it has finished; a reader that started on the
old commit still finds its files, as they go only with :meth:`vacuum`.

Two writers cannot win the same number: the rename of the second one fails,
and it starts again on the newer commit. The commit is computed by a join of
the old one with the slices of the new data; the driver lists no slice.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Digits of a version in a commit's name, so that names sort as numbers.
DIGITS = 12
#: Rounds of a commit against other writers.
TRIES = 20


class Conflict(RuntimeError):
    """Other writers took every number that this one tried."""


class SliceTable:
    """A parquet table at ``path`` with slices named by ``slice_col`` of type ``kind``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, slice_col: str):
        self.spark, self.path, self.slice_col = spark, path.rstrip("/"), slice_col
        self.schema = T.StructType([f for f in schema.fields if f.name != "version"])
        self.kind = self.schema[slice_col].dataType

    # storage ------------------------------------------------------------------
    def _at(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def _numbers(self, folder: str) -> list[int]:
        """Numbers of the commits, or of the data versions, that exist."""
        store, at = self._at(f"{self.path}/{folder}")
        if not store.exists(at):
            return []
        names = [s.getPath().getName().removeprefix("version=") for s in store.listStatus(at)]
        return sorted(int(n) for n in names if n.isdigit())

    def version(self) -> int | None:
        """The newest commit, None for a table without one."""
        numbers = self._numbers("commits")
        return numbers[-1] if numbers else None

    def _commit(self, number: int) -> str:
        return f"{self.path}/commits/{number:0{DIGITS}d}"

    def live(self, version: int | None = None) -> DataFrame:
        """(slice, version) of every slice in a commit (default: the newest)."""
        version = self.version() if version is None else version
        kinds = T.StructType([T.StructField("slice", self.kind), T.StructField("version", T.LongType())])
        if version is None:
            return self.spark.createDataFrame([], kinds)
        return self.spark.read.schema(kinds).parquet(self._commit(version))

    # reading ------------------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a commit (default: the newest)."""
        number = self.version() if version is None else version
        columns = [F.col(f"`{f.name}`") for f in self.schema.fields]
        if number is None or number not in self._numbers("commits"):
            if version is not None:
                raise ValueError(f"{self.path} has no commit {version}")
            return self.spark.createDataFrame([], self.schema)
        live = self.live(number)
        used = [r["version"] for r in live.select("version").distinct().collect()]  # folders, not slices
        if not used:
            return self.spark.createDataFrame([], self.schema)
        rows = (self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("version", T.LongType())]))
                .option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/version={v}" for v in used]))
        live = live.select(F.col("slice").alias("_slice"), F.col("version").alias("_version"))
        # the slices are partitions: those that do not live are pruned, not read
        return rows.join(live, (rows[self.slice_col].eqNullSafe(live["_slice"])) & (rows["version"] == live["_version"]),
                         "left_semi").select(*columns)

    # writing ------------------------------------------------------------------
    def replace(self, df: DataFrame, slices: Iterable | None = None, max_records_per_file: int = 5_000_000) -> int:
        """Replace slices by ``df``, also by nothing; returns the new version.

        The named ``slices`` (None: every slice of the table) and those that
        ``df`` has rows for get what ``df`` holds. All other slices stay.
        """
        folder = self._write(df, max_records_per_file)
        return self._publish(folder, None if slices is None else list(slices), replaces=True)

    def append(self, df: DataFrame, max_records_per_file: int = 5_000_000) -> int:
        """Add slices; a slice that exists already is an error."""
        number = self._write(df, max_records_per_file)
        known = self.live().join(self._new(number), "slice", "left_semi").limit(1).collect()
        if known:
            raise ValueError(f"slice {known[0]['slice']!r} exists")
        return self._publish(number, [], replaces=True)

    def _write(self, df: DataFrame, max_records_per_file: int) -> int:
        """Write the new rows to a data version nobody reads yet."""
        number = max([-1, *self._numbers("data"), *self._numbers("commits")]) + 1
        store, _ = self._at(self.path)
        while True:  # claim the number by making its folder
            claim = self._at(f"{self.path}/data/.claim-{number}")[1]
            store.mkdirs(claim.getParent())
            if store.createNewFile(claim):
                break
            number += 1
        (df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])
         .write.option("maxRecordsPerFile", max_records_per_file).partitionBy(self.slice_col)
         .parquet(f"{self.path}/data/version={number}"))
        return number

    def _new(self, number: int) -> DataFrame:
        """Slices that a data version has rows for."""
        path = f"{self.path}/data/version={number}"
        rows = self.spark.read.schema(self.schema).parquet(path)
        return rows.select(F.col(f"`{self.slice_col}`").alias("slice")).distinct()

    def _publish(self, number: int, slices: list | None, replaces: bool) -> int:
        """Commit: the old slices that stay, and the new ones in their version."""
        new = self._new(number).withColumn("version", F.lit(number).cast("long"))
        for _ in range(TRIES):
            latest = self.version()
            commit = new
            if slices is not None:
                gone = new.select("slice")
                if slices:
                    named = self.spark.createDataFrame([(x,) for x in slices], T.StructType([T.StructField("slice", self.kind)]))
                    gone = gone.unionByName(named)
                old = self.live(latest) if latest is not None else self.live()
                gone = gone.select(F.col("slice").alias("_gone"))
                commit = old.join(gone, old["slice"].eqNullSafe(gone["_gone"]), "left_anti").unionByName(new)
            store, draft = self._at(f"{self.path}/drafts/{uuid.uuid4().hex}")
            commit.repartition(1).write.parquet(draft.toString())  # one small row per slice
            target = self._at(self._commit(0 if latest is None else latest + 1))[1]
            store.mkdirs(target.getParent())
            if not store.exists(target) and self._rename(store, draft, target):
                return 0 if latest is None else latest + 1
            store.delete(draft, True)
        raise Conflict(f"{self.path}: {TRIES} commits were taken by others")

    def _rename(self, store, draft, target) -> bool:
        """Make a draft the commit ``target``, unless another writer has been faster."""
        # a rename onto an existing folder would put the draft inside it
        marker = self._at(f"{target.getParent().toString()}/.claim-{target.getName()}")[1]
        return store.createNewFile(marker) and store.rename(draft, target)

    def vacuum(self, keep: int = 1) -> int:
        """Delete the data of versions that none of the ``keep`` newest commits
        uses, drafts left behind, and the commits before them. Returns the
        number of data versions deleted. Not while another run writes."""
        commits = self._numbers("commits")
        kept = commits[-keep:] if keep > 0 else []
        used = {r["version"] for c in kept for r in self.live(c).select("version").distinct().collect()}
        for c in commits[:-keep] if keep > 0 else commits:
            store, at = self._at(self._commit(c))
            store.delete(at, True)
        store, drafts = self._at(f"{self.path}/drafts")
        if store.exists(drafts):
            store.delete(drafts, True)
        dead = [n for n in self._numbers("data") if n not in used]
        for n in dead:
            store.delete(self._at(f"{self.path}/data/version={n}")[1], True)
        for folder in ("data", "commits"):   # a number is claimed once; older claims than the newest number do nothing
            self._drop_claims(folder, max([-1, *self._numbers(folder)]))
        return len(dead)

    def _drop_claims(self, folder: str, newest: int) -> None:
        store, at = self._at(f"{self.path}/{folder}")
        if not store.exists(at):
            return
        for status in store.listStatus(at):
            number = status.getPath().getName().removeprefix(".claim-")
            if number.isdigit() and status.isFile() and int(number) < newest:
                store.delete(status.getPath(), False)
