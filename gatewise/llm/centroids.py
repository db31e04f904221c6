"""Centroid clustering with heap-ordered bounds, in exact integers.

Lloyd's rounds spend their time on vectors that stay where they are. A vector
that has just been scanned knows the gap between its second nearest and its
nearest centroid. It can only change sides after the centroids have moved by
that much, so each cluster keeps a heap of its vectors' gaps, each offset by
the drift that the cluster had accumulated when the gap was measured. A round
pops those whose gap has expired, scans them exactly and pushes them with
their new gap; all others are not touched. The cluster sums follow from the
vectors that moved.

Vectors are packed into blocks (one row each, with the heaps of its vectors);
every round reads the blocks of the round before and writes its own, in the
folder that all executors share. The driver holds the centroids, their sums
and their drift, whose size does not depend on the input.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewise.llm.common import discard, ship, stage
from gatewise.sources.tables import scratch_path

#: Components of a vector, centroids, rounds and the seed of the first centroids.
DIMS, CENTROIDS, ROUNDS, SEED = 64, 8, 10, 3
#: A component x counts as floor(SCALE * x), held within -LIMIT to LIMIT.
SCALE, LIMIT = 1024, 1 << 27
#: Vectors of a block.
BLOCK = 4096
#: Up to this component, squared distances are exact in floating point.
EXACT = 1 << 22
#: A gap counts as expired a little early: room for the rounding of square roots.
ROOM = 1e-9


def usable(vector: Column, dims: int = DIMS) -> Column:
    """The vector has exactly ``dims`` components, none null or non-finite."""
    fits = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.coalesce((F.size(vector) == dims) & fits, F.lit(False))


def whole(vector: Column) -> Column:
    """Components as integers (array of long)."""
    return F.transform(vector, lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(x * SCALE))))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The integer vectors of the ``k`` rows with the smallest hash of their id."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = (vectors.select(order.alias("hash"), whole(F.col("vector")).alias("vector"))
            .orderBy(F.col("hash").asc_nulls_last(), "vector").limit(k).collect())
    return [r["vector"] for r in rows]


class Block:
    """Packed vectors, the cluster of each, and the clusters' heaps of (key, vector)."""

    def __init__(self, points: np.ndarray, k: int):
        self.points, self.k = points, k
        self.near = np.full(len(points), -1, dtype=np.int32)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(k)]

    def squares(self, which: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Exact squared distances of vectors to all centroids."""
        points = self.points[which]
        if max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT:
            x, c = points.astype(np.float64), centroids.astype(np.float64)
            far = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
            return far.astype(np.int64)
        return np.stack([((points.astype(np.int64) - c) ** 2).sum(1) for c in centroids], axis=1)

    def expired(self, drift: np.ndarray) -> np.ndarray:
        """Pop the vectors whose gap is used up."""
        if len(self.near) and self.near[0] < 0:  # no vector has been scanned
            return np.arange(len(self.near))
        out = []
        for heap, gone in zip(self.heaps, drift.tolist(), strict=True):
            while heap and heap[0][0] - gone <= ROOM * (abs(heap[0][0]) + 1):
                out.append(heapq.heappop(heap)[1])
        return np.array(out, dtype=np.int64)

    def advance(self, centroids: np.ndarray, drift: np.ndarray) -> np.ndarray:
        """Assign the vectors to ``centroids``; returns what that changes in
        the clusters' sums and, in the last column, their counts."""
        change = np.zeros((self.k, self.points.shape[1] + 1), dtype=np.int64)
        which = self.expired(drift)
        if not len(which):
            return change
        squares = self.squares(which, centroids)
        near = squares.argmin(axis=1).astype(np.int32)  # of equal distances the smaller number
        two = np.sqrt(np.partition(squares, 1, axis=1)[:, :2].astype(np.float64)) if self.k > 1 else None
        gaps = two[:, 1] - two[:, 0] if two is not None else np.full(len(which), np.inf)
        keys = (gaps + drift[near]).tolist()
        fresh: list[list[tuple[float, int]]] = [[] for _ in range(self.k)]
        for c, key, i in zip(near.tolist(), keys, which.tolist(), strict=True):
            fresh[c].append((key, i))
        for heap, new in zip(self.heaps, fresh, strict=True):
            if not heap:
                heap += new
                heapq.heapify(heap)
            else:
                for pair in new:
                    heapq.heappush(heap, pair)
        before = self.near[which]
        moved = before != near
        ones = np.hstack([self.points[which[moved]].astype(np.int64), np.ones((int(moved.sum()), 1), np.int64)])
        np.add.at(change, near[moved], ones)
        left = before[moved] >= 0
        np.subtract.at(change, before[moved][left], ones[left])
        self.near[which] = near
        return change

    def packed(self) -> dict:
        flat = [p for heap in self.heaps for p in heap]
        return {"data": self.points.tobytes(), "unit": self.points.dtype.itemsize, "near": self.near.tobytes(),
                "held": [len(h) for h in self.heaps],
                "keys": np.array([k for k, _ in flat], dtype=np.float64).tobytes(),
                "items": np.array([i for _, i in flat], dtype=np.int32).tobytes()}

    @classmethod
    def unpacked(cls, row: dict, dims: int, k: int) -> Block:
        block = cls(np.frombuffer(row["data"], dtype=f"i{row['unit']}").reshape(-1, dims), k)
        block.near = np.frombuffer(row["near"], dtype=np.int32).copy()
        pairs = list(zip(np.frombuffer(row["keys"]).tolist(), np.frombuffer(row["items"], dtype=np.int32).tolist(),
                         strict=True))
        at = 0
        for c, n in enumerate(row["held"]):  # a heap written in order is a heap when read
            block.heaps[c] = pairs[at:at + n]
            at += n
        return block


STATE = ["data", "unit", "near", "held", "keys", "items"]


def _arrow(ids: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(ids)), ("data", pa.binary()), ("unit", pa.int32()), ("near", pa.binary()),
                      ("held", pa.list_(pa.int32())), ("keys", pa.binary()), ("items", pa.binary()),
                      ("change", pa.list_(pa.int64()))])


def pack(vectors: DataFrame, dims: int, k: int) -> DataFrame:
    """Blocks of at most BLOCK vectors, none of them scanned; ``vectors`` has vec_id and vector (array of double)."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = (f"ids array<{kind}>, data binary, unit int, near binary, held array<int>, keys binary, items binary, "
              "change array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = _arrow(batch.schema.field(0).type)
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                points = np.clip(np.floor(np.clip(x, -LIMIT, LIMIT) * SCALE), -LIMIT, LIMIT).astype(np.int32)
                if np.abs(points).max() < 1 << 15:
                    points = points.astype(np.int16)
                row = Block(points, k).packed() | {"change": []}
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array([row[f.name]], f.type) for f in list(out)[1:]]], schema=out)

    return vectors.mapInArrow(run, schema)


def scanned(blocks: DataFrame, centroids: list[list[int]], drift: list[float]) -> DataFrame:
    """The blocks after a round against ``centroids``."""
    middle, gone = np.array(centroids, dtype=np.int64), np.array(drift)
    k, dims = middle.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1)
                row = part.select(STATE).to_pylist()[0]
                block = Block.unpacked(row, dims, k)
                change = block.advance(middle, gone)
                row = block.packed() | {"change": change.ravel().tolist()}
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array([row[f.name]], f.type) for f in list(batch.schema)[1:]]],
                    schema=batch.schema)

    return blocks.mapInArrow(run, blocks.schema)


def summed(blocks: DataFrame, cells: int) -> list[int]:
    """Sum of the blocks' ``change``, exact: one partial sum a task, then ``cells`` sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, dtype=np.int64)
        for batch in batches:
            total += batch.column(0).flatten().to_numpy().reshape(-1, cells).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells, dtype=np.int32)), pa.array(total)],
                                         names=["cell", "part"])

    parts = blocks.select("change").mapInArrow(run, "cell int, part long")
    out = [0] * cells
    for row in parts.groupBy("cell").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("n")).collect():
        out[row["cell"]] = int(row["n"])
    return out


def moved_centroids(centroids: list[list[int]], sums: list[int]) -> list[list[int]]:
    """Floor of the mean of every cluster; an empty one keeps its centroid."""
    width = len(centroids[0]) + 1
    out = []
    for c, old in enumerate(centroids):
        *total, count = sums[c * width:(c + 1) * width]
        out.append([x // count for x in total] if count else old)
    return out


def drifted(drift: list[float], old: list[list[int]], new: list[list[int]]) -> list[float]:
    """Accumulated drift of every cluster: how far its centroid went, and the
    farthest that any other one went."""
    far = [math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b, strict=True))) * (1 + 1e-12)
           for a, b in zip(old, new, strict=True)]
    return [d + far[c] + max((f for j, f in enumerate(far) if j != c), default=0.0) for c, d in enumerate(drift)]


def assigned(blocks: DataFrame, centroids: list[list[int]], drift: list[float], kind: str) -> DataFrame:
    """vec_id, cluster and squared distance of every vector after a last round."""
    middle, gone = np.array(centroids, dtype=np.int64), np.array(drift)
    k, dims = middle.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1)
                block = Block.unpacked(part.select(STATE).to_pylist()[0], dims, k)
                block.advance(middle, gone)
                off = block.points.astype(np.int64) - middle[block.near]
                yield pa.RecordBatch.from_arrays([part.column(0).flatten(), pa.array(block.near),
                                                  pa.array((off * off).sum(axis=1))],
                                                 names=["vec_id", "cluster", "distance"])

    return blocks.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every usable vector.

    Null vectors and those with another number of components, a null or a
    non-finite one are left out. A component beyond LIMIT / SCALE (2**17) counts as
    that bound. Repeated rows are vectors of their own; of rows with one id the
    smaller vector is the earlier first centroid, and rows without an id are
    clustered but come last among the first centroids. Fewer than ``k``
    vectors make fewer clusters; no usable vector gives an empty result. Sums
    of squared distances beyond 64 bits are null.
    """
    spark = vectors.sparkSession
    ship(spark)
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    rows = rows.where(usable(F.col("vector"), dims))
    centroids = first_centroids(rows, k, seed)
    if not centroids:
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, "
                                         "inertia long, centroid_sha256 string")
    k = len(centroids)
    drift, sums = [0.0] * k, [0] * (k * (dims + 1))
    path, blocks = None, pack(rows, dims, k)
    for _ in range(rounds):
        before, path = path, scratch_path(spark, "centroids")
        scanned(blocks, centroids, drift).write.parquet(path)
        blocks = spark.read.schema(blocks.schema).parquet(path)
        if before:
            discard(spark, before)  # its blocks are in the new table
        sums = [a + b for a, b in zip(sums, summed(blocks, len(sums)), strict=True)]
        new = moved_centroids(centroids, sums)
        drift, centroids = drifted(drift, centroids, new), new
    found = stage(assigned(blocks, centroids, drift, kind), "clustered")
    if path:
        discard(spark, path)
    per = {r["cluster"]: int(r["n"]) for r in
           found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}
    top = (1 << 63) - 1
    own = [per.get(c, 0) if per.get(c, 0) <= top else None for c in range(k)]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    every = sum(per.values())

    def pick(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)

    return found.select("vec_id", "cluster", "distance", pick(own, "long").alias("cluster_inertia"),
                        F.lit(every if every <= top else None).cast("long").alias("inertia"),
                        pick(names, "string").alias("centroid_sha256"))
