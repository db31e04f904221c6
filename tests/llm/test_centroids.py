import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from gatewise.llm import centroids
from gatewise.llm.queries import QUERIES

from .conftest import SF, table

SCHEMA = "vec_id long, embedding array<double>, label string, cluster string, distance string"


def brute(rows, k=8, rounds=10, seed=3, dims=64):
    """Lloyd's rounds in plain Python integers, every vector against every centroid."""
    kept = [(i, [max(-1 << 27, min(1 << 27, math.floor(1024 * float(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    middle = [v for _, v in order[:k]]

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(middle)) for _, v in kept]

    for _ in range(rounds):
        where = [j for _, j in nearest()]
        for j in range(len(middle)):
            own = [v for (_, v), w in zip(kept, where) if w == j]
            if own:
                middle[j] = [sum(x) // len(own) for x in zip(*own)]
    last = nearest()
    per = [sum(d for d, j in last if j == c) for c in range(len(middle))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    fits = lambda n: n if n < 1 << 63 else None
    return sorted(((str(i), j, d, fits(per[j]), fits(sum(per)), names[j]) for (i, _), (d, j) in zip(kept, last)))


def got(df):
    return sorted((str(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"],
                   r["centroid_sha256"]) for r in df.collect())


def test_query_matches_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, "embeddings").collect()]
    found = QUERIES["op11_heap_bounds_centroids"](spark, SF)
    assert got(found) == brute(rows)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]


def test_ties_repeats_and_unusable_vectors(spark):
    rng = random.Random(3)
    corner = [[float(rng.randint(0, 1)) for _ in range(64)] for _ in range(6)]
    rows = [(i, rng.choice(corner)) for i in range(60)] + [(5, corner[0]), (5, corner[1]), (5, corner[1])]
    rows += [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [1.0] * 63 + [None]),
             (105, [1.0] * 63 + [float("nan")]), (106, [1.0] * 63 + [float("-inf")]), (None, corner[2]), (None, None)]
    df = spark.createDataFrame([(*r, "l", "c", "d") for r in rows], SCHEMA).repartition(5)
    assert got(centroids.cluster(df)) == brute(rows)


def test_few_and_no_vectors(spark):
    one = [(1, [0.25] * 64), (2, [-3.7] * 64), (2, [-3.7] * 64)]
    df = spark.createDataFrame([(*r, "l", "c", "d") for r in one], SCHEMA)
    found = centroids.cluster(df, rounds=3)
    assert got(found) == brute(one, rounds=3)
    assert got(centroids.cluster(df.where("vec_id = 1"), rounds=2)) == brute(one[:1], rounds=2)
    empty = centroids.cluster(df.where("vec_id = 9"))
    assert empty.collect() == [] and empty.columns == found.columns


def test_large_components_stay_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.randint(0, 7) for _ in range(64)]) for i in range(80)]
    rows.append((99, [1e300] * 64))
    df = spark.createDataFrame([(*r, "l", "c", "d") for r in rows], SCHEMA)
    want = brute(rows, rounds=4)
    assert got(centroids.cluster(df, rounds=4)) == want
    assert max(r[2] for r in want) > 1 << 53


def test_other_sizes_over_many_blocks(spark):
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(5, 3)) * 3
    rows = [(i, [float(x) for x in middle[i % 5] + rng.normal(size=3)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7)
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert got(centroids.cluster(df, k=5, rounds=6, seed=11, dims=3)) == brute(rows, 5, 6, 11, 3)


def test_text_ids(spark):
    df = spark.createDataFrame([(f"v{i}", [float(i % 7), float(i % 3)]) for i in range(30)],
                               "vec_id string, embedding array<double>")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert got(centroids.cluster(df, k=3, rounds=4, dims=2)) == brute(rows, 3, 4, dims=2)


def test_only_expired_gaps_are_scanned():
    rng = np.random.default_rng(6)
    points = np.concatenate([rng.integers(0, 40, (200, 4)), rng.integers(900, 960, (200, 4))]).astype(np.int32)
    block = centroids.Block(points, 2)
    middle = np.array([[10, 10, 10, 10], [900, 900, 900, 900]])
    block.advance(middle, np.zeros(2))
    heaps = [list(h) for h in block.heaps]
    assert all(h == sorted(h) or h[0] == min(h) for h in heaps)
    moved = middle + 5
    drift = centroids.drifted([0.0, 0.0], middle.tolist(), moved.tolist())
    assert not len(block.expired(np.array(drift)))  # every gap is far wider than the drift
    assert not block.advance(moved, np.array(drift)).any()
    assert len(block.expired(np.array([1e6, 0.0]))) == 200 and block.heaps[0] == []


def test_written_blocks_read_back():
    block = centroids.Block(np.arange(40, dtype=np.int16).reshape(10, 4), 3)
    block.advance(np.array([[0, 0, 0, 0], [20, 20, 20, 20], [40, 40, 40, 40]]), np.zeros(3))
    again = centroids.Block.unpacked(block.packed(), 4, 3)
    assert again.heaps == block.heaps and (again.near == block.near).all() and (again.points == block.points).all()


def test_helpers_in_spark_agree_with_the_packing(spark):
    df = spark.createDataFrame([([0.5, -0.0001, 3.25],), ([1e300, -1e300, 0.0],)], "v array<double>")
    rows = df.select(centroids.whole(F.col("v")).alias("w")).collect()
    assert [r["w"] for r in rows] == [[512, -1, 3328], [1 << 27, -1 << 27, 0]]
