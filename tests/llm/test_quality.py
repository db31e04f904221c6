import zlib

import numpy as np

from gatewise.llm import quality
from gatewise.llm.queries import QUERIES

from .conftest import docs_df, table


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    pos = np.array(labels) == 1
    return (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in QUERIES["op10_fourier_quality"](spark, sf).collect()}
    assert len(got) == table(spark, "documents", sf).count()
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    held = [(r["quality"], got[r["doc_id"]]) for r in table(spark, "labels", sf).collect()
            if got[r["doc_id"]]["held_out"]]
    assert auc([r["score"] for _, r in held], [y for y, _ in held]) > 0.95
    assert np.mean([y == r["predicted"] for y, r in held]) > 0.93
    assert all(r["predicted"] == 1 for y, r in held if y == 1)


def test_partition_sums_give_the_ridge_solution(spark):
    """The distributed fit equals one made of all rows at once."""
    docs = table(spark, "documents", "/root/testdata/sf0.01").repartition(5)
    labels = table(spark, "labels", "/root/testdata/sf0.01")
    stats = quality.stage(quality.document_statistics(docs), "statistics")
    model = quality.fit(stats, labels)
    known = labels.where(quality.fold(labels["doc_id"]) != 0).selectExpr("doc_id AS l", "quality")
    later = quality.F.xxhash64("doc_id", quality.F.lit("calibrate")) % quality.CALIBRATION == 0
    rows = stats.join(known, stats["doc_id"] == known["l"]).select("stats", "quality", later.alias("later")).collect()
    x = np.array([r["stats"] for r in rows if not r["later"]])
    y = np.array([r["quality"] for r in rows if not r["later"]], dtype=float)
    z = model.features(x)
    weights = np.linalg.solve(z.T @ z + (quality.RIDGE + quality.RIDGE_ROW * len(y)) * np.eye(z.shape[1]), z.T @ y)
    assert np.allclose(z @ weights, model.ridge(x), atol=1e-6)


def test_features_approximate_the_gaussian_kernel():
    model = quality.blank(4)
    x = np.random.default_rng(0).normal(size=(40, 4))
    z = model.features(x)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * 4))
    assert np.abs(z @ z.T - kernel).mean() < 0.06


def test_isotonic_is_the_best_monotone_fit():
    at, value = quality.isotonic(np.array([1.0, 2, 3, 4]), np.array([1.0, 1, 2, 1]), np.array([0.0, 1, 1, 1]))
    assert np.allclose(value, [0, 2 / 3, 1]) and np.allclose(at, [1, 8 / 3, 4])


def test_awkward_rows(spark, awkward, awkward_rows):
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, None), (7, None, 1), (8, 1, 0), (8, 0, 0), (None, 1, 0), (10, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.classify(awkward, labels).collect()
    assert len(rows) == len(awkward_rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3, 4)}) == 1  # all without words
    assert len({r["score"] for r in rows if r["doc_id"] == 8}) == 1
    kept = quality.keep_good(awkward, labels)
    assert kept.columns == awkward.columns
    assert kept.count() == sum(r["predicted"] for r in rows)


def test_nothing_to_learn_from(awkward, awkward_rows, spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.classify(awkward, labels).collect()} == {0.5}
    assert quality.classify(nothing, labels).collect() == []
    assert quality.keep_good(nothing, labels).collect() == []


def test_scores_do_not_see_the_id_of_the_row(spark):
    labels = table(spark, "labels")
    text = table(spark, "documents").first()["text"]
    docs = docs_df(spark, [(i, text) for i in range(10)])
    assert len({r["score"] for r in quality.classify(docs.union(docs_df(spark, [(99, "x")])), labels)
                .where("doc_id < 99").collect()}) == 1
