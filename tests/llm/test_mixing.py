import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from gatewise.llm import mixing
from gatewise.llm.queries import QUERIES

from .conftest import docs_df, words

SF = "/root/testdata/sf0.01"


def test_expected_tokens_meet_the_targets(spark):
    rows = QUERIES["op6_soft_membership_mixing"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    total = sum(r["tokens"] for r in rows)
    for domain, share in mixing.TARGETS.items():
        have = sum(r["rate"] * r["tokens"] * r["posterior"][domain] for r in rows)
        assert abs(have / total - share) < 0.002
    assert all(r["rate"] >= 0 and 0 <= r["copies"] - int(r["rate"]) <= 1 for r in rows)
    labels = {r["doc_id"]: r["domain"] for r in spark.read.parquet(f"{SF}/labels.parquet")
              .select("doc_id", mixing.domain_of_labels().alias("domain")).collect()}
    hits = [r["domain"] == labels[r["doc_id"]] for r in rows if r["doc_id"] in labels]
    assert np.mean(hits) > 0.85


def brute_rates(p, t, targets, rounds=3000):
    """Plain projected gradient in the metric of the tokens, in numpy."""
    goal = t.sum() * np.array(targets) / np.sum(targets)
    inverse = np.linalg.pinv((p * t[:, None]).T @ p, rcond=1e-9)
    r = np.ones(len(p))
    for _ in range(rounds):
        r = np.maximum(0, r - p @ (inverse @ ((r * t) @ p - goal)))
    return r


def test_solution_matches_numpy(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3, 0.3, 0.3], 200)
    t = rng.integers(0, 500, 200)
    df = mixing.stage(spark.createDataFrame([(p[i].tolist(), int(t[i])) for i in range(200)], "c array<double>, n long"), "m")
    for targets in ([0.2, 0.3, 0.5], [0.0, 0.5, 0.5]):
        steps, off = mixing.solve(df, targets, "c", "n")
        got = np.array([r["r"] for r in df.select(mixing.rate(F.col("c"), steps).alias("r"), "c", "n").collect()])
        rows = df.collect()
        pp, tt = np.array([r["c"] for r in rows]), np.array([r["n"] for r in rows])
        want = brute_rates(pp, tt, targets)
        assert (got >= 0).all()
        assert np.abs((got * tt) @ pp - (want * tt) @ pp).max() < 0.01 * tt.sum()


def test_awkward_rows(spark, awkward, awkward_rows):
    labelled = spark.createDataFrame([(5, "a"), (6, "b"), (7, "a"), (8, "b"), (8, "a"), (None, "a"), (10, None), (12, "zz")],
                                     "doc_id long, domain string")
    rows = mixing.mix(awkward, labelled, {"a": 1.0, "b": 1.0}).collect()
    assert len(rows) == len(awkward_rows)
    assert all(r["tokens"] == 0 for r in rows if r["doc_id"] in (1, 2, 3, 4))
    assert all(abs(sum(r["posterior"].values()) - 1) < 1e-9 and r["rate"] >= 0 for r in rows)
    out = mixing.resample(awkward, labelled, {"a": 1.0, "b": 1.0})
    assert out.columns == awkward.columns
    want = Counter()
    for r in rows:
        want[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in out.collect()) == +want


def test_no_labels_and_no_rows(spark, awkward, nothing):
    none = spark.createDataFrame([], "doc_id long, domain string")
    rows = mixing.mix(awkward, none, {"a": 1.0, "b": 1.0}).collect()
    assert all(abs(r["rate"] - 1) < 1e-6 and r["copies"] in (0, 1) for r in rows)
    assert mixing.mix(nothing, none, {"a": 1.0, "b": 1.0}).collect() == []
    assert mixing.resample(nothing, none, {"a": 1.0}).collect() == []


def test_posteriors_separate_what_words_separate(spark):
    rng = random.Random(4)
    rows = [(i, words(rng, 40, "ka to mi" if i % 4 else "ber und sch")) for i in range(200)]
    labelled = spark.createDataFrame([(i, "x" if i % 4 else "y") for i in range(0, 200, 2)], "doc_id long, domain string")
    got = mixing.mix(docs_df(spark, rows), labelled, {"x": 0.5, "y": 0.5}).collect()
    assert all(r["domain"] == ("x" if r["doc_id"] % 4 else "y") for r in got)
    copied = Counter()
    for r in got:
        copied[r["domain"]] += r["copies"] * r["tokens"]
    assert 0.8 < copied["x"] / copied["y"] < 1.25
