"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

A document becomes a few statistics of its whole text. Random cosine features
of the scaled statistics approximate a Gaussian kernel; every partition of the
labelled rows adds up its share of the normal equations, the summed matrix
(its size depends on the number of features only) is solved on the driver, and
a part of the labelled rows that the fit has not seen calibrates the ridge
score by isotonic regression over a fixed grid of score cells.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewise.llm.common import SLICE_ROWS, fold, fresh, id_and_text, ship, slices, stage, sum_vectors

#: Random features, seed, and the ridge weight: so much and so much per labelled row.
FEATURES, RANDOM_SEED, RIDGE, RIDGE_ROW = 256, 17, 0.3, 1e-4
#: Every fourth labelled row (by a hash of its id) calibrates instead of fitting.
CALIBRATION = 4
#: Ridge scores are calibrated on cells of 1/CELLS from LOW to HIGH.
CELLS, LOW, HIGH = 500, -1.0, 2.0
#: From this score on a document is predicted to be of quality 1.
THRESHOLD = 0.3

STATISTICS = ["log_words", "word_length", "distinct_words", "repeats_next", "top_word", "upper", "marks", "shouts",
              "bars", "digits", "lines", "beyond_ascii", "stops", "repeated_lines", "code", "long_words", "letters"]


def _bytes(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode(), dtype=np.uint8)


UPPER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LETTERS = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
MARKS = _bytes("#$%&*@^~+\\_`")
CODE = _bytes("{}<>[]=/;()")
DIGITS = _bytes("0123456789")


def statistics(text: str) -> list[float]:
    """The numbers named in STATISTICS, all finite; zeros for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    data = text.encode("utf-8")
    seen = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    size = len(data)
    counts = Counter(words)
    lines = text.split("\n")
    repeated = 0
    if len(lines) > 1:
        again = Counter(lines)
        repeated = sum(len(line) * k for line, k in again.items() if k > 1)
    letters = int(seen[LETTERS].sum())
    return [
        float(np.log1p(n)), size / n, len(counts) / n ** 0.8, sum(map(str.__eq__, words, words[1:])) / n,
        counts.most_common(1)[0][1] / n, int(seen[UPPER].sum()) / max(1, letters), int(seen[MARKS].sum()) / n,
        int(seen[33]) / n, int(seen[124]) / n, int(seen[DIGITS].sum()) / size, len(lines) / n,
        int(seen[128:].sum()) / size, int(seen[46]) / n, repeated / len(text), int(seen[CODE].sum()) / n,
        sum(k for w, k in counts.items() if len(w) > 20) / n, letters / size]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``stats`` (array of double) of every row."""
    rows = id_and_text(docs, id_col, text_col)
    schema = f"doc_id {rows.schema[0].dataType.simpleString()}, stats array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                stats = [statistics(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(stats, pa.list_(pa.float64()))],
                                                 names=["doc_id", "stats"])

    return rows.mapInArrow(run, schema)


@dataclass
class Model:
    """A fitted scorer; ``weights`` is None when there was nothing to learn from."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    at: np.ndarray | None = None
    value: np.ndarray | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Random cosine features of rows of statistics, with a last column of ones."""
        scaled = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.sqrt(2 / self.waves.shape[1]) * np.cos(scaled @ self.waves + self.phases)
        return np.hstack([waves, np.ones((len(stats), 1))])

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated scores from 0 to 1; 0.5 for all when nothing was learned."""
        if self.weights is None:
            return np.full(len(stats), 0.5)
        raw = self.ridge(stats)
        return np.clip(raw if self.at is None else np.interp(raw, self.at, self.value), 0.0, 1.0)


def blank(dims: int) -> Model:
    rng = np.random.default_rng(RANDOM_SEED)
    # the kernel's width: the root of the number of (scaled) statistics
    return Model(np.zeros(dims), np.ones(dims), rng.normal(size=(dims, FEATURES)) / np.sqrt(dims),
                 rng.uniform(0, 2 * np.pi, FEATURES))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def isotonic(cells: np.ndarray, counts: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: centres of the pools and their shares of hits."""
    pools: list[list[float]] = []
    for c, n, h in zip(cells, counts, hits, strict=True):
        pools.append([c * n, n, h])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([c / n for c, n, _ in pools]), np.array([h / n for _, n, h in pools])


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Learn from the stored ``stats`` and the 0/1 column ``label`` of ``labels``.

    Only ids outside fold 0 are used; null labels are left out; a doc_id that
    occurs several times on either side counts once per match. No class or
    one class only: the model knows nothing, or gives that class.
    """
    known = labels.select(F.col("doc_id").alias("l_id"), F.col(f"`{label}`").cast("double").alias("y")).where(
        F.col("y").isNotNull() & (fold(F.col("l_id")) != 0))
    used = F.xxhash64("doc_id", F.lit("calibrate")) % CALIBRATION
    rows = stage(stats.join(known, stats["doc_id"] == known["l_id"])
                 .select((used == 0).alias("later"), "stats", "y"), "labelled")
    dims = len(STATISTICS)
    model = blank(dims)
    fitted = rows.where(~F.col("later"))
    moments = fitted.agg(F.count("*"), *[f(F.col("stats")[i]) for i in range(dims) for f in (F.avg, F.stddev_pop)]).first()
    if not moments[0]:
        return model
    model.mean = np.array(moments[1::2], dtype=float)
    model.scale = np.maximum(np.array(moments[2::2], dtype=float), 1e-6)

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z = model.features(matrix(batch.column(0), dims))
            y = batch.column(1).to_numpy(zero_copy_only=False)
            total += z.T @ np.hstack([z, y[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()),
                                          pa.array(list(total), pa.list_(pa.float64()))], names=["key", "values"])

    parts = fitted.select("stats", "y").mapInArrow(normal, "key int, values array<double>")
    system = np.zeros((FEATURES + 1, FEATURES + 2))
    for row in sum_vectors(parts).collect():  # FEATURES + 1 rows, whatever the input
        system[row["key"]] = row["values"]
    gram = system[:, :-1] + (RIDGE + RIDGE_ROW * moments[0]) * np.eye(FEATURES + 1)
    model.weights = np.linalg.solve(gram, system[:, -1])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.ridge(matrix(batch.column(0), dims)), LOW, HIGH)
            yield pa.RecordBatch.from_arrays([pa.array(np.round(raw * CELLS).astype(np.int32)), batch.column(1)],
                                             names=["cell", "y"])

    curve = (rows.where("later").select("stats", "y").mapInArrow(cells, "cell int, y double")
             .groupBy("cell").agg(F.count("*").alias("n"), F.sum("y").alias("hits")).collect())  # at most 1501 rows
    if curve:
        table = np.array(sorted((r["cell"], r["n"], r["hits"]) for r in curve), dtype=float)
        model.at, model.value = isotonic(table[:, 0] / CELLS, table[:, 1], table[:, 2])
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``stats``."""
    schema = f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(matrix(batch.column(1), len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())],
                                             names=["doc_id", "score"])

    scored = stats.select("doc_id", "stats").mapInArrow(run, schema)
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def statistics_column(text: Column) -> Column:
    """The statistics of a text column (null text: as empty), a slice of rows at a time."""
    @F.arrow_udf("array<double>")
    def of(texts: pa.Array) -> pa.Array:
        found = (statistics(t or "") for at in range(0, len(texts), SLICE_ROWS)
                 for t in texts.slice(at, SLICE_ROWS).to_pylist())
        flat = np.fromiter(chain.from_iterable(found), float, len(texts) * len(STATISTICS))
        return pa.ListArray.from_arrays(pa.array(range(0, len(flat) + 1, len(STATISTICS)), pa.int32()), pa.array(flat))

    return of(text)


def score_column(model: Model, stats: Column) -> Column:
    """The score of a column of statistics, row by row."""
    @F.arrow_udf("double")
    def scores(rows: pa.Array) -> pa.Array:
        return pa.array(model.score(matrix(rows, len(STATISTICS))), pa.float64())

    return scores(stats)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Fit on the labelled rows and score every row of ``docs``.

    Returns doc_id, held_out, score (0 to 1, higher: label 1 likelier) and
    predicted. Null texts count as empty; empty texts get the score that their
    zero statistics get. Each repeated row gets its own (equal) score.
    """
    stats = stage(document_statistics(docs, id_col, text_col), "statistics")
    return score(stats, fit(stats, labels, label))


def keep_good(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of at least THRESHOLD, all columns kept.

    The statistics are computed once and stored beside their rows; the fit and
    the scores read those.
    """
    ship(docs.sparkSession)
    found = fresh(docs, "quality_statistics")
    known = stage(docs.withColumn(found, statistics_column(F.col(f"`{text_col}`"))), "quality")
    model = fit(known.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(found).alias("stats")), labels, label)
    return known.where(score_column(model, F.col(found)) >= THRESHOLD).drop(found)
