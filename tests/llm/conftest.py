"""Small tables with every awkward case: nulls, empty and long texts, ties,
repeated rows, and extra columns whose names the operators use themselves."""

from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"
EXTRA = ["row_id", "fp", "part", "tie", "score", "shard", "recipe", "winner_id", "winner_sha256", "mix_words",
         "quality_score", "key", "values", "label", "slot"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def words(rng: random.Random, n: int, syllables: str = "an er in th on re st ou ly ed") -> str:
    parts = syllables.split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


def docs_df(spark, rows):
    """Rows of (doc_id, text) or (doc_id, text, lang) as a documents table with clashing extra columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or ""), *["x"] * len(EXTRA)) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def awkward_rows():
    rng = random.Random(5)
    base = words(rng, 120)
    long = words(rng, 30_000)
    rows = [(1, None), (2, ""), (3, None), (4, " \n\t "), (5, "one"), (6, "Ünï çödé ß 漢字"), (7, base), (8, base), (8, base),
            (9, base + " more"), (10, long), (11, long + " tail"), (None, base), (None, None), (12, "x" * 50_000),
            (13, "a\x00b c\x85d"), (14, "😀 <|endoftext|> It's 123"), (-15, words(rng, 60))]
    return rows


@pytest.fixture()
def awkward(spark, awkward_rows):
    return docs_df(spark, awkward_rows).repartition(3)


@pytest.fixture()
def nothing(spark):
    return docs_df(spark, [])


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")
