"""Language identification as inference of a mixture of languages.

Every word is one draw from a mixture of languages; its likelihood under a
language comes from the language's letter n-grams (the letter before and
letter, and the letter with both neighbours, word borders included).
Expectation-maximisation estimates a document's language proportions, for
growing sets of languages, and the set with the best penalised likelihood
wins. The document's language is the largest share of that set.

N-grams are counted in hashed tables of a fixed size, one per language, so a
worker's and the driver's memory follow the number of languages only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewise.llm.common import fold, id_and_text, slices, sum_vectors

#: Hash cells of the pair table and of the triple table of a language.
TABLE = 1 << 16
#: Cells that travel in one row when counts are summed.
BLOCK = 1 << 12
#: The tables are learned from about this many labelled documents of each
#: language, the ones with the smallest id hashes (all, if there are fewer).
FIT_DOCUMENTS = 10_000
SMOOTHING = 0.5
#: EM ends when no share moves by more than this, which it does at last.
STILL = 1e-4
#: A language more must raise the log-likelihood by PENALTY * log(words).
PENALTY = 4.0
UNDEFINED = "und"
#: Words whose likelihoods a worker keeps; past it the memory is emptied.
KEPT_WORDS = 200_000

WORD = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table cells of the pair and of the triple at every letter of ``words``
    (none empty), and where each word's letters begin."""
    joined = "\n" + "\n".join(words) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    letters = np.flatnonzero(codes[1:-1] != 10) + 1
    before, here, after = codes[letters - 1], codes[letters], codes[letters + 1]
    pair = (before * np.uint64(0x9E3779B97F4A7C15) + here) * np.uint64(0xC2B2AE3D27D4EB4F)
    triple = (pair ^ after) * np.uint64(0x165667B19E3779F9)
    shift = np.uint64(64 - TABLE.bit_length() + 1)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    return (pair >> shift).astype(np.int64), (triple >> shift).astype(np.int64), np.cumsum(lengths) - lengths


@dataclass
class Languages:
    """Learned languages in name order and their n-gram log-likelihoods."""

    names: list[str]
    tables: np.ndarray  # cells of both tables x languages
    kept: dict[str, int] = field(default_factory=dict)
    known: np.ndarray | None = None

    def likelihoods(self, words: list[str]) -> np.ndarray:
        """Log-likelihood of each word under each language."""
        pair, triple, starts = grams(words)
        return np.add.reduceat(self.tables[pair] + self.tables[TABLE + triple], starts, axis=0)

    def rows(self, counts: list[Counter]) -> None:
        """Make sure that every word of ``counts`` is kept."""
        met = set().union(*counts)
        new = list(met.difference(self.kept))
        if len(self.kept) + len(new) > KEPT_WORDS:
            self.kept, self.known, new = {}, None, list(met)
        if new:
            found = self.likelihoods(new)
            at = len(self.kept)
            self.kept.update(zip(new, range(at, at + len(new)), strict=True))
            if self.known is None:
                self.known = np.empty((max(KEPT_WORDS, len(new)), len(self.names)))
            self.known[at:at + len(new)] = found

    def predict(self, counts: Counter) -> tuple[str, float]:
        """Language of a document and its share; its words must be kept."""
        at = np.fromiter(map(self.kept.__getitem__, counts), dtype=np.int64, count=len(counts))
        often = np.fromiter(counts.values(), dtype=float, count=len(counts))
        likely = self.known[at]
        shares = mixture(likely, often)
        best = int(np.argmax(shares))
        return self.names[best], float(shares[best])


def expect(likely: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions of the columns of ``likely`` by EM, until they stand still, and the log-likelihood."""
    top = likely.max(axis=1, keepdims=True)
    odds = np.exp(likely - top)
    n = often.sum()
    shares = np.full(likely.shape[1], 1 / likely.shape[1])
    while True:
        weighted = odds * shares
        new = (often / weighted.sum(axis=1)) @ weighted / n
        far, shares = np.abs(new - shares).max(), new
        if far <= STILL:
            break
    return shares, float(often @ (np.log((odds * shares).sum(axis=1)) + top[:, 0]))


def mixture(likely: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Proportions of all languages; zero outside the chosen set, which grows in
    the order of the shares that all languages together get."""
    single = often @ likely
    order = np.argsort(-single, kind="stable")  # equal likelihoods: the first name
    chosen, shares, best = order[:1], np.ones(1), single[order[0]]
    n = often.sum()
    price = PENALTY * np.log(n + 1)
    if len(order) > 1:
        first, _ = expect(likely[:, order], often)
        by_share = order[np.argsort(-first, kind="stable")]
        for size in range(2, len(by_share) + 1):
            if first[by_share[size - 1]] * n < 0.5:  # it and those after it explain no whole word
                break
            trial, fit = expect(likely[:, by_share[:size]], often)
            if fit - price * (size - 1) > best:
                chosen, shares, best = by_share[:size], trial, fit - price * (size - 1)
    out = np.zeros(likely.shape[1])
    out[chosen] = shares
    return out


def learn(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
          fit_documents: int = FIT_DOCUMENTS) -> Languages:
    """Learn from texts with a language whose id is outside fold 0."""
    lang, key = F.col(f"`{lang_col}`"), F.col(f"`{id_col}`")
    usable = docs.where(lang.isNotNull() & (fold(key) != 0))
    # one row per language
    counts = usable.groupBy(lang.alias("lang")).agg(F.count("*").alias("n")).collect()
    names = sorted(r["lang"] for r in counts)
    if not names:
        return Languages([], np.zeros((2 * TABLE, 0)))
    share = F.element_at(F.create_map(*[x for r in counts for x in
                                        (F.lit(r["lang"]), F.lit(min(1.0, fit_documents / r["n"])))]), lang)
    draw = F.shiftrightunsigned(F.xxhash64(key, F.lit("fit")), 11).cast("double") / F.lit(float(1 << 53))
    rows = usable.where(draw < share).select(lang.alias("lang"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            by_lang: dict[str, Counter] = {}
            for part in slices(batch):
                for name, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    by_lang.setdefault(name, Counter()).update(words_of(text))
            for name, words in by_lang.items():
                if words:
                    pair, triple, _ = grams(list(words))
                    often = np.repeat(np.fromiter(words.values(), float, len(words)), list(map(len, words)))
                    table = tables.setdefault(name, np.zeros(2 * TABLE))
                    table += np.bincount(np.concatenate([pair, TABLE + triple]), np.concatenate([often, often]), 2 * TABLE)
        for name, table in tables.items():
            for at in range(0, 2 * TABLE, BLOCK):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{at // BLOCK} {name}"]), pa.array([table[at:at + BLOCK]], pa.list_(pa.float64()))],
                    names=["key", "values"])

    tables = np.zeros((2, TABLE, len(names)))
    for row in sum_vectors(rows.mapInArrow(count, "key string, values array<double>")).toLocalIterator():
        at, name = row["key"].split(" ", 1)
        which, at = divmod(int(at) * BLOCK, TABLE)
        tables[which, at:at + BLOCK, names.index(name)] = row["values"]
    tables += SMOOTHING
    tables = np.log(tables / tables.sum(axis=1, keepdims=True))
    return Languages(names, tables.reshape(2 * TABLE, len(names)))


def identify(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
             fit_documents: int = FIT_DOCUMENTS) -> DataFrame:
    """doc_id, held_out, lang_pred and score (0 to 1) of every row of ``docs``.

    The score is the predicted language's share of the document's words.
    Null texts and texts without letters are ``und`` with score 0, and so is
    everything if no labelled text exists. A prediction sees the text only.
    """
    model = learn(docs, lang_col, id_col, text_col, fit_documents)
    rows = id_and_text(docs, id_col, text_col)
    schema = f"doc_id {rows.schema[0].dataType.simpleString()}, lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                counts = [Counter(words_of(t)) for t in part.column(1).to_pylist()]
                out = [(UNDEFINED, 0.0)] * len(counts)
                if model.names:
                    model.rows([c for c in counts if c])
                    out = [model.predict(c) if c else (UNDEFINED, 0.0) for c in counts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([a for a, _ in out], pa.string()),
                     pa.array([min(1.0, b) for _, b in out], pa.float64())], names=["doc_id", "lang_pred", "score"])

    found = rows.mapInArrow(run, schema)
    return found.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")
