"""Quality rules by distribution divergence.

A document's histogram of character classes and its histogram of common words
are compared with references, one pair per language, by the Jensen-Shannon
distance (0: equal, 1: nothing in common). The references come from the corpus
itself: of every language the words that most documents hold, and the mean
shares of those words and of the character classes over all its documents, in
whole millionths, so that their sum does not depend on the order of the rows.
A document passes if one language is near by both histograms; a histogram of
fewer characters or words than a guard says nothing and passes.

Before that come plain rules: too few words, or too many of them in repeated
five-word windows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewise.llm.common import id_and_text, ship, slices, stage

#: Bytes between words (where ``bytes.split`` cuts), and the marks that the base rules count.
BLANKS, SYMBOLS = list(b" \t\n\v\f\r"), list(b"#*$%&|<>")
#: Fewer words, or a larger share (in hundredths) of words in repeated windows, fail the base rules.
LEAST_WORDS, REPEATED_SHARE, WINDOW = 10, 20, 5
#: Common words of a language, and the words of a document that contributes to the references.
COMMON, REFERENCE_WORDS = 100, 50
#: Guards: characters and words below which a histogram is not compared.
LEAST_CHARS, LEAST_COMPARED = 100, 50
#: Largest squared distances of a document that passes: for a very long text,
#: and what is added for the chance of a short one, divided by its length.
FAR_CLASSES, CLASS_CHANCE = 0.02, 9.6
FAR_WORDS, WORD_CHANCE = 0.105, 5.5
#: Shares are whole numbers of this unit.
UNIT = 1_000_000
#: (language, word) entries that a task counts before it sends them on.
HELD_WORDS = 300_000
PAIR = 1 << 62

CLASSES = ["lower", "upper", "digit", "space", "line", "stop", "quote", "symbol", "mark", "control",
           "letters_c2", "letters_d0", "wide", "beyond"]


def byte_classes() -> np.ndarray:
    """Class of every byte of UTF-8 (its first byte stands for a character); -1 for bytes that follow."""
    out = np.full(256, CLASSES.index("control"))
    names = {"lower": range(ord("a"), ord("z") + 1), "upper": range(ord("A"), ord("Z") + 1),
             "digit": range(ord("0"), ord("9") + 1), "space": b" \t", "line": b"\n\r", "stop": b".,;:!?", "quote": b"\"'()-",
             "symbol": b"#*$%&|<>", "mark": b"+/=@[\\]^_`{}~", "letters_c2": range(0xC2, 0xD0),
             "letters_d0": range(0xD0, 0xE0), "wide": range(0xE0, 0xF0), "beyond": range(0xF0, 0xF8)}
    for name, codes in names.items():
        out[list(codes)] = CLASSES.index(name)
    out[0x80:0xC0] = -1
    return out


BYTE_CLASS = byte_classes()


def byte_counts(data: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)


def class_counts(seen: np.ndarray) -> np.ndarray:
    """Characters of each class, from the counts of the bytes."""
    return np.bincount(BYTE_CLASS[BYTE_CLASS >= 0], seen[BYTE_CLASS >= 0], len(CLASSES)).astype(np.int64)


def folded_words(data: bytes) -> list[bytes]:
    """Words as they are looked up: letters of ASCII in lower case."""
    return data.lower().split()


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of WINDOW words that occur twice or more, the first one included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number = dict(zip(words, range(len(words)), strict=True))  # of equal words the last place
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    rank, most = ids[:n], len(words)
    for step in range(1, WINDOW):  # a window's number: its first words so far and the next one
        if most > (1 << 62) // len(words):
            rank = np.unique(rank, return_inverse=True)[1]
            most = n
        rank = rank * len(words) + ids[step:step + n]
        most *= len(words)
    order = np.argsort(rank, kind="stable")
    same = rank[order[1:]] == rank[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(n, dtype=np.int64)
    again[order[1:][same]] = again[order[:-1][same]] = 1
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[:n] += again
    edges[WINDOW:] -= again
    return int((np.cumsum(edges[:-1]) > 0).sum())


def base(data: bytes, seen: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text in UTF-8."""
    words = data.split()
    met: set[bytes] = set()
    doubled = 0
    for line in data.split(b"\n"):
        if line.strip():
            doubled += line in met
            met.add(line)
    chars = len(data) - seen[0x80:0xC0].sum() - seen[BLANKS].sum()
    return len(words), int(chars), int(seen[SYMBOLS].sum()), doubled, repeated_words(words)


def fails(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > REPEATED_SHARE * n_words


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> list:
    """One row (lang, documents, classes, words, shares) per language of ``docs``.

    Of every document with a language and at least REFERENCE_WORDS words, the
    tasks add up shares per (language, word) and send them on whenever they
    hold HELD_WORDS entries, so memory is bounded and no word is dropped. The
    result has COMMON words and a class histogram per language.
    """
    rows = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one number per entry: PAIR times the documents, plus the share
        words: dict[str, dict[bytes, int]] = {}
        classes: dict[str, dict[int, int]] = {}
        entries = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for lang in words:
                for keys, kinds, sums in ((list(words[lang]), -1, words[lang]), ([], list(classes[lang]), classes[lang])):
                    n = len(sums)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * n, pa.string()), pa.array(keys or [b""] * n, pa.binary()).cast(pa.string()),
                         pa.array([-1] * n if kinds == -1 else kinds, pa.int32()),
                         pa.array([x // PAIR for x in sums.values()], pa.int64()),
                         pa.array([x % PAIR for x in sums.values()], pa.int64())],
                        names=["lang", "word", "kind", "documents", "share"])
            words.clear()
            classes.clear()

        for batch in batches:
            for part in slices(batch):
                texts = part.column(1).cast(pa.binary()).to_pylist()
                for lang, data in zip(part.column(0).to_pylist(), texts, strict=True):
                    found = folded_words(data)
                    n = len(found)
                    if n < REFERENCE_WORDS:
                        continue
                    own = words.setdefault(lang, {})
                    entries -= len(own)
                    for word, k in Counter(found).items():
                        own[word] = own.get(word, 0) + PAIR + k * UNIT // n
                    entries += len(own)
                    counts = class_counts(byte_counts(data))
                    own = classes.setdefault(lang, {})
                    for kind, share in enumerate((counts * UNIT // counts.sum()).tolist()):
                        own[kind] = own.get(kind, 0) + PAIR + share
                    if entries >= HELD_WORDS:
                        yield from sent()
                        entries = 0
        yield from sent()

    sums = rows.mapInArrow(run, "lang string, word string, kind int, documents long, share long").groupBy(
        "lang", "word", "kind").agg(F.sum("documents").alias("documents"), F.sum("share").alias("share"))
    sums = stage(sums, "divergence-sums")
    known = sums.where(F.col("kind") >= 0).groupBy("lang").agg(
        F.max("documents").alias("documents"), F.sort_array(F.collect_list(F.struct("kind", "share"))).alias("classes"))
    # the most held words of a language: first of every hash cell of it, then of all its cells
    cell = F.pmod(F.xxhash64("word"), F.lit(64))
    order = [F.desc("documents"), F.col("word")]
    words = sums.where((F.col("kind") < 0) & (F.col("word") != "")).withColumn("cell", cell)
    words = (words.withColumn("place", F.row_number().over(Window.partitionBy("lang", "cell").orderBy(*order)))
             .where(F.col("place") <= COMMON)
             .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
             .where(F.col("place") <= COMMON))
    common = words.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "word", "share"))).alias("words"))
    return known.join(common, "lang").orderBy("lang").collect()  # a fixed number of values per language


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of a histogram, or of rows of them, to each row of ``q``; all sum to 1."""
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0.0)
        right = np.where(q > 0, q * np.log2(q / middle), 0.0)
    return np.sqrt(np.clip((left + right).sum(axis=-1) / 2, 0.0, 1.0))


class References:
    """What documents are compared with: per language (a row of the matrices)
    the class shares, and the shares of its common words and of all others."""

    def __init__(self, rows: list):
        self.langs = [r["lang"] for r in rows]
        classes = np.array([[c["share"] for c in r["classes"]] for r in rows], dtype=float)
        classes = classes.reshape(len(rows), len(CLASSES))
        self.classes = classes / classes.sum(axis=1, keepdims=True)
        #: number of every common word; one more number stands for all other words
        self.number: dict[bytes, int] = {}
        for r in rows:
            for w in r["words"]:
                self.number.setdefault(w["word"].encode(), len(self.number))
        self.other = len(self.number)
        width = max((len(r["words"]) for r in rows), default=0)
        self.places = np.full((len(rows), width), self.other + 1)  # past the last number: nothing is there
        self.shares = np.zeros((len(rows), width + 1))
        for i, r in enumerate(rows):
            n = len(r["words"])
            self.places[i, :n] = [self.number[w["word"].encode()] for w in r["words"]]
            self.shares[i, :n] = [w["share"] / (UNIT * r["documents"]) for w in r["words"]]
        self.shares[:, -1] = np.maximum(0.0, 1 - self.shares.sum(axis=1))
        self.shares /= self.shares.sum(axis=1, keepdims=True)

    def distances(self, data: bytes, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances of a text with words to every language, by classes and by common words."""
        counts = class_counts(seen)
        words = folded_words(data)
        found = np.bincount(list(map(self.number.get, words, repeat(self.other))), minlength=self.other + 2)
        own = found[self.places]
        own = np.hstack([own, len(words) - own.sum(axis=1, keepdims=True)])
        return distance(counts / counts.sum(), self.classes), distance(own / len(words), self.shares)

    def judge(self, data: bytes, seen: np.ndarray, n_words: int, word_chars: int) -> tuple[float | None, float | None, str | None, bool]:
        """Distances to the nearest language, its name, and the verdict.

        Nearest is the language with the smallest larger one of both
        distances, each measured in units of what is allowed.
        """
        if not self.langs or not n_words:
            return None, None, None, True
        by_class, by_word = self.distances(data, seen)
        over = np.zeros(len(self.langs))
        if word_chars >= LEAST_CHARS:
            over = by_class / np.sqrt(FAR_CLASSES + CLASS_CHANCE / word_chars)
        if n_words >= LEAST_COMPARED:
            over = np.maximum(over, by_word / np.sqrt(FAR_WORDS + WORD_CHANCE / n_words))
        near = int(np.argmin(over))
        return float(by_class[near]), float(by_word[near]), self.langs[near], bool(over[near] <= 1)


RESULT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
          "class_distance", "word_distance", "nearest"]
TYPES = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2 + [pa.string()]


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts and verdict of every row of ``docs``.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, and the distances to the nearest
    language by classes and by words with its name (null if the base rules
    fail, or without references). Null and empty texts have no words and fail the base rules.
    Documents without a language are judged, but are in no reference; where
    no document has a language, the base rules decide alone. Repeated rows
    each get their own row.
    """
    ship(docs.sparkSession)
    known = References(references(docs, text_col, lang_col))
    rows = id_and_text(docs, id_col, text_col)
    schema = (f"doc_id {rows.schema[0].dataType.simpleString()}, n_words long, word_chars long, n_symbols long, "
              "n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, class_distance double, "
              "word_distance double, nearest string")

    def judged(data: bytes) -> tuple:
        seen = byte_counts(data)
        counts = base(data, seen)
        if fails(counts[0], counts[4]):
            return *counts, True, False, None, None, None
        by_class, by_word, lang, passed = known.judge(data, seen, *counts[:2])
        return *counts, False, passed, by_class, by_word, lang

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = zip(*[judged(t) for t in part.column(1).cast(pa.binary()).to_pylist()], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(x, t) for x, t in zip(out, TYPES, strict=True)]], names=RESULT)

    return rows.mapInArrow(run, schema)
