"""Document fingerprints: invertible Bloom lookup tables of paragraph digests.

A text's paragraphs become 64-bit digests. A table of cells holds each digest
in one cell of each of three parts; a cell keeps how many digests it got, their
XOR and the XOR of their checks. Subtracting two tables cell by cell cancels
every shared paragraph, and peeling (a cell that holds one digest gives it up,
which frees others) recovers the digests that differ. If the peeling stops
before the cells are empty, both tables are built again with twice the cells.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewise.llm.chunking import rolling
from gatewise.llm.common import ship, slices

#: Cells of each of the three parts of a fingerprint (a power of two).
PART_CELLS = 8
#: A line's first piece ends at its first blank after HEAD_BYTES bytes; the
#: rest is cut at content-defined borders, about every 2**CUT_BITS bytes, that
#: look at WINDOW bytes of the line.
HEAD_BYTES, CUT_BITS, WINDOW = 16, 7, 32
#: Documents whose tables are handled at once.
GROUP = 128
#: Peeling rounds after which a table counts as not peeled.
ROUNDS = 500
#: Where in a mixed digest the cells of the three parts are read.
SHIFTS = np.array([[0], [21], [42]], dtype=np.uint64)


class Sketch(NamedTuple):
    """Tables in a row: one row of 3 x cells per document or pair."""

    count: np.ndarray
    keys: np.ndarray
    checks: np.ndarray


def paragraphs(text: str) -> list[bytes]:
    """Pieces of the non-empty lines in order, trimmed.

    How a line is cut depends on that line alone: borders in its first WINDOW
    bytes, where the rolling hash still sees the line before, do not count. A
    line of two words or more, the first HEAD_BYTES bytes or longer, has two
    pieces at least, so also a text of one short line is more than one digest.
    """
    data = text.encode("utf-8")
    if not data:
        return []
    codes = np.frombuffer(data, dtype=np.uint8)
    ends = np.append(np.flatnonzero(codes == 10) + 1, len(data))
    starts = np.concatenate([[0], ends[:-1]])
    found = np.flatnonzero(rolling(data, WINDOW) >> np.uint32(32 - CUT_BITS) == 0) + 1
    found = found[found - starts[np.searchsorted(ends, found, side="left")] > WINDOW]
    blanks = np.append(np.flatnonzero(codes == 32), len(data))
    heads = blanks[np.searchsorted(blanks, np.minimum(starts + HEAD_BYTES, len(data)))]
    ends = np.unique(np.concatenate([ends, found, heads[heads < ends]]))
    pieces, start = [], 0
    for end in ends.tolist():
        piece = data[start:end].strip()
        if piece:
            pieces.append(piece)
        start = end
    return pieces


def digests(text: str) -> np.ndarray:
    """One digest per paragraph; the n-th copy of a paragraph has its own."""
    met: dict[bytes, int] = {}
    out = []
    for p in paragraphs(text):
        nth = met.get(p, 0)
        met[p] = nth + 1
        out.append(xxhash.xxh64_intdigest(p, nth))
    return np.array(out, dtype=np.uint64)


def mixed(keys: np.ndarray) -> np.ndarray:
    h = keys * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def places(h: np.ndarray, cells: int) -> np.ndarray:
    """The cell of every mixed digest in each part (3 x digests)."""
    at = (h >> SHIFTS) & np.uint64(cells - 1)
    return at.astype(np.int64) + np.arange(0, 3 * cells, cells)[:, None]


def checks_of(h: np.ndarray) -> np.ndarray:
    return ((h * np.uint64(0x94D049BB133111EB)) >> np.uint64(32)).astype(np.uint32)


def sketch(lists: list[np.ndarray], cells: int = PART_CELLS) -> Sketch:
    """One table per list of digests."""
    width = 3 * cells
    keys = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
    h = mixed(keys)
    at = (places(h, cells) + np.repeat(np.arange(len(lists)), list(map(len, lists))) * width).ravel()
    count = np.bincount(at, minlength=len(lists) * width).astype(np.int32)
    xor, check = np.zeros(len(count), np.uint64), np.zeros(len(count), np.uint32)
    np.bitwise_xor.at(xor, at, np.tile(keys, 3))
    np.bitwise_xor.at(check, at, np.tile(checks_of(h), 3))
    return Sketch(*[x.reshape(len(lists), width) for x in (count, xor, check)])


def written(count: np.ndarray, keys: np.ndarray, checks: np.ndarray) -> str:
    """A table as text: counts, keys and checks of the cells, little-endian, in base64."""
    return base64.b64encode(count.astype("<i4").tobytes() + keys.astype("<u8").tobytes()
                            + checks.astype("<u4").tobytes()).decode("ascii")


def read(text: str) -> Sketch:
    data = base64.b64decode(text)
    n = len(data) // 16
    return Sketch(np.frombuffer(data, "<i4", n)[None], np.frombuffer(data, "<u8", n, 4 * n)[None],
                  np.frombuffer(data, "<u4", n, 12 * n)[None])


def peel(a: Sketch, b: Sketch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Subtract tables row by row and peel: (row of each digest found, the
    digest, 1 if it is in a or -1 if in b, whether each row was peeled whole)."""
    rows, width = a.count.shape
    cells = width // 3
    count, xor, check = (a.count - b.count).ravel(), (a.keys ^ b.keys).ravel(), (a.checks ^ b.checks).ravel()
    part = np.arange(len(count)) // cells % 3
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(ROUNDS):
        moved = False
        for p in range(3):  # a digest has one cell in a part, so none is met twice
            alone = np.flatnonzero((np.abs(count) == 1) & (part == p))
            keys = xor[alone]
            h = mixed(keys)
            row = alone // width
            at = places(h, cells) + row * width
            real = (checks_of(h) == check[alone]) & (at[p] == alone)
            if not real.any():
                continue
            moved = True
            keys, h, row, at, sign = keys[real], h[real], row[real], at[:, real].ravel(), count[alone][real]
            found.append((row, keys, sign))
            np.subtract.at(count, at, np.tile(sign, 3))
            np.bitwise_xor.at(xor, at, np.tile(keys, 3))
            np.bitwise_xor.at(check, at, np.tile(checks_of(h), 3))
        if not moved:
            break
    left = ((count != 0) | (xor != 0) | (check != 0)).reshape(rows, width).any(axis=1)
    out = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [
        np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int32)]
    return *out, ~left


def differing(pairs: list[tuple[np.ndarray, np.ndarray]], first: tuple[Sketch, Sketch] | None = None
              ) -> tuple[list[np.ndarray], list[np.ndarray], list[int]]:
    """For each pair of digest lists: those only in the left one, those only in
    the right one, and the cells per part that recovering them took.

    All pairs are tried with tables of PART_CELLS (``first``, if given); those
    that fail again with tables that would hold a difference in every
    paragraph, and then with twice the cells until they are peeled.
    """
    lost, gained, took = [None] * len(pairs), [None] * len(pairs), [0] * len(pairs)
    todo = {PART_CELLS: list(range(len(pairs)))}
    while todo:
        cells = min(todo)
        which = todo.pop(cells)
        if cells == PART_CELLS and first is not None:
            a, b = first
        else:
            a, b = sketch([pairs[i][0] for i in which], cells), sketch([pairs[i][1] for i in which], cells)
        row, keys, sign, whole = peel(a, b)
        order = np.argsort(row, kind="stable")
        row, keys, sign = row[order], keys[order], sign[order]
        ends = np.searchsorted(row, np.arange(len(which) + 1))
        for k, i in enumerate(which):
            if whole[k]:
                own, signs = keys[ends[k]:ends[k + 1]], sign[ends[k]:ends[k + 1]]
                lost[i], gained[i], took[i] = own[signs > 0], own[signs < 0], cells
            else:
                need = (len(pairs[i][0]) + len(pairs[i][1])) // 2
                todo.setdefault(max(2 * cells, 1 << need.bit_length()), []).append(i)
    return lost, gained, took


def likeness(a: int, b: int, differ: int) -> float:
    """Shared paragraphs over all paragraphs of two texts; two empty texts are alike."""
    shared = (a + b - differ) / 2
    return shared / (shared + differ) if a + b else 1.0


def _after(key: tuple) -> tuple:
    """Sort key of (doc_id, tie, copy), any of them null, in the order of Spark's ascending sort."""
    return tuple((x is not None, x) for x in key)


def sequence(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (part, ghost, doc_id, tie, text), sorted inside their partition.

    All rows form one sequence: by descending doc_id (of any type that can be
    ordered; nulls last), then by descending hash of the text, then by the
    place of the row in the input, which tells copies of a row apart. It is
    cut into parts of about as many rows, at limits of these three, so neither
    null nor repeated ids meet in one part. Each part also holds, as a ghost at
    its end, the row that follows its last row; after the last part comes the
    first row of all. The driver holds one limit and one first row per part,
    and the join that finds the ghosts broadcasts those.
    """
    spark = docs.sparkSession
    key, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = docs.select(key.alias("doc_id"), F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("copy"))
    dealt = keys.repartitionByRange(parts, "doc_id", "tie", "copy").groupBy(F.spark_partition_id().alias("range"))
    least = dealt.agg(F.min(F.struct("doc_id", "tie", "copy")).alias("least")).collect()  # a row per part
    limits = sorted(_after(tuple(r["least"])) for r in least)[1:]

    @F.arrow_udf("int")
    def part_of(ids: pa.Array, ties: pa.Array, copies: pa.Array) -> pa.Array:
        rows = zip(ids.to_pylist(), ties.to_pylist(), copies.to_pylist(), strict=True)
        return pa.array([len(limits) - bisect_right(limits, _after(r)) for r in rows], pa.int32())

    rows = docs.select(part_of(key, F.xxhash64(text), F.monotonically_increasing_id()).alias("part"),
                       F.lit(0).alias("ghost"), key.alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    first = {r["part"]: r["first"] for r in rows.groupBy("part").agg(
        F.max(F.struct("doc_id", "tie")).alias("first")).collect()}
    order = sorted(first)
    after = [(p, first[n]["doc_id"], first[n]["tie"]) for p, n in zip(order, order[1:] + order[:1], strict=True)]
    kind = docs.schema[id_col].dataType.simpleString()
    ends = spark.createDataFrame(after, f"g_part int, g_id {kind}, g_tie long")
    ghosts = (rows.join(F.broadcast(ends), F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("tie") == F.col("g_tie")))
              .select(F.col("g_part").alias("part"), F.lit(1).alias("ghost"), "doc_id", "tie", "text")
              .dropDuplicates(["part"]))
    return (rows.unionByName(ghosts).repartition(parts, "part")
            .sortWithinPartitions("part", "ghost", F.col("doc_id").desc_nulls_last(), F.col("tie").desc()))


def edited(text: str, following: str) -> str:
    """``text`` with its last third (rounded down) replaced by the first as
    many characters (or all) of ``following``."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and its edited text, and what differs.

    The next document is the one that follows by descending doc_id (after the
    last: the first; alone: itself; equal ids: by the text's hash; null ids
    last). Null texts count as empty; an empty text has no paragraphs, an
    empty table and a likeness of 1 to another empty text. Returns doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, lost and gained (lists of the paragraph digests, as signed
    integers, that the edit takes away and brings in) and cells (per part,
    that recovering them took).
    """
    ship(docs.sparkSession)
    rows = sequence(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double, lost array<long>, gained array<long>, cells int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # (part, doc_id, text) that waits for the row after it
        for batch in batches:
            names = dict(zip(OUT, [batch.schema.field(2).type, *OUT_TYPES], strict=True))
            for piece in slices(batch, GROUP):
                columns = [c.to_pylist() for c in piece.columns]
                rows = list(zip(columns[0], columns[2], columns[4], strict=True))
                if last is not None:
                    rows.insert(0, last)
                last = rows[-1]
                met = [(x, y) for x, y in zip(rows, rows[1:]) if x[0] == y[0]]
                if met:
                    yield batch_of(compared(met), names)

    return rows.mapInArrow(run, schema)


def compared(met: list[tuple[tuple, tuple]]) -> list[tuple]:
    """Result rows of documents, each with the row that follows it; both are (part, doc_id, text)."""
    texts = [x[2] for x, _ in met]
    after = [y[2] for _, y in met]
    changed = [edited(t, n) for t, n in zip(texts, after, strict=True)]
    known = {t: digests(t) for t in {*texts, *after, *changed}}
    keys, next_keys, new_keys = ([known[t] for t in ts] for ts in (texts, after, changed))
    tables, next_tables, new_tables = sketch(keys), sketch(next_keys), sketch(new_keys)
    lost, gained, took = differing(list(zip(keys, new_keys, strict=True)), (tables, new_tables))
    gone, came, _ = differing(list(zip(keys, next_keys, strict=True)), (tables, next_tables))
    out = []
    for i, (x, _) in enumerate(met):
        out.append((
            x[1], len(texts[i]), hashlib.sha256(changed[i].encode("utf-8")).hexdigest(),
            written(tables.count[i], tables.keys[i], tables.checks[i]),
            written(new_tables.count[i], new_tables.keys[i], new_tables.checks[i]),
            likeness(len(keys[i]), len(new_keys[i]), len(lost[i]) + len(gained[i])),
            likeness(len(keys[i]), len(next_keys[i]), len(gone[i]) + len(came[i])),
            lost[i].view(np.int64).tolist(), gained[i].view(np.int64).tolist(), took[i]))
    return out


OUT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "lost",
       "gained", "cells"]
OUT_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.list_(pa.int64()),
             pa.list_(pa.int64()), pa.int32()]


def batch_of(rows: list[tuple], types: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types.values(), strict=True)],
                                      names=list(types))
