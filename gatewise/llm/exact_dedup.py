"""Exact de-duplication by content-defined chunk recipes.

Every text is cut at content-defined borders; a chunk is named by a digest,
and a document becomes its recipe, the ordered list of chunk names. Chunk
contents travel once, each distinct one per task, to prove that no two
different chunks carry the same name. If two do, the whole run is repeated
with names of twice the length. After that proof, two texts are equal exactly
when their recipes are, and only the short recipes are grouped and joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatewise.llm.chunking import borders
from gatewise.llm.common import id_and_text, keep_rows, slices, stage

#: Chunks are about 2 KiB: a border every 2**11 bytes, 512 bytes to 16 KiB.
CHUNK_BITS, CHUNK_LEAST, CHUNK_MOST = 11, 512, 16384
#: Bytes of a chunk's name, to begin with.
NAME_BYTES = 16
#: Bytes of chunk contents sent back in one batch.
OUT_BYTES = 8 << 20


def chunks(text: str) -> list[bytes]:
    data = text.encode("utf-8")
    start, out = 0, []
    for end in borders(data, CHUNK_BITS, CHUNK_LEAST, CHUNK_MOST):
        out.append(data[start:end])
        start = end
    return out


def chunk_name(chunk: bytes, size: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=size).digest()


def recipes(rows: DataFrame, size: int) -> DataFrame:
    """doc_id, row_id, text_sha256 and recipe (list of chunk names) of each row."""
    schema = rows.schema[0:2].add("text_sha256", "string").add("recipe", T.ArrayType(T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = part.column(2).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in texts], pa.string()),
                     pa.array([[chunk_name(c, size) for c in chunks(t)] for t in texts], pa.list_(pa.binary()))],
                    names=schema.names)

    return rows.mapInArrow(run, schema)


def chunk_contents(rows: DataFrame, size: int) -> DataFrame:
    """(name, chunk) of every chunk, each distinct one once per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met: set[tuple[bytes, bytes]] = set()
            names: list[bytes] = []
            contents: list[bytes] = []
            held = 0

            def out() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(contents, pa.binary())],
                                                  names=["name", "chunk"])

            for part in slices(batch):
                for text in part.column(2).to_pylist():
                    for chunk in chunks(text):
                        name = chunk_name(chunk, size)
                        # the full-length digest stands in for the chunk in this filter only
                        seen = (name, hashlib.sha256(chunk).digest())
                        if seen in met:
                            continue
                        met.add(seen)
                        names.append(name)
                        contents.append(chunk)
                        held += len(chunk)
                        if held >= OUT_BYTES:
                            yield out()
                            names, contents, held = [], [], 0
            if names:
                yield out()

    return rows.mapInArrow(run, "name binary, chunk binary")


def names_hold(rows: DataFrame, size: int) -> bool:
    """Whether every chunk name stands for one content (compared byte by byte)."""
    spread = chunk_contents(rows, size).groupBy("name").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
    return spread.where(F.col("low") != F.col("high")).limit(1).count() == 0


def verified_recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     name_bytes: int = NAME_BYTES) -> DataFrame:
    """Stored (doc_id, row_id, text_sha256, recipe) of every row, names proven unique."""
    rows = id_and_text(docs, id_col, text_col).select("doc_id", F.monotonically_increasing_id().alias("row_id"),
                                                      "text")
    size = name_bytes
    while not names_hold(rows, size):
        if size >= 64:
            raise ValueError("two chunks share a 64-byte digest")
        size = min(64, size * 2)
    return stage(recipes(rows, size), "recipes")


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         name_bytes: int = NAME_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays. Null text counts as
    empty; empty texts are equal to each other. A null id is smaller than any
    other. Of rows that repeat both id and text, exactly one stays. Groups of
    any size are counted by partial sums; no task gathers a group.
    """
    stored = verified_recipes(docs, id_col, text_col, name_bytes)
    # stored, so that the join shuffles both sides and Spark can split a large group
    groups = stage(stored.groupBy("recipe").agg(F.max(F.struct("doc_id", "row_id")).alias("best"),
                                                F.count("*").alias("group_size")), "recipe-groups")
    return (stored.join(groups, "recipe")
            .select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                    (F.col("row_id") == F.col("best.row_id")).alias("kept"), "text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns (rules of :func:`mark`)."""
    return keep_rows(docs, mark(docs, id_col, text_col).where("kept"), id_col, text_col)
