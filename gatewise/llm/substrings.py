"""Substring de-duplication by content-defined chunks.

A text is cut where its gear rolling hash has a local minimum, so equal
passages are cut alike wherever they stand, and an insertion moves only the
borders around it. Chunks are de-duplicated by a 128-bit digest; chunks that
occur in several documents and follow each other form a repeated passage.
Which copy of a chunk stays is decided chunk by chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewise.llm.chunking import low_points
from gatewise.llm.common import id_and_text, slices, stage

#: Borders are local minima over this many bytes on both sides (chunks of 17
#: bytes at least and 33 on average) of a hash over WINDOW bytes.
REACH, WINDOW = 16, 16
#: Words inside the matched chunks from which a passage is reported. At each
#: end of a repeated passage a chunk reaches into text that differs; about
#: 15 of its words are lost that way, so passages of 50 words and more count.
LEAST_WORDS = 20
#: Chunk rows sent back in one batch.
OUT_ROWS = 50_000
#: Odd factors that mix the digests of two neighbouring chunks into a link.
HERE, NEXT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def white(data: bytes) -> np.ndarray:
    """Where a word ends: white space after something else."""
    codes = np.frombuffer(data, dtype=np.uint8)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    return np.flatnonzero(space[1:] & ~space[:-1]) + 1


def chunk_rows(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Starts, ends, finished words and 128-bit digests of the chunks of a text."""
    data = text.encode("utf-8")
    ends = low_points(data, REACH, WINDOW)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    before = np.searchsorted(white(data), np.concatenate([starts, ends[-1:]])) if len(ends) else ends
    digest = xxhash.xxh3_128_intdigest
    return starts, ends, np.diff(before), [digest(data[a:z]) for a, z in zip(starts.tolist(), ends.tolist(), strict=True)]


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per chunk: row_id, doc_id, nth, start and stop (UTF-8 byte
    offsets), words (that end in it), the digest's halves high and low, and link
    (64 bits of its digest and the next chunk's; of no use at the last chunk)."""
    rows = id_and_text(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["row_id", "doc_id", "nth", "start", "stop", "words", "high", "low", "link"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_type = batch.schema.field(1).type
            held: list[tuple] = []
            size = 0

            def out() -> pa.RecordBatch:
                long = [len(h[2]) for h in held]
                digests = [d for h in held for d in h[5]]
                raw = np.frombuffer(b"".join([d.to_bytes(16, "little") for d in digests]), dtype="<i8").reshape(-1, 2)
                at = np.repeat(np.arange(len(held)), long)
                low = raw[:, 0].astype(np.uint64)
                link = (low * HERE + np.roll(low, -1) * NEXT).view(np.int64)
                join = lambda i: np.concatenate([h[i] for h in held]).astype(np.int64)
                return pa.RecordBatch.from_arrays(
                    [pa.array(np.array([h[0] for h in held], dtype=np.int64)[at]),
                     pa.array([h[1] for h in held], id_type).take(pa.array(at)),
                     pa.array(np.concatenate([np.arange(n) for n in long]), pa.int64()),
                     pa.array(join(2)), pa.array(join(3)), pa.array(join(4)), pa.array(raw[:, 1]), pa.array(raw[:, 0]),
                     pa.array(link)],
                    names=names)

            for part in slices(batch):
                for row_id, doc_id, text in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    if not text:
                        continue
                    held.append((row_id, doc_id, *chunk_rows(text)))
                    size += len(held[-1][2])
                    if size >= OUT_ROWS:
                        yield out()
                        held, size = [], 0
            if held:
                yield out()

    return rows.mapInArrow(run, f"row_id long, doc_id {kind}, nth long, start long, stop long, words long, high long, low long, "
                                "link long")


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             least_words: int = LEAST_WORDS) -> DataFrame:
    """The passages of every document that other documents hold too.

    One row per passage and place: doc_id, start and stop (UTF-8 byte offsets
    of its matched chunks), words, first_doc_id (the smallest doc_id among
    all holders of its chunks), copies (the most places of one of its chunks),
    kept (this document is the first holder of all its chunks) and drop.
    Documents without such a passage have no row; null and empty texts have
    none. A passage that repeats inside one document only, or inside rows of
    one doc_id, does not count; null ids count as no document.

    A passage needs ``least_words`` in chunks of which each shares a document
    with the next: both stand side by side in another document, or have their
    smallest or their largest holder in common. Chunks that recur here and
    there do not add up. ``drop`` lists what may go: the stretches (start, stop,
    first_doc_id) of such chunks whose smallest holder is another document,
    cut where that holder changes. All places of a chunk in its smallest holder
    stay, so nothing in ``drop`` is dropped everywhere. A row that is not kept
    can hold chunks that stand nowhere else once ``drop`` is cut out: cut out
    ``drop``, not rows.
    """
    cut = chunks(docs, id_col, text_col)
    # stored, so that the join shuffles both sides and Spark can split a very common chunk
    repeated = stage(cut.groupBy("high", "low")
                     .agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last"),
                          F.count("*").alias("copies"))
                     .where(F.col("first_doc_id") < F.col("last")), "repeated-chunks")
    met = stage(cut.join(repeated, ["high", "low"]).drop("high", "low"), "met-chunks")
    shared = stage(met.groupBy("link").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
                   .where(F.col("least") < F.col("most")).select("link", F.lit(True).alias("linked")), "shared-links")
    in_row = Window.partitionBy("row_id").orderBy("nth")
    # a stretch ends where the next chunk shares no document, a piece also where the first holder changes
    same = {c: F.lag(c).over(in_row) == F.col(c) for c in ("first_doc_id", "last")}
    partner = [same[c] & ~F.col("doc_id").eqNullSafe(F.col(c)) for c in same]
    joined = (F.lag("nth").over(in_row) + 1 == F.col("nth")) & (
        F.lag("linked").over(in_row).isNotNull() | partner[0] | partner[1])
    apart = ~F.coalesce(joined, F.lit(False))
    turned = ~same["first_doc_id"]
    runs = (met.join(shared, "link", "left")
            .select("*", (F.col("nth") - F.row_number().over(in_row)).alias("run"), apart.cast("int").alias("apart"),
                    (apart | turned).cast("int").alias("turned"))
            .withColumn("stretch", F.sum("apart").over(in_row)).withColumn("piece", F.sum("turned").over(in_row)))
    whole = [F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("stop").alias("stop"),
             F.sum("words").alias("words"), F.min("first_doc_id").alias("first_doc_id"), F.max("copies").alias("copies")]
    own = F.col("doc_id").eqNullSafe(F.col("first_doc_id"))
    pieces = runs.groupBy("row_id", "run", "stretch", "piece").agg(*whole)
    stretches = pieces.groupBy("row_id", "run", "stretch").agg(
        *whole, F.collect_list(F.when(~own, F.struct("start", "stop", "first_doc_id"))).alias("others"))
    enough = F.col("words") >= least_words
    found = stretches.groupBy("row_id", "run").agg(
        *whole, F.max(enough).alias("enough"),
        F.array_sort(F.flatten(F.collect_list(F.when(enough, F.col("others"))))).alias("drop"))
    return found.where("enough").select("doc_id", "start", "stop", "words", "first_doc_id", "copies",
                                        own.alias("kept"), "drop")
