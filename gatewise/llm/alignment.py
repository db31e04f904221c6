"""Alignment of two tokenizers' tokens over the same text.

Both tokenizers cut the same bytes, so a token is a range of bytes. An as-of
merge, keyed by document, finds for every token start the other side's token
that covers it; both directions together are all overlapping pairs, once each
(a pair's overlap begins where one of the two begins). Going through the pairs
in the order of the text, a pair of equal ends closes a group. Tokens of one
group are linked, each of one side with each of the other.

Corpus-wide, an id pair counts the documents that hold it linked. The pairs of
a document are stored as arrays, once; counts come back to the documents by a
join whose frequent pairs (a fixed number of rows) are broadcast, while the
rare ones, each of which few documents hold, are shuffled.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewise.llm.bpe import byte_letters
from gatewise.llm.common import id_and_text, stage

#: Characters of the documents that are aligned at once (a longer one is alone).
GROUP_CHARS = 400_000
#: Counted id pairs that are broadcast: a few MB in memory, whatever the input.
HEAD_PAIRS = 1 << 16
#: How byte-level BPE cuts words (a fixed value of that kind of tokenizer).
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The tokenizer files of the registered query, as the package that has them names them.
LEFT, RIGHT = "byte_bpe_50k.json", "piece_bpe_32k.model"


class Side:
    """A tokenizer's vocabulary: the bytes of every id, and its number as text."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.size = np.array([len(p) for p in pieces], dtype=np.int64)
        self.name = {end: np.array([f"{i}{end}" for i in range(len(pieces))], dtype=object) for end in ",|;"}


class Aligner:
    """Both tokenizers: byte-level BPE (its JSON file) on the left, pieces with
    byte fallback that put a space in front of a text on the right."""

    def __init__(self, left: str, right: str):
        import sentencepiece
        import tiktoken

        with open(left, encoding="utf-8") as f:
            spec = json.load(f)
        back = {ord(letter): b for b, letter in byte_letters().items()}
        special = {t["id"] for t in spec["added_tokens"]}
        ranks = {t.translate(back).encode("latin-1"): i for t, i in spec["model"]["vocab"].items() if i not in special}
        # ids in the order of the merges, which every token's own text goes through: the ids are ranks
        merged = [t if isinstance(t, str) else " ".join(t) for t in spec["model"]["merges"]]
        if spec["normalizer"] or any(spec["model"]["vocab"][t.replace(" ", "")] != 256 + i for i, t in enumerate(merged)):
            raise ValueError(f"{left} is no byte-level BPE whose ids follow its merges")
        self.byte_bpe = tiktoken.Encoding("left", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})
        named = {i: p for p, i in ranks.items()}
        self.left = Side([named.get(i, b"") for i in range(max(named) + 1)])
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=right)
        self.right = Side([bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode()
                           for i, p in enumerate(map(self.pieces.id_to_piece, range(self.pieces.vocab_size())))])
        self.wide = len(self.right.pieces)

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each side; none if a side's bytes are not a space and the text."""
        none = np.zeros(0, np.int64)
        left, right = [], []
        for text, b in zip(texts, self.pieces.encode(texts, num_threads=1), strict=True):
            a = self.byte_bpe.encode_to_numpy(" " + text, disallowed_special=()) if text else none
            want = (" " + text).encode()
            # byte-level BPE without a normaliser loses no byte, so its length tells
            whole = text and len(want) == self.left.size[a].sum() and want == b"".join(
                map(self.right.pieces.__getitem__, b))
            left.append(a.astype(np.int64) if whole else none)
            right.append(np.array(b, dtype=np.int64) if whole else none)
        return left, right

    def align(self, texts: list[str]) -> dict[str, np.ndarray | list]:
        """Counts, digest and linked id pairs (``ends`` has the end of each
        text's pairs in ``a``, ``b`` and ``times``) of every text."""
        n, (left, right) = len(texts), self.tokens(texts)
        n_a, n_b = (np.array(list(map(len, side)), dtype=np.int64) for side in (left, right))
        a, b = np.concatenate(left), np.concatenate(right)
        doc_a, doc_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        # a text has as many bytes on both sides, so running ends agree across texts
        end_a, end_b = np.cumsum(self.left.size[a]), np.cumsum(self.right.size[b])
        at, over_a, over_b = overlaps(doc_a, end_a - self.left.size[a], doc_b, end_b - self.right.size[b])
        closing = end_a[over_a] == end_b[over_b]
        group = np.cumsum(closing) - closing
        group_a, group_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
        group_a[over_a], group_b[over_b] = group, group
        groups = int(closing.sum())
        doc_g = doc_a[over_a[closing]]
        in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        ends, pair_a, pair_b, times = self.linked(n, a, b, group_a, group_b, in_a, in_b, doc_g, (over_a, over_b, group))
        return {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(doc_g, minlength=n),
                "n_links": sums_by(doc_g, in_a * in_b, n), "groups_sha256": self.written(
                    n, a, b, doc_a, doc_b, group_a, group_b, in_a, in_b, n_a + n_b),
                "ends": ends, "a": pair_a, "b": pair_b, "times": times}

    def linked(self, n, a, b, group_a, group_b, in_a, in_b, doc_g, over) -> tuple[np.ndarray, ...]:
        """Distinct linked id pairs of every text and how often each is linked."""
        over_a, over_b, group = over
        many = (in_a > 1) & (in_b > 1)
        # with one token on a side, the links of a group are its overlaps
        plain = ~many[group]
        keys, times = [self.key(doc_g[group[plain]], a[over_a[plain]], b[over_b[plain]])], [np.ones(plain.sum(), np.int64)]
        if many.any():  # else each distinct id of one side with each of the other
            ga, ia, ca = distinct(group_a[many[group_a]], a[many[group_a]], len(self.left.pieces))
            gb, ib, cb = distinct(group_b[many[group_b]], b[many[group_b]], self.wide)
            first, last = np.searchsorted(gb, ga, "left"), np.searchsorted(gb, ga, "right")
            reach = last - first
            left = np.repeat(np.arange(len(ga)), reach)
            right = np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach - first, reach)
            keys.append(self.key(doc_g[ga[left]], ia[left], ib[right]))
            times.append(ca[left] * cb[right])
        key, times = np.concatenate(keys), np.concatenate(times)
        key, where = np.unique(key, return_inverse=True)
        times = sums_by(where, times, len(key))
        doc, rest = key // (len(self.left.pieces) * self.wide), key % (len(self.left.pieces) * self.wide)
        return np.searchsorted(doc, np.arange(n), "right"), rest // self.wide, rest % self.wide, times

    def key(self, doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (doc * len(self.left.pieces) + a) * self.wide + b

    def written(self, n, a, b, doc_a, doc_b, group_a, group_b, in_a, in_b, sizes) -> list[str]:
        """Digest of each text's groups, ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
        before_a, before_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        out = np.empty(len(a) + len(b), dtype=object)
        for ids, side, groups, until, at in (
                (a, self.left, group_a, np.cumsum(in_a), np.arange(len(a)) + before_b[group_a]),
                (b, self.right, group_b, np.cumsum(in_b), np.arange(len(b)) + np.cumsum(in_a)[group_b])):
            last = np.arange(len(ids)) + 1 == until[groups]
            end = "|" if side is self.left else ";"
            out[at] = np.where(last, side.name[end][ids], side.name[","][ids])
        stops = np.cumsum(sizes)
        return [hashlib.sha256("".join(out[s - k:s].tolist())[:-1].encode()).hexdigest() if k else ""
                for s, k in zip(stops.tolist(), sizes.tolist(), strict=True)]


def sums_by(where: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of integers by their (n) places."""
    out = np.zeros(n, dtype=np.int64)
    np.add.at(out, where, values)
    return out


def distinct(group: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, id) in order, and how often each occurs."""
    key, count = np.unique(group * size + ids, return_counts=True)
    return key // size, key % size, count


def overlaps(doc_a: np.ndarray, start_a: np.ndarray, doc_b: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Where each overlap begins, and the numbers of its two tokens, in the order of the text."""
    a = pd.DataFrame({"at": start_a, "doc": doc_a, "a": np.arange(len(start_a))})
    b = pd.DataFrame({"at": start_b, "doc": doc_b, "b": np.arange(len(start_b))})
    both = pd.concat([pd.merge_asof(a, b, on="at", by="doc"), pd.merge_asof(b, a, on="at", by="doc")])
    order = np.argsort(both["at"].to_numpy(), kind="stable")
    at = both["at"].to_numpy()[order]
    new = np.ones(len(at), dtype=bool)
    new[1:] = at[1:] != at[:-1]  # tokens that begin together are met from both sides
    order = order[new]
    return at[new], both["a"].to_numpy()[order].astype(np.int64), both["b"].to_numpy()[order].astype(np.int64)


@lru_cache(maxsize=2)
def aligner(left: str, right: str) -> Aligner:
    return Aligner(left, right)


def batches_of(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about GROUP_CHARS characters."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > GROUP_CHARS:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def pairs(docs: DataFrame, left: str, right: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and the linked id
    pairs (``a``, ``b``, ``times``: equally long arrays) of every row of ``docs``."""
    rows = id_and_text(docs, id_col, text_col)
    schema = (f"row long, doc_id {rows.schema[0].dataType.simpleString()}, n_a long, n_b long, n_groups long, "
              "n_links long, groups_sha256 string, a array<int>, b array<int>, times array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found, row = aligner(left, right), TaskContext.get().partitionId() << 40
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                texts = part.column(1).to_pylist()
                for start, stop in batches_of(texts):
                    got = found.align(texts[start:stop])
                    offsets = pa.array(np.concatenate([[0], got["ends"]]), pa.int32())
                    lists = [pa.ListArray.from_arrays(offsets, pa.array(got[k], t)) for k, t in (
                        ("a", pa.int32()), ("b", pa.int32()), ("times", pa.int64()))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(row, row + stop - start)), part.column(0).slice(start, stop - start),
                         *[pa.array(got[c], pa.int64()) for c in COUNTS], pa.array(got["groups_sha256"], pa.string()),
                         *lists], names=["row", "doc_id", *COUNTS, "groups_sha256", "a", "b", "times"])
                    row += stop - start

    return rows.mapInArrow(run, schema)


def each_pair(stored: DataFrame) -> DataFrame:
    return stored.select("row", F.explode(F.arrays_zip("a", "b", "times")).alias("p")).select(
        "row", "p.a", "p.b", "p.times")


def pair_counts(stored: DataFrame) -> DataFrame:
    """a, b, count (documents that hold the pair linked) and best (no pair of this a has more)."""
    counted = stage(each_pair(stored).groupBy("a", "b").agg(F.count("*").alias("count")), "pair-counts")
    most = counted.groupBy("a").agg(F.max("count").alias("most"))
    return stage(counted.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best")),
                 "pair-best")


def align(docs: DataFrame, left: str, right: str, id_col: str = "doc_id", text_col: str = "text",
          head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of ``docs``.

    ``left`` and ``right`` name the tokenizer files on every executor. Null
    and empty texts, and texts that a tokenizer does not give back byte by
    byte, have no tokens: zeros and an empty digest. Repeated rows count as
    documents of their own. Texts of any length are aligned whole.
    """
    stored = stage(pairs(docs, left, right, id_col, text_col), "alignment")
    counts = pair_counts(stored)
    found, total = each_pair(stored), counts.count()
    if total <= head_pairs:
        joined = found.join(F.broadcast(counts), ["a", "b"])
    else:
        # the most frequent pairs: those of the highest powers of two that together are few enough
        level = F.floor(F.log2("count")).cast("int")
        sizes = counts.groupBy(level.alias("level")).count().collect()  # at most 64 rows
        lowest, room = 64, head_pairs
        for size in sorted(sizes, reverse=True):
            room -= size["count"]
            if room < 0:
                break
            lowest = size["level"]
        head, tail = F.broadcast(counts.where(level >= lowest)), counts.where(level < lowest)
        rare = found.join(head.select("a", "b"), ["a", "b"], "left_anti")
        joined = found.join(head, ["a", "b"]).unionByName(rare.join(tail, ["a", "b"]))
    per = joined.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"),
                                    F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    base = stored.select("row", "doc_id", *COUNTS, "groups_sha256")
    return base.join(per, "row", "left").select(
        "doc_id", *COUNTS, *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")],
        "groups_sha256")
