import hashlib
import random
from collections import Counter

import numpy as np

from gatewise.llm import sketches
from gatewise.llm.queries import QUERIES

from .conftest import SF, docs_df, table, words


def in_order(rows):
    """(doc_id, text) by descending id, nulls last; the tests' ids do not repeat with different texts."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0), reverse=True)


def brute(rows):
    """{row: (n_chars, edited digest, likeness to the edited, to the next)} from multisets of paragraphs."""
    def alike(a, b):
        a, b = Counter(sketches.paragraphs(a)), Counter(sketches.paragraphs(b))
        return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0

    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        third = len(text) // 3
        new = text[:len(text) - third] + after[:third]
        out.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), round(alike(text, new), 9),
                    round(alike(text, after), 9)))
    return out


def got(df):
    return [(r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9))
            for r in df.collect()]


def test_query_matches_brute_force(spark):
    rows = sorted(((d["doc_id"], d["text"] or "") for d in table(spark, "documents").collect()), reverse=True)
    found = QUERIES["op9_invertible_sketches"](spark, SF)
    assert sorted(got(found)) == sorted(brute(rows))


def test_awkward_rows(awkward, awkward_rows):
    rows = sketches.compare(awkward).collect()
    assert sorted(str((r["doc_id"], r["n_chars"])) for r in rows) == sorted(
        str((i, len(t or ""))) for i, t in awkward_rows)
    by_length = {}
    for r in rows:
        by_length.setdefault((r["doc_id"] in (1, 2, 3), r["n_chars"], r["doc_id"] in (7, 8)), set()).add(r["fingerprint"])
    assert len(by_length[True, 0, False]) == 1  # null and empty texts
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)


def test_sequence_wraps_and_one_document_follows_itself(spark, nothing):
    assert sketches.compare(nothing).collect() == []
    rng = random.Random(2)
    one = [(7, "\n".join(words(rng, 12) for _ in range(9)))]
    assert got(sketches.compare(docs_df(spark, one))) == brute(one)
    many = sorted([(i, "\n".join(words(rng, 12) for _ in range(i % 7))) for i in range(-20, 60, 3)], reverse=True)
    assert sorted(got(sketches.compare(docs_df(spark, many)))) == sorted(brute(many))


def test_peeling_recovers_what_differs():
    rng = np.random.default_rng(1)
    pairs, want = [], []
    for shared, left, right in [(0, 0, 0), (500, 0, 0), (300, 3, 5), (40, 0, 60), (2000, 700, 10), (0, 1, 0)]:
        keys = rng.integers(0, 1 << 63, shared + left + right).astype(np.uint64)
        pairs.append((keys[:shared + left], np.concatenate([keys[:shared], keys[shared + left:]])))
        want.append((sorted(keys[shared:shared + left]), sorted(keys[shared + left:])))
    lost, gained, cells = sketches.differing(pairs)
    assert [(sorted(a), sorted(b)) for a, b in zip(lost, gained, strict=True)] == want
    assert all(3 * c >= len(a) + len(b) for c, (a, b) in zip(cells, want, strict=True))
    assert cells[1] == cells[2] == sketches.PART_CELLS


def test_a_full_table_fails_and_a_larger_one_works():
    keys = np.arange(1, 60, dtype=np.uint64)
    none = np.zeros(0, np.uint64)
    assert not sketches.peel(sketches.sketch([keys], 8), sketches.sketch([none], 8))[3].any()
    assert sketches.differing([(keys, none)])[2][0] > 8


def test_every_difference_is_recovered_at_last():
    rng = np.random.default_rng(2)
    pairs = []
    for _ in range(400):
        a = rng.integers(0, 1 << 63, rng.integers(0, 80)).astype(np.uint64)
        b = rng.integers(0, 1 << 63, rng.integers(0, 80)).astype(np.uint64)
        pairs.append((np.concatenate([a, b[: len(b) // 2]]), b))
    lost, gained, _ = sketches.differing(pairs)
    for (a, b), x, y in zip(pairs, lost, gained, strict=True):
        assert set(x.tolist()) == set(a.tolist()) - set(b.tolist()) and set(y.tolist()) == set(b.tolist()) - set(a.tolist())


def test_a_line_is_cut_alike_wherever_it_stands():
    line = words(random.Random(8), 300)
    alone = sketches.paragraphs(line)
    assert len(alone) > 5 and b"".join(alone).replace(b" ", b"") == line.encode().replace(b" ", b"")
    assert set(sketches.paragraphs("another line\n" + line + "\nand one more")) == {*alone, b"another line", b"and one more"}


def test_fingerprints_read_back():
    table = sketches.sketch([sketches.digests("a\nb\nb\nc")])
    again = sketches.read(sketches.written(*[x[0] for x in table]))
    assert all((x == y).all() for x, y in zip(table, again, strict=True))
    assert table.count.sum() == 3 * 4


def test_lost_and_gained_are_the_paragraph_digests(spark):
    rng = random.Random(4)
    rows = [(2, "\n".join(words(rng, 10) for _ in range(12))), (1, "\n".join(words(rng, 10) for _ in range(12)))]
    r = sketches.compare(docs_df(spark, rows)).where("doc_id = 2").first()
    new = sketches.edited(rows[0][1], rows[1][1])
    a, b = set(sketches.digests(rows[0][1]).tolist()), set(sketches.digests(new).tolist())
    unsigned = lambda xs: {x & ((1 << 64) - 1) for x in xs}
    assert unsigned(r["lost"]) == a - b and unsigned(r["gained"]) == b - a


def test_large_and_null_ids_have_the_right_neighbours(spark):
    rng = random.Random(12)
    rows = [((1 << 60) + i, f"text {i} " + words(rng, 6)) for i in range(4000)] + [(None, "nobody's text"), (None, "nobody's text")]
    found = sketches.compare(docs_df(spark, rows).repartition(7))
    digests = sorted((str(r["doc_id"]), r["edited_sha256"]) for r in found.collect())
    assert digests == sorted((str(i), sha) for i, _, sha, _, _ in brute(in_order(rows)))


def test_text_ids(spark):
    rng = random.Random(13)
    rows = [(f"é{i % 7}-{i}", f"text {i} " + words(rng, 9)) for i in range(300)]
    found = sketches.compare(spark.createDataFrame(rows, "doc_id string, text string").repartition(3))
    assert sorted(got(found)) == sorted(brute(sorted(rows, key=lambda r: r[0].encode(), reverse=True)))


def test_a_hot_id_is_cut_into_parts(spark):
    rng = random.Random(14)
    rows = [(None, words(rng, 5)) for _ in range(600)] + [(3, "one text")] * 600 + [(i, words(rng, 5)) for i in range(10, 40)]
    parts = sketches.sequence(docs_df(spark, rows).repartition(4), "doc_id", "text").where("ghost = 0").groupBy("part").count()
    assert max(r["count"] for r in parts.collect()) < 300


def test_short_texts_of_one_line_resemble_their_edits(spark):
    rng = random.Random(15)
    rows = [(i, words(rng, 9)) for i in range(60)]
    found = sketches.compare(docs_df(spark, rows)).collect()
    assert all(r["near_edited"] > r["near_next"] == 0 for r in found)
