import hashlib
from collections import defaultdict

from gatewise.llm import exact_dedup

from .conftest import SF, docs_df, table


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return groups


def test_marks_match_brute_force(awkward, awkward_rows):
    rows = exact_dedup.mark(awkward).collect()
    assert len(rows) == len(awkward_rows)
    by_sha = defaultdict(list)
    for r in rows:
        by_sha[r["text_sha256"]].append(r)
    groups = brute(awkward_rows)
    assert len(by_sha) == len(groups)
    for text, ids in groups.items():
        got = by_sha[hashlib.sha256(text.encode()).hexdigest()]
        best = max(ids, key=lambda i: (i is not None, i))
        assert {r["group_size"] for r in got} == {len(ids)}
        assert {r["keep_id"] for r in got} == {best}
        assert [r["doc_id"] for r in got if r["kept"]] == [best]


def test_rows_that_stay_keep_their_columns(awkward, awkward_rows):
    out = exact_dedup.deduplicate(awkward)
    assert out.columns == awkward.columns
    want = sorted(str((max(ids, key=lambda i: (i is not None, i)), t)) for t, ids in brute(awkward_rows).items())
    assert sorted(str((r["doc_id"], r["text"] or "")) for r in out.collect()) == want


def test_empty_table(nothing):
    assert exact_dedup.mark(nothing).collect() == []
    assert exact_dedup.deduplicate(nothing).collect() == []


def test_colliding_names_are_found_and_lengthened(spark, monkeypatch):
    texts = [f"text number {i % 400}" for i in range(800)]
    docs = docs_df(spark, list(enumerate(texts)))
    rows = exact_dedup.id_and_text(docs).selectExpr("doc_id", "doc_id AS row_id", "text")
    assert not exact_dedup.names_hold(rows, 1)  # 400 contents, 256 names
    assert exact_dedup.names_hold(rows, 16)
    got = exact_dedup.mark(docs, name_bytes=1).collect()
    assert {r["group_size"] for r in got} == {2}
    assert all(r["keep_id"] == r["doc_id"] % 400 + 400 for r in got)


def test_long_texts_share_all_but_the_changed_chunks():
    import random
    rng = random.Random(1)
    text = " ".join(str(rng.random()) for _ in range(4000))
    a, b = exact_dedup.chunks(text), exact_dedup.chunks("inserted " + text)
    assert b"".join(a).decode() == text
    assert len(set(a) - set(b)) <= 2


def test_query_on_a_table(spark):
    from gatewise.llm.queries import QUERIES
    docs = table(spark, "documents")
    got = QUERIES["op4_chunk_recipes"](spark, SF)
    assert got.count() == docs.count()
    assert got.where("kept").count() == docs.selectExpr("coalesce(text, '') t").distinct().count()
