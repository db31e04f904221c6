import random
from collections import defaultdict

import numpy as np

from gatewise.llm import chunking, substrings
from gatewise.llm.queries import QUERIES

from .conftest import SF, docs_df, table, words


def brute_chunks(data, reach, window):
    """Borders by the definition, byte by byte."""
    gear = [int(x) for x in chunking.GEAR]
    each = 32 // window
    h = [sum(gear[data[i - k]] << (k * each) for k in range(min(window, i + 1))) % (1 << 32) for i in range(len(data))]
    ends = []
    for i in range(reach, len(data) - reach):
        if h[i] <= min(h[i - reach:i + reach + 1]) and (not ends or i + 1 - ends[-1] > reach):
            ends.append(i + 1)
    return ends + [len(data)]


def test_borders_match_the_definition():
    rng = random.Random(1)
    for n in (1, 5, 32, 33, 34, 100, 700):
        data = words(rng, 200).encode()[:n]
        assert chunking.low_points(data, 16, 16).tolist() == brute_chunks(data, 16, 16)
    for data in (b"be " * 90, b"x" * 200, b"abcdefghijklmnopqrstuvwxyz" * 9):
        assert chunking.low_points(data, 16, 16).tolist() == brute_chunks(data, 16, 16)
    assert chunking.low_points(b"", 16).tolist() == []
    data = words(rng, 400).encode()
    assert chunking.rolling(data, 32)[500] == sum(int(chunking.GEAR[data[500 - k]]) << k for k in range(32)) % (1 << 32)


def test_insertions_move_nearby_borders_only():
    data = words(random.Random(2), 2000).encode()
    a = chunking.low_points(data, 16, 16)
    b = chunking.low_points(data[:3000] + b"inserted" + data[3000:], 16, 16)
    assert [x for x in a if x < 2900] == [x for x in b if x < 2900]
    assert [x + 8 for x in a if x > 3100] == [x for x in b if x > 3108]


def test_planted_passages_are_caught_and_clean_documents_left(spark):
    rng = random.Random(3)
    passages = [words(rng, rng.randint(60, 120)) for _ in range(40)]
    rows, holders = [], set()
    for i in range(300):
        body = words(rng, 150)
        if i % 3 == 0:
            cut = rng.randint(0, len(body))
            body = body[:cut] + " " + passages[i // 3 % 40] + " " + body[cut:]
            holders.add(i)
        rows.append((i, body))
    got = substrings.passages(docs_df(spark, rows)).collect()
    assert {r["doc_id"] for r in got} == holders
    texts = dict(rows)
    for r in got:
        piece = texts[r["doc_id"]].encode()[r["start"]:r["stop"]]
        assert piece in passages[r["doc_id"] // 3 % 40].encode() or r["words"] >= 20
        assert r["first_doc_id"] in holders and r["kept"] == (r["doc_id"] == r["first_doc_id"])


def test_matches_brute_force_chunk_table(spark):
    docs = [(d["doc_id"], d["text"] or "") for d in table(spark, "documents").collect()]
    where = defaultdict(set)
    cut = {}
    for i, t in docs:
        starts, ends, n, digests = substrings.chunk_rows(t)
        cut[i] = list(zip(starts, ends, n, digests, strict=True))
        for d in digests:
            where[d].add(i)
    want = set()
    for i, parts in cut.items():
        run = []
        for part in [*parts, None]:
            if part and len(where[part[3]]) > 1:
                run.append(part)
            elif run:
                if sum(p[2] for p in run) >= substrings.LEAST_WORDS:
                    want.add((i, int(run[0][0]), int(run[-1][1]), int(sum(p[2] for p in run)),
                              min(min(where[p[3]]) for p in run)))
                run = []
    got = {(r["doc_id"], r["start"], r["stop"], r["words"], r["first_doc_id"])
           for r in QUERIES["op8_gear_chunks"](spark, SF).collect()}
    assert got == want


def test_awkward_rows(awkward, nothing):
    rows = substrings.passages(awkward).collect()
    assert {r["doc_id"] for r in rows} == {7, 8, 9, 10, 11, None}  # a null id holds a passage but is nobody's first
    assert all(r["first_doc_id"] in (7, 10) for r in rows)
    assert substrings.passages(nothing).collect() == []


def test_runs_of_one_word_are_passages_too(spark):
    rng = random.Random(6)
    rows = [(i, words(rng, 30) + " same" * (80 + i) + " " + words(rng, 30)) for i in range(3)]
    assert {r["doc_id"] for r in substrings.passages(docs_df(spark, rows)).collect()} == {0, 1, 2}


def test_repeats_inside_one_document_do_not_count(spark):
    line = words(random.Random(9), 80)
    assert substrings.passages(docs_df(spark, [(1, line + "\n" + line), (1, line), (2, "other words")])).collect() == []


def test_words_are_counted_where_they_end():
    text = "one two  three\nfour five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    assert int(np.sum(substrings.chunk_rows(text)[2])) == 14  # the last one does not end in white space


def kept_somewhere(spark, rows):
    """Cut ``drop`` out of every text; the rest, by doc_id, with the rows found."""
    got = substrings.passages(docs_df(spark, rows)).collect()
    left = {i: t.encode() for i, t in rows}
    for r in got:
        for d in r["drop"]:
            left[r["doc_id"]] = left[r["doc_id"]][:d["start"]] + b"\0" * (d["stop"] - d["start"]) + left[r["doc_id"]][d["stop"]:]
    for i, text in rows:  # every chunk of every text stays in some text
        starts, ends, _, _ = substrings.chunk_rows(text)
        for a, z in zip(starts.tolist(), ends.tolist(), strict=True):
            piece = text.encode()[a:z]
            assert any(piece in x for x in left.values()), (i, a, z)
    return got, left


def test_overlapping_passages_are_kept_somewhere(spark):
    rng = random.Random(21)
    p, q = words(rng, 60), words(rng, 60)
    rows = [(1, words(rng, 40) + " " + p + " " + words(rng, 40)),
            *[(i, words(rng, 40) + " " + p + " " + q + " " + words(rng, 40)) for i in (2, 3)]]
    got, left = kept_somewhere(spark, rows)
    assert {r["doc_id"] for r in got} == {1, 2, 3}
    middle = {"p": p.encode()[100:-100], "q": q.encode()[100:-100]}
    holds = {k: [i for i, x in left.items() if v in x] for k, v in middle.items()}
    assert holds == {"p": [1], "q": [2]}
    assert {d["first_doc_id"] for r in got if r["doc_id"] == 3 for d in r["drop"]} == {1, 2}


def test_a_chunk_common_elsewhere_does_not_take_the_passage_along(spark):
    rng = random.Random(22)
    p = words(rng, 60)
    starts, ends, _, _ = substrings.chunk_rows(p)
    k = len(ends) // 2  # one chunk and as much of its neighbours as its borders need
    phrase = p.encode()[starts[k - 1]:ends[k + 1]].decode()
    rows = [(1, words(rng, 40) + " " + phrase + " " + words(rng, 40)),
            *[(i, words(rng, 40) + " " + p + " " + words(rng, 40)) for i in (5, 9)]]
    got, left = kept_somewhere(spark, rows)
    assert {r["doc_id"]: (r["first_doc_id"], r["kept"]) for r in got} == {5: (1, False), 9: (1, False)}
    assert p.encode()[100:-100] in left[5] or {d["first_doc_id"] for r in got if r["doc_id"] == 5 for d in r["drop"]} == {1}
    assert p.encode()[100:-100] not in left[9]


def test_chunks_of_different_documents_do_not_add_up(spark):
    rng = random.Random(23)
    body = words(rng, 200)
    starts, ends, _, _ = substrings.chunk_rows(body)
    rows = [(0, body)]
    for k in range(4, 16):  # each chunk recurs alone, in a document of its own
        reach = body.encode()[starts[k] - 33:ends[k] + 17].decode()
        rows.append((k, words(rng, 40) + " " + reach + " " + words(rng, 40)))
    where = defaultdict(set)
    for i, t in rows:
        for d in substrings.chunk_rows(t)[3]:
            where[d].add(i)
    repeated = [len(where[d]) > 1 for d in substrings.chunk_rows(body)[3]]
    assert sum(repeated) > 6
    assert substrings.passages(docs_df(spark, rows)).collect() == []
