import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from gatewise.llm import divergence
from gatewise.llm.queries import QUERIES

from .conftest import SF, docs_df, table, words

WORD = r"[^\x20\x09-\x0D]+"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute(text):
    """The base counts in plain Python, each read off its definition."""
    text = text or ""
    found = re.findall(WORD, text)
    windows = [tuple(found[i:i + 5]) for i in range(len(found) - 4)]
    seen = Counter(windows)
    inside = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(5)}
    lines = text.split("\n")
    doubled = sum(bool(re.search(WORD, line)) and line in lines[:i] for i, line in enumerate(lines))
    counts = (len(found), sum(len(w) for w in found), len(re.findall(r"[#*$%&|<>]", text)), doubled, len(inside))
    return *counts, len(found) < 10 or 100 * len(inside) > 20 * len(found)


def got(rows):
    return sorted((str(r["doc_id"]), *[r[c] for c in COUNTS], r["base_failed"]) for r in rows)


def test_base_counts_of_the_query_match_brute_force(spark):
    rows = QUERIES["op13_language_divergence"](spark, SF).collect()
    assert got(rows) == sorted((str(r["doc_id"]), *brute(r["text"])) for r in table(spark, "documents").collect())
    assert not any(r["kept"] and r["base_failed"] for r in rows)


def test_clean_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in QUERIES["op13_language_divergence"](spark, sf).collect()}
    marked = [(rows[r["doc_id"]], r["quality"]) for r in table(spark, "labels", sf).collect()]
    judged = [(r["kept"], q) for r, q in marked if not r["base_failed"]]
    assert np.mean([k for k, q in judged if q == 1]) > 0.98
    assert np.mean([not k for k, q in judged if q == 0]) > 0.85  # the rest are texts of about 100 words or fewer


def reference_brute(rows):
    """Mean class shares and common words per language, from (text, lang) rows."""
    out = {}
    for lang in sorted({lang for t, lang in rows if lang is not None}):
        docs, shares, held, classes = 0, Counter(), Counter(), np.zeros(len(divergence.CLASSES), dtype=np.int64)
        for text, own in rows:
            found = re.findall(WORD, text or "")
            if own != lang or len(found) < divergence.REFERENCE_WORDS:
                continue
            docs += 1
            for w, k in Counter(w.encode().lower() for w in found).items():
                held[w] += 1
                shares[w] += k * divergence.UNIT // len(found)
            c = divergence.class_counts(divergence.byte_counts(text.encode()))
            classes += c * divergence.UNIT // c.sum()
        top = sorted((w for w in held if w), key=lambda w: (-held[w], w))[:divergence.COMMON]
        if docs:
            out[lang] = (docs, classes.tolist(), [(w.decode(), shares[w]) for w in top])
    return out


def test_references_match_brute_force(spark, monkeypatch):
    docs = table(spark, "documents").repartition(6)
    found = {r["lang"]: (r["documents"], [c["share"] for c in r["classes"]], [(w["word"], w["share"]) for w in r["words"]])
             for r in divergence.references(docs)}
    assert found == reference_brute([(r["text"], r["lang"]) for r in docs.collect()])


def test_distance_is_jensen_shannon():
    p, q = np.array([0.5, 0.5, 0.0]), np.array([[0.5, 0.5, 0.0], [0.0, 0.0, 1.0], [0.25, 0.25, 0.5]])
    want = []
    for row in q:
        m = (p + row) / 2
        kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x > 0)  # noqa: B023, E731
        want.append(math.sqrt((kl(p) + kl(row)) / 2))
    assert divergence.distance(p, q) == pytest.approx(want) and want[:2] == [0, 1]


def test_character_classes_cover_all_characters():
    text = "".join(chr(c) for c in [*range(0, 0x250), 0x416, 0x5D0, 0x4E2D, 0x20AC, 0x1F600]) + "##"
    counts = dict(zip(divergence.CLASSES, divergence.class_counts(divergence.byte_counts(text.encode())).tolist()))
    assert sum(counts.values()) == len(text)
    assert counts["lower"] == counts["upper"] == 26 and counts["digit"] == 10 and counts["symbol"] == 10
    assert counts["beyond"] == 1 and counts["wide"] == 2 and counts["letters_d0"] == 2


def test_repeated_windows_of_long_texts():
    rng = random.Random(1)
    for n, kinds in [(4, 1), (5, 1), (6, 1), (40, 2), (300, 3), (3000, 40), (200, 200)]:
        found = [f"w{rng.randrange(kinds)}" for _ in range(n)]
        assert divergence.repeated_words([w.encode() for w in found]) == brute(" ".join(found))[4]


def test_awkward_rows(awkward, awkward_rows):
    rows = divergence.judge(awkward).collect()
    assert got(rows) == sorted((str(i), *brute(t)) for i, t in awkward_rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert not by_id[1]["kept"] and by_id[1]["nearest"] is None and by_id[7]["nearest"] == "en"


def test_guards_spare_short_texts_and_far_texts_fail(spark):
    rng = random.Random(9)
    base = [(i, words(rng, 300), "xx") for i in range(20)]
    own = words(rng, 300)
    extra = [(100, " ".join(f"{w.upper()}!!" for w in own.split())), (101, own), (102, " ".join(own.upper().split()[:12])[:90]),
             (103, " | ".join(f"q{i}zk{i}" for i in range(300)))]
    df = docs_df(spark, base + [(*r, None) for r in extra])
    kept = {r["doc_id"]: r["kept"] for r in divergence.judge(df).collect()}
    assert all(kept[i] for i in range(20)) and not kept[100] and kept[101] and kept[102] and not kept[103]


def test_no_language_and_no_rows(spark, nothing):
    rng = random.Random(2)
    df = docs_df(spark, [(1, words(rng, 80), None), (2, "few words", None)])
    assert {r["doc_id"]: (r["kept"], r["nearest"]) for r in divergence.judge(df).collect()} == {1: (True, None), 2: (False, None)}
    assert divergence.judge(nothing).collect() == []


def test_counted_words_are_sent_on_in_parts(spark, monkeypatch):
    docs = table(spark, "documents").repartition(2)
    whole = divergence.references(docs)
    monkeypatch.setattr(divergence, "HELD_WORDS", 300)
    assert divergence.references(docs) == whole
