import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gatewise.llm import bpe
from gatewise.llm.queries import QUERIES, word_vocabulary

from .conftest import SF, table


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(word_vocabulary())


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_query_matches_the_library(spark, library):
    got = {r["doc_id"]: r for r in QUERIES["op3_bpe_trie"](spark, SF).collect()}
    docs = table(spark, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, text = expected(library, d["text"])
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_awkward_rows(spark, awkward, awkward_rows, library):
    coded = bpe.encode(awkward, word_vocabulary())
    rows = coded.collect()
    want = sorted((str(i), *expected(library, t)) for i, t in awkward_rows)
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in rows) == want
    back = bpe.decode(coded, word_vocabulary()).collect()
    assert sorted((str(r["doc_id"]), r["decoded"]) for r in back) == [(a, c) for a, _, c in want]


def test_empty_table(nothing):
    assert bpe.encode(nothing, word_vocabulary()).collect() == []


TEXTS = st.lists(st.one_of(st.text(max_size=30), st.text("aeothinsr", max_size=40), st.text("ab", max_size=60),
                           st.text("!#'s l\n<|>ÄéΣ中😀", max_size=20),
                           st.sampled_from(["<|endoftext|>", "<|startoftext|>", "It's", "we'll"])), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_random_texts_match_the_library(library, texts):
    coder = bpe.word_bpe(word_vocabulary())
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        want, decoded = expected(library, text)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert coder.decode(ids) == decoded


def test_shared_prefixes_are_walked_once(library):
    merges = bpe.word_bpe(word_vocabulary()).merges
    calls = []
    plain = merges.last
    merges.last = lambda tail, states, backwards: calls.append(len(tail)) or plain(tail, states, backwards)
    try:
        out = merges.encode_words(["transport", "transports", "transported", "trans"])
    finally:
        del merges.last
    assert set(out) == {"transport", "transports", "transported", "trans"}
    inner = 10  # t..transporte: the prefixes that words go on from
    assert len(calls) == inner + 4  # and one ending per word


def test_the_kept_words_may_be_emptied(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_CHARS", 40)
    coder = bpe.WordBpe(word_vocabulary())
    texts = ["some words that come and go", "other words that stay", "some words again and again"]
    for text in texts:
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == expected(library, text)[0]


def test_words_met_lately_stay_when_memory_is_short(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_CHARS", 60)
    coder = bpe.WordBpe(word_vocabulary())
    walked = []
    plain = coder.merges.walk
    monkeypatch.setattr(coder.merges, "walk", lambda words: walked.extend(words) or plain(words))
    for rare in ("alphabet", "bicycles", "cathedral", "dolphins", "elephants", "furniture"):
        text = f"common {rare}"
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == expected(library, text)[0]
    assert walked.count("common") == 1 and len(walked) == 7
    assert sum(len(w) for w in [*coder.kept, *coder.older]) <= 60
