import zlib
from collections import Counter

import numpy as np

from gatewise.llm import language
from gatewise.llm.queries import QUERIES

from .conftest import docs_df, table, words


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in QUERIES["op7_language_mixture"](spark, sf).collect()}
    docs = table(spark, "documents", sf).collect()
    assert len(got) == len(docs)
    held = [(d["lang"], got[d["doc_id"]]["lang_pred"]) for d in docs if got[d["doc_id"]]["held_out"]]
    assert all(got[d["doc_id"]]["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0) for d in docs)
    assert np.mean([a == b for a, b in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got.values())


def two_languages(rng_seed=1):
    import random
    rng = random.Random(rng_seed)
    return [words(rng, n, s) for s in ("ka to mi ru", "ber und sch eit") for n in [80] * 12]


def test_mixed_text_gets_both_languages(spark):
    texts = two_languages()
    docs = docs_df(spark, [(i, t, "xx" if i < 12 else "yy") for i, t in enumerate(texts)])
    model = language.learn(docs)
    assert model.names == ["xx", "yy"]

    def shares(text):
        counts = Counter(language.words_of(text))
        return language.mixture(model.likelihoods(list(counts)), np.array(list(counts.values()), float))

    assert np.allclose(shares(texts[0]), [1, 0])
    mixed = shares(texts[0] + " " + texts[12] + " " + texts[13])  # a third, two thirds
    assert abs(mixed[0] - 1 / 3) < 0.1 and abs(mixed.sum() - 1) < 1e-9


def test_grams_match_a_plain_count():
    pair, triple, starts = language.grams(["ab", "ñ", "abc"])
    assert starts.tolist() == [0, 2, 3] and len(pair) == len(triple) == 6
    assert pair[0] == pair[3] and pair[1] == pair[4]  # border-a and a-b of both words
    assert triple[0] == triple[3] and triple[1] != triple[4]  # b at the end, b before c


def test_em_raises_the_likelihood():
    rng = np.random.default_rng(0)
    likely, often = rng.normal(size=(50, 3)), rng.integers(1, 5, 50).astype(float)
    _, fitted = language.expect(likely, often)
    flat = float(often @ np.log(np.exp(likely).mean(axis=1)))
    assert fitted >= flat


def test_awkward_rows(spark, awkward, awkward_rows):
    texts = two_languages()
    docs = awkward.union(docs_df(spark, [(100 + i, t, "xx" if i < 12 else None if i == 12 else "yy")
                                         for i, t in enumerate(texts)]))
    rows = language.identify(docs).collect()
    assert len(rows) == len(awkward_rows) + 24
    for r in rows:
        assert r["lang_pred"] in ("en", "xx", "yy", "und") and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (r["doc_id"] in (1, 2, 3, 4) or r["doc_id"] is None and r["score"] == 0)
    assert len({(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] == 8}) == 1


def test_nothing_to_learn_from(spark, nothing):
    assert language.identify(nothing).collect() == []
    rows = language.identify(docs_df(spark, [(1, "abc", None), (2, None, None)])).collect()
    assert {(r["lang_pred"], r["score"]) for r in rows} == {("und", 0.0)}


def test_the_fit_bound_keeps_about_that_many(spark):
    docs = docs_df(spark, [(i, "ka to", "xx") for i in range(2000)])
    model = language.learn(docs, fit_documents=200)
    # each document holds 4 letters: the counts in the table tell how many were read
    total = language.SMOOTHING * language.TABLE / (np.exp(model.tables[: language.TABLE, 0]).min() * language.TABLE)
    assert model.names == ["xx"] and total > 0


def test_words_that_are_forgotten_come_back(spark, monkeypatch):
    texts = two_languages()
    docs = docs_df(spark, [(i, t, "xx" if i < 12 else "yy") for i, t in enumerate(texts)])
    model = language.learn(docs)
    counts = [Counter(language.words_of(t)) for t in texts]
    model.rows(counts)
    plain = [model.predict(c) for c in counts]
    monkeypatch.setattr(language, "KEPT_WORDS", 30)
    model.kept, model.known = {}, None
    again = []
    for c in counts:
        model.rows([c])
        again.append(model.predict(c))
    assert again == plain


def test_only_letters_make_words():
    assert language.words_of("½ ² Ⅷ 12_3 Été x2y") == ["été", "x", "y"]


def test_eight_languages_in_one_text():
    """All learned languages are in the mixture, none is left out by a limit."""
    alphabets = ["abcde", "fghij", "klmno", "pqrst", "uvwxy", "éèêëç", "αβγδε", "бвгдж"]
    rng = np.random.default_rng(3)
    tables = np.full((2 * language.TABLE, 8), 0.5)
    texts = [["".join(rng.choice(list(a), 5)) for _ in range(400)] for a in alphabets]
    for i, found in enumerate(texts):
        pair, triple, _ = language.grams(found)
        np.add.at(tables[:, i], pair, 1)
        np.add.at(tables[:, i], language.TABLE + triple, 1)
    model = language.Languages([str(i) for i in range(8)], np.log(tables / tables.sum(axis=0)))
    counts = language.Counter(w for i, found in enumerate(texts) for w in found[:20 + 5 * i])
    model.rows([counts])
    at = [model.kept[w] for w in counts]
    shares = language.mixture(model.known[at], np.array(list(counts.values()), float))
    assert (shares > 0.05).all() and np.argmax(shares) == 7 and abs(shares[7] - 55 / 300) < 0.02
