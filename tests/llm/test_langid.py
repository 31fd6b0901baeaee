import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bankspark.llm import langid
from tests.llm.util import odd_rows

WORDS = {"en": ["the", "with", "thing", "other", "ring"], "fr": ["que", "les", "eaux", "être", "oui"], "de": ["der", "und", "schon", "über", "ich"]}


def corpus(n=150, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        lang = rnd.choice(list(WORDS))
        out.append((i, " ".join(rnd.choice(WORDS[lang]) + rnd.choice(["", "s", rnd.choice(WORDS[lang])]) for _ in range(rnd.randint(3, 60))).title(), lang))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(spark.createDataFrame(corpus(), "doc_id long, text string, lang string"))


def brute(word, probs, pieces):
    """Sum over all segmentations, by recursion."""
    if not word:
        return 1.0
    return sum(probs[i] * brute(word[len(p):], probs, pieces) for i, p in pieces if word.startswith(p))


def test_forward_sums_all_segmentations():
    pieces = [b"a", b"b", b"ab", b"ba", b"aba", b" ", b" a"]
    probs = np.array([[0.3, 0.1], [0.2, 0.2], [0.1, 0.3], [0.1, 0.1], [0.1, 0.1], [0.1, 0.1], [0.1, 0.1]])
    words = [b" abab", b" a", b" bbaabab", b" abaabaaba"]
    got = langid.log_probs(langid.Trie(pieces), probs, words)
    for w, row in zip(words, got):
        for lang in range(2):
            assert math.isclose(row[lang], math.log(brute(w, probs[:, lang], list(enumerate(pieces)))), rel_tol=1e-9)


def test_expected_counts_spell_the_words():
    pieces = [b"a", b"b", b"ab", b" ", b" a"]
    probs = np.full((5, 1), 0.2)
    words, counts = [b" ab", b" bab"], np.array([[2.0], [3.0]])
    got = langid.expected_counts(langid.Trie(pieces), probs, words, counts)
    assert math.isclose(sum(got[i, 0] * len(p) for i, p in enumerate(pieces)), 2 * 3 + 3 * 4)


def test_held_out_texts_are_told(spark, model):
    docs = spark.createDataFrame(corpus(200, seed=2), "doc_id long, text string, lang string")
    rows = langid.identify(docs, model).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97 and all(0 < r.score <= 1 for r in rows)


def test_odd_rows(spark, model):
    docs = spark.createDataFrame([(*r, "mine") for r in odd_rows()], "doc_id long, text string, score string")
    out = langid.identify(docs, model, score_out="llm_score")
    assert out.columns == ["doc_id", "text", "score", "lang_pred", "llm_score"] and out.count() == docs.count()
    told = {r.doc_id: (r.lang_pred, r.llm_score) for r in out.filter("doc_id is not null").collect()}
    for i in (1, 2, 3, 8):
        assert told[i] == ("und", 0.0)
    assert told[4][0] == "en" and told[7][0] in WORDS and told[9][0] in WORDS
    assert out.filter(F.col("text").isNull()).filter("lang_pred != 'und'").count() == 0
    assert langid.identify(docs.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "hello", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert langid.fit(docs) is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}


def test_long_runs_of_letters_are_scored_whole():
    parts = langid.words_of("É" * 100 + " x")
    assert b"".join(parts[:-1]) == b" " + ("é" * 100).encode() and all(len(p) <= langid.MAX_WORD for p in parts)


def test_numerals_are_no_letters(spark, model):
    assert list(langid.letters("½ ² ⅷ ① añb²c_d1 漢字½x")) == ["añb", "c", "d", "漢字", "x"]
    docs = spark.createDataFrame([(1, "½ ²"), (2, "ⅷ ① 3"), (3, "the ² of")], "doc_id long, text string")
    told = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    assert told[1] == told[2] == ("und", 0.0) and told[3][0] != "und"
