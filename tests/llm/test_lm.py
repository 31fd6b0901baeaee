import inspect
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark import SparkFiles
from pyspark.sql import functions as F

from bankspark.llm import lm
from bankspark.llm.common import id_remainder
from bankspark.llm.ngram_trie import ORDER, EliasFano, Quantised, Trie, gram_counts
from tests.llm.util import docs_frame, odd_rows, remainder, similar_docs


def vocabulary(n=800, seed=1):
    rnd = random.Random(seed)
    return sorted({"".join(rnd.choice(["th", "er", "on", "é", "x", "\x01"]) for _ in range(rnd.randint(1, 5))).encode() for _ in range(n)}) + [b""]


def trie_of(words, classes=None):
    counts = gram_counts(words, classes)
    return Trie.build([a for a, _ in counts], [b.astype(float) for _, b in counts])


@pytest.mark.parametrize("values", [[0], [5, 5, 5], list(range(0, 90000, 7)), sorted(random.Random(2).randrange(10**7) for _ in range(999))])
def test_elias_fano_round_trip(values):
    assert EliasFano.of(np.array(values))[np.arange(len(values))].tolist() == values


def test_quantised_numbers_are_near():
    x = np.random.default_rng(1).normal(size=5000)
    q = Quantised.of(x)
    assert q.codes.dtype == np.uint8 and np.median(np.abs(q[np.arange(5000)] - x)) < 0.02
    few = np.array([0.5, -1.0, 0.5])
    assert Quantised.of(few)[np.arange(3)].tolist() == few.tolist()


def brute_score(words, w, order=6, discount=0.75):
    """The same smoothing by dictionaries, unquantised."""
    n = Counter({b"\1": 1})
    for x in words:
        s = b"\1" + x + b" "
        for i in range(1, len(s)):
            for k in range(1, order + 1):
                if i - k + 1 >= 0:
                    n[s[i - k + 1:i + 1]] += 1
    mass, kinds = Counter(), Counter()
    for g, c in n.items():
        mass[g[:-1]] += c
        kinds[g[:-1]] += 1

    def p(context, b):
        lower = p(context[1:], b) if context else 1 / 256
        return max(n[context + b] - discount, 0) / mass[context] + discount * kinds[context] / mass[context] * lower if mass[context] else lower

    s = b"\1" + w + b" "
    return sum(math.log10(p(s[max(0, i - order + 1):i], s[i:i + 1])) for i in range(1, len(s)))


def test_trie_gives_the_smoothed_probabilities(tmp_path):
    words = vocabulary(300)
    trie = trie_of(words)
    (tmp_path / "t").write_bytes(trie.dump())
    asked = words[:40] + [b"therzz", "éé".encode(), b"", b"q" * 300]
    got = trie.score(asked)
    assert np.array_equal(got, Trie.open(str(tmp_path / "t")).score(asked))
    want = np.array([brute_score(words, w) for w in asked])
    # Quantised: near for grams that occur, within a hundredth of the whole otherwise.
    assert np.abs(got - want).max() < 0.01 * np.abs(want).max() and np.median(np.abs(got - want)) < 0.1


def test_next_bytes_sum_to_one():
    trie = trie_of(vocabulary(300))
    base = trie.score([b"th"])[0]
    parts = [trie.score([b"th" + bytes([b])]) for b in range(256) if b != 32]
    assert np.isfinite(base) and all(np.isfinite(x).all() for x in parts)
    assert 10 ** base + sum(10 ** x[0] for x in parts) < 1


def test_base_counts_and_held_out(spark):
    rows = odd_rows() + [(1000 + i, t) for i, t in similar_docs(60)]
    got = lm.score_corpus(docs_frame(spark, rows), id_remainder("doc_id", 5) == 1)
    got = sorted((None if r.k_id == -2**63 else r.k_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got.collect() if r.k_id > 0)
    tokens = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    c = Counter(w for i, t in tokens if remainder(i, 5) != 1 for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted(
        (i, remainder(i, 5) == 1, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6))
        for i, t in tokens if i is not None)
    assert got == want


def test_score_beats_the_base_on_held_out_texts(spark):
    rows = similar_docs(300, seed=4)
    out = lm.score_corpus(docs_frame(spark, rows), id_remainder("doc_id", 5) == 1).filter("held_out").collect()
    assert sum(r.score for r in out) > sum(r.base_score for r in out) and all(r.score < 0 for r in out)


def test_blocks_of_any_size_agree(spark, monkeypatch):
    docs = docs_frame(spark, similar_docs(40)).coalesce(1)
    one = sorted((r.k_id, round(r.score, 9)) for r in lm.score_corpus(docs, id_remainder("doc_id", 5) == 1).collect())
    monkeypatch.setattr(lm, "BLOCK_BYTES", 500)
    assert one == sorted((r.k_id, round(r.score, 9)) for r in lm.score_corpus(docs, id_remainder("doc_id", 5) == 1).collect())


def test_no_training_rows_and_empty_table(spark):
    docs = docs_frame(spark, [(1, "a b"), (2, None)])
    from pyspark.sql import functions as F

    out = lm.score_corpus(docs, F.lit(True)).collect()
    assert all(r.score == r.base_score and r.n_known == 0 and r.train_tokens == 0 for r in out)
    assert lm.score_corpus(docs.limit(0), F.lit(False)).count() == 0


def test_classes_come_from_all_documents(spark, monkeypatch):
    """Words that few of many documents hold are markers too, whatever the number of documents."""
    monkeypatch.setattr(lm, "SAMPLE_DOCS", 20, raising=False)
    rows = [(i, f"all w{i % 100} v{i % 50}") for i in range(400)]
    classes = lm.learn_classes(docs_frame(spark, rows).select("doc_id", "text").withColumnRenamed("doc_id", "k_id"))
    assert set(classes) == {w.encode() for _, t in rows for w in t.split()}


def test_low_bits_are_packed_in_steps(monkeypatch):
    values = np.arange(1000) * 37
    whole = EliasFano.of(values)
    monkeypatch.setattr("bankspark.llm.ngram_trie.STEP", 8)
    parts = EliasFano.of(values)
    assert whole.low.tolist() == parts.low.tolist() and parts[np.arange(1000)].tolist() == values.tolist()


def test_trie_keeps_its_order_whatever_its_size(spark):
    """No number of grams lowers the order."""
    caps = {k: 10 for k in inspect.signature(lm.train).parameters if k == "max_grams"}
    model = lm.train(docs_frame(spark, similar_docs(40)), F.lit(False), **caps)
    assert Trie.open(SparkFiles.get(model.trie)).order == ORDER


def brute_lm(rows, tokens, d=0.75):
    """Scores of whole texts by dictionaries of token n-grams, unquantised."""
    texts = [(t or "").encode().lower().split() + [b""] for _, t in rows]
    train = [t for (i, _), t in zip(rows, texts) if remainder(i, 5) != 1]
    c1 = Counter(w for t in train for w in t)
    n, kinds = sum(c1.values()), {w: brute_score(sorted(c1), w) for w in {w for t in texts for w in t}}
    c, mass, after = Counter(), Counter(), Counter()
    for (i, _), t in zip(rows, texts):
        if remainder(i, 5) != 1:
            for j in range(len(t)):
                for k in range(2, tokens + 1):
                    c[k, context(t, j, k), t[j]] += 1
    for (k, x, _), m in c.items():
        mass[k, x] += m
        after[k, x] += 1

    def p(t, j, k):
        if k == 1:
            return (max(c1[t[j]] - d, 0) + d * len(c1) * 10 ** kinds[t[j]]) / n
        x = context(t, j, k)
        lower = p(t, j, k - 1)
        return max(c[k, x, t[j]] - d, 0) / mass[k, x] + d * after[k, x] / mass[k, x] * lower if mass[k, x] else lower

    return {i: sum(math.log10(p(t, j, tokens)) for j in range(len(t))) for (i, _), t in zip(rows, texts)}


def context(t, j, k):
    """The k - 1 tokens before position j; what precedes a text is one token."""
    return ("<s>", *t[:j]) if j < k - 1 else tuple(t[j - k + 1:j])


@pytest.mark.parametrize("tokens", [2, 3])
def test_score_is_that_of_token_grams(spark, monkeypatch, tokens):
    """All n-grams of tokens of all training documents, over several blocks and shards."""
    monkeypatch.setattr(lm, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(lm, "SHARD_BYTES", 4000)
    rows = similar_docs(30) + [(901, None), (902, "th th th"), (903, "zz qq")]
    model = lm.train(docs_frame(spark, rows), id_remainder("doc_id", 5) == 1, tokens=tokens)
    want = brute_lm(rows, tokens)
    got = {r.k_id: r.score for r in lm.score(model).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[i] - want[i]) < 0.02 * abs(want[i]) + 0.05 for i in want)


def test_order_of_words_counts(spark):
    """A text seen in training scores higher than its words in another order, whatever words they are."""
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words)) for i in range(20) if remainder(i, 5) != 1]
    model = lm.train(docs_frame(spark, [*rows, (100, " ".join(words[::-1]))]), F.col("doc_id") == 100)
    got = {r.k_id: r.score for r in lm.score(model).collect()}
    assert all(got[i] > -2 for i, _ in rows) and got[100] < -40


def test_a_level_is_built_from_chunks_of_any_number(monkeypatch):
    """Counts of a shard are the same, added up at once or few at a time."""
    rnd = np.random.default_rng(3)
    rows = []
    for block in range(6):
        runs, at = np.array([2, 3]), np.array([0, 1, 0, 1, 2])
        parts = [lm.six(np.array([7, 9], np.uint64)), lm.squeezed(runs), lm.six(np.array([4, 5, 6], np.uint64)), lm.squeezed(at), lm.squeezed(rnd.integers(0, 5, 5))]
        rows.append({"block": block, "level": 2, "number": 0, "payload": lm.joined(parts)})
    table = pa.Table.from_pylist(rows)
    whole = lm.token_level((2, 0), table)
    monkeypatch.setattr(lm, "CHUNK_GRAMS", 1)
    assert lm.token_level((2, 0), table).equals(whole)
