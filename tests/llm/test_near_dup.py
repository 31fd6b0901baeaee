import random

import numpy as np
import pytest

from bankspark.llm import near_dup as nd
from tests.llm.util import brute_components, docs_frame, odd_rows, similar_docs


def rows_of(docs):
    out = nd.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("limit", [1000, 3])
def test_equals_brute_force(spark, monkeypatch, limit):
    """The small limit sends groups through blocks, leaders and branching."""
    monkeypatch.setattr(nd, "NODE_LIMIT", limit)
    rows = odd_rows()[:8] + [(100 + i, t) for i, t in similar_docs(80)]
    got = rows_of(docs_frame(spark, rows))
    want = [r if r[0] is not None else (*r[:3], r[2] is None) for r in brute_components(rows)]
    assert got == want and sum(not r[3] for r in got) > 10


def test_every_depth_and_the_last_level_are_exact(spark, monkeypatch):
    monkeypatch.setattr(nd, "NODE_LIMIT", 4)
    monkeypatch.setattr(nd, "MAX_DEPTH", 1)
    rows = similar_docs(50, seed=9)
    assert rows_of(docs_frame(spark, rows)) == brute_components(rows)


def test_components_beyond_one_task(spark, monkeypatch):
    monkeypatch.setattr(nd, "LOCAL_EDGES", 7)
    pairs = [(i, i + 1) for i in range(0, 40) if i % 10 != 9] + [(100, 200), (200, 150), (100, 150), (1, 1)]
    edges = spark.createDataFrame(pairs, "x long, y long")
    got = {r.v: r.label for r in nd.components(edges).collect()}
    for i in range(40):
        assert got[i] == i // 10 * 10
    assert got[200] == got[150] == 100


def test_keep_one_of_each_group(spark):
    docs = docs_frame(spark, odd_rows() + [(6, "one two three four five six"), (20, "One two THREE four five six")])
    kept = nd.keep_one(docs)
    assert kept.columns == docs.columns
    rows = sorted((r.doc_id for r in kept.collect()), key=repr)
    # Of the group around 6 (null id, 6 twice, 20) one stays; 5 repeats itself once; without words all stay.
    assert rows == sorted([1, 2, 3, 4, 5, 6, 7, 8, 9, None], key=repr)
    assert nd.keep_one(docs.limit(0)).count() == 0
    # An id that stands for two texts, and a group of which no row has an id.
    odd = docs_frame(spark, [(1, "a b c d e f"), (1, "p q r s t u"), (None, "k l m n o p"), (None, "K l m n o p")])
    assert sorted((repr(r.doc_id), r.text.lower()) for r in nd.keep_one(odd).collect()) == [
        ("1", "a b c d e f"), ("1", "p q r s t u"), ("None", "k l m n o p")]


def test_word_hashes_follow_the_contract():
    data = "A b\tC  é\n".encode() + b"a B c" + b"" + b"x"
    offsets = np.array([0, 10, 15, 15, 16])
    codes, first = nd.word_hashes(np.frombuffer(data, np.uint8), offsets)
    assert list(first) == [0, 4, 7, 7, 8]
    assert list(codes[:3]) == list(codes[4:7]) and len(set(codes.tolist())) == 5


def test_pairs_stay_together_down_to_depth_five(spark):
    """Recall of the branching against brute force: near pairs that still share a node, at 0.75 and up."""
    rnd = random.Random(8)
    rows = []
    for i in range(300):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(150)]
        near = list(words)
        for at in (20, 60, 100, 130)[:rnd.choice([3, 4])]:
            near[at] = f"n{rnd.randrange(10**6)}"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(near))]
    join = nd.Join(docs_frame(spark, rows), "doc_id", "text", nd.WORDS, nd.SIMILARITY)
    level = join.leaves(nd.TREES)
    for depth in range(1, 5):
        level = nd.write_stage(join.branch(nd.write_stage(level, "nodes"), depth), "nodes")
    # Every document follows FAN tokens in every tree and level.
    assert {r["count"] for r in level.groupBy("v").count().collect()} == {nd.TREES * nd.FAN ** 4}
    nodes = {}
    v = {r.v: r.k_id for r in join.signed.collect()}
    for r in level.collect():
        nodes.setdefault(v[r.v], set()).add(r.node)
    sets = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in rows)}
    alike = [2 * i for i in range(300) if 100 * len(sets[2 * i] & sets[2 * i + 1]) >= 75 * len(sets[2 * i] | sets[2 * i + 1])]
    lost = sum(not nodes[i] & nodes[i + 1] for i in alike)
    assert len(alike) > 250 and lost == 0 and nd.missed(0.75, nd.MAX_DEPTH) < 2e-6
