import random

import numpy as np
from pyspark.sql import functions as F

from bankspark.llm import quality
from tests.llm.util import odd_rows


def labelled(n=300, seed=1):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 8))) for _ in range(rnd.randint(5, 60))]
        good = rnd.random() < 0.7
        text = " ".join(words) + "." if good else rnd.choice([" ".join(w.upper() + "!!" for w in words), " ".join(words[:1] * len(words)), " | ".join(words)])
        rows.append((i, text))
        labels.append((i, int(good)))
    return rows, labels


def test_ranks_held_out_documents(spark):
    rows, labels = labelled()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held_out", F.col("doc_id") % 4 == 2)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    out = quality.classify(docs, marks, ~F.col("held_out")).join(marks, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in out]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)


def test_bradley_terry_orders_a_known_scale():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    y = (x @ [2.0, -1.0, 0.0] + rng.normal(scale=0.1, size=400)) > 0
    w = quality.bradley_terry(quality.rank_pairs(x[y], x[~y]))
    assert w[0] > 0 > w[1] and abs(w[2]) < 0.2 * w[0]


def test_threshold_is_the_quantile_of_the_labels(spark):
    rows, labels = labelled(200, seed=8)
    described = quality.describe(spark.createDataFrame(rows, "doc_id long, text string"))
    ranking = quality.fit(described, spark.createDataFrame(labels, "doc_id long, quality int"))
    x = np.array([r.features for r in described.collect()])
    share = np.mean(ranking.score(x) >= quality.CUT)
    assert abs(share - np.mean([y for _, y in labels])) < 0.02


def test_odd_rows_and_odd_labels(spark):
    docs = spark.createDataFrame([(*r, "x") for r in odd_rows()], "doc_id long, text string, features string").drop("features").withColumn("llm_y", F.lit(1))
    marks = spark.createDataFrame([(4, 1), (5, 0), (5, 0), (6, None), (7, 3), (None, 1), (999, 0)], "doc_id long, quality int")
    out = quality.classify(docs, marks, F.lit(True))
    assert out.count() == docs.count() and out.filter("score is null or score < 0 or score > 1").count() == 0
    same = {(r.doc_id, r.score) for r in out.collect() if r.doc_id == 5}
    assert len(same) == 1
    none = quality.classify(docs, marks.filter("quality = 1"), F.lit(True))
    assert {r.score for r in none.collect()} == {0.5}
    assert quality.classify(docs.limit(0), marks, F.lit(True)).count() == 0


def test_features_of_nothing():
    assert len(quality.features(b"")) == len(quality.features(b"Some text\nhere")) and not quality.features(b"").any()
