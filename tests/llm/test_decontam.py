import re
import string


from bankspark.llm import decontam as dc
from tests.llm.util import docs_frame, odd_rows



def words(text):
    table = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(table))


def brute(docs, items, size=13):
    windows = {}
    for item, text in items:
        w = words(text)
        for s in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[s:s + size]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for i, text in docs:
        w = words(text)
        hit, named = set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit.update(range(s, s + n))
                    named |= windows[tuple(w[s:s + n])]
        out.append((i, len(w), len(hit), sorted(named), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


PASSAGE = " ".join(f"word{i % 17} É{i}" for i in range(30))
ITEMS = [(1, PASSAGE), (2, "Short item, THREE"), (2, "Short item, THREE"), (3, None), (4, ""), (None, "lonely"), (10, "a a a a a a a a a a a a a a a")]
DOCS = [
    (20, "before " + PASSAGE.replace(" ", "-") + " after"), (21, PASSAGE.lower()), (22, "short ITEM three; short item three"),
    (23, "short item four"), (24, " ".join(f"w{i}" for i in range(900)) + " short item three"), (25, "a " * 40), (26, "lonely"),
    (27, " ".join(f"word{i % 17} É{i}" for i in range(6, 13))),
]


def test_equals_brute_force(spark):
    rows = odd_rows() + DOCS
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = dc.contamination(docs_frame(spark, rows), items)
    got = sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()), key=repr)
    assert got == brute(rows, ITEMS) and sum(r[4] for r in got) >= 5


def test_stage_keeps_clean_rows_and_empty_tables(spark):
    docs, items = docs_frame(spark, odd_rows() + DOCS), spark.createDataFrame(ITEMS, "item_id long, text string")
    left = dc.drop_contaminated(docs, items)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} >= {1, 2, 3, 4, 5, 6, 7, 8, 21, 23, 24, None} and left.filter("doc_id in (20, 22, 25, 26)").count() == 0
    assert dc.contamination(docs, items.limit(0)).filter("contaminated").count() == 0
    assert dc.contamination(docs.limit(0), items).count() == 0


def test_proximity_finds_words_apart(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = docs_frame(spark, [(1, "alpha beta gamma"), (2, "alpha x beta gamma x"), (3, "alpha " + "x " * 50 + "beta gamma"), (4, "gamma")])
    index = dc.build_index(docs, items)
    got = dc.proximity_matches(index, slop=3).select("k_id", "distance").collect()
    assert {(r.k_id, r.distance) for r in got} <= {(1, 0), (2, 0), (2, 1)} and {r.k_id for r in got} == {1, 2}
    assert {r.k_id for r in dc.phrase_matches(index).collect()} == {1}


def test_native_plan(spark):
    """No Python on the main path."""
    docs = docs_frame(spark, DOCS)
    text = dc.contamination(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text
