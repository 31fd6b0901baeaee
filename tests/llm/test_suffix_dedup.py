import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from bankspark.llm import suffix_dedup as sd
from tests.llm.util import brute_repeats, docs_frame, odd_rows, similar_docs


def rows_of(df):
    return sorted(((r.doc_id, r.llm_kept.n_bytes, r.llm_kept.n_removed, r.llm_kept.n_spans, bytes(r.llm_kept.kept)) for r in df.collect()), key=repr)


# Distinct ids and texts: of rows alike, `first` cannot tell which one is first.
ROWS = [r for r in odd_rows() if r != (5, "a")] + [(100 + i, t) for i, t in similar_docs(40)] + [(300, "ab " * 300), (301, "ab " * 90)]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("bucket", [sd.BUCKET_BYTES, 1500])
def test_equals_brute_force(spark, monkeypatch, keep, bucket):
    """Also where a hash is too hot for one group and its windows are counted as rows."""
    monkeypatch.setattr(sd, "BUCKET_BYTES", bucket)
    rows = [(i, t[:3000] if t else t) for i, t in ROWS]
    got = rows_of(sd.remove_repeats(docs_frame(spark, rows), min_bytes=100, keep=keep))
    assert got == brute_repeats(rows, 100, keep)
    assert sum(r[2] for r in got) > 0


def test_odd_rows_extra_columns_and_empty_table(spark):
    docs = docs_frame(spark, odd_rows())
    out = sd.remove_repeats(docs, keep="none")
    assert out.columns == [*docs.columns, "llm_kept"] and out.count() == docs.count()
    by_id = {r.doc_id: r.llm_kept for r in out.collect()}
    assert by_id[7].n_removed == 5000 and by_id[7].n_spans == 1  # every window starts again one byte on
    assert by_id[1].n_bytes == 0 and by_id[4].n_removed == 0
    assert sd.remove_repeats(docs.limit(0)).count() == 0


def test_repeated_rows_are_each_others_copies(spark):
    docs = docs_frame(spark, [(1, "q" + "abc" * 100), (1, "q" + "abc" * 100)])
    assert [r.llm_kept.n_removed for r in sd.remove_repeats(docs, keep="none").collect()] == [301, 301]


def test_text_form_drops_halves_of_characters(spark):
    docs = docs_frame(spark, [(1, "é" * 150 + "x"), (2, "y" + "é" * 150)])
    out = sd.remove_repeats(docs, min_bytes=201, as_text=True).collect()
    assert all("�" not in r.llm_kept.kept for r in out)


def test_suffix_array_is_sorted_and_earlier_matches_are_right():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    starts = np.arange(len(data) - 40 + 1)
    suffixes, run = sd.suffix_runs(data, starts, 40)
    text = data.tobytes()
    windows = [text[i:i + 40] for i in suffixes]
    assert windows == sorted(windows)
    assert all((a == b) == (p == q) for a, b, p, q in zip(windows, windows[1:], run, run[1:]))
    earlier = sd.earlier_match(suffixes, run)
    first = {}
    for i, w in sorted(zip(suffixes, windows)):
        first.setdefault(w, i)
    assert list(earlier) == [first[w] < i for i, w in zip(suffixes, windows)]


def test_sorting_a_bucket_takes_few_times_its_bytes():
    """Indices of four bytes, words read in place: peak memory per window stays small."""
    import tracemalloc

    rng = np.random.default_rng(2)
    data = np.tile(rng.integers(97, 123, 2000).astype(np.uint8), 400)
    starts = np.arange(len(data) - 199)
    sd.suffix_runs(data[:5000], starts[:4000], 200)
    tracemalloc.start()
    sd.suffix_runs(data, starts, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50 * len(data)


def test_a_bucket_is_sorted_in_little_memory():
    """Under 24 bytes for each byte of its stretches, at the peak."""
    rng = np.random.default_rng(2)
    shared = rng.integers(97, 123, 300).astype(np.uint8).tobytes()
    texts = [rng.integers(97, 123, 400).astype(np.uint8).tobytes() + shared for _ in range(2000)]
    n = list(range(len(texts)))
    table = pa.table({
        "digest": [hashlib.md5(t).digest() for t in texts], "k_id": n, "k_row": n, "at": [0] * len(n), "stretch": texts})
    sort = sd._sort_bucket(200)
    tracemalloc.start()
    try:
        out = sort(table)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # What stands before the shared part can be alike by chance.
    assert out.num_rows == len(texts) and all(380 < m[-2] <= 400 and m[-1] == 700 for m in out.column("matched").to_pylist())
    assert peak < 24 * sum(map(len, texts))


def test_held_stretches_are_passed_on_in_small_batches(monkeypatch):
    monkeypatch.setattr(sd, "PASSED_BYTES", 1000)
    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 123, 600).astype(np.uint8).tobytes() for _ in range(20)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    doc, anchor, *_ = sd.stretches(data, np.arange(0, len(data) + 1, 600), 200)
    hits = [[int(a) for a, d in zip(anchor, doc) if d == i] for i in range(20)]
    docs = pa.RecordBatch.from_arrays(
        [pa.array(range(20)), pa.array(range(20)), pa.array([t.decode() for t in texts]), pa.array(hits, pa.list_(pa.int64()))],
        names=["k_id", "k_row", "text", "hits"])
    out = [b for b in sd._stretch_rows(200)(iter([docs])) if b.column("kind")[0].as_py() == sd.HOLDS]
    held = [[len(x) for x in b.column("stretch").to_pylist()] for b in out]
    assert sum(map(len, held)) == len(doc) and all(sum(x[:-1]) < 1000 for x in held)
