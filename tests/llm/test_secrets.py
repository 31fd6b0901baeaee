import hashlib
import math
import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from bankspark.llm import queries, secrets
from tests.llm.util import docs_frame, odd_rows, similar_docs

PATTERNS = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    ("access", r"AKIA[A-Z0-9]+", 0), ("hex", r"[0-9a-f]+", 0),
]
KEEP = {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}
ORDER = {"assign": 0, "access": 1, "hex": 2, "random": 3}


def base_spans(text):
    """The contract word for word: all matches first, then those that fail are dropped."""
    out = [(m.start(), ORDER[k], m.end(), k) for k, p, flags in PATTERNS for m in re.finditer(p, text or "", flags) if KEEP[k](m)]
    return sorted(out)


def scores(samples):
    counts, rows, ends = Counter(), Counter(), Counter()
    for s, r in samples:
        s = " " + re.sub("[^A-Za-z0-9+/_=-]", "", s or "")
        for a, b in zip(s, s[1:]):
            counts[a, b, r] += 1
            rows[a, r] += 1
            ends[b, r] += 1

    def p(a, b, r):
        share = (ends[b, r] + 0.5) / sum(ends[x, r] + 0.5 for x in secrets.SYMBOLS)
        return math.log((counts[a, b, r] + 8 * share) / (rows[a, r] + 8))

    score = lambda run: sum(round(1000 * (p(a, b, True) - p(a, b, False))) for a, b in zip(" " + run, run))
    given = [re.sub("[^A-Za-z0-9+/_=-]", "", s or "") for s, r in samples if r]
    rate = sum(map(score, given)) // (2 * sum(map(len, given)))
    return lambda run: score(run) >= max(secrets.LEAST_SCORE, rate * len(run))


def brute(rows, score):
    out = []
    for i, t in rows:
        base = base_spans(t)
        runs = [m for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", t or "") if not any(s < m.end() and m.start() < e for s, _, e, _ in base)]
        spans = sorted(base + [(m.start(), 3, m.end(), "random") for m in runs if score(m[0])])
        out.append((i, ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)))
    return sorted(out, key=repr)


def key(n, alphabet, seed):
    rnd = random.Random(seed)
    return "".join(rnd.choice(alphabet) for _ in range(n))


B62, HEXES = secrets.SYMBOLS[:62], "0123456789abcdef"
TRICKY = [
    (20, f'é password="{key(12, B62, 1)}", API_KEY : {key(5, B62, 2)} apikey=\'{key(6, B62, 3)}\''),
    (21, "token:token:abcdefgh secret = = x passwd:..a.b TokenK=abcdefg toKen=abcdefg ſecret=abcdefg"),
    (22, f"AKIA{key(15, 'ABC123', 4)} AKIA{key(16, 'ABC123', 5)} AKIAAKIA{key(20, 'XYZ', 6)}z"),
    (23, f"{key(23, HEXES, 7)} {key(24, HEXES, 8)}g{key(30, HEXES, 9)} \U0001F600{key(24, HEXES, 10)}"),
    (24, f"a {key(32, B62, 11)} b {key(40, secrets.SYMBOLS, 12)}, an_ordinary_long_identifier_name, AnotherOrdinaryIdentifierName"),
    (25, f"secret={key(8, B62, 13)}.{key(30, B62, 14)} {key(30, B62, 15)}token={key(9, B62, 16)} x"),
    (26, f"token={key(40, HEXES, 17)}/{key(30, B62, 18)}"),
]
PROSE = [(100 + i, t) for i, t in similar_docs(600)] + [(1300, "the ordinary long identifier name another reads words of code by its name and an identifier")]


def got(df):
    return sorted(((r.doc_id, r.spans) for r in df.select("doc_id", secrets.shown(F.col("secrets")).alias("spans")).collect()), key=repr)


def test_spans_equal_brute_force(spark):
    rows = odd_rows() + TRICKY + PROSE
    docs = docs_frame(spark, rows)
    samples = secrets.labelled_samples(docs_frame(spark, PROSE))
    model = secrets.fit(samples)
    found = got(secrets.find_secrets(docs, model))
    assert found == brute(rows, scores([tuple(r) for r in samples.collect()]))
    by = dict(found)
    assert by[24].count("random") == 2 and "random" not in by[1300] and by[21].count("assign") == 0
    assert by[22].count("access") == 2 and by[23].count("hex") == 3 and by[25].count("random") == 0


def test_positions_and_values(spark):
    rows = [r for r in odd_rows() + TRICKY if r[0] is not None]
    found = secrets.find_secrets(docs_frame(spark, rows), secrets.Model([0] * 68 * 67))
    for r in found.collect():
        texts = [t or "" for i, t in rows if i == r.doc_id]
        assert all(s.value == texts[0][s.start:s.end] and s.kind != "random" and s.score is None for s in r.secrets)


def test_model_tells_unseen_keys_from_identifiers(spark):
    """Learnt from the digests of one set of texts, tried on random keys and names of another."""
    docs = docs_frame(spark, PROSE)
    model = secrets.fit(secrets.labelled_samples(docs))
    keys = [key(n, a, n) for a in (B62, HEXES.upper(), secrets.SYMBOLS, B62[:26] + B62[52:]) for n in range(24, 64)]
    names = ["_".join(t.split()[k:k + 3]) for _, t in similar_docs(150, seed=9) for k in range(3) if len("_".join(t.split()[k:k + 3])) >= 20]
    rows = [(k, x) for k, x in enumerate(keys + names)]
    hits = {r.doc_id for r in secrets.find_secrets(docs_frame(spark, rows), model).filter("exists(secrets, s -> s.kind = 'random')").collect()}
    assert len(hits & set(range(len(keys)))) >= 0.99 * len(keys) and len(names) > 50
    assert len(hits - set(range(len(keys)))) <= 0.01 * len(names)


def test_many_matches_in_one_text_take_linear_time(spark):
    """Running sums in blocks: 60,000 matches; places stay right past every block."""
    text = " ".join(f"{i:024x}" for i in range(60_000)) + " token=abcdef " + "x-" * 500_000
    began = time.time()
    r = secrets.find_secrets(docs_frame(spark, [(1, text)]), secrets.Model([1] * 68 * 67)).first()
    assert time.time() - began < 60
    assert [(s.start, s.end) for s in r.secrets[:60_000]] == [(25 * i, 25 * i + 24) for i in range(60_000)]
    assert [s.kind for s in r.secrets[60_000:]] == ["assign", "random"] and r.secrets[-1].end == len(text)


def test_empty_tables_and_samples(spark):
    docs = docs_frame(spark, TRICKY)
    assert secrets.fit(spark.createDataFrame([], "sample string, random boolean")).ratio == [0] * 68 * 67
    odd = spark.createDataFrame([(None, True), ("", False), ("abc", None), ("é€", True)], "sample string, random boolean")
    assert secrets.fit(odd).ratio == [0] * 68 * 67
    assert secrets.find_secrets(docs.limit(0), secrets.fit(secrets.labelled_samples(docs.limit(0)))).count() == 0


def test_native_plan(spark):
    docs = docs_frame(spark, TRICKY)
    for df in (secrets.find_secrets(docs, secrets.Model([0] * 68 * 67)), secrets.labelled_samples(docs)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text
    assert "Exchange" not in secrets.find_secrets(docs, secrets.Model([0] * 68 * 67))._jdf.queryExecution().executedPlan().toString()


def test_query_hashes_base_spans(spark, sf_dir):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.QUERIES["op11_secret_scan"](spark, sf_dir).collect():
        base = ",".join(f"{k}:{s}:{e}" for s, _, e, k in base_spans(rows[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(base.count(k) for k in ("assign", "access", "hex"))
        assert [x for x in r.spans.split(",") if x and not x.startswith("random")] == [x for x in base.split(",") if x]
