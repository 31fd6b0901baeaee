"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from bankspark.llm import alignment, decontam, langid, lm, merkle, near_dup, packing, preferences, quality, secrets, suffix_dedup, topk, url_filter
from bankspark.llm.common import id_remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


# A-Z as a-z and nothing else, in the checking SQL.
SQL_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs, min_bytes=200, keep="none").select(
        "doc_id", "llm_kept.n_bytes", "llm_kept.n_removed", "llm_kept.n_spans",
        F.sha2("llm_kept.kept", 256).alias("kept_sha256"))


# Fixed values of the contract.
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.apply_rules(pages, rules).select("page_id", "llm_rule.*")


ORACLE["op2_url_filter"] = f"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM a),
p AS (SELECT page_id, {SQL_LOWER.format("raw")} AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
m AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost) * 1000 + length(rpath)) AS rule,
         arg_max(rverdict, length(rhost) * 1000 + length(rpath)) AS rverdict
  FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id
)
SELECT p.page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)
"""


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (id_remainder("doc_id", 4) == 2).alias("held_out"))
    return quality.classify(docs, table(spark, sf_dir, "labels"), ~F.col("held_out"))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


ORACLE["op4_decontamination"] = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({SQL_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT DISTINCT item_id, regexp_extract_all({SQL_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, len(list_slice(w, s, s + 12)) AS size, array_to_string(list_slice(w, s, s + 12), ' ') AS terms
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM win),
grams AS (
  SELECT doc_id, s, size, array_to_string(list_slice(w, s, s + size - 1), ' ') AS terms
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes)
), hit AS (SELECT g.doc_id, g.s, g.size, win.item_id FROM grams g JOIN win USING (size, terms)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hit) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query
def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    pairs = preferences.format_sides(preferences.exchanged(turns))
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat(s["start"], F.lit("-"), s["end"])), ",")
    return pairs.withColumns({c: shown(c) for c in ("chosen_trained", "rejected_trained")})


ORACLE["op5_preference_format"] = """
WITH t AS (
  SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), last AS (SELECT conv_id, max(i) FILTER (WHERE role = 'assistant') AS li FROM t GROUP BY conv_id),
said AS (SELECT conv_id, text FROM t JOIN last USING (conv_id) WHERE i = li),
sides AS (
  SELECT t.conv_id AS conv_id, CASE WHEN li IS NOT NULL THEN s.conv_id END AS rejected_id, i, role, t.text AS mine, CASE WHEN i = li THEN coalesce(s.text, '') ELSE t.text END AS other
  FROM t JOIN last USING (conv_id) LEFT JOIN said s ON s.conv_id = xor(t.conv_id, 1)
), common AS (
  SELECT conv_id, coalesce(min(CASE WHEN mine <> other THEN i - 1 END), max(i)) AS n_prompt FROM sides GROUP BY conv_id
), shown AS (
  SELECT conv_id AS chosen_id, rejected_id, n_prompt, chosen, i, role, i > n_prompt AS rest, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS line
  FROM (SELECT *, true AS chosen, mine AS text FROM sides UNION ALL SELECT *, false, other FROM sides) JOIN common USING (conv_id)
), placed AS (
  SELECT *, sum(length(line)) OVER (PARTITION BY chosen_id, rejected_id, chosen, rest ORDER BY i) - length(line) AS pos FROM shown
), spans AS (
  SELECT *, CASE WHEN rest AND role = 'assistant' THEN (pos + length(role) + 5)::BIGINT || '-' || (pos + length(line) - 1)::BIGINT END AS span FROM placed
)
SELECT chosen_id, rejected_id, CAST(n_prompt AS INTEGER) AS n_prompt,
       coalesce(string_agg(line, '' ORDER BY i) FILTER (WHERE chosen AND NOT rest), '') AS prompt,
       coalesce(string_agg(line, '' ORDER BY i) FILTER (WHERE chosen AND rest), '') AS chosen,
       coalesce(string_agg(span, ',' ORDER BY i) FILTER (WHERE chosen AND rest), '') AS chosen_trained,
       coalesce(string_agg(line, '' ORDER BY i) FILTER (WHERE NOT chosen AND rest), '') AS rejected,
       coalesce(string_agg(span, ',' ORDER BY i) FILTER (WHERE NOT chosen AND rest), '') AS rejected_trained
FROM spans GROUP BY chosen_id, rejected_id, n_prompt
"""


@query
def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = topk.top_k(vectors, vectors.filter("vec_id % 100 = 0"))
    return found.withColumnRenamed("id", "vec_id")


ORACLE["op6_top_k"] = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.e, c.e)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", id_remainder("doc_id", 3) == 1)
    model = langid.fit(docs.filter("not held_out"))
    return langid.identify(docs.select("doc_id", "text", "held_out"), model).drop("text")


@query
def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = lm.score_corpus(docs, id_remainder("doc_id", 5) == 1)
    no_id = F.col("k_id") == F.lit(-(2**63)).cast("long")
    return found.select(F.when(~no_id, F.col("k_id")).alias("doc_id"), *found.columns[2:])


@query
def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, secrets.fit(secrets.labelled_samples(docs)))
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(secrets.shown(base), 256).alias("base_sha256"), secrets.shown(F.col("secrets")).alias("spans"))


def _either_case(text: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in text)


_SQL_ASSIGN = "(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _sql_matches(pattern: str, source: str) -> str:
    """(doc_id, s, e, v) of a pattern's matches in (doc_id, text)."""
    return f"""(SELECT doc_id, CAST(e - length(v) AS BIGINT) AS s, e, v FROM (
      SELECT doc_id, v, sum(length(v) + length(g)) OVER (PARTITION BY rid ORDER BY i) AS e FROM (
        SELECT doc_id, rid, unnest(f) AS v, unnest(list_slice(p, 1, len(f))) AS g, unnest(range(1, len(f) + 1)) AS i
        FROM (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(text, '{pattern}') AS f, string_split_regex(text, '{pattern}') AS p FROM {source}))))"""


ORACLE["op11_secret_scan"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
chosen AS (
  SELECT DISTINCT doc_id, text FROM d WHERE CAST('0x' || substr(md5(concat_ws(':', doc_id, text)), 1, 8) AS UBIGINT)
    < {secrets.MAX_SAMPLE_DOCS}::DOUBLE / (SELECT greatest(count(*), 1) FROM d) * 4294967296
), given AS (
  SELECT unnest(list_concat(regexp_extract_all(text, '{_SQL_ASSIGN}', 2), regexp_extract_all(text, '{secrets.ACCESS}'), regexp_extract_all(text, '{secrets.HEX}'))) AS v, text FROM chosen
), keys AS (SELECT to_base64(unhex(sha256(text) || sha256('+' || text))) AS b, sha256(text) AS h, regexp_replace(to_base64(unhex(sha256(text) || sha256('+' || text))), '[+/=]', '', 'g') AS l FROM chosen),
words AS (
  SELECT doc_id, regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(text, '{_SQL_ASSIGN}', ' ', 'g'), '{secrets.ACCESS}', ' ', 'g'), '{secrets.HEX}', ' ', 'g'), '{secrets.RUN % secrets.LEAST_WORD}') AS w FROM chosen
), pairs AS (SELECT unnest(range(1, len(w))) AS i, unnest(list_slice(w, 1, len(w) - 1)) AS a, unnest(list_slice(w, 2, len(w))) AS b FROM words WHERE len(w) > 1),
samples AS (
  SELECT ' ' || replace(v, '.', '') AS v, true AS random FROM (SELECT DISTINCT v FROM given) WHERE length(v) >= {secrets.LEAST_RUN}
  UNION ALL SELECT DISTINCT ' ' || unnest([b, translate(b, '+/=', '-_'), l, upper(l), substr(h, 1, 40)]), true FROM keys
  UNION SELECT ' ' || unnest(w), false FROM words
  UNION SELECT ' ' || CASE (i - 1) % 3 WHEN 0 THEN a || '_' || b WHEN 1 THEN a || '-' || b ELSE a || upper(substr(b, 1, 1)) || substr(b, 2) END, false FROM pairs
), grams AS (
  SELECT substr(v, i, 2) AS g, count(*) FILTER (random) AS r, count(*) FILTER (NOT random) AS o
  FROM (SELECT v, random, unnest(range(1, length(v))) AS i FROM samples) GROUP BY 1
), symbols AS (SELECT unnest(string_split('{secrets.SYMBOLS}', '')) AS c),
alone AS (
  SELECT c, (coalesce(sum(r), 0) + {secrets.PRIOR}) AS r, (coalesce(sum(o), 0) + {secrets.PRIOR}) AS o FROM symbols LEFT JOIN grams ON substr(g, 2, 1) = c GROUP BY c
), shares AS (SELECT c, r / sum(r) OVER () AS r, o / sum(o) OVER () AS o FROM alone),
after AS (
  SELECT c, coalesce(sum(r), 0) + {secrets.BACK} AS r, coalesce(sum(o), 0) + {secrets.BACK} AS o
  FROM (SELECT c FROM symbols UNION ALL SELECT ' ') LEFT JOIN grams ON substr(g, 1, 1) = c GROUP BY c
), ratio AS (
  SELECT a.c || b.c AS g, CAST(round(1000 * (ln((coalesce(grams.r, 0) + {secrets.BACK} * b.r) / a.r) - ln((coalesce(grams.o, 0) + {secrets.BACK} * b.o) / a.o))) AS BIGINT) AS x
  FROM after a CROSS JOIN shares b LEFT JOIN grams ON grams.g = a.c || b.c
), base AS (
  SELECT doc_id, s, 1 AS k, 'assign' AS kind, e FROM {_sql_matches(_SQL_ASSIGN, "d")} WHERE length(regexp_extract(v, '{_SQL_ASSIGN}', 2)) >= {secrets.LEAST_ASSIGNED}
  UNION ALL SELECT doc_id, s, 2, 'access', e FROM {_sql_matches(secrets.ACCESS, "d")} UNION ALL SELECT doc_id, s, 3, 'hex', e FROM {_sql_matches(secrets.HEX, "d")}
), runs AS (
  SELECT r.doc_id, r.s, r.e, r.v FROM {_sql_matches(secrets.RUN % secrets.LEAST_RUN, "d")} r
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = r.doc_id AND b.s < r.e AND r.s < b.e)
), scored AS (
  SELECT doc_id, s, e FROM (SELECT doc_id, s, e, ' ' || v AS v, unnest(range(1, length(v) + 1)) AS i FROM runs) JOIN ratio ON g = substr(v, i, 2)
  GROUP BY doc_id, s, e HAVING sum(x) >= greatest({secrets.LEAST_SCORE}, (e - s) * (SELECT coalesce(sum(r * x) // (2 * sum(r)), 0) FROM ratio JOIN grams USING (g)))
), spans AS (SELECT * FROM base UNION ALL SELECT doc_id, s, 4, 'random', e FROM scored),
named AS (
  SELECT doc_id, count(*) FILTER (k = 1) AS n_assign, count(*) FILTER (k = 2) AS n_access, count(*) FILTER (k = 3) AS n_hex, count(*) FILTER (k = 4) AS n_random,
    string_agg(kind || ':' || s || ':' || CAST(e AS BIGINT), ',' ORDER BY s, k, e) FILTER (k < 4) AS base,
    string_agg(kind || ':' || s || ':' || CAST(e AS BIGINT), ',' ORDER BY s, k, e) AS spans
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(n_random, 0) AS n_random,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN named USING (doc_id)
"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = {c: merkle.field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    altered = merkle.digest(*{**fields, "text": merkle.field(merkle.lower_ascii(F.col("text")))}.values())
    altered = F.when(id_remainder("doc_id", 5) == 0, altered)
    rows = merkle.manifest(docs, tuple(fields), carry={"altered": altered})
    seen = rows.withColumn("seen", F.coalesce("altered", "leaf"))
    return merkle.verify(seen, "seen").select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", "verified")


def _sql_field(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"


_SQL_CRC32 = """xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split({0}, ''), lambda c: ascii(c)::UBIGINT)),
  lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
    lambda x, y: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))), 4294967295::UBIGINT)"""
_LEAF = " || ".join(_sql_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
_ALTERED = _LEAF.replace("text::VARCHAR", SQL_LOWER.format("text"))

ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, sha256({_LEAF}) AS leaf,
    CASE WHEN {_SQL_CRC32.format("coalesce(doc_id::VARCHAR, '')")} % 5 = 0 THEN sha256({_ALTERED}) ELSE sha256({_LEAF}) END AS seen FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM d
), tree AS (
  SELECT source, 0 AS k, place, n, leaf AS h FROM placed
  UNION ALL
  SELECT source, k + 1, place // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY place)) FROM tree WHERE n > 1 GROUP BY source, k, place // 16, n
), sub AS (
  SELECT source, k AS top, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1
), upper_tree AS (
  SELECT 0 AS k, place, n, h FROM sub
  UNION ALL
  SELECT k + 1, place // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY place)) FROM upper_tree WHERE n > 1 GROUP BY k, place // 16, n
), leaves AS (
  SELECT p.source, p.place, p.doc_id, p.leaf, p.seen, sub.h AS subroot, sub.top, sub.place AS up, row_number() OVER () AS id
  FROM placed p JOIN sub ON p.source IS NOT DISTINCT FROM sub.source
), step AS (
  SELECT id, k, string_agg(h, '' ORDER BY p) FILTER (p < mine) AS lhs, string_agg(h, '' ORDER BY p) FILTER (p > mine) AS rhs FROM (
    SELECT id, t.k, t.place AS p, l.place // (16 ** t.k)::BIGINT AS mine, t.h
    FROM leaves l JOIN tree t ON t.source IS NOT DISTINCT FROM l.source AND t.k < l.top AND t.place // 16 = l.place // (16 ** (t.k + 1))::BIGINT
    UNION ALL
    SELECT id, l.top + t.k, t.place, l.up // (16 ** t.k)::BIGINT, t.h FROM leaves l JOIN upper_tree t ON t.n > 1 AND t.place // 16 = l.up // (16 ** (t.k + 1))::BIGINT
  ) GROUP BY id, k
), folding AS (
  SELECT id, 0 AS k, seen AS h FROM leaves
  UNION ALL
  SELECT f.id, f.k + 1, sha256(coalesce(lhs, '') || f.h || coalesce(rhs, '')) FROM folding f JOIN step s ON s.id = f.id AND s.k = f.k
), folded AS (SELECT id, arg_max(h, k) AS folded_root FROM folding GROUP BY id),
proof AS (SELECT id, string_agg(coalesce(lhs, '') || coalesce(rhs, ''), '' ORDER BY k) AS s FROM step GROUP BY id),
root AS (SELECT h AS root FROM upper_tree WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(s, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN folded USING (id) LEFT JOIN proof USING (id) CROSS JOIN root
"""


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.count_links(table(spark, sf_dir, "documents"))
