"""Secret scans: fixed patterns, and character Markov models that tell random strings from ordinary
identifiers; DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the contract.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
LEAST_ASSIGNED = 6
# A run of either class is matched from its start or not at all, so the least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
START = " "
RUN = "[A-Za-z0-9+/_=-]{%d,}"
LEAST_RUN = 20  # shortest run that is scored
LEAST_WORD = 4  # shortest ordinary run that is learnt from
MAX_SAMPLE_DOCS = 1000
# Thousandths of a nat: odds of a million to one that a run is random.
LEAST_SCORE = 13816
PRIOR = 0.5  # added to every symbol's count
BACK = 8  # weight of a symbol's share of all symbols among those that follow another
SUM_BLOCK = 256

SECRETS = "array<struct<start: int, end: int, kind: string, value: string, score: int>>"


@dataclass
class Model:
    """log P(next | previous) among random strings less that among ordinary ones, in thousandths of
    a nat, for every previous symbol (the start mark included) and next symbol. Each model falls
    back on how often the next symbol stands anywhere. `rate` is half of what a symbol of the random
    samples scores on average: each symbol of a name nobody has seen looks a little random too."""

    ratio: list[int]
    rate: int = 0

    def score(self, run: Column) -> Column:
        """Log-likelihood ratio of a run of SYMBOLS, linear in its length."""
        table = F.split(F.lit(",".join(map(str, self.ratio))), ",").cast("array<int>")
        # 1 is the start mark, symbols follow; the table has a row for each of them, without a column for the mark.
        places = F.transform(F.split(F.concat(F.lit(START), run), ""), lambda c: F.instr(F.lit(START + SYMBOLS), c))
        steps = F.zip_with(
            F.slice(places, 1, F.length(run)), F.slice(places, 2, F.length(run)),
            lambda a, b: F.get(table, (a - 1) * len(SYMBOLS) + b - 2))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)


def sum_so_far(xs: Column) -> Column:
    """For each element the sum of it and those before, in blocks: an array is copied when it
    grows, so one pass over a long array would take quadratic time."""
    def grown(values: Column) -> Column:
        return F.aggregate(
            values, F.array().cast("array<int>"),
            lambda done, x: F.array_append(done, F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)) + x))

    starts = F.sequence(F.lit(1), F.greatest(F.size(xs), F.lit(1)), F.lit(SUM_BLOCK))
    blocks = F.transform(starts, lambda s: grown(F.slice(xs, s, SUM_BLOCK)))
    ends = grown(F.transform(blocks, lambda b: F.coalesce(F.try_element_at(b, F.lit(-1)), F.lit(0))))
    return F.flatten(F.zip_with(blocks, ends, lambda b, end: F.transform(b, lambda x: x + end - F.element_at(b, -1))))


def _with_matches(df: DataFrame, out: str, pattern: str, when: Column) -> DataFrame:
    """Adds `out`: the leftmost non-overlapping matches of a pattern, as (start, end, value) in code
    points. Each match ends after the texts before, between and of the matches so far. `when`, a
    cheap test, spares the other texts the pattern."""
    text = F.when(when, F.col("text")).otherwise("")
    found, gaps, ends = f"{out}_found", f"{out}_gaps", f"{out}_ends"
    df = df.withColumns({
        found: F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        gaps: F.transform(F.split(text, pattern, -1), F.length),
    })
    lengths = F.zip_with(F.slice(gaps, 1, F.size(found)), F.transform(found, F.length), lambda g, m: g + m)
    df = df.withColumn(ends, F.when(F.size(found) > 0, sum_so_far(lengths)).otherwise(F.array().cast("array<int>")))
    spans = F.zip_with(found, ends, lambda m, e: F.struct((e - F.length(m)).alias("start"), e.alias("end"), m.alias("value")))
    return df.withColumn(out, spans).drop(found, gaps, ends)


def _based(docs: DataFrame) -> DataFrame:
    """doc_id, text and an array per fixed pattern."""
    text = F.col("text")
    df = _with_matches(docs, "assign", ASSIGN, text.rlike("(?i)passw|secret|token|api_?key"))
    df = _with_matches(df, "access", ACCESS, text.contains("AKIA"))
    df = _with_matches(df, "hex", HEX, F.lit(True))
    long = F.filter("assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= LEAST_ASSIGNED)
    return df.withColumn("assign", long)


def _plain(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def labelled_samples(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_docs: int = MAX_SAMPLE_DOCS
) -> DataFrame:
    """Distinct (sample, random) strings from about `max_docs` documents, chosen by a digest of id and text.

    Random: what the fixed patterns take for a secret there, and digests of the texts written in
    the alphabets that keys come in (hex, base 64 in both forms, letters and digits, capitals and
    digits). Ordinary: all other runs of SYMBOLS, and each joined to the next in one of the three
    ways identifiers are.
    """
    docs = _plain(docs, id_col, text_col)
    rate = max_docs / max(docs.count(), 1)
    draw = F.conv(F.substr(F.md5(F.concat_ws(":", "doc_id", "text")), F.lit(1), F.lit(8)), 16, 10).cast("double")
    chosen = _based(docs.filter(draw < rate * 2**32).select("doc_id", "text").distinct())
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    chosen = chosen.select(
        F.regexp_extract_all(rest, F.lit(RUN % LEAST_WORD), F.lit(0)).alias("words"),
        F.regexp_replace(F.base64(F.unhex(F.concat(F.sha2("text", 256), F.sha2(F.concat(F.lit("+"), "text"), 256)))), r"\s", "").alias("b64"), F.sha2("text", 256).alias("digest"),
        F.transform("assign", lambda s: F.regexp_extract(s["value"], ASSIGN, 2)).alias("given"),
        *[F.transform(k, lambda s: s["value"]).alias(k) for k in ("access", "hex")])
    letters = F.regexp_replace("b64", "[+/=]", "")
    made = F.array("b64", F.translate("b64", "+/=", "-_"), letters, F.upper(letters), F.substr("digest", F.lit(1), F.lit(40)))
    known = F.filter(F.concat("given", "access", "hex"), lambda s: F.length(s) >= LEAST_RUN)
    follows = F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0)))
    pairs = F.zip_with(F.slice("words", 1, F.size(follows)), follows, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    joined = F.transform(pairs, lambda p, i: F.when(i % 3 == 0, F.concat(p["a"], F.lit("_"), p["b"])).when(
        i % 3 == 1, F.concat(p["a"], F.lit("-"), p["b"])).otherwise(F.concat(p["a"], F.upper(F.substr(p["b"], F.lit(1), F.lit(1))), F.substr(p["b"], F.lit(2)))))
    both = F.array(
        F.struct(F.lit(True).alias("random"), F.concat(made, known).alias("texts")),
        F.struct(F.lit(False).alias("random"), F.concat("words", joined).alias("texts")))
    return chosen.select(F.explode(both).alias("b")).select(F.explode("b.texts").alias("sample"), "b.random").distinct()


def fit(samples: DataFrame) -> Model:
    """Both models from labelled strings (sample, random). Null and empty samples and symbols
    outside SYMBOLS teach nothing; without samples every score is 0. The driver gets a count for
    each pair of symbols, 68 by 67 at most."""
    clean = F.concat(F.lit(START), F.regexp_replace("sample", "[^A-Za-z0-9+/_=-]", ""))
    pairs = F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substr("s", i, F.lit(2)))
    rows = (
        samples.filter("random is not null").select(clean.alias("s"), "random").filter(F.length("s") > 1)
        .select(F.explode(pairs).alias("pair"), "random").groupBy("pair")
        .agg(F.count_if(F.col("random")).alias("random"), F.count_if(~F.col("random")).alias("plain")).collect())
    counts = {r.pair: (r.random, r.plain) for r in rows}
    at = lambda pair, k: counts.get(pair, (0, 0))[k]

    def steps(k: int) -> list[float]:
        alone = [sum(at(a + b, k) for a in START + SYMBOLS) + PRIOR for b in SYMBOLS]
        share = [x / sum(alone) for x in alone]
        after = [sum(at(a + b, k) for b in SYMBOLS) + BACK for a in START + SYMBOLS]
        return [math.log((at(a + b, k) + BACK * y) / x) for a, x in zip(START + SYMBOLS, after) for b, y in zip(SYMBOLS, share)]

    ratio = [round(1000 * (r - p)) for r, p in zip(steps(0), steps(1))]
    weights = [at(a + b, 0) for a in START + SYMBOLS for b in SYMBOLS]
    return Model(ratio, sum(w * x for w, x in zip(weights, ratio)) // max(2 * sum(weights), 1))


def find_secrets(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", least_score: int = LEAST_SCORE,
) -> DataFrame:
    """doc_id and `secrets`: every span (start, end, kind, value, score) by start, kind as in KINDS, end.

    Positions count code points, the end excluded; a span is its whole match, the name ahead of an
    assigned value included. `random` are the runs of at least 20 SYMBOLS that meet no other span
    and whose log-likelihood ratio reaches `least_score` and `model.rate` a symbol; only these have a score. One row per
    document, repeated rows and null ids as they come; null and empty texts have no spans; other
    columns are ignored, whatever their names. One pass without a shuffle. A text costs time in
    proportion to its length; the model is a literal of 4,556 numbers.
    """
    df = _based(_plain(docs, id_col, text_col))
    df = _with_matches(df, "run", RUN % LEAST_RUN, F.lit(True))

    def tagged(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("k"), s["end"].alias("end"), s["value"].alias("value"),
            F.lit(None).cast("long").alias("score")))

    # Runs hold each hex and access span that they meet; of the assigned spans, which do not overlap,
    # the last that starts before a run's end tells.
    df = df.withColumn("run", F.filter("run", lambda r: ~r["value"].rlike(f"{ACCESS}|{HEX}")))
    events = F.array_sort(F.concat(
        F.transform("run", lambda r: F.struct(r["end"].alias("at"), F.lit(0).alias("starts"))),
        F.transform("assign", lambda s: F.struct(s["start"].alias("at"), F.lit(1).alias("starts")))))
    df = df.withColumn("events", F.when(F.size("assign") > 0, events).otherwise(F.array().cast("array<struct<at:int,starts:int>>")))
    df = df.withColumn("counts", sum_so_far(F.transform("events", lambda e: e["starts"])))
    at_runs = F.filter(F.arrays_zip("events", "counts"), lambda e: e["events"]["starts"] == 0)
    df = df.withColumn("earlier", F.transform(at_runs, lambda e: e["counts"]))
    placed = F.zip_with("run", "earlier", lambda r, n: F.struct(
        r.alias("run"), F.coalesce(F.when(n > 0, F.element_at("assign", n)["end"] > r["start"]), F.lit(False)).alias("meets")))
    free = F.transform(F.filter("placed", lambda x: ~x["meets"]), lambda x: x["run"])
    df = df.withColumn("placed", placed).select("doc_id", free.alias("free"), F.concat(*[tagged(k) for k in KINDS[:3]]).alias("base"))
    scored = F.transform("free", lambda r: F.struct(
        r["start"].alias("start"), F.lit(KINDS.index("random")).alias("k"), r["end"].alias("end"), r["value"].alias("value"),
        model.score(r["value"]).alias("score")))
    df = df.withColumn("scored", scored)
    spans = F.array_sort(F.concat("base", F.filter("scored", lambda r: (r["score"] >= least_score) & (r["score"] >= (r["end"] - r["start"]) * model.rate))))
    named = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.element_at(F.array(*map(F.lit, KINDS)), s["k"] + 1).alias("kind"),
        s["value"].alias("value"), s["score"].cast("int").alias("score")))
    return df.select("doc_id", named.cast(SECRETS).alias("secrets"))


def shown(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
