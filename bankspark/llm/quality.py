"""Document quality by Bradley-Terry pairwise ranking over text statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from bankspark.llm.common import byte_slices, prepare, texts_of, write_stage

MAX_LABELLED = 20_000  # rows the ranking is fitted on
PAIRS_PER_ROW = 20
CUT = 0.7  # the score at the chosen quantile
RIDGE = 1e-2


def byte_classes() -> dict[str, np.ndarray]:
    out = {
        "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": b" ", "newline": b"\n",
        "exclamation": b"!?", "symbol": b"#$%&*@^~=+<>", "pipe": b"|\t", "stop": b".,;:", "bracket": b"()[]{}/\\_-'\"`",
        "high": range(128, 256), "control": [*range(9), *range(11, 32), 127],
    }
    return {k: np.isin(np.arange(256), list(v)) for k, v in out.items()}


CLASSES = byte_classes()
SHARES = np.stack(list(CLASSES.values()), axis=1).astype(float)


def features(raw: bytes) -> np.ndarray:
    """Shares of byte classes and their roots, and how words and lines repeat. An empty text has
    the statistics of nothing: zeros."""
    n = len(raw)
    if not n:
        return np.zeros(2 * SHARES.shape[1] + 9)
    share = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ SHARES / n
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n_words, n_lines = max(1, len(words)), max(1, len(lines))
    distinct = len(set(words))
    return np.concatenate([share, np.sqrt(share), [
        distinct / n_words, np.log1p(distinct) / np.log1p(n_words), min(20.0, n / n_words) / 20, np.log1p(n_words) / 10,
        len(set(lines)) / n_lines, np.log1p(n_lines) / 10, np.log1p(n / n_lines) / 10, 1.0 / n_words, np.log1p(n) / 10,
    ]])


def describe(docs: DataFrame, text_col: str = "text", out: str = "features") -> DataFrame:
    """The other columns of `docs` and the features of its whole texts (null: empty)."""
    prepare(docs.sparkSession)
    names = [c for c in docs.columns if c not in (out, text_col)]
    source = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text_col}`").alias("llm_text"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "llm_text"):
                data, offsets = texts_of(part, "llm_text")
                raw = data.tobytes()
                rows = [features(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(rows, pa.list_(pa.float64()))], names=[*names, out])

    return source.mapInArrow(run, schema)


@dataclass
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float  # raw score at the quantile
    slope: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * (self.raw(x) - self.threshold) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def rank_pairs(good: np.ndarray, bad: np.ndarray, seed: int = 7) -> np.ndarray:
    """Feature differences, preferred less other. Each row meets PAIRS_PER_ROW of the other kind."""
    rng = np.random.default_rng(seed)
    n = PAIRS_PER_ROW * max(len(good), len(bad))
    return good[np.arange(n) % len(good)] - bad[rng.permutation(n) % len(bad)]


def bradley_terry(diff: np.ndarray, ridge: float = RIDGE, rounds: int = 30) -> np.ndarray:
    """Weights that minimise the logistic loss of w . difference (Newton's method)."""
    w = np.zeros(diff.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -500, 500)))
        gradient = diff.T @ p / len(diff) - ridge * w
        curve = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(described: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        max_labelled: int = MAX_LABELLED) -> Ranking | None:
    """Learn from the described rows (`describe`) that have a label 0 or 1.

    Fitted on a bounded sample of about `max_labelled` rows, chosen by a hash of the id (all, where
    there are fewer). The threshold is the quantile of their scores at the share of label 0, so
    that as large a share passes as is labelled 1. None unless both labels occur.
    """
    marks = labels.select(F.col(id_col).alias("llm_id"), F.col(label_col).cast("int").alias("llm_y")).filter("llm_y in (0, 1)")
    known = described.select(F.col(id_col).alias("llm_id"), "features").join(marks, "llm_id")
    n = marks.count()
    if not n:
        return None
    rate = min(1.0, max_labelled / n)
    known = known.filter(F.pmod(F.xxhash64("llm_id", F.lit("quality")), F.lit(1 << 30)) < F.lit(int(rate * (1 << 30))))
    rows = known.orderBy(F.xxhash64("llm_id"), "llm_id", "llm_y").limit(2 * max_labelled).collect()  # bounded by the parameter
    y = np.array([r["llm_y"] for r in rows], int)
    if len(set(y)) < 2:
        return None
    x = np.array([r["features"] for r in rows])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.clip((x - mean) / scale, -20, 20)
    w = bradley_terry(rank_pairs(z[y == 1], z[y == 0]))
    raw = (x - mean) / scale @ w
    threshold = float(np.quantile(raw, (y == 0).mean()))
    slope, base = 1.0, np.log(CUT / (1 - CUT))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * (raw - threshold) + base, -500, 500)))
        d = raw - threshold
        step = (d @ (y - p)) / max(1e-9, d @ (d * p * (1 - p)))
        slope = float(np.clip(slope + np.clip(step, -0.5, 0.5), 0.05, 20.0))
    return Ranking(mean, scale, w, threshold, slope)


def judge(described: DataFrame, ranking: Ranking | None, score_out: str = "score") -> DataFrame:
    """The described rows, features replaced by a score from 0 to 1: the likelihood of label 1,
    shifted so that the threshold's quantile scores CUT. Without a ranking every score is 0.5."""
    names = [c for c in described.columns if c not in ("features", score_out)]
    source = described.select(*[F.col(f"`{c}`") for c in names], "features")
    schema = T.StructType([*source.schema.fields[:-1], T.StructField(score_out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = batch.column(len(names)).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else None
            score = ranking.score(x) if ranking and n else np.full(n, 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score, pa.float64())], names=[*names, score_out])

    return source.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """`docs` without its text, with a score from 0 to 1 and `predicted` (1 from CUT on).

    `learn`: condition on the columns of `docs`, the rows whose labels may be learnt from. Null
    texts count as empty and get a score like any text; labels other than 0 and 1, and those
    without a document, are ignored; repeated rows agree; an empty table gives no rows.
    """
    described = write_stage(describe(docs, text_col), "features")
    ranking = fit(described.filter(learn), labels, id_col, label_col, max_labelled)
    return judge(described, ranking).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
