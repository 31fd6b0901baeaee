"""Language identification by unigrams of pieces, summed over all segmentations of a word."""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from bankspark.llm.common import byte_slices, prepare, write_stage

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
RUNS = re.compile(r"[^\W\d_]+")
MAX_PIECE = 16  # longer pieces of the vocabulary are not used
MAX_WORD = 48  # a longer run of letters is scored in stretches of so many bytes
SCALE = 64.0  # per byte, keeps products of probabilities within a double's range
MAX_DOCS_PER_LANG = 1000
CACHE_WORDS = 400_000
UNDETERMINED = "und"


def read_vocabulary(path: str | None = None) -> list[bytes]:
    """The pieces of a public rank file, as they stand there."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, "rb") as f:
        pieces = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
    return [p for p in pieces if len(p) <= MAX_PIECE]


class Trie:
    """Pieces by prefix: the child of a node under a byte is found in a sorted key array."""

    def __init__(self, pieces: Iterable[bytes]):
        children: dict[int, int] = {}
        piece_at = [-1]
        for k, piece in enumerate(pieces):
            node = 0
            for b in piece:
                key = node << 8 | b
                node = children.setdefault(key, len(piece_at))
                if node == len(piece_at):
                    piece_at.append(-1)
            piece_at[node] = k
        keys = np.fromiter(children.keys(), np.int64, len(children))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.nodes = np.fromiter(children.values(), np.int64, len(children))[order]
        self.piece_at = np.array(piece_at, np.int64)
        self.first = np.full(256, -1, np.int64)  # from the root
        for b in range(256):
            self.first[b] = children.get(b, -1)

    def step(self, nodes: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = nodes << 8 | byte
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.nodes[at], -1)

    def lattice(self, words: list[bytes]) -> tuple[np.ndarray, list[tuple]]:
        """Lengths of the words, and by (start, length) which of them hold which piece there."""
        lengths = np.array([len(w) for w in words], np.int64)
        width = int(lengths.max())
        grid = np.zeros((len(words), width), np.uint8)
        mask = np.arange(width) < lengths[:, None]
        grid[mask] = np.frombuffer(b"".join(words), np.uint8)
        arcs = []
        for start in range(width):
            rows = np.nonzero(lengths > start)[0]
            nodes = self.first[grid[rows, start]]
            for size in range(1, MAX_PIECE + 1):
                on = nodes >= 0
                rows, nodes = rows[on], nodes[on]
                if not len(rows):
                    break
                piece = self.piece_at[nodes]
                if (hit := piece >= 0).any():
                    arcs.append((start, size, rows[hit], piece[hit]))
                more = lengths[rows] > start + size
                rows, nodes = rows[more], nodes[more]
                if size < MAX_PIECE and len(rows):
                    nodes = self.step(nodes, grid[rows, start + size].astype(np.int64))
        return lengths, arcs


def forward(lengths: np.ndarray, arcs: list[tuple], probs: np.ndarray) -> np.ndarray:
    """alpha[word, position, language]: scaled sum over the segmentations of each prefix."""
    alpha = np.zeros((len(lengths), int(lengths.max()) + 1, probs.shape[1]))
    alpha[:, 0] = 1.0
    for start, size, rows, piece in arcs:
        alpha[rows, start + size] += alpha[rows, start] * (probs[piece] * SCALE**size)
    return alpha


def log_probs(trie: Trie, probs: np.ndarray, words: list[bytes], block: int = 20000) -> np.ndarray:
    """Natural log probability of each word in each language, all segmentations summed."""
    out = np.empty((len(words), probs.shape[1]))
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for at in range(0, len(order), block):
        part = order[at:at + block]
        lengths, arcs = trie.lattice([words[i] for i in part])
        alpha = forward(lengths, arcs, probs)
        total = alpha[np.arange(len(part)), lengths]
        out[part] = np.log(np.maximum(total, 1e-300)) - lengths[:, None] * np.log(SCALE)
    return out


def expected_counts(
    trie: Trie, probs: np.ndarray, words: list[bytes], counts: np.ndarray, block: int = 20000
) -> np.ndarray:
    """Expected piece counts per language (forward-backward), each word weighted by its counts."""
    out = np.zeros_like(probs)
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for at in range(0, len(order), block):
        part = order[at:at + block]
        lengths, arcs = trie.lattice([words[i] for i in part])
        alpha = forward(lengths, arcs, probs)
        n = np.arange(len(part))
        beta = np.zeros_like(alpha)
        beta[n, lengths] = 1.0
        weight = counts[part] / np.maximum(alpha[n, lengths], 1e-300)
        for start, size, rows, piece in reversed(arcs):
            p = probs[piece] * SCALE**size
            through = p * beta[rows, start + size]
            beta[rows, start] += through
            np.add.at(out, piece, alpha[rows, start] * through * weight[rows])
    return out


def letters(text: str) -> Iterator[str]:
    """Runs of letters. The pattern's runs may also hold numerals that are no digits, such as
    fractions and superscripts; those are cut out."""
    for run in RUNS.findall(text):
        if run.isalpha():
            yield run
        else:
            yield from "".join(c if c.isalpha() else " " for c in run).split()


def words_of(text: str) -> list[bytes]:
    """Lower-cased runs of letters behind a space, long runs in stretches."""
    out = []
    for word in letters(text.lower()):
        raw = b" " + word.encode("utf-8", "surrogatepass")
        if len(raw) <= MAX_WORD:
            out.append(raw)
        else:
            out.extend(raw[i:i + MAX_WORD] for i in range(0, len(raw), MAX_WORD))
    return out


@dataclass
class Model:
    langs: list[str]
    log_prior: np.ndarray
    probs: np.ndarray  # piece x language
    vocabulary: str | None


def normalised(counts: np.ndarray, n_pieces: int) -> np.ndarray:
    """Piece probabilities from counts; half a count is spread as in all languages together,
    a little of it evenly, so that every word can be segmented in every language."""
    pooled = counts.sum(axis=1) + 1e-3
    pooled = pooled / pooled.sum()
    counts = counts + 200.0 * pooled[:, None]
    return 0.9999 * counts / counts.sum(axis=0) + 1e-4 / n_pieces


def fit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
    rounds: int = 2, max_docs_per_lang: int = MAX_DOCS_PER_LANG, vocabulary: str | None = None,
) -> Model | None:
    """Learn from the rows with text and language.

    Fitted on a bounded sample: about `max_docs_per_lang` rows of each language, chosen by a hash
    of the id (all, where there are fewer). Expectation-maximisation over all segmentations runs
    as Spark jobs on the word counts; the driver holds vocabulary x languages numbers. None if
    nothing can be learnt.
    """
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    langs = sorted(sizes)
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, max_docs_per_lang / sizes[k]))])
    sample = rows.filter(
        F.pmod(F.xxhash64("id", F.lit("langid")), F.lit(1 << 30)) < share[F.col("lang")] * float(1 << 30)
    ).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text"):
                seen: dict[str, Counter] = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    seen.setdefault(lang, Counter()).update(words_of(text))
                for lang, words in seen.items():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.binary()),
                         pa.array(list(words.values()), pa.int64())], names=["lang", "word", "n"])

    words = sample.mapInArrow(count, "lang string, word binary, n long").groupBy("word")
    words = words.agg(*[
        F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"n{i}") for i, x in enumerate(langs)
    ])
    words = write_stage(words, "langid-words")
    pieces = read_vocabulary(vocabulary)
    probs = np.full((len(pieces), len(langs)), 1.0 / len(pieces))

    for _ in range(rounds):
        now = probs

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trie = Trie(pieces)
            total = np.zeros_like(now)
            for batch in batches:
                if batch.num_rows:
                    n = np.column_stack([batch.column(i + 1).to_numpy(zero_copy_only=False) for i in range(len(langs))])
                    total += expected_counts(trie, now, batch.column(0).to_pylist(), n.astype(float))
            at = np.nonzero(total.sum(axis=1))[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int64()), pa.array(list(total[at]), pa.list_(pa.float64()))], names=["piece", "c"])

        parts = words.mapInArrow(expect, "piece long, c array<double>")
        # vocabulary x languages numbers, whatever the input.
        got = parts.groupBy("piece").agg(*[F.sum(F.col("c")[i]).alias(f"c{i}") for i in range(len(langs))]).collect()
        counts = np.zeros_like(probs)
        for r in got:
            counts[r["piece"]] = r[1:]
        probs = normalised(counts, len(pieces))
    n = np.array([sizes[k] for k in langs], float)
    return Model(langs, np.log(n / n.sum()), probs, vocabulary)


class Scorer:
    """Log probabilities of texts, word by word, with a bounded memory of words."""

    def __init__(self, model: Model):
        self.model, self.trie = model, Trie(read_vocabulary(model.vocabulary))
        self.forget()

    def forget(self) -> None:
        self.at: dict[bytes, int] = {}
        self.rows = np.empty((1 << 14, len(self.model.langs)))

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, posterior probability) of each text; `und` and 0 without a letter."""
        if len(self.at) > CACHE_WORDS:
            self.forget()
        docs = [words_of(t) if t else [] for t in texts]
        at = self.at
        new = list({w for words in docs for w in words if w not in at})
        if new:
            n = len(at)
            while n + len(new) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
            self.rows[n:n + len(new)] = log_probs(self.trie, self.model.probs, new)
            at.update(zip(new, range(n, n + len(new))))
        out = []
        for words in docs:
            if not words:
                out.append((UNDETERMINED, 0.0))
                continue
            total = self.rows[[at[w] for w in words]].sum(axis=0) + self.model.log_prior
            p = np.exp(total - total.max())
            best = int(p.argmax())
            out.append((self.model.langs[best], float(p[best] / p.sum())))
        return out


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", lang_out: str = "lang_pred",
             score_out: str = "score") -> DataFrame:
    """All columns of `docs` (bar those of the result's names), the likeliest learnt language of
    the whole text and its posterior probability.

    A null text, an empty one and one without a letter get `und` and 0, as does every text if
    there is no model. Ties go to the first language in order. Rows are judged one by one, so
    repeated rows stay and agree.
    """
    prepare(docs.sparkSession)
    names = [c for c in docs.columns if c not in (lang_out, score_out)]
    source = docs.select(*[F.col(f"`{c}`") for c in names])
    schema = T.StructType([
        *source.schema.fields, T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for batch in batches:
            for part in byte_slices(batch, text_col):
                texts = part.column(names.index(text_col)).to_pylist()
                got = scorer.score(texts) if scorer else [(UNDETERMINED, 0.0)] * len(texts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())],
                    names=[*names, lang_out, score_out])

    return source.mapInArrow(run, schema)
