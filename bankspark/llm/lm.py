"""Language-model scores: a trie of token n-grams, backed by word counts and a byte trie of the words."""

from __future__ import annotations

import itertools
import os
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bankspark.llm.common import byte_slices, prepare, row_key, texts_of, write_stage
from bankspark.llm.ngram_trie import ORDER, TokenLevel, Trie, gram_counts
from bankspark.session import work_dir
from bankspark.sources.sinks import _fs, _path, discard

DISCOUNT = 0.75
TOKENS = 2  # the longest gram of tokens
BLOCK_BYTES = 16 << 20  # text whose words share one dictionary
SHARD_BYTES = 16 << 20  # text whose grams, by their contexts, make one shard of a level
CHUNK_GRAMS = 1 << 17  # grams handed on or added up at once
WORDS_AT_ONCE = 50_000
END = b""  # the token behind the last word
LN10 = float(np.log(10.0))

CLASSES = 8
MARKERS = 400  # frequent words that tell the class of what follows

# Rows of a block: its documents (payload: tokens), the words it holds (payload: word, count n), the shards of
# a level's contexts (payload), and its token grams by shard of their context (see `GRAM_PARTS`).
BLOCK_ARROW = pa.schema([
    ("kind", pa.int32()), ("block", pa.int64()), ("k_id", pa.int64()), ("k_row", pa.int64()), ("held_out", pa.bool_()),
    ("number", pa.int64()), ("n", pa.int64()), ("level", pa.int32()), ("shard", pa.int32()), ("payload", pa.binary()),
])
GRAM_PARTS = ("contexts", "runs", "words", "at", "counts")
BLOCKS = ", ".join(
    f"{f.name} {({'int32': 'int', 'int64': 'long', 'bool': 'boolean', 'binary': 'binary'})[str(f.type)]}" for f in BLOCK_ARROW)
DOCUMENT, WORD, SHARDS, GRAM = 0, 1, 2, 3


def tokens_of(raw: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, and the end."""
    words = raw.lower().split()
    words.append(END)
    return words


def planes(values: np.ndarray) -> bytes:
    """Numbers under 2^32 as four runs of bytes, low bytes first; high ones are mostly zeros."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unplaned(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def squeezed(values: np.ndarray) -> bytes:
    """Many numbers under 2^32, compressed where they are made, as they are written and shuffled."""
    return len(values).to_bytes(4, "little") + pa.compress(planes(values), "zstd", asbytes=True)


def unsqueezed(raw: bytes) -> np.ndarray:
    size = int.from_bytes(raw[:4], "little")
    return unplaned(pa.decompress(raw[4:], 4 * size, "zstd", asbytes=True))


def joined(parts: list[bytes]) -> bytes:
    """Some byte strings as one."""
    return np.array([len(p) for p in parts], "<u4").tobytes() + b"".join(parts)


def parted(raw: bytes, n: int) -> list[bytes]:
    ends = np.cumsum([4 * n, *np.frombuffer(raw, "<u4", n).tolist()]).tolist()
    return [raw[a:b] for a, b in zip(ends[:-1], ends[1:])]


def learn_classes(docs: DataFrame) -> dict[bytes, int]:
    """Classes (from 1) of the most frequent words, by the documents they share.

    docs: (text). From all documents; each task sums its own, and the driver holds MARKERS x
    MARKERS numbers. The scores do not use it: their contexts are the tokens before.
    """

    def frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in byte_slices(batch, "text"):
                data, offsets = texts_of(rows, "text")
                raw = data.tobytes()
                seen = Counter(w for a, b in zip(offsets[:-1], offsets[1:]) for w in set(tokens_of(raw[a:b])[:-1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    top = docs.mapInArrow(frequency, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    markers = [bytes(r["word"]) for r in top.orderBy(F.desc("n"), "word").limit(MARKERS).collect()]
    if not markers:
        return {}
    number = {w: i for i, w in enumerate(markers)}

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = np.zeros((len(number), len(number)))
        for batch in batches:
            for rows in byte_slices(batch, "text"):
                data, offsets = texts_of(rows, "text")
                raw = data.tobytes()
                holds = np.zeros((len(rows), len(number)), np.float32)
                for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                    holds[i, [number[w] for w in number.keys() & set(tokens_of(raw[a:b])[:-1])]] = 1
                shared += holds.T @ holds
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(shared))), pa.array(list(shared), pa.list_(pa.float64()))], names=["i", "n"])

    rows = docs.mapInArrow(together, "i long, n array<double>").groupBy("i")
    sums = rows.agg(*[F.sum(F.col("n")[j]).alias(f"n{j}") for j in range(len(markers))]).orderBy("i").collect()
    shared = np.array([r[1:] for r in sums])
    kinds = clusters(shared / np.sqrt(np.outer(np.diag(shared), np.diag(shared))), CLASSES)
    return {w: int(k) + 1 for w, k in zip(markers, kinds)}


def clusters(rows: np.ndarray, n: int, rounds: int = 30) -> np.ndarray:
    """Spherical k-means with farthest-first starts."""
    x = rows - rows.mean(axis=0)
    x = x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-12)
    chosen = [0]
    while len(chosen) < min(n, len(x)):
        chosen.append(int((x @ x[chosen].T).max(axis=1).argmin()))
    centres = x[chosen]
    for _ in range(rounds):
        kind = (x @ centres.T).argmax(axis=1)
        for k in range(len(centres)):
            if (kind == k).any():
                centres[k] = x[kind == k].mean(axis=0)
                centres[k] /= np.linalg.norm(centres[k]) + 1e-12
    return kind


class Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def hashed(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, the same in every process."""
    return pd.util.hash_array(np.array([*words, None], object)[:-1], categorize=False) if words else np.zeros(0, np.uint64)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes, in order."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    for shift in (32, 29):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def six(hashes: np.ndarray) -> bytes:
    """Their low 48 bits, which tell grams of a shard apart (its number holds the bits above)."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unsix(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.int64)


def token_grams(
    ids: np.ndarray, starts: np.ndarray, width: int, shards: Callable[[int], np.ndarray], tokens: int = TOKENS,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Distinct grams of 2, ... `tokens` tokens that end at each position of some documents.

    ids: the documents' tokens (under `width`), one after the other; starts: where documents begin. What
    precedes a document is a token of its own. Contexts of a level are numbered as the grams of the
    level before, and the beginning last; shards(length) tells the shard of each. Per length: the context of
    each gram, its last token, and the gram of each position. Grams come by shard, context and last
    token, whatever the documents' order.
    """
    context, n = np.roll(ids, 1), width
    for k in range(2, tokens + 1):
        context[starts] = n
        by = np.argsort(shards(k), kind="stable")
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        key = rank[context] * width + ids
        order = np.argsort(key)
        key = key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        gram = np.empty(len(ids), np.int64)
        gram[order] = np.cumsum(new) - 1
        key = key[new]
        yield by[key // width], key % width, gram
        context, n = np.roll(gram, 1), len(key)


def shards_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shares of the range of hashes."""
    return ((hashes >> np.uint64(40)).astype(np.int64) * shards) >> 24


def cuts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    return np.concatenate([[0], np.nonzero(values[1:] != values[:-1])[0] + 1, [len(values)]])


def _batch(size: int, **cols) -> pa.RecordBatch:
    whole = {f.name: pa.nulls(size, f.type) for f in BLOCK_ARROW}
    whole |= {k: v if isinstance(v, pa.Array) else pa.array(v, BLOCK_ARROW.field(k).type) for k, v in cols.items()}
    return pa.RecordBatch.from_arrays(list(whole.values()), schema=BLOCK_ARROW)


def _block_rows(shards: int, tokens: int):
    """Documents as numbers of a block's own dictionary; that dictionary with the counts of the
    training documents; and the block's distinct token grams with theirs, by shard of their context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, serial = TaskContext.get().partitionId(), itertools.count()

        def fresh():
            return (part << 24) + next(serial), Numbers(), [], [], 0

        def close() -> Iterator[pa.RecordBatch]:
            ids = np.concatenate(texts)
            sizes = np.array([len(t) for t in texts])
            trained = np.repeat(np.array(trains, np.int64), sizes)
            words, n = list(known), len(known)
            hashes = hashed(words)
            counts = np.bincount(ids, weights=trained, minlength=n).astype(np.int64)
            for a in range(0, n, WORDS_AT_ONCE):
                b = min(n, a + WORDS_AT_ONCE)
                yield _batch(
                    b - a, kind=np.full(b - a, WORD, np.int32), block=np.full(b - a, block), number=np.arange(a, b), payload=words[a:b],
                    n=counts[a:b])
            del words
            known.clear()  # the numbers suffice from here on
            texts.clear()
            contexts = np.append(hashes, np.uint64(1))
            grams = token_grams(ids, np.cumsum(sizes) - sizes, n, lambda _: shards_of(contexts, shards), tokens)
            for k, (context, last, gram) in enumerate(grams):
                counts = np.bincount(gram, weights=trained, minlength=len(last)).astype(np.int64)
                shard, before = shards_of(contexts, shards), contexts[context]
                yield _batch(1, kind=[SHARDS], block=[block], level=[k + 2], payload=[squeezed(shard)])
                shard, contexts = shard[context], np.append(mixed(before, hashes[last]), np.uint64(k + 2))
                rows, held = [], 0
                at = cuts(shard)
                for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                    run_at = cuts(context[a:b])
                    distinct, place = np.unique(last[a:b], return_inverse=True)
                    rows.append((int(shard[a]), a, joined([
                        six(before[a:b][run_at[:-1]]), squeezed(np.diff(run_at)), six(hashes[distinct]), squeezed(place), squeezed(counts[a:b])])))
                    held += b - a
                    if held > CHUNK_GRAMS or b == len(last):
                        m, c = len(rows), dict(zip(("shard", "number", "payload"), zip(*rows)))
                        yield _batch(m, kind=[GRAM] * m, block=[block] * m, level=[k + 2] * m, **c)
                        rows, held = [], 0

        block, known, texts, trains, size = fresh()
        for batch in batches:
            for rows in byte_slices(batch, "text"):
                data, offsets = texts_of(rows, "text")
                raw = data.tobytes()
                n = len(rows)
                for i, held_out in enumerate(rows.column(2).to_pylist()):
                    words = tokens_of(raw[offsets[i]:offsets[i + 1]])
                    texts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                    trains.append(not held_out)
                yield _batch(
                    n, kind=[DOCUMENT] * n, block=[block] * n, k_id=rows.column(0), k_row=rows.column(1), held_out=rows.column(2),
                    n=[len(t) for t in texts[-n:]], payload=[planes(t) for t in texts[-n:]])
                size += len(raw) + 16 * n
                if size > BLOCK_BYTES:
                    yield from close()
                    block, known, texts, trains, size = fresh()
        if texts:
            yield from close()

    return run


ANSWERS = "block long, level int, number long, payload binary"  # codes and books of probabilities and backoffs


def token_level(key: tuple, rows: pa.Table) -> pa.Table:
    """The trie's level of a shard of contexts, and what it says of the grams each block asks for.

    Counts are added up a few chunks at a time, so that a frequent context costs its distinct words
    and not its occurrences.
    """
    c = dict(zip(GRAM_PARTS, zip(*[parted(x.as_py(), len(GRAM_PARTS)) for x in rows.column("payload")])))
    contexts = np.unique(unsix(b"".join(c["contexts"])))
    words = np.unique(unsix(b"".join(c["words"])))
    width = len(words)

    def places(i: int) -> tuple[np.ndarray, np.ndarray]:
        context = np.searchsorted(contexts, unsix(c["contexts"][i]))
        return context, np.repeat(context, unsqueezed(c["runs"][i])) * width + np.searchsorted(words, unsix(c["words"][i]))[unsqueezed(c["at"][i])]

    keys, counts, held = [np.zeros(0, np.int64)], [np.zeros(0)], 0
    for i in range(len(rows)):
        n = unsqueezed(c["counts"][i])
        seen = n > 0
        keys.append(places(i)[1][seen])
        counts.append(n[seen].astype(float))
        held += len(keys[-1])
        if i == len(rows) - 1 or held > max(CHUNK_GRAMS, 2 * len(keys[0])):
            every, n = np.concatenate(keys), np.concatenate(counts)
            order = np.argsort(every)
            every = every[order]
            at = cuts(every)[:-1] if len(every) else np.zeros(0, np.int64)
            keys, counts, held = [every[at]], [np.add.reduceat(n[order], at) if len(at) else n], 0
    level = TokenLevel.build(keys[0], counts[0], len(contexts), width)
    books = [x.book.astype("<f4").tobytes() for x in (level.logp, level.backoff)]
    said = []
    for i in range(len(rows)):
        context, key_of = places(i)
        said.append(joined([level.find(key_of).tobytes(), level.backoff.codes[context].tobytes(), *books]))
    return pa.table({
        "block": rows.column("block"), "level": rows.column("level"), "number": rows.column("number"), "payload": pa.array(said, pa.binary())})


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of packed byte grams of the words, by length."""
    for batch in word_batches(batches):
        for k, (gram, n) in enumerate(gram_counts(batch.column(0).to_pylist())):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(gram), k + 1, np.int32)), pa.array(gram), pa.array(n.astype(np.int64))], names=["size", "gram", "n"])


def word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches joined to WORDS_AT_ONCE rows, and cut by bytes."""
    held, n = [], 0

    def joined() -> Iterator[pa.RecordBatch]:
        for whole in pa.Table.from_batches(held).combine_chunks().to_batches():
            yield from byte_slices(whole, "word")

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= WORDS_AT_ONCE:
            yield from joined()
            held, n = [], 0
    if held:
        yield from joined()


@dataclass
class Model:
    """Counts of the tokens of all documents (written), what the trie of token grams says of each
    block's grams (written), and the byte trie behind the words."""

    blocks: DataFrame
    grams: DataFrame  # see ANSWERS
    words: DataFrame  # word, c1
    train_tokens: int  # N
    distinct: int  # V
    trie: str | None  # name of the file that every executor holds
    tokens: int = TOKENS  # the longest gram of tokens


def train(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, tokens: int = TOKENS,
) -> Model:
    """Count the training documents' tokens and their grams of up to `tokens`, and build both tries.

    Every document becomes numbers of its block's dictionary. A block passes on each of its distinct
    token grams once, with its count; the grams meet by shard of their context, where they become a level
    of the trie and are looked up for the blocks. The number of shards grows with the text. The byte
    trie counts the grams of each distinct training word once and holds all of them up to `order`,
    so it grows with the distinct words. Known cost: its levels pass through the driver (`build_trie`).
    """
    spark = docs.sparkSession
    prepare(spark)
    source = docs.select(*row_key(id_col, text_col), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = write_stage(source.mapInArrow(_block_rows(1 + size // SHARD_BYTES, tokens), BLOCKS), "blocks", "kind")
    grams = blocks.filter(F.col("kind") == GRAM).select("block", "level", "shard", "number", "payload")
    grams = write_stage(grams.groupBy("level", "shard").applyInArrow(token_level, ANSWERS), "token-grams")
    discard(spark, f"{blocks.stage_path}/kind={GRAM}")
    words = blocks.filter(F.col("kind") == WORD).groupBy(F.col("payload").alias("word")).agg(F.sum("n").alias("c1"))
    words = write_stage(words, "counts")
    total, distinct = words.agg(F.coalesce(F.sum("c1"), F.lit(0)), F.count_if(F.col("c1") > 0)).first()
    name = None
    if total:
        spelt = words.filter("c1 > 0").select("word").mapInArrow(_grams, "size int, gram long, n long")
        spelt = write_stage(spelt.filter(F.col("size") <= order).groupBy("size", "gram").agg(F.sum("n").alias("n")), "grams")
        name = share(spark, build_trie(spelt, order).dump())
    return Model(blocks, grams, words, int(total), int(distinct), name, tokens)


def build_trie(grams: DataFrame, order: int) -> Trie:
    """The trie of the grams up to a length, one level after the other gathered by the driver."""
    levels = []
    for k in range(1, order + 1):
        rows = grams.filter(F.col("size") == k).select("gram", "n").toArrow()
        gram = rows.column("gram").to_numpy()
        n = rows.column("n").to_numpy()
        at = np.argsort(gram)
        levels.append((gram[at], n[at].astype(float)))
    levels = [x for x in levels if len(x[0])]
    return Trie.build([g for g, _ in levels], [n for _, n in levels])


def share(spark: SparkSession, data: bytes) -> str:
    """Write a file to the shared folder and have every executor fetch it; its name there."""
    path = work_dir(spark, "trie")
    out = _fs(spark, path).create(_path(spark, path))
    for at in range(0, len(data), 1 << 20):
        out.write(bytearray(data[at:at + (1 << 20)]))
    out.close()
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def word_scores(model: Model) -> DataFrame:
    """(word, c1, logp): the word's training count and its log10 probability without context.

    Absolute discount: P1 = (max(c1 - d, 0) + d V trie(word)) / N. The end token is the empty word.
    """
    n, v, name = float(model.train_tokens), float(model.distinct), model.trie

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie.open(SparkFiles.get(name))
        for batch in word_batches(batches):
            spelling = trie.score(batch.column(0).to_pylist())
            c1 = batch.column(1).to_numpy()
            # Logarithms, as a long unknown word is under the range of doubles.
            plain = np.where(c1 > 0, np.log10(np.maximum(c1 - DISCOUNT, 1e-9) / n), -np.inf)
            p1 = np.logaddexp(plain * LN10, (np.log10(DISCOUNT * v / n) + spelling) * LN10) / LN10
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p1)], names=["word", "c1", "p1"])

    return model.words.mapInArrow(run, "word binary, c1 long, p1 double")


SCORES = (
    "k_id long, k_row long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score(model: Model) -> DataFrame:
    """Per document: k_id, k_row (see `row_key`), held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    Tokens are the words between ASCII white space, A-Z lower-cased, and one end. base_score sums
    log10((c + 0.5) / (N + 0.5 (V + 1))), score the model's log10 probabilities: of a token behind
    the one before it, P2 = (c2 - d) / c(context) + backoff(context) P1, likewise from P2 on in longer
    contexts; P1 is that of the word alone (`word_scores`); a context that training lacks passes the shorter one's on. Null and empty
    texts are the end alone. Held-out conditions that are null count as false; repeated rows agree;
    other columns are ignored; an empty table gives no rows. Without training documents the score
    is the base.

    Words meet their scores by one join, per block and not per occurrence; a block then finds its
    documents' words and grams again by number.
    """
    n, v, tokens = model.train_tokens, model.distinct, model.tokens
    base = np.log10(n + 0.5 * (v + 1))
    plain = model.words.select("word", "c1", F.lit(float(np.log10(0.5) - base)).alias("p1"))
    found = write_stage(word_scores(model) if model.trie else plain, "word-scores")
    asked = model.blocks.filter(F.col("kind") == WORD).select(F.col("block").alias("in_block"), "number", F.col("payload").alias("word"))
    # Keys are unique on the hashed side, so its partitions are even; no sort of the words.
    values = asked.join(found.hint("shuffle_hash"), "word").select("in_block", "number", "c1", "p1")
    values = values.unionByName(model.grams.withColumnRenamed("block", "in_block"), allowMissingColumns=True)
    documents = model.blocks.filter(F.col("kind").isin(DOCUMENT, SHARDS)).select("block", "level", "k_id", "k_row", "held_out", "n", "payload")

    def meet(docs: pa.Table, values: pa.Table) -> pa.Table:
        words = values.filter(pc.is_null(values.column("level")))
        order = np.argsort(words.column("number").to_numpy())
        c1, p1 = (words.column(x).to_numpy()[order] for x in ("c1", "p1"))
        grams = values.filter(pc.is_valid(values.column("level"))).sort_by("number")
        shards = docs.filter(pc.is_valid(docs.column("level")))
        shards = dict(zip(shards.column("level").to_pylist(), shards.column("payload").to_pylist()))
        docs = docs.filter(pc.is_null(docs.column("level")))
        ids = np.concatenate([unplaned(t.as_py()) for t in docs.column("payload")])
        sizes = docs.column("n").to_numpy()
        starts = np.cumsum(sizes) - sizes
        plain, known = np.log10(c1 + 0.5) - base, (c1 > 0).astype(np.int64)
        logp = p1[ids]
        for k, (context, last, gram) in enumerate(token_grams(ids, starts, len(c1), lambda length: unsqueezed(shards[length]), tokens)):
            share, found, weight = [], [], []
            for raw in grams.filter(pc.equal(grams.column("level"), k + 2)).column("payload"):
                code, back, p_book, b_book = [np.frombuffer(x, t) for x, t in zip(parted(raw.as_py(), 4), ("u1", "u1", "<f4", "<f4"))]
                found.append(code != TokenLevel.ABSENT)
                share.append(p_book.astype(float)[np.minimum(code, len(p_book) - 1)])
                weight.append(b_book.astype(float)[back])
            found, share = np.concatenate(found), np.concatenate(share)
            at = np.empty(len(last), np.int64)
            at[gram] = np.arange(len(gram))
            lower = np.repeat(np.concatenate(weight), np.diff(cuts(context))) + logp[at]
            lower[found] = np.minimum(np.logaddexp(share[found] * LN10, lower[found] * LN10) / LN10, 0.0)
            logp = lower[gram]
        return pa.table({
            "k_id": docs.column("k_id"), "k_row": docs.column("k_row"), "held_out": docs.column("held_out"), "n_tokens": docs.column("n"),
            "n_known": pa.array(np.add.reduceat(known[ids], starts)), "train_tokens": pa.array(np.full(len(docs), n, np.int64)),
            "base_score": pa.array(np.add.reduceat(plain[ids], starts)), "score": pa.array(np.add.reduceat(logp, starts))})

    return documents.groupBy("block").cogroup(values.groupBy("in_block")).applyInArrow(meet, SCORES)


def score_corpus(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows that are not held out and score all."""
    return score(train(docs, held_out, id_col, text_col))
