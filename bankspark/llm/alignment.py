"""Alignment of two tokenizers: which tokens of either cover the same bytes of a text, from products of
sparse token-byte and token-group matrices."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from bankspark.llm.common import byte_slices, prepare, write_stage
from bankspark.llm.packing import OTHER_CHARS, Encoder

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE_MARK = "▁"
# Texts are tokenised so many bytes at a time, and pairs of ids are counted over so many.
SLICE_BYTES, CHUNK_BYTES = 1 << 20, 16 << 20
# Entries of a product that are expanded at a time, and characters handed to tokenizer B at a time.
BLOCK_ENTRIES, LONG_TEXT = 1 << 20, 1 << 20


@dataclass
class Csr:
    """A sparse 0/1 matrix by rows: row r has its ones in columns indices[indptr[r]:indptr[r + 1]]."""

    indptr: np.ndarray
    indices: np.ndarray
    n_cols: int

    @property
    def n_rows(self) -> int:
        return len(self.indptr) - 1

    def rows(self, start: int, stop: int) -> Csr:
        ptr = self.indptr[start:stop + 1]
        return Csr(ptr - ptr[0], self.indices[ptr[0]:ptr[-1]], self.n_cols)

    def transposed(self) -> Csr:
        row = np.repeat(np.arange(self.n_rows, dtype=np.int32), np.diff(self.indptr))
        if not (self.indices[1:] >= self.indices[:-1]).all():
            row = row[np.argsort(self.indices, kind="stable")]
        ptr = np.zeros(self.n_cols + 1, np.int64)
        np.cumsum(np.bincount(self.indices, minlength=self.n_cols), out=ptr[1:])
        return Csr(ptr, row, self.n_rows)


def incidence(counts: np.ndarray) -> Csr:
    """Rows that hold the next counts[r] columns each, as tokens do with the bytes of a text."""
    ptr = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=ptr[1:])
    return Csr(ptr, np.arange(ptr[-1], dtype=np.int32), int(ptr[-1]))


def membership(group: np.ndarray, n_groups: int) -> Csr:
    """Rows that lie in one column each."""
    return Csr(np.arange(len(group) + 1), group, n_groups)


def row_sizes(a: Csr, b: Csr) -> np.ndarray:
    """For each row of A, the entries of B's rows that its product with B adds up."""
    width = np.diff(b.indptr)
    if len(width) and width.min() == width.max() == 1:
        return np.diff(a.indptr)
    ends = np.concatenate([[0], np.cumsum(width[a.indices])])
    return np.diff(ends[a.indptr])


def product(a: Csr, b: Csr, block: int = BLOCK_ENTRIES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The product A B by rows (Gustavson): for each row of A the rows of B that it names are put
    together, equal columns added up. Yields (rows, columns, values), some rows at a time, so that
    about `block` entries are expanded at once."""
    done = np.concatenate([[0], np.cumsum(row_sizes(a, b))])
    width = np.diff(b.indptr)
    one_each = len(width) and width.min() == width.max() == 1
    start = 0
    while start < a.n_rows:
        stop = max(start + 1, int(np.searchsorted(done, done[start] + block, side="right")) - 1)
        part = a.rows(start, stop)
        sizes = width[part.indices]
        at, row = b.indptr[part.indices], np.repeat(np.arange(start, stop), np.diff(part.indptr))
        if not one_each:
            first = np.cumsum(sizes) - sizes
            at = np.repeat(at - first, sizes) + np.arange(sizes.sum())
            row = np.repeat(row, sizes)
        key = row * b.n_cols + b.indices[at]
        if (key[1:] < key[:-1]).any():
            key.sort()
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        yield key[new] // b.n_cols, key[new] % b.n_cols, np.diff(np.append(new, len(key)))
        start = stop


def byte_symbols() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: printable Latin-1 characters
    for themselves, the others, in their order, for the characters from 256 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class Pieces:
    """The bytes of every id of a vocabulary."""

    def __init__(self, raw: list[bytes]):
        self.size = np.array([len(x) for x in raw], np.int32)
        self.at = (np.cumsum(self.size) - self.size).astype(np.int32)
        self.data = np.frombuffer(b"".join(raw), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.size[ids]
        first = np.cumsum(sizes, dtype=np.int64) - sizes
        return self.data[np.repeat(self.at[ids] - first, sizes) + np.arange(sizes.sum())]

    def tells(self, ids: np.ndarray, raw: np.ndarray) -> bool:
        """Whether the ids spell these bytes."""
        return int(self.size[ids].sum()) == len(raw) and np.array_equal(self.spell(ids), raw)


class Tokenizers:
    """Both tokenizers: ids of a space and a text, and the bytes that an id stands for."""

    def __init__(self, path_a: str | None = None, path_b: str | None = None, ranks: str | None = None):
        import public_tokenizers
        import sentencepiece

        # Without files of one's own the ranks of the same vocabulary serve plain Latin text, several times faster.
        self.encoder = Encoder(path_a or public_tokenizers.path(TOKENIZER_A), ranks)
        self.encoder.full.encode_special_tokens = True
        self.own = path_a is not None and ranks is None
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path_b or public_tokenizers.path(TOKENIZER_B))
        symbols = byte_symbols()
        vocab = self.encoder.full.get_vocab(with_added_tokens=True)
        raw = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            known = all(c in symbols for c in token)
            raw[i] = bytes(symbols[c] for c in token) if known else token.encode()
        self.a = Pieces(raw)
        names = [self.sp.id_to_piece(i) for i in range(self.sp.vocab_size())]
        self.b = Pieces([
            bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(names)])
        # No piece runs from a word into the next one's space, so a long text can be cut there.
        self.cuts = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in names)

    def ids_a(self, text: str) -> np.ndarray:
        if self.own or "<|" in text or OTHER_CHARS.search(text):
            return np.array(self.encoder.full.encode(text, add_special_tokens=False).ids, np.int32)
        return np.array(self.encoder.fast.encode_ordinary(text), np.int32)

    def ids_b(self, text: str) -> np.ndarray:
        return np.array(self.sp.encode(text) if len(text) <= LONG_TEXT or not self.cuts else self._cut(text), np.int32)

    def _cut(self, text: str) -> list[int]:
        """Ids of a long text from its parts; each part gets the space that is left out ahead of it."""
        out, start = [], 0
        while True:
            end = text.find(" ", start + LONG_TEXT)
            while end > 0 and text[end - 1] == " ":
                end = text.find(" ", end + 1)
            if end < 0 or end == len(text) - 1:
                return out + self.sp.encode(text[start:])
            out += self.sp.encode(text[start:end])
            start = end + 1


@lru_cache(maxsize=2)
def load(path_a: str | None, path_b: str | None, ranks: str | None) -> Tokenizers:
    """Once for a Python worker."""
    return Tokenizers(path_a, path_b, ranks)


@dataclass
class Aligned:
    """Tokens of some texts, one after the other. doc_a, doc_b: the first token of each text and the number
    of all; group_a, group_b: each token's group, counted through all texts."""

    a: np.ndarray
    b: np.ndarray
    doc_a: np.ndarray
    doc_b: np.ndarray
    by_bytes_a: Csr
    by_bytes_b: Csr
    group_a: np.ndarray
    group_b: np.ndarray
    n_groups: int

    def overlaps(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Links (token of A, token of B, shared bytes): the product of A's token-byte matrix with B's transposed."""
        return product(self.by_bytes_a, self.by_bytes_b.transposed())

    def shared(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Links between all tokens of A and of B in one group: as above, with token-group matrices. As
        many as the product of both numbers, in a group that no common end cuts."""
        return product(membership(self.group_a, self.n_groups), membership(self.group_b, self.n_groups).transposed())

    def n_shared(self) -> np.ndarray:
        """How many of these links each token of A has."""
        return row_sizes(membership(self.group_a, self.n_groups), membership(self.group_b, self.n_groups).transposed())


def align_texts(texts: list[str | None], tok: Tokenizers) -> Aligned:
    """Tokens, matrices and groups of some texts; a text that either tokenizer does not give back
    byte by byte, and an empty one, has no tokens."""
    ids_a, ids_b = [], []
    for text in texts:
        a = b = np.zeros(0, np.int32)
        if text:
            a, b = tok.ids_a(" " + text), tok.ids_b(text)
            raw = np.frombuffer((" " + text).encode(), np.uint8)
            if not (tok.a.tells(a, raw) and tok.b.tells(b, raw)):
                a = b = np.zeros(0, np.int32)
        ids_a.append(a)
        ids_b.append(b)
    doc_a, doc_b = (np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64) for ids in (ids_a, ids_b))
    a, b = (np.concatenate([np.zeros(0, np.int32), *ids]) for ids in (ids_a, ids_b))
    by_a, by_b = incidence(tok.a.size[a]), incidence(tok.b.size[b])
    # A token's group is the number of common ends before its own; a text's end is one.
    ends, groups = (by_a.indptr[1:], by_b.indptr[1:]), []
    for own, other in (ends, ends[::-1]):
        marks = np.zeros(by_a.n_cols + 1, bool)
        marks[other] = True
        last = marks[own]
        groups.append(np.cumsum(last, dtype=np.int32) - last)
    return Aligned(a, b, doc_a, doc_b, by_a, by_b, *groups, int(groups[0][-1]) + 1 if len(a) else 0)


def group_strings(x: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of `a1,a2|b1;a3|b2,b3;` of all texts, and where each text's begin and end.

    Numbers are written digit by digit for all tokens at once.
    """
    first_a, first_b = (
        np.concatenate([[0], np.flatnonzero(np.diff(g)) + 1, [len(g)]])[:x.n_groups + 1] for g in (x.group_a, x.group_b))
    place_a = np.arange(len(x.a)) + first_b[x.group_a]
    place_b = np.arange(len(x.b)) + first_a[x.group_b + 1]
    ids, ends = np.empty(len(x.a) + len(x.b), np.uint32), np.full(len(x.a) + len(x.b), ord(","), np.uint8)
    ids[place_a], ids[place_b] = x.a, x.b
    ends[place_a[first_a[1:] - 1]] = ord("|")
    ends[place_b[first_b[1:] - 1]] = ord(";")
    widths = np.full(len(ids), 2, np.int64)
    for k in range(1, 10):
        if not (longer := ids >= 10**k).any():
            break
        widths += longer
    at = np.concatenate([[0], np.cumsum(widths)])
    out = np.empty(at[-1], np.uint8)
    out[at[1:] - 1] = ends
    place, left = at[1:] - 2, ids
    while len(left):
        rest = left // 10
        out[place] = left - rest * 10 + ord("0")
        more = rest > 0
        place, left = place[more] - 1, rest[more]
    return out, at[x.doc_a + x.doc_b]


def _per_doc(per_token: np.ndarray, doc_a: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(per_token)])
    return np.diff(total[doc_a])


class Chunk:
    """Texts of one task, until they hold CHUNK_BYTES: their digests, and the distinct pairs of
    linked ids of each with how often it holds them."""

    def __init__(self, chunk: int, width: int):
        self.chunk, self.width, self.held = chunk, width, 0
        self.rows: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, doc_ids: list, texts: list[str | None], tok: Tokenizers) -> None:
        x = align_texts(texts, tok)
        doc_of = np.repeat(np.arange(len(texts)), np.diff(x.doc_a))
        found = [(doc_of[i], x.a[i].astype(np.int64) * self.width + x.b[j]) for i, j, _ in x.overlaps()]
        doc = np.concatenate([np.zeros(0, np.int64), *[f[0] for f in found]])
        pair = np.concatenate([np.zeros(0, np.int64), *[f[1] for f in found]])
        n_links = np.bincount(doc, minlength=len(texts))
        key = doc << 40 | pair
        key.sort()
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        times = np.diff(np.append(new, len(key)))
        ends = np.searchsorted(key[new] >> 40, np.arange(1, len(texts)))
        self.pairs += np.split(key[new] & (1 << 40) - 1, ends)
        self.times += np.split(times, ends)
        last = np.concatenate([x.group_a[1:] != x.group_a[:-1], [True]]) if len(x.a) else np.zeros(0, bool)
        n_groups, n_shared = _per_doc(last, x.doc_a), _per_doc(x.n_shared(), x.doc_a)
        text, at = group_strings(x)
        for k, doc_id in enumerate(doc_ids):
            raw = text[at[k]:max(at[k], at[k + 1] - 1)].tobytes()
            n_a, n_b = int(x.doc_a[k + 1] - x.doc_a[k]), int(x.doc_b[k + 1] - x.doc_b[k])
            self.rows.append((doc_id, n_a, n_b, int(n_groups[k]), int(n_links[k]), int(n_shared[k]), hashlib.sha256(raw).hexdigest() if raw else ""))

    def batches(self) -> Iterator[pa.RecordBatch]:
        """A row per text, its pairs as places among the chunk's; and one row with the chunk's pairs
        and the number of texts that hold each."""
        if not self.rows:
            return
        ends = np.cumsum([0, *map(len, self.pairs)])
        pairs, places, docs = np.unique(np.concatenate([np.zeros(0, np.int64), *self.pairs]), return_inverse=True, return_counts=True)
        lists = lambda ends, values, kind: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))
        none = lists([0] * (len(self.rows) + 1), [], pa.int64())
        cols = list(zip(*self.rows))
        times = np.concatenate([np.zeros(0, np.int64), *self.times])
        yield pa.RecordBatch.from_arrays([
            pa.array([self.chunk] * len(self.rows), pa.int64()), pa.array([False] * len(self.rows)),
            *[pa.array(list(c), pa.int64()) for c in cols[:6]], pa.array(list(cols[6])),
            lists(ends, places, pa.int32()), lists(ends, times, pa.int32()), none], schema=CHUNKS_ARROW)
        yield pa.RecordBatch.from_arrays([
            pa.array([self.chunk], pa.int64()), pa.array([True]), *[pa.nulls(1, pa.int64())] * 6, pa.nulls(1, pa.string()),
            lists([0, 0], [], pa.int32()), lists([0, len(docs)], docs, pa.int32()), lists([0, len(pairs)], pairs, pa.int64())],
            schema=CHUNKS_ARROW)


DIGESTS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared")
CHUNKS = f"chunk long, summary boolean, {', '.join(f'{c} long' for c in DIGESTS)}, groups_sha256 string, places array<int>, times array<int>, pairs array<long>"
CHUNKS_ARROW = pa.schema([
    ("chunk", pa.int64()), ("summary", pa.bool_()), *[(c, pa.int64()) for c in DIGESTS], ("groups_sha256", pa.string()),
    ("places", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64()))])
SCORED = f"{', '.join(f'{c} long' for c in DIGESTS)}, groups_sha256 string, n_best long, count_sum long"
SCORED_ARROW = pa.schema([*[(c, pa.int64()) for c in DIGESTS], ("groups_sha256", pa.string()), ("n_best", pa.int64()), ("count_sum", pa.int64())])


def _score(docs: pa.Table, known: pa.Table) -> pa.Table:
    """Adds to each text of a chunk the sums over its links, given the corpus counts of the chunk's pairs."""
    order = np.argsort(known["pair"].to_numpy())
    count, best = known["docs"].to_numpy()[order], known["best"].to_numpy()[order]
    places, times = docs["places"].combine_chunks(), docs["times"].combine_chunks()
    at = np.concatenate([[0], np.cumsum(places.value_lengths().to_numpy())]).astype(np.int64)
    places = places.flatten().to_numpy().astype(np.int64)
    times = times.flatten().to_numpy().astype(np.int64)
    total = lambda values: np.diff(np.concatenate([[0], np.cumsum(values)])[at])
    n_best, count_sum = total(times * (best[places] == count[places])), total(times * count[places])
    return pa.Table.from_arrays(
        [*[docs[c] for c in (*DIGESTS, "groups_sha256")], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())], schema=SCORED_ARROW)


def count_links(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    path_a: str | None = None, path_b: str | None = None, ranks: str | None = None, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """One row per document: numbers of tokens, groups, overlap links and shared-group links, the digest of
    its groups, and over its links how many are their A id's commonest in the corpus (n_best) and the
    sum of their counts (count_sum). A pair's count is the number of documents that hold it linked.

    Null and empty texts, and those that a tokenizer does not give back, have zeros and an empty
    digest. Rows that repeat are documents of their own, null ids stay null, other columns are
    ignored, an empty table has no rows. Texts of any length: the products run a block of rows at a
    time, and tokenizer B takes long texts in parts, cut ahead of a space.

    Texts are read once and never shuffled. What is shuffled are a chunk's distinct pairs (one row
    each, so that a pair every text holds is one row a chunk), to count and to look them up, and its
    texts' pairs as places among them. A chunk is a bounded number of bytes of one task.
    """
    prepare(docs.sparkSession)
    width = len(load(path_a, path_b, ranks).b.size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        tok = load(path_a, path_b, ranks)
        chunk = Chunk((context.partitionId() if context else 0) << 32, width)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                chunk.add(part.column(0).to_pylist(), part.column(1).to_pylist(), tok)
                chunk.held += part.nbytes
                if chunk.held >= chunk_bytes:
                    yield from chunk.batches()
                    chunk = Chunk(chunk.chunk + 1, width)
        yield from chunk.batches()

    def score(docs: pa.Table, known: pa.Table) -> pa.Table:
        return _score(docs, known)

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    chunks = write_stage(source.mapInArrow(run, CHUNKS), "aligned", "summary")
    held = chunks.filter("summary").select("chunk", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = held.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("docs"))
    counts = counts.withColumn("a", F.expr(f"pair div {width}"))
    best = counts.groupBy(F.col("a").alias("a2")).agg(F.max("docs").alias("best"))
    counts = write_stage(counts.join(best, F.col("a") == F.col("a2")).select("pair", "docs", "best"), "counts")
    known = held.select("chunk", F.col("p.pairs").alias("held")).join(counts, F.col("held") == F.col("pair")).select("chunk", "pair", "docs", "best")
    texts = chunks.filter("not summary").select(
        F.col("chunk").alias("own"), *DIGESTS, "groups_sha256", "places", "times")
    return texts.groupBy("own").cogroup(known.groupBy("chunk")).applyInArrow(score, SCORED)


LINKS = (
    "doc_id long, a array<int>, b array<int>, a_group array<int>, b_group array<int>, "
    "overlaps array<struct<a: int, b: int, bytes: int>>, shared array<struct<a: int, b: int>>"
)


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    path_a: str | None = None, path_b: str | None = None, ranks: str | None = None,
) -> DataFrame:
    """One row per document: both tokenizers' ids, each token's group, the overlap links with the bytes
    shared, and the shared-group links, both by token number. Cases as in `count_links`. A group that
    no common end cuts has as many shared links as the product of its numbers of tokens."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load(path_a, path_b, ranks)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = align_texts([text], tok)
                links = [[np.concatenate([np.zeros(0, np.int64), *c]) for c in zip(*found)] or [np.zeros(0, np.int64)] * 3
                         for found in (list(x.overlaps()), list(x.shared()))]
                one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                ints = lambda values: pa.array(values, pa.int32())
                structs = lambda cols, names: pa.StructArray.from_arrays([ints(c) for c in cols], names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id], pa.int64()), *[one(ints(v)) for v in (x.a, x.b, x.group_a, x.group_b)],
                     one(structs(links[0], ["a", "b", "bytes"])), one(structs(links[1][:2], ["a", "b"]))],
                    names=["doc_id", "a", "b", "a_group", "b_group", "overlaps", "shared"])

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return source.mapInArrow(run, LINKS)
