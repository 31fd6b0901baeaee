"""Hierarchical packing of tokenised documents into windows of several lengths."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from bankspark.llm.common import byte_slices, prepare

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"  # the same vocabulary as byte ranks
END_ID = 1
TIERS = (256, 512, 1024, 2048)
# Texts within these characters are split alike by both libraries' Unicode tables.
OTHER_CHARS = re.compile("[^\x00-ɏ]")
BUFFER_TOKENS = 1 << 21

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "tier int, step_group long"
)


class Encoder:
    """Token ids of a text, as `Tokenizer.encode(text, add_special_tokens=False)` gives them.

    The same vocabulary's rank file is several times faster, so plain Latin text takes that way;
    any other text, and one that holds the special token's string, takes the tokenizer itself.
    """

    def __init__(self, tokenizer: str | None = None, ranks: str | None = None):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(tokenizer or public_tokenizers.path(TOKENIZER))
        with open(ranks or public_tokenizers.path(RANKS), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        )

    def __call__(self, text: str) -> list[int]:
        if OTHER_CHARS.search(text) or "<|" in text:
            return self.full.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Packer:
    """Packs the documents of one task.

    A document longer than the longest window fills whole windows first; its rest, and every
    shorter document, waits in the shortest tier that holds it. When `buffer` tokens wait, each
    tier is packed, longest first: a window is opened by that tier's longest document, and its gap
    is filled by the longest waiting document that fits, whatever its tier; the last gap is closed
    by cutting the head off a waiting document. So windows in the midst are full. What is left at
    the end is packed into the tiers' lengths, which are powers of two, and then cut at powers of
    two, so that only a rest under the shortest one is spread over still shorter powers.

    Every `group` windows of one length form a step group, so the steps of a group hold the same
    number of tokens.
    """

    def __init__(self, part: int, tiers: tuple[int, ...], buffer: int, group: int):
        self.tiers, self.buffer, self.group = tuple(sorted(tiers)), buffer, group
        self.longest = self.tiers[-1]
        self.base, self.n = part << 33, 0
        self.waiting: dict[int, list[tuple]] = {}  # by length: (row, ids, start)
        self.held = 0
        self.lengths: np.ndarray | None = None
        self.windows: dict[int, int] = {}
        self.out: list[tuple] = []

    def add(self, row: tuple, ids: np.ndarray) -> None:
        """row: (doc_id, number of the document's ids)."""
        at = 0
        while len(ids) - at >= self.longest:
            self.window([(row, ids[at:at + self.longest], at)])
            at += self.longest
        if at < len(ids):
            self.wait(row, ids[at:], at)
        if self.held >= self.buffer:
            self.drain(final=False)

    def wait(self, row: tuple, ids: np.ndarray, start: int) -> None:
        self.waiting.setdefault(len(ids), []).append((row, ids, start))
        self.held += len(ids)

    def take(self, most: int) -> tuple | None:
        """The longest waiting piece of at most `most` ids."""
        i = int(np.searchsorted(self.index, most, side="right")) - 1
        while i >= 0:
            pieces = self.waiting.get(int(self.index[i]))
            if pieces:
                piece = pieces.pop()
                self.held -= len(piece[1])
                if not pieces:
                    self.index = np.delete(self.index, i)
                return piece
            i -= 1
        return None

    def cut(self, length: int) -> tuple | None:
        """The first `length` ids of the shortest waiting piece that is longer."""
        i = int(np.searchsorted(self.index, length, side="right"))
        if i >= len(self.index):
            return None
        size = int(self.index[i])
        row, ids, start = self.waiting[size].pop()
        if not self.waiting[size]:
            self.index = np.delete(self.index, i)
        self.held -= size
        self.wait(row, ids[length:], start + length)
        rest = size - length
        j = int(np.searchsorted(self.index, rest))
        if j == len(self.index) or self.index[j] != rest:
            self.index = np.insert(self.index, j, rest)
        return row, ids[:length], start

    def fill(self, size: int) -> bool:
        """One window of `size` ids, full unless too little is waiting."""
        pieces, room = [], size
        while room and (piece := self.take(room) or self.cut(room)):
            pieces.append(piece)
            room -= len(piece[1])
        self.window(pieces)
        return not room

    def drain(self, final: bool) -> None:
        self.index = np.array(sorted(k for k, v in self.waiting.items() if v), np.int64)
        floor = 0 if final else self.buffer // 8
        for tier in reversed(self.tiers):
            # A tier's own documents are those over half its length; the shorter fill gaps.
            while self.held >= max(tier, floor) and len(self.index) and self.index[-1] > tier // 2:
                self.fill(tier)
        while self.held >= max(self.longest, floor):
            self.fill(self.longest)
        if final:
            size = self.longest
            while self.held:
                while size > self.held:
                    size //= 2
                self.fill(size)
        self.waiting = {k: v for k, v in self.waiting.items() if v}

    def window(self, pieces: list[tuple]) -> None:
        offset, size = 0, sum(len(ids) for _, ids, _ in pieces)
        tier = next(t for t in self.tiers if size <= t)
        done = self.windows.get(size, 0)
        self.windows[size] = done + 1
        step = self.base | (size << 20) | done // self.group
        for (doc_id, n), ids, start in pieces:
            crc = zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
            self.out.append((doc_id, start, len(ids), crc, n, self.base + self.n, offset, tier, step))
            offset += len(ids)
        self.n += 1

    def rows(self, schema: pa.Schema) -> pa.RecordBatch:
        out, self.out = self.out, []
        cols = list(zip(*out)) if out else [[] for _ in schema]
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


PIECES_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()),
    ("step_group", pa.int64()),
])


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tiers: tuple[int, ...] = TIERS,
    end_id: int = END_ID, group: int = 64, buffer_tokens: int = BUFFER_TOKENS,
    tokenizer: str | None = None, ranks: str | None = None,
) -> DataFrame:
    """One row per piece of a document: where it lies in which sequence.

    Each document is its ids and then `end_id`; a null or empty text is `end_id` alone. Every id
    lies in one piece. Repeated rows are packed as often as they stand there, a null id stays null,
    other columns are ignored, an empty table gives no rows. Windows hold documents of one task
    only, so nothing is shuffled and a lost task is repeated by itself; each task leaves fewer than
    two dozen windows under the longest length, all at powers of two, hence without padding.
    Memory: `buffer_tokens` ids and the longest document. Fills are by bytes of text already
    tokenised, so the order of equal lengths is last in, first out.
    """
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers are powers of two")
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        encode = Encoder(tokenizer, ranks)
        packer = Packer(context.partitionId() if context else 0, tiers, buffer_tokens, group)
        for batch in batches:
            for part in byte_slices(batch, "text"):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encode(text) if text else []
                    ids.append(end_id)
                    packer.add((doc_id, len(ids)), np.array(ids, np.uint32))
                if packer.out:
                    yield packer.rows(PIECES_ARROW)
        packer.drain(final=True)
        yield packer.rows(PIECES_ARROW)

    source = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return source.mapInArrow(run, PIECES)
