"""A compact n-gram trie: Elias-Fano sequences over memory-mapped words, quantised probabilities."""

from __future__ import annotations

import io

import numpy as np

ORDER = 6
DISCOUNT = 0.75
CODES = 256
STEP = 1 << 16  # numbers whose low bits are packed at once; a multiple of 8


class EliasFano:
    """A monotone sequence: low bits packed side by side, high bits as gaps between ones."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.width, self.low, self.high, self.ones = n, width, low, high, ones

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        width = min(24, max(0, (top // max(1, n)).bit_length() - 1))
        places = np.arange(width, dtype=np.uint64)
        # Step by step, as a bit takes a number of eight bytes on the way.
        low = [
            np.packbits(((values[a:a + STEP, None] >> places) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
            for a in range(0, n, STEP)
        ]
        low = np.concatenate([*low, np.zeros(4, np.uint8)])
        spots = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        flags = np.zeros(-(-(int(spots[-1]) + 1 if n else 1) // 64) * 64, np.uint8)
        flags[spots] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])[:-1]
        return cls(n, width, low, high, ones.astype(np.uint32))

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """The values at positions `i`."""
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self.ones, i, side="right") - 1
        left = i - self.ones[word].astype(np.int64)
        x = self.high[word].copy()
        spot = word * 64
        for half in (32, 16, 8, 4, 2, 1):
            part = x & np.uint64((1 << half) - 1)
            count = np.bitwise_count(part).astype(np.int64)
            over = left >= count
            left = np.where(over, left - count, left)
            x = np.where(over, x >> np.uint64(half), part)
            spot = spot + np.where(over, half, 0)
        value = (spot - i) << self.width
        if self.width:
            at = i * self.width
            byte, shift = at >> 3, at & 7
            raw = sum(self.low[byte + j].astype(np.int64) << (8 * j) for j in range(4))
            value |= (raw >> shift) & ((1 << self.width) - 1)
        return value


class Quantised:
    """Numbers as one byte each, the means of equal shares of them."""

    def __init__(self, codes: np.ndarray, book: np.ndarray):
        self.codes, self.book = codes, book

    @classmethod
    def of(cls, values: np.ndarray, codes: int = CODES) -> "Quantised":
        distinct = np.unique(values)
        if len(distinct) > codes:
            distinct = np.quantile(values, (np.arange(codes) + 0.5) / codes)
        middle = (distinct[1:] + distinct[:-1]) / 2
        return cls(np.searchsorted(middle, values).astype(np.uint8), distinct.astype(np.float64))

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        return self.book[self.codes[i]]


class TokenLevel:
    """One level of a trie over tokens: contexts, and behind each the words seen there.

    Contexts and words are numbers from 0. A context's words are a stretch of the level, found by a
    monotone pointer; word w behind context c is the number c x width + w, so that the level is one
    monotone sequence as well. Each has the discounted log10 share of its context in one byte, and each
    context the log10 weight of the next shorter one.
    """

    ABSENT = CODES - 1

    def __init__(self, pointers: EliasFano, words: EliasFano, logp: Quantised, backoff: Quantised, width: int):
        self.pointers, self.words, self.logp, self.backoff, self.width = pointers, words, logp, backoff, width

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray, contexts: int, width: int) -> "TokenLevel":
        """keys: sorted distinct c x width + w, with counts above 0."""
        context = keys // width
        mass = np.bincount(context, weights=counts, minlength=contexts)
        kinds = np.bincount(context, minlength=contexts)
        weight = np.where(mass > 0, DISCOUNT * kinds / np.maximum(mass, 1), 1.0)
        logp = np.log10((counts - DISCOUNT) / mass[context])
        return cls(
            EliasFano.of(np.concatenate([[0], np.cumsum(kinds)])), EliasFano.of(keys),
            Quantised.of(logp, cls.ABSENT) if len(keys) else Quantised(np.zeros(0, np.uint8), np.zeros(1)),
            Quantised.of(np.log10(weight)), width)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The probability code of each c x width + w, or ABSENT."""
        out = np.full(len(keys), self.ABSENT, np.uint8)
        if self.words.n and len(keys):
            at = np.minimum(np.searchsorted(self.stored, keys), self.words.n - 1)
            out = np.where(self.stored[at] == keys, self.logp.codes[at], out)
        return out

    @property
    def stored(self) -> np.ndarray:
        """The sequence of words written out, as many are looked up at once."""
        if not hasattr(self, "_stored"):
            self._stored = self.words[np.arange(self.words.n)]
        return self._stored


def probabilities(grams: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, float]:
    """Interpolated absolute discounting. grams[k]: sorted big-endian packed grams of k + 1 bytes.

    Returns log10 probabilities and log10 backoff weights per level, child pointers per level as
    one list of starts, and the log10 probability of an unseen byte."""
    logp, backoff = [], []
    total, seen = counts[0].sum(), len(counts[0])
    unseen = DISCOUNT * seen / total / 256
    p = np.maximum(counts[0] - DISCOUNT, 0) / total + unseen
    logp.append(p)
    starts = []
    for k in range(1, len(grams)):
        parent = np.searchsorted(grams[k - 1], grams[k] >> 8)
        suffix = np.searchsorted(grams[k - 1], grams[k] & ((1 << (8 * k)) - 1))
        n = len(grams[k - 1])
        mass = np.bincount(parent, weights=counts[k], minlength=n)
        kinds = np.bincount(parent, minlength=n)
        weight = np.where(mass > 0, DISCOUNT * kinds / np.maximum(mass, 1), 1.0)
        logp.append(np.maximum(counts[k] - DISCOUNT, 0) / mass[parent] + weight[parent] * logp[k - 1][suffix])
        backoff.append(np.log10(weight))
        starts.append(np.concatenate([[0], np.cumsum(kinds)]))
    return [np.log10(x) for x in logp], backoff, starts, float(np.log10(unseen))


class Trie:
    """Levels of grams of 1, 2, ... bytes in sorted order.

    A node's children are a stretch of the next level, found by a monotone pointer. A child does not
    store its byte but its rank among the children of its context without the first byte, which
    are a superset; ranks grow within a stretch, and each stretch starts behind the one
    before, so that a level is one monotone sequence. Looking a gram up takes the nodes of the gram
    without its last byte (where to look) and without its first (what rank to look for).
    """

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        self.order = int(arrays["order"][0])
        self.unseen = float(arrays["unseen"][0])
        self.first = arrays["first"]  # node of a single byte, or -1
        self.ranks, self.pointers, self.logp, self.backoff = [None], [], [], []
        for k in range(self.order):
            self.logp.append(Quantised(arrays[f"p{k}"], arrays[f"pb{k}"]))
            if k:
                self.ranks.append(self._sequence(f"r{k}"))
            if k < self.order - 1:
                self.pointers.append(self._sequence(f"c{k}"))
                self.backoff.append(Quantised(arrays[f"b{k}"], arrays[f"bb{k}"]))

    def _sequence(self, name: str) -> EliasFano:
        n, width = self.arrays[name + "n"]
        return EliasFano(int(n), int(width), *[self.arrays[name + x] for x in ("low", "high", "ones")])

    @classmethod
    def build(cls, grams: list[np.ndarray], counts: list[np.ndarray]) -> "Trie":
        """From sorted packed grams by length (every prefix and suffix present) and counts."""
        logp, backoff, starts, unseen = probabilities(grams, counts)
        order = len(grams)
        first = np.full(256, -1, np.int64)
        first[grams[0]] = np.arange(len(grams[0]))
        arrays = {"order": np.array([order]), "unseen": np.array([unseen]), "first": first}

        def put(name: str, values: np.ndarray) -> None:
            s = EliasFano.of(values)
            arrays.update({name + "n": np.array([s.n, s.width]), name + "low": s.low, name + "high": s.high, name + "ones": s.ones})

        for k in range(order):
            q = Quantised.of(logp[k])
            arrays[f"p{k}"], arrays[f"pb{k}"] = q.codes, q.book
            if k < order - 1:
                q = Quantised.of(backoff[k])
                arrays[f"b{k}"], arrays[f"bb{k}"] = q.codes, q.book
                put(f"c{k}", starts[k])
            if k:
                tail = grams[k] & ((1 << (8 * k)) - 1)
                node = np.searchsorted(grams[k - 1], tail)
                rank = node if k == 1 else node - starts[k - 2][np.searchsorted(grams[k - 2], tail >> 8)]
                parent = np.searchsorted(grams[k - 1], grams[k] >> 8)
                last = np.nonzero(np.concatenate([parent[1:] != parent[:-1], [True]]))[0] if len(parent) else parent
                spans = rank[last] + 1
                base = np.repeat(np.concatenate([[0], np.cumsum(spans)[:-1]]), np.diff(np.concatenate([[-1], last])))
                put(f"r{k}", base + rank)
        return cls(arrays)

    def dump(self) -> bytes:
        """All levels one after the other, each at a multiple of 8 bytes, behind a table of contents."""
        body, contents, at = io.BytesIO(), [], 0
        for name, a in self.arrays.items():
            a = np.ascontiguousarray(a)
            raw = a.tobytes()
            contents.append(f"{name} {a.dtype.str} {len(a)} {at}")
            body.write(raw + b"\0" * (-len(raw) % 8))
            at = body.tell()
        head = "\n".join(contents).encode()
        head += b"\n" * (-len(head) % 8)
        return len(head).to_bytes(8, "little") + head + body.getvalue()

    @classmethod
    def open(cls, path: str) -> "Trie":
        """Memory-map a dumped trie; pages are read as they are needed."""
        raw = np.memmap(path, np.uint8, "r")
        size = int.from_bytes(raw[:8].tobytes(), "little")
        arrays = {}
        for line in raw[8:8 + size].tobytes().decode().split("\n"):
            if line:
                name, kind, n, at = line.split(" ")
                at = 8 + size + int(at)
                arrays[name] = raw[at:at + int(n) * np.dtype(kind).itemsize].view(kind)
        return cls(arrays)

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.pointers[level][nodes], self.pointers[level][nodes + 1]

    def find(self, level: int, prefix: np.ndarray, suffix: np.ndarray, middle: np.ndarray | None) -> np.ndarray:
        """Nodes of grams at `level` (1: two bytes) or -1, from the nodes of the gram without its
        last byte, without its first, and without both."""
        out = np.full(len(prefix), -1, np.int64)
        on = np.nonzero((prefix >= 0) & (suffix >= 0))[0]
        if not len(on):
            return out
        rank = suffix[on] if level == 1 else suffix[on] - self.pointers[level - 2][middle[on]]
        lo, hi = self.children(level - 1, prefix[on])
        ranks = self.ranks[level]
        base = np.where(lo > 0, ranks[np.maximum(lo - 1, 0)] + 1, 0)
        want, end = base + rank, hi.copy()
        while (open_ := np.nonzero(lo < hi)[0]).size:  # the first child of at least the rank
            mid = (lo[open_] + hi[open_]) // 2
            less = ranks[mid] < want[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        ok = np.nonzero(lo < end)[0]
        ok = ok[ranks[lo[ok]] == want[ok]]
        out[on[ok]] = lo[ok]
        return out

    def score(self, words: list[bytes], classes: list[int] | None = None) -> np.ndarray:
        """log10 probability of each word and its end, from the bytes before within the word and
        the class in front of it."""
        if not words:
            return np.zeros(0)
        data, place = spelled(words, classes)
        total = np.zeros(len(data))
        below: tuple | None = None
        under: tuple | None = None
        for k in range(self.order):
            at = np.nonzero(place >= k)[0]
            if not len(at):
                break
            key, back = np.unique(packed(data, at, k + 1), return_inverse=True)
            if k == 0:
                node = self.first[key]
                logp = np.where(node >= 0, self.logp[0][np.maximum(node, 0)], self.unseen)
            else:
                pre = np.searchsorted(below[0], key >> 8)
                suf = np.searchsorted(below[0], key & ((1 << (8 * k)) - 1))
                mid = None if k == 1 else under[1][np.searchsorted(under[0], (key & ((1 << (8 * k)) - 1)) >> 8)]
                node = self.find(k, below[1][pre], below[1][suf], mid)
                parent = below[1][pre]
                weight = np.where(parent >= 0, self.backoff[k - 1][np.maximum(parent, 0)], 0.0)
                logp = np.where(node >= 0, self.logp[k][np.maximum(node, 0)], weight + below[2][suf])
            total[at] = logp[back]
            under, below = below, (key, node, logp)
        total[place == 0] = 0.0  # what stands before a word is given
        ends = np.cumsum([len(w) + 2 for w in words])
        return np.add.reduceat(total, np.concatenate([[0], ends[:-1]]))


def spelled(words: list[bytes], classes: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the words, each behind its class as a byte and before a space, and each byte's
    place in its word."""
    data = np.frombuffer(b" " + b"  ".join(words) + b" ", np.uint8).copy()
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    heads = np.cumsum(sizes) - sizes
    data[heads] = np.array(classes, np.uint8) + 1 if classes is not None else 1
    return data, np.arange(len(data)) - np.repeat(heads, sizes)


def packed(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The `size` bytes up to each position as one number."""
    out = np.zeros(len(at), np.int64)
    for j in range(size - 1, -1, -1):
        out = out << 8 | data[at - j].astype(np.int64)
    return out


def gram_counts(words: list[bytes], classes: list[int] | None = None, order: int = ORDER) -> list[tuple[np.ndarray, np.ndarray]]:
    """Packed grams of each length and how often they stand in the words (each word once). The
    class in front counts only as the beginning of longer grams, and once as a gram of its own."""
    data, place = spelled(words, classes)
    out = []
    for k in range(order):
        at = np.nonzero(place >= max(k, 1))[0]
        if not k:
            at = np.concatenate([at, np.nonzero(place == 0)[0][np.unique(data[place == 0], return_index=True)[1]]])
        out.append(np.unique(packed(data, at, k + 1), return_counts=True))
    return out
