"""Removal of long repeated byte strings by suffix arrays over buckets of equal local minima."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from bankspark.llm.common import KEY, as_key, byte_slices, columns_of, drop_stage, keyed, prepare, row_key, texts_of, write_stage

GRAM = 24  # bytes of the hashed grams; a window of `min_bytes` holds min_bytes - GRAM + 1 of them
BUCKET_BYTES = 8 << 20  # most bytes of one hash's stretches that are sorted in one group
USUAL_BYTES = 1 << 20  # stretches whose suffixes a group sorts at a time, about
SCAN_BYTES = 1 << 18  # texts hashed at a time: the arrays stay in the processor's cache
HELD_BYTES = 24 << 20  # distinct stretches a task gathers before it passes them on
PASSED_BYTES = 1 << 20  # stretches in a batch of those

_rng = np.random.default_rng(20240229)
BYTE_HASH = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP_HASH = _rng.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` bytes at each position, by doubling; as long as `data` allows."""
    done, out = 1, BYTE_HASH[data]
    parts: list[tuple[int, np.ndarray]] = []
    want, k = size, 0
    while True:
        if want & done:
            parts.append((done, out))
        if done * 2 > size:
            break
        out = out[:-done] * STEP_HASH[k] + out[done:]
        done, k = done * 2, k + 1
    n, at = len(data) - size + 1, 0
    total = np.zeros(n, np.uint64)
    for width, h in reversed(parts):
        total = total * STEP_HASH[k + 1] + h[at:at + n]
        at += width
    total ^= total >> np.uint64(31)
    total *= np.uint64(0x9E3779B97F4A7C15)
    total ^= total >> np.uint64(29)
    return total


def sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The least or largest value of each window of `width`, by doubling."""
    done, out = 1, values
    while done * 2 <= width:
        out = best(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return best(out[:-rest], out[rest:]) if rest else out


def stretches(data: np.ndarray, offsets: np.ndarray, min_bytes: int):
    """Maximal runs of windows of `min_bytes` whose least gram hash is the same, document by document.

    Returns arrays (document, least hash, first window start in the document, windows, twice).
    Equal windows have equal least hashes, so they lie in runs of one hash. `twice`: the gram
    stands in the run more than once, without which no window can repeat inside its own run.
    """
    gram = min(GRAM, max(1, min_bytes // 4))
    width = min_bytes - gram + 1
    empty = np.zeros(0, np.int64)
    if len(data) < min_bytes:
        return empty, empty, empty, empty, empty.astype(bool)
    h = gram_hashes(data, gram)
    least = sliding(h, width, np.minimum)
    n = len(least)
    doc_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    inside = np.arange(n) + min_bytes <= offsets[1:][doc_of]
    new = np.ones(n, bool)
    new[1:] = (least[1:] != least[:-1]) | (doc_of[1:] != doc_of[:-1])
    first = np.nonzero(new & inside)[0]
    # A run ends where another begins or its document's windows end.
    stops = np.nonzero(np.concatenate([new | ~inside, [True]]))[0]
    last = stops[np.searchsorted(stops, first, side="right")]
    # Gram positions that are the least of a window of theirs, among those of any one run.
    padded = np.concatenate([np.zeros(width - 1, np.uint64), np.where(inside, least, 0), np.zeros(width - 1, np.uint64)])
    spots = np.nonzero(sliding(padded, width, np.maximum)[:len(h)] == h)[0]
    a = np.searchsorted(spots, first)
    b = np.searchsorted(spots, last - 1 + width, side="left")
    count = np.zeros(len(first), np.int64)
    for k in range(int((b - a).max()) if len(first) else 0):
        on = a + k < b
        if not on.any() or k > 64:
            count[on] = 2
            break
        count[on] += h[spots[a[on] + k]] == least[first[on]]
    doc = doc_of[first]
    return doc, least[first].view(np.int64), first - offsets[doc], last - first, count > 1


def suffix_runs(data: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the windows at `starts`, and for each the number of its run of equal
    windows (longest common prefix with its neighbour at least `size`).

    Windows are sorted by eight bytes at a time; each further word is looked at only where the
    words before it tie, and sorted only where it differs.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    # Numbers of windows and positions are under 2^31: half the memory of the usual index.
    kind = np.int32 if len(data) < 2**31 else np.int64

    # The eight bytes from each place on as a number, read where they stand.
    words = np.ndarray((len(data),), ">u8", padded, strides=(1,))

    def word(at: np.ndarray) -> np.ndarray:
        found = words[at]
        return found.byteswap(inplace=True).view(np.uint64) if np.little_endian else found.astype(np.uint64)

    key = word(starts)
    order = np.argsort(key, kind="stable").astype(kind)
    key = key[order]
    suffixes = starts.astype(kind, copy=False)[order]
    del order
    new = np.ones(len(suffixes), bool)
    new[1:] = key[1:] != key[:-1]
    del key
    offsets = sorted({*range(8, size - 7, 8), size - 8}) if size > 8 else []
    for offset in offsets:
        # Windows that tie so far: those that do not begin a run, or whose next one does not.
        tied = np.nonzero(~new | ~np.append(new[1:], True))[0].astype(kind)
        if not len(tied):
            break
        group = np.cumsum(new[tied], dtype=kind) - 1
        key = word(suffixes[tied] + kind(offset))
        differs = np.zeros(len(tied), bool)
        differs[1:] = (key[1:] != key[:-1]) & (group[1:] == group[:-1])
        if not differs.any():
            continue
        mixed = np.zeros(int(group[-1]) + 1, bool)
        mixed[group[differs]] = True
        on = mixed[group]
        at, group, key = tied[on], group[on], key[on]
        del tied, on
        order = np.lexsort((key, group))
        suffixes[at] = suffixes[at][order]
        key = key[order]
        del order
        fresh = np.zeros(len(at), bool)
        fresh[1:] = (key[1:] != key[:-1]) & (group[1:] == group[:-1])
        new[at] |= fresh
    return suffixes, np.cumsum(new, dtype=kind) - 1


def earlier_match(position: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Whether the longest previous factor of each window, in suffix order, spans its run's length.

    The longest earlier match of a suffix is with the nearest smaller position before or after it
    in suffix order. Its length reaches the run's common prefix if that neighbour lies in the run,
    that is if the running minimum of the run's positions, from either side, is smaller.
    """
    if not len(position):
        return np.zeros(0, bool)
    heads = np.nonzero(np.concatenate([[True], run[1:] != run[:-1]]))[0]
    least = np.minimum.reduceat(position, heads)[run - run[0]]
    return position > least


def as_ranges(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal byte ranges covered by windows of `size` at the sorted starts."""
    if not len(starts):
        return starts, starts
    cut = np.nonzero(starts[1:] > starts[:-1] + size)[0]
    return starts[np.concatenate([[0], cut + 1])], starts[np.concatenate([cut, [len(starts) - 1]])] + size


STRETCH = "kind int, k_id long, k_row long, at long, windows long, anchor long, twice boolean, digest binary, stretch binary"
STRETCH_NAMES = [c.split()[0] for c in STRETCH.split(", ")]
OCCURS, HOLDS = 0, 1


def _stretch_rows(min_bytes: int):
    """Stretches of documents (with the least hashes that repeat, `hits`): where each occurs,
    and once per task, or per HELD_BYTES of it, its bytes and first place."""

    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        """What is held, let go of as it is passed on: a batch has PASSED_BYTES or one stretch."""
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
        while held:
            rows, size = [], 0
            while held and size < PASSED_BYTES:
                digest, (place, *about, raw) = held.popitem()
                rows.append((HOLDS, *place, *about, digest, raw))
                size += len(raw)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=STRETCH_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple] = {}
        size = 0
        for batch in batches:
            for part in byte_slices(batch, "text", SCAN_BYTES):
                data, offsets = texts_of(part, "text")
                ids = part.column(0).to_numpy(zero_copy_only=False)
                rows = part.column(1).to_numpy(zero_copy_only=False)
                hits = part.column(3)
                doc, anchor, start, windows, twice = stretches(data, offsets, min_bytes)
                lengths = np.diff(np.frombuffer(hits.buffers()[1], np.int32)[hits.offset:hits.offset + len(hits) + 1])
                known = hits.flatten().to_numpy(zero_copy_only=False)
                # (document, hash) pairs as one sorted key each.
                pair = np.zeros(len(known), [("d", np.int64), ("a", np.int64)])
                pair["d"], pair["a"] = np.repeat(np.arange(len(hits)), lengths), known
                mine = np.zeros(len(doc), pair.dtype)
                mine["d"], mine["a"] = doc, anchor
                on = np.nonzero(np.isin(mine.view("V16").ravel(), pair.view("V16").ravel()))[0] if len(pair) else []
                raw = data.tobytes()
                out = []
                for i in on:
                    d, s, w = int(doc[i]), int(start[i]), int(windows[i])
                    lo = int(offsets[d]) + s
                    text = raw[lo:lo + w - 1 + min_bytes]
                    digest = hashlib.md5(text).digest()
                    place = (int(ids[d]), int(rows[d]), s)
                    out.append((*place, w, digest))
                    seen = held.get(digest)
                    if seen is None:
                        held[digest] = (place, w, int(anchor[i]), bool(twice[i]), text)
                        size += len(text)
                    elif place < seen[0]:
                        held[digest] = (place, *seen[1:])
                if out:
                    c = list(zip(*out))
                    n = len(out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([OCCURS] * n, pa.int32()), *[pa.array(x, pa.int64()) for x in c[:4]],
                         pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), pa.array(c[4], pa.binary()), pa.nulls(n, pa.binary())],
                        names=STRETCH_NAMES)
                if size > HELD_BYTES:
                    yield from flush(held)
                    size = 0
        yield from flush(held)

    return run


def _anchor_rows(min_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SCAN_BYTES):
                data, offsets = texts_of(part, "text")
                doc, anchor, _, _, twice = stretches(data, offsets, min_bytes)
                rows = part.column(0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(rows[doc] if len(doc) else np.zeros(0, np.int64)),
                     pa.array(1 + twice.astype(np.int32))], names=["anchor", "k_row", "n"])

    return run


RANGES = "digest binary, matched array<int>, earlier array<int>"


def _flat(a: np.ndarray, b: np.ndarray) -> list[int]:
    return np.column_stack([a, b]).ravel().tolist()


def _sort_bucket(min_bytes: int):
    """One bucket: ranges of each distinct stretch (as flat starts and ends) that match anywhere
    else among distinct stretches, and that match earlier ones."""

    def run(table: pa.Table) -> pa.Table:
        # The same stretch can come from several tasks: the first place counts.
        first: dict[bytes, tuple] = {}
        cols = [table.column(c).to_pylist() for c in ("digest", "k_id", "k_row", "at", "stretch")]
        for digest, *place, raw in zip(*cols):
            if digest not in first or tuple(place) < first[digest][0]:
                first[digest] = (tuple(place), raw)
        del cols, table
        digests = sorted(first, key=lambda d: first[d][0])  # in order of their places
        sizes = np.array([len(first[d][1]) for d in digests], np.int64)
        data = np.frombuffer(b"".join(first[d][1] for d in digests), np.uint8)
        first.clear()
        offset = np.concatenate([[0], np.cumsum(sizes)])
        windows = sizes - min_bytes + 1
        # Positions take four bytes where the buffer allows, as there is one a byte of it.
        kind = np.int32 if len(data) < 2**31 else np.int64
        starts = np.arange(int(windows.sum()), dtype=kind)
        starts += np.repeat((offset[:-1] - np.concatenate([[0], np.cumsum(windows)[:-1]])).astype(kind), windows)
        suffixes, runs = suffix_runs(data, starts, min_bytes)
        del starts
        several = np.bincount(runs)[runs] > 1
        # Places ascend with positions in the buffer, so those stand for them.
        earlier = earlier_match(suffixes, runs)
        del runs
        flagged = np.sort(suffixes[several])
        later = np.sort(suffixes[earlier])
        del suffixes, several, earlier
        out = []
        lo, hi = np.searchsorted(flagged, offset[:-1]), np.searchsorted(flagged, offset[1:])
        lo2, hi2 = np.searchsorted(later, offset[:-1]), np.searchsorted(later, offset[1:])
        for i in np.nonzero(hi > lo)[0]:
            out.append((
                digests[i],
                _flat(*as_ranges(flagged[lo[i]:hi[i]] - offset[i], min_bytes)),
                _flat(*as_ranges(later[lo2[i]:hi2[i]] - offset[i], min_bytes)),
            ))
        c = list(zip(*out)) if out else [[], [], []]
        return pa.table(
            {"digest": pa.array(c[0], pa.binary()), "matched": pa.array(c[1], pa.list_(pa.int32())),
             "earlier": pa.array(c[2], pa.list_(pa.int32()))})

    return run


def _split_windows(min_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "stretch", 1 << 16):
                out = []
                for digest, k_id, k_row, at, raw in zip(*[c.to_pylist() for c in part.columns]):
                    for i in range(len(raw) - min_bytes + 1):
                        out.append((hashlib.md5(raw[i:i + min_bytes]).digest(), digest, i, k_id, k_row, at + i))
                c = list(zip(*out)) if out else [[] for _ in range(6)]
                kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(c, kinds)], names=["window", "digest", "i", "k_id", "k_row", "at"])

    return run


def _hot_ranges(held: DataFrame, min_bytes: int) -> DataFrame:
    """The same ranges for stretches of a least hash that too many distinct ones share: their
    windows become rows, counted by groups with map-side combining."""
    rows = held.select("digest", "k_id", "k_row", "at", "stretch").mapInArrow(
        _split_windows(min_bytes), "window binary, digest binary, i int, k_id long, k_row long, at long")
    place = F.struct("k_id", "k_row", "at")
    # A stretch that several tasks passed on counts once, by its first place.
    rows = rows.groupBy("window", "digest", "i").agg(F.min(place).alias("place"))
    counts = rows.groupBy("window").agg(F.count("*").alias("n"), F.min("place").alias("least")).filter("n > 1")

    def ranges(starts):
        ends = F.aggregate(
            F.sort_array(starts), F.array().cast("array<int>"),
            lambda acc, s: F.when(
                (F.size(acc) > 0) & (F.element_at(acc, -1) >= s),
                F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(s + min_bytes)),
            ).otherwise(F.concat(acc, F.array(s, s + min_bytes))),
        )
        return ends

    return (
        rows.join(counts, "window").groupBy("digest").agg(
            F.collect_list("i").alias("all"),
            F.collect_list(F.when(F.col("place") != F.col("least"), F.col("i"))).alias("late"))
        .select("digest", ranges(F.col("all")).alias("matched"), ranges(F.col("late")).alias("earlier"))
    )


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 200,
                   keep: str = "first") -> DataFrame:
    """(k_id, k_row, spans): sorted disjoint byte ranges to remove, as flat starts and ends, of the
    documents that have any. `keep`: `first` spares the first copy of each string in the order of
    ids, `none` spares no copy."""
    if keep not in ("first", "none"):
        raise ValueError(f"keep is first or none, not {keep}")
    if min_bytes < 16:
        raise ValueError("min_bytes is 16 at least")
    spark = docs.sparkSession
    prepare(spark)
    source = docs.select(*row_key(id_col, text_col), F.col(text_col).alias("text"))
    anchors = write_stage(
        source.select("k_row", "text").filter(F.octet_length("text") >= min_bytes)
        .mapInArrow(_anchor_rows(min_bytes), "anchor long, k_row long, n int"), "anchors")
    repeated = anchors.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor")
    hits = anchors.select("anchor", "k_row").join(repeated, "anchor", "left_semi")
    hits = hits.groupBy("k_row").agg(F.collect_set("anchor").alias("hits"))
    found = write_stage(
        source.join(hits, "k_row").select("k_id", "k_row", "text", "hits")
        .mapInArrow(_stretch_rows(min_bytes), STRETCH), "stretches", "kind")
    drop_stage(anchors)
    held = found.filter(F.col("kind") == HOLDS).drop("kind")
    occurs = found.filter(F.col("kind") == OCCURS).select("k_id", "k_row", "at", "windows", "digest")

    loads = held.groupBy("anchor").agg(
        F.sum(F.col("windows") + min_bytes).alias("bytes"), F.max("twice").alias("twice"),
        F.min("digest").alias("a"), F.max("digest").alias("b"))
    # A single stretch whose gram stands there once can only be its own copy: nothing to sort.
    loads = write_stage(loads.filter("a != b or twice").select("anchor", "bytes"), "loads")
    total, hottest = loads.agg(F.sum("bytes"), F.max("bytes")).first()
    buckets = max(1, int((total or 0) // min(USUAL_BYTES, BUCKET_BYTES)))
    cool = loads.filter(F.col("bytes") <= BUCKET_BYTES).select("anchor")
    ranges = (
        held.join(cool, "anchor", "left_semi")
        .withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
        .groupBy("bucket").applyInArrow(_sort_bucket(min_bytes), RANGES)
    )
    if hottest and hottest > BUCKET_BYTES:
        hot = loads.filter(F.col("bytes") > BUCKET_BYTES).select("anchor")
        ranges = ranges.unionByName(_hot_ranges(held.join(hot, "anchor", "left_semi"), min_bytes))

    place = F.struct("k_id", "k_row", "at")
    known = occurs.groupBy("digest").agg(F.count("*").alias("n"), F.min(place).alias("least"))
    known = known.join(ranges, "digest", "left").filter("n > 1 or matched is not null")
    whole = F.array(F.lit(0), (F.col("windows") + min_bytes - 1).cast("int"))
    nothing = F.array().cast("array<int>")
    if keep == "none":
        cover = F.when(F.col("n") > 1, whole).otherwise(F.col("matched"))
    else:
        cover = F.when(place == F.col("least"), F.coalesce("earlier", nothing)).otherwise(whole)
    return (
        occurs.join(known, "digest").withColumn("cover", cover).filter(F.size("cover") > 0)
        .groupBy("k_id", "k_row")
        .agg(F.collect_list(F.transform("cover", lambda x: x.cast("long") + F.col("at"))).alias("spans"))
        .select("k_id", "k_row", F.flatten("spans").alias("spans"))
    )


def merge_spans(flat: list[int] | None) -> list[tuple[int, int]]:
    """Sorted disjoint ranges; ranges that touch become one."""
    out: list[tuple[int, int]] = []
    if not flat:
        return out
    for a, b in sorted(zip(flat[::2], flat[1::2])):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 200,
                   keep: str = "first", out: str = "llm_kept", as_text: bool = False) -> DataFrame:
    """`docs` with a struct column `out`: n_bytes, n_removed, n_spans, kept (the bytes that stay;
    `as_text`: as a string, without the halves of characters that a cut left).

    A byte goes if a string of `min_bytes` around it, inside one document, stands earlier in the
    corpus, the same document included (`keep="first"`: documents in order of id, null first), or
    anywhere else (`keep="none"`). Judged on the input, as UTF-8 bytes; a cut can fall inside a
    character. Null and empty texts have no bytes; texts under `min_bytes` lose nothing. Rows that
    repeat id and text are each other's copies under `none` and share their fate under `first`.

    Windows are dealt to buckets by their least gram hash, so equal windows meet; each bucket's
    windows are put in suffix order, and the nearest smaller positions tell the earlier matches.
    Only documents and stretches with a repeated hash go further than the first pass. Equal
    stretches are sorted once, whatever the number of copies; a hash with too many distinct
    stretches for one task is counted window by window instead.
    """
    spans = as_key(repeated_spans(docs, id_col, text_col, min_bytes, keep), F.col("spans").alias("llm_spans"))
    names = docs.columns
    joined = keyed(docs, id_col, text_col).join(spans, KEY, "left").select(*columns_of(docs), "llm_spans")
    kind = T.StructType.fromDDL(f"n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}")
    held = pa.string() if as_text else pa.binary()
    schema = T.StructType([*docs.schema.fields, T.StructField(out, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, text_col):
                data, offsets = texts_of(part, text_col)
                raw = data.tobytes()
                rows = []
                for i, flat in enumerate(part.column(len(names)).to_pylist()):
                    text = raw[offsets[i]:offsets[i + 1]]
                    cuts = merge_spans(flat)
                    at, keep_parts = 0, []
                    for a, b in cuts:
                        keep_parts.append(text[at:a])
                        at = b
                    keep_parts.append(text[at:])
                    kept = b"".join(keep_parts)
                    shown = kept.decode("utf-8", "ignore") if as_text else kept
                    rows.append({"n_bytes": len(text), "n_removed": len(text) - len(kept), "n_spans": len(cuts), "kept": shown})
                arrow = pa.array(rows, pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", held)]))
                yield pa.RecordBatch.from_arrays([*part.columns[:len(names)], arrow], names=[*names, out])

    return joined.mapInArrow(run, schema)
