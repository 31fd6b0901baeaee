"""Near-duplicate documents by a chosen-path set similarity join over minwise tokens."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bankspark.llm.common import KEY, as_key, byte_slices, columns_of, drop_stage, few, keyed, prepare, row_key, texts_of, write_stage

WORDS = 5
SIMILARITY = 75  # per cent
PERMS = 64  # minwise tokens of a document
TREES = 12
FIRST_TREES = 2
FAN = 2  # branches that every document follows at a further level
NODE_LIMIT = 2000  # documents that are compared exhaustively at once
MAX_DEPTH = 10
# A pair goes to the exact comparison if so many of its PERMS tokens agree: 4.6 standard
# deviations under the expectation at the similarity asked for.
LEAST_AGREEING = 32
BUCKET_ROWS = 20_000
LOCAL_EDGES = 500_000  # edges that one task contracts
BROADCAST_ROWS = 1_000_000  # keys or labels (a few longs a row) that are broadcast at most

_rng = np.random.default_rng(19970611)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
POWER = np.uint64(0x5851F42D4C957F2D)
INVERSE = np.uint64(pow(int(POWER), -1, 2**64))
PLACE = _rng.integers(1, 2**63, WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MULTIPLY = _rng.integers(1, 2**63, PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 2**63, PERMS, dtype=np.uint64)
# A-Z become a-z, and the white space that ends a word.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, document by document, and the first word of each document (n + 1)."""
    n = len(data)
    gap = SPACE[data]
    begins = ~gap
    begins[1:] &= gap[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    begins[heads] |= ~gap[heads]
    start = np.nonzero(begins)[0]
    # A word ends at the next gap or where the next document begins.
    stops = np.unique(np.concatenate([np.nonzero(gap)[0], offsets[1:]]))
    end = stops[np.searchsorted(stops, start, side="right")] if len(start) else start
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_CODE[LOWER[data]] * powers(POWER, n), out=running[1:])
    codes = mix((running[end] - running[start]) * powers(INVERSE, n)[start] + (end - start).astype(np.uint64))
    return codes, np.searchsorted(start, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document; fewer words make one shingle."""
    codes, first = word_hashes(data, offsets)
    grams = np.zeros(max(0, len(codes) - words + 1), np.uint64)
    for k in range(words):
        grams += codes[k:k + len(grams)] * PLACE[k % len(PLACE)]
    grams = mix(grams)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(grams[a:b - words + 1]))
        elif b > a:
            whole = np.append(codes[a:b] * PLACE[:b - a], np.array([b - a], np.uint64) * PLACE[-1:])
            out.append(mix(whole.sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(grams[:0])
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """PERMS minwise tokens (32 bits) of each non-empty set."""
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])[:-1]
    out = np.empty((len(sets), PERMS), np.uint32)
    for p in range(PERMS):
        out[:, p] = np.minimum.reduceat(flat * MULTIPLY[p] + ADD[p], at) >> np.uint64(32)
    return out


def branch_tokens(sets: list[np.ndarray], depth: int) -> np.ndarray:
    """FAN minwise tokens for each tree, by hash functions that only this level of this tree uses."""
    rng = np.random.default_rng([19970611, depth])
    multiply = rng.integers(1, 2**63, TREES * FAN, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2**63, TREES * FAN, dtype=np.uint64)
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])[:-1]
    out = np.empty((len(sets), TREES * FAN), np.uint32)
    for p in range(TREES * FAN):
        out[:, p] = np.minimum.reduceat(flat * multiply[p] + add[p], at) >> np.uint64(32)
    return out


def missed(similarity: float, depth: int, trees: int = TREES) -> float:
    """Expected share of the pairs of a similarity that share no node at a depth (1: first tokens)."""
    apart = 0.0
    for _ in range(depth - 1):
        apart = (1 - similarity + similarity * apart) ** FAN
    return (1 - similarity + similarity * apart) ** trees


def vertex(values: np.ndarray) -> int:
    """A number that stands for a set; equal sets share it."""
    return int.from_bytes(hashlib.md5(values.tobytes()).digest()[:8], "little", signed=True)


SIGNED = "k_id long, k_row long, n_shingles long, v long, tokens array<int>"


def _sign(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", 1 << 20):
                sets = shingle_sets(*texts_of(part, "text"), words)
                full = [s for s in sets if len(s)]
                tokens = signatures(full) if full else np.zeros((0, PERMS), np.uint32)
                sizes = np.array([PERMS if len(s) else 0 for s in sets], np.int32)
                tokens = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(tokens.ravel().view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([vertex(s) if len(s) else None for s in sets], pa.int64()), tokens],
                    names=["k_id", "k_row", "n_shingles", "v", "tokens"])

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text"):
                sets = shingle_sets(*texts_of(part, "text"), words)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["v", "grams"])

    return run


def _branch(words: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", 1 << 20):
                sets = shingle_sets(*texts_of(part, "text"), words)
                if not sets:
                    continue
                tokens = branch_tokens(sets, depth)
                at = np.arange(len(sets) + 1, dtype=np.int32) * (TREES * FAN)
                tokens = pa.ListArray.from_arrays(pa.array(at), pa.array(tokens.ravel().view(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), tokens], names=["v", "further"])

    return run


def agreeing(sketch: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Number of equal tokens for each pair of rows."""
    if len(sketch) * len(other) <= 4096:
        return (sketch[:, None, :] == other[None, :, :]).sum(axis=2)
    out = np.zeros((len(sketch), len(other)), np.int16)
    for k in range(sketch.shape[1]):
        out += sketch[:, k, None] == other[None, :, k]
    return out


def likely(sketch: np.ndarray, n: np.ndarray, similarity: int) -> np.ndarray:
    """Agreeing tokens of each pair that can be similar, else 0."""
    agree = agreeing(sketch, sketch)
    fits = 100 * np.minimum(n[:, None], n) >= similarity * np.maximum(n[:, None], n)
    agree = np.where((agree >= LEAST_AGREEING) & fits, agree, 0)
    np.fill_diagonal(agree, 0)
    return agree


def spanning_edges(weight: np.ndarray) -> list[tuple[int, int]]:
    """A maximum spanning forest over the pairs of positive weight."""
    m = len(weight)
    best, parent, out = np.zeros(m, weight.dtype), np.full(m, -1), np.zeros(m, bool)
    edges = []
    for _ in range(m):
        u = int(np.where(out, -1, best).argmax())
        if parent[u] >= 0:
            edges.append((int(parent[u]), u))
        out[u] = True
        better = (weight[u] > best) & ~out
        best[better] = weight[u][better]
        parent[better] = u
    return edges


def by_node(table: pa.Table) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """The nodes of a bucket with their columns."""
    node = table.column("node").to_numpy()
    order = np.argsort(node, kind="stable")
    cols = {c: table.column(c).to_numpy()[order] for c in ("v", "n", "label")}
    cols["sketch"] = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(node), PERMS)[order]
    cuts = (np.nonzero(np.diff(node[order]))[0] + 1).tolist()
    for a, b in zip([0, *cuts], [*cuts, len(node)]):
        if b - a > 1:
            yield int(node[order[a]]), {c: x[a:b] for c, x in cols.items()}


def open_pairs(rows: dict[str, np.ndarray], similarity: int) -> np.ndarray:
    """Agreeing tokens of the likely pairs whose documents are in different components."""
    weight = likely(rows["sketch"], rows["n"], similarity)
    weight[rows["label"][:, None] == rows["label"][None, :]] = 0
    return weight


def _spanning(similarity: int):
    """A spanning forest of each node's likely pairs."""

    def run(table: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        for _, rows in by_node(table):
            weight = open_pairs(rows, similarity)
            for i, j in spanning_edges(weight):
                p, q = int(rows["v"][i]), int(rows["v"][j])
                out.append((min(p, q), max(p, q), int(weight[i, j])))
        c = list(zip(*out)) if out else [[], [], []]
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip("xyw", c)})

    return run


def _unsettled(similarity: int):
    """The documents of each node that have a likely partner in another component."""

    def run(table: pa.Table) -> pa.Table:
        nodes, vs = [], []
        for node, rows in by_node(table):
            v = rows["v"][open_pairs(rows, similarity).any(axis=1)]
            nodes.append(np.full(len(v), node))
            vs.append(v)
        flat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return pa.table({"node": pa.array(flat(nodes), pa.int64()), "v": pa.array(flat(vs), pa.int64())})

    return run


class Forest:
    """Union-find over any keys."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, v: int) -> int:
        up = self.up
        r = v
        while (p := up.get(r, r)) != r:
            r = p
        while v != r:
            up[v], v = r, up.get(v, v)
        return r

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        up = self.up
        up[max(a, b)] = up.setdefault(min(a, b), min(a, b))
        return True


def common_grams(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of slices of the incidence matrix."""
    m = len(sets)
    doc = np.repeat(np.arange(m), [len(s) for s in sets])
    _, gram, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    on = count[gram] > 1
    doc, gram = doc[on], np.unique(gram[on], return_inverse=True)[1]
    out = np.zeros((m, m), np.float64)
    step = 4096
    order = np.argsort(gram, kind="stable")
    doc, gram = doc[order], gram[order]
    for a in range(0, int(gram[-1]) + 1 if len(gram) else 0, step):
        lo, hi = np.searchsorted(gram, [a, a + step])
        part = np.zeros((m, step), np.float32)
        part[doc[lo:hi], gram[lo:hi] - a] = 1
        out += part @ part.T
    return out


def _compare(similarity: int):
    """One node, exhaustively on full sets: links that join components not joined before."""

    def run(table: pa.Table) -> pa.Table:
        grams = table.column("grams").combine_chunks()
        flat, at = grams.flatten().to_numpy(), np.concatenate([[0], np.cumsum(grams.value_lengths().to_numpy())])
        sets = [flat[a:b] for a, b in zip(at[:-1], at[1:])]
        sizes = np.diff(at)
        v, label = table.column("v").to_pylist(), table.column("label").to_pylist()
        common = common_grams(sets)
        near = 100 * common >= similarity * (sizes[:, None] + sizes[None, :] - common)
        forest, links = Forest(), []
        for i, j in zip(*np.nonzero(np.triu(near, 1))):
            if forest.join(label[i], label[j]):
                links.append((min(v[i], v[j]), max(v[i], v[j])))
        c = list(zip(*links)) if links else [[], []]
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip("xy", c)})

    return run


def _edges_of(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    held = [[c.to_numpy() for c in b.columns] for b in batches if b.num_rows]
    return [np.concatenate(c) for c in zip(*held)]


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's weighted edges (x, y, w) a maximum spanning forest."""
    if edges := _edges_of(batches):
        x, y, w = edges
        forest = Forest()
        order = np.lexsort((y, x, -w)).tolist()
        x, y = x.tolist(), y.tolist()
        on = [i for i in order if forest.join(x[i], y[i])]
        yield pa.RecordBatch.from_arrays([pa.array([c[i] for i in on], pa.int64()) for c in (x, y)], names=["x", "y"])


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's edges: each vertex, its component's least vertex included, with that vertex."""
    if edges := _edges_of(batches):
        forest = Forest()
        for a, b in zip(edges[0].tolist(), edges[1].tolist()):
            forest.join(a, b)
        v = list(forest.up)
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()), pa.array([forest.root(a) for a in v], pa.int64())], names=["v", "label"])


def spanning_forest(edges: DataFrame, most: int) -> DataFrame:
    """A subset (x, y) of at most `most` weighted edges that connects what they connect: each task
    of about LOCAL_EDGES drops those that close a circle."""
    return edges.repartition(-(-most // LOCAL_EDGES) or 1).mapInArrow(_local_forest, "x long, y long")


def components(edges: DataFrame) -> DataFrame:
    """(v, label): the least vertex reachable from each vertex of the written edges (x, y).

    Tasks of at most LOCAL_EDGES edges contract theirs to stars. If one task held all edges,
    that is the result. Else large-star and small-star steps alternate, each written, until nothing
    changes; a vertex with many neighbours is one key of two-sided joins, which adaptive execution splits.
    """
    parts = -(-edges.count() // LOCAL_EDGES) or 1
    stars = write_stage(edges.repartition(parts).mapInArrow(_local_stars, "v long, label long"), "stars")
    if parts == 1:
        return stars
    now = write_stage(stars.filter("v != label").select(F.col("v").alias("u"), F.col("label").alias("w")).distinct(), "edges")
    state = None
    while True:
        both = now.union(now.select("w", "u"))
        least = both.groupBy("u").agg(F.least(F.min("w"), F.col("u")).alias("m"))
        large = both.filter("w > u").join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("w"))
        large = write_stage(large.filter("u != w").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("w").alias("m"))
        small = large.join(least, "u").filter("w != m").select(F.col("w").alias("u"), F.col("m").alias("w"))
        small = write_stage(small.unionByName(least.select("u", F.col("m").alias("w"))).filter("u != w").distinct(), "small-star")
        drop_stage(now)
        drop_stage(large)
        now = small
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "w")), F.sum(F.col("w") % 1000003)).first()
        if seen == state:
            break
        state = seen
    roots = now.select(F.col("w").alias("v"), F.col("w").alias("label")).distinct()
    return now.select(F.col("u").alias("v"), F.col("w").alias("label")).unionByName(roots)


class Join:
    """State of one similarity join: vertices, full sets fetched so far, components so far."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, words: int, similarity: int):
        self.words, self.similarity = words, similarity
        spark = docs.sparkSession
        prepare(spark)
        self.source = docs.select(*row_key(id_col, text_col), F.col(text_col).alias("text"))
        self.signed = write_stage(self.source.mapInArrow(_sign(words), SIGNED), "signed")
        place = F.struct("k_id", "k_row")
        # The low byte of each token is the sketch that nodes compare.
        sketch = F.to_binary(F.array_join(F.transform("tokens", lambda t: F.lpad(F.hex(t.bitwiseAND(255)), 2, "0")), ""), F.lit("hex"))
        self.vertices = write_stage(
            self.signed.filter("n_shingles > 0").groupBy("v")
            .agg(F.min(place).alias("place"), F.max("n_shingles").alias("n"), F.first("tokens").alias("tokens"))
            .select("v", "place", "n", "tokens", sketch.alias("sketch")), "vertices")
        self.labels: DataFrame | None = None
        self.edges: DataFrame | None = None  # the labels as links
        self.sets: DataFrame | None = None

    def labelled(self, rows: DataFrame) -> DataFrame:
        if self.labels is None:
            return rows.withColumn("label", F.col("v"))
        return rows.join(self.labels, "v", "left").withColumn("label", F.coalesce("label", "v"))

    def alive(self, rows: DataFrame) -> DataFrame:
        """Rows (node, v) of the nodes that hold several components, with the node's size and the
        vertex's label. Written."""
        rows = self.labelled(rows)
        nodes = rows.groupBy("node").agg(F.count("*").alias("size"), F.min("label").alias("a"), F.max("label").alias("b"))
        return write_stage(rows.join(nodes.filter("a != b").select("node", "size"), "node"), "nodes")

    def in_buckets(self, rows: DataFrame, count: int):
        """Rows (node, v, label), about `count`, with their sketches, many small nodes to a group."""
        buckets = max(1, count // BUCKET_ROWS * 2)
        rows = rows.select("node", "v", "label").join(self.vertices.select("v", "n", "sketch"), "v")
        return rows.withColumn("bucket", F.pmod(F.xxhash64("node", F.lit("bucket")), F.lit(buckets))).groupBy("bucket")

    def fetch(self, wanted: DataFrame) -> None:
        """Make sure of the full sets of some vertices (v; written, also several times)."""
        places = self.vertices.join(few(wanted, BROADCAST_ROWS), "v", "left_semi").select("v", "place.k_id", "place.k_row")
        if self.sets is not None:
            places = places.join(few(self.sets.select("v"), BROADCAST_ROWS), "v", "left_anti")
        places = write_stage(places, "wanted")
        if places.isEmpty():
            return
        # Rows that repeat id and text give a set more than once, which does no harm.
        fresh = self.source.join(few(places, BROADCAST_ROWS), ["k_id", "k_row"]).select("v", "text")
        fresh = write_stage(fresh.mapInArrow(_sets(self.words), "v long, grams array<long>"), "sets")
        self.sets = fresh if self.sets is None else self.sets.unionByName(fresh)

    def link(self, links: DataFrame) -> bool:
        """Take confirmed links into the components. Whether there were any."""
        links = write_stage(links, "links")
        if links.isEmpty():
            return False
        if self.edges is not None:
            links = write_stage(links.unionByName(self.edges), "links")
        labels = components(links)
        self.edges = labels.filter("v != label").select(F.col("v").alias("x"), F.col("label").alias("y"))
        self.labels = few(labels, BROADCAST_ROWS)
        return True

    def link_spanning(self, rows: DataFrame, count: int) -> bool:
        """Link what a spanning forest of likely pairs confirms. rows: (node, v, label)."""
        pairs = self.in_buckets(rows, count).applyInArrow(_spanning(self.similarity), "x long, y long, w long")
        pairs = write_stage(spanning_forest(pairs, count), "pairs")  # a node has fewer edges than rows
        if pairs.isEmpty():
            return False
        self.fetch(pairs.select(F.explode(F.array("x", "y")).alias("v")))
        both = (
            self.sets.select(F.col("v").alias("x"), F.col("grams").alias("gx")).join(few(pairs, BROADCAST_ROWS), "x")
            .join(self.sets.select(F.col("v").alias("y"), F.col("grams").alias("gy")), "y")
        )
        common = F.size(F.array_intersect("gx", "gy")).cast("long")
        union = F.size("gx") + F.size("gy") - common
        return self.link(both.filter(100 * common >= self.similarity * union).select("x", "y"))

    def link_exhaustively(self, rows: DataFrame) -> bool:
        """Compare all likely pairs of written nodes of bounded size that are in different components."""
        left = self.in_buckets(rows, rows.count()).applyInArrow(_unsettled(self.similarity), "node long, v long")
        left = write_stage(left, "unsettled")
        if left.isEmpty():
            return False
        # Of nodes with the same unsettled documents one is enough.
        h = F.xxhash64("v")
        nodes = left.groupBy("node").agg(F.count("*").alias("n"), F.sum(h % (1 << 31)).alias("s"), F.bit_xor(h).alias("t"))
        nodes = write_stage(nodes.groupBy("n", "s", "t").agg(F.min("node").alias("node")).select("node"), "nodes")
        left = write_stage(left.join(few(nodes, BROADCAST_ROWS), "node", "left_semi"), "unsettled")
        self.fetch(left.select("v"))
        rows = self.labelled(self.sets.join(few(left, BROADCAST_ROWS), "v"))
        return self.link(rows.select("node", "v", "label", "grams").groupBy("node").applyInArrow(_compare(self.similarity), "x long, y long"))

    def link_large(self, rows: DataFrame, salt: int) -> DataFrame:
        """Link nodes of any size through one document per component, as long as that joins a fifth
        of them; returns the nodes (node, v, tree) that still hold several components."""
        before = None
        while True:
            rows = self.alive(rows.select("node", "v", "tree"))
            if rows.isEmpty():
                return rows
            leaders = rows.groupBy("node", "label").agg(F.min("v").alias("v"))
            sizes = leaders.groupBy("node").agg(F.count("*").alias("leaders"))
            leaders = write_stage(leaders.join(sizes, "node"), "leaders")
            count = leaders.count()
            if before is not None and count > 0.8 * before:
                return rows
            before = count
            if not self.link_spanning(blocked(leaders, "leaders", salt), count):
                return rows

    def leaves(self, trees: int) -> DataFrame:
        """(v, node, tree): each vertex in the first node of its first so many trees."""
        return self.vertices.select("v", F.posexplode(F.slice("tokens", 1, trees)).alias("tree", "token")).select(
            "v", F.xxhash64("tree", "token", F.lit(0)).alias("node"), "tree")

    def run(self) -> None:
        # A few trees link most copies, so that the nodes of the others are settled from the start.
        # Large nodes meet in blocks, and then by one document per component.
        first = self.alive(self.leaves(FIRST_TREES))
        if not first.isEmpty():
            self.link_spanning(blocked(first, "size", 0), first.count())
            large = first.filter(F.col("size") > NODE_LIMIT)
            if not large.isEmpty():
                self.link_large(large, 0)
        rows = self.leaves(TREES)
        for depth in range(1, MAX_DEPTH + 1):
            level = self.alive(rows)
            if level.isEmpty():
                return
            self.link_exhaustively(level.filter(F.col("size") <= NODE_LIMIT))
            rest = level.filter(F.col("size") > NODE_LIMIT)
            if rest.isEmpty():
                return
            if depth == 1:
                rest = self.link_large(rest, depth)
                if rest.isEmpty():
                    return
            rows = self.branch(rest, depth)
        self.blocks(rows)

    def branch(self, rest: DataFrame, depth: int) -> DataFrame:
        """(v, node, tree) a level below the written nodes `rest`: every document follows FAN further
        tokens of its own, read off its text again, as few documents come this far."""
        places = self.vertices.join(few(rest.select("v").distinct(), BROADCAST_ROWS), "v", "left_semi")
        places = write_stage(places.select("v", "place.k_id", "place.k_row"), "wanted")
        further = self.source.join(few(places, BROADCAST_ROWS), ["k_id", "k_row"]).select("v", "text")
        further = further.mapInArrow(_branch(self.words, depth), "v long, further array<int>")
        # Rows that repeat id and text give the same tokens again.
        further = write_stage(further.groupBy("v").agg(F.first("further").alias("further")), "further")
        ways = F.explode(F.array(*[F.lit(b) for b in range(FAN)]))
        rows = rest.select("node", "v", "tree").join(further, "v").withColumn("b", ways)
        token = F.element_at("further", (F.col("tree") * FAN + F.col("b") + 1).cast("int"))
        return rows.select("v", F.xxhash64("node", "b", token).alias("node"), "tree")

    def blocks(self, rows: DataFrame) -> None:
        """What is still large at the last level: every pair of its blocks is compared."""
        half = NODE_LIMIT // 2
        rest = self.alive(rows)
        if rest.isEmpty():
            return
        count = F.ceil(F.col("size") / half).cast("long")
        rest = rest.withColumn("mine", F.pmod(F.xxhash64("v", F.lit("rest")), count))
        other = F.explode(F.sequence(F.lit(0).cast("long"), count - 1))
        rest = rest.withColumn("other", other).withColumn(
            "node", F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other")))
        self.link_exhaustively(write_stage(rest.select("node", "v", "label").distinct(), "rest"))


def blocked(rows: DataFrame, size: str, salt: int) -> DataFrame:
    """Nodes of more than NODE_LIMIT rows cut into random blocks of about that."""
    parts = F.ceil(F.col(size) / NODE_LIMIT)
    block = F.when(F.col(size) > NODE_LIMIT, F.pmod(F.xxhash64("v", F.lit(salt)), parts).cast("long")).otherwise(F.lit(-1).cast("long"))
    return rows.withColumn("node", F.xxhash64("node", block))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    similarity: int = SIMILARITY) -> DataFrame:
    """Per row of `docs`: k_id and k_row (see `row_key`), doc_id, n_shingles, component_id, kept,
    class_id (the component's vertex, also where ids are null or stand for several texts; null
    without words).

    A document's set holds its distinct `words`-word shingles (words end at ASCII white space,
    A-Z lower-cased); fewer words make one shingle; null, empty and blank texts have none and are
    linked with nothing. Documents are linked if 100 x intersection >= similarity x union, judged
    on full sets of 64-bit shingle hashes. component_id is the smallest id reachable; null ids
    count only where a component has no other. `kept`: the row has its component's id. Rows that
    repeat id and text agree; other columns are ignored; an empty table gives no rows.

    Documents with equal sets become one vertex. TREES independent trees deal the vertices to
    nodes by one minwise token. In the first trees a spanning forest of each node's likely pairs (by
    agreeing tokens) is confirmed, which links most copies. Then nodes up to NODE_LIMIT are
    compared exhaustively, on full sets gathered at the node: every document with a likely partner
    in another component. Larger nodes link block by block and through one document per component,
    and then branch by FAN further minwise tokens, each tree and level by hash functions
    of its own, with their components known, so that a node whose documents are all linked is done
    whatever its size. At MAX_DEPTH all blocks of what is left are compared with each other. Two
    documents at 0.75 stay together in a tree with probability 0.75 at the first level and at
    least 2/3 at any depth, so all 12 trees part them with probability 3 ** -12 at most (`missed`).
    """
    join = Join(docs, id_col, text_col, words, similarity)
    join.run()
    rows = join.signed.select("k_id", "k_row", "n_shingles", "v")
    rows = join.labelled(rows).withColumn("doc_id", F.when(F.col("k_id") != F.lit(-(2**63)).cast("long"), F.col("k_id")))
    least = rows.filter("v is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    rows = rows.join(least, "label", "left")
    component = F.when(F.col("v").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return rows.select(
        "k_id", "k_row", "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"), F.col("label").alias("class_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
             similarity: int = SIMILARITY) -> DataFrame:
    """The rows of `docs` that stay when one document of each group does.

    The one with the smallest id, of several such the first by its text's hash; rows that repeat
    id and text count once. Documents without words are linked with nothing and all stay.
    """
    found = near_duplicates(docs, id_col, text_col, words, similarity)
    place = F.struct(F.col("doc_id").isNull(), "k_id", "k_row")
    groups = found.filter("n_shingles > 0 and kept").groupBy("class_id").agg(F.min(place).alias("place"))
    groups = groups.select("place.k_id", "place.k_row")
    lone = found.filter("n_shingles = 0").select("k_id", "k_row")
    stay = as_key(groups.unionByName(lone)).distinct()
    return keyed(docs, id_col, text_col).join(stay, KEY, "left_semi").dropDuplicates(KEY).select(*columns_of(docs))
