"""Exact top-k inner-product search with a pivot-distance index."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from bankspark.llm.common import prepare, write_stage

PIVOTS = 16
PIVOT_SAMPLE = 2000  # rows the pivots are chosen from
ANNULI = 4
BLOCK = 2048  # vectors of a stored block, queries of a query block
EXACT = float(2**53)


LARGEST = 9223372036854774784.0  # the largest double that is a long


def scaled(vector: Column, factor: int = 1024) -> Column:
    """floor(factor * x) of each component, at the edge of longs where it lies beyond them; null for a
    vector that is null or holds a null or non-finite component."""
    x = F.transform(vector, lambda e: e.cast("double"))
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    edge = F.lit(LARGEST)
    return F.when(fine, F.transform(x, lambda e: F.floor(F.greatest(F.least(F.lit(factor) * e, edge), -edge))))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Lists of integers as rows of `dim` numbers; shorter ones are padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = np.zeros((len(column), dim), np.int64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products, exact: by doubles where they are, else by Python's integers; a sum beyond
    the longs is at their edge."""
    bound = np.sqrt((a.astype(float) ** 2).sum(axis=1).max() * (b.astype(float) ** 2).sum(axis=1).max())
    if bound < EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, 1 - 2**63, 2**63 - 1).astype(np.int64)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x, p = x.astype(float), pivots.astype(float)
    square = (x**2).sum(axis=1)[:, None] + (p**2).sum(axis=1) - 2 * x @ p.T
    return np.sqrt(np.maximum(square, 0))


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to the smaller id."""
    if len(ids) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        on = scores >= least
        ids, scores = ids[on], scores[on]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first: each next pivot is the sampled vector farthest from those chosen."""
    chosen = [0]
    near = distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(n, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


@dataclass
class Index:
    pivots: np.ndarray
    cells: np.ndarray  # per cell: pivot, least and largest distance, largest square norm, blocks
    blocks: DataFrame  # cell, block, ids, vectors
    points: DataFrame  # id, ints, cell
    dim: int


def build_index(rows: DataFrame, n_pivots: int = PIVOTS, annuli: int = ANNULI, block: int = BLOCK) -> Index | None:
    """Index rows (id, ints). Every row is indexed; only the pivots come from a bounded sample of
    PIVOT_SAMPLE rows. The driver holds figures per cell, n_pivots x annuli at most."""
    dim = rows.agg(F.max(F.size("ints"))).first()[0]
    if dim is None:
        return None
    dim = max(1, dim)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).select("ints").collect()
    pivots = choose_pivots(matrix(pa.array([r[0] for r in sample], pa.list_(pa.int64())), dim), n_pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), dim)
            d = distances(x, pivots)
            near = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(x)), near]),
                 pa.array((x.astype(float) ** 2).sum(axis=1))], names=["id", "ints", "pivot", "distance", "norm"])

    points = write_stage(
        rows.select("id", "ints").mapInArrow(place, "id long, ints array<long>, pivot int, distance double, norm double"), "points")
    cuts = points.groupBy("pivot").agg(F.percentile_approx("distance", [i / annuli for i in range(1, annuli)]).alias("cuts"))
    edges = {r["pivot"]: r["cuts"] for r in cuts.collect()}
    lookup = F.create_map(*[F.lit(x) if not isinstance(x, list) else F.array(*[F.lit(e) for e in x]) for p, e in edges.items() for x in (p, e)])
    ring = F.size(F.filter(lookup[F.col("pivot")], lambda e: F.col("distance") > e))
    points = points.withColumn("cell", F.col("pivot") * annuli + ring)
    figures = points.groupBy("cell").agg(
        F.first("pivot").alias("pivot"), F.min("distance").alias("lo"), F.max("distance").alias("hi"), F.max("norm").alias("norm"),
        F.count("*").alias("n")).collect()
    cells = np.array([(r["cell"], r["pivot"], r["lo"], r["hi"], r["norm"], -(-r["n"] // block)) for r in figures], float)
    parts = F.create_map(*[F.lit(int(x)) for r in cells for x in (r[0], r[5])])
    number = F.pmod(F.xxhash64("id", "ints"), parts[F.col("cell")]).cast("int")

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        x = matrix(table.column("ints"), dim)
        return pa.table({
            "cell": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
            "ids": pa.array([table.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()),
            "vectors": pa.array([x.astype("<i8").tobytes()], pa.binary())})

    blocks = points.select("cell", number.alias("block"), "id", "ints").groupBy("cell", "block").applyInArrow(
        gather, "cell int, block int, ids binary, vectors binary")
    return Index(pivots, cells, write_stage(blocks, "blocks"), points.select("id", "ints", "cell"), dim)


def _scored(dim: int, k: int):
    """Per row: a block of queries (with what they still accept) against a block of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(j)[i].as_py() for j, c in enumerate(batch.schema.names)}
                qid = np.frombuffer(row["qids"], "<i8")
                q = np.frombuffer(row["queries"], "<i8").reshape(-1, dim)
                least = np.frombuffer(row["least"], "<f8")
                ids = np.frombuffer(row["ids"], "<i8")
                score = products(q, np.frombuffer(row["vectors"], "<i8").reshape(-1, dim))
                out = [[], [], []]
                for j in range(len(qid)):
                    on = np.nonzero((ids != qid[j]) & (score[j] >= least[j]))[0]
                    got, s = best(ids[on], score[j][on], k)
                    out[0].append(np.full(len(got), qid[j]))
                    out[1].append(got)
                    out[2].append(s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in out], names=["query_id", "id", "score"])

    return run


FOUND = "query_id long, id long, score long"


def search(index: Index, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, id, score): the k highest inner products of each query (id, ints) with the
    indexed rows of other ids; ties to the smaller id. Exact.

    Queries are gathered in blocks by cell. Each first meets a block of its own annulus, which
    bounds its k-th score from below. An annulus (pivot distance lo..hi) can hold a vector v only at
    a distance of max(0, lo - d, d - hi) from a query at distance d of the pivot, hence with a
    product of at most (|q|^2 + max|v|^2 - that^2) / 2; the expansion stops at annuli below
    the k-th score. The rest are visited, in blocks, by the queries that still need them.
    """
    dim, pivots, cells = index.dim, index.pivots, index.cells
    # A query that is not indexed, or has more components than any indexed row, starts anywhere.
    where = queries.join(index.points.select("id", "cell").distinct(), "id", "left").select(
        "id", F.coalesce("cell", F.lit(int(cells[0][0]))).alias("cell"), F.slice("ints", 1, dim).alias("ints"))
    where = where.groupBy("id").agg(F.min("cell").alias("cell"), F.min("ints").alias("ints"))
    sizes = where.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    where = where.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        x = matrix(table.column("ints"), dim)
        return pa.table({
            "cell": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([0], pa.int32()),
            "qids": pa.array([table.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()),
            "queries": pa.array([x.astype("<i8").tobytes()], pa.binary()),
            "least": pa.array([np.full(len(x), -np.inf).tobytes()], pa.binary())})

    groups = where.select("cell", "part", "id", "ints").groupBy("cell", "part").applyInArrow(
        gather, "cell int, block int, qids binary, queries binary, least binary")
    groups = write_stage(groups, "query-blocks")
    stored = index.blocks
    first = groups.join(stored, ["cell", "block"]).select("qids", "queries", "least", "ids", "vectors")
    first = write_stage(first.mapInArrow(_scored(dim, k), FOUND), "first")
    kth = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("s")).filter(F.col("n") >= k)
    known = where.select("id", "cell", "part", "ints").join(kth.select(F.col("query_id").alias("id"), "s"), "id", "left")

    def expand(key: tuple, table: pa.Table) -> pa.Table:
        x = matrix(table.column("ints"), dim)
        ids = table.column("id").to_numpy()
        least = table.column("s").to_numpy(zero_copy_only=False).astype(float)
        least = np.nextafter(np.where(np.isnan(least), -np.inf, least), -np.inf)  # as a double it may be rounded up
        d = distances(x, pivots)
        norm = (x.astype(float) ** 2).sum(axis=1)
        out = []
        for cell, pivot, lo, hi, top, blocks in cells:
            apart = np.maximum(0, np.maximum(lo - d[:, int(pivot)], d[:, int(pivot)] - hi))
            apart = np.maximum(0, apart - 1e-6 * (1 + apart))
            bound = (norm + top - apart**2) / 2
            on = bound + np.abs(bound) * 1e-9 + 1e-6 >= least
            own = int(cell) == key[0].as_py()
            if on.any():
                chosen = (ids[on].astype("<i8").tobytes(), x[on].astype("<i8").tobytes(), least[on].tobytes())
                out += [(int(cell), b, *chosen) for b in range(int(own), int(blocks))]
        c = list(zip(*out)) if out else [[] for _ in range(5)]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table({n: pa.array(v, t) for n, v, t in zip(["cell", "block", "qids", "queries", "least"], c, kinds)})

    more = known.groupBy("cell", "part").applyInArrow(expand, "cell int, block int, qids binary, queries binary, least binary")
    more = more.join(stored, ["cell", "block"]).select("qids", "queries", "least", "ids", "vectors").mapInArrow(_scored(dim, k), FOUND)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    both = first.unionByName(more).withColumn("rank", F.row_number().over(order))
    return both.filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def top_k(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10) -> DataFrame:
    """Build the index over `vectors` and search it with `queries`, both (id, vector).

    Vectors are scaled to integers (`scaled`); null ones, those with null or non-finite
    components, and rows without id take no part. Shorter vectors count as padded with zeros. Rows
    of the query's own id are not its candidates; a repeated query id is one query; repeated
    candidates each count. Queries need not be among the vectors; components beyond the longest
    indexed vector meet nothing. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    prepare(spark)
    clean = lambda df: df.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector_col)).alias("ints")).filter(
        "id is not null and ints is not null")
    index = build_index(clean(vectors))
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    return search(index, clean(queries), k)
