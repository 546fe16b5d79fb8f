"""Nearest neighbours over a few stable projections (SRS, Sun et al. 2014).

Gaussian projections to ``dims`` dimensions keep distances in distribution: the squared projected distance of a pair is
its squared distance times a chi-square variable. A kd-tree indexes the projected points. A query takes its projected
neighbours nearest first, verifies each on the original vectors, and stops when the chi-square test says that a point as
near as the k-th found would have turned up by now with probability ``sure``.

The top of the kd-tree deals the vectors into cells; a task searches one cell. A query searches its own cell first; the
distance found there gives the radius, by the same test, of the other cells it has to visit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stopwise.llm.common import remove, require, shared_root, with_workers, written


@dataclass(frozen=True)
class ProjectionConfig:
    """``sample``: rows that place the cells' borders (all rows are indexed). ``cell``: rows of a cell, aimed at, and
    at most of one task; ``cells``: most cells. ``block``: queries that a task holds at a time. ``leaf``: rows of a leaf."""

    dims: int = 8
    sure: float = 0.99
    k: int = 10
    sample: int = 20_000
    cell: int = 16_384
    cells: int = 4096
    block: int = 8192
    leaf: int = 64
    seed: int = 5


def chi_square_cdf(x: float, dims: int) -> float:
    """For an even number of degrees of freedom, in closed form."""
    term, total = 1.0, 1.0
    for i in range(1, dims // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi_square_quantile(p: float, dims: int) -> float:
    low, high = 0.0, 1.0
    while chi_square_cdf(high, dims) < p:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, dims) < p else (low, middle)
    return high


def projection(width: int, cfg: ProjectionConfig) -> np.ndarray:
    return np.random.default_rng(cfg.seed).standard_normal((width, cfg.dims))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


# ---- the cells: a kd-tree of cut values, breadth first


def cuts(points: np.ndarray, depth: int) -> np.ndarray:
    """Cut values of a complete tree of ``depth`` levels; level ``d`` cuts the axis ``d mod dims`` at the medians."""
    values = np.zeros((1 << depth) - 1)
    parts = [points]
    for d in range(depth):
        following = []
        for i, part in enumerate(parts):
            axis = part[:, d % points.shape[1]]
            cut = float(np.median(axis)) if len(axis) else 0.0
            values[(1 << d) - 1 + i] = cut
            following += [part[axis < cut], part[axis >= cut]]
        parts = following
    return values


def cell_of(points: np.ndarray, values: np.ndarray) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    for d in range(int(math.log2(len(values) + 1))):
        node = 2 * node + 1 + (points[:, d % points.shape[1]] >= values[node])
    return node - len(values)


def cell_boxes(values: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    depth = int(math.log2(len(values) + 1))
    low, high = np.full((1, dims), -np.inf), np.full((1, dims), np.inf)
    for d in range(depth):
        cut = values[(1 << d) - 1 : (1 << (d + 1)) - 1]
        low, high = np.repeat(low, 2, axis=0), np.repeat(high, 2, axis=0)
        high[0::2, d % dims] = np.minimum(high[0::2, d % dims], cut)
        low[1::2, d % dims] = np.maximum(low[1::2, d % dims], cut)
    return low, high


# ---- the search inside a cell


class KdTree:
    """Leaves of equal size over projected points, cut at medians of the widest axis; leaves keep tight boxes."""

    def __init__(self, points: np.ndarray, leaf: int) -> None:
        order = [np.arange(len(points))]
        while max(map(len, order)) > leaf:
            following = []
            for part in order:
                if len(part) <= leaf:
                    following.append(part)
                    continue
                axis = int(np.argmax(np.ptp(points[part], axis=0)))
                half = len(part) // 2
                split = np.argpartition(points[part, axis], half)
                following += [part[split[:half]], part[split[half:]]]
            order = following
        self.leaves = order
        self.low = np.array([points[x].min(0) for x in order])
        self.high = np.array([points[x].max(0) for x in order])

    def nearest_first(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves and their squared distances from the query, ascending."""
        gap = np.maximum(np.maximum(self.low - query, query - self.high), 0)
        squared = (gap**2).sum(1)
        order = np.argsort(squared, kind="stable")
        return order, squared[order]


def search(
    ids: np.ndarray, vectors: np.ndarray, points: np.ndarray, tree: KdTree, query_id: int, query: np.ndarray,
    projected: np.ndarray, bound: float, limit: float, k: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and squared distances of up to ``k`` nearest; ``bound``: squared k-th distance known before; ``limit``: the
    chi-square quantile of the stopping test."""
    best_id, best = np.zeros(0, np.int64), np.zeros(0)
    order, away = tree.nearest_first(projected)
    at, width = 0, 4
    while at < len(order):
        kth = min(bound, best[k - 1]) if len(best) >= k else bound
        if away[at] > limit * kth:  # the test holds: stop
            break
        rows = np.concatenate([tree.leaves[i] for i in order[at : at + width]])
        at, width = at + width, min(2 * width, 64)
        rows = rows[ids[rows] != query_id]
        if np.isfinite(kth):
            rows = rows[((points[rows] - projected) ** 2).sum(1) <= limit * kth]
        squared = ((vectors[rows] - query) ** 2).sum(1)
        best_id, best = np.concatenate([best_id, ids[rows]]), np.concatenate([best, squared])
        keep = np.lexsort((best_id, best))[:k]
        best_id, best = best_id[keep], best[keep]
    return best_id, best


_FOUND = "query_id long, vec_id long, squared double"


def _search_cell(matrix_: np.ndarray, cfg: ProjectionConfig, limit: float):
    def run(left: Iterator[pa.RecordBatch], right: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, queries = pa.Table.from_batches(list(left)), pa.Table.from_batches(list(right))
        out: list[tuple[np.ndarray, ...]] = []
        if len(rows) and len(queries):
            ids = rows["vec_id"].to_numpy()
            vectors = matrix(rows["embedding"].combine_chunks())
            points = vectors @ matrix_
            tree = KdTree(points, cfg.leaf)
            wanted = matrix(queries["embedding"].combine_chunks())
            near = wanted @ matrix_
            for i, (q, bound) in enumerate(zip(queries["vec_id"].to_pylist(), queries["bound"].to_pylist(), strict=True)):
                found, squared = search(ids, vectors, points, tree, q, wanted[i], near[i], bound, limit, cfg.k)
                out.append((np.full(len(found), q), found, squared))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query_id", "vec_id", "squared"])

    return lambda left, right: pa.Table.from_batches(run(iter(left.to_batches()), iter(right.to_batches())))


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` (doubles) of vectors that can take part."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select("vec_id", v.alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    )


def _numbers(count: str) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.col(count).cast("long") - 1)


def nearest(vectors: DataFrame, queries: DataFrame, cfg: ProjectionConfig | None = None, folder: str | None = None) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` (Euclidean distance): each query's ``k`` nearest rows of ``vectors``.

    Both tables have ``vec_id`` and ``embedding``; a row with the query's own id is no candidate. Vectors that are null,
    zero or hold null or non-finite components take no part, nor do those without id or of another length than the
    commonest (ties: the shorter). Ties go to the smaller id. Rows that repeat an id and vector count once. Other
    columns are ignored; empty tables give an empty result. With ``sure`` each true neighbour is found with that
    probability at least.
    """
    require(vectors, "vec_id", "embedding"), require(queries, "vec_id", "embedding")
    with_workers(vectors)
    cfg = cfg or ProjectionConfig()
    folder = folder or shared_root(vectors.sparkSession)
    rows = valid_vectors(vectors)
    widths = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if widths is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, total = widths
    rows = rows.where(F.size("embedding") == width)
    random, limit = projection(width, cfg), chi_square_quantile(cfg.sure, cfg.dims)

    # The cells' borders, from a bounded sample of projected points.
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(cfg.sample).select("embedding").toArrow()
    depth = max(0, math.ceil(math.log2(min(cfg.cells, max(1, total / cfg.cell)))))
    values = cuts(matrix(sample["embedding"].combine_chunks()) @ random, depth)
    low, high = cell_boxes(values, cfg.dims)
    # A cell of more rows than aimed at, as with many copies, is dealt to several tasks.
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = cell_of(matrix(batch.column("embedding")) @ random, values)
                yield batch.append_column("cell", pa.array(cell, pa.int64()))

    placed = T.StructType([*rows.schema.fields, T.StructField("cell", T.LongType())])
    indexed = written(rows.mapInArrow(place, placed), folder, "cells")
    sizes = indexed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / (2 * cfg.cell)).cast("int").alias("parts"))
    sizes = written(sizes, folder, "sizes")  # one row for each of at most ``cells`` cells
    shards = indexed.join(F.broadcast(sizes), "cell").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")))

    asked = queries.select("vec_id").distinct()
    own = written(indexed.join(asked, "vec_id", "left_semi").withColumn("bound", F.lit(float("inf"))), folder, "queries")
    find = _search_cell(random, cfg, limit)

    def visit(visits: DataFrame, step: int) -> DataFrame:
        """Search the cells of ``visits``: vectors and queries meet by cell, part of the cell and block of queries."""
        blocks = visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / cfg.block).cast("int").alias("blocks"))
        blocks = F.broadcast(written(blocks, folder, f"blocks-{step}"))
        seekers = visits.join(blocks, "cell").join(F.broadcast(sizes), "cell").select(
            "cell", F.explode(_numbers("parts")).alias("part"),
            F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("long").alias("block"), "vec_id", "embedding", "bound",
        )
        there = shards.join(blocks, "cell").select(
            "cell", F.col("part").cast("long").alias("part"), F.explode(_numbers("blocks")).alias("block"),
            "vec_id", "embedding",
        )
        keys = ["cell", "part", "block"]
        return there.groupBy(*keys).cogroup(seekers.groupBy(*keys)).applyInArrow(find, _FOUND)

    best = Window.partitionBy("query_id").orderBy("squared", "vec_id")
    top = lambda found: found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= cfg.k)
    first = written(top(visit(own, 1)), folder, "first")
    kth = first.where(F.col("rank") == cfg.k).select(F.col("query_id").alias("vec_id"), F.col("squared").alias("kth"))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                point = np.asarray(row.embedding) @ random
                gap = np.maximum(np.maximum(low - point, point - high), 0)
                near = np.flatnonzero((gap**2).sum(1) <= limit * row.bound)
                near = near[near != row.cell]
                if len(near):
                    yield pd.DataFrame({"cell": near, "vec_id": row.vec_id, "embedding": [row.embedding] * len(near), "bound": row.bound})

    bounded = own.drop("bound").join(kth, "vec_id", "left").select("cell", "vec_id", "embedding", F.coalesce("kth", F.lit(float("inf"))).alias("bound"))
    visits = bounded.mapInPandas(route, "cell long, vec_id long, embedding array<double>, bound double")
    second = visit(written(visits, folder, "visits"), 2)
    return top(first.select("query_id", "vec_id", "squared").unionByName(second)).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.sqrt("squared").alias("score")
    )
