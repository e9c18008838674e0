"""Operator 4: exact top-k by inner product with best-first search in M-trees.

``build`` turns each task's vectors, ``TREE`` at a time, into a tree of metric pages and
stores it as one row; nothing is shuffled and a hot vector is spread over all trees. A
page has a pivot, the covering radius of what lies below, the distance of its pivot to
the pivot of its parent, and the greatest norm and least id below; a leaf page also keeps
its vectors' distances to its pivot.

``search`` sends blocks of ``QUERIES`` query vectors to all trees. From a tree's pages a
query always opens the one with the best bound next. With d(q, p) known for a page, the
triangle inequality gives |d(q, p) - d(x, p)| <= d(q, x) for everything stored with its
distance to p, and since the inner product is (|q|^2 + |x|^2 - d(q, x)^2) / 2, an upper
bound of the score without touching x. Only pages and vectors whose bound reaches the
k-th score so far are computed; a tree is left when no page can reach it. Scores are
integers and exact, whatever the size of the components; bounds get a small slack for
rounding. How much the bounds spare depends on the vectors: much where they lie in
clusters, next to nothing where they point everywhere alike (README has figures).

The query set against all vectors, in blocks, makes queries times trees small tasks;
each returns k rows a query, of which tasks keep k before the last shuffle. A task holds
one tree and one block.

Components are floor(``SCALE`` * x), kept as doubles, which hold such a floor exactly.
Defined cases: a vector that is null, or holds a null or a non-finite component (or, of
double vectors, one of 1e150 or more), takes no part; so does a row whose id is null; a
pair whose score is beyond a long is left out, as there is no such number to return; vectors of different lengths do not meet; equal scores go to the
smaller id, and a repeated id counts once for each row, but never for its own query; a
query row that repeats is asked once; fewer than k others are all returned; further
columns are left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martweave.session import work_folder

SCALE, TOP = 1024, 10
TREE, PAGE, FAN, QUERIES = 8192, 512, 8, 512
SLACK = 1e-9

STORED = "dim int, n int, ids binary, vectors binary, pages binary, apart binary"
#: Columns of the table of pages; children and vectors are ranges.
PIVOT, RADIUS, TO_PARENT, NORM, LEAST, LEAF, FIRST, LAST = range(8)


class Tree(NamedTuple):
    ids: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    pages: np.ndarray
    apart: np.ndarray


def _distances(points: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - pivot) ** 2).sum(1))


def _split(points: np.ndarray, far: np.ndarray) -> np.ndarray:
    """The group of each point: that of its nearest of some points far from each other.

    Groups that would leave a page nearly empty join others; where none are left (all
    points alike, or all about as far from each other) shells around the pivot are cut,
    in the order of the rows among equals.
    """
    pivots, gaps, near = [0], [far], far
    while len(pivots) < FAN and near.max() > 0:
        pivots.append(int(near.argmax()))
        gaps.append(_distances(points, points[pivots[-1]]))
        near = np.minimum(near, gaps[-1])
    table = np.stack(gaps, 1)
    while table.shape[1] > 1:
        owner = table.argmin(1)
        size = np.bincount(owner, minlength=table.shape[1])
        if size.min() >= PAGE // 4:
            return owner
        table = np.delete(table, size.argmin(), 1)
    shells = min(FAN, -(-len(points) // PAGE))
    owner = np.zeros(len(points), np.int64)
    owner[np.argsort(far, kind="stable")] = np.arange(len(points)) * shells // len(points)
    return owner


def grow(ids: np.ndarray, vectors: np.ndarray) -> Tree:
    """A tree over some vectors, split from the root."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order].astype(np.float64)
    norms = (vectors**2).sum(1)
    pages: list[list[float]] = []
    place = np.zeros(len(ids), np.int64)
    apart = np.zeros(len(ids))
    filled = 0
    # Breadth first, so that the children of a page are a range.
    waiting: list[tuple[np.ndarray, int, int]] = [(np.arange(len(ids)), 0, -1)]
    pages.append([0.0] * 8)
    while waiting:
        later = []
        for rows, page, parent in waiting:
            pivot = int(pages[page][PIVOT]) if parent >= 0 else int(rows[0])
            far = _distances(vectors[rows], vectors[pivot])
            to_parent = _distances(vectors[[pivot]], vectors[int(pages[parent][PIVOT])])[0] if parent >= 0 else 0.0
            head = [pivot, far.max(), to_parent, np.sqrt(norms[rows].max()), ids[rows].min()]
            if len(rows) <= PAGE:
                place[filled : filled + len(rows)] = rows
                apart[filled : filled + len(rows)] = far
                pages[page] = [*head, 1, filled, filled + len(rows)]
                filled += len(rows)
                continue
            owner = _split(vectors[rows], far)
            pivots = [int(rows[owner == k][0]) for k in range(owner.max() + 1)]
            first = len(pages)
            for k, new in enumerate(pivots):
                pages.append([float(new)] + [0.0] * 7)
                later.append((rows[owner == k], first + k, page))
            pages[page] = [*head, 0, first, len(pages)]
        waiting = later
    table = np.array(pages, float)
    where = np.zeros(len(ids), np.int64)
    where[place] = np.arange(len(ids))
    table[:, PIVOT] = where[table[:, PIVOT].astype(np.int64)]
    return Tree(ids[place], vectors[place], np.sqrt(norms[place]), table, apart)


def _arithmetic(left: np.ndarray, right: np.ndarray) -> type:
    """What inner products of rows of two matrices of whole doubles need to be exact."""
    largest = [float(np.abs(x).max(initial=0)) for x in (left, right)]
    most = largest[0] * largest[1] * max(left.shape[1], 1)
    if most < 2**53:
        return float
    return int if most < 2**62 and max(largest) < 2**62 else object


def _whole(values: np.ndarray) -> np.ndarray:
    """Whole doubles as Python integers."""
    return np.array([int(v) for v in values.ravel().tolist()], object).reshape(values.shape)


def best(tree: Tree, own: int, query: np.ndarray, top: int, kind: type) -> list[tuple[int, int]]:
    """(score, -id) of the query's best others in the tree, best first; ``kind`` is the arithmetic."""
    square = float(query @ query)
    norm = np.sqrt(square)
    pages, vectors = tree.pages, tree.vectors
    found: list[tuple[int, int]] = []  # a heap, the worst first

    def bound(low: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Of scores at distance ``low`` or more and norms up to ``norms``."""
        out = (square + norms**2 - np.maximum(low, 0) ** 2) / 2
        return np.minimum(out, norm * norms) * 1.0 + SLACK * (square + norms**2) + 1e-3

    def worth(limit: np.ndarray, least: np.ndarray) -> np.ndarray:
        if len(found) < top:
            return np.ones(len(limit), bool)
        score, number = float(found[0][0]), found[0][1]
        return (limit > score + 1) | ((limit >= score) & ((limit >= score + 0.5) | (least <= -number)))

    def opened(page: int) -> float:
        return float(np.sqrt(((vectors[int(pages[page, PIVOT])] - query) ** 2).sum()))

    far = opened(0)
    heap = [(-np.inf, 0, far)]
    while heap:
        limit, page, far = heapq.heappop(heap)
        if not worth(np.array([-limit]), pages[page : page + 1, LEAST])[0]:
            continue
        first, last = int(pages[page, FIRST]), int(pages[page, LAST])
        if pages[page, LEAF]:
            limits = bound(np.abs(far - tree.apart[first:last]), tree.norms[first:last])
            some = first + np.flatnonzero(worth(limits, tree.ids[first:last]) & (tree.ids[first:last] != own))
            if kind is float and 2 * len(some) > last - first:  # no copy of the page
                scores = (vectors[first:last] @ query)[some - first].astype(np.int64)
            elif kind is float:
                scores = (vectors[some] @ query).astype(np.int64)
            elif kind is int:
                scores = vectors[some].astype(np.int64) @ query.astype(np.int64)
            else:
                sums = _whole(vectors[some]) @ _whole(query)
                fits = np.array([-(2**63) <= s < 2**63 for s in sums.tolist()], bool)
                some, scores = some[fits], sums[fits].astype(np.int64)
            numbers = tree.ids[some]
            if len(found) == top:
                good = scores >= found[0][0]
                scores, numbers = scores[good], numbers[good]
            if len(scores) > top:
                good = np.lexsort((numbers, -scores))[:top]
                scores, numbers = scores[good], numbers[good]
            for score, number in zip(scores.tolist(), numbers.tolist()):
                if len(found) < top:
                    heapq.heappush(found, (score, -number))
                elif (score, -number) > found[0]:
                    heapq.heapreplace(found, (score, -number))
            continue
        child = pages[first:last]
        # Before any distance: the stored one to this page's pivot.
        limits = bound(np.abs(far - child[:, TO_PARENT]) - child[:, RADIUS], child[:, NORM])
        some = np.flatnonzero(worth(limits, child[:, LEAST]))
        if not len(some):
            continue
        gaps = _distances(vectors[child[some, PIVOT].astype(np.int64)], query)
        limits = bound(gaps - child[some, RADIUS], child[some, NORM])
        for k in np.flatnonzero(worth(limits, child[some, LEAST])).tolist():
            heapq.heappush(heap, (-float(limits[k]), first + int(some[k]), float(gaps[k])))
    return sorted(found, reverse=True)


def points(df: DataFrame, scale: int = SCALE, name: str = "embedding") -> DataFrame:
    """vec_id and the scaled components of the vectors that take part."""
    # From 2^52 on a double is whole, and a long may be too small for it.
    whole = F.transform(
        F.col(name).cast("array<double>"),
        lambda x: F.when(F.abs(x) < 2.0**52 / scale, F.floor(x * scale).cast("double")).otherwise(x * scale),
    )
    real = F.forall(F.col(name).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 1e150))
    usable = df.where(F.col("vec_id").isNotNull() & F.col(name).isNotNull()).where(real)
    return usable.select(F.col("vec_id").cast("long"), whole.alias("vector"))


def _packed(matrix: np.ndarray) -> bytes:
    """Whole doubles in four bytes each if that is enough, else in eight."""
    return matrix.astype("<i4" if np.abs(matrix).max(initial=0) < 2**31 else "<f8").tobytes()


def _unpacked(data: bytes, rows: int, dim: int) -> np.ndarray:
    kind = "<i4" if len(data) == 4 * rows * dim else "<f8"
    return np.frombuffer(data, kind).reshape(rows, dim).astype(np.float64)


def _held(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, ids and vectors of up to ``size`` rows of one length at a time."""
    waiting: dict[int, list] = {}
    for batch in batches:
        for first in range(0, batch.num_rows, size):
            some = batch.slice(first, size)
            ids = some.column(0).to_numpy(zero_copy_only=False)
            count = some.column(1).value_lengths().to_numpy(zero_copy_only=False)
            flat = some.column(1).flatten().to_numpy(zero_copy_only=False)
            at = np.cumsum(count) - count
            for dim in np.unique(count).tolist():
                rows = np.flatnonzero(count == dim)
                matrix = flat[(at[rows][:, None] + np.arange(dim)).ravel()].reshape(len(rows), dim)
                kept = waiting.setdefault(dim, [])
                kept.append((ids[rows], matrix))
                while sum(len(i) for i, _ in kept) >= size:
                    ids_, matrix = (np.concatenate(x) for x in zip(*kept))
                    yield dim, ids_[:size], matrix[:size]
                    kept[:] = [(ids_[size:], matrix[size:])]
    for dim, kept in waiting.items():
        ids, matrix = (np.concatenate(x) for x in zip(*kept))
        if len(ids):
            yield dim, ids, matrix


def build(vectors: DataFrame, size: int = TREE) -> DataFrame:
    """One row for each tree over ``vectors`` (rows of ``points``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, ids, matrix in _held(batches, size):
            tree = grow(ids, matrix)
            binary = (tree.ids.astype("<i8").tobytes(), _packed(tree.vectors), tree.pages.tobytes(), tree.apart.tobytes())
            yield pa.RecordBatch.from_pydict(
                {
                    "dim": pa.array([dim], pa.int32()),
                    "n": pa.array([len(ids)], pa.int32()),
                    **{
                        k: pa.array([x], pa.binary())
                        for k, x in zip(("ids", "vectors", "pages", "apart"), binary)
                    },
                }
            )

    return vectors.mapInArrow(run, STORED)


def search(trees: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the best ``top`` others of each query.

    ``trees``: rows of ``build``, from a written table; ``queries``: rows of ``points``.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, ids, matrix in _held(batches, QUERIES):
            yield pa.RecordBatch.from_pydict(
                {
                    "dim": pa.array([dim], pa.int32()),
                    "asked": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                    "asked_vectors": pa.array([_packed(matrix)], pa.binary()),
                }
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dim, ids, vectors, pages, apart, asked, asked_vectors = (c[row].as_py() for c in batch.columns)
                ids = np.frombuffer(ids, "<i8")
                vectors = _unpacked(vectors, len(ids), dim)
                tree = Tree(ids, vectors, np.sqrt((vectors**2).sum(1)), np.frombuffer(pages).reshape(-1, 8), np.frombuffer(apart))
                asked = np.frombuffer(asked, "<i8")
                matrix = _unpacked(asked_vectors, len(asked), dim)
                kind = _arithmetic(vectors, matrix)
                out = [
                    (own, -number, score)
                    for own, query in zip(asked.tolist(), matrix)
                    for score, number in best(tree, own, query, top, kind)
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": pa.array([o[0] for o in out], pa.int64()),
                        "vec_id": pa.array([o[1] for o in out], pa.int64()),
                        "score": pa.array([o[2] for o in out], pa.int64()),
                    }
                )

    blocks = queries.dropDuplicates(["vec_id"]).mapInArrow(pack, "dim int, asked binary, asked_vectors binary")
    # Every block goes to every tree of its length, dealt over as many places as there are trees.
    places = max(1, min(trees.count(), 1 << 16))
    key: Column = F.pmod(F.xxhash64("ids"), F.lit(places))
    dealt = blocks.withColumn("place", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(places - 1).cast("long"))))
    pairs = trees.withColumn("place", key).join(dealt, ["dim", "place"])
    found = pairs.select("dim", "ids", "vectors", "pages", "apart", "asked", "asked_vectors").mapInArrow(
        run, "query_id long, vec_id long, score long"
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranks = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return ranks.select("query_id", "rank", "vec_id", "score")


def top_k(df: DataFrame, asked: Column, top: int = TOP, scale: int = SCALE) -> DataFrame:
    """``search`` for the rows of ``df`` (vec_id, embedding) where ``asked`` holds, against all rows."""
    spark = df.sparkSession
    folder = work_folder(spark, "trees")
    build(points(df, scale)).write.parquet(folder)
    return search(spark.read.parquet(folder), points(df.where(asked), scale), top)
