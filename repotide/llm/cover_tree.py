"""Exact top-k by inner product: dual-tree search over cover trees.

Data are dealt into blocks of bounded size by a hash, and every block meets the
whole query set, group by group. In a task the block and the query group are
both indexed by cover trees. A pair of nodes is left out when the largest inner
product that their centres and covering radii allow is below the worst kth score
of the query node's group. What remains meets leaf by leaf as matrix products.
The blocks' results, k rows a query each, merge by score.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repotide.llm.common import prepare

BLOCK_ROWS = 4096
GROUP_ROWS = 1024
LEAF = 128
STEP = 256
# Scores beyond a long are null and ranked by ``beyond`` and ``digits``.
FOUND = "query_id long, vec_id long, score long, beyond int, digits string"
# Products of vectors below this are exact sums in doubles; others are made of Python's numbers.
SMALL = float(1 << 22)
EXACT = float(1 << 53)


class Node:
    """A centre, the radius that covers all rows below it, and children or none.

    The centres of a node's children lie further than ``level`` apart, and each
    covers the rows within ``level`` of it that no earlier one covers. Rows
    that no other is near share leaves.
    """

    __slots__ = ("center", "norm", "radius", "rows", "children")

    def __init__(self, points: np.ndarray, squares: np.ndarray, rows: np.ndarray, level: float) -> None:
        distance = _distances(points, squares, rows, rows[:1])[0]
        self.center, self.rows = points[rows[0]], rows
        self.norm = float(np.sqrt(squares[rows[0]]))
        self.radius = float(distance.max(initial=0.0))
        self.children: list[Node] = []
        if len(rows) <= LEAF or self.radius == 0:
            return
        while level >= self.radius:
            level /= 2
        parts, single = [], []
        left = rows
        while len(left):
            # The next centres' distances at once, as one matrix product.
            ahead = left[:STEP]
            near = _distances(points, squares, left, ahead) <= level
            free = np.ones(len(left), bool)
            for i in range(len(ahead)):
                if free[i]:
                    covered = near[i] & free
                    free &= ~covered
                    (parts if np.count_nonzero(covered) > 1 else single).append(left[covered])
            left = left[free]
        if len(parts) + bool(single) > 1:
            self.children = [Node(points, squares, own, level / 2) for own in parts]
            alone = np.concatenate(single) if single else rows[:0]
            for start in range(0, len(alone), LEAF):
                self.children.append(Node(points, squares, alone[start : start + LEAF], level))


def _distances(points: np.ndarray, squares: np.ndarray, rows: np.ndarray, centers) -> np.ndarray:
    """Distances of ``rows`` from one centre or each of several; exact below 2**53."""
    inner = points[centers] @ points[rows].T
    return np.sqrt(np.maximum(squares[rows] + squares[centers, None] - 2 * inner, 0))


def tree(points: np.ndarray) -> Node:
    squares = (points**2).sum(axis=1)
    return Node(points, squares, np.arange(len(points)), float(np.ldexp(1.0, 64)))


class _Best:
    """The k best rows of each query so far, ties to the smaller id."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.scores = np.full((queries, k), -np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)

    def worst(self, rows: np.ndarray) -> float:
        return float(self.scores[rows, -1].min())

    def take(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``ids`` ascend, so among equal scores the first column wins."""
        if scores.shape[1] > self.k:
            limit = -np.partition(-scores, self.k - 1, axis=1)[:, self.k - 1 : self.k]
            row, column = np.nonzero(scores >= limit)
            order = np.lexsort((column, -scores[row, column], row))
            row, column = row[order], column[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            column = column[place < self.k].reshape(len(scores), self.k)
            scores, ids = np.take_along_axis(scores, column, 1), ids[column]
        else:
            ids = np.broadcast_to(ids, scores.shape)
        all_scores = np.concatenate([self.scores[rows], scores], axis=1)
        all_ids = np.concatenate([self.ids[rows], ids], axis=1)
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(all_scores, order, 1)
        self.ids[rows] = np.take_along_axis(all_ids, order, 1)


def search(
    queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, root: Node, best: _Best
) -> None:
    """Add the block ``data``, indexed by ``root``, to the queries' best rows."""

    def bound(q: Node, r: Node) -> float:
        # Sums of integers below 2**53 are exact; radii are rounded up a little.
        reach = q.radius * r.norm + r.radius * q.norm + q.radius * r.radius
        return float(q.center @ r.center) + reach * (1 + 1e-9) + 1e-6

    top = tree(queries)
    pairs, turn = [(-bound(top, root), 0, top, root)], 0
    while pairs:
        high, _, q, r = heapq.heappop(pairs)
        if -high < best.worst(q.rows):
            continue
        if not q.children and not r.children:
            scores = queries[q.rows] @ data[r.rows].T
            scores[query_ids[q.rows][:, None] == ids[r.rows]] = -np.inf
            best.take(q.rows, scores, ids[r.rows])
            continue
        # The wider node opens first.
        if r.children and (not q.children or r.radius >= q.radius):
            opened = [(q, c) for c in r.children]
        else:
            opened = [(c, r) for c in q.children]
        for q, r in opened:
            turn += 1
            heapq.heappush(pairs, (-bound(q, r), turn, q, r))


def _run(k: int):
    """Rows of a block come first, then the query groups, each in one run."""

    def found(query_rows: list, block: list) -> pa.RecordBatch | None:
        ids = np.concatenate([i for i, _ in block])
        data = np.concatenate([v for _, v in block])
        query_ids = np.concatenate([i for i, _ in query_rows])
        queries = np.concatenate([v for _, v in query_rows])
        if np.abs(queries).max() * np.abs(data).max() * data.shape[1] >= EXACT:
            return _beyond(queries, query_ids, data, ids, k)
        if not roots:
            roots.append(tree(data))
        best = _Best(len(queries), min(k, len(ids)))
        search(queries, query_ids, data, ids, roots[0], best)
        real = np.isfinite(best.scores)
        owner = np.broadcast_to(query_ids[:, None], real.shape)
        return _found(owner[real].tolist(), best.ids[real].tolist(), [int(s) for s in best.scores[real]])

    roots: list[Node] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block, waiting = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)])
            ids = batch.column(3).to_numpy()
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            edges = [0, *edges.tolist(), len(ids)]
            for start, end in zip(edges, edges[1:]):
                here = tuple(keys[:, start].tolist())
                own = batch.column(4).slice(start, end - start)
                rows = ids[start:end], own.flatten().to_numpy().reshape(end - start, -1)
                if here != at:
                    if waiting and block:
                        yield found(waiting, block)
                    waiting = []
                    if at is None or here[:2] != at[:2]:
                        block = []
                        roots.clear()
                    at = here
                (block if here[2] < 0 else waiting).append(rows)
        if waiting and block:
            yield found(waiting, block)

    return run


def _found(query_ids: list, ids: list, scores: list[int]) -> pa.RecordBatch:
    fits = [-(1 << 63) <= s < 1 << 63 for s in scores]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(query_ids, pa.int64()),
            pa.array(ids, pa.int64()),
            pa.array([s if fit else None for s, fit in zip(scores, fits)], pa.int64()),
            pa.array([0 if fit else (1 if s > 0 else -1) for s, fit in zip(scores, fits)], pa.int32()),
            pa.array([None if fit else _digits(s) for s, fit in zip(scores, fits)], pa.string()),
        ],
        names=["query_id", "vec_id", "score", "beyond", "digits"],
    )


def _digits(score: int) -> str:
    """Text that sorts like numbers of one sign."""
    shown = f"{len(str(abs(score))):05d}{abs(score)}"
    return shown if score > 0 else shown.translate(str.maketrans("0123456789", "9876543210"))


def _beyond(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int) -> pa.RecordBatch:
    """The same where doubles could not hold the sums.

    Small vectors meet by trees as ever. Of the others each pair is made exactly.
    """
    few, usual = np.abs(queries).max(axis=1) < SMALL, np.abs(data).max(axis=1) < SMALL
    scores: dict[int, list[tuple[int, int]]] = {i: [] for i in range(len(queries))}
    if few.any() and usual.any():
        best = _Best(int(few.sum()), min(k, int(usual.sum())))
        search(queries[few], query_ids[few], data[usual], ids[usual], tree(data[usual]), best)
        for i, own_scores, own_ids in zip(np.flatnonzero(few).tolist(), best.scores, best.ids):
            scores[i] += [(-int(s), int(j)) for s, j in zip(own_scores, own_ids) if np.isfinite(s)]
    numbers = [[int(x) for x in row] for row in data.tolist()]
    for i, query in enumerate(queries.tolist()):
        whole = [int(x) for x in query]
        others = range(len(data)) if not few[i] else np.flatnonzero(~usual).tolist()
        scores[i] += [
            (-sum(a * b for a, b in zip(whole, numbers[j])), int(ids[j])) for j in others if ids[j] != query_ids[i]
        ]
    rows = [(int(query_ids[i]), j, -s) for i, own in scores.items() for s, j in heapq.nsmallest(k, own)]
    return _found(*map(list, zip(*rows))) if rows else _found([], [], [])


def whole_numbers(vectors: DataFrame, column: str = "embedding", scale: int = 256) -> DataFrame:
    """``vec_id, v``: components times ``scale``, rounded down; one row per id.

    Rows without id, and vectors that are null, empty or hold a component that is
    null or non-finite, also after scaling, take no part. The numbers are kept as
    doubles, which hold every such component exactly. Of several vectors with an id the
    smallest counts, so that repeated rows count once.
    """
    def whole(x):
        # From 2**53 on every double is a whole number.
        y = x.cast("double") * scale
        return F.when(F.abs(y) < float(1 << 60), F.floor(y).cast("double")).otherwise(y)

    scaled = F.transform(column, whole)
    usable = F.coalesce(
        (F.size(column) > 0)
        & F.forall(
            column,
            lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float("inf")),
        ),
        F.lit(False),
    )
    return (
        vectors.filter(F.col("vec_id").isNotNull() & usable)
        .select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v"))
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
    )


def top_k(queries: DataFrame, data: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` rows of largest inner product.

    Both inputs are ``(vec_id, v)`` of whole numbers. A query is compared with the
    vectors of its length. Its own id is no result; ties go to the smaller id; with
    fewer rows all are returned. A score beyond a long is null, in its rank. The
    queries go to every block once.
    """
    prepare(data.sparkSession)
    blocks = max(1, -(-data.count() // block_rows))
    groups = max(1, -(-queries.count() // GROUP_ROWS))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    group = F.pmod(F.xxhash64("vec_id"), F.lit(groups))
    width = F.size("v").cast("long").alias("width")
    stored = data.select(width, block.alias("block"), F.lit(-1).cast("long").alias("part"), "vec_id", "v")
    asked = queries.select(
        width,
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        group.alias("part"),
        "vec_id",
        "v",
    )
    found = (
        stored.union(asked)
        .repartition("width", "block")
        .sortWithinPartitions("width", "block", "part", "vec_id")
        .mapInArrow(_run(k), FOUND)
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("beyond"), F.desc("score"), F.desc("digits"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
