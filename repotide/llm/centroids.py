"""Centroid clustering over zone maps in the order of a space-filling curve.

The vectors are sorted along a Hilbert curve through their leading principal
axes and cut into blocks, each with the least and greatest value of every
component: its box. In a round, the box tells which centroids can be nearest to
any vector of the block. A centroid is out if its least distance to the box
exceeds the greatest distance of another, or if another is nearer at every point
of the box: the difference of two squared distances is linear, so its bound is
reached in a corner. The vectors of the block are compared with the rest exactly.

The axes and the range of the curve come from a bounded sample; they only decide
which vectors share a block, never a result. Blocks are written once and read in
every round without a shuffle; a task answers with one sum per centroid and
component. All arithmetic is on whole numbers. Components too large for it in
machine words are carried as Python's numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import materialize, prepare

CENTROIDS = 16
ROUNDS = 3
WIDTH = 64
SCALE = 64
BLOCK = 512
# Vectors that the curve is fitted on, the first by hash.
SAMPLE = 4096
AXES, BITS = 8, 7
# Components below these keep squared distances exact in 64-bit integers, and in doubles.
SMALL, TINY = 1 << 26, 1 << 22
LIMB = 31
LONG = 1 << 63

BLOCKS = "vec_ids array<long>, small boolean, data binary, low array<long>, high array<long>"
ASSIGNED = "vec_id long, cluster int, distance long"
SUMS = "cluster int, part int, limb int, value long"


def whole(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)``, as 64-bit integers, or as Python's where those are too short."""
    scaled = np.floor(x * scale)
    if scaled.size and np.abs(scaled).max() >= 2.0**62:
        return np.array([[int(v) for v in row] for row in scaled.tolist()], object).reshape(scaled.shape)
    return scaled.astype(np.int64)


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on a Hilbert curve of points with whole coordinates of ``bits`` bits.

    Skilling's transform, on all points at once.
    """
    x = [column.astype(np.int64) for column in points.T]
    top = 1 << (bits - 1)
    bit = top
    while bit > 1:
        below = bit - 1
        for i in range(len(x)):
            inverted = (x[i] & bit) != 0
            exchanged = np.where(inverted, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(inverted, x[0] ^ below, x[0] ^ exchanged)
            x[i] = x[i] ^ exchanged
        bit >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turned = np.zeros_like(x[0])
    bit = top
    while bit > 1:
        turned = np.where(x[-1] & bit, turned ^ (bit - 1), turned)
        bit >>= 1
    place = np.zeros_like(x[0])
    for shift in range(bits - 1, -1, -1):
        for column in x:
            place = place << 1 | (column ^ turned) >> shift & 1
    return place


class Curve:
    """A Hilbert curve through the box of a sample, along its principal axes."""

    def __init__(self, sample: np.ndarray, axes: int = AXES, bits: int = BITS) -> None:
        self.bits = bits
        self.unit = float(np.abs(sample).max()) or 1.0
        scaled = sample / self.unit
        self.middle = scaled.mean(axis=0)
        _, vectors = np.linalg.eigh(np.cov(scaled.T - self.middle[:, None], bias=True).reshape(sample.shape[1], -1))
        self.axes = vectors[:, ::-1][:, :axes]
        seen = (scaled - self.middle) @ self.axes
        self.low = seen.min(axis=0)
        self.span = np.maximum(seen.max(axis=0) - self.low, 1e-300)

    def place(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            seen = (x / self.unit - self.middle) @ self.axes
            cells = np.nan_to_num((seen - self.low) / self.span) * (1 << self.bits)
        return hilbert(np.clip(cells, 0, (1 << self.bits) - 1).astype(np.int64), self.bits)


def box_candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers, ascending, of the centroids that can be nearest to a point of the box."""
    below, above = low - centroids, centroids - high
    gap = np.maximum(np.maximum(below, above), 0)
    far = np.maximum(np.abs(below), np.abs(above))
    least, most = (gap * gap).sum(axis=1), (far * far).sum(axis=1)
    left = np.flatnonzero(least <= most.min())
    own = centroids[left]
    if len(left) == 1:
        return left
    # Greatest surplus of the distance to ``b`` over that to ``a``, over the box.
    apart = own[None, :, :] - own[:, None, :]
    corner = np.where(apart > 0, low, high)
    squares = (own * own).sum(axis=1)
    surplus = squares[None, :] - squares[:, None] - 2 * (apart * corner).sum(axis=2)
    return left[~(surplus < 0).any(axis=1)]


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids, exact."""
    if x.dtype == object or centroids.dtype == object:
        apart = x.astype(object)[:, None, :] - centroids.astype(object)[None, :, :]
        return (apart * apart).sum(axis=2)
    if max(np.abs(x).max(), np.abs(centroids).max()) < TINY:
        left, right = x.astype(np.float64), centroids.astype(np.float64)
        found = (left * left).sum(axis=1)[:, None] - 2 * (left @ right.T) + (right * right).sum(axis=1)
        return found.astype(np.int64)
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def _numbers(rows: list[list[int]]) -> np.ndarray:
    small = all(abs(v) < SMALL for row in rows for v in row)
    return np.array(rows, np.int64 if small else object).reshape(len(rows), -1)


class _Assigner:
    """Nearest centroids of the vectors of a block."""

    def __init__(self, centroids: list[list[int]], width: int, scale: int) -> None:
        self.centroids, self.width, self.scale = _numbers(centroids), width, scale
        self.compared = self.vectors = 0

    def block(self, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The block's vectors, their clusters and their squared distances."""
        if row["small"]:
            x = np.frombuffer(row["data"], "<i4").reshape(-1, self.width).astype(np.int64)
            low, high = np.array(row["low"]), np.array(row["high"])
        else:
            x = whole(np.frombuffer(row["data"], "<f8").reshape(-1, self.width), self.scale).astype(object)
            low, high = x.min(axis=0), x.max(axis=0)
        left = box_candidates(low, high, self.centroids)
        chosen = self.centroids[left]
        if chosen.dtype == object and all(abs(v) < SMALL for v in chosen.ravel()):
            chosen = chosen.astype(np.int64)
        self.compared += len(left) * len(x)
        self.vectors += len(x)
        found = distances(x, chosen)
        nearest = found.argmin(axis=1)
        return x, left[nearest], found[np.arange(len(x)), nearest]


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _limbs(value: int) -> list[int]:
    """``value`` in digits of :data:`LIMB` bits, the sign in the last."""
    digits = []
    while not -(1 << LIMB) <= value < 1 << LIMB:
        digits.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*digits, value]


def _sums(centroids: list[list[int]], width: int, scale: int):
    """Counts (part -1) and component sums of each cluster, in limbs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner = _Assigner(centroids, width, scale)
        counts = [0] * len(centroids)
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in _rows(batch):
                x, cluster, _ = assigner.block(row)
                for c in np.unique(cluster).tolist():
                    own = x[cluster == c]
                    counts[c] += len(own)
                    # A block's sum fits a machine word; what tasks add up may not.
                    totals[c] = totals.get(c, 0) + own.sum(axis=0).astype(object)
        found = []
        for c, total in totals.items():
            for part, value in enumerate([counts[c], *total.tolist()], -1):
                found += [(c, part, limb, digit) for limb, digit in enumerate(_limbs(value))]
        if found:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=["cluster", "part", "limb", "value"]
            )

    return run


def _moved(blocks: DataFrame, centroids: list[list[int]], width: int, scale: int) -> list[list[int]]:
    """The centroids after a round; what reaches the driver is bounded by their number."""
    sums = blocks.mapInArrow(_sums(centroids, width, scale), SUMS).groupBy("cluster", "part", "limb")
    totals: dict[tuple[int, int], int] = {}
    for cluster, part, limb, value in sums.agg(F.sum(F.col("value").cast("decimal(38,0)"))).collect():
        totals[cluster, part] = totals.get((cluster, part), 0) + (int(value) << LIMB * limb)
    moved = []
    for c, old in enumerate(centroids):
        count = totals.get((c, -1), 0)
        moved.append([totals[c, i] // count for i in range(width)] if count else old)
    return moved


def _assign(centroids: list[list[int]], width: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner = _Assigner(centroids, width, scale)
        for batch in batches:
            for row in _rows(batch):
                _, cluster, distance = assigner.block(row)
                fits = [d if d < LONG else None for d in distance.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["vec_ids"], pa.int64()), pa.array(cluster, pa.int32()), pa.array(fits, pa.int64())],
                    names=["vec_id", "cluster", "distance"],
                )

    return run


def _cut(width: int, scale: int):
    """Blocks of rows that come in the order of the curve."""

    def block(vec_ids: list, x: np.ndarray) -> pa.RecordBatch:
        numbers = whole(x, scale)
        small = numbers.dtype != object and int(np.abs(numbers).max()) < SMALL
        data = numbers.astype("<i4").tobytes() if small else x.astype("<f8").tobytes()
        low, high = (numbers.min(axis=0).tolist(), numbers.max(axis=0).tolist()) if small else (None, None)
        longs = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array([vec_ids], longs), pa.array([small]), pa.array([data], pa.binary()),
             pa.array([low], longs), pa.array([high], longs)],
            names=["vec_ids", "small", "data", "low", "high"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        rows = np.empty((0, width))
        for batch in batches:
            if not batch.num_rows:
                continue
            ids += batch.column(0).to_pylist()
            rows = np.concatenate([rows, batch.column(1).flatten().to_numpy().reshape(-1, width)])
            while len(ids) >= BLOCK:
                yield block(ids[:BLOCK], rows[:BLOCK])
                ids, rows = ids[BLOCK:], rows[BLOCK:]
        if ids:
            yield block(ids, rows)

    return run


def _order(salt: str) -> Column:
    return F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)


def _blocks(kept: DataFrame, curve: Curve, width: int, scale: int) -> DataFrame:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy().reshape(-1, width)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(curve.place(x))], names=["vec_id", "v", "place"])

    # Stored, as sampling for the ranges reads the places alone.
    placed = materialize(kept.mapInArrow(place, "vec_id long, v array<double>, place long"), "placed")
    tasks = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = placed.repartitionByRange(tasks, "place", "vec_id").sortWithinPartitions("place", "vec_id")
    return materialize(in_order.select("vec_id", "v").mapInArrow(_cut(width, scale), BLOCKS), "blocks")


def cluster(
    vectors: DataFrame,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    scale: int = SCALE,
    salt: str = "1",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` of every kept row.

    ``vectors`` has ``vec_id`` and ``embedding``; other columns are ignored. Kept
    are embeddings of exactly ``width`` components that are neither null nor
    non-finite, also after scaling; others give no row. A component ``x`` counts
    as ``floor(scale * x)``. The first centroids are the rows with the smallest
    hash of ``salt:vec_id``: ties by the vectors themselves, null ids last, and
    fewer where there are fewer rows. Ties go to the smaller centroid, an empty
    centroid stays. Repeated rows and null ids each give a row. ``centroid`` lists
    the final components, separated by commas. A squared distance, or a sum of
    them, beyond a long is null. Empty input gives no rows.
    """
    spark = vectors.sparkSession
    prepare(spark)
    own = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))
    kept = own.filter((F.size("v") == width) & finite)
    sample = (
        kept.select("vec_id", "v", _order(salt).alias("hash"))
        .orderBy(F.col("hash").asc_nulls_last(), "v")
        .limit(max(SAMPLE, centroids))
        .toArrow()
    )
    outcome = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid string"
    if not sample.num_rows:
        return spark.createDataFrame([], outcome)
    x = np.array(sample["v"].to_pylist(), np.float64)
    means = [[int(v) for v in row] for row in whole(x[:centroids], scale).tolist()]
    blocks = _blocks(kept, Curve(x), width, scale)
    for _ in range(rounds):
        means = _moved(blocks, means, width, scale)
    assigned = materialize(blocks.mapInArrow(_assign(means, width, scale), ASSIGNED), "assigned")

    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {
        r["cluster"]: None if r["lost"] else int(r["total"])
        for r in assigned.groupBy("cluster")
        .agg(exact.alias("total"), F.max(F.col("distance").isNull()).alias("lost"))
        .collect()
    }
    total = None if None in sums.values() else sum(sums.values())

    def fitting(value: int | None) -> int | None:
        return value if value is not None and value < LONG else None

    rows = [
        (c, fitting(sums[c]), fitting(total), ",".join(map(str, means[c])))
        for c in sorted(sums)
    ]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid string")
    # One row per centroid.
    return assigned.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def candidate_share(blocks: DataFrame, means: list[list[int]], width: int = WIDTH, scale: int = SCALE) -> float:
    """Share of all pairs of vector and centroid that the boxes leave to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner = _Assigner(means, width, scale)
        for batch in batches:
            for row in _rows(batch):
                assigner.block(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array([assigner.compared]), pa.array([assigner.vectors])], names=["compared", "vectors"]
        )

    found = blocks.mapInArrow(run, "compared long, vectors long").agg(F.sum("compared"), F.sum("vectors")).first()
    return found[0] / (found[1] * len(means)) if found[1] else 0.0
