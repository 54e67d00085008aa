"""Near-duplicate embeddings by NN-descent.

Equal vectors of a label are one node. Tables of random hyperplanes give every
node a first list of neighbours: rows on the same side of all planes of a table
are compared. There are as many tables as a pair at the threshold needs to meet
in one of them but for :data:`MISSED`. Each step of the descent then joins the
neighbours of every node with one another, forwards and backwards, and keeps each
node's best. A list whose last entry is still at the threshold is saturated: it
is enlarged in the next step, see :data:`ENLARGE`.

Lists are bounded, links are not. Whatever pair at the threshold any comparison
meets is kept, in or out of a list: a chunk of rows gives a spanning forest of its
links, so what is kept grows with the rows. The links make groups, and a group is
completed exactly: all its block pairs are compared, which gives the link counts.
So a link can only be missed between two groups of which no pair ever met.

:func:`audit` measures that against brute force, on a sample that grows with the
table and has linked nodes, nodes with a neighbour just below the threshold, and
others. While its mean recall is too low the descent goes on with fresh tables;
at last the labels are compared as a whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repotide.llm.common import chunks, materialize, prepare
from repotide.llm.graph import components

# Rows of one matrix product, and how many times as many a block of a large group has.
BLOCK = 1024
WIDER = 16
FOUND = "u long, v long, links long"

NEIGHBOURS = 8
ENLARGE = 4
# Rows compared as one chunk, and what a bucket holds on average.
CHUNK, BUCKET = 256, 128
MISSED = 0.002
STEPS = 3
SETTLED, NEAR = 0.02, 0.05
RECALL = 0.99
PASSES = 3
# Sampled nodes: this many for each square root of the nodes, within bounds.
AUDIT_SHARE, AUDIT_LEAST, AUDIT_MOST = 4, 200, 2000
BELOW = 0.02
MET = "node long, nbr long, sim double, link boolean"


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of a symmetric matrix, breadth first."""
    unseen = linked.any(axis=1)
    sources, ends = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while unseen.any():
        at = np.array([unseen.argmax()])
        unseen[at] = False
        while len(at):
            steps = linked[at] & unseen
            reached = np.flatnonzero(steps.any(axis=0))
            sources.append(at[steps[:, reached].argmax(axis=0)])
            ends.append(reached)
            unseen[reached] = False
            at = reached
    return np.concatenate(sources), np.concatenate(ends)


def _met(mine: pa.RecordBatch, other: pa.RecordBatch, threshold: float) -> pa.RecordBatch:
    """Link counts, with copies, and a forest (no count) of two different pieces, or of one with itself."""
    same = mine is other
    ids, other_ids = mine.column(4).to_numpy(), other.column(4).to_numpy()
    units = [t.column(5).flatten().to_numpy().reshape(t.num_rows, -1) for t in (mine, other)]
    linked = units[0] @ units[1].T >= threshold
    if same:
        linked &= ids[:, None] != ids
    counts = linked @ other.column(6).to_numpy()
    if same:
        both, whole = ids, linked
    else:
        both = np.concatenate([ids, other_ids])
        counts = np.concatenate([counts, mine.column(6).to_numpy() @ linked])
        whole = np.zeros((len(both), len(both)), bool)
        if linked.any():
            whole[: len(ids), len(ids) :] = linked
            whole[len(ids) :, : len(ids)] = linked.T
    some = np.flatnonzero(counts)
    source, end = _forest(whole)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([both[some], both[source]])),
            pa.array([None] * len(some) + both[end].tolist(), pa.int64()),
            pa.array(np.concatenate([counts[some], np.zeros(len(source), np.int64)])),
        ],
        names=["u", "v", "links"],
    )


def _compare(threshold: float):
    """Every pair of rows of each block pair, piece by piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, left, right = None, [], []

        def met() -> Iterator[pa.RecordBatch]:
            for i, mine in enumerate(left):
                for other in left[i:] if at[1] == at[2] else right:
                    yield _met(mine, other, threshold)

        for chunk in chunks(batches, 4, BLOCK):
            here = tuple(chunk.column(i)[0].as_py() for i in range(3))
            if here != at:
                yield from met()
                at, left, right = here, [], []
            (right if chunk.column(3)[0].as_py() else left).append(chunk)
        yield from met()

    return run


def _all_links(nodes: DataFrame, threshold: float) -> DataFrame:
    """``u, v, links``: counts of ``u`` with a null ``v``, and links that join all that is linked.

    Up to some thousand rows of a label a block is one piece; with more rows it
    gets wider, as each row travels once for each block of its label.
    """
    wide = F.least(F.lit(WIDER), F.ceil(F.count("*") / (WIDER * BLOCK)))
    sizes = nodes.groupBy("label").agg(F.ceil(F.count("*") / (wide * BLOCK)).cast("long").alias("blocks"))
    placed = nodes.join(sizes, "label").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    return (
        placed.select("label", "block", every.alias("met"), "node", "unit", "copies")
        .select(
            "label",
            F.least("block", "met").alias("i"),
            F.greatest("block", "met").alias("j"),
            (F.col("block") > F.col("met")).cast("int").alias("side"),
            "node",
            "unit",
            "copies",
        )
        .repartition("label", "i", "j")
        .sortWithinPartitions("label", "i", "j", "side", "node")
        .mapInArrow(_compare(threshold), FOUND)
    )


# --- the descent


def tables_for(bits: int, threshold: float, missed: float = MISSED) -> int:
    """Tables of so many hyperplanes that a pair at the threshold shares a bucket of one."""
    if not bits:
        return 1
    together = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return max(2, math.ceil(math.log(missed) / math.log(1 - together)))


def _meet(threshold: float):
    """Members of each chunk compared: what beats a member's list, and links as a forest.

    Columns: label, width, a, b (the chunk's group), node, floor, keep, unit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, 4, CHUNK):
            if chunk.num_rows < 2:
                continue
            ids, floor, keep = (chunk.column(i).to_numpy() for i in (4, 5, 6))
            units = chunk.column(7).flatten().to_numpy().reshape(len(ids), -1)
            sims = units @ units.T
            sims[ids[:, None] == ids] = -2
            source, end = _forest(sims >= threshold)
            most = min(int(keep.max()), len(ids) - 1)
            best = np.argpartition(-sims, most - 1, axis=1)[:, :most] if most < len(ids) - 1 else np.argsort(-sims, axis=1)[:, :most]
            row = np.repeat(np.arange(len(ids)), most)
            column = best.ravel()
            near = sims[row, column]
            better = (near > floor[row]) & (near > -2)
            row, column, near = row[better], column[better], near[better]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([ids[row], ids[source]])),
                    pa.array(np.concatenate([ids[column], ids[end]])),
                    pa.array(np.concatenate([near, sims[source, end]])),
                    pa.array(np.arange(len(row) + len(source)) >= len(row)),
                ],
                names=["node", "nbr", "sim", "link"],
            )

    return run


GROUP = ["label", "width", "a", "b"]


def _compared(members: DataFrame, threshold: float, label: str, place: str) -> DataFrame:
    """``members`` of the groups :data:`GROUP`, compared inside them in the order of ``place``."""
    sorted_ = members.repartition(*GROUP).sortWithinPartitions(*GROUP, place, "node")
    return materialize(
        sorted_.select(*GROUP, "node", "floor", "keep", "unit").mapInArrow(_meet(threshold), MET), label
    )


def _first(nodes: DataFrame, threshold: float, keep: int, seed: int) -> DataFrame:
    """Comparisons among rows on the same side of all of a table's hyperplanes."""
    sizes = nodes.groupBy("label", "width").agg(F.count("*").alias("n"))
    bits = F.when(F.col("n") <= CHUNK, 0).otherwise(F.ceil(F.log2(F.col("n") / BUCKET))).cast("int")
    sized = sizes.select("label", "width", bits.alias("bits"))
    most = sized.agg(F.max("bits")).first()[0] or 0
    counts = [tables_for(b, threshold) for b in range(most + 1)]

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            units = batch.column(4)
            kinds = np.stack([batch.column(1).to_numpy(), batch.column(2).to_numpy()])
            for width, own in np.unique(kinds, axis=1).T.tolist():
                rows = np.flatnonzero((kinds[0] == width) & (kinds[1] == own))
                part = batch.take(pa.array(rows))
                x = part.column(4).flatten().to_numpy().reshape(-1, width)
                for table in range(counts[own]):
                    if (width, table) not in drawn:
                        rng = np.random.default_rng([seed, width, table])
                        drawn[width, table] = rng.standard_normal((most + 1, width))
                    # One plane more orders the bucket, so that its chunks differ by table.
                    seen = x @ drawn[width, table][: own + 1].T
                    code = (seen[:, :own] > 0) @ (1 << np.arange(own, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array(np.full(len(rows), table, np.int64)),
                         pa.array(code.astype(np.int64)), part.column(3), pa.array(seen[:, own]), part.column(4)],
                        names=["label", "width", "a", "b", "node", "place", "unit"],
                    )

    coded = (
        nodes.join(sized, ["label", "width"])
        .select("label", "width", "bits", "node", "unit")
        .mapInArrow(sides, "label long, width int, a long, b long, node long, place double, unit array<double>")
        .select("*", F.lit(-2.0).alias("floor"), F.lit(keep).alias("keep"))
    )
    return _compared(coded, threshold, "first", "place")


def _best(pairs: DataFrame, keeps: DataFrame, keep: int) -> DataFrame:
    """The best neighbours of each node, as many as its list holds."""
    order = Window.partitionBy("node").orderBy(F.desc("sim"), "nbr")
    distinct = pairs.groupBy("node", "nbr").agg(F.max("sim").alias("sim"))
    ranked = distinct.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= keep * ENLARGE)
    held = ranked.join(keeps, "node", "left")
    return held.filter(F.col("_rank") <= F.coalesce("keep", F.lit(keep))).select("node", "nbr", "sim")


def _keeps(lists: DataFrame, threshold: float, keep: int) -> DataFrame:
    """How long the lists are that may be longer: those whose last entry is at the threshold."""
    last = lists.groupBy("node").agg(F.count("*").alias("n"), F.min("sim").alias("least"))
    return last.filter((F.col("n") >= keep) & (F.col("least") >= threshold)).select(
        "node", F.lit(keep * ENLARGE).alias("keep")
    )


def _step(lists: DataFrame, keeps: DataFrame, nodes: DataFrame, threshold: float, keep: int, turn: int) -> DataFrame:
    """Comparisons among each node's neighbours; large neighbourhoods by parts."""
    full = lists.groupBy("node").agg(F.count("*").alias("n"), F.min("sim").alias("least")).join(keeps, "node", "left")
    own = F.coalesce("keep", F.lit(keep))
    known = nodes.join(full, "node", "left").select(
        "label", "width", "node", "unit", own.alias("keep"),
        F.when(F.col("n") >= own, F.col("least")).otherwise(F.lit(-2.0)).alias("floor"),
    )
    around = (
        lists.select(F.col("node").alias("a"), F.col("nbr").alias("node"))
        .union(lists.select(F.col("nbr").alias("a"), "node"))
        .union(nodes.select(F.col("node").alias("a"), "node"))
        .distinct()
    )
    sizes = around.groupBy("a").agg(F.count("*").alias("size"))
    part = F.pmod(F.xxhash64("node", F.lit(turn)), F.ceil(F.col("size") / CHUNK))
    members = (
        around.join(sizes, "a")
        .select("a", part.cast("long").alias("b"), "node")
        .join(known, "node")
        .withColumn("place", F.xxhash64("node", F.lit(turn)))
    )
    return _compared(members, threshold, "step", "place")


def _descend(
    nodes: DataFrame, threshold: float, keep: int, seed: int, lists: DataFrame | None
) -> tuple[DataFrame, list[DataFrame]]:
    """Lists after a descent from fresh tables, and the links that all its comparisons met."""
    spark = nodes.sparkSession
    none = spark.createDataFrame([], "node long, keep int")
    found = [_first(nodes, threshold, keep, seed)]
    start = found[0].select("node", "nbr", "sim")
    lists = materialize(_best(start if lists is None else start.union(lists), none, keep), "lists")
    for turn in range(STEPS):
        keeps = materialize(_keeps(lists, threshold, keep), "keeps")
        found.append(_step(lists, keeps, nodes, threshold, keep, seed * STEPS + turn))
        better = found[-1].filter("not link").select("node", "nbr", "sim")
        before, lists = lists, materialize(_best(lists.union(better), keeps, keep), "lists")
        # What happens far below the threshold makes no link.
        near = lists.filter(F.col("sim") >= threshold - NEAR)
        if near.join(before, ["node", "nbr"], "left_anti").count() <= SETTLED * near.count():
            break
    at = [f.filter("link").select(F.col("node").alias("u"), F.col("nbr").alias("v")) for f in found]
    return lists, at


def audit(
    nodes: DataFrame, lists: DataFrame, links: DataFrame, threshold: float, seed: int = 0
) -> float | None:
    """Mean share of its true links that a sampled node has; null if none has any.

    A third of the sample each are nodes with links, nodes without whose best
    neighbour is just below the threshold, and others, as far as there are any.
    All links of a sampled node are looked for among all nodes of its label.
    """
    count = nodes.count()
    rows = int(min(AUDIT_MOST, max(AUDIT_LEAST, AUDIT_SHARE * math.sqrt(count))))
    nearest = lists.groupBy("node").agg(F.max("sim").alias("best"))
    kind = F.when(F.col("links") > 0, 0).when(F.col("best") >= threshold - BELOW, 1).otherwise(2)
    known = nodes.join(links, "node", "left").join(nearest, "node", "left").select(
        "node", "label", "width", "unit", F.coalesce("links", F.lit(0)).alias("links"), kind.alias("kind")
    )
    drawn = Window.partitionBy("kind").orderBy(F.xxhash64("node", F.lit(seed)), "node")
    some = (
        known.withColumn("_rank", F.row_number().over(drawn))
        .filter(F.col("_rank") <= max(rows // 3, 1))
        .select("node", "label", "width", "unit", "links")
        .toArrow()
    )
    if not some.num_rows:
        return None
    units = some["unit"].to_pylist()
    ids, labels, widths, told = (some[c].to_numpy() for c in ("node", "label", "width", "links"))
    by_width = {int(w): (np.flatnonzero(widths == w), np.array([u for u in units if len(u) == w])) for w in np.unique(widths)}

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            width = batch.column(2).to_numpy()
            for w, (rows_, mine) in by_width.items():
                own = batch.take(pa.array(np.flatnonzero(width == w)))
                if own.num_rows:
                    theirs = own.column(3).flatten().to_numpy().reshape(-1, w)
                    linked = mine @ theirs.T >= threshold
                    linked &= labels[rows_, None] == own.column(1).to_numpy()
                    linked &= ids[rows_, None] != own.column(0).to_numpy()
                    total[rows_] += linked @ own.column(4).to_numpy()
        some_ = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some_), pa.array(total[some_])], names=["at", "links"])

    counted = nodes.select("node", "label", "width", "unit", "copies").mapInArrow(tally, "at long, links long")
    true = np.zeros(len(ids), np.int64)
    for at, n in counted.groupBy("at").agg(F.sum("links")).collect():
        true[at] = n
    having = true > 0
    return float((told[having] / true[having]).mean()) if having.any() else None


def _normalized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors, and digests that tell equal vectors of a label; null where unusable."""
    for batch in batches:
        if not batch.num_rows:
            continue
        labels, lists = batch.column(1).to_pylist(), batch.column(2)
        units: list[np.ndarray | None] = []
        keys: list[bytes | None] = []
        for label, row in zip(labels, lists):
            x = np.array([], float) if label is None or not row.is_valid else row.values.to_numpy(zero_copy_only=False)
            unit = key = None
            if len(x) and np.isfinite(x).all() and x.any():
                # Scaled first, so that no square overflows or vanishes.
                x = x / np.abs(x).max()
                unit = x / np.sqrt((x * x).sum()) + 0.0
                key = blake2b(unit.tobytes(), key=str(label).encode(), digest_size=16).digest()
            units.append(unit)
            keys.append(key)
        doubles = pa.list_(pa.float64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(units, doubles)],
            names=["vec_id", "label", "key", "unit"],
        )


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, neighbours: int = NEIGHBOURS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``; other columns are
    ignored. Rows of equal labels and lengths are linked at a cosine of
    ``threshold`` or more; vectors of different lengths are not. A null label, and a vector that is null, empty, zero
    or holds a null or non-finite component, links with nothing. Repeated rows
    link with each other. A row without id names no component: it is kept only
    if none of its component has one.
    """
    found = _groups(vectors, threshold, neighbours)
    component = F.coalesce("component_id", "vec_id")
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"),
    )


def node_table(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows ``vec_id, key``, and the nodes: different unit vectors of a label, numbered."""
    prepare(vectors.sparkSession)
    own = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    )
    rows = materialize(
        own.mapInArrow(_normalized, "vec_id long, label long, key binary, unit array<double>"), "rows"
    )
    # The number is written with the row, so it stays whatever is lost.
    nodes = materialize(
        rows.filter("key is not null")
        .groupBy("key")
        .agg(
            F.first("label").alias("label"),
            F.first("unit").alias("unit"),
            F.count("*").alias("copies"),
            F.min("vec_id").alias("first_id"),
        )
        .select(
            F.monotonically_increasing_id().alias("node"), "key", "label", F.size("unit").alias("width"),
            "unit", "copies", "first_id",
        ),
        "nodes",
    )
    return rows.select("vec_id", "key"), nodes


def linked(nodes: DataFrame, threshold: float, neighbours: int) -> tuple[DataFrame, DataFrame, float | None]:
    """``node, root`` of linked nodes, ``node, links`` with copies, and the audited recall."""
    lists, met, recall, keep = None, [], None, neighbours
    for turn in range(PASSES):
        lists, more = _descend(nodes, threshold, keep, turn, lists)
        met += more
        edges = met[0]
        for other in met[1:]:
            edges = edges.union(other)
        merged = materialize(components(edges), "merged")
        # A group is completed as if it were a label of its own.
        grouped = nodes.join(merged, "node").select(F.col("root").alias("label"), "node", "unit", "copies")
        inside = materialize(_all_links(grouped, threshold), "links")
        links = inside.filter("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
        recall = audit(nodes, lists, links, threshold, turn)
        if recall is None or recall >= RECALL:
            return merged, links, recall
        keep *= 2
    # Not found by search: every pair of a label and width.
    kinds = nodes.select(F.col("label").alias("own"), "width").distinct()
    numbered = materialize(kinds.select("*", F.monotonically_increasing_id().alias("label")), "kinds")
    whole = nodes.withColumnRenamed("label", "own").join(numbered, ["own", "width"])
    inside = materialize(_all_links(whole.select("label", "node", "unit", "copies"), threshold), "links")
    links = inside.filter("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    return components(inside.filter("v is not null").select("u", "v")), links, 1.0


def _groups(vectors: DataFrame, threshold: float, neighbours: int) -> DataFrame:
    """``vec_id, n_links, component_id``; the last two are null for what links with nothing usable."""
    rows, nodes = node_table(vectors)
    merged, links, _ = linked(nodes, threshold, neighbours)
    smallest = (
        nodes.join(merged, "node").groupBy("root").agg(F.min("first_id").alias("component_id"))
    )
    found = nodes.select("node", "key", "copies", "first_id").join(merged, "node", "left").join(smallest, "root", "left").join(
        links, "node", "left"
    ).select(
        "key",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "first_id").alias("component_id"),
    )
    return rows.join(found, "key", "left").select("vec_id", "n_links", "component_id")
