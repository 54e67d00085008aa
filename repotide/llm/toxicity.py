"""Toxicity by a linear classifier over character n-grams.

The features are the distinct n-grams of three to five characters of a whole
text, hashed to 2**18 places. Each is scaled by its naive Bayes log-count ratio
before a logistic regression learns the weights, so that an n-gram seen in both
classes alike starts out, and mostly stays, without effect.

The model is fitted on at most ``max_rows`` labelled rows (the documented bound;
the rows with the smallest hash of their id, hence the same ones at each run)
and on no others; scoring reads every text whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import add_column, by_batch, materialize, prepare, unused

HASH_BITS = 18
SIZES = (3, 4, 5)
MAX_ROWS = 8_000
# Log-count ratio, weighted by how often an n-gram stands in either class, that makes it a feature.
LEAST_STRENGTH = 0.2
THRESHOLD = 0.7
SMOOTHING = 1.0
PENALTY = 1e-4
STEPS = 400


def grams(text: str | None) -> np.ndarray:
    """Hashed n-grams of a text, with repeats; white space counts as one blank."""
    plain = " ".join((text or "").lower().split())
    codes = np.frombuffer(f" {plain} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    found, h = [], codes
    for size in range(2, max(SIZES) + 1):
        if len(codes) < size:
            break
        h = h[: len(codes) - size + 1] * np.uint32(0x01000193) + codes[size - 1 :]
        if size in SIZES:
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1 + 2 * size)
            found.append(mixed >> np.uint32(32 - HASH_BITS))
    return np.concatenate(found) if found else np.empty(0, np.uint32)


@dataclass(frozen=True)
class Model:
    """Weight per hashed n-gram (zero if not selected), and the offset."""

    weights: np.ndarray
    offset: float

    def score(self, text: str | None) -> float:
        """Probability of the toxic class, 0 to 1."""
        found = grams(text)
        hits = found[self.weights[found] != 0]
        margin = self.offset + float(self.weights[np.unique(hits)].sum())
        return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


def _count(batches):
    places = 1 << HASH_BITS
    counts = np.zeros((2, places), np.int64)
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[toxic, np.unique(grams(text))] += 1
    seen = np.flatnonzero(counts.sum(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen, pa.int32()), pa.array(counts[1, seen]), pa.array(counts[0, seen])],
        names=["gram", "toxic", "clean"],
    )


def _descend(
    active: np.ndarray, sizes: np.ndarray, y: np.ndarray, ratios: np.ndarray
) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated descent.

    ``active`` lists the features of one row after the other, ``sizes`` how many
    each has. The step is the inverse of a bound of the curvature, a quarter of
    the mean squared row norm. Returns weights per active feature, ratios included.
    """
    owner = np.repeat(np.arange(len(y), dtype=np.int32), sizes)
    values = ratios[active]
    step = 4 / ((values**2).sum() / len(y) + 1)
    weights, offset = np.zeros(len(ratios)), 0.0
    ahead, ahead_offset = weights, offset
    for turn in range(STEPS):
        margin = ahead_offset + np.bincount(owner, (ratios * ahead)[active], minlength=len(y))
        off = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y
        slope = ratios * np.bincount(active, off[owner], minlength=len(ratios)) / len(y)
        new = ahead - step * (slope + PENALTY * ahead)
        new_offset = ahead_offset - step * off.mean()
        pull = turn / (turn + 3)
        ahead = new + pull * (new - weights)
        ahead_offset = new_offset + pull * (new_offset - offset)
        weights, offset = new, new_offset
    return weights * ratios, offset


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learnt: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, least_strength: float = LEAST_STRENGTH
) -> Model:
    """Learn from ``labels (doc_id, toxic)`` outside the held-out part.

    Null labels and ids are left out; of several labels for a document the
    toxic one counts. Without rows of both classes every score is the share of
    toxic rows (one half without any).
    """
    prepare(docs.sparkSession)
    chosen = (
        labels.select(F.col("doc_id").alias("labelled_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("labelled_id is not null and toxic in (0, 1)")
        .filter(~held_out("labelled_id"))
        .groupBy("labelled_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("labelled_id"), "labelled_id")
        .limit(max_rows)
    )
    # At most max_rows pairs of numbers are broadcast, so no text is shuffled.
    sample = materialize(
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id"))
        .groupBy("doc_id")
        # Of rows that share an id one is learnt, so the bound holds for rows too.
        .agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
        .select("text", "toxic", "doc_id"),
        "labelled",
    )
    sizes = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        share = (toxic + 0.5) / (clean + toxic + 1)
        return Model(np.zeros(1 << HASH_BITS), float(np.log(share / (1 - share))))
    p = (F.col("toxic") + SMOOTHING) / (toxic + 2 * SMOOTHING)
    q = (F.col("clean") + SMOOTHING) / (clean + 2 * SMOOTHING)
    ratio = F.log(p) - F.log(q)
    best = (
        sample.select("text", "toxic")
        .mapInArrow(_count, "gram int, toxic long, clean long")
        .groupBy("gram")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .select("gram", ratio.alias("ratio"), (F.abs(ratio) * F.sqrt(p + q)).alias("strength"))
        .filter(F.col("strength") >= least_strength)
        .orderBy("gram")
        .toPandas()
    )
    slots = np.full(1 << HASH_BITS, -1, np.int32)
    slots[best["gram"].to_numpy()] = np.arange(len(best), dtype=np.int32)

    def active(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [slots[np.unique(grams(t))] for t in batch.column(0).to_pylist()]
        rows = [r[r >= 0] for r in rows]
        return pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.list_(pa.int32())), *batch.columns[1:]],
            names=["active", "toxic", "doc_id"],
        )

    learnt = sample.mapInArrow(by_batch(active), "active array<int>, toxic int, doc_id long")
    learnt = learnt.toArrow().sort_by("doc_id").combine_chunks()
    lists = learnt["active"].combine_chunks()
    weights, offset = _descend(
        lists.flatten().to_numpy(),
        lists.value_lengths().to_numpy(),
        learnt["toxic"].to_numpy().astype(np.float64),
        best["ratio"].to_numpy(),
    )
    full = np.zeros(1 << HASH_BITS)
    full[best["gram"].to_numpy()] = weights
    return Model(full, offset)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with ``score``; null and empty texts get the offset's score."""

    def values(texts: list) -> pa.Array:
        return pa.array([model.score(t) for t in texts], pa.float64())

    return add_column(docs, name, "double", values)


def predicted(threshold: float = THRESHOLD) -> F.Column:
    return (F.col("score") >= threshold).cast("int")


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` scored below ``threshold``, with their own columns."""
    name = unused(docs.columns, "score")
    return score(docs, model, name).filter(F.col(name) < threshold).drop(name)
