"""Near-duplicate documents by HyperMinHash signatures.

A document's set is its distinct five-word shingles, hashed to 64 bits. The top
bits of a hash choose one of 128 buckets; of the smallest hash in each bucket
the signature keeps the number of leading zeros and ten mantissa bits. A bucket
without shingles takes the register of the first filled bucket in an order
fixed for that bucket, so that short texts have full signatures as well.

32 bands of four registers find candidates. At similarity 0.75 a pair shares no
band with a chance of 5e-6, at 0.8 of 6e-8. Candidates first pass the
collision-corrected estimate (six standard deviations of slack), then the exact
comparison of their full sets.

Equal sets are one class before any comparison. In a bucket all classes are
compared with a few of them; links so found merge into components, and only
members of different components meet in the second round, where every such pair
of a bucket is looked at. A group of n copies thus costs some n comparisons, not
n squared, and no link between components is lost.
Within buckets pairs are first told apart by 256 bits of their signatures.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import by_batch, materialize, prepare, unused
from repotide.llm.graph import components

WORDS = 5
BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
BANDS, ROWS = 32, 4
# Expected share of equal registers among disjoint sets of equal size.
COLLISION = 0.169919487 / (1 << MANTISSA_BITS)
# Members of a bucket that all others meet in the first round.
LEADERS = 4
# The last round's finer estimate: one bit for each of 2048 buckets, and whether
# it is filled. Of large sets at the limit 5 in a million fall below 0.685 (4.4
# standard deviations). In a small set one collision weighs much more, so sets of
# up to SMALL shingles bring their hashes, and two such sets are compared exactly.
FINE_BITS = 11
FINE_LEAST = 685
SMALL = 200
FINE = "class_id long, fine array<long>, few array<long>"
# Two bits per register, for comparisons within buckets.
BITS = ("b0", "b1", "b2", "b3")

SIGNATURES = (
    "doc_id long, row_key struct<a:long,b:long>, n_shingles long, class_id long, sig array<int>, "
    "b0 long, b1 long, b2 long, b3 long"
)

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Words(dict):
    """Word hashes, remembered for one batch."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str | None, words: _Words | None = None) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text; empty without words.

    ``bytes.split`` cuts at exactly the white space of the contract, and
    ``bytes.lower`` changes A-Z alone.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    known = _Words() if words is None else words
    hashes = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    count = max(len(tokens) - WORDS + 1, 1)
    width = min(WORDS, len(tokens))
    h = np.full(count, width, np.uint64)
    for i in range(width):
        h = _mix(h * _MULTIPLIER + hashes[i : i + count])
    return np.unique(h)


def _probe_order() -> np.ndarray:
    generator = np.random.default_rng(20)
    return np.stack([generator.permutation(BUCKETS) for _ in range(BUCKETS)])


_PROBES = _probe_order()


def signature(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of sorted distinct hashes (at least one)."""
    buckets = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    filled, first = np.unique(buckets, return_index=True)
    rest = (hashes[first] << np.uint64(BUCKET_BITS)) >> np.uint64(BUCKET_BITS)
    # The fraction lies in [1/2, 1); zero, the smallest rest, has its own code.
    fraction, exponent = np.frexp(rest.astype(np.float64))
    zeros = 64 - BUCKET_BITS - exponent
    mantissa = ((fraction * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.int64)
    code = (zeros << MANTISSA_BITS) | np.clip(mantissa, 0, (1 << MANTISSA_BITS) - 1)
    registers = np.full(BUCKETS, -1, np.int64)
    registers[filled] = code
    if len(filled) < BUCKETS:
        has = registers >= 0
        empty = np.flatnonzero(~has)
        order = _PROBES[empty]
        source = order[np.arange(len(empty)), has[order].argmax(axis=1)]
        registers[empty] = registers[source]
    return registers.astype(np.int32)


def short_bits(registers: np.ndarray) -> np.ndarray:
    """Four 64-bit numbers; equal registers give equal bits, others do half the time."""
    place = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(32)
    mixed = _mix(registers.astype(np.uint64) + place)
    both = np.concatenate([mixed & np.uint64(1), (mixed >> np.uint64(1)) & np.uint64(1)])
    return np.packbits(both.astype(np.uint8)).view(np.int64)


def _class_of(hashes: np.ndarray) -> int | None:
    if not len(hashes):
        return None
    digest = xxhash.xxh3_64_intdigest(hashes.tobytes())
    return digest - (digest >> 63 << 64)


def _sign(batch: pa.RecordBatch) -> pa.RecordBatch:
    words = _Words()
    sizes, classes, signatures = [], [], []
    bits = np.zeros((batch.num_rows, len(BITS)), np.int64)
    for i, text in enumerate(batch.column(2).to_pylist()):
        hashes = shingles(text, words)
        sizes.append(len(hashes))
        classes.append(_class_of(hashes))
        if len(hashes):
            signatures.append(signature(hashes))
            bits[i] = short_bits(signatures[-1])
        else:
            signatures.append(None)
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            batch.column(1),
            pa.array(sizes, pa.int64()),
            pa.array(classes, pa.int64()),
            pa.array(signatures, pa.list_(pa.int32())),
            *(pa.array(column) for column in bits.T.copy()),
        ],
        names=["doc_id", "row_key", "n_shingles", "class_id", "sig", *BITS],
    )


def _row_key() -> Column:
    """Tells rows apart, by 128 bits, that share an id or have none; repeated rows share it."""
    own = F.col("doc_id").cast("long"), F.col("text")
    return F.struct(F.xxhash64(*own).alias("a"), F.xxhash64(F.lit(1), *own).alias("b"))


def sign(docs: DataFrame) -> DataFrame:
    """Set size, class of equal sets, and signature of every document."""
    prepare(docs.sparkSession)
    keyed = docs.select("doc_id", _row_key().alias("row_key"), "text")
    return keyed.mapInArrow(by_batch(_sign), SIGNATURES)


def _estimate(a: str, b: str):
    """Collision-corrected similarity of two signatures with set sizes."""
    equal = F.aggregate(
        F.zip_with(f"{a}.sig", f"{b}.sig", lambda x, y: (x == y).cast("int")),
        F.lit(0),
        lambda total, x: total + x,
    )
    ratio = F.least(f"{a}.n", f"{b}.n") / F.greatest(f"{a}.n", f"{b}.n")
    by_chance = F.lit(COLLISION) * 4 * ratio / ((1 + ratio) * (1 + ratio))
    return (equal / F.lit(float(BUCKETS)) - by_chance) / (1 - by_chance)


def _sizes_allow(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _plausible(a: str, b: str, percent: int):
    """Sizes allow the similarity, and the estimate is within six deviations of it."""
    goal = percent / 100
    slack = 6 * (goal * (1 - goal) / BUCKETS) ** 0.5
    return _sizes_allow(f"{a}.n", f"{b}.n", percent) & (_estimate(a, b) >= goal - slack)


def _bits_allow(mine: str, theirs: str, percent: int):
    """The same by the short bits, of which unequal registers leave half equal."""
    goal = percent / 100
    slack = 6 * ((1 - goal) * (goal + 0.5) / BUCKETS) ** 0.5
    unequal = sum(
        F.bit_count(F.col(mine.format(b)).bitwiseXOR(F.col(theirs.format(b)))) for b in BITS
    )
    return unequal <= int((1 - goal + slack) * BUCKETS)


SETS = "class_id long, hashes binary"


def fine_bits(hashes: np.ndarray) -> np.ndarray:
    """Filled buckets, then one bit of each bucket's smallest hash, as 64-bit numbers."""
    buckets = (hashes >> np.uint64(64 - FINE_BITS)).astype(np.int64)
    filled, first = np.unique(buckets, return_index=True)
    bits = np.zeros(2 << FINE_BITS, np.uint8)
    bits[filled] = 1
    bits[(1 << FINE_BITS) + filled] = _mix(hashes[first]) & np.uint64(1)
    return np.packbits(bits).view(np.int64)


def _class_sets(batch: pa.RecordBatch) -> pa.RecordBatch:
    words = _Words()
    sets = [shingles(text, words) for text in batch.column(0).to_pylist()]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(map(_class_of, sets), pa.int64()),
            pa.array([h.tobytes() for h in sets], pa.binary()),
        ],
        names=["class_id", "hashes"],
    )


def _class_fine(batch: pa.RecordBatch) -> pa.RecordBatch:
    words = _Words()
    sets = [shingles(text, words) for text in batch.column(0).to_pylist()]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(map(_class_of, sets), pa.int64()),
            pa.array([fine_bits(h) for h in sets], pa.list_(pa.int64())),
            pa.array([h.view(np.int64) if len(h) <= SMALL else None for h in sets], pa.list_(pa.int64())),
        ],
        names=["class_id", "fine", "few"],
    )


def _of_classes(wanted: DataFrame, classes: DataFrame, docs: DataFrame, step, schema: str) -> DataFrame:
    """``step`` over one text of each of the ``wanted`` classes, one row per class.

    Sets are made again for the few classes in question instead of keeping all.
    """
    sources = (
        classes.join(wanted, "class_id", "left_semi")
        .select(F.xxhash64("doc_id").alias("k"))
        .distinct()
    )
    return (
        docs.select(F.xxhash64("doc_id").alias("k"), "text")
        .join(sources, "k", "left_semi")
        .select("text")
        .mapInArrow(by_batch(step), schema)
        .join(wanted, "class_id", "left_semi")
        .dropDuplicates(["class_id"])
    )


def _confirmer(percent: int):
    def confirm(batch: pa.RecordBatch) -> pa.RecordBatch:
        a_ids, b_ids, a_sets, b_sets = batch.columns
        linked = np.zeros(batch.num_rows, bool)
        last_id, last = None, None
        for i, (a, left, right) in enumerate(zip(a_ids.to_pylist(), a_sets, b_sets)):
            if a != last_id:
                last_id, last = a, np.frombuffer(left.as_buffer(), np.uint64)
            other = np.frombuffer(right.as_buffer(), np.uint64)
            shared = len(last) + len(other) - len(np.union1d(last, other))
            union = len(last) + len(other) - shared
            linked[i] = 100 * shared >= percent * union
        mask = pa.array(linked)
        return pa.RecordBatch.from_arrays(
            [a_ids.filter(mask), b_ids.filter(mask)], names=["u", "v"]
        )

    return by_batch(confirm)


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs (u, v)`` whose full sets are similar enough."""
    pairs = materialize(pairs, "pairs")
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("class_id")).distinct()
    sets = materialize(_of_classes(wanted, classes, docs, _class_sets, SETS), "sets")
    left = sets.select(F.col("class_id").alias("u"), F.col("hashes").alias("a"))
    right = sets.select(F.col("class_id").alias("v"), F.col("hashes").alias("b"))
    return materialize(
        pairs.join(right, "v")
        .join(left, "u")
        .select("u", "v", "a", "b")
        .mapInArrow(_confirmer(percent), "u long, v long"),
        "confirmed",
    )


def _band(sig, i):
    return F.xxhash64(i, F.slice(sig, i * ROWS + 1, ROWS))


def _shared_bands(classes: DataFrame) -> DataFrame:
    """``(key, class_id, n, bits)`` of the buckets with two or more classes."""
    keyed = classes.select(
        "class_id",
        F.explode(
            F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: _band(F.col("sig"), i))
        ).alias("key"),
    )
    crowded = keyed.groupBy("key").count().filter("count > 1").select("key")
    # Only ids travel with all bands; the bits join the few that are shared.
    shared = keyed.join(crowded, "key", "left_semi")
    return shared.join(classes.select("class_id", "n", *BITS), "class_id")


def _stars(shared: DataFrame, percent: int) -> DataFrame:
    """Pairs of each bucket's leaders and its other members."""
    leads = shared.groupBy("key").agg(
        F.array_distinct(
            F.array(
                *(F.min_by(F.struct("class_id", "n", *BITS), F.xxhash64("class_id", F.lit(i)))
                  for i in range(LEADERS))
            )
        ).alias("leads")
    )
    met = (
        (F.col("class_id") != F.col("lead.class_id"))
        & _sizes_allow("n", "lead.n", percent)
        & _bits_allow("{}", "lead.{}", percent)
    )
    return (
        shared.join(leads, "key")
        .withColumn("lead", F.explode("leads"))
        .filter(met)
        .select(
            F.least("class_id", "lead.class_id").alias("u"),
            F.greatest("class_id", "lead.class_id").alias("v"),
        )
    )


def _unmerged(shared: DataFrame, merged: DataFrame) -> DataFrame:
    """Members of the buckets that still hold several components, with these.

    Small buckets have had all their pairs compared with the leaders.
    """
    named = shared.join(merged.withColumnRenamed("node", "class_id"), "class_id", "left")
    named = named.withColumn("label", F.coalesce("root", "class_id")).drop("root")
    mixed = (
        named.groupBy("key")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("members"))
        .filter("low < high and members > 2")
        .select("key")
    )
    return named.join(mixed, "key", "left_semi")


def _few_allow(a: str, b: str, percent: int):
    """Exactly, from the hashes of two small sets; null if one is not small."""
    shared = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - shared
    return F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), shared * 100 >= either * percent)


def _fine_allows(a: str, b: str, percent: int):
    half = (1 << FINE_BITS) // 64
    both = either = unequal = F.lit(0)
    for i in range(half):
        mine, theirs = F.get(a, F.lit(i)), F.get(b, F.lit(i))
        mixed = F.get(a, F.lit(half + i)).bitwiseXOR(F.get(b, F.lit(half + i)))
        shared = mine.bitwiseAND(theirs)
        both = both + F.bit_count(shared)
        either = either + F.bit_count(mine.bitwiseOR(theirs))
        unequal = unequal + F.bit_count(mixed.bitwiseAND(shared))
    return (both - 2 * unequal) * 75_000 >= either * (FINE_LEAST * percent)


def _second_round_allows(a: str, b: str, percent: int):
    """Exact for two small sets, else by the finer estimate."""
    return F.coalesce(
        _few_allow(f"few_{a}", f"few_{b}", percent), _fine_allows(f"fine_{a}", f"fine_{b}", percent)
    )


def _across(members: DataFrame, classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """All pairs of a bucket in different components that may be similar enough.

    Each pair is given by the first bucket that it shares.
    """
    members = materialize(members, "members")
    wanted = members.select("class_id").distinct()
    fine = _of_classes(wanted, classes, docs, _class_fine, FINE)
    keys = classes.select(
        "class_id",
        F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: _band(F.col("sig"), i)).alias("keys"),
    )
    members = members.join(materialize(fine.join(keys, "class_id"), "fine"), "class_id")
    columns = ("class_id", "label", "n", "fine", "few", "keys", *BITS)
    a = members.select("key", *(F.col(c).alias(f"{c}_a") for c in columns))
    b = members.select("key", *(F.col(c).alias(f"{c}_b") for c in columns))
    shared = F.filter(
        F.zip_with("keys_a", "keys_b", lambda x, y: F.when(x == y, x)), lambda k: k.isNotNull()
    )
    met = (
        (F.col("class_id_a") < F.col("class_id_b"))
        & (F.col("label_a") != F.col("label_b"))
        & _sizes_allow("n_a", "n_b", percent)
        & _bits_allow("{}_a", "{}_b", percent)
        & _second_round_allows("a", "b", percent)
        & (F.get(shared, F.lit(0)) == F.col("key"))
    )
    return a.join(b, "key").filter(met).select(
        F.col("class_id_a").alias("u"), F.col("class_id_b").alias("v")
    )


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct ``pairs`` whose estimate comes near the similarity."""
    side = classes.select("class_id", F.struct("n", "sig").alias("s"))
    left = side.select(F.col("class_id").alias("u"), F.col("s").alias("a"))
    right = side.select(F.col("class_id").alias("v"), F.col("s").alias("b"))
    both = pairs.distinct().join(right, "v").join(left, "u")
    return both.filter(_plausible("a", "b", percent)).select("u", "v")


def _assigned(docs: DataFrame, percent: int) -> DataFrame:
    """``doc_id, row_key, n_shingles, root, component_id``; the last two null without words."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = materialize(sign(docs), "signed")
    classes = materialize(
        signed.filter("class_id is not null")
        .groupBy("class_id")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n_shingles").alias("n"),
            F.first("sig").alias("sig"),
            *(F.first(b).alias(b) for b in BITS),
        ),
        "classes",
    )
    shared = materialize(_shared_bands(classes), "bands")

    first = _near(_stars(shared, percent), classes, percent)
    links = _confirmed(first, classes, docs, percent)
    merged = components(links)
    second = _across(_unmerged(shared, merged), classes, docs, percent)
    more = _confirmed(second, classes, docs, percent)
    merged = components(merged.select(F.col("root").alias("u"), F.col("node").alias("v")).union(more))

    named = (
        classes.select("class_id", "doc_id")
        .join(merged.withColumnRenamed("node", "class_id"), "class_id", "left")
        .withColumn("root", F.coalesce("root", "class_id"))
    )
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(smallest, "root").select("class_id", "root", "component_id")
    return signed.drop("sig", *BITS).join(named, "class_id", "left").drop("class_id")


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    Documents are linked when ``100 * intersection >= percent * union`` of their
    shingle sets. ``component_id`` is the smallest ``doc_id`` reachable by links.
    A text that is null or without words has an empty set and links with nothing.
    Repeated rows belong to one component. A row without ``doc_id`` never names a
    component; it is kept only if no row of its component has an id. Other
    columns of ``docs`` are ignored. Empty input gives empty output.
    """
    component = F.coalesce("component_id", "doc_id")
    return _assigned(docs, percent).select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
    )


def one_of_each(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest ``doc_id``.

    Rows without words stay, save for repeats of the same row. All columns stay.
    """
    key = unused(docs.columns, "row_key")
    first = (
        _assigned(docs, percent)
        .groupBy("root", F.when(F.col("root").isNull(), F.col("row_key")).alias("group"))
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first"))
        .select(F.col("first.row_key").alias(key))
        .distinct()
    )
    return docs.withColumn(key, _row_key()).join(first, key, "left_semi").dropDuplicates([key]).drop(key)
