"""Token ids in files of range-coded blocks, predicted by mixed contexts.

The ids of a segment, some whole documents, are cut into blocks of at most
``BLOCK`` ids. Every block is coded on its own: its models start anew, and its
words and its ids have a checksum each. Within a block an id is coded in up to
three steps, the first two as one interval of a range coder:

1. Is it the id that followed last time? The candidate is what came after the
   last two ids (order 2), or else after the last one (order 1). Three
   predictions of "yes", from the record of the order-2 context, of the order-1
   context and of the id's own frequency (order 0), are mixed in the logistic
   domain by weights that learn from the answers.
2. If not: which of the block's earlier ids, by their counts (order 0), or none?
3. If none: the id's bits, which lie ahead of the coder's words.

Records, weights and counts are renewed after ever more ids, see :data:`RENEWED`.
All numbers are whole, so that every machine decodes alike. Many blocks are
coded in step with one another, one numpy lane each; the encoder and the decoder
run the same :class:`_Mixer`. The encoder knows a stretch's intervals at once and
takes its models lane by lane, only the coder goes step by step; the decoder
predicts step by step and learns lane by lane.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repotide.llm.common import prepare
from repotide.llm.packing import LONGEST_RUN, encoder

END_ID = 0
BLOCK = 4096
# Ids after which a segment ends with its document, and blocks coded in step.
SEGMENT = 16 * BLOCK
LANES = 2048
# Blocks whose models learn at a time, and blocks whose earlier ids are sorted at a time.
NEAR, FEW = 64, 16
# Bytes of texts that are split into words together, and words that a worker remembers.
WORDS_OF, KNOWN = 1 << 24, 100_000

MAGIC = b"IDS2"
STORED = "part int, base long, n_ids long, doc_ids array<long>, segment binary"
DOCS = "part int, doc_id long, start long, n_tokens long, ids binary"

# Ids of a block after which its models take in what has come.
RENEWED = [32, 64, 128, 256, 512, 1024, 1536, 2048, 2560, 3072, 3584]
# Contexts that a block remembers, by hash; a record is an id and how often it was right.
SLOT_BITS = 10
SLOTS = 1 << SLOT_BITS
HASH_1, HASH_2 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
TRUST = 15
# Count of "none of the earlier ids" in step 2.
UNSEEN = 24
RATE = 3
WEIGHT_LIMIT = 300_000
LEAST_BET = 32
U64 = np.uint64
FOUR, FIFTEEN, SIXTEEN = (np.uint32(n) for n in (4, 15, 16))
HASH_SHIFT = np.uint32(32 - SLOT_BITS)
# An id's interval is a part of TOTAL; a lane's range has at least 31 and at most 63 bits.
TOTAL, FULL, LEAST_RANGE = 1 << 24, (1 << 63) - 1, 1 << 31
BET, LOW_32, LOW_31 = (1 << 12) - 1, (1 << 32) - 1, U64((1 << 31) - 1)
S24, S31, S32 = U64(24), U64(31), U64(32)
STRETCH_LIMIT = 2047
# Above every id, which has 28 bits beside its trust.
NO_ID = np.uint32((1 << 31) - 1)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """``stretch`` of a record's chance of being right, and ``squash`` to 12 bits."""
    chance = [(r + 0.35) / (TRUST + 1.6) for r in range(TRUST + 1)]
    stretch = np.array([round(256 * math.log(c / (1 - c))) for c in chance], np.int32)
    squash = [round(4096 / (1 + math.exp(-x / 256))) for x in range(-STRETCH_LIMIT - 1, STRETCH_LIMIT + 1)]
    return stretch, np.clip(np.array(squash, np.uint16), LEAST_BET, 4096 - LEAST_BET)


STRETCH, SQUASH = _tables()
NO_RECORD = STRETCH[0]
# A record's trust after it was wrong, and from place 16 on after it was right.
TRUSTED = np.array([*(r >> 2 or 2 for r in range(16)), 2, *(min(r + 3, TRUST) for r in range(1, 16))], np.uint32)


class _Mixer:
    """Records of contexts, each with a candidate and the mixed odds of it.

    They are fixed within a stretch of ids and learn from it afterwards, some
    lanes and all ids at once. Tables are flat, ``lane * SLOTS + slot``; a place
    holds ``id << 16 | trust << 12 | bet``, the first two the record, so that one
    look gives all. ``wide`` ids have more than 16 bits.
    """

    def __init__(self, lanes: int, wide: bool) -> None:
        self.row = np.arange(lanes) << SLOT_BITS
        # Orders 1 and 2, one behind the other. A bet is so many of 4096; a free
        # place of order 2 holds 0, so that order 1 shows through.
        self.kind = np.uint64 if wide else np.uint32
        self.rows = np.stack([self.row, self.row + (lanes << SLOT_BITS)])
        self.both = np.zeros(2 * lanes << SLOT_BITS, self.kind)
        self.one, self.two = np.split(self.both, 2)
        self.one += LEAST_BET
        self.often = np.zeros(lanes << SLOT_BITS, np.uint8)
        self.weights = np.array([9000, 22000, 34000], np.int32).repeat(lanes).reshape(3, lanes, 1)

    def predict(self, before: np.ndarray, before_2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Candidates of the first lanes, and what to bet on them, of 4096."""
        k = len(before)
        slots = np.empty((2, k), np.uint32)
        first, second = slots
        np.multiply(before, HASH_1, out=first)
        np.multiply(before_2, HASH_2, out=second)
        second ^= first
        second *= HASH_1
        slots >>= HASH_SHIFT
        one, two = self.both.take(self.rows[:, :k] + slots)
        one *= two == 0
        one |= two
        chosen = one.astype(np.int64)
        return chosen >> 16, chosen & BET

    def look(self, first: int, past: np.ndarray) -> tuple:
        """Candidates of a stretch and bets, and what :meth:`learn` needs, for lanes from ``first``.

        ``past`` has a row for each lane: two ids before the stretch, and its own.
        """
        row = self.row[first : first + len(past), None]
        mixed = past[:, 1:-1] * HASH_1
        slot_1 = row + (mixed >> HASH_SHIFT)
        mixed ^= past[:, :-2] * HASH_2
        mixed *= HASH_1
        mixed >>= HASH_SHIFT
        slot_2 = row + mixed
        one, two = self.one.take(slot_1), self.two.take(slot_2)
        chosen = one * (two == 0)
        chosen |= two
        return chosen >> 16, (chosen & BET).astype(np.int32), (first, slot_1, slot_2, one, two)

    def _odds(self, one: np.ndarray, two: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, ...]:
        """Stretched predictions of order 0 to 2 for the candidate of order 2, or else 1."""
        trust_1, trust_2 = one & FIFTEEN, two & FIFTEEN
        agree = (one ^ two) < SIXTEEN
        agree |= trust_2 == 0
        trust_1 *= agree
        return STRETCH.take(often), STRETCH.take(trust_1), STRETCH.take(trust_2)

    def _mixed(self, odds: tuple[np.ndarray, ...], weights: np.ndarray) -> np.ndarray:
        dot = weights[0] * odds[0]
        dot += weights[1] * odds[1]
        dot += weights[2] * odds[2]
        dot >>= 16
        dot += STRETCH_LIMIT + 1
        return SQUASH.take(dot, mode="clip")

    def learn(
        self, ids: np.ndarray, candidate: np.ndarray, bet: np.ndarray, seen: tuple, inside: np.ndarray | None
    ) -> None:
        """Take in the ids of a stretch after the :meth:`look` at it.

        ``inside`` marks what belongs to a block where lanes end within.
        """
        first, slot_1, slot_2, one, two = seen
        row = self.row[first : first + len(ids), None]
        weights = self.weights[:, first : first + len(ids)]
        slot_0 = ids * HASH_2
        slot_0 >>= HASH_SHIFT
        slot_0 = row + slot_0
        err = (candidate == ids).astype(np.int32)
        err <<= 12
        err -= bet
        if inside is not None:
            err *= inside
        one >>= 12
        two >>= 12
        often = self.often.take(slot_0)
        # 512 errors of under 4096 by odds of under 1000 are less than 32 bits.
        for weight, odds in zip(weights, self._odds(one, two, often)):
            odds *= err
            step = np.add.reduce(odds, axis=1, keepdims=True, dtype=np.int32).astype(np.int64) * RATE >> 14
            weight[:] = np.clip(weight + step, -WEIGHT_LIMIT, WEIGHT_LIMIT)
        record = ids << FOUR
        for table, slot, old in ((self.one, slot_1, one), (self.two, slot_2, two)):
            # A wrong record loses most of its trust, and its id when none is left.
            trust = old & FIFTEEN
            right = ((old ^ record) < SIXTEEN).astype(np.uint32)
            right <<= FOUR
            right |= trust.astype(np.uint32, copy=False)
            kept = trust >= FOUR
            old ^= trust
            old -= record
            old *= kept
            old += record
            old |= TRUSTED.take(right)
            old <<= 12
            table[slot] = old
        often += 1
        self.often[slot_0] = np.minimum(often, 15, out=often)
        # Where a place came up twice, its last record is the one to bet on.
        place_1, place_2 = self.one.take(slot_1), self.two.take(slot_2)
        one, two = place_1 >> 12, place_2 >> 12
        odds = self._odds(one, two, self.often.take(slot_0))
        place_2 |= self._mixed(odds, weights)
        one &= FIFTEEN
        place_1 |= self._mixed((odds[0], STRETCH.take(one), NO_RECORD), weights)
        self.one[slot_1], self.two[slot_2] = place_1, place_2


class _Coder:
    """Range coder over all lanes in 63 bits and words of 32; a carry is settled at the end."""

    def __init__(self, lanes: int) -> None:
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, FULL, np.uint64)
        # The words of each step, with bit 32 a carry to the one before, and their lanes.
        self.words: list[np.ndarray] = []
        self.lanes: list[np.ndarray] = []

    def code(self, start: np.ndarray, size: np.ndarray) -> None:
        """Narrow the first lanes to ``size`` from ``start``, of :data:`TOTAL`."""
        k = len(start)
        low, part = self.low[:k], self.range[:k]
        part >>= S24
        low += part * start
        part *= size
        small = (part < LEAST_RANGE).nonzero()[0]
        if len(small):
            at = low[small]
            self.words.append(at >> S31)
            self.lanes.append(small.astype(np.uint16))
            low[small] = (at & LOW_31) << S32
            part[small] = part[small] << S32

    def finish(self) -> list[bytes]:
        lanes = len(self.low)
        # One more word is enough: the range has 31 bits at least.
        words = np.concatenate([*self.words, (self.low + LOW_31) >> S31])
        owners = np.concatenate([*self.lanes, np.arange(lanes, dtype=np.uint16)])
        words = words[np.argsort(owners, kind="stable")]
        # No carry goes beyond the first word of a lane.
        while (over := words >> S32).any():
            words &= U64(LOW_32)
            words[:-1] += over[1:]
        ends = np.cumsum(np.bincount(owners, minlength=lanes)) * 4
        data = words.astype("<u4").tobytes()
        return [data[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]


class _Reader:
    """The coder's other side."""

    def __init__(self, coded: list[bytes]) -> None:
        lanes = len(coded)
        # Behind its end a lane reads zeros.
        words = np.zeros((lanes, max(map(len, coded)) // 4 + 3), np.uint32)
        for i, own in enumerate(coded):
            words[i, : len(own) // 4] = np.frombuffer(own, "<u4")
        # Words are read one bit late, as 63 bits are not two of them.
        late = words[:, :-1] << 31
        late |= words[:, 1:] >> 1
        self.value = words[:, 0].astype(np.int64) << 31 | words[:, 1] >> 1
        self.range = np.full(lanes, FULL, np.int64)
        self.late, self.at = late.ravel(), np.arange(lanes) * late.shape[1] + 1

    def narrow(self, part: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Narrow the first lanes, of :data:`TOTAL` parts, as the coder did."""
        k = len(part)
        value, ranges = self.value[:k], self.range[:k]
        value -= part * start
        np.multiply(part, size, out=ranges)
        # All bits where the range is small.
        small = ranges - LEAST_RANGE
        small >>= 63
        at = self.at[:k]
        word = self.late.take(at, mode="clip") & small
        at -= small
        small &= 32
        value <<= small
        value |= word
        ranges <<= small


def _by_length(lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Lanes from long to short, and how many are still active at each step."""
    sizes = np.asarray(lengths)
    order = np.argsort(-sizes, kind="stable")
    steps = np.arange(sizes.max())
    active = len(sizes) - np.searchsorted(np.sort(sizes), steps, side="right")
    return order, active


def _spans(size: int) -> list[tuple[int, int]]:
    edges = [0, *(r for r in RENEWED if r < size), size]
    return list(zip(edges, edges[1:]))


def _inside(begin: int, end: int, sizes: np.ndarray) -> np.ndarray | None:
    """What of a stretch belongs to lanes of these sizes, or None for all of it."""
    return None if sizes[-1] >= end else np.arange(begin, end) < sizes[:, None]


def _ranks(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, int]:
    """Each id's place among the different ids of its lane, and how many there are at most."""
    lanes, size = ids.shape
    # Ids of 16 bits fit 32 bits together with their places.
    kind = np.uint32 if ids.max() <= 0xFFFF else np.int64
    keyed = ids.astype(kind)
    if sizes[-1] < size:
        keyed[np.arange(size) >= sizes[:, None]] = (1 << 20) - 1 if kind is np.uint32 else NO_ID
    keyed <<= 12
    keyed |= np.arange(size, dtype=kind)
    keyed.sort(axis=1)
    row = np.arange(lanes)[:, None]
    at = keyed & (BLOCK - 1)
    keyed >>= 12
    place = np.zeros(ids.shape, np.int32)
    np.cumsum(keyed[:, 1:] != keyed[:, :-1], axis=1, out=place[:, 1:])
    wide = int(place[:, -1].max()) + 1
    place += (row * wide).astype(np.int32)
    rank = np.empty(lanes * size, np.int64)
    rank[at + row * size] = place
    return rank.reshape(lanes, size), wide


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """The coded form of blocks of at most :data:`BLOCK` ids, none of them empty.

    About :data:`LANES` blocks at a time are worth the calls of a step. The models
    see :data:`NEAR` lanes at a time, whose tables stay in the cache; the coder then
    goes over all lanes step by step.
    """
    lengths = [len(b) for b in blocks]
    order, active = _by_length(lengths)
    sizes = np.asarray(lengths)[order]
    starts = np.zeros((sizes[0], len(blocks)), np.uint32)
    parts = starts.copy()
    bare: list[bytes] = []
    for first in range(0, len(blocks), NEAR):
        near = slice(first, first + NEAR)
        bare += _intervals([blocks[i] for i in order[near]], sizes[near], starts[:, near], parts[:, near])
    coder = _Coder(len(blocks))
    for k, start, part in zip(active.tolist(), starts, parts):
        coder.code(start[:k], part[:k])
    out: list[bytes] = [b""] * len(blocks)
    for i, head, words in zip(order, bare, coder.finish()):
        out[i] = head + words
    return out


def _intervals(blocks: list[np.ndarray], sizes: np.ndarray, starts: np.ndarray, parts: np.ndarray) -> list[bytes]:
    """Fill in each id's interval, a row for each step; gives the blocks' ids of step 3."""
    lanes, size = len(blocks), int(sizes[0])
    # Two ids before each; a block begins behind ids 0.
    past = np.zeros((lanes, size + 2), np.uint32)
    for lane, block in enumerate(blocks):
        past[lane, 2 : 2 + len(block)] = block
    rank, wide = _ranks(past[:, 2:], sizes)
    counts = np.zeros(lanes * wide, np.int64)
    mixer, bare = _Mixer(lanes, past.max() > 0xFFFF), np.zeros((lanes, size), bool)
    for begin, end in _spans(size):
        alive = int(np.count_nonzero(sizes > begin))
        now, inside = past[:alive, begin + 2 : end + 2], _inside(begin, end, sizes[:alive])
        candidate, bet, seen = mixer.look(0, past[:alive, begin : end + 2])
        here = rank[:alive, begin:end]
        found = counts.take(here)
        ahead = np.cumsum(counts.reshape(lanes, wide)[:alive], axis=1).ravel()
        ahead -= counts[: len(ahead)]
        start = ahead.take(here)
        new = found == 0
        start += (begin - start) * new
        found += new * UNSEEN
        own = bet.astype(np.int64)
        own <<= 12
        unit = (TOTAL - own) // (begin + UNSEEN)
        start *= unit
        found *= unit
        hit = candidate == now
        start += own
        start *= ~hit
        own -= found
        own *= hit
        found += own
        starts[begin:end, :alive] = start.astype(np.uint32).T
        parts[begin:end, :alive] = found.astype(np.uint32).T
        new &= ~hit
        if inside is not None:
            new &= inside
        bare[:alive, begin:end] = new
        if end < size:
            mixer.learn(now, candidate, bet, seen, inside)
            here = here if inside is None else here[inside]
            counts += np.bincount(here.ravel(), minlength=len(counts))
    heads = []
    for lane, block in enumerate(blocks):
        own = block[bare[lane, : len(block)]]
        width = 1 + int(block.max() > 0xFFFF)
        heads.append(bytes([width]) + len(own).to_bytes(2, "little") + own.astype(f"<u{2 * width}").tobytes())
    return heads


def decode_blocks(coded: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The ids of coded blocks, whose lengths are known."""
    lanes = len(coded)
    order, active = _by_length(lengths)
    sizes = np.asarray(lengths)[order]
    size = int(sizes[0])
    bare, words = zip(*(_opened(coded[i]) for i in order))
    # The ids of step 3 of all lanes, and which of them is each lane's next.
    bare_at = np.cumsum([0, *map(len, bare[:-1])])
    bare = np.concatenate(bare)
    # The ids of a stretch, a row for each step, behind the two before them; and all ids.
    steps = np.zeros((max(end - begin for begin, end in _spans(size)) + 2, lanes), np.uint32)
    by_lane = np.zeros((lanes, size + 2), np.uint32)
    mixer, reader = _Mixer(lanes, any(c[0] == 2 for c in coded)), _Reader(list(words))
    room = np.empty(lanes * (_spans(size)[-1][0] + 1), np.int64)
    for begin, end in _spans(size):
        alive = int(active[begin])
        total = begin + UNSEEN
        earlier = _earlier(by_lane[:alive, 2 : begin + 2], room)
        base = np.arange(alive) * (begin + 1)
        for t in range(begin, end):
            k = int(active[t])
            ids, bet = mixer.predict(steps[t - begin + 1, :k], steps[t - begin, :k])
            bet <<= 12
            part = reader.range[:k] >> 24
            # In unsigned numbers, which divide faster.
            value = np.floor_divide(reader.value[:k].view(np.uint64), part.view(np.uint64)).view(np.int64)
            value -= bet
            # All bits where the bet was lost; choices by bits are cheaper than by branches.
            missed = ~(value >> 63)
            # Step 2. The floats' quotient of numbers of 24 bits is never rounded up to the next one.
            unit = (TOTAL - bet) // total
            place = (value.astype(np.float64) / unit.astype(np.float64)).astype(np.int64)
            place &= missed
            np.minimum(place, begin, out=place)
            lost = place == begin
            if not begin:
                lost &= missed < 0
            raw = lost.nonzero()[0]
            place += base[:k]
            found = earlier.take(place)
            start = found & 0xFFFF
            start *= unit
            start += bet
            start &= missed
            size_here = found >> 16
            size_here &= 0xFFFF
            size_here *= unit
            size_here -= bet
            size_here &= missed
            size_here += bet
            found >>= 32
            found -= ids
            found &= missed
            ids += found
            if len(raw):
                at = bare_at[raw]
                ids[raw] = bare.take(at)
                bare_at[raw] = at + 1
            steps[t - begin + 2, :k] = ids
            reader.narrow(part, start, size_here)
        for first in range(0, alive, NEAR):
            last = min(first + NEAR, alive)
            by_lane[first:last, begin + 2 : end + 2] = steps[2 : end - begin + 2, first:last].T
            if end < size:
                past = by_lane[first:last, begin : end + 2]
                mixer.learn(past[:, 2:], *mixer.look(first, past), _inside(begin, end, sizes[first:last]))
        steps[:2] = steps[end - begin : end - begin + 2].copy()
    out: list[np.ndarray] = [np.empty(0, np.uint32)] * lanes
    for lane, i in enumerate(order):
        out[i] = by_lane[lane, 2 : 2 + lengths[i]]
    return out


def _opened(coded: bytes) -> tuple[np.ndarray, bytes]:
    """The ids of step 3 of a block, and its words."""
    width, n = 2 * coded[0], int.from_bytes(coded[1:3], "little")
    return np.frombuffer(coded, f"<u{width}", n, 3).astype(np.int64), coded[3 + width * n :]


def _earlier(ids: np.ndarray, room: np.ndarray) -> np.ndarray:
    """For each lane and place in the order of its earlier ids ``id << 32 | count << 16 | start`` of
    the places of that id; the last place of a lane stands for none of them."""
    lanes, begin = ids.shape
    size = begin + 1
    # Numbers of 16 bits are sorted faster.
    none = NO_ID if ids.size and ids.max() >= 0xFFFF else np.uint16(0xFFFF)
    for first in range(0, lanes, FEW):
        last = min(first + FEW, lanes)
        near = np.full((last - first, size), none)
        near[:, :begin] = ids[first:last]
        near.sort(axis=1)
        flat = near.ravel()
        fresh = np.ones(len(flat), bool)
        np.not_equal(flat[1:], flat[:-1], out=fresh[1:])
        edges = fresh.nonzero()[0]
        runs = np.diff(edges, append=len(flat))
        start = edges - edges // size * size
        packed = runs.copy()
        packed[start == begin] = UNSEEN
        packed <<= 16
        packed |= start
        packed |= flat.take(edges).astype(np.int64) << 32
        room[first * size : last * size] = packed.repeat(runs)
    return room


# --- segments


def _cut(ids: np.ndarray) -> list[np.ndarray]:
    return [ids[i : i + BLOCK] for i in range(0, len(ids), BLOCK)]


def _coded(blocks: list[np.ndarray]) -> list[bytes]:
    coded = []
    for a, b in _groups(len(blocks)):
        coded += encode_blocks(blocks[a:b])
    return coded


def _groups(blocks: int) -> list[tuple[int, int]]:
    """Equal groups of about :data:`LANES` blocks, less than half as many again or a single group."""
    n = max(1, round(blocks / LANES))
    edges = [blocks * i // n for i in range(n + 1)]
    return list(zip(edges, edges[1:]))


def _pack(lengths: list[int], blocks: list[np.ndarray], coded: list[bytes]) -> bytes:
    """A segment: magic, counts, document lengths, table of blocks, checksum of all that, words."""
    table = [
        (len(ids), len(words), zlib.crc32(words), zlib.crc32(ids.astype("<u4").tobytes()))
        for ids, words in zip(blocks, coded)
    ]
    head = b"".join(
        [MAGIC, np.array([len(lengths), len(blocks)], "<u4").tobytes(), np.array(lengths, "<u8").tobytes(),
         np.array(table, "<u4").tobytes()]
    )
    return b"".join([head, np.array([zlib.crc32(head)], "<u4").tobytes(), *coded])


def _unpack(segment: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Document lengths, table of blocks, and their words; damage is an error."""
    if segment[:4] != MAGIC or len(segment) < 12:
        raise ValueError("not a segment of token ids")
    n_docs, n_blocks = np.frombuffer(segment, "<u4", 2, 4).tolist()
    end = 12 + 8 * n_docs + 16 * n_blocks
    if len(segment) < end + 4 or zlib.crc32(segment[:end]) != int.from_bytes(segment[end : end + 4], "little"):
        raise ValueError("damaged header of a segment of token ids")
    lengths = np.frombuffer(segment, "<u8", n_docs, 12).astype(np.int64)
    table = np.frombuffer(segment, "<u4", 4 * n_blocks, 12 + 8 * n_docs).reshape(-1, 4)
    ends = (end + 4 + np.cumsum(table[:, 1], dtype=np.int64)).tolist()
    words = [segment[a:b] for a, b in zip([end + 4, *ends], ends)]
    for i, (payload, crc) in enumerate(zip(words, table[:, 2].tolist())):
        if zlib.crc32(payload) != crc:
            raise ValueError(f"damaged block {i} of a segment of token ids")
    return lengths, table, words


def unpack_all(segments: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Document lengths and ids of each segment; blocks of several are decoded in step."""
    opened = [_unpack(s) for s in segments]
    words = [w for _, _, own in opened for w in own]
    sizes = [n for _, table, _ in opened for n in table[:, 0].tolist()]
    sums = [n for _, table, _ in opened for n in table[:, 3].tolist()]
    blocks: list[np.ndarray] = []
    for a, b in _groups(len(words)):
        blocks += decode_blocks(words[a:b], sizes[a:b])
    for i, (ids, crc) in enumerate(zip(blocks, sums)):
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError(f"block {i} decodes to other token ids")
    at = 0
    for lengths, table, _ in opened:
        yield lengths, np.concatenate(blocks[at : at + len(table)])
        at += len(table)


# --- texts


class Words:
    """Ids of many texts at a time: each different word of theirs is encoded once.

    In a text of Latin characters whose white space is single blanks and line
    feeds, a word with the blank or the line feed before it is encoded alike
    wherever it stands. The words that a line feed precedes stay together with
    it; the first word of a text gets one, whose id then gives way to the end id
    of the text before. Other texts go to the encoder as a whole.
    """

    # Texts that need the encoder: other characters or white space, and words so
    # long that their merges are worth its care.
    OTHER = rf"[^ \n!-~\x{{a1}}-\x{{17f}}]|[ \n][ \n]|\A[ \n]|[ \n]\z|[^ \n]{{{LONGEST_RUN}}}"

    def __init__(self, tokenizer: str) -> None:
        self.encoder = encoder(tokenizer)
        whole = self.encoder.whole
        special = [re.escape(o) for o in self.encoder.odd]
        self.other = "|".join([self.OTHER, *special])
        strings = [whole.decode([i]) for i in range(whole.get_vocab_size())]
        # Per id: 1 opens with a blank, 2 is one, 4 opens with a line feed.
        # Words known from earlier texts, and their ids as bytes.
        self.known, self.ids = pa.array([], pa.string()), pa.array([], pa.binary())
        self.marks = np.array([s.startswith(" ") + 2 * (s == " ") + 4 * s.startswith("\n") for s in strings], np.uint8)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with ``end_id`` behind it, and how many each has."""
        texts = pc.fill_null(texts, "")
        # Arrow's strings end at 2 GB, and an id has four bytes.
        if not self.encoder.quick or texts.nbytes > 1 << 28:
            return self._apart(texts, end_id)
        texts = texts.cast(pa.string())
        other = pc.match_substring_regex(texts, self.other)
        plain = pc.and_not(pc.greater(pc.binary_length(texts), 0), other)
        if not pc.any(plain).as_py():
            return self._apart(texts, end_id)
        ids, sizes = self._plain(texts.filter(plain), end_id)
        if pc.all(plain).as_py():
            return ids, sizes
        # Put the others between them.
        chosen = plain.to_numpy(zero_copy_only=False)
        more, more_sizes = self._apart(texts.filter(pc.invert(plain)), end_id)
        all_sizes = np.empty(len(texts), np.int64)
        all_sizes[chosen], all_sizes[~chosen] = sizes, more_sizes
        mine = np.repeat(chosen, all_sizes)
        out = np.empty(len(mine), np.uint32)
        out[mine], out[~mine] = ids, more
        return out, all_sizes

    def _apart(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        last = np.array([end_id], np.uint32)
        found = [self.encoder.encode(t) for t in texts.to_pylist()]
        return np.concatenate([i for ids in found for i in (ids, last)]), np.array([len(f) + 1 for f in found])

    def _plain(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        lines = pc.binary_join_element_wise("", pc.replace_substring(texts, "\n", " \n"), "\n")
        words = pc.split_pattern(lines, " ")
        ends = words.offsets.to_numpy()
        # The known words go ahead, so that the codes behind them are the new ones'.
        known = len(self.known)
        coded = pa.concat_arrays([self.known, words.flatten()]).dictionary_encode()
        different, codes = coded.dictionary, coded.indices.to_numpy()[known:]
        ids = pa.concat_arrays([self.ids, self._of_words(different[known:])])
        if known < KNOWN:
            # What comes up early is common: it stays.
            self.known, self.ids = different[:KNOWN], ids[:KNOWN]
        _, offsets, data = ids.take(pa.array(codes)).buffers()
        # Where each text's first id is, which is a line feed's.
        first = np.frombuffer(offsets, np.int32)[ends - ends[0]] // 4
        out = np.empty(first[-1] + 1, np.uint32)
        out[:-1] = np.frombuffer(data, np.uint32, first[-1])
        out[first] = end_id
        return out[1:], np.diff(first)

    def _of_words(self, words: pa.Array) -> pa.Array:
        """The ids of different words, as bytes."""
        if not len(words):
            return pa.array([], pa.binary())
        # One text of all of them, with a blank before each.
        row = pa.ListArray.from_arrays([0, len(words)], words)
        text = " " + pc.binary_join(row, " ")[0].as_py()
        ids = np.frombuffer(array("I", self.encoder.quick(text)), np.uint32)
        marks = self.marks.take(ids)
        begins = np.append((marks & 1).nonzero()[0], len(ids))
        # A line feed's blank is no part of its word.
        bare = np.zeros(len(ids) + 1, bool)
        bare[:-2] = (marks[:-1] >> 1) & (marks[1:] >> 2)
        begins -= (np.cumsum(bare) - bare)[begins]
        buffers = [None, pa.py_buffer((4 * begins).astype(np.int32)), pa.py_buffer(ids[~bare[:-1]])]
        return pa.Array.from_buffers(pa.binary(), len(words), buffers)


@cache
def _words(tokenizer: str) -> Words:
    return Words(tokenizer)


# --- Spark


def _write(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, base = TaskContext.get().partitionId(), 0
        words = _words(tokenizer)
        waiting: list[tuple[list, list[int], list[np.ndarray]]] = []  # ids of documents, lengths, blocks
        docs: list = []
        texts: list[np.ndarray] = []
        size = n_blocks = 0

        def close() -> None:
            nonlocal size, n_blocks
            blocks = _cut(np.concatenate(texts))
            # Document ids and ids of tokens of one segment, to be coded with others.
            waiting.append((list(docs), [len(t) for t in texts], blocks))
            n_blocks += len(blocks)
            docs.clear()
            texts.clear()
            size = 0

        def flush() -> pa.RecordBatch:
            nonlocal base, n_blocks
            coded = _coded([b for _, _, blocks in waiting for b in blocks])
            rows, at = [], 0
            for names, lengths, blocks in waiting:
                segment = _pack(lengths, blocks, coded[at : at + len(blocks)])
                at += len(blocks)
                rows.append((part, base, sum(lengths), names, segment))
                base += sum(lengths)
            waiting.clear()
            n_blocks = 0
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                names=["part", "base", "n_ids", "doc_ids", "segment"],
            )

        for names, column in _together(batches):
            ids, sizes = words.encode(column, end_id)
            ends = np.cumsum(sizes).tolist()
            for doc_id, begin, end in zip(names.to_pylist(), [0, *ends], ends):
                docs.append(doc_id)
                texts.append(ids[begin:end])
                size += end - begin
                if size >= SEGMENT:
                    close()
                    if n_blocks >= LANES:
                        yield flush()
        if docs:
            close()
        if waiting:
            yield flush()

    return run


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts of documents, of several batches at a time."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            size += batch.column(1).nbytes
        if size >= WORDS_OF:
            whole = pa.concat_batches(waiting)
            yield whole.column(0), whole.column(1)
            waiting, size = [], 0
    if waiting:
        whole = pa.concat_batches(waiting)
        yield whole.column(0), whole.column(1)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Write the ids of all documents to ``path``, in ascending order of ``doc_id``.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. A null or
    empty text is the end id alone. Null ids come first; rows of one id follow
    each other, ordered by a hash of their texts; each row is a document of its
    own. An empty table gives no segment. The folder is a Parquet table whose
    rows are segments of whole documents, so that Spark commits and retries the
    writing tasks; ``part`` and ``base`` give the order of the segments.
    """
    prepare(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = own.withColumn("_tie", F.xxhash64("text"))
    # A number given is a number kept: the work is in the coding, not in the bytes shuffled.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        keyed.repartitionByRange(tasks, "doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .select("doc_id", "text")
        .mapInArrow(_write(tokenizer, end_id), STORED)
        .write.option("compression", "none")
        .parquet(path)
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def opened(rows: list[tuple]) -> pa.RecordBatch:
        found: list[tuple] = []
        segments = unpack_all([r[3] for r in rows])
        for (part, base, names, _), (lengths, ids) in zip(rows, segments):
            ends = np.cumsum(lengths).tolist()
            data = ids.astype("<u4").tobytes()
            for name, size, end in zip(names, lengths.tolist(), ends):
                found.append((part, name, base + end - size, size, data[4 * (end - size) : 4 * end]))
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*found), kinds)],
            names=["part", "doc_id", "start", "n_tokens", "ids"],
        )

    rows: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(batch["part"].to_pylist(), batch["base"].to_pylist(), batch["doc_ids"].to_pylist(),
                       batch["segment"].to_pylist(), batch["n_ids"].to_pylist()):
            rows.append(row[:4])
            size += row[4]
            if size >= LANES * BLOCK:
                yield opened(rows)
                rows, size = [], 0
    if rows:
        yield opened(rows)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files of :func:`write`.

    ``start`` counts the ids of all documents before it; ``ids`` are
    little-endian 32-bit numbers, the end id included. Damaged segments are an
    error.
    """
    prepare(spark)
    stored = spark.read.schema(STORED).parquet(path)
    # One row per writing task.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored.groupBy("part").agg(F.sum("n_ids").alias("_ids")).select(
        "part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_before")
    )
    found = stored.mapInArrow(_read, DOCS)
    return found.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("start") + F.col("_before")).alias("start"), "n_tokens", "ids"
    )
