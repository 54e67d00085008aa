"""Order-preserving packing of tokenized documents into fixed-length sequences.

Each document's ids and an end id form one stream per input partition. Dynamic
programming chooses where the stream is cut into windows of at most ``window``
ids: a cut after a document is free, one after a sentence costs a little, one
inside a sentence more, and padding costs its length. The last term makes the
recurrence ``cost[j] = min over i of (cost[i] + i) + window - j + penalty[j]``
over the cut places ``i`` of the last ``window`` ids, so a monotone queue keeps
the best one and each place enters and leaves it once. Windows whose length is a
power of two, 512 or more, need no padding; those few predecessors are looked up
one by one.

Partitions are packed on their own, in the order of their rows, and hold the
state of one block of documents at a time. Only the last window of a partition
can be short for want of ids.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections import deque
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import prepare

WINDOW = 2048
END_ID = 1
SENTENCE_CUT, INNER_CUT = 1, 24
# Ids that one run of the recurrence looks at.
BLOCK = 1 << 20
# Shortest window that may go without padding.
LEAST_POWER = 512
# Where no sentence ends, a cut may fall every so many ids.
STRIDE = 32
# Remembered pieces of a worker, with and without a blank before them, each.
MAX_KNOWN = 700_000

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)

# The split of the byte-level vocabulary within a run of characters other than white space.
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
_PIECE = re.compile(r" ?\S+|\s+(?!\S)|\s+")
# White space but blank and line feed, as Python sees it; the four controls are
# none for the vocabulary.
_CONTROLS = "\x1c\x1d\x1e\x1f"
_SPACES = "\t\r\x0b\x0c\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    chr(c) for c in range(0x2000, 0x200B)
)
_PAIRS = ("  ", "\n\n", " \n", "\n ")
# Characters beyond those that every Unicode version classes alike.
_FOREIGN = re.compile(r"[^ \n!-~\xa1-\u017f]").search
# Longest run of one kind in a plain text; the merges of a longer one would take quadratic time.
LONGEST_RUN = 400


def _plain(text: str) -> bool:
    """Latin characters between single kinds of white space, without overlong runs.

    A run of :data:`LONGEST_RUN` covers a whole stretch of half its length.
    """
    if _FOREIGN(text) or "\n " in text or " \n" in text or " " * LONGEST_RUN in text or "\n" * LONGEST_RUN in text:
        return False
    half = LONGEST_RUN // 2
    for i in range(0, len(text) - half + 1, half):
        stretch = text[i : i + half]
        if " " not in stretch and "\n" not in stretch:
            return False
    return True


class _Known(dict):
    """Ids of pieces as bytes, made when first asked for; ``lead`` goes before each key.

    When it is full, the older half goes.
    """

    def __init__(self, make, lead: str) -> None:
        super().__init__()
        self.make, self.lead = make, lead

    def __missing__(self, piece: str) -> bytes:
        if len(self) > MAX_KNOWN:
            for old in list(islice(self, len(self) // 2)):
                del self[old]
        value = self[piece] = self.make(self.lead + piece)
        return value


def _quick_merges(whole, letters: dict[int, str]):
    """``tiktoken`` over the vocabulary of ``whole``, or None where it would merge otherwise.

    It merges the pair whose union has the lowest id, the library the pair that
    comes first in the file: the same, if the file gives the ids in that order.
    """
    import tiktoken

    model = json.loads(whole.to_str())["model"]
    own = {token: i for token, i in model["vocab"].items() if token not in
           {t.content for t in whole.get_added_tokens_decoder().values()}}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merged = [own.get(a + b, -1) for a, b in pairs]
    alike = all(a < b for a, b in zip(merged, merged[1:])) and len(own) == len(merged) + 256
    odd = any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if not alike or odd or merged[:1] <= [max((own[c] for c in own if len(c) == 1), default=0)]:
        return None
    byte = {c: b for b, c in letters.items()}
    ranks = {bytes(byte.get(c) if c in byte else ord(c) for c in token): i for token, i in own.items()}
    pattern = _PARTS + r"|\s+(?!\S)|\s+"
    return tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def _little_endian(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class Encoder:
    """Ids of whole texts as the ``tokenizers`` library gives them, one call per distinct piece.

    Plain Latin texts are merged by ``tiktoken`` from the same vocabulary, in a
    quarter of the library's time. White space ends every piece of byte-level
    pre-tokenization, so the pieces of other texts are encoded apart and remembered. Texts whose only white space is
    single blanks and line feeds are split at those; others by the vocabulary's
    pattern. A text with the special token's string, or with control characters
    that Python alone takes for white space, goes to the library as a whole, and
    so does a piece with characters that this Python's Unicode tables do not know.
    """

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        # Byte-level letters: printable Latin-1 bytes are themselves, the rest follow at 256.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        self.letters = {b: chr(256 + i) for i, b in enumerate(rest)}
        self.split = regex.compile(_PARTS + r"|\s+(?!\S)|\s+").findall
        special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.odd = (*_CONTROLS, *special)
        self.quick = _quick_merges(self.whole, self.letters)
        self.plain = _Known(self._piece, "")
        self.spaced = _Known(self._piece, " ")
        strings = [self.whole.decode([i]) for i in range(self.whole.get_vocab_size())]
        # Per id: 1 ends a sentence, 2 opens with white space, 4 with a line feed.
        ends = np.array([s.rstrip("\"')]»”")[-1:] in (".", "!", "?", "…") for s in strings])
        opens = np.array([s[:1].isspace() for s in strings])
        breaks = np.array([s[:1] == "\n" for s in strings])
        self.marks = (ends + 2 * opens + 4 * breaks).astype(np.uint8)

    def _part(self, part: str) -> bytes:
        mapped = part.encode("utf-8", "replace").decode("latin-1").translate(self.letters)
        return _little_endian([t.id for t in self.model.tokenize(mapped)])

    def _piece(self, piece: str) -> bytes:
        word = piece[1:] if piece[:1] == " " else piece
        if word.isalpha():
            return self._part(piece)
        # A word with one mark behind is the commonest piece of two parts.
        if word[-1:] in (",", ".") and word[:-1].isalpha():
            known = self.spaced if word is not piece else self.plain
            return known[word[:-1]] + self.plain[word[-1]]
        if not piece.isascii() and any(unicodedata.category(c) == "Cn" for c in piece):
            return _little_endian(self.whole.encode(piece, add_special_tokens=False).ids)
        return b"".join(map(self._part, self.split(piece)))

    def encode(self, text: str) -> np.ndarray:
        if any(o in text for o in self.odd):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        if self.quick and _plain(text):
            return np.frombuffer(_little_endian(self.quick(text)), "<u4")
        plain, spaced = self.plain, self.spaced
        ends = text[:1] + text[-1:]
        if ends.strip() != ends or any(s in text for s in _PAIRS) or any(s in text for s in _SPACES):
            found = [plain[p] for p in _PIECE.findall(text)]
        else:
            found = []
            for i, line in enumerate(text.split("\n")):
                head, *rest = line.split(" ")
                if i:
                    found.append(plain["\n"])
                if head:
                    found.append(plain[head])
                found += [spaced[word] for word in rest]
        return np.frombuffer(b"".join(found), "<u4")

    def sentence_ends(self, ids: np.ndarray) -> np.ndarray:
        """Positions between a sentence and the next, by the ids' strings."""
        marks = self.marks[ids]
        after = marks[1:]
        return np.flatnonzero((marks[:-1] & 1) & (after >> 1) | (after >> 2)) + 1


@cache
def encoder(path: str) -> Encoder:
    """One per worker; what it has learnt serves the worker's later tasks."""
    return Encoder(path)


def cut_places(sentences: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in one document of ``size`` ids, with penalties; its end is free.

    ``sentences`` are ascending positions inside. Stretches without a sentence end get a place every :data:`STRIDE` ids.
    """
    known = np.append(sentences, size)
    costs = np.full(len(known), SENTENCE_CUT)
    costs[-1] = 0
    gaps = known.copy()
    gaps[1:] -= known[:-1]
    wide = np.flatnonzero(gaps > 4 * STRIDE)
    if not len(wide):
        return known, costs
    more = [np.arange(known[i] - gaps[i] + STRIDE, known[i], STRIDE) for i in wide]
    inner = np.concatenate(more)
    places = np.concatenate([known, inner])
    costs = np.concatenate([costs, np.full(len(inner), INNER_CUT)])
    order = np.argsort(places, kind="stable")
    return places[order], costs[order]


def best_cuts(places: np.ndarray, costs: np.ndarray, window: int, final: bool) -> list[int]:
    """The cheapest cuts of a stream that starts at 0, ascending.

    ``final`` demands a cut at the last place. Otherwise the end is open: the
    last cut is the cheapest place within one window of the end, and the ids
    behind it wait for what follows.
    """
    position = np.concatenate([[0], places])
    exact: dict[int, list[int]] = {}
    for k in range(LEAST_POWER.bit_length() - 1, window.bit_length()):
        at = np.searchsorted(position, position - (1 << k))
        for me in np.flatnonzero(position[at] == position - (1 << k)).tolist():
            exact.setdefault(me, []).append(int(at[me]))
    position, penalty = position.tolist(), [0, *costs.tolist()]
    cost, came = [0] * len(position), [-1] * len(position)
    # The queue holds places by ascending cost + position; both ends are popped.
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])
    pop, drop, push = queue.popleft, queue.pop, queue.append
    for me in range(1, len(position)):
        place = position[me]
        while queue[0][1] < place - window:
            pop()
        value, _, source = queue[0]
        best = value + window - place
        if me in exact:
            for i in exact[me]:
                if cost[i] < best:
                    best, source = cost[i], i
        best += penalty[me]
        cost[me], came[me] = best, source
        value = best + place
        while queue and queue[-1][0] >= value:
            drop()
        push((value, place, me))
    last = len(position) - 1
    if not final:
        # Padding is a cost per id, so a later place may cost that much more.
        while last and position[last - 1] >= position[-1] - window:
            last -= 1
        last = min(range(last, len(position)), key=cost.__getitem__)
    cuts = []
    while last > 0:
        cuts.append(position[last])
        last = came[last]
    return cuts[::-1]


class _Stream:
    """Ids waiting to be cut, as documents with their places."""

    def __init__(self, window: int, first_id: int) -> None:
        self.window, self.next_id = window, first_id
        self.docs: list[tuple] = []  # doc_id, ids, ids consumed, places, costs
        self.waiting = 0

    def add(self, doc_id, ids: np.ndarray, sentences: np.ndarray) -> None:
        self.docs.append((doc_id, ids, 0, *cut_places(sentences, len(ids))))
        self.waiting += len(ids)

    def cut(self, final: bool) -> list[tuple]:
        """Pieces of the sequences that are settled now."""
        places, costs, base = [], [], 0
        for _, ids, used, own, own_costs in self.docs:
            if used:
                keep = own > used
                own, own_costs = own[keep], own_costs[keep]
            places.append(own + (base - used))
            costs.append(own_costs)
            base += len(ids) - used
        cuts = best_cuts(np.concatenate(places), np.concatenate(costs), self.window, final) if places else []
        pieces, left = [], deque(self.docs)
        done = 0
        for cut in cuts:
            offset = 0
            while done < cut:
                doc_id, ids, used, own, own_costs = left.popleft()
                size = min(cut - done, len(ids) - used)
                pieces.append(
                    (doc_id, used, size, ids[used : used + size].tobytes(), len(ids), self.next_id, offset)
                )
                done, offset, used = done + size, offset + size, used + size
                if used < len(ids):
                    left.appendleft((doc_id, ids, used, own, own_costs))
            self.next_id += 1
        self.docs, self.waiting = list(left), self.waiting - done
        return pieces


def _as_batch(pieces: list[tuple]) -> pa.RecordBatch:
    doc_id, start, length, ids, tokens, sequence, offset = zip(*pieces)
    whole = pa.int64()
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_id, whole), pa.array(start, whole), pa.array(length, whole), pa.array(ids, pa.binary()),
         pa.array(tokens, whole), pa.array(sequence, whole), pa.array(offset, whole)],
        names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
    )


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of the sequences, with their ids as little-endian 32-bit numbers.

    ``tokenizer`` is the path of a byte-level vocabulary for ``tokenizers``, seen
    by every worker. A null text counts as empty: its document is the end id
    alone. Each row is packed by itself, repeated rows and null ids included;
    columns other than ``doc_id`` and ``text`` are ignored. Empty input gives no
    pieces. Sequence ids are unique, and ascend within a partition of the input.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer)
        stream = _Stream(window, TaskContext.get().partitionId() << 33)
        last = np.array([end_id], "<u4")
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode.encode(text or "")
                stream.add(doc_id, np.concatenate([ids, last]), encode.sentence_ends(ids))
                if stream.waiting >= BLOCK and (pieces := stream.cut(final=False)):
                    yield _as_batch(pieces)
        if stream.docs:
            yield _as_batch(stream.cut(final=True))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)
