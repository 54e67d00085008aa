"""BPE encoding and decoding, with a segment tree over the ranks of adjacent pairs.

Each leaf of the tree holds the rank of one pair of neighbouring symbols, ties
broken by position, so the root yields the leftmost pair of lowest rank. A merge
changes three leaves at most; a word of n symbols takes n log n steps, however
long it is. Words are merged once and remembered by the worker.

The vocabulary file is one of the ``tokenizers`` library with word ends, lower
case and byte-level letters. Its rules are carried out here; the library itself
normalizes and splits only runs with characters that this Python's Unicode
tables do not know.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import by_batch, prepare

ENCODED = "doc_id long, ids array<int>, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
# Words a worker remembers before it starts anew.
MAX_KNOWN = 600_000

# Fixed value: the split pattern of the vocabulary.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Control characters that Python takes for white space and the vocabulary does not.
_ODD = re.compile("[\x1c-\x1f]")


def merge(symbols: list[int], ranks: dict[int, int], merged: list[int], shift: int) -> list[int]:
    """``symbols`` after all merges; ``ranks`` is keyed by ``left << shift | right``."""
    n = len(symbols)
    if n < 2:
        return symbols
    symbols = list(symbols)
    none = len(merged) * n
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    tree = [none] * (2 * size)
    for i in range(n - 1):
        rank = ranks.get(symbols[i] << shift | symbols[i + 1])
        if rank is not None:
            tree[size + i] = rank * n + i
    for p in range(size - 1, 0, -1):
        left, right = tree[2 * p], tree[2 * p + 1]
        tree[p] = left if left < right else right
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while tree[1] != none:
        rank, i = divmod(tree[1], n)
        j = after[i]
        symbols[i] = merged[rank]
        symbols[j] = -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for leaf in (before[i], i, j):
            if leaf < 0 or leaf >= n - 1:
                continue
            value = none
            if leaf != j and after[leaf] < n:
                rank = ranks.get(symbols[leaf] << shift | symbols[after[leaf]])
                if rank is not None:
                    value = rank * n + leaf
            p = size + leaf
            tree[p] = value
            p >>= 1
            while p:
                left, right = tree[2 * p], tree[2 * p + 1]
                low = left if left < right else right
                if tree[p] == low:
                    break
                tree[p] = low
                p >>= 1
    return [s for s in symbols if s >= 0]


class Vocabulary:
    """Encoding and decoding by one vocabulary file."""

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = {i: s for s, i in (self.ids | self.special).items()}
        self.shift = max(self.tokens).bit_length()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merged = [self.ids[a + b] for a, b in pairs]
        self.ranks: dict[int, int] = {}
        for rank, (a, b) in enumerate(pairs):
            self.ranks.setdefault(self.ids[a] << self.shift | self.ids[b], rank)
        # Byte-level letters: printable Latin-1 bytes are themselves, the rest follow at 256.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        self.letters = {b: chr(256 + i) for i, b in enumerate(rest)}
        self.words = regex.compile(WORDS).findall
        self.library = Tokenizer.from_file(path)
        self.spaces = regex.compile(r"\s+")
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.known: dict[str, tuple[str, str]] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}

    def _piece(self, piece: str) -> tuple[int, ...]:
        found = self.pieces.get(piece)
        if found is None:
            if len(self.pieces) > MAX_KNOWN:
                self.pieces.clear()
            letters = piece.encode("utf-8", "replace").decode("latin-1").translate(self.letters)
            found = self.pieces[piece] = self._merged(letters)
        return found

    def _merged(self, letters: str) -> tuple[int, ...]:
        start = [self.ids[c] for c in letters[:-1]] + [self.ids[letters[-1] + self.suffix]]
        return tuple(merge(start, self.ranks, self.merged, self.shift))

    def run(self, chunk: str) -> list[int]:
        """Ids of a run of characters without white space or special tokens."""
        if not chunk.isascii() and any(unicodedata.category(c) == "Cn" for c in chunk):
            known = self.library.normalizer.normalize_str(chunk)
            pieces = self.library.pre_tokenizer.pre_tokenize_str(known)
            return [i for letters, _ in pieces for i in self._merged(letters)]
        plain = unicodedata.normalize("NFC", chunk)
        # One character at a time: a final sigma is no special case here.
        lower = "".join(map(str.lower, plain)) if "Σ" in plain else plain.lower()
        return [i for piece in self.words(lower) for i in self._piece(piece)]

    def _chunks(self, text: str) -> list[str]:
        if _ODD.search(text):
            return [c for c in self.spaces.split(text) if c]
        return text.split()

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; null counts as empty."""
        ids: list[int] = []
        for i, part in enumerate(self.cut.split(text or "")):
            if i % 2:
                ids.append(self.special[part])
            else:
                for chunk in self._chunks(part):
                    ids += self.run(chunk)
        return ids

    def decode(self, ids: list[int]) -> str:
        """The ids' strings, special tokens included; the file names no decoder."""
        return " ".join([self.tokens[i] for i in ids])

    def digest_forms(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, the ids in decimal, and the decoded text."""
        known, numbers, strings = self.known, [], []
        for i, part in enumerate(self.cut.split(text or "")):
            if i % 2:
                numbers.append(str(self.special[part]))
                strings.append(part)
                continue
            for chunk in self._chunks(part):
                form = known.get(chunk)
                if form is None:
                    if len(known) > MAX_KNOWN:
                        known.clear()
                    ids = self.run(chunk)
                    form = known[chunk] = (" ".join(map(str, ids)), self.decode(ids))
                numbers.append(form[0])
                strings.append(form[1])
        decimal = " ".join(numbers)
        return decimal.count(" ") + 1 if decimal else 0, decimal, " ".join(strings)


@cache
def vocabulary(path: str) -> Vocabulary:
    """One per worker; what it has learnt serves the worker's later tasks."""
    return Vocabulary(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded`` of every row's whole text.

    Null and empty texts have no ids and decode to an empty text. Repeated rows
    and null ids each give a row; other columns are ignored.
    """
    prepare(docs.sparkSession)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = vocabulary(path)
        ids = [words.encode(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(map(words.decode, ids), pa.string())],
            names=["doc_id", "ids", "decoded"],
        )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.mapInArrow(by_batch(step), ENCODED)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """The same as SHA-256 digests, made where the ids are, so that they need not travel."""
    prepare(docs.sparkSession)

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = vocabulary(path)
        forms = [words.digest_forms(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([n for n, _, _ in forms], pa.int64()),
                pa.array([sha(numbers) for _, numbers, _ in forms]),
                pa.array([sha(decoded) for _, _, decoded in forms]),
            ],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.mapInArrow(by_batch(step), DIGESTS)
