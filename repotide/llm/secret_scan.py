"""Secrets in texts: broad candidate patterns, then a random forest against false alarms.

Candidates are values of assignments to names that end like ``password``, long
runs of key-like characters with a digit, an inner capital letter or the prefix
of a known kind of key, and private key blocks. The forest reads a
candidate's length, its transitions between character classes, how much of it
words of its own document or a short list cover, the document's path and the
neighbouring words. It learns from labelled findings; since no table holds any,
:func:`labelled_findings` writes a seeded set of them by rule. Private key
blocks are certain by their frame and bypass the forest.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import add_column, unused

THRESHOLD = 0.5
TREES, DEPTH, LEAF = 40, 10, 3
MAX_FINDINGS = 20_000
MASK = "[SECRET]"

KEYWORDS = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key",
            "access_key", "auth", "credential", "bearer", "key")
HARMLESS = ("example", "sample", "test", "dummy", "placeholder", "changeme", "your", "sha",
            "commit", "checksum", "uuid", "version", "isbn", "phone", "card", "date", "build")
FINDING = "array<struct<start:int,end:int,score:double>>"

_BLOCK_EDGE = re.compile(r"-----(BEGIN|END) [A-Z ]{0,40}PRIVATE KEY-----")
_NAMED = re.compile(
    r"(?i)(?:password|passwd|pwd|secret|token|credential|auth|(?:api|access)[_-]?key)[\"']?\s{0,3}$"
)
_VALUE = re.compile(r"\s{0,3}(?:\"([^\"\n]{6,200})\"|'([^'\n]{6,200})'|[\"']?([^\s\"',;]{6,}))")
_SIGN = re.compile(r"[:=]")
_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "glpat-", "sk_", "sk-", "xox")
_TELLING = re.compile(rf"[0-9]|(?<=[A-Za-z])[A-Z]|(?<![A-Za-z0-9])(?:{'|'.join(_PREFIXES)})")
_KEY_LIKE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-")
_RUN = re.compile(r"[A-Za-z0-9+/_=.\-]*")
_WORD = re.compile(r"[^\W\d_]{3,}")
_BESIDE = 48


@dataclass(frozen=True)
class Finding:
    start: int
    end: int
    value: str
    before: str
    after: str


def candidates(text: str) -> list[Finding]:
    """Every candidate of a whole text, by position, none inside another.

    Digits, inner capitals, known prefixes and assignment signs are rare, so the
    search starts from them.
    """
    spans = set()
    for sign in _SIGN.finditer(text):
        if _NAMED.search(text[max(0, sign.start() - 24) : sign.start()]):
            value = _VALUE.match(text, sign.end())
            if value:
                spans.add(value.span(value.lastindex))
    at = 0
    while sign := _TELLING.search(text, at):
        start, at = sign.start(), _RUN.match(text, sign.start()).end()
        while start and text[start - 1] in _KEY_LIKE:
            start -= 1
        body = text[start:at].rstrip("=.-")
        cut = body.rfind("=") + 1
        value = body[cut:]
        if len(value) >= 12 and _TELLING.search(value):
            spans.add((start + cut, start + len(body)))
    found, last = [], 0
    for start, end in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= last:
            found.append(
                Finding(start, end, text[start:end], text[max(0, start - _BESIDE) : start],
                        text[end : end + _BESIDE])
            )
            last = end
    return found


def _classes(value: str) -> np.ndarray:
    return np.array([0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in value])


def _coverage(value: str, words: set[str]) -> float:
    """Share of the value's characters inside dictionary words of three letters or more."""
    low = value.lower()
    covered = np.zeros(len(low), bool)
    for m in _WORD.finditer(low):
        run, at = m.group(), m.start()
        i = 0
        while i < len(run):
            size = next((n for n in range(min(24, len(run) - i), 2, -1) if run[i : i + n] in words), 0)
            covered[at + i : at + i + size] = True
            i += size or 1
    return float(covered.mean()) if len(low) else 0.0


_BASE_WORDS = {w for w in KEYWORDS + HARMLESS if w.isalpha()} | {
    "user", "name", "file", "config", "admin", "default", "server", "data", "index", "page",
    "image", "http", "https", "www", "com", "org", "net", "html", "release", "beta", "alpha",
}
NEIGHBOUR_PLACES = 16


def features(f: Finding, path: str | None, words: set[str]) -> list[float]:
    value = f.value
    size = max(len(value), 1)
    kinds = _classes(value)
    steps = np.bincount(kinds[:-1] * 4 + kinds[1:], minlength=16) / max(size - 1, 1)
    shares = np.bincount(kinds, minlength=4) / size
    _, counts = np.unique(list(value) or [""], return_counts=True)
    p = counts / counts.sum()
    entropy = float(-(p * np.log2(p)).sum())
    low_before = f.before.lower()
    beside = re.findall(r"[\w-]+", low_before)[-4:] + re.findall(r"[\w-]+", f.after.lower())[:2]
    places = np.zeros(NEIGHBOUR_PLACES)
    for word in beside:
        places[zlib.crc32(word.encode("utf-8", "surrogatepass")) % NEIGHBOUR_PLACES] = 1
    near = " ".join(beside)
    # What the value is called; a word further off, as of a mail address, tells nothing of it.
    name = " ".join(re.findall(r"[\w-]+", low_before)[-2:])
    where = (path or "").lower()
    joined = low_before[-1:] in ("/", "\\", ":", "#", "?", "&", "@")
    return [
        size, entropy, entropy / np.log2(size + 1), len(counts) / size, *shares, *steps,
        max((len(m) for m in re.findall(r"[A-Za-z]+", value)), default=0),
        max((len(m) for m in re.findall(r"\d+", value)), default=0),
        float(bool(re.fullmatch(r"[0-9a-fA-F]+", value))),
        value.count("."), value.count("-"), value.count("/"),
        _coverage(value, words),
        float(any(k in near for k in KEYWORDS)),
        float(any(k in name or k in value.lower() for k in HARMLESS)),
        float(low_before.rstrip("\"' ")[-1:] in ("=", ":") and not low_before.endswith("//")),
        float(joined), float(low_before.rsplit(None, 1)[-1:] != [] and "://" in low_before.rsplit(None, 1)[-1]),
        float(any(k in where for k in ("test", "example", "doc", "fixture", "sample"))),
        float(any(k in where for k in ("config", "env", "secret", "deploy"))),
        *places,
    ]


class Forest:
    """Gini trees on bootstrap samples, each cut chosen among random features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.trees = []
        for _ in range(TREES):
            rows = rng.integers(0, len(y), len(y))
            nodes: list = []
            self._grow(x[rows], y[rows], 0, nodes, rng)
            self.trees.append(tuple(np.array(c) for c in zip(*nodes)))

    def _grow(self, x, y, depth, nodes, rng) -> int:
        me = len(nodes)
        nodes.append((-1, 0.0, 0, 0, float(y.mean())))
        if depth == DEPTH or len(y) < 2 * LEAF or y.min() == y.max():
            return me
        best = None
        for f in rng.choice(x.shape[1], int(np.sqrt(x.shape[1])) + 2, replace=False):
            order = np.argsort(x[:, f], kind="stable")
            v, hits = x[order, f], np.cumsum(y[order])
            cut = np.flatnonzero(v[1:] > v[:-1]) + 1
            cut = cut[(cut >= LEAF) & (cut <= len(y) - LEAF)]
            if len(cut):
                left, right = hits[cut - 1] / cut, (hits[-1] - hits[cut - 1]) / (len(y) - cut)
                impure = cut * left * (1 - left) + (len(y) - cut) * right * (1 - right)
                i = impure.argmin()
                if best is None or impure[i] < best[0]:
                    low, high = v[cut[i] - 1], v[cut[i]]
                    # Between neighbouring floats there is none to take.
                    middle = (low + high) / 2
                    best = impure[i], f, middle if middle < high else low
        if best is not None:
            goes = x[:, best[1]] <= best[2]
            left = self._grow(x[goes], y[goes], depth + 1, nodes, rng)
            right = self._grow(x[~goes], y[~goes], depth + 1, nodes, rng)
            nodes[me] = (int(best[1]), float(best[2]), left, right, nodes[me][4])
        return me

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, limit, left, right, share in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(DEPTH):
                goes = x[np.arange(len(x)), np.maximum(feature[at], 0)] <= limit[at]
                at = np.where(feature[at] < 0, at, np.where(goes, left[at], right[at]))
            total += share[at]
        return total / len(self.trees)


def labelled_findings(count: int = 6000, seed: int = 5) -> list[tuple]:
    """``(value, before, after, path, label)`` by seeded rules, half of them secrets."""
    rng = np.random.default_rng(seed)
    pick = lambda items: items[rng.integers(len(items))]
    draw = lambda chars, n: "".join(chars[i] for i in rng.integers(0, len(chars), n))
    hexes, upper = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    digits, lower = "0123456789", "abcdefghijklmnopqrstuvwxyz"
    variable = lambda: pick(("", "", "DB_", "my_", "client_", "user", "app."))
    mixed = upper + "abcdefghijklmnopqrstuvwxyz0189"
    syllables = ("th", "er", "an", "re", "on", "en", "at", "or", "ing", "ion", "ha", "st", "le", "qu", "io", "de")
    word = lambda: "".join(pick(syllables) for _ in range(rng.integers(1, 5)))
    prose = lambda: " ".join(word() for _ in range(4))
    named = lambda: pick(("password", "token", "secret", "api_key", "auth", "passwd"))
    assign = lambda: named() + pick(("=", " = \"", ": ", "='", "=\""))
    secrets = (
        lambda: ("AKIA" + draw(upper, 16), prose() + " "),
        lambda: (pick(("ghp_", "gho_", "glpat-", "xoxb-", "sk_live_")) + draw(mixed, rng.integers(20, 40)), prose() + " "),
        lambda: (draw(hexes, pick((18, 24, 32, 40, 64))), prose() + " " + assign()),
        lambda: (draw(hexes, pick((32, 40))), prose() + " " + assign()),
        lambda: (draw(mixed + "+/", rng.integers(16, 48)), prose() + " " + assign()),
        lambda: (draw(mixed + "!$%&", rng.integers(8, 20)), prose() + " " + assign()),
        lambda: (draw(mixed, rng.integers(24, 60)), prose() + " " + pick(("bearer ", "token "))),
        lambda: (pick(("sk_live_", "sk-", "ghp_", "glpat-")) + draw(lower, rng.integers(20, 32)), prose() + " "),
        # Words are secrets too, where a name says so and they hold no placeholder.
        lambda: (word() + word() + word(), prose() + " " + variable() + assign()),
        lambda: (word() + pick("-_.") + word() + draw(digits, rng.integers(0, 3)), prose() + " " + variable() + assign()),
        lambda: (" ".join(word() for _ in range(rng.integers(3, 6))), prose() + " " + variable() + named() + pick((": \"", "=\"", " = '"))),
    )
    kinds = ("string", "required", "optional", "missing", "invalid", "expired", "redacted", "hidden", "unknown")
    stand_ins = (
        lambda: "<" + word() + ">", lambda: "<" + word() + pick("-_") + named() + ">", lambda: "${" + word().upper() + "}", lambda: "$" + word().upper() + "_" + word().upper(),
        lambda: pick(("your", "my")) + pick("-_") + word() + pick(("", "-here", "_here")), lambda: "*" * rng.integers(6, 12),
        lambda: "x" * rng.integers(6, 16), lambda: pick(("example", "sample", "test", "dummy")) + pick("-_") + word(),
        lambda: "os.environ['" + word().upper(), lambda: "get" + word().title() + "()",
    )
    dashed = lambda: "-".join(draw(hexes, n) for n in (8, 4, 4, 4, 12))
    harmless = (
        lambda: (draw(digits, rng.integers(12, 20)), prose() + " "),
        lambda: (dashed(), pick(("uuid: ", prose() + " ", "id="))),
        lambda: (draw(hexes, 40), pick(("commit ", "sha1 ", "checksum: ", "https://host/tree/"))),
        lambda: (word() + pick("_-./") + word() + draw(digits, 2) + pick("_-./") + word(), prose() + " "),
        lambda: (word() + word() + word() + draw(digits, rng.integers(1, 4)), prose() + " "),
        lambda: (pick(("changeme", "yourpassword", "example123", "test_token_1", "xxxxxxxxxxxx", "placeholder1")), assign()),
        lambda: (pick(stand_ins)(), prose() + " " + variable() + assign()),
        lambda: (pick(stand_ins)(), prose() + " " + variable() + assign()),
        lambda: (pick(kinds), prose() + " " + named() + pick((": ", " = ", "="))),
        lambda: (f"20{draw(digits, 2)}-{draw(digits, 2)}-{draw(digits, 2)}T{draw(digits, 2)}", prose() + " "),
        lambda: (".".join(draw(digits, 3) for _ in range(4)), prose() + " "),
        lambda: ("/".join([word(), word(), word() + draw(digits, 3) + ".html"]), "https://" + word() + ".com/"),
        lambda: ("".join(word().title() for _ in range(rng.integers(2, 5))) + draw(digits, rng.integers(0, 2)), prose() + " "),
        lambda: (word() + "".join(word().title() for _ in range(rng.integers(1, 4))), prose() + " "),
        lambda: ((word() + word() + word()).upper(), prose() + " "),
        lambda: (pick("_-./").join(word().upper() for _ in range(rng.integers(2, 5))), prose() + " "),
        lambda: ("/".join(word().title() for _ in range(3)) + pick((".java", ".md", "")), prose() + " "),
        lambda: (f"v{draw(digits, 1)}.{draw(digits, 2)}.{draw(digits, 1)}-beta.{draw(digits, 2)}", "version "),
    )
    rows = []
    for i in range(count):
        value, before = pick(secrets if i % 2 else harmless)()
        path = pick(("src0", "src7", "config/app.env", "docs/example.md", "", "tests/sample.py", "deploy/x"))
        rows.append((value, before, " " + prose(), path, i % 2))
    return rows


def train(findings: list[tuple]) -> Forest:
    """A forest from ``(value, before, after, path, label)`` rows of both labels."""
    x = [
        features(Finding(0, len(v), v, b[-_BESIDE:], a[:_BESIDE]), path, _vocabulary(f"{b} {a}"))
        for v, b, a, path, _ in findings
    ]
    return Forest(np.array(x), np.array([label for *_, label in findings], float))


def train_from(findings: DataFrame, max_rows: int = MAX_FINDINGS) -> Forest:
    """The same from a table of those columns; at most ``max_rows``, by hash, are learnt."""
    columns = ("value", "before", "after", "path", "label")
    usable = findings.filter("value is not null and label in (0, 1)").select(
        "value", *(F.coalesce(c, F.lit("")).alias(c) for c in columns[1:4]), "label"
    )
    return train([tuple(r) for r in usable.orderBy(F.xxhash64(*columns), *columns).limit(max_rows).collect()])


def _vocabulary(text: str) -> set[str]:
    return _BASE_WORDS | {w for w in _WORD.findall(text.lower())}


def key_blocks(text: str) -> list[tuple[int, int]]:
    """Private keys between their first and last lines; a first line without a last one is none."""
    found, start = [], None
    if "-----BEGIN" in text:
        for edge in _BLOCK_EDGE.finditer(text):
            if edge.group(1) == "BEGIN":
                start = edge.start() if start is None else start
            elif start is not None:
                found.append((start, edge.end()))
                start = None
    return found


def scan_texts(texts: list, paths: list, forest: Forest) -> list[list[tuple[int, int, float]]]:
    """``(start, end, score)`` of the candidates and key blocks of each text, in code points."""
    found, owners, rows = [], [], []
    for text, path in zip(texts, paths):
        text = text or ""
        blocks = [(*span, 1.0) for span in key_blocks(text)]
        open_ones = [
            f for f in candidates(text) if not any(s < f.end and f.start < e for s, e, _ in blocks)
        ]
        if open_ones:
            ends = [0, *(f.end for f in open_ones)]
            starts = [*(f.start for f in open_ones), len(text)]
            words = _vocabulary(" ".join(text[e:s] for e, s in zip(ends, starts)))
            rows += [features(f, path, words) for f in open_ones]
            owners += [(len(found), f) for f in open_ones]
        found.append(blocks)
    if rows:
        for (i, f), score in zip(owners, forest.predict(np.array(rows))):
            found[i].append((f.start, f.end, float(score)))
    return [sorted(spans) for spans in found]


def scan(docs: DataFrame, forest: Forest, path: str = "source") -> DataFrame:
    """``docs`` with ``findings``: every candidate with its score, true or false.

    Null and empty texts have none; a missing path counts as empty. All columns
    pass through (one named ``findings`` is replaced), repeated rows each get
    their findings.
    """
    own = [c for c in docs.columns if c.lower() != "findings"]
    seen = unused([*own, "findings"], "scan")
    packed = docs.select(*own, F.struct("text", F.col(path).cast("string").alias("path")).alias(seen))

    def values(rows: list) -> pa.Array:
        spans = scan_texts([r["text"] for r in rows], [r["path"] for r in rows], forest)
        found = [[{"start": s, "end": e, "score": p} for s, e, p in own] for own in spans]
        kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
        return pa.array(found, pa.list_(kind))

    return add_column(packed, "findings", FINDING, values, text=seen).drop(seen)


def redacted(docs: DataFrame, forest: Forest, path: str = "source", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by :data:`MASK`; no row goes."""
    own = docs.columns
    seen, masked_text = unused(own, "scan"), unused(own, "masked")
    packed = docs.withColumn(seen, F.struct("text", F.col(path).cast("string").alias("path")))

    def values(rows: list) -> pa.Array:
        texts, masked = [r["text"] for r in rows], []
        for text, spans in zip(texts, scan_texts(texts, [r["path"] for r in rows], forest)):
            for start, end, p in reversed(spans):
                if p >= threshold:
                    text = text[:start] + MASK + text[end:]
            masked.append(text)
        return pa.array(masked, pa.string())

    safe = add_column(packed, masked_text, "string", values, text=seen)
    return safe.select(*(F.col(masked_text).alias("text") if c == "text" else F.col(f"`{c}`") for c in own))
