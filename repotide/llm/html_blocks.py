"""Main text of web pages by a recurrent labeller of their blocks.

A page is cut into its leaf blocks: runs of text between block-level tags. Each
block becomes a vector of its hashed tag path (tags, class and id words), its
hashed words and a few measures. A bidirectional LSTM, in numpy, reads the whole
sequence of a page's blocks and labels each one as article or not, so that a
block's neighbours on both sides count.

It learns from pages written by seeded rules, whose labels are known, and from a
bounded sample of the given pages whose blocks lie under telling tags.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import add_column, prepare

PATH_PLACES, WORD_PLACES, MEASURES = 96, 32, 6
WIDTH = PATH_PLACES + WORD_PLACES + MEASURES
HIDDEN = 16
EPOCHS, BATCH, RATE = 14, 64, 0.02
# Blocks of a batch with its padding, and steps whose input product is made at once.
PADDED, STRETCH = 16_384, 2_048
SAMPLE_PAGES = 200
WRITTEN_PAGES = 600

# Raw text runs to its end tag or the end of the page; other silent elements
# are skipped only where their end tag is there.
_RAW = "script|style|title"
_SILENT = frozenset("noscript template svg iframe object textarea select".split())
_IN_HEAD = frozenset("base link meta noscript template".split())
_SILENT_TAG = re.compile(rf"<(/?)({'|'.join(sorted(_SILENT))})(?=[\s/>])[^>]*>", re.I)
# A tag with an unclosed quote ends at the next bracket.
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>|<[!?][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_INLINE = frozenset(
    "a abbr b bdi bdo big cite code data dfn del em font i img ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr br".split()
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_CLOSED_BY = {"p": None, "li": ("ul", "ol"), "td": ("tr",), "th": ("tr",), "tr": ("table",), "dt": ("dl",), "dd": ("dl",)}


class Place:
    """An open element: its names, and in bits the names of all elements it is in."""

    __slots__ = ("parent", "names", "bits", "telling")

    def __init__(self, parent: Place | None, names: tuple[str, ...]) -> None:
        self.parent, self.names = parent, names
        self.bits, self.telling = _bits(names)
        if parent:
            self.bits |= parent.bits
            self.telling |= parent.telling


@dataclass
class Block:
    place: Place | None
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""

    @property
    def path(self) -> tuple[str, ...]:
        """Names of the elements around the block, outermost first."""
        found, place = [], self.place
        while place:
            found.append(place.names)
            place = place.parent
        return tuple(n for names in reversed(found) for n in names)


def _silent_ends(html: str) -> dict[int, int]:
    """Where the silent elements that have an end tag start and end; an end tag belongs to the nearest start."""
    started: dict[str, list[int]] = {}
    ends = {}
    # Behind the last bracket no tag ends.
    for m in _SILENT_TAG.finditer(html, 0, html.rfind(">") + 1):
        name = m.group(2).lower()
        if m.group(1):
            if started.get(name):
                ends[started[name].pop()] = m.end()
        elif name != "svg" or not m.group().endswith("/>"):
            started.setdefault(name, []).append(m.start())
    return ends


def blocks(html: str | None) -> list[Block]:
    """Leaf blocks with text, in page order, from the whole page.

    Unclosed and stray tags are put up with: a block-level tag ends an open
    paragraph, an end tag closes what is open inside its element. A head without
    end tag ends at the first tag that cannot be in it, and of a silent element
    without end tag only the tag is skipped.
    """
    html = html or ""
    stack: list[tuple[str, Place]] = []
    # Depths at which each element is open.
    depths: dict[str, list[int]] = {}
    found: list[Block] = []
    current = Block(None)
    link, at = 0, 0

    def close() -> None:
        nonlocal current
        current.text = " ".join("".join(current.parts).split())
        if current.text:
            found.append(current)
        current = Block(stack[-1][1] if stack else None)

    def pop(name: str, within: tuple[str, ...] = ()) -> bool:
        """Close the innermost ``name`` and all inside it, unless it lies beyond ``within``."""
        own = depths.get(name)
        if not own or any(depths.get(w, [-1])[-1:] > own[-1:] for w in within):
            return False
        depth = own[-1]
        while len(stack) > depth:
            depths[stack.pop()[0]].pop()
        return True

    def write(piece: str) -> None:
        if piece:
            # References are decoded by stretch: none reaches over a tag.
            piece = unescape(piece)
            current.parts.append(piece)
            if link:
                current.linked += len(piece)

    silent_ends = _silent_ends(html)
    limit = html.rfind(">") + 1
    # Text of an open head: dropped at its end tag, part of the page without one.
    held: list[str] | None = None
    while m := _TOKEN.search(html, at, limit):
        (write if held is None else held.append)(html[at : m.start()])
        at = m.end()
        name = m.group(3)
        if name is None:
            if at == limit and _unclosed(m):
                at = len(html)
            continue
        name, ends = name.lower(), m.group(2) == "/"
        if name == "head":
            held = None if ends else held or []
            continue
        if held is not None and name not in _IN_HEAD:
            write("".join(held))
            held = None
        if name in _SILENT:
            at = silent_ends.get(m.start(), at)
            continue
        if name in _INLINE:
            if name == "a":
                link = 0 if ends else 1
            elif name == "br":
                write(" ")
            continue
        if ends:
            if depths.get(name):
                close()
                pop(name)
                link = 0
                current.place = stack[-1][1] if stack else None
            continue
        close()
        pop("p")
        if name in _CLOSED_BY and name != "p":
            pop(name, _CLOSED_BY[name])
        if name not in _VOID:
            depths.setdefault(name, []).append(len(stack))
            stack.append((name, Place(stack[-1][1] if stack else None, _names(name, m.group(4) or ""))))
        current.place = stack[-1][1] if stack else None
    write("".join(held or ()))
    write(html[at:].split("<!--", 1)[0])
    close()
    return found


def _unclosed(m: re.Match) -> bool:
    """A comment or raw text that goes on to the end of the page."""
    if m.group(1):
        return not re.search(rf"</{m.group(1)}\s*>\Z", m.string[max(m.start(), m.end() - 64) : m.end()], re.I)
    return m.group()[:4] == "<!--" and m.group()[-3:] != "-->"


@lru_cache(4096)
def _names(tag: str, attributes: str) -> tuple[str, ...]:
    words = [w for groups in _NAMES.findall(attributes) for w in re.split(r"[\s_-]+", "".join(groups).lower()) if w]
    return (tag, *(f".{w}" for w in words))


class _Places(dict):
    """Hash places of words, remembered by the worker."""

    def __init__(self, places: int) -> None:
        super().__init__()
        self.places = places

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        place = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % self.places
        return place


_PATH, _WORDS = _Places(PATH_PLACES), _Places(WORD_PLACES)
_MAIN = frozenset(("article", "main"))
_ASIDE = frozenset("nav header footer aside form .ad .ads .comments .sidebar .cookie .notice".split())


@lru_cache(4096)
def _bits(names: tuple[str, ...]) -> tuple[int, int]:
    """Hash places of names, and whether they tell of an article (1) or of what is none (2)."""
    bits = 0
    for name in names:
        bits |= 1 << _PATH[name]
    return bits, (1 if _MAIN & set(names) else 0) | (2 if _ASIDE & set(names) else 0)


def vectors(page: list[Block]) -> np.ndarray:
    """One row per block."""
    x = np.zeros((len(page), WIDTH), np.float32)
    packed = b"".join((b.place.bits if b.place else 0).to_bytes(PATH_PLACES // 8, "little") for b in page)
    bits = np.unpackbits(np.frombuffer(packed, np.uint8).reshape(len(page), PATH_PLACES // 8), axis=1, bitorder="little")
    x[:, :PATH_PLACES] = bits
    for i, block in enumerate(page):
        words = block.text.lower().split()
        at = np.bincount([_WORDS[w] for w in words], minlength=WORD_PLACES)
        x[i, PATH_PLACES : PATH_PLACES + WORD_PLACES] = at / len(words)
        size = len(block.text)
        x[i, -MEASURES:] = (
            np.log1p(size) / 8, np.log1p(len(words)) / 6, min(block.linked / size, 1),
            sum(map(block.text.count, ".,;!?")) / size * 10, (i + 1) / len(page),
            block.place is not None and block.place.names[-1:] == ("p",),
        )
    return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _forward(x: np.ndarray, w: np.ndarray, mask: np.ndarray):
    """States of an LSTM over ``x (time, pages, width)``; ended pages keep their state."""
    steps, pages = x.shape[:2]
    h = np.zeros((steps + 1, pages, HIDDEN), x.dtype)
    c = np.zeros_like(h)
    gates = np.zeros((steps, pages, 4 * HIDDEN), x.dtype)
    inner = x @ w[:WIDTH] + w[-1]
    for t in range(steps):
        z = inner[t] + h[t] @ w[WIDTH:-1]
        z[:, : 3 * HIDDEN] = _sigmoid(z[:, : 3 * HIDDEN])
        z[:, 3 * HIDDEN :] = np.tanh(z[:, 3 * HIDDEN :])
        i, f, o, g = np.split(z, 4, axis=1)
        m = mask[t][:, None]
        c[t + 1] = m * (f * c[t] + i * g) + (1 - m) * c[t]
        h[t + 1] = m * (o * np.tanh(c[t + 1])) + (1 - m) * h[t]
        gates[t] = z
    return h, c, gates


def _backward(x, w, mask, h, c, gates, slope):
    """Gradient of the weights for ``slope``, that of the loss by the states."""
    grad = np.zeros_like(w)
    dh, dc = np.zeros_like(h[0]), np.zeros_like(c[0])
    for t in range(len(x) - 1, -1, -1):
        m = mask[t][:, None]
        i, f, o, g = np.split(gates[t], 4, axis=1)
        now, keep = (dh + slope[t]) * m, (dh + slope[t]) * (1 - m)
        squashed = np.tanh(c[t + 1])
        inside = dc * m + now * o * (1 - squashed**2)
        dz = np.concatenate(
            [inside * g * i * (1 - i), inside * c[t] * f * (1 - f), now * squashed * o * (1 - o), inside * i * (1 - g**2)],
            axis=1,
        )
        grad[:WIDTH] += x[t].T @ dz
        grad[WIDTH:-1] += h[t].T @ dz
        grad[-1] += dz.sum(axis=0)
        dh = dz @ w[WIDTH:-1].T + keep
        dc = inside * f + dc * (1 - m)
    return grad


def _stacked(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), WIDTH), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for j, page in enumerate(pages):
        x[: len(page), j] = page
        mask[: len(page), j] = 1
    return x, mask


@dataclass
class Labeller:
    """Weights of the two directions and of the output."""

    ahead: np.ndarray
    back: np.ndarray
    out: np.ndarray

    def _states(self, x, mask):
        ahead = _forward(x, self.ahead, mask)
        back = _forward(x[::-1], self.back, mask[::-1])
        joined = np.concatenate([ahead[0][1:], back[0][1:][::-1]], axis=2)
        return ahead, back, joined

    def predict(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of each block of each page to be article text."""
        found: list[np.ndarray] = [np.empty(0, np.float32)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        for own in _batches(order, [len(p) for p in pages]):
            x, mask = _stacked([pages[i] for i in own])
            states = _run(x, self.ahead, mask), _run(x[::-1], self.back, mask[::-1])[::-1]
            p = _sigmoid(np.concatenate(states, axis=2) @ self.out[:-1] + self.out[-1])
            for j, i in enumerate(own):
                found[i] = p[: len(pages[i]), j]
        return found


def _batches(order: list[int], sizes: list[int]) -> Iterator[list[int]]:
    """Pages of ascending length, so many that a batch padded to its longest stays small."""
    own: list[int] = []
    for i in order:
        if own and (len(own) == BATCH or sizes[i] * (len(own) + 1) > PADDED):
            yield own
            own = []
        own.append(i)
    if own:
        yield own


def _run(x: np.ndarray, w: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The states of :func:`_forward` alone; only those are kept."""
    steps, pages = x.shape[:2]
    # tanh(z) is 2 sigmoid(2 z) - 1, so one sigmoid does for all gates.
    double = np.concatenate([np.ones(3 * HIDDEN), np.full(HIDDEN, 2.0)]).astype(x.dtype)
    recurrent, open_ = w[WIDTH:-1] * double, mask.astype(bool)
    states = np.empty((steps, pages, HIDDEN), x.dtype)
    h = np.zeros((pages, HIDDEN), x.dtype)
    c = np.zeros_like(h)
    for first in range(0, steps, STRETCH):
        inner = (x[first : first + STRETCH] @ w[:WIDTH] + w[-1]) * double
        for t in range(len(inner)):
            z = h @ recurrent
            z += inner[t]
            np.maximum(z, -30, out=z)
            np.negative(z, out=z)
            np.exp(z, out=z)
            z += 1
            np.reciprocal(z, out=z)
            new_c = z[:, HIDDEN : 2 * HIDDEN] * c
            new_c += z[:, :HIDDEN] * (2 * z[:, 3 * HIDDEN :] - 1)
            new_h = z[:, 2 * HIDDEN : 3 * HIDDEN] * np.tanh(new_c)
            if open_[first + t].all():
                h, c = new_h, new_c
            else:
                on = open_[first + t][:, None]
                h, c = np.where(on, new_h, h), np.where(on, new_c, c)
            states[first + t] = h
    return states


def train(pages: list[np.ndarray], labels: list[np.ndarray], seed: int = 4) -> Labeller:
    """Adam on the mean log loss of the blocks."""
    rng = np.random.default_rng(seed)
    shape = (WIDTH + HIDDEN + 1, 4 * HIDDEN)
    model = Labeller(
        *(rng.normal(0, 0.1, shape).astype(np.float32) for _ in range(2)), np.zeros(2 * HIDDEN + 1, np.float32)
    )
    weights = [model.ahead, model.back, model.out]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    turn = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(pages))
        for start in range(0, len(order), BATCH):
            own = order[start : start + BATCH]
            x, mask = _stacked([pages[i] for i in own])
            y = np.zeros_like(mask)
            for j, i in enumerate(own):
                y[: len(labels[i]), j] = labels[i]
            ahead, back, joined = model._states(x, mask)
            off = (_sigmoid(joined @ model.out[:-1] + model.out[-1]) - y) * mask / mask.sum()
            slope = off[:, :, None] * model.out[:-1]
            out = np.append(np.einsum("tp,tph->h", off, joined), off.sum()).astype(np.float32)
            grads = [
                _backward(x, model.ahead, mask, *ahead, slope[:, :, :HIDDEN]),
                _backward(x[::-1], model.back, mask[::-1], *back, slope[::-1, :, HIDDEN:]),
                out,
            ]
            turn += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for w, g, a, b in zip(weights, grads, first, second):
                a *= 0.9
                a += 0.1 * g
                b *= 0.999
                b += 0.001 * g**2
                w -= rate * (a / (1 - 0.9**turn)) / (np.sqrt(b / (1 - 0.999**turn)) + 1e-8)
    return model


def told(page: list[Block]) -> np.ndarray | None:
    """Labels by telling tags; none if the page has no such article."""
    labels = np.array([b.place is not None and b.place.telling == 1 for b in page], np.float32)
    return labels if labels.any() else None


def written_pages(count: int = WRITTEN_PAGES, seed: int = 9) -> list[tuple[str, list[int]]]:
    """Pages by seeded rules, with the label of each block."""
    rng = np.random.default_rng(seed)
    syllables = "th er an re on en at or ing ion ha st le que ment de la ein sch ung ado ci".split()
    pick = lambda items: items[rng.integers(len(items))]
    word = lambda: "".join(pick(syllables) for _ in range(rng.integers(1, 5)))
    words = lambda low, high: " ".join(word() for _ in range(rng.integers(low, high)))
    sentence = lambda: words(3, 20).capitalize() + pick((".", ".", ",", "!"))
    prose = lambda: " ".join(sentence() for _ in range(rng.integers(1, 6)))
    named = lambda kind, names: f'<{kind} {pick(("class", "id"))}="{pick(names)}">'

    def listed(label):
        n = rng.integers(2, 8)
        items = "".join(f'<li><a href="/{word()}">{words(1, 4)}</a></li>' for _ in range(n))
        return f"<ul>{items}</ul>", [label] * n

    def menu():
        inner, labels = listed(0)
        return pick((f"<nav>{inner}</nav>", f"{named('div', ('menu', 'navbar', 'nav-main', 'breadcrumbs'))}{inner}</div>",
                     f"<header>{inner}</header>")), labels

    def small(names, tags=("div", "section")):
        kind, n = pick(tags), rng.integers(1, 4)
        inner = "".join(f"<p>{prose() if rng.random() < 0.5 else words(2, 8)}</p>" for _ in range(n))
        return f"{named(kind, names)}{inner}</{kind}>", [0] * n

    advert = lambda: (f"{named('div', ('ad', 'ads', 'advert', 'promo', 'sponsored', 'banner'))}{prose()}</div>", [0])
    notice = lambda: small(("cookie", "cookie-notice", "consent", "notice", "alert", "popup"))
    comments = lambda: small(("comments", "comment-list", "reader-comments", "responses", "discussion"))
    share = lambda: (f"{named('div', ('share', 'social', 'tags', 'meta', 'author-box'))}{words(1, 5)}</div>", [0])

    def form():
        return f"<form><p>{words(2, 8)}</p><label>{words(1, 3)}</label><input name=q><button>{word()}</button></form>", [0, 0, 0]

    def side():
        inner, labels = listed(0)
        kind = pick(("aside", "div"))
        start = "<aside>" if kind == "aside" else named("div", ("sidebar", "related", "widget", "side-column", "recommended"))
        return f"{start}<h3>{words(1, 4)}</h3>{inner}</{kind}>", [0, *labels]

    def footer():
        text = f"&copy; {word()} &middot; {sentence()}"
        return pick((f"<footer>{text}</footer>", f"<footer><p>{text}</p></footer>",
                     f"{named('div', ('footer', 'page-footer', 'copyright'))}{text}</div>")), [0]

    def unusual(count):
        texts = [f"{prose()} {prose()} {prose()}" for _ in range(count)]
        kind = pick(("div", "section", "section", "td", "dd", "figcaption", "bare"))
        if kind == "td":
            inner = "".join(f"<tr><td>{t}</td></tr>" for t in texts)
            return f"{pick(('<table>', named('table', ('layout', 'page', 'outer'))))}{inner}</table>", [1] * count
        if kind == "dd":
            inner = "".join(f"<dt>{words(1, 5)}</dt><dd>{t}</dd>" for t in texts)
            return f"<dl>{inner}</dl>", [1, 1] * count
        if kind == "figcaption":
            inner = "".join(f"<figure><img src=x.png><figcaption>{t}</figcaption></figure>" for t in texts)
            return f"<div>{inner}</div>", [1] * count
        if kind == "bare":
            return "<hr>".join(texts), [1] * count
        inner = "".join(f"<{kind}>{t}</{kind}>" for t in texts)
        return pick((inner, f"<div>{inner}</div>", f"<div><div>{inner}</div></div>")), [1] * count

    def article():
        parts, labels = [f"<h1>{words(2, 9)}</h1>"], [1]
        for _ in range(rng.integers(1, 12)):
            roll = rng.random()
            if roll < 0.62:
                parts.append(pick((f"<p>{prose()}</p>", f"<p><b>{prose()}<br>", f"<p>{prose()}", f"<p>{word()}.</p>")))
                labels.append(1)
            elif roll < 0.72:
                kind = pick(("h2", "h3", "blockquote", "pre"))
                parts.append(f"<{kind}>{words(1, 12)}</{kind}>")
                labels.append(1)
            elif roll < 0.8:
                n = rng.integers(2, 5)
                parts.append("<ul>" + "".join(f"<li>{words(1, 9)}</li>" for _ in range(n)) + "</ul>")
                labels += [1] * n
            else:
                inner, own = pick((advert, form, side, share))()
                parts.append(inner)
                labels += own
        if rng.random() < 0.3:
            # Prose counts whatever holds it.
            return unusual(pick((1, 2, 3, 6)))
        start, end = pick((
            ("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"),
            (named("div", ("content", "post-body", "entry-content", "story", "article-body", "main")), "</div>"),
        ))
        return start + "".join(parts) + end, labels

    pages = []
    for _ in range(count):
        before = [pick((menu, advert, notice, share, form)) for _ in range(rng.integers(0, 4))]
        after = [pick((side, comments, form, notice, menu, advert, share)) for _ in range(rng.integers(0, 4))]
        html, labels = "", []
        for part in [menu, *before, article, *after, footer]:
            inner, own = part()
            html += inner
            labels += own
        pages.append((f"<html><head><title>{words(1, 6)}</title></head><body>{html}</body></html>", labels))
    return pages


def fit(pages: DataFrame, max_pages: int = SAMPLE_PAGES) -> Labeller:
    """Learn from written pages and from at most ``max_pages`` given ones, by hash of their id."""
    prepare(pages.sparkSession)
    sample = pages.select("page_id", "html").filter("page_id is not null and html is not null")
    wanted = sample.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(max_pages)
    # At most max_pages ids are broadcast; of rows that share an id one is learnt.
    one = sample.join(F.broadcast(wanted), "page_id", "left_semi").groupBy("page_id").agg(F.min("html").alias("html"))
    given = one.toArrow().sort_by("page_id")
    x, y = [], []
    for html, labels in written_pages():
        page = blocks(html)
        if len(page) == len(labels):
            x.append(vectors(page))
            y.append(np.array(labels, np.float32))
    for html in given["html"].to_pylist():
        page = blocks(html)
        labels = told(page)
        if labels is not None:
            x.append(vectors(page))
            y.append(labels)
    return train(x, y)


def extract_pages(htmls: list, model: Labeller) -> list[str]:
    """Main text of each page: its article blocks, joined by a blank line."""
    pages = [blocks(h) for h in htmls]
    labels = model.predict([vectors(p) for p in pages])
    return ["\n\n".join(b.text for b, p in zip(page, own) if p >= 0.5) for page, own in zip(pages, labels)]


def extract(pages: DataFrame, model: Labeller, column: str = "html") -> DataFrame:
    """``pages`` with ``text``: the main text, empty for null or empty pages.

    All other columns and every row stay; a column named ``text`` is replaced.
    """

    def values(htmls: list) -> pa.Array:
        return pa.array(extract_pages(htmls, model), pa.string())

    return add_column(pages, "text", "string", values, text=column)
