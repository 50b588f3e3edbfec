"""Main text of web pages by a recurrent block labeller.

A page becomes a sequence of leaf blocks, each with the path of tags (and class
and id words) above it. A bidirectional LSTM in numpy reads, for every block,
a hashed vector of its tag path, a hashed vector of its words and a few shares,
and labels the block in the light of the whole document. Blocks labelled main
text are joined in page order.

The labeller is trained here, on pages that ``sample_page`` makes up: articles
among menus, headers, footers, sidebars, notices, adverts, forms and reader
comments, with and without telling tags. Training is seeded and takes seconds.

Defined results: null and empty html give empty text; unclosed and misnested
tags are taken as browsers mostly do (a new block ends an open paragraph);
scripts, styles, comments and the head are never blocks; a tag that never ends
is text, and once a quote in a tag is never closed, tags end at the next
greater sign; character references are decoded within a run of text, not
across tags; time and memory are linear in a page of any length; repeated rows
are labelled alike; extra columns, whatever their names, are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATH_DIM, WORD_DIM, HIDDEN = 128, 24, 16
EXTRAS = 8
WIDTH = PATH_DIM + WORD_DIM + EXTRAS

# Elements by their part in the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr br img".split())
UNSEEN = frozenset("script style noscript template iframe svg math canvas object audio video head title textarea select".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
                     "h6 header hr main menu nav ol p pre section table ul li".split())

OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?", re.S)
REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
ATTR = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPACE = re.compile(r"\s+")
# Elements that an open paragraph, or an open item of the same name, does not reach across.
HOLDS_P = ("table", "td", "th", "button")
ITEMS = frozenset("li dt dd tr td th option".split())
HOLDS_ITEMS = ("ul", "ol", "dl", "table", "tbody", "select", "div", "nav")


@dataclass
class Block:
    """Text of a leaf, how often each slot of the hashed path is named above it, its last two words' slots, and the path's length."""

    text: str
    counts: np.ndarray
    last: tuple[int, ...]
    depth: int
    linked: float = 0.0


class _Stack:
    """Open elements; everything a tag asks of them takes a few steps, however many there are."""

    def __init__(self):
        self.rows: list[tuple[str, tuple[int, ...]]] = []  # name, slots of its words (of none if inline)
        self.at: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        self.counts = np.zeros(PATH_DIM, np.int32)
        self.words: list[int] = []
        self.path: tuple[np.ndarray, tuple[int, ...], int] | None = None

    def last(self, *names: str) -> int:
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=-1)

    def push(self, name: str, words: list[str]) -> None:
        slots = () if name in INLINE else tuple(_slot(w) % PATH_DIM for w in words)
        self.at[name].append(len(self.rows))
        if name not in INLINE:
            self.blocks.append(len(self.rows))
            self.path = None
        self.rows.append((name, slots))
        for k in slots:
            self.counts[k] += 1
        self.words += slots

    def close(self, upto: int) -> None:
        while len(self.rows) > upto:
            name, slots = self.rows.pop()
            self.at[name].pop()
            if self.blocks and self.blocks[-1] == len(self.rows):
                self.blocks.pop()
                self.path = None
            for k in slots:
                self.counts[k] -= 1
            del self.words[len(self.words) - len(slots):]

    def place(self) -> tuple[np.ndarray, tuple[int, ...], int]:
        if self.path is None:
            self.path = self.counts.copy(), tuple(self.words[-2:]), len(self.words)
        return self.path


def blocks_of(page: str | None) -> list[Block]:
    """The leaf blocks of a page, in page order, with decoded and spaced text."""
    src = page or ""
    out: list[Block] = []
    stack = _Stack()
    parts: list[str] = []
    linked = 0

    def finish() -> None:
        nonlocal linked
        if parts:
            text = SPACE.sub(" ", "".join(parts)).strip()
            if text:
                out.append(Block(text, *stack.place(), min(1.0, linked / max(1, len(text)))))
            parts.clear()
            linked = 0

    def add(text: str) -> None:
        nonlocal linked
        parts.append(entities.unescape(text))
        if stack.at.get("a"):
            linked += len(text)

    at, end, quotes, ends = 0, len(src), True, src.rfind(">")
    while at < end:
        if src[at] != "<":
            nxt = src.find("<", at)
            nxt = end if nxt < 0 else nxt
            add(src[at:nxt])
            at = nxt
            continue
        if src[at + 1 : at + 2] in ("!", "?"):
            at = OTHER.match(src, at).end()
            continue
        named = NAME.match(src, at)
        if not named or named.end() > ends:
            add("<")
            at += 1
            continue
        m = REST.match(src, named.end()) if quotes else None
        quotes = m is not None
        stop = m.end() if m else src.index(">", named.end()) + 1
        tok, at, name = src[at:stop], stop, named.group(1).lower()
        block = name not in INLINE
        if tok[1] == "/":
            if block:
                finish()
            k = stack.last(name)
            if k >= 0 and (block or not stack.blocks or k > stack.blocks[-1]):
                stack.close(k)
            continue
        if name in UNSEEN:
            finish()
            if not tok.endswith("/>"):  # on to its end tag; a head without one ends where the body starts
                close = re.compile(rf"</{name}\s*>" + (r"|(?=<body[\s>])" if name == "head" else ""), re.I).search(src, at)
                at = close.end() if close else end
            continue
        if name == "br":
            parts.append(" ")
            continue
        if block:
            finish()
            if name in CLOSES_P:
                k = stack.last("p")
                if k > stack.last(*HOLDS_P):
                    stack.close(k)
            if name in ITEMS:
                k = stack.last(name)
                if k > stack.last(*HOLDS_ITEMS):
                    stack.close(k)
        if name in VOID or tok.endswith("/>"):
            continue
        words = [name]
        if block and len(tok) > len(name) + 2:
            for a in ATTR.finditer(tok):
                words += [f".{w}" for w in re.findall(r"[a-z]+", (a.group(1) or a.group(2) or a.group(3) or "").lower())]
        stack.push(name, words)
    finish()
    return out


_slots: dict[str, int] = {}


def _slot(word: str) -> int:
    k = _slots.get(word)
    if k is None:
        if len(_slots) > 200_000:
            _slots.clear()
        k = _slots[word] = zlib.crc32(word.encode("utf-8", "replace"))
    return k


def vectors(blocks: list[Block]) -> np.ndarray:
    """One row per block: hashed tag path, hashed words, shares."""
    x = np.zeros((len(blocks), WIDTH), dtype=np.float32)
    for i, b in enumerate(blocks):
        x[i, :PATH_DIM] = 0.6 * b.counts
        for k in b.last:
            x[i, k] += 0.4
        words = b.text.split()
        slots = [_slot(w) % WORD_DIM for w in b.text.lower().split()]
        x[i, PATH_DIM : PATH_DIM + WORD_DIM] = np.bincount(slots, minlength=WORD_DIM) / max(1, len(slots))
        n = len(b.text)
        x[i, PATH_DIM + WORD_DIM :] = (
            min(2.0, np.log1p(len(words)) / 3), b.linked, sum(map(b.text.count, ".,;")) / max(1, len(words)), i / len(blocks),
            b.text[-1] in ".!?…:", n / max(1, len(words)) / 10, min(2.0, np.log1p(b.depth) / 2), 1.0)
    return x


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


class Labeller:
    """A bidirectional LSTM with a logistic output for each step."""

    def __init__(self, width: int = WIDTH, hidden: int = HIDDEN, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.p: dict[str, np.ndarray] = {"o": rng.normal(0, 0.1, 2 * hidden).astype(np.float32), "c": np.zeros(1, np.float32)}
        for d in "fb":
            self.p[f"x{d}"] = rng.normal(0, 0.15, (width, 4 * hidden)).astype(np.float32)
            self.p[f"r{d}"] = rng.normal(0, 0.15, (hidden, 4 * hidden)).astype(np.float32)
            self.p[f"i{d}"] = np.repeat(np.array([0, 1, 0, 0], np.float32), hidden)  # forget gates begin open

    def _pass(self, x: np.ndarray, live: np.ndarray, d: str, keep: bool):
        n, t, _ = x.shape
        k = self.h
        pre = x @ self.p[f"x{d}"] + self.p[f"i{d}"]
        h = c = np.zeros((n, k), np.float32)
        out, tape = np.zeros((n, t, k), np.float32), []
        for s in range(t) if d == "f" else range(t - 1, -1, -1):
            a = pre[:, s] + h @ self.p[f"r{d}"]
            gates = _sigmoid(a[:, : 3 * k])
            i, f, o, g = gates[:, :k], gates[:, k : 2 * k], gates[:, 2 * k :], np.tanh(a[:, 3 * k :])
            on = live[:, s, None]
            c2 = np.where(on, f * c + i * g, c)
            th = np.tanh(c2)
            h2 = np.where(on, o * th, h)
            if keep:
                tape.append((s, i, f, o, g, c, th, h, on))
            h, c = h2, c2
            out[:, s] = h
        return out, tape

    def forward(self, x: np.ndarray, live: np.ndarray) -> np.ndarray:
        f, _ = self._pass(x, live, "f", False)
        b, _ = self._pass(x, live, "b", False)
        return _sigmoid(np.concatenate([f, b], axis=2) @ self.p["o"] + self.p["c"])

    def gradients(self, x: np.ndarray, live: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        (f, tf), (b, tb) = self._pass(x, live, "f", True), self._pass(x, live, "b", True)
        both = np.concatenate([f, b], axis=2)
        err = np.where(live, _sigmoid(both @ self.p["o"] + self.p["c"]) - y, 0) / live.sum()
        grad = {"o": np.einsum("nt,ntk->k", err, both), "c": np.array([err.sum()], np.float32)}
        k = self.h
        for d, tape, part in (("f", tf, self.p["o"][:k]), ("b", tb, self.p["o"][k:])):
            pre = np.zeros((*x.shape[:2], 4 * k), np.float32)
            dh = dc = np.zeros((len(x), k), np.float32)
            dr = np.zeros_like(self.p[f"r{d}"])
            for s, i, fg, o, g, c, th, h, on in reversed(tape):
                dh = dh + err[:, s, None] * part
                on_dh = np.where(on, dh, 0)
                dct = np.where(on, dc + on_dh * o * (1 - th**2), 0)
                da = np.concatenate([dct * g * i * (1 - i), dct * c * fg * (1 - fg), on_dh * th * o * (1 - o), dct * i * (1 - g**2)], axis=1)
                pre[:, s] = da
                dr += h.T @ da
                dh = np.where(on, da @ self.p[f"r{d}"].T, dh)
                dc = np.where(on, dct * fg, dc)
            grad[f"x{d}"] = np.einsum("ntw,ntk->wk", x, pre, optimize=True)
            grad[f"r{d}"], grad[f"i{d}"] = dr, pre.sum(axis=(0, 1))
        return grad

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 10, batch: int = 16, rate: float = 0.02, seed: int = 9) -> None:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for e in range(epochs):
            order = rng.permutation(len(pages))
            for lo in range(0, len(order), batch):
                x, live, y = padded([pages[i][0] for i in order[lo : lo + batch]], [pages[i][1] for i in order[lo : lo + batch]])
                step += 1
                for k, g in self.gradients(x, live, y).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.99 * v2[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - rate * 0.8**e * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)


def padded(xs: list[np.ndarray], ys: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    t = max(map(len, xs))
    x = np.zeros((len(xs), t, WIDTH), np.float32)
    live, y = np.zeros((len(xs), t), bool), np.zeros((len(xs), t), np.float32)
    for i, v in enumerate(xs):
        x[i, : len(v)], live[i, : len(v)] = v, True
        if ys is not None:
            y[i, : len(v)] = ys[i]
    return x, live, y


# Names that made-up pages give their parts.
MAIN = ("article", "main", "div.content", "div.article body", "section.post", "div.entry content", "div.story", "td.main", "div.text", "div", "section")
ASIDE = {
    "menu": ("nav", "ul.menu", "div.nav", "div.navigation bar", "div.breadcrumb", "header/nav", "menu", "div.topnav"),
    "head": ("header", "div.header", "div.masthead", "div.banner", "div.logo", "div.site header"),
    "foot": ("footer", "div.footer", "div.copyright", "section.footer links", "div.site footer"),
    "side": ("aside", "div.sidebar", "div.related", "section.recommended", "div.widget", "div.popular"),
    "note": ("div.cookie notice", "div.notice", "div.alert", "div.popup", "div.consent", "section.newsletter", "dialog"),
    "ad": ("div.ad", "div.ads", "div.advert", "div.sponsored", "aside.advertisement", "div.promo", "div.adsense", "ins.ad"),
    "form": ("form", "form.search", "div.login/form", "form.subscribe", "fieldset"),
    "talk": ("div.comments", "section.comments", "ul.comment list", "div.comment", "section.discussion", "div.disqus thread", "ol.replies", "div.reader comments"),
}


def sample_page(rng: random.Random) -> tuple[str, list[str]]:
    """A made-up page and the blocks of its main text."""
    stems = ["".join(rng.choice("aeiourstlnmdpkgbvzchw") for _ in range(rng.randint(2, 9))) for _ in range(60)]

    def sentence(lo: int, hi: int) -> str:
        return (" ".join(rng.choice(stems) for _ in range(rng.randint(lo, hi)))).capitalize() + rng.choice([".", ".", ".", "", "!"])

    def wrap(spec: str, inner: str) -> str:
        for part in reversed(spec.split("/")):
            name, _, words = part.partition(".")
            kind = rng.choice(["class", "class", "id"])
            inner = f"<{name}{f' {kind}=\"{words.replace(' ', rng.choice(['-', ' ', '_']))}\"' if words else ''}>{inner}</{name}>"
        return inner

    def aside(kind: str) -> str:
        n = rng.randint(1, 6)
        if kind in ("menu", "side", "head") and rng.random() < 0.8:
            inner = "".join(f'<li><a href="/{i}">{sentence(1, 4)}</a></li>' for i in range(n))
            inner = f"<ul>{inner}</ul>" if rng.random() < 0.8 else inner.replace("li>", "span> ")
        elif kind == "form":
            inner = "".join(f"<label>{sentence(1, 3)}</label><input name='x'>" for _ in range(n)) + f"<button>{sentence(1, 2)}</button>"
        elif kind == "talk":
            inner = "".join(f"<div><b>{rng.choice(stems)}</b><p>{sentence(3, 40)}</p></div>" if rng.random() < 0.6 else f"<p>{sentence(3, 40)}</p>" for _ in range(n + 1))
        else:
            inner = sentence(2, 16) if rng.random() < 0.6 else "".join(f"<p>{sentence(2, 20)}</p>" for _ in range(min(n, 3)))
        return wrap(rng.choice(ASIDE[kind]), inner)

    main: list[str] = []

    def paragraph(tag: str, lo: int, hi: int) -> str:
        words = [sentence(lo, hi) for _ in range(rng.randint(1, 4) if tag == "p" else 1)]
        text = " ".join(words)
        main.append(text)
        shown = text
        if tag == "p" and rng.random() < 0.2:
            k = rng.randint(0, len(words) - 1)
            words[k] = f"<{(t := rng.choice(['b', 'em', 'a href=/x', 'span']))}>{words[k]}</{t.split()[0]}>"
            shown = " ".join(words)
        if tag == "p" and rng.random() < 0.1:
            return f"<p><b>{shown}<br>"  # unclosed, as many pages are
        return f"<{tag}>{shown}</{tag}>" if rng.random() < 0.93 or tag != "p" else f"<p>{shown}"

    body = [paragraph("h1", 3, 12)] if rng.random() < 0.9 else []
    for _ in range(rng.randint(1, 14)):
        r = rng.random()
        body.append(paragraph("h2" if r < 0.08 else "li" if r < 0.12 else "blockquote" if r < 0.15 else "p", 1 if r > 0.9 else 3, 30))
        if rng.random() < 0.05:
            body.append(aside(rng.choice(["ad", "note", "side"])))
    before = [aside(k) for k in ("note", "head", "menu", "ad", "side") if rng.random() < 0.5]
    after = [aside(k) for k in ("talk", "side", "ad", "form", "menu", "note") if rng.random() < 0.35] + ([aside("foot")] if rng.random() < 0.8 else [])
    inner = "".join(before) + wrap(rng.choice(MAIN), "".join(body)) + "".join(after)
    if rng.random() < 0.3:
        inner = wrap(rng.choice(["div.wrapper", "div.page", "div.container", "div", "main"]), inner)
    return f"<html><head><title>{sentence(2, 6)}</title></head><body>{inner}{'</body></html>' if rng.random() < 0.8 else ''}", main


def train_labeller(pages: int = 900, seed: int = 11) -> Labeller:
    rng = random.Random(seed)
    data = []
    while len(data) < pages:
        page, main = sample_page(rng)
        blocks = blocks_of(page)
        want = [SPACE.sub(" ", m).strip() for m in main]
        y, k = np.zeros(len(blocks), np.float32), 0
        for i, b in enumerate(blocks):
            if k < len(want) and b.text == want[k]:
                y[i], k = 1, k + 1
        if blocks and k == len(want):
            data.append((vectors(blocks), y))
    out = Labeller()
    out.train(data)
    return out


_trained: Labeller | None = None


def labeller() -> Labeller:
    """Trained once for each driver process."""
    global _trained
    if _trained is None:
        _trained = train_labeller()
    return _trained


def main_texts(model: Labeller, pages: list[str | None], batch: int = 64) -> list[str]:
    parsed = [blocks_of(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i, b in enumerate(parsed) if b), key=lambda i: len(parsed[i]))
    lo = 0
    while lo < len(order):
        hi, longest = lo, 0
        while hi < len(order) and hi - lo < batch:  # padded steps stay bounded
            longest = len(parsed[order[hi]])
            if hi > lo and (hi - lo + 1) * longest > 20_000:
                break
            hi += 1
        x, live, _ = padded([vectors(parsed[i]) for i in order[lo:hi]])
        p = model.forward(x, live)
        for row, i in enumerate(order[lo:hi]):
            out[i] = "\n".join(b.text for b, v in zip(parsed[i], p[row]) if v >= 0.5)
        lo = hi
    return out


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html)."""
    shared = pages.sparkSession.sparkContext.broadcast(labeller())  # a few thousand weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                text = main_texts(shared.value, b.column(2).slice(lo, 256).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, 256), b.column(1).slice(lo, 256), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
