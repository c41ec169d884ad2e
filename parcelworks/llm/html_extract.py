"""HTML extraction with a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, outside
scripts, styles and other parts that show no text.  Each block has a vector:
hashed tags, classes, ids and roles of its ancestors (the tag path), hashed
words, and a few shape numbers (length, link share, punctuation).  A
bidirectional LSTM in numpy reads the blocks of the whole document in order
and labels each as content or not, from both directions' context.

No page table carries labels, so the LSTM is trained (on the driver, once, a
fixed seeded number of pages) on generated pages whose blocks' roles are
known: menus, headers, adverts, notices, forms, comments, related links,
sidebars and footers around articles in many container styles.  Words are
invented and blocks often share lengths, so the labels have to come from the
path and the context.

The main text is the content blocks in page order, joined by two line feeds;
character references are decoded and white space inside a block is one space.

Defined results: null or empty html, or a page without content blocks, gives
an empty text; a comment, script, style, title or text area that never ends
runs to the end of the page, an option ends at the next start tag or with its
parent, any other element without its end tag shows its text; a tag that never
ends is text; null page_ids and urls are carried; repeated rows give repeated
results; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_columns

PATH_DIM, WORD_DIM, SHAPE_DIM = 96, 16, 8
INPUT = PATH_DIM + WORD_DIM + SHAPE_DIM
HIDDEN = 12
TRAIN_PAGES = 900
TRAIN_EPOCHS = 6

# Tags that do not end a block, and tags whose content is not shown (fixed values of HTML).
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp small span "
    "strike strong sub sup time tt u var wbr ruby rb rt rp input button select option optgroup picture source".split()
)
RAW = frozenset("script style textarea title".split())  # text up to their end tag or the end of the page
HIDDEN_TAGS = frozenset("noscript template svg math iframe object select option optgroup button".split())
OPTIONS = ("option", "optgroup")  # end at the next start tag or with their parent
FOREIGN = ("svg", "math")  # a slash ends them and what is inside them
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {  # a start tag ends an open element of these kinds
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>\"']*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_NAMED = re.compile(r"</?([a-zA-Z][^\s/<>\"']*)")
_SPECIAL = re.compile(r"[>\"']")
_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in (*RAW, "iframe")}
_MARK = re.compile(r"(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+")


class Token(NamedTuple):
    """A tag (with ``tag`` in lower case), text, or neither (a comment or declaration)."""

    text: str | None = None
    tag: str | None = None
    end: bool = False
    attrs: str = ""


class _TagEnds:
    """Where a tag that is read from a place on ends: its first > outside of quotes.  One pass over the page."""

    def __init__(self, page: str):
        found = [(m.start(), m.group()) for m in _SPECIAL.finditer(page)]
        self.places = [at for at, _ in found]
        # for each special character met outside of quotes: the end of the tag, or -1
        self.ends = [-1] * (len(found) + 1)
        later = {'"': len(found), "'": len(found)}  # the next quote of each kind
        for k in range(len(found) - 1, -1, -1):
            at, char = found[k]
            if char == ">":
                self.ends[k] = at
            else:
                closing = later[char]
                self.ends[k] = self.ends[closing + 1] if closing < len(found) else -1
                later[char] = k

    def after(self, at: int) -> int:
        return self.ends[bisect_left(self.places, at)]


class _Tokens:
    """The page's tokens from any place on, in time that grows with the page alone."""

    def __init__(self, page: str):
        self.page, self.last, self.ends = page, page.rfind(">"), None

    def read(self, at: int) -> tuple[Token, int]:
        """The token at a place and where it ends."""
        if self.page[at] == "<" and not self._closes(at):
            return Token("<"), at + 1
        found = _TOKEN.match(self.page, at)
        end, tag, attrs, text = found.groups()
        if text == "<" and self.ends is None and _NAMED.match(self.page, at):
            self.ends = _TagEnds(self.page)  # a tag without an end was read to the end of the page; once is enough
        return Token(text, tag and tag.lower(), end == "/", attrs or ""), found.end()

    def _closes(self, at: int) -> bool:
        """Whether what begins with < may have an end."""
        if at > self.last:
            return self.page.startswith("<!--", at)
        named = self.ends and _NAMED.match(self.page, at)
        return not named or self.ends.after(named.end()) >= 0


def _shown(page: str) -> list[Token]:
    """The page's tokens without the elements that show no text."""
    tokens: list[Token] = []
    after: dict[int, int] = {}  # token that opens a hidden element: first token behind the element
    open_: list[tuple[str, int]] = []
    depth: Counter = Counter()
    endless = set()
    reader, at = _Tokens(page), 0
    while at < len(page):
        token, at = reader.read(at)
        number, tag = len(tokens), token.tag
        tokens.append(token)
        if tag is None:
            continue
        if token.end:
            while depth[tag]:
                name, first = open_.pop()
                depth[name] -= 1
                if name in OPTIONS or name == tag and name in HIDDEN_TAGS:
                    after[first] = number + (name == tag)
                if name == tag:
                    break
            continue
        if open_ and open_[-1][0] in OPTIONS:
            name, first = open_.pop()
            depth[name] -= 1
            after[first] = number
        if tag in VOID:
            continue
        if token.attrs.rstrip().endswith("/") and (tag in FOREIGN or any(depth[name] for name in FOREIGN)):
            after[number] = number + 1
        elif tag in _END:
            end = None if tag in endless else _END[tag].search(page, at)
            if end or tag in RAW:
                after[number] = number + 1
                at = end.end() if end else len(page)
            else:
                endless.add(tag)
        elif tag in HIDDEN_TAGS or tag not in INLINE:
            open_.append((tag, number))
            depth[tag] += 1
    shown, number = [], 0
    while number < len(tokens):
        if number in after:
            number = after[number]
        else:
            shown.append(tokens[number])
            number += 1
    return shown


class Path:
    """The tags and marks from the page down to an element, and their vector; shares its ancestors' part."""

    def __init__(self, above: Path | None = None, names: tuple[str, ...] = (), fresh: Iterable[str] = ()):
        self.above, self.names = above, names
        self.size = (above.size if above else 0) + len(names)
        self.vector = above.vector.copy() if above else np.zeros(PATH_DIM, np.float32)
        for name in fresh:  # a name counts once, wherever in the path
            at, sign = _slot(name, PATH_DIM)
            self.vector[at] += sign

    def __len__(self) -> int:
        return self.size

    def __iter__(self) -> Iterator[str]:
        parts, here = [], self
        while here:
            parts.append(here.names)
            here = here.above
        return (name for names in reversed(parts) for name in names)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Iterable) and tuple(self) == tuple(other)

    def __bool__(self) -> bool:
        return True


class _OpenElements:
    """The stack of open elements; each step costs what it opens or closes, however deep the stack."""

    def __init__(self):
        self.paths = [Path()]
        self.tags: list[str] = []
        self.at: dict[str, list[int]] = defaultdict(list)  # places of each open tag
        self.held: Counter = Counter()  # names in the path

    def nearest(self, tags: Iterable[str]) -> int:
        return max((self.at[tag][-1] for tag in tags if self.at[tag]), default=-1)

    def close(self, place: int) -> None:
        """Everything from a place on."""
        while len(self.tags) > place:
            self.at[self.tags.pop()].pop()
            self.held.subtract(self.paths.pop().names)

    def open(self, tag: str, marks: Iterable[str]) -> None:
        names = (tag, *marks)
        fresh = [name for name in dict.fromkeys(names) if not self.held[name]]
        self.paths.append(Path(self.paths[-1], names, fresh))
        self.at[tag].append(len(self.tags))
        self.tags.append(tag)
        self.held.update(names)


def blocks(page: str | None) -> list[tuple[str, Path, float]]:
    """(text, path of tags and marks, share of characters inside links) per non-empty leaf block."""
    out: list[tuple[str, Path, float]] = []
    stack = _OpenElements()
    parts: list[str] = []
    linked, links = 0, 0

    def flush():
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append((text, stack.paths[-1], min(1.0, linked / len(text))))
        parts.clear()
        linked = 0

    for token in _shown(page or ""):
        if token.text is not None:
            text = html.unescape(token.text)
            parts.append(text)
            if links:
                linked += len(text)
            continue
        tag = token.tag
        if tag is None:
            continue
        if tag in INLINE:
            if tag == "a":
                links = max(0, links + (-1 if token.end else 1))
            elif tag == "br":
                parts.append(" ")
            continue
        flush()
        if tag in VOID:
            continue
        if token.end:
            if stack.at[tag]:
                stack.close(stack.at[tag][-1])
            links = 0
            continue
        if stack.tags and stack.tags[-1] == "p":
            stack.close(len(stack.tags) - 1)
        if tag in CLOSES:
            place = stack.nearest(CLOSES[tag])
            if place > stack.nearest(("ul", "ol", "dl", "table")):
                stack.close(place)
        values = [v for m in _MARK.finditer(token.attrs) for v in m.groups() if v]
        stack.open(tag, ["." + n for n in dict.fromkeys(n for v in values for n in _NAME.findall(v.lower()))])
    flush()
    return out


@lru_cache(maxsize=50_000)
def _slot(name: str, dim: int) -> tuple[int, float]:
    h = zlib.crc32(name.encode("utf-8"))
    return h % dim, 1.0 if h >> 31 else -1.0


def vectors(found: list[tuple[str, Path, float]]) -> np.ndarray:
    out = np.zeros((len(found), INPUT), np.float32)
    for i, (text, path, linked) in enumerate(found):
        row = out[i]
        row[:PATH_DIM] = path.vector
        words = text.split(" ")
        scale = max(8.0, len(words) / 8)
        for word in words:
            at, sign = _slot(word.lower(), WORD_DIM)
            row[PATH_DIM + at] += sign / scale
        np.clip(row[PATH_DIM : PATH_DIM + WORD_DIM], -1, 1, out=row[PATH_DIM : PATH_DIM + WORD_DIM])
        shape = row[PATH_DIM + WORD_DIM :]
        n = len(text)
        shape[0] = min(np.log1p(n) / 6, 1.2)
        shape[1] = linked
        shape[2] = min(np.log1p(len(words)) / 5, 1.2)
        shape[3] = text[-1] in ".!?"
        shape[4] = min((text.count(",") + text.count(".")) / len(words), 1.0)
        shape[5] = min(i, 10) / 10
        shape[6] = min(len(found) - 1 - i, 10) / 10
        shape[7] = len(path) / 10
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM with a logistic output per block."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.p: dict[str, np.ndarray] = {}
        for side in "fb":
            self.p["w" + side] = rng.normal(0, 0.15, (INPUT, 4 * HIDDEN)).astype(np.float32)
            self.p["u" + side] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            self.p["c" + side] = np.zeros(4 * HIDDEN, np.float32)
            self.p["c" + side][HIDDEN : 2 * HIDDEN] = 1  # remember at first
        self.p["out"] = rng.normal(0, 0.3, 2 * HIDDEN).astype(np.float32)
        self.p["bias"] = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str, keep: bool):
        """Hidden states (time, batch, HIDDEN); x is (time, batch, INPUT)."""
        steps, batch, _ = x.shape
        gates = x @ self.p["w" + side] + self.p["c" + side]
        h = c = np.zeros((batch, HIDDEN), np.float32)
        states, saved = np.zeros((steps, batch, HIDDEN), np.float32), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            a = gates[t] + h @ self.p["u" + side]
            i, f, o = (_sigmoid(a[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in (0, 1, 2))
            g = np.tanh(a[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new_c = m * (f * c + i * g) + (1 - m) * c
            tanh_c = np.tanh(new_c)
            new_h = m * o * tanh_c + (1 - m) * h
            if keep:
                saved.append((t, h, c, i, f, o, g, tanh_c, m))
            h, c = new_h, new_c
            states[t] = h
        return states, saved

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, mask, side, False)[0] for side in "fb"], axis=2)
        return both @ self.p["out"] + self.p["bias"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        runs = {side: self._run(x, mask, side, True) for side in "fb"}
        both = np.concatenate([runs[s][0] for s in "fb"], axis=2)
        error = (_sigmoid(both @ self.p["out"] + self.p["bias"]) - y) * mask / mask.sum()
        grads = {"out": np.einsum("tb,tbh->h", error, both), "bias": np.array([error.sum()], np.float32)}
        back = error[:, :, None] * self.p["out"]
        for n, side in enumerate("fb"):
            gate_grad = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            du = np.zeros_like(self.p["u" + side])
            dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t, h, c, i, f, o, g, tanh_c, m in reversed(runs[side][1]):
                dh = dh + back[t][:, n * HIDDEN : (n + 1) * HIDDEN]
                own_h, dc_in = dh * m, dc * m + dh * m * o * (1 - tanh_c**2)
                a = np.concatenate(
                    [dc_in * g * i * (1 - i), dc_in * c * f * (1 - f), own_h * tanh_c * o * (1 - o), dc_in * i * (1 - g**2)],
                    axis=1,
                )
                gate_grad[t] = a
                du += h.T @ a
                dh = dh * (1 - m) + a @ self.p["u" + side].T
                dc = dc * (1 - m) + dc_in * f
            grads["u" + side] = du
            grads["c" + side] = gate_grad.sum(axis=(0, 1))
            grads["w" + side] = np.tensordot(x, gate_grad, ((0, 1), (0, 1)))
        return grads

    def label(self, pages: list[np.ndarray], batch: int = 64) -> list[np.ndarray]:
        """Content flags per page; pages of similar length share a batch."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        lo = 0
        while lo < len(order):
            hi = lo + 1
            while hi < len(order) and hi - lo < batch and len(pages[order[hi]]) * (hi - lo) < 40_000:
                hi += 1
            part = order[lo:hi]
            value = self.logits(*_padded([pages[i] for i in part]))
            for k, i in enumerate(part):
                out[i] = value[: len(pages[i]), k] > 0
            lo = hi
        return out


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x = np.zeros((steps, len(pages), INPUT), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for k, v in enumerate(pages):
        x[: len(v), k], mask[: len(v), k] = v, 1
    return x, mask


class PageMaker:
    """Generated training pages: (html, label of each block)."""

    SYLLABLES = ("ba", "re", "ton", "li", "ä", "que", "shi", "or", "an", "el", "mu", "st", "é", "ng", "ka", "po", "wi")
    BEFORE = ("nav", "header", "menu", "notice", "ad", "form", "crumbs", "side")
    AFTER = ("footer", "footer", "comments", "related", "side", "ad", "notice", "form", "share")

    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)
        self.parts: list[str] = []
        self.labels: list[bool] = []

    def pick(self, *options):
        return options[int(self.rng.integers(len(options)))]

    def words(self, low: int, high: int) -> str:
        n = int(self.rng.integers(low, high + 1))
        if high >= 40 and self.rng.random() < 0.1:  # odd paragraphs: rows, repeats, numbers, very long ones
            one = "".join(self.rng.choice(self.SYLLABLES, 3))
            return self.pick(
                " | ".join([one, "x", "y.", one.upper()] * self.pick(1, 4, 12)),
                " ".join([one] * self.pick(5, 60, 300)),
                " ".join(str(int(v)) for v in self.rng.integers(0, 9999, self.pick(3, 40))),
                " ".join([one, "ka.", "re,", "tion"] * self.pick(50, 200)),
                "### " + one + " %% $$ *** && " + one,
            )
        made = ["".join(self.rng.choice(self.SYLLABLES, int(self.rng.integers(1, 4)))) for _ in range(n)]
        text = " ".join(made).capitalize()
        return text + self.pick(".", ".", ".", "", "!", "?") if n > 2 else text

    def put(self, content: bool, before: str, text: str, after: str) -> None:
        self.parts.append(before + text + after)
        self.labels.append(content)

    def attrs(self, *names: str) -> str:
        name = self.pick(*names)
        return self.pick(f' class="{name}"', f' id="{name}"', f" class='{self.pick('x', 'box', 'block', 'wrap')} {name}'", f' class="{name}-{self.pick("inner", "area", "main", "list")}"')

    def links(self, tag: str, low: int, high: int) -> None:
        for _ in range(int(self.rng.integers(low, high + 1))):
            self.put(False, f'<{tag}><a href="/x">', self.words(1, self.pick(2, 3, 6)), f"</a></{tag}>")

    def plain(self, low: int, high: int, blocks_: int = 2) -> None:
        for _ in range(int(self.rng.integers(1, blocks_ + 1))):
            self.put(False, "<p>", self.words(low, high), "</p>")

    def boilerplate(self, kind: str) -> None:
        open_, close = "<div>", "</div>"
        long = self.pick((3, 12), (10, 40), (20, 90))
        if kind in ("nav", "menu", "crumbs", "related", "share"):
            name = {"nav": ("nav", "navbar", "navigation", "topnav"), "menu": ("menu", "main-menu", "nav"), "crumbs": ("breadcrumb", "breadcrumbs"),
                    "related": ("related", "recommended", "more-posts", "related-posts"), "share": ("share", "social", "tags", "sharing")}[kind]
            tag = self.pick("nav", "div", "ul", "section") if kind != "nav" else self.pick("nav", "nav", "div")
            open_, close = f"<{tag}{self.pick('', self.attrs(*name)) if tag == 'nav' else self.attrs(*name)}>", f"</{tag}>"
            self.parts.append(open_)
            if kind == "related" and self.rng.random() < 0.6:
                self.put(False, "<h3>", self.words(1, 4), "</h3>")
            self.parts.append("<ul>")
            self.links("li", 2, 8)
            self.parts.append("</ul>")
        elif kind in ("header", "footer"):
            tag = self.pick(kind, kind, "div")
            open_, close = f"<{tag}{self.pick('', self.attrs(kind, 'site-' + kind)) if tag == kind else self.attrs(kind, 'site-' + kind, 'page-' + kind)}>", f"</{tag}>"
            self.parts.append(open_)
            if self.rng.random() < 0.5:
                self.put(False, "", self.pick("&copy; ", "") + self.words(2, 20), "")
            else:
                self.put(False, f"<{self.pick('h1', 'p', 'div', 'small')}>".replace("small", "p"), self.words(1, 15), "</p>")
                if self.rng.random() < 0.5:
                    self.links("li", 1, 5)
        elif kind == "ad":
            open_ = f"<div{self.attrs('ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'banner', 'sponsor')}>"
            self.parts.append(open_)
            if self.rng.random() < 0.5:
                self.put(False, "", self.words(*long), "")
            else:
                self.plain(*long)
        elif kind == "notice":
            open_ = f"<div{self.attrs('cookie', 'notice', 'consent', 'popup', 'alert', 'banner', 'gdpr', 'subscribe', 'newsletter', 'paywall')}>"
            self.parts.append(open_)
            self.plain(*long)
        elif kind == "form":
            open_, close = f"<form{self.pick('', self.attrs('search', 'login', 'subscribe', 'contact'))}>", "</form>"
            self.parts.append(open_)
            self.put(False, self.pick("<p>", "<div>", "<fieldset>"), self.words(1, 12), "</p>")
        elif kind == "side":
            tag = self.pick("aside", "aside", "div")
            open_, close = f"<{tag}{self.pick('', self.attrs('sidebar', 'side', 'widget')) if tag == 'aside' else self.attrs('sidebar', 'side', 'widget', 'rail')}>", f"</{tag}>"
            self.parts.append(open_)
            self.put(False, "<h3>", self.words(1, 4), "</h3>")
            if self.rng.random() < 0.5:
                self.links("li", 2, 6)
            else:
                self.plain(*long)
        else:  # reader comments
            tag = self.pick("section", "div", "ol", "div")
            open_, close = f"<{tag}{self.attrs('comments', 'comment-list', 'comment', 'replies', 'discussion', 'responses', 'disqus')}>", f"</{tag}>"
            self.parts.append(open_)
            for _ in range(int(self.rng.integers(1, 6))):
                self.parts.append(self.pick("<div>", '<div class="comment">', '<li class="reply">', "<article>", '<article class="comment">'))
                if self.rng.random() < 0.4:
                    self.put(False, "<p>", self.words(1, 3), "</p>")
                self.put(False, "<p>", self.words(3, 60), "</p>")
                self.parts.append(self.pick("</div>", "</li>", "</article>"))
        self.parts.append(close)

    def article(self) -> None:
        broken = self.rng.random() < 0.3
        if self.rng.random() < 0.85:
            title = self.words(3, 12)
            self.put(True, f"<{self.pick('h1', 'h1', 'h1', 'h2')}>", title, "</h1>")
        for _ in range(int(self.rng.integers(1, 16))):
            kind = self.rng.random()
            if kind < 0.72:
                inner = self.words(1, self.pick(4, 40, 120))
                if self.rng.random() < 0.15:
                    inner = f"<b>{inner}</b>" if not broken else f"<b>{inner}<br>"
                elif self.rng.random() < 0.15:
                    inner += f' <a href="/y">{self.words(1, 4)}</a> {self.words(2, 9)}'
                self.put(True, "<p>", inner, "" if broken and self.rng.random() < 0.5 else "</p>")
            elif kind < 0.82:
                self.put(True, f"<{self.pick('h2', 'h3')}>", self.words(1, 7), "</h2>")
            elif kind < 0.9:
                self.parts.append(self.pick("<ul>", "<ol>"))
                for _ in range(int(self.rng.integers(1, 5))):
                    self.put(True, "<li>", self.words(1, 15), "</li>")
                self.parts.append("</ul></ol>")
            elif kind < 0.94:
                self.put(True, "<blockquote>", self.words(4, 40), "</blockquote>")
            elif kind < 0.96:
                self.put(True, "<pre>", self.words(2, 20), "</pre>")
            elif kind < 0.98:
                self.parts.append("<table><tr>")
                for _ in range(3):
                    self.put(True, "<td>", self.words(1, 4), "</td>")
                self.parts.append("</tr></table>")
            else:
                self.boilerplate(self.pick("ad", "share", "notice", "related"))

    def page(self) -> tuple[str, list[bool]]:
        self.parts, self.labels = ["<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body>"], []
        wrap = self.pick("", "", f"<div{self.attrs('page', 'wrapper', 'container', 'site')}>")
        self.parts.append(wrap)
        for kind in self.BEFORE:
            if self.rng.random() < 0.4:
                self.boilerplate(kind)
        tag = self.pick("article", "article", "article", "main", "div", "section", "main><article", "td")
        own = self.attrs("content", "article", "post", "entry", "story", "body", "main", "text", "post-content", "entry-content", "article-body")
        plain = tag in ("article", "main", "main><article") and self.rng.random() < 0.6
        self.parts.append(f"<{tag}{'' if plain else own}>" if tag != "td" else f"<table><tr><td{own}>")
        self.article()
        inside = self.rng.random() < 0.15
        if not inside:
            self.parts.append({"main><article": "</article></main>", "td": "</td></tr></table>"}.get(tag, f"</{tag}>"))
        for kind in self.AFTER:
            if self.rng.random() < (0.7 if kind == "footer" else 0.35):
                self.boilerplate(kind)
        self.parts.append("</body></html>")
        return "".join(self.parts), list(self.labels)


def train(pages: int = TRAIN_PAGES, epochs: int = TRAIN_EPOCHS, seed: int = 5) -> Labeller:
    """Train on generated pages; fixed work, whatever the input."""
    maker, examples = PageMaker(seed), []
    while len(examples) < pages:
        text, labels = maker.page()
        found = blocks(text)
        if len(found) == len(labels):  # a page whose parts ran together has no block labels
            examples.append((vectors(found), np.array(labels, np.float32)))
    model, rng = Labeller(), np.random.default_rng(seed)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}
    examples.sort(key=lambda e: len(e[1]))
    batches = [examples[lo : lo + 16] for lo in range(0, len(examples), 16)]
    step = 0
    for epoch in range(epochs):
        for k in rng.permutation(len(batches)):
            x, mask = _padded([v for v, _ in batches[k]])
            y = np.zeros_like(mask)
            for j, (_, labels) in enumerate(batches[k]):
                y[: len(labels), j] = labels
            step += 1
            rate = 0.02 / (1 + epoch)
            for name, grad in model.gradients(x, mask, y).items():
                one, two = moment[name]
                one += 0.1 * (grad - one)
                two += 0.01 * (grad * grad - two)
                model.p[name] -= rate * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.99**step)) + 1e-7)
    return model


def extract(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """Per page: page_id, url, text, n_blocks, n_content."""
    shared = pages.sparkSession.sparkContext.broadcast(model or train())  # fixed size

    def run(batches):
        for batch in batches:
            found = [blocks(p) for p in batch["html"]]
            flags = shared.value.label([vectors(f) for f in found])
            text = ["\n\n".join(b[0] for b, keep in zip(f, k, strict=True) if keep) for f, k in zip(found, flags, strict=True)]
            yield pd.DataFrame(
                {"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": text,
                 "n_blocks": [len(f) for f in found], "n_content": [int(k.sum()) for k in flags]}
            )

    return own_columns(pages, "page_id", "url", "html").mapInPandas(
        run, "page_id long, url string, text string, n_blocks long, n_content long"
    )


def extract_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars."""
    return extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
