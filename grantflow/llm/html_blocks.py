"""Main-text extraction: a bidirectional LSTM labels the blocks of a page.

A page becomes its sequence of leaf blocks, the stretches of text between block-level tags. A block is described by
its tag path (elements with the words of their class, id and role, hashed), by its words (hashed) and by a few
numbers; a bidirectional LSTM over all blocks of the page decides for each one whether it belongs to the article. The
main text is the article's blocks in page order.

Training: no table has labels for blocks, so the network learns from labelled pages that a small grammar writes with
words of the corpus (articles in many kinds of containers amid menus, headers, footers, sidebars, notices, adverts,
forms and comments), and from the structure of at most ``PAGES`` pages of the table, chosen by a hash of the id: blocks
under an ``article`` or ``main`` element and no other landmark are taken as its text. Both bounds are fixed.

Defined results: null and empty html, and pages without an article, give an empty text. Broken markup is read as far
as it goes; text in scripts, styles and other hidden elements is no block; an unclosed one hides the rest. Formulas and
what stands in for an object or a canvas are text like other. Quoted values may have any length. Rows without
id and repeated rows are extracted like others; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from grantflow.llm.common import pick, small
from grantflow.llm.recurrent import Adam, Lstm, add_rows, flip, uniform, unflip

PAGES = 200
PAGE_CHARS = 30_000  # of each page that teaches
SIZE, PATH_DIM, WORD_DIM = 16, 16, 8
PATH_ROWS = WORD_ROWS = 1 << 15
NUMBERS = 7

# Elements that start and end blocks, elements whose text isn't shown, and elements without an end (HTML standard).
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split())
HIDDEN = frozenset("script style template svg iframe select textarea noframes noembed".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

NAME = r"<(?P<end>/?)(?P<tag>[A-Za-z][\w:-]*+)"
OTHER = r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
# quotes delimit a value after its "=" only; a quote without an end is a character like others
TOKEN = re.compile(
    rf"{OTHER}|{NAME}(?:(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>|(?P<broken>))", re.S)
PLAIN = re.compile(rf"{OTHER}|{NAME}(?P<attrs>[^>]*+)>", re.S)
HIDDEN_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+>", re.I) for t in HIDDEN}
# all attributes in turn, so that nothing inside the value of one is taken for another
ATTRIBUTE = re.compile(r"([^\s/>=]++)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+")
NAMING = frozenset(("class", "id", "role", "itemprop"))
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Block(NamedTuple):
    text: str
    path: tuple[str, ...]  # tokens of all open elements, outermost first
    last: tuple[str, ...]  # tokens of the innermost two
    linked: int  # characters inside links


def element_tokens(tag: str, attrs: str) -> tuple[str, ...]:
    out = [tag]
    if "=" in attrs:
        for name, *values in ATTRIBUTE.findall(attrs):
            if name.lower() not in NAMING:
                continue
            kind = "." if name.lower() in ("class", "id") else "="
            for value in entities.unescape("".join(values)).split():
                out += {kind + p.lower(): None for p in (value, *PART.findall(value))}
    return tuple(out)


def read_tokens(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """Start, end, tag (empty if none), whether it is an end tag, and attributes; a hidden element is one token.

    Takes time in proportion to the page: nothing is looked for after the last ``>``, and once a tag has no end outside
    of quoted values up to there, values are no longer looked at.
    """
    token, at, last = TOKEN, 0, page.rfind(">") + 1
    while m := token.search(page, at, last):
        tag = (m["tag"] or "").lower()
        if tag and m["attrs"] is None:
            token, at = PLAIN, m.start()
            continue
        at = m.end()
        if not tag:
            if page.startswith("<!--", m.start()) and not page.endswith("-->", m.start() + 4, at):
                at = len(page)
        elif tag in HIDDEN and not m["end"] and (not m["attrs"] or m["attrs"][0] == "/" or m["attrs"][0].isspace()):
            if not m["attrs"].endswith("/"):
                end = HIDDEN_END[tag].search(page, at, last)
                at = end.end() if end else len(page)
            tag = ""
        yield m.start(), at, tag, bool(m["end"]), m["attrs"] or ""
    if (rest := page.find("<!--", max(at, last))) >= 0:
        yield rest, len(page), "", False, ""


def read_blocks(page: str | None) -> list[Block]:
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, links = 0, 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                path = tuple(t for _, tokens in stack for t in tokens)
                last = tuple(t for _, tokens in stack[-2:] for t in tokens)
                blocks.append(Block(text, path, last, linked))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if links:
                linked += len(text)

    page = page or ""
    at = 0
    for start, end, tag, ends, attrs in read_tokens(page):
        add(page[at:start])
        at = end
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
        elif tag in VOID:
            if tag == "hr":
                close()
        elif ends:
            if any(t == tag for t, _ in stack):
                if tag in BLOCK:
                    close()
                while (t := stack.pop()[0]) != tag:
                    links -= t == "a"
                links -= tag == "a"
        else:
            if tag in BLOCK:
                close()
                # a paragraph or item ends where the next one starts
                if tag in ("p", "li") and stack and any(t == tag for t, _ in stack[-3:]):
                    k = max(i for i, (t, _) in enumerate(stack) if t == tag)
                    if not any(t in BLOCK for t, _ in stack[k + 1 :]):
                        links -= sum(t == "a" for t, _ in stack[k:])
                        del stack[k:]
            if not attrs.endswith("/"):
                stack.append((tag, element_tokens(tag, attrs)))
                links += tag == "a"
    add(page[at:])
    close()
    return blocks


# ---------------------------------------------------------------- features


def _bucket(token: str, rows: int) -> int:
    return zlib.crc32(token.encode("utf-8", "replace")) % rows


class Features:
    """Numbers and hashed tokens of blocks; keeps the buckets of a bounded number of tokens."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.paths: dict[tuple, np.ndarray] = {}

    def path_vector(self, b: Block, p: dict[str, np.ndarray]) -> np.ndarray:
        """Mean vectors of a path and its innermost elements; pages repeat their paths."""
        found = self.paths.get((b.path, b.last))
        if found is None:
            if len(self.paths) > 50_000:
                self.paths.clear()
            found = self.paths[b.path, b.last] = np.concatenate([
                p["path"][self._ids(t)].mean(axis=0) if t else np.zeros(PATH_DIM, np.float32) for t in (b.path, b.last)])
        return found

    def _ids(self, tokens) -> list[int]:
        known = self.known
        if len(known) > 300_000:
            known.clear()
        for t in tokens:
            if t not in known:
                known[t] = _bucket(t, PATH_ROWS)
        return [known[t] for t in tokens]

    def of(self, blocks: list[Block], paths: bool = True) -> dict[str, np.ndarray]:
        out = {"numbers": np.zeros((len(blocks), NUMBERS), dtype=np.float32)}
        lists = {"word": [self._ids(b.text.lower().split()) for b in blocks]}
        if paths:
            lists |= {"path": [self._ids(b.path) for b in blocks], "last": [self._ids(b.last) for b in blocks]}
        for name, lists in lists.items():
            out[name] = np.array([i for ids in lists for i in ids], dtype=np.int64)
            out[name + "_of"] = np.repeat(np.arange(len(blocks)), [len(ids) for ids in lists])
        for i, b in enumerate(blocks):
            n = len(b.text)
            words = b.text.count(" ") + 1
            out["numbers"][i] = (
                np.log1p(n) / 5, np.log1p(words) / 4, min(1.0, b.linked / n), b.text[-1] in ".!?…»\"”",
                min(1.0, 10 * sum(map(b.text.count, ".,;:!?")) / n), i / max(1, len(blocks) - 1), "©" in b.text,
            )
        return out


    def vectors(self, blocks: list[Block], p: dict[str, np.ndarray]) -> np.ndarray:
        """The same as ``vectors`` of all features."""
        f = self.of(blocks, paths=False)
        return np.concatenate([
            np.stack([self.path_vector(b, p) for b in blocks]),
            _mean(p["word"], f["word"], f["word_of"], len(blocks)), f["numbers"]], axis=1)


def _mean(table: np.ndarray, ids: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, table.shape[1]), dtype=np.float32)
    if len(ids):
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        count = np.diff(np.append(starts, len(ids)))
        out[owner[starts]] = np.add.reduceat(table[ids], starts, axis=0) / count[:, None]
    return out


def vectors(f: dict[str, np.ndarray], p: dict[str, np.ndarray]) -> np.ndarray:
    n = len(f["numbers"])
    return np.concatenate([
        _mean(p["path"], f["path"], f["path_of"], n), _mean(p["path"], f["last"], f["last_of"], n),
        _mean(p["word"], f["word"], f["word_of"], n), f["numbers"],
    ], axis=1)


WIDTH = 2 * PATH_DIM + WORD_DIM + NUMBERS


def gate_inputs(x: np.ndarray, p: dict[str, np.ndarray]) -> np.ndarray:
    """[time, 2, gates, batch] from block vectors [time, batch, WIDTH]; the padding after a page is zeros."""
    forward = np.einsum("gi,tbi->tgb", p["in"][0], x, optimize=True)
    backward = np.einsum("gi,tbi->tgb", p["in"][1], x[::-1], optimize=True)
    return (np.stack([forward, backward], axis=1) + p["bias"][None, :, :, None]).astype(np.float32)


def padded(parts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((max(map(len, parts)), len(parts), parts[0].shape[1]), dtype=np.float32)
    for j, x in enumerate(parts):
        out[: len(x), j] = x
    return out


def label(pages: list[list[Block]], p: dict[str, np.ndarray], features: Features) -> list[np.ndarray]:
    """For each block of each page whether it belongs to the article."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i, b in enumerate(pages) if b), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        # a batch holds so many blocks, padding included, at most
        size = 1
        while at + size < len(order) and (size + 1) * len(pages[order[at + size]]) <= 20_000:
            size += 1
        batch = order[at : at + size]
        at += size
        x = padded([features.vectors(pages[i], p) for i in batch])
        h, _ = Lstm.forward(gate_inputs(x, p), p["u"])
        logits = np.einsum("h,thb->tb", p["out"], flip(h)) + p["out_bias"][0]
        for j, i in enumerate(batch):
            out[i] = logits[: len(pages[i]), j] > 0
    return out


# ---------------------------------------------------------------- training


class Grammar:
    """Writes pages with known article blocks."""

    # Class and id words that pages use for what isn't and for what is article text.
    OTHER = {
        "nav": "menu nav navbar navigation breadcrumb breadcrumbs topbar toolbar pagination pager tabs",
        "header": "header masthead site-header branding logo top banner",
        "footer": "footer site-footer bottom copyright colophon legal",
        "aside": "sidebar side related widget recommended trending popular more rail",
        "ad": "ad ads advert advertisement sponsored promo banner-ad adbox dfp sponsor",
        "notice": "cookie consent notice alert gdpr popup modal privacy-notice subscribe newsletter paywall",
        "form": "search login signup contact newsletter-form search-form subscribe-form",
        "share": "share social sharing follow tags meta byline author",
        "comments": "comments comment reply responses discussion disqus thread user-comment reader-comments",
    }
    MAIN = "content post entry article-body story main article body-text entry-content post-content text page"
    # Short texts that pages use outside of articles.
    PHRASES = (
        "Home|About us|Contact|Login|Sign up|Search|Subscribe|Share this|Read more|Advertisement|Sponsored|Cookie "
        "settings|Accept all|Privacy policy|Terms of use|All rights reserved|© 2024|Follow us|Related articles|Leave a "
        "comment|Reply|Next|Previous|Startseite|Impressum|Datenschutz|Anmelden|Accueil|Connexion|Inicio|Buscar|We use "
        "cookies to improve your experience|Enter your email|Most popular|Back to top").split("|")

    def __init__(self, words: list[str], seed: int = 5):
        self.rng = np.random.default_rng(seed)
        self.words = words or ["lorem", "ipsum", "dolor", "sit", "amet"]

    def any(self, options):
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def text(self, low: int, high: int) -> str:
        n = int(np.exp(self.rng.uniform(np.log(low), np.log(high + 1))))
        words = [self.any(self.words) for _ in range(n)]
        for i in range(n - 1):
            if self.chance(0.1):
                words[i] += self.any([",", ".", ";"])
        return " ".join(words) + (self.any([".", ".", "!", "?"]) if self.chance(0.8) else "")

    def attrs(self, words: str | None) -> str:
        if not words or self.chance(0.15):
            return f' class="c{self.rng.integers(999)}"' if self.chance(0.3) else ""
        name = self.any(words.split())
        if self.chance(0.2):
            name = self.any(["site", "page", "block", "main", "left", "right", "wp", "js"]) + self.any("-_") + name
        return f' {self.any(["class", "class", "id"])}="{name}"'

    def leaf(self, tag: str, text: str, keep: bool, linked: float = 0.0) -> list[tuple[str, bool | None]]:
        """Markup pieces; a text piece carries its label, markup carries None."""
        inner: list[tuple[str, bool | None]] = [(text, keep)]
        if self.chance(linked):
            inner = [("<a href=x>", None), *inner, ("</a>", None)]
        elif self.chance(0.1):
            t = self.any(["b", "i", "em", "strong", "span"])
            inner = [(f"<{t}>", None), *inner] + ([(f"</{t}>", None)] if self.chance(0.7) else [])
        if self.chance(0.1):
            inner.append(("<br>", None))
        return [(f"<{tag}>", None), *inner] + ([(f"</{tag}>", None)] if tag != "p" or self.chance(0.9) else [])

    def other(self, kind: str | None = None) -> list[tuple[str, bool | None]]:
        kind = kind or self.any(list(self.OTHER))
        short = lambda: self.any(self.PHRASES) if self.chance(0.4) else self.text(1, 6)
        plain = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form",
                 "comments": "section"}.get(kind, "div")
        tag = plain if self.chance(0.7) else self.any(["div", "section", "div"])
        named = self.OTHER[kind] if tag in ("div", "section", "form") or self.chance(0.4) else None
        attrs = self.attrs(named) if tag not in ("div", "section") else ""
        while named and tag in ("div", "section") and not ("class=" in attrs or "id=" in attrs):
            attrs = self.attrs(named)
        out: list[tuple[str, bool | None]] = [(f"<{tag}{attrs}>", None)]
        if kind == "nav" or (kind in ("footer", "aside", "header", "share") and self.chance(0.5)):
            out.append(("<ul>", None))
            for _ in range(int(self.rng.integers(2, 9))):
                out += self.leaf("li", short(), False, 0.9)
            out.append(("</ul>", None))
        elif kind == "comments":
            out += self.leaf(self.any(["h2", "h3", "h4"]), self.any(["Comments", "Reply", self.text(1, 4)]), False)
            for _ in range(int(self.rng.integers(1, 7))):
                item = self.any(["div", "li", "article"])
                out.append((f"<{item}{self.attrs('comment reply comment-body user')}>", None))
                out += self.leaf(self.any(["span", "cite", "h4", "div"]), self.text(1, 3), False, 0.3)
                out += self.leaf("p", self.text(3, 80), False)
                out.append((f"</{item}>", None))
        elif kind == "form":
            out += self.leaf("label", short(), False) + [("<input name=q>", None)] + self.leaf("button", short(), False)
        else:
            for _ in range(int(self.rng.integers(1, 4))):
                text = self.text(2, 60) if self.chance(0.6) else short()
                out += self.leaf(self.any(["p", "div", "span", "h3"]), text, False, 0.4) if self.chance(0.6) else [(text, False)]
            if kind == "footer" and self.chance(0.6):
                out.append((f"&copy; {self.text(1, 3)} &middot; {self.text(2, 20)}", False))
        return [*out, (f"</{tag}>", None)]

    def article(self) -> list[tuple[str, bool | None]]:
        tag = self.any(["article", "article", "main", "div", "div", "section"])
        attrs = self.attrs(self.MAIN) if tag in ("div", "section") or self.chance(0.4) else ""
        out: list[tuple[str, bool | None]] = [(f"<{tag}{attrs}>", None)]
        if self.chance(0.8):
            head = self.leaf("h1", self.text(2, 14), True)
            out += [("<header>", None), *head, ("</header>", None)] if self.chance(0.15) else head
        for _ in range(int(np.exp(self.rng.uniform(0, np.log(25))))):
            r = self.rng.random()
            if r < 0.75:
                out += self.leaf("p", self.text(1, 120), True, 0.03)
            elif r < 0.83:
                out += self.leaf(self.any(["h2", "h3", "h4"]), self.text(1, 8), True)
            elif r < 0.9:
                kind = self.any(["ul", "ol"])
                out.append((f"<{kind}>", None))
                for _ in range(int(self.rng.integers(1, 6))):
                    out += self.leaf("li", self.text(1, 25), True, 0.05)
                out.append((f"</{kind}>", None))
            elif r < 0.94:
                out += self.leaf(self.any(["blockquote", "pre", "div", "td"]), self.text(3, 60), True)
            else:
                out += self.other(self.any(["ad", "aside", "share", "notice", "form"]))
        return [*out, (f"</{tag}>", None)]

    def page(self) -> tuple[list[Block], np.ndarray]:
        out: list[tuple[str, bool | None]] = [("<html><head>", None)]
        out += self.leaf("title", self.text(2, 12), False) + [("</head><body>", None)]
        wrap = self.chance(0.3)
        out += [(f"<div{self.attrs('wrapper container page layout')}>", None)] if wrap else []
        for kind in ("notice", "header", "nav", "ad", "form"):
            if self.chance(0.45):
                out += self.other(kind)
        if not self.chance(0.03):
            out += self.article()
        for kind in ("share", "comments", "aside", "ad", "nav", "footer"):
            if self.chance(0.45):
                out += self.other(kind)
        # the same reading as any page: a marker in front of each text tells its label
        blocks = read_blocks("".join(t if k is None else f"\x02{int(k)}{t} " for t, k in out))
        marks = [re.findall("\x02(.)", b.text) for b in blocks]
        y = np.array([float(m[0]) if m else 0.0 for m in marks], dtype=np.float32)
        plain = [b._replace(text=re.sub("\x02.", "", b.text).strip() or "-") for b in blocks]
        return plain, y


# Elements and roles that mark article text and what isn't (HTML standard).
INSIDE = frozenset(("article", "main"))
OUTSIDE = frozenset(("nav", "aside", "footer", "form", "button", "=navigation", "=complementary", "=search"))


def by_landmarks(blocks: list[Block]) -> np.ndarray | None:
    """Labels of a page that marks its article with a landmark element; None if it doesn't."""
    named = [set(b.path) for b in blocks]
    if not any(n & INSIDE for n in named):
        return None
    return np.array([float(bool(n & INSIDE) and not n & OUTSIDE) for n in named], dtype=np.float32)


def train(pages: list[str], steps: int = 260, written: int = 500, batch: int = 24) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(3)
    real = [read_blocks(p) for p in pages]
    words = sorted({w for blocks in real for b in blocks for w in b.text.split()[:200]})[:: max(1, len(real) // 20)]
    grammar = Grammar([entities.escape(w) for w in words[:5000]])
    examples = [grammar.page() for _ in range(written)]
    examples += [(b, y) for b in real if b and (y := by_landmarks(b)) is not None]
    examples = [(b[:150], y[:150]) for b, y in examples if b]
    features = Features()
    coded = [(features.of(b), y) for b, y in examples]
    p = {
        # rows not met in training stay neutral
        "path": np.zeros((PATH_ROWS, PATH_DIM), dtype=np.float32), "word": np.zeros((WORD_ROWS, WORD_DIM), dtype=np.float32),
        "in": uniform(rng, 2, 4 * SIZE, WIDTH, scale=0.3), "bias": np.zeros((2, 4 * SIZE), dtype=np.float32),
        "u": uniform(rng, 2, 4 * SIZE, SIZE, scale=0.25), "out": uniform(rng, 2 * SIZE, scale=0.3),
        "out_bias": np.zeros(1, dtype=np.float32),
    }
    adam = Adam(p, 0.02)
    by_size = sorted(range(len(coded)), key=lambda i: len(coded[i][1]))
    for step in range(steps):
        adam.rate = 0.02 * (1 - step / steps) + 0.0005
        start = int(rng.integers(max(1, len(by_size) - batch)))
        chosen = [coded[i] for i in by_size[start : start + batch]]
        x = padded([vectors(f, p) for f, _ in chosen])
        y, mask = np.zeros(x.shape[:2], dtype=np.float32), np.zeros(x.shape[:2], dtype=np.float32)
        for j, (_, t) in enumerate(chosen):
            y[: len(t), j], mask[: len(t), j] = t, 1
        h, kept = Lstm.forward(gate_inputs(x, p), p["u"], keep=True)
        h = flip(h)
        logits = np.einsum("h,thb->tb", p["out"], h) + p["out_bias"][0]
        d = ((1 / (1 + np.exp(-logits)) - y) * mask / mask.sum()).astype(np.float32)
        d_gx, d_u = Lstm.backward(unflip(p["out"][None, :, None] * d[:, None]), p["u"], kept)
        d_in = np.stack([
            np.einsum("tgb,tbi->gi", d_gx[:, 0], x, optimize=True),
            np.einsum("tgb,tbi->gi", d_gx[:, 1], x[::-1], optimize=True)])
        d_x = np.einsum("tgb,gi->tbi", d_gx[:, 0], p["in"][0], optimize=True) + np.einsum(
            "tgb,gi->tbi", d_gx[::-1, 1], p["in"][1], optimize=True)
        path = np.zeros_like(p["path"])
        word = np.zeros_like(p["word"])
        for j, (f, t) in enumerate(chosen):
            own = d_x[: len(t), j]
            for name, target, cut in (("path", path, slice(0, PATH_DIM)), ("last", path, slice(PATH_DIM, 2 * PATH_DIM)),
                                      ("word", word, slice(2 * PATH_DIM, 2 * PATH_DIM + WORD_DIM))):
                if len(f[name]):
                    share = own[:, cut] / np.maximum(1, np.bincount(f[name + "_of"], minlength=len(t)))[:, None]
                    rows, where = np.unique(f[name], return_inverse=True)
                    target[rows] += add_rows(where, share[f[name + "_of"]], len(rows))
        adam.update({
            "path": path, "word": word, "in": d_in, "bias": d_gx.sum(axis=(0, 3)), "u": d_u,
            "out": np.einsum("tb,thb->h", d, h), "out_bias": np.array([d.sum()], dtype=np.float32),
        })
    return p


def main_text(pages: list[str | None], p: dict[str, np.ndarray], features: Features) -> list[str]:
    blocks = [read_blocks(page) for page in pages]
    return [
        "\n".join(b.text for b, k in zip(own, keep, strict=True) if k)
        for own, keep in zip(blocks, label(blocks, p, features), strict=True)
    ]


def training_pages(rows: DataFrame) -> list[str]:
    """At most PAGES different pages; their hashes are chosen before any text travels."""
    hashed = rows.where("html IS NOT NULL").withColumn("o", F.xxhash64("id", "html"))
    chosen = [r.o for r in hashed.select("o").distinct().orderBy("o").limit(PAGES).collect()]
    texts = hashed.where(F.col("o").isin(chosen)).groupBy("o").agg(F.min(F.substring("html", 1, PAGE_CHARS)).alias("h"))
    return [r.h for r in texts.orderBy("o").collect()]


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """``id, url, text, n_chars`` per page."""
    rows = pick(pages, id_col, url_col, html_col).toDF("id", "url", "html").select(
        F.col("id").cast("long").alias("id"), "url", "html")
    params = train(training_pages(rows))
    schema = pa.schema([("id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in small(batches):
            texts = main_text(batch.column("html").to_pylist(), params, features)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    return rows.mapInArrow(run, from_arrow_schema(schema))
