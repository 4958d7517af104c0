"""Main text of web pages by a recurrent block labeller.

A page becomes a sequence of leaf blocks: text between block-level tags, with the path of open tags and their class and
id words. Each block has a vector of its hashed path, its hashed words and a few counts; a bidirectional LSTM in numpy
reads the whole sequence and labels each block as main text or not. It is trained here, on pages that ``sample_pages``
makes up with known labels: a fixed number, so what is broadcast has a fixed size.

Cases: null and empty pages have no blocks and give an empty text; tags left open end with the page, an unfinished tag or
comment at its end is dropped; unknown tags are inline; very long pages are one sequence; repeated rows each have a row;
an empty table gives an empty result; columns other than those named are not read.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ngram_join import words_of

#: Elements that end a block of text, elements without content, elements whose content is no text.
BLOCK_TAGS = frozenset("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template svg iframe object".split())
#: An opening tag closes an open one of these.
CLOSES = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)} | {t: ("p",) for t in ("article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul")}
TAG = re.compile(r"</?(?=[a-zA-Z])")
NAME_ENDS, SPECIAL = re.compile(r"[\s/>]"), re.compile("[>\"']")
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
PATH_DIMS, WORD_DIMS, EXTRA = 96, 64, 6
DIMS = PATH_DIMS + WORD_DIMS + EXTRA
HIDDEN = 12
TRAIN_PAGES = 480

Block = tuple[np.ndarray, str, int]  # hashed path, text, characters in links


class Tags:
    """Tags, comments and declarations of a page, found in one pass: what a failed search has learnt is not searched again."""

    def __init__(self, page: str):
        self.page, self.size = page, len(page)
        self.last = {c: page.rfind(c) for c in "<>\"'"}
        self.known = {NAME_ENDS: (0, -1), SPECIAL: (0, -1)}  # between these places nothing of the kind stands
        self.dead: set[int] = set()  # places outside quotes from which no tag ends

    def next(self, kind: re.Pattern, at: int) -> int:
        low, high = self.known[kind]
        if not low <= at <= high:
            m = kind.search(self.page, at)
            self.known[kind] = at, m.start() if m else self.size
        return self.known[kind][1]

    def end_of_tag(self, at: int) -> int:
        """Where the > outside quotes is, or -1."""
        seen = []
        while at not in self.dead:
            seen.append(at)
            at = self.next(SPECIAL, at)
            if at == self.size:
                break
            c = self.page[at]
            if c == ">":
                return at
            if at >= self.last[c]:  # a quote that nothing closes
                break
            at = self.page.find(c, at + 1) + 1
        self.dead.update(seen)
        return -1

    def __iter__(self) -> Iterator[tuple[int, int, str, bool, str]]:
        """start, end, name (empty for what is no tag), whether it closes, attributes. Assign to ``at`` to skip."""
        page, self.at = self.page, 0
        while (start := page.find("<", self.at)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                self.at = self.size if end < 0 else end + 3
                yield start, self.at, "", False, ""
            elif page[start + 1 : start + 2] in ("!", "?"):
                end = page.find(">", start + 2)
                self.at = self.size if end < 0 else end + 1
                yield start, self.at, "", False, ""
            elif m := TAG.match(page, start):
                named = self.next(NAME_ENDS, m.end())
                end = self.end_of_tag(named)
                if end >= 0:
                    self.at = end + 1
                    yield start, self.at, page[m.end() : named], len(m[0]) == 2, page[named:end]
                elif start == self.last["<"] and self.last[">"] < start:
                    self.at = self.size  # an unfinished tag
                    yield start, self.at, "", False, ""
                else:
                    self.at = start + 1
            else:
                self.at = start + 1


class Stack:
    """Open tags with the hashed words of their path, kept up as tags open and close."""

    def __init__(self):
        self.tags: list[tuple[str, tuple[int, ...]]] = []
        self.of: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.path = np.zeros(PATH_DIMS, np.int64)

    def open(self, tag: str, words: list[str]) -> None:
        dims = tuple(zlib.crc32(w.encode()) % PATH_DIMS for w in words)
        for d in dims:
            self.path[d] += 1
        self.of.setdefault(tag, []).append(len(self.tags))
        if tag in BLOCK_TAGS:
            self.blocks.append(len(self.tags))
        self.tags.append((tag, dims))

    def cut(self, at: int) -> None:
        while len(self.tags) > at:
            tag, dims = self.tags.pop()
            self.of[tag].pop()
            if tag in BLOCK_TAGS:
                self.blocks.pop()
            for d in dims:
                self.path[d] -= 1

    def close(self, tag: str) -> None:
        """Closes the tag and what is open in it; an inline tag only within its block."""
        if (at := self.of.get(tag)) and (tag in BLOCK_TAGS or not self.blocks or at[-1] > self.blocks[-1]):
            self.cut(at[-1])

    def closed_by(self, tag: str) -> None:
        while self.blocks and self.tags[self.blocks[-1]][0] in CLOSES.get(tag, ()):
            self.cut(self.blocks[-1])


def plain(text: str) -> str:
    """Text with character references decoded and white space as one space; numbers of any length are none of a character."""
    if "&#" in text:
        text = re.sub(r"&#0+(?=\d)", "&#", text)
        text = re.sub(r"&#\d{8,};?", "\ufffd", text)
    return " ".join(entities.unescape(text).split())


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks in page order."""
    out: list[Block] = []
    stack = Stack()
    parts: list[str] = []
    linked = 0
    page = page or ""

    def close() -> None:
        nonlocal linked
        if parts:
            if text := plain("".join(parts)):
                out.append((np.minimum(stack.path, 2).astype(np.float32), text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def take(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if any(t == "a" for t, _ in stack.tags[-4:]):
                linked += len(text.strip())

    at, tags = 0, Tags(page)
    for start, end, name, closing, attributes in tags:
        take(page[at:start])
        at = end
        tag = name.lower()
        if not tag:
            continue
        if tag in VOID_TAGS:
            if tag == "hr":
                close()
            parts.append(" ")
        elif closing:
            if tag in BLOCK_TAGS:
                close()
            stack.close(tag)
        elif tag in RAW_TAGS:
            if not attributes.endswith("/"):
                m = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = tags.at = m.end() if m else len(page)
        else:
            if tag in BLOCK_TAGS:
                close()
                stack.closed_by(tag)
            words = [tag]
            if attributes:
                for n in NAMES.findall(attributes):
                    words += [f".{w}" for w in re.findall(r"[a-z]+", "".join(n).lower())]
            stack.open(tag, words)
    take(page[at:])
    close()
    return out


def vectors(seq: list[Block]) -> np.ndarray:
    """A row for each block. Counts are scaled so that no block's length dominates."""
    x = np.zeros((len(seq), DIMS), np.float32)
    for i, (path, text, linked) in enumerate(seq):
        x[i, :PATH_DIMS] = path
        n = len(text)
        x[i, -EXTRA:] = (np.log1p(n) / 6, linked / n, text[-1] in ".?!", sum(map(text.count, ".,;")) * 10 / n, i / len(seq), 1)
    for i, h in enumerate(words_of([t for _, t, _ in seq])):
        if len(h):
            x[i, PATH_DIMS : PATH_DIMS + WORD_DIMS] = np.bincount((h % np.uint64(WORD_DIMS)).astype(np.int64), minlength=WORD_DIMS) / np.sqrt(len(h))
    return x


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Two LSTMs, one for each direction, and a logistic unit over both states."""

    def __init__(self, seed: int = 7):
        r = np.random.RandomState(seed)
        g = lambda *s: (r.randn(*s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"wf": g(DIMS, 4 * HIDDEN), "wb": g(DIMS, 4 * HIDDEN), "uf": g(HIDDEN, 4 * HIDDEN), "ub": g(HIDDEN, 4 * HIDDEN), "bf": np.zeros(4 * HIDDEN, np.float32), "bb": np.zeros(4 * HIDDEN, np.float32), "o": g(2 * HIDDEN, 1)[:, 0], "c": np.zeros(1, np.float32)}
        for b in ("bf", "bb"):
            self.p[b][HIDDEN : 2 * HIDDEN] = 1

    def direction(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States (pages, steps, HIDDEN); steps where the mask is 0 keep the state at 0."""
        w, u, b = self.p["w" + d], self.p["u" + d], self.p["b" + d]
        z_all = x @ w + b
        n, steps, _ = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((n, steps, HIDDEN), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = z_all[:, t] + h @ u
            i, f, o = (sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in (0, 1, 2))
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[:, t, None]
            c_new = (f * c + i * g) * m
            tc = np.tanh(c_new)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, tc, m))
            h, c = o * tc * m, c_new
            out[:, t] = h
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        h = np.concatenate([self.direction(x, mask, "f", keep and keep[0]), self.direction(x, mask, "b", keep and keep[1])], axis=2)
        return h @ self.p["o"] + self.p["c"], h

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        keep: tuple[list, list] = ([(None,)], [(None,)])
        z, h = self.logits(x, mask, keep)
        dz = (sigmoid(z) - y) * mask / mask.sum()
        out = {"o": np.einsum("nth,nt->h", h, dz), "c": np.array([dz.sum()])}
        dh_all = dz[..., None] * self.p["o"]
        for k, d in enumerate("fb"):
            u = self.p["u" + d]
            dh, dc = np.zeros((len(x), HIDDEN), np.float32), np.zeros((len(x), HIDDEN), np.float32)
            dw_z, du = np.zeros(x.shape[:2] + (4 * HIDDEN,), np.float32), np.zeros_like(u)
            for t, h0, c0, i, f, o, g, tc, m in reversed(keep[k][1:]):
                a = (dh_all[:, t, k * HIDDEN : (k + 1) * HIDDEN] + dh) * m
                dct = dc * m + a * o * (1 - tc * tc)
                dzt = np.concatenate([dct * g * i * (1 - i), dct * c0 * f * (1 - f), a * tc * o * (1 - o), dct * i * (1 - g * g)], axis=1)
                dw_z[:, t] = dzt
                du += h0.T @ dzt
                dh, dc = dzt @ u.T, dct * f
            out |= {"w" + d: np.einsum("ntd,ntz->dz", x, dw_z, optimize=True), "u" + d: du, "b" + d: dw_z.sum(axis=(0, 1))}
        return out

    def train(self, pages: list[tuple[list[Block], list[int]]], epochs: int = 10, batch: int = 24, rate: float = 0.02) -> Labeller:
        """Adam over batches of pages of like length."""
        pages = sorted(pages, key=lambda p: len(p[0]))
        sets = [padded([vectors(s) for s, _ in pages[i : i + batch]], [np.array(y, np.float32) for _, y in pages[i : i + batch]]) for i in range(0, len(pages), batch)]
        m, v, n = {k: np.zeros_like(a) for k, a in self.p.items()}, {k: np.zeros_like(a) for k, a in self.p.items()}, 0
        order = random.Random(3)
        for _ in range(epochs):
            order.shuffle(sets)
            for x, mask, y in sets:
                n += 1
                for k, g in self.gradients(x, mask, y).items():
                    g = np.clip(g, -1, 1)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**n)) / (np.sqrt(v[k] / (1 - 0.99**n)) + 1e-6)).astype(np.float32)
        return self

    def label(self, seqs: list[list[Block]]) -> list[np.ndarray]:
        """For each sequence which blocks are main text. Sequences of like length are read together."""
        out: list = [np.zeros(0, bool)] * len(seqs)
        order = sorted((i for i, s in enumerate(seqs) if s), key=lambda i: len(seqs[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and end - at < 64 and len(seqs[order[end]]) * (end - at + 1) <= 4096:
                end += 1
            x, mask, _ = padded([vectors(seqs[i]) for i in order[at:end]])
            z, _ = self.logits(x, mask)
            for r, i in enumerate(order[at:end]):
                out[i] = z[r, : len(seqs[i])] > 0
            at = end
        return out


def padded(xs: list[np.ndarray], ys: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps = max(map(len, xs))
    x, mask, y = np.zeros((len(xs), steps, DIMS), np.float32), np.zeros((len(xs), steps), np.float32), np.zeros((len(xs), steps), np.float32)
    for i, a in enumerate(xs):
        x[i, : len(a)], mask[i, : len(a)] = a, 1
        if ys is not None:
            y[i, : len(a)] = ys[i]
    return x, mask, y


def sample_pages(n: int = TRAIN_PAGES, seed: int = 11) -> list[str]:
    """Made-up pages in many layouts; characters of main text are marked by a leading U+E000 in their block."""
    r = random.Random(seed)
    syllables = [a + b for a in "b c d f g h k l m n p r s t v w".split() for b in "a e i o u é ö an er ing ou".split()]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    sentence = lambda: words(3, 18).capitalize() + r.choice("....?!")
    prose = lambda a, b: " ".join(sentence() for _ in range(r.randint(a, b)))
    noisy = lambda t: " ".join(w + r.choice(["", "***", "###", "&amp;&amp;", "%%%"]) for w in t.split()) if r.random() < 0.1 else t.upper() if r.random() < 0.05 else t

    def attr(*names: str) -> str:
        return f'{r.choice(["class", "class", "id"])}="{r.choice(names)}"'

    def main_block() -> str:
        k, t = r.random(), "\ue000"
        if k < 0.7:
            body = t + noisy(prose(1, 7))
            tag = r.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<p>{} <a href='#'>" + word() + "</a> " + word() + ".</p>"])
            return tag.format(body)
        if k < 0.76:
            return f"<h{(d := r.randint(2, 4))}>{t}{words(1, 6)}</h{d}>"
        if k < 0.84:
            return f"<p>{t}{words(1, 2).capitalize()}.</p>"
        if k < 0.9:
            return "<ul>" + "".join(f"<li>{t}{words(2, 9)}</li>" for _ in range(r.randint(2, 5))) + "</ul>"
        return r.choice(["<blockquote>{}</blockquote>", "<div>{}</div>", "<pre>{}</pre>", "<blockquote><p>{}</p></blockquote>"]).format(t + prose(1, 3))

    def links() -> str:
        items = [f'<a href="/{word()}">{words(1, 3)}</a>' for _ in range(r.randint(2, 9))]
        return r.choice(["<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>", " | ".join(items), "".join(f"<div>{i}</div>" for i in items)])

    def boiler() -> str:
        return r.choice([
            lambda: f'<div {attr("ad", "ads", "advert", "ad-slot", "banner", "promo", "sponsored")}>{prose(1, 3)}</div>',
            lambda: f'<div {attr("cookie", "cookie-notice", "notice", "consent", "gdpr", "alert", "banner")}>{prose(1, 2)} {r.choice(["<button>OK</button>", ""])}</div>',
            lambda: f'<aside {attr("sidebar", "related", "widget", "side")}><h3>{words(1, 3)}</h3>{links()}{r.choice(["", "<p>" + prose(1, 3) + "</p>"])}</aside>',
            lambda: f"<aside>{prose(1, 3)}</aside>",
            lambda: f'<div {attr("sidebar", "related", "widget", "recommended", "tags", "share", "social", "breadcrumb", "menu")}>{links()}</div>',
            lambda: f'<form action="/s"><label>{words(1, 3)}</label><input name="q"><button>{word()}</button></form>',
            lambda: f'<form {attr("newsletter", "subscribe", "search", "login")}><p>{prose(1, 2)}</p><input><select><option>{word()}</option></select></form>',
        ])()

    def comments() -> str:
        each = lambda: r.choice([f'<div class="comment"><p>{prose(1, 3)}</p></div>', f"<li><b>{word()}</b> {prose(1, 3)}</li>", f"<p>{prose(1, 3)}</p>"])
        tag = r.choice(["section", "div", "ol", "ul"])
        return f'<{tag} {attr("comments", "comment-list", "comments-area", "responses", "discussion", "replies")}>{r.choice(["", "<h3>" + words(1, 2) + "</h3>"])}{"".join(each() for _ in range(r.randint(1, 6)))}</{tag}>'

    out = []
    for _ in range(n):
        title = words(2, 9).capitalize()
        head = f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>"
        top = r.choice([f"<nav>{links()}</nav>", f"<header><h1>{words(1, 3)}</h1>{links()}</header>", f'<div {attr("header", "top", "masthead", "navbar", "menu")}>{words(1, 4)} {links()}</div>', f"<header><nav>{links()}</nav><p>{sentence()}</p></header>", ""])
        body = [main_block() for _ in range(r.choice([1, 2, 3, 5, 8, 12, 18]))]
        if r.random() < 0.8:
            body.insert(0, f"<h1>\ue000{title}</h1>")
        for _ in range(r.choice([0, 0, 0, 1, 2])):
            body.insert(r.randint(0, len(body)), boiler())
        said = comments() if r.random() < 0.35 else ""
        inside = r.random() < 0.4
        body = "".join(body) + (said if inside else "")
        wrap = r.choice(["<article>{}</article>", "<article>{}</article>", "<main><article>{}</article></main>", "<main>{}</main>", '<div class="content">{}</div>', '<div class="post entry">{}</div>', '<div id="article-body">{}</div>', '<section class="story">{}</section>'])
        page = head + top + "".join(boiler() for _ in range(r.choice([0, 1, 1, 2]))) + wrap.format(body) + ("" if inside else said) + "".join(boiler() for _ in range(r.choice([0, 0, 1, 2])))
        page += r.choice([f"<footer>&copy; {word()} &middot; {prose(1, 2)}</footer>", f'<div {attr("footer", "bottom", "copyright", "legal")}>{prose(1, 2)}{links()}</div>', f"<footer>{links()}</footer>", ""]) + "</body></html>"
        out.append(page[: r.randint(len(page) // 2, len(page))] if r.random() < 0.1 else page)
    return out


def labelled(page: str) -> tuple[list[Block], list[int]]:
    seq = blocks(page)
    return [(p, t.replace("\ue000", "") or ".", k) for p, t, k in seq], [int("\ue000" in t) for _, t, _ in seq]


@cache
def trained() -> Labeller:
    return Labeller().train([p for p in map(labelled, sample_pages()) if p[0]])


def main_texts(pages: list[str | None], model: Labeller) -> list[str]:
    seqs = [blocks(p) for p in pages]
    return ["\n".join(t for (_, t, _), k in zip(s, keep) if k) for s, keep in zip(seqs, model.label(seqs))]


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", model: Labeller | None = None) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    model = model or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(2)
            for i in range(0, len(raw), 500):
                texts = main_texts(raw.slice(i, 500).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 500), batch.column(1).slice(i, 500), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
