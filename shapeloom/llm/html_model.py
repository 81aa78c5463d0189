"""Recurrent block labeller: a bidirectional LSTM in numpy.

It reads the vectors of a page's blocks from both ends, so every block is
classed knowing the whole page. It is trained here, on pages made with a fixed
seed out of the kinds of parts that pages have, each block labelled by the
part that it was made in.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache

import numpy as np

from .html_blocks import WIDTH, blocks, vectors

HIDDEN = 24
#: Blocks of a page that are read at a time.
WINDOW = 1024
#: A private-use character.
MARK = chr(0xE000)

#: Parts of made pages: (tag, class or id) forms that such parts take.
CONTENT = [("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "post-content"), ("div", "entry-content"),
           ("section", "story"), ("div", "article-body"), ("div", "text"), ("article", "entry hentry"), ("div", "main-content"),
           ("div", "articleBody"), ("section", "")]
CHROME = {
    "nav": [("nav", ""), ("div", "nav"), ("ul", "menu"), ("div", "navbar"), ("div", "topbar"), ("div", "breadcrumbs"), ("nav", "breadcrumb"),
            ("div", "main-menu"), ("div", "navigation"), ("div", "pagination"), ("div", "toc"), ("nav", "site-nav")],
    "header": [("header", ""), ("div", "header"), ("div", "masthead"), ("header", "site-header"), ("div", "top"), ("div", "logo"), ("div", "branding")],
    "footer": [("footer", ""), ("div", "footer"), ("footer", "site-footer"), ("div", "copyright"), ("div", "bottom"), ("div", "legal"), ("div", "colophon")],
    "side": [("aside", ""), ("div", "sidebar"), ("div", "widget"), ("div", "related"), ("section", "recommended"), ("div", "rail"), ("aside", "sidebar"),
             ("div", "side"), ("section", "related-posts"), ("div", "trending"), ("div", "popular"), ("div", "more")],
    "ad": [("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"), ("div", "sponsored"), ("div", "promo"), ("div", "banner"),
           ("ins", "adsbygoogle"), ("aside", "ad"), ("section", "sponsor"), ("div", "ad-slot"), ("p", "ad"), ("div", "advertising")],
    "notice": [("div", "cookie"), ("div", "cookie-notice"), ("div", "consent"), ("div", "gdpr"), ("div", "alert"), ("div", "notice"), ("p", "notice"),
               ("div", "popup"), ("div", "modal"), ("div", "newsletter"), ("div", "subscribe"), ("section", "cookie-banner"), ("div", "warning"),
               ("div", "message"), ("div", "paywall"), ("div", "disclaimer"), ("aside", "notice")],
    "form": [("form", ""), ("form", "search"), ("form", "login"), ("div", "search-form"), ("form", "contact"), ("form", "signup")],
    "comments": [("section", "comments"), ("div", "comments"), ("ol", "comment-list"), ("div", "disqus"), ("div", "replies"), ("section", "responses"),
                 ("div", "discussion"), ("ul", "comments"), ("div", "comment"), ("aside", "comments"), ("div", "reader-comments"), ("div", "user-comments")],
    "share": [("div", "share"), ("div", "social"), ("ul", "tags"), ("div", "share-buttons"), ("div", "follow")],
}
WORDS = {"nav": "home about contact news blog products services login search help menu next previous".split(),
         "header": "the daily welcome site your source for official news of world".split(),
         "footer": "© copyright all rights reserved privacy policy terms contact imprint 2024 powered by".split(),
         "side": "related popular more most read posts recent trending you may like archive".split(),
         "ad": "buy now sale offer free shipping discount advertisement sponsored order today limited deal".split(),
         "notice": "we use cookies accept to improve your experience consent subscribe newsletter please read updated notice".split(),
         "form": "name email password send submit search subscribe your message required".split(),
         "comments": "comment reply says i think great post thanks disagree agree you wrote ago".split(),
         "share": "share tweet facebook email print like follow tags".split()}


class _Pages:
    """Made pages and their labels."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, n: int, kind: str | None = None) -> str:
        r, out = self.r, []
        syllables = r.choice(("th er on an re he in ed nd ha", "ción os de la ar ue mi ez ll ra", "sch ung en ver ch ge lich be ein te",
                              "ou la en tion eau re le ai qu é", "ka to mi no su re ha ri", "st pro kov na ve sky od i je")).split()
        for _ in range(n):
            if kind and r.random() < 0.4:
                out.append(r.choice(WORDS[kind]))
            else:
                out.append("".join(r.choice(syllables) for _ in range(r.randint(1, 4))))
        out[0] = out[0].capitalize()
        return " ".join(out)

    def sentence(self, kind: str | None = None) -> str:
        return self.words(self.r.randint(2, 18), kind) + "."

    def wrap(self, form: tuple[str, str], inner: str, plain: bool) -> str:
        r, (tag, name) = self.r, form
        if plain:
            return f"<div>{inner}</div>" if tag not in ("ul", "ol") else f"<{tag}>{inner}</{tag}>"
        if name and r.random() < 0.3:
            name += r.choice(["-1", "-top", "_2", " box", " wide", "-x", " clearfix", " c" + str(r.randint(1, 99))])
        if not name and r.random() < 0.15:
            name = self.words(1).lower()
        attribute = f' {r.choice(["class", "class", "id"])}="{name}"' if name else ""
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def chrome(self, kind: str, plain: bool) -> str:
        r = self.r
        form = r.choice(CHROME[kind])
        count = r.randint(1, 7)
        links = "".join(f'<li><a href="/{k}">{self.words(r.randint(1, 4), kind if r.random() < .5 else None)}</a></li>' for k in range(count))
        texts = "".join(f"<p>{self.sentence(kind if r.random() < .5 else None)}</p>" for _ in range(r.randint(1, 3)))
        word = kind if r.random() < 0.5 else None
        if kind in ("nav", "share"):
            inner = links if form[0] in ("ul", "ol") else r.choice([f"<ul>{links}</ul>", links.replace("<li>", "").replace("</li>", " "), f"<ul>{links}</ul>"])
        elif kind == "side":
            inner = f"<h3>{self.words(2, word)}</h3>" + r.choice([f"<ul>{links}</ul>", texts])
        elif kind == "form":
            inner = "".join(f"<label>{self.words(r.randint(1, 3), word)}</label><input name=x>" for _ in range(r.randint(1, 3)))
            inner += r.choice(["", f"<select><option>{self.words(1)}<option>{self.words(1)}</select>"]) + f"<button>{self.words(1, word)}</button>"
        elif kind == "comments":
            tag = r.choice(["p", "li", "div", "article"])
            some = "".join(f'<{tag}{r.choice(["", " class=comment", " class=reply"])}>' + r.choice(["", f"<b>{self.words(1)}</b>: "])
                           + " ".join(self.sentence(word) for _ in range(r.randint(1, 5))) + f"</{tag}>" for _ in range(r.randint(1, 6)))
            inner = r.choice(["", f"<h2>{self.words(2, word)}</h2>"]) + some
        elif kind == "header":
            inner = r.choice([f"<h1>{self.words(2, word)}</h1>", f"<a href=/>{self.words(2, word)}</a>", texts, self.words(3, word)])
        else:
            inner = r.choice([texts, self.sentence(word), self.sentence(word), f"<p>{self.sentence(word)} <a href=#>{self.words(1)}</a></p>"])
        if form[0] == "p":
            inner = self.sentence(word)
        return self.wrap(form, inner, plain and kind not in ("form",))

    def content(self, plain: bool) -> list[str]:
        r = self.r
        out = [f"<h1>{self.words(r.randint(1, 9))}</h1>"] if r.random() < 0.85 else []
        for _ in range(r.randint(1, 14)):
            text = " ".join(self.sentence() for _ in range(r.choice([1, 1, 2, 4, 9])))
            if r.random() < 0.12:
                text = self.words(r.randint(1, 30)).upper()
            if r.random() < 0.15:
                text = text.replace(" ", f" <a href=/x>{self.words(1)}</a> ", 1)
            kind = r.random()
            out.append(f"<p>{text}</p>" if kind < 0.72 else f"<p><b>{text}<br>" if kind < 0.8 else f"<h2>{self.words(r.randint(1, 6))}</h2>" if kind < 0.87
                       else f"<ul><li>{text}</li><li>{self.sentence()}</li></ul>" if kind < 0.92 else f"<blockquote>{text}</blockquote>" if kind < 0.95
                       else f"<pre>{text}</pre>" if kind < 0.97 else f"<table><tr><td>{self.words(2)}<td>{self.words(1)}</table>")
        return out

    def page(self) -> tuple[list[str], list[int]]:
        """Pieces of html in order, and 1 for those of the main text."""
        r = self.r
        plain = r.random() < 0.12
        inner = [(x, 1) for x in self.content(plain)]
        if r.random() < 0.35:  # adverts, notices, asides, forms and comments also stand inside the article
            for _ in range(r.randint(1, 3)):
                kind = r.choice(["ad", "side", "notice", "share", "form", "ad"])
                inner.insert(r.randint(1, len(inner)), (self.chrome(kind, False), 0))
        if r.random() < 0.2:
            inner.append((self.chrome("comments", False), 0))
        top = [k for k in ("notice", "header", "nav", "ad", "side", "form", "nav") if r.random() < 0.45]
        bottom = [k for k in ("share", "comments", "comments", "side", "ad", "form", "notice", "footer") if r.random() < 0.4]
        if r.random() < 0.6 and "footer" not in bottom:
            bottom.append("footer")
        if plain:  # without names only links and short lines can be told from the text
            top, bottom = [k for k in top if k in ("nav", "form")], [k for k in bottom if k in ("share", "form")]
            inner = [x for x in inner if x[1]]
        r.shuffle(top)
        form = r.choice(CONTENT)
        outer = r.choice(["", "", '<div id="page">', '<div class="container"><div class="row">', "<main>"])
        opening = outer + (f'<{form[0]}{f" class={chr(34)}{form[1]}{chr(34)}" if form[1] else ""}>' if not plain else "<div>")
        pieces = [(self.chrome(k, plain), 0) for k in top] + [(opening, -1)] + inner
        pieces += [(f"</{form[0] if not plain else 'div'}>", -1)] + [(self.chrome(k, plain), 0) for k in bottom]
        return [p for p, _ in pieces], [y for _, y in pieces]


def made_pages(n: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(vectors, labels) of ``n`` made pages.

    Every block of main text is made with a mark in front, which no page has,
    so that labels survive parsing; the mark is taken off before the vectors.
    """
    make, out = _Pages(seed), []
    while len(out) < n:
        pieces, kinds = make.page()
        html = ""
        for piece, kind in zip(pieces, kinds, strict=True):
            if kind == 1:
                cells = re.findall("<li>|<td>", piece)
                piece = re.sub("(<li>|<td>)", rf"\1{MARK}", piece) if cells else piece.replace(">", ">" + MARK, 1)
            html += piece
        page = blocks(f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{html}</body></html>")
        labels = np.array([b.text.startswith(MARK) for b in page], dtype=np.float64)
        for b in page:
            b.text = b.text.replace(MARK, "").strip() or "x"
        if page:
            out.append((vectors(page), labels))
    return out


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(batch x steps x WIDTH, the same from the end, lengths)."""
    lengths = np.array([len(p) for p in pages])
    x = np.zeros((len(pages), lengths.max(), WIDTH), dtype=np.float32)
    back = x.copy()
    for k, p in enumerate(pages):
        x[k, :len(p)] = p
        back[k, :len(p)] = p[::-1]
    return x, back, lengths


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _read(x: np.ndarray, wx, wh, b):
    """States of one direction, and what training needs of every step."""
    size, steps, _ = x.shape
    z_all = x.reshape(size * steps, -1) @ wx
    z_all = z_all.reshape(size, steps, 4 * HIDDEN) + b
    hid = np.zeros((size, HIDDEN), dtype=x.dtype)
    cell = np.zeros_like(hid)
    states, kept = np.empty((size, steps, HIDDEN), dtype=x.dtype), []
    for t in range(steps):
        z = z_all[:, t] + hid @ wh
        gates = _sigmoid(z[:, :3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        g = np.tanh(z[:, 3 * HIDDEN:])
        before = cell
        cell = f * before + i * g
        bent = np.tanh(cell)
        kept.append((hid, i, f, o, g, before, bent))
        hid = o * bent
        states[:, t] = hid
    return states, kept


def _back(x, wh, kept, d_states):
    """Gradients of one direction's weights."""
    size, steps, _ = x.shape
    dz_all = np.zeros((size, steps, 4 * HIDDEN), dtype=x.dtype)
    d_wh = np.zeros_like(wh)
    d_hid = np.zeros((size, HIDDEN), dtype=x.dtype)
    d_cell = np.zeros_like(d_hid)
    for t in range(steps - 1, -1, -1):
        hid, i, f, o, g, before, bent = kept[t]
        d = d_states[:, t] + d_hid
        d_cell = d_cell + d * o * (1 - bent * bent)
        dz = np.concatenate([d_cell * g * i * (1 - i), d_cell * before * f * (1 - f), d * bent * o * (1 - o), d_cell * i * (1 - g * g)], axis=1)
        d_cell = d_cell * f
        d_wh += hid.T @ dz
        d_hid = dz @ wh.T
        dz_all[:, t] = dz
    flat = dz_all.reshape(size * steps, -1)
    return x.reshape(size * steps, -1).T @ flat, d_wh, flat.sum(axis=0)


def _from_end(states: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """States of the backward reading in page order (and the other way round)."""
    steps = states.shape[1]
    place = lengths[:, None] - 1 - np.arange(steps)[None, :]
    return np.take_along_axis(states, np.where(place >= 0, place, np.arange(steps)[None, :])[:, :, None], axis=1)


def _steps(x: np.ndarray, hid: np.ndarray, cell: np.ndarray, wx, wh, b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """States of one direction over a window of steps, from the states before it; nothing is kept for training."""
    size, steps, _ = x.shape
    z_all = (x.reshape(size * steps, -1) @ wx).reshape(size, steps, 4 * HIDDEN) + b
    states = np.empty((size, steps, HIDDEN), dtype=x.dtype)
    for t in range(steps):
        z = z_all[:, t] + hid @ wh
        gates = _sigmoid(z[:, :3 * HIDDEN])
        cell = gates[:, HIDDEN:2 * HIDDEN] * cell + gates[:, :HIDDEN] * np.tanh(z[:, 3 * HIDDEN:])
        hid = gates[:, 2 * HIDDEN:] * np.tanh(cell)
        states[:, t] = hid
    return states, hid, cell


def _scores(pages: list, wx, wh, b, out, backward: bool) -> list[np.ndarray]:
    """What one direction adds to the score of every block, read in windows of WINDOW steps."""
    lengths = [len(p) for p in pages]
    hid = np.zeros((len(pages), HIDDEN), dtype=np.float32)
    cell = np.zeros_like(hid)
    found = [np.empty(n, dtype=np.float32) for n in lengths]
    for begin in range(0, max(lengths), WINDOW):
        steps = min(WINDOW, max(lengths) - begin)
        x = np.zeros((len(pages), steps, WIDTH), dtype=np.float32)
        for k, (page, n) in enumerate(zip(pages, lengths, strict=True)):
            here = min(max(n - begin, 0), steps)
            if here:
                x[k, :here] = page(n - begin - here, n - begin)[::-1] if backward else page(begin, begin + here)
        states, hid, cell = _steps(x, hid, cell, wx, wh, b)
        score = states @ out
        for k, n in enumerate(lengths):
            here = min(max(n - begin, 0), steps)
            if here and backward:
                found[k][n - begin - here:n - begin] = score[k, :here][::-1]
            elif here:
                found[k][begin:begin + here] = score[k, :here]
    return found


class Sequence:
    """A page's vectors, made a stretch at a time; those of a page of one window are made once."""

    def __init__(self, page: list):
        self.page = page
        self.whole = vectors(page) if len(page) <= WINDOW else None

    def __len__(self) -> int:
        return len(self.page)

    def __call__(self, begin: int, end: int) -> np.ndarray:
        return vectors(self.page, begin, end) if self.whole is None else self.whole[begin:end]


class Given:
    """Vectors that are there already."""

    def __init__(self, x: np.ndarray):
        self.x = x

    def __len__(self) -> int:
        return len(self.x)

    def __call__(self, begin: int, end: int) -> np.ndarray:
        return self.x[begin:end]


def probabilities(weights: list[np.ndarray], pages: list) -> list[np.ndarray]:
    """Probability of main text for every block of each page: a Sequence, or an array of its vectors.

    Pages of like length are read together, up to 16,384 blocks of a window at
    a time, so memory is that of a window, and a few numbers a block.
    """
    pages = [Given(p) if isinstance(p, np.ndarray) else p for p in pages]
    out: list[np.ndarray] = [np.zeros(0)] * len(pages)
    order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and (to - at + 1) * len(pages[order[to]]) <= 16_384:
            to += 1
        some = [pages[k] for k in order[at:to]]
        ahead = _scores(some, *weights[:3], weights[6], False)
        behind = _scores(some, *weights[3:6], weights[7], True)
        for k, a, b in zip(order[at:to], ahead, behind, strict=True):
            out[k] = _sigmoid(a + b + weights[8])
        at = to
    return out


@lru_cache(maxsize=1)
def trained(n_pages: int = 1500, epochs: int = 8, batch: int = 45, rate: float = 0.012, seed: int = 11) -> tuple[np.ndarray, ...]:
    """Weights after ``epochs`` passes over ``n_pages`` made pages; the same in every run."""
    rng = np.random.default_rng(seed)
    pages = sorted(made_pages(n_pages, seed), key=lambda p: len(p[1]))
    groups = [pages[k:k + batch] for k in range(0, len(pages), batch)]

    def start(rows, cols):
        return (rng.standard_normal((rows, cols)) / np.sqrt(rows)).astype(np.float32)
    bias = np.zeros(4 * HIDDEN, dtype=np.float32)
    bias[HIDDEN:2 * HIDDEN] = 1.0
    weights = [start(WIDTH, 4 * HIDDEN), start(HIDDEN, 4 * HIDDEN), bias.copy(), start(WIDTH, 4 * HIDDEN), start(HIDDEN, 4 * HIDDEN), bias.copy(),
               start(HIDDEN, 1)[:, 0], start(HIDDEN, 1)[:, 0], np.zeros(1, dtype=np.float32)]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        pace = rate * (1 - epoch / epochs) + 1e-3
        for k in rng.permutation(len(groups)):
            x, back, lengths = _padded([p for p, _ in groups[k]])
            y = np.zeros(x.shape[:2], dtype=np.float32)
            for row, (_, labels) in enumerate(groups[k]):
                y[row, :len(labels)] = labels
            mask = np.arange(x.shape[1])[None, :] < lengths[:, None]
            ahead, kept_a = _read(x, *weights[:3])
            behind, kept_b = _read(back, *weights[3:6])
            ordered = _from_end(behind, lengths)
            p = _sigmoid(ahead @ weights[6] + ordered @ weights[7] + weights[8])
            d = ((p - y) * mask / mask.sum()).astype(np.float32)
            grads = [*_back(x, weights[1], kept_a, d[:, :, None] * weights[6]),
                     *_back(back, weights[4], kept_b, _from_end(d[:, :, None] * weights[7], lengths)),
                     np.einsum("bth,bt->h", ahead, d), np.einsum("bth,bt->h", ordered, d), d.sum(keepdims=True).reshape(1)]
            step += 1
            for w, g, m, v in zip(weights, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= (pace * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return tuple(weights)
