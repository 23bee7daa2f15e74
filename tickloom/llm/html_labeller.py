"""Main text of web pages: a bidirectional LSTM labels every block of a page as article or not.

A page's blocks are one sequence. A block's input is the sum of vectors of its tag path (element names,
words of class, id and role), the mean of vectors of its hashed words, and plain numbers such as length
and share of links. Two LSTMs read the sequence forwards and backwards, so each block is judged with all
of the page around it. Everything is NumPy; pages of similar length are run together.

`train` makes pages of many layouts from a small grammar, with known labels, and fits the model to them:
no labelled page is needed, and no page of the table is seen. The same seed gives the same model.

Cases: NULL, empty and text-free html give the empty text; broken markup is read as far as it goes and
unclosed elements end with their parents; long pages are read whole; NULL ids and urls are carried;
repeated rows get equal texts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.html_blocks import DENSE, PATH_SIZE, WORD_SIZE, Block, blocks, inputs
from tickloom.llm.workers import ship

PATH_DIM, WORD_DIM, HIDDEN = 12, 6, 16
INPUT = PATH_DIM + WORD_DIM + DENSE
PAGES, EPOCHS, BATCH = 1600, 7, 24
#: Characters of html whose blocks are labelled together.
AT_ONCE = 2 << 20
MARK = "①"

_NAMES = {
    "content": "content post entry story article text body main single-post page-content article-body post-content entry-content story-body articleBody",
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topbar main-menu site-nav pagination toc tabs",
    "header": "header masthead site-header branding logo top-bar page-header hero-bar",
    "footer": "footer site-footer copyright colophon foot legal bottom-bar credits",
    "side": "sidebar side widget related recommended popular trending side-bar rail more-stories tags aside",
    "notice": "notice cookie cookie-banner consent alert gdpr popup modal newsletter warning message banner-notice paywall disclaimer announcement",
    "ad": "ad ads advert advertisement banner promo sponsored sponsor ad-slot ad-container adsbygoogle promotion commercial",
    "form": "form login search subscribe signup search-form contact-form poll survey",
    "comments": "comments comment reply replies responses discussion disqus comment-list user-comments reader-comments feedback",
    "share": "share social follow share-buttons social-links meta byline author-box",
}
_TALK = {
    "nav": "home about contact news sports archive products next previous login blog shop help",
    "footer": "copyright rights reserved privacy terms imprint contact all site",
    "notice": "we use cookies accept agree privacy consent please subscribe continue",
    "ad": "advertisement sponsored buy now sale offer discount shop best deal",
    "form": "search email name password submit subscribe send login",
    "comments": "reply says posted like great thanks comment report user ago",
    "side": "related popular recent read more latest tags trending",
    "share": "share tweet follow facebook email print by author",
    "header": "welcome site logo home magazine daily",
}


class _Grammar:
    """Pages as text, the blocks of the article marked."""

    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(("an", "ti", "re", "th", "on", "es", "ou", "la", "en", "mi", "sch", "ing", "qu", "o", "é", "ü")) for _ in range(self.r.randint(1, 4)))

    def prose(self, n: int) -> str:
        out = []
        while n > 0:
            k = min(n, self.r.randint(1, 14))
            out.append(" ".join(self.word() for _ in range(k)).capitalize() + self.r.choice(("." if self.r.random() < 0.95 else "", ".", "!", "?")))
            n -= k
        return " ".join(out)

    def talk(self, kind: str, n: int) -> str:
        if self.r.random() < 0.5:
            return self.prose(n)
        own = _TALK.get(kind, "more info here").split()
        return " ".join(self.r.choice(own) if self.r.random() < 0.6 else self.word() for _ in range(n))

    def names(self, kind: str, sure: bool = False) -> str:
        if not sure and self.r.random() < 0.2:
            return ""
        name = self.r.choice(_NAMES[kind].split())
        if self.r.random() < 0.3:
            name = f"{self.word()}-{name}" if self.r.random() < 0.5 else f"{name} {self.word()}"
        return f' {self.r.choice(("class", "class", "id"))}="{name}"'

    def list_of(self, kind: str) -> str:
        items = "".join(f'<li><a href="/{self.word()}">{self.talk(kind, self.r.randint(1, 4))}</a></li>' for _ in range(self.r.randint(3, 9)))
        return f"<ul>{items}</ul>"

    def boiler(self, kind: str) -> str:
        r, tag = self.r, {"nav": "nav", "header": "header", "footer": "footer", "side": "aside", "form": "form"}.get(kind, "")
        plain = not tag or r.random() < 0.35
        opening = f"<{'section' if plain and r.random() < 0.2 else 'div'}{self.names(kind, True)}>" if plain else f"<{tag}{self.names(kind)}>"
        closing = f"</{opening[1:].split('>')[0].split(' ')[0]}>"
        if kind == "nav":
            inside = self.list_of(kind) if r.random() < 0.8 else "".join(f'<a href="#">{self.talk(kind, 1)}</a> | ' for _ in range(5))
        elif kind == "side":
            inside = f"<h3>{self.talk(kind, 2)}</h3>" + (self.list_of(kind) if r.random() < 0.6 else f"<p>{self.talk(kind, r.randint(5, 40))}</p>")
        elif kind == "form":
            inside = f'<label>{self.talk(kind, 2)}</label><input name="q"><button>{self.talk(kind, 1)}</button>' + (f"<p>{self.talk(kind, 8)}</p>" if r.random() < 0.4 else "")
        elif kind == "comments":
            one = lambda: f'<{r.choice(("div", "li", "article", "p"))}{self.names(kind)}><p>{self.talk(kind, r.randint(1, 60))}</p>'
            inside = f"<h{r.randint(2, 4)}>{self.talk(kind, 2)}</h3>" * (r.random() < 0.6) + "".join(one() for _ in range(r.randint(1, 6)))
        elif kind == "header":
            inside = f"<{r.choice(('div', 'p', 'h1', 'span'))}>{self.talk(kind, r.randint(1, 6))}</div>" + (self.boiler("nav") if r.random() < 0.4 else "")
        elif kind == "footer":
            inside = f"&copy; {self.word()}.example &middot; {self.talk(kind, r.randint(2, 14))}" + (f"<p>{self.talk(kind, 12)}</p>" if r.random() < 0.3 else "")
        else:
            inside = self.talk(kind, r.randint(1, 40)) if r.random() < 0.5 else f"<p>{self.talk(kind, r.randint(1, 40))}</p>" * r.randint(1, 2)
        return opening + inside + closing

    def paragraph(self) -> str:
        r = self.r
        text = self.prose(int(r.choice((1, 2, 4, 10, 25, 60, 120)) * (0.5 + r.random())) or 1)
        if r.random() < 0.1:
            text = " ".join(f"{w}{r.choice(('***', '###', '&amp;&amp;', '%%%', '$$$', '!!', ' |'))}" for w in text.split())
        kind = r.random()
        if kind < 0.04:
            return "<ul>" + "".join(f"<li>{MARK}{self.prose(r.randint(2, 12))}</li>" for _ in range(r.randint(2, 5))) + "</ul>"
        if kind < 0.08:
            return f"<blockquote><p>{MARK}{text}</p></blockquote>"
        if kind < 0.13:
            return f"<h{r.randint(2, 4)}>{MARK}{self.prose(r.randint(1, 6))}</h2>"
        if kind < 0.16:
            return "<table><tr>" + "".join(f"<td>{MARK}{self.prose(2)}</td>" for _ in range(4)) + "</tr></table>"
        if kind < 0.22:
            return f"<p><b>{MARK}{text}<br>"
        if kind < 0.28:
            return f"<p>{MARK}{text} <a href='x'>{self.word()}</a> {self.word()}</p>"
        if kind < 0.31:
            return f"<pre>{MARK}{text}</pre>"
        return f"<p>{MARK}{text}" + "</p>" * (r.random() < 0.9)

    def article(self) -> str:
        r = self.r
        parts = [f"<h1>{MARK}{self.prose(r.randint(1, 12))}</h1>"] if r.random() < 0.9 else []
        if r.random() < 0.1 and parts:
            parts = [f"<header>{parts[0]}</header>"]
        for _ in range(int(r.choice((0, 1, 3, 6, 12, 30)) * (0.5 + r.random())) or (not parts)):
            parts.append(self.paragraph())
            if r.random() < 0.06:
                parts.append(self.boiler(r.choice(("ad", "side", "notice", "form", "share"))))
        if r.random() < 0.15:
            parts.append(self.boiler("comments"))
        body = "".join(parts)
        kind = r.random()
        if kind < 0.55:
            return f"<article{self.names('content') if r.random() < 0.4 else ''}>{body}</article>"
        if kind < 0.7:
            return f"<main>{body}</main>"
        if kind < 0.8:
            return f"<main><article>{body}</article></main>"
        if kind < 0.95:
            return f"<div{self.names('content', True)}>{body}</div>"
        return f"<div>{body}</div>"

    def page(self) -> str:
        r = self.r
        some = lambda kinds, p: "".join(self.boiler(k) for k in kinds if r.random() < p)
        before, after = ["notice", "header", "nav", "ad", "form", "side"], ["share", "comments", "ad", "side", "form", "notice", "nav", "footer"]
        if r.random() < 0.5:
            r.shuffle(before)
        first, rest = some(before, r.choice((0.25, 0.6))), some(after[:-1], r.choice((0.1, 0.5)))
        foot = self.boiler("footer") if r.random() < 0.85 else ""
        middle = first + self.article() + rest
        if r.random() < 0.3:
            middle = f"<div{self.names('content') if r.random() < 0.2 else ' id=wrapper'}>{middle}</div>"
        ending = "</body></html>" if r.random() < 0.9 else ""
        return f"<!DOCTYPE html><html><head><title>{self.prose(4)}</title></head><body>{middle}{foot}{ending}"


def labelled(page: str) -> tuple[list[Block], np.ndarray]:
    found = blocks(page)
    truth = np.array([MARK in b.text for b in found], np.float32)
    return [Block(b.text.replace(MARK, ""), b.path, b.links) for b in found if b.text != MARK], truth[[b.text != MARK for b in found]]


class Labeller:
    """Weights by name. `forward` runs padded sequences (pages, blocks, INPUT); masks say which blocks are there."""

    def __init__(self, seed: int) -> None:
        r = np.random.default_rng(seed)
        self.w = {"path": r.normal(0, 0.1, (PATH_SIZE, PATH_DIM)), "word": r.normal(0, 0.05, (WORD_SIZE, WORD_DIM)), "out": r.normal(0, 0.2, 2 * HIDDEN), "bias": np.zeros(1)}
        for side in ("f", "b"):
            self.w[f"x{side}"] = r.normal(0, INPUT**-0.5, (INPUT, 4 * HIDDEN))
            self.w[f"h{side}"] = r.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
            self.w[f"c{side}"] = np.concatenate([np.ones(HIDDEN), np.zeros(3 * HIDDEN)])
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def pad(self, pages: list[tuple]) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Inputs of pages as one array, its mask, and what the gradient of the vectors needs."""
        longest = max(len(p[2]) for p in pages)
        x = np.zeros((len(pages), longest, INPUT), np.float32)
        mask = np.zeros((len(pages), longest), np.float32)
        cells = {"path": [], "word": []}
        for i, (paths, bags, dense) in enumerate(pages):
            n = len(dense)
            mask[i, :n] = 1
            x[i, :n, PATH_DIM + WORD_DIM :] = dense
            for name, lists in (("path", paths), ("word", bags)):
                size = np.array([len(t) for t in lists])
                if name == "word":
                    weight = np.fromiter((k / total for t in lists for total in (t.total(),) for k in t.values()), np.float64)
                else:
                    weight = np.repeat(1 / np.sqrt(size), size)
                owner = i * longest + np.repeat(np.arange(n), size)
                cells[name].append((owner, np.fromiter((v for t in lists for v in t), np.int64), weight))
        flat = x.reshape(-1, INPUT)
        cells = {k: tuple(np.concatenate(c) for c in zip(*v, strict=True)) for k, v in cells.items()}
        for name, low, dim in (("path", 0, PATH_DIM), ("word", PATH_DIM, WORD_DIM)):
            owner, token, weight = cells[name]
            rows = self.w[name][token] * weight[:, None].astype(np.float32)
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            flat[owner[starts], low : low + dim] = np.add.reduceat(rows, starts, axis=0)
        return x, mask, cells

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str, keep: bool) -> tuple[np.ndarray, list]:
        n, steps = mask.shape
        pre = x @ self.w[f"x{side}"] + self.w[f"c{side}"]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, kept = np.zeros((n, steps, HIDDEN), np.float32), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            gates = pre[:, t] + h @ self.w[f"h{side}"]
            s = 1 / (1 + np.exp(-gates[:, : 3 * HIDDEN]))
            f, i, o, g = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(gates[:, 3 * HIDDEN :])
            m = mask[:, t : t + 1]
            new = f * c + i * g
            th = np.tanh(new)
            if keep:
                kept.append((t, f, i, o, g, c, th, h, m))
            h, c = m * o * th + (1 - m) * h, m * new + (1 - m) * c
            out[:, t] = h
        return out, kept

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
        (hf, kf), (hb, kb) = self._run(x, mask, "f", keep), self._run(x, mask, "b", keep)
        h = np.concatenate([hf, hb], axis=2)
        return 1 / (1 + np.exp(-np.clip(h @ self.w["out"] + self.w["bias"], -30, 30))), (h, kf, kb)

    def gradient(self, x: np.ndarray, mask: np.ndarray, cells: dict, truth: np.ndarray) -> dict[str, np.ndarray]:
        p, (h, *kept) = self.forward(x, mask, keep=True)
        d = ((p - truth) * mask / mask.sum()).astype(np.float32)
        grad = {"out": np.einsum("nt,nth->h", d, h), "bias": d.sum(keepdims=True).ravel()[:1]}
        dx = np.zeros_like(x)
        for k, side in enumerate("fb"):
            dout = d[:, :, None] * self.w["out"][k * HIDDEN : (k + 1) * HIDDEN]
            wx, wh = self.w[f"x{side}"], self.w[f"h{side}"]
            gx, gh, gc = np.zeros_like(wx), np.zeros_like(wh), np.zeros_like(self.w[f"c{side}"])
            dh, dc = np.zeros((len(x), HIDDEN), np.float32), np.zeros((len(x), HIDDEN), np.float32)
            for t, f, i, o, g, c, th, before, m in reversed(kept[k]):
                dh = dh + dout[:, t]
                dn, cn = dh * m, dc * m
                cn = cn + dn * o * (1 - th * th)
                gates = np.concatenate([cn * c * f * (1 - f), cn * g * i * (1 - i), dn * th * o * (1 - o), cn * i * (1 - g * g)], axis=1)
                gx += x[:, t].T @ gates
                gh += before.T @ gates
                gc += gates.sum(0)
                dx[:, t] += gates @ wx.T
                dh, dc = dh * (1 - m) + gates @ wh.T, dc * (1 - m) + cn * f
            grad |= {f"x{side}": gx, f"h{side}": gh, f"c{side}": gc}
        flat = dx.reshape(-1, INPUT)
        for name, low, dim in (("path", 0, PATH_DIM), ("word", PATH_DIM, WORD_DIM)):
            owner, token, weight = cells[name]
            grad[name] = np.zeros_like(self.w[name])
            np.add.at(grad[name], token, flat[owner, low : low + dim] * weight[:, None].astype(np.float32))
        return grad

    def __call__(self, pages: list[tuple]) -> list[np.ndarray]:
        """Chance of being article text for every block of every page; similar lengths run together."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i][2])) if len(pages[i][2])]
        first = 0
        while first < len(order):
            last = first + 1
            while last < len(order) and last - first < 256 and len(pages[order[last]][2]) <= 1.25 * len(pages[order[first]][2]) + 4:
                last += 1
            mine = order[first:last]
            x, mask, _ = self.pad([pages[i] for i in mine])
            p, _ = self.forward(x, mask)
            for i, row in zip(mine, p, strict=True):
                out[i] = row[: len(pages[i][2])]
            first = last
        return out


@cache
def train(seed: int = 7) -> Labeller:
    """Fit to pages of the grammar by Adam; the vectors of tokens decay, so unknown names weigh little."""
    grammar, model = _Grammar(seed), Labeller(seed)
    pages = [labelled(grammar.page()) for _ in range(PAGES)]
    data = [(inputs(found), truth) for found, truth in pages if found]
    m, v, step, pick = {}, {}, 0, random.Random(seed)
    for epoch in range(EPOCHS):
        pick.shuffle(data)
        ordered = sorted(range(len(data)), key=lambda i: len(data[i][1]) + pick.random() * 8)
        lots = [ordered[i : i + BATCH] for i in range(0, len(ordered), BATCH)]
        pick.shuffle(lots)
        for lot in lots:
            x, mask, cells = model.pad([data[i][0] for i in lot])
            truth = np.zeros(mask.shape, np.float32)
            for row, i in enumerate(lot):
                truth[row, : len(data[i][1])] = data[i][1]
            step += 1
            rate = 0.02 * (1 - epoch / EPOCHS) + 0.002
            for k, g in model.gradient(x, mask, cells, truth).items():
                g = g + (1e-5 * model.w[k] if k in ("path", "word") else 0)
                m[k], v[k] = 0.9 * m.get(k, 0) + 0.1 * g, 0.99 * v.get(k, 0) + 0.01 * g * g
                model.w[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return model


def main_texts(pages: list[str], model: Labeller) -> list[str]:
    found = [blocks(p) for p in pages]
    chances = model([inputs(b) if b else ([], [], np.zeros((0, DENSE), np.float32)) for b in found])
    return ["\n\n".join(b.text for b, p in zip(page, chance, strict=True) if p >= 0.5) for page, chance in zip(found, chances, strict=True)]


def extract(pages: DataFrame, model: Labeller | None = None, html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row."""
    ship(pages.sparkSession)
    model = model or train()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = [x or "" for x in batch.column("html").to_pylist()]
            first = 0
            while first < len(html):
                last, size = first + 1, len(html[first])
                while last < len(html) and size + len(html[last]) <= AT_ONCE:
                    size += len(html[last])
                    last += 1
                texts = main_texts(html[first:last], model)
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
                first = last

    rows = pages.select("page_id", "url", F.col(html_col).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(read, f"page_id {kind}, url string, text string, n_chars long")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
