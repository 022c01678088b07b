"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, with the path
of open elements above them.  A bidirectional LSTM in numpy reads, for every block of
the whole page, a hashed vector of its tag path (tags, classes, ids), a hashed vector
of its words and a few numbers, and labels each block in the light of all others.

No labels come with pages, so the labeller is trained here: on at most ``sample_pages``
whole pages (a documented bound, chosen by a hash of id and url) whose blocks are labelled by
what their markup says.  Where no element is an article, the main text is taken to be in the
deepest element that holds most of the page's unlinked text (``dense``).  Boilerplate blocks of
many kinds are put in, articles are renamed on every third page, and part of each path is
hidden, so that words, links and neighbours have to carry the decision.

Scripts, styles and comments in the markup hold no text; character references are
decoded; white space inside a block is one space; blocks are joined by one newline.

Defined results: a null or empty page has empty text; text outside any element is a
block; tags left open end with the page; equal pages give equal rows; with no page to
learn from (an empty table) nothing is labelled.
"""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[a-zA-Z/!?][^<>\"']*(?:\"[^\"]*\"[^<>\"']*|'[^']*'[^<>\"']*)*(?:>|\Z)|<[a-zA-Z/!?][^>]*(?:>|\Z)|[^<]+|<", re.S)
NAME = re.compile(r"</?\s*([a-zA-Z][a-zA-Z0-9:-]*)")
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: HTML's void elements, elements whose content is not text, and block-level elements (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg iframe textarea".split())
INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: What markup calls things that are not the article (fixed values).
OUTSIDE = frozenset("nav header footer aside form menu button select title head figcaption dialog".split())
SAYS_OUTSIDE = re.compile(r"(?:^|[-_\s])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side|menu|nav\w*|footer|header|comments?|replies|"
                          r"reply|disqus|notice|cookie\w*|consent|popup|modal|newsletter|subscribe|share|social|related|breadcrumbs?|"
                          r"widget|toolbar|login|search|copyright|legal)(?:$|[-_\s])", re.I)
INSIDE = frozenset(("article", "main"))
PATH_SIZE, WORD_SIZE, HIDDEN = 96, 64, 16
SIZE = PATH_SIZE + WORD_SIZE + 5
#: Paths of what training puts in: (path, words it likes to hold).
#: What training calls an article instead, on every third page.
RENAMED = ["div.content", "div#content", "div", "div.post-body", "section", "div.entry", "div.text", "td", "div.story"]
PUT_IN = [("body", "aside"), ("body", "div.sidebar"), ("body", "header"), ("body", "div#header"), ("body", "footer"), ("body", "form"),
          ("body", "div.notice"), ("body", "div.cookie-notice"), ("body", "div.ad"), ("body", "div.advert"), ("body", "nav", "ul", "li", "a"),
          ("body", "div.menu", "ul", "li", "a"), ("body", "section.comments", "div.comment", "p"), ("body", "div#comments", "p"),
          ("body", "article", "aside"), ("body", "article", "div.ad"), ("body", "article", "section.comments", "p"),
          ("body", "article", "div.share", "a"), ("body", "article", "form", "label"), ("body", "main", "aside", "p"),
          ("body", "div.related", "ul", "li", "a"), ("body", "article", "div.comments", "div.comment", "p"), ("body", "article", "header"),
          ("body", "article", "footer"), ("body", "article", "div.notice", "p"), ("body", "article", "nav", "ul", "li", "a")]


def blocks(page) -> list[tuple[tuple[str, ...], str, float]]:
    """(path, text, share of linked text) of each leaf block that holds text."""
    out: list = []
    if not isinstance(page, str) or not page:
        return out
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked = 0
    path: tuple | None = None

    def end() -> None:
        nonlocal parts, linked, path
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((path, text, min(1.0, linked / len(text))))
        parts, linked, path = [], 0, None

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.match(page, at)
        token = m.group()
        at = m.end()
        if token[0] != "<" or token == "<":
            if path is None and not token.isspace():
                path = tuple(x[1] for x in stack)
            parts.append(token)
            if any(x[0] == "a" for x in stack):
                linked += len(token)
            continue
        if token[1] in "!?":
            continue
        name = NAME.match(token)
        if not name:
            continue
        tag = name.group(1).lower()
        if token[1] == "/":
            if tag not in INLINE:
                end()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if tag in INLINE and stack[i][0] not in INLINE:
                    break
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else n
            continue
        if tag not in INLINE:
            end()
            if tag in CLOSES_P:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        del stack[i:]
                        break
                    if stack[i][0] not in INLINE:
                        break
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in SAME.get(tag, ()):
                    del stack[i:]
                    break
                if stack[i][0] not in INLINE:
                    break
        if tag in VOID or token.endswith("/>"):
            continue
        says = "".join(("#" if a[0].lower() == "id" else ".") + (a[1] or a[2] or a[3]) for a in ATTRIBUTE.findall(token))
        stack.append((tag, tag + says))
    end()
    return out


def taught(path: tuple[str, ...]) -> bool | None:
    """What the markup says of a block: main text, not, or nothing."""
    inside = False
    for step in path:
        tag = re.match(r"[^.#]*", step).group()
        if tag in OUTSIDE or SAYS_OUTSIDE.search(re.sub(r"[.#]", " ", step[len(tag):])):
            return False
        inside |= tag in INSIDE
    return True if inside else None


def _slot(kind: str, text: str, size: int, seen: dict) -> int:
    key = (kind, text)
    found = seen.get(key)
    if found is None:
        if len(seen) > 1 << 18:
            seen.clear()
        found = seen[key] = zlib.crc32(f"{kind}:{text}".encode("utf-8", "replace")) % size
    return found


def features(page: list, seen: dict, hide: np.random.Generator | None = None) -> np.ndarray:
    """(blocks, SIZE): hashed paths, hashed words, numbers."""
    x = np.zeros((len(page), SIZE), np.float32)
    for i, (path, text, linked) in enumerate(page):
        steps = [s for s in path if hide is None or hide.random() > 0.15]
        for s in steps:
            tag, *says = re.split(r"[.#\s]+", s.lower())
            x[i, _slot("tag", tag, PATH_SIZE, seen)] = 1
            for word in says:
                for w in re.split(r"[-_]+", word):
                    x[i, _slot("says", w, PATH_SIZE, seen)] = 1
        words = text.split()
        at = [_slot("word", w, WORD_SIZE, seen) for w in words]
        x[i, PATH_SIZE:PATH_SIZE + WORD_SIZE] = np.bincount(at, minlength=WORD_SIZE) / (len(at) + 3)
        x[i, -5:] = (min(1.0, len(words) / 50), linked, sum(c in text for c in ".!?;") / 4, len(path) / 10, float(text[-1:] in ".!?"))
    return x


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with one output per block."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {f"{k}{d}": (r.standard_normal(s) * 0.1).astype(np.float32)
                  for d in "fb" for k, s in (("x", (SIZE, 4 * HIDDEN)), ("h", (HIDDEN, 4 * HIDDEN)), ("c", (4 * HIDDEN,)))}
        for d in "fb":
            self.p["c" + d][HIDDEN:2 * HIDDEN] = 1
        self.p["o"] = (r.standard_normal(2 * HIDDEN + SIZE) * 0.05).astype(np.float32)
        self.p["ob"] = np.zeros(1, np.float32)

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray, keep: list | None):
        """States of one direction, (pages, steps, HIDDEN); padded steps carry the state on."""
        n, steps, _ = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((n, steps, HIDDEN), np.float32)
        pre = x @ self.p["x" + d] + self.p["c" + d]
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g = pre[:, t] + h @ self.p["h" + d]
            i, f, o = (sigmoid(g[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            u = np.tanh(g[:, 3 * HIDDEN:])
            m = mask[:, t:t + 1]
            c2 = f * c + i * u
            tc = np.tanh(c2)
            if keep is not None:
                keep.append((t, h, c, i, f, o, u, c2, tc, m))
            c = m * c2 + (1 - m) * c
            h = m * (o * tc) + (1 - m) * h
            out[:, t] = h
        return out

    def logits(self, x, mask, keep=None):
        kf, kb = ([], []) if keep is not None else (None, None)
        z = np.concatenate([self._run("f", x, mask, kf), self._run("b", x, mask, kb), x], axis=2)
        if keep is not None:
            keep += [kf, kb, z]
        return z @ self.p["o"] + self.p["ob"]

    def gradients(self, x, mask, y, weight):
        keep: list = []
        d = (sigmoid(self.logits(x, mask, keep)) - y) * weight
        d /= max(weight.sum(), 1)
        kf, kb, z = keep
        g = {"o": np.einsum("nt,ntk->k", d, z), "ob": np.array([d.sum()])}
        dz = d[:, :, None] * self.p["o"]
        for name, steps, part in (("f", kf, dz[:, :, :HIDDEN]), ("b", kb, dz[:, :, HIDDEN:2 * HIDDEN])):
            gx, gh, gc = (np.zeros_like(self.p[k + name]) for k in "xhc")
            dh, dc = np.zeros((len(x), HIDDEN), np.float32), np.zeros((len(x), HIDDEN), np.float32)
            for t, h, c, i, f, o, u, c2, tc, m in reversed(steps):
                dh = dh + part[:, t]
                on_h, on_c = m * dh, m * dc
                dc2 = on_c + on_h * o * (1 - tc ** 2)
                dg = np.concatenate([dc2 * u * i * (1 - i), dc2 * c * f * (1 - f), on_h * tc * o * (1 - o), dc2 * i * (1 - u ** 2)], axis=1)
                gx += x[:, t].T @ dg
                gh += h.T @ dg
                gc += dg.sum(axis=0)
                dh = (1 - m) * dh + dg @ self.p["h" + name].T
                dc = (1 - m) * dc + dc2 * f
            g["x" + name], g["h" + name], g["c" + name] = gx, gh, gc
        return g

    def train(self, pages: list[tuple[np.ndarray, np.ndarray, np.ndarray]], epochs: int = 12, rate: float = 0.02) -> None:
        """Adam over batches of pages of like length."""
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(p) for k, p in self.p.items()}
        pages = sorted(pages, key=lambda p: len(p[0]))
        batches: list[list] = []
        for p in pages:  # 16 pages to a batch, fewer where they are long
            if not batches or len(batches[-1]) * max(len(p[0]), 60) >= 16 * 60:
                batches.append([])
            batches[-1].append(p)
        order, step = np.random.default_rng(11), 0
        for _ in range(epochs):
            for k in order.permutation(len(batches)):
                x, mask = padded([p[0] for p in batches[k]])
                y, w = (padded([p[j][:, None] for p in batches[k]])[0][:, :, 0] for j in (1, 2))
                step += 1
                for name, g in self.gradients(x, mask, y, w * mask).items():
                    m[name] = 0.9 * m[name] + 0.1 * g
                    v[name] = 0.99 * v[name] + 0.01 * g ** 2
                    self.p[name] = (self.p[name] - rate * (m[name] / (1 - 0.9 ** step)) / (np.sqrt(v[name] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)

    def label(self, pages: list[np.ndarray], at_once: int = 64) -> list[np.ndarray]:
        """Whether each block is main text."""
        out: list = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        for s in range(0, len(order), at_once):
            part = order[s:s + at_once]
            x, mask = padded([pages[i] for i in part])
            for i, row in zip(part, self.logits(x, mask)):
                out[i] = row[:len(pages[i])] > 0
        return out


def padded(xs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, xs))
    x = np.zeros((len(xs), steps, xs[0].shape[1]), np.float32)
    mask = np.zeros((len(xs), steps), np.float32)
    for i, a in enumerate(xs):
        x[i, :len(a)], mask[i, :len(a)] = a, 1
    return x, mask


def dense(page: list) -> list[bool | None]:
    """What text and links say of the blocks of a page without an article: from the root
    down, the element that holds 0.6 or more of the unlinked words.  Its blocks are main
    text, those of links are not, nor what the markup rules out; short blocks outside it
    are not, longer ones remain open."""
    told = [taught(path) for path, _, _ in page]
    words = np.array([0.0 if t is False or linked >= 0.5 else len(text.split()) * (1 - linked) for t, (_, text, linked) in zip(told, page)])
    inside, depth = np.ones(len(page), bool), 0
    while words.sum():
        mass: dict[str, float] = {}
        for i in np.flatnonzero(inside):
            if len(page[i][0]) > depth + 1:  # its own element is no container
                mass[page[i][0][depth]] = mass.get(page[i][0][depth], 0.0) + words[i]
        best = max(sorted(mass), key=mass.get, default=None)
        if best is None or mass[best] < 0.6 * words.sum():
            break
        inside &= np.array([len(path) > depth + 1 and path[depth] == best for path, _, _ in page])
        depth += 1
    out: list[bool | None] = []
    for t, own, w, (_, text, linked) in zip(told, inside, words, page):
        if t is False or linked >= 0.5:
            out.append(False)
        elif own:
            out.append(bool(w))
        else:
            out.append(False if len(text.split()) < 8 else None)
    return out


def lesson(page: list, r: np.random.Generator, seen: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and weights of one training page, with boilerplate put in."""
    labels = [taught(b[0]) for b in page]
    told = list(zip(page, labels if True in labels else dense(page)))
    if r.integers(3) == 0:
        name = RENAMED[int(r.integers(len(RENAMED)))]
        told = [((tuple(name if re.match(r"[^.#]*", s).group() in INSIDE else s for s in path), text, linked), t) for (path, text, linked), t in told]
    texts = [b[1] for b, _ in told]
    for _ in range(int(r.integers(0, 4))):
        steps = PUT_IN[int(r.integers(len(PUT_IN)))]
        words = texts[int(r.integers(len(texts)))].split()
        own = (tuple(("html", *steps)), " ".join(words[:int(r.integers(1, 40))]), 1.0 if steps[-1] == "a" else 0.0)
        told.insert(int(r.integers(len(told) + 1)), (own, False))
    y = np.array([float(t is True) for _, t in told], np.float32)
    w = np.array([float(t is not None) for _, t in told], np.float32)
    return features([b for b, _ in told], seen, r), y, w


def sample(pages: DataFrame, id_col: str, url_col: str, html_col: str, sample_pages: int) -> list[str]:
    """At most ``sample_pages`` pages, by a hash of id and url; rows that repeat one are one.
    Ids are chosen first, by a threshold from the number of rows, so only about as many
    pages are read out of their files and sent to the driver."""
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    n = src.count()
    if not n:
        return []
    h = F.pmod(F.xxhash64("id", "url"), F.lit(1 << 40))
    picked = src.where(h <= int((1 << 40) * min(1.0, sample_pages / n))).where("length(html) > 0")
    one = picked.groupBy("id", "url").agg(F.min("html").alias("html"))
    return [x["html"] for x in one.orderBy(h, "id", "url").limit(sample_pages).collect()]


def fit(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sample_pages: int = 300,
        epochs: int = 12) -> Labeller | None:
    """A labeller trained on a bounded sample."""
    r, seen = np.random.default_rng(5), {}
    lessons = [lesson(b, r, seen) for b in map(blocks, sample(pages, id_col, url_col, html_col, sample_pages)) if b]
    if not lessons:
        return None
    model = Labeller()
    model.train(lessons, epochs * max(1, min(8, 300 // len(lessons))))
    return model


def _extract(model: Labeller | None):
    def run(batches):
        seen: dict = {}
        for b in batches:
            pages = [blocks(h) for h in b["html"]]
            keep = model.label([features(p, seen) for p in pages]) if model else [[False] * len(p) for p in pages]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"],
                                "text": ["\n".join(x[1] for x, k in zip(p, ks) if k) for p, ks in zip(pages, keep)]})
    return run


def main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", **kw) -> DataFrame:
    """One row per page row: page_id, url and the main text, "" if there is none."""
    ship(pages.sparkSession)
    model = fit(pages, id_col=id_col, url_col=url_col, html_col=html_col, **kw)
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.coalesce(html_col, F.lit("")).alias("html"))
    return src.mapInPandas(_extract(model), "page_id bigint, url string, text string").select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
