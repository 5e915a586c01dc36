"""Main text of web pages by a recurrent block labeller (operator 7).

A page is cut into leaf blocks: runs of text between block-level tags. Each
block becomes a vector: its tag path (tags, classes and ids of the open
elements, hashed), its words (hashed), and a few figures (length, share of
linked text, punctuation, place in the page). A bidirectional LSTM written in
numpy reads the page's whole sequence in both directions and classifies each
block as main text or not; the blocks of main text are joined.

Training: at most ``max_pages`` pages, those smallest by a hash of their id.
There are no labelled pages, so a teacher that knows what the names of tags
and classes mean labels their blocks; each page is also used in altered form,
with furniture of other templates (headers, sidebars, notices, forms, reader
comments, other containers) filled with texts of the sample, so that words
alone decide nothing. The labeller learns from both.

Text rules: scripts, styles, comments and markup never become text; character
references are decoded; white space inside a block is one space, a line break
tag counts as white space; nothing else is dropped or cut.

Defined results: a null or empty page has the empty text; a page without tags
is one block and judged like any other; repeated rows give the same text.
"""

from __future__ import annotations

import html as _html
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .neardup import word_hashes

MAX_PAGES = 240
HIDDEN = 16
EPOCHS = 8
STRETCH = 400  # blocks of one training example
PATH_DIM, WORD_DIM, NUM_DIM = 96, 32, 8
DIM = PATH_DIM + WORD_DIM + NUM_DIM
SEED = 5

# HTML's element categories.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe svg".split())
BLOCK = set(("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption "
             "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre "
             "section select summary table tbody td textarea tfoot th thead title tr ul").split())
# What the teacher takes for furniture: names of elements, and words of class and id values.
SIDE_TAGS = set("head title nav aside footer form button select option label fieldset legend menu textarea dialog".split())
SIDE_WORDS = set(("ad ads adv advert advertisement banner promo sponsor sponsored cookie cookies consent notice notices gdpr alert "
                  "menu nav navbar navigation breadcrumb breadcrumbs sidebar side widget related recommended popular share "
                  "sharing social comment comments reply replies disqus respond footer foot header masthead topbar toolbar login "
                  "signup search subscribe newsletter popup modal overlay pagination pager tags copyright legal disclaimer").split())

_OPEN = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
_CLOSING = {"<!--": "-->", "<![CDATA[": "]]>"}
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
_STEP = re.compile("[>=]")
_QUOTE = re.compile(r"\s*([\"'])")
_NAME = re.compile(r"\b(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z0-9]+")


def tag_end(page: str, at: int) -> int:
    """The place after the ``>`` that closes a tag, seen from behind its name; -1 if the page ends before.

    A quote opens a value only straight after ``=``. Goes forward once.
    """
    while m := _STEP.search(page, at):
        at = m.end()
        if m[0] == ">":
            return at
        if q := _QUOTE.match(page, at):
            at = page.find(q[1], q.end()) + 1
            if not at:
                return -1
    return -1


def blocks(page: str | None) -> list[tuple[tuple, str, int]]:
    """``(path, text, linked)`` of every leaf block: open elements as ``(tag, names)``, text, code points inside links."""
    out: list[tuple[tuple, str, int]] = []
    if not page:
        return out
    stack: list[tuple[str, tuple]] = []
    parts: list[str] = []
    linked, in_link = 0, 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((tuple(stack), text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def say(raw: str):
        nonlocal linked
        if raw:
            t = _html.unescape(raw) if "&" in raw else raw
            parts.append(t)
            if in_link:
                linked += len(t)

    at = 0
    while m := _OPEN.search(page, at):
        if m.start() > at:
            say(page[at:m.start()])
        tag = m[2]
        if tag is None:
            end = page.find(closing := _CLOSING.get(m[0], ">"), m.end())
            if m[0] == "<![CDATA[":
                say(page[m.end():end if end >= 0 else len(page)])
            at = end + len(closing) if end >= 0 else len(page)
            continue
        at = tag_end(page, m.end())
        if at < 0:  # the page ends inside a tag
            at = len(page)
            break
        tag, rest = tag.lower(), page[m.end():at - 1]
        if m[1]:
            if tag == "a":
                in_link = 0
            elif tag in BLOCK:
                flush()
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
            continue
        if tag in RAW:
            if not rest.endswith("/"):
                end = _RAW_END[tag].search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = 1
        elif tag in BLOCK:
            flush()
            if tag in VOID:
                continue
            while stack and (stack[-1][0] == "p" or stack[-1][0] == tag and tag in ("li", "option", "dt", "dd", "tr", "td", "th")):
                stack.pop()
            names = ()
            if rest:
                names = tuple(w for x in _NAME.findall(rest) for w in _WORD.findall((x[0] or x[1] or x[2]).lower()))
            stack.append((tag, names))
            in_link = 0
    say(page[at:])
    flush()
    return out


def teach(path: tuple) -> int:
    """The teacher's label of a block: 1 unless an open element is furniture by its tag or its names."""
    inside = any(tag in ("article", "main") for tag, _ in path)
    for tag, names in path:
        if tag in SIDE_TAGS or (tag == "header" and not inside) or not SIDE_WORDS.isdisjoint(names):
            return 0
    return 1


_paths: dict[tuple, np.ndarray] = {}


def path_vector(path: tuple) -> np.ndarray:
    """Hashed bag of the open elements; the innermost three count once more with their tags joined."""
    v = _paths.get(path)
    if v is None:
        v = np.zeros(PATH_DIM, np.float32)
        words = [f"<{tag}" for tag, _ in path] + [f".{w}" for _, names in path for w in names]
        words.append("/".join(tag for tag, _ in path[-3:]))
        for w in words:
            for salt in ("1", "2"):
                h = zlib.crc32((salt + w).encode("utf-8", "surrogatepass"))
                v[h % PATH_DIM] += 1 if h & 0x10000 else -1
        if len(_paths) < 50_000:
            _paths[path] = v
    return v


def vectors(pages: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """Block vectors of all pages one after another, and the number of blocks of each."""
    sizes = np.array([len(p) for p in pages], np.int64)
    flat = [b for p in pages for b in p]
    x = np.zeros((len(flat), DIM), np.float32)
    if not flat:
        return x, sizes
    x[:, :PATH_DIM] = [path_vector(b[0]) for b in flat]
    raws = [b[1].encode("utf-8", "surrogatepass").lower() for b in flat]
    edges = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raws])))
    words, starts = word_hashes(np.frombuffer(b"\n".join(raws), np.uint8))
    of = np.searchsorted(edges, starts, "right") - 1
    bag = np.bincount(of * WORD_DIM + (words >> np.uint64(59)).astype(np.int64), minlength=len(flat) * WORD_DIM)
    bag = np.log1p(bag[:len(flat) * WORD_DIM].reshape(-1, WORD_DIM))
    n_words = np.bincount(of, minlength=len(flat))[:len(flat)]
    x[:, PATH_DIM:PATH_DIM + WORD_DIM] = 0.3 * bag
    length = np.array([len(b[1]) for b in flat], np.float64)
    stops = np.array([b[1].count(".") + b[1].count(",") for b in flat], np.float64)
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    place = (np.arange(len(flat)) - np.repeat(first, sizes)) / np.maximum(1, np.repeat(sizes, sizes) - 1)
    depth = np.array([len(b[0]) for b in flat], np.float64)
    num = [np.log1p(length) / 5, np.log1p(n_words) / 4, np.array([b[2] for b in flat]) / length, np.minimum(1, 10 * stops / length),
           place, 1 - place, depth / 10, np.ones(len(flat))]
    x[:, PATH_DIM + WORD_DIM:] = np.stack(num, 1)
    return x, sizes


class Labeller:
    """Bidirectional LSTM with a logistic output for every step, in numpy."""

    def __init__(self, dim: int = DIM, hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {}
        for d in "fb":
            self.p["wx" + d] = rng.normal(0, 1 / np.sqrt(dim), (dim, 4 * hidden))
            self.p["wh" + d] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
            self.p["b" + d] = np.concatenate((np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)))
        self.p["wo"] = rng.normal(0, 1 / np.sqrt(2 * hidden), 2 * hidden)
        self.p["bo"] = np.zeros(1)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    @staticmethod
    def _index(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the flat array by (page, step), forwards and backwards, and the mask of real steps."""
        steps = np.arange(int(sizes.max()))
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        real = steps[None] < sizes[:, None]
        ahead = np.where(real, first[:, None] + steps, 0)
        back = np.where(real, first[:, None] + sizes[:, None] - 1 - steps, 0)
        return ahead, back, real

    def _run(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states (page, step, hidden) of one direction; with ``keep`` also what the gradient needs."""
        n, steps, _ = x.shape
        k = self.hidden
        wh = self.p["wh" + d]
        h, c = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
        out = np.empty((n, steps, k), np.float32)
        saved = []
        for t in range(steps):
            z = x[:, t] + h @ wh
            s = 1 / (1 + np.exp(-np.clip(z[:, :3 * k], -30, 30)))
            g = np.tanh(z[:, 3 * k:])
            c2 = s[:, k:2 * k] * c + s[:, :k] * g
            tc = np.tanh(c2)
            if keep:
                saved.append((h, c, s, g, tc))
            h, c = s[:, 2 * k:] * tc, c2
            out[:, t] = h
        return out, saved

    def logits(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """One logit per block of the flat array; pages of like length go through together."""
        out = np.zeros(len(x), np.float32)
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] > 0]
        xf, xb = x @ self.p["wxf"] + self.p["bf"], x @ self.p["wxb"] + self.p["bb"]
        lo = 0
        while lo < len(order):
            hi = min(len(order), lo + 256)
            while hi - lo > 1 and (hi - lo) * sizes[order[hi - 1]] > 20_000:
                hi = lo + (hi - lo) // 2
            at = order[lo:hi]
            steps = np.arange(int(sizes[at].max()))
            real = steps[None] < sizes[at][:, None]
            ahead = np.where(real, first[at][:, None] + steps, 0)
            back = np.where(real, (first[at] + sizes[at] - 1)[:, None] - steps, 0)
            k = self.hidden
            part = self._run(xf[ahead], "f", False)[0] @ self.p["wo"][:k]
            out[ahead[real]] = part[real] + self.p["bo"]
            part = self._run(xb[back], "b", False)[0] @ self.p["wo"][k:]
            out[back[real]] += part[real]
            lo = hi
        return out

    def gradients(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean logistic loss of a batch and the gradient of every parameter (back-propagation through time)."""
        k, p = self.hidden, self.p
        ahead, back, real = self._index(sizes)
        states, grads = {}, {}
        z = np.full(len(x), p["bo"][0], np.float32)
        for d, at, w in (("f", ahead, p["wo"][:k]), ("b", back, p["wo"][k:])):
            states[d] = self._run((x @ p["wx" + d] + p["b" + d])[at], d, True)
            z[at[real]] += (states[d][0] @ w)[real]
        q = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        loss = -float(np.mean(np.log(np.where(y == 1, q, 1 - q) + 1e-9)))
        dz = ((q - y) / len(x)).astype(np.float32)
        grads["bo"] = np.array([dz.sum()], np.float32)
        wo = []
        for d, at, w in (("f", ahead, p["wo"][:k]), ("b", back, p["wo"][k:])):
            hs, saved = states[d]
            dzs = np.where(real, dz[at], 0)
            wo.append(np.einsum("nt,ntk->k", dzs, hs))
            dh = np.zeros((len(sizes), k), np.float32)
            dc = np.zeros((len(sizes), k), np.float32)
            wh, dwh = p["wh" + d], np.zeros_like(p["wh" + d])
            dpre = np.zeros((len(sizes), hs.shape[1], 4 * k), np.float32)
            for t in range(hs.shape[1] - 1, -1, -1):
                h, c, s, g, tc = saved[t]
                dh = dh + dzs[:, t, None] * w
                i, f, o = s[:, :k], s[:, k:2 * k], s[:, 2 * k:]
                dc = dc + dh * o * (1 - tc * tc)
                da = np.concatenate((dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)), 1)
                dwh += h.T @ da
                dpre[:, t] = da
                dh, dc = da @ wh.T, dc * f
            flat = dpre[real]
            grads["wh" + d] = dwh
            grads["wx" + d] = x[at[real]].T @ flat
            grads["b" + d] = flat.sum(0)
        grads["wo"] = np.concatenate(wo)
        return loss, grads

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = 0.01, size: int = 24,
            seed: int = SEED) -> float:
        """Adam over batches of pages ``(vectors, labels)``; the last epoch's mean loss."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, mean = 0, 0.0
        for _ in range(epochs):
            losses = []
            order = rng.permutation(len(pages))
            for lo in range(0, len(order), size):
                part = [pages[i] for i in order[lo:lo + size]]
                sizes = np.array([len(a) for a, _ in part])
                loss, grads = self.gradients(np.concatenate([a for a, _ in part]), sizes, np.concatenate([b for _, b in part]))
                losses.append(loss)
                step += 1
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                for k, g in grads.items():
                    g = g * min(1.0, 1.0 / (norm + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
            mean = float(np.mean(losses))
        return mean


def altered(page: list, others: list, rng) -> list[tuple[tuple, str, int]]:
    """The page with another template: its own containers renamed, furniture of other kinds around and inside it."""
    pick = lambda seq: seq[int(rng.integers(len(seq)))]
    root = pick([(("html", ()), ("body", ())), (("html", ()), ("body", ()), ("div", ("page",))),
                 (("html", ()), ("body", ()), ("div", ("wrapper",)), ("div", ("container",)))])
    main = pick([(("article", ()),), (("main", ()),), (("main", ()), ("article", ())), (("div", ("content",)),),
                 (("div", ("post", "body")),), (("section", ("entry", "content")),), (("div", ("article", "text")),),
                 (("article", ("post",)), ("section", ()))])
    furniture = [(("header", ()),), (("header", ()), ("nav", ()), ("ul", ()), ("li", ())), (("div", ("header",)),),
                 (("aside", ()),), (("aside", ("sidebar",)),), (("div", ("sidebar",)), ("ul", ()), ("li", ())),
                 (("div", ("cookie", "notice")),), (("div", ("notice",)),), (("div", ("alert", "banner")),), (("form", ()),),
                 (("form", ()), ("label", ())), (("form", ("search",)), ("button", ())), (("section", ("comments",)), ("div", ("comment",))),
                 (("section", ("comments",)), ("article", ("comment",)), ("p", ())), (("ol", ("comments",)), ("li", ())),
                 (("div", ("comments",)), ("p", ())), (("div", ("ad",)),), (("div", ("advert",)),), (("div", ("sponsored",)),),
                 (("div", ("related",)), ("ul", ()), ("li", ())), (("footer", ()),), (("div", ("footer",)), ("p", ())),
                 (("nav", ()), ("ul", ()), ("li", ())), (("div", ("share", "social")),), (("div", ("newsletter",)), ("form", ()))]

    def extra(inside: tuple) -> list:
        f = pick(furniture)
        n = int(rng.integers(1, 6))
        return [(root + inside + f, pick(others)[: int(rng.integers(3, 400))].strip() or "x", 0 if rng.random() < 0.6 else 3) for _ in range(n)]

    tags = set(t for t, _ in main)
    body = []
    for path, text, linked in page:
        if teach(path):
            tail = tuple(e for e in path if e[0] not in ("html", "body", "article", "main", "head") and e[0] not in tags)[-2:]
            body.append((root + main + tail, text, linked))
    out: list = []
    for _ in range(int(rng.integers(1, 5))):
        out += extra(())
    for b in body:
        out.append(b)
        if rng.random() < 0.05:
            out += extra(main)
    for _ in range(int(rng.integers(1, 5))):
        out += extra(())
    return out


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", max_pages: int = MAX_PAGES) -> Labeller:
    """A labeller fitted on ``max_pages`` pages (the bound of what comes to the driver) and their altered forms."""
    order = [F.xxhash64(F.lit("pages"), F.col(id_col).cast("string")), F.col(id_col)]
    ids = pages.where(F.length(html_col) > 0).select(id_col).orderBy(*order).limit(max_pages)  # narrow: no page leaves its task
    sample = pages.where(F.length(html_col) > 0).select(id_col, html_col).join(ids.distinct(), id_col, "left_semi")
    rows = sample.orderBy(id_col, F.xxhash64(html_col)).limit(2 * max_pages).collect()
    return fit_pages([blocks(r[1]) for r in rows])


def fit_pages(cut: list, seed: int = SEED) -> Labeller:
    """A labeller from pages cut into blocks."""
    model = Labeller()
    cut = [p for p in cut if p]
    if not cut:
        return model
    rng = np.random.default_rng(seed)
    others = [b[1] for p in cut for b in p]
    examples = []
    for p in cut + [altered(p, others, rng) for p in cut for _ in range(2)]:
        x, _ = vectors([p])
        y = np.array([teach(b[0]) for b in p], np.float32)
        # a long page is learned in stretches, each with its place in the whole page
        examples += [(x[lo:lo + STRETCH], y[lo:lo + STRETCH]) for lo in range(0, len(p), STRETCH)]
    model.fit(examples)
    return model


def extract(pages: DataFrame, model: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; the model's few thousand numbers are broadcast."""
    sent = pages.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for b in small_batches(batches, rows=512, max_bytes=4 << 20):
            cut = [blocks(h.as_py()) for h in b.column(2)]
            x, sizes = vectors(cut)
            keep = sent.value.logits(x, sizes) > 0
            texts, at = [], 0
            for p in cut:
                texts.append("\n".join(t[1] for t, k in zip(p, keep[at:at + len(p)]) if k))
                at += len(p)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
