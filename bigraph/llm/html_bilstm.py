"""Main-text extraction with a recurrent block labeller.

A page is cut into its leaf blocks (text between block-level tags).  Each block
is a vector: learned embeddings of the hashed tokens of its tag path (tags,
class, id and role words of all ancestors), of its hashed words, and a few
measures.  A bidirectional LSTM reads the page's blocks in order, so every
block is classified in the context of the whole page.

Training needs no labels: pages of a bounded sample (``PAGES`` with the least
id hash) that mark their article (``article`` or ``main``) label their own
blocks.  So that the labeller does not lean on that one mark, most training
copies are recast: the container renamed, menus, sidebars, notices, forms and
comments inserted with text from other pages.  Extraction is one pass over the
pages without a shuffle.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bigraph.llm.common import arrow_map
from bigraph.llm.kernels import CHUNK_BYTES, U64, prefix_hash, span_hash, word_spans

PAGES = 240                 # pages the labeller is trained on
BITS = 12                   # hashed path tokens and words
PATH_DIM, WORD_DIM, HIDDEN = 16, 8, 16
EPOCHS = 10
BATCH_PAGES = 32
KEEP = 0.5

# Fixed values of HTML: elements whose content is not text, elements without
# content, elements that end a block, and what an open tag closes.
SILENT = frozenset("script style template svg math iframe object canvas noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset((
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option "
    "p pre search section select summary table tbody td textarea tfoot th thead title tr ul").split())
ENDS_P = BLOCK - frozenset("body html head title button label option optgroup select textarea".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table article aside section div body td th form nav main".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<([/]?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def path_tokens(tag: str, attributes: str) -> tuple[str, ...]:
    """Tokens of one element: its tag, and the words of class, id and role."""
    out = [tag]
    if attributes and attributes.strip("/ "):
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
            if name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none", value)):
                out.append("hidden")
            elif name != "style":
                out.extend("." + w.lower() for w in _PART.findall(value))
    return tuple(out)


_elements: dict[tuple[str, str], tuple[str, ...]] = {}


def _element(tag: str, attributes: str) -> tuple[str, ...]:
    got = _elements.get((tag, attributes))
    if got is None:
        got = path_tokens(tag, attributes)
        if len(_elements) < 20_000:
            _elements[(tag, attributes)] = got
    return got


def blocks(page: str) -> list[tuple[tuple, str, int]]:
    """Leaf blocks in page order: ``(path, text, characters in links)``, the
    path one token tuple per open element.  Tolerates unclosed and stray
    tags; an element that never ends holds the rest of the page."""
    out: list[tuple[tuple, str, int]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    buffer: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            if text:
                out.append((tuple(t for _, t in stack), text, linked))
            buffer.clear()
            linked = 0

    def close(names, scope):
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                del stack[i:]
                return True
            if stack[i][0] in scope:
                return False
        return False

    at, n = 0, len(page)
    in_link = 0
    for m in iter(lambda: _TAG.search(page, at), None):
        if m.start() > at:
            buffer.append(page[at:m.start()])
            linked += (m.start() - at) if in_link else 0
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            if tag in BLOCK:
                flush()
            if tag == "a":
                in_link = 0
            close((tag,), ())
            continue
        if tag in SILENT:
            if m.group(3).rstrip().endswith("/") and tag in ("svg", "math"):
                continue
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            buffer.append(" ")
            continue
        if tag in BLOCK:
            flush()
            if tag in ENDS_P:
                close(("p",), SCOPE)
            if tag in CLOSES:
                close(CLOSES[tag], frozenset(SCOPE - set(CLOSES[tag])))
        if tag in VOID:
            buffer.append(" ")
            continue
        if tag == "a":
            in_link = 1
        stack.append((tag, _element(tag, m.group(3))))
    if at < n:
        buffer.append(page[at:])
    flush()
    return out


# ------------------------------------------------------------------ features

MEASURES = 6


def _token_id(token: str) -> int:
    return zlib.crc32(token.encode()) & ((1 << BITS) - 1)


def path_ids(path: tuple) -> list[int]:
    """Hashed tokens of a path; the innermost element's tag also by itself,
    and whether an element lies in another is kept as a pair of tags."""
    ids = [_token_id(t) for element in path for t in element]
    if path:
        ids.append(_token_id("in:" + path[-1][0]))
        ids.extend(_token_id(f"{a[0]}>{b[0]}") for a, b in zip(path[-3:], path[-2:]))
    return ids


def featurize(pages: list[list[tuple[tuple, str, int]]], cache: dict | None = None) -> dict:
    """Blocks of several pages as arrays: path token ids and word ids with
    their bounds, measures, blocks per page."""
    cache = {} if cache is None else cache
    flat = [b for p in pages for b in p]
    sizes = np.array([len(p) for p in pages], dtype=np.int64)
    paths = []
    for path, _, _ in flat:
        got = cache.get(path)
        if got is None:
            got = np.array(path_ids(path) or [0], dtype=np.int64)
            if len(cache) < 50_000:
                cache[path] = got
        paths.append(got)
    raw = [text.encode() for _, text, _ in flat]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    bounds = np.append(0, np.cumsum([len(r) for r in raw])).astype(np.int64)
    starts, ends, of = word_spans(data, bounds)
    words = (span_hash(prefix_hash(data), starts, ends) >> U64(64 - BITS)).astype(np.int64)
    count = np.bincount(of, minlength=len(flat))
    length = np.diff(bounds)
    marks = np.array([r.count(b".") + r.count(b",") for r in raw], dtype=float)
    link = np.array([min(x, max(n, 1)) for (_, _, x), n in zip(flat, length)], dtype=float)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    part = place / np.maximum(np.repeat(sizes, sizes) - 1, 1)
    measures = np.stack([np.log1p(length) / 5, np.log1p(count) / 3, marks / np.maximum(count, 1),
                         link / np.maximum(length, 1), part, np.minimum(length / 1000, 1)], axis=1) if flat else np.zeros((0, MEASURES))
    return {"sizes": sizes, "path": np.concatenate(paths) if paths else np.zeros(0, np.int64),
            "path_n": np.array([len(p) for p in paths], dtype=np.int64), "word": words, "word_n": count,
            "measures": measures}


def _bag(ids: np.ndarray, counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Mean embedding of each block's ids (0 without any)."""
    out = np.zeros((len(counts), table.shape[1]))
    some = counts > 0
    if some.any():
        lead = (np.cumsum(counts) - counts)[some]
        out[some] = np.add.reduceat(table[ids], lead, axis=0) / counts[some, None]
    return out


# --------------------------------------------------------------------- model

@dataclass
class Labeller:
    """Embeddings, two LSTM directions (input, recurrent, bias) and the
    output layer."""
    params: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int = 3) -> Labeller:
        r = np.random.default_rng(seed)
        d = PATH_DIM + WORD_DIM + MEASURES
        p = {"path": r.normal(0, 0.1, (1 << BITS, PATH_DIM)), "word": r.normal(0, 0.1, (1 << BITS, WORD_DIM)),
             "out": r.normal(0, 0.1, 2 * HIDDEN), "bias": np.zeros(1)}
        for way in "fb":
            p["x" + way] = r.normal(0, 1 / np.sqrt(d), (d, 4 * HIDDEN))
            p["h" + way] = r.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            p["c" + way] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        return cls(p)

    def inputs(self, f: dict) -> np.ndarray:
        return np.concatenate([_bag(f["path"], f["path_n"], self.params["path"]) * 3,
                               _bag(f["word"], f["word_n"], self.params["word"]), f["measures"]], axis=1)

    def probabilities(self, f: dict) -> np.ndarray:
        """P(main text) of every block."""
        x = self.inputs(f)
        if not len(x):
            return np.zeros(0)
        p = self.params
        hidden = [_lstm(x, f["sizes"], p["x" + w], p["h" + w], p["c" + w], w == "b")[0] for w in "fb"]
        return _sigmoid(np.concatenate(hidden, axis=1) @ p["out"] + p["bias"])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _layout(sizes: np.ndarray, reverse: bool):
    """Time-major places of blocks (pages sorted by length, all stepping
    together) and the number of pages that live at each step."""
    order = np.argsort(-sizes, kind="stable")
    steps = int(sizes.max())
    live = np.searchsorted(-sizes[order], -np.arange(steps), side="left")
    begin = np.append(0, np.cumsum(live))
    rank = np.empty(len(sizes), dtype=np.int64)
    rank[order] = np.arange(len(sizes))
    page = np.repeat(np.arange(len(sizes)), sizes)
    t = np.arange(len(page)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    if reverse:
        t = sizes[page] - 1 - t
    return begin[t] + rank[page], begin, live


def _lstm(x, sizes, wx, wh, b, reverse):
    """Hidden states in block order, and what the backward pass needs."""
    place, begin, live = _layout(sizes, reverse)
    pre = np.empty((len(x), wx.shape[1]))
    pre[place] = x @ wx + b
    n = HIDDEN
    gates, cells, hidden = np.empty_like(pre), np.empty((len(x), n)), np.empty((len(x), n))
    for i in range(len(live)):
        s, k = slice(begin[i], begin[i + 1]), live[i]
        z = pre[s]
        if i:
            z = z + hidden[begin[i - 1]:begin[i - 1] + k] @ wh
        g = np.concatenate([_sigmoid(z[:, :3 * n]), np.tanh(z[:, 3 * n:])], axis=1)
        c = g[:, :n] * g[:, 3 * n:]
        if i:
            c = c + g[:, n:2 * n] * cells[begin[i - 1]:begin[i - 1] + k]
        gates[s], cells[s], hidden[s] = g, c, g[:, 2 * n:3 * n] * np.tanh(c)
    return hidden[place], (place, begin, live, gates, cells, hidden)


def _lstm_back(grad, x, wx, wh, state):
    """Gradients of inputs and weights from those of the hidden states."""
    place, begin, live, gates, cells, hidden = state
    n = HIDDEN
    dh_all = np.empty_like(hidden)
    dh_all[place] = grad
    dz = np.empty_like(gates)
    dwh = np.zeros_like(wh)
    dh_next, dc_next = np.zeros((0, n)), np.zeros((0, n))
    for i in range(len(live) - 1, -1, -1):
        s, k = slice(begin[i], begin[i + 1]), live[i]
        dh, dc = dh_all[s].copy(), np.zeros((k, n))
        dh[:len(dh_next)] += dh_next
        dc[:len(dc_next)] += dc_next
        g, c = gates[s], cells[s]
        th = np.tanh(c)
        dc += dh * g[:, 2 * n:3 * n] * (1 - th * th)
        before = cells[begin[i - 1]:begin[i - 1] + k] if i else np.zeros((k, n))
        d = np.concatenate([dc * g[:, 3 * n:] * g[:, :n] * (1 - g[:, :n]),
                            dc * before * g[:, n:2 * n] * (1 - g[:, n:2 * n]),
                            dh * th * g[:, 2 * n:3 * n] * (1 - g[:, 2 * n:3 * n]),
                            dc * g[:, :n] * (1 - g[:, 3 * n:] ** 2)], axis=1)
        dz[s] = d
        if i:
            dwh += hidden[begin[i - 1]:begin[i - 1] + k].T @ d
            dh_next, dc_next = d @ wh.T, dc * g[:, n:2 * n]
    d = dz[place]
    return d @ wx.T, x.T @ d, dwh, d.sum(axis=0)


def train(pages: list[list[tuple[tuple, str, int]]], labels: list[np.ndarray], epochs: int = EPOCHS,
          rate: float = 0.01, seed: int = 3, recast=None) -> Labeller:
    """Fit the labeller by Adam on cross-entropy, page batches in random
    order; ``recast(page, label, rng)`` may vary a page each time."""
    model, rng = Labeller.fresh(seed), np.random.default_rng(seed)
    p = model.params
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step, cache = 0, {}
    for _ in range(epochs):
        order = rng.permutation(len(pages))
        for at in range(0, len(order), BATCH_PAGES):
            chosen = [recast(pages[i], labels[i], rng) if recast else (pages[i], labels[i])
                      for i in order[at:at + BATCH_PAGES]]
            chosen = [(b, y) for b, y in chosen if b]
            if not chosen:
                continue
            f = featurize([b for b, _ in chosen], cache)
            y = np.concatenate([y for _, y in chosen]).astype(float)
            x = model.inputs(f)
            runs = {w: _lstm(x, f["sizes"], p["x" + w], p["h" + w], p["c" + w], w == "b") for w in "fb"}
            hidden = np.concatenate([runs["f"][0], runs["b"][0]], axis=1)
            err = (_sigmoid(hidden @ p["out"] + p["bias"]) - y) / len(y)
            g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("path", "word")}
            g["out"], g["bias"] = hidden.T @ err, err.sum(keepdims=True)
            back = err[:, None] * p["out"]
            dx = np.zeros_like(x)
            for i, w in enumerate("fb"):
                d, g["x" + w], g["h" + w], g["c" + w] = _lstm_back(
                    back[:, i * HIDDEN:(i + 1) * HIDDEN], x, p["x" + w], p["h" + w], runs[w][1])
                dx += d
            for name, lo, hi, scale in (("path", 0, PATH_DIM, 3.0), ("word", PATH_DIM, PATH_DIM + WORD_DIM, 1.0)):
                n = f[name + "_n"]
                g[name] = np.zeros_like(p[name])
                np.add.at(g[name], f[name], np.repeat(dx[:, lo:hi] * scale / np.maximum(n, 1)[:, None], n, axis=0))
            step += 1
            for k in p:
                first[k] += 0.1 * (g[k] - first[k])
                second[k] += 0.001 * (g[k] * g[k] - second[k])
                p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


# ------------------------------------------------------- weak labels, recasts

ARTICLE = ("article", "main")
NOT_ARTICLE = frozenset("nav footer aside header form button select label".split())
# Names that training copies give to the article's container and to what is
# put around and into it: common class and id words.
CONTAINERS = ("content", "post", "entry", "article", "main", "story", "body", "text", "page content", "post body")
BOILERPLATE = {
    "menu": ("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "tabs", "toolbar", "links", "topbar"),
    "header": ("header", "masthead", "banner", "site header", "logo", "branding", "top"),
    "footer": ("footer", "site footer", "copyright", "bottom", "legal", "colophon"),
    "sidebar": ("sidebar", "side", "widget", "related", "recommended", "more", "popular", "trending", "tags", "toc"),
    "notice": ("notice", "cookie", "consent", "gdpr", "alert", "popup", "modal", "warning", "subscribe", "newsletter",
               "paywall", "message"),
    "advert": ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "banner ad", "adsense"),
    "comments": ("comments", "comment", "reader comments", "discussion", "replies", "reply", "responses", "disqus",
                 "comment list", "comment body"),
    "share": ("share", "social", "follow", "author bio", "byline", "meta", "pagination", "pager"),
    "form": ("form", "search", "login", "signup", "register", "contact", "field", "search box"),
}
NATIVE = {"menu": ("nav", "menu"), "header": ("header",), "footer": ("footer",), "sidebar": ("aside",),
          "form": ("form",), "comments": ("section",), "notice": ("aside", "dialog"), "advert": ("aside",), "share": ("aside",)}


def self_labels(page: list[tuple[tuple, str, int]]) -> np.ndarray | None:
    """Which blocks lie in the page's marked article (None without one)."""
    marked = [any(e[0] in ARTICLE for e in path) for path, _, _ in page]
    if not any(marked):
        return None
    last = lambda path: max(i for i, e in enumerate(path) if e[0] in ARTICLE)
    return np.array([m and not any(e[0] in NOT_ARTICLE or "hidden" in e for e in path[last(path):])
                     for m, (path, _, _) in zip(marked, page)])


def recaster(pool: list[str]):
    """Varies a training page: see the module notes.  Inserted text comes
    from ``pool`` (sentences of the sample's pages)."""
    kinds = sorted(BOILERPLATE)

    def one(rng, options):
        return options[int(rng.integers(len(options)))]

    def named(rng, tag, words):
        mark = one(rng, words)
        return (tag, *("." + w for w in mark.split()))

    def filler(rng, kind):
        """A few blocks of one kind, with the path below their container."""
        tag = one(rng, NATIVE[kind]) if rng.random() < 0.5 else one(rng, ["div", "section", "div", "ul"])
        plain = tag in NATIVE[kind] and tag not in ("section",) and rng.random() < 0.5
        box = (tag,) if plain else named(rng, tag, BOILERPLATE[kind])
        out = []
        for _ in range(int(rng.integers(1, 7))):
            text = pool[int(rng.integers(len(pool)))]
            words = text.split()
            short = kind in ("menu", "share", "form", "header") or rng.random() < 0.4
            text = " ".join(words[:int(rng.integers(1, 5))]) if short else text
            if kind == "menu" or (kind in ("sidebar", "footer", "share") and rng.random() < 0.5):
                inner, linked = (("ul",), ("li",), ("a",)) if rng.random() < 0.7 else (("a",),), len(text)
            elif kind == "form":
                inner, linked = ((one(rng, ["label", "button", "p", "option", "legend"]),),), 0
            else:
                inner, linked = ((one(rng, ["p", "div", "span", "li", "h3", "p"]),),), 0
                if kind == "comments" and rng.random() < 0.5:
                    inner = (named(rng, "div", BOILERPLATE[kind]), *inner)
            out.append(((box, *inner), text, linked))
        return out

    def recast(page, label, rng):
        if rng.random() < 0.25:
            return page, label
        style = rng.random()
        box = named(rng, one(rng, ["div", "section", "div", "td"]), CONTAINERS)
        wrap = [("div", ".wrapper"), ("div", ".container"), ("div",), ("div", ".row")]
        outer = [wrap[i] for i in rng.integers(0, len(wrap), int(rng.integers(0, 3)))]
        cased, inside = [], None
        for (path, text, linked), y in zip(page, label):
            new = []
            for e in path:
                if e[0] in ARTICLE and style > 0.4:
                    new.extend([] if style > 0.9 else [box])
                else:
                    new.append(e)
                if e[0] == "body":
                    new.extend(outer)
            new = tuple(new)
            if y:
                cut = next((i for i, e in enumerate(path) if e[0] in ARTICLE), 0)
                inside = inside or new[:max(1, len(new) - (len(path) - cut - 1))]
            cased.append((new, text, linked, bool(y)))
        body = next((b[0][:2 + len(outer)] for b in cased if len(b[0]) > 1 and b[0][1][0] == "body"), ())
        main = [i for i, b in enumerate(cased) if b[3]]
        if not main:
            return page, label
        for _ in range(int(rng.integers(0, 5))):
            kind = one(rng, kinds)
            within = inside and kind not in ("menu", "header", "footer") and rng.random() < 0.4
            base = inside if within else body
            new = [((*base, *path), text, linked, False) for path, text, linked in filler(rng, kind)]
            if within:
                where = main[-1] + 1 if kind == "comments" or rng.random() < 0.5 else int(rng.choice(main))
            else:
                where = int(rng.choice([main[0], main[-1] + 1, len(cased)]))
            cased[where:where] = new
            main = [i for i, b in enumerate(cased) if b[3]]
        return [(a, b, c) for a, b, c, _ in cased], np.array([d for *_, d in cased])

    return recast


MARKED = r"(?i)<(article|main)[\s>]"     # a page that marks its article, before it is parsed


def fit(pages: DataFrame, key: str = "page_id", html: str = "html", sample: int = PAGES, **settings) -> Labeller | None:
    """A labeller trained on a bounded sample of the pages that mark their
    article; None when no page of the table does."""
    rows = (pages.where(F.col(html).rlike(MARKED)).select(F.xxhash64(key).alias("h"), F.col(html).alias("html"))
            .orderBy("h", "html").limit(sample).toArrow())
    parsed = [blocks(h) for h in rows.column("html").to_pylist()]
    both = [(b, y) for b in parsed if (y := self_labels(b)) is not None]
    if not both:
        return None
    pool = [t for b, _ in both for _, t, _ in b if len(t) < 400] or [both[0][0][0][1]]
    return train([b for b, _ in both], [y for _, y in both], recast=recaster(pool), **settings)


def _extract(model: Labeller | None):
    cache: dict = {}

    def run(batch: pa.RecordBatch):
        sources = batch.column(2)
        at = 0
        while at < batch.num_rows:
            first, size, parsed = at, 0, []
            while at < batch.num_rows and size < CHUNK_BYTES:
                page = sources[at].as_py() or ""
                size += len(page) + 64
                parsed.append(blocks(page))
                at += 1
            flat = [b for p in parsed for b in p]
            if model is None:
                keep = np.array([not any(e[0] == "head" for e in path) for path, _, _ in flat], dtype=bool)
            else:
                f = featurize(parsed, cache)
                live = f["sizes"] > 0
                f["sizes"] = f["sizes"][live]
                keep = model.probabilities(f) >= KEEP
            texts, i = [], 0
            for p in parsed:
                texts.append("\n".join(t for (_, t, _), k in zip(p, keep[i:i + len(p)]) if k))
                i += len(p)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, at - first), batch.column(1).slice(first, at - first),
                 pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([len(p) for p in parsed], pa.int64())], names=["page_id", "url", "text", "n_chars", "n_blocks"])
    return run


def main_text(pages: DataFrame, model: Labeller | None, key: str = "page_id", url: str = "url",
              html: str = "html") -> DataFrame:
    """Per page ``key, url, text, n_chars, n_blocks``: kept blocks in page
    order joined by line feeds, white space inside a block as one space,
    character references decoded.

    Edge cases: NULL html is empty and gives an empty text, as does a page
    without kept blocks.  NULL ids or urls stay, repeated rows are extracted
    each.  Without a labeller (no page marked its article) every block outside
    the head is kept.  Other columns are ignored; an empty table gives no
    rows.
    """
    rows = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    out = arrow_map(rows, _extract(model), "page_id bigint, url string, text string, n_chars bigint, n_blocks bigint")
    return out.withColumnsRenamed({"page_id": key, "url": url})
