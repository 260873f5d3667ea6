"""Main text of pages by a recurrent block labeller.

A page is its sequence of leaf blocks. Each block is a vector: its tag path and its words,
both hashed, and a few numbers. A bidirectional LSTM (numpy) reads the whole sequence in both
directions, so that every block is labelled knowing all of the document. It is trained here on
a bounded sample of the pages: blocks of pages with an article or main element (or one named so)
are labelled by their ancestors, other pages teach nothing, and pages composed from those blocks
add layouts with other containers, among them unnamed ones, headers, sidebars, notices,
adverts, forms and comments. If no page can be labelled so, long unlinked blocks are main text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textscan
from millrace.llm.markup import Block, Path, blocks

SAMPLE_ROWS = 300  # pages that the labeller is trained on, as drawn by hash
SAMPLE_CHARS = 200_000  # longer pages are not trained on
COMPOSED = 3  # composed pages for each
LEAST_CHARS = 60  # of a main block, where nothing is named
PATH, WORD, NUMBERS = 96, 32, 8
HIDDEN = 24
EPOCHS = 14
RATE = 0.01

# Words of class names and roles, and elements, that mark what is not the article.
ASIDE_MARKS = (
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer header login menu modal nav navbar "
    "navigation newsletter notice notification popup promo promoted related replies search share sharing sidebar signup social sponsor sponsored "
    "subscribe toolbar widget"
).split()
ASIDE_TAGS = "nav header footer aside form menu dialog button select textarea label legend fieldset".split()
ARTICLE_MARKS = "article content entry main post story text".split()


@lru_cache(maxsize=20_000)
def _place(word: str) -> tuple[int, float]:
    h = zlib.crc32(word.encode())
    return h % PATH, 1.0 if h >> 31 else -1.0


def _with(vector: np.ndarray, words: list[str]) -> np.ndarray:
    if words:
        vector = vector.copy()
        for at, sign in map(_place, words):
            vector[at] += sign
    return vector


def _path_vectors(blocks: list[Block]) -> list[np.ndarray]:
    """Hashed words of each block's path and its innermost tag; a node of a path is hashed once."""
    outer: dict = {None: np.zeros(PATH, dtype=np.float32)}
    whole: dict = {}
    step = lambda vector, node: _with(vector, [x for x in node.fresh if x not in ("html", "body")])
    out = []
    for b in blocks:
        node = b.path if isinstance(b.path, Path) else Path.of(b.path)
        if node not in whole:
            whole[node] = _with(node.derive(outer, step), [f"last {node.last}"])
        out.append(whole[node])
    return out


def _either(page: list[Block], words: set[str]) -> list[bool]:
    """For each block, whether its path has one of the words."""
    kept: dict = {None: False}
    step = lambda found, node: found or not words.isdisjoint(node.fresh)
    return [(b.path if isinstance(b.path, Path) else Path.of(b.path)).derive(kept, step) for b in page]


def vectors(pages: list[list[Block]]) -> np.ndarray:
    """A row per block of all pages."""
    flat = [b for p in pages for b in p]
    out = np.zeros((len(flat), PATH + WORD + NUMBERS), dtype=np.float32)
    if not flat:
        return out
    words = textscan.scan(pa.array([b.text for b in flat], pa.string()), textscan.ALNUM)
    count = np.diff(words.first)
    owner = words.owner()
    place = (words.hash >> np.uint64(40)).astype(np.int64) % WORD
    bags = np.bincount(owner * WORD + place, minlength=len(flat) * WORD).reshape(len(flat), WORD)
    out[:, PATH : PATH + WORD] = bags / np.sqrt(np.maximum(1, (bags**2).sum(axis=1, keepdims=True)))
    out[:, :PATH] = _path_vectors(flat)
    size = np.array([len(b.text) for b in flat], dtype=np.float32)
    place_in = np.concatenate([np.arange(len(p)) / max(1, len(p) - 1) for p in pages])
    tail = out[:, PATH + WORD :]
    tail[:, 0] = np.log1p(size) / 5
    tail[:, 1] = [b.linked for b in flat]
    tail[:, 2] = np.log1p(count) / 4
    tail[:, 3] = [b.text[-1] in ".!?:\"" for b in flat]
    tail[:, 4] = size / np.maximum(1, count) / 8
    tail[:, 5] = place_in
    tail[:, 6] = size > 120
    tail[:, 7] = [b.text[0].isupper() for b in flat]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _direction(x: np.ndarray, mask: np.ndarray, weights: dict[str, np.ndarray], side: str, keep: list | None = None) -> np.ndarray:
    """Hidden states of one direction; ``x``: time, sequence, input."""
    steps, many, _ = x.shape
    drive = x @ weights[side + "x"] + weights[side + "b"]
    h = c = np.zeros((many, HIDDEN), dtype=x.dtype)
    out = np.zeros((steps, many, HIDDEN), dtype=x.dtype)
    for t in range(steps):
        z = drive[t] + h @ weights[side + "h"]
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        m = mask[t][:, None]
        new = f * c + i * g
        squashed = np.tanh(new)
        if keep is not None:
            keep.append((h, c, i, f, o, g, squashed, m))
        h, c = m * (o * squashed) + (1 - m) * h, m * new + (1 - m) * c
        out[t] = h
    return out


def _direction_back(x: np.ndarray, kept: list, above: np.ndarray, weights: dict[str, np.ndarray], side: str, into: dict[str, np.ndarray]) -> None:
    """Add the gradients of one direction to ``into``."""
    down_h = down_c = np.zeros_like(above[0])
    slopes = np.zeros((*above.shape[:2], 4 * HIDDEN), dtype=above.dtype)
    for t in range(len(kept) - 1, -1, -1):
        h, c, i, f, o, g, squashed, m = kept[t]
        dh = above[t] + down_h
        do = m * dh
        dc = m * down_c + do * o * (1 - squashed**2)
        dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), do * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1)
        slopes[t] = dz
        into[side + "h"] += h.T @ dz
        down_h = dz @ weights[side + "h"].T + (1 - m) * dh
        down_c = dc * f + (1 - m) * down_c
    into[side + "x"] += np.einsum("tbd,tbk->dk", x, slopes, optimize=True)
    into[side + "b"] += slopes.sum(axis=(0, 1))


@dataclass
class Labeller:
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int = 11) -> Labeller:
        rng = np.random.default_rng(seed)
        size = PATH + WORD + NUMBERS
        w = {}
        for side in ("f", "b"):
            w[side + "x"] = rng.normal(0, size**-0.5, (size, 4 * HIDDEN)).astype(np.float32)
            w[side + "h"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            w[side + "b"] = np.zeros(4 * HIDDEN, dtype=np.float32)
            w[side + "b"][HIDDEN : 2 * HIDDEN] = 1.0
        w["o"] = rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32)
        w["ob"] = np.zeros(1, dtype=np.float32)
        return cls(w)

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        ahead = _direction(x, mask, self.weights, "f")
        back = _direction(x[::-1], mask[::-1], self.weights, "b")[::-1]
        return np.concatenate([ahead, back], axis=2) @ self.weights["o"] + self.weights["ob"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy of the blocks and its gradients."""
        w, kf, kb = self.weights, [], []
        ahead = _direction(x, mask, w, "f", kf)
        back = _direction(x[::-1], mask[::-1], w, "b", kb)[::-1]
        both = np.concatenate([ahead, back], axis=2)
        p = _sigmoid(both @ w["o"] + w["ob"])
        total = max(1.0, float(mask.sum()))
        loss = -float((mask * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).sum()) / total
        slope = mask * (p - y) / total
        into = {k: np.zeros_like(v) for k, v in w.items()}
        into["o"] = np.einsum("tb,tbh->h", slope, both)
        into["ob"] = slope.sum(keepdims=True).reshape(1)
        above = slope[:, :, None] * w["o"]
        _direction_back(x, kf, above[:, :, :HIDDEN], w, "f", into)
        _direction_back(x[::-1], kb, above[::-1, :, HIDDEN:], w, "b", into)
        return loss, into

    def fit(self, pages: list[list[Block]], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        flat = vectors(pages)
        first = np.concatenate([[0], np.cumsum([len(p) for p in pages])])
        some = [k for k in range(len(pages)) if len(pages[k])]
        some.sort(key=lambda k: len(pages[k]))
        batches = [some[k : k + 24] for k in range(0, len(some), 24)]
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for epoch in range(epochs):
            for k in rng.permutation(len(batches)):
                x, mask = _padded(flat, first, batches[k])
                y = np.zeros(mask.shape, dtype=np.float32)
                for j, page in enumerate(batches[k]):
                    y[: len(labels[page]), j] = labels[page]
                _, found = self.gradients(x, mask, y)
                norm = np.sqrt(sum(float((g**2).sum()) for g in found.values()))
                step += 1
                for name, g in found.items():
                    g = g * min(1.0, 5.0 / max(norm, 1e-9))
                    mean[name] = 0.9 * mean[name] + 0.1 * g
                    square[name] = 0.999 * square[name] + 0.001 * g * g
                    rate = RATE * (1 - 0.9 * epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.weights[name] = (self.weights[name] - rate * mean[name] / (np.sqrt(square[name]) + 1e-8)).astype(np.float32)

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page, which blocks are main text."""
        flat = vectors(pages)
        sizes = np.array([len(p) for p in pages])
        first = np.concatenate([[0], np.cumsum(sizes)])
        out = [np.zeros(n, dtype=bool) for n in sizes]
        order = [k for k in np.argsort(sizes, kind="stable") if sizes[k]]
        while order:
            many = max(1, min(len(order), 512, 200_000 // int(sizes[order[min(len(order), 512) - 1]])))
            group, order = order[:many], order[many:]
            x, mask = _padded(flat, first, group)
            found = self.scores(x, mask) > 0
            for j, page in enumerate(group):
                out[page] = found[: sizes[page], j]
        return out


def _padded(flat: np.ndarray, first: np.ndarray, group: list[int]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(first[k + 1] - first[k] for k in group)
    x = np.zeros((longest, len(group), flat.shape[1]), dtype=np.float32)
    mask = np.zeros((longest, len(group)), dtype=np.float32)
    for j, k in enumerate(group):
        n = first[k + 1] - first[k]
        x[:n, j] = flat[first[k] : first[k + 1]]
        mask[:n, j] = 1
    return x, mask


def ancestry(page: list[Block]) -> np.ndarray:
    """Labels by ancestors: within an article (or what is named so), and in nothing beside it."""
    aside = _either(page, {*ASIDE_TAGS, *(f".{w}" for w in ASIDE_MARKS)})
    inside = _either(page, {"article", "main", *(f".{w}" for w in ARTICLE_MARKS)})
    return np.array([i and not a for i, a in zip(inside, aside, strict=True)], dtype=np.float32)


def density(page: list[Block]) -> np.ndarray:
    """Labels by length and links, for tables in which nothing is named."""
    aside = _either(page, {*ASIDE_TAGS, *(f".{w}" for w in ASIDE_MARKS)})
    return np.array([not a and len(b.text) >= LEAST_CHARS and b.linked < 0.5 for a, b in zip(aside, page, strict=True)], dtype=np.float32)


def compose(page: list[Block], labels: np.ndarray, others: list[str], rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """The same main text in another layout, with parts around and within it that are not main text."""
    say = lambda: others[rng.integers(len(others))]
    short = lambda: " ".join(say().split()[: rng.integers(1, 6)])
    pick = lambda *x: x[rng.integers(len(x))]
    odd = lambda: "." + "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 5))
    outer = pick((), ("div", ".wrapper"), ("div", ".container"), ("div", odd()))
    unnamed = pick((), ("div",), ("div", odd()), ("table", "tbody", "tr", "td"), ("table", "tr", "td"), ("section",), ("div", "div"))
    holder = pick(unnamed, unnamed, unnamed, unnamed, unnamed, ("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".main"), ("section", ".post"), ("div", ".entry", ".content"), ("div", ".story"), ("div", odd(), "article"))
    out: list[Block] = []
    kept: list[float] = []

    def put(path: tuple[str, ...], text: str, linked: float = 0.0, main: bool = False) -> None:
        if text:
            out.append(Block(("html", "body", *outer, *path), text, linked))
            kept.append(float(main))

    def part(kind: str, within: tuple[str, ...] = ()) -> None:
        if kind == "header":
            path = pick(("header",), ("div", ".header"), ("header", ".site", ".header"))
            for _ in range(rng.integers(1, 4)):
                put((*within, *path, pick("h1", "p", "div", "span")), short() if rng.random() < 0.6 else say(), float(rng.random() < 0.3))
        elif kind == "nav":
            path = pick(("nav", "ul", "li", "a"), ("div", ".menu", "ul", "li", "a"), ("ul", ".nav", "li", "a"), ("div", ".breadcrumb", "a"))
            for _ in range(rng.integers(2, 9)):
                put((*within, *path), short(), 1.0)
        elif kind == "sidebar":
            path = pick(("aside",), ("div", ".sidebar"), ("aside", ".sidebar"), ("div", ".widget"), ("div", ".related"))
            put((*within, *path, pick("h2", "h3", "h4")), short())
            for _ in range(rng.integers(1, 6)):
                link = rng.random() < 0.6
                put((*within, *path, *(("ul", "li", "a") if link else ("p",))), short() if link else say(), float(link))
        elif kind == "notice":
            path = pick(("div", ".notice"), ("div", ".cookie", ".banner"), ("div", ".cookies"), ("section", ".notice"), ("div", ".popup"), ("div", ".newsletter"), ("p", ".notice"))
            put((*within, *path, *pick((), ("p",))), say())
        elif kind == "advert":
            path = pick(("div", ".ad"), ("div", ".ads"), ("aside", ".ad"), ("div", ".advert"), ("div", ".sponsored"), ("section", ".promo"))
            put((*within, *path, *pick((), ("p",), ("a",))), say(), float(rng.random() < 0.4))
        elif kind == "form":
            path = pick(("form",), ("form", ".search"), ("form", ".login"), ("div", ".subscribe", "form"), ("form", ".newsletter"))
            for tag in ("label", "button", "p", "option", "legend", "div")[: rng.integers(1, 7)]:
                put((*within, *path, tag), short() if rng.random() < 0.7 else say())
        elif kind == "comments":
            path = pick(("section", ".comments"), ("div", ".comments"), ("div", ".comment", ".list"), ("ol", ".comments", "li"), ("section", ".replies"))
            put((*within, *path, pick("h2", "h3")), short())
            for _ in range(rng.integers(1, 6)):
                one = pick(("article", ".comment"), ("div", ".comment"), ("li", ".comment"), ())
                if rng.random() < 0.5:
                    put((*within, *path, *one, pick("b", "span", "cite", "h4")), short())
                put((*within, *path, *one, "p"), say())
        elif kind == "footer":
            path = pick(("footer",), ("div", ".footer"), ("footer", "p"))
            for _ in range(rng.integers(1, 4)):
                put((*within, *path), ("© " if rng.random() < 0.6 else "") + say())

    main = [b for b, y in zip(page, labels, strict=True) if y]
    before = ["header", "nav", "notice", "advert", "form", "sidebar"]
    after = ["sidebar", "comments", "notice", "advert", "form", "nav", "footer"]
    for kind in rng.permutation(before)[: rng.integers(1, 5)]:
        part(str(kind))
    for k, b in enumerate(main):
        if k and rng.random() < 0.08:
            part(str(pick("advert", "notice", "form", "sidebar", "nav")), holder)
        last = next((x for x in reversed(b.path) if x[0] != "."), "p")
        tag = last if last not in ("article", "main", "div", "section", "b", "body") else "p"
        put((*holder, pick(tag, tag, tag, tag, "p", "li", "blockquote", "h2") if tag == "p" else tag), b.text, b.linked, True)
    if rng.random() < 0.3:
        part("comments", holder)
    for kind in rng.permutation(after)[: rng.integers(1, 6)]:
        part(str(kind))
    return out, np.array(kept, dtype=np.float32)


def train(pages: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 3) -> Labeller:
    """A labeller fitted on about ``rows`` pages at most, drawn by hash; equal pages are drawn once.

    The share to draw follows from the number of pages, so the driver gets the drawn pages only.
    """
    whole = 1 << 30
    text = F.col("html").cast("string")
    drawn = pages.select(F.pmod(F.xxhash64("url", text), F.lit(whole)).alias("draw"), text.alias("html"))
    share = rows / max(rows, pages.count())
    sample = drawn.where((F.col("draw") < int(share * whole)) & (F.length("html") <= SAMPLE_CHARS))
    found = [r["html"] for r in sorted(sample.groupBy("draw").agg(F.first("html").alias("html")).collect())]
    parsed = [p for p in map(blocks, found) if p]
    ways = ([(p, y) for p in parsed if (y := way(p)).any()] for way in (ancestry, density))
    taught = next(filter(None, ways), [])
    rng = np.random.default_rng(seed)
    others = [b.text[:300] for p in parsed for b in p] or ["-"]
    more = [compose(p, y, others, rng) for p, y in taught for _ in range(COMPOSED)]
    model = Labeller.fresh()
    model.fit(*map(list, zip(*taught, *taught, *more, strict=True)) if taught else ([], []))
    return model


def _extract(model: Labeller):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textscan.pieces_of(batch, "html", 4 << 20):
                pages = [blocks(x.as_py() or "") for x in part.column("html")]
                labels = model.label(pages)
                texts = ["\n\n".join(b.text for b, y in zip(p, own, strict=True) if y) for p, own in zip(pages, labels, strict=True)]
                counts = [len(p) for p in pages]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array([int(x.sum()) for x in labels], pa.int64())],
                    names=["page_id", "url", "text", "n_blocks", "n_main"],
                )

    return run


def extract(pages: DataFrame, model: Labeller) -> DataFrame:
    """Main text of every page.

    ``pages``: ``page_id``, ``url``, ``html``; more columns are ignored. A row per row: ``page_id``,
    ``url``, ``text`` (blocks in page order, joined by two \\n; empty if there is none, or if
    ``html`` is null or empty), ``n_chars`` (code points of it), ``n_blocks``, ``n_main``. Repeated rows
    give repeated results; very long pages are read whole.
    """
    types = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    read = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    schema = f"page_id {types['page_id']}, url {types['url']}, text string, n_blocks long, n_main long"
    found = read.mapInArrow(_extract(model), schema)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks", "n_main")
