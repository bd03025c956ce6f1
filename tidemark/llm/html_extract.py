"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks: the runs of text between block-level tags.  Each block is
read as the mean vector of the hashed tags, classes and ids on the path to it, the mean vector of
its hashed words, and a few shares such as that of link text.  A bidirectional LSTM in numpy goes
over the whole sequence of a page, so every block is judged by what stands before and after it,
and labels each block as main text or not.

The weights are learned here, by gradient descent on pages that are built for it: real layouts
differ in which containers they use and in what order, so articles of made-up words are set into
random ones together with menus, notices, adverts, forms, side columns and comments.

Texts of scripts, styles and the head are no blocks.  Character references are decoded, white
space inside a block becomes one space, and the main blocks are joined by an empty line in page
order.  Null, empty or textless pages give an empty text; repeated rows are extracted once each;
an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import pick, rows_of

PATH_BUCKETS, WORD_BUCKETS, DIM, SHARES, HIDDEN = 2048, 2048, 12, 6, 16
#: Pages built for training, epochs, step size and seed.
TRAIN_PAGES, EPOCHS, RATE, SEED = 1200, 6, 0.01, 3
#: Share of training pages that are read without words, so that layouts count more than they.
WORDLESS = 0.5
#: Blocks that are labelled at a time.
CELLS = 200_000

#: Elements that end a block (fixed values).
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td textarea tfoot th thead title tr ul".split()
)
#: Elements of other vocabularies; elements without text of the page, and without content.
FOREIGN = frozenset(("svg", "math"))
SILENT = frozenset("head iframe math noframes noscript object script style svg template title".split())
#: Elements that may stand in the head; others, and text, end one whose end tag is left out.
HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that cannot contain a block of their own kind: opening one closes the other.
SINGLE = frozenset("p li dt dd option tr td th h1 h2 h3 h4 h5 h6".split())
#: Elements beyond which the search for an open element does not go.
SCOPES = frozenset("table ul ol dl select article section div body html aside nav header footer form main template svg math object".split())
_NAME = re.compile(r"[a-z]+|[0-9]+")


@dataclass
class Block:
    """A leaf: its text, the names on the path to it, and the share of its text in links."""

    text: str
    path: list[str]
    links: float


class Blocks(HTMLParser):
    """Collects the leaf blocks of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[Block] = []
        self._open: list[tuple[str, list[str]]] = []
        self._text: list[str] = []
        self._linked = self._silent = self._links = 0

    def end_block(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            path = [name for tag, names in self._open for name in (tag, *names)]
            self.found.append(Block(text, path, min(1.0, self._linked / len(text))))
        self._text, self._linked = [], 0

    def _end_head(self) -> None:
        while self._open and self._open[-1][0] == "head":
            self._cut(len(self._open) - 1)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in HEAD:
            self._end_head()
        if tag in BLOCKS:
            self.end_block()
            # a block ends an open paragraph; items, cells and headings end their like
            self._close_within("p")
            if tag in SINGLE:
                self._close_within(tag)
        elif tag == "br":
            self._text.append(" ")
        if tag in VOID:
            return
        names = []
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                names += [f"{key[0]}:{n}" for n in _NAME.findall(value.lower())]
        self._open.append((tag, names))
        self._silent += tag in SILENT
        self._links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        # only foreign elements end by their slash; HTML elements stay open as without it
        if tag in FOREIGN or any(name in FOREIGN for name, _ in self._open[:-1]):
            if self._open and self._open[-1][0] == tag:
                self._cut(len(self._open) - 1)

    def _close_within(self, tag: str) -> None:
        for k in range(len(self._open) - 1, -1, -1):
            if self._open[k][0] == tag:
                self._cut(k)
                return
            if self._open[k][0] in SCOPES:
                return

    def _cut(self, k: int) -> None:
        for tag, _ in self._open[k:]:
            self._silent -= tag in SILENT
            self._links -= tag == "a"
        del self._open[k:]

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_block()
        for k in range(len(self._open) - 1, -1, -1):
            if self._open[k][0] == tag:
                self._cut(k)
                return

    def handle_data(self, data: str) -> None:
        if self._silent and data.strip():
            self._end_head()
        if not self._silent:
            self._text.append(data)
            if self._links:
                self._linked += len(data.strip())


def blocks(html: str | None) -> list[Block]:
    """Leaf blocks of a page in order."""
    if not html:
        return []
    parser = Blocks()
    parser.feed(html)
    parser.close()
    parser.end_block()
    return parser.found


# --- model ----------------------------------------------------------------------------------


@functools.lru_cache(maxsize=100_000)
def _bucket(name: str, size: int) -> int:
    return zlib.crc32(name.encode()) % size


def _shares(page: list[Block]) -> np.ndarray:
    out = np.empty((len(page), SHARES), np.float32)
    for k, b in enumerate(page):
        n = len(b.text)
        out[k] = (
            np.log1p(n) / 6, b.links, sum(map(b.text.count, ".,;:!?")) / n * 10,
            b.text[:1].isupper(), b.text[-1:] in ".!?", k / len(page),
        )
    return out


class Reader:
    """Input vectors of a page: hashed ids of path names and words, and shares."""

    @staticmethod
    def ids(page: list[Block]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        # the last names tell most, and whole paths of tags are names too
        paths = [
            [_bucket(n, PATH_BUCKETS) for n in (*b.path, "/".join(b.path[-2:]))] for b in page
        ]
        words = [[_bucket(w, WORD_BUCKETS) for w in set(b.text.lower().split())] for b in page]
        return paths, words, _shares(page)


def _means(table: np.ndarray, ids: list[list[int]]) -> np.ndarray:
    lengths = np.array([len(i) for i in ids])
    out = np.zeros((len(ids), table.shape[1]), np.float32)
    flat = np.array([x for i in ids for x in i], np.int64)
    if len(flat):
        some = lengths > 0
        starts = (np.cumsum(lengths) - lengths)[some]
        out[some] = np.add.reduceat(table[flat], starts, axis=0) / lengths[some, None]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(x: np.ndarray, mask: np.ndarray, w: np.ndarray, b: np.ndarray, keep: bool):
    """Outputs for every step of ``x`` (steps, pages, inputs); states stay where the mask is 0."""
    steps, pages, _ = x.shape
    h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
    out, saved = np.empty((steps, pages, HIDDEN), np.float32), []
    for t in range(steps):
        z = np.concatenate([x[t], h], axis=1)
        g = z @ w + b
        i, f, o = (_sigmoid(g[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        u = np.tanh(g[:, 3 * HIDDEN :])
        m = mask[t][:, None]
        new = f * c + i * u
        tanh = np.tanh(new)
        if keep:
            saved.append((z, i, f, o, u, c, tanh, m))
        c = m * new + (1 - m) * c
        h = m * (o * tanh) + (1 - m) * h
        out[t] = h
    return out, saved


def _lstm_back(grad: np.ndarray, saved: list, w: np.ndarray):
    """Gradients of the weights, the bias and the inputs."""
    dw, db = np.zeros_like(w), np.zeros(w.shape[1], np.float32)
    steps, pages, _ = grad.shape
    dx = np.empty((steps, pages, w.shape[0] - HIDDEN), np.float32)
    dh, dc = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        z, i, f, o, u, c, tanh, m = saved[t]
        dh = dh + grad[t]
        dnew = m * dc + m * dh * o * (1 - tanh * tanh)
        dg = np.concatenate(
            [dnew * u * i * (1 - i), dnew * c * f * (1 - f), m * dh * tanh * o * (1 - o), dnew * i * (1 - u * u)], axis=1
        )
        dw += z.T @ dg
        db += dg.sum(axis=0)
        dz = dg @ w.T
        dx[t] = dz[:, : -HIDDEN]
        dh = dz[:, -HIDDEN:] + (1 - m) * dh
        dc = dnew * f + (1 - m) * dc
    return dw, db, dx


class Labeller:
    """Bidirectional LSTM over the blocks of a page."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        size = 2 * DIM + SHARES

        def normal(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.weights = {
            "path": (0.3 * rng.standard_normal((PATH_BUCKETS, DIM))).astype(np.float32),
            "word": (0.1 * rng.standard_normal((WORD_BUCKETS, DIM))).astype(np.float32),
            "wf": normal(size + HIDDEN, 4 * HIDDEN), "bf": np.zeros(4 * HIDDEN, np.float32),
            "wb": normal(size + HIDDEN, 4 * HIDDEN), "bb": np.zeros(4 * HIDDEN, np.float32),
            "wo": normal(2 * HIDDEN + size, 1), "bo": np.zeros(1, np.float32),
        }

    def _inputs(self, pages: list) -> tuple[np.ndarray, np.ndarray]:
        steps = max(len(p[2]) for p in pages)
        x = np.zeros((steps, len(pages), 2 * DIM + SHARES), np.float32)
        mask = np.zeros((steps, len(pages)), np.float32)
        for k, (paths, words, shares) in enumerate(pages):
            n = len(shares)
            x[:n, k, :DIM] = _means(self.weights["path"], paths)
            x[:n, k, DIM : 2 * DIM] = _means(self.weights["word"], words)
            x[:n, k, 2 * DIM :] = shares
            mask[:n, k] = 1
        return x, mask

    def _forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        w = self.weights
        left, saved = _lstm(x, mask, w["wf"], w["bf"], keep)
        right, back = _lstm(x[::-1], mask[::-1], w["wb"], w["bb"], keep)
        both = np.concatenate([left, right[::-1], x], axis=2)
        return (both @ w["wo"] + w["bo"])[:, :, 0], both, saved, back

    def main(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Whether each block of each page is main text."""
        order = sorted((k for k, p in enumerate(pages) if p), key=lambda k: len(pages[k]))
        out = [np.zeros(0, bool)] * len(pages)
        while order:
            # pages of like length together; the last one is the longest
            count = max(1, min(128, CELLS // len(pages[order[-1]])))
            some, order = order[-count:], order[:-count]
            x, mask = self._inputs([Reader.ids(pages[k]) for k in some])
            logits = self._forward(x, mask)[0]
            for j, k in enumerate(some):
                out[k] = logits[: len(pages[k]), j] > 0
        return out

    def fit(self, pages: list[list[Block]], labels: list[np.ndarray], epochs: int = EPOCHS, rate: float = RATE) -> None:
        """Gradient descent on the mean log loss of the blocks, with adaptive steps."""
        rng = np.random.default_rng(SEED)
        read = [Reader.ids(p) for p in pages]
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.weights.items()}
        done, batch, steps = 0, 16, epochs * -(-len(pages) // 16)
        for _ in range(epochs):
            order = rng.permutation(len(pages))
            for start in range(0, len(order), batch):
                some = order[start : start + batch]
                done += 1
                step = rate * (1 - 0.9 * done / steps)
                seen = [self._wordless(read[k]) if rng.random() < WORDLESS else read[k] for k in some]
                for name, grad in self._gradients(seen, [labels[k] for k in some]).items():
                    first, second = moments[name]
                    first *= 0.9
                    first += 0.1 * grad
                    second *= 0.99
                    second += 0.01 * grad * grad
                    up = first / (1 - 0.9**done)
                    self.weights[name] -= step * up / (np.sqrt(second / (1 - 0.99**done)) + 1e-6)

    @staticmethod
    def _wordless(page):
        paths, words, shares = page
        return paths, [[] for _ in words], shares

    def _gradients(self, read: list, labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        w = self.weights
        x, mask = self._inputs(read)
        logits, both, saved, back = self._forward(x, mask, keep=True)
        target = np.zeros_like(logits)
        for k, y in enumerate(labels):
            target[: len(y), k] = y
        error = ((_sigmoid(logits) - target) * mask / mask.sum())[:, :, None].astype(np.float32)
        dboth = error @ w["wo"].T
        grads = {"wo": np.einsum("tpi,tpj->ij", both, error), "bo": error.sum(axis=(0, 1))}
        grads["wf"], grads["bf"], dx = _lstm_back(dboth[:, :, :HIDDEN], saved, w["wf"])
        grads["wb"], grads["bb"], dback = _lstm_back(dboth[::-1, :, HIDDEN : 2 * HIDDEN], back, w["wb"])
        dx = dx + dback[::-1] + dboth[:, :, 2 * HIDDEN :]
        for name, at, part in (("path", 0, slice(0, DIM)), ("word", 1, slice(DIM, 2 * DIM))):
            grad = np.zeros_like(w[name])
            for k, page in enumerate(read):
                ids = page[at]
                lengths = np.array([max(len(i), 1) for i in ids])
                rows = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
                flat = np.array([i for some in ids for i in some], np.int64)
                np.add.at(grad, flat, (dx[: len(ids), k, part] / lengths[:, None])[rows])
            grads[name] = grad
        return grads


@functools.lru_cache(maxsize=2)
def trained(pages: int = TRAIN_PAGES, seed: int = SEED) -> Labeller:
    """The labeller, trained once per driver process: about a quarter of a minute."""
    from tidemark.llm.html_layouts import training_pages

    made = training_pages(pages, seed)
    model = Labeller(seed)
    model.fit([p for p, _ in made], [y for _, y in made])
    return model


def extract(html: str | None, model: Labeller) -> str:
    """Main text of one page."""
    page = blocks(html)
    return "\n\n".join(b.text for b, main in zip(page, model.main([page])[0], strict=True) if main)


def html_extract(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", model: Labeller | None = None
) -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks, n_main`` of every page."""
    rows = pick(pages, page_id=page_id, url=url, html=html)
    shared = pages.sparkSession.sparkContext.broadcast(model or trained())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = shared.value
        for batch in rows_of(batches, 512):
            read = [blocks(h) for h in batch.column("html").to_pylist()]
            chosen = labeller.main(read)
            texts = [
                "\n\n".join(b.text for b, main in zip(p, c, strict=True) if main) for p, c in zip(read, chosen, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()), pa.array([len(p) for p in read], pa.int64()),
                    pa.array([int(c.sum()) for c in chosen], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars", "n_blocks", "n_main"],
            )

    kinds = dict(rows.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint, n_blocks bigint, n_main bigint"
    return rows.mapInArrow(work, schema)
