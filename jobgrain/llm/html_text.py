"""Main text of web pages by a recurrent block labeller in numpy.

A page is read as its sequence of leaf blocks: runs of text between block-level tags, each with the whole path of open
tags and their class, id and role words. Hashed vectors of path and words go through a bidirectional LSTM, so every block
is judged in the context of the whole page; the blocks labelled as article are joined in page order. The vector of the path
is updated at every open and close, so a tag costs the same at any depth.

Nobody has labelled pages by hand, so the network is fitted on at most ``SAMPLE`` pages whose own markup tells (an article
or main element, less what it marks as navigation, adverts, comments and the like), varied with inserted boilerplate and
other names for the container. Fitting is bounded (``SAMPLE`` pages and ``SHOWN`` blocks of each) and on the driver; every page is labelled whole, in its
task.

Defined cases: a null or empty page has the empty text; white space includes the no-break space; markup without an end is
read as markup to the end of the page; a quote opens a value directly after an equals sign only, and one that is never
closed opens none; script, style, iframe, template and svg are not read, all other elements are (math,
object, canvas and noscript as inline text); an unclosed script, style or iframe hides the rest, an unclosed template or svg
hides what is left of its parent; a page of any number of blocks is labelled as one
sequence; without a page to learn from the markup rule itself decides; repeated rows and null ids keep their rows; further
columns are not read; all class, id and role words of a tag are
read; each word of a path counts once, however many of the open tags have it and however deep they are.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Dimensions of the path and word vectors, LSTM units each way, pages to learn from, passes, blocks projected at once.
PATH_DIM, WORD_DIM, UNITS, SAMPLE, EPOCHS, SLAB = 96, 24, 16, 160, 20, 4096
#: Least steps of fitting (few pages get more passes), and blocks of a page shown in fitting.
STEPS, SHOWN = 200, 2000
INPUTS = PATH_DIM + WORD_DIM + 3
#: Words without a meaning to the markup rule that a path shows at full weight; the weights of more are scaled to the norm of so many.
PLAIN = 8

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are not shown: raw text up to their own end tag, and markup.
RAW, HIDDEN = frozenset("script style iframe".split()), frozenset("template svg".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td "
    "textarea tfoot th thead title tr ul".split()
)
#: Tags that end an open paragraph, and those that end an open one of their own kind.
ENDS_P = BLOCK - {"br", "button", "option"}
ENDS_OWN = frozenset("li dd dt option tr td th".split())
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
#: What ends a tag or opens a quoted value: a quote opens one only directly after the equals sign, white space apart.
_STOP = re.compile(r""">|=\s*(["'])""")

#: What the markup rule takes as article and as boilerplate.
ARTICLE = frozenset("article main".split())
BOILERPLATE = frozenset(
    "nav header footer aside form menu head title button select option textarea dialog ad ads advert advertisement sponsored "
    "sidebar comment comments notice cookie banner promo related share social widget breadcrumb newsletter".split()
)


class Leaf(NamedTuple):
    """One block: the vector of its tag path, whether an article element is open, whether the markup says that the block
    belongs to the article, its text, and the characters of it that are link text."""

    path: np.ndarray
    named: bool
    told: bool
    text: str
    linked: int


@lru_cache(maxsize=100_000)
def _spot(word: str, size: int) -> tuple[int, float]:
    code = zlib.crc32(word.encode())
    return code % size, 1.0 if code >> 31 else -1.0


def _with_values(words: Iterable[str]) -> set[str]:
    """The words, and those of attributes without their attribute too."""
    return {x for w in words for x in (w, w.rpartition("=")[2])}


def _path_vector(words: Iterable[str]) -> np.ndarray:
    vector = np.zeros(PATH_DIM, np.float32)
    for word in _with_values(words):
        at, sign = _spot(word, PATH_DIM)
        vector[at] += sign
    return vector


class Path:
    """The distinct words of all open tags as a vector."""

    def __init__(self) -> None:
        self._times: Counter = Counter()
        self._telling, self._plain, self._many = np.zeros(PATH_DIM), np.zeros(PATH_DIM), 0
        self._article = self._boilerplate = 0

    def open(self, words: set[str]) -> None:
        for word in words:
            self._times[word] += 1
            if self._times[word] == 1:
                self._turn(word, 1)

    def close(self, words: set[str]) -> None:
        for word in words:
            self._times[word] -= 1
            if not self._times[word]:
                del self._times[word]
                self._turn(word, -1)

    def _turn(self, word: str, by: int) -> None:
        (at, sign), value = _spot(word, PATH_DIM), word.rpartition("=")[2]
        article, boilerplate = value in ARTICLE, value in BOILERPLATE
        self._article += by * article
        self._boilerplate += by * boilerplate
        if article or boilerplate:
            self._telling[at] += by * sign
        else:
            self._plain[at] += by * sign
            self._many += by

    def vector(self) -> np.ndarray:
        return (self._telling + self._plain / max(1, self._many / PLAIN) ** 0.5).astype(np.float32)

    def told(self) -> bool:
        return self._article > 0 and not self._boilerplate


def _tag_end(page: str, at: int) -> int:
    """Place of the ``>`` that ends a tag, past quoted values; a quoted value without an end holds none. -1 when there is none."""
    while found := _STOP.search(page, at):
        if found.group() == ">":
            return found.start()
        end = page.find(found.group(1), found.end())
        at = found.end() if end < 0 else end + 1
    return -1


def leaves(page: str) -> list[Leaf]:
    """The blocks of a page in order."""
    stack: list[tuple[str, set[str]]] = []
    tags, known = Path(), {}
    opened: Counter = Counter()
    found: list[Leaf] = []
    parts: list[str] = []
    linked, at, size = 0, 0, len(page)
    place: tuple[np.ndarray, bool, bool] = tags.vector(), False, False

    def close(name: str) -> None:
        while opened[name]:
            top, words = stack.pop()
            opened[top] -= 1
            tags.close(words)
            if top == name:
                return

    def hidden() -> bool:
        return any(opened[x] for x in HIDDEN)

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            found.append(Leaf(*place, text, linked))
        parts.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal place, linked
        if text and not hidden() and (parts or not text.isspace()):
            if not parts:
                path = tags.vector()
                place = known.setdefault(path.tobytes(), path), opened["article"] > 0, tags.told()
            parts.append(text)
            linked += len(text) * bool(opened["a"])

    while at < size:
        start = page.find("<", at)
        if start < 0:
            say(page[at:])
            break
        say(page[at:start])
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        following = page[start + 1 : start + 2]
        if following in ("!", "?"):
            end = page.find(">", start)
            at = size if end < 0 else end + 1
            continue
        if not (following.isalpha() or following == "/" and page[start + 2 : start + 3].isalpha()):
            say("<")
            at = start + 1
            continue
        end = _tag_end(page, start + 1)
        if end < 0:
            break
        tag, at = page[start + 1 : end], end + 1
        closing = tag[0] == "/"
        name = re.match(r"/?([^\s/>]*)", tag).group(1).lower()
        if name in RAW:
            if not closing and not tag.endswith("/"):
                after = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
                at = after.end() if after else size
            continue
        if closing:
            close(name)
        if name in BLOCK and not hidden():
            flush()
        if closing:
            continue
        if name in ENDS_P and not hidden():
            close("p")
        if name in ENDS_OWN and stack and stack[-1][0] == name:
            close(name)
        if name not in VOID and not tag.endswith("/"):
            words = [name]
            for kind, value in _ATTRIBUTE.findall(tag):
                words += [f"{kind.lower()}={w}" for w in re.split(r"[\s_-]+", value.strip("\"'").lower()) if w]
            stack.append((name, _with_values(words)))
            opened[name] += 1
            tags.open(stack[-1][1])
    flush()
    return found


def rule_label(leaf: Leaf) -> bool:
    """Whether the markup says that the block belongs to the article."""
    return leaf.told


def features(blocks: list[Leaf]) -> np.ndarray:
    """Hashed path and word vectors, length, share of link text and share of sentence marks."""
    table = np.zeros((len(blocks), INPUTS), np.float32)
    for row, leaf in zip(table, blocks):
        row[:PATH_DIM] = leaf.path
        words = leaf.text.lower().split()
        for word in words:
            at, sign = _spot(word, WORD_DIM)
            row[PATH_DIM + at] += sign
        row[PATH_DIM : PATH_DIM + WORD_DIM] /= max(len(words), 1) ** 0.5
        size = len(leaf.text)
        row[-3:] = np.log1p(size) / 4, leaf.linked / size, 20 * sum(map(leaf.text.count, ".,;:!?")) / size
    return table


class Labeller(NamedTuple):
    """Weights of both directions (inputs, recurrent, bias) and of the output."""

    inputs: np.ndarray  # 2 x INPUTS x 4 UNITS
    recurrent: np.ndarray  # 2 x UNITS x 4 UNITS
    bias: np.ndarray  # 2 x 4 UNITS
    out: np.ndarray  # 2 UNITS
    offset: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _step(gates: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, ...]:
    u = UNITS
    enter, forget, give, new = _sigmoid(gates[:, :u]), _sigmoid(gates[:, u : 2 * u]), _sigmoid(gates[:, 2 * u : 3 * u]), np.tanh(gates[:, 3 * u :])
    cell = forget * cell + enter * new
    return enter, forget, give, new, cell, np.tanh(cell)


def scores(net: Labeller, pages: list[list[Leaf]]) -> list[np.ndarray]:
    """Score of every block; pages of like length go through the network together."""
    result: list[np.ndarray] = [np.zeros(0)] * len(pages)
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    while order:
        longest = len(pages[order[-1]])
        group = [order.pop() for _ in range(min(len(order), max(1, 4 * SLAB // longest)))]
        total = np.zeros((len(group), longest), np.float32)
        projected = np.zeros((2, longest, len(group), 4 * UNITS), np.float32)
        for g, i in enumerate(group):
            for at in range(0, len(pages[i]), SLAB):
                table = features(pages[i][at : at + SLAB])
                for way in (0, 1):
                    projected[way, at : at + len(table), g] = table @ net.inputs[way] + net.bias[way]
        lengths = np.array([len(pages[i]) for i in group])
        for way in (0, 1):
            hidden = cell = np.zeros((len(group), UNITS), np.float32)
            for t in range(longest) if way == 0 else range(longest - 1, -1, -1):
                here = (t < lengths)[:, None]
                _, _, give, _, new_cell, squashed = _step(projected[way, t] + hidden @ net.recurrent[way], cell)
                hidden, cell = np.where(here, give * squashed, hidden), np.where(here, new_cell, cell)
                total[:, t] += hidden @ net.out[way * UNITS : (way + 1) * UNITS]
        for g, i in enumerate(group):
            result[i] = _sigmoid(total[g, : lengths[g]] + net.offset[0])
    return result


def _varied(blocks: list[Leaf], labels: list[bool], rng: np.random.Generator) -> tuple[list[Leaf], list[bool]]:
    """The page with boilerplate put in and, at times, another name for the article's container and unknown wrappers."""
    names = [("main",), ("div", "class=content"), ("div", "id=content"), ("section", "class=post", "class=body"), ("div", "class=article", "class=text")]
    extra = ["nav", "aside", "footer", "header", "form", "class=comments", "class=comment", "class=sidebar", "class=notice", "class=ad",
             "class=cookie", "class=promo", "class=related", "class=banner", "id=comments", "id=sidebar", "class=newsletter", "class=share"]
    name = names[rng.integers(len(names))] if rng.random() < 0.4 else None
    wrapped, wrapper = rng.random(), np.zeros(PATH_DIM, np.float32)
    if wrapped < 0.5:
        np.add.at(wrapper, rng.integers(PATH_DIM, size=rng.integers(1, PLAIN + 1)), 1)
        wrapper *= rng.choice([-1, 1], PATH_DIM)
    out, marks = [], []
    texts = [b.text for b in blocks]
    for leaf, label in zip(blocks, labels):
        path = leaf.path
        if name and leaf.named:
            path = path - _path_vector(["article"]) + _path_vector(name)
        if leaf.named or wrapped < 0.15:
            path = path + wrapper
        out.append(leaf._replace(path=path))
        marks.append(label)
        if rng.random() < 0.12:
            kind = extra[rng.integers(len(extra))]
            inside = path if rng.random() < 0.5 else _path_vector(("html", "body"))
            words = ("div", kind) if "=" in kind else (kind,)
            text = texts[rng.integers(len(texts))]
            for _ in range(rng.integers(1, 4)):
                own = _path_vector((*words, *(("p",) if rng.random() < 0.6 else ("ul", "li"))))
                out.append(Leaf(inside + own + wrapper * rng.integers(2), False, False, text, 0))
                marks.append(False)
    return out, marks


def fit(pages: list[list[Leaf]], epochs: int = EPOCHS, batch: int = 10, seed: int = 3) -> Labeller | None:
    """Adam on the cross entropy through time; None without a page whose markup tells."""
    told = [(p, [rule_label(x) for x in p]) for p in pages]
    told = [(p[:SHOWN], y[:SHOWN]) for p, y in told if any(y)]
    if not told:
        return None
    rng, u = np.random.default_rng(seed), UNITS
    bias = np.zeros((2, 4 * u), np.float32)
    bias[:, u : 2 * u] = 1
    state = [
        rng.normal(0, 0.15, (2, INPUTS, 4 * u)).astype(np.float32), rng.normal(0, 0.15, (2, u, 4 * u)).astype(np.float32), bias,
        rng.normal(0, 0.3, 2 * u).astype(np.float32), np.zeros(1, np.float32),
    ]
    first, second, step = [np.zeros_like(p) for p in state], [np.zeros_like(p) for p in state], 0
    epochs = max(epochs, -(-STEPS * batch // len(told)))
    for epoch in range(epochs):
        order, rate = rng.permutation(len(told)), 0.01 * (1 - epoch / epochs) + 0.0005
        for at in range(0, len(order), batch):
            chosen = [told[i] if epoch % 2 else _varied(*told[i], rng) for i in order[at : at + batch]]
            step += 1
            for p, g, m, v in zip(state, _gradients(Labeller(*state), chosen), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Labeller(*state)


def _gradients(net: Labeller, pages: list[tuple[list[Leaf], list[bool]]]) -> list[np.ndarray]:
    longest, n, u = max(len(p) for p, _ in pages), len(pages), UNITS
    data, label, mask = np.zeros((longest, n, INPUTS), np.float32), np.zeros((longest, n), np.float32), np.zeros((longest, n), np.float32)
    for g, (blocks, marks) in enumerate(pages):
        data[: len(blocks), g], label[: len(blocks), g], mask[: len(blocks), g] = features(blocks), marks, 1
    kept, total = [], np.full((longest, n), net.offset[0], np.float32)
    for way in (0, 1):
        times = list(range(longest))[:: 1 if way == 0 else -1]
        projected, trace = data @ net.inputs[way] + net.bias[way], []
        hidden = cell = np.zeros((n, u), np.float32)
        for t in times:
            parts = _step(projected[t] + hidden @ net.recurrent[way], cell)
            here = mask[t][:, None]
            trace.append((t, hidden, cell, parts))
            hidden, cell = here * parts[2] * parts[5] + (1 - here) * hidden, here * parts[4] + (1 - here) * cell
            total[t] += hidden @ net.out[way * u : (way + 1) * u]
        kept.append(trace)
    error = (_sigmoid(total) - label) * mask / mask.sum()
    inputs, recurrent, bias, out = (np.zeros_like(p) for p in net[:4])
    for way in (0, 1):
        weight = net.out[way * u : (way + 1) * u]
        to_hidden = to_cell = np.zeros((n, u), np.float32)
        back = np.zeros((longest, n, 4 * u), np.float32)
        for t, hidden, cell, (enter, forget, give, new, _, squashed) in reversed(kept[way]):
            here = mask[t][:, None]
            out[way * u : (way + 1) * u] += error[t] @ (here * give * squashed + (1 - here) * hidden)
            d_hidden = to_hidden + error[t][:, None] * weight
            own = here * d_hidden
            d_cell = here * to_cell + own * give * (1 - squashed**2)
            gates = np.concatenate((
                d_cell * new * enter * (1 - enter), d_cell * cell * forget * (1 - forget),
                own * squashed * give * (1 - give), d_cell * enter * (1 - new**2),
            ), axis=1)
            back[t] = gates
            recurrent[way] += hidden.T @ gates
            to_hidden = gates @ net.recurrent[way].T + (1 - here) * d_hidden
            to_cell = d_cell * forget + (1 - here) * to_cell
        inputs[way] = np.tensordot(data, back, axes=((0, 1), (0, 1)))
        bias[way] = back.sum(axis=(0, 1))
    return [inputs, recurrent, bias, out, error.sum(keepdims=True)[0]]


def train(pages: DataFrame, key: str = "page_id", text: str = "html", sample: int = SAMPLE) -> Labeller | None:
    """A labeller from at most ``sample`` pages, taken in the order of a hash of their id."""
    chosen = pages.filter(F.length(text) > 0).select(key).orderBy(F.xxhash64(key), key).limit(sample)
    rows = pages.select(key, text).join(F.broadcast(chosen.distinct()), key).groupBy(key).agg(
        F.min(F.struct(F.xxhash64(text).alias("mark"), F.col(text).alias("page"))).alias("one")  # the same one of repeated ids in every run
    ).orderBy(key).select("one.page").collect()
    return fit([leaves(r[0]) for r in rows])


def main_text(net: Labeller | None, pages: list[str | None]) -> list[str]:
    read = [leaves(p or "") for p in pages]
    marks = scores(net, read) if net else [np.array([float(rule_label(x)) for x in p]) for p in read]
    return [" ".join(leaf.text for leaf, mark in zip(p, own) if mark >= 0.5) for p, own in zip(read, marks)]


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", text: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row."""
    shared = pages.sparkSession.sparkContext.broadcast(train(pages, key, text))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                texts = main_text(shared.value, part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(text).alias("html"))
    return rows.mapInArrow(extracted, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
