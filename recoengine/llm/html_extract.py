"""Main text of HTML pages by a linear-chain conditional random field.

A page's text is split into leaf blocks (runs of text between the tags of
block elements).  Each block has features of its ancestors (tags, parent and
child pairs, words of class, id and role) and of its text (length, share in
links, punctuation, set phrases, place).  A conditional random field with the
labels main and other is fitted to labelled pages by the gradient of the exact
likelihood (forward and backward sums) and decodes a page's blocks by Viterbi.

The model is some thousand numbers whatever the input; extraction is one pass
without a shuffle, page by page, so a task holds one batch of pages.

Defined cases: null or empty html has the empty text; a page without main
blocks too; a page that breaks off is read as far as it goes (an open tag at
its end is no text); equal pages have equal texts; rows are kept one by one,
also with equal or null ids; an empty table gives an empty result; further
columns are not read; labels of equal likelihood: other before main.  A very
long or deeply nested page takes time and memory in proportion to its size: an
element is held once, with the sum of its features' weights.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoengine.llm._util import prepare, text_slices
from recoengine.llm.labelled_pages import MARK, labelled_pages

SLICE_BYTES = 4 << 20

# Fixed values of HTML.
#: Elements whose content is never page text: those of raw text run to their
#: end tag (or the end of the page), the others as long as they are open.
RAW_TEXT = "script style noscript iframe title textarea".split()
HIDDEN = set("template svg annotation annotation-xml head select option datalist".split())
#: Hidden elements that a block closes, as they hold none.
WITHOUT_BLOCKS = {"head", "option"}
#: Elements that begin and end a block.
BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that an opening tag closes when they are open, and what shields them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
NOT_IN_P = BLOCK - {"button", "body", "html"}

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<(" + "|".join(RAW_TEXT) + r")(?=[\s/>])[^>]*>(?:.*?</\1(?=[\s/>])[^>]*(?:>|\Z)|.*)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+(?:>|\Z)|[^>]*(?:>|\Z))",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Words of a name; single letters and what follows a digit are mostly parts of generated names.
NAME_PART = re.compile(r"(?<![0-9])(?:[A-Z][a-z]+|(?<![A-Za-z])[a-z]{2,})")
PHRASES = re.compile(r"©|\b(cookies?|subscribe|newsletter|share|comments?|reply|log in|sign up|copyright|rights reserved|advertisement|sponsored|related|read more|privacy|terms|popular|search|says|contact|home)\b", re.I)


class Node:
    """An open element below its ancestors: tag and words of its names.
    Equal paths share their nodes, so a page holds each element once however
    deep it nests."""

    __slots__ = ("parent", "tag", "names", "children", "own", "level", "weight")

    def __init__(self, parent: Node | None = None, tag: str = "", names: tuple[str, ...] = ()):
        self.parent, self.tag, self.names = parent, tag, names
        self.children: dict[tuple[str, tuple[str, ...]], Node] = {}
        counts = tag in BLOCK and tag not in ("html", "body")
        self.own: str = tag if counts else parent.own if parent else "-"  # the innermost block element
        self.level: int = (parent.level if parent else 0) + counts
        self.weight: tuple[frozenset[str], np.ndarray] | None = None  # set by Crf.path_weight

    def added(self) -> list[str]:
        """Features of this element, which hold for all below it."""
        out = [f"name:{w}" for w in self.names]
        if self.parent and self.level > self.parent.level:
            out += [f"in:{self.tag}", f"pair:{self.parent.own}>{self.tag}"]
        return out

    def last(self) -> list[str]:
        """Features of a block right below this element."""
        return [f"own:{self.own}", f"depth:{min(self.level, 6)}"]


class Paths:
    """The nodes that a worker's pages share, given up when there are many."""

    def __init__(self, most: int = 50_000):
        self.most, self.root, self.made = most, Node(), 0

    def top(self) -> Node:
        if self.made > self.most:
            self.root, self.made = Node(), 0
        return self.root

    def below(self, node: Node, tag: str, names: tuple[str, ...]) -> Node:
        found = node.children.get((tag, names))
        if found is None:
            found = node.children[tag, names] = Node(node, tag, names)
            self.made += 1
        return found


@dataclass
class Block:
    path: Node  # the innermost open element
    text: str
    linked: int  # characters inside links


def _names(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ()
    found = " ".join(next((x for x in m if x), "") for m in ATTRIBUTE.findall(attributes))
    return tuple(sorted({x.lower() for x in NAME_PART.findall(found)}))


def blocks_of(html: str, paths: Paths | None = None) -> list[Block]:
    """The leaf blocks of a page in its order; character references are
    decoded, white space inside a block is one space."""
    paths = paths or Paths()
    top = paths.top()
    out: list[Block] = []
    stack: list[Node] = []
    open_tags: Counter[str] = Counter()
    held: list[tuple[str, bool]] = []
    links = 0
    hidden: int | None = None  # place of the outermost open hidden element

    def flush() -> None:
        if held:
            text = " ".join("".join(x for x, _ in held).split())
            if text:
                out.append(Block(stack[-1] if stack else top, text, sum(len(x) for x, linked in held if linked)))
            held.clear()

    def add(piece: str) -> None:
        if piece and hidden is None:
            held.append((entities.unescape(piece) if "&" in piece else piece, links > 0))

    def pop_to(depth: int) -> None:
        nonlocal links, hidden
        for node in stack[depth:]:
            open_tags[node.tag] -= 1
            links -= node.tag == "a"
        del stack[depth:]
        if hidden is not None and hidden >= depth:
            hidden = None

    at = 0
    for m in TOKEN.finditer(html):
        add(html[at : m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        if at == len(html) and not m[0].endswith(">"):
            break  # the page breaks off inside a tag
        tag = tag.lower()
        if m[2]:  # an end tag
            if tag in BLOCK and hidden is None:
                flush()
            for depth in range(len(stack) - 1, -1, -1) if open_tags[tag] else ():
                if stack[depth].tag == tag:
                    if tag in BLOCK and hidden is not None and hidden >= depth:
                        pop_to(hidden)
                        flush()
                    pop_to(depth)
                    break
                if tag not in BLOCK and tag not in HIDDEN and stack[depth].tag in BLOCK:
                    break
            continue
        if tag in BLOCK or tag == "option":
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].tag in WITHOUT_BLOCKS:
                    pop_to(depth)
                    break
                if stack[depth].tag in BLOCK or stack[depth].tag in HIDDEN:
                    break
        if tag in BLOCK:
            if hidden is None:
                flush()
            if tag in NOT_IN_P:
                for depth in range(len(stack) - 1, -1, -1) if open_tags["p"] else ():
                    if stack[depth].tag == "p":
                        pop_to(depth)
                        break
                    if stack[depth].tag in BLOCK or stack[depth].tag in HIDDEN:
                        break
            if tag in CLOSES:
                ends, shields = CLOSES[tag]
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth].tag in ends:
                        pop_to(depth)
                        break
                    if stack[depth].tag in shields or stack[depth].tag in HIDDEN:
                        break
        elif tag in ("br", "wbr", "img") and hidden is None:
            held.append((" " if tag != "wbr" else "", False))
        if tag not in VOID and not m[0].endswith("/>"):
            if hidden is None and tag in HIDDEN:
                hidden = len(stack)
            stack.append(paths.below(stack[-1] if stack else top, tag, _names(m[4])))
            open_tags[tag] += 1
            links += tag == "a"
    add(html[at:])
    if hidden is not None:
        pop_to(hidden)
    flush()
    return out


def path_features(path: Node) -> list[str]:
    """Features of a block's ancestors (the same for all blocks of a path)."""
    found, node = set(path.last()), path
    while node is not None:
        found.update(node.added())
        node = node.parent
    return sorted(found)


def text_features(block: Block, place: int, n: int) -> list[str]:
    text, size = block.text, len(block.text)
    words = text.count(" ") + 1
    found = ["bias", f"size:{min(size.bit_length(), 11)}", f"words:{min(words.bit_length(), 8)}", f"linked:{min(4, 4 * block.linked // size)}"]
    found.append("ends:" + ("stop" if text[-1] in ".!?…:;\"'" else "open"))
    if "|" in text or "·" in text or "»" in text:
        found.append("bars")
    if size < 400:
        found += {f"says:{(m or '©').lower()}" for m in PHRASES.findall(text)}
    if place == 0:
        found.append("first")
    if place == n - 1:
        found.append("last")
    return found


@dataclass
class Crf:
    """Weights of the features, of neighbouring labels, and of the first and
    the last label; label 1 is main."""

    features: dict[str, np.ndarray]  # two weights each
    between: np.ndarray
    ends: np.ndarray  # first and last

    def decode(self, emissions: np.ndarray) -> np.ndarray:
        """The most likely labels (Viterbi)."""
        n = len(emissions)
        if not n:
            return np.zeros(0, np.int64)
        (ab, aa), (bb, ba) = (self.between[0, 1], self.between[0, 0]), (self.between[1, 1], self.between[1, 0])
        rows = emissions.tolist()
        x, y = rows[0][0] + self.ends[0, 0], rows[0][1] + self.ends[0, 1]
        back = []
        for e, f in rows[1:]:
            to_x, to_y = (x + aa < y + ba), (x + ab < y + bb)
            back.append((to_x, to_y))
            x, y = max(x + aa, y + ba) + e, max(x + ab, y + bb) + f
        label = int(x + self.ends[1, 0] < y + self.ends[1, 1])
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return np.array(out[::-1])

    def path_weight(self, path: Node) -> tuple[frozenset[str], np.ndarray]:
        """The known features that a path's elements have, and the sum of their
        weights, made of those of the element above."""
        todo, node = [], path
        while node is not None and node.weight is None:
            todo.append(node)
            node = node.parent
        seen, total = node.weight if node is not None else (frozenset(), np.zeros(2))
        for node in reversed(todo):
            new = {f for f in node.added() if f in self.features} - seen
            if new:
                seen, total = seen | new, sum((self.features[f] for f in sorted(new)), total)
            node.weight = (seen, total)
        return seen, total

    def emissions(self, blocks: list[Block]) -> np.ndarray:
        """Scores of each block's labels; nodes keep their sums, so those of
        one model only."""
        out = np.zeros((len(blocks), 2))
        for i, b in enumerate(blocks):
            out[i] = self.path_weight(b.path)[1]
            for f in [*b.path.last(), *text_features(b, i, len(blocks))]:
                w = self.features.get(f)
                if w is not None:
                    out[i] += w
        return out

    def main_text(self, html: str | None, paths: Paths | None = None) -> str:
        blocks = blocks_of(html, paths) if html else []
        labels = self.decode(self.emissions(blocks))
        return "\n\n".join(b.text for b, label in zip(blocks, labels, strict=True) if label)


def labelled_blocks(page: str) -> tuple[list[Block], list[int]]:
    """A labelled page's blocks without the marks, and their labels."""
    blocks = blocks_of(page)
    labels = [int(MARK in b.text) for b in blocks]
    return [Block(b.path, b.text.replace(MARK, ""), b.linked) for b in blocks], labels


def train(pages: list[str], rounds: int = 150, penalty: float = 0.02, rate: float = 0.08) -> Crf:
    """Fit by Adam to the mean log-likelihood of the pages' labels less a
    quadratic penalty."""
    data = [x for x in map(labelled_blocks, pages) if x[0]]
    index: dict[str, int] = {}
    rows, columns, longest = [], [], max(len(b) for b, _ in data)
    gold = np.full((len(data), longest), -1)
    for p, (blocks, labels) in enumerate(data):
        gold[p, : len(labels)] = labels
        for i, b in enumerate(blocks):
            for f in [*path_features(b.path), *text_features(b, i, len(blocks))]:
                rows.append(p * longest + i)
                columns.append(index.setdefault(f, len(index)))
    x = np.zeros((len(data) * longest, len(index)))
    x[rows, columns] = 1
    there, size = gold >= 0, (gold >= 0).sum(axis=1)
    own = np.arange(len(data))
    hot = np.where(there[:, :, None], np.eye(2)[np.maximum(gold, 0)], 0)
    pairs = np.einsum("pia,pib->ab", hot[:, :-1], hot[:, 1:])
    edges = np.stack([hot[:, 0].sum(axis=0), hot[own, size - 1].sum(axis=0)])
    w = [np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros((2, 2))]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    add = np.logaddexp
    for t in range(1, rounds + 1):
        e = (x @ w[0]).reshape(len(data), longest, 2)
        ahead, behind = np.zeros_like(e), np.zeros_like(e)
        ahead[:, 0] = e[:, 0] + w[2][0]
        for i in range(1, longest):
            step = ahead[:, i - 1, :, None] + w[1]
            ahead[:, i] = np.where(there[:, i, None], add(step[:, 0], step[:, 1]) + e[:, i], ahead[:, i - 1])
        behind[own, size - 1] = w[2][1]
        for i in range(longest - 2, -1, -1):
            step = w[1] + (e[:, i + 1] + behind[:, i + 1])[:, None, :]
            behind[:, i] = np.where((i < size - 1)[:, None], add(step[:, :, 0], step[:, :, 1]), behind[:, i])
        total = add(*(ahead[own, size - 1] + w[2][1]).T)
        marginal = np.where(there[:, :, None], np.exp(ahead + behind - total[:, None, None]), 0)
        both = ahead[:, :-1, :, None] + w[1] + (e[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        both = np.where(there[:, 1:, None, None], np.exp(np.minimum(both, 0)), 0)
        grads = [
            x.T @ (marginal - hot).reshape(-1, 2),
            both.sum(axis=(0, 1)) - pairs,
            np.stack([marginal[:, 0].sum(axis=0), marginal[own, size - 1].sum(axis=0)]) - edges,
        ]
        for k, g in enumerate(grads):
            g = g / len(data) + penalty / len(data) * w[k] * 10
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] = w[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return Crf({f: w[0][i] for f, i in index.items()}, w[1], w[2])


def extract(pages: DataFrame, model: Crf | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    prepare(pages.sparkSession)
    model = model or train(labelled_pages())
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, paths = shared.value, Paths()
        for batch in batches:
            for first, end in text_slices(batch.column(2), SLICE_BYTES):
                part = batch.slice(first, end - first)
                texts = [own.main_text(x, paths) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    read = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return read.mapInArrow(run, "page_id long, url string, text string").withColumn("n_chars", F.char_length("text").cast("long"))
