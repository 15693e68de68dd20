"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is read as overlapping windows of words.  A word enters as the sum of a
hashed word vector and the scaled sum of hashed vectors of its
character n-grams and beginnings; two gated
recurrent layers (one in each direction) run over the window, attention pools
their states, and a logistic unit scores the pooled vector.  A document's score is
that of its highest window; every window of the whole text is scored.

The network is trained in numpy on a bounded sample of labelled documents
(``max_toxic`` and ``max_clean`` rows of at most ``max_chars`` characters,
chosen by a hash of the id).  Labels belong to documents, so training is by
multiple instances: the highest windows of a document carry its label.  The
parameters (a few MB whatever the input) are broadcast; scoring is one pass
over the texts without a shuffle.

Defined cases: null and empty texts have one window without words and are
scored by the bias; labels that are null or belong to no document are ignored,
and of repeated labels of a document the largest counts; equal texts have equal
scores; an empty table gives an empty result; further columns are kept by
``drop_toxic`` and not read by ``score``.  Without a toxic and a clean training
row the network keeps its initial weights and a bias that scores below 0.5.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoengine.llm._util import prepare, text_bytes, text_slices, tidy
from recoengine.llm._words import BYTE_STEP, FOLDED, U, Words, mix, prefix_sums, stretches

#: Text read at a time in scoring and in training: a worker holds many times their bytes beside them.
SLICE_BYTES, TRAINING_SLICE_BYTES = 512 << 10, 1 << 20
#: Words whose n-gram vectors are gathered at a time.
VECTOR_WORDS = 1 << 14
BATCH_WINDOWS = 2048
#: Bytes that part words here: ASCII other than letters and digits.
APART = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


@dataclass
class Settings:
    window: int = 64
    step: int = 48
    vector: int = 16
    hidden: int = 10
    attention: int = 12
    word_rows: int = 1 << 15
    gram_rows: int = 1 << 16
    grams: tuple[int, ...] = (3, 4)
    ends: tuple[int, ...] = (3, 4, 5, 6, 7, 8)
    word_dropout: float = 0.5
    rounds: int = 400
    documents: int = 32
    seed: int = 11
    rate: float = 0.03
    max_windows: int = 16  # of one document in one training round


@dataclass
class Vocabulary:
    """Distinct words: rows of the word table, and those of their n-grams."""

    word: np.ndarray
    gram: np.ndarray
    gram_off: np.ndarray

    def take(self, which: np.ndarray) -> Vocabulary:
        size = np.diff(self.gram_off)[which]
        off = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.gram_off[which] - off[:-1], size) + np.arange(off[-1])
        return Vocabulary(self.word[which], self.gram[at], off)


def read_words(buf: np.ndarray, off: np.ndarray, s: Settings) -> tuple[Vocabulary, np.ndarray, np.ndarray]:
    """The vocabulary of some texts, each word's place in it, and the offsets
    of the texts into the words."""
    words = Words(buf, off, APART)
    sums = prefix_sums(FOLDED[buf], BYTE_STEP)
    length = words.end - words.start
    hashes = mix(stretches(sums, BYTE_STEP, words.start, words.end) + length.astype(np.uint64))
    distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    start, end = words.start[first], words.end[first]
    # n-grams of the bytes of each distinct word, and its beginnings
    found, owner = [], []
    for n in s.grams:
        count = np.maximum(end - start - n + 1, 0)
        own = np.repeat(np.arange(len(start)), count)
        at = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count) + start[own]
        found.append(mix(stretches(sums, BYTE_STEP, at, at + n) + U(n)))
        owner.append(own)
    for n in s.ends:
        own = np.flatnonzero(end - start >= n)
        found.append(mix(stretches(sums, BYTE_STEP, start[own], start[own] + n) + U(100 + n)))
        owner.append(own)
    own = np.concatenate(owner) if owner else np.zeros(0, np.int64)
    by = np.argsort(own, kind="stable")
    gram = (np.concatenate(found)[by] % U(s.gram_rows)).astype(np.int64)
    gram_off = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(distinct)))])
    return Vocabulary((distinct % U(s.word_rows)).astype(np.int64), gram, gram_off), place, words.off


def read_slices(texts: list[str], s: Settings) -> tuple[Vocabulary, np.ndarray, np.ndarray]:
    """As :func:`read_words`, a slice of the texts at a time (a word may then
    stand in the vocabulary several times)."""
    raw, parts, first, size = [t.encode() for t in texts], [], 0, 0
    for i, x in enumerate(raw):
        size += len(x)
        if size >= TRAINING_SLICE_BYTES or i == len(raw) - 1:
            own = raw[first : i + 1]
            parts.append(read_words(np.frombuffer(b"".join(own), np.uint8), np.concatenate([[0], np.cumsum([len(y) for y in own])]), s))
            first, size = i + 1, 0
    word, gram, gram_off, place, off = [], [], [np.zeros(1, np.int64)], [], [np.zeros(1, np.int64)]
    for vocabulary, at, own_off in parts:
        place.append((at + sum(map(len, word))).astype(np.int32))
        word.append(vocabulary.word)
        gram.append(vocabulary.gram.astype(np.int32))
        gram_off.append(vocabulary.gram_off[1:] + gram_off[-1][-1])
        off.append(own_off[1:] + off[-1][-1])
    return Vocabulary(np.concatenate(word), np.concatenate(gram), np.concatenate(gram_off)), np.concatenate(place), np.concatenate(off)


def windows_of(counts: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word in it, length) of all windows; they overlap by
    window - step words and the last one may be shorter."""
    n = np.maximum(1, -(-(counts - (s.window - s.step)) // s.step))
    n[counts <= s.window] = 1
    text = np.repeat(np.arange(len(counts)), n)
    first = (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * s.step
    return text, first, np.minimum(counts[text] - first, s.window)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def start_parameters(s: Settings) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(s.seed)
    h, d, a = s.hidden, s.vector, s.attention
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    return {
        "word": draw(s.word_rows, d, scale=0.05),
        "gram": draw(s.gram_rows, d, scale=0.1),
        "W": draw(d, 6 * h, scale=d**-0.5),
        "b": np.zeros(6 * h, np.float32),
        "U0": draw(h, 3 * h, scale=h**-0.5),
        "U1": draw(h, 3 * h, scale=h**-0.5),
        "c0": np.zeros(h, np.float32),
        "c1": np.zeros(h, np.float32),
        "A": draw(2 * h, a, scale=(2 * h) ** -0.5),
        "Ab": np.zeros(a, np.float32),
        "v": draw(a, scale=a**-0.5),
        "w": draw(2 * h, scale=(2 * h) ** -0.5),
        "o": np.full(1, -2.0, np.float32),
    }


@dataclass
class Network:
    s: Settings
    p: dict[str, np.ndarray] = field(default_factory=dict)

    def vectors(self, vocabulary: Vocabulary, kept: np.ndarray | None = None) -> np.ndarray:
        """Of each word; ``kept`` scales the word's own part in training."""
        p, size = self.p, np.diff(vocabulary.gram_off)
        x = p["word"][vocabulary.word]
        if kept is not None:
            x *= kept[:, None]
        off = vocabulary.gram_off
        for first in range(0, len(x), VECTOR_WORDS):
            some = first + np.flatnonzero(size[first : first + VECTOR_WORDS])
            if len(some):
                grams = p["gram"][vocabulary.gram[off[some[0]] : off[some[-1] + 1]]]
                x[some] += np.add.reduceat(grams, off[some] - off[some[0]], axis=0) / np.sqrt(size[some, None]).astype(np.float32)
        return x

    def _run(self, x: np.ndarray, rows: np.ndarray, direction: int, keep: list | None) -> np.ndarray:
        """States (time, window, hidden) of one direction.  ``x``: inputs of
        all gates (time, window, 3 * hidden); ``rows``: how many windows, the
        longest first, reach each time."""
        h, p = self.s.hidden, self.p
        Un, c = p[f"U{direction}"], p[f"c{direction}"]
        out = np.zeros((*x.shape[:2], h), np.float32)
        state = np.zeros((x.shape[1], h), np.float32)
        for t in range(len(x)) if direction == 0 else range(len(x) - 1, -1, -1):
            k = rows[t]
            old = state[:k]
            inner = old @ Un
            gates = sigmoid(x[t, :k, : 2 * h] + inner[:, : 2 * h])
            r, z = gates[:, :h], gates[:, h:]
            hid = inner[:, 2 * h :] + c
            n = np.tanh(x[t, :k, 2 * h :] + r * hid)
            new = n + z * (old - n)
            if keep is not None:
                keep.append((t, k, old.copy(), r, z, hid, n))
            state[:k] = new
            out[t, :k] = new
        return out

    def forward(self, inputs: np.ndarray, place: np.ndarray, lengths: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows, the longest first.  ``inputs``: gate inputs by
        distinct word; ``place``: (time, window) words."""
        h, p = self.s.hidden, self.p
        rows = np.searchsorted(-lengths, -np.arange(len(place)), side="left")
        x = inputs[place]
        kept = ([], []) if keep is not None else (None, None)
        states = np.concatenate([self._run(x[:, :, : 3 * h], rows, 0, kept[0]), self._run(x[:, :, 3 * h :], rows, 1, kept[1])], axis=2)
        shown = np.tanh(states @ p["A"] + p["Ab"])
        weight = shown @ p["v"]
        weight = np.where(np.arange(len(place))[:, None] < lengths, weight, np.float32(-1e9))
        weight = np.exp(weight - weight.max(axis=0, initial=-1e9))
        weight = np.where(lengths > 0, weight / np.maximum(weight.sum(axis=0), np.float32(1e-9)), np.float32(0)).astype(np.float32)
        pooled = np.einsum("tb,tbh->bh", weight, states)
        if keep is not None:
            keep.update(kept=kept, states=states, shown=shown, weight=weight, pooled=pooled, x_shape=x.shape)
        return pooled @ p["w"] + p["o"][0]

    def backward(self, keep: dict, slope: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the dense parameters, and of the gate inputs."""
        h, p = self.s.hidden, self.p
        weight, states, shown = keep["weight"], keep["states"], keep["shown"]
        g = {"w": keep["pooled"].T @ slope, "o": slope.sum(keepdims=True)}
        d_pooled = slope[:, None] * p["w"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = np.einsum("tbh,bh->tb", states, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["v"] = np.einsum("tb,tba->a", d_score, shown)
        d_in = d_score[:, :, None] * p["v"] * (1 - shown * shown)
        g["A"] = np.einsum("tbh,tba->ha", states, d_in)
        g["Ab"] = d_in.sum(axis=(0, 1))
        d_states += d_in @ p["A"].T
        d_x = np.zeros(keep["x_shape"], np.float32)
        for direction in (0, 1):
            Un = p[f"U{direction}"]
            d_Un, d_c = np.zeros_like(Un), np.zeros_like(p[f"c{direction}"])
            carry = np.zeros((d_x.shape[1], h), np.float32)
            for t, k, old, r, z, hid, n in reversed(keep["kept"][direction]):
                d = carry[:k] + d_states[t, :k, direction * h : (direction + 1) * h]
                d_n = d * (1 - z) * (1 - n * n)
                d_z = d * (old - n) * z * (1 - z)
                d_r = d_n * hid * r * (1 - r)
                d_gates = np.concatenate([d_r, d_z, d_n * r], axis=1)
                d_x[t, :k, 3 * h * direction : 3 * h * direction + 2 * h] = d_gates[:, : 2 * h]
                d_x[t, :k, 3 * h * direction + 2 * h : 3 * h * (direction + 1)] = d_n
                d_Un += old.T @ d_gates
                d_c += d_gates[:, 2 * h :].sum(axis=0)
                carry[:k] = d * z + d_gates @ Un.T
            g[f"U{direction}"], g[f"c{direction}"] = d_Un, d_c
        return g, d_x

    def document_logits(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The highest window's logit of each text."""
        s = self.s
        vocabulary, place, word_off = read_words(buf, off, s)
        inputs = self.vectors(vocabulary) @ self.p["W"] + self.p["b"]
        text, first, length = windows_of(np.diff(word_off), s)
        out = np.full(len(off) - 1, -np.inf, np.float32)
        order = np.argsort(-length, kind="stable")
        place = np.append(place, np.zeros(s.window, np.int64))
        inputs = inputs if len(inputs) else np.zeros((1, 6 * s.hidden), np.float32)
        for i in range(0, len(order), BATCH_WINDOWS):
            own = order[i : i + BATCH_WINDOWS]
            times = np.arange(max(1, length[own[0]]))
            logits = self.forward(inputs, place[(word_off[text[own]] + first[own]) + times[:, None]], length[own])
            np.maximum.at(out, text[own], logits)
        return out


class Adam:
    def __init__(self, rate: float):
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def update(self, p: dict[str, np.ndarray], g: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, x in g.items():
            m = self.m[k] = 0.9 * self.m.get(k, 0) + 0.1 * x
            v = self.v[k] = 0.999 * self.v.get(k, 0) + 0.001 * x * x
            p[k] -= (self.rate * m / (1 - 0.9**self.t) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)).astype(np.float32)


def _row_step(table: np.ndarray, squares: np.ndarray, rows: np.ndarray, grads: np.ndarray, rate: float) -> None:
    """Adagrad on the rows of an embedding table that occur."""
    order = np.argsort(rows, kind="stable")
    ids, first = np.unique(rows[order], return_index=True)
    total = np.add.reduceat(grads[order], first, axis=0)
    squares[ids] += (total * total).mean(axis=1)
    table[ids] -= rate * total / (np.sqrt(squares[ids]) + 1e-6)[:, None]


def train(texts: list[str], labels: np.ndarray, s: Settings | None = None) -> Network:
    """Fit the network to labelled texts (1: toxic)."""
    s = s or Settings()
    net = Network(s, start_parameters(s))
    kinds = [np.flatnonzero(labels == 0), np.flatnonzero(labels == 1)]
    if not len(kinds[0]) or not len(kinds[1]):
        return net
    vocabulary, place, word_off = read_slices(texts, s)
    text, first, length = windows_of(np.diff(word_off), s)
    window_off = np.searchsorted(text, np.arange(len(texts) + 1))
    place = np.append(place, np.zeros(s.window, place.dtype))
    rng = np.random.default_rng(s.seed)
    adam = Adam(s.rate)
    squares = {"word": np.full(s.word_rows, 1e-4, np.float32), "gram": np.full(s.gram_rows, 1e-4, np.float32)}
    queues: list[list[int]] = [[], []]

    def draw(kind: int, n: int) -> list[int]:
        while len(queues[kind]) < n:
            queues[kind] += rng.permutation(kinds[kind]).tolist()
        out, queues[kind] = queues[kind][:n], queues[kind][n:]
        return out

    def prepared(own: np.ndarray):
        own = own[np.argsort(-length[own], kind="stable")]
        at = place[(word_off[text[own]] + first[own]) + np.arange(max(1, length[own].max()))[:, None]]
        used, local = np.unique(at, return_inverse=True)
        part = vocabulary.take(used)
        kept = (rng.random(len(used)) >= s.word_dropout).astype(np.float32) / np.float32(1 - s.word_dropout)
        x = net.vectors(part, kept)
        return own, local.reshape(at.shape), part, kept, x, x @ net.p["W"] + net.p["b"]

    half = s.documents // 2
    for turn in range(s.rounds):
        docs = draw(0, half) + draw(1, half)
        own = []
        for d in docs:
            w = np.arange(window_off[d], window_off[d + 1])
            own.append(w if len(w) <= s.max_windows else np.sort(rng.choice(w, s.max_windows, replace=False)))
        own, at, _, _, _, inputs = prepared(np.concatenate(own))
        logits = net.forward(inputs, at, length[own])
        # the highest window of each document; at first another one of it, and for clean documents always
        picked = []
        for d in docs:
            mine = np.flatnonzero(text[own] == d)
            best = mine[np.argsort(-logits[mine], kind="stable")]
            picked += best[: 1 if labels[d] and turn > s.rounds // 4 else 3].tolist()
        own, at, part, kept, x, inputs = prepared(own[np.array(sorted(set(picked)))])
        keep: dict = {}
        logits = net.forward(inputs, at, length[own], keep)
        y = labels[text[own]].astype(np.float32)
        balance = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
        slope = ((sigmoid(logits) - y) * balance).astype(np.float32)
        g, d_x = net.backward(keep, slope)
        # gather the gate inputs' gradients by distinct word; padding has none
        flat = at.ravel()
        order = np.argsort(flat, kind="stable")
        ids, begin = np.unique(flat[order], return_index=True)
        d_inputs = np.zeros_like(inputs)
        d_inputs[ids] = np.add.reduceat(d_x.reshape(-1, d_x.shape[2])[order], begin, axis=0)
        g["W"], g["b"] = x.T @ d_inputs, d_inputs.sum(axis=0)
        d_vector = d_inputs @ net.p["W"].T
        size = np.diff(part.gram_off)
        rate = s.rate * 6 * (1 - turn / s.rounds)
        adam.rate = s.rate * (1 - 0.9 * turn / s.rounds)
        _row_step(net.p["word"], squares["word"], part.word, d_vector * kept[:, None], rate)
        if len(part.gram):
            each = np.repeat(d_vector / np.sqrt(np.maximum(size, 1))[:, None].astype(np.float32), size, axis=0)
            _row_step(net.p["gram"], squares["gram"], part.gram, each, rate)
        adam.update(net.p, g)
    return net


def training_sample(docs: DataFrame, labels: DataFrame, max_toxic: int = 1200, max_clean: int = 2000, max_chars: int = 30_000, held_out_of: int = 5) -> DataFrame:
    """doc_id, text and toxic of at most max_toxic + max_clean labelled texts,
    chosen by a hash of the id, none of which is held out (crc32 of the id as
    text divisible by ``held_out_of``)."""
    known = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % held_out_of != 0)
    by = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = None
    for kind, n in ((1, max_toxic), (0, max_clean)):
        part = known.filter(F.col("toxic") == kind).orderBy(*by).limit(n)
        sample = part if sample is None else sample.unionByName(part)
    texts = docs.select("doc_id", "text").filter(f"text is not null and length(text) <= {max_chars}")
    # at most max_toxic + max_clean rows of two numbers are broadcast
    return texts.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic").distinct()


def trained_network(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, **sample) -> Network:
    """The network fitted to the training sample, in one task (the sample is
    bounded, whatever the input); only the parameters come to the driver."""
    s = settings or Settings()
    prepare(docs.sparkSession)

    def fit(frames):
        import pandas as pd

        rows = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "toxic": []}), *frames], ignore_index=True).sort_values(["doc_id", "text"], kind="stable")
        net = train(rows["text"].tolist(), rows["toxic"].to_numpy(np.int64), s)
        for name, p in net.p.items():
            yield pd.DataFrame({"name": [name], "shape": [list(p.shape)], "data": [p.astype("<f4").tobytes()]})

    found = training_sample(docs, labels, **sample).coalesce(1).mapInPandas(tidy(fit), "name string, shape array<int>, data binary").collect()  # some MB
    return Network(s, {r.name: np.frombuffer(r.data, "<f4").reshape(r.shape).copy() for r in found})


SCORES = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, net: Network, held_out_of: int = 5) -> DataFrame:
    """One row (``SCORES``) per document."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for first, end in text_slices(batch.column(1), SLICE_BYTES):
                buf, off = text_bytes(batch.column(1).slice(first, end - first))
                found = 1 / (1 + np.exp(-own.document_logits(buf, off).astype(np.float64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(found, pa.float64())], ["doc_id", "score"])

    scores = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidy(run), "doc_id long, score double")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % held_out_of == 0, F.lit(False))
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, net: Network) -> DataFrame:
    """The documents scored below 0.5, all columns as they were."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for first, end in text_slices(batch.column(at), SLICE_BYTES):
                part = batch.slice(first, end - first)
                logits = own.document_logits(*text_bytes(part.column(at)))
                yield part.filter(pa.array(logits < 0))

    return docs.mapInArrow(tidy(run), docs.schema)
