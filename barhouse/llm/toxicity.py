"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Each word goes in as a learned vector of the word and learned vectors of its character
n-grams. The network reads windows of words that overlap; a document is as toxic as its
worst window. It is trained in numpy on a bounded sample of labelled rows, each document
teaching through the window that scores highest, and is small enough to send to every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from barhouse.llm.common import chunks
from barhouse.llm.letters import Words, words_of

# The network is trained on about so many documents of each label, picked by a hash of the id;
# a longer text teaches in pieces.
ROWS_PER_LABEL = 2000
TRAIN_CHARS = 100_000
WINDOW, STRIDE = 32, 24
WORD_BUCKETS, GRAM_BUCKETS = 1 << 15, 1 << 16
WORD_SIZE, GRAM_SIZE, HIDDEN = 4, 8, 8
EPOCHS = 18
# Epochs between choices of the window that a document teaches through.
CHOOSE = 3
BATCH = 2048
CHUNK_CHARS = 1 << 20
THRESHOLD = 0.3


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


@dataclass
class Text:
    """Texts as distinct words, where each of them stands, and windows over them."""

    word: np.ndarray  # bucket of each distinct word
    gram: np.ndarray  # buckets of its n-grams, word by word
    grams: np.ndarray  # how many each word has
    index: np.ndarray  # (windows, WINDOW): distinct word, or -1 past the end
    doc: np.ndarray  # document of each window

    def part(self, rows: np.ndarray) -> Text:
        """Some of the windows, with no more words than they hold."""
        index = self.index[rows]
        used, inverse = np.unique(index, return_inverse=True)
        inverse = inverse.reshape(index.shape)
        if len(used) and used[0] < 0:
            used, inverse = used[1:], inverse - 1
        n = self.grams[used]
        starts = (np.cumsum(self.grams) - self.grams)[used]
        places = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return Text(self.word[used], self.gram[places], n, inverse, self.doc[rows])


def read(texts: list[str | None]) -> Text:
    words: Words = words_of(texts)
    distinct, first, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
    kinds = words.take(first)
    gram = np.zeros(0, np.int64)
    if len(first):
        letters = np.repeat(np.arange(len(first)), kinds.lengths)
        order = np.argsort(np.tile(letters, 3), kind="stable")
        gram = np.concatenate([kinds.grams(GRAM_BUCKETS, n) for n in (3, 4, 5)])[order]
    counts = words.counts
    windows = np.where(counts > 0, 1 + -(-np.maximum(counts - WINDOW, 0) // STRIDE), 0)
    doc = np.repeat(np.arange(len(texts)), windows)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows)
    # The last window of a text ends where the text ends.
    start = np.minimum(nth * STRIDE, np.maximum(counts[doc] - WINDOW, 0))
    step = start[:, None] + np.arange(WINDOW)
    base = (np.cumsum(counts) - counts)[doc][:, None]
    inside = step < counts[doc][:, None]
    index = np.full(step.shape, -1, np.int64)
    index[inside] = inverse[(base + step)[inside]]
    return Text((distinct % np.uint64(WORD_BUCKETS)).astype(np.int64), gram, 3 * kinds.lengths, index, doc)


@dataclass
class Network:
    """All weights by name; the two directions are stacked in the first axis."""

    w: dict[str, np.ndarray] = field(default_factory=dict)
    shift: float = 0.0

    @staticmethod
    def fresh(seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        size = WORD_SIZE + GRAM_SIZE
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        w = {
            "word": np.zeros((WORD_BUCKETS, WORD_SIZE), np.float32),
            "gram": np.zeros((GRAM_BUCKETS, GRAM_SIZE), np.float32),
            "in": draw(2, size, 3 * HIDDEN, scale=0.3),
            "bias": np.zeros((2, 1, 3 * HIDDEN), np.float32),
            "back": draw(2, HIDDEN, 3 * HIDDEN, scale=0.2),
            "look": draw(2, HIDDEN, scale=0.3),
            "out": draw(2, HIDDEN, scale=0.3),
            "out0": np.zeros(1, np.float32),
        }
        return Network(w)

    def inputs(self, text: Text, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Vector of each distinct word, and what the gates get from it; the last row is that of no word.

        Words that aren't ``known`` go in by their characters alone.
        """
        words = self.w["word"][text.word]
        if known is not None:
            words = words * known[:, None]
        sums = np.zeros((0, GRAM_SIZE), np.float32)
        if len(text.word):
            sums = np.add.reduceat(self.w["gram"][text.gram], np.cumsum(text.grams) - text.grams, axis=0)
        vector = np.concatenate([words, np.tanh(sums)], axis=1)
        vector = np.concatenate([vector, np.zeros((1, vector.shape[1]), np.float32)])
        return vector, vector @ self.w["in"] + self.w["bias"]

    def forward(self, index: np.ndarray, given: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """Logit of each window, and if asked for what backpropagation needs; given: gate inputs of the distinct words."""
        n, steps, h = len(index), index.shape[1], HIDDEN
        both = np.stack([index, index[:, ::-1]])
        mask = (both >= 0).astype(np.float32)[..., None]
        state = np.zeros((2, n, h), np.float32)
        kept = {"state": [state], "r": [], "z": [], "c": [], "u": []}
        side = np.array([0, 1])[:, None]
        for t in range(steps):
            x = given[side, both[:, :, t]]
            u = state @ self.w["back"]
            rz = sigmoid(x[..., : 2 * h] + u[..., : 2 * h])
            r, z = rz[..., :h], rz[..., h:]
            c = np.tanh(x[..., 2 * h :] + r * u[..., 2 * h :])
            m = mask[:, :, t]
            state = m * ((1 - z) * c + z * state) + (1 - m) * state
            kept["state"].append(state)
            if keep:
                for name, value in (("r", r), ("z", z), ("c", c), ("u", u[..., 2 * h :])):
                    kept[name].append(value)
        states = np.stack(kept["state"][1:], axis=2)
        # Both directions' states of a word stand at the word's place.
        states = np.stack([states[0], states[1][:, ::-1]])
        seen = mask[0][..., 0]
        look = np.einsum("dnth,dh->nt", states, self.w["look"]) - 1e9 * (1 - seen)
        weight = np.exp(look - look.max(axis=1, keepdims=True))
        weight /= weight.sum(axis=1, keepdims=True)
        value = np.einsum("dnth,dh->nt", states, self.w["out"])
        logit = (weight * value).sum(axis=1) + self.w["out0"][0]
        return logit, {**kept, "both": both, "mask": mask, "states": states, "weight": weight, "value": value}

    def scores(self, text: Text) -> np.ndarray:
        """Logit of every window."""
        _, given = self.inputs(text)
        out = [self.forward(text.index[k : k + BATCH], given)[0] for k in range(0, len(text.index), BATCH)]
        return np.concatenate(out) if out else np.zeros(0, np.float32)

    def gradients(self, text: Text, label: np.ndarray, cost: np.ndarray, known: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted cross-entropy of all windows of ``text``, by backpropagation through time."""
        vector, given = self.inputs(text, known)
        logit, kept = self.forward(text.index, given, keep=True)
        g = {k: np.zeros_like(v) for k, v in self.w.items()}
        d = ((sigmoid(logit) - label) * cost / cost.sum()).astype(np.float32)
        g["out0"][0] = d.sum()
        weight, value, states = kept["weight"], kept["value"], kept["states"]
        dvalue = d[:, None] * weight
        dlook = dvalue * (value - (weight * value).sum(axis=1, keepdims=True))
        g["out"] = np.einsum("nt,dnth->dh", dvalue, states)
        g["look"] = np.einsum("nt,dnth->dh", dlook, states)
        dstates = np.einsum("nt,dh->dnth", dvalue, self.w["out"]) + np.einsum("nt,dh->dnth", dlook, self.w["look"])
        dstates = np.stack([dstates[0], dstates[1][:, ::-1]])
        both, mask = kept["both"], kept["mask"]
        dgiven = np.zeros_like(given)
        down = np.zeros_like(kept["state"][0])
        for t in reversed(range(both.shape[2])):
            m, r, z, c, u = mask[:, :, t], kept["r"][t], kept["z"][t], kept["c"][t], kept["u"][t]
            before = kept["state"][t]
            down = down + dstates[:, :, t]
            live = m * down
            dc = live * (1 - z) * (1 - c * c)
            dz = live * (before - c) * z * (1 - z)
            dr = dc * u * r * (1 - r)
            dx = np.concatenate([dr, dz, dc], axis=2)
            du = np.concatenate([dr, dz, dc * r], axis=2)
            g["back"] += np.swapaxes(before, 1, 2) @ du
            down = (1 - m) * down + live * z + du @ np.swapaxes(self.w["back"], 1, 2)
            for s in (0, 1):
                np.add.at(dgiven[s], both[s, :, t], dx[s])
        dgiven[:, -1] = 0
        g["bias"] = dgiven.sum(axis=1, keepdims=True)
        g["in"] = vector.T @ dgiven
        dvector = (dgiven @ np.swapaxes(self.w["in"], 1, 2)).sum(axis=0)[:-1]
        np.add.at(g["word"], text.word, dvector[:, :WORD_SIZE] * known[:, None])
        dsums = dvector[:, WORD_SIZE:] * (1 - vector[:-1, WORD_SIZE:] ** 2)
        np.add.at(g["gram"], text.gram, np.repeat(dsums, text.grams, axis=0))
        return g


def _evidence(text: Text, own: np.ndarray, label: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For word and n-gram buckets: log-odds of label 1 for documents that hold one, in standard errors
    beyond two; and where there are documents to tell. Goes through some documents at a time."""
    sums = {"word": np.zeros((2, WORD_BUCKETS)), "gram": np.zeros((2, GRAM_BUCKETS))}
    rows = np.flatnonzero(own)
    for k in range(0, len(label), 100):
        some = text.part(rows[(text.doc[rows] >= k) & (text.doc[rows] < k + 100)])
        pairs = np.unique(some.index * 100 + (some.doc - k)[:, None])
        pairs = pairs[pairs >= 0]
        word, doc = pairs // 100, pairs % 100
        spread = some.grams[word]
        starts = (np.cumsum(some.grams) - some.grams)[word]
        places = np.repeat(starts - (np.cumsum(spread) - spread), spread) + np.arange(spread.sum())
        for name, bucket, of in (("word", some.word[word], doc), ("gram", some.gram[places], np.repeat(doc, spread))):
            held = np.unique(bucket * 100 + of)
            toxic = label[k + held % 100].astype(np.int64)
            np.add.at(sums[name], (toxic, held // 100), 1)
    docs = np.unique(text.doc[own])
    ones = label[docs].sum()
    out = {}
    for name, (zero, one) in sums.items():
        odds = np.log((one + 0.5) / (ones + 1)) - np.log((zero + 0.5) / (len(docs) - ones + 1))
        z = odds / np.sqrt(1 / (one + 0.5) + 1 / (zero + 0.5))
        out[name] = np.sign(z) * np.clip(np.abs(z) - 2, 0, 3), zero + one >= 3
    return out


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 5) -> Network:
    """Fit on texts that are held in memory. The first coordinates start from evidence by counts, so that few epochs do.

    Half of a batch's words go in by their characters alone, so that unseen words are learned too. A fifth of
    the documents is kept apart to set the shift that puts the best threshold at ``THRESHOLD``.
    """
    net = Network.fresh(seed)
    label = np.array(labels, np.float32)
    if not len(label) or label.min() == label.max():
        net.shift = -12.0 if not len(label) or label.max() < 1 else 12.0
        return net
    rng = np.random.default_rng(seed)
    text = read(texts)
    apart = rng.random(len(label)) < 0.2
    own = ~apart[text.doc]
    for name, (evidence, held) in _evidence(text, own, label).items():
        net.w[name][:, 0] = evidence * held / 2
        net.w[name][:, 1:] = rng.normal(0, 0.05, net.w[name][:, 1:].shape) * held[:, None]
    for row in (0, WORD_SIZE):
        net.w["in"][:, row, 2 * HIDDEN :] = np.abs(net.w["in"][:, row, 2 * HIDDEN :])
    net.w["out"], net.w["look"] = np.abs(net.w["out"]), np.abs(net.w["look"])
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.w.items()}
    balance = np.where(label > 0, 0.5 / max(label[~apart].sum(), 1), 0.5 / max((1 - label[~apart]).sum(), 1))
    step = 0
    for epoch in range(epochs):
        if epoch % CHOOSE == 0:
            top = _best_window(net.scores(text), text.doc, len(label))
            top = top[(top >= 0) & ~apart]
        rng.shuffle(top)
        for rows in np.array_split(top, max(1, len(top) // 256)):
            part = text.part(rows)
            known = (rng.random(len(part.word)) < 0.5).astype(np.float32)
            grads = net.gradients(part, label[part.doc], balance[part.doc].astype(np.float32), known)
            step += 1
            for k, g in grads.items():
                a, b = moment[k]
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                rate = 0.02 * min(1.0, 2 * (1 - epoch / epochs))
                net.w[k] -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-6)
    net.shift = _shift(_document_logits(net, text, len(label)), label, apart)
    return net


def _best_window(logit: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """The highest window of each document; -1 for one without words."""
    order = np.lexsort((logit, doc))
    last = np.flatnonzero(np.diff(doc[order], append=-1))
    out = np.full(docs, -1)
    out[doc[order][last]] = order[last]
    return out


def _document_logits(net: Network, text: Text, docs: int) -> np.ndarray:
    out = np.full(docs, -30.0)
    np.maximum.at(out, text.doc, net.scores(text))
    return out


def _shift(logit: np.ndarray, label: np.ndarray, apart: np.ndarray) -> float:
    """So that logits above the best cut for F1 score at least ``THRESHOLD``; the middle of equally good cuts."""
    use = apart if label[apart].sum() >= 20 and (1 - label[apart]).sum() >= 20 else np.ones_like(apart)
    x, y = logit[use], label[use]
    order = np.argsort(-x, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(x) + 1) + y.sum())
    k = int(np.argmax(f1))
    cut = (x[order][k] + x[order][min(k + 1, len(x) - 1)]) / 2
    return float(np.log(THRESHOLD / (1 - THRESHOLD)) - cut)


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_LABEL, epochs: int = EPOCHS) -> Network:
    """Train on documents (doc_id, text) that ``labels`` (doc_id, toxic) marks, about ``rows`` of each label.

    Nulls are left out; copies of a labelled text teach once. Texts of over ``TRAIN_CHARS`` characters
    teach in pieces of that length, each with the document's label. Labels are sampled first: what is
    sent to every task, and then to the driver, are no more than the sample's ids and texts.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").select("doc_id", "toxic").distinct()
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, rows / sizes.get(1, 1))).otherwise(min(1.0, rows / sizes.get(0, 1)))
    draw = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 20)) / (1 << 20)
    sample = docs.where("text is not null").join(F.broadcast(known.where(draw < share)), "doc_id").select("doc_id", "text", "toxic")
    pieces = F.sequence(F.lit(0), F.greatest(F.ceil(F.length("text") / TRAIN_CHARS).cast("int") - 1, F.lit(0)))
    cut = sample.select("doc_id", "toxic", "text", F.explode(pieces).alias("piece"))
    text = F.substring("text", F.col("piece") * TRAIN_CHARS + 1, F.lit(TRAIN_CHARS)).alias("text")
    alone = cut.select("doc_id", "toxic", "piece", text).groupBy("text", "toxic").agg(F.min(F.struct("doc_id", "piece")).alias("at"))
    got = alone.select("at.doc_id", "at.piece", "text", "toxic").toPandas().sort_values(["doc_id", "piece", "text"])
    return train(list(got["text"]), list(got["toxic"]), epochs)


def score(net: Network, text: Column | str = "text") -> Column:
    """The score of each whole text, from 0 to 1: that of its highest window, however long the text. Null texts and those without a letter score 0."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            listed = [None if t is None or t != t else t for t in batch]
            out = []
            for a, b in chunks([len(t or "") for t in listed], CHUNK_CHARS):
                logit = _document_logits(net, read(listed[a:b]), b - a)
                out.append(np.where(logit > -30.0, sigmoid(np.clip(logit + net.shift, -40, 40)), 0.0))
            yield pd.Series(np.concatenate(out) if out else [])

    return scored(text)
