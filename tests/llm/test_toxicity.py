from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from barhouse.llm import toxicity
from barhouse.llm.common import remainder, table
from tests.llm.cases import ALL_IDS, awkward, clashing, empty, ids


def small(seed=1, docs=120):
    """Texts of which those with a word that begins with "bad" are labelled."""
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(docs):
        words = ["".join(rng.choices(["la", "no", "ti", "re", "mu"], k=rng.randint(1, 3))) for _ in range(rng.randint(1, 150))]
        if i % 3 == 0:
            words[rng.randrange(len(words))] = "bad" + rng.choice(["ly", "x", "oo", "ness", "am"])
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return texts, labels


def test_gradients_against_differences(monkeypatch):
    monkeypatch.setattr(toxicity, "WORD_BUCKETS", 64)
    monkeypatch.setattr(toxicity, "GRAM_BUCKETS", 128)
    rng = np.random.default_rng(0)
    net = toxicity.Network.fresh()
    net.w = {k: rng.normal(0, 0.4, (64, toxicity.WORD_SIZE) if k == "word" else (128, toxicity.GRAM_SIZE) if k == "gram" else v.shape) for k, v in net.w.items()}
    text = toxicity.read(["one two three one", "a " * 40 + "b", "x"])
    label, cost = np.array([1.0, 0.0, 1.0, 0.0])[: len(text.doc)], np.ones(len(text.doc))
    known = np.ones(len(text.word))

    def loss():
        _, given = net.inputs(text, known)
        logit = net.forward(text.index, given)[0]
        return float((np.logaddexp(0, logit) - label * logit).mean())

    grads = net.gradients(text, label, cost, known)
    for name, value in net.w.items():
        flat, g = value.reshape(-1), grads[name].reshape(-1)
        for k in {int(np.argmax(np.abs(g))), *rng.integers(0, flat.size, 4).tolist()}:
            old = flat[k]
            flat[k] = old + 1e-5
            up = loss()
            flat[k] = old - 1e-5
            down = loss()
            flat[k] = old
            assert g[k] == pytest.approx((up - down) / 2e-5, abs=2e-6), name


@pytest.mark.parametrize("words", [0, 1, 31, 32, 33, 57, 80, 1000])
def test_windows_overlap_and_cover_all(words):
    text = toxicity.read([" ".join(f"w{'a' * (i % 7)}" for i in range(words))])
    assert (text.index >= 0).any(axis=1).all()
    starts = [min(i * toxicity.STRIDE, max(words - toxicity.WINDOW, 0)) for i in range(len(text.index))]
    covered = {s + k for s, row in zip(starts, text.index, strict=True) for k in range(toxicity.WINDOW) if row[k] >= 0}
    assert covered == set(range(words))
    assert all(b - a <= toxicity.STRIDE for a, b in zip(starts, starts[1:], strict=False))


def test_learns_unseen_forms():
    texts, labels = small()
    net = toxicity.train(texts, labels)
    other, want = small(seed=2)
    logit = toxicity._document_logits(net, toxicity.read(other), len(other)) + net.shift
    assert np.mean((toxicity.sigmoid(logit) >= toxicity.THRESHOLD) == np.array(want)) > 0.95


M64 = 2**64 - 1
MIX, STEP = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def plain_word(word):
    """(word bucket, n-gram buckets) of a word, number by number."""
    total = 0
    for depth, c in enumerate(word):
        x = ((ord(c) + 1) * MIX + depth * STEP) & M64
        x = (x ^ (x >> 29)) * STEP & M64
        total = (total + (x ^ (x >> 32))) & M64
    grams = []
    padded = f" {word}" + " " * 5
    for i in range(len(word)):
        for size in (3, 4, 5):
            x = 0
            for c in padded[i : i + size]:
                x = (x ^ ord(c)) * MIX & M64
                x ^= x >> 31
            grams.append(((x * STEP & M64) >> 40) % toxicity.GRAM_BUCKETS)
    return total % toxicity.WORD_BUCKETS, grams


def plain_score(net, text):
    """The same network word by word, window by window."""
    w, h = {k: v.astype(float) for k, v in net.w.items()}, toxicity.HIDDEN
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    vectors = []
    for word in words:
        bucket, grams = plain_word(word)
        vectors.append(np.concatenate([w["word"][bucket], np.tanh(sum(w["gram"][g] for g in grams))]))
    best = None
    last = max(len(words) - toxicity.WINDOW, 0)
    for start in sorted({min(k, last) for k in range(0, last + toxicity.STRIDE, toxicity.STRIDE)}) if words else []:
        window = vectors[start : start + toxicity.WINDOW]
        states = []
        for side, order in ((0, window), (1, window[::-1])):
            state, out = np.zeros(h), []
            for x in order:
                given, u = x @ w["in"][side] + w["bias"][side][0], state @ w["back"][side]
                r, z = toxicity.sigmoid(given[:h] + u[:h]), toxicity.sigmoid(given[h : 2 * h] + u[h : 2 * h])
                state = (1 - z) * np.tanh(given[2 * h :] + r * u[2 * h :]) + z * state
                out.append(state)
            states.append(out if side == 0 else out[::-1])
        look = np.array([states[0][t] @ w["look"][0] + states[1][t] @ w["look"][1] for t in range(len(window))])
        weight = np.exp(look - look.max())
        value = np.array([states[0][t] @ w["out"][0] + states[1][t] @ w["out"][1] for t in range(len(window))])
        logit = (weight * value).sum() / weight.sum() + w["out0"][0]
        best = logit if best is None else max(best, logit)
    return 0.0 if best is None else float(toxicity.sigmoid(best + net.shift))


@pytest.mark.parametrize("parts", [1, 5])
def test_scores_word_by_word(spark, parts):
    """Whatever texts lie in a batch beside it, a text scores what it scores alone."""
    texts, labels = small(docs=60)
    net = toxicity.train(texts, labels, epochs=2)
    texts += [None, "", "12 !", "a", "Ünï çödé", "x" * 40, " ".join(f"badly {k} no" for k in range(100))]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(parts)
    got = {r["i"]: r["s"] for r in docs.select("i", toxicity.score(net).alias("s")).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx([plain_score(net, t) for t in texts], abs=1e-4)


def test_long_labelled_texts_teach(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(toxicity, "TRAIN_CHARS", 50)
    monkeypatch.setattr(toxicity, "train", lambda texts, labels, epochs: seen.update(zip(texts, labels, strict=True)))
    long = "".join(chr(97 + i % 26) for i in range(120))
    docs = spark.createDataFrame([(1, long), (2, "short"), (3, "short"), (4, None), (5, "")], "doc_id bigint, text string")
    toxicity.fit(docs, spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 1), (5, 0)], "doc_id bigint, toxic int"))
    assert seen == {long[:50]: 1, long[50:100]: 1, long[100:]: 1, "short": 0, "": 0}


def test_one_kind_of_label_or_none():
    for labels, side in (([0, 0], 0), ([1, 1], 1), ([], 0)):
        net = toxicity.train(["a b", "c"][: len(labels)], labels)
        assert (toxicity.sigmoid(net.shift) >= 0.5) == bool(side)


def test_awkward_documents(spark):
    texts, labels = small(docs=60)
    net = toxicity.train(texts, labels, epochs=3)
    got = clashing(spark).select("doc_id", toxicity.score(net).alias("s"))
    assert ids(got) == ALL_IDS
    scores = {r["doc_id"]: r["s"] for r in got.collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and scores[5] == scores[6] == scores[7] == 0.0
    assert empty(spark).select(toxicity.score(net)).count() == 0
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (None, 1), (5, 1), (99, None)], "doc_id bigint, toxic int")
    assert isinstance(toxicity.fit(awkward(spark), labels, epochs=1), toxicity.Network)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels")
    held_out = remainder(F.col("doc_id"), 4) == 2
    docs = table(spark, sf, "documents")
    net = toxicity.fit(docs, labels.where(~held_out))
    got = docs.join(labels.where(held_out), "doc_id").select("lang", "toxic", toxicity.score(net).alias("s")).toPandas()
    hit = got["s"] >= toxicity.THRESHOLD
    assert (hit & (got["toxic"] == 1)).sum() / hit.sum() > 0.8
    english = got[got["lang"] == "en"]
    assert (english["s"] >= toxicity.THRESHOLD)[english["toxic"] == 1].mean() > 0.85
