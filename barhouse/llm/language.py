"""Language identification as inference of a mixture.

A document is a mixture of languages: each of its words was drawn from one of them,
with a likelihood that the word's character trigrams give. Expectation-maximisation
estimates the proportions; the set of languages is the one with the best likelihood
less a penalty for each language beyond the first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from barhouse.llm.common import chunks
from barhouse.llm.letters import words_of

UNKNOWN = "und"
# The model is fitted on about so many rows of each language, picked by a hash of the id.
ROWS_PER_LANGUAGE = 1000
BUCKETS = 1 << 15
ROUNDS = 12
CHUNK_CHARS = 1 << 20
# Every letter stands in three trigrams, so their likelihoods count a third each.
OVERLAP = 3.0


@dataclass(frozen=True)
class Model:
    """Log-likelihood of each trigram bucket under each language."""

    languages: list[str]
    logp: np.ndarray


def fit(labelled: DataFrame, rows: int = ROWS_PER_LANGUAGE) -> Model:
    """Learn from labelled documents (doc_id, text, lang); nulls in text or lang are left out.

    Counts are made where the rows are; the driver gets at most ``BUCKETS`` of them per language.
    """
    known = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32))
    share = F.create_map(*(x for lang in languages for x in (F.lit(lang), F.lit(min(1.0, rows / sizes[lang])))))
    draw = F.pmod(F.xxhash64(F.lit(7), "doc_id", "text"), F.lit(1 << 20)) / (1 << 20)
    sample = known.where(draw < share[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS), np.int64)
        place = {lang: k for k, lang in enumerate(languages)}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks([len(t) for t in texts], CHUNK_CHARS):
                words = words_of(texts[a:b])
                if len(words):
                    row = np.repeat([place[x] for x in langs[a:b]], words.counts)
                    flat = np.repeat(row, words.lengths) * BUCKETS + words.grams(BUCKETS)
                    total += np.bincount(flat, minlength=total.size).reshape(total.shape)
        k, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (k, bucket, total[k, bucket])], ["k", "bucket", "n"])

    counted = sample.select("text", "lang").mapInArrow(count, "k bigint, bucket bigint, n bigint")
    found = counted.groupBy("k", "bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.full((len(languages), BUCKETS), 0.1)
    table[found["k"], found["bucket"]] += found["n"]
    logp = np.log(table / table.sum(axis=1, keepdims=True)).T / OVERLAP
    return Model(languages, np.ascontiguousarray(logp, np.float32))


def _mixture(lik: np.ndarray, doc: np.ndarray, first: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM over words: proportions per document and the log-likelihood, for the allowed languages."""
    n = np.diff(np.append(first, len(doc)))[:, None]
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        part = lik * share[doc]
        part /= part.sum(axis=1, keepdims=True)
        share = np.add.reduceat(part, first, axis=0) / n
    whole = (lik * share[doc]).sum(axis=1)
    return share, np.add.reduceat(np.log(whole), first)


def infer(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of each language in each text, zero for languages not in the selected set, and the words of each text."""
    words = words_of(texts)
    out = np.zeros((len(texts), len(model.languages)))
    if not len(words) or not model.languages:
        return out, words.counts
    some = np.flatnonzero(words.counts)
    counts = words.counts[some]
    first = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(some)), counts)
    logs = words.sums(model.logp[words.grams(BUCKETS)]).astype(np.float64)
    best = logs.max(axis=1, keepdims=True)
    # No language is ruled out by one word.
    lik = np.maximum(np.exp(logs - best), 1e-12)
    peak = np.add.reduceat(best[:, 0], first)
    k = len(model.languages)
    share, full = _mixture(lik, doc, first, np.ones((len(some), k)))
    full += peak
    penalty = 0.5 * np.log(counts + 1.0)
    single = np.add.reduceat(logs, first, axis=0)
    chosen = np.zeros_like(share)
    chosen[np.arange(len(some)), single.argmax(axis=1)] = 1.0
    value = single.max(axis=1)
    order = np.argsort(-share, axis=1)
    # No set can beat the likelihood of all languages, so texts for which that isn't worth one penalty are settled.
    open_ = np.flatnonzero(full - penalty > value)
    for size in range(2, k + 1):
        if not len(open_):
            break
        allowed = np.zeros((len(open_), k))
        np.put_along_axis(allowed, order[open_, :size], 1.0, axis=1)
        pick = np.isin(doc, open_)
        sizes = counts[open_]
        own = np.repeat(np.arange(len(open_)), sizes)
        got, likelihood = _mixture(lik[pick], own, np.cumsum(sizes) - sizes, allowed)
        worth = likelihood + peak[open_] - penalty[open_] * (size - 1)
        better = worth > value[open_]
        chosen[open_[better]], value[open_[better]] = got[better], worth[better]
        open_ = open_[full[open_] - penalty[open_] * size > value[open_]]
    out[some] = chosen
    return out, words.counts


def predict(model: Model, text: Column | str = "text") -> Column:
    """Struct (lang_pred, score): the language with the largest proportion and that proportion.

    All words of a text count, however long it is. ``und`` with score 0 if the text is null or
    has no letter, or nothing was learned.
    Ties go to the language that sorts first.
    """
    names = np.array([*model.languages, UNKNOWN], object)

    @F.pandas_udf("lang_pred string, score double")
    def mixture(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            listed = [None if t is None or t != t else t for t in batch]
            picks, scores = [], []
            for a, b in chunks([len(t or "") for t in listed], CHUNK_CHARS):
                share, counts = infer(model, listed[a:b])
                known = (counts > 0) & bool(model.languages)
                if model.languages:
                    picks.append(np.where(known, share.argmax(axis=1), len(model.languages)))
                    scores.append(np.where(known, share.max(axis=1), 0.0))
                else:
                    picks.append(np.zeros(b - a, int))
                    scores.append(np.zeros(b - a))
            yield pd.DataFrame({"lang_pred": names[np.concatenate(picks)], "score": np.clip(np.concatenate(scores), 0.0, 1.0)})

    return mixture(text)
