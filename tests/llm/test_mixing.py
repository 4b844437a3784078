from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from barhouse.llm import mixing
from tests.llm.cases import ALL_IDS, ROWS, WORDS, awkward, clashing, empty, ids


def targets(sizes):
    """Start in proportion and reshare what is above, over and over."""
    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s else b""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not above:
            return out | {s: left * weight[s] / total for s in open_}
        for s in above:
            out[s] = 2 * sizes[s]
            left -= out[s]
        open_ -= above
    return out


@pytest.mark.parametrize("seed", range(8))
def test_subset_sum_against_all_sums(seed):
    rng = random.Random(seed)
    lengths = np.array(sorted(rng.sample(range(1, 30), 6)))
    counts = np.array([rng.randint(0, 4) for _ in lengths])
    sums = {0}
    for n, c in zip(lengths, counts, strict=True):
        sums = {s + k * n for s in sums for k in range(c + 1)}
    for budget in range(0, int((lengths * counts).sum()) + 5, 7):
        left = np.array(mixing._subset_sum(lengths, counts, budget))
        assert (left <= counts).all() and (left >= 0).all()
        assert (left * lengths).sum() == max(s for s in sums if s <= budget)


@pytest.mark.parametrize("seed", range(6))
def test_budgets_are_met(seed, monkeypatch):
    monkeypatch.setattr(mixing, "TABLE_WORDS", 300)
    rng = np.random.default_rng(seed)
    lengths = np.unique(rng.integers(0, 400, 80))
    counts = rng.integers(1, 50, len(lengths))
    total = int((lengths * counts).sum())
    for budget in rng.integers(0, total + 1, 20):
        take = mixing.fit_budget(lengths, counts, int(budget))
        assert (take >= 0).all() and (take <= counts).all()
        assert 0 <= budget - (take * lengths).sum() <= 3


def test_awkward_documents(spark):
    got = mixing.mix(clashing(spark)).toPandas()
    assert sorted(got["doc_id"].astype(object).where(got["doc_id"].notna(), None), key=lambda x: (x is None, x)) == ALL_IDS
    sizes = defaultdict(int)
    for r in ROWS:
        sizes[r[3]] += len(WORDS.findall(r[1] or ""))
    want = targets(sizes)
    by_source = mixing.mix(awkward(spark), keep=["doc_id", "source"]).toPandas()
    for source, part in by_source.groupby("source", dropna=False):
        source = source if isinstance(source, str) else None
        assert part["target"].iloc[0] == pytest.approx(want[source])
        assert part["source_size"].iloc[0] == sizes[source]
        assert (part["taken"] <= 2 * part["size"]).all()
    # The long document alone fills its source, so only that source may miss its target, by less than the document.
    assert mixing.mix(empty(spark)).count() == 0


def test_many_documents_meet_their_targets(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 3, 7, 40, rng.randint(1, 90)])), rng.choice(["a", "a", "a", "é", "z", None, "b"])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix(docs, keep=["doc_id", "source"]).toPandas()
    for _, part in got.groupby("source", dropna=False):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= 1
        assert set((part["taken"] / part["size"].where(part["size"] > 0)).dropna()) <= {0, 1, 2}
    again = mixing.mix(docs.repartition(13), keep=["doc_id", "source"]).toPandas()
    assert got.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))


def test_documents_without_words(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (2, "", "b")], "doc_id bigint, text string, source string")
    assert ids(mixing.mix(docs)) == [1, 2, 2]
    assert {r["taken"] for r in mixing.mix(docs).collect()} == {0}
