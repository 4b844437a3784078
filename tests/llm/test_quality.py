from __future__ import annotations

import random

import duckdb
import numpy as np
import pandas as pd
import pytest

from barhouse.llm import quality
from tests.llm.cases import ALL_IDS, ROWS, WORDS, awkward, clashing, empty, ids


def plain(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered)


def made_up(seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(["a ", "bé ", "C", "#", "a b\n", "\n", "\t", "x y z u v ", "𝄞", "!"], k=rng.randint(0, 60))) for _ in range(80)]


@pytest.mark.parametrize("seed", [1, 2])
def test_measures_against_plain_counting(seed):
    texts = made_up(seed)
    t = quality.Texts([x.encode() for x in texts])
    assert np.stack([getattr(t, m) for m in quality.MEASURES], axis=1).tolist() == [list(plain(x)) for x in texts]


def test_order_of_rules_does_not_change_the_verdict():
    texts = quality.Texts([x.encode() for seed in range(4) for x in made_up(seed)])
    verdicts = {tuple(quality.run_cascade(texts, random.Random(k).sample(quality.RULES, len(quality.RULES)))) for k in range(10)}
    assert len(verdicts) == 1
    rejected = np.zeros(len(texts.texts), bool)
    for rule in quality.RULES:
        rejected |= rule.rejects(texts)
    assert verdicts == {tuple(~rejected)}


def test_short_circuit_and_order():
    seen = []

    def rule(name, rejects, wait):
        def run(t):
            seen.append((name, len(t.texts)))
            sum(range(wait))
            return np.array([rejects(x) for x in t.texts], bool)

        return quality.Rule(name, run)

    never, costly, cheap = rule("never", lambda x: False, 10), rule("costly", lambda x: x < b"5", 3_000_000), rule("cheap", lambda x: x < b"5", 10)
    texts = [str(i).encode() for i in range(10)]
    order = quality.order_rules(texts, [never, costly, cheap])
    assert [r.name for r in order] == ["cheap", "never", "costly"]
    seen.clear()
    assert quality.run_cascade(quality.Texts(texts), order).sum() == 5
    assert seen == [("cheap", 10), ("never", 5), ("costly", 5)]


def test_awkward_documents(spark):
    got = quality.measured(clashing(spark), quality.planned(awkward(spark)))
    assert ids(got) == ALL_IDS
    texts = {r[0]: r[1] for r in ROWS if r[0] is not None and len(r[1] or "") < 10_000}
    for r in got.where("doc_id is not null").collect():
        if r["doc_id"] in texts:
            assert tuple(r[m] for m in quality.MEASURES) == plain(texts[r["doc_id"]])
    assert quality.measured(empty(spark), quality.planned(empty(spark))).count() == 0
    passes = awkward(spark).select("doc_id", quality.passes(quality.RULES).alias("kept"))
    assert {(r["doc_id"], r["kept"]) for r in passes.collect()} == {(r["doc_id"], r["kept"]) for r in got.collect()}


def test_sql_agrees(spark):
    documents = pd.DataFrame({"doc_id": range(80), "text": made_up(5)})
    con = duckdb.connect()
    con.register("documents", documents)
    theirs = con.execute(quality.MEASURED_SQL).fetch_df().sort_values("doc_id").reset_index(drop=True)
    ours = quality.measured(spark.createDataFrame(documents), quality.RULES).toPandas().sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(ours[theirs.columns], theirs, check_dtype=False)
