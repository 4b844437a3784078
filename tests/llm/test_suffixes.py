from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barhouse.llm import suffixes
from tests.llm.cases import CLASHING, ROWS, SCHEMA, awkward, clashing, empty


def plain(rows, span):
    """What is removed of each (doc_id, text), string by string; rows of one doc_id are one document."""
    last = float("inf")
    data = [(last if d is None else d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, t in data:
        for i in range(len(t) - span + 1):
            key = t[i : i + span]
            first[key] = min(first.get(key, (last, last)), (d, i))
    out = []
    for d, t in data:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - span + 1):
            if first[t[i : i + span]] != (d, i):
                gone[i : i + span] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((None if d == last else d, len(t), int(gone.sum()), int((gone[:-1] & ~np.append(False, gone[:-1])[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, span, **how):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    done = suffixes.drop_repeats(docs, span, **how)
    return sorted((tuple(r) for r in done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()), key=str)


def invented(seed, docs=40):
    """Texts that share passages, copies with one byte changed, and runs of one character."""
    rng = random.Random(seed)
    letters = "abé " if seed % 2 else "abcdefgh ij"
    passages = ["".join(rng.choice(letters) for _ in range(rng.choice([15, 40, 90]))) for _ in range(6)]
    rows = []
    for k in range(docs):
        parts = [rng.choice([rng.choice(passages), "".join(rng.choice(letters) for _ in range(rng.randint(0, 30))), "z" * rng.randint(0, 60)]) for _ in range(rng.randint(0, 6))]
        text = "".join(parts)
        rows.append((rng.randint(-5, 60), text))
        if text and rng.random() < 0.3:
            at = rng.randrange(len(text))
            rows.append((rng.randint(0, 60), text[:at] + rng.choice(["", "q", "qq"]) + text[at + 1 :]))
        if rng.random() < 0.2:
            rows.append((rng.randint(61, 70), text))
    return rows + [(None, ""), (3, None), (None, "abc" * 20)]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("batches", [1, 5])
def test_same_as_string_by_string(spark, seed, batches):
    rows = [(d, t) for d, t in dict.fromkeys(invented(seed))]
    assert got(spark, rows, 24, batches=batches, prefix=10) == plain(rows, 24)


@pytest.mark.parametrize("sizes", [(7, 5), (64, 40)])
def test_small_steps_and_buffers_change_nothing(sizes):
    """The functions that tasks run, without Spark: entries are the same whatever the step."""
    text = "".join(t or "" for _, t in invented(1)).encode()
    windows = []
    for step in (*sizes, 1 << 20):
        suffixes_step, suffixes.STEP = suffixes.STEP, step
        try:
            found = suffixes.entries_of(suffixes.Rolling(text), 24, 10)
        finally:
            suffixes.STEP = suffixes_step
        windows.append([(s + k, a) for s, c, a in zip(found.start, found.count, found.anchor) for k in range(c)])
    assert windows[0] == windows[1] == windows[2]


def test_equal_windows_have_equal_anchors():
    rng = random.Random(5)
    text = "".join(rng.choice("ab") for _ in range(3000)).encode()
    found = suffixes.entries_of(suffixes.Rolling(text), 24, 10)
    assert found.start[0] == 0 and (found.start[1:] == (found.start + found.count)[:-1]).all()
    offset = {}
    for s, c, a in zip(found.start, found.count, found.anchor):
        for i in range(s, s + c):
            assert i <= a <= i + 14
            assert offset.setdefault(text[i : i + 24], a - i) == a - i


def test_fingerprints_are_of_the_bytes_alone():
    text = b"x" * 5 + bytes(range(200)) * 2
    sums = suffixes.Rolling(text)
    assert sums.of(np.array([5]), np.array([105])) == sums.of(np.array([205]), np.array([305]))
    assert len(set(sums.of(np.arange(5, 205), np.arange(105, 305)).tolist())) == 200


def test_arrays_double(spark):
    family, rng = suffixes.Family(24, 10), random.Random(2)
    for k in range(7):
        text = "".join(rng.choice("abcdef ") for _ in range(300))
        docs = spark.createDataFrame([(text.encode(), k, 0)], "text binary, doc bigint, mark bigint")
        assert family.add(docs).where(F.col("kind") == suffixes.GONE).count() == 0
        assert [size for size, _ in family.arrays] == [s for s in (4, 2, 1) if (k + 1) & s]
    again = spark.createDataFrame([(text.encode(), 9, 0)], "text binary, doc bigint, mark bigint")
    spans = family.add(again).where(F.col("kind") == suffixes.GONE).collect()
    assert min(r["at"] >> suffixes.AT_BITS for r in spans) == 0 and max(r["c"] for r in spans) == 300
    kept = family.arrays[0][1]
    assert kept.select("h", "c").distinct().count() == kept.count()


def test_a_passage_of_many_documents(spark):
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(150))
    rows = [(k, "".join(rng.choice("abcdefgh ") for _ in range(40)) + passage + "".join(rng.choice("abcdefgh ") for _ in range(40))) for k in range(300)]
    found = got(spark, rows, 100)
    assert found == plain(rows, 100)
    assert sum(r[2] >= 150 for r in found) == 299


def test_awkward_documents(spark):
    report = suffixes.repeat_report(clashing(spark)).toPandas()
    unique = list(dict.fromkeys((r[0], r[1]) for r in ROWS))
    want = plain(unique, 100)
    assert sorted(set(tuple(None if x != x else x for x in r) for r in report.astype(object).itertuples(index=False)), key=str) == sorted(set(want), key=str)
    assert len(report) == len(ROWS)
    done = suffixes.drop_repeats(clashing(spark))
    assert done.columns == [*SCHEMA.replace(" bigint", "").replace(" string", "").split(", "), *(c.split()[0] for c in CLASHING.split(", ")), "kept", "n_bytes", "n_removed", "n_spans"]
    assert suffixes.repeat_report(empty(spark)).count() == 0


def test_columns_called_like_the_results_are_replaced(spark):
    docs = spark.createDataFrame([(1, "x", "k", "s", 5)], "doc_id bigint, text string, kept string, spans string, mark int")
    assert suffixes.drop_repeats(docs).collect() == [(1, "x", "s", 5, bytearray(b"x"), 1, 0, 0)]


def test_ids_all_missing(spark):
    docs = awkward(spark).withColumn("doc_id", F.lit(None).cast("bigint"))
    assert suffixes.repeat_report(docs).count() == len(ROWS)
