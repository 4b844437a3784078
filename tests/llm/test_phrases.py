from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from barhouse.llm import phrases
from tests.llm.cases import EN, ROWS, awkward, clashing, empty

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def plain(rows, least, top, longest=5):
    """Every phrase of every piece, one by one."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = {o[i : i + k] for o, b in found.items() for k in range(2, len(o)) for i in range(len(o) - k + 1) if b >= counts[o[i : i + k]]}
        rated = []
        for p, a in found.items():
            if p not in inside:
                cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rated.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rated)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def invented(seed, docs=60):
    rng = random.Random(seed)
    words = ["a", "B", "ab", "abc", "é", "ÉA", "x-y", "x\x1fy", "\x85", "the", "of", "\U0001d4d0"]
    clauses = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 12))) for _ in range(25)]
    texts = []
    for _ in range(docs):
        parts = [rng.choice(clauses) if rng.random() < 0.7 else "\t ".join(rng.choice(words) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 9))]
        text = "".join(p + rng.choice([". ", ", ", "\n", " ", "\x0b", "; ;"]) for p in parts)
        texts.append((text, rng.choice(["en", "en", "de", None, "und"])))
    return texts + texts[:5] + [(None, "en"), ("", None)]


def got(spark, rows, least, top):
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    return sorted(tuple(r) for r in phrases.collocations(docs, least, top).collect())


@pytest.mark.parametrize("seed, least, top", [(1, 3, 1000), (2, 8, 7), (3, 2, 50)])
def test_same_as_phrase_by_phrase(spark, seed, least, top):
    rows = invented(seed)
    found = got(spark, rows, least, top)
    assert found and found == plain(rows, least, top)


def test_crowded_bitmap_and_small_buffers_change_nothing(spark, monkeypatch):
    """With few bits nearly everything is marked; counts stay as they are."""
    for name, value in (("MARK_BITS", 8), ("PART_BITS", 4), ("HELD_CHUNKS", 10), ("HELD_GRAMS", 20), ("CHUNK_BYTES", 50)):
        monkeypatch.setattr(phrases, name, value)
    rows = invented(4)
    assert got(spark, rows, 4, 100) == plain(rows, 4, 100)


def test_chunks_own_every_word_once(monkeypatch):
    monkeypatch.setattr(phrases, "TRIGGER", 3)
    text = " ".join(w for t, _ in invented(5) for w in (t or "").split()).encode()
    for longest in (2, 5):
        found = list(phrases.parsed(text, phrases.Triggers(), longest))
        pieces = [p.split() for p in text.translate(phrases._FOLD).split(b"\n")]
        assert [w for tail, own, chunk in found for w in chunk.split()[:own]] == [w for p in pieces for w in p]
        assert all(len(chunk.split()) == own + tail and tail < longest for tail, own, chunk in found)
        assert any(tail for tail, _, _ in found)


def test_products_past_64_bits(spark):
    """Counts of a large corpus, from a dictionary that says so."""
    big = 10**11
    rows = [("en", 0, "new york", 2, big), ("en", 0, "new", 1, 3 * big), ("en", 0, "york", 1, 7), ("en", 0, "other", 1, 10**13)]
    held = spark.createDataFrame(rows, "lang string, tail int, chunk string, own int, count bigint")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(phrases, "dictionary", lambda docs, longest: held)
        (row,) = phrases.collocations(None).collect()
    n = 2 * big + 3 * big + 7 + 10**13
    assert tuple(row) == ("en", 1, "new york", big, 4 * big, big + 7, n, 1000 * big * n // (4 * big * (big + 7)))


def test_ties_go_by_bytes(spark):
    rows = [("zz é, zz a, zz b, " * 3, "en")]
    found = got(spark, rows, 3, 10)
    assert [r[2] for r in found] == ["zz a", "zz b", "zz é"] and found == plain(rows, 3, 10)


def test_awkward_documents(spark):
    for docs in (awkward(spark), clashing(spark)):
        found = sorted(tuple(r) for r in phrases.collocations(docs, least=3).collect())
        assert found and found == plain([(r[1], r[2]) for r in ROWS], 3, 2000)
    assert phrases.collocations(empty(spark)).count() == 0
    assert phrases.collocations(awkward(spark).withColumn("text", F.lit(None).cast("string"))).count() == 0


def test_one_long_piece(spark):
    text = EN.replace(".", " ") * 4000
    rows = [(text, "en"), ("w " * 30_000, "en")]
    assert got(spark, rows, 100, 50) == plain(rows, 100, 50)
