from __future__ import annotations

import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from barhouse.llm import packing
from tests.llm.cases import ALL_IDS, ROWS, awkward, clashing, empty

FILE = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(FILE)


KNOWN = packing.WordIds(FILE)


def whole_ids(text):
    return np.array([*WHOLE.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")


@given(st.lists(st.text(max_size=60), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_give_the_ids_of_the_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, totals = packing.WordIds(FILE).encode([t.encode() for t in texts])
    want = [whole_ids(t) for t in texts]
    assert totals.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_special_strings_and_a_full_cache(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)
    known = packing.WordIds(FILE)
    for text in ["a b c d e f", "A, b. É, é. é, it's. 'tis, ., a.. a,. 3, ß. ſ, İ. Σ, ΑΣ. x<|endoftext|>, <|ENDOFTEXT|>. Ⅷ, ª. K, ½.", "<|endoftext|> The, the. THE", "x <|endoftext|> y<|startoftext|>z", "don't stop 123 a b", "é́ ½ \x1f \x85 \xa0!"]:
        assert known.encode([text.encode()])[0].tolist() == whole_ids(text).tolist()


marked = st.builds(lambda w, m: w + m, st.text(st.characters(categories=["L", "N", "M", "P"]), min_size=1, max_size=6), st.sampled_from(["", ",", ".", ",.", ". "]))


@given(st.lists(marked, max_size=12).map(" ".join))
@settings(max_examples=300, deadline=None)
def test_marks_and_letters(text):
    assert KNOWN.encode([text.encode()])[0].tolist() == whole_ids(text).tolist()


def test_words_are_known_to_the_next_task_and_forgotten_when_idle(monkeypatch):
    monkeypatch.setattr(packing, "IDLE_SECONDS", 0.3)
    with packing.known_words(FILE) as known:
        known.encode([b"some words"])
    with packing.known_words(FILE) as again:
        assert again is known
    time.sleep(2)
    assert not packing._SHELF
    with pytest.raises(OSError), packing.known_words(FILE):
        raise OSError
    assert not packing._SHELF  # what a task that failed has left may be half learned


def plain_best_fit(lengths, window):
    """Best-fit decreasing, one piece after the other; how full each window is."""
    full = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, f in enumerate(full) if f + n <= window]
        if fits:
            i = max(fits, key=lambda i: full[i])
            full[i] += n
        else:
            full.append(n)
    return Counter(full)


def lay_out(counts, window):
    windows = {}
    for r in packing.best_fit_decreasing(counts, window):
        later = [x.rank for x in packing.best_fit_decreasing(counts, window) if x.length == r.length and x.rank > r.rank]
        for rank in range(r.rank, min(later, default=counts[r.length] + 1)):
            past = rank - r.rank
            windows.setdefault(r.first + past // r.each, []).append((r.offset + past % r.each * r.length, r.length))
    return windows


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    window = rng.choice([8, 31, 64])
    lengths = [rng.randint(1, window) if rng.random() < 0.7 else rng.choice([1, window // 3, window]) or 1 for _ in range(rng.randint(1, 300))]
    windows = lay_out(dict(Counter(lengths)), window)
    assert sorted(windows) == list(range(len(windows)))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    assert Counter(sum(n for _, n in p) for p in windows.values()) == plain_best_fit(lengths, window)


def test_plan_stays_small():
    counts = {n: 10**9 + n for n in range(1, 4097)}
    assert len(packing.best_fit_decreasing(counts)) < 5 * 4096


@pytest.mark.parametrize("window", [16, 4096])
def test_awkward_documents(spark, window):
    got = packing.pack(clashing(spark), FILE, window).toPandas()
    texts = {}
    for r in ROWS:
        texts.setdefault(r[0], []).append(whole_ids(r[1]))
    assert Counter(got["doc_id"][got["start"] == 0].astype(object).where(lambda s: s.notna(), None)) == Counter(ALL_IDS)
    for r in got.dropna(subset="doc_id").itertuples():
        part = texts[r.doc_id][0][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32 and r.doc_tokens == len(texts[r.doc_id][0])
    for _, part in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert part["offset"].tolist() == (part["length"].cumsum() - part["length"]).tolist()
        assert part["length"].sum() <= window
    assert got["length"].sum() == sum(len(w) for ws in texts.values() for w in ws)
    assert packing.pack(empty(spark), FILE).count() == 0


def test_reruns_agree(spark):
    rows = packing.pack(awkward(spark).repartition(3), FILE).collect()
    assert sorted(rows, key=str) == sorted(packing.pack(awkward(spark).repartition(7), FILE).collect(), key=str)
