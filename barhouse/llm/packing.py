"""Packing of token sequences by best-fit decreasing.

Best-fit decreasing looks at nothing but lengths, and no piece is longer than a
window, so the whole corpus is planned exactly from one count per length: at
most ``window`` rows reach the driver, however many documents there are. The
plan places runs of equally long pieces into runs of equally filled windows; a
segment tree over remaining capacities finds the tightest one that is open.
"""

from __future__ import annotations

import json
import os
import threading
import time
import zlib
from collections import deque
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barhouse.llm.common import chunks, ranked, settled

WINDOW = 4096
END_ID = 2
# Marks that the tokenizer parts from a letter before them.
MARKS = b",."
# Words encoded as one text.
TOGETHER = 200
# Words whose ids a worker remembers before it starts afresh, seconds without a task after which it forgets them, and bytes of text encoded at a time.
CACHE_WORDS = 1 << 18
IDLE_SECONDS = 4
CHUNK_BYTES = 4 << 20

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def tokenizers_of(file: str) -> tuple:
    """The tokenizer; one without normalisation that gives the same ids for lower-case letters; and which ids end a word of it.

    The last two are None unless the file cuts at everything but letters, then only maps
    bytes, and marks the ends of words.
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    whole = Tokenizer.from_file(file)
    with open(file, encoding="utf-8") as f:
        data = json.load(f)
    steps = (data["pre_tokenizer"] or {}).get("pretokenizers", [])
    kinds = [step["type"] for step in steps]
    suffix = data["model"].get("end_of_word_suffix")
    if not suffix or kinds != ["Split", "ByteLevel"] or "[\\p{L}]+" not in steps[0]["pattern"].get("Regex", "") or steps[1]["use_regex"]:
        return whole, None, None
    apart = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, steps[1]]}
    vocab = data["model"]["vocab"]
    ends = np.zeros(max(vocab.values()) + 1, bool)
    ends[[number for token, number in vocab.items() if token.endswith(suffix)]] = True
    return whole, Tokenizer.from_str(json.dumps({**data, "normalizer": None, "pre_tokenizer": apart})), ends


def _gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` one after another."""
    ends = np.cumsum(lengths, dtype=np.int32)
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]


class Stretches:
    """Numbered runs of ids, end to end; 32 bits hold any place in what is remembered."""

    def __init__(self, first: list[int]):
        self.flat, self.starts, self.lengths = np.array(first, "<u4"), np.array([0], np.int32), np.array([len(first)], np.int32)

    def append(self, flat: np.ndarray, lengths: np.ndarray, order: np.ndarray | None = None) -> None:
        """More runs, to be numbered as they lie or in the given order."""
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        if order is not None:
            starts, lengths = starts[order], lengths[order]
        self.starts = np.concatenate([self.starts, starts.astype(np.int32)])
        self.lengths = np.concatenate([self.lengths, lengths.astype(np.int32)])
        self.flat = np.concatenate([self.flat, flat])

    def of(self, numbers: np.ndarray) -> np.ndarray:
        return _gathered(self.flat, self.starts[numbers], self.lengths[numbers])


class Numbers(dict):
    """Bytes to a number; those that are new are listed."""

    def __init__(self, first: bytes | None = None):
        super().__init__({} if first is None else {first: 0})
        self._first = 1 - len(self)
        self.new: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        self.new.append(key)
        number = self[key] = len(self) + self._first
        return number


class WordIds:
    """The ids of words, of which each is encoded once.

    The tokenizer never joins characters across white space, so a text's ids
    are those of its words. Number 0 stands for the end of a document. It also
    folds case and parts a comma or full stop from a letter before it, so a word
    with such a mark is put together from the ids of its bare form and of the mark.
    """

    def __init__(self, tokenizer_file: str):
        self._whole, self._letters, self._ends = tokenizers_of(tokenizer_file)
        self._forget()

    def _forget(self) -> None:
        self._numbers, self._words = Numbers(), Stretches([END_ID])
        # Bare forms and marks; number 0 is the absent mark.
        self._bare, self._forms = Numbers(b""), Stretches([])

    def _encode(self, forms: list[bytes]) -> None:
        words = b"\n".join(forms).decode().split("\n")
        light = []
        if self._letters is not None:
            light = [i for i, w in enumerate(words) if w.isalpha() and (w.islower() if w.isascii() else w == w.lower() and is_normalized("NFC", w))]
        rest = np.ones(len(words), bool)
        rest[light] = False
        rest = np.flatnonzero(rest).tolist()
        flat, lengths = self._light([words[i] for i in light])
        found = [e.ids for e in self._whole.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        others = np.fromiter(chain.from_iterable(found), "<u4", int(counts.sum()))
        self._forms.append(np.concatenate([flat, others]), np.concatenate([lengths, counts]), np.argsort(np.array(light + rest)))

    def _light(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of lower-case letters end to end, and how many each has: many are encoded as one text, each up to the id that ends it."""
        texts = [" ".join(words[k : k + TOGETHER]) for k in range(0, len(words), TOGETHER)]
        found = [np.array(e.ids, "<u4") for e in self._letters.encode_batch_fast(texts, add_special_tokens=False)] if words else []
        flat = np.concatenate([np.empty(0, "<u4"), *found])
        return flat, np.diff(np.flatnonzero(self._ends[flat]), prepend=-1) if words else np.empty(0, np.int64)

    def _learn(self) -> None:
        new, self._numbers.new = self._numbers.new, []
        # The last two bytes of each word; words of one byte are no bare form with a mark.
        data = np.frombuffer(b"\n\n" + b"\n".join(new), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)) + 1) + 1
        last, before = data[ends - 1], data[ends - 2] | 32
        marks = np.where((before >= 97) & (before <= 122), np.select([last == MARKS[0], last == MARKS[1]], [1, 2]), 0)
        forms = [w[:-1] if m else w for w, m in zip(new, marks.tolist(), strict=True)]
        pairs = np.array([*map(self._bare.__getitem__, forms)], np.int64), np.array([0, *(self._bare[bytes([m])] for m in MARKS)])[marks]
        unknown, self._bare.new = self._bare.new, []
        if unknown:
            self._encode(unknown)
        pairs = np.column_stack(pairs)
        self._words.append(self._forms.of(pairs.ravel()), self._forms.lengths[pairs].sum(axis=1))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each closed by the end id, and how many each has."""
        if len(self._numbers) > CACHE_WORDS:
            self._forget()
        numbers: list[int] = []
        counts = np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            before = len(numbers)
            # Folding is left to the tokenizer where the text may name one of its special tokens.
            numbers.extend(map(self._numbers.__getitem__, (text if b"<|" in text else text.lower()).split()))
            numbers.append(0)
            counts[k] = len(numbers) - before
        if self._numbers.new:
            self._learn()
        words = np.array(numbers, np.int32)
        lengths = self._words.lengths[words].astype(np.int64)
        totals = np.add.reduceat(lengths, np.cumsum(counts) - counts) if len(counts) else counts
        return self._words.of(words), totals


_SHELF: dict[str, tuple[float, WordIds]] = {}


@contextmanager
def known_words(tokenizer_file: str) -> Iterator[WordIds]:
    """What this worker process knows of a tokenizer: its next task goes on from there, unless that is long in coming."""
    _, known = _SHELF.pop(tokenizer_file, (0, None))
    known = known or WordIds(tokenizer_file)
    yield known
    _SHELF[tokenizer_file] = time.monotonic(), known
    timer = threading.Timer(IDLE_SECONDS + 1, _clear_shelf)
    timer.daemon = True
    timer.start()


def _clear_shelf() -> None:
    """Other jobs on the worker get the memory back."""
    for file, (since, _) in list(_SHELF.items()):
        if time.monotonic() - since > IDLE_SECONDS:
            _SHELF.pop(file, None)


def token_pieces(docs: DataFrame, tokenizer_file: str, window: int = WINDOW) -> DataFrame:
    """Tokenize whole texts and cut each into full windows and a rest.

    Null texts are empty: their only id is the end id. Repeated rows give repeated pieces.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with known_words(tokenizer_file) as known:
            for batch in batches:
                texts = batch.column(1).cast(pa.binary())
                sizes = [x.as_py() or 0 for x in pa.compute.binary_length(texts)]
                for a, b in chunks(sizes, CHUNK_BYTES):
                    ids, totals = known.encode([x or b"" for x in texts.slice(a, b - a).to_pylist()])
                    rows = -(-totals // window)
                    doc = np.repeat(np.arange(b - a), rows)
                    start = (np.arange(len(doc)) - np.repeat(np.cumsum(rows) - rows, rows)) * window
                    length = np.minimum(window, totals[doc] - start)
                    at = (np.cumsum(totals) - totals)[doc] + start
                    crc = [zlib.crc32(ids[x : x + n]) for x, n in zip(at.tolist(), length.tolist(), strict=True)]
                    columns = [
                        batch.column(0).slice(a, b - a).take(pa.array(doc)),
                        *(pa.array(x, pa.int64()) for x in (start, length, crc, totals[doc])),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, PIECES.replace(" bigint", "").split(", "))

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(encode, PIECES)


class Capacities:
    """Segment tree: the smallest remaining capacity of at least so much that has an open window."""

    def __init__(self, window: int):
        self._leaves = 1 << window.bit_length()
        self._any = np.zeros(2 * self._leaves, bool)
        self.runs: list[deque[tuple[int, int]]] = [deque() for _ in range(window + 1)]

    def add(self, capacity: int, first: int, count: int) -> None:
        self.runs[capacity].append((first, count))
        self._mark(capacity, True)

    def _mark(self, capacity: int, has: bool) -> None:
        node = self._leaves + capacity
        self._any[node] = has
        while node > 1:
            node //= 2
            self._any[node] = self._any[2 * node] or self._any[2 * node + 1]

    def take(self, capacity: int) -> tuple[int, int]:
        run = self.runs[capacity].popleft()
        if not self.runs[capacity]:
            self._mark(capacity, False)
        return run

    def tightest(self, least: int) -> int | None:
        node = self._leaves + least
        if self._any[node]:
            return least
        while node > 1:  # up to the first right sibling that has something, then down its left edge
            if node % 2 == 0 and self._any[node + 1]:
                node += 1
                while node < self._leaves:
                    node = 2 * node if self._any[2 * node] else 2 * node + 1
                return node - self._leaves
            node //= 2
        return None


@dataclass(frozen=True)
class Run:
    """Pieces of one length from rank ``rank`` on, ``each`` to a window, from window ``first`` on."""

    length: int
    rank: int
    each: int
    first: int
    offset: int


def best_fit_decreasing(counts: dict[int, int], window: int = WINDOW) -> list[Run]:
    """Where the pieces go, given how many there are of each length.

    A window that has just taken a piece is tighter than any other open one, so
    it goes on taking pieces of that length until it can't; whole runs of
    windows are therefore filled in one step. A length costs a constant number of
    runs besides those that it uses up, so the plan grows with ``window`` alone.
    """
    tree, plan, opened = Capacities(window), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 1, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, each = window, window // length
                first, count = opened, -(-left // each)
                opened += count
            else:
                each = room // length
                first, count = tree.take(room)
            used = min(count, -(-left // each))
            placed = min(left, used * each)
            plan.append(Run(length, rank, each, first, window - room))
            whole = placed // each
            if whole and room - each * length:
                tree.add(room - each * length, first, whole)
            if whole < used and (rest := room - (placed - whole * each) * length):
                tree.add(rest, first + whole, 1)
            if used < count:
                tree.add(room, first + used, count - used)
            rank, left = rank + placed, left - placed
    return plan


def pack(docs: DataFrame, tokenizer_file: str, window: int = WINDOW) -> DataFrame:
    """Pack documents (doc_id, text) into windows of at most ``window`` tokens.

    Returns a row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. Windows fill gapless from offset 0. An empty table gives no
    rows. Pieces of one length are ranked by (doc_id, start, crc), so reruns agree.
    """
    pieces = settled(token_pieces(docs, tokenizer_file, window), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = best_fit_decreasing(counts, window)
    # One sortable key for (length, rank): ranks of a length stay below 2^48.
    keys = np.array([(r.length << 48) + r.rank for r in plan], np.int64)
    order = np.argsort(keys)
    keys = keys[order]
    fields = np.array([[r.rank, r.each, r.first, r.offset] for r in plan], np.int64).reshape(-1, 4)[order]

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, at = length.to_numpy(), rank.to_numpy()
        first_rank, each, first, offset = fields[np.searchsorted(keys, (n << 48) + at, "right") - 1].T
        past = at - first_rank
        return pd.DataFrame({"sequence_id": first + past // each, "offset": offset + past % each * n})

    order_by = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    placed = ranked(pieces, ["length"], order_by, "rank").withColumn("at", place("length", "rank"))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "at.sequence_id", "at.offset")
