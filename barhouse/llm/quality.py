"""Quality rules as a short-circuit cascade.

Rules are pure functions of a text, so their order changes cost and never the verdict. Cost
and selectivity of each are estimated on a sample; the rule that rejects most per second goes
first, and so on among what is left. A document is shown to a rule only if all before passed it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from barhouse.llm.common import chunks

# About so many documents are sampled to order the rules; longer ones are passed over there.
SAMPLE_ROWS = 400
SAMPLE_CHARS = 200_000
CHUNK_BYTES = 4 << 20
GRAM = 5

# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
MEASURES = [part.split()[0] for part in BASE.split(", ")]

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = (_BYTES >= 97) & (_BYTES <= 122)
_SYMBOL = np.isin(_BYTES, list(SYMBOLS.encode()))
# A code point is counted at its first byte; spaces aren't part of words.
_IN_WORD = ((_BYTES < 128) | (_BYTES >= 192)) & ~np.isin(_BYTES, [9, 10, 11, 12, 13, 32])


class Texts:
    """Measures of some UTF-8 texts, each made when first asked for."""

    def __init__(self, texts: Sequence[bytes]):
        self.texts = list(texts)

    def of(self, rows: np.ndarray) -> Texts:
        """Some of the texts, with what is known of them."""
        out = Texts([self.texts[i] for i in rows])
        for name, known in self.__dict__.items():
            if name == "_words":
                out.__dict__[name] = [known[i] for i in rows]
            elif name not in ("texts", "_raw"):
                out.__dict__[name] = known[rows]
        return out

    def _sum(self, kind: np.ndarray) -> np.ndarray:
        ends = np.cumsum([len(t) for t in self.texts])
        total = np.concatenate([[0], np.cumsum(kind[self._raw], dtype=np.int64)])
        return np.diff(total[np.concatenate([[0], ends])]) if len(self.texts) else np.zeros(0, np.int64)

    @cached_property
    def _raw(self) -> np.ndarray:
        return np.frombuffer(b"".join(self.texts), np.uint8)

    @cached_property
    def _words(self) -> list[list[bytes]]:
        return [t.split() for t in self.texts]

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.array([len(w) for w in self._words], np.int64)

    @cached_property
    def word_chars(self) -> np.ndarray:
        return self._sum(_IN_WORD)

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self._sum(_SYMBOL)

    @cached_property
    def n_lines(self) -> np.ndarray:
        """Lines with a word."""
        return np.array([sum(1 for x in t.split(b"\n") if x.strip()) for t in self.texts], np.int64)

    @cached_property
    def n_dup_lines(self) -> np.ndarray:
        kinds = np.array([len({x for x in t.split(b"\n") if x.strip()}) for t in self.texts], np.int64)
        return self.n_lines - kinds

    @cached_property
    def upper_share(self) -> np.ndarray:
        """Of the ASCII letters."""
        upper = self._sum(_UPPER)
        return upper / np.maximum(upper + self._sum(_LOWER), 1)

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        """Words in ``GRAM``-word windows that the text has twice or more."""
        numbers: dict[bytes, int] = {}
        ids = np.array([numbers.setdefault(w, len(numbers)) for words in self._words for w in words], np.uint64)
        doc = np.repeat(np.arange(len(self.texts)), self.n_words)
        covered = np.zeros(len(ids), bool)
        first = np.arange(max(0, len(ids) - GRAM + 1))
        first = first[doc[first] == doc[first + GRAM - 1]]
        if len(first):
            key = doc[first].astype(np.uint64)
            for k in range(GRAM):
                key = (key ^ ids[first + k]) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            order = np.argsort(key, kind="stable")
            run = np.flatnonzero(np.diff(key[order]) == 0)
            one, two = first[order[run]], first[order[run + 1]]
            same = doc[one] == doc[two]
            for k in range(GRAM):
                same &= ids[one + k] == ids[two + k]
            if same.all():
                starts = np.unique(np.concatenate([one, two]))
            else:  # two windows share a key: compare the windows themselves
                windows = np.stack([doc[first].astype(np.uint64), *(ids[first + k] for k in range(GRAM))], axis=1)
                _, kind, times = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
                starts = first[times[kind.ravel()] > 1]
            for k in range(GRAM):
                covered[starts + k] = True
        return np.bincount(doc[covered], minlength=len(self.texts)).astype(np.int64)


@dataclass(frozen=True)
class Rule:
    """Rejects texts; ``base`` rules are those of the base verdict."""

    name: str
    rejects: Callable[[Texts], np.ndarray]
    base: bool = False


def few_words(t: Texts) -> np.ndarray:
    return t.n_words < 10


def repeated_words(t: Texts) -> np.ndarray:
    return 100 * t.n_repeat_words > 20 * t.n_words


def many_symbols(t: Texts) -> np.ndarray:
    return 10 * t.n_symbols > t.n_words


def odd_word_length(t: Texts) -> np.ndarray:
    return (t.word_chars < 2 * t.n_words) | (t.word_chars > 15 * t.n_words)


def repeated_lines(t: Texts) -> np.ndarray:
    return (t.n_dup_lines > 1) & (100 * t.n_dup_lines > 30 * t.n_lines)


def shouting(t: Texts) -> np.ndarray:
    return t.upper_share > 0.7


RULES = (
    Rule("few_words", few_words, base=True),
    Rule("repeated_words", repeated_words, base=True),
    Rule("many_symbols", many_symbols),
    Rule("odd_word_length", odd_word_length),
    Rule("repeated_lines", repeated_lines),
    Rule("shouting", shouting),
)


def order_rules(texts: Sequence[bytes], rules: Sequence[Rule] = RULES) -> list[Rule]:
    """The rule that rejects most of the remaining sample per second first; rules that reject none of it last, cheapest first."""
    left, rules, out = Texts(texts), list(rules), []
    while rules:
        trial = []
        for rule in rules:
            fresh = Texts(left.texts)  # nothing that another rule has measured
            began = time.perf_counter()
            rejected = rule.rejects(fresh)
            cost = max(time.perf_counter() - began, 1e-9)
            trial.append((-rejected.sum() / cost, cost, rule, rejected))
        _, _, rule, rejected = min(trial, key=lambda x: x[:2])
        out.append(rule)
        rules.remove(rule)
        left = left.of(np.flatnonzero(~rejected))
    return out


def run_cascade(texts: Texts, rules: Sequence[Rule], rows: np.ndarray | None = None) -> np.ndarray:
    """Whether each text passes all rules; ``rows`` limits the texts that are looked at, the others fail."""
    kept = np.zeros(len(texts.texts), bool)
    left = np.arange(len(texts.texts)) if rows is None else rows
    part = texts.of(left)
    for rule in rules:
        passed = ~rule.rejects(part)
        if not passed.all():
            left = left[passed]
            part = part.of(np.flatnonzero(passed))
        if not len(left):
            break
    kept[left] = True
    return kept


def planned(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Order rules on about ``rows`` documents (doc_id, text), picked by hash."""
    known = docs.where("text is not null").select("doc_id", "text")
    share = rows / max(1, known.count())
    draw = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    sample = known.where((draw < share) & (F.length("text") <= SAMPLE_CHARS)).select("text").toPandas()["text"]
    return order_rules([t.encode() for t in sample], rules)


def _batches(texts: pa.Array) -> Iterator[Texts]:
    texts = texts.cast(pa.binary())
    for a, b in chunks([x.as_py() or 0 for x in pa.compute.binary_length(texts)], CHUNK_BYTES):
        yield Texts([t or b"" for t in texts.slice(a, b - a).to_pylist()])


def passes(rules: Sequence[Rule], text: Column | str = "text") -> Column:
    """Whether a text (null: empty) passes the rules, in their order."""

    @F.arrow_udf("boolean")
    def cascade(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(np.concatenate([run_cascade(t, rules) for t in _batches(batch)] or [np.zeros(0, bool)]))

    return cascade(text)


def measured(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """doc_id, the base measures, base_failed and kept, for documents (doc_id, text).

    A null text has no words; long texts are measured whole. Base measures are made for all; the other rules see a document
    only if the base rules and all rules before passed it. Repeated rows give repeated rows.
    """
    further = [r for r in rules if not r.base]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _batches(batch.column(1)):
                n = len(texts.texts)
                failed = few_words(texts) | repeated_words(texts)
                kept = run_cascade(texts, further, np.flatnonzero(~failed))
                base = [pa.array(getattr(texts, name)) for name in MEASURES]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), *base, pa.array(failed), pa.array(kept)],
                    ["doc_id", *MEASURES, "base_failed", "kept"],
                )
                at += n

    schema = f"doc_id bigint, {BASE}, base_failed boolean, kept boolean"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(measure, schema)


# The same in SQL: the base measures, then the further rules.
MEASURED_SQL = r"""
with words as (
    select doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines,
           row_number() over () as k
    from documents
), grams as (
    select k, i, list_slice(w, i, i + 4) as g from words, unnest(range(1, greatest(len(w) - 3, 1))) as t(i) where len(w) >= 5
), twice as (
    select k, i from (select k, i, count(*) over (partition by k, g) as n from grams) where n >= 2
), covered as (
    select k, count(distinct i + j) as n from twice, unnest(range(0, 5)) as t(j) group by k
), measured as (
    select doc_id, len(w) as n_words,
           length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as word_chars,
           length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) as n_symbols,
           len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
           coalesce(n, 0) as n_repeat_words,
           length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) as upper,
           length(regexp_replace(coalesce(text, ''), '[^a-z]', '', 'g')) as lower
    from words left join covered using (k)
), judged as (
    select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 10 * n_symbols > n_words or word_chars < 2 * n_words or word_chars > 15 * n_words
            or n_dup_lines > 1 and 100 * n_dup_lines > 30 * n_lines or upper / greatest(upper + lower, 1) > 0.7) as kept
from judged
"""
