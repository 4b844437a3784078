"""Removal of repeated byte strings by a logarithmic family of suffix arrays.

Suffixes are sampled by content. Of the ``SPAN - PREFIX + 1`` prefixes of a window of
``SPAN`` bytes, the one with the smallest hash is the window's anchor, so equal windows
have equal anchors at equal places. Neighbouring windows with one anchor make an entry:
a suffix, ordered by the fingerprint of its first ``PREFIX`` bytes, then by that of all
bytes that its windows cover. An array holds the first occurrence of each entry.

Documents come in batches by doc_id. A batch's entries are merged with the existing
arrays in one sorted scan: an entry met before is a long match, and all of it is
removed. Arrays as large as the batch are merged with it on the way, so there is one
for each power of two, and each entry is rewritten a logarithmic number of times.

An entry that shares its prefix, but not all of its bytes, with another may share some
windows. Such entries are cut into blocks of ``BLOCK`` windows. What all windows of a
block have in common is its core; blocks that are not alone with their core are compared
window by window. Fingerprints of 128 bits decide, in both steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barhouse.llm.common import chunks, settled, shuffles_freed

SPAN = 100
BATCHES = 4
# Bytes of a prefix; the shorter, the fewer entries, and the more of them share one.
PREFIX = 32
# Windows of a block. Seven bytes on either side of a core fit a number of 64 bits.
BLOCK = 8
# Windows looked at in one step, rows that a task sorts at a time, and bytes of text taken from a batch at a time.
STEP = 1 << 20
BUFFER = 1 << 20
CHUNK_BYTES = 4 << 20

# Kinds of rows: an entry of the batch, of an array that is merged, of one that stays; a removed span; an entry that shares its prefix.
NEW, MERGED, STAYS, GONE, SHARED = range(5)
# A place ``at`` holds the start, the number of windows less one, and bits that tell texts with one doc_id apart.
COUNT_BITS, MARK_BITS = 7, 16
AT_BITS = COUNT_BITS + MARK_BITS

ROW = "kind tinyint, h bigint, c bigint, doc bigint, at bigint"
CORE = "core bigint, near bigint, far bigint, doc bigint, at bigint"

_RANDOM = np.random.default_rng(13)
_BYTES = _RANDOM.integers(0, 2**64, 256, np.uint64)
_BASE = int(_RANDOM.integers(2**62, 2**63)) | 1
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(base))]))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Fingerprints of any substring of a text from sums over its beginnings, modulo 2^64."""

    _up, _down = _powers(_BASE, 1), _powers(pow(_BASE, -1, 2**64), 1)

    def __init__(self, text: bytes):
        n = len(text)
        if len(Rolling._up) <= n:
            Rolling._up, Rolling._down = _powers(_BASE, 2 * n), _powers(pow(_BASE, -1, 2**64), 2 * n)
        self.bytes = np.frombuffer(text, np.uint8)
        self._sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[self.bytes] * Rolling._up[:n])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self._sums[end] - self._sums[start]) * Rolling._down[start]

    def all(self, first: int, end: int, length: int) -> np.ndarray:
        """Of every substring of ``length`` that starts in first..end-1."""
        return (self._sums[first + length : end + length] - self._sums[first:end]) * Rolling._down[first:end]


@dataclass
class Entries:
    """Those of one text: first window, number of windows, place of the anchor."""

    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray


def entries_of(sums: Rolling, span: int, prefix: int) -> Entries:
    windows = len(sums.bytes) - span + 1
    parts = []
    for first in range(0, max(windows, 0), STEP):
        end = min(first + STEP, windows)
        hashes = mixed(sums.all(first, end + span - prefix, prefix))
        # The smallest upper half, then the leftmost place.
        least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        wide, want = 1, span - prefix + 1
        while 2 * wide <= want:
            least, wide = np.minimum(least[:-wide], least[wide:]), 2 * wide
        if wide < want:
            least = np.minimum(least[: wide - want], least[want - wide :])
        anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        cut = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
        parts.append((first + cut, np.diff(np.append(cut, len(anchor))), first + anchor[cut]))
    return Entries(*(np.concatenate(x) if parts else np.empty(0, np.int64) for x in (zip(*parts) if parts else [()] * 3)))


def _bits(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _rows(kind: int, h: np.ndarray, c: np.ndarray, doc: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.full(len(h), kind, np.int8)), *(pa.array(_bits(x)) for x in (h, c, doc, at))]
    return pa.RecordBatch.from_arrays(columns, ["kind", "h", "c", "doc", "at"])


def _new_run(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted table starts a run of equal values."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in columns])
    return out


def _gone(doc: np.ndarray, start: np.ndarray, length: np.ndarray, mark: np.ndarray) -> pa.RecordBatch:
    """Rows of removed spans, those that touch or overlap in a text joined; they travel by document."""
    order = np.lexsort((start, mark, doc))
    doc, start, length, mark = (x[order] for x in (doc, start, length, mark))
    # Ends never fall inside a text: spans of equal length, or of entries in their order.
    cut = _new_run(doc, mark)
    cut[1:] |= start[1:] > (start + length)[:-1]
    first = np.flatnonzero(cut)
    ends = np.maximum.reduceat(start + length, first) if len(first) else start
    doc, at = doc[first], start[first] << AT_BITS | mark[first]
    return _rows(GONE, mixed(doc.astype(np.uint64)), ends, doc, at)


@dataclass
class Firsts:
    """Rows waiting to be sorted; of equal (h, c) the earliest passes, the others are removed spans.

    One such step in each task keeps what many documents share down to a row per task.
    """

    span: int
    rows: list[tuple[np.ndarray, ...]] = field(default_factory=list)
    held: int = 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.rows.append(columns)
        self.held += len(columns[0])
        if self.held >= BUFFER:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            h, c, doc, at = (np.concatenate(x) for x in zip(*self.rows, strict=True))
            order = np.lexsort((at, doc, c, h))
            h, c, doc, at = (x[order] for x in (h, c, doc, at))
            first, late = earliest(h, c, doc, at)
            yield _rows(NEW, h[first], c[first], doc[first], at[first])
            yield _late_spans(doc[late], at[late], self.span)
        self.rows, self.held = [], 0


def earliest(h: np.ndarray, c: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted rows, which are at the first place of their (h, c), and which are at a later one.

    Texts that share a doc_id may have one first place; equal rows count once.
    """
    run, place = _new_run(h, c), at >> AT_BITS
    leader = np.flatnonzero(run)[np.cumsum(run) - 1]
    late = (doc != doc[leader]) | (place != place[leader])
    return ~late & _new_run(h, c, doc, at), late


def _late_spans(doc: np.ndarray, at: np.ndarray, span: int) -> pa.RecordBatch:
    return _gone(doc, at >> AT_BITS, (at >> MARK_BITS & (1 << COUNT_BITS) - 1) + span, at & (1 << MARK_BITS) - 1)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, bytes]]:
    """Each row of (text, ...) with its text; few texts are copied out of Arrow at a time."""
    for batch in batches:
        texts = batch.column(0)
        for a, b in chunks([x.as_py() or 0 for x in pa.compute.binary_length(texts)], CHUNK_BYTES):
            for i, text in enumerate(texts.slice(a, b - a).to_pylist(), a):
                yield batch, i, text or b""


def batch_rows(docs: DataFrame, span: int, prefix: int) -> DataFrame:
    """Entries of (text, doc, mark), and spans that repeat within a task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = Firsts(span)
        for batch, i, text in _texts(batches):
            if len(text) < span:
                continue
            sums = Rolling(text)
            found = entries_of(sums, span, prefix)
            h = mixed(sums.of(found.anchor, found.anchor + prefix))
            c = mixed(sums.of(found.start, found.start + found.count - 1 + span) + found.count.astype(np.uint64))
            at = found.start << AT_BITS | (found.count - 1) << MARK_BITS | batch.column(2)[i].as_py()
            yield from firsts.add(_bits(h), _bits(c), np.full(len(h), batch.column(1)[i].as_py()), at)
        yield from firsts.flush()

    return docs.mapInArrow(scan, ROW)


def merge_scan(rows: DataFrame, span: int) -> DataFrame:
    """Sorted rows in, by (h, c, doc, at); entries to keep, removed spans and entries that share their prefix out.

    Only one row is carried from batch to batch, however many have one prefix.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, shares = None, False
        for batch in batches:
            kind, h, c, doc, at = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
            gone = kind == GONE
            if gone.any():
                yield batch.filter(pa.array(gone))
                kind, h, c, doc, at = (x[~gone] for x in (kind, h, c, doc, at))
            if carried is not None:
                kind, h, c, doc, at = (np.append(x, y) for x, y in zip(carried, (kind, h, c, doc, at), strict=True))
            if len(h) == 0:
                continue
            first, late = earliest(h, c, doc, at)
            yield _late_spans(doc[late], at[late], span)
            kind, h, c, doc, at = (x[first] for x in (kind, h, c, doc, at))
            same = h[1:] == h[:-1]
            shared = np.append(False, same) | np.append(same, False)
            shared[0] |= shares
            for which, name in ((kind < STAYS, NEW), (shared, SHARED)):
                which = which[:-1]
                yield _rows(name, *(x[:-1][which] for x in (h, c, doc, at)))
            carried, shares = tuple(x[-1:] for x in (kind, h, c, doc, at)), bool(shared[-1])
        if carried is not None:
            kind, *rest = carried
            if kind[0] < STAYS:
                yield _rows(NEW, *rest)
            if shares:
                yield _rows(SHARED, *rest)

    return rows.repartition("h").sortWithinPartitions("h", "c", "doc", "at").mapInArrow(scan, ROW)


@dataclass
class Family:
    """Sorted arrays by size, largest first; a size is a number of batches."""

    span: int = SPAN
    prefix: int = PREFIX
    arrays: list[tuple[int, DataFrame]] = field(default_factory=list)

    def add(self, docs: DataFrame, last: bool = False) -> DataFrame:
        """Scan a batch of (text, doc, mark), whose docs come after all before it, and take it in.

        Returns rows of removed spans and of entries that share their prefix. Of the last
        batch, nothing is kept.
        """
        size, merged = 1, []
        while self.arrays and self.arrays[-1][0] == size:
            merged.append(self.arrays.pop()[1])
            size *= 2
        rows = batch_rows(docs, self.span, self.prefix)
        for array, kind in [*((x, MERGED) for x in merged), *((x, STAYS) for _, x in self.arrays)]:
            rows = rows.unionByName(array.withColumn("kind", F.lit(kind).cast("tinyint")))
        scanned = merge_scan(rows, self.span)
        with shuffles_freed(docs.sparkSession):
            out = settled(scanned.where(F.col("kind") != NEW) if last else scanned, "suffixes")
        if not last:
            self.arrays.append((size, out.where(F.col("kind") == NEW)))
        return out.where(F.col("kind") != NEW)


def _number(sums: Rolling, start: np.ndarray) -> np.ndarray:
    """The BLOCK - 1 bytes from ``start`` on as a number, the first one highest; bytes outside of the text count as zero."""
    out = np.zeros(len(start), np.uint64)
    n = len(sums.bytes)
    for k in range(BLOCK - 1):
        at = start + k
        inside = (at >= 0) & (at < n)
        out = out << np.uint64(8) | np.where(inside, sums.bytes[np.clip(at, 0, n - 1)], 0).astype(np.uint64)
    return out


def block_rows(shared: DataFrame, docs: DataFrame, span: int, prefix: int) -> DataFrame:
    """Blocks of the entries that share their prefix.

    Window ``t`` of a block starts ``t`` bytes before the core: it is the last ``t`` of the
    bytes ``near`` before the core, the core, and the first of those after it, ``far``. The
    windows that the entry has are the upper eight bits of ``near``.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, text in _texts(batches):
            sums = Rolling(text)
            found = entries_of(sums, span, prefix)
            wanted = np.isin(found.start, np.array(batch.column(3)[i].as_py(), np.int64))
            start, count, anchor = found.start[wanted], found.count[wanted], found.anchor[wanted]
            # Distances from the window's start to the anchor run from the last window's to the first one's.
            least, most = anchor - start - count + 1, anchor - start
            each = most // BLOCK - least // BLOCK + 1
            of = np.repeat(np.arange(len(start)), each)
            block = np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each) + (least // BLOCK)[of]
            core = anchor[of] - BLOCK * block
            low, high = np.maximum(least[of] - BLOCK * block, 0), np.minimum(most[of] - BLOCK * block, BLOCK - 1)
            windows = (np.uint64(2) << high.astype(np.uint64)) - (np.uint64(1) << low.astype(np.uint64))
            held = mixed(sums.of(core, core + span - BLOCK + 1)) ^ mixed(block.astype(np.uint64))
            near = windows << np.uint64(56) | _number(sums, core - BLOCK + 1)
            columns = held, near, _number(sums, core + span - BLOCK + 1), np.full(len(of), batch.column(1)[i].as_py()), core << AT_BITS | batch.column(2)[i].as_py()
            yield pa.RecordBatch.from_arrays([pa.array(_bits(x)) for x in columns], ["core", "near", "far", "doc", "at"])

    mark = F.col("at").bitwiseAND(F.lit((1 << MARK_BITS) - 1))
    places = shared.groupBy("doc", mark.alias("mark")).agg(F.collect_set(F.shiftright("at", AT_BITS)).alias("starts"))
    return docs.join(places, ["doc", "mark"]).select("text", "doc", "mark", "starts").mapInArrow(cut, CORE)


def window_rows(blocks: DataFrame, span: int) -> DataFrame:
    """Windows of blocks that aren't alone with their core, fingerprinted; only one row is carried along a core."""
    ends = np.uint64((1 << 56) - 1)

    def windows(core, near, far, doc, at) -> Iterator[tuple[np.ndarray, ...]]:
        core, near, far = (x.view(np.uint64) for x in (core, near, far))
        for t in range(BLOCK):
            has = (near >> np.uint64(56 + t) & np.uint64(1)).astype(bool)
            before = near[has] & np.uint64((1 << 8 * t) - 1)
            after = (far[has] & ends) >> np.uint64(8 * t)
            h = mixed(mixed(core[has] + np.uint64(t)) ^ mixed(before) * _MIX[0] ^ after)
            c = mixed(mixed(mixed(after + np.uint64(t)) ^ before) ^ core[has] * _MIX[1])
            start = (at[has] >> AT_BITS) - t
            yield _bits(h), _bits(c), doc[has], start << AT_BITS | at[has] & (1 << MARK_BITS) - 1

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, carried, shares = Firsts(span), None, False
        for batch in batches:
            rows = [x.to_numpy() for x in batch.columns]
            if carried is not None:
                rows = [np.append(x, y) for x, y in zip(carried, rows, strict=True)]
            if len(rows[0]) == 0:
                continue
            same = rows[0][1:] == rows[0][:-1]
            shared = np.append(False, same) | np.append(same, False)
            shared[0] |= shares
            carried, shares = [x[-1:] for x in rows], bool(shared[-1])
            shared[-1] = False
            for columns in windows(*(x[shared] for x in rows)):
                yield from firsts.add(*columns)
        if carried is not None and shares:
            for columns in windows(*carried):
                yield from firsts.add(*columns)
        yield from firsts.flush()

    return blocks.repartition("core").sortWithinPartitions("core").mapInArrow(explode, ROW)


def _placed(docs: DataFrame) -> DataFrame:
    """Add ``doc``, the order of documents, and ``mark``, which tells texts with one doc_id apart."""
    doc = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(2**63 - 1))
    return docs.withColumns({"doc": doc, "mark": F.xxhash64("text").bitwiseAND(F.lit((1 << MARK_BITS) - 1))})


def repeated_spans(docs: DataFrame, span: int = SPAN, batches: int = BATCHES, prefix: int = PREFIX) -> DataFrame:
    """(doc, mark, start, end) of what repeats earlier text; spans of one text may overlap. ``docs`` are placed."""
    cuts = docs.where("doc_id is not null").approxQuantile("doc", [k / batches for k in range(1, batches)], 0.01) if batches > 1 else []
    cuts = sorted({int(x) for x in cuts})
    family, found = Family(span, prefix), []
    texts = docs.select(F.col("text").cast("binary").alias("text"), "doc", "mark")
    for k, (low, high) in enumerate(zip([None, *cuts], [*cuts, None], strict=True)):
        batch = texts if low is None else texts.where(F.col("doc") > low)
        batch = batch if high is None else batch.where(F.col("doc") <= high)
        found.append(family.add(batch, last=k == len(cuts)))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    blocks = block_rows(rows.where(F.col("kind") == SHARED), texts, span, prefix)
    with shuffles_freed(docs.sparkSession):
        windows = settled(merge_scan(window_rows(blocks, span), span).where(F.col("kind") == GONE), "windows")
    gone = rows.where(F.col("kind") == GONE).unionByName(windows)
    mark = F.col("at").bitwiseAND(F.lit((1 << MARK_BITS) - 1))
    return gone.select("doc", mark.alias("mark"), F.shiftright("at", AT_BITS).alias("start"), F.col("c").alias("end"))


def drop_repeats(docs: DataFrame, span: int = SPAN, batches: int = BATCHES, prefix: int = PREFIX) -> DataFrame:
    """Take out of each text all bytes that lie in a string of ``span`` bytes that also starts earlier.

    Earlier is in a document of smaller doc_id, or in the same one at an earlier place.
    Strings are judged on the input; overlaps count. Returns all columns, and kept (binary,
    what is left; a character may lose some of its bytes), n_bytes, n_removed, n_spans, in
    the place of columns that are already called so.

    A null text is empty. Documents without an id come after all others and count as one,
    as do rows that share a doc_id: equal rows all lose what the first of them loses, and of
    different ones, only the place inside the text says which is earlier. Texts shorter than
    ``span`` stay. Long texts are read whole, in steps. An empty table gives no rows.
    """
    extra = ["kept", "n_bytes", "n_removed", "n_spans"]
    placed = _placed(docs.select("doc_id", "text", F.struct(*docs.columns).alias("__row")))
    spans = repeated_spans(placed, span, batches, prefix)
    lists = spans.groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = placed.join(lists, ["doc", "mark"], "left")

    @F.arrow_udf("kept binary, n_bytes bigint, n_removed bigint, n_spans bigint")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        kept, counts = [], np.zeros((3, len(texts)), np.int64)
        for i, (text, found) in enumerate(zip(texts.cast(pa.binary()), spans, strict=True)):
            text = text.as_py() or b""
            edges = np.zeros(len(text) + 1, np.int32)
            if found.is_valid:
                flat = found.values
                np.add.at(edges, flat.field("start").to_numpy(), 1)
                np.subtract.at(edges, flat.field("end").to_numpy(), 1)
            gone = np.cumsum(edges[:-1]) > 0
            kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
            counts[:, i] = len(text), gone.sum(), (gone & ~np.append(False, gone[:-1])[: len(gone)]).sum()
        return pa.StructArray.from_arrays([pa.array(kept, pa.binary()), *map(pa.array, counts)], extra)

    done = joined.withColumn("__cut", cut("text", "spans"))
    return done.select(*(F.col(f"__row.{c}").alias(c) for c in docs.columns if c not in extra), *(F.col(f"__cut.{c}").alias(c) for c in extra))


def repeat_report(docs: DataFrame) -> DataFrame:
    """What ``drop_repeats`` takes out, per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    done = drop_repeats(docs.select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# The same string by string, over hexadecimal digits, for tables with unique ids.
REPORT_SQL = f"""
WITH t AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents
), strings AS (
  SELECT doc_id, n, unnest(range(0, n - {SPAN} + 1)) AS i, x FROM t WHERE n >= {SPAN}
), ordered AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY substr(x, 2 * i + 1, {2 * SPAN}) ORDER BY doc_id, i) AS place FROM strings
), late AS (
  SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {SPAN}, -1) AS opens FROM ordered WHERE place > 1
), runs AS (
  SELECT doc_id, i, sum(opens::int) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM late
), spans AS (
  SELECT doc_id, run, min(i) AS a, max(i) + {SPAN} AS b FROM runs GROUP BY ALL
), pieces AS (
  SELECT doc_id, run, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS kept_from FROM spans
), kept AS (
  SELECT doc_id, string_agg(substr(x, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a) AS head, sum(b - a) AS removed, count(*) AS spans, max(b) AS rest
  FROM pieces JOIN t USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n::bigint AS n_bytes, coalesce(removed, 0)::bigint AS n_removed, coalesce(spans, 0)::bigint AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(rest, 0) + 1))) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)
"""
