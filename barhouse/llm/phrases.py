"""Collocations by prefix-free parsing: phrases are counted in a dictionary of chunks.

A piece of text is cut before words whose hash says so, and each chunk goes on for as many
words into the next one as the longest phrase needs. An n-gram belongs to the chunk in
whose own part it starts, so overlaps count once. Equal chunks become one row of the
dictionary with their frequency, and n-grams are counted there, weighted.

Two scans of the dictionary count them. The first adds up fingerprints of words and word
pairs and marks the frequent ones in a bitmap of fixed size; what isn't marked can't be
frequent, nor anything that holds it. The second counts, as text, the n-grams that only
hold marked pairs. Marks of others cost work, never a count.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from barhouse.llm.common import chunks, settled

LONGEST = 5
LEAST = 100
TOP = 2000
# The language of texts without one, what ends a piece, what parts words.
UNKNOWN = "und"
ENDS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"

# One word in so many starts a chunk.
TRIGGER = 16
# Chunks that a task remembers, n-grams that it sorts at a time, and bytes of text taken from a batch at a time.
HELD_CHUNKS, HELD_GRAMS, CHUNK_BYTES = 1 << 18, 1 << 21, 4 << 20
# Bits of the bitmap that tasks get, and of the parts in which it is put together.
MARK_BITS, PART_BITS = 26, 15

CHUNK = "lang string, tail int, chunk string, own int, count bigint"

_RANDOM = np.random.default_rng(11)
_BYTES = _RANDOM.integers(0, 2**64, (2, 256), np.uint64)
_BASES = [int(b) | 1 for b in _RANDOM.integers(2**62, 2**63, 2)]
_FOLD = bytes(10 if b in ENDS else 32 if b in SPACES else b + 32 if 65 <= b <= 90 else b for b in range(256))


class Triggers(dict):
    """Word (bytes) to whether it starts a chunk."""

    def __missing__(self, word: bytes) -> bool:
        if len(self) >= HELD_CHUNKS:
            self.clear()
        starts = self[word] = crc32(word) % TRIGGER == 0
        return starts


def parsed(text: bytes, triggers: Triggers, longest: int) -> Iterator[tuple[int, int, bytes]]:
    """(words that belong to the next chunk, own words, chunk) of a text."""
    for piece in text.translate(_FOLD).split(b"\n"):
        words = piece.split()
        if not words:
            continue
        starts = [0, *(i for i, word in enumerate(words) if i and triggers[word]), len(words)]
        for a, b in zip(starts, starts[1:], strict=False):
            end = min(b + longest - 1, len(words))
            yield end - b, b - a, b" ".join(words[a:end])


def dictionary(docs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, tail, chunk, own, count): the different chunks, and how often the texts hold each."""

    def rows(held: dict[tuple[str, int, int], Counter]) -> Iterator[pa.RecordBatch]:
        for (lang, tail, own), counts in held.items():
            n = len(counts)
            columns = [
                pa.array([lang] * n, pa.string()),
                pa.array(np.full(n, tail, np.int32)),
                pa.array(list(counts), pa.binary()).cast(pa.string()),
                pa.array(np.full(n, own, np.int32)),
                pa.array(list(counts.values()), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "tail", "chunk", "own", "count"])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triggers, held, size = Triggers(), defaultdict(Counter), 0
        for batch in batches:
            texts, langs = batch.column(0), batch.column(1).to_pylist()
            for a, b in chunks([x.as_py() or 0 for x in pa.compute.binary_length(texts)], CHUNK_BYTES):
                for text, lang in zip(texts.slice(a, b - a).to_pylist(), langs[a:b], strict=True):
                    found = Counter(parsed(text or b"", triggers, longest))
                    for (tail, own, chunk), count in found.items():
                        held[lang, tail, own][chunk] += count
                    size += len(found)
                if size > HELD_CHUNKS:
                    yield from rows(held)
                    held, size = defaultdict(Counter), 0
        yield from rows(held)

    texts = docs.select(F.col("text").cast("binary"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    found = texts.mapInArrow(parse, CHUNK).groupBy("lang", "tail", "chunk", "own").agg(F.sum("count").alias("count"))
    return settled(found, "chunks")


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(base))]))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Grams:
    """The words of some chunks end to end, and fingerprints of any run of them."""

    _up: list[np.ndarray] = [_powers(b, 1) for b in _BASES]
    _down: list[np.ndarray] = [_powers(pow(b, -1, 2**64), 1) for b in _BASES]

    def __init__(self, batch: pa.RecordBatch):
        self.text = text = b"\n".join(batch.column("chunk").cast(pa.binary()).to_pylist())
        data = np.frombuffer(text, np.uint8)
        gaps = np.flatnonzero((data == 32) | (data == 10))
        self.starts, self.ends = np.append(0, gaps + 1), np.append(gaps, len(data))
        # Words of each chunk that follow a word, itself included, and whether the word is in the chunk's own part.
        breaks = np.flatnonzero(np.append(data[gaps] == 10, True))
        sizes = np.diff(np.append(-1, breaks))
        self.chunk = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(self.starts)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.left = sizes[self.chunk] - place
        self.own = place < batch.column("own").to_numpy()[self.chunk]
        self.count = batch.column("count").to_numpy()[self.chunk]
        langs = batch.column("lang").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy()[self.chunk]
        salts = np.array([crc32(x.encode()) << 20 for x in self.langs], np.uint64)
        self._salt = _mixed(salts)[self.lang]
        if len(Grams._up[0]) <= len(data):
            Grams._up = [_powers(b, 2 * len(data)) for b in _BASES]
            Grams._down = [_powers(pow(b, -1, 2**64), 2 * len(data)) for b in _BASES]
        self._data, self._sums = data, {}

    def prints(self, at: np.ndarray, words: int, which: int = 0) -> np.ndarray:
        """Fingerprints of the ``words`` words from each of ``at`` on."""
        if which not in self._sums:
            self._sums[which] = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[which][self._data] * Grams._up[which][: len(self._data)])])
        sums, first, end = self._sums[which], self.starts[at], self.ends[at + words - 1]
        return _mixed((sums[end] - sums[first]) * Grams._down[which][first] + self._salt[at])


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[Grams]:
    for batch in batches:
        for a, b in chunks([x.as_py() for x in pa.compute.binary_length(batch.column("chunk"))], CHUNK_BYTES):
            yield Grams(batch.slice(a, b - a))


def _summed(keys: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of the first, sum of counts) of each run of equal keys, once sorted by the first of them."""
    order = np.argsort(keys[0], kind="stable")
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(new)
    return order[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def frequent_marks(chunk_counts: DataFrame, least: int) -> np.ndarray:
    """Bitmap, as bytes of eight bits, of the fingerprints of words and word pairs that occur at least so often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            keys, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            first, sums = _summed([keys], counts)
            return pa.RecordBatch.from_arrays([pa.array(keys[first].view(np.int64)), pa.array(sums)], ["key", "count"])

        held, size = [], 0
        for grams in _batches(batches):
            for words in (1, 2):
                at = np.flatnonzero(grams.own & (grams.left >= words))
                held.append((grams.prints(at, words), grams.count[at]))
                size += len(at)
            if size > HELD_GRAMS:
                yield rows()
                held, size = [], 0
        if held:
            yield rows()

    def join(table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << PART_BITS, bool)
        bits[table.column("bit").to_numpy() & (1 << PART_BITS) - 1] = True
        return pa.table({"part": table.column("part")[:1], "bits": [np.packbits(bits).tobytes()]})

    counted = chunk_counts.mapInArrow(count, "key bigint, count bigint").groupBy("key").agg(F.sum("count").alias("count"))
    bit = F.pmod("key", F.lit(1 << MARK_BITS)).alias("bit")
    bits = counted.where(F.col("count") >= least).select(bit).distinct().withColumn("part", F.shiftright("bit", PART_BITS))
    marks = np.zeros((1 << MARK_BITS - PART_BITS, 1 << PART_BITS - 3), np.uint8)
    for row in bits.groupBy("part").applyInArrow(join, "part bigint, bits binary").collect():
        marks[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return marks.ravel()


def counted_phrases(chunk_counts: DataFrame, least: int, longest: int) -> DataFrame:
    """(lang, phrase, words, f) of all phrases of up to ``longest`` words that occur at least ``least`` times."""
    shared = chunk_counts.sparkSession.sparkContext.broadcast(frequent_marks(chunk_counts, least))

    def marked(prints: np.ndarray) -> np.ndarray:
        bit = (prints & np.uint64((1 << MARK_BITS) - 1)).astype(np.int64)
        return (shared.value[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1).astype(bool)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grams in _batches(batches):
            n = len(grams.starts)
            pair = np.zeros(n, bool)
            at = np.flatnonzero(grams.left >= 2)
            pair[at] = marked(grams.prints(at, 2))
            at = np.arange(n)
            for words in range(1, longest + 1):
                # Starts of runs of so many words that hold marked pairs only.
                at = at[grams.left[at] >= words]
                at = at[marked(grams.prints(at, 1))] if words == 1 else at[pair[at + words - 2]]
                own = at[grams.own[at]]
                first, sums = _summed([grams.prints(own, words), grams.prints(own, words, 1), grams.lang[own]], grams.count[own])
                rows = own[first]
                spans = zip(grams.starts[rows].tolist(), grams.ends[rows + words - 1].tolist(), strict=True)
                columns = [
                    pa.array([grams.langs[k] for k in grams.lang[rows].tolist()], pa.string()),
                    pa.array([grams.text[a:b] for a, b in spans], pa.binary()).cast(pa.string()),
                    pa.array(np.full(len(rows), words, np.int32)),
                    pa.array(sums),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "words", "f"])

    found = chunk_counts.mapInArrow(count, "lang string, phrase string, words int, f bigint")
    return found.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST) -> DataFrame:
    """The ``top`` collocations of each language of documents (text, lang).

    Returns lang, rank, phrase, a, l, r, n, score: the phrase occurs ``a`` times, its parts at
    the cut that ties it least ``l`` and ``r`` times, all words of the language ``n`` times.
    Phrases inside a longer one of the same count are left out.

    A null text is empty, a null language counts as ``und``. Texts of any length are parsed
    whole; repeated rows count each time. A language without such phrases, and an empty
    table, gives no rows.
    """
    chunk_counts = dictionary(docs, longest)
    phrases = settled(counted_phrases(chunk_counts, least, longest), "phrases")
    words = chunk_counts.groupBy("lang").agg(F.sum(F.col("own") * F.col("count")).alias("n"))
    known = phrases.select("lang", "phrase", "f")
    several = phrases.where("words > 1").withColumnRenamed("f", "a").withColumn("parts", F.split("phrase", " "))
    # What is inside a longer phrase as often is inside one that is longer by a word.
    ends = [F.array_join(F.expr(f"slice(parts, {k}, words - 1)"), " ") for k in (1, 2)]
    inner = several.where("words > 2").select("lang", F.explode(F.array(*ends)).alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    alone = several.join(longer, ["lang", "phrase"], "left").where("longer is null or longer < a")
    cuts = alone.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.expr("slice(parts, 1, k)"), " ").alias("head"),
        F.array_join(F.expr("slice(parts, k + 1, words)"), " ").alias("rest"),
    )
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    score = F.expr("(1000 * cast(a as decimal(38, 0)) * n) div (cast(l as decimal(38, 0)) * r)")
    scored = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).join(words, "lang").withColumn("score", score)
    least_tied = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut")).select("lang", "phrase", "cut.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = least_tied.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))


# The same phrase by phrase.
COLLOCATIONS_SQL = f"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS id, piece FROM (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang,
      unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents)
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::hugeint AS n FROM words GROUP BY lang
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
  SELECT lang, w[i:i + k - 1] AS p, k FROM starts, range(1, {LONGEST + 1}) AS ks(k) WHERE i + k - 1 <= len(w)
), counted AS (
  SELECT lang, p, k, count(*)::hugeint AS f FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}
), candidates AS (
  SELECT lang, p, k, f AS a FROM counted WHERE k > 1
), inside AS (
  SELECT DISTINCT c.lang, c.p FROM candidates c JOIN candidates o ON o.lang = c.lang AND o.k > c.k AND 100 * o.a >= 100 * c.a
  WHERE list_contains(list_transform(range(1, o.k - c.k + 2), lambda s: o.p[s:s + c.k - 1]), c.p)
), cuts AS (
  SELECT c.*, unnest(range(1, c.k)) AS cut FROM candidates c ANTI JOIN inside USING (lang, p)
), scored AS (
  SELECT c.lang, c.p, c.a, c.cut, x.f AS l, y.f AS r, t.n, (1000 * c.a * t.n) // (x.f * y.f) AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.p = c.p[1:c.cut] JOIN counted y ON y.lang = c.lang AND y.p = c.p[c.cut + 1:]
  JOIN totals t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1
), listed AS (
  SELECT *, array_to_string(p, ' ') AS phrase FROM lowest
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::bigint AS rank, phrase,
  a::bigint AS a, l::bigint AS l, r::bigint AS r, n::bigint AS n, score::bigint AS score
FROM listed QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= {TOP}
"""
