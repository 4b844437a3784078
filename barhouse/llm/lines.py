"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

A line is a duplicate if an earlier one has the same words, or if both are long enough and
one word inserted, deleted or replaced makes them equal. Lines within one edit of each other
share the variant that leaves out the edited word, so lines are joined on hashed variants:

* equal lines are one class, known by a 128-bit hash; only its first line goes further,
* a class goes further only if some other class begins or ends with the same half, as it must within one edit,
* every variant with one word left out is emitted under a hash of its words and their places,
* replaced words: classes with the same variant at the same place are all one edit apart,
  so each is joined to the earliest of them and never to all,
* inserted words: a variant is joined to the one class that it equals,
* what was joined is verified word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barhouse.llm.common import WORD, settled, shuffles_freed

# Every line with a word can be a duplicate. Below the second length it must match exactly: of seven
# words, one that differs often is all that a list's or a form's lines say.
MIN_WORDS = 1
MIN_EDIT_WORDS = 8
# Classes with more than this share of all lines can't be more than so many; their lines are dealt out in parts.
HOT_CLASSES, SALTS = 4096, 64
# Bits of a word's term in a variant's hash: sums of 2^23 words fit a bigint. Two such sums make a hash.
TERM_BITS = 40

CLASS = ["h1", "h2"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _words(line: Column) -> Column:
    """Runs of characters other than the six ASCII spaces; a line with blanks only takes no regular expression."""
    other = F.lit(False)
    for space in "\t\x0b\x0c\r":
        other = other | F.contains(line, F.lit(space))
    return F.when(other, F.regexp_extract_all(line, F.lit(WORD), F.lit(0))).otherwise(F.array_remove(F.split(line, " "), ""))


def occurrences(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Each line of at least ``min_words`` words: its document, place, class, and keys of its halves."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_id"), _lines(F.col("text")).alias("lines"))
    # A line without a word is told by its first characters; a count of words here would cut every line twice.
    rows = texts.select("doc_id", "text_id", F.posexplode("lines").alias("line_no", "line")).where(F.col("line").rlike(WORD))
    rows = rows.select("doc_id", "text_id", "line_no", _words(F.col("line")).alias("w")).withColumn("n", F.size("w"))
    rows = rows.where(F.col("n") >= min_words) if min_words > 1 else rows
    less, more = F.floor(F.col("n") / 2).cast("int"), F.ceil(F.col("n") / 2).cast("int")
    shorter, longer = ([F.xxhash64(F.lit(side), F.slice("w", start, size)) for side, start in ((0, F.lit(1)), (1, F.col("n") - size + 1))] for size in (less, more))
    keys = F.when(F.col("n") >= MIN_EDIT_WORDS, F.when(less == more, F.array(*shorter)).otherwise(F.array(*shorter, *longer)))
    return rows.select(
        F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "line_no").alias("at"),
        "text_id", "n", F.xxhash64("w").alias("h1"), F.xxhash64(F.lit(1), "w").alias("h2"), keys.alias("keys"),
    )


def _candidates(classes: DataFrame) -> DataFrame:
    """Classes that share half a line with another one."""
    keyed = classes.where("n >= " + str(MIN_EDIT_WORDS)).select(*CLASS, F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("classes")).where("classes > 1")
    return keyed.join(shared, "key", "left_semi").select(*CLASS).distinct()


def _with_words(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """Add the words of the first line of each class."""
    wanted = firsts.groupBy(F.col("first.doc_id").alias("id"), F.col("text_id").alias("tid")).agg(
        F.collect_list(F.struct(*CLASS, "first", "n")).alias("wanted")
    )
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_id"))
    rows = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_id") == F.col("tid")))
    each = rows.select(_lines(F.col("text")).alias("lines"), F.explode("wanted").alias("c")).select("c.*", F.col("lines")[F.col("c.first.line_no")].alias("line"))
    # Repeated rows give a line more than once.
    return each.withColumn("w", _words(F.col("line"))).drop("line").dropDuplicates(CLASS)


def _terms(place: Column) -> list[Column]:
    """Two hashes of a word at a place, small enough to be added up."""
    return [F.shiftrightunsigned(F.xxhash64(F.lit(k), "word", place), 64 - TERM_BITS) for k in (1, 2)]


def _variants(lines: DataFrame) -> DataFrame:
    """Every line with one word left out: the place left out and the hash of what stays; at place 0 also the line's own hash.

    Half of the class's hash is enough here: what a pair's lines are is verified later.
    """
    words = lines.select("h1", "first", "n", F.posexplode("w").alias("i", "word"))
    here, moved = _terms(F.col("i")), _terms(F.col("i") - 1)
    words = words.select("h1", "first", "n", "i", *(c.alias(f"here{k}") for k, c in enumerate(here)), *(c.alias(f"moved{k}") for k, c in enumerate(moved)))
    by_place = Window.partitionBy("h1", "first").orderBy("i")
    before, after = by_place.rowsBetween(Window.unboundedPreceding, -1), by_place.rowsBetween(1, Window.unboundedFollowing)
    whole = by_place.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    none = F.lit(0).cast("bigint")
    rest = [(F.coalesce(F.sum(f"here{k}").over(before), none) + F.coalesce(F.sum(f"moved{k}").over(after), none)).alias(f"v{k}") for k in (0, 1)]
    own = [F.when(F.col("i") == 0, F.sum(f"here{k}").over(whole)).alias(f"s{k}") for k in (0, 1)]
    return words.select("h1", "first", "n", "i", *rest, *own)


def _pairs(variants: DataFrame) -> DataFrame:
    """(h1 of the later, h1 of the earlier, place): classes that a shared variant joins."""
    me = F.struct("first", "h1")
    same = ["n", "i", "v0", "v1"]
    earliest = variants.groupBy(*same).agg(F.min(me).alias("e"), F.count("*").alias("classes")).where("classes > 1")
    replaced = variants.join(earliest, same).where(F.col("e.first") < F.col("first")).select(
        F.col("h1").alias("late"), F.col("e.h1").alias("early"), "i"
    )
    longer = variants.select(me.alias("b"), (F.col("n") - 1).alias("n"), "i", F.col("v0").alias("s0"), F.col("v1").alias("s1"))
    shorter = variants.where("i = 0").select(me.alias("a"), "n", "s0", "s1")
    met = longer.join(shorter, ["n", "s0", "s1"])
    late, early = F.greatest("a", "b"), F.least("a", "b")
    inserted = met.where(F.col("a.first") != F.col("b.first")).select(
        late["h1"].alias("late"), early["h1"].alias("early"), "i"
    )
    return replaced.unionByName(inserted)


def _without(words: str, place: Column) -> Column:
    return F.concat(F.slice(words, F.lit(1), place), F.slice(words, place + 2, F.size(words)))


def near_classes(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(h1, h2) of classes within one edit of a class that begins earlier."""
    with shuffles_freed(docs.sparkSession):
        lines = settled(_with_words(docs, classes.join(_candidates(classes), CLASS, "left_semi")), "line-words")
        pairs = _pairs(settled(_variants(lines), "variants"))
    early = lines.select(F.col("h1").alias("early"), F.col("w").alias("we"))
    late = lines.select(F.col("h1").alias("late"), *CLASS, F.col("w").alias("wl"))
    # Words to compare go with each pair, so a line meets the others one pair at a time.
    both = pairs.join(late, "late").join(early, "early")
    i, a, b = F.col("i"), F.size("wl"), F.size("we")
    equal = (
        F.when(a == b, _without("wl", i) == _without("we", i))
        .when(a == b + 1, _without("wl", i) == F.col("we"))
        .when(b == a + 1, F.col("wl") == _without("we", i))
        .otherwise(False)
    )
    return both.where(equal).select(*CLASS).distinct()


def duplicate_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_id, removed): sorted places of the duplicate lines of documents (doc_id, text) that have any.

    Lines are ordered by doc_id (null last) and place. A line is removed if any earlier
    line duplicates it, whether or not that one is removed too. Lines that tie, as those of
    repeated rows do, don't remove each other. ``text_id`` is xxhash64 of the text and tells
    texts that share a doc_id apart. Lines of fewer than ``min_words`` words, null and empty texts lose nothing.
    """
    found = settled(occurrences(docs, min_words), "lines")
    classes = found.groupBy(*CLASS).agg(
        F.min(F.struct("at", "text_id")).alias("f"), F.count("*").alias("lines"), F.min("n").alias("n"), F.min("keys").alias("keys")
    )
    classes = settled(classes.select(*CLASS, F.col("f.at").alias("first"), F.col("f.text_id").alias("text_id"), "lines", "n", "keys"), "classes")
    close = near_classes(docs, classes).withColumn("near", F.lit(True))
    with shuffles_freed(docs.sparkSession):
        near = settled(close, "near")
    marked = classes.join(near, CLASS, "left").where("lines > 1 or near").select(*CLASS, "first", "near", "lines")
    total = classes.agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0]
    is_hot = F.col("lines") > total // HOT_CLASSES
    hot = F.broadcast(classes.where(is_hot).select(*CLASS, F.lit(True).alias("hot")))
    # The occurrences of a very common line are dealt out, and its class goes with each part.
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("at"), F.lit(SALTS)).cast("int")).otherwise(0).alias("salt")
    rows = found.select("at", "text_id", *CLASS).join(hot, CLASS, "left").select("at", "text_id", *CLASS, salt)
    salts = F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt")
    met = rows.join(marked.select(*CLASS, "first", "near", salts), [*CLASS, "salt"])
    gone = met.where((F.col("at") > F.col("first")) | F.col("near"))
    # Repeated rows give a place more than once.
    return gone.groupBy(F.col("at.doc_id").alias("doc_id"), "text_id").agg(F.sort_array(F.collect_set("at.line_no")).alias("removed"))


def drop_duplicate_lines(docs: DataFrame) -> DataFrame:
    """Documents without their duplicate lines; all columns stay. Documents that lose every line with a word are dropped."""
    gone = duplicate_lines(docs.select("doc_id", "text")).select(
        F.col("doc_id").alias("__lines_id"), F.col("text_id").alias("__lines_text"), F.col("removed").alias("__lines_gone")
    )
    same = docs["doc_id"].eqNullSafe(F.col("__lines_id")) & (F.xxhash64(docs["text"]) == F.col("__lines_text"))
    lines = _lines(F.col("text"))
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__lines_gone"))
    kept = F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")
    out = docs.join(gone, same, "left").withColumn("text", F.when(F.col("__lines_gone").isNull(), F.col("text")).otherwise(kept))
    return out.where(F.col("__lines_gone").isNull() | F.regexp_like("text", F.lit(WORD))).select(*docs.columns)


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and removed_lines (places, comma-joined) for every document; repeated rows give repeated rows."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_id"), F.coalesce(F.size(_lines(F.col("text"))), F.lit(0)).cast("bigint").alias("n_lines"))
    rows = rows.withColumn("n_lines", F.greatest("n_lines", F.lit(0).cast("bigint")))
    gone = duplicate_lines(docs).withColumnsRenamed({"doc_id": "id", "text_id": "tid"})
    return rows.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_id") == F.col("tid")), "left").select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed_lines"),
    )


# The same in SQL, with variants written out.
REPORT_SQL = r"""
with docs as (select row_number() over () as k, doc_id, text from documents),
lines as (
    select k, doc_id, line_no - 1 as line_no, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as w
    from docs, unnest(string_split(text, chr(10))) with ordinality as t(line, line_no)
), found as (
    select *, {'a': doc_id is null, 'b': coalesce(doc_id, 0), 'c': line_no} as place from lines where len(w) >= 1
), classes as (
    select w, len(w) as n, min(place) as first, row_number() over () as c from found group by w
), variants as (
    select c, first, n, i, w[:i - 1] || w[i + 1:] as v from classes, unnest(range(1, n + 1)) as t(i) where n >= 8
), replaced as (
    select c from (select c, first, min(first) over (partition by n, i, v) as e from variants) where first > e
), inserted as (
    select case when a.first > b.first then a.c else b.c end as c
    from classes a join variants b on a.w = b.v where a.n >= 8
), near as (select distinct c from (select c from replaced union all select c from inserted)),
gone as (
    select distinct k, line_no from found join classes using (w) left join near using (c)
    where place > first or near.c is not null
), removed as (
    select k, count(*) as n_removed, string_agg(line_no, ',' order by line_no) as removed_lines from gone group by k
)
select doc_id, coalesce(len(string_split(text, chr(10))), 0) as n_lines,
       coalesce(n_removed, 0) as n_removed, coalesce(removed_lines, '') as removed_lines
from docs left join removed using (k)
"""
