"""Awkward documents that every operator must take, and small brute-force helpers."""

from __future__ import annotations

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use inside or return; as extra columns they must do no harm.
CLASHING = "size bigint, n string, fingerprint string, lang_pred int, score string, k string, w string, line string, rank int, n_private string"

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
EN = "The quick brown fox jumps over the lazy dog while the old farmer is watching from the gate."
DE = "Der schnelle braune Fuchs springt über den faulen Hund, während der alte Bauer vom Tor aus zusieht."

ROWS = [
    (1, EN, "en", "a", 10),
    (2, EN, "en", "a", 10),
    (2, EN, "en", "a", 10),
    (3, EN.replace("lazy", "sleepy"), "en", None, None),
    (4, DE, "de", "b", 5),
    (5, None, None, None, None),
    (6, "", "de", "b", 0),
    (7, " \t\n ", "en", "a", 4),
    (None, EN, "en", "b", 3),
    (None, None, None, None, None),
    (8, LONG, "en", "b", 9),
    (9, "word", "en", "c", 4),
    (10, "12 34 !!", None, "c", 4),
    (11, "\n".join([EN, DE, EN, "short line", "short line"]), "de", "c", 7),
    (-12, "naïve Ünḯ \U0001d4d0 x\x1fy z\x85q", "fr", "ü", 7),
]


def awkward(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def clashing(spark):
    """The same with more columns, all null."""
    from pyspark.sql import functions as F

    extra = [F.lit(None).cast(kind).alias(name) for name, kind in (c.split() for c in CLASHING.split(", "))]
    return awkward(spark).select("*", *extra)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=lambda x: (x is None, x))


ALL_IDS = sorted((r[0] for r in ROWS), key=lambda x: (x is None, x))
