"""The registered queries: each operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from barhouse.llm import language, licences, lines, mixing, neighbours, packing, phrases, private, quality, simhash, suffixes, toxicity, whitening
from barhouse.llm.common import remainder, table


# Of the registered query alone, which runs on invented data: anyone can read it here.
QUERY_KEY = "public key of the registered query"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    net = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.score(net).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", remainder(F.col("doc_id"), 3) == 1)
    model = language.fit(docs.where("not held_out"))
    found = docs.select("doc_id", "held_out", language.predict(model).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.measured(docs, quality.planned(docs))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), QUERY_KEY)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeat_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_lines": op2_lines,
    "op3_toxicity": op3_toxicity,
    "op4_neighbours": op4_neighbours,
    "op5_licences": op5_licences,
    "op6_mixing": op6_mixing,
    "op7_language": op7_language,
    "op8_quality": op8_quality,
    "op9_packing": op9_packing,
    "op10_private": op10_private,
    "op11_phrases": op11_phrases,
    "op12_whitening": op12_whitening,
    "op13_suffixes": op13_suffixes,
}
ORACLES: dict[str, str] = {
    "op2_lines": lines.REPORT_SQL,
    "op5_licences": licences.scan_sql(),
    "op8_quality": quality.MEASURED_SQL,
    "op11_phrases": phrases.COLLOCATIONS_SQL,
    "op13_suffixes": suffixes.REPORT_SQL,
}
