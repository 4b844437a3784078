from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from barhouse.llm import language
from barhouse.llm.common import remainder, table
from barhouse.llm.letters import words_of
from tests.llm.cases import ALL_IDS, DE, EN, awkward, clashing, empty, ids

SF = "/root/testdata/sf0.01"


def test_letter_runs():
    words = words_of(["Hello wörld, it's", "", None, " ab%%% Çd\nÉ ", "\U0001d4d0x"])
    assert words.counts.tolist() == [4, 0, 0, 3, 1]
    found = ["".join(map(chr, words.codes[s : s + n])) for s, n in zip(words.starts, words.lengths, strict=True)]
    assert found == ["hello", "wörld", "it", "s", "ab", "çd", "é", "\U0001d4d0x"]


def test_buckets_of_a_word_do_not_depend_on_its_place():
    words = words_of(["one two", "two"])
    alone = words.take(np.array([1]))
    for size in (3, 4, 5):
        grams = words.grams(1 << 20, size)
        assert grams[3:6].tolist() == grams[6:9].tolist() == alone.grams(1 << 20, size).tolist() or size > 3
    assert words.hashes()[1] == words.hashes()[2] == alone.hashes()[0] != words.hashes()[0]


@pytest.fixture(scope="module")
def model(spark):
    text = spark.createDataFrame([(i, EN, "en") for i in range(5)] + [(i, DE, "de") for i in range(5)], "doc_id bigint, text string, lang string")
    return language.fit(text)


def plain_mixture(model, text, languages, rounds=400):
    """EM for one document, a word at a time."""
    words = words_of([text])
    logs = words.sums(model.logp[words.grams(language.BUCKETS)]).astype(float)[:, languages]
    share = np.full(len(languages), 1 / len(languages))
    for _ in range(rounds):
        part = np.exp(logs) * share
        share = (part / part.sum(axis=1, keepdims=True)).mean(axis=0)
    return share, float(np.log((np.exp(logs) * share).sum(axis=1)).sum())


def test_mixture_against_one_document_at_a_time(model):
    texts = [EN, DE, EN + " " + DE, EN + " " + DE + " " + EN, "the", "zzz qqq"]
    share, counts = language.infer(model, texts)
    for k, text in enumerate(texts):
        both, value = plain_mixture(model, text, [0, 1])
        singles = [plain_mixture(model, text, [i])[1] for i in (0, 1)]
        if value - 0.5 * np.log(counts[k] + 1) > max(singles):
            assert share[k] == pytest.approx(both, abs=0.05)
        else:
            assert share[k].tolist() == np.eye(2)[int(np.argmax(singles))].tolist()
    assert 0.2 < share[2][0] < 0.8


def test_awkward_documents(spark, model):
    got = clashing(spark).select("doc_id", language.predict(model).alias("p")).select("doc_id", "p.*")
    assert ids(got) == ALL_IDS
    found = {r["doc_id"]: r for r in got.collect()}
    assert found[4]["lang_pred"] == "de" and found[1]["lang_pred"] == "en" and found[8]["lang_pred"] in ("de", "en")
    assert {found[i]["lang_pred"] for i in (5, 6, 7, 10)} == {"und"} and found[5]["score"] == 0.0
    nothing = language.fit(empty(spark))
    assert {r["p"]["lang_pred"] for r in awkward(spark).select(language.predict(nothing).alias("p")).collect()} == {"und"}
    assert empty(spark).select(language.predict(model)).count() == 0


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents").withColumn("held_out", remainder(F.col("doc_id"), 3) == 1)
    found = docs.where("held_out").select("lang", language.predict(language.fit(docs.where("not held_out"))).alias("p")).toPandas()
    assert np.mean([p["lang_pred"] == lang for p, lang in zip(found["p"], found["lang"], strict=True)]) > 0.98
