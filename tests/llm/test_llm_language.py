import math
import zlib
from collections import Counter, defaultdict
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakeops.llm import langid
from llm_cases import edge_docs, no_docs


@pytest.fixture(scope="module")
def toy(spark):
    rows = [(i, t, la) for i, (t, la) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"),
                                                    ("the house", "en"), ("das haus", "de")] * 5)]
    return langid.fit(spark.createDataFrame(rows, "id long, text string, lang string"))


def test_known_words_first(toy):
    assert toy.languages == ["de", "en"]
    assert toy.predict("the dog")[0] == "en" and toy.predict("DER HUND")[0] == "de"
    n = {"the": 15}
    row = toy.words.logs[toy.words.row["the"]]
    en = sum(15 if w == "the" else 5 for w in ("the", "cat", "and", "dog", "house"))
    assert row[1] == pytest.approx(np.log((n["the"] + 0.5) / (en + 0.5 * len(toy.words.row))))


def test_unseen_words_back_off_to_the_longest_known_grams(toy):
    assert "hunde" not in toy.words.row
    known = [g for g in langid.grams_of("hunde", 5) if g in toy.grams[4].row]
    assert known == ["^hund"]
    assert toy.backed_off("hunde") == pytest.approx(toy.grams[4].logs[toy.grams[4].row["^hund"]])
    assert toy.predict("hunde")[0] == "de"
    assert (toy.backed_off("日本") == toy.backed_off("本日")).all()  # only its edges are known


def test_undetermined(toy):
    for text in (None, "", "  ", "123 !?", "٣"):
        assert toy.predict(text) == (langid.UNDETERMINED, 0.0)


def test_predictions_use_the_text_alone(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.learn_from_documents(docs)
    judged = docs.select("doc_id", "lang", langid.held_out(F.col("doc_id")).alias("h"),
                         langid.predict_column(spark, model, F.col("text")).alias("p"))
    rows = judged.where("h").collect()
    assert len(rows) > 20 and np.mean([r.p.lang_pred == r.lang for r in rows]) >= 0.95
    assert all(0 <= r.p.score <= 1 for r in rows)


def test_held_out_is_crc32_of_the_id(spark):
    import zlib
    got = {r.id: r.h for r in spark.range(50).select("id", langid.held_out(F.col("id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)}


def test_edges(spark):
    docs = edge_docs(spark)
    model = langid.learn_from_documents(docs)
    assert docs.select(langid.predict_column(spark, model, F.col("text"))).count() == 12
    nothing = langid.learn_from_documents(no_docs(spark))
    assert nothing.predict("the dog") == (langid.UNDETERMINED, 0.0)


def test_sample_is_bounded(spark):
    rows = spark.range(5000).select(F.col("id"), F.concat(F.lit("w"), F.col("id").cast("string"), F.lit("x"),
                                                          F.lit(" kept")).alias("text"), F.lit("en").alias("lang"))
    model = langid.fit(rows.withColumn("text", F.translate("text", "0123456789", "abcdefghij")),
                       rows_per_language=500, max_words=100)
    assert len(model.words.row) == 100 and "kept" in model.words.row


def plain_words(text):
    return ["".join(run) for is_letter, run in groupby(text.lower(), lambda c: c.isalnum() and not c.isdecimal()) if is_letter]


def plain_grams(word, n):
    return ["".join(x) for x in zip(*[f"^{word}$"[i:] for i in range(n)])]


class Plain:
    """Counts of every learned word and n-gram, looked up one by one."""

    def __init__(self, rows):
        self.languages = sorted({lang for _, lang in rows})
        self.counts = [defaultdict(Counter) for _ in range(6)]  # 0: words, else n-grams
        for text, lang in rows:
            for word in plain_words(text or ""):
                self.counts[0][word][lang] += 1
                for n in range(1, 6):
                    for gram in plain_grams(word, n):
                        self.counts[n][gram][lang] += 1
        self.totals = [Counter() for _ in range(6)]
        for level, total in zip(self.counts, self.totals):
            for by in level.values():
                total.update(by)

    def log(self, n, item, lang):
        return math.log((self.counts[n][item][lang] + 0.5) / (self.totals[n][lang] + 0.5 * len(self.counts[n])))

    def added(self, word, lang):
        if word in self.counts[0]:
            return self.log(0, word, lang)
        for n in range(5, 0, -1):
            known = [g for g in plain_grams(word, n) if g in self.counts[n]]
            if known:
                return sum(self.log(n, g, lang) for g in known) / len(known)
        return 0.0

    def predict(self, text):
        if not any(c.isalpha() for c in text or ""):
            return "und", 0.0
        scores = [math.fsum(self.added(w, lang) for w in plain_words(text)) for lang in self.languages]
        best = max(scores)
        return self.languages[scores.index(best)], 1 / math.fsum(math.exp(s - best) for s in scores)


def test_against_brute_force(spark):
    """Whole documents, half of them with words that no text taught, against plain counts of all labelled rows."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn(
        "text", F.when(F.col("doc_id") % 2 == 0, F.translate("text", "eo", "o")).otherwise(F.col("text")))
    rows = docs.select("doc_id", "text", "lang").collect()
    plain = Plain([(r.text, r.lang) for r in rows if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 5])
    model = langid.learn_from_documents(docs)
    got = {r.doc_id: r.p for r in docs.select(
        "doc_id", langid.predict_column(spark, model, F.col("text")).alias("p")).collect()}
    texts = {r.doc_id: r.text for r in rows if len(r.text or "") < 3000}
    assert len(texts) > 60
    for doc, text in texts.items():
        lang, score = plain.predict(text)
        assert (got[doc].lang_pred, got[doc].score) == (lang, pytest.approx(score, abs=1e-9)), doc


def test_every_item_of_the_sample_is_known(spark):
    rows = [(i, " ".join(f"{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{chr(97 + j)}word" for j in range(26)), "en") for i in range(600)]
    model = langid.fit(spark.createDataFrame(rows, "id long, text string, lang string"))
    assert set(model.words.row) == {w for _, t, _ in rows for w in t.split()}
