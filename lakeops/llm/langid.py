"""Language identification: known words first, then ever shorter character n-grams.

A word seen in training adds its log frequency in each language.  An unseen
word is split into n-grams of the longest length of which the model knows at
least one, and adds the mean of their log frequencies; if not even one of its
characters is known it adds nothing.

The model is fitted on a bounded sample of the labelled rows: about
``rows_per_language`` of each language, chosen by a hash of their id, with their
whole texts, and knows every word and n-gram of these.  Its size is bounded by the
sample's, whatever the table's; that is why it may be broadcast.  ``max_words`` and
``max_grams`` (of each length; the most frequent, ties by code point) make a smaller
one where asked for.  Prediction reads every row and its whole text, and the text alone.

Nulls and edges: a null text, or one without a letter, is ``und`` with score 0;
rows without language are not learned from; repeated rows get equal
predictions; ties go to the smaller language name; texts of any length are read
whole.  If nothing can be learned every text is ``und``.  An empty table gives an
empty result.  Only ``doc_id``, ``text`` and ``lang`` are read, so clashing names of
others do not matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.common import materialise

UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")
MAX_N = 5
# Words whose contribution a worker keeps; beyond it the memory is emptied.
_REMEMBERED = 1 << 18


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    """The ``n``-grams of a word between its edges."""
    framed = f"^{word}$"
    return [framed[i:i + n] for i in range(len(framed) - n + 1)]


class Table:
    """Log frequencies of items by language."""

    def __init__(self, items: list[str], logs: np.ndarray):
        self.row = {item: i for i, item in enumerate(items)}
        self.logs = logs


class Model:
    """``words``, and ``grams`` by length from 1."""

    def __init__(self, languages: list[str], words: Table, grams: list[Table]):
        self.languages, self.words, self.grams = languages, words, grams
        self.unseen: dict[str, np.ndarray] = {}

    def backed_off(self, word: str) -> np.ndarray:
        """What an unseen word adds to the log likelihood of each language."""
        for n in range(len(self.grams), 0, -1):
            table = self.grams[n - 1]
            rows = [table.row[g] for g in grams_of(word, n) if g in table.row]
            if rows:
                return table.logs[rows].mean(axis=0)
        return np.zeros(len(self.languages))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and posterior probability of a whole text."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        rows, times, backed, backed_times = [], [], [], []
        for word, n in Counter(words_of(text)).items():
            row = self.words.row.get(word)
            if row is not None:
                rows.append(row)
                times.append(n)
                continue
            added = self.unseen.get(word)
            if added is None:
                if len(self.unseen) >= _REMEMBERED:
                    self.unseen.clear()
                added = self.unseen[word] = self.backed_off(word)
            backed.append(added)
            backed_times.append(n)
        total = np.zeros(len(self.languages))
        if rows:
            total += np.array(times, float) @ self.words.logs[rows]
        if backed:
            total += np.array(backed_times, float) @ np.array(backed)
        best = int(np.argmax(total))
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def _table(counts: DataFrame, languages: list[str], most: int | None) -> Table:
    """Of ``counts(item, lang, n)``, the ``most`` frequent items (None: all)."""
    top = counts.groupBy("item").agg(F.sum("n").alias("total"), F.map_from_entries(
        F.collect_list(F.struct("lang", "n"))).alias("by"))
    if most is not None:
        top = top.orderBy(F.desc("total"), "item").limit(most)
    rows = top.select("item", *[F.coalesce(F.col("by")[lang], F.lit(0)).cast("double").alias(f"n{i}")
                                for i, lang in enumerate(languages)]).toArrow()
    n = np.column_stack([rows[f"n{i}"].to_numpy() for i in range(len(languages))])
    return Table(rows["item"].to_pylist(), np.log((n + 0.5) / (n.sum(axis=0) + 0.5 * max(1, len(rows)))))


def fit(labelled: DataFrame, rows_per_language: int = 1000, max_words: int | None = None,
        max_grams: int | None = None) -> Model:
    """Learn from ``labelled(id, text, lang)``; ``lang`` is not null."""
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], Table([], np.zeros((0, 0))), [])
    # The share of a language's ids that is sampled, as a bound on their hashes.
    shares = F.create_map(*[x for lang in languages for x in (
        F.lit(lang), F.lit(min(1.0, rows_per_language / sizes[lang])))])
    sample = labelled.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < shares[F.col("lang")] * (1 << 30))
    words = materialise(sample.select("lang", F.explode(_words(F.col("text"))).alias("item"))
                        .groupBy("item", "lang").agg(F.count("*").alias("n")), "langid-words")
    framed = words.select("lang", "n", F.concat(F.lit("^"), "item", F.lit("$")).alias("w"))
    tables = [_table(words, languages, max_words)]
    for size in range(1, MAX_N + 1):
        last = F.char_length("w") - size + 1
        starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        grams = framed.select("lang", "n", F.explode(F.transform(
            starts, _substring(F.col("w"), size))).alias("item"))
        tables.append(_table(grams.groupBy("item", "lang").agg(F.sum("n").alias("n")), languages, max_grams))
    return Model(languages, tables[0], tables[1:])


def _substring(text: Column, size: int):
    return lambda start: F.substring(text, start, F.lit(size))


def _words(text: Column) -> Column:
    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        return pd.Series([words_of(t or "") for t in texts], dtype=object)

    return split(text)


def predict_column(spark: SparkSession, model: Model, text: Column) -> Column:
    """``struct(lang_pred, score)`` of each text."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for texts in batches:
            yield pd.DataFrame([known.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict(text)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn_from_documents(docs: DataFrame, **params) -> Model:
    """A model from the documents that are not held out and have a language."""
    return fit(docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
               .select(F.col("doc_id").alias("id"), "text", "lang"), **params)
