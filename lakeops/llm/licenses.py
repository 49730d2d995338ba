"""License scans by diagonal voting, in DataFrame operations only.

Every rolling hash of ``k`` words of a text is joined to the positions at which
the templates hold it.  A hit at word ``p`` of a text and word ``t`` of a
template votes for the diagonal ``p - t``: the place at which the template
would begin.  Votes are summed by diagonal; diagonals next to each other (words
inserted or left out) are merged; a merged span is verified by how much of its
template it covers.

* A short *phrase* stands where one diagonal holds a vote for every one of its
  hashes: there its words stand consecutively.  These are the base places.
* A longer *template* is found where the merged span covers at least
  ``coverage`` of its words.

Each hit's words are compared with the template's before they count, so a
clash of hashes adds no vote.

Nulls and edges: a null text counts as empty and has no words; a text of fewer
than ``k`` words has no hits; repeated rows each give their own row; rows with
a null id are kept.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.llm.common import ascii_lower

K = 3
# Words: runs of ASCII letters and digits and of all characters above ASCII (fixed value).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    name: str
    label: str
    text: str
    base: bool = False


# The base phrases and their labels.
BASE = (
    Template("phrase-mit", "mit", "under the mit license", base=True),
    Template("phrase-apache", "apache-2", "apache license version 2", base=True),
    Template("phrase-cc", "cc-by-nc", "cc by nc", base=True),
)
# Added by the method: passages of public license texts and notices (fixed values).
LONGER = (
    Template("mit-grant", "mit", """Permission is hereby granted, free of charge, to any person obtaining a copy
        of this software and associated documentation files (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
        sublicense, and/or sell copies of the Software"""),
    Template("apache-notice", "apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may
        not use this file except in compliance with the License. You may obtain a copy of the License at"""),
    Template("bsd-terms", "bsd", """Redistribution and use in source and binary forms, with or without modification,
        are permitted provided that the following conditions are met"""),
    Template("gpl-notice", "gpl", """This program is free software: you can redistribute it and/or modify it under
        the terms of the GNU General Public License as published by the Free Software Foundation"""),
    Template("gpl-line", "gpl", "licensed under the GNU General Public License"),
    Template("mpl-notice", "mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License,
        v. 2.0."""),
    Template("cc-by-sa-line", "cc-by-sa", """licensed under a Creative Commons Attribution-ShareAlike"""),
    Template("cc-by-nc-line", "cc-by-nc", """licensed under a Creative Commons Attribution-NonCommercial"""),
)
TEMPLATES = BASE + LONGER


def words_of(text: str) -> list[str]:
    return re.findall(WORD, "".join(c.lower() if c.isascii() else c for c in text))


def template_grams(spark: SparkSession, templates=TEMPLATES, k: int = K) -> DataFrame:
    """``(name, label, base, m, t, gram, hash)``: every ``k``-gram of every template.

    As many rows as the templates have words, whatever the texts hold.
    """
    rows = []
    for x in templates:
        words = words_of(x.text)
        if len(words) < k:
            raise ValueError(f"template {x.name} has fewer than {k} words")
        rows += [(x.name, x.label, x.base, len(words), t, words[t:t + k]) for t in range(len(words) - k + 1)]
    grams = spark.createDataFrame(
        rows, "name string, label string, base boolean, m int, t int, gram array<string>")
    return grams.withColumn("hash", F.xxhash64(*[F.col("gram")[i] for i in range(k)]))


def rolling_hashes(words: Column, k: int = K) -> Column:
    """The hash of the ``k`` words from each position, and a null after the last."""
    n = F.size(words) - k + 1
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))
    return F.concat(hashes, F.array(F.lit(None).cast("bigint")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, k: int = K,
         coverage: float = 0.8, slack: int = 3) -> DataFrame:
    """``(id, n_words, places, spans)`` for each row of ``docs``.

    ``places``: array of ``(label, start)``, where a base phrase stands.
    ``spans``: array of ``(name, label, start, end, covered)``, the verified spans
    of all templates; ``covered`` is the share of the template found there.
    """
    spark = docs.sparkSession
    words = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(WORD), F.lit(0))
    # Rows of one id and text are the same work: they share a key and are told apart by number.
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), words.alias("words"))
    rolled = texts.withColumn("hashes", rolling_hashes(F.col("words"), k))
    # The null behind the last hash is kept as the row that stands for the text itself.
    grams = rolled.select("id", "text_hash", "words", F.posexplode_outer("hashes").alias("p", "hash"))
    hits = (grams.join(F.broadcast(template_grams(spark, templates, k)), "hash", "left")
            .where(F.col("hash").isNull() | (F.slice("words", F.col("p") + 1, F.lit(k)) == F.col("gram")))
            .select("id", "text_hash", "name", "label", "base", "m", "t", "p",
                    F.when(F.col("hash").isNull(), F.size("words")).alias("n_words")))
    # Votes by diagonal; the row of the text itself has no name and is counted, not summed.
    key = ["id", "text_hash"]
    votes = hits.groupBy(*key, "name", "label", "base", "m", (F.col("p") - F.col("t")).alias("diagonal"),
                         F.col("name").isNull().alias("text_row")).agg(
        F.min("t").alias("first_t"), F.max("t").alias("last_t"),
        F.collect_set("t").alias("ts"), F.max("n_words").alias("n_words"), F.count("n_words").alias("copies"))
    # Neighbouring diagonals of one template are one span.
    along = Window.partitionBy(*key, "name").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along)
    merged = (votes.withColumn("new", F.when(F.col("base") | apart.isNull() | (apart > slack), 1).otherwise(0))
              .withColumn("span", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy(*key, "name", "label", "base", "m", "span", "text_row").agg(
        F.min(F.col("diagonal") + F.col("first_t")).alias("start"),
        F.max(F.col("diagonal") + F.col("last_t") + k).alias("end"),
        F.array_distinct(F.flatten(F.collect_list("ts"))).alias("ts"),
        F.max("n_words").alias("n_words"), F.sum("copies").alias("copies")))
    # Verify: the template words that the span's hashes cover, as a share of all.
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "ts", lambda t: F.sequence(t, t + (k - 1)))))) / F.col("m")
    verified = (merged.withColumn("covered", covered)
                .where("text_row OR covered >= CASE WHEN base THEN 1.0 ELSE %s END" % float(coverage)))
    is_span = ~F.col("text_row")
    found = verified.groupBy(*key).agg(
        F.max("n_words").cast("long").alias("n_words"), F.max("copies").alias("copies"),
        F.array_sort(F.collect_list(F.when(is_span & F.col("base"), F.struct("label", "start")))).alias("places"),
        F.array_sort(F.collect_list(F.when(is_span, F.struct("name", "label", "start", "end", "covered"))))
        .alias("spans"))
    # One row again for each row of the input.
    return found.select("id", "n_words", "places", "spans",
                        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("__copy")).drop("__copy")
