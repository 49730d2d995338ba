import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeops.llm import spelling
from llm_cases import edge_docs, edge_rows, no_docs


def plain_words(rows, least_length=5, least_count=3):
    found = Counter()
    for row in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", row[1] or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if row[0] is None else row[0]}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least_length and n >= least_count}


def near(a, b):
    """Whether the edit distance is one, by the textbook table."""
    if abs(len(a) - len(b)) > 1:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1] == 1


def plain_variants(words, ratio=2):
    of, out = {}, {}
    for w, n in words.items():
        around = [x for x in words if near(w, x)]
        best = min(around, key=lambda x: (-words[x], x), default=None)
        of[w] = best if best is not None and words[best] >= ratio * n else None
        out[w] = len(around)
    rows = []
    for w, n in words.items():
        root = w
        while of[root] is not None:
            root = of[root]
        rows.append((w, of[w], root, n, out[w], None if of[w] is None else words[of[w]]))
    return sorted(rows, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def word_table(seed=3):
    rng, words = random.Random(seed), {}
    for _ in range(40):
        base = "".join(rng.choice("abcdeéx") for _ in range(rng.randrange(5, 9)))
        words[base] = rng.randrange(3, 90)
        for _ in range(6):
            i, c = rng.randrange(len(base)), rng.choice("abcé")
            words[rng.choice([base[:i] + base[i + 1:], base[:i] + c + base[i:], base[:i] + c + base[i + 1:]])] = rng.randrange(3, 30)
        words["".join(rng.sample(base, len(base)))] = 7  # the same letters in another order
    words.update({"a" * 300: 9, "a" * 301: 20, "a" * 150 + "b" + "a" * 150: 3, "日本語日本": 4, "日本語日": 8})
    return words


@pytest.mark.parametrize("cell_words", [50_000, 40, 2])
def test_variants(spark, cell_words):
    """With two words a cell, full vectors are divided by halves as well."""
    words = word_table()
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert got(spelling.variants(df, cell_words=cell_words)) == plain_variants(words)


def test_one_letter_order_and_ties(spark):
    words = {"aaaab": 10, "aaaac": 10, "aaaad": 3, "aaaaad": 1, "zzzzz": 5}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = {r.word: r for r in spelling.variants(df).collect()}
    assert rows["aaaad"].form == "aaaab" and rows["aaaad"].n_near == 3  # equal counts: the first in code-point order
    assert rows["aaaaad"].form == "aaaad" and rows["aaaaad"].root == "aaaab"
    assert rows["zzzzz"].form is None and rows["zzzzz"].root == "zzzzz" and rows["zzzzz"].n_near == 0


@pytest.mark.parametrize("least", [1, 2])
def test_vocabulary_of_edge_rows(spark, least):
    docs = edge_docs(spark).withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    found = {r.word: r.n for r in spelling.vocabulary(docs, least_length=2, least_count=least).collect()}
    assert found == plain_words(edge_rows(), 2, least)


def test_words_of_matches_the_rule():
    rng = random.Random(8)
    for i in range(300):
        text = " ".join("".join(rng.choice("aAbBéÉ×zZ'-日ÿ") for _ in range(rng.randrange(1, 7))) for _ in range(60))
        want = plain_words([(i, text)], 0, 1)
        assert {w.decode(): n for w, n in spelling.words_of(i, text).items()} == want


def test_real_words(spark):
    words = plain_words([(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()])
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(spelling.variants(df)) == plain_variants(words)


def test_empty(spark):
    words = spelling.vocabulary(no_docs(spark))
    assert words.count() == 0 and spelling.variants(words).count() == 0


def test_cells_hold_what_the_search_reaches():
    """Every word near another one is sent to that one's cell, wherever the trie is cut."""
    words = sorted(word_table(5))
    vectors = [v.tobytes() for v in spelling.vectors(words)]
    for limit in (1, 5, 50):
        split = set()
        for depth in range(spelling.N_LEVELS + 1):
            split |= {k for k, n in Counter(v[:depth] for v in vectors).items() if n > limit}
        split = frozenset(split)
        for w, v in zip(words, vectors):
            for x, u in zip(words, vectors):
                if near(w, x):
                    home = next(u[:d] for d in range(spelling.N_LEVELS + 1) if u[:d] not in split or d == spelling.N_LEVELS)
                    assert home in spelling.reached(v, split)
