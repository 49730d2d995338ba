"""Rows that every operator must take: nulls, empties, repeats, long texts, clashing names."""

from pyspark.sql import functions as F

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, size int, blob string, "
          "hash bigint, fp bigint, list int, cell int, shard int, part int, words string, spans string")
LONG = " ".join(f"word{i % 9973} of" for i in range(30_000))


def edge_rows():
    texts = [
        (1, "The cat sat on the mat, under the MIT License. cc by nc", "en", "a"),
        (1, "The cat sat on the mat, under the MIT License. cc by nc", "en", "a"),
        (2, None, None, None),
        (3, "", "en", "a"),
        (4, " \n\t ", "en", "b"),
        (None, "a text without an id but with words", "en", "b"),
        (5, LONG, "en", "b"),
        (6, "x", "de", "c"),
        (7, "password = abcdefgh1 and token: short", "en", None),
        (8, "é日本 🙂 ▁   ñandú CORAZÓN", "es", "d"),
        (9, "The cat sat on the mat, under the MIT License. cc by nc", "en", "d"),
        (10, "der hund und die katze und das haus", "de", "c"),
    ]
    return [(i, t, la, s, None if t is None else len(t), -1, 7, "b", 1, 2, 3, 4, 5, 6, "w", "s") for i, t, la, s in texts]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


def no_docs(spark):
    return edge_docs(spark).where(F.lit(False))


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def components_of(nodes, linked):
    """Smallest node of each node's component, by trying all pairs."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    nodes = sorted(root)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}
