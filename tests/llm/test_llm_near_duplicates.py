import random

import pytest
import xxhash
from pyspark.sql import functions as F

from lakeops.llm import simhash
from lakeops.llm.components import components
from llm_cases import components_of, edge_docs, edge_rows, no_docs, rows_of


def plain_fingerprint(text, k=3):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    grams = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


@pytest.mark.parametrize("text", [None, "", " \t", "One", "one TWO", "a b c d e f", "É é x y z é É " * 50])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_hash_is_the_engines(spark):
    got = spark.sql("SELECT xxhash64('a b c')").first()[0]
    assert simhash.fingerprint("a b c") % (1 << 64) == got % (1 << 64)


@pytest.mark.parametrize("distance,heavy", [(2, 16), (2, 2), (1, 2), (3, 2), (0, 2)])
def test_links_give_the_components_of_all_pairs(spark, distance, heavy):
    rng = random.Random(distance * 10 + heavy)
    fps = set()
    for _ in range(8):  # clusters around a centre, and chains that walk away from it
        centre = rng.getrandbits(64)
        for _ in range(25):
            x = centre
            for _ in range(rng.randint(0, 3)):
                x ^= 1 << rng.randrange(64)
            fps.add(signed(x))
        for _ in range(10):
            centre ^= 1 << rng.randrange(64)
            fps.add(signed(centre))
    frame = spark.createDataFrame([(x,) for x in fps], "fp long")
    edges = simhash.links(frame, distance, blocks=4, heavy=heavy)
    pairs = [(r.a, r.b) for r in edges.collect()]
    assert all(bin((a ^ b) % (1 << 64)).count("1") <= distance for a, b in pairs)
    want = components_of(fps, lambda a, b: bin((a ^ b) % (1 << 64)).count("1") <= distance)
    got = {x: x for x in fps} | {r.node: r.root for r in components(edges).collect()}
    assert got == want


def test_components_of_a_long_path(spark):
    n = 400
    edges = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components(edges).collect()} == {0}
    assert components(edges).count() == n + 1


def test_edges(spark):
    got = simhash.near_duplicates(edge_docs(spark))
    rows = rows_of(got.select("id", F.col("fp"), "component_id"), "id", "fp", "component_id")
    want = [(r[0], signed(plain_fingerprint(r[1]))) for r in edge_rows()]
    assert sorted(((i, fp) for i, fp, _ in rows), key=repr) == sorted(want, key=repr)
    by_id = {i: c for i, _, c in rows}
    assert by_id[2] == by_id[3] == by_id[4] == 2 and by_id[9] == by_id[1] == 1 and by_id[None] is None
    assert simhash.near_duplicates(no_docs(spark)).count() == 0


def test_keep_one(spark):
    docs = edge_docs(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id") == sorted([(i,) for i in (1, 2, None, 5, 6, 7, 8, 10)], key=repr)
    assert simhash.keep_one(no_docs(spark)).count() == 0


def test_keep_one_keeps_a_row_of_every_group_without_an_id_of_its_own(spark):
    rng = random.Random(11)
    texts = [" ".join(str(rng.random()) for _ in range(30)) for _ in range(12)]
    rows = [(None, t) for t in texts[:8]] + [(None, texts[0]), (None, texts[9]), (4, texts[9])] \
        + [(3, t) for t in (texts[8], texts[10])] + [(3, texts[10]), (7, texts[10]), (1, texts[11])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(simhash.keep_one(docs), "doc_id", "text") == sorted(
        [(None, t) for t in texts[:8]] + [(4, texts[9]), (3, texts[8]), (3, texts[10]), (1, texts[11])], key=repr)
