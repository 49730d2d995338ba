import hashlib
import random

import numpy as np
import pytest

from lakeops.llm import winnow
from llm_cases import edge_docs, edge_rows, no_docs

BASE, ALL = 0x9E3779B97F4A7C15, (1 << 64) - 1


def plain(text, k=16, w=32):
    def mixed(h):
        for _ in range(2):
            h = ((h ^ (h >> 32)) * 0xD6E8FEB86659FD93) & ALL
        return h >> 32

    codes = [ord(c) + 1 for c in text]
    hashes = []
    for i in range(max(1, len(codes) - k + 1) if codes else 0):
        h = 0
        for c in codes[i:i + k]:
            h = (h * BASE + c) & ALL
        hashes.append(mixed(h))
    kept = set()
    for i in range(max(1, len(hashes) - w + 1) if hashes else 0):
        window = hashes[i:i + w]
        kept.add(i + max(j for j, h in enumerate(window) if h == min(window)))
    return sorted(kept), [hashes[j] for j in sorted(kept)]


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 47, 48, 200, 3000])
def test_winnow(n):
    rng = random.Random(n)
    text = "".join(rng.choice("ab é🙂") for _ in range(n))
    positions, hashes = winnow.winnow(text)
    assert (positions.tolist(), hashes.tolist()) == plain(text)


def test_rightmost_of_equal_hashes():
    positions, _ = winnow.winnow("a" * 100)
    assert positions.tolist() == list(range(31, 85))


def test_match_guarantee():
    rng = random.Random(1)
    shared = "".join(rng.choice("abcdef") for _ in range(16 + 32 - 1))
    for _ in range(20):
        a, b = ("".join(rng.choice("abcdef") for _ in range(rng.randrange(300))) + shared for _ in range(2))
        assert set(winnow.winnow(a)[1].tolist()) & set(winnow.winnow(b)[1].tolist())


def test_edited_pairs(spark):
    got = winnow.edited_pairs(edge_docs(spark)).collect()
    rows = sorted(((r[0], r[1] or "") for r in edge_rows()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for i, (doc, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, other, following = (plain(t) if len(t) < 5000 else tuple(x.tolist() for x in winnow.winnow(t))
                                 for t in (text, edited, after))

        def like(a, b):
            return len(set(a) & set(b)) / len(set(a) | set(b)) if set(a) | set(b) else 1.0

        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                     winnow.digest(np.array(own[0], np.int64), np.array(own[1], np.int64)),
                     winnow.digest(np.array(other[0], np.int64), np.array(other[1], np.int64)),
                     like(own[1], other[1]), like(own[1], following[1])))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_few_rows(spark):
    assert winnow.edited_pairs(no_docs(spark)).count() == 0
    one = winnow.edited_pairs(spark.createDataFrame([(3, "abcd")], "doc_id long, text string")).collect()
    assert [(r.id, r.n_chars, r.near_next) for r in one] == [(3, 4, 1.0)]
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest()


def test_fingerprints_column_form(spark):
    got = {r.id: r for r in winnow.fingerprints(edge_docs(spark)).collect()}
    assert got[2].hashes == [] and len(got[6].hashes) == 1


def by_brute_force(rows):
    """Rows in order of id (null first) and digest, each with the next one; after the last comes the first."""
    rows = sorted(((i, t or "") for i, t in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(r[1].encode()).digest()[:16]))
    want = []
    for i, (doc, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, other, following = (winnow.winnow(t) for t in (text, edited, after))
        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), winnow.digest(*own), winnow.digest(*other),
                     winnow.likeness(own[1], other[1]), winnow.likeness(own[1], following[1])))
    return sorted(want, key=repr)


@pytest.mark.parametrize("hot", ["texts", "copies", "null", "alone"])
def test_hot_ids(spark, hot, monkeypatch):
    monkeypatch.setattr(winnow, "_CHUNK", 7)
    rng = random.Random(hot)

    def text():
        return "".join(rng.choice("abcdef ") for _ in range(rng.randrange(120)))

    rows = [] if hot == "alone" else [(rng.randrange(60), text()) for _ in range(200)]
    rows += {"texts": [(30, text()) for _ in range(100)], "copies": [(30, "the same text")] * 100,
             "null": [(None, text()) for _ in range(60)] + [(None, "")] * 40, "alone": [(5, "the same text")] * 20}[hot]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, winnow.edited_pairs(docs).collect()), key=repr) == by_brute_force(rows)


def test_a_hot_id_is_cut(spark):
    """A third of all rows under one id and another third one row repeated: no part holds more than a few shares."""
    docs = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN id WHEN id % 3 = 1 THEN 500 ELSE 2000 END AS doc_id",
                                        "CASE WHEN id % 3 = 2 THEN 'copy' ELSE concat('text ', id) END AS text")
    dealt = winnow.with_next(docs, "doc_id", "text", parts=30)
    sizes = [r["count"] for r in dealt.where("not extra").groupBy("part").count().collect()]
    assert sum(r.copies for r in dealt.where("not extra").collect()) == 3000
    assert max(sizes) <= 3 * 3000 / 30
