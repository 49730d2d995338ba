import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm import packing, queries
from llm_cases import edge_docs, edge_rows, no_docs


@pytest.fixture(scope="module")
def model():
    return packing.read_tokenizer(queries.WORD_BPE)


@pytest.fixture(scope="module")
def whole(model):
    """The tokenizer itself, on whole texts."""
    tokenizer = Tokenizer.from_str(model)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def table(spark, lengths):
    return spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "k long, length long").repartition(3)


def check_packed(rows, lengths, capacity):
    assert sorted(r.k for r in rows) == list(range(len(lengths)))
    by = {}
    for r in rows:
        assert r.length == lengths[r.k]
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def fewest(lengths, capacity):
    """The true minimum, by trying."""
    lengths = sorted(lengths, reverse=True)

    def fits(bins, i):
        if i == len(lengths):
            return True
        seen = set()
        for b in range(len(bins)):
            if bins[b] + lengths[i] <= capacity and bins[b] not in seen:
                seen.add(bins[b])
                bins[b] += lengths[i]
                if fits(bins, i + 1):
                    return True
                bins[b] -= lengths[i]
        return False

    n = max(1, -(-sum(lengths) // capacity))
    while not fits([0] * n, 0):
        n += 1
    return n


def test_bound_never_exceeds_the_minimum():
    rng = random.Random(4)
    met = 0
    for _ in range(300):
        capacity = rng.choice([10, 17, 30])
        lengths = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 9))]
        bound = packing.dual_feasible_bound(*np.unique(lengths, return_counts=True), capacity)
        best = fewest(lengths, capacity)
        assert bound <= best
        met += bound == best
    assert met > 270


def test_bound_sees_more_than_the_sum():
    for lengths, capacity, want in (([6] * 5, 10, 5), ([4] * 5, 10, 3), ([34] * 6, 100, 3)):
        assert packing.dual_feasible_bound(*np.unique(lengths, return_counts=True), capacity) == want


def test_best_fit_decreasing():
    rng = random.Random(7)
    for _ in range(50):
        lengths = [rng.randrange(1, 31) for _ in range(200)]
        bins, offsets, n = packing.best_fit_decreasing(np.array(lengths), 30)
        rooms, want = [], 0
        for length in sorted(lengths, reverse=True):
            fitting = [r for r in rooms if r >= length]
            if fitting:
                rooms.remove(min(fitting))
                rooms.append(min(fitting) - length)
            else:
                want += 1
                rooms.append(30 - length)
        assert n == want == len(set(bins.tolist()))


@pytest.mark.parametrize("make", [lambda r: r.randrange(1, 101), lambda r: r.randrange(30, 60), lambda r: r.choice([34, 33, 51, 100, 17])])
def test_packing_by_partitions(spark, make):
    rng = random.Random(11)
    lengths = [make(rng) for _ in range(3000)]
    found = packing.pack(table(spark, lengths), 100, group=200)
    n = check_packed(found.packed.collect(), lengths, 100)
    bound = packing.dual_feasible_bound(*np.unique(lengths, return_counts=True), 100)
    together = packing.best_fit_decreasing(np.array(lengths), 100)[2]  # all pieces in one partition
    assert bound <= n <= together * 1.01 + 1
    proofs = found.certificate.collect()
    assert proofs and all(p.bins >= p.bound for p in proofs)
    first = [p for p in proofs if p.turn == 0]
    assert len(first) > 5 and n <= sum(p.bins for p in first) + lengths.count(100)


def test_partitions_with_gaps_exchange(spark):
    """What the partitions leave open is packed better together than apart."""
    rng = random.Random(11)
    lengths = [rng.randrange(1, 100) for _ in range(3000)]
    found = packing.pack(table(spark, lengths), 100, group=200)
    n = check_packed(found.packed.collect(), lengths, 100)
    proofs = found.certificate.collect()
    assert any(p.bins > p.bound for p in proofs if p.turn == 0) and any(p.turn > 0 for p in proofs)
    assert n < sum(p.bins for p in proofs if p.turn == 0)


def test_bad_lengths_and_clashes(spark):
    for bad in (0, 11, None):
        with pytest.raises(ValueError):
            packing.pack(table(spark, [3, bad]), 10)
    with pytest.raises(ValueError):
        packing.pack(table(spark, [3]).withColumn("offset", F.lit(1)), 10)
    assert packing.pack(table(spark, [1]).where("k < 0"), 10).packed.count() == 0
    assert packing.pack(table(spark, [10, 10]), 10).packed.select("sequence_id").distinct().count() == 2


def test_words_apart_give_the_ids_of_the_whole_text(model, whole):
    rng = random.Random(1)
    texts = ["", " ", "it's IT'S don't, l'été “quoted”—dash… ≠ x≠y é, Å. ́x", "a\x00b \x1c z\u0085y w v",
             "naïve, ÉCOLE! ×÷ ß İstanbul ΑΣ. 日本語。テスト 🙂🙂, 123abc 4,567.89", "<|endoftext|> <|startoftext|>x",
             "''s 's 'Tis we'll; 'd", "ﬁ ™ ½ x² Ⅷ", "a" * 3000 + "!!!", "abc</w> ,,, (x) [y] {z}~ \t\n\r\v\f end"]
    texts += ["".join(rng.choice("abE é×,.'’!-9²̸́=<日🙂\t") for _ in range(rng.randrange(40))) for _ in range(1000)]
    found = packing.Tokens(model).encode(texts)
    assert [f.tolist() for f in found] == [whole(t) for t in texts]


def test_documents(spark, model, whole):
    rows = edge_rows()
    docs = edge_docs(spark).withColumn("length", F.lit(1)).withColumn("offset", F.lit(2))
    found = packing.pack_documents(docs, model, capacity=64, with_ids=True, group=4)
    got = found.packed.collect()
    want = []
    for row in rows:
        ids = [*whole(row[1] or ""), 0]
        for piece, start in enumerate(range(0, len(ids), 64)):
            cut = ids[start:start + 64]
            want.append((row[0], piece, start, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes()), cut))
    assert sorted(((r.id, r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in got), key=repr) == sorted(want, key=repr)
    filled = {}
    for r in got:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.ids))
    joined = {k: [i for _, ids in sorted(v) for i in ids] for k, v in filled.items()}
    assert {r.sequence_id: r.ids for r in packing.sequences(found.packed).collect()} == joined
    assert max(map(len, joined.values())) <= 64


def test_no_documents(spark, model):
    assert packing.pack_documents(no_docs(spark), model).packed.count() == 0


def test_real_documents(spark, whole):
    got = queries.op13_packing(spark, "/root/testdata/sf0.001").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    lengths = {r.doc_id: len(whole(r.text or "")) + 1 for r in docs}
    assert got.groupby("doc_id").length.sum().to_dict() == lengths
    fill = got.sort_values(["sequence_id", "offset"])
    before = (fill.offset + fill.length).groupby(fill.sequence_id).shift(1).fillna(0)
    assert (before == fill.offset).all() and (fill.offset + fill.length).max() <= 2048
    bound = packing.dual_feasible_bound(*np.unique(got.length, return_counts=True), 2048)
    assert got.sequence_id.nunique() <= bound + 1
