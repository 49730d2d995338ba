import math
import random

import pytest
from pyspark.sql import functions as F

from lakeops.llm import sentencepiece_codec as sp
from lakeops.llm.queries import PIECES
from llm_cases import edge_docs, edge_rows, no_docs


@pytest.fixture(scope="module")
def codec():
    return sp.Codec(sp.read_model(PIECES))


@pytest.fixture(scope="module")
def scores(codec):
    from sentencepiece import sentencepiece_model_pb2 as proto
    told = proto.ModelProto()
    told.ParseFromString(sp.read_model(PIECES))
    return {p.piece: (i, round(-math.log1p(max(0.0, -p.score)) * (1 << 20)))
            for i, p in enumerate(told.pieces) if p.type in (1, 4)}


def plain(codec, scores, text):
    framed = sp.MARK + text.replace(sp.MARK, "\ud800").replace(" ", sp.MARK) if text else ""
    best = [(0, 0, [])]
    for end in range(1, len(framed) + 1):
        found = [(-(best[s][0] + scores[framed[s:end]][1]), best[s][1] + 1, s - end, best[s][2] + [scores[framed[s:end]][0]])
                 for s in range(max(0, end - 60), end) if framed[s:end] in scores]
        if not found:
            ids = [codec.byte_id[b] for b in framed[end - 1].replace("\ud800", sp.MARK).encode()]
            found = [(-(best[-1][0] - 30 * (1 << 20) * len(ids)), best[-1][1] + len(ids), -1, best[-1][2] + ids)]
        least = min(found, key=lambda x: x[:3])
        best.append((-least[0], least[1], least[3]))
    return best[-1][2]


TEXTS = ["", " ", "a", "  two  spaces ", "▁", "a▁ ▁b", "日本語 🙂\n\ttab", "é" * 80, "Hello world, this is a test.", "\x00\x01"]


@pytest.mark.parametrize("text", TEXTS)
def test_best_segmentation(codec, scores, text):
    assert codec.encode(text).tolist() == plain(codec, scores, text)


def test_random_texts(codec, scores):
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice("abcdeth  ▁é日") for _ in range(rng.randrange(60)))
        ids = codec.encode(text)
        assert ids.tolist() == plain(codec, scores, text) and codec.decode(ids) == text


def test_same_result_without_memory(codec):
    text = " ".join(r[1] or "" for r in edge_rows())[:20000]
    ids = codec.encode(text).tolist()
    codec.memory.clear()
    assert codec.encode(text).tolist() == ids and codec.viterbi(sp.MARK + text.replace(sp.MARK, "\ud800").replace(" ", sp.MARK)) == ids


def test_columns(spark):
    model = sp.read_model(PIECES)
    docs = sp.encode_rows(edge_docs(spark).withColumn("after", F.lit(1)), model, ids_col="ids")
    assert docs.columns == [*edge_docs(spark).columns, "after", "ids"] and sp.encode_rows(no_docs(spark), model).count() == 0
    rows = docs.withColumn("back", sp.decode_column(spark, model, F.col("ids"))).select("text", "ids", "back").collect()
    assert len(rows) == 12 and all(r.text == r.back for r in rows)
    assert all((r.ids is None) == (r.text is None) and (r.text != "" or r.ids == []) for r in rows)


def test_digests(spark):
    got = {r.id: r for r in sp.encoded_digests(edge_docs(spark), sp.read_model(PIECES)).collect()}
    assert got[2].n_tokens is None and got[3].n_tokens == 0 and all(r.exact for i, r in got.items() if i != 2)
    assert sp.encoded_digests(no_docs(spark), sp.read_model(PIECES)).count() == 0
