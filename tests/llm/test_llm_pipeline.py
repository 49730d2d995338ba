import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from lakeops.llm import langid, mixture, oracles, secrets, sentencepiece_codec
from lakeops.llm.common import materialise
from lakeops.llm.queries import PIECES
from llm_cases import components_of, edge_docs, edge_rows, no_docs
from test_llm_near_duplicates import plain_fingerprint


def plain_pipeline(spark, docs):
    """The five stages over rows ``(doc_id, text, lang, source)``, one after the other, without Spark's help."""
    model = langid.learn_from_documents(docs)
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    rows = [r for r in rows for p, score in [model.predict(r[1])] if p != "und" and score >= 0.5]
    prints = {r[0]: plain_fingerprint(r[1]) for r in rows}
    root = components_of(prints, lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 2)
    rows = [r for r in rows if root[r[0]] == r[0]]
    masked = []
    for doc, text, lang, source in rows:
        out, at = "", 0
        for kind, start, end in secrets.find_spans(text):
            if start >= at:
                out += text[at:start] + f"[{kind}]"
            at = max(at, end)
        masked.append((doc, out + text[at:], lang, source))
    kept = spark.createDataFrame(masked, "doc_id long, text string, lang string, source string").toPandas()  # noqa: F841
    taken = duckdb.sql(f"WITH {oracles.mixture_ctes('kept')} SELECT doc_id, taken, size, sid FROM mixed").fetchall()
    keys = {r.doc_id: r.key for r in spark.createDataFrame(kept).select("doc_id", F.xxhash64("text").alias("key")).collect()}
    copies, before = dict.fromkeys(keys, 0), {}
    for sid, _, doc, n, size in sorted((sid, hashlib.md5(f"copies:{doc}:{keys[doc]}".encode()).hexdigest(), doc, n, size)
                                       for doc, n, size, sid in taken if size):
        share = -(-n * (1 << 20) // size)
        done = before.get(sid, 0)
        before[sid] = done + share
        copies[doc] = -(-(done + share) // (1 << 20)) - -(-done // (1 << 20))
    codec = sentencepiece_codec.Codec(sentencepiece_codec.read_model(PIECES))
    return sorted((doc, lang, source, tuple(codec.encode(text).tolist()))
                  for doc, text, lang, source in masked for _ in range(copies[doc]))


def test_pipeline_equals_a_plain_version(spark):
    got = corpus_pipeline.run(spark, SF_SMALL)
    rows = sorted((r.doc_id, r.lang, r.source, tuple(r.input_ids)) for r in got.collect())
    want = plain_pipeline(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert rows == want and len(rows) > 100
    assert got.where("n_tokens <> size(input_ids)").count() == 0


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "mask_secrets", "mix_sources", "encode"]


@pytest.mark.parametrize("make", [edge_docs, no_docs])
def test_every_stage_takes_the_edges(spark, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, ""), f"t-{name}")
        if name != "encode":
            assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        docs = out
    assert docs.count() == 0 or make is edge_docs


def test_decisions_of_the_stages(spark):
    docs = edge_docs(spark)
    spoken = corpus_pipeline.language(spark, docs, "")
    assert spoken.where(F.col("doc_id").isin(2, 3, 4)).count() == 0
    one = corpus_pipeline.near_duplicates(spark, docs, "")
    assert one.where(F.col("doc_id").isin(1, 9)).count() == 1
    masked = {r.doc_id: r for r in corpus_pipeline.mask_secrets(spark, docs, "").collect()}
    assert masked[7].text == "[assign] and token: short" and masked[7].n_chars == len(masked[7].text)
    texts = {r[0]: r[1] for r in edge_rows()}
    assert masked[2].text is None and masked[8].text == texts[8]


def test_no_source_with_a_target_leaves_the_mix(spark):
    """One long document of which less than half is taken, beside a source of many."""
    rows = [(0, " ".join(["w"] * 1000), "long")] + [(i, " ".join(["v"] * (5 + i % 5)), "many") for i in range(1, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = {r.id: r for r in mixture.mix(docs).collect()}
    assert 0 < mixed[0].taken < 500
    out = corpus_pipeline.mix_sources(spark, docs, "")
    assert out.where("source = 'long'").count() == 1 and out.columns == docs.columns
    assert mixture.mix(docs).count() == 60
    taken = sum(r.taken / r.size for r in mixed.values() if r.id)
    assert taken <= out.where("source = 'many'").count() < taken + 1.01
