"""The registered queries of this subpackage and their DuckDB twins.

Each query applies its operator, with production parameters, to the whole of
its table.  ``ORACLE`` holds a twin wherever SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import ann, chains, langid, licenses, mixture, oracles, packing, secrets, \
    sentencepiece_codec, simhash, spelling, suffix_dedup, whitening, winnow
from lakeops.llm.common import read_table
from lakeops.session import scratch_path

# A public model file, read on the driver and broadcast.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
# A public tokenizer file, likewise.
WORD_BPE = "/opt/tokenizers/word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_distance=2)
    return found.select(F.col("id").alias("doc_id"), simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"),
                        "component_id")


@query
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, scanned through a ledger that has seen none."""
    versions = read_table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    ledger = secrets.BlobLedger(spark, scratch_path(spark, "ledger"))
    found = ledger.join_back(versions, ledger.update(versions))
    base = [r.kind for r in secrets.BASE_RULES]
    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    kinds = F.col("spans.kind")
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(secrets.spans_text(of_base), 256).alias("base_sha256"),
                        secrets.spans_text(F.col("spans")).alias("spans"))


ORACLE["op7_secrets"] = oracles.secrets_sql(secrets.RULES)


@query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses that every document names or quotes."""
    found = licenses.scan(read_table(spark, sf_dir, "documents"))
    starts, covered = F.col("places.start"), F.col("spans.covered")

    def labels(of):
        return F.array_join(F.array_sort(F.array_distinct(of)), ",")

    return found.select(
        F.col("id").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        labels(F.col("places.label")).alias("base_labels"), labels(F.col("spans.label")).alias("labels"),
        F.coalesce(F.array_max(covered), F.lit(0.0)).alias("score"))


ORACLE["op4_licenses"] = oracles.licenses_sql(licenses.TEMPLATES, licenses.words_of, licenses.WORD, licenses.K)


@query
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowing fingerprints of every document, its edited text and the next document."""
    return winnow.edited_pairs(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    model = langid.learn_from_documents(docs)
    predicted = langid.predict_column(spark, model, F.col("text"))
    return (docs.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), predicted.alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))


@query
def op2_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix by source weights takes of every document."""
    return (mixture.mix(read_table(spark, sf_dir, "documents"), weights=(1, 2, 3), cap=3)
            .select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"))


ORACLE["op2_mixture"] = oracles.mixture_sql()


@query
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded into pieces and decoded again."""
    model = sentencepiece_codec.read_model(PIECES)
    return (sentencepiece_codec.encoded_digests(read_table(spark, sf_dir, "documents"), model)
            .withColumnRenamed("id", "doc_id"))


@query
def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every hundredth vector."""
    found = ann.search(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query
def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its strings of 50 bytes that an earlier one holds."""
    found = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), length=50)
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                        F.col("kept").alias("kept_sha256"))


@query
def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of documents that repeat, perhaps with changes, in others."""
    found = chains.passages(read_table(spark, sf_dir, "documents"), k=5, least=40, identity=0.8)
    return found.select(F.col("id").alias("doc_id"), F.col("start").alias("first_word"), F.col("end").alias("end_word"),
                        F.col("other_id").alias("other_doc_id"), F.col("other_start").alias("other_first_word"),
                        F.col("other_end").alias("other_end_word"), "identity")


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its form, the root of its forms and the number of words one edit away."""
    words = spelling.vocabulary(read_table(spark, sf_dir, "documents"), least_length=5, least_count=3)
    return spelling.variants(words, ratio=2)


ORACLE["op11_spelling"] = oracles.spelling_sql()


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the sixteen strongest components, whitened."""
    found = whitening.whiten(read_table(spark, sf_dir, "embeddings"), top=16, weights="one")
    return found.select(F.col("id").alias("vec_id"), "component", "n", F.col("deviation").try_cast("bigint").alias("deviation"),
                        "whitened", "explained", "identity_error")


@query
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in a sequence of 2048 tokens."""
    tokenizer = packing.read_tokenizer(WORD_BPE)
    found = packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer, capacity=2048)
    return found.packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
