"""The corpus pipeline: language, near-duplicates, secrets, mixture, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``; all but the last return the
columns of their input.

Nulls and edges follow the operators: a null or letterless text is rejected by
the first stage; rows with a null id stay, one of each near-duplicate group that
has no other id; empty tables stay empty; further columns are carried along,
whatever their names, unless they begin with ``__``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import langid, mixture, secrets, sentencepiece_codec, simhash
from lakeops.llm.common import materialise
from lakeops.llm.queries import PIECES
from lakeops.session import scratch_path

# A text whose best language is less likely than this is rejected.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a language, or of an uncertain one."""
    model = langid.learn_from_documents(docs)
    judged = docs.withColumn("__p", langid.predict_column(spark, model, F.col("text")))
    return judged.where((F.col("__p.lang_pred") != langid.UNDETERMINED)
                        & (F.col("__p.score") >= LEAST_SCORE)).drop("__p")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group: the one of smallest id."""
    return simhash.keep_one(docs, shingle=3, max_distance=2)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by the name of its kind; ``n_chars`` follows the text."""
    ledger = secrets.BlobLedger(spark, scratch_path(spark, "ledger"))
    versions = docs.withColumn("__content", F.col("text"))
    found = ledger.join_back(versions, ledger.update(versions, content="__content"), content="__content",
                             blob="__blob", spans="__spans")
    masked = found.withColumn("text", secrets.masked(F.col("text"), F.col("__spans")))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(F.size("__spans") > 0, F.char_length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return masked.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat each document as often as the mix takes it, in whole copies by source, or leave it out."""
    key = ["__id", "__key"]
    # One text under one id in several sources: each of its rows is repeated as in the source that takes it most.
    taken = (mixture.copies(mixture.mix(docs, weights=(1, 2, 3), cap=3))
             .groupBy(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("__id"), F.col("key").alias("__key"))
             .agg(F.max("copies").alias("__copies")).where("__copies > 0"))
    keyed = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) \
        .withColumn("__key", F.xxhash64("text"))
    return (keyed.join(taken, key)
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
            .drop("__copy", "__copies", *key))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids."""
    model = sentencepiece_codec.read_model(PIECES)
    encoded = sentencepiece_codec.encode_rows(docs.select("doc_id", "lang", "source", "text"), model)
    return encoded.drop("text").withColumn("n_tokens", F.size("input_ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("mask_secrets", mask_secrets),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# Language identification and XXH64 fingerprints have no SQL twin; the tests compare
# the pipeline with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
