"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints are split into blocks; two that differ in at most ``d`` bits agree
on at least ``blocks - d`` of them, so rows are joined on every combination of
that many blocks and each candidate's Hamming distance is verified.

Equal fingerprints are collapsed first, so copies never meet in pairs.  A
bucket (rows that agree on one combination) with more than ``heavy`` different
fingerprints is not paired up either: there every fingerprint is keyed by all
values a few bits away, and the rows of a key are linked to their smallest.
Two fingerprints share such a key exactly if they are within ``d`` bits (or are
then joined through a row that is), so the linked groups are the same as from
all pairs, with rows in proportion to the fingerprints.

Nulls and edges: a null or white-space text has fingerprint zero and links like
any other; a text of fewer words than a shingle is one shingle; repeated rows
share a fingerprint and so a component; rows with a null id take part, and the
component id is the smallest non-null id (null if there is none).  An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import materialise
from lakeops.llm.components import components

BITS = 64
SEED = 42
# Rows whose bits are unpacked at once; bounds the memory of very long texts.
_UNPACK_ROWS = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of one text as an unsigned integer."""
    # bytes.lower() and bytes.split() know ASCII only: A-Z, and \x20 \x09-\x0D.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)  # one value: its own majority
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    ends = (starts + lengths)[shingle - 1:].tolist()
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(line[s:e], SEED) for s, e in zip(starts.tolist(), ends)]),
                           np.uint8).reshape(-1, 8)
    n = len(hashes)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, _UNPACK_ROWS):
        ones += np.unpackbits(hashes[i:i + _UNPACK_ROWS], axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """Fingerprints as signed 64-bit integers, computed in Arrow batches."""

    def batches(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in it:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return F.pandas_udf(batches, "long")(text)


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def block_keys(fp: Column, max_distance: int, blocks: int) -> Column:
    """One key for every combination of ``blocks - max_distance`` blocks."""
    if not 0 <= max_distance < blocks:
        raise ValueError("blocks must exceed max_distance")
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen)
             for chosen in combinations(range(blocks), blocks - max_distance)]
    return F.array(*[F.struct(F.lit(i).alias("t"), fp.bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for i, m in enumerate(masks)])


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def _near_keys(fp: Column, max_distance: int) -> Column:
    """Keys that two fingerprints share exactly if a row within reach joins them.

    For an even distance: all values up to half of it away.  For an odd one, a
    bit is masked out besides.
    """
    masked, flips = max_distance % 2, max_distance // 2
    if max_distance > 3:
        raise ValueError("heavy buckets are linked for distances up to 3")
    flip = [sum(1 << b for b in c) for n in range(flips + 1) for c in combinations(range(BITS), n)]
    if not masked:
        return F.array(*[F.struct(F.lit(-1).alias("b"), fp.bitwiseXOR(F.lit(_signed(x))).alias("v"))
                         for x in flip])
    bits = F.sequence(F.lit(0), F.lit(BITS - 1))
    values = F.array(*[F.lit(_signed(x)) for x in flip])
    return F.flatten(F.transform(bits, lambda b: F.transform(values, lambda x: F.struct(
        b.alias("b"), fp.bitwiseXOR(x).bitwiseAND(F.bitwise_not(F.call_function(
            "shiftleft", F.lit(1).cast("long"), b))).alias("v")))))


def links(fingerprints: DataFrame, max_distance: int = 2, blocks: int = 4, heavy: int = 16) -> DataFrame:
    """Verified links ``(a, b)`` whose groups are those of all pairs within reach.

    ``fingerprints`` has one column ``fp`` (long) without repeats.
    """
    keyed = materialise(
        fingerprints.select("fp", F.inline(block_keys(F.col("fp"), max_distance, blocks))), "simhash-blocks")
    sizes = keyed.groupBy("t", "key").count().where("count > 1")
    paired = keyed.join(sizes.where(F.col("count") <= heavy).select("t", "key"), ["t", "key"], "left_semi")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    light = (paired.withColumnRenamed("fp", "a").join(paired.withColumnRenamed("fp", "b"), ["t", "key"])
             .where((F.col("a") < F.col("b")) & near).select("a", "b"))
    crowded = (keyed.join(sizes.where(F.col("count") > heavy).select("t", "key"), ["t", "key"], "left_semi")
               .select("fp").distinct()
               .select("fp", F.inline(_near_keys(F.col("fp"), max_distance))))
    smallest = crowded.groupBy("b", "v").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    stars = (crowded.withColumnRenamed("fp", "b_fp").join(smallest, ["b", "v"])
             .select("a", F.col("b_fp").alias("b")).where((F.col("a") < F.col("b")) & near))
    return light.union(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_distance: int = 2, blocks: int = 4, heavy: int = 16) -> DataFrame:
    """``(id, text_hash, fp, component_id, root)``: one row per row of ``docs``.

    ``root``: the smallest fingerprint of the component, unique and never null.
    """
    rows = materialise(
        docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                    fingerprint_column(F.col(text_col), shingle).alias("fp")), "simhash-fp")
    classes = rows.groupBy("fp").agg(F.min("id").alias("first_id"))
    roots = components(links(rows.select("fp").distinct(), max_distance, blocks, heavy))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = rooted.join(smallest, "root").select("fp", "component_id", "root")
    return rows.join(by_fp, "fp").select("id", "text_hash", "fp", "component_id", "root")


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with one row per near-duplicate group: the one of smallest id.

    A null id is the last of all; among rows of that id, the smallest text hash
    stays (rows equal in id and text count as one).  All columns are kept.
    """
    found = near_duplicates(docs, **params)
    kept = found.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "text_hash")).alias("k")) \
        .select(F.col("k.id").alias("__id"), F.col("k.text_hash").alias("__hash"))
    id_col, text_col = params.get("id_col", "doc_id"), params.get("text_col", "text")
    rows = docs.withColumn("__h", F.xxhash64(text_col))
    return (rows.join(kept, rows[id_col].eqNullSafe(kept["__id"]) & (rows["__h"] == kept["__hash"]), "left_semi")
            .dropDuplicates([id_col, "__h"]).drop("__h"))
