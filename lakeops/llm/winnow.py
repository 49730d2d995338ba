"""Document fingerprints by winnowing.

Every run of ``k`` code points is hashed by a rolling polynomial; of each
window of ``w`` hashes the smallest is kept, the rightmost of equal ones, with
its position.  Two texts that share a run of ``w + k - 1`` code points keep at
least one hash in common (the match guarantee), and the kept positions tell
where.

``k`` and ``w`` are powers of two: the hash of ``2 m`` code points is made of two
of ``m``, and a minimum over ``2 m`` hashes of two over ``m``, so a text takes
``log k + log w`` passes in numpy.

Nulls and edges: a null text counts as empty; an empty text has no hashes, and
a text shorter than ``k`` code points is hashed as one run; two fingerprints
without hashes are alike by 1, one without by 0.  Very long texts are taken whole.
The next text of rows with one id goes by a digest of their texts, a null id comes
before any other; repeated rows follow each other and are told as often as they
come; an empty table gives an empty result.  Only the two named columns are read,
so clashing names of others do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K, W = 16, 32
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that no code point is lost in the product
_LOW = np.uint64(0xFFFFFFFF)


def _power(base: int, n: int) -> np.uint64:
    return np.uint64(pow(base, n, 1 << 64))


def rolling_hashes(codes: np.ndarray, k: int = K) -> np.ndarray:
    """32-bit hashes of every run of ``k`` code points (of all of them, if fewer)."""
    if k & (k - 1):
        raise ValueError("k must be a power of two")
    h = codes.astype(np.uint64) + np.uint64(1)
    if len(h) < k:
        whole = 0
        for code in h.tolist():
            whole = (whole * int(_BASE) + code) & 0xFFFFFFFFFFFFFFFF
        h = np.array([whole], np.uint64)
    else:
        m = 1
        while m < k:
            h = h[:-m] * _power(int(_BASE), m) + h[m:]
            m *= 2
    # A multiplicative mix: the low bits of a product depend on low bits only.
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h >> np.uint64(32)


def winnow(text: str, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """``(positions, hashes)`` of the kept runs, by position."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    hashes = rolling_hashes(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), k)
    n = len(hashes)
    # Hash above, reversed position below: the smallest is the rightmost of equal hashes.
    keys = (hashes << np.uint64(32)) | (_LOW - np.arange(n, dtype=np.uint64))
    m = 1
    while m < min(w, n):
        step = min(m, min(w, n) - m)
        keys = np.minimum(keys[:-step], keys[step:])
        m += step
    kept = keys[np.concatenate(([True], keys[1:] != keys[:-1]))]
    return (_LOW - (kept & _LOW)).astype(np.int64), (kept >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the different hashes of two fingerprints that both have."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def digest(positions: np.ndarray, hashes: np.ndarray) -> str:
    """A fingerprint as one string: SHA-256 over its positions and hashes."""
    return hashlib.sha256(positions.astype("<i8").tobytes() + hashes.astype("<u4").tobytes()).hexdigest()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W) -> DataFrame:
    """``(id, positions, hashes)`` for each row of ``docs``, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [winnow(t or "", k, w) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array([p.tolist() for p, _ in made], pa.list_(pa.int64())),
                                   pa.array([h.tolist() for _, h in made], pa.list_(pa.int64()))],
                                  ["id", "positions", "hashes"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, positions array<bigint>, hashes array<bigint>")


def with_next(docs: DataFrame, id_col: str, text_col: str, parts: int | None = None) -> DataFrame:
    """Distinct rows dealt so that each task holds runs of consecutive rows and the row after each run.

    ``(part, extra, key, digest, slim, id, text, copies)``, sorted so within each
    partition; ``extra`` marks the row that only follows a run.  Rows are ordered by
    id (null first), then by their text's digest.  An id with more rows than a part
    takes is cut by digests, and of equal rows each task sends one, and the number of
    the others in a row without text (``slim``), so neither crowds a part.  The
    driver sees one cut and one row's key per part, whatever the table's size; the
    text is shuffled once.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = parts or 4 * n  # several runs a task, so that tasks even out
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    # A null id sorts first: the smallest integer stands for it.
    rows = rows.select(F.coalesce("id", F.lit(-(1 << 63))).alias("key"),
                       F.substring(F.unhex(F.sha2("text", 256)), 1, _DIGEST).alias("digest"), "id", "text")
    found = rows.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)] or [0.5], 10 * parts)).first()[0]
    cuts = Cuts(found or [])

    @F.pandas_udf("int")
    def part_of(keys: pd.Series, digests: pd.Series) -> pd.Series:
        return pd.Series(cuts.part(keys.to_numpy(np.int64), digests.tolist()))

    firsts = sorted((r.part, r.lead.key, bytes(r.lead.digest)) for r in rows.groupBy(
        part_of("key", "digest").alias("part")).agg(F.min(F.struct("key", "digest")).alias("lead")).collect())
    # The row that begins a part follows the part before it (cyclic).
    follows = {first[1:]: firsts[i - 1][0] for i, first in enumerate(firsts)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again: dict[tuple, int] = {}  # of the rows of this task, which are bounded by its input
        for batch in batches:
            keys, digests, ids = (batch.column(c).to_pylist() for c in range(3))
            at, part, extra = [], [], []
            for i, (p, row) in enumerate(zip(cuts.part(np.array(keys, np.int64), digests).tolist(), zip(keys, digests, ids))):
                if row in again:
                    again[row] += 1
                    continue
                again[row] = 0
                at.append(i)
                part.append(p)
                extra.append(False)
                if row[:2] in follows:
                    at.append(i)
                    part.append(follows[row[:2]])
                    extra.append(True)
            key, digest, own, text = (batch.column(c).take(pa.array(at, pa.int32())) for c in range(4))
            yield _dealt(part, extra, key, digest, [False] * len(at), own, text, [1] * len(at))
        more = [(row, count) for row, count in again.items() if count]
        keys, digests, ids = ([row[c] for row, _ in more] for c in range(3))
        yield _dealt(cuts.part(np.array(keys, np.int64), digests), [False] * len(more), keys, digests, [True] * len(more),
                     ids, [None] * len(more), [count for _, count in more])

    return (rows.mapInArrow(deal, ", ".join(f"{c} {t}" for c, (t, _) in _DEALT.items())).repartition(n, "part")
            .sortWithinPartitions("part", "extra", "key", "digest", "id", "slim"))


# Bytes of a text's SHA-256 that stand for it.
_DIGEST = 16
_DEALT = {"part": ("int", pa.int32()), "extra": ("boolean", pa.bool_()), "key": ("bigint", pa.int64()),
          "digest": ("binary", pa.binary()), "slim": ("boolean", pa.bool_()), "id": ("bigint", pa.int64()),
          "text": ("string", pa.string()), "copies": ("bigint", pa.int64())}


def _dealt(*columns) -> pa.RecordBatch:
    return pa.record_batch([c.cast(t) if isinstance(c, pa.Array) else pa.array(c, t)
                            for c, (_, t) in zip(columns, _DEALT.values())], list(_DEALT))


class Cuts:
    """Where parts begin: quantiles of the ids; one that is several quantiles is cut by as many even ranges of digests."""

    def __init__(self, quantiles: list[int]):
        self.ids, self.times = np.unique(np.array(quantiles, np.int64), return_counts=True)
        self.before = np.concatenate(([0], np.cumsum(self.times)))

    def part(self, ids: np.ndarray, digests: list[bytes]) -> np.ndarray:
        """How many cuts are at most the row's id and digest."""
        at = np.searchsorted(self.ids, ids, "right")
        parts = self.before[at]
        if not len(ids) or not len(self.ids):
            return parts.astype(np.int32)
        last = np.maximum(at - 1, 0)
        times = self.times[last]
        split = np.flatnonzero((at > 0) & (self.ids[last] == ids) & (times > 1))
        if len(split):
            # Range j of m begins at j / m of all digests; the first range's cut is at most any digest.
            high = np.array([int.from_bytes(digests[i][:4], "big") for i in split.tolist()], np.int64)
            parts[split] += 1 + (high * times[split] >> 32) - times[split]
        return parts.astype(np.int32)


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W) -> DataFrame:
    """Each text's fingerprint against those of its edited text and of the next text.

    The edited text has the last ``n // 2`` code points replaced by the first as
    many (or all) of the next text in ascending id order; after the last comes
    the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        part, held, copies = None, None, 0  # held: the row whose next one is awaited

        def told(row, after, times):
            text, own, following = row[2], row[3], after[2]
            half = len(text) // 2
            edited = text[:len(text) - half] + following[:half]
            other = winnow(edited, k, w)
            out.append((row[0], len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                        digest(*own), digest(*other), likeness(own[1], other[1]), likeness(own[1], after[3][1]), times))

        def close(after):
            if copies > 1:  # equal rows follow each other, the last one is followed by another
                told(held, held, copies - 1)
            told(held, after, 1)

        for batch in batches:
            for p, extra, _, key, _, i, text, times in zip(*(c.to_pylist() for c in batch.columns)):
                if held is not None and p == part and not extra and held[:2] == (i, key):
                    copies += times
                    continue
                # Of the rows that follow a run, only the first one counts.
                if extra and (held is None or p != part):
                    continue
                row = (i, key, text, winnow(text, k, w))
                if held is not None and p == part:
                    close(row)
                part, held, copies = p, None if extra else row, times
            if out:
                yield _table(out)
                out.clear()

    made = with_next(docs, id_col, text_col).mapInArrow(run, _SCHEMA)
    # Equal rows are told once with their number; many of them are dealt in chunks before they are spelled out.
    chunked = made.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.expr(f"(times - 1) div {_CHUNK}").cast("bigint"))))
    rows = F.least(F.lit(_CHUNK).cast("bigint"), F.col("times") - F.col("chunk") * _CHUNK)
    return (chunked.repartition("id", "fingerprint", "edited_sha256", "chunk")
            .withColumn("one", F.explode(F.sequence(F.lit(1).cast("bigint"), rows)))
            .drop("times", "chunk", "one"))


# Equal rows that one task spells out.
_CHUNK = 10_000
_SCHEMA = ("id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, times bigint")


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                           [x.split()[0] for x in _SCHEMA.split(", ")])
