"""Best-fit packing by bound-certified repacking.

Pieces are dealt to partitions of about ``group`` pieces, and each partition packs its
own best-fit decreasing.  Dual-feasible functions turn the lengths into a lower bound
on the number of sequences; a partition that meets its bound is certified: no
packing of its pieces takes fewer.  Its sequences are settled, but for the one that is
at most half full, if any; what is left needs no fewer either.  Partitions with a gap
exchange their pieces among each other, together with the released ones, and run again
in partitions twice as large; an exchange that saves nothing is undone and ends the
repacking.  A piece of full length is a sequence of its own.

Pieces are dealt by a hash of their place in a written table and then by rank of length,
so every partition gets the same share of long and short pieces, copies, one source or
one id never crowd a partition, and a lost task deals them the same way again.

Nulls and edges: a null or empty text is the end token alone; a null id stays null;
repeated rows are packed as often as they come; a text longer than a sequence is cut,
the last piece may be short; words of any length are tokenized whole; a length that is
null, below one or above the capacity is an error; an empty table gives an empty
result.  Only the named columns are read, so clashing names of others do not matter.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm.common import chunked_running, materialise

END_ID = 0
# Distinct words whose ids a worker remembers; beyond that it starts anew.
_REMEMBERED = 800_000


# ------------------------------------------------------------------ bounds and best fit
def dual_feasible_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """The largest lower bound on the number of bins that three families of dual-feasible functions give.

    Each maps lengths so that whatever fits a bin maps to at most the bin's own value; ``lengths`` are distinct.
    """
    x, n = lengths.astype(np.int64), counts.astype(np.int64)
    best = -(-int((x * n).sum()) // capacity)
    # Threshold: small pieces count nothing, those that only go with small ones count a whole bin.
    for t in np.unique(np.concatenate((x[2 * x <= capacity], capacity - x[2 * x > capacity]))).tolist():
        if 0 < t and 2 * t <= capacity:
            value = np.where(x > capacity - t, capacity, np.where(x < t, 0, x))
            best = max(best, -(-int((value * n).sum()) // capacity))
    # Rounding: in units of capacity / k, pieces are rounded down unless they are whole multiples of capacity / (k + 1).
    for k in range(1, 101):
        scaled = x * (k + 1)
        value = np.where(scaled % capacity == 0, x * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * n).sum()) // (k * capacity)))
    # Steps: small pieces in whole steps of t, large ones as what a bin holds besides the steps beside them.
    for t in range(1, capacity // 2 + 1, max(1, capacity // 2048)):
        whole = capacity // t
        value = np.where(2 * x > capacity, 2 * (whole - (capacity - x) // t), np.where(2 * x == capacity, whole, 2 * (x // t)))
        best = max(best, -(-int((value * n).sum()) // (2 * whole)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """``(bin, offset)`` of each piece and the number of bins: longest first, each into the fullest bin that takes it."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n = 0, 0  # rooms: bit r is set if a bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - room
        if room > size:
            open_by_room[room - size].append(b)
            rooms |= 1 << (room - size)
    return bins, offsets, n


# ------------------------------------------------------------------ packing a table of lengths
@dataclass
class Packing:
    """``packed``: the pieces with ``sequence_id`` and ``offset``; ``certificate``: of every partition packed on the way
    (``turn, part``) its number of sequences, ``bins``, and the lower ``bound``: equal where certified."""

    packed: DataFrame
    certificate: DataFrame


_PROOF = "turn int, part bigint, bins bigint, bound bigint"
_MADE = {"part": pa.int64(), "bin": pa.int64(), "offset": pa.int64(), "fill": pa.int64(), "bins": pa.int64(), "bound": pa.int64()}
# Partitions whose rows are dealt together.
_BLOCK_PARTS = 16
# Bits of a sequence's number left of a partition's and left of a turn's.
_BIN_BITS, _TURN_BITS = 24, 58


def _dealt(pool: DataFrame, parts: int, turn: int, length_col: str) -> DataFrame:
    """The pool with a ``part`` for each row, lengths spread evenly: a partition with more than its share of long
    pieces would leave room that another one's short pieces could fill.

    A hash makes blocks of a bounded number of rows; a block's rows go round its partitions by rank of length.
    """
    blocks = -(-parts // _BLOCK_PARTS)
    each = -(-parts // blocks)
    blocked = pool.withColumn("block", F.pmod(F.xxhash64(F.col("row"), F.lit(turn)), F.lit(blocks).cast("bigint"))) \
        .withColumn("one", F.lit(1))
    ranked = chunked_running(blocked, ["block"], length_col, ["row"], "one", "rank")
    return ranked.select(*pool.columns, (F.col("block") * each + F.pmod("rank", F.lit(each))).cast("bigint").alias("part"))


def _packed(pool: DataFrame, parts: int, turn: int, capacity: int, length_col: str) -> DataFrame:
    """Each partition of the pool packed best-fit decreasing, with its number of bins and their bound."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("row")
        lengths = group[length_col].to_numpy().astype(np.int64)
        bins, offsets, n = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)[bins]
        bound = dual_feasible_bound(*np.unique(lengths, return_counts=True), capacity)
        made = {"bin": bins, "offset": offsets, "fill": fill, "bins": np.full(len(bins), n), "bound": np.full(len(bins), bound)}
        for name, values in made.items():
            group = group.append_column(name, pa.array(values, _MADE[name]))
        return group

    dealt = _dealt(pool, parts, turn, length_col)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields] + \
        [f"{name} bigint" for name in _MADE if name != "part"]
    return dealt.groupBy("part").applyInArrow(run, ", ".join(fields))


def pack(pieces: DataFrame, capacity: int, length_col: str = "length", group: int = 20_000, rounds: int = 5,
         largest_group: int = 320_000) -> Packing:
    """Pack the rows of ``pieces`` into sequences of at most ``capacity``, each row whole.

    The columns of ``pieces`` stay; ``sequence_id`` and ``offset`` (without gaps from 0) are added.
    """
    spark, columns = pieces.sparkSession, pieces.columns
    clash = {"sequence_id", "row", "block", "one", "rank", *_MADE} & set(columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are made here")
    # Once written, a row's number no longer changes.
    rows = materialise(pieces.withColumn("row", F.monotonically_increasing_id()), "packing-pieces")
    if rows.where(F.coalesce((F.col(length_col) < 1) | (F.col(length_col) > capacity), F.lit(True))).limit(1).count():
        raise ValueError(f"lengths must be from 1 to {capacity}")
    is_full = F.col(length_col) == capacity
    settled = [rows.where(is_full).select(*columns, (-F.col("row") - 1).alias("sequence_id"),
                                          F.lit(0).cast("bigint").alias("offset"))]
    proofs = [spark.createDataFrame([], _PROOF)]
    pool, kept, kept_bins = rows.where(~is_full), None, None
    for turn in range(rounds):
        parts = -(-pool.count() // min(group << turn, largest_group))
        if not parts:
            break
        packed = materialise(_packed(pool, parts, turn, capacity, length_col), f"packing-{turn}")
        proof = materialise(packed.groupBy("part").agg(F.max("bins").alias("bins"), F.max("bound").alias("bound"))
                            .select(F.lit(turn).alias("turn"), "part", "bins", "bound"), f"packing-proof-{turn}")
        proofs.append(proof)
        if kept is not None and proof.agg(F.sum("bins")).first()[0] >= kept_bins:
            break  # nothing saved: the pieces stay where the last turn put them
        stays = (F.col("bins") == F.col("bound")) & (2 * F.col("fill") > capacity)
        number = (F.lit(turn << _TURN_BITS) + F.shiftleft("part", _BIN_BITS) + F.col("bin")).alias("sequence_id")
        settled.append(packed.where(stays).select(*columns, number, "offset"))
        exchanged = packed.where(~stays)
        kept, pool = exchanged.select(*columns, number, "offset"), exchanged.select(*columns, "row")
        kept_bins = exchanged.where("offset = 0").count()
        if parts == 1 or kept_bins < 2:
            break
    if kept is not None:
        settled.append(kept)
    return Packing(reduce(DataFrame.unionByName, settled), reduce(DataFrame.unionByName, proofs))


# ------------------------------------------------------------------ documents into pieces
# A word of letters, then of ASCII punctuation other than the apostrophe: two words to the tokenizer, neither of
# which changes with the other's presence.
_LETTERS_THEN_MARKS = re.compile(rb"((?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+)([!-&(-/:-@\[-`{-~]*)")


class Tokens:
    """Ids of whole texts, by way of the words between ASCII white space.

    No token of this tokenizer's reaches over white space, and its normalization works word by word, so a text's
    ids are those of its words in turn; each different word is encoded once, letters and the marks behind them
    apart and in lower case, as the tokenizer itself takes them.
    """

    def __init__(self, model: str):
        self._encoder = Tokenizer.from_str(model)
        self._encoder.encode_special_tokens = True  # their strings in a text are ordinary text
        self._forget()

    def _forget(self) -> None:
        self._parts: dict[bytes, tuple[int, ...]] = {}
        self._number: dict[bytes, int] = {}
        self._ids, self._ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    @staticmethod
    def _split(word: bytes) -> tuple[bytes, ...]:
        found = _LETTERS_THEN_MARKS.fullmatch(word)
        return (word,) if found is None else tuple(part for part in (found[1].lower(), found[2]) if part)

    def _learn(self, new: list[bytes]) -> None:
        split = [self._split(w) for w in new]
        parts = list(dict.fromkeys(p for of in split for p in of if p not in self._parts))
        if parts:
            found = self._encoder.encode([p.decode() for p in parts], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, np.uint32)
            of = np.array(found.word_ids, np.int64)  # the part that each id belongs to
            ends = np.searchsorted(of, np.arange(len(parts) + 1)).tolist()
            ids = ids.tolist()
            self._parts.update((p, tuple(ids[i:j])) for p, i, j in zip(parts, ends, ends[1:]))
        spelled = [[i for p in of for i in self._parts[p]] for of in split]
        self._number.update(zip(new, range(len(self._number), len(self._number) + len(new))))
        self._ids = np.concatenate([self._ids, np.array([i for ids in spelled for i in ids], np.uint32)])
        self._ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum([len(ids) for ids in spelled])])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self._number) > _REMEMBERED:
            self._forget()
        split = [t.encode().split() for t in texts]
        ends = np.cumsum([0, *map(len, split)])
        words = [w for of in split for w in of]
        at = np.fromiter(map(self._number.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(at < 0).tolist()
        if unknown:
            self._learn(list(dict.fromkeys(words[i] for i in unknown)))
            at[unknown] = [self._number[words[i]] for i in unknown]
        lengths = self._ends[at + 1] - self._ends[at]
        before = np.concatenate(([0], np.cumsum(lengths)))
        ids = self._ids[np.repeat(self._ends[at] - before[:-1], lengths) + np.arange(int(before[-1]))]
        return np.split(ids, before[ends[1:-1]])


@lru_cache(maxsize=1)
def _tokens(model: str) -> Tokens:
    """What one task has encoded serves the next one of the same worker."""
    return Tokens(model)


_PIECE = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}


def read_tokenizer(path: str) -> str:
    """A tokenizer file (JSON, a few MB), read on the driver; the tasks get its text with their code."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
           with_ids: bool = False) -> DataFrame:
    """``(id, piece, start, length, ids_crc32[, ids])``: each text's ids and an end token, cut only where they are
    longer than ``capacity``.  ``tokenizer``: the text of its file."""
    kind = docs.schema[id_col].dataType.simpleString()
    kinds = {**_PIECE, **({"ids": pa.list_(pa.int32())} if with_ids else {})}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(tokenizer)
        for batch in batches:
            for first in range(0, len(batch), 64):  # a few texts at a time bound what their ids take
                part = batch.slice(first, 64)
                rows, of = [], []
                for i, ids in enumerate(tokens.encode([t or "" for t in part.column(1).to_pylist()])):
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                    for n, start in enumerate(range(0, len(ids), capacity)):
                        cut = ids[start:start + capacity]
                        rows.append((n, start, len(cut), zlib.crc32(cut.tobytes()), *([cut.tolist()] if with_ids else [])))
                        of.append(i)
                yield pa.record_batch([part.column(0).take(pa.array(of, pa.int32())),
                                       *[pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())]], ["id", *kinds])

    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = 2048, with_ids: bool = False, **how) -> Packing:
    """Whole documents packed into sequences of at most ``capacity`` tokens."""
    return pack(pieces(docs, tokenizer, id_col, text_col, capacity, with_ids), capacity, **how)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)`` of packed pieces that carry their ``ids``; a sequence is bounded by its capacity."""
    joined = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
