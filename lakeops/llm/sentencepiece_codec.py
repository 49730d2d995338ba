"""SentencePiece encoding and decoding by an Aho-Corasick driven Viterbi search.

The pieces of a public model file are put into an Aho-Corasick automaton.  One
pass over a text visits, at each position, every piece that ends there (the
automaton's output links) and relaxes the best score of that position from the
position where the piece begins.  Following the best pieces back gives the
segmentation with the greatest sum of scores; of equal ones the one with fewer
pieces, and then the one whose last piece is longer.

Text is framed as the model asks: a space becomes the mark U+2581, and one mark
is put before the text.  A character without a piece becomes its UTF-8 bytes
(byte pieces); so does a U+2581 of the text itself, so decoding gives back every
text exactly.

Where the model's type is unigram its scores are used as they are.  The scores
of a BPE model are merge ranks, not probabilities; as such they would favour
many short pieces, so rank ``r`` is read as Zipf's log probability
``-log(r + 1)``.

A piece has marks at its beginning only, so the best segmentation of a text is
that of its words (a mark and what follows), one after the other.  Words are
solved once and remembered by each worker, up to a bound.

Nulls and edges: a null text has null ids, an empty one no ids; repeated rows
get equal ids.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
# Stands in for a U+2581 of the text itself; not a character that text can hold.
_LITERAL = "\ud800"
# Scores are added up as integers, in so many parts of one: sums do not depend on their order.
_PARTS = 1 << 20
_BYTE_SCORE = -30 * _PARTS  # below any piece: bytes are the last resort
# A piece's score and a count of one, as one number: of equal scores fewer pieces are more.
_SCORE, _ONE = 1 << 32, 1
# Words that a worker remembers (about 200 bytes each); beyond it the memory is emptied.
_REMEMBERED = 600_000
_ROWS_OUT = 256
_UNITS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Codec:
    """Encoder and decoder of one model (the bytes of its file)."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        told = proto.ModelProto()
        told.ParseFromString(model)
        kinds = proto.ModelProto.SentencePiece
        unigram = told.trainer_spec.model_type == proto.TrainerSpec.UNIGRAM
        # Words can be solved one by one only if no piece reaches from one into the next.
        self.by_word = all(MARK not in p.piece.lstrip(MARK) for p in told.pieces)
        self.pieces = [p.piece for p in told.pieces]
        self.byte_of: dict[int, int] = {}
        self.byte_id: dict[int, int] = {}
        self.unknown = 0
        self.automaton = ahocorasick.Automaton()
        for i, p in enumerate(told.pieces):
            if p.type == kinds.BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_of[i], self.byte_id[value] = value, i
            elif p.type == kinds.UNKNOWN:
                self.unknown = i
            elif p.type in (kinds.NORMAL, kinds.USER_DEFINED):
                score = p.score if unigram else -math.log1p(max(0.0, -p.score))
                self.automaton.add_word(p.piece, (i, len(p.piece), round(score * _PARTS) * _SCORE - _ONE))
        self.automaton.make_automaton()
        # The text of each piece; a byte that is no character by itself has none.
        self.text_of = [p.replace(MARK, " ") for p in self.pieces]
        for i, value in self.byte_of.items():
            self.text_of[i] = chr(value) if value < 0x80 else None
        self.spells = np.isin(np.arange(len(self.pieces)), list(self.byte_of))
        self.memory: dict[str, bytes] = {}

    def viterbi(self, text: str) -> list[int]:
        """Ids of the best segmentation of a framed text."""
        n = len(text)
        best: list[int | None] = [0] + [None] * n
        begin, by = [0] * (n + 1), [-1] * (n + 1)
        at = 1  # positions before it are final
        # At one position the automaton's output links go from the longest piece to the shortest.
        for end, (piece, length, value) in self.automaton.iter(text):
            stop = end + 1
            while at < stop:
                if best[at] is None:
                    best[at], begin[at] = best[at - 1] + self._bytes_value(text[at - 1]), at - 1
                at += 1
            total = best[stop - length] + value
            if best[stop] is None or total > best[stop]:
                best[stop], begin[stop], by[stop] = total, stop - length, piece
        while at <= n:
            if best[at] is None:
                best[at], begin[at] = best[at - 1] + self._bytes_value(text[at - 1]), at - 1
            at += 1
        ids: list[int] = []
        stop = n
        while stop:
            start, piece = begin[stop], by[stop]
            if piece < 0:  # a character that no piece ends with is spelled in bytes
                ids.extend(reversed(self._bytes(text[start])))
            else:
                ids.append(piece)
            stop = start
        return ids[::-1]

    def _bytes(self, char: str) -> list[int]:
        char = MARK if char == _LITERAL else char
        return [self.byte_id.get(b, self.unknown) for b in char.encode("utf-8", "surrogatepass")]

    def _bytes_value(self, char: str) -> int:
        return len(self._bytes(char)) * (_BYTE_SCORE * _SCORE - _ONE)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text."""
        if not text:
            return np.zeros(0, np.int32)
        framed = MARK + text.replace(MARK, _LITERAL).replace(" ", MARK)
        units = _UNITS.findall(framed) if self.by_word else [framed]
        memory = self.memory
        found = [memory.get(unit) or self._solve(unit) for unit in units]
        return np.frombuffer(b"".join(found), np.int32)

    def _solve(self, unit: str) -> bytes:
        ids = np.array(self.viterbi(unit), np.int32).tobytes()
        if len(unit) <= 32:
            if len(self.memory) >= _REMEMBERED:
                self.memory.clear()
            self.memory[unit] = ids
        return ids

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``encode``'s ids."""
        texts = list(map(self.text_of.__getitem__, ids.tolist()))
        if None in texts:
            texts = self._with_bytes(ids.tolist(), texts)
        return "".join(texts)[1:]

    def _with_bytes(self, ids: list[int], texts: list[str | None]) -> list[str]:
        """``texts`` with runs of byte pieces read as UTF-8."""
        out: list[str] = []
        spelled = bytearray()
        for i, text in zip(ids, texts):
            value = self.byte_of.get(i)
            if value is not None:
                spelled.append(value)
                continue
            if spelled:
                out.append(spelled.decode("utf-8", "surrogatepass"))
                spelled.clear()
            out.append(text)
        out.append(spelled.decode("utf-8", "surrogatepass"))
        return out


@lru_cache(maxsize=2)
def codec(model: bytes) -> Codec:
    """One codec for each model and worker process."""
    return Codec(model)


def encode_rows(docs: DataFrame, model: bytes, text_col: str = "text", ids_col: str = "input_ids") -> DataFrame:
    """``docs`` with the ids of each text; the model file (a few MB at most) is broadcast.

    Ids leave the workers in small batches: they take more room than the texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(shared.value)
        for whole in batches:
            for start in range(0, len(whole), _ROWS_OUT):
                batch = whole.slice(start, _ROWS_OUT)
                found = [None if t is None else known.encode(t) for t in batch.column(at).to_pylist()]
                ends = np.cumsum([0 if x is None else len(x) for x in found])
                ids = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], ends)).astype(np.int32)),
                    pa.array(np.concatenate([np.zeros(0, np.int32), *(x for x in found if x is not None)])),
                    mask=pa.array([x is None for x in found]))
                yield pa.record_batch([*batch.columns, ids], [*batch.schema.names, ids_col])

    return docs.mapInArrow(encode, T.StructType([*docs.schema.fields, T.StructField(
        ids_col, T.ArrayType(T.IntegerType(), False))]))


def decode_column(spark: SparkSession, model: bytes, ids: Column) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = codec(shared.value)
        for rows in batches:
            yield pd.Series([None if x is None else known.decode(x) for x in rows], dtype=object)

    return decode(ids)


def encoded_digests(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, n_bytes_pieces, ids_sha256, decoded_sha256, exact)`` for each row.

    Each text is encoded and its ids decoded in one pass; ``exact``: the decoded
    text equals the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(shared.value)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                if text is None:
                    rows.append((None, None, None, None, None))
                    continue
                ids = known.encode(text)
                back = known.decode(ids)
                rows.append((len(ids), int(known.spells[ids].sum()),
                             hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest(),
                             hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(), back == text))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
            yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                                  ["id", "n_tokens", "n_byte_pieces", "ids_sha256", "decoded_sha256", "exact"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n_tokens bigint, n_byte_pieces bigint, ids_sha256 string, decoded_sha256 string, "
             "exact boolean")
