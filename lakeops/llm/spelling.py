"""Spelling variant grouping by a frequency-vector trie.

A word is described by how often each letter group occurs in it.  Words are
arranged in a trie by those counts, one group a level.  One inserted, deleted or
replaced letter changes the counts by at most one surplus and one deficit, so a
depth-first search that may spend one of each reaches every word within one
edit; the words of the leaves it reaches are verified letter by letter.

The trie is cut into cells: a node with more than ``cell_words`` words is split at
its next level, any other is a cell.  Only the split nodes are known to all
tasks; there are at most ``levels * words / cell_words`` of them.  A word is stored
in one cell and sent as a query to every cell that the search over the split nodes
reaches, so all that is near a word meets it in one task.  In a cell the search
carries all its queries at once.  A full vector that still holds too many words (of
the same letters) is divided by halves: of two words one edit apart, the front or
the back half is the same.

Nulls and edges: a null or empty text has no words; a null id is written as an empty
text where the id is part of a hash; repeated rows count as often as they come; of
near words with equal counts the first in code-point order is the form; runs of
any length are whole words; an empty table gives an empty result.  Only the two
named columns are read, so clashing names of others do not matter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import materialise

# Of how many (document, word) pairs one gets a typo (fixed value).
TYPO = 97
# Letter groups in the order of the trie's levels, one letter each; any other
# code point joins the group of its number modulo their count.
LEVELS = "eaionrtslducmphgbvfyzkwjxq"
N_LEVELS = len(LEVELS)
# Counts are kept in a byte each; larger ones count as this, which only lets more words through to verification.
_MOST = 255
# Words of a node that are compared with its queries at once instead of descending further.
_LEAF = 24
_BLOCK = 1 << 21
# Pairs verified at once, and the longest words among them; longer ones are verified one by one.
_PAIRS, _WIDE = 1 << 17, 24
# Different words whose counts a task holds before it hands them on.
_HELD = 300_000

_LEVEL_OF = np.array([LEVELS.index(chr(c)) if chr(c) in LEVELS else c % N_LEVELS for c in range(256)], np.int64)


# ------------------------------------------------------------------ words and their counts
# Words are runs of A-Z, a-z and U+00C0 to U+00FF (fixed values).  In UTF-8 the latter are the byte C3 and one
# from 80 to BF, so where no other character is left, a table of bytes tells letters, lower-cased, from the rest.
_OTHER = re.compile("[^\\x00-\\x7F\u00C0-\u00FF]+")
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c == 0xC3 or 0x80 <= c <= 0xBF else 32
                 for c in range(256))


def words_of(doc_id: int | None, text: str | None) -> Counter:
    """How often each word (UTF-8) occurs in a text, typos applied."""
    text = text or ""
    runs = Counter((text if text.isascii() else _OTHER.sub(" ", text)).encode().translate(_LETTERS).split())
    prefix, crc32 = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id), zlib.crc32
    changed: Counter = Counter()
    for run, h in [(run, h) for run in runs if not (h := crc32(run, prefix)) % TYPO]:
        letters = run.decode()
        at = h % len(letters)
        changed[(letters[:at] + letters[at + 1:]).encode()] += runs.pop(run)
    runs.update(changed)
    return runs


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5,
               least_count: int = 3) -> DataFrame:
    """``(word, n)`` of every word of the corpus that is long and frequent enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[bytes, int] = defaultdict(int)

        def told():
            rows = [(word.decode(), n) for word, n in held.items()]
            held.clear()
            return _rows([r for r in rows if len(r[0]) >= least_length], {"word": pa.string(), "n": pa.int64()})

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in words_of(i, text.as_py()).items():
                    held[word] += n
                if len(held) > _HELD:
                    yield told()
        yield told()

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


# ------------------------------------------------------------------ vectors and the search over them
def vectors(words: list[str]) -> np.ndarray:
    """Letter-group counts, a row of bytes per word."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    levels = np.where(codes < 256, _LEVEL_OF[np.minimum(codes, 255)], codes % N_LEVELS)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    counts = np.bincount(row * N_LEVELS + levels, minlength=len(words) * N_LEVELS)
    return np.minimum(counts, _MOST).astype(np.uint8).reshape(len(words), N_LEVELS)


def reached(vector: bytes, split: frozenset[bytes]) -> list[bytes]:
    """The ends of the depth-first search over the split nodes: cells, or full vectors that are split."""
    ends, stack = [], [(b"", 1, 1)]
    while stack:
        node, surplus, deficit = stack.pop()
        if node not in split or len(node) == N_LEVELS:
            ends.append(node)
            continue
        c = vector[len(node)]
        stack.append((node + bytes([c]), surplus, deficit))
        if surplus and c < _MOST:
            stack.append((node + bytes([c + 1]), 0, deficit))
        if deficit and c:
            stack.append((node + bytes([c - 1]), surplus, 0))
    return ends


def half_keys(word: str) -> list[tuple[int, str, str]]:
    """Two words one edit apart share a key whose number is the length of the shorter."""
    n = len(word)
    return [key for m in (n, n - 1) for key in ((m, "front", word[:m // 2]), (m, "back", word[n - (m - m // 2):]))]


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    same = len(a) == len(b)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + same:] == b[i + 1:]


def candidates(stored: np.ndarray, queries: np.ndarray, depth: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Depth-first over the trie of ``stored`` below its first ``depth`` levels, on which all agree.

    Yields ``(stored rows, query rows, crossed)``: pairs within a surplus and a
    deficit of one, or, if ``crossed``, a leaf of equal vectors and the queries
    that reach it, any of which may match.
    """
    stored, queries = stored.astype(np.int16), queries.astype(np.int16)
    over = stored[0, :depth] - queries[:, :depth]
    surplus = 1 - np.maximum(over, 0).sum(1, dtype=np.int64)
    deficit = 1 - np.maximum(-over, 0).sum(1, dtype=np.int64)
    ok = (surplus >= 0) & (deficit >= 0)
    stack = [(depth, np.arange(len(stored)), np.flatnonzero(ok), surplus[ok], deficit[ok])]
    while stack:
        level, s, q, surplus, deficit = stack.pop()
        if not len(q):
            continue
        if len(s) <= _LEAF:
            step = max(1, _BLOCK // (len(s) * (N_LEVELS - level + 1)))
            for i in range(0, len(q), step):
                over = stored[s, None, level:] - queries[None, q[i:i + step], level:]
                near = ((np.maximum(over, 0).sum(2) <= surplus[i:i + step])
                        & (np.maximum(-over, 0).sum(2) <= deficit[i:i + step]))
                a, b = np.nonzero(near)
                yield s[a], q[i:i + step][b], False
        elif level == N_LEVELS:
            yield s, q, True
        else:
            of, own = stored[s, level], queries[q, level]
            for c in np.unique(of):
                over = c - own
                left, short = surplus - (over > 0), deficit - (over < 0)
                go = (np.abs(over) <= 1) & (left >= 0) & (short >= 0)
                stack.append((level + 1, s[of == c], q[go], left[go], short[go]))


class _Letters:
    """Code points of words, aligned at the front and at the back, to compare many pairs at once."""

    def __init__(self, words: list[str]):
        self.words, self.lengths = words, np.array([len(w) for w in words])
        self.width = int(min(_WIDE, self.lengths.max(initial=1)))
        short = [w if len(w) <= self.width else "" for w in words]
        self.front = self._aligned([w.ljust(self.width, "\0") for w in short])
        self.back = self._aligned([w.rjust(self.width, "\0") for w in short])[:, ::-1]

    def _aligned(self, padded: list[str]) -> np.ndarray:
        codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
        return codes.reshape(len(padded), self.width)

    def one_edit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of rows are words one edit apart: all but one letter of the longer lie in what is common to
        both fronts or both backs."""
        shorter, longer = np.minimum(self.lengths[a], self.lengths[b]), np.maximum(self.lengths[a], self.lengths[b])
        ok = (longer - shorter <= 1) & (longer <= self.width) & (a != b)
        i = np.flatnonzero(ok)
        common = [np.minimum(np.where(same.all(1), self.width, same.argmin(1)), shorter[i])
                  for same in (side[a[i]] == side[b[i]] for side in (self.front, self.back))]
        ok[i] = common[0] + common[1] >= longer[i] - 1
        for j in np.flatnonzero(longer > self.width).tolist():
            ok[j] = one_edit(self.words[a[j]], self.words[b[j]])
        return ok


def near_words(words: list[str], is_stored: np.ndarray, depth: int,
               key: tuple | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(stored rows, rows)`` of words one edit apart, in the trie below ``depth`` levels.

    With ``key``, of a full vector divided by halves: pairs whose first common key it is.
    """
    counts, letters = vectors(words), _Letters(words)
    of = np.flatnonzero(is_stored)
    for s, q, crossed in candidates(counts[of], counts, depth):
        if crossed:
            by_key = defaultdict(list)
            for i in of[s].tolist():
                for k in half_keys(words[i]):
                    by_key[k].append(i)
            blocks = ([(i, j) for i in {i for k in half_keys(words[j]) for i in by_key.get(k, ())}] for j in q.tolist())
            pairs = (np.array(block).T for block in blocks if block)
        else:
            pairs = ((of[s[i:i + _PAIRS]], q[i:i + _PAIRS]) for i in range(0, len(s), _PAIRS))
        for a, b in pairs:
            near = letters.one_edit(a, b)
            if key is not None:
                near[near] = [key == _first_common(words[i], words[j]) for i, j in zip(a[near], b[near])]
            yield a[near], b[near]


def _first_common(a: str, b: str) -> tuple:
    m, keys = min(len(a), len(b)), set(half_keys(b))
    return next(k for k in half_keys(a) if k[0] == m and k in keys)


# ------------------------------------------------------------------ the operator
def split_nodes(words: DataFrame, cell_words: int) -> frozenset[bytes]:
    """The trie nodes with more than ``cell_words`` words; ``words`` has their ``vector``."""
    split: set[bytes] = set()
    for depth in range(N_LEVELS + 1):
        heavy = (words.groupBy(F.substring("vector", 1, depth).alias("node")).count()
                 .where(F.col("count") > cell_words).select("node").collect())
        if not heavy:
            break
        split.update(bytes(r.node) for r in heavy)
    return frozenset(split)


def _send(split: frozenset[bytes]):
    """Rows of words dealt to cells: each to its own (``stored``) and to those its search reaches."""

    def cells(word: str, vector: bytes) -> Iterator[tuple[bytes, bool, str | None]]:
        depth = 0
        while depth < N_LEVELS and vector[:depth] in split:
            depth += 1
        home = vector[:depth]
        for end in reached(vector, split):
            if end not in split:
                yield end, end == home, None
            else:  # a full vector with too many words
                for m, side, half in half_keys(word):
                    yield end, end == home, f"{m} {side} {half}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for word, n, vector in zip(*(c.to_pylist() for c in batch.columns)):
                out += [(*cell, word, n) for cell in cells(word, vector)]
                if len(out) > 50_000:
                    yield _rows(out, _SENT)
                    out = []
            if out:
                yield _rows(out, _SENT)

    return run


_SENT = {"cell": pa.binary(), "stored": pa.bool_(), "half": pa.string(), "word": pa.string(), "n": pa.int64()}
_FOUND = {"word": pa.string(), "n": pa.int64(), "n_near": pa.int64(), "near": pa.string(), "near_n": pa.int64()}


def _rows(rows: list[tuple], kinds: dict) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds.values())], list(kinds))


def _meet(key: tuple, group: pa.Table) -> pa.Table:
    """The stored words of a cell, each with its near words' number and the most frequent one."""
    cell, half = key[0].as_py(), key[1].as_py()
    words, n = group["word"].to_pylist(), group["n"].to_numpy()
    stored = group["stored"].to_numpy()
    count = np.zeros(len(words), np.int64)
    order = np.array(sorted(range(len(words)), key=lambda i: (-n[i], words[i])), np.int64)
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    best = np.full(len(words), len(words))
    if stored.any():
        m, side, text = half.split(" ", 2) if half is not None else (0, "", "")
        for i, j in near_words(words, stored, len(cell), (int(m), side, text) if half is not None else None):
            np.add.at(count, i, 1)
            np.minimum.at(best, i, place[j])
    near = [order[best[i]] if count[i] else None for i in range(len(words))]
    rows = [(words[i], n[i], count[i], None if near[i] is None else words[near[i]], None if near[i] is None else n[near[i]])
            for i in np.flatnonzero(stored).tolist()]
    return pa.table({k: pa.array([r[c] for r in rows], t) for c, (k, t) in enumerate(_FOUND.items())})


def nearest(words: DataFrame, cell_words: int = 50_000) -> DataFrame:
    """``(word, n, n_near, near, near_n)`` for ``words(word, n)``: how many words are one edit away, and the
    most frequent of them."""

    @F.pandas_udf("binary")
    def vector(w: pd.Series) -> pd.Series:
        return pd.Series([v.tobytes() for v in vectors(w.tolist())], dtype=object)

    words = materialise(words.select("word", "n", vector("word").alias("vector")), "spelling-words")
    split = split_nodes(words, cell_words)
    sent = words.mapInArrow(_send(split), "cell binary, stored boolean, half string, word string, n bigint")
    met = sent.groupBy("cell", "half").applyInArrow(_meet, "word string, n bigint, n_near bigint, near string, near_n bigint")
    if not any(len(node) == N_LEVELS for node in split):
        return met
    # Words of divided vectors were met by halves.
    order = F.when(F.col("near").isNotNull(), F.struct(-F.col("near_n"), F.col("near")))
    first = F.min_by(F.struct("near", "near_n"), order)
    return (met.groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), first.alias("f"))
            .select("word", "n", "n_near", "f.near", "f.near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``forms(word, form)``, whose chains have an end: pointers are doubled until none moves."""
    jumps = materialise(forms.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialise(jumps.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if not moved.where("moved").limit(1).count():
            return moved.select("word", "root")
        jumps = moved.select("word", "root")


def variants(words: DataFrame, ratio: int = 2, cell_words: int = 50_000) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for ``words(word, n)``.

    ``form``: the most frequent word one edit away, if at least ``ratio`` times as
    frequent; ``root``: where the chain of forms ends (counts rise along it, so it does).
    """
    found = nearest(words, cell_words)
    is_form = F.col("near_n") >= ratio * F.col("n")
    formed = materialise(found.select("word", "n", "n_near", F.when(is_form, F.col("near")).alias("form"),
                                      F.when(is_form, F.col("near_n")).alias("form_n")), "spelling-forms")
    return (formed.join(roots(formed), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
