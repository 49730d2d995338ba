"""Exact substring dedup with suffix arrays, cut into shards that Spark deals out.

A byte is removed if it is covered by a string of ``length`` bytes that also
starts in a document with a smaller id.  Strings never cross documents and are
judged on the input.

1. Documents are dealt into shards of a few MB.  In each, every window of
   ``length`` bytes names its anchor: the smallest hash of ``GRAM`` bytes in it, the
   rightmost of equal ones.  Equal windows have equal anchors.
2. The shards' sorted anchors are merged by ranges of hashes, and each shard
   looks up its own in the merged ones by binary search: an anchor that only one
   document holds proves its windows unique, and these go no further.
3. The windows that are left travel as segments (the bytes that the consecutive
   windows of one anchor cover) to the shard of their anchor's range.  Copies of a
   segment within a shard travel once.  Of an anchor with more than ``HOT`` places the
   windows that hold the bytes before it and those that hold the bytes behind it
   travel apart, each to the range of a hash of the anchor with those bytes: all
   windows that are equal hold equal ones, so no task gets all places of an anchor.
4. There a suffix array is built by Larsson-Sadakane refinement: ranks by 8
   bytes, then only the unsorted groups are refined by the ranks further on, up
   to ``length`` bytes.  Common prefixes of neighbours (Kasai's array, here cut off
   at ``length`` and compared by words, since only "as long as that" matters) bound
   the groups of equal windows; the smallest id of each group decides.
5. What was found goes back to the shards of documents, which cut it out.

The text is shuffled once: all three steps over documents read the same
exchange.  Shards and ranges grow in number, not in size, with the corpus; the
rows between them are at most one per shard and range.

Nulls and edges: a null text counts as empty; texts shorter than ``length`` lose
nothing, texts of any length are whole in one shard; a null id is larger than any
other; rows with equal ids do not remove each other's strings, so repeated rows have
equal results.  An empty table gives an empty result.  Only the two named columns
are read, so clashing names of others do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 16
# Places of an anchor, in the whole corpus, above which its windows are dealt by the bytes beside it.
HOT = 4096
_CHUNK = 1 << 17  # bytes whose hashes are made at once, to stay in a core's cache
_BASE = 0x9E3779B97F4A7C15  # odd
_SPREAD = np.uint64(0xD1B54A32D192ED03)  # odd
_LAST = (1 << 63) - 1  # stands for a null id
_SUBS = 16
_SEVERAL = 128  # the bit of an anchor's byte that says that several ids hold it


def rolling_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of every run of ``GRAM`` bytes."""
    h = data.astype(np.uint64) + np.uint64(1)
    m = 1
    while m < GRAM:
        h = h[:-m] * np.uint64(pow(_BASE, m, 1 << 64)) + h[m:]
        m *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def anchored_runs(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``(first, last, hash, anchor)`` of runs of windows with one anchor, by position; ``anchor``: its place.

    ``data``: documents end to end; ``ends``: where each ends.  Windows that cross
    an end are left out.
    """
    inside = np.ones(len(data) + 1, bool)
    for start, end in zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist()):
        inside[max(start, end - length + 1):end] = False
    grams = length - GRAM + 1
    found = []
    for at in range(0, len(data) - length + 1, _CHUNK):
        piece = data[at:at + _CHUNK + length - 1]
        hashes = rolling_hashes(piece)
        n = len(piece) - length + 1
        # High half of the hash above, reversed position below: the rightmost of equal ones is smallest.
        keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), 0, -1, dtype=np.uint64)
        m = 1
        while m < grams:
            step = min(m, grams - m)
            keys = np.minimum(keys[:-step], keys[step:])
            m += step
        ok = inside[at:at + n]
        cut = np.flatnonzero((keys[1:] != keys[:-1]) | (ok[1:] != ok[:-1])) + 1
        first = np.concatenate(([0], cut))
        last = np.concatenate((cut, [n])) - 1
        good = ok[first]
        first, last = first[good], last[good]
        anchor = len(hashes) - (keys[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # Anchors are smallest hashes; the product (one to one) spreads them over the whole range again.
        found.append((first + at, last + at, hashes[anchor] * _SPREAD, anchor + at))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def anchor_runs(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return anchored_runs(data, ends, length)[:3]


def beside_anchors(data: np.ndarray, first: np.ndarray, last: np.ndarray, hashes: np.ndarray, anchor: np.ndarray,
                   hot: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``(first, last, key)``: the runs of windows, those of hot anchors in two with keys by the bytes beside them.

    A window holds ``length - GRAM`` bytes besides its anchor: at least half of them, rounded up, before it or
    that many of the rest behind it.  Which of the two goes by the anchor's place in the window alone.
    """
    before = (length - GRAM + 1) // 2
    behind = length - GRAM - before + 1
    rest, runs = np.flatnonzero(~hot), np.flatnonzero(hot)
    turn = anchor[runs] - before  # the last window with enough bytes before the anchor
    front, back = runs[first[runs] <= turn], runs[last[runs] > turn]

    def key(of: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
        h = hashes[of].copy()
        for i in range(size):
            h = (h ^ (data[begin + i].astype(np.uint64) + np.uint64(1))) * np.uint64(_BASE)
            h ^= h >> np.uint64(29)
        return h

    return (np.concatenate((first[rest], first[front], np.maximum(first[back], anchor[back] - before + 1))),
            np.concatenate((last[rest], np.minimum(last[front], anchor[front] - before), last[back])),
            np.concatenate((hashes[rest], key(front, anchor[front] - before, before),
                            key(back, anchor[back] + GRAM, behind))))


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions sorted by their first ``depth`` bytes, and the first 8 bytes at each position.

    Larsson-Sadakane: the rank of a position is where its group begins; a group
    of one is done; the others are sorted by the ranks of the positions further on,
    which doubles the bytes that count.  Past the end stand zeros.
    """
    n = len(data)
    words = np.concatenate((data, np.zeros(depth + 8, np.uint8))).astype(np.uint64)
    for m in (1, 2, 4):
        words = (words[:-m] << np.uint64(8 * m)) | words[m:]
    words = words[:n + depth].copy()
    order = np.argsort(words[:n]).astype(np.int32)
    by_word = words[order]
    begins = np.concatenate(([True], by_word[1:] != by_word[:-1]))
    del by_word
    rank = np.full(n + depth, -1, np.int32)
    rank[order] = _group_begins(begins)
    done = 8
    while done < depth:
        slots = np.flatnonzero(~(begins & np.concatenate((begins[1:], [True])))).astype(np.int32)
        if not len(slots):
            break
        step = min(done, depth - done)
        at = order[slots]
        keys = (rank[at].astype(np.uint64) << np.uint64(32)) | (rank[at + step] + 1).astype(np.uint64)
        by = np.argsort(keys)
        at, keys = at[by], keys[by]
        del by
        order[slots] = at
        fresh = np.concatenate(([True], keys[1:] != keys[:-1]))
        begins[slots] = fresh
        rank[at] = slots[_group_begins(fresh)]
        done += step
    return order, words


def _group_begins(begins: np.ndarray) -> np.ndarray:
    """For each place, where its group begins."""
    return np.maximum.accumulate(np.where(begins, np.arange(len(begins), dtype=np.int32), np.int32(0)))


def common_prefixes(order: np.ndarray, words: np.ndarray, limit: int) -> np.ndarray:
    """Bytes that each position of ``order`` has in common with the one before it, up to ``limit``."""
    common = np.zeros(len(order), np.int32)
    live = np.arange(1, len(order), dtype=np.int32)
    for at in range(0, limit, 8):
        differ = words[order[live] + at] ^ words[order[live - 1] + at]
        same = differ == 0
        rest = live[~same]
        # Equal leading bytes of a word that differs: from its highest set bit.
        high = np.frexp((differ[~same] >> np.uint64(32)).astype(float))[1]
        low = np.frexp((differ[~same] & np.uint64(0xFFFFFFFF)).astype(float))[1]
        common[rest] = at + (64 - np.where(high > 0, high + 32, low)) // 8
        live = live[same]
    common[live] = limit
    return np.minimum(common, limit)


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...``, ``count[i]`` numbers for each ``i``."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count - first, count)


def repeated(segments: list[bytes], which: np.ndarray, ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of occurrences (segment ``which[i]`` in document ``ids[i]``): each window's place and if it repeats.

    ``(occurrence, offset)`` of every window that also stands in a document with a
    smaller id.
    """
    sizes = np.array([len(s) for s in segments], np.int64)
    starts = np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    order, words = suffix_array(np.frombuffer(b"".join(segments), np.uint8), length)
    groups = np.empty(len(order), np.int32)
    groups[order] = np.cumsum(common_prefixes(order, words, length) < length) - 1
    least = np.full(len(order), _LAST, np.int64)
    occurrence = np.repeat(np.arange(len(which)), windows[which])
    offset = _spread(np.zeros(len(which), np.int64), windows[which])
    group = groups[starts[which][occurrence] + offset]
    np.minimum.at(least, group, ids[occurrence])
    hit = least[group] < ids[occurrence]
    return occurrence[hit], offset[hit]


def _joined(group: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """A shard's rows in a fixed order, their bytes end to end, and where each ends."""
    group = group.sort_values(["id", "data"], kind="stable", ignore_index=True)
    data = np.frombuffer(b"".join(group["data"]), np.uint8)
    return group, data, np.cumsum([len(x) for x in group["data"]]).astype(np.int64)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50,
                   shard_bytes: int = 2 << 20, part_bytes: int = 2 << 20, hot_places: int = HOT) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept)`` for each row; ``kept``: the remaining bytes' SHA-256.

    ``shard_bytes`` of text make a shard of documents; the range of anchors of
    ``part_bytes`` of text makes a part, whose suffix arrays are built one after the
    other for ``_SUBS`` residues of the anchor, which bounds a task's memory.  Anchors with
    about ``hot_places`` places or more are dealt by the bytes beside them.
    """
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    rows = docs.select(F.col(id_col).isNull().alias("missing"),
                       F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LAST)).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))
    total = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id", F.octet_length("data")), F.lit(shards)).cast("int"))
    parts = max(1, -(-total // part_bytes))
    width = (1 << 64) // parts + 1

    def range_of(hashes: np.ndarray) -> np.ndarray:
        return (hashes // np.uint64(width) if parts > 1 else hashes * np.uint64(0)).astype(np.int32)

    def name_anchors(group: pd.DataFrame) -> pd.DataFrame:
        group, data, ends = _joined(group)
        first, _, hashes = anchor_runs(data, ends, length)
        ids = group["id"].to_numpy(np.int64)[np.searchsorted(ends, first, "right")]
        order = np.lexsort((ids, hashes))
        hashes, ids = hashes[order], ids[order]
        begins = np.flatnonzero(np.concatenate((np.ones(min(1, len(hashes)), bool), hashes[1:] != hashes[:-1])))
        stops = np.concatenate((begins[1:], [len(hashes)]))[:len(begins)] - 1
        # A byte of each anchor: if several ids hold it, and how often it stands here, as a power of two.
        places = np.frexp(stops - begins + 1)[1] - 1
        several = np.where(ids[begins] != ids[stops], _SEVERAL, 0) | places
        hashes = hashes[begins]
        made = []
        for part, a, b in _slices(range_of(hashes)):
            made.append((part, int(group["shard"][0]), hashes[a:b].tobytes(), several[a:b].astype(np.uint8).tobytes()))
        return pd.DataFrame(made, columns=["part", "shard", "hashes", "several"])

    def merge_anchors(group: pd.DataFrame) -> pd.DataFrame:
        runs = [np.frombuffer(x, np.uint64) for x in group["hashes"]]
        notes = np.frombuffer(b"".join(group["several"]), np.uint8)
        merged = np.concatenate(runs)
        order = np.argsort(merged)
        merged, notes = merged[order], notes[order]
        begins = np.flatnonzero(np.concatenate((np.ones(min(1, len(merged)), bool), merged[1:] != merged[:-1])))
        if not len(begins):
            return pd.DataFrame([], columns=["shard", "hashes", "hot"])
        holders = np.diff(np.concatenate((begins, [len(merged)])))
        is_shared = (holders > 1) | np.logical_or.reduceat(notes >= _SEVERAL, begins)
        places = np.add.reduceat(np.left_shift(np.int64(1), (notes & (_SEVERAL - 1)).astype(np.int64)), begins)
        shared, hot = merged[begins][is_shared], places[is_shared] > hot_places
        made = []
        for shard, run in zip(group["shard"], runs):
            if len(shared):
                at = np.minimum(np.searchsorted(shared, run), len(shared) - 1)
                at = at[shared[at] == run]
                if len(at):
                    made.append((shard, shared[at].tobytes(), shared[at[hot[at]]].tobytes()))
        return pd.DataFrame(made, columns=["shard", "hashes", "hot"])

    def cut_segments(group: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        columns = ["part", "shard", "counts", "ids", "starts", "sizes", "data", "gone"]
        if not len(group) or not len(found):
            return pd.DataFrame([], columns=columns)
        group, data, ends = _joined(group)
        first, last, hashes, anchor = anchored_runs(data, ends, length)
        shared = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in found["hashes"]]))
        at = np.minimum(np.searchsorted(shared, hashes), len(shared) - 1)
        keep = np.flatnonzero(shared[at] == hashes)
        first, last, hashes, anchor = first[keep], last[keep], hashes[keep], anchor[keep]
        hot = np.isin(hashes, np.concatenate([np.frombuffer(x, np.uint64) for x in found["hot"]]))
        first, last, hashes = beside_anchors(data, first, last, hashes, anchor, hot, length)
        ids = group["id"].to_numpy(np.int64)[np.searchsorted(ends, first, "right")]
        part, sub = range_of(hashes), (hashes % np.uint64(_SUBS)).astype(np.int32)
        order = np.lexsort((first, sub, part))  # by position, and so by id, within a part and residue
        first, stop, ids, part, sub = first[order], last[order] + length, ids[order], part[order], sub[order]
        whole = data.tobytes()
        made = []
        for value, a, b in _slices(part):
            seen: dict[bytes, int] = {}
            sent, gone = [], []
            for i, (x, y, doc) in enumerate(zip(first[a:b].tolist(), stop[a:b].tolist(), ids[a:b].tolist()), a):
                # A segment that a smaller id of this shard holds repeats as a whole.
                if seen.setdefault(whole[x:y], doc) == doc:
                    sent.append(i)
                else:
                    gone += (x, y)
            made.append((value, int(group["shard"][0]), np.bincount(sub[sent], minlength=_SUBS).astype(np.int32).tobytes(),
                         ids[sent].tobytes(), first[sent].astype(np.int32).tobytes(),
                         (stop[sent] - first[sent]).astype(np.int32).tobytes(),
                         pa.compress(b"".join([whole[x:y] for x, y in zip(first[sent].tolist(), stop[sent].tolist())]),
                                     "zstd", asbytes=True),
                         np.array(gone, np.int32).tobytes()))
        return pd.DataFrame(made, columns=columns)

    def match_segments(group: pd.DataFrame) -> pd.DataFrame:
        gone = {s: [] for s in group["shard"]}
        rows = []
        for shard, counts, i, s, n, blob, out in zip(*(group[c] for c in (
                "shard", "counts", "ids", "starts", "sizes", "data", "gone"))):
            gone[shard].append(np.frombuffer(out, np.int32).reshape(-1, 2))
            ends = [0, *np.cumsum(np.frombuffer(n, np.int32)).tolist()]
            rows.append((shard, np.cumsum(np.frombuffer(counts, np.int32)).tolist(), np.frombuffer(i, np.int64),
                         np.frombuffer(s, np.int32), ends, pa.decompress(blob, ends[-1], "zstd", asbytes=True)))
        for sub in range(_SUBS):
            known: dict[bytes, int] = {}
            which, ids, starts, owner = [], [], [], []
            for shard, until, i, s, ends, blob in rows:
                a, b = until[sub - 1] if sub else 0, until[sub]
                which += [known.setdefault(blob[x:y], len(known)) for x, y in zip(ends[a:b], ends[a + 1:b + 1])]
                ids.append(i[a:b])
                starts.append(s[a:b])
                owner.append(np.full(b - a, shard, np.int32))
            if not which:
                continue
            which, ids, starts, owner = np.array(which, np.int64), *map(np.concatenate, (ids, starts, owner))
            occurrence, offset = repeated(list(known), which, ids, length)
            if not len(occurrence):
                continue
            # Windows next to each other are one span.
            fresh = np.concatenate(([True], (occurrence[1:] != occurrence[:-1]) | (offset[1:] != offset[:-1] + 1)))
            a = np.flatnonzero(fresh)
            b = np.concatenate((a[1:], [len(fresh)])) - 1
            spans = np.stack((starts[occurrence[a]] + offset[a], starts[occurrence[b]] + offset[b] + length), 1)
            order = np.argsort(owner[occurrence[a]], kind="stable")
            for shard, x, y in _slices(owner[occurrence[a]][order]):
                gone[shard].append(spans[order[x:y]].astype(np.int32))
        made = [(s, np.concatenate(x).tobytes()) for s, x in gone.items()]
        return pd.DataFrame([m for m in made if m[1]], columns=["shard", "spans"])

    def cut_out(group: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(group):
            return pd.DataFrame([], columns=["id", "n_bytes", "n_removed", "n_spans", "kept"])
        group, data, ends = _joined(group)
        depth = np.zeros(len(data) + 1, np.int32)
        for spans in found["spans"]:
            spans = np.frombuffer(spans, np.int32).reshape(-1, 2)
            np.add.at(depth, spans[:, 0], 1)
            np.add.at(depth, spans[:, 1], -1)
        removed = np.cumsum(depth[:-1]) > 0
        made = []
        for doc, missing, a, b in zip(group["id"].tolist(), group["missing"], [0, *ends[:-1].tolist()], ends.tolist()):
            out = removed[a:b]
            n = int(out.sum())
            runs = int(np.count_nonzero(out[1:] & ~out[:-1]) + out[0]) if n else 0
            kept = data[a:b][~out] if n else data[a:b]
            made.append((None if missing else doc, b - a, n, runs, hashlib.sha256(kept.tobytes()).hexdigest()))
        out = pd.DataFrame(made, columns=["id", "n_bytes", "n_removed", "n_spans", "kept"], dtype=object)
        # Beside a null, pandas would make floats of the ids.
        return out.assign(id=pd.array(out["id"].tolist(), "Int64"))

    by_shard = rows.groupBy("shard")
    anchors = by_shard.applyInPandas(name_anchors, "part int, shard int, hashes binary, several binary")
    shared = anchors.groupBy("part").applyInPandas(merge_anchors, "shard int, hashes binary, hot binary")
    segments = by_shard.cogroup(shared.groupBy("shard")).applyInPandas(
        cut_segments, "part int, shard int, counts binary, ids binary, starts binary, sizes binary, data binary, "
                      "gone binary")
    spans = segments.groupBy("part").applyInPandas(match_segments, "shard int, spans binary")
    return rows.groupBy("shard").cogroup(spans.groupBy("shard")).applyInPandas(
        cut_out, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept string")


def _slices(sorted_values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``(value, begin, end)`` of the runs of equal values."""
    if not len(sorted_values):
        return
    cut = np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(sorted_values)]):
        yield int(sorted_values[a]), a, b
