"""Removal of long repeated strings by run-length compressed BWT indexes.

A byte is removed if a string of LENGTH bytes that covers it also starts
somewhere else in the corpus.  Matching is exact and judged on the input.

Routing.  The least hash of the K-byte grams of a window of LENGTH bytes (the
leftmost on ties) is the window's anchor: equal windows have equal anchors at
equal places, so windows of different anchors never need to meet.  The
consecutive windows of one anchor make a segment.  Only anchors that occur
twice are followed up.  Where all segments of an anchor are equal, all their
windows repeat.  The rest are grouped by anchor; an anchor with more than
HOT segments is split further by the bytes that all windows of a short range
share, so no group has to be whole in one task.

Index.  The distinct segments of some groups at a time (INDEX_BYTES, or one
group) are indexed: suffixes sorted by prefix doubling or tripling, their Burrows-Wheeler
transform cut into runs, the suffix and the length of the common prefix with
its neighbour sampled at every run's start and end.  Within a run these
lengths fall by one from each position of the text to the next, so streaming
once over the text from sample to sample gives the matching statistics: the
longest match of each position with any other.  Those of LENGTH or more are
marked.

Edge cases: a null text is the empty text; texts shorter than LENGTH lose
nothing; matches never cross documents; rows come out one for one, and equal
rows count as repeats of each other; a null doc_id stays null; other columns
are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkngram.llm.common import chunks, cut, id_text, prefix_hash, span_hash, utf8
from sparkngram.llm.winnowing import _window_minimum

LENGTH, K = 200, 32
HOT, RANGE = 20_000, 16
INDEX_BYTES = 1 << 17  # with arrays that stay in a core's cache
LOWEST = -(1 << 63)
PLACE = np.uint64(0xFFFFFFFF)


def segments(data: np.ndarray, off: np.ndarray, length: int = LENGTH, k: int = K):
    """(text, start, count, anchor, content hash, anchor offset) arrays: the
    segments of texts laid end to end; starts and offsets are relative."""
    n, span = len(data), length - k + 1
    if n < length:
        return [np.zeros(0, np.int64)] * 6
    sums = prefix_hash(data)
    at = np.arange(n - k + 1, dtype=np.int64)
    grams = span_hash(sums, at, at + k)
    key = (grams >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
    least = (_window_minimum(key, span) & PLACE).astype(np.int64)  # anchor of the window at each place
    text = np.repeat(np.arange(len(off) - 1), np.diff(off))[:len(least)]
    inside = np.arange(len(least)) + length <= off[text + 1]
    place = np.flatnonzero(inside)
    if not len(place):
        return [np.zeros(0, np.int64)] * 6
    anchor, owner = least[place], text[place]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(place)))
    start, anchor, owner = place[first], anchor[first], owner[first]
    content = span_hash(sums, start, start + count - 1 + length)
    return owner, start - off[owner], count, grams[anchor].view(np.int64), content.view(np.int64), anchor - start


def _keyed(docs: DataFrame) -> DataFrame:
    return id_text(docs).select(F.coalesce("doc_id", F.lit(LOWEST)).alias("id"), F.xxhash64("text").alias("th"), "text")


def all_segments(docs: DataFrame, length: int, k: int, narrow: bool) -> DataFrame:
    """One row per segment: (anchor, content), or with the place of each
    segment (id, th, start, count, shift) and without the content."""
    names = ["anchor", "content"] if narrow else ["anchor", "id", "th", "start", "count", "shift"]
    schema = "anchor long, content long" if narrow else "anchor long, id long, th long, start int, count int, shift int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, th = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            data, off = utf8(b.column(2))
            for i, j in chunks(off):
                owner, start, count, anchor, content, shift = segments(data[off[i]:off[j]], off[i:j + 1] - off[i], length, k)
                if narrow:
                    cols = [pa.array(anchor, pa.int64()), pa.array(content, pa.int64())]
                else:
                    cols = [pa.array(anchor, pa.int64()), pa.array(ids[i + owner], pa.int64()), pa.array(th[i + owner], pa.int64()),
                            *(pa.array(x.astype(np.int32), pa.int32()) for x in (start, count, shift))]
                yield pa.RecordBatch.from_arrays(cols, names)

    return _keyed(docs).mapInArrow(run, schema)


class RunIndex:
    """Run-length compressed BWT over some byte strings, with the suffixes at
    the ends of runs sampled together with the common prefix they have with
    their neighbours across the run's border."""

    def __init__(self, contents: list[bytes]):
        size = np.array([len(c) + 1 for c in contents], np.int64)
        n = int(size.sum())
        self.begin = np.cumsum(size) - size
        code = np.zeros(n, np.int64)
        mask = np.ones(n, bool)
        mask[self.begin + size - 1] = False
        code[mask] = np.frombuffer(b"".join(contents), np.uint8).astype(np.int64) + 1  # 0 ends a string
        self.left = np.repeat(self.begin + size - 1, size) - np.arange(n)             # symbols before the end
        order, levels = self._sort(code, int(size.max()))
        before = np.where(order > 0, code[order - 1], 0)
        # ends of strings differ from one another, so each is a run of its own
        border = np.flatnonzero((before[1:] != before[:-1]) | (before[1:] == 0)) + 1
        self.run_starts, self.run_ends = order[border], order[border - 1]
        self.sampled = self._common(code, levels, self.run_starts, self.run_ends)
        self.n = n

    def _sort(self, code, longest):
        """Suffixes sorted by prefix doubling, or tripling where three ranks fit
        a key: the order, and the ranks of the prefixes of each length met.  A
        rank is the place of the first suffix of its kind, so suffixes that are
        alone keep theirs, and only the others are sorted further."""
        n, at = len(code), np.arange(len(code))
        used = np.zeros(257, bool)
        used[code] = True
        used[0] = True  # smaller symbols, more of them in the first key
        dense = (np.cumsum(used) - 1)[code]
        bits = max(1, int(used.sum() - 1).bit_length())
        key, depth, want = dense, 1, min(63 // bits, 8)
        parts = {1: dense}
        while depth < want:
            more = max(m for m in parts if m <= want - depth)
            key = key << (more * bits)
            key[:n - depth] |= np.where(self.left[:n - depth] >= depth, parts[more][depth:], 0)
            depth += more
            parts[depth] = key
        levels, order, rank = [], np.empty(n, np.int64), np.zeros(n, np.int32)
        some, tied = at, at  # suffixes that are not alone, and the places they share
        step = 3 if n < (1 << 21) - 1 else 2
        while True:
            by = np.argsort(key)
            order[tied] = some[by]
            key = key[by]
            new = np.append(True, key[1:] != key[:-1])
            first = tied[new].astype(np.int32)[np.cumsum(new) - 1]
            before, rank = rank, rank.copy()
            rank[some[by]] = first
            levels.append((depth, rank))
            shared = ~(new & np.append(new[1:], True))
            split = len(levels) == 1 or not np.array_equal(rank[some], before[some])
            mask = np.empty(len(some), bool)
            mask[by] = shared
            some, tied = some[mask], tied[shared]
            if depth >= longest or not len(tied) or not split:  # no kind was split: none will be
                return np.lexsort((at, rank)) if len(tied) else order, levels
            key, left = rank[some].astype(np.int64), self.left[some]
            for j in range(1, step):
                key *= n + 1
                on = np.flatnonzero(left >= j * depth)
                key[on] += rank[some[on] + j * depth] + 1
            depth *= step

    def _common(self, code, levels, a, b):
        """Length of the common prefix of the suffixes a and b."""
        out, limit = np.zeros(len(a), np.int64), np.minimum(self.left[a], self.left[b])
        for depth, rank in reversed(levels):
            on = np.flatnonzero(limit - out >= depth)
            while len(on):
                on = on[rank[a[on] + out[on]] == rank[b[on] + out[on]]]
                out[on] += depth
                on = on[limit[on] - out[on] >= depth]
        for _ in range(levels[0][0]):
            on = np.flatnonzero(limit > out)
            on = on[code[a[on] + out[on]] == code[b[on] + out[on]]]
            if not len(on):
                break
            out[on] += 1
        return out

    def matching_statistics(self) -> np.ndarray:
        """Longest match of each position with any other, streamed in text
        order from the samples at run starts and run ends."""
        place = np.arange(self.n)
        best = np.zeros(self.n, np.int64)
        for at in (self.run_starts, self.run_ends):
            reach = np.zeros(self.n, np.int64)
            reach[at] = self.sampled + at
            best = np.maximum(best, np.maximum.accumulate(reach) - place)
        return best

    def _long(self, length: int) -> np.ndarray:
        return (self.matching_statistics() >= length) & (self.left >= length)

    def repeated(self, length: int) -> list[np.ndarray]:
        """Per string: whether the window at each place repeats elsewhere."""
        long = self._long(length)
        ends = np.append(self.begin[1:], self.n)
        return [long[a:max(a, z - length)] for a, z in zip(self.begin, ends)]

    def stretches(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(string, start, end): the stretches of such windows.  None starts at
        a string's end, so no stretch goes on into the next string."""
        edge = np.flatnonzero(np.diff(np.concatenate([[0], self._long(length).astype(np.int8), [0]])))
        start, end = edge[::2], edge[1::2]
        of = np.searchsorted(self.begin, start, "right") - 1
        return of, start - self.begin[of], end - self.begin[of]


def runs_of(flags: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of each stretch of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(anchor, sub, content, places) of the segments of the rows (id, th,
    text, segments), equal ones of a few megabytes of text in one row; those
    of hot anchors in ranges of windows, ``sub`` being the hash of the bytes
    that all windows of the range share."""
    out: dict[tuple, list] = {}
    size = 0

    def flush():
        kind = pa.list_(pa.struct([("id", pa.int64()), ("th", pa.int64()), ("start", pa.int32())]))
        keys = list(out)
        cols = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))]
        return pa.RecordBatch.from_arrays([*cols, pa.array(list(out.values()), kind)], ["anchor", "sub", "content", "places"])

    for b in batches:
        for i, (id_, th, found) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist())):
            data = b.column(2)[i].as_buffer().to_pybytes()
            for s in found:
                cuts = [(s["start"], s["count"], 0)]
                if s["hot"]:
                    # ranges lie on a grid of the window's place relative to the anchor
                    low, high = s["shift"] - s["count"] + 1, s["shift"]
                    cuts = []
                    for g in range(low // RANGE, high // RANGE + 1):
                        a, z = max(low, g * RANGE), min(high, g * RANGE + RANGE - 1)
                        start = s["start"] + high - z
                        at = s["start"] + s["shift"]  # of the anchor
                        core = data[max(0, at - g * RANGE):at - g * RANGE - RANGE + 1 + length]
                        mark = hashlib.blake2b(core, digest_size=7, salt=g.to_bytes(4, "big", signed=True)).digest()
                        cuts.append((start, z - a + 1, int.from_bytes(mark, "big") + 1))
                for start, count, sub in cuts:
                    content = data[start:start + count - 1 + length]
                    out.setdefault((s["anchor"], sub, content), []).append((id_, th, start))
                    size += len(content)
            if size > 8_000_000:
                yield flush()
                out, size = {}, 0
    yield flush()


def _marks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(id, th, a, b): ranges of repeated windows, from pieces sorted by
    (anchor, sub).  A content met twice repeats as a whole, and its places are
    written out at once; whole groups are gathered until the distinct contents
    fill an index."""
    seen: dict[tuple, int] = {}      # (group, content) -> index
    contents: list[bytes] = []
    single: list[tuple | None] = []  # the place of a content met once
    several: list[bool] = []         # whether the content's group has others
    group: list[int] = []
    rows: list[tuple] = []
    size, at = 0, None

    def written():
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], ["id", "th", "a", "b"])

    def judge():
        todo = [i for i in range(len(contents)) if several[i]]
        if todo and any(single[i] for i in todo):
            for j, a, z in zip(*(x.tolist() for x in RunIndex([contents[i] for i in todo]).stretches(length))):
                if single[todo[j]]:
                    id_, th, start = single[todo[j]]
                    rows.append((id_, th, start + a, start + z))

    for b in batches:
        of = b.column(3).offsets.to_pylist()
        ids, ths, starts = (c.to_pylist() for c in b.column(3).flatten().flatten())
        for row, (anchor, sub, content) in enumerate(zip(*(b.column(i).to_pylist() for i in range(3)))):
            places = range(of[row] - of[0], of[row + 1] - of[0])
            if (anchor, sub) != at:
                if size > INDEX_BYTES:
                    judge()
                    seen, contents, single, several, size = {}, [], [], [], 0
                if len(rows) > 50_000:
                    yield written()
                    rows = []
                at, group = (anchor, sub), []
            i = seen.get((anchor, sub, content))
            if i is None:
                i = seen[anchor, sub, content] = len(contents)
                contents.append(content)
                single.append(None)
                several.append(False)
                group.append(i)
                size += len(content)
                if len(group) > 1:
                    several[i] = several[group[0]] = True
                new = len(places) == 1
                if new:
                    single[i] = ids[places[0]], ths[places[0]], starts[places[0]]
            else:
                new = False
                if single[i]:
                    rows.append((*single[i], single[i][2] + len(content) - length + 1))
                    single[i] = None
            if not new:
                n = len(content) - length + 1
                rows.extend((ids[p], ths[p], starts[p], starts[p] + n) for p in places)
                if len(rows) > 50_000:
                    yield written()
                    rows = []
    judge()
    yield written()


def _removed(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n_bytes, n_removed, n_spans, sha = [], [], [], []
        for i, runs in enumerate(b.column(2).to_pylist()):
            raw = np.frombuffer(b.column(1)[i].as_buffer(), np.uint8)
            n_bytes.append(len(raw))
            if not runs:
                n_removed.append(0)
                n_spans.append(0)
                sha.append(hashlib.sha256(raw).hexdigest())
                continue
            edge = np.zeros(len(raw) + 1, np.int64)
            np.add.at(edge, [r["a"] for r in runs], 1)
            np.add.at(edge, [r["b"] - 1 + length for r in runs], -1)
            gone = np.cumsum(edge[:-1]) > 0
            n_removed.append(int(gone.sum()))
            n_spans.append(len(runs_of(gone)))
            sha.append(hashlib.sha256(raw[~gone].tobytes()).hexdigest())
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip((n_bytes, n_removed, n_spans, sha), kinds))],
                                         ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, k: int = K, hot: int = HOT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    twice = cut(all_segments(docs, length, k, narrow=True).groupBy("anchor").agg(
        F.count(F.lit(1)).alias("k"), F.min("content").alias("x"), F.max("content").alias("y")).where("k > 1")
        .select("anchor", (F.col("x") != F.col("y")).alias("mixed"), (F.col("k") > hot).alias("hot")))
    found = cut(all_segments(docs, length, k, narrow=False).join(twice, "anchor"))
    texts = _keyed(docs).repartition(parts, "id", "th")  # one exchange of the texts for both joins below
    mixed = (found.where("mixed").groupBy("id", "th").agg(F.collect_set(F.struct("start", "count", "shift", "anchor", "hot")).alias("found")))
    pieces = (texts.join(mixed, ["id", "th"]).select("id", "th", "text", "found")
              .mapInArrow(lambda it: _pieces(it, length), "anchor long, sub long, content binary, places array<struct<id: long, th: long, start: int>>"))
    marks = (pieces.repartition(parts, "anchor", "sub").sortWithinPartitions("anchor", "sub")
             .mapInArrow(lambda it: _marks(it, length), "id long, th long, a int, b int"))
    plain = found.where("not mixed").select("id", "th", F.col("start").alias("a"), (F.col("start") + F.col("count")).alias("b"))
    runs = plain.union(marks).groupBy("id", "th").agg(F.collect_set(F.struct("a", "b")).alias("runs"))
    out = texts.join(runs, ["id", "th"], "left").select("id", "text", "runs").mapInArrow(
        lambda it: _removed(it, length), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.select(F.nullif("id", F.lit(LOWEST)).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
