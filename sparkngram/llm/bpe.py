"""Byte-level BPE encoding and decoding with a segment tree.

Each piece that the split pattern yields is merged on its own.  A segment
tree over the byte positions of a piece stores the lowest pair rank below
each node, the leftmost one on ties; a merge changes three leaves (the merged
pair, its left neighbour's pair and the vanished right part), each a
logarithmic update.  Live neighbours are kept in two link arrays.  Short
pieces that a worker has not met yet are merged side by side, one tree per
matrix row; the split pattern is evaluated on whole arrays of code points.

Edge cases: a null text is the empty text (no ids, empty bytes); every input
row gives one output row, repeated rows included; other columns of the input
are ignored; an empty table gives an empty table.  Whole texts are encoded.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparkngram.llm.common import chunks, id_text, mix64, prefix_hash, span_hash, utf8

VOCABULARY = "byte_bpe_50k.tiktoken"
NONE = 1 << 60  # no such token
# Pieces of at most this many bytes are remembered, at most about CACHE of them
# per worker, so at most CACHED_BYTES * CACHE bytes; this changes no result.
CACHED_BYTES, CACHE = 64, 1 << 19


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class PairTree:
    """Leftmost minimum over a fixed number of slots with point updates."""

    def __init__(self, values: list[int]):
        size = 1
        while size < len(values):
            size *= 2
        self.size = size
        self.tree = tree = [NONE] * size + values + [NONE] * (size - len(values))
        for i in range(size - 1, 0, -1):
            left, right = tree[2 * i], tree[2 * i + 1]
            tree[i] = left if left <= right else right

    def set(self, slot: int, value: int) -> None:
        tree, i = self.tree, slot + self.size
        tree[i] = value
        i >>= 1
        while i:
            left, right = tree[2 * i], tree[2 * i + 1]
            low = left if left <= right else right
            if tree[i] == low:
                break
            tree[i] = low
            i >>= 1

    def first_minimum(self) -> tuple[int, int]:
        """(value, slot), the leftmost slot on ties."""
        tree, i, low = self.tree, 1, self.tree[1]
        while i < self.size:
            i = 2 * i if tree[2 * i] == low else 2 * i + 1
        return low, i - self.size


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    end = list(range(1, n + 1))     # part i is piece[i:end[i]]
    before = list(range(-1, n - 1))  # start of the live part to the left
    get = ranks.get
    tree = PairTree([get(piece[i:i + 2], NONE) for i in range(n - 1)] + [NONE])
    while True:
        low, i = tree.first_minimum()
        if low == NONE:
            break
        j = end[i]
        tree.set(j, NONE)
        e = end[i] = end[j]
        if e < n:
            before[e] = i
            tree.set(i, get(piece[i:end[e]], NONE))
        else:
            tree.set(i, NONE)
        p = before[i]
        if p >= 0:
            tree.set(p, get(piece[p:e], NONE))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return ids


class PairTable:
    """Rank of the token that two adjacent tokens make, by open addressing
    over (left, right) so that whole arrays are looked up at once."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [(ranks[t[:i]] << 20 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks]
        self.bits = max(10, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int64)
        todo_k, todo_v = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)
        at, self.probes = self._home(todo_k), 0
        while len(todo_k):
            self.probes += 1
            free = np.flatnonzero(self.keys[at] < 0)
            self.keys[at[free]] = todo_k[free]  # the last of several stays; the others go on
            won = self.keys[at] == todo_k
            self.values[at[won]] = todo_v[won]
            todo_k, todo_v, at = todo_k[~won], todo_v[~won], (at[~won] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 20 | right
        at = self._home(keys)
        out = np.where(self.keys[at] == keys, self.values[at], NONE)
        more = np.flatnonzero((self.keys[at] >= 0) & (self.keys[at] != keys))
        for _ in range(self.probes - 1):
            if not len(more):
                break
            at = (at + 1) & ((1 << self.bits) - 1)
            hit = self.keys[at[more]] == keys[more]
            out[more[hit]] = self.values[at[more[hit]]]
            more = more[~hit & (self.keys[at[more]] >= 0)]
        return out


def merge_many(data: np.ndarray, start: np.ndarray, size: np.ndarray, byte_id: np.ndarray,
               pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """:func:`merge_piece` for many short pieces of ``data`` side by side: one
    segment tree per row of a matrix, one merge per row and round.  Returns
    the ids of all pieces in order and their number per piece."""
    m, width = len(start), 1
    while width < int(size.max()):
        width *= 2
    slot = np.arange(width)
    live = slot[None, :] < size[:, None]
    ids = np.where(live, byte_id[data[np.minimum(start[:, None] + slot[None, :], len(data) - 1)]], -1)
    nxt = np.minimum(np.tile(slot + 1, (m, 1)), size[:, None])
    prv = np.tile(slot - 1, (m, 1))
    # a leaf is rank * width + slot, so that the minimum is also the leftmost
    tree = np.full((m, 2 * width), NONE, np.int64)
    if width > 1:
        r, k = np.nonzero(live[:, 1:])
        rank = pairs.get(ids[r, k], ids[r, k + 1])
        tree[r, width + k] = np.where(rank < NONE, rank * width + k, NONE)
    level = width
    while level > 1:
        half = level // 2
        np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2], out=tree[:, half:level])
        level = half

    def put(rows, slots, values):
        at = slots + width
        tree[rows, at] = values
        while width > 1 and len(at) and at[0] > 1:
            at = at >> 1
            tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])

    rows = np.flatnonzero(tree[:, 1] < NONE) if width > 1 else np.zeros(0, np.int64)
    while len(rows):
        top = tree[rows, 1]
        i, new = top % width, top // width
        j = nxt[rows, i]
        e = nxt[rows, j]
        ids[rows, i] = new
        ids[rows, j] = -1
        nxt[rows, i] = e
        put(rows, j, NONE)
        inner = e < size[rows]
        prv[rows[inner], e[inner]] = i[inner]
        value = np.full(len(rows), NONE, np.int64)
        rank = pairs.get(new[inner], ids[rows[inner], e[inner]])
        value[inner] = np.where(rank < NONE, rank * width + i[inner], NONE)
        put(rows, i, value)
        p = prv[rows, i]
        left = p >= 0
        rank = pairs.get(ids[rows[left], p[left]], new[left])
        put(rows[left], p[left], np.where(rank < NONE, rank * width + p[left], NONE))
        rows = rows[tree[rows, 1] < NONE]
    kept = ids >= 0
    return ids[kept], kept.sum(axis=1)


LETTER, NUMBER, OTHER, SPACE = range(4)


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of each code point that the split pattern tells apart."""
    import regex
    every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, every))
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, name in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\p{White_Space}")):
        out[[ord(c) for c in regex.findall(name, text)]] = kind
    return out


def piece_starts(chars: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pieces of the public split pattern start, for the code points
    of several texts laid end to end; ``first`` marks each text's first one.
    A blank joins the run behind it, white space leaves its last character to
    a following word, and the seven English contractions stand alone."""
    n = len(chars)
    kind = char_classes()[chars]
    last = np.append(first[1:], True)
    turn = first.copy()
    turn[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    word_next = np.append(~space[1:], False) & ~last
    blank_before = np.zeros(n, bool)
    blank_before[1:] = (chars[:-1] == 32) & ~first[1:]
    start = first | (space & (turn | word_next)) | (~space & turn & ~blank_before)
    mark = np.flatnonzero((chars == 39) & start & ~last)
    if len(mark):
        far = np.append(chars, [0, 0])
        same2 = ~last[mark + 1] if n else mark
        one, two = far[mark + 1], np.where(same2, far[mark + 2], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ~short & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
        start[mark[short | long] + 1] = False
        for at, more in ((mark[short], 2), (mark[long], 3)):
            at = at[~last[at + more - 1]] + more
            start[at] = True
    return np.flatnonzero(start)


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of several spans, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _alike(a, start, size, b, start_b, size_b) -> bool:
    """Whether every span of ``a`` holds the same bytes as its span of ``b``."""
    if not (size == size_b).all():
        return False
    # spans that tile all of a need no gathering
    tiles = len(start) > 0 and start[0] == 0 and size.sum() == len(a)
    return bool(((a if tiles else a[_spans(start, size)]) == b[_spans(start_b, size)]).all())


class Growing:
    """An array that is added to at its end; its memory doubles when full."""

    def __init__(self, kind):
        self.data, self.used = np.zeros(0, kind), 0

    def add(self, new: np.ndarray) -> None:
        if self.used + len(new) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(len(self.data), len(new)), self.data.dtype)])
        self.data[self.used:self.used + len(new)] = new
        self.used += len(new)


class Codec:
    """Encoder and decoder for one rank file.  A worker remembers the ids and
    bytes of short pieces by a hash; wherever two hashes meet the bytes are
    compared, so that a collision costs time only."""

    def __init__(self, path: str, pattern: str):
        import public_tokenizers
        import regex
        self.ranks = load_ranks(path)
        self.find = None if pattern == public_tokenizers.PATTERN else regex.compile(pattern).finditer
        self.token = np.empty(max(self.ranks.values()) + 1, object)
        for token, rank in self.ranks.items():
            self.token[rank] = token
        self.decimal = np.array([str(i) for i in range(len(self.token))], object)
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs = PairTable(self.ranks)
        self.forget()

    def forget(self):
        self.hashes, self.begin = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.count, self.flat = np.zeros(0, np.int64), Growing(np.int32)
        self.at, self.size, self.bytes = np.zeros(0, np.int64), np.zeros(0, np.int64), Growing(np.uint8)

    def starts(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Byte positions at which pieces start (``off``: the texts' bounds)."""
        head = np.flatnonzero((data & 0xC0) != 0x80)
        text = data.tobytes().decode("utf-8")
        if self.find is None:
            chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            first = np.zeros(len(chars), bool)
            begin = off[:-1][np.diff(off) > 0]
            first[np.searchsorted(head, begin)] = True
            return head[piece_starts(chars, first)]
        out, bounds = [], np.searchsorted(head, off)
        for a, b in zip(bounds[:-1], bounds[1:]):
            out += [a + m.start() for m in self.find(text[a:b])]
        return head[np.array(out, np.int64)] if out else np.zeros(0, np.int64)

    def merged(self, data, start, size) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces, and where each piece's begin and how many they are."""
        begin, count = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        parts, total = [np.zeros(0, np.int64)], 0
        order = np.flatnonzero(size <= CACHED_BYTES)
        width = np.ceil(np.log2(np.maximum(size[order], 1))).astype(np.int64)
        groups = [order[width == w] for w in np.unique(width)] + [np.array([r]) for r in np.flatnonzero(size > CACHED_BYTES)]
        for rows in groups:
            if size[rows[0]] <= CACHED_BYTES:
                flat, n = merge_many(data, start[rows], size[rows], self.byte_id, self.pairs)
            else:
                i = start[rows[0]]
                flat = np.array(merge_piece(data[i:i + size[rows[0]]].tobytes(), self.ranks), np.int64)
                n = np.array([len(flat)])
            begin[rows], count[rows] = np.cumsum(n) - n + total, n
            parts.append(flat)
            total += len(flat)
        return np.concatenate(parts).astype(np.int32), begin, count

    def learn(self, data, start, size, hashes):
        """Short pieces not seen before (hashes ascending), added to what the worker knows."""
        flat, begin, count = self.merged(data, start, size)
        begin += self.flat.used
        at = np.cumsum(size) - size + self.bytes.used
        self.flat.add(flat)
        self.bytes.add(data[_spans(start, size)])
        place = np.searchsorted(self.hashes, hashes)
        for name, new in (("hashes", hashes), ("begin", begin), ("count", count), ("at", at), ("size", size)):
            setattr(self, name, np.insert(getattr(self, name), place, new))

    def encode_many(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of several texts laid end to end, and their bounds per text."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
        start = self.starts(data, off)
        size = np.diff(np.append(start, len(data)))
        h = span_hash(prefix_hash(data), start, start + size)
        kinds, where, back = np.unique(h, return_index=True, return_inverse=True)
        first = where[back]
        if _alike(data, start, size, data, start[first], size[first]):
            ids, count = self._known(data, start[where], size[where], kinds, back)
        else:
            ids, count = self._plainly(data, start, size)
        return ids, np.concatenate([[0], np.cumsum(count)])[np.searchsorted(start, off)]

    def _known(self, data, start, size, kinds, back):
        """Ids of pieces ``back`` (indices of distinct pieces), by way of what is remembered."""
        if len(self.hashes) > CACHE:
            self.forget()
        short = np.flatnonzero(size <= CACHED_BYTES)
        new = short[~self._has(kinds[short])]
        if len(new):
            self.learn(data, start[new], size[new], kinds[new])
        at = np.searchsorted(self.hashes, kinds[short])
        if not _alike(data, start[short], size[short], self.bytes.data, self.at[at], self.size[at]):
            ids, count = self._plainly(data, start, size)
            begin, flat = np.cumsum(count) - count, ids
        else:
            long = np.flatnonzero(size > CACHED_BYTES)
            flat, begin, count = self.flat.data, np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
            begin[short], count[short] = self.begin[at], self.count[at]
            if len(long):
                more, at, count[long] = self.merged(data, start[long], size[long])
                begin[long] = at + len(flat)
                flat = np.concatenate([flat, more])
        begin, count = begin[back], count[back]
        return flat[_spans(begin, count)], count

    def _has(self, kinds: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(kinds), bool)
        return self.hashes[np.minimum(np.searchsorted(self.hashes, kinds), len(self.hashes) - 1)] == kinds

    def _plainly(self, data, start, size):
        """Pieces told apart by their bytes alone."""
        seen: dict[bytes, np.ndarray] = {}
        ids = []
        for i, n in zip(start.tolist(), size.tolist()):
            piece = data[i:i + n].tobytes()
            if piece not in seen:
                seen[piece] = np.array(merge_piece(piece, self.ranks), np.int32)
            ids.append(seen[piece])
        return np.concatenate([np.zeros(0, np.int32), *ids]), np.array([len(x) for x in ids], np.int64)

    def encode(self, text: str) -> list[int]:
        data = np.frombuffer(text.encode("utf-8"), np.uint8)
        return self.encode_many(data, np.array([0, len(data)]))[0].tolist()

    def decode(self, ids) -> bytes:
        return b"".join(self.token[np.asarray(ids, np.int64)].tolist())

    def batch(self, column) -> Iterator[np.ndarray]:
        """Ids of each text of an Arrow column, in order."""
        data, off = utf8(column)
        for i, j in chunks(off):
            part = off[i:j + 1] - off[i]
            ids, bounds = self.encode_many(data[off[i]:off[j]], part)
            for a, b in zip(bounds[:-1], bounds[1:]):
                yield ids[a:b]


@lru_cache(maxsize=2)
def codec(path: str | None = None, pattern: str | None = None) -> Codec:
    """The worker's codec; without a path, the vocabulary file that the
    worker's own installation of the public tokenizers holds."""
    import public_tokenizers
    return Codec(path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN)


def encode_column(docs: DataFrame, path: str | None = None, pattern: str | None = None,
                  keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of ``docs`` plus ``ids array<int>``: the ids of
    ``text``.  One pass, no shuffle."""
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(b.schema.get_field_index("text"))
            ids = list(codec(path, pattern).batch(text.fill_null("") if text.null_count else text))
            cols = [b.column(b.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(ids, pa.list_(pa.int32()))], [*keep, "ids"])

    return docs.select(*keep, "text").mapInArrow(run, f"{fields}, ids array<int>")


def decode_column(encoded: DataFrame, path: str | None = None, pattern: str | None = None,
                  keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``data binary``: the bytes that ``ids`` stand for."""
    fields = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dec = codec(path, pattern).decode
        for b in batches:
            data = [dec(x or []) for x in b.column(b.schema.get_field_index("ids")).to_pylist()]
            cols = [b.column(b.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(data, pa.binary())], [*keep, "data"])

    return encoded.select(*keep, "ids").mapInArrow(run, f"{fields}, data binary")


def round_trip_digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (decimal ids joined by one
    space), decoded_sha256 (the bytes that the ids decode to).  Encoding and
    decoding run in one pass over each batch; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            count, ids_sha, data_sha = [], [], []
            for ids in c.batch(b.column(1)):
                count.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(c.decimal[ids].tolist()).encode()).hexdigest())
                data_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(data_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, ids, and decoded_sha256, the digest of the
    bytes that the ids decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            ids = list(c.batch(b.column(1)))
            sha = [hashlib.sha256(c.decode(x)).hexdigest() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(sha, pa.string())],
                ["doc_id", "n_tokens", "ids", "decoded_sha256"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string")
