"""Document fingerprints by winnowing.

Every k-gram of the UTF-8 bytes gets a rolling hash; of each window of ``w``
consecutive k-grams the least hash is selected, the rightmost one on ties,
and its byte position kept.  Any two texts that share w + k - 1 bytes share a
selected hash, and a selected gram of one text is found in the other at the
positions kept.  A fingerprint is written as hex, 16 digits per entry: 8 for
the position, 8 for the hash.  With K = 8 and W = 16 any 23 bytes shared are
found, and a text of 23 bytes or more has several windows; a shorter one is a
single window, so a single entry.  About 2 of W + 1 grams are selected.

Edge cases: a null text is the empty text, whose fingerprint is empty; a text
shorter than k bytes is one gram; a text with fewer than ``w`` grams is one
window.  Two empty fingerprints are alike (1.0), an empty and another are not
(0.0).  Rows come out one for one, repeated ids included: documents follow one
another by doc_id (null first), then by text; the last is followed by the
first, a single one by itself.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkngram.llm.common import chunks, id_text, prefix_hash, span_hash

K, W = 8, 16
LOWEST = -(1 << 63)
FAR = np.uint64(0xFFFFFFFF)


def _window_minimum(key: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` neighbours (by doubling the span)."""
    span, out = 1, key
    while 2 * span <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = w - span
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def select(data: np.ndarray, off: np.ndarray, k: int = K, w: int = W) -> list[np.ndarray]:
    """Selected (position, hash) pairs, an (n, 2) array per text, for the
    bytes of several texts laid end to end with bounds ``off``."""
    size = np.diff(off)
    grams = np.where(size >= k, size - k + 1, np.minimum(size, 1))
    n = len(data)
    start = np.arange(n, dtype=np.int64)
    h = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    if n:
        sums = prefix_hash(data)
        if n >= k:
            h[:n - k + 1] = span_hash(sums, start[:n - k + 1], start[k - 1:] + 1)
        short = np.flatnonzero((size > 0) & (size < k))
        h[off[short]] = span_hash(sums, off[short], off[short + 1])
    # least hash first, then the rightmost position
    key = (h >> np.uint64(32) << np.uint64(32)) | (FAR - start.astype(np.uint64))
    least = _window_minimum(key, w) if n >= w else np.zeros(0, np.uint64)
    out = []
    for i in range(len(size)):
        g, a = int(grams[i]), int(off[i])
        if not g:
            out.append(np.zeros((0, 2), np.uint32))
            continue
        low = least[a:a + g - w + 1] if g >= w else key[a:a + g].min(keepdims=True)
        low = low[np.append(True, low[1:] != low[:-1])]
        at = (FAR - (low & FAR)).astype(np.int64) - a
        out.append(np.stack([at.astype(np.uint32), (low >> np.uint64(32)).astype(np.uint32)], axis=1))
    return out


def fingerprints(texts: list[str], k: int = K, w: int = W) -> list[np.ndarray]:
    """:func:`select` for a list of texts, about a megabyte at a time."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    off = np.concatenate([[0], np.cumsum([len(x) for x in data], dtype=np.int64)])
    out: list[np.ndarray] = []
    for i, j in chunks(off):
        out += select(np.frombuffer(b"".join(data[i:j]), np.uint8), off[i:j + 1] - off[i], k, w)
    return out


def to_hex(entries: np.ndarray) -> str:
    return entries.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of distinct hashes that two fingerprints have in common."""
    x, y = np.unique(a[:, 1]), np.unique(b[:, 1])
    if not len(x) and not len(y):
        return 1.0
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def fingerprint_column(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """doc_id and its fingerprint as ``array<struct<position, hash>>``; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("position", pa.int64()), ("hash", pa.int64())]))
        for b in batches:
            got = [[{"position": int(p), "hash": int(h)} for p, h in x] for x in fingerprints(b.column(1).to_pylist(), k, w)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, kind)], ["doc_id", "fingerprint"])

    return id_text(docs).mapInArrow(run, "doc_id long, fingerprint array<struct<position: long, hash: long>>")


def in_order(docs: DataFrame, parts: int) -> DataFrame:
    """(part, ahead, key, doc_id, text): the documents dealt into ranges of
    doc_id, each range sorted, followed (ahead = 1) by a copy of the first
    document of the next range, so that no task needs another's rows.  The
    bounds are ids taken from an approximate percentile of the ids alone."""
    rows = id_text(docs).withColumn("key", F.coalesce("doc_id", F.lit(LOWEST)))
    shares = [i / parts for i in range(1, parts)]
    at = rows.agg(F.min("key").alias("low"), (F.percentile_approx("key", shares, 10 * parts) if shares else
                                              F.array().cast("array<long>")).alias("cuts")).first()
    low = at["low"] if at["low"] is not None else LOWEST
    cuts = sorted(set(at["cuts"] or []) - {low})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.array(cuts, np.int64)
        for b in batches:
            key = b.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            part = np.searchsorted(bounds, key, "right")
            edge = np.flatnonzero((key == low) | ((part > 0) & (bounds[part - 1] == key) if len(bounds) else False))
            take = np.concatenate([np.arange(len(key)), edge])
            before = np.where(key[edge] == low, len(bounds), part[edge] - 1)
            own = b if not len(edge) else pa.RecordBatch.from_arrays([c.take(pa.array(take)) for c in b.columns], names=b.schema.names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([part, before]), pa.int64()),
                 pa.array(np.concatenate([np.zeros(len(key)), np.ones(len(edge))]), pa.int32()),
                 own.column(2), own.column(0), own.column(1)], ["part", "ahead", "key", "doc_id", "text"])

    dealt = rows.mapInArrow(deal, "part long, ahead int, key long, doc_id long, text string")
    return dealt.repartition(parts, "part").sortWithinPartitions("part", "ahead", "key", "text")


def with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """(doc_id, text, next text) from the rows of :func:`in_order`, as lists
    of a few megabytes at most (or one document)."""
    held, out, size = None, [], 0
    for b in batches:
        for part, ahead, doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                             b.column(3).to_pylist(), b.column(4)):
            if ahead and held is None:
                continue  # a second copy of the first document of the next range
            text = text.as_py()
            if held is not None:
                out.append((held[1], held[2], text))
                size += len(held[2])
                if size > 4_000_000:
                    yield out
                    out, size = [], 0
            held = None if ahead else (part, doc_id, text)
    if out:
        yield out


def edited(text: str, following: str) -> str:
    """``text`` whose last quarter gives way to as much of the following text's beginning."""
    m = len(text) // 4
    return text[:len(text) - m] + following[:m]


def compare_neighbours(docs: DataFrame, k: int = K, w: int = W, parts: int | None = None) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.  The texts are shuffled once."""
    parts = parts or 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in with_next(batches):
            changed = [edited(t, f) for _, t, f in rows]
            # the next document of a row is the row behind it, but for the last
            own = fingerprints([t for _, t, _ in rows] + [rows[-1][2]], k, w)
            new = fingerprints(changed, k, w)
            follow = [own[i + 1] if i + 1 < len(rows) and rows[i + 1][1] == rows[i][2] else None for i in range(len(rows))]
            follow[-1] = own[-1]
            for i in [i for i, x in enumerate(follow) if x is None]:  # the last row of a range
                follow[i] = fingerprints([rows[i][2]], k, w)[0]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([len(r[1]) for r in rows], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
                pa.array([to_hex(x) for x in own[:-1]], pa.string()),
                pa.array([to_hex(x) for x in new], pa.string()),
                pa.array([likeness(x, y) for x, y in zip(own, new)], pa.float64()),
                pa.array([likeness(x, y) for x, y in zip(own, follow)], pa.float64())],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return in_order(docs, parts).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
