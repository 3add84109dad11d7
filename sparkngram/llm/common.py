"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkngram.session import ensure_checkpoint_dir, let_go

# Text bytes that one vectorised step holds at a time (one longer text is a
# step of its own).
CHUNK_BYTES = 1 << 20
# Rows of an Arrow batch of texts, unless the session sets a number of its own:
# Spark's default of 10,000 rows of long texts would not fit beside others.
BATCH_ROWS, BATCH_KEY, BATCH_DEFAULT = 500, "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_ROWS rows where the session has Spark's default."""
    if spark.conf.get(BATCH_KEY) == BATCH_DEFAULT:
        spark.conf.set(BATCH_KEY, str(BATCH_ROWS))


def id_text(docs: DataFrame) -> DataFrame:
    """The two columns an operator reads, whatever else the table holds; a
    null text counts as the empty text."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder that
    ``spark.checkpoint.dir`` names, so that a lost executor costs only the
    tasks of the stage at hand.  Spark removes a plan's shuffle files once the
    driver has no use for the plan: of many steps in a row those behind the cut
    would stay until its memory fills, so it is asked to look now."""
    ensure_checkpoint_dir(df.sparkSession)
    done = df.checkpoint(eager=True)
    let_go(df.sparkSession)
    return done


HOT_ROWS, HOT_KEYS = 1000, 4096


def spread_join(left: DataFrame, right: DataFrame, key: str, by: list[str], rows: int = HOT_ROWS, keys: int = HOT_KEYS) -> DataFrame:
    """``left`` and ``right`` joined on ``key``, of which ``left`` may hold many
    rows: those of a key with more than ``rows`` are dealt by the columns
    ``by`` to as many parts as they fill, and only such a key's rows of
    ``right`` are copied, once a part.  ``rows`` rises with the table so that
    fewer than ``keys`` hot keys exist, which bounds the broadcast."""
    left = cut(left)
    limit = max(rows, -(-left.count() // keys))
    hot = left.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > limit)
    hot = cut(hot.select(key, F.ceil(F.col("_rows") / limit).cast("int").alias("_parts")))
    part = F.pmod(F.xxhash64(*by), F.coalesce("_parts", F.lit(1))).cast("int")
    dealt = left.join(F.broadcast(hot), key, "left").withColumn("_part", part).drop("_parts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    spread = right.join(F.broadcast(hot), key, "left").withColumn("_part", copies).drop("_parts")
    return dealt.join(spread, [key, "_part"]).drop("_part")


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of an Arrow string or binary column without nulls."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    kind = np.int64 if wide else np.int32
    off = np.frombuffer(off, kind, len(col) + 1 + col.offset)[col.offset:].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def chunks(off: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with about ``size`` bytes each (one row at least)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        yield i, j
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64's constants) over an unsigned array."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BASE = 0x9E3779B97F4A7C15
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    if n:
        p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


class Powers:
    """Powers of the rolling-hash base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * CHUNK_BYTES)
            self.up, self.down = _powers(BASE, size), _powers(pow(BASE, -1, 1 << 64), size)
        return self.up[:n], self.down[:n]


POWERS = Powers()


def prefix_hash(data: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """Prefix sums from which :func:`span_hash` takes the hash of any span.
    ``data`` holds bytes, or any codes when ``table`` is None and the dtype is uint64."""
    up, _ = POWERS.get(len(data))
    h = np.zeros(len(data) + 1, np.uint64)
    codes = _BYTE[data] if data.dtype == np.uint8 else mix64(data) | np.uint64(1)
    np.cumsum(codes * up, out=h[1:])
    return h


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end): equal spans, equal hashes."""
    _, down = POWERS.get(len(h))
    return mix64((h[end] - h[start]) * down[start] + (end - start).astype(np.uint64))


# A Mersenne prime and two bases: 62 bits of hash.
PRIME, BASES = (1 << 31) - 1, (1299709321, 1500450271)
_CODE = _BYTE >> np.uint64(33)


class PrimePowers:
    """Powers of the bases and of their inverses modulo the prime, grown on demand."""

    def __init__(self):
        self.tables = []

    @staticmethod
    def _grown(base: int, n: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < n:
            out = np.concatenate([out, out * np.uint64(pow(base, len(out), PRIME)) % np.uint64(PRIME)])
        return out

    def get(self, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        if not self.tables or len(self.tables[0][0]) < n:
            size = max(n, 2 * CHUNK_BYTES)
            self.tables = [(self._grown(b, size), self._grown(pow(b, -1, PRIME), size)) for b in BASES]
        return self.tables


PRIME_POWERS = PrimePowers()


def prime_span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """62-bit hash of each byte span [start, end), modulo a prime, so that no
    text is built from repeats that make it collide."""
    out, p, code = np.zeros(len(start), np.uint64), np.uint64(PRIME), _CODE[data]
    for up, down in PRIME_POWERS.get(len(data) + 1):
        h = np.zeros(len(data) + 1, np.uint64)
        x = code * up[:len(data)]
        # below 2**32 each, equal modulo the prime: sums of 2**32 terms fit
        np.cumsum((x & p) + (x >> np.uint64(31)), out=h[1:])
        out = out << np.uint64(31) | (h[end] - h[start]) % p * down[start] % p
    return mix64(out + (end - start).astype(np.uint64) * np.uint64(BASE))
