"""Skew-aware join patterns.

Two shapes recur in language-model scoring:

* rows joined back to their own per-group totals (``attach_group_totals``):
  a hot prefix such as ``the`` can own a large share of all n-gram rows,
  and a plain shuffle join puts that whole group into one task;
* many requests joined to a lookup table that has few rows per key
  (``lookup_join``, ``split_hot_join``): a popular request key is hot on the
  request side.

The explicit forms split the hottest keys off and serve them with a broadcast
hash join.
The broadcast side is a ``limit(max_hot_keys)`` of keys (times the few
lookup rows per key), so its size is bounded by construction and never by
the data.  Everything else goes through the ordinary shuffle join, where no
key exceeds the hot threshold unless more than ``max_hot_keys`` keys are hot.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Defaults: a key is "hot" when it owns more rows than this ...
HOT_ROWS = 1_000_000
# ... and at most this many hot keys are split off (bounded broadcast).
MAX_HOT_KEYS = 2_000
# Hashes by which rows are counted to tell where hot keys may be.
HASHES = 1 << 16


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    """A threshold from the session conf (``sparkngram.hotRows`` /
    ``sparkngram.maxHotKeys``) so operators can tune it per cluster."""
    v = df.sparkSession.conf.get(key, None)
    return int(v) if v else default


def _hot_keys(counts: DataFrame, keys: Sequence[str], count_col: str,
              hot_rows: int, max_hot_keys: int) -> DataFrame:
    return (counts.where(F.col(count_col) > F.lit(hot_rows))
            .orderBy(F.col(count_col).desc())
            .limit(max_hot_keys))


def attach_group_totals(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column] | Mapping[str, Column],
                        hot_rows: int | None = None, max_hot_keys: int | None = None,
                        stats: DataFrame | None = None, rows_col: str | None = None, rows: DataFrame | None = None) -> DataFrame:
    """Add per-group aggregates (``aggs`` must be aliased) to every row.

    Equivalent to ``agg.over(Window.partitionBy(keys))`` but safe for hot groups.
    A precomputed ``stats`` table (one row per key, with its row count in
    ``rows_col``) can be passed instead of ``aggs``.

    ``aggs`` by name (a mapping): the rows are first counted by a hash of the
    keys, HASHES counts in all.  Where a hash has at most ``hot_rows`` rows, so
    has each of its groups, and a window adds the totals, one shuffle of the
    rows; only the rows of the other hashes are totalled and joined.  ``rows``:
    a table with the same keys, row for row, that is cheaper to count.
    """
    keys = list(keys)
    hot_rows = hot_rows if hot_rows is not None else _conf_int(df, "sparkngram.hotRows", HOT_ROWS)
    max_hot_keys = max_hot_keys if max_hot_keys is not None else _conf_int(df, "sparkngram.maxHotKeys", MAX_HOT_KEYS)
    if isinstance(aggs, Mapping):
        w = Window.partitionBy(*keys)
        sums = [c.alias(name) for name, c in aggs.items()]
        mark = F.pmod(F.xxhash64(*keys), F.lit(HASHES)).cast("int")
        crowded = (rows if rows is not None else df).select(mark.alias("_hash")).groupBy("_hash").count().where(F.col("count") > hot_rows)
        crowded = materialize(crowded.select("_hash"))
        if not crowded.limit(1).count():
            return df.select("*", *[c.over(w).alias(name) for name, c in aggs.items()])
        crowded = F.broadcast(crowded)  # HASHES rows at most
        marked = df.withColumn("_hash", mark)
        calm = marked.join(crowded, "_hash", "left_anti").select(*df.columns, *[c.over(w).alias(name) for name, c in aggs.items()])
        return calm.unionByName(attach_group_totals(marked.join(crowded, "_hash", "left_semi").select(*df.columns), keys, sums, hot_rows, max_hot_keys))
    if stats is None:
        stats = df.groupBy(*keys).agg(*aggs, F.count(F.lit(1)).alias("_grp_rows"))
    else:
        stats = stats.withColumnRenamed(rows_col, "_grp_rows")
    hot = _hot_keys(stats, keys, "_grp_rows", hot_rows, max_hot_keys).drop("_grp_rows")
    stats = stats.drop("_grp_rows")
    tagged = df.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), keys, "left")
    hot_part = tagged.where(F.col("_hot").isNotNull()).drop("_hot")
    cold = tagged.where(F.col("_hot").isNull()).select(*df.columns)
    cold_part = cold.join(stats, keys, "inner")
    return hot_part.unionByName(cold_part)


# Bits of a hashed set of keys (4 MB), whatever the input, and 64-bit words of it in a row.
KEY_BITS, ROW_WORDS = 1 << 25, 1 << 10


def thin(df: DataFrame, keys: Sequence[str], wanted: DataFrame, bits: int = KEY_BITS) -> DataFrame:
    """Rows of ``df`` whose ``keys`` may be in ``wanted`` (the same columns), and
    few others: only a hashed set of ``bits`` bits, a power of two from 64 on, is
    broadcast, in rows of ROW_WORDS words.  For rows that else would be shuffled
    to be dropped."""
    words = min(ROW_WORDS, bits >> 6)
    row = 6 + words.bit_length() - 1
    place = F.xxhash64(*keys).bitwiseAND(F.lit(bits - 1))
    bit_of = lambda p: p.bitwiseAND(F.lit(63)).cast("int")
    some = wanted.select(F.shiftright(place, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit_of(place)).alias("set"))
    none = df.sparkSession.range(bits >> 6).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("set"))
    each = some.unionByName(none).groupBy("word").agg(F.bit_or("set").alias("set"))
    rows = each.groupBy(F.shiftright("word", row - 6).alias("_row")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("word", "set"))), lambda x: x["set"]).alias("_words"))
    held = F.get("_words", F.shiftright("_place", 6).bitwiseAND(F.lit(words - 1)).cast("int"))
    bit = F.call_function("shiftright", held, bit_of(F.col("_place"))).bitwiseAND(F.lit(1))
    return (df.withColumn("_place", place).join(F.broadcast(rows), (F.shiftright("_place", row) == F.col("_row")) & (bit == 1), "left_semi")
            .select(*df.columns))


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Requests joined to a lookup table with few rows per key: a plain join.
    Where both inputs reach it through their own exchange, AQE's skew-join rule
    splits a hot request key at run time; :func:`split_hot_join` is the explicit
    form for plans where they do not."""
    return left.join(right, list(on), how)


def split_hot_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                   hot_rows: int = HOT_ROWS, max_hot_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """Explicit hot-key split for shapes AQE cannot split (the inputs are
    not plain shuffle stages).  Hot keys of ``left`` (more than
    ``hot_rows`` rows, at most ``max_hot_keys`` of them) are joined with a
    broadcast slice of ``right``; the rest use a shuffle join.
    """
    on = list(on)
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_key_rows"))
    hot = _hot_keys(counts, on, "_key_rows", hot_rows, max_hot_keys).select(*on)
    hot_b = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    tagged = left.join(hot_b, on, "left")
    left_hot = tagged.where(F.col("_hot").isNotNull()).drop("_hot")
    left_cold = tagged.where(F.col("_hot").isNull()).drop("_hot")
    right_hot = right.join(F.broadcast(hot), on, "left_semi")
    part_hot = left_hot.join(F.broadcast(right_hot), on, how)
    part_cold = left_cold.join(right, on, how)
    return part_hot.unionByName(part_cold)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by a table in the shared folder named in
    ``spark.checkpoint.dir``: compressed columns, of which a plan reads those it
    needs, where ``checkpoint()`` keeps whole rows as they are.  A cluster
    session without that folder is refused: a plan that stays lazy could be
    laid out differently each time it runs."""
    from sparkngram.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/tables/made-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """:func:`materialize`, and the shuffle files behind the table are let go of."""
    from sparkngram.session import let_go
    out = materialize(df)
    let_go(df.sparkSession)
    return out


def dropped(table: DataFrame) -> None:
    """Remove a table of :func:`materialize` that no plan reads any more."""
    from sparkngram.sources.store import drop
    files = table.inputFiles()
    if files:
        drop(table.sparkSession, files[0].rsplit("/", 1)[0])


def checked_broadcast(df: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` only after checking it has at most ``max_rows`` rows.

    Returns ``(df_or_broadcast, was_broadcast)``.  The check is one cheap
    count on a small input; beyond the bound the caller gets the plain
    DataFrame and Spark plans a shuffle join.
    """
    n = df.limit(max_rows + 1).count()
    if n <= max_rows:
        return F.broadcast(df), True
    return df, False
