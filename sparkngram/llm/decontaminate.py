"""Benchmark decontamination by size-partitioned MinHash containment search.

Items and documents are sets of word shingles (A-Z lower-cased, words
``[^\\x20\\x09-\\x0D]+``).  An item has shingles of ``words`` words, or one of
all its words if it has fewer; a document has shingles of each length that the
items have, so that an item of one to four words is found inside a longer
document as well.  A document holds an item if it has at least
``numerator / denominator`` of the item's shingles.

1. *Sketches.*  Items are partitioned by size, class c for 2^c to 2^(c+1) - 1
   shingles.  A document that holds an item of n shingles misses at most
   m = n - ceil(n * numerator / denominator) of them.  The sketch of an item
   is its bottom m + need shingles by MinHash order, where ``need`` = 1 + 2^c / 8
   belongs to the class: however the missing ones fall, ``need`` of the sketch
   are there.  So the search loses no pair, and larger items must show more
   shared shingles before they become candidates.
2. *Search.*  Hashes of the documents' shingles meet the sketches; a pair with
   ``need`` hits is a candidate.  A document's own size does not enter:
   containment asks for the item's shingles only, so a short item in a very
   long document is as likely to be found as in a short one.
3. *Verification.*  All shingles of a candidate's item are looked up, by text,
   among the document's; the exact count decides.

A broadcast of hash buckets (FILTER of them at most, whatever the size of the
benchmark) drops most shingles of documents before anything is kept or
shuffled; beyond that size more shingles pass, none is lost.  Keys with many
rows (a passage that a third of all documents share) are dealt to parts whose
number follows the count of their rows (:func:`spread_join`).

Edge cases: a null text is the empty text; items without words match nothing,
and nor do documents without words; texts of a repeated item_id count as one
item, and a null item_id is a value of its own;
rows are judged one by one (a document is a doc_id, null or not, and the hash
of its text), and of the rows of one doc_id the greatest ``n_shared`` comes
out; other columns are ignored; empty tables give an empty table.  Everything
is DataFrame operations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkngram.llm.common import cut, spread_join

WORDS, NUMERATOR, DENOMINATOR = 5, 4, 5
FILTER = 1 << 18
LOWEST = -(1 << 63)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: Column) -> Column:
    """Words of a text; of no words, an empty array."""
    folded = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(folded, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def item_lengths(benchmark: DataFrame, words: int = WORDS) -> list[int]:
    """The lengths of the items' shingles, ``words`` values at most."""
    sizes = benchmark.select(F.least(F.size(_words(F.col("text"))), F.lit(words)).alias("n")).where("n > 0")
    return sorted(r["n"] for r in sizes.distinct().collect())


def shingle_rows(table: DataFrame, key: str, length: int) -> DataFrame:
    """(``key``, text_hash, shingle): one row per run of ``length`` words of
    each text, repeated ones included.  The words are laid beside themselves,
    shifted, and exploded."""
    w = table.select(F.coalesce(F.col(key).cast("long"), F.lit(LOWEST)).alias(key), text_hash().alias("text_hash"), _words(F.col("text")).alias("w"))
    n = F.size("w")
    shifted = [F.slice("w", i + 1, F.greatest(n - (length - 1), F.lit(0))).alias(f"w{i}") for i in range(length)]
    rows = w.select(key, "text_hash", F.inline(F.arrays_zip(*shifted)))
    return rows.select(key, "text_hash", F.concat_ws(" ", *[f"w{i}" for i in range(length)]).alias("shingle"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def bucket(hashed: str) -> Column:
    return F.pmod(F.col(hashed), F.lit(FILTER)).cast("int")


def item_shingles(benchmark: DataFrame, lengths: list[int], words: int = WORDS, numerator: int = NUMERATOR,
                  denominator: int = DENOMINATOR) -> DataFrame:
    """(item_id, shingle, h, n, need, sketched): the distinct shingles of each
    item, their number, the hits that the search needs, and whether the item's
    sketch holds the shingle."""
    size = F.least(F.size(_words(F.col("text"))), F.lit(words))
    rows = _union([shingle_rows(benchmark.where(size == k), "item_id", k) for k in lengths]).select("item_id", "shingle").distinct()
    sets = rows.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct(F.xxhash64("shingle").alias("h"), "shingle"))).alias("s"))
    n = F.size("s").cast("long")
    missing = n - F.ceil(n * numerator / F.lit(denominator)).cast("long")
    # the least size of the item's class, and what a holder of such an item surely has
    least = F.pow(F.lit(2.0), F.floor(F.log2(n.cast("double")) + 1e-12)).cast("long")
    need = F.greatest(F.lit(1), F.least(1 + F.floor(least / 8).cast("long"), n - missing))
    each = sets.withColumn("n", n).withColumn("need", need).withColumn("k", missing + F.col("need"))
    return each.select("item_id", "n", "need", "k", F.posexplode("s").alias("_pos", "_x")).select(
        "item_id", F.col("_x.shingle").alias("shingle"), F.col("_x.h").alias("h"), "n", "need", (F.col("_pos") < F.col("k")).alias("sketched"))


def candidates(rows: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id): pairs of which the document has as many
    shingles of the item's sketch as its size class needs."""
    sketch = items.where("sketched").select("item_id", "h", "need")
    wanted = sketch.select(bucket("h").alias("_bucket")).distinct()  # FILTER rows at most
    hashes = (rows.withColumn("_bucket", bucket("h")).join(F.broadcast(wanted), "_bucket", "left_semi")
              .select("doc_id", "text_hash", "h").distinct())
    hits = spread_join(hashes, sketch, "h", ["doc_id", "text_hash"])
    found = hits.groupBy("doc_id", "text_hash", "item_id", "need").agg(F.count(F.lit(1)).alias("hits"))
    return found.where("hits >= need").select("doc_id", "text_hash", "item_id")


def contained_in_rows(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, numerator: int = NUMERATOR,
                      denominator: int = DENOMINATOR) -> DataFrame:
    """(doc_id, text_hash, item_id, n_shared, n): every item that a row's text
    holds; LOWEST stands for a null id."""
    lengths = item_lengths(benchmark, words) or [words]
    items = cut(item_shingles(benchmark, lengths, words, numerator, denominator))
    buckets = items.select(bucket("h").alias("_bucket")).distinct()  # FILTER rows at most
    rows = _union([shingle_rows(docs, "doc_id", k) for k in lengths]).withColumn("h", F.xxhash64("shingle")).withColumn("_bucket", bucket("h"))
    # one pass over the texts; the search and the verification read what is left
    rows = cut(rows.join(F.broadcast(buckets), "_bucket", "left_semi").select("doc_id", "text_hash", "shingle", "h"))
    pairs = cut(candidates(rows, items))
    asked = spread_join(pairs, items.select("item_id", "shingle", "n"), "item_id", ["doc_id", "text_hash"])
    present = rows.select("doc_id", "text_hash", "shingle").distinct()
    shared = asked.join(present, ["doc_id", "text_hash", "shingle"])
    counted = shared.groupBy("doc_id", "text_hash", "item_id", "n").agg(F.count(F.lit(1)).alias("n_shared"))
    return counted.where(F.col("n_shared") * denominator >= F.col("n") * numerator).select("doc_id", "text_hash", "item_id", "n_shared", "n")


def contained_items(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, numerator: int = NUMERATOR,
                    denominator: int = DENOMINATOR) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item): every item that a document holds."""
    held = (contained_in_rows(docs, benchmark, words, numerator, denominator)
            .groupBy("doc_id", "item_id", "n").agg(F.max("n_shared").alias("n_shared")))
    return held.select(F.nullif("doc_id", F.lit(LOWEST)).alias("doc_id"), F.nullif("item_id", F.lit(LOWEST)).alias("item_id"),
                       "n_shared", F.col("n").alias("n_item"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, judged one by one."""
    dirty = contained_in_rows(docs, benchmark).select(F.nullif("doc_id", F.lit(LOWEST)).alias("_dirty"), F.col("text_hash").alias("_hash")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_dirty")) & (text_hash() == F.col("_hash"))
    return docs.join(dirty, same, "left_anti")


def oracle_sql(words: int = WORDS, numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> str:
    """DuckDB SQL for :func:`contained_items` with distinct non-null ids."""
    def words_of(table, key):
        return (f"SELECT {key}, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
                f"'[\\x20\\x09-\\x0D]+') IF x <> ''] AS w FROM {table}")
    runs = "unnest([array_to_string(w[i:i + l - 1], ' ') FOR i IN range(1, len(w) - l + 2)])"
    return (f"WITH iw AS (SELECT *, least(len(w), {words}) AS l FROM ({words_of('benchmark', 'item_id')}) WHERE len(w) > 0), "
            f"dw AS ({words_of('documents', 'doc_id')}), i AS (SELECT DISTINCT item_id, {runs} AS s FROM iw), "
            f"d AS (SELECT DISTINCT doc_id, {runs} AS s FROM dw JOIN (SELECT DISTINCT l FROM iw) ON len(w) >= l), "
            "n AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id), "
            "p AS (SELECT doc_id, item_id, count(*) AS k FROM d JOIN i USING (s) GROUP BY doc_id, item_id) "
            f"SELECT doc_id, item_id, k AS n_shared, n AS n_item FROM p JOIN n USING (item_id) WHERE k * {denominator} >= n * {numerator}")
