"""Corpus readers (A1, A2, A10-A13, B6) over the driver tables.

A "line" is one ``\\n``-separated line of a document's text; that is the
unit the reference reads with ``readLines``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkngram.functions import clean as C


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Scan-parallelism guard for text tables.

    Cleaning and n-gram extraction are CPU-heavy per row.  When the scan
    yields fewer splits than the cluster has cores (a small or
    single-row-group file), spread the rows; a large input already has
    enough splits and is left untouched (no extra shuffle).
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    want = 4 * cores  # documents vary from one word to tens of thousands: smaller slices balance better
    return df.repartition(want, key) if key else df.repartition(want)


def explode_lines(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """One row per line: ``keep`` columns + ``line_no`` (0-based) + ``line``."""
    return (df.select(*keep, F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line")))


def training_lines(spark: SparkSession, sf_dir: str, lang: str | None = "en") -> DataFrame:
    """A1 + B6: ``lines(source, doc_id, line_no, line)`` of the training corpus.

    The language filter reaches the parquet scan (PushedFilters) and only
    the four needed columns are read.
    """
    docs = table(spark, sf_dir, "documents")
    if lang is not None:
        docs = docs.where(F.col("lang") == F.lit(lang))
    docs = spread(docs.select("source", "doc_id", "text"), "doc_id")
    return explode_lines(docs, "text", ["source", "doc_id"])


def heldout_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 stand-ins: ``benchmark.text`` -> blogs, user turns -> tweets.

    Returns ``(dataset, src_id, line_no, line)`` with the raw line.
    """
    blogs = table(spark, sf_dir, "benchmark").select(
        F.lit("blogs").alias("dataset"), F.col("item_id").alias("src_id"), "text")
    tweets = (table(spark, sf_dir, "conversations").where(F.col("role") == F.lit("user"))
              .select(F.lit("tweets").alias("dataset"),
                      (F.col("conv_id") * F.lit(1000) + F.col("turn")).alias("src_id"), "text"))
    return explode_lines(spread(blogs.unionByName(tweets), "src_id"), "text", ["dataset", "src_id"])


def heldout_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out lines cleaned by C18 (per dataset)."""
    h = heldout_lines(spark, sf_dir)
    return h.select("dataset", "src_id", "line_no",
                    C.clean_eval_by(F.col("line"), F.col("dataset")).alias("line"))


def line_set_fingerprint(df: DataFrame, group: str, line: str = "line") -> DataFrame:
    """A2: order-free fingerprint of a line set of any size, the sum of the
    lines' hashes (partial aggregation; repeated lines count each time)."""
    part = F.conv(F.substring(F.md5(F.col(line)), 1, 14), 16, 10).cast("decimal(20,0)")
    return df.groupBy(group).agg(F.sum(part).cast("string").alias("hash"), F.count(F.lit(1)).alias("lines"))


def matching_lines(lines: DataFrame, substring: str, line: str = "line", whole: bool = False) -> DataFrame:
    """The distinct lines that contain ``substring``; ``whole`` leaves out
    lines that were cut short, which an ellipsis at their end says."""
    kept = lines.where(F.col(line).contains(substring))
    if whole:
        kept = kept.where(~F.rtrim(line).rlike("(\\.\\.\\.|\u2026)$"))
    return kept.select(line).distinct()


def html_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraph text of every page, tags and common entities removed,
    newlines flattened, de-duplicated per page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    body = F.regexp_replace(F.col("html"), r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    paras = F.regexp_extract_all(body, F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"), 1)
    out = pages.select("page_id", F.posexplode(paras).alias("pos", "raw"))
    txt = F.regexp_replace(F.col("raw"), r"<[^>]*>", "")
    for ent, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                    ("&amp;", "&")):
        txt = F.replace(txt, F.lit(ent), F.lit(ch))
    txt = F.trim(F.regexp_replace(C.newlines_to_blank(txt), r"\s+", " "))
    out = out.select("page_id", "pos", txt.alias("text")).where(F.col("text") != F.lit(""))
    return out.groupBy("page_id", "text").agg(F.min("pos").alias("pos"))


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 on fixtures: parse the JSON ``props`` of events."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.from_json("props", "k long").alias("p")).select(
        "event_id", F.col("p.k").alias("k"))
