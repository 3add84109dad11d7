"""Stupid backoff (F1-F4) and its published lookup table.

Score of an order-n row for a model of order x:
``0.4^(x-n) * freq / sum(freq over the same prefix)``; unigrams use
``freq / sum(all unigram freq)`` with no factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkngram.operators.ngrams import top_by_group
from sparkngram.plans.joins import attach_group_totals

BETA = 0.4


def _unigram_scores(counts: DataFrame) -> DataFrame:
    uni = counts.where(F.col("n") == 1)
    total = uni.agg(F.sum("freq").alias("_tot"))  # one row
    return (uni.crossJoin(F.broadcast(total))
            .select("n", F.col("word").alias("w"), F.col("word").alias("pred"), "freq",
                    (F.col("freq") / F.col("_tot")).alias("score")))


def sbo_scores(counts: DataFrame, max_order: int = 4, beta: float = BETA) -> DataFrame:
    """F1 + F2 for every n-gram of order 1..max_order: ``(n, w, pred, freq, score)``."""
    hi = counts.where((F.col("n") >= 2) & (F.col("n") <= max_order)).select("n", "w", "pred", "freq")
    hi = attach_group_totals(hi, ["n", "w"], {"_wsum": F.sum("freq")})
    hi = hi.select("n", "w", "pred", "freq",
                   (F.pow(F.lit(beta), F.lit(max_order) - F.col("n")) * F.col("freq") / F.col("_wsum"))
                   .alias("score"))
    return _unigram_scores(counts).unionByName(hi)


def sbo_model(counts: DataFrame, max_order: int = 4, k: int = 5, beta: float = BETA) -> DataFrame:
    """Top-k continuations per prefix, ``(n, w, pred, score, rnk)``.

    Top-k is taken on ``freq`` (same order as score inside one prefix) before
    the per-prefix sum is joined, so only k rows per prefix meet the join.
    Unigrams: the global top-k, with ``w = pred = word``.
    """
    hi = counts.where((F.col("n") >= 2) & (F.col("n") <= max_order)).select("n", "w", "pred", "freq")
    top = top_by_group(hi, ["n", "w"], [F.col("freq").desc(), F.col("pred").asc()], k)
    sums = hi.groupBy("n", "w").agg(F.sum("freq").alias("_wsum"))
    top = top.join(sums, ["n", "w"], "inner").select(
        "n", "w", "pred",
        (F.pow(F.lit(beta), F.lit(max_order) - F.col("n")) * F.col("freq") / F.col("_wsum")).alias("score"),
        "rnk")
    uni = _unigram_scores(counts)
    uni_top = (uni.orderBy(F.col("score").desc(), F.col("pred").asc()).limit(k)
               .withColumn("rnk", F.row_number().over(
                   Window.orderBy(F.col("score").desc(), F.col("pred").asc())))
               .select("n", "w", "pred", "score", "rnk"))
    return uni_top.unionByName(top)


def textbook_sbo(counts: DataFrame, max_order: int = 4, beta: float = BETA) -> DataFrame:
    """``beta^(x-n) * C(ngram) / C(prefix (n-1)-gram)``; the unigram level
    uses ``beta^(x-1) * C(w) / N``.  Joins each n-gram to its prefix count."""
    hi = counts.where((F.col("n") >= 2) & (F.col("n") <= max_order))
    pref = counts.select((F.col("n") + 1).alias("n"), F.col("word").alias("w"), F.col("freq").alias("_pc"))
    hi = hi.join(pref, ["n", "w"], "inner").select(
        "n", "word", (F.pow(F.lit(beta), F.lit(max_order) - F.col("n")) * F.col("freq") / F.col("_pc")).alias("score"))
    uni = counts.where(F.col("n") == 1)
    total = uni.agg(F.sum("freq").alias("_tot"))
    uni = uni.crossJoin(F.broadcast(total)).select(
        "n", "word", (F.lit(beta ** (max_order - 1)) * F.col("freq") / F.col("_tot")).alias("score"))
    return uni.unionByName(hi)
