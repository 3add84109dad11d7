"""Interpolated Kneser-Ney for orders 1-3 (F21-F23), token-exact.

* unigram: ``freq / (sum freq - offset)`` (offset 3 as in the reference
  script; a sentinel word can be forced to 0);
* bigram ``ab``: ``max(C(ab)-D2, 0)/C(a) + D2/C(a) * N1+(a.) * N1+(.b) / N1+(..)``;
* trigram ``abc``: ``max(C(abc)-D3, 0)/C(ab) + D3/C(ab) * N1+(ab.) * P_KN(bc)``;
with ``D = N1 / (N1 + 2 N2)`` from the order's own counts of counts.
``N1+(a.)`` counts bigram *types* starting with a, ``N1+(.b)`` types ending
with b (by whole tokens, not string prefixes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkngram.plans.joins import attach_group_totals


def _discount(t: DataFrame) -> DataFrame:
    return t.agg((F.count(F.when(F.col("freq") == 1, 1)) /
                  (F.count(F.when(F.col("freq") == 1, 1)) + F.lit(2) * F.count(F.when(F.col("freq") == 2, 1))))
                 .alias("D"), F.count(F.lit(1)).alias("types"))  # one row


def kn_unigram(counts: DataFrame, offset: float = 3.0, zero_word: str | None = None) -> DataFrame:
    uni = counts.where(F.col("n") == 1).select("word", "freq")
    tot = uni.agg(F.sum("freq").alias("_t"))
    p = F.col("freq") / (F.col("_t") - F.lit(offset))
    if zero_word is not None:
        p = F.when(F.col("word") == F.lit(zero_word), F.lit(0.0)).otherwise(p)
    return uni.crossJoin(F.broadcast(tot)).select("word", "freq", p.alias("pkn"))


def kn_bigram(counts: DataFrame) -> DataFrame:
    """``(word, w, pred, freq, pkn)`` for every bigram."""
    big = counts.where(F.col("n") == 2).select("word", "w", "pred", "freq")
    uni = counts.where(F.col("n") == 1).select(F.col("word").alias("w"), F.col("freq").alias("c_a"))
    d = _discount(big)
    x = attach_group_totals(big, ["pred"], {"n1_b": F.count(F.lit(1))})
    x = attach_group_totals(x, ["w"], {"n1_a": F.count(F.lit(1))}, rows=big)  # last: the join by w finds the rows in place
    x = x.join(uni, "w", "left").crossJoin(F.broadcast(d))
    p = (F.greatest(F.col("freq") - F.col("D"), F.lit(0.0)) / F.col("c_a")
         + F.col("D") / F.col("c_a") * F.col("n1_a") * F.col("n1_b") / F.col("types"))
    return x.select("word", "w", "pred", "freq", p.alias("pkn"))


def kn_trigram(counts: DataFrame) -> DataFrame:
    """``(word, w, pred, freq, pkn)`` for every trigram."""
    tri = counts.where(F.col("n") == 3).select("word", "w", "pred", "freq")
    bi = counts.where(F.col("n") == 2).select(F.col("word").alias("w"), F.col("freq").alias("c_ab"))
    b_kn = kn_bigram(counts).select(F.col("word").alias("bc"), F.col("pkn").alias("p_bc"))
    d = _discount(tri)
    x = attach_group_totals(tri, ["w"], {"n1_ab": F.count(F.lit(1))})
    x = x.withColumn("bc", F.regexp_extract("word", r"^[^_]+_(.*)$", 1))
    x = x.join(bi, "w", "left").join(b_kn, "bc", "left").crossJoin(F.broadcast(d.select("D")))
    p = (F.greatest(F.col("freq") - F.col("D"), F.lit(0.0)) / F.col("c_ab")
         + F.col("D") / F.col("c_ab") * F.col("n1_ab") * F.col("p_bc"))
    return x.select("word", "w", "pred", "freq", p.alias("pkn"))
