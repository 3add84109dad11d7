"""Linear interpolation and perplexity.

``p = l1 * C(abc)/C(ab) + l2 * C(bc)/C(b) + l3 * C(c)/N`` on held-out
trigrams; the weights are chosen on a grid by held-out log-likelihood.
The grid is a tiny DataFrame cross-joined with the *aggregated* test
n-grams (one row per distinct trigram with its count), so the work is
``|grid| x |distinct test trigrams|`` rows, summed per grid point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ml_components(counts: DataFrame, test: DataFrame) -> DataFrame:
    """``test(a, b, c, cnt)`` -> ``+ p3, p2, p1`` maximum-likelihood terms.
    A test trigram whose last word is out of vocabulary keeps its row, with a
    null ``p1``."""
    uni = counts.where(F.col("n") == 1).select(F.col("word").alias("c"), F.col("freq").alias("cc"))
    total = uni.agg(F.sum("cc").alias("N"))
    big = counts.where(F.col("n") == 2).select("word", "freq")
    tri = counts.where(F.col("n") == 3).select("word", "freq")
    t = test.withColumn("ab", F.concat_ws("_", "a", "b")).withColumn("bc", F.concat_ws("_", "b", "c")) \
        .withColumn("abc", F.concat_ws("_", "a", "b", "c"))
    ub = uni.select(F.col("c").alias("b"), F.col("cc").alias("cb_"))
    t = (t.join(uni, "c", "left")
         .join(ub, "b", "left")
         .join(big.select(F.col("word").alias("ab"), F.col("freq").alias("cab")), "ab", "left")
         .join(big.select(F.col("word").alias("bc"), F.col("freq").alias("cbc")), "bc", "left")
         .join(tri.select(F.col("word").alias("abc"), F.col("freq").alias("cabc")), "abc", "left")
         .crossJoin(F.broadcast(total)))
    z = F.lit(0.0)
    return t.select("a", "b", "c", "cnt",
                    F.coalesce(F.try_divide(F.col("cabc"), F.col("cab")), z).alias("p3"),
                    F.coalesce(F.try_divide(F.col("cbc"), F.col("cb_")), z).alias("p2"),
                    (F.col("cc") / F.col("N")).alias("p1"))


def lambda_grid(spark, step: int = 10) -> DataFrame:
    """All (l1, l2, l3) in tenths with l3 >= 1/step (so p > 0 in vocabulary)."""
    rows = [(i / step, j / step, (step - i - j) / step)
            for i in range(step + 1) for j in range(step + 1 - i) if step - i - j >= 1]
    return spark.createDataFrame(rows, "l1 double, l2 double, l3 double")


def interpolate(comp: DataFrame, grid: DataFrame) -> DataFrame:
    """Per grid point: log-likelihood, predictions and perplexity over targets
    of the vocabulary, and ``oov``, the number of predictions outside it."""
    p = F.col("l1") * F.col("p3") + F.col("l2") * F.col("p2") + F.col("l3") * F.col("p1")
    x = comp.crossJoin(F.broadcast(grid)).select("l1", "l2", "l3", "cnt", F.col("p1").isNotNull().alias("known"), (F.col("cnt") * F.log(p)).alias("ll"))
    g = x.groupBy("l1", "l2", "l3").agg(F.sum("ll").alias("loglik"), F.sum(F.when(F.col("known"), F.col("cnt")).otherwise(0)).alias("n"),
                                         F.sum(F.when(~F.col("known"), F.col("cnt")).otherwise(0)).alias("oov"))
    return g.withColumn("perplexity", F.exp(F.try_divide(-F.col("loglik"), F.col("n"))))


def best_lambda(scored: DataFrame) -> DataFrame:
    """The grid point with the highest log-likelihood (ties: larger l1, l2)."""
    return scored.orderBy(F.col("loglik").desc(), F.col("l1").desc(), F.col("l2").desc()).limit(1)


def perplexity(probs: DataFrame, p: str = "p", cnt: str = "cnt") -> DataFrame:
    """``exp(-sum(cnt * log p) / sum(cnt))`` over rows with p > 0;
    rows with p = 0 are counted separately (perplexity is infinite for them)."""
    return probs.agg(
        F.exp(-F.sum(F.when(F.col(p) > 0, F.col(cnt) * F.log(p))) / F.sum(F.when(F.col(p) > 0, F.col(cnt))))
        .alias("perplexity"),
        F.sum(F.when(~(F.col(p) > 0), F.col(cnt)).otherwise(F.lit(0))).alias("zero_prob"))
