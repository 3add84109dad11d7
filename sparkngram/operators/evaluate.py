"""Evaluation of a predictor on held-out lines (H1-H8).

The reference calls the predictor once per (prefix, next word) pair.
Here the pairs are first reduced to their distinct *contexts* (the last
m-1 words, which is all a backoff predictor looks at), the predictor runs
once per distinct context, and the pair counts are joined back on
``(context, next word)`` - a key with at most one prediction row, so a
hot context cannot skew the join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkngram.operators.predict import last_words


def split_sentence(lines: DataFrame, keys: list[str], line: str = "line") -> DataFrame:
    """H1: every (prefix, next word) pair of a cleaned line.

    A line of k words gives k-1 pairs; the prefix of word i is the first
    i-1 words each followed by one blank (``""`` for the first word).
    The last word is never a target, as in the reference.
    """
    words = F.filter(F.split(F.col(line), " "), lambda x: x != F.lit(""))
    x = lines.select(*keys, words.alias("_w"))
    x = x.select(*keys, "_w", F.posexplode("_w").alias("pos", "next_word")).where(
        F.col("pos") < F.size("_w") - 1)
    prefix = F.when(F.col("pos") > 0, F.concat(F.array_join(F.slice("_w", F.lit(1), F.col("pos")), " "), F.lit(" "))) \
        .otherwise(F.lit(""))
    return x.select(*keys, "pos", prefix.alias("prefix"), F.lower("next_word").alias("next_word"),
                    F.slice("_w", F.lit(1), F.col("pos")).alias("prefix_words"))


def context_pairs(pairs: DataFrame, m: int, group: str = "dataset", words: Column | None = None) -> DataFrame:
    """Reduce pairs to ``(group, ctx, next_word, cnt)`` - partial aggregation
    before the shuffle, so frequent pairs cost one row per map task.

    ``words`` is the predictor's view of the prefix (default: the prefix
    words as split); ``ctx`` keeps its last m-1 words."""
    w = words if words is not None else F.col("prefix_words")
    return (pairs.select(group, last_words(w, m - 1).alias("ctx"), "next_word")
            .groupBy(group, "ctx", "next_word").agg(F.count(F.lit(1)).alias("cnt")))


def rank_pairs(ctx_pairs: DataFrame, predictor: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """H2 on grouped pairs: ``rank`` = position of the true word in the
    predictor's top 3, 4 when absent.

    ``predictor`` maps a DataFrame ``(ctx, words array, empty bool)`` to
    ``(ctx, rnk, word, ...)``.
    """
    ctx = ctx_pairs.select("ctx").distinct()
    ctx = ctx.select("ctx", F.filter(F.split("ctx", " "), lambda x: x != F.lit("")).alias("words"),
                     (F.col("ctx") == F.lit("")).alias("empty"))
    pred = predictor(ctx).where(F.col("rnk") <= 3).select("ctx", F.col("word").alias("next_word"), "rnk")
    j = ctx_pairs.join(pred, ["ctx", "next_word"], "left")
    return j.withColumn("rank", F.coalesce(F.col("rnk"), F.lit(4)).cast("long")).drop("rnk")


def dataset_report(ranked: DataFrame, lines: DataFrame, group: str = "dataset") -> DataFrame:
    """H3: one row per dataset (runtime is measured by the caller)."""
    r = ranked.groupBy(group).agg(
        F.sum(F.col("cnt") * (F.lit(4) - F.col("rank"))).alias("score"),
        (F.sum("cnt") * F.lit(3)).alias("max_score"),
        F.sum(F.when(F.col("rank") < 4, F.col("cnt")).otherwise(F.lit(0))).alias("hit_count_top3"),
        F.sum(F.when(F.col("rank") == 1, F.col("cnt")).otherwise(F.lit(0))).alias("hit_count_top1"),
        F.sum("cnt").alias("total_count"))
    words = F.size(F.filter(F.split(F.col("line"), " "), lambda x: x != F.lit("")))
    ln = lines.groupBy(group).agg(F.count(F.lit(1)).alias("line_count"),
                                  F.sum(words).cast("long").alias("word_count"))
    return ln.join(r, group, "left").select(
        F.col(group).alias("list_name"), "line_count", "word_count",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
          for c in ("score", "max_score", "hit_count_top3", "hit_count_top1", "total_count")])


def hashed_report(report: DataFrame, raw_lines: DataFrame, group: str = "dataset") -> DataFrame:
    """H3 with its hash: each set's report and the fingerprint of the raw lines
    that it was made from, so that two reports are known to be about one set."""
    from sparkngram.sources.corpus import line_set_fingerprint
    return report.join(line_set_fingerprint(raw_lines, group).select(F.col(group).alias("list_name"), "hash"), "list_name", "left")


def overall(report: DataFrame) -> DataFrame:
    """H4 + H8: unweighted means over datasets, in percent."""
    return report.agg(
        F.round(F.lit(100.0) * F.avg(F.col("score") / F.col("max_score")), 6).alias("overall_score_percent"),
        F.round(F.lit(100.0) * F.avg(F.col("hit_count_top3") / F.col("total_count")), 6).alias("precision_top3"),
        F.round(F.lit(100.0) * F.avg(F.col("hit_count_top1") / F.col("total_count")), 6).alias("precision_top1"),
        F.round(F.lit(100.0) * (F.lit(1.0) - F.avg(F.col("hit_count_top1") / F.col("total_count"))), 6)
        .alias("word_error_rate"),
        F.sum("total_count").alias("number_of_predictions"))


def line_contexts(lines: DataFrame, m: int, group: str = "dataset", line: str = "line",
                  words_fn=None) -> DataFrame:
    """H1 + context reduction in one linear pass: ``(group, ctx, next_word, cnt)``.

    For the pair at 0-based position p of a line with words w, the context
    is the last ``m-1`` of the first p words - read directly with one
    ``slice`` per pair (O(m) work, no prefix string is built, so long lines
    are not quadratic).  ``words_fn`` maps the word array to the
    predictor's view of each word (``''`` = word dropped); the context
    then keeps the last m-1 non-empty views before p.
    """
    w = F.filter(F.split(F.col(line), " "), lambda x: x != F.lit(""))
    x = lines.select(group, w.alias("_w"))
    k = m - 1
    if words_fn is None:
        pairs = F.transform(F.sequence(F.lit(0), F.size("_w") - 2), lambda p: F.struct(
            F.array_join(F.slice(F.col("_w"), F.greatest(p - F.lit(k) + 1, F.lit(1)), F.least(p, F.lit(k))), " ").alias("ctx"),
            F.lower(F.element_at(F.col("_w"), p + 1)).alias("next_word")))
        x = x.where(F.size("_w") >= 2).select(group, F.explode(pairs).alias("pr"))
    else:
        x = x.select(group, "_w", words_fn(F.col("_w")).alias("_v"))
        nz = F.filter(F.transform(F.col("_v"), lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda s: s["v"] != F.lit(""))
        x = x.where(F.size("_w") >= 2).select(group, "_w", nz.alias("_nz"))
        last = F.size("_w") - 2

        def run_after(j):
            """The pairs whose prefix holds the first ``j`` views: one context,
            from behind the j-th view to the next one."""
            tail = F.slice(F.col("_nz"), F.greatest(j - F.lit(k) + 1, F.lit(1)), F.least(j, F.lit(k)))
            ctx = F.array_join(F.transform(tail, lambda s: s["v"]), " ")
            lo = F.when(j > 0, F.get(F.col("_nz"), j - 1)["i"] + 1).otherwise(F.lit(0))
            hi = F.least(F.when(j < F.size("_nz"), F.get(F.col("_nz"), j)["i"]).otherwise(last), last)
            at = F.when(lo <= hi, F.sequence(lo, F.greatest(lo, hi))).otherwise(F.array().cast("array<int>"))
            return F.transform(at, lambda p: F.struct(ctx.alias("ctx"), F.lower(F.element_at(F.col("_w"), p + 1)).alias("next_word")))

        pairs = F.flatten(F.transform(F.sequence(F.lit(0), F.size("_nz")), run_after))
        x = x.select(group, F.explode(pairs).alias("pr"))
    return (x.select(group, F.col("pr.ctx").alias("ctx"), F.col("pr.next_word").alias("next_word"))
            .groupBy(group, "ctx", "next_word").agg(F.count(F.lit(1)).alias("cnt")))
