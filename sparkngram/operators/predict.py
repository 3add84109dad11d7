"""Batch next-word prediction.

The reference answers one phrase per call with a loop of point lookups.
Here every phrase of a DataFrame is answered in one job:

1. explode each phrase into its suffixes (one row per backoff level),
2. one equi-join of all suffixes with the lookup table on ``(n, w)``,
3. keep-first de-duplication and top-k per phrase with ranking windows
   (partitioned by the phrase key, a handful of rows each).

Levels are ordered highest order first, then by the table's rank, which
is exactly the sequence in which the looping reference appends words.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkngram.operators.ngrams import SEP, top_by_group
from pyspark.sql.window import Window
from sparkngram.plans.joins import checked_broadcast, lookup_join, thin

# Fixed values that must equal the reference's: default words and the
# message for a phrase without a hit.
EVAL_DEFAULTS = ("the", "on", "a")   # evaluation harness / constant baseline
APP_DEFAULTS = ("the", "to", "and")  # interactive app
NO_MATCH = "Sorry! Cannot Find it!"
# Rows of a word list that may be broadcast.
LIST_ROWS = 50_000


def last_words(words: Column, n: int, sep: str = " ") -> Column:
    """G1: the last ``n`` words joined (fewer when the phrase is shorter)."""
    k = F.least(F.size(words), F.lit(n))
    return F.when(k > 0, F.array_join(F.slice(words, -k, k), sep)).otherwise(F.lit(""))


def suffix_levels(q: DataFrame, keys: Sequence[str], words: str, m: int, sep: str = SEP) -> DataFrame:
    """One row per backoff level i = min(len, m-1) .. 1: ``keys, level, n, w``."""
    top = F.least(F.size(words), F.lit(m - 1))
    lv = F.when(top >= 1, F.sequence(F.lit(1), F.greatest(top, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    x = q.select(*keys, words, F.explode(lv).alias("level"))
    return x.select(*keys, "level", (F.col("level") + 1).alias("n"),
                    F.array_join(F.slice(F.col(words), -F.col("level"), F.col("level")), sep).alias("w"))


def _defaults_rows(q: DataFrame, keys: Sequence[str], defaults: Sequence[str]) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(i + 1).alias("rnk"), F.lit(d).alias("pred")) for i, d in enumerate(defaults)])
    return q.select(*keys, F.explode(arr).alias("d")).select(
        *keys, F.lit(0).alias("level"), F.col("d.rnk").alias("rnk"), F.col("d.pred").alias("pred"),
        F.lit(None).cast("double").alias("score"))


def asked_histories(q: DataFrame, words: str, m: int, by: Sequence[str] = ()) -> DataFrame:
    """``(by, n, w)``: every history that the phrases of ``q`` back off through,
    once; with a history its shorter ones are there too."""
    return suffix_levels(q, list(by), words, m).select(*by, "n", "w").distinct()


def _rank_keep_first(cand: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """Keep the first occurrence of every word (highest level, best rank),
    then the first ``k`` words per phrase.  A phrase's few rows are brought
    together once, which serves both steps."""
    first = cand.repartition(*keys).groupBy(*keys, "pred").agg(
        F.min(F.struct((-F.col("level")).alias("nl"), F.col("rnk").alias("r"), F.col("score").alias("s")))
        .alias("b"))
    first = first.select(*keys, F.col("pred").alias("word"), (-F.col("b.nl")).alias("level"),
                         F.col("b.r").alias("lrnk"), F.col("b.s").alias("score"))
    return top_by_group(first, keys, [F.col("level").desc(), F.col("lrnk").asc()], k).drop("lrnk")


def predict_sbo(q: DataFrame, model: DataFrame, keys: Sequence[str], words: str = "words", m: int = 3,
                k: int = 3, per_level: int = 3, fill: str = "defaults",
                defaults: Sequence[str] = EVAL_DEFAULTS, first_hit_only: bool = False,
                empty: Column | None = None, message: str | None = None) -> DataFrame:
    """Stupid-backoff prediction for every row of ``q``.

    * G2 ``fill='defaults'``: suffix levels, then pad with ``defaults``;
    * G3 ``fill='unigram'``: the model's top unigrams as the last level;
    * G4 ``first_hit_only``: stop at the highest level with any hit;
    * G6/G7 ``k=5, per_level=5, fill='none'``; with ``message`` a phrase
      without a hit keeps one row, rank 0, whose word is the message.

    ``empty`` (a boolean column of ``q``) marks phrases answered with the
    default words alone (the reference's ``raw == ""`` branch).
    Returns ``keys, rnk, word, score, level``.
    """
    keys = list(keys)
    q = q.select(*keys, words, (empty if empty is not None else F.lit(False)).alias("_empty"))
    lv = suffix_levels(q.where(~F.col("_empty")), keys, words, m)
    mdl = model.where((F.col("n") >= 2) & (F.col("rnk") <= F.lit(per_level))).select("n", "w", "pred", "score", "rnk")
    cand = lookup_join(lv, mdl, ["n", "w"], "inner").select(*keys, "level", "rnk", "pred", "score")
    if first_hit_only:
        best = cand.groupBy(*keys).agg(F.max("level").alias("_best"))
        cand = cand.join(best, keys).where(F.col("level") == F.col("_best")).drop("_best")
        hits = cand.select(*keys).distinct()
        none = q.where(~F.col("_empty")).join(hits, keys, "left_anti")
        cand = cand.unionByName(_defaults_rows(none, keys, defaults))
    else:
        if fill == "unigram":
            uni = F.broadcast(model.where((F.col("n") == 1) & (F.col("rnk") <= F.lit(per_level)))
                              .select("rnk", "pred", "score"))  # <= per_level rows
            cand = cand.unionByName(q.where(~F.col("_empty")).select(*keys).crossJoin(uni)
                                    .select(*keys, F.lit(0).alias("level"), "rnk", "pred", "score"))
        elif fill == "defaults":
            cand = cand.unionByName(_defaults_rows(q.where(~F.col("_empty")), keys, defaults))
    cand = cand.unionByName(_defaults_rows(q.where(F.col("_empty")), keys, defaults))
    found = _rank_keep_first(cand, keys, k)
    if message is None:
        return found
    none = q.select(*keys).join(found.select(*keys).distinct(), keys, "left_anti")
    return found.unionByName(none.select(*keys, F.lit(message).alias("word"), F.lit(None).cast("int").alias("level"),
                                         F.lit(None).cast("double").alias("score"), F.lit(0).alias("rnk")))


def first_hit_counts(q: DataFrame, counts: DataFrame, keys: Sequence[str], words: str = "words", max_history: int = 3, k: int = 5,
                     message: str = NO_MATCH) -> DataFrame:
    """The ``k`` most frequent continuations of the longest history (up to
    ``max_history`` words) that has any, with their counts; a phrase without
    one gets ``message`` at rank 0.  Returns ``keys, rnk, word, freq``."""
    keys = list(keys)
    lv = suffix_levels(q, keys, words, max_history + 1)
    top = top_by_group(counts.where("n >= 2").select("n", "w", "pred", "freq"), ["n", "w"], [F.col("freq").desc(), F.col("pred").asc()], k)
    hit = lv.join(top, ["n", "w"])
    # k rows per phrase and level: the longest level's are gathered as one struct
    best = hit.groupBy(*keys, "level").agg(F.collect_list(F.struct("rnk", "pred", "freq")).alias("rows")) \
        .groupBy(*keys).agg(F.max_by("rows", "level").alias("rows"))
    found = best.select(*keys, F.explode("rows").alias("x")).select(*keys, F.col("x.rnk").alias("rnk"), F.col("x.pred").alias("word"), F.col("x.freq").alias("freq"))
    none = q.select(*keys).join(best.select(*keys), keys, "left_anti")
    return found.unionByName(none.select(*keys, F.lit(0).alias("rnk"), F.lit(message).alias("word"), F.lit(None).cast("long").alias("freq")))


def suggest_by_prefix(q: DataFrame, counts: DataFrame, stop: DataFrame, keys: Sequence[str], words: str = "words", top_order: int = 5,
                      k: int = 3) -> DataFrame:
    """The first ``k`` words that n-grams starting with the phrase's last
    words end in, orders ``top_order`` to 2, each order's n-grams by frequency
    (ties: name), then the first ``k`` unigrams; stop words (``stop``, column
    word) and repeats are left out, so a phrase may get fewer than k words.

    An n-gram starts with n - 1 given words and a separator exactly if these are
    its prefix column, so the look-up is a join by key; what is dropped goes
    before the cut to k rows per prefix.  Returns ``keys, rnk, word, level``."""
    keys = list(keys)
    small, _ = checked_broadcast(stop.select(F.col("word").alias("pred")).distinct(), LIST_ROWS)
    order = [F.col("freq").desc(), F.col("pred").asc()]
    q = q.select(*keys, F.transform(words, F.lower).alias(words))
    high = counts.where((F.col("n") >= 2) & (F.col("n") <= top_order)).select("n", "w", "pred", "freq").join(small, "pred", "left_anti")
    top = top_by_group(high.join(asked_histories(q, words, top_order), ["n", "w"], "left_semi"), ["n", "w"], order, k)
    uni = counts.where("n = 1").select(F.col("word").alias("pred"), "freq").orderBy(*order).limit(k)
    uni = top_by_group(uni.withColumn("g", F.lit(0)), ["g"], order, k).join(small, "pred", "left_anti")  # k rows
    cand = suffix_levels(q, keys, words, top_order).join(top, ["n", "w"]).select(*keys, "level", "rnk", "pred")
    cand = cand.unionByName(q.select(*keys).crossJoin(F.broadcast(uni.select("rnk", "pred"))).select(*keys, F.lit(0).alias("level"), "rnk", "pred"))
    return _rank_keep_first(cand.withColumn("score", F.lit(None).cast("double")), keys, k).drop("score")


def baseline(q: DataFrame, keys: Sequence[str], defaults: Sequence[str] = EVAL_DEFAULTS) -> DataFrame:
    """The constant predictor."""
    d = _defaults_rows(q.select(*keys), keys, defaults)
    return d.select(*keys, "rnk", F.col("pred").alias("word"), "score", "level")


def score_options(q: DataFrame, scores: DataFrame, keys: Sequence[str], words: str = "words",
                  option: str = "option", max_order: int = 4, sep: str = SEP, rank: bool = False) -> DataFrame:
    """Score candidate words of a phrase by backoff - the score of the
    highest-order n-gram (history suffix + option) present in the score
    table ``(n, word, score)``.  ``q`` has one row per (phrase, option);
    options never seen get a null score.  Returns ``keys, option, n,
    score`` (+ ``opt_rank`` by score then word when ``rank``).
    """
    keys = list(keys)
    h = F.sequence(F.lit(0), F.least(F.size(words), F.lit(max_order - 1)))
    x = q.select(*keys, words, option, F.explode(h).alias("h"))
    hist = F.slice(F.col(words), -F.greatest(F.col("h"), F.lit(1)), F.greatest(F.col("h"), F.lit(1)))
    full = F.when(F.col("h") == 0, F.col(option)).otherwise(F.array_join(F.concat(hist, F.array(F.col(option))), sep))
    x = x.select(*keys, option, (F.col("h") + 1).alias("n"), full.alias("word"))
    found = x.join(scores.select("n", "word", "score", F.col("n").alias("hit")), ["n", "word"], "left")
    # every option has a row of order 1, which keeps it where nothing is found
    out = found.where(F.col("hit").isNotNull() | (F.col("n") == 1)).groupBy(*keys, option).agg(
        F.max("hit").alias("n"), F.max_by("score", "hit").alias("score"))
    if rank:
        out = out.withColumn("opt_rank", F.row_number().over(
            Window.partitionBy(*keys).orderBy(F.col("score").desc_nulls_last(), F.col(option).asc())))
    return out


def freq_clusters(q: DataFrame, counts: DataFrame, gt: DataFrame, keys: Sequence[str], words: str = "words",
                  cluster: int = 7, store: Callable[[DataFrame], DataFrame] = lambda d: d, parts: int = 1) -> DataFrame:
    """G16 + G17: 4-gram predictor by frequency clusters.

    The longest history with 4-gram evidence is used: the last three words
    as a 4-gram prefix, else the last two as words 2-3 of a 4-gram, else
    the last word as word 3.  4-gram counts are summed per next word,
    rows down to the ``cluster``-th distinct frequency are kept, counts
    <= 5 are replaced by the Good-Turing r* of the matching order (one
    history word -> bigram, two -> trigram, three -> 4-gram), and
    ``probability = count / total * 100`` with the total of the raw counts.

    The levels are looked up one after the other, each for the phrases that no
    longer history answers, and a level's histories in ``parts`` by their hash.
    ``store`` keeps a table: with one, only one part's rows are shuffled at a time.
    """
    keys = list(keys)
    sz = F.size(words)
    four = counts.where(F.col("n") == 4).select(F.substring_index("word", "_", 3).alias("h"), "pred", "freq")
    left, out = store(q.select(*keys, words)), None
    for lvl in (3, 2, 1):
        need = store(left.where(sz >= lvl).select(*keys, F.array_join(F.slice(F.col(words), -lvl, lvl), "_").alias("h")))
        asked, tab = store(need.select("h").distinct()), None
        for k in range(parts):
            mine = lambda t: t.where(F.pmod(F.xxhash64("h"), F.lit(parts)) == k) if parts > 1 else t  # noqa: E731, B023
            rows = thin(mine(four.withColumn("h", F.substring_index("h", "_", -lvl))), ["h"], asked).join(mine(asked), "h", "left_semi")
            rows = rows.groupBy("h", "pred").agg(F.sum("freq").alias("freq"))
            # rank and total hang on the history alone: the table is cut before any phrase meets it
            own = Window.partitionBy("h")
            ranked = rows.withColumn("total", F.sum("freq").over(own)).withColumn("crank", F.dense_rank().over(own.orderBy(F.col("freq").desc())))
            ranked = store(ranked.where(F.col("crank") <= F.lit(cluster)).select(F.lit(lvl).alias("lvl"), "h", "pred", "freq", "total", "crank"))
            tab = ranked if tab is None else tab.unionByName(ranked)
        found = need.join(tab, "h")
        out = found if out is None else out.unionByName(found)
        if lvl > 1:
            answered = need.join(tab.select("h").distinct(), "h", "left_semi")
            left = store(left.join(answered.select(*keys), keys, "left_anti"))
    rs = gt.where((F.col("r") >= 1) & (F.col("r") <= 5)).select((F.col("n") - 1).alias("lvl"), F.col("r").alias("freq"), "r_star")
    rows = out.join(F.broadcast(rs), ["lvl", "freq"], "left")  # <= 15 rows
    adj = F.when(F.col("freq") <= 5, F.col("r_star")).otherwise(F.col("freq").cast("double"))
    return rows.select(*keys, "lvl", F.col("pred").alias("word"), "freq", adj.alias("count"),
                       (adj / F.col("total") * 100).alias("probability"), "crank")
