"""Katz backoff with absolute discounting.

For a history ``(a, b)`` and discounts ``g3`` (trigram) / ``g2`` (bigram):

* observed trigram ``abc``: ``(C(abc) - g3) / C(ab)``;
* ``alpha3(ab) = 1 - sum_obs (C(abc) - g3) / C(ab)`` (1 if none observed);
* ``alpha2(b)  = 1 - sum_c (C(bc) - g2) / C(b)`` (0 if b has no continuation);
* for a word c outside the observed trigram tails, the backed-off bigram
  value ``q(c)`` is ``(C(bc) - g2)/C(b)`` when ``bc`` was seen, else
  ``alpha2(b) * C(c) / sum C(c')`` over unseen tails; then
  ``P(c | ab) = alpha3(ab) * q(c) / sum q`` over all unobserved tails.

Sums over "all words that ab has not been followed by" are never spelt out:
they are b's totals minus the few words seen after ab, whose bigrams are looked
up by key.  So a history costs as many rows as it has trigrams, however many
words follow its last word.  A word of interest gets its probability by three
look-ups (:func:`absdisc_probability`); the most probable word is the best of
three candidates, one per level (:func:`absdisc_argmax`).

The counts must be consistent: a counted trigram's last two words are a counted
bigram.  That holds for token and document counts, trimmed or not, as
``C(bc) >= C(abc)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkngram.operators.ngrams import top_by_group
from sparkngram.operators.ranking import global_rank
from sparkngram.plans.joins import thin

# Rows of a last word, and most frequent words, that the arg-max looks at
# before it ranks all of them (for the histories that need more).
SHORT = 256


def _orders(counts: DataFrame):
    one = counts.where("n = 1").select(F.col("word").alias("c"), F.col("freq").alias("cu"))
    two = counts.where("n = 2").select(F.col("word").alias("bc"), F.col("w").alias("b"), F.col("pred").alias("c"), F.col("freq").alias("cb"))
    three = counts.where("n = 3").select(F.col("word").alias("hc"), F.col("w").alias("h"), F.col("pred").alias("c"), F.col("freq").alias("ct"))
    return one, two, three


def _last(h: str = "h") -> Column:
    return F.substring_index(h, "_", -1)


def for_histories(counts: DataFrame, histories: DataFrame, store=lambda d: d) -> DataFrame:
    """The counts that the distributions of ``histories`` (h) hang on: every
    word, the bigrams that start with a history's last word or are a history,
    and the histories' own trigrams.  The functions below give the same rows on
    them, and look them up several times."""
    cols = ["n", "word", "w", "pred", "freq"]
    h = store(histories.select("h").distinct())
    last = h.select(F.lit(2).alias("n"), _last().alias("w")).distinct()
    asked = h.select(F.lit(3).alias("n"), F.col("h").alias("w")).union(last)
    high = thin(counts.where("n in (2, 3)").select(*cols), ["n", "w"], asked).join(asked, ["n", "w"], "left_semi").select(*cols)
    whole = h.select(F.col("h").alias("word"))
    own = thin(counts.where("n = 2").select(*cols), ["word"], whole).join(whole, "word", "left_semi").join(last, ["n", "w"], "left_anti").select(*cols)
    return store(counts.where("n = 1").select(*cols).unionByName(high).unionByName(own))


def in_parts(histories: DataFrame, parts: int) -> list[DataFrame]:
    """``histories`` (h) by their last word's hash: a part's distributions hang
    on counts that few other parts need."""
    return [histories.where(F.pmod(F.xxhash64(_last()), F.lit(parts)) == k) for k in range(parts)]


def observed(counts: DataFrame, histories: DataFrame) -> DataFrame:
    """``(h, b, c, ct, cb)``, the words seen after each history with
    the counts of the trigram and of the bigram that ends it."""
    _, two, three = _orders(counts)
    obs = three.join(histories.select("h").distinct(), "h", "left_semi")
    bc = F.substring_index("hc", "_", -2)
    return (obs.select("h", _last().alias("b"), "c", "ct", bc.alias("bc")).join(two.select("bc", "cb"), "bc", "left")
            .select("h", "b", "c", "ct", "cb"))


def absdisc_backoff(counts: DataFrame, histories: DataFrame, g2: float = 0.5, g3: float = 0.5) -> DataFrame:
    """Per history ``(h, b, cab, cbb, n3, nb, s3, alpha3, alpha2,
    q2, pool_u, sum_q)``: words and mass seen after it (n3, s3), words seen
    after b (nb), the back-off weights, what of q is left for seen bigrams, the
    summed counts of all other words, and the sum of q."""
    one, two, _ = _orders(counts)
    h = histories.select("h").distinct().select("h", _last().alias("b"))
    last = h.select("b").distinct()
    per_b = (two.join(last, "b", "left_semi").join(one, "c", "left").groupBy("b")
             .agg(F.count(F.lit(1)).alias("nb"), F.sum("cb").alias("sb"), F.sum(F.coalesce("cu", F.lit(0))).alias("s2u")))
    per_h = observed(counts, histories).groupBy("h").agg(
        F.count(F.lit(1)).alias("n3"), F.sum("ct").alias("st"), F.count("cb").alias("nt"), F.sum("cb").alias("sbt"))
    x = (h.join(two.select(F.col("bc").alias("h"), F.col("cb").alias("cab")), "h", "left")
         .join(one.select(F.col("c").alias("b"), F.col("cu").alias("cbb")), "b", "left")
         .join(per_b, "b", "left").join(per_h, "h", "left").crossJoin(F.broadcast(one.agg(F.sum("cu").alias("U"))))
         .fillna(0, ["nb", "sb", "s2u", "n3", "st", "nt", "sbt"]))
    s3 = F.try_divide(F.col("st") - g3 * F.col("n3"), F.col("cab"))
    x = x.withColumn("s3", F.when(F.col("n3") > 0, s3).otherwise(F.lit(0.0)))
    x = x.withColumn("alpha3", F.lit(1.0) - F.col("s3"))
    x = x.withColumn("alpha2", F.when(F.col("nb") > 0, 1 - F.try_divide(F.col("sb") - g2 * F.col("nb"), F.col("cbb"))).otherwise(F.lit(0.0)))
    # whole counts are subtracted first: nothing left is exactly nothing
    x = x.withColumn("q2", F.when(F.col("nb") > F.col("nt"), F.try_divide(
        (F.col("sb") - F.col("sbt")) - g2 * (F.col("nb") - F.col("nt")), F.col("cbb"))).otherwise(F.lit(0.0)))
    x = x.withColumn("pool_u", F.col("U") - F.col("s2u"))
    rest = F.when(F.col("pool_u") > 0, F.col("alpha2")).otherwise(F.lit(0.0))
    return x.withColumn("sum_q", F.col("q2") + rest).select(
        "h", "b", "cab", "cbb", "n3", "nb", "s3", "alpha3", "alpha2", "q2", "pool_u", "sum_q")


def _bigram_probability(g2: float) -> Column:
    return F.try_divide(F.col("alpha3") * F.try_divide(F.col("cb") - g2, F.col("cbb")), F.col("sum_q"))


def _rest_probability() -> Column:
    return F.try_divide(F.col("alpha3") * F.try_divide(F.col("alpha2") * F.col("cu"), F.col("pool_u")), F.col("sum_q"))


def absdisc_probability(counts: DataFrame, requests: DataFrame, g2: float = 0.5, g3: float = 0.5,
                        backoff: DataFrame | None = None) -> DataFrame:
    """F17-F19 for the pairs in ``requests(h, word)``: ``(h, word, kind, prob)``.

    ``kind`` is the level that the probability comes from (``trigram``,
    ``bigram``, ``unigram``); a word that was never counted has a null
    probability, and so has one whose distribution is undefined (0/0).
    ``backoff``: the histories' :func:`absdisc_backoff`, if it is at hand."""
    one, two, three = _orders(counts)
    requests = requests.select("h", "word").distinct()
    scal = backoff if backoff is not None else absdisc_backoff(counts, requests, g2, g3)
    x = (requests.withColumn("hc", F.concat_ws("_", "h", "word")).withColumn("bc", F.concat_ws("_", _last(), F.col("word")))
         .join(three.select("hc", "ct"), "hc", "left").join(two.select("bc", "cb"), "bc", "left")
         .join(one.select(F.col("c").alias("word"), "cu"), "word", "left").join(scal, "h"))
    kind = F.when(F.col("ct").isNotNull(), "trigram").when(F.col("cb").isNotNull(), "bigram").when(F.col("cu").isNotNull(), "unigram")
    prob = F.when(F.col("ct").isNotNull(), F.try_divide(F.col("ct") - g3, F.col("cab"))) \
        .when(F.col("cb").isNotNull(), _bigram_probability(g2)).when(F.col("pool_u") > 0, _rest_probability())
    return x.select("h", "word", kind.alias("kind"), prob.alias("prob"))


def absdisc_masses(counts: DataFrame, histories: DataFrame, g2: float = 0.5, g3: float = 0.5) -> DataFrame:
    """``(h, kind, words, mass)``: how many words each level of a history's
    distribution names, and their probability; ``rest`` stands for all words
    seen neither after h nor after its last word."""
    x = absdisc_backoff(counts, histories, g2, g3)
    part = lambda kind, words, mass: F.struct(F.lit(kind).alias("kind"), words.cast("long").alias("words"), mass.alias("mass"))
    share = lambda q: F.try_divide(F.col("alpha3") * q, F.col("sum_q"))
    parts = F.array(part("trigram", F.col("n3"), F.col("s3")), part("bigram", F.col("nb") - F.col("n3"), share(F.col("q2"))),
                    part("rest", F.lit(0), share(F.col("alpha2"))))
    shown = (F.col("p.words") > 0) | ((F.col("p.kind") == "rest") & (F.col("pool_u") > 0))
    return x.select("h", "pool_u", F.explode(parts).alias("p")).where(shown).select("h", "p.kind", "p.words", "p.mass")


def absdisc_distribution(counts: DataFrame, histories: DataFrame, g2: float = 0.5, g3: float = 0.5) -> DataFrame:
    """The whole distributions of a few histories, spelt out: ``(h, word, prob,
    kind, pool_u)`` with a row for every word seen after h or its last word, and
    one ``rest`` row with the probability and the summed counts of all others.
    Its size is that of the answer; for many histories ask for the words or
    masses that are wanted (above)."""
    _, two, _ = _orders(counts)
    x, obs = absdisc_backoff(counts, histories, g2, g3), observed(counts, histories)
    none = F.lit(None).cast("double").alias("pool_u")
    tri = obs.join(x.select("h", "cab"), "h").select(
        "h", F.col("c").alias("word"), F.try_divide(F.col("ct") - g3, F.col("cab")).alias("prob"), F.lit("trigram").alias("kind"), none)
    bi = x.join(two.select("b", "c", "cb"), "b").join(obs.select("h", "c"), ["h", "c"], "left_anti").select(
        "h", F.col("c").alias("word"), _bigram_probability(g2).alias("prob"), F.lit("bigram").alias("kind"), none)
    rest = x.where("pool_u > 0").select(
        "h", F.lit(None).cast("string").alias("word"), F.try_divide(F.col("alpha3") * F.col("alpha2"), F.col("sum_q")).alias("prob"),
        F.lit("rest").alias("kind"), F.col("pool_u").cast("double").alias("pool_u"))
    return tri.union(bi).union(rest)


def absdisc_rest_coef(dist: DataFrame) -> DataFrame:
    """``(h, rest_coef)`` from a distribution: ``P(c | h) = rest_coef * C(c)``
    for every word c seen neither after h nor after its last word."""
    return dist.where(F.col("kind") == "rest").select("h", F.try_divide(F.col("prob"), F.col("pool_u")).alias("rest_coef"))


def _first_missing(taken: DataFrame, key: str, rank: str) -> DataFrame:
    """``(key, first)``: the least rank from 1 on that a key does not have, for
    rows (key, rank) with distinct ranks: ranks without a gap equal their place."""
    after = taken.select(key, (F.col(rank) + 1).alias(rank)).join(taken.select(key, rank), [key, rank], "left_anti")
    one = taken.groupBy(key).agg(F.min(rank).alias("_low"))
    gap = after.groupBy(key).agg(F.min(rank).alias("_gap"))
    return one.join(gap, key, "left").select(key, F.when(F.col("_low") > 1, F.lit(1)).otherwise(F.col("_gap")).alias("first"))


def absdisc_argmax(counts: DataFrame, histories: DataFrame, g2: float = 0.5, g3: float = 0.5, short: int = SHORT,
                   store=lambda d: d) -> DataFrame:
    """``(h, word, prob)``, the most probable next word (ties: word).

    The candidates of a history are its best trigram, the best continuation of
    its last word b that it has not seen itself, and the most frequent word
    that b has not seen.  Both exclusions look at the ``short`` best rows of b
    (of all words) first; only a history (a word b) that has seen all of those
    meets the full list.  ``store`` keeps tables that several plans read."""
    one, two, _ = _orders(counts)
    obs = store(observed(counts, histories))
    scal = store(absdisc_backoff(counts, histories, g2, g3))
    tri = top_by_group(obs, ["h"], [F.col("ct").desc(), F.col("c").asc()], 1).join(scal.select("h", "cab"), "h") \
        .select("h", F.col("c").alias("word"), F.try_divide(F.col("ct") - g3, F.col("cab")).alias("prob"))

    # the best continuation of b outside the words seen after h
    last = scal.select("b").distinct()
    mine = two.join(last, "b", "left_semi").select("b", "c", "cb")
    best = store(top_by_group(mine, ["b"], [F.col("cb").desc(), F.col("c").asc()], short))
    taken = store(obs.join(best.select("b", "c", "rnk"), ["b", "c"]).select("h", "rnk"))
    full = taken.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= short).select("h")
    first = scal.select("h", "b").join(full, "h", "left_anti").join(_first_missing(taken, "h", "rnk"), "h", "left") \
        .select("h", "b", F.coalesce("first", F.lit(1)).alias("rnk"))
    near = first.join(best, ["b", "rnk"]).select("h", "c", "cb")
    long = scal.join(full, "h", "left_semi").select("h", "b").join(mine, "b").join(obs.select("h", "c"), ["h", "c"], "left_anti")
    near = near.union(top_by_group(long, ["h"], [F.col("cb").desc(), F.col("c").asc()], 1).select("h", "c", "cb"))
    bi = near.join(scal, "h").select("h", F.col("c").alias("word"), _bigram_probability(g2).alias("prob"))

    # the most frequent word that b has not seen: the same for all histories that end in b
    common = one.orderBy(F.col("cu").desc(), F.col("c").asc()).limit(short)
    common = store(top_by_group(common.withColumn("g", F.lit(1)), ["g"], [F.col("cu").desc(), F.col("c").asc()], short).drop("g"))
    seen = store(mine.join(F.broadcast(common.select("c", "rnk")), "c").select("b", "rnk"))  # ``short`` rows
    all_ = seen.groupBy("b").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= short).select("b")
    first = last.join(all_, "b", "left_anti").join(_first_missing(seen, "b", "rnk"), "b", "left").select("b", F.coalesce("first", F.lit(1)).alias("rnk"))
    rest = first.join(F.broadcast(common), "rnk").select("b", "c", "cu")
    if all_.limit(1).count():
        ranked = global_rank(one, [F.col("cu").desc(), F.col("c").asc()], "rnk")
        more = store(mine.join(all_, "b", "left_semi").join(ranked, "c").select("b", "rnk"))
        rest = rest.union(_first_missing(more, "b", "rnk").withColumnRenamed("first", "rnk").join(ranked, "rnk").select("b", "c", "cu"))
    un = rest.join(scal.where("pool_u > 0"), "b").select("h", F.col("c").alias("word"), _rest_probability().alias("prob"))

    cand = tri.union(bi).union(un).where(F.col("prob").isNotNull())  # three rows per history at most
    return top_by_group(cand, ["h"], [F.col("prob").desc(), F.col("word").asc()], 1).select("h", "word", "prob")
