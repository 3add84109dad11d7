"""Tokens and document features (D1-D13): block lists, stop words, DFM
in long form, proportions, top features, UNK mapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkngram.plans.joins import checked_broadcast, materialize

# A block list above this many entries is applied with a join instead of
# an in-expression hash set.
INLINE_LIST_MAX = 50_000


def remove_listed_tokens(df: DataFrame, tokens_col: str, words: DataFrame, keys: Sequence[str],
                         word_col: str = "word", inline_max: int = INLINE_LIST_MAX) -> DataFrame:
    """Drop every token that is on a list, neighbours close up; every row
    stays, whatever its ``keys`` (rows may share them), null tokens stay.

    A bounded list (checked count) becomes a literal ``IN`` set evaluated
    inside the codegen'd projection (Catalyst turns it into a hash set).
    A longer list is applied with an anti join on exploded positions; a row
    number that is fixed first says to which row a token goes back.
    """
    words = words.select(F.col(word_col).alias("_tok")).where("_tok is not null").distinct()
    small, is_small = checked_broadcast(words, inline_max)
    if is_small:
        vals = [r[0] for r in small.collect()]  # <= inline_max short strings
        if not vals:
            return df
        return df.withColumn(tokens_col, F.filter(F.col(tokens_col), lambda x: x.isNull() | ~x.isin(vals)))
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()))
    kept = rows.select("_row", F.posexplode(tokens_col).alias("_pos", "_tok")).join(words, "_tok", "left_anti")
    back = kept.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_pos", "_tok"))).alias("_a"))
    back = rows.join(back.select("_row", F.transform("_a", lambda s: s["_tok"]).alias("_left")), "_row", "left")
    none = F.when(F.col(tokens_col).isNotNull(), F.array().cast(df.schema[tokens_col].dataType))
    return back.withColumn(tokens_col, F.coalesce("_left", none)).select(*df.columns)


def blocklist_from_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """A3: a word list file read with ``spark.read.text``: trim, drop empty,
    de-duplicate."""
    return (lines.select(F.trim(F.regexp_replace(F.col(col), "\r", "")).alias("word"))
            .where(F.col("word") != F.lit("")).distinct())


def remove_listed_features(counts: DataFrame, words: DataFrame, feature: str = "word") -> DataFrame:
    """Drop features (whole n-grams) that exactly match a list entry."""
    listed, _ = checked_broadcast(words.select(F.col("word").alias(feature)).distinct(), INLINE_LIST_MAX)
    return counts.join(listed, feature, "left_anti")


def glob_to_regex(glob: str) -> str:
    """A glob (``*`` / ``?``) as an anchored Java regex."""
    out = []
    for ch in glob:
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        else:
            out.append("\\Q" + ch + "\\E" if not ch.isalnum() else ch)
    return "^" + "".join(out) + "$"


def remove_by_globs(df: DataFrame, globs: Sequence[str], feature: str = "feature") -> DataFrame:
    """D5."""
    cond = F.lit(False)
    for g in globs:
        cond = cond | F.col(feature).rlike(glob_to_regex(g))
    return df.where(~cond)


def pad_unmatched(tokens: Column, regex: str) -> Column:
    """Keep tokens matching ``regex``; others become ``''`` (padding)."""
    return F.transform(tokens, lambda x: F.when(x.rlike(regex), x).otherwise(F.lit("")))


def word_count(c: Column) -> Column:
    """Number of words of a line."""
    return F.size(F.regexp_extract_all(c, F.lit(r"\w+"), 0))


def dfm(df: DataFrame, doc: str, tokens_col: str) -> DataFrame:
    """Long document-feature matrix ``(doc, feature, count)``."""
    return (df.select(doc, F.explode(tokens_col).alias("feature"))
            .groupBy(doc, "feature").agg(F.count(F.lit(1)).alias("count")))


def dfm_prop(d: DataFrame, doc: str) -> DataFrame:
    """Feature share within its document (per-document totals are a
    pre-aggregated join, not a window over raw rows)."""
    tot = d.groupBy(doc).agg(F.sum("count").alias("_tot"))
    return d.join(tot, doc).select(doc, "feature", "count", (F.col("count") / F.col("_tot")).alias("prop"))


def top_features(d: DataFrame, k: int) -> DataFrame:
    """The k most frequent features (distributed top-k)."""
    return (d.groupBy("feature").agg(F.sum("count").alias("freq"))
            .orderBy(F.col("freq").desc(), F.col("feature").asc()).limit(k))


def unk_map(tokens: Column, vocab_words: list[str], unk: str = "UNK") -> Column:
    """D8 for a bounded vocabulary held as an in-expression set."""
    return F.transform(tokens, lambda x: F.when(x.isin(vocab_words), x).otherwise(F.lit(unk)))


def drop_markers(c: Column, markers: Sequence[str] = ("<EOS>", "<NUM>", "NA")) -> Column:
    """D13."""
    return ~c.isin(list(markers))


# The public English stop-word list that Spark's
# StopWordsRemover ships, held here so that the plan and its SQL twin read
# the same words without any file, jar or JVM access at import time.
ENGLISH_STOP_WORDS = """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
    herself it its itself they them their theirs themselves what which who whom this that these those am is
    are was were be been being have has had having do does did doing a an the and but if or because as until
    while of at by for with about against between into through during before after above below to from up
    down in out on off over under again further then once here there when where why how all any both each
    few more most other some such no nor not only own same so than too very s t can will just don should now
    i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
    they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't
    won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
    there's what's when's where's who's why's would
""".split()


def stop_words(spark, words: Sequence[str] = ENGLISH_STOP_WORDS) -> DataFrame:
    """A stop-word list as a one-column DataFrame."""
    return spark.createDataFrame([(w,) for w in words], "word string")


def unk_tokens(df: DataFrame, keys: Sequence[str], tokens_col: str, vocab: DataFrame, unk: str = "UNK",
               word_col: str = "word") -> DataFrame:
    """D8 for a vocabulary of any size: tokens outside ``vocab`` become
    ``unk``.  Tokens are exploded with their positions, matched by an
    equi-join against the vocabulary (no list on the driver) and put back
    in order per row (a row is one line, so each group is small)."""
    keys = list(keys)
    ex = df.select(*keys, F.posexplode(tokens_col).alias("_pos", "_tok"))
    v = vocab.select(F.col(word_col).alias("_tok"), F.lit(True).alias("_known")).distinct()
    m = ex.join(v, "_tok", "left").select(
        *keys, "_pos", F.when(F.col("_known"), F.col("_tok")).otherwise(F.lit(unk)).alias("_tok"))
    back = m.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_pos", "_tok"))).alias("_a"))
    back = back.select(*keys, F.transform("_a", lambda s: s["_tok"]).alias(tokens_col))
    return df.drop(tokens_col).join(back, keys, "left").withColumn(
        tokens_col, F.coalesce(F.col(tokens_col), F.array().cast("array<string>")))


def vocabulary(tokens_df: DataFrame, tokens_col: str, min_count: int) -> DataFrame:
    """Words seen at least ``min_count`` times (partial aggregation)."""
    return (tokens_df.select(F.explode(tokens_col).alias("word")).groupBy("word")
            .agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= F.lit(min_count)).select("word"))


def select_by_glob_grouped(d: DataFrame, glob: str, group: str, feature: str = "feature") -> DataFrame:
    """Keep only features matching a glob, counts grouped by a document
    variable (``dfm(select=glob, groups=group)``)."""
    return (d.where(F.col(feature).rlike(glob_to_regex(glob)))
            .groupBy(group, feature).agg(F.sum("count").alias("count")))
