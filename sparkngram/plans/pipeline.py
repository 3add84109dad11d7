"""End-to-end training / prediction plans built from the operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkngram.functions import clean as C
from sparkngram.operators import evaluate as E
from sparkngram.operators import ngrams as NG
from sparkngram.operators import predict as P
from sparkngram.operators import sbo as S
from sparkngram.plans.joins import dropped, kept, materialize
from sparkngram.sources import corpus
from sparkngram.sources import store as ST


def train_tokens(spark: SparkSession, sf_dir: str, lang: str | None = "en") -> DataFrame:
    """lines -> C16 -> D1: ``(source, doc_id, line_no, tokens)``."""
    lines = corpus.training_lines(spark, sf_dir, lang)
    return lines.select("source", "doc_id", "line_no", C.tokens(C.clean_train(F.col("line"))).alias("tokens"))


# Sets of orders that one counting pass makes; where orders beyond them are asked for, one
# pass makes all that are, and of the counts those that the trim leaves are kept.
STAGED_ORDERS = ((1, 2, 3), (1, 2, 3, 4))


# Bytes of documents' files whose windows one task counts without spilling.
BYTES_PER_TASK = 16 << 20


def count_partitions(spark: SparkSession, inputs: list[str], passes: int = 1) -> int | None:
    """Tasks of the counting step, or of one of its passes, by the size of its
    input, if that is more than the session has; else None."""
    want = -(-ST.input_bytes(spark, inputs) // (BYTES_PER_TASK * passes))
    return want if want > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


# Passes over the tokens in which whole counts are made: each shuffles its part of the windows.
PASSES = 4


def counted_in_passes(spark: SparkSession, sf_dir: str, orders, lang: str | None, passes: int = PASSES) -> Iterator[DataFrame]:
    """The counts of all n-grams in ``passes`` parts, one after the other, from
    tokens that are cleaned and written once, so that only one part's windows
    are on disk at a time."""
    tokens = materialize(train_tokens(spark, sf_dir, lang).select("tokens"))
    here = count_partitions(spark, [f"{sf_dir}/documents.parquet"], passes)
    for k in range(passes):
        yield NG.count_windows(tokens, "tokens", orders, partitions=here, part=(k, passes))
    dropped(tokens)


def ngram_counts(spark: SparkSession, sf_dir: str, orders=(1, 2, 3, 4), trim: int = 1, lang: str | None = "en") -> DataFrame:
    """``(n, word, w, pred, freq)`` from the staged count table (A6), which is
    partitioned by order: documents are read by the first query only.  The
    smallest set that holds the orders is made unless a larger one is there;
    with a trim and no whole table there, only what the trim leaves is."""
    inputs, sets = [f"{sf_dir}/documents.parquet"], STAGED_ORDERS
    whole = lambda made: {"orders": made, "lang": lang, "columns": "word, freq"}
    fit = [made for made in sets if set(orders) <= set(made)]
    made = next((made for made in fit if ST.staged(spark, "ngram-counts", inputs, whole(made), ["n"])), None)
    if made is not None:
        least, key = 1, whole(made)
    else:  # what a trim drops is neither sorted nor written
        made, least = (*fit, tuple(sorted(orders)))[0], trim
        key = whole(made) | ({"trim": trim} if trim > 1 or not fit else {})
    # sorted, neighbours share their first words and take little room; prefix and prediction are cut from the word when it is read
    t = ST.stage(spark, "ngram-counts", inputs, key, lambda: counted_in_passes(spark, sf_dir, made, lang) if least == 1 else NG.count_windows(
        train_tokens(spark, sf_dir, lang), "tokens", made, min_freq=least, partitions=count_partitions(spark, inputs)), partition_by=["n"])
    t = t.where(F.col("n").isin(list(orders)) & (F.col("freq") >= F.lit(trim)))
    return NG.split_prefix(t).select("n", "word", "w", "pred", "freq")


def sbo_lookup(spark: SparkSession, sf_dir: str, max_order: int = 4, trim: int = 5, k: int = 5) -> DataFrame:
    """The stupid-backoff lookup table ``(n, w, pred, score, rnk)``."""
    return S.sbo_model(ngram_counts(spark, sf_dir, tuple(range(1, max_order + 1)), trim), max_order, k)


def heldout_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.split_sentence(corpus.heldout_clean(spark, sf_dir), ["dataset", "src_id", "line_no"])


def evaluate_sbo(spark: SparkSession, sf_dir: str, m: int = 3, max_order: int = 4, trim: int = 5,
                 model: DataFrame | None = None) -> DataFrame:
    """H1-H3 for the benchmark stupid-backoff predictor."""
    model = model if model is not None else sbo_lookup(spark, sf_dir, max_order, trim)
    lines = corpus.heldout_clean(spark, sf_dir)
    cp = E.line_contexts(lines, m)

    def predictor(ctx: DataFrame) -> DataFrame:
        return P.predict_sbo(ctx, model, ["ctx"], "words", m=m, empty=F.col("empty"))

    return E.dataset_report(E.rank_pairs(cp, predictor), lines)


def katz_inputs(spark: SparkSession, sf_dir: str, mat: bool = False):
    """Untrimmed counts of orders 1..3 and their Good-Turing table."""
    from sparkngram.operators.goodturing import gt_table
    counts = ngram_counts(spark, sf_dir, (1, 2, 3), 1)
    if mat:
        return counts, materialize(gt_table(counts, (1, 2, 3)))
    return counts, gt_table(counts, (1, 2, 3))


def katz_model(spark: SparkSession, sf_dir: str, k: int = 3, contexts: DataFrame | None = None):
    """The trigram model for the histories of ``contexts`` (ctx), or for all."""
    from sparkngram.operators.katz import KatzModel
    counts, gt = katz_inputs(spark, sf_dir, mat=True)
    asked = None
    if contexts is not None:
        words = contexts.select(F.filter(F.split("ctx", " "), lambda x: x != F.lit("")).alias("words"))
        asked = P.asked_histories(words, "words", 3)
    return KatzModel(counts, gt, k, materialize=materialize, histories=asked)


def katz_context_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out pairs as the Katz predictor sees them: C17 on the prefix,
    then the last two words."""
    return E.line_contexts(corpus.heldout_clean(spark, sf_dir), 3, words_fn=C.clean_query_words)


def evaluate_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkngram.operators.katz import predict_katz
    lines = corpus.heldout_clean(spark, sf_dir)
    cp = materialize(katz_context_pairs(spark, sf_dir))
    model = katz_model(spark, sf_dir, contexts=cp)

    def predictor(ctx: DataFrame) -> DataFrame:
        return predict_katz(materialize(ctx), model, ["ctx"], "words", empty=F.col("empty"))

    return E.dataset_report(E.rank_pairs(cp, predictor), lines)


def train_dfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long document-feature matrix ``(doc_id, source, feature, count)``."""
    t = train_tokens(spark, sf_dir)
    return (t.select("doc_id", "source", F.explode("tokens").alias("feature"))
            .groupBy("doc_id", "source", "feature").agg(F.count(F.lit(1)).alias("count")))


def doc_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, feature, count)``, rows of one doc_id together, as a table;
    the shuffle of each of its two steps goes before the next one."""
    dfm = kept(train_dfm(spark, sf_dir))
    out = kept(dfm.groupBy("doc_id", "feature").agg(F.sum("count").alias("count")))
    dropped(dfm)
    return out


def evaluate_katz_bench(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3 for the evaluation harness's own Katz predictor: prefixes split on
    blanks as they are (no query cleaning), evaluation default words."""
    from sparkngram.operators.katz import predict_katz
    lines = corpus.heldout_clean(spark, sf_dir)
    cp = materialize(E.line_contexts(lines, 3))
    model = katz_model(spark, sf_dir, contexts=cp)

    def predictor(ctx: DataFrame) -> DataFrame:
        return predict_katz(materialize(ctx), model, ["ctx"], "words", defaults=P.EVAL_DEFAULTS,
                            empty=F.col("empty"))

    return E.dataset_report(E.rank_pairs(cp, predictor), lines)


def katz_chain(spark: SparkSession, sf_dir: str, order: int = 4, k: int = 5, histories: DataFrame | None = None):
    """G12's model from the staged counts of orders 1 to ``order``, for
    ``histories`` or all."""
    from sparkngram.operators.goodturing import gt_table
    from sparkngram.operators.katz_chain import KatzChain
    counts = ngram_counts(spark, sf_dir, tuple(range(1, order + 1)), 1)
    return KatzChain(counts, materialize(gt_table(counts, range(2, order + 1))), order, k, materialize, histories=histories)


def sweep(spark: SparkSession, sf_dir: str, orders=(3, 4), fractions=(0.15, 0.25), trims=(2, 5), models=("sbo", "katz")) -> DataFrame:
    """H7: one counting pass (staged) for all fractions, one evaluation for all configurations."""
    from sparkngram.operators import sweep as SW
    made = tuple(range(1, max(orders) + 1))
    nested = ST.stage(spark, "nested-counts", [f"{sf_dir}/documents.parquet"], {"orders": made, "fractions": list(fractions), "columns": "word, f"},
                      lambda: SW.nested_counts(train_tokens(spark, sf_dir), made, fractions).drop("w", "pred").sortWithinPartitions("n", "word"), partition_by=["n"])
    nested = NG.split_prefix(nested)
    return SW.sweep(nested, corpus.heldout_clean(spark, sf_dir), orders, fractions, trims, models, store=kept)
