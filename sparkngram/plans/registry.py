"""Registered queries: ``name -> (spark plan builder, DuckDB SQL)``.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver tables; each SQL string computes the same rows from the same
tables.  Doubles are rounded to 9 digits on both sides so value hashes
agree across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkngram.functions import clean as C
from sparkngram.functions import sqltwin as T
from sparkngram.operators import evaluate as E
from sparkngram.operators import ngrams as NG
from sparkngram.operators import predict as P
from sparkngram.operators import sbo as S
from sparkngram.plans import oracle as O
from sparkngram.plans import pipeline as PL
from sparkngram.sources import corpus

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
SQL: dict[str, str] = {}

DIGITS = 9


def query(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def r9(c):
    return F.round(c, DIGITS)


# ---------------------------------------------------------------- cleaning

_NUMBERED_LINES = ("nl AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, "
                   "unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents WHERE lang = 'en')")


@query("clean_train", O.ctes(_NUMBERED_LINES) +
       f" SELECT doc_id, line_no, {T.clean_train('line')} AS clean FROM nl")
def q_clean_train(spark, sf):
    lines = corpus.training_lines(spark, sf)
    return lines.select("doc_id", F.col("line_no").cast("long").alias("line_no"),
                        C.clean_train(F.col("line")).alias("clean"))


@query("clean_query", O.ctes(_NUMBERED_LINES) +
       f" SELECT doc_id, line_no, {T.clean_query('line')} AS clean FROM nl")
def q_clean_query(spark, sf):
    lines = corpus.training_lines(spark, sf)
    return lines.select("doc_id", F.col("line_no").cast("long").alias("line_no"),
                        C.clean_query(F.col("line")).alias("clean"))


_HELD_NUMBERED = ("held AS (SELECT 'blogs' AS dataset, item_id AS src_id, text FROM benchmark "
                  "UNION ALL SELECT 'tweets', conv_id * 1000 + turn, text FROM conversations WHERE role = 'user'),\n"
                  "hn AS (SELECT dataset, src_id, unnest(string_split(text, chr(10))) AS raw, "
                  "unnest(range(len(string_split(text, chr(10))))) AS line_no FROM held)")


@query("clean_eval", O.ctes(_HELD_NUMBERED) +
       f" SELECT dataset, src_id, line_no, {T.clean_eval_by('raw', 'dataset')} AS line FROM hn")
def q_clean_eval(spark, sf):
    return corpus.heldout_clean(spark, sf).withColumn("line_no", F.col("line_no").cast("long"))


@query("heldout_fingerprint", O.ctes(_HELD_NUMBERED) +
       " SELECT dataset, CAST(sum(CAST('0x' || substr(md5(raw), 1, 14) AS BIGINT)) AS VARCHAR) AS hash, count(*) AS lines "
       "FROM hn GROUP BY dataset")
def q_heldout_fingerprint(spark, sf):
    """A2 + the hash of H3: one order-free fingerprint per held-out set."""
    return corpus.line_set_fingerprint(corpus.heldout_lines(spark, sf), "dataset")


@query("matching_lines", O.ctes(O.train_lines()) + " SELECT DISTINCT line FROM lines WHERE contains(line, 'the')")
def q_matching_lines(spark, sf):
    """Distinct English lines with a given substring."""
    return corpus.matching_lines(corpus.training_lines(spark, sf), "the")


@query("tokens", O.ctes(_NUMBERED_LINES) +
       f" SELECT doc_id, line_no, CAST(len({T.tokens(T.clean_train('line'))}) AS BIGINT) AS n_tokens, "
       f"array_to_string({T.tokens(T.clean_train('line'))}, ' ') AS tokens FROM nl")
def q_tokens(spark, sf):
    t = PL.train_tokens(spark, sf)
    return t.select("doc_id", F.col("line_no").cast("long").alias("line_no"),
                    F.size("tokens").cast("long").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


# ---------------------------------------------------------------- counting

_TRAIN = (O.train_lines(), O.train_tokens())


@query("ngram_counts", O.ctes(*_TRAIN, O.grams((1, 2, 3, 4)), O.counts(1)) +
       " SELECT n, word, freq FROM counts")
def q_ngram_counts(spark, sf):
    return PL.ngram_counts(spark, sf, (1, 2, 3, 4), 1).select(F.col("n").cast("long").alias("n"), "word", "freq")


@query("trim_ngrams", O.ctes(*_TRAIN, O.grams((1, 2, 3, 4)), O.counts(5)) +
       " SELECT n, word, w, pred, freq FROM counts")
def q_trim_ngrams(spark, sf):
    return PL.ngram_counts(spark, sf, (1, 2, 3, 4), 5).select(
        F.col("n").cast("long").alias("n"), "word", "w", "pred", "freq")


@query("freq_of_freq", O.ctes(*_TRAIN, O.grams((1, 2, 3, 4)), O.counts(1)) +
       " SELECT c.n, r.r, count(*) FILTER (WHERE c.freq = r.r) AS n_r, count(*) AS n_types "
       "FROM counts c, (SELECT unnest(range(1, 8)) AS r) r GROUP BY c.n, r.r")
def q_freq_of_freq(spark, sf):
    ff = NG.freq_of_freq(PL.ngram_counts(spark, sf, (1, 2, 3, 4), 1))
    return ff.select(F.col("n").cast("long").alias("n"), "r", "n_r", "n_types")


# ---------------------------------------------------------------- stupid backoff

_SBO = (*_TRAIN, O.grams((1, 2, 3, 4)), O.counts(5))


@query("sbo_scores", O.ctes(*_SBO) +
       " SELECT n, w, pred, freq, round(pow(0.4, 4 - n) * freq / sum(freq) OVER (PARTITION BY n, w), 9) AS score "
       "FROM counts WHERE n > 1 UNION ALL "
       "SELECT n, word, word, freq, round(freq / sum(freq) OVER (), 9) FROM counts WHERE n = 1")
def q_sbo_scores(spark, sf):
    s = S.sbo_scores(PL.ngram_counts(spark, sf, (1, 2, 3, 4), 5), 4)
    return s.select(F.col("n").cast("long").alias("n"), "w", "pred", "freq", r9(F.col("score")).alias("score"))


@query("sbo_top5", O.ctes(*_SBO, O.sbo_model()) +
       " SELECT n, w, pred, round(score, 9) AS score, rnk FROM model")
def q_sbo_top5(spark, sf):
    m = PL.sbo_lookup(spark, sf, 4, 5, 5)
    return m.select(F.col("n").cast("long").alias("n"), "w", "pred", r9(F.col("score")).alias("score"),
                    F.col("rnk").cast("long").alias("rnk"))


_EVAL = (*_SBO, O.sbo_model(), O.heldout_clean(), O.pairs(3))


def _ctx_predictions(spark, sf, fn) -> DataFrame:
    lines = corpus.heldout_clean(spark, sf)
    ctx = E.line_contexts(lines, 3).select("ctx").distinct()
    ctx = ctx.select("ctx", F.filter(F.split("ctx", " "), lambda x: x != F.lit("")).alias("words"),
                     (F.col("ctx") == F.lit("")).alias("empty"))
    return fn(ctx).select("ctx", F.col("rnk").cast("long").alias("rnk"), "word")


@query("predict_sbo", O.ctes(*_EVAL, O.sbo_predictions()) + " SELECT ctx, rnk, word FROM preds")
def q_predict_sbo(spark, sf):
    model = PL.sbo_lookup(spark, sf)
    return _ctx_predictions(spark, sf, lambda c: P.predict_sbo(c, model, ["ctx"], m=3, empty=F.col("empty")))


@query("eval_dataset", O.ctes(*_EVAL, O.sbo_predictions()) + " " + O.eval_report())
def q_eval_dataset(spark, sf):
    return PL.evaluate_sbo(spark, sf)


@query("eval_overall", O.ctes(*_EVAL, O.sbo_predictions()) +
       " SELECT round(100 * avg(score / max_score), 6) AS overall_score_percent, "
       "round(100 * avg(hit_count_top3 / total_count), 6) AS precision_top3, "
       "round(100 * avg(hit_count_top1 / total_count), 6) AS precision_top1, "
       "round(100 * (1 - avg(hit_count_top1 / total_count)), 6) AS word_error_rate, "
       "CAST(sum(total_count) AS BIGINT) AS number_of_predictions FROM (" + O.eval_report() + ") r")
def q_eval_overall(spark, sf):
    return E.overall(PL.evaluate_sbo(spark, sf))


@query("split_sentence", O.ctes(O.heldout_clean(), O.pairs(3)) +
       " SELECT dataset, CAST(pos AS BIGINT) AS pos, CASE WHEN pos = 0 THEN '' ELSE array_to_string(ws[1:pos], ' ') || ' ' END AS prefix, "
       "lower(next_word) AS next_word FROM pairs")
def q_split_sentence(spark, sf):
    p = PL.heldout_pairs(spark, sf)
    return p.select("dataset", F.col("pos").cast("long").alias("pos"), "prefix", "next_word")


# ---------------------------------------------------------------- Good-Turing / Katz

from sparkngram.operators import goodturing as GT  # noqa: E402
from sparkngram.operators import katz as K  # noqa: E402

_KATZ = (*_TRAIN, O.grams((1, 2, 3)), O.counts(1, name="kcounts"), O.gt_table(), O.katz_tables())


@query("gt_discount", O.ctes(*_KATZ) +
       " SELECT n, r, round(n_r, 6) AS n_r, round(discount, 9) AS discount, round(r_star, 9) AS r_star FROM gt")
def q_gt_discount(spark, sf):
    counts, gt = PL.katz_inputs(spark, sf)
    return gt.select(F.col("n").cast("long").alias("n"), "r", F.round("n_r", 6).alias("n_r"),
                     r9(F.col("discount")).alias("discount"), r9(F.col("r_star")).alias("r_star"))


@query("katz_prob", O.ctes(*_KATZ) +
       " SELECT n, w, pred, freq, round(d, 9) AS d, round(prob, 9) AS prob, round(leftover, 9) AS leftover FROM kt")
def q_katz_prob(spark, sf):
    counts, gt = PL.katz_inputs(spark, sf, mat=True)
    t = K.katz_tables(counts, gt, (2, 3))
    return t.select(F.col("n").cast("long").alias("n"), "w", "pred", "freq", r9(F.col("d")).alias("d"),
                    r9(F.col("prob")).alias("prob"), r9(F.col("leftover")).alias("leftover"))


@query("katz_unigram", O.ctes(*_KATZ) + " SELECT word, freq, round(d, 9) AS d, round(prob, 9) AS prob FROM ku")
def q_katz_unigram(spark, sf):
    counts, gt = PL.katz_inputs(spark, sf)
    u = K.katz_unigram(counts, gt)
    return u.select("word", "freq", r9(F.col("d")).alias("d"), r9(F.col("prob")).alias("prob"))


_KCTX = ("kpairs AS (SELECT DISTINCT CASE WHEN len(cw) = 0 THEN '' ELSE array_to_string(cw[len(cw) - least(len(cw), 2) + 1 : len(cw)], ' ') END AS ctx FROM ("
         f"SELECT {T.tokens(T.clean_query(chr(39) + chr(39) + ' || ' + 'prefix'))} AS cw FROM ("
         "SELECT CASE WHEN pos = 0 THEN '' ELSE array_to_string(ws[1:pos], ' ') || ' ' END AS prefix FROM pairs) a) b)")


def _katz_ctx(spark, sf):
    cp = PL.katz_context_pairs(spark, sf).select("ctx").distinct()
    return PL.materialize(cp.select("ctx", F.filter(F.split("ctx", " "), lambda x: x != F.lit("")).alias("words"),
                                    (F.col("ctx") == F.lit("")).alias("empty")))


@query("predict_katz", O.ctes(*_KATZ, O.heldout_clean(), O.pairs(3), _KCTX, O.katz_predictions("kpairs")) +
       " SELECT ctx, CAST(rnk AS BIGINT) AS rnk, word, round(score, 9) AS score FROM kpreds")
def q_predict_katz(spark, sf):
    ctx = _katz_ctx(spark, sf)
    p = K.predict_katz(ctx, PL.katz_model(spark, sf, contexts=ctx), ["ctx"], "words", empty=F.col("empty"))
    return p.select("ctx", F.col("rnk").cast("long").alias("rnk"), "word", r9(F.col("score")).alias("score"))


@query("predict_katz_top5", O.ctes(*_KATZ, O.heldout_clean(), O.pairs(3), _KCTX, O.katz_predictions("kpairs", k=5)) +
       " SELECT ctx, CAST(rnk AS BIGINT) AS rnk, word, round(score, 9) AS score FROM kpreds")
def q_predict_katz_top5(spark, sf):
    """Five Katz suggestions per phrase (the trigram form of G12)."""
    ctx = _katz_ctx(spark, sf)
    p = K.predict_katz(ctx, PL.katz_model(spark, sf, 5, ctx), ["ctx"], "words", k=5, empty=F.col("empty"))
    return p.select("ctx", F.col("rnk").cast("long").alias("rnk"), "word", r9(F.col("score")).alias("score"))


@query("eval_katz", O.ctes(*_KATZ, O.heldout_clean(), O.pairs(3),
                           "kcp AS (SELECT dataset, CASE WHEN len(cw) = 0 THEN '' ELSE array_to_string(cw[len(cw) - least(len(cw), 2) + 1 : len(cw)], ' ') END AS ctx, "
                           "next_word, count(*) AS cnt FROM (SELECT dataset, lower(next_word) AS next_word, "
                           f"{T.tokens(T.clean_query(chr(39) + chr(39) + ' || prefix'))} AS cw FROM ("
                           "SELECT dataset, next_word, CASE WHEN pos = 0 THEN '' ELSE array_to_string(ws[1:pos], ' ') || ' ' END AS prefix FROM pairs) a) b GROUP BY ALL)",
                           O.katz_predictions("(SELECT DISTINCT ctx FROM kcp)")) +
       " SELECT l.dataset AS list_name, l.line_count, l.word_count, CAST(coalesce(r.score, 0) AS BIGINT) AS score, "
       "CAST(coalesce(r.max_score, 0) AS BIGINT) AS max_score, CAST(coalesce(r.top3, 0) AS BIGINT) AS hit_count_top3, "
       "CAST(coalesce(r.top1, 0) AS BIGINT) AS hit_count_top1, CAST(coalesce(r.total, 0) AS BIGINT) AS total_count FROM "
       "(SELECT dataset, count(*) AS line_count, CAST(sum(len(list_filter(string_split(line, ' '), lambda x: x <> ''))) AS BIGINT) AS word_count "
       "FROM hlines GROUP BY dataset) l LEFT JOIN (SELECT dataset, sum(cnt * (4 - rk)) AS score, sum(cnt) * 3 AS max_score, "
       "sum(CASE WHEN rk < 4 THEN cnt ELSE 0 END) AS top3, sum(CASE WHEN rk = 1 THEN cnt ELSE 0 END) AS top1, sum(cnt) AS total "
       "FROM (SELECT c.dataset, c.cnt, coalesce(p.rnk, 4) AS rk FROM kcp c LEFT JOIN kpreds p ON p.ctx = c.ctx AND p.word = c.next_word) q "
       "GROUP BY dataset) r ON l.dataset = r.dataset")
def q_eval_katz(spark, sf):
    return PL.evaluate_katz(spark, sf)


# ---------------------------------------------------------------- Kneser-Ney

from sparkngram.operators import kneserney as KN  # noqa: E402

_KN = (*_TRAIN, O.grams((1, 2, 3)), O.counts(1, name="kcounts"),
       "knd AS (SELECT n, CAST(count(*) FILTER (WHERE freq = 1) AS DOUBLE) / (count(*) FILTER (WHERE freq = 1) + 2 * count(*) FILTER (WHERE freq = 2)) AS D, "
       "count(*) AS types FROM kcounts GROUP BY n)",
       "knb AS (SELECT b.word, b.w, b.pred, b.freq, greatest(b.freq - d.D, 0) / u.freq + d.D / u.freq * "
       "(count(*) OVER (PARTITION BY b.w)) * (count(*) OVER (PARTITION BY b.pred)) / d.types AS pkn "
       "FROM kcounts b JOIN knd d ON d.n = 2 LEFT JOIN kcounts u ON u.n = 1 AND u.word = b.w WHERE b.n = 2)")


@query("kn_unigram", O.ctes(*_KN) +
       " SELECT word, freq, round(freq / (sum(freq) OVER () - 3), 9) AS pkn FROM kcounts WHERE n = 1")
def q_kn_unigram(spark, sf):
    u = KN.kn_unigram(PL.ngram_counts(spark, sf, (1,), 1))
    return u.select("word", "freq", r9(F.col("pkn")).alias("pkn"))


@query("kn_bigram", O.ctes(*_KN) + " SELECT word, freq, round(pkn, 9) AS pkn FROM knb")
def q_kn_bigram(spark, sf):
    b = KN.kn_bigram(PL.ngram_counts(spark, sf, (1, 2), 1))
    return b.select("word", "freq", r9(F.col("pkn")).alias("pkn"))


@query("kn_trigram", O.ctes(*_KN) +
       " SELECT t.word, t.freq, round(greatest(t.freq - d.D, 0) / b.freq + d.D / b.freq * "
       "(count(*) OVER (PARTITION BY t.w)) * kb.pkn, 9) AS pkn FROM kcounts t JOIN knd d ON d.n = 3 "
       "LEFT JOIN kcounts b ON b.n = 2 AND b.word = t.w "
       "LEFT JOIN knb kb ON kb.word = regexp_extract(t.word, '^[^_]+_(.*)$', 1) WHERE t.n = 3")
def q_kn_trigram(spark, sf):
    t = KN.kn_trigram(PL.ngram_counts(spark, sf, (1, 2, 3), 1))
    return t.select("word", "freq", r9(F.col("pkn")).alias("pkn"))


# ---------------------------------------------------------------- absolute discounting

from sparkngram.operators import absdisc as AD  # noqa: E402

_HIST = ("hist AS (SELECT DISTINCT replace(ctx, ' ', '_') AS h FROM kpairs WHERE ctx LIKE '% %')")
_AD = (*_KATZ, O.heldout_clean(), O.pairs(3), _KCTX, _HIST,
       "adu AS (SELECT pred AS c, freq AS cu FROM kcounts WHERE n = 1)",
       "adtot AS (SELECT sum(cu) AS U FROM adu)",
       "adh AS (SELECT h.h, regexp_extract(h.h, '[^_]+$') AS b, ab.freq AS cab, ub.cu AS cbb FROM hist h "
       "LEFT JOIN kcounts ab ON ab.n = 2 AND ab.word = h.h LEFT JOIN adu ub ON ub.c = regexp_extract(h.h, '[^_]+$'))",
       "ad3 AS (SELECT a.h, t.pred AS c, (t.freq - 0.5) / a.cab AS p3 FROM adh a JOIN kcounts t ON t.n = 3 AND t.w = a.h)",
       "ad2 AS (SELECT a.h, t.pred AS c, t.freq AS cb, a.cbb FROM adh a JOIN kcounts t ON t.n = 2 AND t.w = a.b)",
       "adx AS (SELECT a.h, a.cbb, "
       "CASE WHEN (SELECT count(*) FROM ad3 WHERE ad3.h = a.h) = 0 THEN 1.0 ELSE 1 - (SELECT sum(p3) FROM ad3 WHERE ad3.h = a.h) END AS alpha3, "
       "CASE WHEN (SELECT count(*) FROM kcounts t WHERE t.n = 2 AND t.w = a.b) = 0 THEN 0.0 "
       "ELSE 1 - (SELECT sum(t.freq - 0.5) FROM kcounts t WHERE t.n = 2 AND t.w = a.b) / a.cbb END AS alpha2, "
       "(SELECT U FROM adtot) - (SELECT coalesce(sum(u.cu), 0) FROM adu u WHERE u.c IN (SELECT c FROM ad2 WHERE ad2.h = a.h) "
       "OR u.c IN (SELECT c FROM ad3 WHERE ad3.h = a.h)) AS pool_u FROM adh a)",
       "adq AS (SELECT x.*, coalesce((SELECT sum((cb - 0.5) / ad2.cbb) FROM ad2 WHERE ad2.h = x.h "
       "AND ad2.c NOT IN (SELECT c FROM ad3 WHERE ad3.h = x.h)), 0) "
       "+ CASE WHEN pool_u > 0 THEN alpha2 ELSE 0 END AS sum_q FROM adx x)",
       "addist AS (SELECT h, c AS word, p3 AS prob, 'trigram' AS kind FROM ad3 "
       "UNION ALL SELECT d.h, d.c, q.alpha3 * ((d.cb - 0.5) / d.cbb) / q.sum_q, 'bigram' FROM ad2 d JOIN adq q ON q.h = d.h "
       "WHERE d.c NOT IN (SELECT c FROM ad3 WHERE ad3.h = d.h) "
       "UNION ALL SELECT h, NULL, alpha3 * alpha2 / sum_q, 'rest' FROM adq WHERE pool_u > 0)")


def _histories(spark, sf):
    cp = PL.katz_context_pairs(spark, sf).select("ctx").distinct().where(F.col("ctx").contains(" "))
    return PL.materialize(cp.select(F.regexp_replace("ctx", " ", "_").alias("h")))


@query("absdisc_trigram", O.ctes(*_AD) +
       " SELECT h, kind, count(word) AS words, round(sum(CASE WHEN isnan(prob) THEN NULL ELSE prob END) + 1e-10, 6) AS mass FROM addist GROUP BY h, kind")
def q_absdisc_trigram(spark, sf):
    """Per history and part (trigram / bigram / rest): explicit words and
    probability mass of the absolute-discount distribution."""
    h = _histories(spark, sf)
    d = AD.absdisc_masses(AD.for_histories(PL.ngram_counts(spark, sf, (1, 2, 3), 1), h, PL.materialize), h, 0.5, 0.5)
    return d.select("h", "kind", "words", F.round(F.col("mass") + F.lit(1e-10), 6).alias("mass"))


@query("absdisc_argmax", O.ctes(*_AD, "adr AS (SELECT x.h, x.alpha3 * x.alpha2 / x.sum_q / x.pool_u AS coef FROM adq x WHERE x.pool_u > 0)",
                                "adrank AS (SELECT c, cu, row_number() OVER (ORDER BY cu DESC, c) AS ur FROM adu)",
                                "ader AS (SELECT DISTINCT e.h, k.ur FROM addist e JOIN adrank k ON k.c = e.word)",
                                "adfm AS (SELECT h, min(r) AS ur FROM (SELECT h, ur + 1 AS r FROM ader UNION ALL SELECT h, 1 FROM adr) z "
                                "WHERE NOT EXISTS (SELECT 1 FROM ader e WHERE e.h = z.h AND e.ur = z.r) GROUP BY h)",
                                "adrest AS (SELECT r.h, k.c AS word, r.coef * k.cu AS prob FROM adr r JOIN adfm f ON f.h = r.h JOIN adrank k ON k.ur = f.ur)",
                                "adall AS (SELECT h, word, prob FROM (SELECT h, word, prob FROM addist WHERE kind <> 'rest' UNION ALL SELECT h, word, prob FROM adrest) a "
                                "WHERE prob IS NOT NULL AND NOT isnan(prob))") +
       " SELECT h, word, round(prob, 9) AS prob FROM (SELECT h, word, prob, row_number() OVER (PARTITION BY h ORDER BY prob DESC, word) AS rn FROM adall) z WHERE rn = 1")
def q_absdisc_argmax(spark, sf):
    h = _histories(spark, sf)
    counts = AD.for_histories(PL.ngram_counts(spark, sf, (1, 2, 3), 1), h, PL.materialize)
    a = AD.absdisc_argmax(counts, h, 0.5, 0.5, store=PL.materialize)
    return a.select("h", "word", r9(F.col("prob")).alias("prob"))


@query("absdisc_words", O.ctes(
    *_AD, "adr AS (SELECT DISTINCT h, word FROM (SELECT replace(ctx, ' ', '_') AS h, next_word AS word FROM ("
    "SELECT CASE WHEN len(cw) = 0 THEN '' ELSE array_to_string(cw[len(cw) - least(len(cw), 2) + 1 : len(cw)], ' ') END AS ctx, next_word FROM ("
    f"SELECT lower(next_word) AS next_word, {T.tokens(T.clean_query(chr(39) + chr(39) + ' || prefix'))} AS cw FROM ("
    "SELECT next_word, CASE WHEN pos = 0 THEN '' ELSE array_to_string(ws[1:pos], ' ') || ' ' END AS prefix FROM pairs) a) b) c WHERE ctx LIKE '% %' "
    "UNION ALL SELECT h, c FROM ad3) d)",
    "adp AS (SELECT r.h, r.word, coalesce(d.kind, CASE WHEN u.cu IS NOT NULL THEN 'unigram' END) AS kind, "
    "CASE WHEN d.kind IS NOT NULL THEN d.prob WHEN q.pool_u > 0 THEN q.alpha3 * q.alpha2 * u.cu / q.pool_u / q.sum_q END AS prob "
    "FROM adr r JOIN adq q ON q.h = r.h LEFT JOIN addist d ON d.h = r.h AND d.word = r.word LEFT JOIN adu u ON u.c = r.word)") +
    " SELECT h, word, kind, CASE WHEN isfinite(prob) THEN round(prob, 9) END AS prob FROM adp")
def q_absdisc_words(spark, sf):
    """F11-F19 per word: the probability of every word seen after a held-out
    history, in training or in the held-out text itself, and its level."""
    cp = PL.materialize(PL.katz_context_pairs(spark, sf).where(F.col("ctx").contains(" "))
                        .select(F.regexp_replace("ctx", " ", "_").alias("h"), F.col("next_word").alias("word")).distinct())
    whole, out = PL.ngram_counts(spark, sf, (1, 2, 3), 1), None
    for part in AD.in_parts(cp, 6):  # one part's look-ups are on disk at a time
        counts = AD.for_histories(whole, part, PL.kept)
        seen = AD.observed(counts, part).select("h", F.col("c").alias("word"))
        p = PL.kept(AD.absdisc_probability(counts, part.union(seen), backoff=AD.absdisc_backoff(counts, part)))
        out = p if out is None else out.unionByName(p)
        PL.dropped(counts)
    return out.select("h", "word", "kind", r9(F.col("prob")).alias("prob"))


# ---------------------------------------------------------------- sampling / summary

from sparkngram.operators import sampling as SM  # noqa: E402
from sparkngram.operators import stats as ST  # noqa: E402
from sparkngram.operators import interp as IP  # noqa: E402

_SRC_LINES = ("sl AS (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line, "
              "unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents WHERE lang = 'en')")
_HRANK = ("hr AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('1234|' || CAST(doc_id AS VARCHAR) || '|' || "
          "CAST(line_no AS VARCHAR)), doc_id, line_no) AS hrank, count(*) OVER (PARTITION BY source) AS group_n FROM sl)")


@query("sample_lines", O.ctes(_SRC_LINES, _HRANK) +
       " SELECT source, doc_id, line_no FROM hr WHERE hrank <= floor(group_n * 0.25)")
def q_sample_lines(spark, sf):
    lines = corpus.training_lines(spark, sf).withColumn("line_no", F.col("line_no").cast("long"))
    return SM.sample_lines(lines, 0.25).select("source", "doc_id", "line_no")


@query("split_lines", O.ctes(_SRC_LINES, _HRANK) +
       " SELECT source, doc_id, line_no, CASE WHEN hrank <= round_even(group_n * 0.6, 0) THEN 'train' "
       "WHEN hrank <= round_even(group_n * 0.6, 0) + round_even((group_n - round_even(group_n * 0.6, 0)) * 0.5, 0) THEN 'holdout' "
       "ELSE 'test' END AS part FROM hr")
def q_split_lines(spark, sf):
    lines = corpus.training_lines(spark, sf).withColumn("line_no", F.col("line_no").cast("long"))
    return SM.split_lines(lines).select("source", "doc_id", "line_no", "part")


_SUMMARY_SQL = ("SELECT coalesce(source, 'total') AS file_name, round(sum(octet_length(encode(line))) / 1048576.0, 6) AS size_mb, "
                "count(*) AS line_count, CAST(sum(len(regexp_extract_all(line, '\\w+'))) AS BIGINT) AS word_count "
                "FROM {src} GROUP BY ROLLUP (source)")


@query("corpus_summary", O.ctes(_SRC_LINES, _HRANK) + " " + _SUMMARY_SQL.format(src="sl") + " UNION ALL " +
       _SUMMARY_SQL.format(src="(SELECT * FROM hr WHERE hrank <= floor(group_n * 0.25))").replace(
           "coalesce(source, 'total')", "'sample ' || coalesce(source, 'total')"))
def q_corpus_summary(spark, sf):
    lines = corpus.training_lines(spark, sf).withColumn("line_no", F.col("line_no").cast("long"))
    full = SM.corpus_summary(lines)
    samp = SM.corpus_summary(SM.sample_lines(lines, 0.25), prefix="sample ")
    return full.unionByName(samp)


# ---------------------------------------------------------------- counting variants

@query("docfreq", O.ctes(_NUMBERED_LINES,
                         f"dtok AS (SELECT doc_id, line_no, {T.tokens(T.clean_train('line'))} AS t FROM nl)",
                         "dl AS (SELECT DISTINCT doc_id, line_no, n, array_to_string(t[i:i+n-1], '_') AS word FROM ("
                         "SELECT doc_id, line_no, t, n, unnest(range(1, len(t) - n + 2)) AS i FROM dtok, "
                         "(SELECT unnest([1, 2, 3]) AS n) ns WHERE len(t) >= n) x)") +
       " SELECT n, word, count(*) AS docfreq FROM dl GROUP BY n, word")
def q_docfreq(spark, sf):
    t = PL.train_tokens(spark, sf)
    c = NG.count_windows(t, "tokens", (1, 2, 3), once=True, partitions=PL.count_partitions(spark, [f"{sf}/documents.parquet"]))
    return c.select(F.col("n").cast("long").alias("n"), "word", F.col("freq").alias("docfreq"))


_SRC_COUNTS = ("sc AS (SELECT source, n, word, count(*) AS freq FROM (SELECT source, n, array_to_string(t[i:i+n-1], '_') AS word FROM ("
               "SELECT source, t, n, unnest(range(1, len(t) - n + 2)) AS i FROM toks, (SELECT unnest([1, 2]) AS n) ns WHERE len(t) >= n) x) y "
               "GROUP BY source, n, word)")


@query("merge_counts", O.ctes(*_TRAIN, _SRC_COUNTS) + " SELECT n, word, CAST(sum(freq) AS BIGINT) AS freq, count(*) AS sources FROM sc GROUP BY n, word")
def q_merge_counts(spark, sf):
    """Per-source count tables merged (union + sum), with the number of
    sources each n-gram came from."""
    t = PL.train_tokens(spark, sf)
    per = NG.explode_ngrams(t, "tokens", (1, 2), keep=["source"]).groupBy("source", "n", "word").agg(
        F.count(F.lit(1)).alias("freq"))
    return per.groupBy("n", "word").agg(F.sum("freq").alias("freq"), F.count(F.lit(1)).alias("sources")) \
        .select(F.col("n").cast("long").alias("n"), "word", "freq", "sources")


@query("merge_counts_outer", O.ctes(*_TRAIN, O.grams((1, 2)), O.counts(1),
                                    "btok AS (SELECT " + T.tokens(T.clean_train("line")) + " AS t FROM "
                                    "(SELECT unnest(string_split(text, chr(10))) AS line FROM benchmark) b)",
                                    O.grams((1, 2), src="btok", name="bgrams"), O.counts(1, src="bgrams", name="bcounts")) +
       " SELECT coalesce(a.n, b.n) AS n, coalesce(a.word, b.word) AS word, coalesce(a.freq, 0) + coalesce(b.freq, 0) AS freq "
       "FROM counts a FULL OUTER JOIN bcounts b ON a.n = b.n AND a.word = b.word")
def q_merge_counts_outer(spark, sf):
    """E6 literal form: training counts full-outer-joined with the counts
    of the benchmark text, NA-ignoring sum."""
    a = PL.ngram_counts(spark, sf, (1, 2), 1)
    bl = corpus.explode_lines(corpus.table(spark, sf, "benchmark"), "text", ["item_id"])
    b = NG.count_ngrams(bl.select(C.tokens(C.clean_train(F.col("line"))).alias("tokens")), "tokens", (1, 2))
    m = NG.merge_counts_outer(a, b)
    return m.select(F.col("n").cast("long").alias("n"), "word", "freq")


# ---------------------------------------------------------------- statistics

_DFM = ("dfm AS (SELECT doc_id, source, f AS feature, count(*) AS count FROM (SELECT doc_id, source, unnest(t) AS f FROM toks) x "
        "GROUP BY doc_id, source, f)")


@query("topn_log", O.ctes(*_TRAIN, O.grams((1, 2, 3, 4)), O.counts(5)) +
       " SELECT n, rnk, word, freq, round(log10(freq), 9) AS log10_freq FROM (SELECT n, word, freq, "
       "row_number() OVER (PARTITION BY n ORDER BY freq DESC, word) AS rnk FROM counts) z WHERE rnk <= 30")
def q_topn_log(spark, sf):
    t = ST.top_log(PL.ngram_counts(spark, sf, (1, 2, 3, 4), 5), 30)
    return t.select(F.col("n").cast("long").alias("n"), F.col("rnk").cast("long").alias("rnk"), "word", "freq",
                    r9(F.col("log10_freq")).alias("log10_freq"))


@query("rank_frequency", O.ctes(*_TRAIN, O.grams((1, 2, 3, 4)), O.counts(5)) +
       " SELECT n, rnk, freq FROM (SELECT n, freq, row_number() OVER (PARTITION BY n ORDER BY freq DESC, word) AS rnk "
       "FROM counts) z WHERE rnk <= 2000")
def q_rank_frequency(spark, sf):
    t = ST.top_log(PL.ngram_counts(spark, sf, (1, 2, 3, 4), 5), 2000)
    return t.select(F.col("n").cast("long").alias("n"), F.col("rnk").cast("long").alias("rnk"), "freq")


@query("freq_spectrum", O.ctes(*_TRAIN, O.grams((1, 2, 3, 4)), O.counts(1)) +
       " SELECT n, freq AS r, count(*) AS n_r, round(log10(freq), 9) AS log10_r, round(log10(count(*)), 9) AS log10_n_r "
       "FROM counts GROUP BY n, freq")
def q_freq_spectrum(spark, sf):
    s = ST.freq_spectrum(PL.ngram_counts(spark, sf, (1, 2, 3, 4), 1))
    return s.select(F.col("n").cast("long").alias("n"), "r", "n_r", r9(F.col("log10_r")).alias("log10_r"),
                    r9(F.col("log10_n_r")).alias("log10_n_r"))


@query("wordcloud_groups", O.ctes(*_TRAIN, _DFM) +
       " SELECT source, feature, freq, rnk FROM (SELECT source, feature, sum(count) AS freq, row_number() OVER "
       "(PARTITION BY source ORDER BY sum(count) DESC, feature) AS rnk FROM dfm GROUP BY source, feature) z WHERE rnk <= 100")
def q_wordcloud_groups(spark, sf):
    t = ST.top_features_by_group(PL.train_dfm(spark, sf), "source", 100)
    return t.select("source", "feature", "freq", F.col("rnk").cast("long").alias("rnk"))


@query("text_frequency", O.ctes(*_TRAIN, _DFM) +
       " SELECT feature, frequency, docfreq, rnk AS rank FROM (SELECT feature, sum(count) AS frequency, count(DISTINCT doc_id) AS docfreq, "
       "row_number() OVER (ORDER BY sum(count) DESC, feature) AS rnk FROM dfm GROUP BY feature) z WHERE rnk <= 15")
def q_text_frequency(spark, sf):
    d = PL.train_dfm(spark, sf).groupBy("doc_id", "feature").agg(F.sum("count").alias("count"))
    t = ST.text_frequency(d, "doc_id", 15)
    return t.select("feature", "frequency", "docfreq", F.col("rank").cast("long").alias("rank"))


_TOPF = ("dfd AS (SELECT doc_id, feature, sum(count) AS count FROM dfm GROUP BY doc_id, feature),\n"
         "topf AS (SELECT feature, sum(count) AS freq FROM dfd GROUP BY feature ORDER BY freq DESC, feature LIMIT 50)")


@query("cooccurrence", O.ctes(*_TRAIN, _DFM, _TOPF) +
       " SELECT a.feature AS f1, b.feature AS f2, sum(a.count * b.count) AS count FROM dfd a JOIN dfd b ON a.doc_id = b.doc_id "
       "AND a.feature < b.feature WHERE a.feature IN (SELECT feature FROM topf) AND b.feature IN (SELECT feature FROM topf) "
       "GROUP BY a.feature, b.feature")
def q_cooccurrence(spark, sf):
    d = PL.train_dfm(spark, sf).groupBy("doc_id", "feature").agg(F.sum("count").alias("count"))
    return ST.cooccurrence(d, "doc_id", 50)


@query("feature_sizes", O.ctes(*_TRAIN, _DFM, _TOPF) +
       " SELECT feature, freq, round(ln(freq) / max(ln(freq)) OVER () * 3, 9) AS size FROM topf")
def q_feature_sizes(spark, sf):
    d = PL.train_dfm(spark, sf).groupBy("doc_id", "feature").agg(F.sum("count").alias("count"))
    s = ST.feature_sizes(d, 50)
    return s.select("feature", "freq", r9(F.col("size")).alias("size"))


@query("ttr", O.ctes(*_TRAIN, _DFM) +
       " SELECT doc_id, round(count(*) / sum(count), 9) AS ttr, count(*) AS types, CAST(sum(count) AS BIGINT) AS tokens "
       "FROM (SELECT doc_id, feature, sum(count) AS count FROM dfm GROUP BY doc_id, feature) d GROUP BY doc_id")
def q_ttr(spark, sf):
    d = PL.train_dfm(spark, sf).groupBy("doc_id", "feature").agg(F.sum("count").alias("count"))
    t = ST.type_token_ratio(d, "doc_id")
    return t.select("doc_id", r9(F.col("ttr")).alias("ttr"), "types", "tokens")


@query("keyness", O.ctes(*_TRAIN, _DFM,
                         "kf AS (SELECT d.feature, sum(CASE WHEN l.quality = 1 THEN d.count ELSE 0 END) AS a, "
                         "sum(CASE WHEN l.quality = 1 THEN 0 ELSE d.count END) AS b FROM dfm d JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.feature)",
                         "kt AS (SELECT sum(a) AS ta, sum(b) AS tb FROM kf)",
                         "kx AS (SELECT feature, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b, CAST(ta - a AS DOUBLE) AS c, CAST(tb - b AS DOUBLE) AS dd FROM kf, kt)") +
       " SELECT feature, CAST(a AS BIGINT) AS n_target, CAST(b AS BIGINT) AS n_reference, round(CASE WHEN a * dd >= b * c THEN 1.0 ELSE -1.0 END * "
       "(a + b + c + dd) * pow(greatest(abs(a * dd - b * c) - (a + b + c + dd) / 2, 0), 2) / "
       "nullif((a + b) * (c + dd) * (a + c) * (b + dd), 0), 6) + 0.0 AS chi2 FROM kx")
def q_keyness(spark, sf):
    """I8 + I11: documents flagged by their quality label (target = 1)."""
    lab = corpus.table(spark, sf, "labels").select("doc_id", (F.col("quality") == 1).alias("target"))
    d = PL.train_dfm(spark, sf).join(lab, "doc_id")
    k = ST.keyness(d, "target")
    return k.select("feature", "n_target", "n_reference", F.round("chi2", 6).alias("chi2"))


@query("collocations", O.ctes(*_TRAIN, O.grams((2,)), O.counts(1),
                              "cx AS (SELECT word, freq AS n11, sum(freq) OVER (PARTITION BY w) AS r1, sum(freq) OVER (PARTITION BY pred) AS c1, "
                              "sum(freq) OVER () AS N FROM counts)") +
       " SELECT replace(word, '_', ' ') AS collocation, n11 AS count, "
       "round(ln(n11 + 0.5) + ln(N - r1 - c1 + n11 + 0.5) - ln(r1 - n11 + 0.5) - ln(c1 - n11 + 0.5), 9) AS lambda, "
       "round((ln(n11 + 0.5) + ln(N - r1 - c1 + n11 + 0.5) - ln(r1 - n11 + 0.5) - ln(c1 - n11 + 0.5)) / "
       "sqrt(1 / (n11 + 0.5) + 1 / (r1 - n11 + 0.5) + 1 / (c1 - n11 + 0.5) + 1 / (N - r1 - c1 + n11 + 0.5)), 9) AS z "
       "FROM cx WHERE n11 >= 100")
def q_collocations(spark, sf):
    c = ST.collocations(PL.ngram_counts(spark, sf, (2,), 1), 100)
    return c.select("collocation", "count", r9(F.col("lambda")).alias("lambda"), r9(F.col("z")).alias("z"))


@query("doc_distance", O.ctes(*_TRAIN, _DFM,
                              "dd AS (SELECT doc_id, feature, sum(count) AS count FROM dfm GROUP BY doc_id, feature)",
                              "dr AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('1234|' || CAST(doc_id AS VARCHAR)), doc_id) AS hrank "
                              "FROM (SELECT DISTINCT doc_id, source FROM documents WHERE lang = 'en') z)",
                              "pr AS (SELECT a.doc_id AS doc_a, b.doc_id AS doc_b FROM dr a JOIN dr b ON b.source = a.source AND b.hrank = a.hrank + 1)",
                              "sq AS (SELECT doc_id, sum(count * count) AS sq FROM dd GROUP BY doc_id)",
                              "dt AS (SELECT p.doc_a, p.doc_b, sum(x.count * y.count) AS dot FROM pr p JOIN dd x ON x.doc_id = p.doc_a "
                              "JOIN dd y ON y.doc_id = p.doc_b AND y.feature = x.feature GROUP BY p.doc_a, p.doc_b)") +
       " SELECT p.doc_a, p.doc_b, round(sqrt(greatest(CAST(coalesce(a.sq, 0) + coalesce(b.sq, 0) - 2 * coalesce(t.dot, 0) AS DOUBLE), 0)), 9) AS distance "
       "FROM pr p LEFT JOIN dt t ON t.doc_a = p.doc_a AND t.doc_b = p.doc_b LEFT JOIN sq a ON a.doc_id = p.doc_a LEFT JOIN sq b ON b.doc_id = p.doc_b")
def q_doc_distance(spark, sf):
    """I10 for each document and its successor in the seeded hash order of
    its source (skew-safe two-level rank + equi-join, not all pairs)."""
    d = PL.train_dfm(spark, sf).groupBy("doc_id", "feature").agg(F.sum("count").alias("count"))
    docs = corpus.table(spark, sf, "documents").where(F.col("lang") == "en").select("doc_id", "source").distinct()
    r = SM.hash_rank(docs, "source", ["doc_id"])
    pairs = r.select(F.col("doc_id").alias("doc_a"), "source", "hrank").join(
        r.select(F.col("doc_id").alias("doc_b"), "source", (F.col("hrank") - 1).alias("hrank")), ["source", "hrank"]) \
        .select("doc_a", "doc_b")
    out = ST.doc_distance(d, pairs)
    return out.select("doc_a", "doc_b", r9(F.col("distance")).alias("distance"))


@query("group_max_date",
       "SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS max_ts, count(*) FILTER (WHERE year(ts) >= 2024) AS recent "
       "FROM events GROUP BY user_id")
def q_group_max_date(spark, sf):
    """I13 + J15: latest event per user and a year flag count."""
    ev = corpus.table(spark, sf, "events")
    g = ev.groupBy("user_id").agg(F.max("ts").alias("m"), F.count(F.when(F.year("ts") >= 2024, 1)).alias("recent"))
    return g.select("user_id", F.date_format("m", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("max_ts"), "recent")


@query("json_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def q_json_props(spark, sf):
    """JSON documents parsed with a declared schema."""
    return corpus.json_props(spark, sf)


_HTML_BODY = ("regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script\\s*>', ' ', 'g'), "
              "'(?is)<style\\b.*?</style\\s*>', ' ', 'g')")


@query("html_paragraphs",
       "WITH px AS (SELECT page_id, regexp_extract_all(" + _HTML_BODY + ", '(?is)<p(?:\\s[^>]*)?>(.*?)</p>', 1) AS ps FROM pages),\n"
       "pu AS (SELECT page_id, unnest(ps) AS raw, unnest(range(len(ps))) AS pos FROM px),\n"
       "pt AS (SELECT page_id, pos, trim(regexp_replace(translate(replace(replace(replace(replace(replace(replace("
       "regexp_replace(raw, '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), "
       "chr(13) || chr(10), '  '), '[[:space:]]+', ' ', 'g')) AS text FROM pu)\n"
       "SELECT page_id, text, CAST(min(pos) AS INTEGER) AS pos FROM pt WHERE text <> '' GROUP BY page_id, text")
def q_html_paragraphs(spark, sf):
    return corpus.html_paragraphs(spark, sf)


# ---------------------------------------------------------------- interpolation / perplexity

_GRID = ("grid AS (SELECT i / 10.0 AS l1, j / 10.0 AS l2, (10 - i - j) / 10.0 AS l3 FROM range(0, 11) a(i), range(0, 11) b(j) "
         "WHERE i + j <= 9)")
_ITEST = ("itest AS (SELECT split_part(ctx, ' ', 1) AS a, split_part(ctx, ' ', 2) AS b, next_word AS c, sum(cnt) AS cnt "
          "FROM cpairs WHERE ctx LIKE '% %' GROUP BY ALL)",
          "icomp AS (SELECT t.a, t.b, t.c, t.cnt, coalesce(abc.freq / ab.freq, 0) AS p3, coalesce(bc.freq / ub.freq, 0) AS p2, "
          "uc.freq / (SELECT sum(freq) FROM kcounts WHERE n = 1) AS p1 FROM itest t "
          "LEFT JOIN kcounts uc ON uc.n = 1 AND uc.word = t.c LEFT JOIN kcounts ub ON ub.n = 1 AND ub.word = t.b "
          "LEFT JOIN kcounts ab ON ab.n = 2 AND ab.word = t.a || '_' || t.b LEFT JOIN kcounts bc ON bc.n = 2 AND bc.word = t.b || '_' || t.c "
          "LEFT JOIN kcounts abc ON abc.n = 3 AND abc.word = t.a || '_' || t.b || '_' || t.c)")
_INTERP = (*_TRAIN, O.grams((1, 2, 3)), O.counts(1, name="kcounts"), O.heldout_clean(), O.pairs(3), *_ITEST, _GRID,
           "isc AS (SELECT l1, l2, l3, sum(cnt * ln(l1 * p3 + l2 * p2 + l3 * p1)) AS loglik, CAST(coalesce(sum(cnt) FILTER (WHERE p1 IS NOT NULL), 0) AS BIGINT) AS n, "
           "CAST(coalesce(sum(cnt) FILTER (WHERE p1 IS NULL), 0) AS BIGINT) AS oov FROM icomp, grid GROUP BY l1, l2, l3)")


def _interp_scored(spark, sf):
    counts = PL.ngram_counts(spark, sf, (1, 2, 3), 1)
    cp = E.line_contexts(corpus.heldout_clean(spark, sf), 3).where(F.col("ctx").contains(" "))
    test = cp.select(F.split("ctx", " ")[0].alias("a"), F.split("ctx", " ")[1].alias("b"),
                     F.col("next_word").alias("c"), "cnt").groupBy("a", "b", "c").agg(F.sum("cnt").alias("cnt"))
    comp = IP.ml_components(counts, test)
    return IP.interpolate(comp, IP.lambda_grid(spark))


@query("interp", O.ctes(*_INTERP) +
       " SELECT l1, l2, l3, round(loglik, 6) AS loglik, n, oov, round(exp(-loglik / n), 6) AS perplexity FROM isc")
def q_interp(spark, sf):
    s = _interp_scored(spark, sf)
    return s.select("l1", "l2", "l3", F.round("loglik", 6).alias("loglik"), "n", "oov", F.round("perplexity", 6).alias("perplexity"))


@query("interp_best", O.ctes(*_INTERP) +
       " SELECT l1, l2, l3, round(loglik, 6) AS loglik, round(exp(-loglik / n), 6) AS perplexity FROM isc "
       "ORDER BY loglik DESC, l1 DESC, l2 DESC LIMIT 1")
def q_interp_best(spark, sf):
    b = IP.best_lambda(_interp_scored(spark, sf))
    return b.select("l1", "l2", "l3", F.round("loglik", 6).alias("loglik"), F.round("perplexity", 6).alias("perplexity"))


# ---------------------------------------------------------------- predictor variants

@query("predict_sbo_unigram", O.ctes(*_EVAL, O.sbo_variant("unigram", defaults=P.APP_DEFAULTS)) +
       " SELECT ctx, CAST(rnk AS BIGINT) AS rnk, word FROM vpreds")
def q_predict_sbo_unigram(spark, sf):
    """The app's predictor - unigram top 3 as the last level."""
    model = PL.sbo_lookup(spark, sf)
    return _ctx_predictions(spark, sf, lambda c: P.predict_sbo(c, model, ["ctx"], m=3, fill="unigram",
                                                               defaults=P.APP_DEFAULTS, empty=F.col("empty")))


@query("predict_first_hit", O.ctes(*_EVAL, O.sbo_variant("first_hit")) + " SELECT ctx, CAST(rnk AS BIGINT) AS rnk, word FROM vpreds")
def q_predict_first_hit(spark, sf):
    """Stop at the highest order with any hit."""
    model = PL.sbo_lookup(spark, sf)
    return _ctx_predictions(spark, sf, lambda c: P.predict_sbo(c, model, ["ctx"], m=3, first_hit_only=True,
                                                               empty=F.col("empty")))


@query("predict_top5", O.ctes(*_EVAL, O.sbo_variant("none", k=5, per_level=5)) + " SELECT ctx, CAST(rnk AS BIGINT) AS rnk, word FROM vpreds "
       f"UNION ALL SELECT ctx, 0, '{P.NO_MATCH}' FROM vctx WHERE ctx NOT IN (SELECT ctx FROM vpreds)")
def q_predict_top5(spark, sf):
    """Five suggestions, no padding; a phrase without a hit gets the message."""
    model = PL.sbo_lookup(spark, sf)
    return _ctx_predictions(spark, sf, lambda c: P.predict_sbo(c, model, ["ctx"], m=3, k=5, per_level=5, fill="none",
                                                               empty=F.col("empty"), message=P.NO_MATCH))


@query("predict_top5_unigram", O.ctes(*_EVAL, O.sbo_variant("unigram", k=5, per_level=5)) + " SELECT ctx, CAST(rnk AS BIGINT) AS rnk, word FROM vpreds")
def q_predict_top5_unigram(spark, sf):
    """Five suggestions from trigrams, bigrams, then unigrams."""
    model = PL.sbo_lookup(spark, sf)
    return _ctx_predictions(spark, sf, lambda c: P.predict_sbo(c, model, ["ctx"], m=3, k=5, per_level=5, fill="unigram",
                                                               empty=F.col("empty")))


@query("predict_4gram", O.ctes(*_EVAL, O.sbo_variant("none", m=4, defaults=("the", "on", "a"),
                                                       ctx_src="(SELECT DISTINCT CASE WHEN pos = 0 THEN '' ELSE array_to_string(ws[pos - least(pos, 3) + 1 : pos], ' ') END AS ctx FROM pairs)").replace(
    "vcand AS (SELECT * FROM vhit UNION ALL", "vcand AS (SELECT * FROM vhit UNION ALL SELECT c.ctx, 0, d.r, d.p FROM vctx c, (VALUES ('the', 1), ('on', 2), ('a', 3)) d(p, r) WHERE c.ctx <> '' UNION ALL")) +
       " SELECT ctx, CAST(rnk AS BIGINT) AS rnk, word FROM vpreds")
def q_predict_4gram(spark, sf):
    """G2 with m = 4 (three-word histories, orders 4..2)."""
    model = PL.sbo_lookup(spark, sf)
    lines = corpus.heldout_clean(spark, sf)
    ctx = E.line_contexts(lines, 4).select("ctx").distinct()
    ctx = ctx.select("ctx", F.filter(F.split("ctx", " "), lambda x: x != F.lit("")).alias("words"),
                     (F.col("ctx") == F.lit("")).alias("empty"))
    return P.predict_sbo(ctx, model, ["ctx"], m=4, empty=F.col("empty")).select(
        "ctx", F.col("rnk").cast("long").alias("rnk"), "word")


@query("eval_rank", O.ctes(*_EVAL, O.sbo_predictions()) +
       " SELECT c.dataset, c.ctx, c.next_word, c.cnt, CAST(coalesce(p.rnk, 4) AS BIGINT) AS rank FROM cpairs c "
       "LEFT JOIN preds p ON p.ctx = c.ctx AND p.word = c.next_word")
def q_eval_rank(spark, sf):
    """H2: rank of the true next word (4 = not in the top 3) per distinct
    (dataset, context, next word) with its count."""
    model = PL.sbo_lookup(spark, sf)
    cp = E.line_contexts(corpus.heldout_clean(spark, sf), 3)
    r = E.rank_pairs(cp, lambda c: P.predict_sbo(c, model, ["ctx"], m=3, empty=F.col("empty")))
    return r.select("dataset", "ctx", "next_word", "cnt", "rank")


@query("eval_baseline", O.ctes(O.heldout_clean(), O.pairs(3)) +
       " SELECT dataset, CAST(sum(cnt * (4 - CASE next_word WHEN 'the' THEN 1 WHEN 'on' THEN 2 WHEN 'a' THEN 3 ELSE 4 END)) AS BIGINT) AS score, "
       "CAST(sum(cnt) * 3 AS BIGINT) AS max_score FROM cpairs GROUP BY dataset")
def q_eval_baseline(spark, sf):
    """G19 + H3: the constant predictor (the, on, a) scored on held-out pairs."""
    cp = E.line_contexts(corpus.heldout_clean(spark, sf), 3)
    r = E.rank_pairs(cp, lambda c: P.baseline(c, ["ctx"]))
    return r.groupBy("dataset").agg(F.sum(F.col("cnt") * (4 - F.col("rank"))).cast("long").alias("score"),
                                    (F.sum("cnt") * 3).cast("long").alias("max_score"))


# ---------------------------------------------------------------- features

from sparkngram.operators import features as FT  # noqa: E402

# A small neutral block list for the block-list queries (the reference's
# own word file is not reproduced here).
BLOCKLIST = ("ing", "tion", "ness", "ly", "nt")


@query("blocklist_tokens", O.ctes(_NUMBERED_LINES) +
       f" SELECT doc_id, line_no, array_to_string(list_filter({T.tokens(T.clean_train('line'))}, "
       f"lambda x: x NOT IN ({', '.join(repr(w) for w in BLOCKLIST)})), ' ') AS tokens FROM nl")
def q_blocklist_tokens(spark, sf):
    """Listed words removed from the token lists (neighbours close up)."""
    t = PL.train_tokens(spark, sf)
    words = spark.createDataFrame([(w,) for w in BLOCKLIST], "word string")
    r = FT.remove_listed_tokens(t, "tokens", words, ["doc_id", "line_no"])
    return r.select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.array_join("tokens", " ").alias("tokens"))


@query("blocklist_features", O.ctes(*_TRAIN, O.grams((1, 2)), O.counts(1)) +
       f" SELECT n, word, freq FROM counts WHERE word NOT IN ({', '.join(repr(w) for w in BLOCKLIST)})")
def q_blocklist_features(spark, sf):
    """D3: listed features removed after counting (exact n-gram match)."""
    c = PL.ngram_counts(spark, sf, (1, 2), 1)
    words = spark.createDataFrame([(w,) for w in BLOCKLIST], "word string")
    return FT.remove_listed_features(c, words).select(F.col("n").cast("long").alias("n"), "word", "freq")


@query("unk_tokens", O.ctes(_NUMBERED_LINES,
                            f"ut AS (SELECT doc_id, line_no, {T.tokens(T.clean_train('line'))} AS t FROM nl)",
                            "ux AS (SELECT doc_id, line_no, unnest(t) AS w, unnest(range(len(t))) AS i FROM ut)",
                            "uv AS (SELECT w FROM ux GROUP BY w HAVING count(*) >= 5)",
                            "us AS (SELECT doc_id, line_no, string_agg(coalesce(uv.w, 'UNK'), ' ' ORDER BY i) AS tokens "
                            "FROM ux LEFT JOIN uv ON uv.w = ux.w GROUP BY doc_id, line_no)") +
       " SELECT ut.doc_id, ut.line_no, coalesce(us.tokens, '') AS tokens FROM ut LEFT JOIN us "
       "ON us.doc_id = ut.doc_id AND us.line_no = ut.line_no")
def q_unk_tokens(spark, sf):
    """Words seen fewer than five times become UNK."""
    t = PL.train_tokens(spark, sf)
    r = FT.unk_tokens(t, ["doc_id", "line_no"], "tokens", FT.vocabulary(t, "tokens", 5))
    return r.select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.array_join("tokens", " ").alias("tokens"))


@query("dfm_prop", O.ctes(*_TRAIN, _DFM) +
       " SELECT doc_id, feature, count, round(count / sum(count) OVER (PARTITION BY doc_id), 9) AS prop "
       "FROM (SELECT doc_id, feature, sum(count) AS count FROM dfm GROUP BY doc_id, feature) d")
def q_dfm_prop(spark, sf):
    """D10 + D11: long DFM with per-document feature shares."""
    d = PL.train_dfm(spark, sf).groupBy("doc_id", "feature").agg(F.sum("count").alias("count"))
    p = FT.dfm_prop(d, "doc_id")
    return p.select("doc_id", "feature", "count", r9(F.col("prop")).alias("prop"))


# ---------------------------------------------------------------- streaming

from sparkngram.streaming import scoring as STR  # noqa: E402


@query("stream_counts", O.ctes(*_TRAIN, O.grams((1, 2)), O.counts(1)) + " SELECT n, word, freq FROM counts")
def q_stream_counts(spark, sf):
    """K2: running counts of the English documents read as a file stream;
    the merged table equals the batch counts."""
    c = STR.stream_ngram_counts(spark, f"{sf}/documents.parquet",
                                "doc_id long, text string, lang string, source string, n_chars long", "text",
                                orders=(1, 2), where="lang = 'en'")
    return c.select(F.col("n").cast("long").alias("n"), "word", "freq")


@query("stream_predict", O.ctes(*_SBO, O.sbo_model(),
                                "sq AS (SELECT conv_id, turn, " + T.tokens(T.clean_query("text")) + " AS cw, text = '' AS is_empty FROM conversations WHERE role = 'user')",
                                "sctx AS (SELECT DISTINCT CASE WHEN is_empty THEN '' ELSE array_to_string(cw[len(cw) - least(len(cw), 2) + 1 : len(cw)], ' ') END AS ctx FROM sq)",
                                O.sbo_variant("unigram", defaults=("the", "to", "and"), ctx_src="sctx")) +
       " SELECT q.conv_id, q.turn, CAST(p.rnk AS BIGINT) AS rnk, p.word FROM sq q JOIN vpreds p ON p.ctx = "
       "CASE WHEN q.is_empty THEN '' ELSE array_to_string(q.cw[len(q.cw) - least(len(q.cw), 2) + 1 : len(q.cw)], ' ') END")
def q_stream_predict(spark, sf):
    """K1: user turns arriving as a stream, scored against the static
    stupid-backoff table (app variant, unigram fill)."""
    model = PL.materialize(PL.sbo_lookup(spark, sf))
    out = STR.stream_predictions(spark, f"{sf}/conversations.parquet",
                                 "conv_id long, turn long, role string, text string", model, ["conv_id", "turn"], "text",
                                 where="role = 'user'")
    return out.select("conv_id", "turn", F.col("rnk").cast("long").alias("rnk"), "word")


# ---------------------------------------------------------------- option scoring / frequency clusters

_CPAIRS4 = ("cp4 AS (SELECT DISTINCT CASE WHEN pos = 0 THEN '' ELSE array_to_string(ws[pos - least(pos, 3) + 1 : pos], ' ') END AS ctx, "
            "lower(next_word) AS option FROM pairs)")
_SCORES = ("scr AS (SELECT n, word, pow(0.4, 4 - n) * freq / sum(freq) OVER (PARTITION BY n, w) AS score FROM counts WHERE n > 1 "
           "UNION ALL SELECT n, word, freq / sum(freq) OVER () FROM counts WHERE n = 1)")


@query("score_options", O.ctes(*_SBO, _SCORES, O.heldout_clean(), O.pairs(3), _CPAIRS4,
                               "so AS (SELECT ctx, option, h + 1 AS n, CASE WHEN h = 0 THEN option ELSE "
                               "array_to_string(list_concat(cw[len(cw) - h + 1 : len(cw)], [option]), '_') END AS word FROM ("
                               "SELECT ctx, option, cw, unnest(range(0, least(len(cw), 3) + 1)) AS h FROM ("
                               "SELECT ctx, option, list_filter(string_split(ctx, ' '), lambda x: x <> '') AS cw FROM cp4) a) b)",
                               "sb AS (SELECT so.ctx, so.option, max(so.n) AS n, arg_max(s.score, so.n) AS score FROM so JOIN scr s "
                               "ON s.n = so.n AND s.word = so.word GROUP BY so.ctx, so.option)") +
       " SELECT c.ctx, c.option, CAST(b.n AS BIGINT) AS n, round(b.score, 9) AS score FROM cp4 c LEFT JOIN sb b ON b.ctx = c.ctx AND b.option = c.option")
def q_score_options(spark, sf):
    """G15 on held-out data: every observed (3-word context, next word)
    pair's next word scored by backoff over the stupid-backoff scores."""
    scores = S.sbo_scores(PL.ngram_counts(spark, sf, (1, 2, 3, 4), 5), 4)
    scores = scores.withColumn("word", F.when(F.col("n") == 1, F.col("pred")).otherwise(F.concat_ws("_", "w", "pred")))
    q = E.line_contexts(corpus.heldout_clean(spark, sf), 4).select("ctx", F.col("next_word").alias("option"))
    q = q.withColumn("words", F.filter(F.split("ctx", " "), lambda x: x != F.lit("")))
    r = P.score_options(q, scores, ["ctx"], "words", "option", 4)
    return r.select("ctx", "option", F.col("n").cast("long").alias("n"), r9(F.col("score")).alias("score"))


@query("freq_clusters", O.ctes(*_TRAIN, O.grams((1, 2, 3, 4)), O.counts(1, name="kcounts"), O.gt_table(),
                               O.heldout_clean(), O.pairs(3),
                               "fc AS (SELECT DISTINCT array_to_string(ws[pos - least(pos, 3) + 1 : pos], ' ') AS ctx FROM pairs WHERE pos > 0)",
                               "f4 AS (SELECT string_split(word, '_') AS p, pred, freq FROM kcounts WHERE n = 4)",
                               "ftab AS (SELECT lvl, h, pred, sum(freq) AS freq FROM ("
                               "SELECT 3 AS lvl, p[1] || '_' || p[2] || '_' || p[3] AS h, pred, freq FROM f4 UNION ALL "
                               "SELECT 2, p[2] || '_' || p[3], pred, freq FROM f4 UNION ALL SELECT 1, p[3], pred, freq FROM f4) z GROUP BY lvl, h, pred)",
                               "ftot AS (SELECT lvl, h, sum(freq) AS total FROM ftab GROUP BY lvl, h)",
                               "fh AS (SELECT ctx, lvl, array_to_string(cw[len(cw) - lvl + 1 : len(cw)], '_') AS h FROM ("
                               "SELECT ctx, list_filter(string_split(ctx, ' '), lambda x: x <> '') AS cw FROM fc) a, (SELECT unnest([1, 2, 3]) AS lvl) l "
                               "WHERE len(cw) >= lvl)",
                               "fb AS (SELECT fh.ctx, max(fh.lvl) AS lvl FROM fh JOIN ftot t ON t.lvl = fh.lvl AND t.h = fh.h GROUP BY fh.ctx)",
                               "fr AS (SELECT fh.ctx, fh.lvl, ft.pred, ft.freq, t.total, dense_rank() OVER (PARTITION BY fh.ctx ORDER BY ft.freq DESC) AS crank "
                               "FROM fh JOIN fb ON fb.ctx = fh.ctx AND fb.lvl = fh.lvl JOIN ftot t ON t.lvl = fh.lvl AND t.h = fh.h "
                               "JOIN ftab ft ON ft.lvl = fh.lvl AND ft.h = fh.h)") +
       " SELECT r.ctx, r.lvl, r.pred AS word, r.freq, round(CASE WHEN r.freq <= 5 THEN g.r_star ELSE r.freq END, 9) AS count, "
       "round(CASE WHEN r.freq <= 5 THEN g.r_star ELSE r.freq END / r.total * 100, 9) AS probability, CAST(r.crank AS BIGINT) AS crank "
       "FROM fr r LEFT JOIN gt g ON g.n = r.lvl + 1 AND g.r = r.freq WHERE r.crank <= 7")
def q_freq_clusters(spark, sf):
    """G16 + G17 for the three-word histories of held-out prefixes."""
    from sparkngram.operators.goodturing import gt_table
    counts = PL.ngram_counts(spark, sf, (1, 2, 3, 4), 1)
    gt = PL.materialize(gt_table(counts, (1, 2, 3, 4)))
    q = E.line_contexts(corpus.heldout_clean(spark, sf), 4).where(F.col("ctx") != "").select("ctx").distinct() \
        .withColumn("words", F.filter(F.split("ctx", " "), lambda x: x != F.lit("")))
    r = P.freq_clusters(q, counts, gt, ["ctx"], "words", 7, PL.kept, 2)
    return r.select("ctx", F.col("lvl").cast("int").alias("lvl"), "word", "freq", r9(F.col("count")).alias("count"),
                    r9(F.col("probability")).alias("probability"), F.col("crank").cast("long").alias("crank"))


# ---------------------------------------------------------------- published tables / files

import uuid as _uuid  # noqa: E402

from sparkngram.sources import store as SS  # noqa: E402


def _scratch(spark, name):
    return f"{SS.table_root(spark)}/{name}-{_uuid.uuid4().hex[:10]}"


@query("published_sbo", O.ctes(*_SBO, O.sbo_model()) + " SELECT w AS pre, pred AS word, round(score, 9) AS score, n, rnk FROM model")
def q_published_sbo(spark, sf):
    """Lookup table written partitioned by order and read back."""
    t = SS.publish_sbo(PL.sbo_lookup(spark, sf), _scratch(spark, "sbo"))
    return t.select("pre", "word", r9(F.col("score")).alias("score"), F.col("n").cast("long").alias("n"),
                    F.col("rnk").cast("long").alias("rnk"))


@query("published_katz", O.ctes(*_KATZ) +
       " SELECT n, w AS pre, pred AS word, round(prob, 9) AS prob, round(leftover, 9) AS leftover, freq, round(d, 9) AS d FROM kt "
       "UNION ALL SELECT 1, NULL, word, round(prob, 9), NULL, freq, round(d, 9) FROM ku")
def q_published_katz(spark, sf):
    """Katz tables (orders 1-3) in one order-partitioned table."""
    counts, gt = PL.katz_inputs(spark, sf, mat=True)
    t = SS.publish_katz(K.katz_tables(counts, gt, (2, 3)), K.katz_unigram(counts, gt), _scratch(spark, "katz"))
    return t.select(F.col("n").cast("long").alias("n"), "pre", "word", r9(F.col("prob")).alias("prob"),
                    r9(F.col("leftover")).alias("leftover"), "freq", r9(F.col("d")).alias("d"))


@query("csv_counts", O.ctes(*_TRAIN, O.grams((1, 2, 3)), O.counts(1)) + " SELECT word, freq FROM counts")
def q_csv_counts(spark, sf):
    """A4: count tables written as header-less blank-separated CSV and read
    back with strip-white / named columns."""
    path = _scratch(spark, "csv")
    SS.write_count_csv(PL.ngram_counts(spark, sf, (1, 2, 3), 1), path)
    return SS.read_count_csv(spark, path)


@query("text_round_trip", O.ctes(O.heldout_clean()) +
       " SELECT CAST(0 AS BIGINT) AS missing_after, CAST(0 AS BIGINT) AS extra_after, count(*) AS lines FROM hlines")
def q_text_round_trip(spark, sf):
    """Cleaned held-out lines written as text and read back unchanged."""
    lines = corpus.heldout_clean(spark, sf)
    return SS.text_round_trip(lines, _scratch(spark, "text"))


@query("summary_csv", O.ctes(_SRC_LINES) + " " + _SUMMARY_SQL.format(src="sl"))
def q_summary_csv(spark, sf):
    """A5: the corpus summary written to CSV with a header and read back."""
    lines = corpus.training_lines(spark, sf)
    return SS.write_csv(SM.corpus_summary(lines), _scratch(spark, "summary"))


@query("eval_katz_bench", O.ctes(*_KATZ, O.heldout_clean(), O.pairs(3),
                                 O.katz_predictions("(SELECT DISTINCT ctx FROM cpairs)", defaults=P.EVAL_DEFAULTS)) +
       " SELECT l.dataset AS list_name, l.line_count, l.word_count, CAST(coalesce(r.score, 0) AS BIGINT) AS score, "
       "CAST(coalesce(r.max_score, 0) AS BIGINT) AS max_score, CAST(coalesce(r.top3, 0) AS BIGINT) AS hit_count_top3, "
       "CAST(coalesce(r.top1, 0) AS BIGINT) AS hit_count_top1, CAST(coalesce(r.total, 0) AS BIGINT) AS total_count FROM "
       "(SELECT dataset, count(*) AS line_count, CAST(sum(len(list_filter(string_split(line, ' '), lambda x: x <> ''))) AS BIGINT) AS word_count "
       "FROM hlines GROUP BY dataset) l LEFT JOIN (SELECT dataset, sum(cnt * (4 - rk)) AS score, sum(cnt) * 3 AS max_score, "
       "sum(CASE WHEN rk < 4 THEN cnt ELSE 0 END) AS top3, sum(CASE WHEN rk = 1 THEN cnt ELSE 0 END) AS top1, sum(cnt) AS total "
       "FROM (SELECT c.dataset, c.cnt, coalesce(p.rnk, 4) AS rk FROM cpairs c LEFT JOIN kpreds p ON p.ctx = c.ctx AND p.word = c.next_word) q "
       "GROUP BY dataset) r ON l.dataset = r.dataset")
def q_eval_katz_bench(spark, sf):
    """G8 as the evaluation harness calls it, scored per dataset (H3)."""
    return PL.evaluate_katz_bench(spark, sf)


def _stop_sql() -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in FT.ENGLISH_STOP_WORDS)


@query("ttr_nostop", O.ctes(*_TRAIN, _DFM) +
       " SELECT doc_id, round(count(*) / sum(count), 9) AS ttr, count(*) AS types, CAST(sum(count) AS BIGINT) AS tokens "
       "FROM (SELECT doc_id, feature, sum(count) AS count FROM dfm WHERE feature NOT IN (" + _stop_sql() + ") "
       "GROUP BY doc_id, feature) d GROUP BY doc_id")
def q_ttr_nostop(spark, sf):
    """I9 as in the reference: type-token ratio per document with stop words
    (Spark's English list, D4) removed from the features first."""
    d = PL.train_dfm(spark, sf).groupBy("doc_id", "feature").agg(F.sum("count").alias("count"))
    d = FT.remove_listed_features(d, FT.stop_words(spark), "feature")
    t = ST.type_token_ratio(d, "doc_id")
    return t.select("doc_id", r9(F.col("ttr")).alias("ttr"), "types", "tokens")


@query("glob_features", O.ctes(*_TRAIN, _DFM) +
       " SELECT source, feature, CAST(sum(count) AS BIGINT) AS count FROM dfm WHERE feature LIKE 'th%' GROUP BY source, feature")
def q_glob_features(spark, sf):
    """Features matching ``th*`` with counts per source."""
    g = FT.select_by_glob_grouped(PL.train_dfm(spark, sf), "th*", "source")
    return g.select("source", "feature", F.col("count").cast("long").alias("count"))


@query("remove_globs", O.ctes(*_TRAIN, _DFM) +
       " SELECT doc_id, feature, CAST(sum(count) AS BIGINT) AS count FROM dfm "
       "WHERE NOT (feature LIKE '%ing' OR feature LIKE 'un%') GROUP BY doc_id, feature")
def q_remove_globs(spark, sf):
    """DFM without features matching ``*ing`` or ``un*``."""
    d = PL.train_dfm(spark, sf).groupBy("doc_id", "feature").agg(F.sum("count").alias("count"))
    r = FT.remove_by_globs(d, ["*ing", "un*"])
    return r.select("doc_id", "feature", F.col("count").cast("long").alias("count"))


@query("pad_capitalized", O.ctes(_NUMBERED_LINES) +
       " SELECT doc_id, line_no, array_to_string(list_transform(string_split(line, ' '), "
       "lambda x: CASE WHEN regexp_matches(x, '^[A-Z]') THEN x ELSE '' END), '|') AS padded FROM nl")
def q_pad_capitalized(spark, sf):
    """Raw blank-split tokens, those not starting with a capital letter
    replaced by '' (padding keeps positions)."""
    lines = corpus.training_lines(spark, sf)
    p = FT.pad_unmatched(F.split(F.col("line"), " "), "^[A-Z]")
    return lines.select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.array_join(p, "|").alias("padded"))


@query("substring_share", O.ctes(*_TRAIN, O.grams((3,)), O.counts(1)) +
       " SELECT word, freq, round(freq / sum(freq) OVER (), 9) AS share FROM counts WHERE contains(word, 'the_')")
def q_substring_share(spark, sf):
    """Trigrams containing a substring, with their share of the
    matching frequency (one-row total, broadcast)."""
    c = PL.ngram_counts(spark, sf, (3,), 1).where(F.col("word").contains("the_"))
    tot = c.agg(F.sum("freq").alias("_t"))
    return c.crossJoin(F.broadcast(tot)).select("word", "freq", r9(F.col("freq") / F.col("_t")).alias("share"))


@query("prefix_max", O.ctes(*_TRAIN, O.grams((2,)), O.counts(1)) +
       " SELECT w, min(pred) AS pred, max(freq) AS freq FROM (SELECT w, pred, freq, max(freq) OVER (PARTITION BY w) AS mx FROM counts) z "
       "WHERE freq = mx GROUP BY w")
def q_prefix_max(spark, sf):
    """Per bigram prefix, the continuation with the highest count
    (ties: first word); hot prefixes go through the split join."""
    from sparkngram.plans.joins import attach_group_totals
    c = PL.ngram_counts(spark, sf, (2,), 1).select("w", "pred", "freq")
    t = attach_group_totals(c, ["w"], [F.max("freq").alias("_mx")])
    return t.where(F.col("freq") == F.col("_mx")).groupBy("w").agg(F.min("pred").alias("pred"), F.max("freq").alias("freq"))


@query("prefix_filter", O.ctes(*_TRAIN, O.grams((2, 3)), O.counts(1)) +
       " SELECT n, word, freq FROM counts WHERE regexp_matches(word, '^the_')")
def q_prefix_filter(spark, sf):
    """N-grams whose name starts with a prefix regex (``^the_``)."""
    c = PL.ngram_counts(spark, sf, (2, 3), 1).where(F.col("word").rlike("^the_"))
    return c.select(F.col("n").cast("long").alias("n"), "word", "freq")


@query("first_lines", O.ctes(_HELD_NUMBERED) +
       f" SELECT dataset, src_id, line_no, {T.clean_eval_by('raw', 'dataset')} AS line FROM ("
       "SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY src_id, line_no) AS rn FROM hn) z WHERE rn <= 5")
def q_first_lines(spark, sf):
    """The first five held-out lines of each set (explicit order) - the
    quick-run subset of the evaluation harness."""
    from sparkngram.operators.sampling import first_k
    h = corpus.heldout_clean(spark, sf).withColumn("line_no", F.col("line_no").cast("long"))
    return first_k(h, "dataset", [F.col("src_id"), F.col("line_no")], 5).select("dataset", "src_id", "line_no", "line")


@query("eval_report_text", O.ctes(*_EVAL, O.sbo_predictions()) +
       " SELECT printf('%s: score %.2f %%, top-1 %.2f %%, top-3 %.2f %%, %d predictions', list_name, "
       "100.0 * score / max_score, 100.0 * hit_count_top1 / total_count, 100.0 * hit_count_top3 / total_count, total_count) AS report "
       "FROM (" + O.eval_report() + ") r")
def q_eval_report_text(spark, sf):
    """H6: the printed per-dataset report lines."""
    r = PL.evaluate_sbo(spark, sf)
    return r.select(F.format_string("%s: score %.2f %%, top-1 %.2f %%, top-3 %.2f %%, %d predictions", "list_name",
                                    F.lit(100.0) * F.col("score") / F.col("max_score"),
                                    F.lit(100.0) * F.col("hit_count_top1") / F.col("total_count"),
                                    F.lit(100.0) * F.col("hit_count_top3") / F.col("total_count"),
                                    "total_count").alias("report"))


@query("next_words", "SELECT ctx, word, CAST(rn AS BIGINT) AS rnk FROM (SELECT ctx, word, row_number() OVER "
       "(PARTITION BY ctx ORDER BY probability DESC, word) AS rn FROM (" + SQL["freq_clusters"] + ") z "
       "WHERE word NOT IN ('<EOS>', '<NUM>', 'NA')) y WHERE rn <= 3")
def q_next_words(spark, sf):
    """G18 + D13: the cluster predictor's words without marker words,
    first three per history."""
    from sparkngram.operators.features import drop_markers
    from sparkngram.operators.ngrams import top_by_group
    fc = QUERIES["freq_clusters"](spark, sf).where(drop_markers(F.col("word")))
    t = top_by_group(fc, ["ctx"], [F.col("probability").desc(), F.col("word").asc()], 3)
    return t.select("ctx", "word", F.col("rnk").cast("long").alias("rnk"))


# ---------------------------------------------------------------- general orders, merged form, sweep

from sparkngram.operators import katz_chain as KC  # noqa: E402


def _ctx(m: int) -> str:
    return (f"SELECT DISTINCT CASE WHEN pos = 0 THEN '' ELSE array_to_string(ws[pos - least(pos, {m - 1}) + 1 : pos], ' ') END AS ctx FROM pairs")


def _chain_model(counts: str, gt: str, order: int, by: str = "") -> str:
    """CTEs cw (weights) and ct (rows with probabilities) over counts(by, n, word, w, pred, freq)."""
    b, on = (f"{by}, ", lambda x, y: "".join(f"{x}.{c} = {y}.{c} AND " for c in by.split(", "))) if by else ("", lambda x, y: "")
    return (f"cr AS (SELECT {', '.join('c.' + c for c in by.split(', ')) + ', ' if by else ''}c.n, c.word, c.w, c.pred, c.freq, "
            f"c.freq * coalesce(g.discount, 1.0) AS fd FROM {counts} c "
            f"LEFT JOIN {gt} g ON {on('g', 'c')} g.n = c.n AND g.r = c.freq AND g.r BETWEEN 1 AND 5 WHERE c.n BETWEEN 2 AND {order}),\n"
            f"cs AS (SELECT {b}n, w, count(*) AS hits, sum(freq) AS sf, sum(fd) AS sfd FROM cr GROUP BY {b}n, w),\n"
            f"cl AS (SELECT {', '.join('a.' + c for c in by.split(', ')) + ', ' if by else ''}a.n, a.w, sum(l.fd) AS seen FROM cr a JOIN cr l ON {on('l', 'a')} "
            f"l.n = a.n - 1 AND l.word = regexp_replace(a.word, '^[^_]+_', '') GROUP BY ALL),\n"
            f"cx AS (SELECT s.*, 1 - s.sfd / s.sf AS lft, (z.sfd - coalesce(cl.seen, 0)) / z.sf AS rest FROM cs s "
            f"LEFT JOIN cl ON {on('cl', 's')} cl.n = s.n AND cl.w = s.w LEFT JOIN cs z ON {on('z', 's')} z.n = s.n - 1 AND z.w = regexp_replace(s.w, '^[^_]+_', '')),\n"
            f"cw AS (SELECT *, CASE WHEN rest > 1e-9 AND lft > 1e-9 THEN lft / rest ELSE 0.0 END AS alpha FROM cx),\n"
            f"ct AS (SELECT {', '.join('r.' + c for c in by.split(', ')) + ', ' if by else ''}r.n, r.w, r.pred, r.fd / s.sf AS prob, row_number() OVER (PARTITION BY "
            f"{', '.join('r.' + c for c in by.split(', ')) + ', ' if by else ''}r.n, r.w ORDER BY r.fd DESC, r.pred) AS rnk FROM cr r JOIN cs s ON {on('s', 'r')} s.n = r.n AND s.w = r.w)")


_GT4 = ("gt4 AS (SELECT n, r, coalesce((r + 1) * nx / nullif(r * n_r, 0), 1.0) AS discount FROM (SELECT n, r, n_r, lead(n_r) OVER (PARTITION BY n ORDER BY r) AS nx FROM ("
        "SELECT c.n, r.r, CAST(count(*) FILTER (WHERE c.freq = r.r) AS DOUBLE) AS n_r FROM counts c, (SELECT unnest(range(1, 7)) AS r) r GROUP BY c.n, r.r) z) y WHERE r <= 5)")


@query("predict_katz_order4", O.ctes(
    *_TRAIN, O.grams((1, 2, 3, 4)), O.counts(1), _GT4, _chain_model("counts", "gt4", 4), O.heldout_clean(), O.pairs(3),
    "gq AS (SELECT ctx, list_filter(string_split(ctx, ' '), lambda x: x <> '') AS c FROM (" + _ctx(4) + ") z WHERE ctx <> '')",
    "gl AS (SELECT ctx, lvl, lvl + 1 AS n, array_to_string(c[len(c) - lvl + 1 : len(c)], '_') AS w FROM (SELECT ctx, c, unnest(range(1, least(len(c), 3) + 1)) AS lvl FROM gq) z)",
    "ga AS (SELECT gl.ctx, gl.lvl, gl.n, gl.w, cw.alpha FROM gl JOIN cw ON cw.n = gl.n AND cw.w = gl.w)",
    "gs AS (SELECT a.ctx, a.lvl, a.n, a.w, coalesce((SELECT product(b.alpha) FROM ga b WHERE b.ctx = a.ctx AND b.lvl > a.lvl), 1.0) AS scale FROM ga a)",
    "gk AS (SELECT s.ctx, ct.pred, max(s.lvl) AS lvl, arg_max(ct.rnk, s.lvl) AS r, arg_max(ct.prob * s.scale, s.lvl) AS score FROM gs s "
    "JOIN ct ON ct.n = s.n AND ct.w = s.w WHERE ct.rnk <= 9 GROUP BY s.ctx, ct.pred)") +
    " SELECT ctx, CAST(rnk AS BIGINT) AS rnk, pred AS word, lvl AS level, round(score, 9) AS score FROM (SELECT *, row_number() OVER "
    "(PARTITION BY ctx ORDER BY lvl DESC, r) AS rnk FROM gk) z WHERE rnk <= 5")
def q_predict_katz_order4(spark, sf):
    """G12 for l = 4, k = 5: a chain of back-off weights from 4-grams to bigrams."""
    ctx = E.line_contexts(corpus.heldout_clean(spark, sf), 4).select("ctx").distinct().where("ctx <> ''")
    q = PL.materialize(ctx.withColumn("words", F.filter(F.split("ctx", " "), lambda x: x != F.lit(""))))
    p = KC.predict_chain(q, PL.katz_chain(spark, sf, 4, 5, P.asked_histories(q, "words", 4)), ["ctx"])
    return p.select("ctx", F.col("rnk").cast("long").alias("rnk"), "word", F.col("level").cast("long").alias("level"), r9(F.col("score")).alias("score"))


@query("predict_katz_merged", O.ctes(
    *_TRAIN, O.grams((1, 2, 3)), O.counts(1), _GT4,
    "mr AS (SELECT c.n, c.w, c.pred, c.freq, c.freq * coalesce(g.discount, 1.0) AS fd FROM counts c LEFT JOIN gt4 g ON g.n = c.n AND g.r = c.freq WHERE c.n >= 2)",
    "ml AS (SELECT n, w, 1 - sum(fd) / sum(freq) AS lft FROM mr GROUP BY n, w)",
    "mt AS (SELECT * FROM mr QUALIFY row_number() OVER (PARTITION BY n, w ORDER BY fd DESC, pred) <= 5)",
    O.heldout_clean(), O.pairs(3),
    "mq AS (SELECT ctx, list_filter(string_split(ctx, ' '), lambda x: x <> '') AS c FROM (SELECT DISTINCT ctx FROM cpairs) z)",
    "mv AS (SELECT ctx, lvl, least(len(c), 2) AS start, lvl + 1 AS n, array_to_string(c[len(c) - lvl + 1 : len(c)], '_') AS w FROM (SELECT ctx, c, unnest(range(1, least(len(c), 2) + 1)) AS lvl FROM mq) z)",
    "mh AS (SELECT v.ctx, v.lvl, v.start, t.pred, t.freq, t.fd FROM mv v JOIN mt t ON t.n = v.n AND t.w = v.w)",
    "mlo AS (SELECT v.ctx, l.lft FROM mv v JOIN ml l ON l.n = v.n AND l.w = v.w WHERE v.lvl = v.start)",
    "mo AS (SELECT h.*, mlo.lft, EXISTS (SELECT 1 FROM mh f WHERE f.ctx = h.ctx AND f.lvl = f.start AND f.pred = h.pred) AS given FROM mh h LEFT JOIN mlo ON mlo.ctx = h.ctx)",
    "mp AS (SELECT ctx, lvl, pred, CASE WHEN lvl = start OR lft IS NULL THEN 1.0 ELSE greatest(lft, 0.0) / (sum(CASE WHEN NOT given THEN fd END) OVER (PARTITION BY ctx, lvl) "
    "/ sum(freq) OVER (PARTITION BY ctx, lvl)) END * fd / sum(freq) OVER (PARTITION BY ctx, lvl) AS score FROM mo)",
    "mc AS (SELECT ctx, l.lvl, (SELECT count(DISTINCT pred) FROM mp WHERE mp.ctx = c.ctx AND mp.lvl >= l.lvl) AS c FROM (SELECT DISTINCT ctx FROM mp) c, (VALUES (1), (2)) l(lvl))",
    "ms AS (SELECT ctx, max(lvl) AS stop FROM mc WHERE c >= 5 GROUP BY ctx)",
    "mb AS (SELECT mp.ctx, pred, max(score) AS score, max(lvl) AS lvl, arg_max(lvl, coalesce(score, -1) * 1000 + lvl / 1e6) AS best FROM mp JOIN ms ON ms.ctx = mp.ctx WHERE mp.lvl >= ms.stop GROUP BY mp.ctx, pred)",
    "mk AS (SELECT ctx, pred, score, row_number() OVER (PARTITION BY ctx ORDER BY score DESC NULLS LAST, best DESC, pred) AS rnk FROM mb)") +
    " SELECT ctx, CAST(rnk AS BIGINT) AS rnk, pred AS word, round(score, 9) AS score FROM mk WHERE rnk <= 5 UNION ALL "
    f"SELECT ctx, 0, '{P.NO_MATCH}', NULL FROM mq WHERE ctx NOT IN (SELECT ctx FROM ms)")
def q_predict_katz_merged(spark, sf):
    """Levels re-scaled, merged and re-sorted by probability, five words or the message."""
    ctx = E.line_contexts(corpus.heldout_clean(spark, sf), 3).select("ctx").distinct()
    q = PL.materialize(ctx.withColumn("words", F.filter(F.split("ctx", " "), lambda x: x != F.lit(""))))
    # what a history leaves over hangs on its own n-grams alone
    counts = PL.ngram_counts(spark, sf, (1, 2, 3), 1)
    gt = PL.materialize(GT.gt_table(counts, (2, 3)))
    rows = KC.discounted(counts.join(P.asked_histories(q, "words", 3), ["n", "w"], "left_semi"), gt)
    p = KC.predict_merged(q, PL.materialize(rows.select("n", "w", "pred", "freq", "fd")), ["ctx"])
    return p.select("ctx", F.col("rnk").cast("long").alias("rnk"), "word", r9(F.col("score")).alias("score"))


SWEEP_ORDERS, SWEEP_FRACTIONS, SWEEP_TRIMS = (3, 4), (0.15, 0.25), (2, 5)


def _sweep_sql() -> str:
    fr = list(enumerate(SWEEP_FRACTIONS))
    marks = " ".join(f"WHEN u < {int(f * (1 << 32))} THEN {j}" for j, f in fr)
    cols = ", ".join(f"count(*) FILTER (WHERE mark <= {j}) AS f{j}" for j, _ in fr)
    cfg = " UNION ALL ".join(f"SELECT CAST({f} AS DOUBLE) AS fraction, CAST({t} AS INTEGER) AS trim, n, word, w, pred, f{j} AS freq FROM wc WHERE f{j} >= {t}"
                             for j, f in fr for t in SWEEP_TRIMS)
    nr = " UNION ALL ".join(f"SELECT CAST({f} AS DOUBLE) AS fraction, n, r.r, CAST(count(*) FILTER (WHERE f{j} = r.r) AS DOUBLE) AS n_r FROM wc, rr r GROUP BY n, r.r" for j, f in fr)
    grid = ", ".join(f"(CAST({f} AS DOUBLE), CAST({t} AS INTEGER))" for f in SWEEP_FRACTIONS for t in SWEEP_TRIMS)
    pairs = " UNION ALL ".join(
        f"SELECT CAST({m} AS INTEGER) AS ord, dataset, CASE WHEN pos = 0 THEN '' ELSE array_to_string(ws[pos - least(pos, {m - 1}) + 1 : pos], ' ') END AS ctx, "
        f"lower(next_word) AS next_word, count(*) AS cnt FROM pairs GROUP BY ALL" for m in SWEEP_ORDERS)
    top = max(SWEEP_ORDERS)
    return O.ctes(
        _SRC_LINES, "mk AS (SELECT line, CASE " + marks + " END AS mark FROM (SELECT line, CAST('0x' || substr(md5('1234|' || CAST(doc_id AS VARCHAR) || '|' || "
        "CAST(line_no AS VARCHAR)), 1, 8) AS BIGINT) AS u FROM sl) z)",
        f"tk AS (SELECT mark, {T.tokens(T.clean_train('line'))} AS t FROM mk WHERE mark IS NOT NULL)", O.grams(range(1, top + 1), src="tk", name="wg", extra="mark,"),
        f"wc AS (SELECT n, word, CASE WHEN n > 1 THEN regexp_replace(word, '_[^_]+$', '') ELSE '' END AS w, regexp_extract(word, '[^_]+$') AS pred, {cols} FROM wg GROUP BY n, word)",
        f"cfg AS ({cfg})", "rr AS (SELECT unnest(range(1, 7)) AS r)", f"nr AS ({nr})",
        f"sgt AS (SELECT fraction, t.trim, n, r, coalesce((r + 1) * nx / nullif(r * n_r, 0), 1.0) AS discount FROM (SELECT *, lead(n_r) OVER (PARTITION BY fraction, n ORDER BY r) AS nx FROM nr) z, "
        f"(VALUES {', '.join(f'(CAST({t} AS INTEGER))' for t in SWEEP_TRIMS)}) t(trim) WHERE r <= 5)",
        _chain_model("cfg", "sgt", top, "fraction, trim"),
        "bt AS (SELECT fraction, trim, n, w, pred, row_number() OVER (PARTITION BY fraction, trim, n, w ORDER BY freq DESC, pred) AS rnk FROM cfg WHERE n >= 2)",
        O.heldout_clean(), O.pairs(3), f"sp AS ({pairs})", f"gr(fraction, trim) AS (VALUES {grid})",
        "sq AS (SELECT ord, ctx, fraction, trim, list_filter(string_split(ctx, ' '), lambda x: x <> '') AS c FROM (SELECT DISTINCT ord, ctx FROM sp) z, gr)",
        f"sv AS (SELECT ord, ctx, fraction, trim, lvl, lvl + 1 AS n, array_to_string(c[len(c) - lvl + 1 : len(c)], '_') AS w FROM (SELECT *, unnest(range(1, least(len(c), {top - 1}) + 1)) AS lvl FROM sq) z)",
        "df AS (SELECT ord, ctx, fraction, trim, 0 AS lvl, d.r AS rnk, d.p AS pred FROM sq, (VALUES " + ", ".join(f"('{d}', {i + 1})" for i, d in enumerate(P.EVAL_DEFAULTS)) + ") d(p, r))",
        "cand AS (SELECT 'sbo' AS model, v.ord, v.ctx, v.fraction, v.trim, v.lvl, b.rnk, b.pred FROM sv v JOIN bt b ON b.fraction = v.fraction AND b.trim = v.trim AND b.n = v.n AND b.w = v.w WHERE b.rnk <= 3 "
        "UNION ALL SELECT 'katz', v.ord, v.ctx, v.fraction, v.trim, v.lvl, b.rnk, b.pred FROM sv v JOIN ct b ON b.fraction = v.fraction AND b.trim = v.trim AND b.n = v.n AND b.w = v.w WHERE b.rnk <= 5 "
        "UNION ALL SELECT m.m, df.* FROM df, (VALUES ('sbo'), ('katz')) m(m))",
        "kf AS (SELECT model, ord, ctx, fraction, trim, pred, max(lvl) AS lvl, arg_max(rnk, lvl) AS r FROM cand GROUP BY ALL)",
        "an AS (SELECT *, row_number() OVER (PARTITION BY model, ord, ctx, fraction, trim ORDER BY lvl DESC, r) AS rnk FROM kf QUALIFY rnk <= 3)",
        "ev AS (SELECT a.model, a.ord, a.fraction, a.trim, s.dataset, sum(s.cnt * (4 - a.rnk)) AS score, sum(s.cnt) AS top3, coalesce(sum(s.cnt) FILTER (WHERE a.rnk = 1), 0) AS top1 FROM sp s "
        "JOIN an a ON a.ord = s.ord AND a.ctx = s.ctx AND a.pred = s.next_word GROUP BY ALL)",
        "tt AS (SELECT m.m AS model, ord, fraction, trim, dataset, sum(cnt) AS total FROM sp, gr, (VALUES ('sbo'), ('katz')) m(m) GROUP BY ALL)") + (
        " SELECT tt.model, CAST(tt.ord AS BIGINT) AS model_order, tt.fraction, CAST(tt.trim AS BIGINT) AS trim, round(100 * avg(coalesce(score, 0) / (3 * total)), 6) AS overall_score_percent, "
        "round(100 * avg(coalesce(top3, 0) / total), 6) AS precision_top3, round(100 * avg(coalesce(top1, 0) / total), 6) AS precision_top1, "
        "round(100 * (1 - avg(coalesce(top1, 0) / total)), 6) AS word_error_rate, CAST(sum(total) AS BIGINT) AS number_of_predictions FROM tt LEFT JOIN ev "
        "ON ev.model = tt.model AND ev.ord = tt.ord AND ev.fraction = tt.fraction AND ev.trim = tt.trim AND ev.dataset = tt.dataset GROUP BY tt.model, tt.ord, tt.fraction, tt.trim")


@query("eval_sweep", _sweep_sql())
def q_eval_sweep(spark, sf):
    """H7: 2 orders x 2 nested samples x 2 trims x {stupid backoff, Katz}, a row each."""
    s = PL.sweep(spark, sf, SWEEP_ORDERS, SWEEP_FRACTIONS, SWEEP_TRIMS)
    return s.select("model", F.col("order").cast("long").alias("model_order"), "fraction", F.col("trim").cast("long").alias("trim"),
                    *[F.round(c, 6).alias(c) for c in ("overall_score_percent", "precision_top3", "precision_top1", "word_error_rate")], "number_of_predictions")


# ---------------------------------------------------------------- pairwise statistics, orders, files, event time

@query("doc_distances", O.ctes(*_TRAIN, _DFM,
                               "dd AS (SELECT doc_id, feature, CAST(sum(count) AS BIGINT) AS count FROM dfm GROUP BY doc_id, feature)",
                               "sq AS (SELECT doc_id, sum(count * count) AS sq FROM dd GROUP BY doc_id)",
                               "qs AS (SELECT DISTINCT doc_id AS query FROM documents WHERE lang = 'en' AND doc_id % 50 = 0)",
                               "dt AS (SELECT x.doc_id AS query, y.doc_id AS doc, sum(x.count * y.count) AS dot FROM dd x JOIN qs ON qs.query = x.doc_id "
                               "JOIN dd y ON y.feature = x.feature GROUP BY ALL)") +
       " SELECT qs.query, s.doc_id AS doc, round(sqrt(CAST(coalesce(a.sq, 0) + s.sq - 2 * coalesce(t.dot, 0) AS DOUBLE)), 9) AS distance "
       "FROM qs CROSS JOIN sq s LEFT JOIN sq a ON a.doc_id = qs.query LEFT JOIN dt t ON t.query = qs.query AND t.doc = s.doc_id")
def q_doc_distances(spark, sf):
    """Documents whose id is divisible by 50 against all documents."""
    d = PL.doc_features(spark, sf)
    q = corpus.table(spark, sf, "documents").where((F.col("lang") == "en") & (F.col("doc_id") % 50 == 0)).select("doc_id")
    return ST.pairwise_distance(d, q).select("query", "doc", r9(F.col("distance")).alias("distance"))


@query("cooccurrence_full", O.ctes(*_TRAIN, _DFM,
                                   "dd AS (SELECT doc_id, feature, CAST(sum(count) AS BIGINT) AS count FROM dfm GROUP BY doc_id, feature "
                                   "QUALIFY sum(sum(count)) OVER (PARTITION BY feature) >= 100)") +
       " SELECT a.feature AS f1, b.feature AS f2, CAST(sum(a.count * b.count) AS BIGINT) AS count FROM dd a JOIN dd b ON a.doc_id = b.doc_id AND a.feature < b.feature GROUP BY ALL")
def q_cooccurrence_full(spark, sf):
    """I6 for all features seen at least 100 times."""
    d = PL.doc_features(spark, sf)
    return ST.full_cooccurrence(d, "doc_id", 100)


@query("ordered_by_name", O.ctes(*_TRAIN, O.grams((1, 2)), O.counts(1)) +
       " SELECT n, word, freq, row_number() OVER (ORDER BY n, word) AS position FROM counts")
def q_ordered_by_name(spark, sf):
    """Per-source count tables re-aggregated in key order."""
    t = PL.train_tokens(spark, sf)
    per = NG.explode_ngrams(t, "tokens", (1, 2), keep=["source"]).groupBy("source", "n", "word").agg(F.count(F.lit(1)).alias("freq"))
    o = NG.ordered_counts([per], "name")
    return o.select(F.col("n").cast("long").alias("n"), "word", "freq", F.col("position").cast("long").alias("position"))


@query("ordered_by_freq", O.ctes(*_TRAIN, O.grams((1, 2, 3)), O.counts(1)) +
       " SELECT n, word, freq, row_number() OVER (ORDER BY freq DESC, n, word) AS position FROM counts")
def q_ordered_by_freq(spark, sf):
    """N-grams of orders 1 to 3 by frequency."""
    o = NG.ordered_counts([PL.ngram_counts(spark, sf, (n,), 1) for n in (1, 2, 3)], "freq", apart=True)
    return o.select(F.col("n").cast("long").alias("n"), "word", "freq", F.col("position").cast("long").alias("position"))


@query("file_docvars", "SELECT lang, source, count(*) AS lines, CAST(sum(len(line)) AS BIGINT) AS chars FROM ("
       "SELECT lang, source, unnest(string_split(text, chr(10))) AS line FROM documents WHERE source IS NOT NULL) z GROUP BY lang, source")
def q_file_docvars(spark, sf):
    """A10: lines written to files named by language and source, read back
    with both taken from the names."""
    docs = corpus.table(spark, sf, "documents").where("source is not null")
    # a carriage return would end a line of a text file: kept as a mark on the way
    lines = corpus.explode_lines(corpus.spread(docs.select("doc_id", "lang", "source", "text"), "doc_id"), "text", ["lang", "source"])
    path = _scratch(spark, "files")
    SS.write_named_files(lines.withColumn("line", F.translate("line", "\r", "\x1f")), path, ["lang", "source"], "~")
    back = SS.docvars_from_filenames(spark, path, ["lang", "source"], "~")
    return back.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("line")).alias("chars"))


@query("stream_windows", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS freq FROM events GROUP BY ALL")
def q_stream_windows(spark, sf):
    """K2 with event time: events per day and type from a stream with a watermark."""
    w = STR.stream_window_counts(spark, f"{sf}/events.parquet", "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
                                 "ts", ["event_type"], "1 day", "2 days")
    return w.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "freq")


@query("eval_report_hash", O.ctes(*_EVAL, O.sbo_predictions(), _HELD_NUMBERED.split("held AS", 1)[0] + "hraw AS (" + SQL["heldout_fingerprint"] + ")") +
       " SELECT r.*, h.hash FROM (" + O.eval_report() + ") r LEFT JOIN hraw h ON h.dataset = r.list_name")
def q_eval_report_hash(spark, sf):
    """H3 as the reference prints it: each set's report with its hash."""
    return E.hashed_report(PL.evaluate_sbo(spark, sf), corpus.heldout_lines(spark, sf))


@query("predict_backoff_freq", O.ctes(
    *_SBO, O.heldout_clean(), O.pairs(3),
    "bq AS (SELECT ctx, list_filter(string_split(ctx, ' '), lambda x: x <> '') AS c FROM (" + _ctx(4) + ") z)",
    "bl AS (SELECT ctx, lvl, lvl + 1 AS n, array_to_string(c[len(c) - lvl + 1 : len(c)], '_') AS w FROM (SELECT ctx, c, unnest(range(1, least(len(c), 3) + 1)) AS lvl FROM bq) z)",
    "bh AS (SELECT bl.ctx, bl.lvl, c.pred, c.freq, max(bl.lvl) OVER (PARTITION BY bl.ctx) AS best FROM bl JOIN counts c ON c.n = bl.n AND c.w = bl.w)",
    "br AS (SELECT ctx, pred, freq, row_number() OVER (PARTITION BY ctx ORDER BY freq DESC, pred) AS rnk FROM bh WHERE lvl = best)") +
    f" SELECT ctx, CAST(rnk AS BIGINT) AS rnk, pred AS word, freq FROM br WHERE rnk <= 5 UNION ALL SELECT ctx, 0, '{P.NO_MATCH}', NULL FROM bq WHERE ctx NOT IN (SELECT ctx FROM br)")
def q_predict_backoff_freq(spark, sf):
    """First hit from 4-grams down, five rows with their counts."""
    ctx = E.line_contexts(corpus.heldout_clean(spark, sf), 4).select("ctx").distinct()
    q = PL.materialize(ctx.withColumn("words", F.filter(F.split("ctx", " "), lambda x: x != F.lit(""))))
    p = P.first_hit_counts(q, PL.ngram_counts(spark, sf, (2, 3, 4), 5), ["ctx"])
    return p.select("ctx", F.col("rnk").cast("long").alias("rnk"), "word", "freq")


@query("textbook_sbo", O.ctes(*_TRAIN, O.grams((1, 2, 3, 4)), O.counts(1)) +
       " SELECT c.n, c.word, round(pow(0.4, 4 - c.n) * c.freq / p.freq, 9) AS score FROM counts c JOIN counts p ON p.n = c.n - 1 AND p.word = c.w "
       "UNION ALL SELECT n, word, round(pow(0.4, 3) * freq / sum(freq) OVER (), 9) FROM counts WHERE n = 1")
def q_textbook_sbo(spark, sf):
    """scores by the count of the prefix n-gram itself."""
    t = S.textbook_sbo(PL.ngram_counts(spark, sf, (1, 2, 3, 4), 1), 4)
    return t.select(F.col("n").cast("long").alias("n"), "word", r9(F.col("score")).alias("score"))


@query("published_old_layout", O.ctes(*_SBO, O.sbo_model()) + " SELECT w AS pre, pred AS word, n FROM model")
def q_published_old_layout(spark, sf):
    """The older lookup layout, read from the published table."""
    t = SS.old_layout(SS.publish_sbo(PL.sbo_lookup(spark, sf), _scratch(spark, "sbo")))
    return t.select("pre", "word", F.col("n").cast("long").alias("n"))


@query("suggest_by_prefix", O.ctes(
    *_TRAIN, O.grams((1, 2, 3, 4, 5)), O.counts(2), O.heldout_clean(), O.pairs(3),
    "xq AS (SELECT ctx, list_filter(string_split(lower(ctx), ' '), lambda x: x <> '') AS c FROM (" + _ctx(5) + ") z)",
    "xl AS (SELECT ctx, lvl, lvl + 1 AS n, array_to_string(c[len(c) - lvl + 1 : len(c)], '_') AS w FROM (SELECT ctx, c, unnest(range(1, least(len(c), 4) + 1)) AS lvl FROM xq) z)",
    "xt AS (SELECT n, w, pred, freq FROM counts WHERE n > 1 AND pred NOT IN (" + _stop_sql() + ") UNION ALL "
    "SELECT * FROM (SELECT n, '', word, freq FROM counts WHERE n = 1 ORDER BY freq DESC, word LIMIT 3) u WHERE word NOT IN (" + _stop_sql() + "))",
    "xc AS (SELECT xl.ctx, xl.lvl, t.pred, t.freq FROM xl JOIN xt t ON t.n = xl.n AND t.w = xl.w UNION ALL SELECT q.ctx, 0, t.pred, t.freq FROM xq q, xt t WHERE t.n = 1)",
    "xb AS (SELECT ctx, pred, max(lvl) AS lvl, arg_max(freq, lvl) AS freq FROM xc GROUP BY ctx, pred)") +
    " SELECT ctx, word, rnk FROM (SELECT ctx, pred AS word, row_number() OVER (PARTITION BY ctx ORDER BY lvl DESC, freq DESC, pred) AS rnk FROM xb) z WHERE rnk <= 3")
def q_suggest_by_prefix(spark, sf):
    """Words that 5- to 1-grams with the phrase's last words as prefix end in, stop words left out."""
    ctx = E.line_contexts(corpus.heldout_clean(spark, sf), 5).select("ctx").distinct()
    q = PL.materialize(ctx.withColumn("words", F.filter(F.split("ctx", " "), lambda x: x != F.lit(""))))
    p = P.suggest_by_prefix(q, PL.ngram_counts(spark, sf, (1, 2, 3, 4, 5), 2), FT.stop_words(spark), ["ctx"])
    return p.select("ctx", "word", F.col("rnk").cast("long").alias("rnk"))


@query("blocklist_file", SQL["blocklist_tokens"])
def q_blocklist_file(spark, sf):
    """A3 + D2: the block list read from a text file with blanks, repeats and
    carriage returns, then applied."""
    path = _scratch(spark, "list")
    spark.createDataFrame([(x,) for w in BLOCKLIST for x in (f"{w}  \r", w)] + [("\r",), ("",)], "value string").coalesce(1).write.text(path)
    words = FT.blocklist_from_lines(spark.read.text(path))
    t = FT.remove_listed_tokens(PL.train_tokens(spark, sf), "tokens", words, ["doc_id", "line_no"])
    return t.select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.array_join("tokens", " ").alias("tokens"))


@query("clean_input", O.ctes(_NUMBERED_LINES) + " SELECT doc_id, line_no, regexp_replace(regexp_replace(regexp_replace(lower(line), "
       "'[^a-zA-Z0-9[:space:]'']', '', 'g'), '^ {1,10}', ''), ' {2,10}', ' ', 'g') AS clean FROM nl")
def q_clean_input(spark, sf):
    """C14: the input cleaner of the interactive form."""
    return corpus.training_lines(spark, sf).select("doc_id", F.col("line_no").cast("long").alias("line_no"), C.clean_input(F.col("line")).alias("clean"))


@query("matching_whole_lines", O.ctes(O.train_lines()) +
       " SELECT DISTINCT line FROM lines WHERE contains(line, 'the') AND NOT regexp_matches(rtrim(line), '(\\.\\.\\.|\u2026)$')")
def q_matching_whole_lines(spark, sf):
    """B6 with its test for lines that were cut short."""
    return corpus.matching_lines(corpus.training_lines(spark, sf), "the", whole=True)
