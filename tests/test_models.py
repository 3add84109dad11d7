"""Golden values on the toy corpus and the micro Good-Turing table."""

import math

import pytest
from pyspark.sql import functions as F


def approx(a, b, tol=1e-6):
    return abs(a - b) <= tol


def test_toy_counts(toy_counts):
    got = {(r.n, r.word): r.freq for r in toy_counts.collect()}
    assert got[(1, "EOS")] == 8 and got[(1, "buy")] == 6 and got[(1, "house")] == 3
    assert got[(2, "SOS_buy")] == 6 and got[(2, "the_book")] == 5 and got[(2, "paint_the")] == 1
    assert got[(3, "buy_the_book")] == 4 and got[(3, "the_house_EOS")] == 3
    assert sum(1 for k in got if k[0] == 2) == 10 and sum(1 for k in got if k[0] == 3) == 9
    row = toy_counts.where("word = 'buy_the_house'").first()
    assert row.w == "buy_the" and row.pred == "house"


def test_stupid_backoff_scores(toy_counts):
    from sparkngram.operators.sbo import sbo_scores
    s = {(r.n, r.w, r.pred): r.score for r in sbo_scores(toy_counts, max_order=3).collect()}
    assert approx(s[(3, "buy_the", "book")], 4 / 6)  # factor 0.4^(3-3)=1
    x4 = {(r.n, r.w, r.pred): r.score for r in sbo_scores(toy_counts, max_order=4).collect()}
    assert approx(x4[(3, "buy_the", "book")], 0.266667)
    assert approx(x4[(3, "buy_the", "house")], 0.133333)
    assert approx(x4[(3, "the_book", "EOS")], 0.4)
    assert approx(x4[(2, "the", "book")], 0.1)
    assert approx(x4[(2, "the", "house")], 0.06)
    assert approx(x4[(1, "the", "the")], 0.2)


def test_sbo_prefix_sums_property(toy_counts):
    """Scores of one prefix sum to 0.4^(x-n)."""
    from sparkngram.operators.sbo import sbo_scores
    s = sbo_scores(toy_counts, max_order=4).where("n > 1").groupBy("n", "w").agg(F.sum("score").alias("s"))
    for r in s.collect():
        assert approx(r.s, 0.4 ** (4 - r.n))


def test_kneser_ney(toy_counts):
    from sparkngram.operators.kneserney import kn_bigram, kn_trigram
    b = {r.word: r.pkn for r in kn_bigram(toy_counts).collect()}
    assert approx(b["SOS_buy"], 0.6625) and approx(b["SOS_paint"], 0.0375)
    assert approx(b["buy_the"], 0.883333) and approx(b["paint_the"], 0.3)
    assert approx(b["the_book"], 0.525) and approx(b["the_house"], 0.275)
    assert approx(b["book_EOS"], 0.84) and approx(b["house_EOS"], 0.733333)
    t = {r.word: r.pkn for r in kn_trigram(toy_counts).collect()}
    golden = {"SOS_buy_the": 0.987037, "SOS_paint_the": 0.533333, "SOS_sell_the": 0.533333,
              "buy_the_book": 0.672222, "buy_the_house": 0.283333, "paint_the_house": 0.516667,
              "sell_the_book": 0.683333, "the_book_EOS": 0.978667, "the_house_EOS": 0.940741}
    for k, v in golden.items():
        assert approx(t[k], v), (k, t[k], v)


def _full_distribution(spark, toy_counts, h, g):
    from sparkngram.operators.absdisc import absdisc_distribution, absdisc_rest_coef
    hist = spark.createDataFrame([(h,)], "h string")
    dist = absdisc_distribution(toy_counts, hist, g, g).cache()
    d = dist.collect()
    coef = absdisc_rest_coef(dist).first().rest_coef
    explicit = {r.word: r.prob for r in d if r.kind != "rest"}
    uni = {r.word: r.freq for r in toy_counts.where("n = 1").collect()}
    full = {w: explicit.get(w, (coef or 0.0) * c) for w, c in uni.items()}
    rest_mass = [r.prob for r in d if r.kind == "rest"]
    return full, explicit, rest_mass


@pytest.mark.parametrize("g,golden", [
    (0.5, {"book": 0.5, "house": 0.357143, "EOS": 0.035714, "SOS": 0.035714, "the": 0.035714,
           "buy": 0.026786, "paint": 0.004464, "sell": 0.004464}),
    (0.6, {"book": 0.4, "house": 0.4, "EOS": 0.05, "SOS": 0.05, "the": 0.05, "buy": 0.0375,
           "paint": 0.00625, "sell": 0.00625}),
])
def test_absdisc_sell_the(spark, toy_counts, g, golden):
    full, explicit, rest_mass = _full_distribution(spark, toy_counts, "sell_the", g)
    for w, p in golden.items():
        assert approx(full[w], p), (w, full[w], p)
    assert approx(sum(full.values()), 1.0)
    assert approx(sum(explicit.values()) + rest_mass[0], 1.0)


def test_absdisc_buy_the_and_argmax(spark, toy_counts):
    from sparkngram.operators.absdisc import absdisc_argmax
    full, _, _ = _full_distribution(spark, toy_counts, "buy_the", 0.5)
    golden = {"book": 0.583333, "house": 0.25, "EOS": 0.041667, "buy": 0.03125, "paint": 0.005208}
    for w, p in golden.items():
        assert approx(full[w], p)
    hist = spark.createDataFrame([("buy_the",), ("sell_the",)], "h string")
    best = {r.h: (r.word, r.prob) for r in absdisc_argmax(toy_counts, hist, 0.5, 0.5).collect()}
    assert best["buy_the"][0] == "book" and approx(best["buy_the"][1], 0.583333)
    assert best["sell_the"][0] == "book" and approx(best["sell_the"][1], 0.5)


def test_good_turing_micro(spark):
    from sparkngram.operators.goodturing import gt_from_nr
    nr = spark.createDataFrame([(1, r, float(v)) for r, v in [(1, 100), (2, 40), (3, 20), (4, 10), (5, 8), (6, 6)]],
                               "n int, r int, n_r double")
    got = {r.r: r for r in gt_from_nr(nr).collect()}
    for r, d in [(1, 0.8), (2, 0.75), (3, 0.666667), (4, 1.0), (5, 0.9)]:
        assert approx(got[r].discount, d)
    for r, rs in [(1, 0.6875), (2, 1.21875), (3, 1.4375), (4, 4.0), (5, 4.21875)]:
        assert approx(got[r].r_star, rs)


def test_katz_prefix(spark):
    """One prefix with freq 10, 5, 2, 1 and the micro discounts."""
    from sparkngram.operators.katz import katz_tables
    counts = spark.createDataFrame([(2, "x", f"w{f}", f) for f in (10, 5, 2, 1)], "n int, w string, pred string, freq long")
    gt = spark.createDataFrame([(2, r, d) for r, d in [(1, 0.8), (2, 0.75), (3, 0.666667), (4, 1.0), (5, 0.9)]],
                               "n int, r int, discount double")
    t = {r.pred: r for r in katz_tables(counts, gt, (2,)).collect()}
    for p, v in [("w10", 0.555556), ("w5", 0.25), ("w2", 0.083333), ("w1", 0.044444)]:
        assert approx(t[p].prob, v)
    assert approx(t["w10"].leftover, 0.066667)
    assert approx(sum(r.prob for r in t.values()) + t["w1"].leftover, 1.0)
    assert not math.isnan(t["w1"].leftover)


# ---------------------------------------------------------------- word-level absolute discounting, one hot last word

def _brute_absdisc(counts, h, g2, g3):
    """The whole distribution of one history, word by word as defined."""
    one = {w: f for (n, w), f in counts.items() if n == 1}
    two = {w: f for (n, w), f in counts.items() if n == 2}
    three = {w: f for (n, w), f in counts.items() if n == 3}
    b = h.split("_")[-1]
    seen = {w.split("_")[2]: f for w, f in three.items() if w.rsplit("_", 1)[0] == h}
    after = {w.split("_")[1]: f for w, f in two.items() if w.split("_")[0] == b}
    p = {c: (f - g3) / two[h] for c, f in seen.items()}
    alpha3 = 1 - sum(p.values()) if seen else 1.0
    alpha2 = 1 - sum(f - g2 for f in after.values()) / one[b] if after else 0.0
    pool = sum(f for c, f in one.items() if c not in after and c not in seen)
    q = {c: (after[c] - g2) / one[b] if c in after else alpha2 * one[c] / pool for c in one if c not in seen}
    return p | {c: alpha3 * v / sum(q.values()) for c, v in q.items()}


def test_absdisc_words_and_argmax_with_a_hot_last_word(spark):
    """One last word follows and precedes a third of the text; no join makes histories x its continuations."""
    import random
    from collections import Counter
    from sparkngram.operators import absdisc as A
    from sparkngram.operators.ngrams import count_ngrams
    from pyspark.sql import functions as F
    r = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    lines = [" ".join(x for _ in range(12) for x in (["the"] if r.random() < .33 else []) + [words[min(int(r.expovariate(.08)), 59)]]) for _ in range(250)]
    counts = count_ngrams(spark.createDataFrame([(t,) for t in lines], "line string").select(F.split("line", " ").alias("tokens")), "tokens", (1, 2, 3)).cache()
    table = {(x.n, x.word): x.freq for x in counts.collect()}
    hs = sorted({w for (n, w) in table if n == 2 and w.endswith("_the")})[:40] + ["w1_w2", "w0_w50", "w58_w59", "the_w0"]
    hs = [h for h in hs if (2, h) in table]
    hist = spark.createDataFrame([(h,) for h in hs], "h string")
    want = {h: _brute_absdisc(table, h, .5, .5) for h in hs}
    req = spark.createDataFrame([(h, w) for h in hs for w in [*words, "the", "never"]], "h string, word string")
    df = A.absdisc_probability(counts, req)
    got = {(x.h, x.word): x.prob for x in df.collect()}
    for h in hs:
        assert got[h, "never"] is None
        for w, p in want[h].items():
            assert got[h, w] == pytest.approx(p, abs=1e-12)
    masses = Counter()
    for x in A.absdisc_masses(counts, hist).collect():
        masses[x.h] += x.mass
    assert all(masses[h] == pytest.approx(1) for h in hs)
    for short in (256, 3):  # 3: the exact path of histories that have seen all of the first rows
        best = {x.h: (x.word, x.prob) for x in A.absdisc_argmax(counts, hist, short=short).collect()}
        for h in hs:
            p = max(want[h].values())
            assert best[h][1] == pytest.approx(p) and best[h][0] == min(w for w, v in want[h].items() if v > p - 1e-12)


def test_katz_chain_weights_sum_to_one(spark):
    """G12's model: what a history gives its own words and, through the weight, the shorter history's others is one."""
    import random
    from sparkngram.operators.katz_chain import KatzChain, predict_chain
    from sparkngram.operators.ngrams import count_ngrams
    from sparkngram.operators.goodturing import gt_table
    from pyspark.sql import functions as F
    r = random.Random(9)
    lines = [" ".join(f"w{min(int(r.expovariate(.15)), 40)}" for _ in range(15)) for _ in range(300)]
    counts = count_ngrams(spark.createDataFrame([(t,) for t in lines], "line string").select(F.split("line", " ").alias("tokens")), "tokens", (1, 2, 3, 4)).cache()
    gt = gt_table(counts, (2, 3, 4))
    gt = gt.withColumn("discount", F.least("discount", F.lit(0.9))).cache()  # every order holds something back
    m = KatzChain(counts, gt, 4, 5)
    d = {(x.n, x.r): x.discount for x in gt.collect() if x.r and x.r <= 5}
    fd = {(x.n, x.word): x.freq * d.get((x.n, x.freq), 1.0) for x in counts.where("n > 1").collect()}
    sf, own = {}, {}
    for x in counts.where("n > 1").collect():
        sf[x.n, x.w] = sf.get((x.n, x.w), 0) + x.freq
        own.setdefault((x.n, x.w), {})[x.pred] = fd[x.n, x.word]
    alpha = {(x.n, x.w): x.alpha for x in m.weights.collect()}
    for (n, w), words in own.items():
        if n > 2 and alpha[n, w] > 0:
            low = w.split("_", 1)[1]
            mass = sum(words.values()) / sf[n, w] + alpha[n, w] * sum(v for c, v in own[n - 1, low].items() if c not in words) / sf[n - 1, low]
            assert mass == pytest.approx(1)

    def p(n, w, c):
        if (n, w) not in own:
            return p(n - 1, w.split("_", 1)[1], c) if n > 2 else None
        if c in own[n, w]:
            return own[n, w][c] / sf[n, w]
        return alpha[n, w] * p(n - 1, w.split("_", 1)[1], c) if n > 2 else None

    q = spark.createDataFrame([(i, t.split()[:3]) for i, t in enumerate(lines[:60])] + [(60, ["w0"]), (61, []), (62, ["never", "w1"])], "id int, words array<string>")
    for x in predict_chain(q, m, ["id"]).collect():
        words = q.where(f"id = {x.id}").first().words if x.id >= 60 else lines[x.id].split()[:3]
        assert x.score == pytest.approx(p(len(words) + 1, "_".join(words), x.word))


def test_chain_of_asked_histories_answers_like_the_whole_model(spark, toy_counts):
    """The rows of histories that no phrase backs off through are left out of
    the model before anything is joined; the answers are the same."""
    from pyspark.sql import functions as F

    from sparkngram.operators import katz_chain as KC
    from sparkngram.operators import predict as P
    from sparkngram.operators.goodturing import gt_table
    gt = gt_table(toy_counts, (1, 2, 3))
    q = spark.createDataFrame([("buy the",), ("zzz the",), ("book",), ("nothing known",)], "ctx string").withColumn("words", F.split("ctx", " "))
    sizes, answers = [], []
    for histories in (None, P.asked_histories(q, "words", 3)):
        model = KC.KatzChain(toy_counts, gt, 3, 2, histories=histories)
        sizes.append(model.weights.count())
        answers.append(sorted(map(tuple, KC.predict_chain(q, model, ["ctx"]).select("ctx", "rnk", "word", "level", F.round("score", 12)).collect())))
    assert answers[0] == answers[1] and answers[0] and sizes[1] == 3 < sizes[0]


def test_katz_model_of_asked_contexts_answers_like_the_whole_model(spark, toy_counts):
    from pyspark.sql import functions as F

    from sparkngram.operators import katz as K
    from sparkngram.operators import predict as P
    from sparkngram.operators.goodturing import gt_table
    gt = gt_table(toy_counts, (1, 2, 3))
    q = spark.createDataFrame([("buy the",), ("zzz the",), ("sell the",), ("book",), ("nothing known",)], "ctx string").withColumn("words", F.split("ctx", " "))
    models = [K.KatzModel(toy_counts, gt, 2, histories=h) for h in (None, P.asked_histories(q, "words", 3))]
    answers = [sorted(map(tuple, K.predict_katz(q, m, ["ctx"], k=2).select("ctx", "rnk", "word", "level", F.round("score", 12)).collect())) for m in models]
    assert answers[0] == answers[1] and answers[0] and models[1].stats.count() < models[0].stats.count()


def test_clusters_bring_a_history_together_once(spark, toy_counts):
    """Histories of no phrase are gone before sums, totals and ranks, none of
    which deals the rows anew."""
    from pyspark.sql import functions as F

    from sparkngram.operators import predict as P
    from sparkngram.operators.goodturing import gt_table
    q = spark.createDataFrame([("a b c",)], "ctx string").withColumn("words", F.split("ctx", " "))
    counts = spark.createDataFrame([(4, "a_b_c_d", 3), (4, "x_b_c_e", 2), (4, "u_v_w_x", 9)], "n int, word string, freq long").withColumn("pred", F.substring_index("word", "_", -1))
    r = P.freq_clusters(q, counts, gt_table(toy_counts, (1, 2, 3)), ["ctx"])
    assert [(x.lvl, x.word, x.freq, x.crank) for x in r.collect()] == [(3, "d", 3, 1)]
    assert "LeftSemi" in r._jdf.queryExecution().optimizedPlan().toString()


def test_clusters_by_level_and_part(spark, toy_counts):
    """Levels one after the other, histories in parts, tables kept in between:
    the rows are those of the definition."""
    import random

    from pyspark.sql import functions as F

    from sparkngram.operators import predict as P
    from sparkngram.operators.goodturing import gt_table
    from sparkngram.plans import pipeline as PL
    rnd = random.Random(3)
    grams = {"_".join(rnd.choice("abcdef") for _ in range(4)): rnd.randint(1, 9) for _ in range(300)}
    phrases = sorted({" ".join(rnd.choice("abcdefxy") for _ in range(rnd.randint(1, 5))) for _ in range(150)})
    want = set()
    for ctx in phrases:
        words = ctx.split()
        for lvl in (3, 2, 1):
            tab = {}
            for g, f in grams.items():
                if len(words) >= lvl and g.split("_")[3 - lvl:3] == words[-lvl:]:
                    tab[g[-1]] = tab.get(g[-1], 0) + f
            if tab:
                ranks = {f: i + 1 for i, f in enumerate(sorted(set(tab.values()), reverse=True))}
                want |= {(ctx, lvl, p, f, ranks[f], round(100 * f / sum(tab.values()), 6) if f > 5 else None) for p, f in tab.items() if ranks[f] <= 3}
                break
    assert {r[1] for r in want} == {1, 2, 3}
    q = spark.createDataFrame([(p,) for p in phrases], "ctx string").withColumn("words", F.split("ctx", " "))
    counts = spark.createDataFrame([(4, g, g[-1], f) for g, f in grams.items()], "n int, word string, pred string, freq long")
    for more in ((), (PL.kept, 3)):
        r = P.freq_clusters(q, counts, gt_table(toy_counts, (1, 2, 3)), ["ctx"], "words", 3, *more).collect()
        assert {(x.ctx, x.lvl, x.word, x.freq, x.crank, round(x.probability, 6) if x.freq > 5 else None) for x in r} == want and len(r) == len(want)


def test_thinned_rows_hold_all_wanted_keys_and_few_others(spark):
    from pyspark.sql import functions as F

    from sparkngram.plans.joins import thin
    rows = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id")).alias("h"), "id")
    wanted = rows.where("id % 100 = 7").select("h")
    for bits, most in ((1 << 16, 400), (1 << 6, 20_000), (1 << 20, 220)):
        kept = {r.id for r in thin(rows, ["h"], wanted, bits).collect()}
        assert {i for i in range(20_000) if i % 100 == 7} <= kept and len(kept) <= most
    assert thin(rows, ["h"], wanted.limit(0)).count() == 0


def test_runs_that_share_nothing_are_shuffled_once(spark):
    from sparkngram.operators import ngrams as NG
    runs = [spark.createDataFrame(rows, "n int, word string, freq long") for rows in ([(1, "b", 3), (1, "a", 3)], [(2, "a_b", 5)])]
    both = [sorted(NG.ordered_counts(runs, "freq", apart=a).collect(), key=lambda r: r.position) for a in (False, True)]
    assert both[0] == both[1] and [r.word for r in both[1]] == ["a_b", "a", "b"] and [r.position for r in both[1]] == [1, 2, 3]


def test_absdisc_counts_for_histories(spark):
    """The counts that a history hangs on give what all counts give."""
    from sparkngram.operators import absdisc as A
    from sparkngram.operators.ngrams import count_ngrams
    lines = ["a b c", "a b d", "a b c", "x b e", "b c a", "c c d a b", "d a b e"]
    df = spark.createDataFrame([(x.split(),) for x in lines], "tokens array<string>")
    counts = count_ngrams(df, "tokens", (1, 2, 3)).cache()
    hist = spark.createDataFrame([("a_b",), ("c_d",), ("q_b",), ("q_q",)], "h string")
    few = A.for_histories(counts, hist).cache()
    assert {(r.n, r.w) for r in few.where("n > 1").collect()} <= {(3, "a_b"), (3, "c_d"), *((2, w) for w in "abcdq")}
    assert few.where("n > 1").count() < counts.where("n > 1").count()
    req = hist.crossJoin(counts.where("n = 1").select("word"))
    for f in (lambda c: A.absdisc_masses(c, hist), lambda c: A.absdisc_argmax(c, hist), lambda c: A.absdisc_probability(c, req),
              lambda c: A.observed(c, hist)):
        assert sorted(map(str, f(few).collect())) == sorted(map(str, f(counts).collect()))


def test_merged_katz_keeps_rows_of_asked_histories_only(spark, monkeypatch):
    from sparkngram.plans import pipeline as PL
    from sparkngram.plans import registry
    kept = []
    whole = PL.materialize
    monkeypatch.setattr(PL, "materialize", lambda d: kept.append(whole(d)) or kept[-1])
    registry.QUERIES["predict_katz_merged"](spark, "/root/testdata/sf0.001")
    ctx, rows = (next(t for t in kept if c in t.columns) for c in ("ctx", "fd"))
    asked = {(i + 1, "_".join(r.words[-i:])) for r in ctx.collect() for i in (1, 2) if len(r.words) >= i}
    assert {(r.n, r.w) for r in rows.select("n", "w").distinct().collect()} <= asked


def test_orders_beyond_the_staged_sets_take_one_trimmed_pass(spark, tmp_path, monkeypatch):
    from sparkngram.plans import pipeline as PL
    docs = [(i, "blogs", "en", t) for i, t in enumerate(["one two three four five six"] * 2 + ["one two three four five seven"])]
    spark.createDataFrame(docs, "doc_id long, source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    made, stage = [], PL.ST.stage
    monkeypatch.setattr(PL.ST, "stage", lambda *a, **k: made.append(stage(*a, **k)) or made[-1])
    got = {(r.n, r.word): r.freq for r in PL.ngram_counts(spark, str(tmp_path), (1, 2, 3, 4, 5), 2).collect()}
    assert got[5, "one_two_three_four_five"] == 3 and got[5, "two_three_four_five_six"] == 2 and got[1, "six"] == 2
    assert min(got.values()) == 2 and len(got) == 6 + 5 + 4 + 3 + 2
    assert len(made) == 1 and made[0].count() == len(got)


def test_options_meet_the_scores_in_one_join(spark, toy_counts):
    """The highest order that is there scores an option; one that is nowhere,
    or is asked twice, keeps one row, without a second join of the requests."""
    from sparkngram.operators.predict import score_options
    from sparkngram.operators.sbo import sbo_scores
    scores = sbo_scores(toy_counts, max_order=4)
    scores = scores.withColumn("word", F.when(F.col("n") == 1, F.col("pred")).otherwise(F.concat_ws("_", "w", "pred")))
    asked = [("buy the", "book"), ("buy the", "book"), ("buy the", "moon"), ("red the", "book"), ("", "the"), ("", "moon"), ("red", "the")]
    q = spark.createDataFrame(asked, "ctx string, option string").withColumn("words", F.filter(F.split("ctx", " "), lambda x: x != F.lit("")))
    r = score_options(q, scores.localCheckpoint(), ["ctx"], "words", "option", 4)
    assert r._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    got = {(x.ctx, x.option): (x.n, None if x.score is None else round(x.score, 6)) for x in r.collect()}
    assert r.count() == len(got) == 6
    assert got == {("buy the", "book"): (3, 0.266667), ("buy the", "moon"): (None, None), ("red the", "book"): (2, 0.1),
                   ("", "the"): (1, 0.2), ("", "moon"): (None, None), ("red", "the"): (1, 0.2)}


def test_absdisc_words_in_parts(spark):
    """Histories dealt by their last word, each part on its own counts, which
    hold no bigram twice: the probabilities of all at once."""
    import random

    from sparkngram.operators import absdisc as A
    from sparkngram.operators.ngrams import count_ngrams
    from sparkngram.plans import pipeline as PL
    rnd = random.Random(11)
    lines = [[rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9))] for _ in range(80)]
    counts = PL.kept(count_ngrams(spark.createDataFrame([(x,) for x in lines], "tokens array<string>"), "tokens", (1, 2, 3)))
    ask = PL.kept(spark.createDataFrame(sorted({(f"{rnd.choice('abcdefghz')}_{rnd.choice('abcdefghz')}", rnd.choice("abcdefghzy")) for _ in range(120)}), "h string, word string"))
    show = lambda p: sorted((r.h, r.word, r.kind or "", round(r.prob or -1, 9)) for r in p.collect())
    want = show(A.absdisc_probability(counts, ask))
    got, rows = [], 0
    for part in A.in_parts(ask, 3):
        own = A.for_histories(counts, part, PL.kept)
        assert own.count() == own.distinct().count() and 0 < own.where("n = 2").count() < counts.where("n = 2").count()
        got += show(A.absdisc_probability(own, part))
        rows += own.where("n = 3").count()
        PL.dropped(own)
    assert sorted(got) == want and rows == counts.where("n = 3").join(ask.selectExpr("h AS w").distinct(), "w", "left_semi").count()


def test_sweep_keeps_sums_of_one_configuration_at_a_time(spark):
    """Each model, order and configuration is answered by itself and leaves a
    row per held-out set; the figures are those of a lazy plan."""
    import random

    from sparkngram.operators import sweep as SW
    from sparkngram.plans import pipeline as PL
    rnd = random.Random(2)
    lines = [(i, 0, [rnd.choice("abcde") for _ in range(8)]) for i in range(200)]
    nested = PL.kept(SW.nested_counts(spark.createDataFrame(lines, "doc_id long, line_no int, tokens array<string>"), (1, 2, 3), (0.5, 0.9)))
    held = PL.kept(spark.createDataFrame([(rnd.choice(["x", "y"]), " ".join(rnd.choice("abcdef") for _ in range(6))) for _ in range(40)], "dataset string, line string"))
    sums = []

    def store(df):
        out = PL.kept(df)
        if "top3" in out.columns:
            sums.append(out.count())
        return out

    kept = SW.sweep(nested, held, (2, 3), (0.5, 0.9), (1, 2), ("sbo", "katz"), store=store).collect()
    assert len(sums) == 16 and 0 < max(sums) <= 2
    assert len(kept) == 16 and {r.number_of_predictions for r in kept} == {200} and all(0 < r.precision_top3 <= 100 for r in kept)
    show = lambda rows: sorted((r.order, r.fraction, r.trim, round(r.overall_score_percent, 6), r.number_of_predictions) for r in rows if r.model == "sbo")
    assert show(SW.sweep(nested, held, (2, 3), (0.5, 0.9), (1, 2), ("sbo",)).collect()) == show(kept)
