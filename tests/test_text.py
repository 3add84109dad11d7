"""Cleaning rules, sentence splitting and ranking on hand-made inputs."""

from pyspark.sql import functions as F


def run(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_clean_train_rules(spark):
    from sparkngram.functions import clean as C
    out = run(spark, C.clean_train, ["Don't STOP 123 me_now", "café au lait", "the b c d end", "soooo good", "we oops"])
    assert out[0] == "dont stop menow"
    assert out[1] == "caf au lait"
    assert out[2] == "the    end"           # each single letter after a blank becomes a blank
    assert out[3] == "so good"              # 3+ repeats squeezed
    assert out[4] == "we ps"                # doubled start letters dropped (kept as the reference does)


def test_clean_query_order_differs(spark):
    from sparkngram.functions import clean as C
    # pattern rules run before lower-casing in the query cleaner
    assert run(spark, C.clean_query, ["I saw U.S. news"]) == ["i saw u s news"]
    assert run(spark, C.clean_train, ["I saw U.S. news"]) == ["i saw us news"]


def test_clean_eval(spark):
    from sparkngram.functions import clean as C
    df = spark.createDataFrame([("see http://x.com/a now", "tweets"), ("wait... what?! 42", "blogs")], "x string, d string")
    out = [r[0] for r in df.select(C.clean_eval_by(F.col("x"), F.col("d"))).collect()]
    assert out == ["see", "wait what"]


def test_split_sentence(spark):
    from sparkngram.operators.evaluate import split_sentence
    df = spark.createDataFrame([(1, "i love the game"), (2, "its ok now"), (3, "hello"), (4, "")], "id int, line string")
    rows = sorted((r.id, r.pos, r.prefix, r.next_word) for r in split_sentence(df, ["id"]).collect())
    assert rows == [(1, 0, "", "i"), (1, 1, "i ", "love"), (1, 2, "i love ", "the"),
                    (2, 0, "", "its"), (2, 1, "its ", "ok")]


def test_rank_and_score(spark):
    from sparkngram.operators.evaluate import dataset_report, rank_pairs
    pairs = spark.createDataFrame([("d", "ctx", "on", 1), ("d", "ctx", "zzz", 1)],
                                  "dataset string, ctx string, next_word string, cnt long")

    def predictor(ctx):
        words = spark.createDataFrame([(1, "the"), (2, "on"), (3, "a")], "rnk int, word string")
        return ctx.select("ctx").crossJoin(words)

    ranked = {r.next_word: r["rank"] for r in rank_pairs(pairs, predictor).collect()}
    assert ranked == {"on": 2, "zzz": 4}
    lines = spark.createDataFrame([("d", "x y z")], "dataset string, line string")
    rep = dataset_report(rank_pairs(pairs, predictor), lines).first()
    assert rep.score == 2 and rep.max_score == 6 and rep.hit_count_top3 == 1 and rep.hit_count_top1 == 0


def test_global_rank(spark):
    from sparkngram.operators.ranking import global_rank
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("v")).repartition(7)
    got = sorted((r.v, r.rank) for r in global_rank(df, [F.col("v").desc()]).collect())
    assert got == [(v, 1000 - v) for v in range(1000)]


def test_ngram_orders_short_lines(spark):
    from sparkngram.operators.ngrams import count_ngrams
    df = spark.createDataFrame([(["a", "b"],), ([],), (["c"],)], "tokens array<string>")
    got = sorted((r.n, r.word) for r in count_ngrams(df, "tokens", (1, 2, 3)).collect())
    assert got == [(1, "a"), (1, "b"), (1, "c"), (2, "a_b")]


def test_stop_words_and_unk(spark):
    from sparkngram.operators.features import remove_listed_tokens, stop_words, unk_tokens, vocabulary
    df = spark.createDataFrame([(1, ["the", "cat", "and", "the", "hat"]), (2, ["a", "dog"]), (3, [])],
                               "id int, tokens array<string>")
    sw = stop_words(spark)
    out = {r.id: r.tokens for r in remove_listed_tokens(df, "tokens", sw, ["id"]).collect()}
    assert out == {1: ["cat", "hat"], 2: ["dog"], 3: []}
    vocab = vocabulary(df, "tokens", 2)  # only "the" appears twice
    got = {r.id: r.tokens for r in unk_tokens(df, ["id"], "tokens", vocab).collect()}
    assert got == {1: ["the", "UNK", "UNK", "the", "UNK"], 2: ["UNK", "UNK"], 3: []}


def test_list_removal_has_one_result_for_all_list_lengths(spark):
    """Rows that share keys and tokens stay rows, by the literal set and by the join."""
    from sparkngram.operators.features import remove_listed_tokens
    rows = [(1, ["a", "b", "a"], "x"), (1, ["a", "b", "a"], "x"), (1, ["b"], "y"), (2, [], None), (3, None, "z"), (None, ["c", None, "b"], "q")]
    df = spark.createDataFrame(rows, "id int, tokens array<string>, other string")
    words = spark.createDataFrame([("b",), ("b",), (None,), ("nothere",)], "word string")
    want = sorted([(1, ["a", "a"], "x"), (1, ["a", "a"], "x"), (1, [], "y"), (2, [], None), (3, None, "z"), (None, ["c", None], "q")], key=repr)
    for most in (50_000, 0):
        got = remove_listed_tokens(df, "tokens", words, ["id"], inline_max=most)
        assert got.columns == df.columns and sorted(map(tuple, got.collect()), key=repr) == want


def test_whole_lines_only(spark):
    from sparkngram.sources.corpus import matching_lines
    df = spark.createDataFrame([("the end",), ("the end...",), ("the end\u2026 ",), ("none",), ("the end",)], "line string")
    assert [r.line for r in matching_lines(df, "the", whole=True).collect()] == ["the end"]


def test_windows_count_what_every_order_counts(spark):
    """One row per position to the shuffle gives the counts of all orders,
    of rows shorter than an order too."""
    from pyspark.sql import functions as F

    from sparkngram.operators import ngrams as NG
    rows = [("a b c d a b c",), ("a",), ("",), ("a b",), ("b ab b ab b",), ("é b c",), ("a b",)]
    df = spark.createDataFrame(rows, "line string").select(F.filter(F.split("line", " "), lambda x: x != "").alias("tokens"))
    for orders in ((1, 2, 3, 4), (1,), (2, 3), (3,), (1, 5)):
        plain = NG.count_ngrams(df, "tokens", orders).select("n", "word", "freq")
        windows = NG.count_windows(df, "tokens", orders)
        assert sorted(windows.collect()) == sorted(plain.collect()), orders


def test_staged_counts_send_one_row_per_position(spark, tmp_path):
    """The staged table holds no column that its n-grams spell out already,
    and order 4 is counted only for queries that read it."""
    from sparkngram.plans import pipeline as PL
    from sparkngram.sources import store
    spark.createDataFrame([(0, "the red fox and the red dog", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    made, stage = [], store.stage
    store.stage = lambda *a, **b: made.append(stage(*a, **b)) or made[-1]
    try:
        rows = {(r.n, r.w, r.pred): r.freq for r in PL.ngram_counts(spark, str(tmp_path), (1, 2, 3)).collect()}
        PL.ngram_counts(spark, str(tmp_path), (1, 4))
    finally:
        store.stage = stage
    assert rows[2, "the", "red"] == 2 and rows[3, "the_red", "dog"] == 1 and {n for n, _, _ in rows} == {1, 2, 3}
    assert [sorted(m.columns) for m in made] == [["freq", "n", "word"]] * 2 and [m.where("n = 4").count() for m in made] == [0, 4]


def test_trimmed_windows_keep_what_the_trim_keeps(spark):
    """An n-gram's total may come with a longer one that the trim drops; any
    number of partitions gives the same rows."""
    from pyspark.sql import functions as F

    from sparkngram.operators import ngrams as NG
    rows = [("a b a c",), ("a b b",), ("a b c d e",), ("a b c d f",), ("a b c e",), ("a",), ("c d",), ("c d e",)]
    df = spark.createDataFrame(rows, "line string").select(F.split("line", " ").alias("tokens"))
    for orders in ((1, 2, 3, 4), (2, 3, 4), (1, 2, 3, 4, 5), (3, 4), (1, 2)):
        for least in (1, 2, 3, 4):
            plain = NG.count_ngrams(df, "tokens", orders, min_freq=least).select("n", "word", "freq")
            windows = NG.count_windows(df, "tokens", orders, min_freq=least, partitions=7 if least == 2 else None)
            assert sorted(windows.collect()) == sorted(plain.collect()), (orders, least)


def test_trimmed_queries_stage_only_what_the_trim_keeps(spark, tmp_path):
    """Without a whole table there, a trimmed request neither sorts nor writes the
    rest; with one, it reads that."""
    from sparkngram.plans import pipeline as PL
    from sparkngram.sources import store
    spark.createDataFrame([(0, "the red fox and the red dog", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    made, stage = [], store.stage
    store.stage = lambda *a, **b: made.append(stage(*a, **b)) or made[-1]
    try:
        trimmed = PL.ngram_counts(spark, str(tmp_path), (1, 2, 3, 4), 2).collect()
        whole = PL.ngram_counts(spark, str(tmp_path), (1, 2, 3, 4), 1).collect()
        again = PL.ngram_counts(spark, str(tmp_path), (1, 2, 3, 4), 2).collect()
    finally:
        store.stage = stage
    assert sorted(trimmed) == sorted(again) == sorted(r for r in whole if r.freq >= 2) and len(trimmed) == 3
    assert [m.count() for m in made] == [3, 19, 19]


def test_counting_takes_more_partitions_for_larger_input(spark, tmp_path):
    """The windows of one task stay in bounds whatever the session's number of partitions is."""
    from sparkngram.plans import pipeline as PL
    from sparkngram.sources import store
    spark.createDataFrame([(i, "the red fox", "en", "s", 1) for i in range(50)], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    size, here = store.input_bytes(spark, [f"{tmp_path}/documents.parquet"]), int(spark.conf.get("spark.sql.shuffle.partitions"))
    was, PL.BYTES_PER_TASK = PL.BYTES_PER_TASK, 1 + size // (here + 9)
    try:
        want = PL.count_partitions(spark, [f"{tmp_path}/documents.parquet"])
        assert here < want <= here + 9
        assert PL.ngram_counts(spark, str(tmp_path), (1, 2), 5).count() == 5
    finally:
        PL.BYTES_PER_TASK = was
    assert PL.count_partitions(spark, [f"{tmp_path}/documents.parquet"]) is None


def test_windows_clean_each_line_once(spark):
    """Rows without tokens are left out without a filter that would do the cleaning a second time."""
    from pyspark.sql import functions as F

    from sparkngram.operators import ngrams as NG
    lines = spark.createDataFrame([("the red fox",), ("",), (" ",), (None,), ("the red",)], "line string")
    tokens = lines.select(F.filter(F.split(F.regexp_replace("line", r"\s+", " "), " "), lambda x: x != "").alias("tokens"))
    windows = NG.count_windows(tokens, "tokens", (2, 3))
    assert windows._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
    assert sorted(windows.collect()) == [(2, "red_fox", 1), (2, "the_red", 2), (3, "the_red_fox", 1)]


def test_document_frequency_by_windows(spark):
    """Each n-gram once per row: windows against the direct form, also where
    words start like others and where a row ends inside a window; a long row
    takes no time that grows with its square."""
    import random
    import time
    from sparkngram.operators import ngrams as NG
    rnd = random.Random(5)
    vocab = ["a", "ab", "abc", "b", "bc", "c", "A", "a1", "z"]
    rows = [[rnd.choice(vocab) for _ in range(rnd.randint(0, 14))] for _ in range(200)] + [[], ["a"], ["a", "a"], ["a", "b", "a", "b"]]
    df = spark.createDataFrame([(r,) for r in rows], "tokens array<string>")
    for orders in ((1, 2, 3), (2,), (1,), (2, 4)):
        want = {}
        for r in rows:
            for g in {(n, "_".join(r[i:i + n])) for n in orders for i in range(len(r) - n + 1)}:
                want[g] = want.get(g, 0) + 1
        for made in (NG.count_windows(df, "tokens", orders, once=True), NG.count_windows(df, "tokens", orders, once=True, partitions=7),
                     NG.count_ngrams(df, "tokens", orders, doc_freq=True)):
            assert {(r.n, r.word): r.freq for r in made.collect()} == want
    some = NG.count_windows(df, "tokens", (1, 2, 3), once=True, min_freq=20)
    assert {(r.n, r.word) for r in some.collect()} == {(r.n, r.word) for r in NG.count_ngrams(df, "tokens", (1, 2, 3), True, 20).collect()} != set()
    long = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(40_000)), lambda i: F.concat(F.lit("w"), i)).alias("tokens"))
    for count in (lambda: NG.count_windows(long, "tokens", (1, 2, 3), once=True), lambda: NG.count_ngrams(long, "tokens", (1, 2, 3), True)):
        start = time.time()
        assert count().count() == 119_997
        assert time.time() - start < 20
