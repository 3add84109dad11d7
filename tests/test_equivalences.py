"""Optimised forms equal their direct definitions."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _random_lines(n=60, seed=7):
    rnd = random.Random(seed)
    vocab = ["a", "i", "b", "bb", "cc", "oops", "aab", "the", "sooo", "eel", "x", "zzz", "word", "ok", "ab"]
    return [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 12))) for _ in range(n)]


def test_per_word_query_cleaning_matches_prefix_cleaning(spark):
    from sparkngram.functions import clean as C
    from sparkngram.operators.evaluate import context_pairs, line_contexts, split_sentence
    lines = spark.createDataFrame([("d", i, 0, l) for i, l in enumerate(_random_lines())],
                                  "dataset string, src_id int, line_no int, line string")
    direct = context_pairs(split_sentence(lines, ["dataset", "src_id", "line_no"]), 3,
                           words=C.tokens(C.clean_query(F.col("prefix"))))
    fast = line_contexts(lines, 3, words_fn=C.clean_query_words)
    a = sorted(tuple(r) for r in direct.collect())
    b = sorted(tuple(r) for r in fast.collect())
    assert a == b and len(a) > 100


def test_line_contexts_match_split_sentence(spark):
    from sparkngram.operators.evaluate import context_pairs, line_contexts, split_sentence
    lines = spark.createDataFrame([("d", i, 0, l) for i, l in enumerate(_random_lines(seed=3))],
                                  "dataset string, src_id int, line_no int, line string")
    for m in (2, 3, 4):
        a = sorted(tuple(r) for r in context_pairs(split_sentence(lines, ["dataset", "src_id", "line_no"]), m).collect())
        b = sorted(tuple(r) for r in line_contexts(lines, m).collect())
        assert a == b


def test_hash_rank_matches_row_number(spark):
    from sparkngram.operators.sampling import hash_key, hash_rank
    df = spark.range(0, 3000).select((F.col("id") % 3).cast("string").alias("source"), F.col("id").alias("doc_id"),
                                     F.lit(0).alias("line_no"))
    fast = hash_rank(df, "source", ["doc_id", "line_no"], bucket_chars=2)
    w = Window.partitionBy("source").orderBy(hash_key("1234", ["doc_id", "line_no"]), "doc_id", "line_no")
    direct = df.withColumn("r", F.row_number().over(w))
    a = sorted((r.source, r.doc_id, r.hrank) for r in fast.collect())
    b = sorted((r.source, r.doc_id, r.r) for r in direct.collect())
    assert a == b


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="fixtures not present")
def test_stream_counts_equal_batch(spark):
    from sparkngram.plans import pipeline as PL
    from sparkngram.streaming.scoring import stream_ngram_counts
    sf = "/root/testdata/sf0.001"
    s = stream_ngram_counts(spark, f"{sf}/documents.parquet",
                            "doc_id long, text string, lang string, source string, n_chars long", "text",
                            orders=(1, 2), where="lang = 'en'")
    b = PL.ngram_counts(spark, sf, (1, 2), 1).select("n", "word", "freq")
    assert s.select("n", "word", "freq").exceptAll(b).count() == 0
    assert b.exceptAll(s.select("n", "word", "freq")).count() == 0
