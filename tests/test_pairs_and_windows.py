"""Pairwise statistics with hot features and long documents, event-time windows,
and count tables compacted between two runs of a stream."""

import math
import os
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkngram.operators import stats as ST
from sparkngram.streaming import scoring as STR


@pytest.fixture(scope="module")
def long_dfm(spark):
    """A third of all rows belong to one feature, and one document holds every feature."""
    r = random.Random(1)
    rows = [(i, "the", 1 + i % 3) for i in range(90)]
    rows += [(i, f"f{j}", r.randint(1, 3)) for i in range(60) for j in r.sample(range(70), 2)]
    rows += [(1000, f"f{j}", 1 + j % 4) for j in range(70)] + [(1001, "alone", 2)]
    return rows, spark.createDataFrame(rows, "doc_id long, feature string, count long").cache()


@pytest.mark.parametrize("block,hot", [(1000, None), (7, 10)])
def test_pairwise_distance(spark, long_dfm, block, hot):
    rows, d = long_dfm
    docs = {}
    for i, f, c in rows:
        docs.setdefault(i, Counter())[f] = c
    asked = [0, 50, 1000, 7777]  # one has no rows at all: an empty document
    got = {(x.query, x.doc): x.distance for x in ST.pairwise_distance(
        d, spark.createDataFrame([(i,) for i in asked], "q long"), block=block, hot_rows=hot).collect()}
    want = {(a, b): math.sqrt(sum((docs.get(a, Counter())[f] - docs[b][f]) ** 2 for f in {*docs.get(a, {}), *docs[b]})) for a in asked for b in docs}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


@pytest.mark.parametrize("least,pairs,block", [(1, 1, 256), (3, 1, 5), (1, 4, 5)])
def test_full_cooccurrence(long_dfm, least, pairs, block):
    rows, d = long_dfm
    total = Counter()
    for _, f, c in rows:
        total[f] += c
    want, docs = Counter(), {}
    for i, f, c in rows:
        if total[f] >= least:
            docs.setdefault(i, []).append((f, c))
    for fs in docs.values():
        for f, c in fs:
            for g, e in fs:
                if f < g:
                    want[f, g] += c * e
    got = {(x.f1, x.f2): x["count"] for x in ST.full_cooccurrence(d, "doc_id", least, pairs, block).collect()}
    assert got == {k: v for k, v in want.items() if v >= pairs}


def test_full_cooccurrence_shuffles_no_pairs(spark):
    # 40 documents of the same 300 features: 44,850 pairs, whose partial sums made 8 times as many rows before
    d = spark.range(40).select(F.col("id").alias("doc"), F.explode(F.sequence(F.lit(0), F.lit(299))).alias("f"))
    d = d.select("doc", F.format_string("w%03d", "f").alias("feature"), (F.col("f") % 3 + 1).cast("long").alias("count"))
    out = ST.full_cooccurrence(d, "doc", block=64)
    assert "keys=[f1" not in out._jdf.queryExecution().toString()
    got = out.agg(F.count(F.lit(1)).alias("n"), F.sum("count").alias("s"), F.sum((F.col("f1") >= F.col("f2")).cast("int")).alias("bad")).first()
    x = [i % 3 + 1 for i in range(300)]
    assert tuple(got) == (300 * 299 // 2, 40 * (sum(x) ** 2 - sum(v * v for v in x)) // 2, 0)


def add(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_counts_across_a_compaction_that_is_interrupted(spark, tmp_path, monkeypatch):
    src, work = str(tmp_path / "in"), str(tmp_path / "work")

    def run(*lines):
        add(spark, src, [(t,) for t in lines], "text string")
        return {r.word: r.freq for r in STR.stream_ngram_counts(spark, src, "text string", "text", orders=(1,), work=work).collect()}

    def table():
        return {r.word: r.freq for r in STR.read_counts(spark, f"{work}/deltas").collect()}

    assert run("red blue", "red") == {"red": 2, "blue": 1}
    # the job dies after it wrote the base, before the marker
    with monkeypatch.context() as m:
        m.setattr(STR.store, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            STR.compact_counts(spark, work)
    assert table() == {"red": 2, "blue": 1}
    assert {r.word: r.freq for r in STR.compact_counts(spark, work).collect()} == {"red": 2, "blue": 1}
    # a second run goes on from the base
    assert run("red green") == {"red": 3, "blue": 1, "green": 1}
    # the job dies after the marker, before it removed what the base holds
    real, left = STR._children, []
    with monkeypatch.context() as m:
        def children(spark_, path):
            names = real(spark_, path)
            if path.endswith("/deltas") and STR._base(spark_, work)[0] > 0 and not left:
                left.append(names)
                raise RuntimeError("lost")
            return names
        m.setattr(STR, "_children", children)
        with pytest.raises(RuntimeError):
            STR.compact_counts(spark, work)
    assert left and table() == {"red": 3, "blue": 1, "green": 1}
    assert {r.word: r.freq for r in STR.compact_counts(spark, work).collect()} == table() == {"red": 3, "blue": 1, "green": 1}
    assert not [n for n in os.listdir(f"{work}/deltas") if n.startswith("batch=")]
    assert run("blue") == {"red": 3, "blue": 2, "green": 1}


def test_windows_follow_late_rows_until_the_watermark(spark, tmp_path):
    src, work, schema = str(tmp_path / "in"), str(tmp_path / "work"), "ts timestamp, kind string"
    day = datetime(2024, 1, 1)

    def run(*rows):
        add(spark, src, [(day + timedelta(days=d), k) for d, k in rows], schema)
        w = STR.stream_window_counts(spark, src, schema, "ts", ["kind"], "1 day", "2 days", work=work)
        return {((r.window_start - day).days, r.kind): r.freq for r in w.collect()}

    assert run((0, "a"), (0.5, "a"), (1, "b")) == {(0, "a"): 2, (1, "b"): 1}
    # late by a day: the window is still open; a second run on the same folder
    assert run((0.2, "a"), (9, "a")) == {(0, "a"): 3, (1, "b"): 1, (9, "a"): 1}
    # the watermark is at day 7 now: a row of day 0 comes too late
    assert run((0.3, "a"), (8, "b")) == {(0, "a"): 3, (1, "b"): 1, (9, "a"): 1, (8, "b"): 1}


def test_ordered_counts_merge_runs(spark):
    from sparkngram.operators.ngrams import ordered_counts
    a = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (2, "a_b", 5)], "n int, word string, freq long")
    b = spark.createDataFrame([(1, "c", 1), (1, "b", 1)], "n int, word string, freq long")
    assert [tuple(r) for r in ordered_counts([a, b], "name").orderBy("position").collect()] == [(1, "a", 2, 1), (1, "b", 3, 2), (1, "c", 1, 3), (2, "a_b", 5, 4)]
    assert [tuple(r) for r in ordered_counts([a, b], "freq").orderBy("position").collect()] == [(2, "a_b", 5, 1), (1, "b", 3, 2), (1, "a", 2, 3), (1, "c", 1, 4)]


def test_document_variables_from_file_names(spark, tmp_path):
    from sparkngram.sources import store
    lines = spark.createDataFrame([("en", "blogs", "one"), ("en", "blogs", "two"), ("de", "my news", "drei"), ("de", "my news", "")], "lang string, source string, line string")
    store.write_named_files(lines, str(tmp_path / "out"), ["lang", "source"])
    (tmp_path / "out" / "fi_tweets.txt").write_text("yksi\n")
    (tmp_path / "out" / "plain.txt").write_text("x\n")
    got = sorted(((r.lang, r.source, r.line) for r in store.docvars_from_filenames(spark, str(tmp_path / "out")).collect()), key=str)
    assert got == sorted([("en", "blogs", "one"), ("en", "blogs", "two"), ("de", "my news", "drei"), ("de", "my news", ""), ("fi", "tweets", "yksi"), ("plain", None, "x")], key=str)


def test_merged_katz_form(spark):
    """G11 on a table where merging re-sorts and stops early."""
    from sparkngram.operators.katz_chain import predict_merged
    rows = [(3, "a_b", "x", 4, 2.0), (3, "a_b", "y", 4, 4.0), (2, "b", "x", 5, 5.0), (2, "b", "u", 90, 90.0), (2, "b", "v", 3, 3.0), (2, "b", "w", 2, 1.0),
            (3, "c_d", "p", 1, 0.5)]
    df = spark.createDataFrame(rows, "n int, w string, pred string, freq long, fd double")
    q = spark.createDataFrame([(1, ["a", "b"]), (2, ["c", "d"]), (3, ["b"]), (4, [])], "id int, words array<string>")
    got = {}
    for r in predict_merged(q, df, ["id"]).collect():
        got.setdefault(r.id, []).append((r.rnk, r.word, r.score))
    left = 1 - 6 / 8
    scale = left / (94 / 100)
    want = sorted([("y", .5), ("x", .25), ("u", scale * .9), ("v", scale * .03), ("w", scale * .01)], key=lambda t: -t[1])
    assert [(w, pytest.approx(s)) for w, s in want] == [(w, s) for _, w, s in sorted(got[1])]
    assert [w for _, w, _ in got[2]] == [w for _, w, _ in got[3]] == [w for _, w, _ in got[4]] == ["Sorry! Cannot Find it!"]


def test_pairwise_distance_shuffles_no_pairs(spark):
    """Pairs are made where a block of queries meets one of documents: no
    shuffle comes after, however many features two documents share."""
    from pyspark.sql import functions as F

    from sparkngram.operators import stats as ST
    d = spark.range(60).select(F.col("id").alias("doc_id"), F.explode(F.array(*[F.lit(f"w{i}") for i in range(20)])).alias("feature"))
    d = d.where("(doc_id * 7 + cast(substr(feature, 2) as int)) % 3 > 0").withColumn("count", F.col("doc_id") % 5 + 1)
    q = spark.createDataFrame([(i,) for i in (0, 10, 20, 999)], "q long")
    out = ST.pairwise_distance(d, q, block=7)
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert "MapInArrow" in plan[0] and sum("Aggregate" in x for x in plan[:4]) == 0
    rows = {}
    for r in d.collect():
        rows.setdefault(r.doc_id, {})[r.feature] = r["count"]
    want = {(a, b): sum((rows.get(a, {}).get(f, 0) - rows[b].get(f, 0)) ** 2 for f in {*rows.get(a, {}), *rows[b]}) ** 0.5 for a in (0, 10, 20, 999) for b in rows}
    got = {(r.query, r.doc): r.distance for r in out.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want) and out.count() == len(want)


def test_full_cooccurrence_cells_read_columns_and_shuffle_nothing(spark):
    """Five blocks of features are 15 cells: as many tasks at least, and no
    document is copied for them."""
    d = spark.range(40).select(F.col("id").alias("doc"), F.explode(F.sequence(F.lit(0), F.lit(299))).alias("f"))
    d = d.select("doc", F.format_string("w%03d", "f").alias("feature"), (F.col("f") % 3 + 1).cast("long").alias("count"))
    out = ST.full_cooccurrence(d, "doc", block=64)
    assert out.rdd.getNumPartitions() >= 15
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 15 and "Repartition" not in plan.replace("Repartition 1, false", "") and "cell" not in plan


def test_pairwise_distance_copies_no_document(spark):
    """Blocks of documents meet blocks of queries without a shuffle of either,
    however many blocks there are; several to a batch and ids that are names."""
    import random
    rnd = random.Random(4)
    rows = [(f"d{i}", f"w{rnd.randint(0, 30)}", rnd.randint(1, 4)) for i in range(90) for _ in range(rnd.randint(0, 12))]
    d = spark.createDataFrame(rows, "doc_id string, feature string, count long").groupBy("doc_id", "feature").agg(F.sum("count").alias("count"))
    q = spark.createDataFrame([(f"d{i}",) for i in range(0, 90, 3)] + [("none",)], "q string")
    out = ST.pairwise_distance(d, q, block=7)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" in plan and "Repartition" not in plan and "Sort" not in plan
    have = {}
    for a, f, c in rows:
        have.setdefault(a, Counter())[f] += c
    got = {(r["query"], r["doc"]): r["distance"] for r in out.collect()}
    asked = [r[0] for r in q.collect()]
    assert got.keys() == {(a, b) for a in asked for b in have} and out.count() == len(got)
    assert all(abs(got[a, b] - sum((have.get(a, Counter())[f] - have[b][f]) ** 2 for f in {*have.get(a, ()), *have[b]}) ** 0.5) < 1e-9 for a, b in got)
