"""Staged tables (A6): made once per inputs and parameters, safe against lost attempts."""

import os

from pyspark.sql import functions as F

from sparkngram.sources import store


def write(spark, path, words):
    spark.createDataFrame([(w,) for w in words], "word string").coalesce(1).write.mode("append").parquet(path)


def test_stage_is_made_once_and_follows_inputs_and_parameters(spark, tmp_path):
    src, root, made = str(tmp_path / "in"), str(tmp_path / "root"), []
    write(spark, src, ["a", "b", "a"])

    def run(least=1):
        def build():
            made.append(least)
            return spark.read.parquet(src).groupBy("word").count().where(F.col("count") >= least)
        return {r.word: r["count"] for r in store.stage(spark, "counts", [src], {"least": least}, build, root=root).collect()}

    assert run() == run() == {"a": 2, "b": 1} and made == [1]
    assert run(2) == {"a": 2} and made == [1, 2]
    write(spark, src, ["b", "c"])
    assert run() == {"a": 2, "b": 2, "c": 1} and made == [1, 2, 1]


def test_attempt_without_marker_is_ignored(spark, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "root")
    write(spark, src, ["a"])

    def read():
        return store.stage(spark, "t", [src], {}, lambda: spark.read.parquet(src), root=root)

    assert read().count() == 1
    folder = next((tmp_path / "root" / "stages").iterdir())
    # a job died while it wrote: data, no marker
    os.remove(folder / "_COMMITTED")
    for crc in folder.glob("._COMMITTED.crc"):
        os.remove(crc)
    write(spark, str(folder / "attempt-dead"), ["x", "y"])
    assert [r.word for r in read().collect()] == ["a"]
    # a second job that wrote at the same time does not replace what is committed
    before = store.committed(spark, str(folder))
    write(spark, str(folder / "attempt-late"), ["z"])
    store._commit(spark, str(folder), "attempt-late")
    assert store.committed(spark, str(folder)) == before and [r.word for r in read().collect()] == ["a"]


def test_training_queries_share_one_count_table(spark, tmp_path):
    """The second query's plan reads no documents."""
    from sparkngram.plans import pipeline as PL
    sf = str(tmp_path)
    spark.createDataFrame([(0, "the red fox and the red dog", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{sf}/documents.parquet")
    first = {(r.n, r.word): r.freq for r in PL.ngram_counts(spark, sf, (1, 2)).collect()}
    assert first[1, "the"] == 2 and first[2, "the_red"] == 2
    for df in (PL.sbo_lookup(spark, sf, 4, 1), PL.ngram_counts(spark, sf, (3,), 1), PL.katz_inputs(spark, sf)[0]):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "documents.parquet" not in plan and "PartitionFilters" in plan
    assert PL.ngram_counts(spark, sf, (5,)).count() == 3


def test_documents_are_counted_once_for_all_stages_of_a_session(spark, tmp_path):
    """The folder of the stages stays where it is, so the second call finds the first one's table."""
    from sparkngram.plans import pipeline as PL
    from sparkngram.session import ensure_checkpoint_dir
    spark.createDataFrame([(0, "red fox ran", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    made, tokens = [], PL.train_tokens
    PL.train_tokens = lambda *a: made.append(a) or tokens(*a)
    try:
        assert [PL.ngram_counts(spark, str(tmp_path), (n,)).count() for n in (1, 2, 3)] == [3, 2, 1] and len(made) == 1
    finally:
        PL.train_tokens = tokens
    assert ensure_checkpoint_dir(spark) == ensure_checkpoint_dir(spark) and store.table_root(spark) == store.table_root(spark)


def test_counting_passes_let_go_of_their_shuffle_files(spark, tmp_path, monkeypatch):
    """Whole counts come pass by pass, none of which finds the windows of
    those before it on disk, and are those of one pass."""
    from pyspark.sql import functions as F
    from sparkngram.operators import ngrams as NG
    from sparkngram.plans import pipeline as PL
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("s").alias("source"),
                                   F.array_join(F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.substring(F.md5((F.col("id") * i % 97).cast("string")), 1, 3)), " ").alias("text"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    PL.ST.let_go(spark)
    found, count = [], NG.count_windows

    def counted(*a, **b):
        found.append(store.getAllFiles().mkString("|").count("shuffle_"))
        return count(*a, **b)

    monkeypatch.setattr(NG, "count_windows", counted)
    made = PL.ngram_counts(spark, str(tmp_path), (1, 2, 3))
    # files go a moment later: those of one pass may still be there
    assert len(found) == PL.PASSES and found[-1] - found[1] < found[1] - found[0], found
    want = NG.count_ngrams(PL.train_tokens(spark, str(tmp_path)), "tokens", (1, 2, 3))
    assert {(r.n, r.word, r.freq) for r in made.collect()} == {(r.n, r.word, r.freq) for r in want.collect()}
