"""A stream started again on the same folder goes on where the last run stopped."""

from sparkngram.streaming.scoring import stream_ngram_counts, stream_predictions

SCHEMA = "text string"


def test_second_run_reads_only_new_files(spark, tmp_path):
    src, work = str(tmp_path / "in"), str(tmp_path / "work")

    def add(*lines):
        spark.createDataFrame([(t,) for t in lines], SCHEMA).coalesce(1).write.mode("append").parquet(src)

    def counts():
        got = stream_ngram_counts(spark, src, SCHEMA, "text", orders=(1,), work=work)
        return {r.word: r.freq for r in got.collect()}

    add("red blue", "red")
    assert counts() == {"red": 2, "blue": 1}
    add("red green")
    assert counts() == {"red": 3, "blue": 1, "green": 1}
    assert counts() == {"red": 3, "blue": 1, "green": 1}


def test_a_table_that_is_a_folder_is_scored(spark, tmp_path):
    """A table written in parts is a folder, whose name ends in .parquet too."""
    model = spark.createDataFrame([(1, "the", "the", 0.5, 1), (2, "red", "car", 1.0, 1)], "n int, w string, pred string, score double, rnk int")
    for name, rows in (("few.parquet", [(1, "a red"), (2, "red")]), ("none.parquet", [])):
        spark.createDataFrame(rows, "id long, text string").repartition(2).write.parquet(str(tmp_path / name))
        got = stream_predictions(spark, str(tmp_path / name), "id long, text string", model, ["id"], "text", work=str(tmp_path / f"work-{name}"))
        assert sorted((r.id, r.word) for r in got.collect() if r.rnk == 1) == [(i, "car") for i, _ in rows]
