"""Structured Streaming re-aims of the interactive predictor (K1) and of
count merging (K2).

* K1 ``stream_predictions``: phrases arrive as files; each micro-batch is
  answered with the batch predictor (suffix explode -> join with the
  static lookup table -> per-phrase ranking).  Ranking windows are not
  allowed on streams, so the per-phrase top-k runs inside
  ``foreachBatch`` on the micro-batch, and results are appended to a
  parquet sink (idempotent per batch id: one folder per batch).
* K2 ``stream_ngram_counts``: running n-gram counts of arriving lines.
  Each micro-batch is counted (partial aggregation) and written as a delta
  keyed by its batch id; the table is the sum of the deltas on read.
  ``compact_counts`` folds deltas into a base table.
* K2 with event time, ``stream_window_counts``: counts per time window and
  key, kept as Spark's window state behind a watermark; late rows update their
  window until the watermark has passed it.

Both keep their checkpoint and sink under ``work``, a folder of the caller's
choice on shared storage: a job started again with the same folder resumes
where the last one stopped and reads only what has arrived since.  Without it
a run of its own is made under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkngram.functions import clean as C
from sparkngram.operators import ngrams as NG
from sparkngram.operators import predict as P
from sparkngram.session import ensure_checkpoint_dir
from sparkngram.sources import store


def _file_stream(spark: SparkSession, path: str, schema: str, max_files: int | None = None) -> DataFrame:
    """A parquet file stream over ``path``: a folder of files, or one file, then
    its folder filtered to that file name.  The file system says which it is,
    as a table's folder may end in ``.parquet`` too."""
    import os
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    p, fs = store._path(spark, path)
    if fs.exists(p) and fs.getFileStatus(p).isFile():
        folder, name = os.path.split(path)
        return r.option("pathGlobFilter", name).parquet(folder)
    return r.parquet(path)


def _work_dir(spark: SparkSession, name: str, work: str | None) -> str:
    if work:
        return work.rstrip("/")
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/streams/{name}-{uuid.uuid4().hex[:12]}"


def stream_ngram_counts(spark: SparkSession, path: str, schema: str, text_col: str, orders=(1, 2),
                        where: str | None = None, max_files_per_trigger: int = 1, work: str | None = None) -> DataFrame:
    """K2: run the stream to completion (availableNow) and return the
    merged count table ``(n, word, freq)``."""
    work = _work_dir(spark, "counts", work)
    src = _file_stream(spark, path, schema, max_files_per_trigger)
    if where:
        src = src.where(where)
    lines = src.select(F.explode(F.split(F.col(text_col), "\n")).alias("line"))
    toks = lines.select(C.tokens(C.clean_train(F.col("line"))).alias("tokens"))
    grams = NG.explode_ngrams(toks, "tokens", orders)

    def merge(batch: DataFrame, batch_id: int) -> None:
        # one folder per batch id: a replayed batch overwrites only itself
        counted = batch.groupBy("n", "word").agg(F.count(F.lit(1)).alias("freq"))
        counted.write.mode("overwrite").parquet(f"{work}/deltas/batch={batch_id}")

    q = (grams.writeStream.foreachBatch(merge).option("checkpointLocation", f"{work}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return read_counts(spark, f"{work}/deltas")


def _children(spark: SparkSession, path: str) -> list[str]:
    p, fs = store._path(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def _base(spark: SparkSession, work: str) -> tuple[int, str | None]:
    """The last committed base table: the batch up to which it reaches, and its folder."""
    for name in reversed(_children(spark, f"{work}/base")):
        done = store.committed(spark, f"{work}/base/{name}")
        if done:
            return int(name), done
    return -1, None


def _deltas(spark: SparkSession, deltas: str, after: int) -> list[int]:
    """Batches beyond ``after`` whose delta is complete."""
    ids = [int(n.split("=")[1]) for n in _children(spark, deltas) if n.startswith("batch=")]
    whole = [i for i in sorted(ids) if i > after and "_SUCCESS" in _children(spark, f"{deltas}/batch={i}")]
    return whole


def read_counts(spark: SparkSession, deltas: str) -> DataFrame:
    """The merged count table: the base, if there is one, and the deltas of the
    batches after it summed on read (partial aggregation), so a micro-batch
    costs O(batch), never O(table)."""
    work = deltas.rsplit("/", 1)[0]
    upto, base = _base(spark, work)
    paths = ([base] if base else []) + [f"{deltas}/batch={i}" for i in _deltas(spark, deltas, upto)]
    if not paths:
        return spark.createDataFrame([], "n int, word string, freq long")
    rows = [spark.read.schema("n int, word string, freq long").parquet(p) for p in paths]
    return reduce(DataFrame.unionByName, rows).groupBy("n", "word").agg(F.sum("freq").alias("freq"))


def compact_counts(spark: SparkSession, work: str) -> DataFrame:
    """Fold all deltas so far into a new base table and return the counts.

    The base is written beside the old one and counts only once its marker is
    there; the marker names the last batch that it holds, and readers leave out
    deltas up to that batch.  So a job that dies before the marker changes
    nothing, one that dies after it leaves folders that nobody reads (the next
    run removes them), and a batch that the stream replays is not counted twice."""
    work = work.rstrip("/")
    deltas = f"{work}/deltas"
    upto, _ = _base(spark, work)
    new = _deltas(spark, deltas, upto)
    if new:
        folder, attempt = f"{work}/base/{new[-1]:020d}", f"attempt-{uuid.uuid4().hex}"
        read_counts(spark, deltas).write.parquet(f"{folder}/{attempt}")
        store._commit(spark, folder, attempt)
    upto, _ = _base(spark, work)
    for name in _children(spark, deltas):
        if name.startswith("batch=") and int(name.split("=")[1]) <= upto:
            p, fs = store._path(spark, f"{deltas}/{name}")
            fs.delete(p, True)
    for name in _children(spark, f"{work}/base"):
        if int(name) < upto:
            p, fs = store._path(spark, f"{work}/base/{name}")
            fs.delete(p, True)
    return read_counts(spark, deltas)


def stream_window_counts(spark: SparkSession, path: str, schema: str, ts: str, keys: list[str], window: str = "1 day", watermark: str = "2 days",
                         where: str | None = None, max_files_per_trigger: int = 1, work: str | None = None) -> DataFrame:
    """K2 with event time: run the stream to completion (availableNow) and
    return ``(window_start, *keys, freq)``.

    The state store holds the windows that the watermark has not passed; a row
    later than that is dropped.  Each batch writes the windows it changed, with
    their whole counts, under its batch id; a window's count is that of its last
    batch, so a replayed batch overwrites itself."""
    work = _work_dir(spark, "windows", work)
    src = _file_stream(spark, path, schema, max_files_per_trigger)
    if where:
        src = src.where(where)
    counted = (src.withWatermark(ts, watermark).groupBy(F.window(ts, window).alias("w"), *keys).agg(F.count(F.lit(1)).alias("freq"))
               .select(F.col("w.start").alias("window_start"), *keys, "freq"))

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{work}/windows/batch={batch_id}")

    q = (counted.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{work}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if not _children(spark, f"{work}/windows"):
        return spark.createDataFrame([], counted.select("window_start", *keys, "freq").schema)
    rows = spark.read.parquet(f"{work}/windows")
    return rows.groupBy("window_start", *keys).agg(F.max_by("freq", "batch").alias("freq"))


def stream_predictions(spark: SparkSession, path: str, schema: str, model: DataFrame, key_cols: list[str],
                       text_col: str, where: str | None = None, m: int = 3, k: int = 3, work: str | None = None) -> DataFrame:
    """K1: score every arriving phrase (C17 cleaning, stupid backoff with
    the app's unigram fill) and return the appended predictions."""
    work = _work_dir(spark, "predict", work)
    src = _file_stream(spark, path, schema)
    if where:
        src = src.where(where)
    phrases = src.select(*key_cols, C.tokens(C.clean_query(F.col(text_col))).alias("words"),
                         (F.col(text_col) == F.lit("")).alias("empty"))

    def score(batch: DataFrame, batch_id: int) -> None:
        out = P.predict_sbo(batch, model, key_cols, "words", m=m, k=k, fill="unigram",
                            defaults=P.APP_DEFAULTS, empty=F.col("empty"))
        out.write.mode("overwrite").parquet(f"{work}/out/batch={batch_id}")

    q = (phrases.writeStream.foreachBatch(score).option("checkpointLocation", f"{work}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if not _children(spark, f"{work}/out"):  # nothing has arrived
        keys = [f for f in phrases.schema.fields if f.name in key_cols]
        return spark.createDataFrame([], T.StructType([*keys, T.StructField("rnk", T.IntegerType()), T.StructField("word", T.StringType())]))
    return spark.read.parquet(f"{work}/out")
