"""Materialised stages and published tables.

Everything is written under a caller-given folder on shared storage
(default: ``<spark.checkpoint.dir>/tables``), so a job restarted after an
executor or driver loss finds its finished stages again.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkngram.session import ensure_checkpoint_dir, let_go


def table_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, the same for every job;
    without that setting the session's own."""
    own = ensure_checkpoint_dir(spark)
    return (spark.conf.get("spark.checkpoint.dir", None) or own).rstrip("/") + "/tables"


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def input_fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Digest of the files below ``paths``: their names, sizes and times of
    change.  A listing only, nothing is read."""
    seen = []
    for path in paths:
        p, fs = _path(spark, path)
        files = fs.listFiles(p, True)
        while files.hasNext():
            f = files.next()
            name = f.getPath().getName()
            if not name.startswith(("_", ".")):
                seen.append(f"{f.getPath().toUri().getPath()}|{f.getLen()}|{f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()


def input_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    """Size of the files below ``paths``, from their listing."""
    return sum(fs.getContentSummary(p).getLength() for p, fs in (_path(spark, path) for path in paths))


def committed(spark: SparkSession, folder: str) -> str | None:
    """The data folder that a stage's commit marker names, if it is there."""
    p, fs = _path(spark, f"{folder}/_COMMITTED")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        name = bytes(stream.readNBytes(1 << 10)).decode()
    finally:
        stream.close()
    return f"{folder}/{name}"


def _stage_folder(spark: SparkSession, name: str, inputs: Sequence[str], params: dict, partition_by: Sequence[str], root: str | None) -> str:
    key = json.dumps([name, params, list(partition_by)], sort_keys=True, default=str)
    digest = hashlib.sha256((input_fingerprint(spark, inputs) + key).encode()).hexdigest()[:24]
    return f"{root or table_root(spark)}/stages/{name}-{digest}"


def staged(spark: SparkSession, name: str, inputs: Sequence[str], params: dict, partition_by: Sequence[str] = (), root: str | None = None) -> bool:
    """Whether :func:`stage` with these arguments would find its table made."""
    return committed(spark, _stage_folder(spark, name, inputs, params, partition_by, root)) is not None


def drop(spark: SparkSession, path: str) -> None:
    """Remove a table of this job's own that no plan reads any more."""
    p, fs = _path(spark, path)
    fs.delete(p, True)


def stage(spark: SparkSession, name: str, inputs: Sequence[str], params: dict, build: Callable[[], DataFrame | Iterable[DataFrame]],
          partition_by: Sequence[str] = (), root: str | None = None) -> DataFrame:
    """The table that ``build`` makes from the files ``inputs`` under
    ``params``, made once and read back from then on, also by later jobs.

    The folder is named by the inputs' fingerprint and the parameters, so a
    changed file or parameter gives another stage.  Each attempt writes to a
    folder of its own and is committed by a marker, created only if none is
    there: a job that dies while writing leaves no marker, and of two that
    write at a time the first to commit wins and both read its table.  A table
    that ``build`` gives in parts is written part by part, each of which lets go
    of its shuffle files before the next one starts."""
    folder = _stage_folder(spark, name, inputs, params, partition_by, root)
    done = committed(spark, folder)
    if done is None:
        attempt = f"attempt-{uuid.uuid4().hex}"
        made = build()
        parts = iter([made] if isinstance(made, DataFrame) else made)
        while (part := next(parts, None)) is not None:
            w = part.write.option("compression", "zstd").mode("append")
            (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{folder}/{attempt}")
            if part is not made:
                del part, w
                let_go(spark)
        _commit(spark, folder, attempt)
        done = committed(spark, folder)
    return spark.read.parquet(done)


def _commit(spark: SparkSession, folder: str, attempt: str) -> None:
    """Write the marker whole and move it into place; a marker that is there stays."""
    draft, fs = _path(spark, f"{folder}/_{attempt}")
    stream = fs.create(draft, True)
    stream.write(bytearray(attempt.encode()))
    stream.close()
    marker, _ = _path(spark, f"{folder}/_COMMITTED")
    if fs.exists(marker) or not fs.rename(draft, marker):
        fs.delete(draft, False)


def publish_sbo(model: DataFrame, path: str) -> DataFrame:
    """The stupid-backoff lookup ``(pre, word, score, n, rnk)``,
    partitioned by order so a lookup reads one order's files only."""
    out = model.select(F.col("w").alias("pre"), F.col("pred").alias("word"), "score", "n", "rnk")
    out.write.mode("overwrite").partitionBy("n").parquet(path)
    return model.sparkSession.read.parquet(path)


def publish_katz(tables: DataFrame, unigram: DataFrame, path: str) -> DataFrame:
    """Katz lookup in one table partitioned by order: trigram / bigram
    rows ``(pre, word, prob, leftover, freq, d)`` and unigram rows
    ``(pre = NULL, word, prob, freq, d)``."""
    hi = tables.select("n", F.col("w").alias("pre"), F.col("pred").alias("word"), "prob", "leftover", "freq", "d")
    uni = unigram.select(F.lit(1).alias("n"), F.lit(None).cast("string").alias("pre"), "word", "prob",
                         F.lit(None).cast("double").alias("leftover"), "freq", "d")
    hi.unionByName(uni).write.mode("overwrite").partitionBy("n").parquet(path)
    return tables.sparkSession.read.parquet(path)


def old_layout(published_sbo: DataFrame) -> DataFrame:
    """The older layout without a score column (column-pruned view)."""
    return published_sbo.select("pre", "word", "n")


def write_count_csv(counts: DataFrame, path: str) -> None:
    """Header-less ``word,freq`` CSV with blank-separated n-grams (the
    layout the Kneser-Ney script reads)."""
    counts.select(F.regexp_replace("word", "_", " ").alias("word"), "freq") \
        .write.mode("overwrite").option("header", False).csv(path)


def read_count_csv(spark: SparkSession, path: str) -> DataFrame:
    """A4: header-less count CSV, blanks stripped, columns named, separator
    normalised to ``_``."""
    df = (spark.read.schema("word string, freq long").option("header", False)
          .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path))
    return df.select(F.regexp_replace(F.trim("word"), r"\s+", "_").alias("word"), "freq")


def write_csv(df: DataFrame, path: str) -> DataFrame:
    """A5: CSV with header, read back with the same schema."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return df.sparkSession.read.schema(df.schema).option("header", True).csv(path)


def text_round_trip(lines: DataFrame, path: str, col: str = "line") -> DataFrame:
    """Write lines as text, read them back, and report the lines
    missing on either side (both counts must be 0)."""
    spark = lines.sparkSession
    lines.select(F.col(col).alias("value")).write.mode("overwrite").text(path)
    back = spark.read.text(path)
    orig = lines.select(F.col(col).alias("value"))
    return spark.createDataFrame([(0,)], "x int").select(
        F.lit(orig.exceptAll(back).count()).alias("missing_after"),
        F.lit(back.exceptAll(orig).count()).alias("extra_after"),
        F.lit(back.count()).alias("lines"))


def write_named_files(lines: DataFrame, path: str, names: Sequence[str], sep: str = "_", line: str = "line") -> None:
    """Lines as text files in one folder per value of ``names``, which its name
    spells out (``en_blogs/part-...``)."""
    lines.select(F.col(line).alias("value"), F.concat_ws(sep, *names).alias("file")).write.mode("overwrite").partitionBy("file").text(path)


def docvars_from_filenames(spark: SparkSession, path: str, names: Sequence[str] = ("lang", "source"), sep: str = "_") -> DataFrame:
    """A10: the text files below ``path`` with document variables from their
    names split by ``sep``: ``(line, file, *names)``; a file that Spark wrote
    as parts is named by its folder.  A name with too few parts gives nulls."""
    text = spark.read.option("recursiveFileLookup", True).text(path)
    whole = F.element_at(F.split(F.url_decode(F.col("_metadata.file_path")), "/"), -1)
    folder = F.regexp_replace(F.element_at(F.split(F.url_decode(F.col("_metadata.file_path")), "/"), -2), "^file=", "")
    name = F.when(whole.startswith("part-"), folder).otherwise(F.regexp_replace(whole, r"\.[^.]*$", ""))
    named = text.select(F.col("value").alias("line"), name.alias("file"))
    return named.select("*", *[F.get(F.split("file", sep), F.lit(i)).alias(n) for i, n in enumerate(names)])
