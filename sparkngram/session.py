"""Session helpers: a local session for tests / bench, and the shared
checkpoint folder used to cut lineage."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session should carry, local or cluster.
_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "sparkngram", event_log_dir: str | None = None) -> SparkSession:
    """A local[N] session for tests and the benchmark (UI off)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if not SparkSession.getActiveSession():
        b = b.config("spark.checkpoint.dir",
                     tempfile.mkdtemp(prefix="sparkngram-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    for k, v in _SQL_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured shared folder.  Only a local[...] session without
    one (tests, single-machine runs) gets a temporary folder; a cluster
    session must name ``spark.checkpoint.dir``."""
    d = checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS / object storage)")
        d = tempfile.mkdtemp(prefix="sparkngram-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    # each call of setCheckpointDir makes another folder below the one that is named: once is enough
    now = spark.sparkContext.getCheckpointDir()
    if not now or (now != d and now.rsplit("/", 1)[0].split(":", 1)[-1].rstrip("/") != d.split(":", 1)[-1].replace("///", "/").rstrip("/")):
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def _trim(spark: SparkSession) -> str:
    """Have the driver's C library hand freed memory back to the system: many
    threads' short-lived buffers stay in its arenas else, more with every step.
    Through the JVM's diagnostic commands, by the interface that is open to all."""
    jvm, new = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    named = jvm.java.lang.Class.forName
    kinds, values = new(jvm.java.lang.Class, 4), new(jvm.java.lang.Object, 4)
    for k, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
        kinds[k] = named(kind)
    values[0], values[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    return named("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), values)


_no_trim = False


def let_go(spark: SparkSession) -> None:
    """Ask the driver to look now for plans that nobody holds and to hand back
    what it does not use: their shuffle files go once it has no use for them,
    which else waits until its memory fills."""
    global _no_trim
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    if not _no_trim:
        try:
            _trim(spark)
        except Exception:  # noqa: BLE001 - a JVM without that command
            _no_trim = True
