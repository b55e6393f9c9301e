"""Session helpers: one place that sets the Spark knobs the operators rely on.

On a cluster the session is created by the platform; :func:`configure` only
fills in settings that are unset and never points Spark at machine-local
folders unless the master is ``local[...]`` (tests, benches).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every operator assumes. ANSI stays on (Spark 4 default); all
# divisions and logs in the library are guarded, so no query depends on
# ANSI being off.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "scorecraft",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        builder = builder.config("spark.driver.memory", os.environ.get("SCORECRAFT_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local session without one gets
    a fresh scratch folder (tests); a cluster session without one is an error,
    because a machine-local folder does not survive executor loss.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if conf_dir:
        if not current:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    if current:
        return current
    if not is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    scratch = tempfile.mkdtemp(prefix="scorecraft-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", scratch)
    sc.setCheckpointDir(scratch)
    return scratch


def stage_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written stage tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffles that nothing refers to any more, as those of
    a table just written: it acts on what the driver's JVM has collected, which an idle
    driver would not do for half an hour, while the files stay on the executors' disks."""
    spark._jvm.System.gc()
