"""Session helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "scriptmill") -> SparkSession:
    """A session configured the way the library expects.

    AQE is on (runtime broadcast by measured size, partition coalescing and
    skew-join splitting); the session time zone is UTC so rendered times do
    not depend on the machine.
    """
    b = (SparkSession.builder.appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master:
        b = b.master(master)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint directory the cluster names; a scratch one only in local mode.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; it is
    read from the session and never replaced.  Only a local-mode session with
    nothing configured (tests, benchmarks) gets a private scratch folder; a
    cluster session without the setting is an error, since a machine-local
    folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (needed for ordered ranks)")
    path = tempfile.mkdtemp(prefix="scriptmill-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def write_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the checkpoint directory and read back: evaluated once
    however often it is used, values that depend on partition numbers are fixed,
    and the loss of an executor costs a read."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
