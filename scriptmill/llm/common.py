"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scriptmill.session import ensure_checkpoint_dir

#: words are runs of anything but ASCII white space
WORD_RE = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """What makes a document: its id and its text (by 128-bit hash).  Rows equal in both are one document."""
    return F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit("doc"), text).alias("b"))


def reserve(df: DataFrame, prefix: str = "__") -> None:
    """Columns whose names begin with ``__`` are the operators' own; input may not bring them."""
    taken = [c for c in df.columns if c.startswith(prefix)]
    if taken:
        raise ValueError(f"column names beginning with {prefix} are reserved: {', '.join(taken)}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder that ``spark.checkpoint.dir``
    names and read it back.

    Cuts the lineage, fixes values that depend on the physical plan
    (partition numbers, range bounds) and survives the loss of executors.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_total(df: DataFrame, order: list[str], value: str, out: str, name: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over all rows before a row in
    the order of ``order`` (which must be unique).

    Rows are range-partitioned on the whole key and written, so the partition
    numbers are fixed; the only thing gathered is one sum per partition.  The
    running sum itself is a window inside each partition.
    """
    spark = df.sparkSession
    parts = materialize(df.repartitionByRange(shuffle_parts(spark), *order)
                        .withColumn("__part", F.spark_partition_id()), name)
    sums = parts.groupBy("__part").agg(F.sum(value).alias("__sum"))
    # one row per partition: the window and the broadcast are bounded by the partition count
    w0 = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__part", F.coalesce(F.sum("__sum").over(w0), F.lit(0)).alias("__offset"))
    w1 = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (parts.join(F.broadcast(offsets), "__part")
            .withColumn(out, (F.col("__offset") + F.coalesce(F.sum(value).over(w1), F.lit(0))).cast("long"))
            .drop("__part", "__offset"))


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of an undirected edge list (``a``, ``b``: long):
    one row (``node``, ``root``) per node, ``root`` the smallest node reachable.

    Smallest label among neighbours, then pointer jumping, one written table a
    round until no label changes; nothing but the count of changes is brought
    to the driver.  A hot node is one key of a join whose other side holds it
    once, so its edges can be split over tasks.
    """
    both = materialize(edges.filter("a <> b").select("a", "b")
                       .unionByName(edges.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .distinct(), f"{name}-edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m"))
                         .select(F.col("a").alias("node"), F.least("a", "m").alias("root")), f"{name}-labels")
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("seen"))
        step = (labels.join(seen, labels["node"] == seen["a"])
                .select("node", F.col("root").alias("old"), F.least("root", "seen").alias("root")))
        up = labels.select(F.col("node").alias("up"), F.col("root").alias("up_root"))
        jumped = (step.join(up, step["root"] == up["up"], "left")
                  .select("node", F.least("root", F.coalesce("up_root", "root")).alias("root"), "old"))
        after = materialize(jumped, f"{name}-labels")
        changed = after.filter("root <> old").limit(1).count()
        labels = after.select("node", "root")
        if not changed:
            return labels
