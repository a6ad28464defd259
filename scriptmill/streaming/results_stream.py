"""Live view of a growing result log.

The sweep appends result lines while it runs and its status/best-config tools
re-read the whole file on every call.  Here the log directory is a streaming
file source: each new part file is parsed once, and a running aggregate keeps
the experiment count and the best config (score strictly above 0, parseable
config, earliest on ties) in Spark's state store, so every trigger costs only
the new lines.  Checkpointing (``checkpointLocation``) makes it restartable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import RESULTS_COLUMNS
from ..functions.text import py_strip


def result_lines(spark: SparkSession, path: str, columns=RESULTS_COLUMNS) -> DataFrame:
    """Streaming rows of a result-log directory, with lenient numbers; ``seq``
    is the stored log order (null in logs without it)."""
    header = F.array(*[F.lit(c) for c in columns])
    lines = (spark.readStream.format("text").option("pathGlobFilter", "*.csv").load(path)
             .select(F.col("_metadata.file_path").alias("file"), F.split(py_strip("value"), "\t", -1).alias("f"))
             .where((F.size("f") >= len(columns)) & (F.slice("f", 1, len(columns)) != header)))
    return lines.select("file", *[F.col("f")[i].alias(c) for i, c in enumerate(columns)],
                        F.expr(f"try_cast(get(f, {len(columns)}) as bigint)").alias("seq"),
                        F.expr("try_cast(f[1] as double)").alias("score"))


def live_status(rows: DataFrame) -> DataFrame:
    """Running ``num_experiments, has_best, best_val_score, best_config``."""
    ok = F.col("score").isNotNull() & (F.col("score") > 0) & F.get_json_object("config", "$").isNotNull()
    agg = rows.agg(F.count(F.lit(1)).alias("num_experiments"),
                   F.max(F.when(ok, F.col("score"))).alias("best"),
                   F.min_by(F.col("config"), F.when(ok, F.struct(-F.col("score"), F.col("seq"), F.col("timestamp"), F.col("file"))))
                    .alias("cfg"))
    return agg.select("num_experiments", F.col("best").isNotNull().alias("has_best"),
                      F.coalesce("best", F.lit(0.0)).alias("best_val_score"),
                      F.coalesce("cfg", F.lit("{}")).alias("best_config"))


def start_live_status(spark: SparkSession, path: str, checkpoint: str, query_name: str = "sweep_status",
                      available_now: bool = True):
    """Start the status query into an in-memory table named ``query_name``."""
    w = (live_status(result_lines(spark, path)).writeStream.outputMode("complete").format("memory")
         .queryName(query_name).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
