import os

from scriptmill.streaming.results_stream import start_live_status

HEADER = "timestamp\tval_score\tsyntax\tkeyword\tstructure\tstatus\telapsed_s\tconfig\n"


def _part(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(HEADER + "".join(lines))


def test_live_status_over_growing_log(spark, tmp):
    log = os.path.join(tmp, "results")
    ck = os.path.join(tmp, "ck")
    _part(log, "part-0.csv", ["2024-01-01 10:00\t0.000000\t0\t0\t0\tok\t1\t{\"a\":0}\n",
                              "2024-01-01 10:05\t0.500000\t0\t0\t0\tok\t1\t{\"a\":1}\n"])
    q = start_live_status(spark, log, ck, "status_a")
    q.awaitTermination()
    r = spark.sql("select * from status_a").first()
    assert (r.num_experiments, r.has_best, r.best_val_score, r.best_config) == (2, True, 0.5, '{"a":1}')
    _part(log, "part-1.csv", ["2024-01-01 10:10\t0.500000\t0\t0\t0\tok\t1\t{\"a\":2}\n",
                              "2024-01-01 10:15\t0.900000\t0\t0\t0\tok\t1\tnot json\n",
                              "short\tline\n"])
    q = start_live_status(spark, log, ck, "status_b")
    q.awaitTermination()
    r = spark.sql("select * from status_b").first()
    assert (r.num_experiments, r.best_val_score, r.best_config) == (4, 0.5, '{"a":1}')


def test_live_status_reads_what_the_log_appends(spark, tmp):
    from pyspark.sql import functions as F

    from scriptmill.sources.results_log import append_results

    log = os.path.join(tmp, "results")
    rows = spark.range(40).select(F.col("id").alias("seq"), F.current_timestamp().alias("ts"), (F.col("id") % 7 / 10).alias("val_score"),
                                  *[F.lit(0.0).alias(c) for c in ("syntax", "keyword", "structure")], F.lit("ok").alias("status"),
                                  F.lit(1.0).alias("elapsed_s"), F.concat(F.lit('{"a":'), "id", F.lit("}")).alias("config"))
    append_results(rows.repartition(4), log)
    start_live_status(spark, log, os.path.join(tmp, "ck"), "status_c").awaitTermination()
    r = spark.sql("select * from status_c").first()
    assert (r.num_experiments, r.best_val_score, r.best_config) == (40, 0.6, '{"a":6}')
