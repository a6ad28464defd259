"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set).  Each query runs to
completion into Spark's ``noop`` sink (every row produced, nothing written).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scriptmill.plans.queries import QUERIES  # noqa: E402
from scriptmill.session import get_session  # noqa: E402

#: the six extraction stages of one full run
EXTRACTION = ["corpus_raw", "corpus_clm", "blocks_structured", "pairs_sft", "pairs_loc", "pairs_engine"]
HEADLINE = [*EXTRACTION, "score_summary",
            "log_running_best", "log_hits", "sweep_ranking", "sft_split", "train_text", "grid_expand"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, app_name="scriptmill-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # warm the JVM (class loading, codegen caches) on a small query
    QUERIES["log_status_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus}
    if set(EXTRACTION) <= set(times):
        # the baseline is the rate of a whole extraction run: all six stages, ours in its units (untimed count)
        from pyspark.sql import functions as F

        from scriptmill.functions.text import line_count
        from scriptmill.plans.views import Views
        n = Views(spark, sf_dir).view("v_scripts").agg(F.count(F.lit(1)).alias("files"),
                                                       F.sum(line_count("text")).alias("lines")).first()
        t = sum(times[n] for n in EXTRACTION)
        out["extraction"] = {"files": n.files, "lines": n.lines, "files_per_s": round(n.files / t, 1),
                             "lines_per_s": round(n.lines / t, 1),
                             "baseline_files_per_s": 33, "baseline_lines_per_s": 3300}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
