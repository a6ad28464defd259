"""Experiment-log and sweep-result analytics.

Logs are ordered by an explicit ``seq`` (file order).  Every order-dependent
step (positions, running best, previous kept score, new-best flags) goes
through the bucketed scans of :mod:`.ordered`, so no step needs a window
without a partition key and a log of any length is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import BASE_MODEL, RESULTS_NUMERIC
from ..functions.json_text import compact_json, python_json  # noqa: F401  compact_json: for callers of this module
from ..functions.text import cut_with_ellipsis, fixed_6, py_strip
from .grid import resolve_config
from .ordered import SEQ_BUCKET_WIDTH, global_rank, rank_by_seq, running_max_by_seq, seq_scan

KEEP, DISCARD, CRASH = "KEEP", "DISCARD", "CRASH"


# ---- experiment log (commit, val_score, memory_gb, status, description) ----

def normalise_log(log: DataFrame) -> DataFrame:
    """Numbers parsed leniently (unparsable -> null), status stripped and upper-cased."""
    return log.select(
        "seq", "commit",
        F.expr("try_cast(val_score as double)").alias("val_score"),
        F.expr("try_cast(memory_gb as double)").alias("memory_gb"),
        F.upper(py_strip("status")).alias("status"),
        "description")


def status_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def keep_rate(log: DataFrame) -> DataFrame:
    """Counts of KEEP / DISCARD / CRASH and KEEP/(KEEP+DISCARD) when defined."""
    k = F.count_if(F.col("status") == KEEP)
    d = F.count_if(F.col("status") == DISCARD)
    c = F.count_if(F.col("status") == CRASH)
    return log.agg(k.alias("n_keep"), d.alias("n_discard"), c.alias("n_crash")) \
              .withColumn("keep_rate", F.when(F.col("n_keep") + F.col("n_discard") > 0,
                                              F.col("n_keep") / (F.col("n_keep") + F.col("n_discard"))))


def kept_with_index(log: DataFrame, width: int = SEQ_BUCKET_WIDTH) -> DataFrame:
    """Kept rows with their 0-based position in the whole log."""
    return rank_by_seq(log, "seq", "idx", width).where(F.col("status") == KEEP)


def running_best(log: DataFrame, width: int = SEQ_BUCKET_WIDTH) -> DataFrame:
    """Kept rows after dropping crashes: 0-based index among valid rows, the
    running best of kept scores, and the baseline (first valid score)."""
    valid = log.where(F.col("status") != CRASH)
    kept_score = F.when(F.col("status") == KEEP, F.col("val_score"))
    return seq_scan(valid, "seq", width, idx="idx", running_max={"running_best": (kept_score, True)},
                    first={"baseline": F.col("val_score")}).where(F.col("status") == KEEP)


def gains(log: DataFrame, width: int = SEQ_BUCKET_WIDTH) -> DataFrame:
    """Kept rows after the first, with ``delta`` over the previous kept score."""
    kept = seq_scan(log.where(F.col("status") == KEEP), "seq", width, lag={"prev_score": F.col("val_score")},
                    first={"_first": F.col("seq")})
    return (kept.where(F.col("seq") > F.col("_first")).drop("_first")
            .withColumn("delta", F.col("val_score") - F.col("prev_score")))


def hits(log: DataFrame, width: int = SEQ_BUCKET_WIDTH) -> DataFrame:
    """The gains ranked by delta (largest first, ties in log order; null deltas last)."""
    return global_rank(gains(log, width), F.col("delta"), "seq", "rank")


def total_gain(gain_rows: DataFrame) -> DataFrame:
    """Sum of deltas, summed exactly in fixed point (6 decimals); needs no ranks."""
    return gain_rows.agg(F.sum(F.col("delta").cast("decimal(20,6)")).cast("double").alias("total_gain"),
                         F.count(F.lit(1)).alias("n_hits"))


def summary(log: DataFrame) -> DataFrame:
    """Baseline (first row), best kept score and its first row, gain and percent."""
    kept_score = F.when(F.col("status") == KEEP, F.col("val_score"))
    best_key = F.when((F.col("status") == KEEP) & F.col("val_score").isNotNull(),
                      F.struct(F.col("val_score"), -F.col("seq")))
    s = log.agg(F.min_by("val_score", "seq").alias("baseline"),
                F.max(kept_score).alias("best"),
                F.max_by("description", best_key).alias("best_description"),
                F.count(F.lit(1)).alias("n_total"),
                F.count_if(F.col("status") == KEEP).alias("n_kept"))
    gain = F.col("best") - F.col("baseline")
    return s.select("baseline", "best", "best_description", "n_total", "n_kept",
                    F.round(gain, 6).alias("gain"),
                    F.round(gain / F.greatest(F.col("baseline"), F.lit(0.001)) * 100, 6).alias("gain_pct"))


def frontier_labels(log: DataFrame) -> DataFrame:
    """Labels of kept rows among valid ones: description stripped, cut to 42 + '...'."""
    valid = log.where((F.col("status") != CRASH) & (F.col("status") == KEEP))
    return valid.select("seq", cut_with_ellipsis(py_strip("description"), 42, 45).alias("label"))


def run_metrics(results: DataFrame, overrides, extra: dict[str, Column] | None = None, model: str = BASE_MODEL) -> DataFrame:
    """One flat metrics record per run: its resolved settings and scores.

    ``overrides`` is a ``map<string,string>`` column of the run's settings
    (known keys replace the defaults); ``extra`` gives what the results do not
    hold, by name (``peak_vram_mb``, ``num_prompts``), null if absent.
    """
    cfg = resolve_config(overrides)
    g = lambda k: F.element_at(cfg, k)
    extra = {"peak_vram_mb": F.lit(None).cast("double"), "num_prompts": F.lit(None).cast("int")} | (extra or {})
    return results.select(
        "seq", F.lit(model).alias("model"),
        g("LORA_R").cast("int").alias("lora_r"), g("LORA_ALPHA").cast("int").alias("lora_alpha"),
        g("LEARNING_RATE").cast("double").alias("learning_rate"),
        (g("BATCH_SIZE").cast("int") * g("GRADIENT_ACCUMULATION").cast("int")).alias("batch_size"),
        g("NUM_EPOCHS").cast("int").alias("epochs"), g("CLM_MIX_RATIO").cast("double").alias("clm_mix"),
        F.round("elapsed_s", 1).alias("training_time_s"),
        F.col("val_score"), F.col("syntax").alias("syntax_score"), F.col("keyword").alias("keyword_score"),
        F.col("structure").alias("structure_score"), *[c.alias(n) for n, c in extra.items()])


# ---- sweep results (timestamp, val_score, syntax, keyword, structure, status, elapsed_s, config) ----

def typed_results(results: DataFrame) -> DataFrame:
    """Numeric result columns parsed leniently (text that is no number -> null)."""
    out = results
    for c in RESULTS_NUMERIC:
        out = out.withColumn(c, F.expr(f"try_cast({c} as double)"))
    return out


def format_result_rows(results: DataFrame, ts_col: str = "ts") -> DataFrame:
    """The eight tab-separated fields of a result line, as text.

    Missing scores print as 0, a missing status as ``unknown``; scores with 6
    decimals (the binary value, half to even), elapsed seconds with none (half to even, like ``%.0f`` on a
    binary double), the config as compact JSON in Python's spelling.
    """
    f6 = lambda c: fixed_6(F.coalesce(F.col(c), F.lit(0.0)))
    return results.select(
        "seq",
        F.date_format(ts_col, "yyyy-MM-dd HH:mm").alias("timestamp"),
        f6("val_score").alias("val_score"), f6("syntax").alias("syntax"),
        f6("keyword").alias("keyword"), f6("structure").alias("structure"),
        F.coalesce(F.col("status"), F.lit("unknown")).alias("status"),
        F.format_string("%.0f", F.bround(F.coalesce(F.col("elapsed_s"), F.lit(0.0)), 0)).alias("elapsed_s"),
        python_json("config").alias("config"))


def sorted_results(results: DataFrame, sort_by: str = "val_score", limit: int = 50) -> DataFrame:
    """A page of results sorted by a column, largest first (unknown name ->
    ``val_score``); ``limit <= 0`` returns all rows.  Ties keep file order."""
    col = sort_by if sort_by in results.columns else "val_score"
    ordered = results.orderBy(F.col(col).desc_nulls_last(), F.col("seq"))
    return ordered.limit(limit) if limit > 0 else ordered


def best_config(results: DataFrame) -> DataFrame:
    """Highest score strictly above 0 with a parseable config (earliest on ties).

    One row; ``best_val_score = 0`` and config ``{}`` when none qualifies.
    """
    ok = F.col("val_score").isNotNull() & (F.col("val_score") > 0) & F.get_json_object("config", "$").isNotNull()
    key = F.when(ok, F.struct(F.col("val_score"), -F.col("seq")))
    s = results.agg(F.max_by("config", key).alias("cfg"), F.max_by("seq", key).alias("best_seq"),
                    F.max(F.when(ok, F.col("val_score"))).alias("best"))
    return s.select(F.coalesce("best", F.lit(0.0)).alias("best_val_score"),
                    F.coalesce("cfg", F.lit("{}")).alias("best_config"), "best_seq")


def results_status(results: DataFrame) -> DataFrame:
    """Number of experiments and whether any row can be a best (score > 0)."""
    return results.agg(F.count(F.lit(1)).alias("num_experiments"),
                       F.coalesce(F.bool_or(F.col("val_score") > 0), F.lit(False)).alias("has_best"))


def new_best_flags(results: DataFrame, width: int = SEQ_BUCKET_WIDTH) -> DataFrame:
    """Whether each run beat every earlier run that saved a model (start 0).

    A run saves a model only when it succeeded (``status = 'ok'``), and only
    such runs move the best, so the best before a run is the running max of
    successful runs' scores strictly before it.
    """
    ok_score = F.when(F.col("status") == "ok", F.col("val_score"))
    r = running_max_by_seq(results, ok_score, "seq", "_ok_best", False, width)
    before = F.greatest(F.coalesce(F.col("_ok_best"), F.lit(0.0)), F.lit(0.0))
    return r.select("seq", "val_score", "status", before.alias("best_before"),
                    ((F.col("status") == "ok") & F.coalesce(F.col("val_score") > before, F.lit(False))).alias("new_best"))


def ranking(results: DataFrame, config: str = "config") -> DataFrame:
    """Runs by score, largest first and stable, numbered from 1; config cut to 37 + '...'."""
    r = global_rank(results, F.coalesce(F.col("val_score"), F.lit(0.0)), "seq", "rank")
    return r.select("rank", "seq", "val_score", cut_with_ellipsis(config, 37, 40).alias("config_short"))


def sweep_summary(results: DataFrame) -> DataFrame:
    """Total runs, best score and its config (first on ties); 0 and {} when empty."""
    score = F.coalesce(F.col("val_score"), F.lit(0.0))
    key = F.struct(score, -F.col("seq"))
    s = results.agg(F.count(F.lit(1)).alias("total_experiments"), F.max_by("config", key).alias("cfg"),
                    F.max(score).alias("best"))
    return s.select("total_experiments", F.coalesce("best", F.lit(0.0)).alias("best_val_score"),
                    F.coalesce("cfg", F.lit("{}")).alias("best_config"))
