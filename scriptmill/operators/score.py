"""Batch scoring of generated outputs against the benchmark prompts.

Every score is a column expression; scoring a table of outputs is a
projection after one join to the prompt table (a fixed, tiny table, so the
join is a broadcast).  Per-run summaries are one aggregation keyed by run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import CODE_MARKERS, EVAL_PROMPTS, RATING_BANDS, SCOPE_WORDS, SCORE_WEIGHTS
from ..functions.text import WORD, WS, col_of, count_char

SCORE_COLUMNS = ["syntax_score", "keyword_score", "structure_score", "total_score"]
BLOCK_RE = rf"{WORD}{WS}*={WS}*\{{"
SCOPE_RE = "(" + "|".join(SCOPE_WORDS) + ")"


def eval_prompts(spark: SparkSession) -> DataFrame:
    """The fixed benchmark: ``ord, prompt_id, category, checks, instruction``."""
    rows = [(i, p["id"], p["category"], p["checks"], p["instruction"]) for i, p in enumerate(EVAL_PROMPTS)]
    return spark.createDataFrame(
        rows, "ord int, prompt_id string, category string, checks array<string>, instruction string")


def score_columns(text, checks) -> list[Column]:
    """Score columns for one output ``text`` against its ``checks``."""
    t, ch = col_of(text), col_of(checks)
    found = F.size(F.filter(ch, lambda c: F.contains(t, c)))
    total = F.size(ch)
    keyword = found / F.greatest(total, F.lit(1))
    opens, closes = count_char(t, "{"), count_char(t, "}")
    balance = F.when((opens == closes) & (opens > 0), 1.0).otherwise(0.0)
    assign = F.when(t.contains("="), 1.0).otherwise(0.0)
    code = F.lit(False)
    for m in CODE_MARKERS:
        code = code | t.contains(m)
    code = F.when(code, 1.0).otherwise(0.0)
    syntax = (balance * 0.5 + assign * 0.5) * (1.0 - code * 0.5)
    structure = F.when(t.rlike(BLOCK_RE), 0.5).otherwise(0.0) + F.when(t.rlike(SCOPE_RE), 0.5).otherwise(0.0)
    total_score = (syntax * SCORE_WEIGHTS["syntax"] + keyword * SCORE_WEIGHTS["keyword"]
                   + structure * SCORE_WEIGHTS["structure"])
    return [F.round(syntax, 4).alias("syntax_score"),
            F.round(keyword, 4).alias("keyword_score"),
            F.round(structure, 4).alias("structure_score"),
            F.round(total_score, 4).alias("total_score"),
            (opens == closes).alias("brace_balanced"),
            found.cast("int").alias("keywords_found"),
            total.cast("int").alias("keywords_total")]


def score_outputs(outputs: DataFrame, prompts: DataFrame, how: str = "inner") -> DataFrame:
    """Score rows for outputs that have a prompt (``how='left'`` keeps the rest
    with null scores, which summaries count as absent)."""
    # the prompt table is a benchmark (a handful of rows); Spark broadcasts
    # it from its measured size, no hint needed
    p = prompts.select("prompt_id", "checks", "ord")
    j = outputs.join(p, "prompt_id", how)
    keep = [c for c in outputs.columns if c not in ("prompt_id", "text")]
    scored = j.select(*keep, "prompt_id", "ord", *score_columns("text", "checks"))
    if how != "inner":
        matched = F.col("ord").isNotNull()
        scored = scored.select(*keep, "prompt_id", "ord",
                               *[F.when(matched, F.col(c)).alias(c) for c in
                                 SCORE_COLUMNS + ["brace_balanced", "keywords_found", "keywords_total"]])
    return scored


def rating(total) -> Column:
    """PASS / WARN / FAIL bands of a total score."""
    (hi, a), (lo, b) = RATING_BANDS
    t = col_of(total)
    return F.when(t >= hi, a).when(t >= lo, b).otherwise("FAIL")


def summarize(scored: DataFrame, by: list[str]) -> DataFrame:
    """Per group: means of the rounded scores (round 6) and the prompt count.

    ``scored`` may hold unmatched rows with null scores (a left join); a group
    with no scored prompt gets ``val_score = 0`` and ``num_prompts = 0`` and
    null means otherwise, as the original returns only those two keys.
    """
    n = F.count("total_score")
    aggs = [F.coalesce(F.round(F.avg("total_score"), 6), F.lit(0.0)).alias("val_score")]
    for c in ["syntax_score", "keyword_score", "structure_score"]:
        aggs.append(F.round(F.avg(c), 6).alias(c))
    aggs.append(n.cast("int").alias("num_prompts"))
    return scored.groupBy(*by).agg(*aggs)


def per_prompt_list(scored: DataFrame, by: list[str]) -> DataFrame:
    """Per group: the score rows nested in prompt order (bounded by the prompt count)."""
    row = F.struct("ord", "prompt_id", *SCORE_COLUMNS, "brace_balanced", "keywords_found", "keywords_total")
    return (scored.where(F.col("total_score").isNotNull()).groupBy(*by)
                  .agg(F.transform(F.array_sort(F.collect_list(row)), lambda r: r.dropFields("ord")).alias("per_prompt")))


def compare_runs(summary_a: DataFrame, summary_b: DataFrame, keys: list[str]) -> DataFrame:
    """Four metrics of run A against run B; a missing metric counts 0.

    Both sides are unpivoted to ``metric, value`` and full-outer joined on
    ``keys + metric``; ``delta = b - a`` and ``sign`` is ``+`` when positive.
    """
    metrics = ["val_score", "syntax_score", "keyword_score", "structure_score"]

    def longer(df: DataFrame, side: str) -> DataFrame:
        return (df.unpivot(keys, metrics, "metric", side).where(F.col(side).isNotNull()))

    a, b = longer(summary_a, "a"), longer(summary_b, "b")
    j = a.join(b, keys + ["metric"], "full_outer")
    va, vb = F.coalesce("a", F.lit(0.0)), F.coalesce("b", F.lit(0.0))
    delta = vb - va
    return j.select(*keys, "metric", va.alias("a"), vb.alias("b"), F.round(delta, 6).alias("delta"),
                    F.when(delta > 0, "+").otherwise("").alias("sign"))


def eval_report(summary: DataFrame, per_prompt: DataFrame, outputs: DataFrame, by: list[str],
                timestamp) -> DataFrame:
    """``by..., report``: the JSON report ``{timestamp, metrics, outputs}``.

    ``outputs`` per group become a map prompt_id -> text (one entry per prompt).
    """
    outs = outputs.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("prompt_id", "text")))).alias("outputs"))
    m = summary.join(per_prompt, by, "left").join(outs, by, "left")
    metrics = F.struct("val_score", "syntax_score", "keyword_score", "structure_score", "num_prompts", "per_prompt")
    return m.select(*by, F.to_json(F.struct(col_of(timestamp).alias("timestamp"), metrics.alias("metrics"),
                                            F.col("outputs"))).alias("report"))


def read_report_metrics(reports: DataFrame, report: str = "report") -> DataFrame:
    """Metrics of a JSON report, accepting bare metrics objects too."""
    schema = ("timestamp long, val_score double, syntax_score double, keyword_score double, "
              "structure_score double, num_prompts int, metrics struct<val_score:double, syntax_score:double, "
              "keyword_score:double, structure_score:double, num_prompts:int>")
    p = F.from_json(F.col(report), schema)
    out = [c for c in reports.columns if c != report]
    return reports.select(*out, *[F.coalesce(p["metrics"][k], p[k]).alias(k) for k in
                                  ["val_score", "syntax_score", "keyword_score", "structure_score", "num_prompts"]])
