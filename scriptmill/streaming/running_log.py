"""Running analytics of a growing log that read only what was appended.

A log is a folder of part files (see :mod:`..sources.results_log`) that grows by
appends.  ``extend`` reads the files it has not read, makes one *batch* of their
rows and writes it with its running columns; a one-row summary of each batch
(rows, maxima, last and first values, totals) stays in a ledger, so a batch starts
from the summaries of those before it and no earlier row is read again.  An append
of one hundredth of the log costs one hundredth of a full run.

Batches have disjoint ranges of ``seq``.  Rows that fall before the end of earlier
batches (appends out of order, two writers) and files that changed or went away
make those batches and the later ones they touch be read again, as one batch; the
ledger then leaves the old ones out.  The ledger gets one file per ``extend``, put
in place by one rename: an ``extend`` that fails changes nothing, and the next one
reads the same files.  One writer at a time.

Defined results: lines without a stored ``seq`` raise (read such a log whole); an
empty log or no new file changes nothing; files of headers alone count as read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import SEQ_BUCKET_WIDTH, seq_scan
from ..operators.results import CRASH, KEEP
from ..session import write_once
from ..sources.results_log import read_new_experiments, read_new_results


@dataclass(frozen=True)
class Running:
    """What is carried along a log.

    ``idx``, ``running_max``, ``lag`` and ``first`` as in ``seq_scan``, over the
    rows that satisfy ``where``; ``sums`` and ``maxima`` (also of structs) are
    totals over all rows.  ``read`` gives the rows of a list of files.
    """
    read: Callable[[SparkSession, list[str]], DataFrame]
    where: Column | None = None
    idx: str = "idx"
    running_max: dict[str, tuple[Column, bool]] = field(default_factory=dict)
    lag: dict[str, Column] = field(default_factory=dict)
    first: dict[str, Column] = field(default_factory=dict)
    sums: dict[str, Column] = field(default_factory=dict)
    maxima: dict[str, Column] = field(default_factory=dict)

    def summary(self) -> list[Column]:
        """Aggregates of a batch's rows."""
        inside = F.lit(True) if self.where is None else F.coalesce(self.where, F.lit(False))
        at = F.when(inside, F.col("seq"))
        cell = lambda c: F.struct(c.alias("v"))  # noqa: E731  keeps a null apart from no row
        return [F.count_if(inside).alias("n"),
                *[F.max(F.when(inside, v)).alias(f"max_{k}") for k, (v, _) in self.running_max.items()],
                *[F.max_by(cell(v), at).alias(f"last_{k}") for k, v in self.lag.items()],
                *[F.min_by(cell(v), at).alias(f"first_{k}") for k, v in self.first.items()],
                *[F.sum(v).alias(f"sum_{k}") for k, v in self.sums.items()],
                *[F.max(v).alias(f"top_{k}") for k, v in self.maxima.items()]]

    def carried(self, batches: DataFrame) -> DataFrame:
        """One row: the summaries of some batches as one."""
        return batches.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                           *[F.max(f"max_{k}").alias(f"max_{k}") for k in self.running_max],
                           *[F.max_by(f"last_{k}", F.when(F.col("n") > 0, F.col("lo"))).alias(f"last_{k}") for k in self.lag],
                           *[F.min_by(f"first_{k}", F.when(F.col("n") > 0, F.col("lo"))).alias(f"first_{k}") for k in self.first])

    def scanned(self, rows: DataFrame, before: DataFrame, width: int) -> DataFrame:
        """A batch's rows with the running columns, started from ``before`` (one row)."""
        held = rows if self.where is None else rows.where(self.where)
        own = seq_scan(held, "seq", width, idx=self.idx, running_max=self.running_max, lag=self.lag, first=self.first)
        start = before.select(F.struct(*before.columns).alias("_start"))
        out = own.join(F.broadcast(start))
        s = lambda name: F.col("_start")[name]
        for k in self.running_max:
            out = out.withColumn(k, F.greatest(k, s(f"max_{k}")))
        for k in self.lag:
            out = out.withColumn(k, F.when(F.col(self.idx) == 0, s(f"last_{k}")["v"]).otherwise(F.col(k)))
        for k in self.first:
            out = out.withColumn(k, F.when(s(f"first_{k}").isNotNull(), s(f"first_{k}")["v"]).otherwise(F.col(k)))
        return out.withColumn(self.idx, F.col(self.idx) + s("n")).drop("_start")


def _live(spark: SparkSession, state: str) -> DataFrame | None:
    """Ledger rows of the batches in force: one with the summary (``path`` null)
    and one for each file."""
    try:
        # a batch whose files are all gone has no summary columns
        ledger = spark.read.option("mergeSchema", "true").parquet(f"{state}/ledger")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    replaced = ledger.where("path is null").select(F.explode("replaces").alias("batch"))
    return ledger.join(replaced, "batch", "left_anti")


def _batches(spark: SparkSession, state: str) -> DataFrame:
    live = _live(spark, state)
    if live is None:
        raise ValueError(f"no running log at {state}: extend it first")
    return live.where("path is null")


def extend(spark: SparkSession, log: str, state: str, what: Running, width: int = SEQ_BUCKET_WIDTH) -> dict[str, int]:
    """Take in what was appended to ``log``; how many ``files`` were read and
    their ``rows``, and how many earlier batches were ``replaced``."""
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(log)
              .select("path", "length"))  # names and sizes: contents are not read
    live = _live(spark, state)
    fresh, gone = listed, None
    if live is not None:
        known = live.where("path is not null").select("path", "length", "batch")
        fresh = listed.join(known, ["path", "length"], "left_anti")
        lost = known.join(listed, ["path", "length"], "left_anti").select("batch").distinct()
        gone = live.where("path is null").join(lost, "batch").agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"),
                                                                  F.collect_list("batch").alias("batches")).first()
    paths = [r["path"] for r in fresh.collect()]
    if not paths and not (gone and gone["n"]):
        return {"files": 0, "rows": 0, "replaced": 0}
    rows = write_once(what.read(spark, paths), "log") if paths else None
    lows = [rows.agg(F.min("seq")).first()[0] if paths else None, gone["lo"] if gone else None]
    low = min((x for x in lows if x is not None), default=None)
    replaced, files = list(gone["batches"]) if gone else [], fresh
    if live is not None:
        old = live.where("path is null")
        if low is not None:
            replaced += [r["batch"] for r in old.where(F.col("hi") >= low).select("batch").collect()]
        if replaced := sorted(set(replaced)):
            again = (live.where(F.col("path").isNotNull() & F.col("batch").isin(replaced)).select("path", "length")
                     .join(listed, ["path", "length"], "left_semi"))
            more = [r["path"] for r in again.collect()]
            if more:
                back = what.read(spark, more)
                rows = write_once(back if rows is None else rows.unionByName(back), "log")
                files, paths = fresh.unionByName(again), paths + more
    batch = uuid.uuid4().hex
    lo, hi, n = rows.agg(F.min("seq"), F.max("seq"), F.count(F.lit(1))).first() if rows is not None else (None, None, 0)
    folder = None
    own = rows.agg(*what.summary()) if rows is not None else spark.range(1).select(F.col("id").alias("n"))
    if n:
        before = what.carried(live.where(F.col("path").isNull() & (F.col("hi") < lo) & ~F.col("batch").isin(replaced))) \
            if live is not None else what.carried(own.withColumn("lo", F.lit(lo)).limit(0))
        folder = f"{state}/rows/{batch}"
        what.scanned(rows, before, width).write.parquet(folder)
    of = [F.lit(batch).alias("batch"), F.lit(lo).cast("long").alias("lo"), F.lit(hi).cast("long").alias("hi")]
    head = own.select(*of, F.lit(None).cast("string").alias("path"), F.lit(folder).cast("string").alias("folder"),
                      F.array(*[F.lit(b) for b in replaced]).cast("array<string>").alias("replaces"), *own.columns)
    # one file, so that one rename puts a batch in force
    (head.unionByName(files.select(*of, "path", "length"), allowMissingColumns=True).coalesce(1)
     .write.mode("append").parquet(f"{state}/ledger"))
    return {"files": len(paths), "rows": n, "replaced": len(replaced)}


def running_rows(spark: SparkSession, state: str) -> DataFrame:
    """The log's rows (those of ``where``) with their running columns."""
    folders = [r["folder"] for r in _batches(spark, state).where("folder is not null").select("folder").collect()]
    if not folders:
        raise ValueError("the log has no rows yet")
    return spark.read.parquet(*folders)


def running_totals(spark: SparkSession, state: str, what: Running) -> DataFrame:
    """One row: the sums and maxima over the whole log, from the summaries alone."""
    return _batches(spark, state).agg(*[F.sum(f"sum_{k}").alias(k) for k in what.sums],
                                      *[F.max(f"top_{k}").alias(k) for k in what.maxima])


# ---- the experiment log ------------------------------------------------------

def experiments() -> Running:
    """Positions, running best of kept scores and baseline among valid rows."""
    kept = F.when(F.col("status") == KEEP, F.col("val_score"))
    return Running(read_new_experiments, F.col("status") != CRASH, running_max={"running_best": (kept, True)},
                   first={"baseline": F.col("val_score")})


def running_best(spark: SparkSession, state: str) -> DataFrame:
    """As ``results.running_best``."""
    return running_rows(spark, state).where(F.col("status") == KEEP)


def kept_gains() -> Running:
    """The kept rows, each with the kept score before it."""
    return Running(read_new_experiments, F.col("status") == KEEP, lag={"prev_score": F.col("val_score")})


def running_gains(spark: SparkSession, state: str) -> DataFrame:
    """As ``results.gains``."""
    return (running_rows(spark, state).where(F.col("idx") > 0).drop("idx")
            .withColumn("delta", F.col("val_score") - F.col("prev_score")))


# ---- the result log ----------------------------------------------------------

def sweep() -> Running:
    """The best before each run, and what the status, best-config and summary views need."""
    score = F.col("val_score")
    ok = score.isNotNull() & (score > 0) & F.get_json_object("config", "$").isNotNull()
    key = lambda v: F.struct(v.alias("score"), (-F.col("seq")).alias("place"), F.col("config").alias("config"))
    return Running(read_new_results, running_max={"ok_best": (F.when(F.col("status") == "ok", score), False)},
                   sums={"total": F.lit(1)},
                   maxima={"best": F.when(ok, key(score)), "top": key(F.coalesce(score, F.lit(0.0))), "has_best": score > 0})


def new_best_flags(spark: SparkSession, state: str) -> DataFrame:
    """As ``results.new_best_flags``."""
    before = F.greatest(F.coalesce(F.col("ok_best"), F.lit(0.0)), F.lit(0.0))
    return running_rows(spark, state).select("seq", "val_score", "status", before.alias("best_before"), (
        (F.col("status") == "ok") & F.coalesce(F.col("val_score") > before, F.lit(False))).alias("new_best"))


def sweep_status(spark: SparkSession, state: str) -> DataFrame:
    """One row: number of runs, whether any can be a best, the best score and its
    config (as ``results.best_config`` and ``results_status``), and the top score
    and config of the summary (as ``results.sweep_summary``)."""
    return running_totals(spark, state, sweep()).select(
        F.col("total").alias("num_experiments"), F.coalesce("has_best", F.lit(False)).alias("has_best"),
        F.coalesce("best.score", F.lit(0.0)).alias("best_val_score"), F.coalesce("best.config", F.lit("{}")).alias("best_config"),
        (-F.col("best.place")).alias("best_seq"), F.coalesce("top.score", F.lit(0.0)).alias("top_val_score"),
        F.coalesce("top.config", F.lit("{}")).alias("top_config"))
