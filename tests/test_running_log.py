import glob
import os

import pytest
from pyspark.sql import functions as F

from scriptmill.operators import results as R
from scriptmill.sources.results_log import append_experiments, append_results, read_experiments, read_results
from scriptmill.streaming import running_log as L


def _experiments(spark, n=400):
    seq = F.col("id")
    score = F.when(seq % 11 == 3, "n/a").otherwise((F.pmod(F.xxhash64(seq), F.lit(1000)) / 1000 + seq / 5000).cast("string"))
    status = F.element_at(F.array(*[F.lit(s) for s in ("keep", "discard", "crash", " KEEP", "keep")]), (F.pmod(F.hash(seq), F.lit(5)) + 1))
    return spark.range(n).select(seq.alias("seq"), F.concat(F.lit("c"), seq).alias("commit"), score.alias("val_score"),
                                 F.lit("1.5").alias("memory_gb"), status.alias("status"), F.concat(F.lit('try "x"\t'), seq).alias("description"))


def _results(spark, n=300):
    seq = F.col("id")
    score = F.round(F.pmod(F.xxhash64(seq), F.lit(50)) / 100 + seq / 1000, 3)
    return spark.range(n).select(
        seq.alias("seq"), F.current_timestamp().alias("ts"), F.when(seq % 13 != 5, score).alias("val_score"),
        *[F.lit(0.5).alias(c) for c in ("syntax", "keyword", "structure")], F.when(seq % 4 == 1, "error").otherwise("ok").alias("status"),
        F.lit(2.0).alias("elapsed_s"), F.when(seq % 9 == 2, "no json").otherwise(F.concat(F.lit('{"a":'), seq, F.lit("}"))).alias("config"))


def _rows(df):
    cols = sorted(df.columns)
    return sorted(map(repr, (tuple(r[c] for c in cols) for r in df.select(*cols).collect())))


def _parts(log):
    return sorted(glob.glob(f"{log}/part-*.csv"))


def test_appends_in_order_read_only_what_is_new(spark, tmp):
    log, state, gains = f"{tmp}/log", f"{tmp}/state", f"{tmp}/gains"
    rows = _experiments(spark)
    for i, (a, b) in enumerate([(0, 250), (250, 251), (251, 400)]):
        before = len(_parts(log))
        append_experiments(rows.where(f"{a} <= seq and seq < {b}").repartition(3), log)
        got = L.extend(spark, log, state, L.experiments(), width=16)
        assert got == {"files": len(_parts(log)) - before, "rows": b - a, "replaced": 0}
        L.extend(spark, log, gains, L.kept_gains(), width=16)
        whole = read_experiments(spark, log)
        assert _rows(L.running_best(spark, state)) == _rows(R.running_best(whole, 32))
        assert _rows(L.running_gains(spark, gains)) == _rows(R.gains(whole, 32))
    assert L.extend(spark, log, state, L.experiments()) == {"files": 0, "rows": 0, "replaced": 0}


def _check_sweep(spark, log, state):
    whole = read_results(spark, log)
    assert _rows(L.new_best_flags(spark, state)) == _rows(R.new_best_flags(whole, 32))
    best, status, top = R.best_config(whole).first(), R.results_status(whole).first(), R.sweep_summary(whole).first()
    assert tuple(L.sweep_status(spark, state).first()) == (*status, *best, top.best_val_score, top.best_config)


def test_rows_out_of_order_changed_and_lost_files(spark, tmp):
    log, state = f"{tmp}/log", f"{tmp}/state"
    rows = _results(spark)
    take = lambda cond: append_results(rows.where(cond).repartition(2), log)
    grow = lambda: L.extend(spark, log, state, L.sweep(), width=16)
    for cond, n, replaced in (("seq < 100", 100, 0), ("seq between 100 and 199 and seq % 5 > 0", 80, 0),
                              ("seq between 100 and 199 and seq % 5 = 0", 100, 1), ("seq >= 200", 100, 0)):
        take(cond)
        got = grow()
        assert (got["rows"], got["replaced"]) == (n, replaced)
        _check_sweep(spark, log, state)
    for crc in glob.glob(f"{log}/.*.crc"):
        os.remove(crc)
    last = max(_parts(log), key=os.path.getmtime)
    lines = open(last).read().splitlines(keepends=True)
    with open(last, "w") as f:
        f.writelines(lines[:-1])
    got = grow()
    assert got["replaced"] == 1 and got["rows"] == 99
    _check_sweep(spark, log, state)
    for path in _parts(log):
        if any(line.endswith("\t0\n") for line in open(path)):
            os.remove(path)  # the first batch loses a file: everything from there on is read again
    assert grow()["replaced"] == 3
    _check_sweep(spark, log, state)


def test_empty_logs_and_unnumbered_lines(spark, tmp):
    log, state = f"{tmp}/log", f"{tmp}/state"
    os.makedirs(log)
    assert L.extend(spark, log, state, L.sweep())["files"] == 0
    with pytest.raises(ValueError):
        L.running_rows(spark, state)
    append_results(_results(spark).where("seq < 0"), log)
    assert L.extend(spark, log, state, L.sweep())["rows"] == 0
    append_results(_results(spark, 20), log)
    assert L.extend(spark, log, state, L.sweep())["rows"] == 20
    _check_sweep(spark, log, state)
    with open(f"{log}/part-x.csv", "w") as f:
        f.write("2024-01-01 10:00\t0.5\t0\t0\t0\tok\t1\t{}\n")
    with pytest.raises(Exception, match="no number"):
        L.extend(spark, log, state, L.sweep())
    assert L.sweep_status(spark, state).first().num_experiments == 20
