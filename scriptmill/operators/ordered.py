"""Order-dependent operators that stay distributed.

A window without ``partitionBy`` runs in one task.  Logs, shuffles and splits
need global positions, running maxima and lags over the whole table, so
these helpers scan in levels instead: rows go to *buckets* that are monotone in
the sort order and bounded in size (a hash prefix, a ``seq`` range, a value
range), a summary with one row per bucket is scanned in order and joined back,
and a window partitioned by bucket does the rest.  Nothing here runs a job when
it is called, but for ``global_rank``, which writes its rows once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_bucket
from ..functions.text import col_of
from ..session import write_once

SEQ_BUCKET_WIDTH = 1 << 16
#: buckets per group of the two-level scan: a group covers 2**32 positions
SUPER = 1 << 16


def seq_bucket(seq="seq", width: int = SEQ_BUCKET_WIDTH) -> Column:
    """Bucket of a unique integer position: at most ``width`` rows each."""
    return F.floor(col_of(seq) / F.lit(width)).cast("long")


def _bucket_offsets(df: DataFrame, bucket: str, out: str) -> DataFrame:
    """Rows before each bucket and in all (``_total``): one row per bucket of a
    bucketing whose number of buckets is bounded, prefix-summed in order."""
    counts = df.groupBy(bucket).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(bucket, F.coalesce(F.sum("_n").over(w), F.lit(0)).cast("long").alias(out),
                         F.sum("_n").over(Window.partitionBy()).alias("_total"))


def rank_by_hash(df: DataFrame, h: str, tiebreak: Sequence[str], out: str = "pos",
                 bits: int = 16, total: str | None = None) -> DataFrame:
    """0-based position of each row in the order ``(h, *tiebreak)``, and the
    number of rows as ``total`` if named.

    ``h`` is a uniformly distributed 32-bit hash of a unique key.  Buckets are
    its leading ``bits`` bits, so the per-bucket table has at most
    ``2**bits`` rows and is broadcast; the row numbers inside a bucket come
    from a window partitioned by bucket (one shuffle, no hot partition).
    """
    b = "_bucket"
    d = df.withColumn(b, hash_bucket(h, bits))
    offsets = _bucket_offsets(d, b, "_offset")
    w = Window.partitionBy(b).orderBy(h, *tiebreak)
    out_df = (d.join(F.broadcast(offsets), b)
               .withColumn(out, F.col("_offset") + F.row_number().over(w) - 1)
               .drop(b, "_offset"))
    return out_df.withColumnRenamed("_total", total) if total else out_df.drop("_total")


def seq_scan(df: DataFrame, seq: str = "seq", width: int = SEQ_BUCKET_WIDTH, *, idx: str | None = None,
             running_max: dict[str, tuple[Column, bool]] | None = None,
             lag: dict[str, Column] | None = None, first: dict[str, Column] | None = None) -> DataFrame:
    """Order-dependent columns of a log in one pass over its buckets.

    ``idx`` names the 0-based position in ``seq`` order (``seq`` are unique
    integers); ``running_max`` maps a name to (value, whether the row itself
    counts), nulls ignored; ``lag`` maps a name to the value of the row before;
    ``first`` maps a name to the value of the first row of all.

    One aggregation makes a summary row per ``seq`` bucket.  The summaries are
    scanned in two levels: inside groups of ``SUPER`` buckets by a window
    partitioned by group, then over one row per group, so no window without a
    partition key sees more than (rows / (width * SUPER)) rows.
    """
    running_max, lag, first = running_max or {}, lag or {}, first or {}
    d = df.withColumn("_b", seq_bucket(seq, width))
    for name, (value, _) in running_max.items():
        d = d.withColumn(f"_m_{name}", value)
    for name, value in lag.items():
        d = d.withColumn(f"_l_{name}", value)
    for name, value in first.items():
        d = d.withColumn(f"_f_{name}", value)
    cell = lambda c: F.struct(F.col(c).alias("v"))  # noqa: E731  keeps a null apart from no row
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.max(f"_m_{n}").alias(f"_m_{n}") for n in running_max]
    aggs += [F.max_by(cell(f"_l_{n}"), seq).alias(f"_l_{n}") for n in lag]
    aggs += [F.min_by(cell(f"_f_{n}"), seq).alias(f"_f_{n}") for n in first]
    buckets = d.groupBy("_b").agg(*aggs).withColumn("_g", F.floor(F.col("_b") / SUPER))

    def scanned(table: DataFrame, part: list[str], order: str, tag: str) -> DataFrame:
        before = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        out = table.withColumn(f"_n{tag}", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        for n in running_max:
            out = out.withColumn(f"_m_{n}{tag}", F.max(f"_m_{n}").over(before))
        for n in lag:
            out = out.withColumn(f"_l_{n}{tag}", F.last(f"_l_{n}", ignorenulls=True).over(before))
        return out

    inner = scanned(buckets, ["_g"], "_b", "1")
    tops = buckets.groupBy("_g").agg(
        F.sum("_n").alias("_n"), *[F.max(f"_m_{n}").alias(f"_m_{n}") for n in running_max],
        *[F.max_by(f"_l_{n}", "_b").alias(f"_l_{n}") for n in lag],
        *[F.min_by(f"_f_{n}", "_b").alias(f"_f_{n}") for n in first])
    outer = scanned(tops, [], "_g", "2")
    for n in first:
        outer = outer.withColumn(f"_f_{n}2", F.first(f"_f_{n}").over(
            Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, 0)))
    keep1 = ["_b", "_g", "_n1", *[f"_m_{n}1" for n in running_max], *[f"_l_{n}1" for n in lag]]
    keep2 = ["_g", "_n2", *[f"_m_{n}2" for n in running_max], *[f"_l_{n}2" for n in lag], *[f"_f_{n}2" for n in first]]
    out = d.join(inner.select(*keep1).join(outer.select(*keep2), "_g"), "_b")
    w = Window.partitionBy("_b").orderBy(seq)
    if idx:
        out = out.withColumn(idx, F.col("_n2") + F.col("_n1") + F.row_number().over(w) - 1)
    for n, (_, inclusive) in running_max.items():
        frame = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        out = out.withColumn(n, F.greatest(F.col(f"_m_{n}2"), F.col(f"_m_{n}1"), F.max(f"_m_{n}").over(frame)))
    for n in lag:
        out = out.withColumn(n, F.when(F.row_number().over(w) == 1, F.coalesce(F.col(f"_l_{n}1"), F.col(f"_l_{n}2"))["v"])
                             .otherwise(F.lag(f"_l_{n}", 1).over(w)))
    for n in first:
        out = out.withColumn(n, F.col(f"_f_{n}2")["v"])
    names = [idx] if idx else []
    return out.select(*df.columns, *names, *running_max, *lag, *first)


def rank_by_seq(df: DataFrame, seq: str = "seq", out: str = "idx", width: int = SEQ_BUCKET_WIDTH) -> DataFrame:
    """0-based position in ``seq`` order."""
    return seq_scan(df, seq, width, idx=out)


def running_max_by_seq(df: DataFrame, value, seq: str = "seq", out: str = "running_max",
                       inclusive: bool = True, width: int = SEQ_BUCKET_WIDTH) -> DataFrame:
    """Running ``max(value)`` in ``seq`` order; ``inclusive=False``: over the rows strictly before."""
    return seq_scan(df, seq, width, running_max={out: (col_of(value), inclusive)})


def lag_by_seq(df: DataFrame, value, seq: str = "seq", out: str = "prev", width: int = SEQ_BUCKET_WIDTH) -> DataFrame:
    """``lag(value, 1)`` in ``seq`` order across the whole table."""
    return seq_scan(df, seq, width, lag={out: col_of(value)})


def position_by(df: DataFrame, order: str, out: str, cuts: int | None = None) -> DataFrame:
    """0-based position in the rising order of a unique column, written once."""
    return _by_range(df, [F.col(order)], out, cuts)


def _by_range(df: DataFrame, order: list[Column], out: str, cuts: int | None) -> DataFrame:
    """0-based position in a sort order whose key is unique."""
    n = cuts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = write_once(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                      .withColumn("_id", F.monotonically_increasing_id()), "rank")
    ranged = kept.withColumn("_p", F.shiftright("_id", 33))  # an id is the range and the place in it
    offsets = _bucket_offsets(ranged, "_p", "_offset").drop("_total")
    place = F.col("_id").bitwiseAND((1 << 33) - 1)
    return ranged.join(F.broadcast(offsets), "_p").withColumn(out, F.col("_offset") + place).select(*df.columns, out)


def global_rank(df: DataFrame, value: Column, seq: str = "seq", out: str = "rank", cuts: int | None = None) -> DataFrame:
    """1-based position by ``value`` falling (null last), ties by ``seq`` rising (unique).

    Rows are dealt over ``cuts`` ranges (default: the shuffle partitions) of the
    whole sort key, so a value that holds a third of the rows is split by
    ``seq``, sorted inside each and written once.  A row's place in its range is
    in its row id; the ranges' counts, one small row each, are summed and added.
    Unlike the rest of this module this writes when it is called.
    """
    ranked = _by_range(df.withColumn("_v", value), [F.col("_v").desc_nulls_last(), F.col(seq)], out, cuts)
    return ranked.withColumn(out, F.col(out) + 1).drop("_v")


def cut_classes(df: DataFrame, h: str, key: str, targets: Callable[[Column], Sequence[Column]], out: str, bits: int = 16) -> DataFrame:
    """How many of the rising ``targets`` (positions, from the number of rows) a
    row's position in the order ``(h, key)`` has reached, without ranking.

    The smallest pair of each position is found by counting: rows per hash
    prefix (at most ``2**bits`` counters), then the rows of the one prefix that
    holds it.  All rows are then compared with those few pairs where they lie:
    only hashes and keys of a few prefixes are shuffled, no record moves.  Rows
    that equal such a pair (copies of one key) are numbered among themselves, so
    every class has its exact size.
    """
    d = df.withColumn("_b", hash_bucket(h, bits))
    counts = d.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    wanted = list(targets(F.col("_total")))
    cells = (counts.select("_b", "_n", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_total"))
             .select("_b", "_n", "_before", F.posexplode(F.array(*[t.cast("long") for t in wanted])).alias("_i", "_t"))
             .where((F.col("_before") <= F.col("_t")) & (F.col("_t") < F.col("_before") + F.col("_n")))
             .select(F.col("_b"), "_i", (F.col("_t") - F.col("_before")).alias("_rest")))
    # at most one cell a target; its rows are 1 / 2**bits of all
    inside = Window.partitionBy("_i").orderBy(h, key)
    picked = (d.select("_b", h, key).join(F.broadcast(cells), "_b")
              .withColumn("_k", F.row_number().over(inside) - 1)
              .withColumn("_same", F.col("_k") - F.rank().over(inside) + 1)
              .where(F.col("_k") == F.col("_rest")).select("_i", F.struct(F.col(h).alias("h"), F.col(key).alias("k")).alias("_at"), "_same"))
    pairs = picked.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("_i", F.struct("_at", "_same")))).alias("_cuts"))  # one row
    at = F.struct(F.col(h).alias("h"), F.col(key).alias("k"))
    c = [F.element_at("_cuts", F.lit(i)) for i in range(len(wanted))]  # null: beyond the last row
    marked = df.join(F.broadcast(pairs))
    equal = reduce(lambda a, b: a | b, [F.coalesce(at == x["_at"], F.lit(False)) for x in c])
    reached = lambda more: sum((F.coalesce((at > x["_at"]) | more(x), F.lit(False)).cast("int") for x in c[1:]),
                               F.coalesce((at > c[0]["_at"]) | more(c[0]), F.lit(False)).cast("int"))
    # copies of a pair: numbered among themselves
    copies = (marked.where(equal).withColumn("_k", F.row_number().over(Window.partitionBy(h, key).orderBy(h)) - 1))
    numbered = copies.withColumn(out, reached(lambda x: (at == x["_at"]) & (F.col("_k") >= x["_same"]))).drop("_k")
    others = marked.where(~equal).withColumn(out, reached(lambda x: F.lit(False)))
    return others.unionByName(numbered).drop("_cuts")
