"""Parameter grids: expansion, estimates, config resolution.

A grid is a map ``key -> list of values`` (JSON text or a map column), one
per row.  Expansion is a generator, not a join: each combination is an
ordinal ``i`` in ``[0, total)``, and key ``k`` (keys sorted, last key
fastest) takes position ``(i div stride_k) mod len_k`` of its list, where
``stride_k`` is the product of the later lists' lengths.  No cross join is
formed; ordinals are made in chunks that are dealt over the tasks, so one grid
of any size expands in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import TIME_BUDGET, TRAIN_DEFAULTS
from ..functions.text import col_of

GRID_TYPE = "map<string,array<string>>"
#: ordinals expanded from one row at a time
CHUNK = 1 << 16


def parse_grid(grid_json) -> Column:
    """JSON object of lists to ``map<string, array<string>>`` (values as JSON text)."""
    return F.from_json(col_of(grid_json), GRID_TYPE)


def grid_size(grid) -> Column:
    """Number of combinations (product of list lengths)."""
    sizes = F.transform(F.map_values(col_of(grid)), lambda v: F.size(v).cast("long"))
    return F.aggregate(sizes, F.lit(1).cast("long"), lambda acc, x: acc * x)


def expand_grid(df: DataFrame, grid: str = "grid", max_experiments: int = 0) -> DataFrame:
    """One row per combination: ``ordinal`` (1-based) and ``combo``, an array of
    ``(key, value)`` in key order.  ``max_experiments > 0`` keeps the first N."""
    entries = F.array_sort(F.map_entries(col_of(grid)))  # sorted by key
    d = df.withColumn("_e", entries).withColumn("_total", grid_size(grid))
    # stride of entry j = product of the lengths after j
    d = d.withColumn("_len", F.transform("_e", lambda e: F.size(e["value"]).cast("long")))
    d = d.withColumn("_stride", F.transform(
        "_len", lambda _, j: F.aggregate(F.slice("_len", j + 2, F.size("_len")), F.lit(1).cast("long"),
                                         lambda acc, x: acc * x)))
    n = F.col("_total") if max_experiments <= 0 else F.least(F.col("_total"), F.lit(max_experiments).cast("long"))
    # chunks of ordinals first, dealt over tasks, then the ordinals of each chunk: a grid of any
    # size is spread, and no row holds more than a chunk's numbers
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    d = d.withColumn("_n", n).where("_n > 0").withColumn("_chunk", F.explode(F.sequence(zero, F.expr(f"(_n - 1) div {CHUNK}"))))
    # a stated number: chunks are small rows that adaptive execution would put back together
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = d.repartition(tasks, F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")], "_chunk"))
    start = F.col("_chunk") * CHUNK
    d = d.withColumn("_i", F.explode(F.sequence(start, F.least(start + CHUNK, F.col("_n")) - one)))
    # i div stride, in integers: exact beyond 2^53
    combo = F.transform("_e", lambda e, j: F.struct(
        e["key"].alias("key"),
        F.element_at(e["value"], (F.pmod(F.call_function("div", F.col("_i"), F.element_at("_stride", j + 1)),
                                         F.element_at("_len", j + 1)) + 1).cast("int")).alias("value")))
    keep = [c for c in df.columns]
    return d.select(*keep, (F.col("_i") + 1).alias("ordinal"), combo.alias("combo"))


def combo_json(combo) -> Column:
    """Compact JSON of a combination (values are JSON text already)."""
    parts = F.transform(col_of(combo), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"]))
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))


def estimate_minutes(total, budget_s: int = TIME_BUDGET) -> Column:
    """``total * budget // 60``."""
    return F.call_function("div", col_of(total) * F.lit(budget_s), F.lit(60)).cast("long")


def resolve_config(overrides, time_budget: int = TIME_BUDGET, defaults: dict = TRAIN_DEFAULTS) -> Column:
    """Defaults overlaid by the overrides whose key is a known setting, plus
    the time budget: a ``map<string,string>``."""
    ov = col_of(overrides)
    known = F.array(*[F.lit(k) for k in defaults])
    d = F.create_map(*[x for k, v in defaults.items() for x in (F.lit(k), F.lit(v))])
    ov_known = F.map_filter(ov, lambda k, v: F.array_contains(known, k))
    base = F.map_filter(d, lambda k, v: ~F.array_contains(F.map_keys(ov_known), k) & (k != "TIME_BUDGET"))
    return F.map_concat(base, F.map_filter(ov_known, lambda k, v: k != "TIME_BUDGET"),
                        F.create_map(F.lit("TIME_BUDGET"), F.lit(str(time_budget))))
