"""Balanced shards: minimax contiguous partition of ordered groups.

Rows with equal texts form a group that no cut divides.  Groups are put into
an order, and the order is cut into contiguous runs, one per shard, so that
the largest shard is as small as possible: a binary search finds the smallest
capacity for which filling shard after shard, greedily, needs no more shards
than there are; the cuts are made there.

The order.  Groups are numbered by a hash of their text into ``atoms`` slots;
the slots, holding whole groups, are the atomic sizes, so what the driver
searches is bounded however many groups there are.  Slots above
1/``HEAVY_PART`` of the ideal shard (at most shards x HEAVY_PART of them) come
first: largest first, each heads the shard that is emptiest so far, as its
starting load.  All others follow in hash order and are cut contiguously on
top of these loads.  A group larger than the ideal shard so takes a shard of
its own, and the rest stays even.

Law ``bytes``: a row's size is its text's UTF-8 bytes plus ``row_bytes``, and
the shards' sizes are near equal, up to one slot and to groups that are larger
than an ideal shard by themselves.

Defined results: null texts are one group with no bytes; empty texts another;
rows that repeat a doc_id, or are repeated whole, each take a slot of their
own; slots of a shard are numbered from 0 without gaps; an empty table gives
an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scriptmill.llm.common import materialize

SHARDS = 40
ROW_BYTES = 16
ATOMS = 1 << 18
HEAVY_PART = 64
SLOT_PARTS = 256


def greedy_cuts(upto: np.ndarray, loads: list[int], capacity: int) -> list[int] | None:
    """Where the ordered sizes (``upto``: their running sum from 0) are cut when
    each shard is filled up to ``capacity`` on top of its load; None if the
    shards do not hold them."""
    cuts, at = [], 0
    for load in loads:
        if load > capacity:
            return None
        at = int(np.searchsorted(upto, upto[at] + capacity - load, side="right")) - 1
        cuts.append(at)
    return cuts if at == len(upto) - 1 else None


def minimax_cuts(sizes: np.ndarray, loads: list[int]) -> list[int]:
    """Cuts at the smallest feasible capacity, found by binary search."""
    upto = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    low, high = max(loads), int(upto[-1]) + max(loads)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if greedy_cuts(upto, loads, mid) else (mid + 1, high)
    return greedy_cuts(upto, loads, low)


def assign_atoms(atom: np.ndarray, size: np.ndarray, shards: int) -> tuple[dict[int, int], list[int]]:
    """The shard of each heavy atom, and for the light ones in order the first
    atom of every shard but the first."""
    order = np.argsort(atom)
    atom, size = atom[order], size[order]
    heavy = size * HEAVY_PART * shards > size.sum()
    emptiest = [(0, s) for s in range(shards)]
    placed: dict[int, int] = {}
    for a, n in sorted(zip(atom[heavy].tolist(), size[heavy].tolist(), strict=True), key=lambda x: (-x[1], x[0])):
        load, s = heapq.heappop(emptiest)
        placed[a] = s
        heapq.heappush(emptiest, (load + n, s))
    loads = [load for load, _ in sorted(emptiest, key=lambda x: x[1])]
    light, light_size = atom[~heavy], size[~heavy]
    # shards whose heavy atoms alone pass the level that the others fill up to take nothing more
    open_to = sorted(range(shards), key=lambda s: loads[s])
    rest = int(light_size.sum())
    while len(open_to) > 1 and loads[open_to[-1]] * len(open_to) >= rest + sum(loads[s] for s in open_to):
        open_to.pop()
    open_to.sort()
    cuts = minimax_cuts(light_size, [loads[s] for s in open_to])
    ends = dict(zip(open_to, cuts, strict=True))
    firsts, at = [], 0
    for s in range(shards):
        if s:
            firsts.append(int(light[at]) if at < len(light) else int(np.iinfo(np.int64).max))
        at = ends.get(s, at)
    return placed, firsts


def shard_rows(docs: DataFrame, shards: int = SHARDS, row_bytes: int = ROW_BYTES, atoms: int = ATOMS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row."""
    spark = docs.sparkSession
    # the row number only tells repeated rows apart and spreads them; it is fixed by being written
    base = materialize(docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(row_bytes)).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.pmod(F.xxhash64(F.col("text").isNull(), F.col("text")), F.lit(atoms)).cast("long").alias("atom"),
        F.monotonically_increasing_id().alias("row")), "shards")
    got = base.groupBy("atom").agg(F.sum("size").alias("size")).toPandas()  # at most ``atoms`` rows
    placed, firsts = assign_atoms(got["atom"].to_numpy(np.int64), got["size"].to_numpy(np.int64), shards)
    light = F.lit(0)
    for first in firsts:
        light = light + (F.col("atom") >= F.lit(first)).cast("int")
    heavy = spark.createDataFrame(list(placed.items()), "heavy long, heavy_shard int")
    rows = (base.join(F.broadcast(heavy), F.col("atom") == F.col("heavy"), "left")
            .withColumn("shard", F.coalesce("heavy_shard", light))
            .withColumn("piece", F.pmod(F.xxhash64("row"), F.lit(SLOT_PARTS)).cast("int"))
            .select("doc_id", "size", "text_crc32", "row", "shard", "piece"))
    # slots: a count per (shard, piece), at most shards x SLOT_PARTS, then positions inside each piece
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"))
               .select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    within = Window.partitionBy("shard", "piece").orderBy("row")
    return (rows.withColumn("at", F.row_number().over(within)).join(F.broadcast(offsets), ["shard", "piece"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("offset") + F.col("at") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
