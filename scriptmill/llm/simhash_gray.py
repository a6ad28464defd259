"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are 64-bit majority votes over hashed word shingles.  Links are
pairs of fingerprints at most ``max_bits`` apart; components of links are the
duplicate groups.

Index.  Fingerprints are sorted by Gray rank, so neighbours share most bits.
Windows of ``FAN`` neighbours form a node that stores the bit pattern all its
members share; windows of nodes form upper nodes, and every node keeps only
the shared bits its parent does not already hold.  A search walks down from
the root and adds the differences on those bits; a node whose accumulated
difference exceeds the limit is pruned with everything below it, and a node
whose free bits cannot exceed the limit any more is linked as a whole.

Distribution.  Two fingerprints within ``max_bits`` agree on at least one of
``max_bits + 1`` bit bands, so each (band, value) is an independent index.  A
band value shared by more than ``group_limit`` fingerprints is split again on
sub-bands of its remaining bits by the same argument.

Defined results: null text counts as empty; a text without words has
fingerprint zero and is linked like any other; exact copies share a
fingerprint and are indexed once; rows that repeat a doc_id are all returned;
a null doc_id is returned and never chosen as component id unless the whole
component has none; other columns of the input are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptmill.llm.common import components, materialize, shuffle_parts

SHINGLE_WORDS = 4
MAX_BITS = 4
GROUP_LIMIT = 100_000
FAN = 8
FRONTIER = 1 << 20
QUERIES = 1 << 13


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Majority-vote fingerprint of one text as an unsigned integer."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    lasts = ends[min(shingle_words, len(words)) - 1:].tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(joined[a:b], 42) for a, b in zip(starts.tolist(), lasts, strict=False)),
                         dtype="<u8", count=n)
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        block = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > n, bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a signed long) of every row, and the columns to ``carry``."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle_words) for t in texts], dtype="<u8").view("<i8"))

    return docs.select("doc_id", fp(F.coalesce("text", F.lit(""))).alias("fp"), *carry)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each 64-bit code in the reflected Gray sequence."""
    out = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    return out


class GrayIndex:
    """Hierarchical index over codes sorted by (group, Gray rank); every group
    has a root of its own and a search stays inside its group."""

    def __init__(self, codes: np.ndarray, group: np.ndarray, max_bits: int):
        self.codes, self.max_bits = codes, max_bits
        self.levels = []  # from the leaves up: first leaf, leaf end, first child, children, pattern, own bits, free bits
        n = len(codes)
        first, end, grp = np.arange(n), np.arange(1, n + 1), group
        child, fan = first, np.zeros(n, dtype=np.int64)
        both, either = codes, codes
        while True:
            shared = ~(both ^ either)
            self.levels.append({"first": first, "end": end, "child": child, "fan": fan, "pattern": both & shared,
                                "shared": shared, "free": 64 - np.bitwise_count(shared).astype(np.int64)})
            heads = np.flatnonzero(np.concatenate(([True], grp[1:] != grp[:-1])))
            sizes = np.diff(np.append(heads, len(grp)))
            if sizes.max(initial=1) == 1:
                break
            rank = np.arange(len(grp)) - np.repeat(heads, sizes)
            starts = np.flatnonzero(rank % FAN == 0)
            self.levels[-1]["up"] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(grp))))
            both = np.bitwise_and.reduceat(both, starts)
            either = np.bitwise_or.reduceat(either, starts)
            end = end[np.append(starts[1:], len(grp)) - 1]
            first, grp = first[starts], grp[starts]
            child, fan = starts, np.diff(np.append(starts, len(rank)))
        for lower, upper in zip(self.levels, self.levels[1:], strict=False):
            lower["own"] = lower["shared"] & ~upper["shared"][lower["up"]]
        self.levels[-1]["own"] = self.levels[-1]["shared"]
        self.root_of = np.repeat(np.arange(len(grp)), np.diff(np.append(heads, len(grp)))) if n else first
        for lv in reversed(self.levels[:-1]):  # root of each leaf, carried down
            self.root_of = self.root_of[lv["up"]]

    def connected(self) -> np.ndarray:
        """Component label (smallest leaf) of each leaf under links of at most
        ``max_bits`` differing bits."""
        n, comp = len(self.codes), np.arange(len(self.codes))
        if n < 2:
            return comp
        lv = self.levels[0]
        near = np.bitwise_count(self.codes[1:] ^ self.codes[:-1]) <= self.max_bits
        near &= self.root_of[1:] == self.root_of[:-1]
        at = np.flatnonzero(near)
        comp = _merge(comp, at, at + 1)
        for lv in self.levels[1:]:  # members of a node with few free bits are all within reach of each other
            tight = np.flatnonzero((lv["free"] <= self.max_bits) & (lv["end"] - lv["first"] > 1))
            size = (lv["end"] - lv["first"])[tight]
            leaves = np.repeat(lv["first"][tight], size)
            comp = _merge(comp, leaves, leaves + _within(size))
        for q0 in range(0, n, QUERIES):
            a, b = self._search(np.arange(q0, min(n, q0 + QUERIES)), comp)
            comp = _merge(comp, a, b)
        return comp

    def _search(self, queries: np.ndarray, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links from each query to later leaves of its group.  Nodes wholly in
        the query's component already are passed over: they add nothing."""
        whole = []
        for lv in self.levels:
            low, high = np.minimum.reduceat(comp, lv["first"]), np.maximum.reduceat(comp, lv["first"])
            whole.append(np.where(low == high, low, -1))
        top = len(self.levels) - 1
        stack = [(top, queries, self.root_of[queries], np.zeros(len(queries), dtype=np.int64))]
        found_a, found_b = [queries[:0]], [queries[:0]]
        while stack:
            level, q, node, acc = stack.pop()
            if len(q) > FRONTIER:
                half = len(q) // 2
                stack += [(level, q[:half], node[:half], acc[:half]), (level, q[half:], node[half:], acc[half:])]
                continue
            lv = self.levels[level]
            keep = (lv["end"][node] - 1 > q) & (whole[level][node] != comp[q])
            q, node, acc = q[keep], node[keep], acc[keep]
            acc = acc + np.bitwise_count((self.codes[q] ^ lv["pattern"][node]) & lv["own"][node])
            keep = acc <= self.max_bits
            q, node, acc = q[keep], node[keep], acc[keep]
            sure = acc + lv["free"][node] <= self.max_bits
            found_a.append(q[sure])
            found_b.append(lv["first"][node[sure]])
            if level:
                q, node, acc = q[~sure], node[~sure], acc[~sure]
                fan = lv["fan"][node]
                if len(q):
                    stack.append((level - 1, np.repeat(q, fan), np.repeat(lv["child"][node], fan) + _within(fan),
                                  np.repeat(acc, fan)))
        return np.concatenate(found_a), np.concatenate(found_b)


def _within(sizes: np.ndarray) -> np.ndarray:
    """0..size-1 for each size, one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _merge(comp: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels after linking leaves a[i] and b[i]."""
    comp = comp.copy()
    while True:
        la, lb = comp[a], comp[b]
        apart = la != lb
        if not apart.any():
            return comp
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(comp, np.maximum(la, lb), np.minimum(la, lb))
        while (nxt := comp[comp]).tobytes() != comp.tobytes():
            comp = nxt


def _masks(bits: list[int], parts: int) -> list[list[int]]:
    """``bits`` cut into ``parts`` runs of near equal length."""
    cuts = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(bits: list[int]) -> int:
    v = sum(1 << b for b in bits)
    return v - (1 << 64) if v >= 1 << 63 else v


def band_keys(fps: DataFrame, max_bits: int, group_limit: int, levels: int = 3) -> DataFrame:
    """(``key``, ``fp``): each fingerprint once per band; groups above
    ``group_limit`` are split on sub-bands of the bits not used yet, up to
    ``levels`` deep."""
    paths = [list(range(64))]
    keyed = fps.select(F.lit(0).alias("path"), F.lit(0).cast("long").alias("key"), "fp")
    done = None
    for level in range(levels):
        split = [_masks(p, max_bits + 1) for p in paths]
        table = F.array(*[F.array(*[F.lit(_signed(m)).cast("long") for m in s]) for s in split])
        keyed = (keyed.select("path", "key", "fp", F.posexplode(table[F.col("path")]).alias("band", "mask"))
                 .select((F.col("path") * (max_bits + 1) + F.col("band")).alias("path"),
                         F.xxhash64("key", "path", "band", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"), "fp"))
        paths = [[b for b in p if b not in m] for p, s in zip(paths, split, strict=True) for m in s]
        hot = keyed.groupBy("key").count().filter(F.col("count") > group_limit).select("key")
        if level == levels - 1 or not hot.limit(1).count():
            out = keyed.select("key", "fp")
            return out if done is None else done.unionByName(out)
        small = keyed.join(hot, "key", "left_anti").select("key", "fp")
        done = small if done is None else done.unionByName(small)
        keyed = keyed.join(hot, "key", "left_semi")


def _link_groups(batches: Iterator[pd.DataFrame], max_bits: int) -> Iterator[pd.DataFrame]:
    """Links (``a``, ``b``) of every key group of one partition: each member to
    the first of its component."""
    got = list(batches)
    rows = pd.concat(got) if got else pd.DataFrame({"key": [], "fp": []}, dtype="int64")
    if not len(rows):
        return
    codes, key = rows["fp"].to_numpy(np.int64).view(np.uint64), rows["key"].to_numpy(np.int64)
    order = np.lexsort((gray_rank(codes), key))
    codes, key = codes[order], key[order]
    comp = GrayIndex(codes, key, max_bits).connected()
    linked = np.flatnonzero(comp != np.arange(len(comp)))
    if len(linked):
        signed = codes.view(np.int64)
        yield pd.DataFrame({"a": signed[linked], "b": signed[comp[linked]]})


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    group_limit: int = GROUP_LIMIT, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``doc_id``, ``fp``, ``group`` (a fingerprint that
    names the component of links of at most ``max_bits`` differing bits),
    ``component_id`` (its smallest doc_id), and the columns to ``carry``."""
    spark = docs.sparkSession
    prints = materialize(with_fingerprints(docs, shingle_words, carry), "simhash")
    # exact copies meet before anything else: one row per fingerprint with its smallest doc_id
    fps = prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc"))
    keyed = band_keys(fps.select("fp"), max_bits, group_limit)
    links = (keyed.repartition(shuffle_parts(spark), "key")
             .mapInPandas(lambda it: _link_groups(it, max_bits), "a long, b long"))
    labels = components(links, "simhash")
    groups = fps.join(labels, fps["fp"] == labels["node"], "left").select(
        fps["fp"], "first_doc", F.coalesce("root", fps["fp"]).alias("group"))
    best = groups.groupBy("group").agg(F.min("first_doc").alias("component_id"))
    of_fp = groups.join(best, "group", "left").select(F.col("fp").alias("fp2"), "group", "component_id")
    return (prints.join(of_fp, prints["fp"].eqNullSafe(of_fp["fp2"]))
            .select("doc_id", "fp", "group", "component_id", *carry))


def fingerprint_hex(col: str = "fp"):
    return F.lower(F.lpad(F.hex(col), 16, "0"))
