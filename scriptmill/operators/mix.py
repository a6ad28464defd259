"""Instruction union, seeded shuffle, exact train/validation split, SFT/CLM mix, chat text.

Python's list shuffle depends on the row order it is handed; what we keep
are its guarantees: exact sizes, determinism by seed, disjoint and complete
splits, sampling without replacement.  The order is a keyed hash of each
record's unique key (ties by key), positions come from the bucketed global
rank of :mod:`.ordered` (no single-task window).  Membership therefore
differs from the original tool, sizes do not.

The split is a cut at ``floor(n * (1 - val_fraction))``, the CLM sample is the
first positions of the shuffled training part (a uniform sample without
replacement), the validation cap counts on from the cut.  All sizes are
arithmetic on two counts.  Where positions themselves are not asked for, the
cuts are found by counting hashes (``cut_classes``) and the records stay where
they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import CHAT_FORMAT, SEED, SYSTEM_CHAT_DEFAULT, VAL_FRACTION
from ..functions.hashing import keyed_hash
from ..functions.text import col_of
from .ordered import cut_classes, rank_by_hash

RECORD_COLUMNS = ["key", "system", "instruction", "completion", "category", "source_file", "name"]


def instruction_records(script_pairs: DataFrame | None = None, loc_pairs: DataFrame | None = None,
                        engine: DataFrame | None = None, chats: DataFrame | None = None) -> DataFrame:
    """The union of the instruction sources with a unique ``key`` per record.

    Script pairs, localization pairs and engine reference are the original's
    three; ``chats`` (``conv_id, turn, system, instruction, completion``) may be
    added.  Sources that are None are skipped; no source at all is an error.
    The key holds a digest of the pair, so records with one key are copies of
    each other and may change places.
    """
    def keyed(df: DataFrame, kind: str, *cols: str) -> DataFrame:
        whole = F.md5(F.concat_ws("|", "instruction", "completion"))
        key = F.concat_ws("|", F.lit(kind), *[F.col(c).cast("string") for c in cols], whole)
        return df.withColumn("key", key).select([c for c in RECORD_COLUMNS if c in (*df.columns, "key")])

    found = []
    if script_pairs is not None:
        found.append(keyed(script_pairs, "script", "source_file", "name", "category"))
    if loc_pairs is not None:
        found.append(keyed(loc_pairs, "loc", "name"))
    if engine is not None:
        found.append(keyed(engine, "engine", "source_file", "name"))
    if chats is not None:
        found.append(keyed(chats, "chat", "conv_id", "turn"))
    if not found:
        raise ValueError("no instruction data: run the extraction first")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def shuffle_positions(df: DataFrame, key, seed=SEED, salt: str = "shuffle", out: str = "pos",
                      bits: int = 16, total: str | None = None) -> DataFrame:
    """0-based position of each record in the seeded shuffle order."""
    d = df.withColumn("_key", col_of(key).cast("string")) \
          .withColumn("_h", keyed_hash(f"{seed}:{salt}", "_key"))
    return rank_by_hash(d, "_h", ["_key"], out, bits, total).drop("_h", "_key")


def n_train(n, val_fraction: float = VAL_FRACTION) -> Column:
    """``int(n * (1 - val_fraction))``."""
    return F.floor(col_of(n) * F.lit(1.0 - val_fraction)).cast("long")


def split_train_val(df: DataFrame, key, seed=SEED, val_fraction: float = VAL_FRACTION,
                    bits: int = 16, total: str | None = None) -> DataFrame:
    """Adds ``pos`` (shuffle position) and ``split``: the first
    ``int(n * (1 - val_fraction))`` positions are ``train``, the rest ``val``;
    ``total`` names a column for n."""
    p = shuffle_positions(df, key, seed, "shuffle", "pos", bits, "_all")
    p = p.withColumn("split", F.when(F.col("pos") < n_train("_all", val_fraction), "train").otherwise("val"))
    return p.withColumnRenamed("_all", total) if total else p.drop("_all")


def label_split(df: DataFrame, key, seed=SEED, val_fraction: float = VAL_FRACTION, bits: int = 16) -> DataFrame:
    """Adds ``split`` as :func:`split_train_val` does, without positions: no record is shuffled."""
    d = _hashed(df, key, seed)
    split = F.when(F.col("_class") == 0, "train").otherwise("val")
    return cut_classes(d, "_h", "_key", lambda n: [n_train(n, val_fraction)], "_class", bits).withColumn("split", split).drop("_h", "_key", "_class")


def _hashed(df: DataFrame, key, seed) -> DataFrame:
    d = df.withColumn("_key", col_of(key).cast("string"))
    return d.withColumn("_h", keyed_hash(f"{seed}:shuffle", "_key"))


def mix_size(n_sft_train, n_clm_train, ratio: float) -> Column:
    """CLM records to add: ``int(n_sft * r / (1 - r))`` capped at what exists."""
    if ratio >= 1:
        raise ValueError("clm_mix_ratio must be below 1")
    if ratio <= 0:
        return F.lit(0).cast("long")
    return F.least(F.floor(col_of(n_sft_train) * F.lit(ratio) / F.lit(1 - ratio)), col_of(n_clm_train)).cast("long")


def mix_datasets(sft: DataFrame, clm: DataFrame | None, ratio: float, sft_key: str = "key", clm_key: str = "doc_id",
                 val_cap: int | None = None, seed=SEED, bits: int = 16) -> DataFrame:
    """The training and validation records of a run: ``kind`` (sft or clm),
    ``split``, ``key`` and the records' columns.

    Training is all SFT training records plus ``mix_size`` CLM ones; validation
    is all SFT validation records plus the CLM ones (the first ``val_cap`` in
    shuffled order, None: all).  At ratio 0, or without CLM data, SFT only.
    """
    s = label_split(sft, sft_key, seed, bits=bits)
    out = s.withColumn("key", col_of(sft_key).cast("string")).withColumn("kind", F.lit("sft"))
    if clm is None or ratio <= 0:
        return out
    n_sft = n_train(sft.select(F.count(F.lit(1))).scalar())

    def targets(n: Column) -> list[Column]:
        cut = n_train(n)  # sampled, left out, validation, beyond the cap
        return [mix_size(n_sft, cut, ratio), cut, n if val_cap is None else F.least(n, cut + val_cap)]

    c = cut_classes(_hashed(clm, clm_key, seed), "_h", "_key", targets, "_class", bits)
    split = F.when(F.col("_class") == 0, "train").when(F.col("_class") == 2, "val")
    c = (c.withColumn("split", split).where("split is not null").withColumn("key", col_of(clm_key).cast("string"))
         .withColumn("kind", F.lit("clm")).drop("_h", "_key", "_class"))
    if clm_key != "key":
        c = c.drop(clm_key)
    return out.unionByName(c, allowMissingColumns=True)


def chat_text(system="system", instruction="instruction", completion="completion") -> Column:
    """Chat markup of a pair; a missing system text takes the default."""
    sys_text = F.coalesce(col_of(system), F.lit(SYSTEM_CHAT_DEFAULT))
    a, rest = CHAT_FORMAT.split("{system}")
    b, rest = rest.split("{instruction}")
    c, d = rest.split("{completion}")
    return F.concat(F.lit(a), sys_text, F.lit(b), col_of(instruction), F.lit(c), col_of(completion), F.lit(d))


def training_text(df: DataFrame, formatter=None) -> Column:
    """Text of a training record: chat markup when it has an instruction,
    else its ``text``.  ``formatter`` replaces the chat markup (the hook the
    original lets users edit); it maps the DataFrame to a Column."""
    chat = formatter(df) if formatter else chat_text()
    has_instr = "instruction" in df.columns
    has_text = "text" in df.columns
    if has_instr and has_text:
        return F.when(F.col("instruction").isNotNull(), chat).otherwise(F.col("text"))
    return chat if has_instr else F.col("text")
