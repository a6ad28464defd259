"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

Documents are tokenized with a public tokenizer, an end id is appended, and
ids are replaced by their rank in the corpus-wide frequency order, so frequent
ids take one byte.  Ranks are coded with separate control bytes: two bits per
value give its length in bytes, four values to a control byte, and the data
bytes follow in a stream of their own.  Decoding is table lookup in numpy: a
control byte maps to four lengths, offsets are their running sum, and a mask
table cuts the loaded words.

Files.  A token store is a folder with two Parquet tables: ``ranks`` (one row:
the ids in rank order, little-endian unsigned 32 bit) and ``blocks`` (one row
per block: its place in doc_id order and the block image).  Spark
writes and reads them, so any file system works.  A block image is::

    b"FRV1", n_docs u64, n_ids u64 | doc_id i64 * n_docs | has_id u8 * n_docs
    | ids per document u64 * n_docs | control bytes | data bytes

Between the passes ids travel as 16-bit numbers when the vocabulary fits, else
as 32-bit ones.

Defined results: null text counts as empty and yields the end id alone; null
doc_ids come first; rows that repeat a doc_id are all stored, ordered by their
ids; a document of any length is stored whole (a block ends after the document
that fills it); an empty table gives an empty store.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scriptmill.llm.common import materialize, shuffle_parts
from scriptmill.session import ensure_checkpoint_dir

END_ID = 1
BLOCK_IDS = 1 << 20
SLICE_BYTES = 8 << 20
CACHE_WORDS = 300_000
#: letters before it are their own canonical composition
LATIN_END = "\u0250"
CODES = {"<u2": "H", "<u4": "I"}
MAGIC = b"FRV1"

#: per control byte: the lengths of its four values
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + np.uint8(1)
#: per length: the bits of a loaded 32-bit word that belong to the value
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    v = values.astype("<u4")
    size = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    padded = np.zeros(-(-len(v) // 4) * 4, dtype=np.uint8)
    padded[:len(v)] = size - 1
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) < size[:, None]]
    return control.tobytes(), data.tobytes()


def decode_values(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values coded in ``control`` and ``data``."""
    size = LENGTHS[control].ravel()[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    padded = np.concatenate((data, np.zeros(3, dtype=np.uint8)))
    word = padded[at].astype(np.uint32)
    for k in (1, 2, 3):
        if size.max(initial=1) > k:
            word |= padded[at + k].astype(np.uint32) << np.uint32(8 * k)
    return word & MASKS[size]


def pack_block(doc_ids: list[int | None], ranks: list[np.ndarray]) -> bytes:
    lengths = np.array([len(r) for r in ranks], dtype="<u8")
    control, data = encode_values(np.concatenate(ranks) if ranks else np.zeros(0, dtype=np.uint32))
    return b"".join([MAGIC, struct.pack("<QQ", len(ranks), int(lengths.sum())),
                     np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
                     np.array([d is not None for d in doc_ids], dtype=np.uint8).tobytes(),
                     lengths.tobytes(), control, data])


def unpack_block(image: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, ids per document, and all ranks of a block image."""
    if image[:4] != MAGIC:
        raise ValueError("not a token block")
    n_docs, n_ids = struct.unpack_from("<QQ", image, 4)
    at = 20
    doc_ids = np.frombuffer(image, "<i8", n_docs, at).tolist()
    has_id = np.frombuffer(image, np.uint8, n_docs, at + 8 * n_docs)
    lengths = np.frombuffer(image, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
    at += 17 * n_docs
    n_control = -(-n_ids // 4)
    control = np.frombuffer(image, np.uint8, n_control, at)
    data = np.frombuffer(image, np.uint8, -1, at + n_control) if at + n_control < len(image) else np.zeros(0, np.uint8)
    return [d if h else None for d, h in zip(doc_ids, has_id, strict=True)], lengths, decode_values(control, data, n_ids)


def splits_at_words(spec: dict) -> bool:
    """Whether a tokenizer file lower-cases, drops white space, and never joins a
    character with one behind a white space, or a letter with a full stop or comma."""
    steps = [(s.get("type"), s.get("content")) for s in (spec.get("normalizer") or {}).get("normalizers", [])]
    parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if steps != [("NFC", None), ("Replace", " "), ("Lowercase", None)] or [p.get("type") for p in parts] != ["Split", "ByteLevel"]:
        return False
    split, level, model = parts[0], parts[1], spec.get("model") or {}
    # matches are words of letters, single digits, or signs without white space: what lies between is dropped
    kept = (split.get("pattern") or {}).get("Regex", "").split("|")
    return (split.get("behavior") == "Removed" and split.get("invert") is True and not level.get("add_prefix_space")
            and kept[-3:] == [r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+"] and all(re.fullmatch("'[a-z]+", k) for k in kept[:-3])
            and model.get("type") == "BPE" and not model.get("unk_token") and not model.get("ignore_merges") and not model.get("dropout"))


class WordEncoder:
    """Encodes texts word by word through the tokenizer, each distinct word once.

    Fits tokenizers that drop white space and never join characters across it
    or across a letter and a following full stop or comma, with lower-casing:
    the ids of a text are then those of its words in order.  Whether a file is of
    that kind is read from its normaliser and splitter; with any other, and for
    texts that hold the opening of a special token, texts are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = splits_at_words(json.loads(self.tokenizer.to_str()))
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.width = "<u4"
        self.model = self.tokenizer.model
        # the characters that stand for bytes in the model's pieces: printable ones for themselves
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
        hidden = sorted(set(range(256)) - set(shown))
        self.byte_chars = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The packed ids of words; lower-case Latin words are what the splitter
        makes of them, so the model alone encodes them."""
        out: list[bytes | None] = [None] * len(words)
        others = []
        for i, w in enumerate(words):
            if not w.isalpha():
                others.append(i)
            elif w.isascii():
                out[i] = self.pack([t.id for t in self.model.tokenize(w)])
            elif max(w) < LATIN_END and w == w.lower():
                out[i] = self.pack([t.id for t in self.model.tokenize(w.encode().decode("latin-1").translate(self.byte_chars))])
            else:
                others.append(i)
        done = self.tokenizer.encode_batch_fast([words[i] for i in others], add_special_tokens=False)
        for i, e in zip(others, done, strict=True):
            out[i] = self.pack(e.ids)
        return out

    def pack(self, ids: list[int]) -> bytes:
        return array(CODES[self.width], ids).tobytes()

    def word_ids(self, words: list[str]) -> list[bytes]:
        """The packed ids of distinct words."""
        out: list[bytes | None] = list(map(self.recent.get, words))
        gaps = [i for i, got in enumerate(out) if got is None]
        new = []
        for i in gaps:
            if (got := self.older.get(words[i])) is None:
                new.append(i)
            else:
                out[i] = self.recent[words[i]] = got
        if new:
            for i, got in zip(new, self.encode_words([words[i] for i in new]), strict=True):
                out[i] = self.recent[words[i]] = got
        if len(self.recent) > CACHE_WORDS:
            self.older, self.recent = self.recent, {}
        return out

    def packed(self, texts: pa.Array, end_id: int, width: str = "<u4") -> pa.Array:
        """The ids of each text, ``end_id`` last: one binary value of ``width`` numbers a text."""
        if width != self.width:  # cached words are packed in one width
            self.width, self.recent, self.older = width, {}, {}
        alone = lambda t: self.pack([*self.tokenizer.encode(t, add_special_tokens=False).ids, end_id])
        if not self.by_words:
            return pa.array([alone(t) for t in texts.to_pylist()], pa.binary())
        whole = pc.match_substring(texts, "<|")
        some = pc.any(whole, min_count=0).as_py()
        plain = pc.if_else(whole, "", texts) if some else texts
        plain = pc.replace_substring_regex(pc.ascii_lower(plain), r"([a-z0-9])([.,])", r"\1 \2")
        split = pc.ascii_split_whitespace(plain)
        coded = split.flatten().dictionary_encode()
        known = self.word_ids(coded.dictionary.to_pylist())
        values = pa.array([*known, self.pack([end_id])], pa.binary())
        # the end id is one more word behind each text's; taking words copies their ids one after the other
        upto = split.offsets.to_numpy() - split.offsets[0].as_py()
        words = np.insert(coded.indices.to_numpy(zero_copy_only=False), upto[1:], len(known))
        ids = values.take(pa.array(words))
        _, starts, data = ids.buffers()
        cuts = np.frombuffer(starts, dtype=np.int32, count=len(ids) + 1, offset=4 * ids.offset)[upto + np.arange(len(upto))]
        out = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(cuts), data])
        if not some:
            return out
        return pc.replace_with_mask(out, whole, pa.array([alone(t) for t in texts.filter(whole).to_pylist()], pa.binary()))

    def encode(self, texts: pa.Array, end_id: int) -> list[np.ndarray]:
        """The ids of each text, ``end_id`` last."""
        return [np.frombuffer(ids, dtype="<u4") for ids in self.packed(texts, end_id).to_pylist()]


_ENCODERS: dict[str, WordEncoder] = {}  # per Python worker


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def id_width(tokenizer: str, end_id: int = END_ID) -> str:
    """The narrowest of numpy's little-endian types that holds every id."""
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = END_ID, width: str = "<u4") -> DataFrame:
    """``doc_id`` and ``ids`` (binary, numbers of type ``width``) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            text = batch.column(1)
            sizes = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(text):  # slices of bounded size
                to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES)))
                got = encoder.packed(text.slice(at, to - at), end_id, width)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), got], ["doc_id", "ids"])
                at = to

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
            .mapInArrow(run, "doc_id long, ids binary"))


def _count_ids(batches: Iterator[pa.RecordBatch], width: str) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, dtype=np.int64)
    for batch in batches:
        got = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), width), minlength=len(total))
        got[:len(total)] += total
        total = got
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])


#: a block: the part that wrote it, the part's ids before it, its ids, its image
BLOCKS = "part long, before long, n_ids long, image binary"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Tokenize ``docs`` and write the token store below ``path``."""
    spark = docs.sparkSession
    width = id_width(tokenizer, end_id)
    ids = materialize(tokenize(docs, tokenizer, end_id, width), "ids")
    # one count per id of the vocabulary, which is bounded by the tokenizer
    counts = ids.select("ids").mapInArrow(lambda it: _count_ids(it, width), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    order = np.array([r["id"] for r in sorted(counts, key=lambda r: (-r["n"], r["id"]))], dtype="<u4")
    rank = np.zeros(int(order.max(initial=0)) + 1, dtype=np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    spark.createDataFrame([(bytearray(order.tobytes()),)], "ids binary").write.parquet(f"{path}/ranks")
    ranks = spark.sparkContext.broadcast(rank)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        names, held, size = [], [], 0

        def flush() -> pa.RecordBatch:
            row = [[part], [before], [size], [pack_block(names, held)]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)],
                                              ["part", "before", "n_ids", "image"])

        for batch in batches:
            for doc_id, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                names.append(doc_id)
                held.append(ranks.value[np.frombuffer(v.as_buffer(), width)])
                size += len(held[-1])
                if size >= BLOCK_IDS:
                    yield flush()
                    names, held, size, before = [], [], 0, before + size
        if held:
            yield flush()

    key = [F.col("doc_id").asc_nulls_first(), F.crc32("ids"), F.length("ids"), F.col("ids")]
    (ids.repartitionByRange(shuffle_parts(spark), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(*key)
     .mapInArrow(blocks, BLOCKS)
     .write.option("compression", "zstd").parquet(f"{path}/blocks"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a token store: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens``, ``ids`` (little-endian unsigned 32 bit)."""
    order = spark.read.parquet(f"{path}/ranks").collect()[0]["ids"]  # at most the vocabulary
    table = spark.sparkContext.broadcast(np.frombuffer(bytes(order), "<u4"))
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # parts are as many as tasks wrote, so their offsets are a small bounded table
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select(F.col("part").alias("of_part"), F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("part_start")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, image in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc_ids, lengths, ranks = unpack_block(image.as_py())
                ids = table.value[ranks].astype("<u4")
                ends = np.cumsum(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(start + ends - lengths, pa.int64()), pa.array(lengths, pa.int64()),
                     pa.array([ids[a:b].tobytes() for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)],
                              pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return (blocks.join(F.broadcast(parts), F.col("part") == F.col("of_part"))
            .select((F.col("part_start") + F.col("before")).alias("start"), "image")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary"))


def new_store(spark: SparkSession) -> str:
    """A fresh store path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-tokens-{uuid.uuid4().hex}"
