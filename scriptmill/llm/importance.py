"""Target-distribution importance resampling over hashed word n-grams.

Byte translate and split: one 256-byte table lower-cases A-Z and blanks every
separator in the UTF-8 bytes of a text, ``bytes.split`` yields the words, and
chained ``zlib.crc32`` seeds extend the checksum of a word by the next ones, so
an n-gram's checksum costs no joined string.  Each task reduces its features to
one Counter of buckets; Spark adds the Counters, at most ``buckets`` rows a
task.  The gain of a bucket is the log ratio of its smoothed share in the
target and in the corpus; a text's weight is the sum over its features, and
the Gumbel noise of a document turns weights into a draw without replacement.

The corpus is read twice (counts, then weights); what travels to the tasks is
the table of gains, ``buckets`` numbers.  The draw sorts narrow rows by range;
nothing but one sum per range is gathered.

Defined results: a null text has no words; a text without words has no
features and weight 0; an empty target or corpus counts 0 in every bucket; a
null doc_id is hashed as the empty string and sorts first; equal rows each keep
a row and a rank of their own; ties in the score go to the smaller doc_id, then
to fewer features; an empty table gives an empty result; other columns are
ignored; very long texts are split whole.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptmill.llm.common import materialize, running_total

BUCKETS = 10_000
MAX_N = 3
SEED = 42
MIN_WORDS = 20
PERCENT = 5

#: lower-cases A-Z, keeps letters, digits and every byte of a non-ASCII character, blanks the rest
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def features(text: bytes, max_n: int = MAX_N) -> tuple[int, list[int]]:
    """Number of words, and the checksum of every run of 1 to ``max_n`` words."""
    words = text.translate(TABLE).split()
    sums = list(map(zlib.crc32, words))
    out = list(sums)
    joined = [b" " + w for w in words] if len(words) > 1 else []
    for n in range(1, max_n):
        sums = list(map(zlib.crc32, joined[n:], sums))  # the seed is the sum of the n words before
        out += sums
    return len(words), out


def _texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """UTF-8 bytes of a column, straight from Arrow's buffers; null: none."""
    for x in batch.column(column).cast(pa.large_binary()):
        yield x.as_py() or b""


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, max_n: int = MAX_N) -> DataFrame:
    """``bucket, n``: features of all texts, one Counter a task before the sum."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[int] = Counter()
        for batch in batches:
            for text in _texts(batch):
                sums = features(text, max_n)[1]
                total.update((np.asarray(sums, np.uint32) % buckets).tolist())
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(total.keys(), pa.int32()), "n": pa.array(total.values(), pa.int64())})

    return docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, gain`` of every bucket from the counts of corpus and target."""
    every = corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = (every.join(corpus.select("bucket", F.col("n").alias("s")), "bucket", "left")
            .join(target.select("bucket", F.col("n").alias("t")), "bucket", "left").fillna(0, ["s", "t"]))
    total = both.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("corpus_size"), F.coalesce(F.sum("t"), F.lit(0)).alias("target_size"))
    d = lambda c: F.col(c).cast("double")
    ratio = (d("t") + 1) * (d("corpus_size") + buckets) / ((d("s") + 1) * (d("target_size") + buckets))
    return both.join(F.broadcast(total)).select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))  # total: one row


def weights(docs: DataFrame, table: np.ndarray, max_n: int = MAX_N) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row."""
    buckets = len(table)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(n, len(sums), int(table[np.asarray(sums, np.uint32) % buckets].sum()))
                    for n, sums in (features(t, max_n) for t in _texts(batch))]
            cols = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols)],
                                             ["doc_id", "n_words", "n_features", "weight"])

    kept = docs.select("doc_id", "text")
    return kept.mapInArrow(weigh, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise of a document in thousandths, rounded down."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8),
               16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def draw(scored: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """``rank`` of the rows drawn: of the N with ``min_words`` words or more the
    floor(percent * N / 100) highest scores; null for all others."""
    fixed = materialize(scored.withColumn("__row", F.monotonically_increasing_id()), "importance-scores")
    able = F.col("n_words") >= min_words
    share = fixed.agg(F.floor(F.count(F.when(able, 1)) * percent / F.lit(100)).alias("__drawn"))  # one row
    order = fixed.filter(able).withColumn("__fall", -F.col("score")).withColumn("__one", F.lit(1))
    placed = (running_total(order, ["__fall", "doc_id", "n_features", "__row"], "__one", "__before", "importance-order")
              .join(F.broadcast(share))
              .withColumn("rank", F.when(F.col("__before") < F.col("__drawn"), F.col("__before") + 1)))
    out = [*scored.columns, "rank"]
    return placed.select(*out).unionByName(fixed.filter(~able).withColumn("rank", F.lit(None).cast("long")).select(*out))


def resample(docs: DataFrame, target: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT,
             buckets: int = BUCKETS, max_n: int = MAX_N, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document."""
    spark = docs.sparkSession
    counted = gains(materialize(bucket_counts(docs, buckets, max_n), "importance-counts"), bucket_counts(target, buckets, max_n), buckets)
    table = np.zeros(buckets, np.int64)
    for row in counted.collect():  # ``buckets`` rows
        table[row["bucket"]] = row["gain"]
    scored = weights(docs, table, max_n).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return draw(scored, min_words, percent)
