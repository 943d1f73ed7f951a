"""Quality selection by importance resampling.

Target texts (labelled as good) and all texts are modelled as bags of hashed n-grams: the unigrams and bigrams of words fall
into ``BUCKETS`` buckets, and each model is the smoothed frequency of the buckets.  A text's weight is the ratio of the two models,
p_target(text) / p_raw(text); its logarithm is the sum over the text's n-grams.  Gumbel noise on that turns "the k largest" into
sampling k texts without replacement by weight; the noise is a function of the id and the text, so it is the same in every run.
``temperature`` above 1 flattens the weights (the ratio's power 1 / temperature).

Counts cover all texts of either kind.  A task sums its texts into one table, so a table of ``BUCKETS`` rows comes to the
driver and is broadcast (1 MB).  The k-th largest key is found by counting keys in 65,536 classes of their leading bits, four
times, never by sorting all keys in one task.

Words are runs without ASCII white space of the whole lower-cased text.  Null and empty texts have no n-grams and log ratio
0.  Repeated rows get equal keys; ties at the k-th place go to the smaller doc_id (a null one first), and rows that tie in
that as well are all taken.  An empty table gives no rows.  Labels that share a doc_id count as good if one is; without labels
every log ratio is 0.  Other columns are not read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, slices, text_buffers, written
from .suffix import Hashed, mixed

BUCKETS = 1 << 16
SMOOTH = 1.0
BROADCAST_ROWS = 200_000           # labels are broadcast up to here (some 180 bytes each in a hash table, 35 MB), else joined by shuffle
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of texts laid end to end, and the text of each."""
    text = Hashed(_LOWER[data])
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]]) | inside & edge[:-1])
    end = np.flatnonzero(inside & (np.concatenate([~inside[1:], [True]]) | edge[1:])) + 1
    word = mixed(text.of(start, end - start))
    owner = np.searchsorted(offsets, start, "right") - 1
    pair = mixed(word[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ word[1:])[owner[:-1] == owner[1:]]
    return (np.concatenate([word, pair]) >> np.uint64(48)).astype(np.int64), np.concatenate([owner, owner[:-1][owner[:-1] == owner[1:]]])


def bucket_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(text, good) -> counts by bucket of the good texts and of all."""
    def task(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in slices(batches, 1 << 21):
            data, offsets = text_buffers(batch.column(0))
            if not len(data):
                continue
            at, owner = features(data, offsets)
            good = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)[owner]
            total[1] += np.bincount(at, minlength=BUCKETS)
            total[0] += np.bincount(at[good], minlength=BUCKETS)
        used = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[0, used]), pa.array(total[1, used])], names=["bucket", "good", "raw"])

    got = (rows.select("text", "good").mapInArrow(task, "bucket long, good long, raw long")
           .groupBy("bucket").agg(F.sum("good").alias("good"), F.sum("raw").alias("raw")).toPandas())     # BUCKETS rows at most
    out = np.zeros((2, BUCKETS))
    out[:, got["bucket"].to_numpy(np.int64)] = got[["good", "raw"]].to_numpy(float).T
    return out[0], out[1]


def log_ratios(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_features, log_ratio) of every row, and a 64-bit hash of its text."""
    docs = id_text(docs)
    marks = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") > 0).cast("int")).alias("good")))
    marks = marks.filter("good = 1")
    if marks.count() <= BROADCAST_ROWS:
        marks = F.broadcast(marks)
    good, raw = bucket_counts(docs.join(marks, "doc_id", "left").select("text", F.coalesce("good", F.lit(0)).alias("good")))
    model = (np.log((good + SMOOTH) / (good + SMOOTH).sum()) - np.log((raw + SMOOTH) / (raw + SMOOTH).sum())
             if good.any() else np.zeros(BUCKETS)).astype(np.float64)

    def task(batches):
        for batch in slices(batches, 1 << 21):
            data, offsets = text_buffers(batch.column(1))
            n, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            if len(data):
                at, owner = features(data, offsets)
                n = np.bincount(owner, minlength=batch.num_rows)
                total = np.bincount(owner, model[at], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(total), batch.column(2)],
                                             names=["doc_id", "n_features", "log_ratio", "salt"])

    salted = docs.select("doc_id", "text", F.xxhash64(F.lit("gumbel"), "doc_id", "text").alias("salt"))
    return salted.mapInArrow(task, "doc_id long, n_features long, log_ratio double, salt long")


def kth_largest(keys: DataFrame, k: int) -> int | None:
    """The k-th largest of the long column ``key``, by leading bits: 65,536 counts at a time come to the driver."""
    prefix, left = 0, k
    for shift in (48, 32, 16, 0):
        here = keys.filter(F.shiftright("key", shift + 16) == prefix) if shift < 48 else keys
        counts = (here.groupBy(F.shiftright("key", shift).alias("p")).agg(F.count("*").alias("n"))
                  .orderBy(F.desc("p")).limit(1 << 16).collect())
        for row in counts:
            if left <= row.n:
                prefix = row.p
                break
            left -= row.n
        else:
            return None
    return prefix


def resample(docs: DataFrame, labels: DataFrame, fraction: float = 0.5, temperature: float = 1.0) -> DataFrame:
    """Every row with n_features, log_ratio, gumbel_key and whether it is among the sampled ``fraction`` of all rows."""
    uniform = (F.shiftrightunsigned("salt", 11).cast("double") + 0.5) / float(1 << 53)
    rows = log_ratios(docs, labels).withColumn("gumbel_key", F.col("log_ratio") / temperature - F.log(-F.log(uniform)))
    # an order-preserving long; keys within 2^-30 of each other are ties, those beyond +-2^31 too
    held = F.greatest(F.lit(-float(1 << 31)), F.least(F.lit(float(1 << 31)), F.col("gumbel_key")))
    rows = written(rows.drop("salt").withColumn("key", F.floor(held * float(1 << 30)).cast("long")), "keys")
    n = rows.count()
    k = int(n * fraction)
    bar = kth_largest(rows.select("key"), k) if k else None
    if bar is None:
        return rows.drop("key").withColumn("selected", F.lit(k > 0))
    above = rows.filter(F.col("key") > bar).count()
    # rows that tie at the bar: the smaller ids (a null one first), found the same way
    place = F.coalesce(F.bitwise_not("doc_id"), F.lit((1 << 63) - 1))
    last = kth_largest(rows.filter(F.col("key") == bar).select(place.alias("key")), k - above)
    return rows.withColumn("selected", (F.col("key") > bar) | ((F.col("key") == bar) & (place >= last))).drop("key")
