"""Document fingerprints by locally consistent parsing.

A text's bytes are the symbols of level 0.  A level is parsed into phrases, whose names are the symbols of the next:

1. Runs of one symbol become one symbol (named by symbol and length), so neighbours differ.
2. Deterministic coin tossing: a symbol's label is the place of the lowest bit in which it differs from its left
   neighbour, and that bit.  Neighbours still differ.  Repeated rounds (four for 64-bit names) leave labels below 6.
3. A phrase begins at each local maximum of the labels (every 2 to 10 symbols) and is named by a hash of its symbols.

Where phrases begin depends on six symbols to the left and one to the right, and names on the symbols alone.  So equal substrings
get equal names inside, wherever they stand and whatever surrounds them.

A fingerprint holds, for levels 1 to ``LEVELS`` (phrases of some 3, 7, 20 and 55 bytes), the least name in each of ``SLOTS`` classes of
names, as one byte (0: no name in that class).  Two fingerprints are compared at the coarsest level at which both fill
``FILLED`` slots (the finest, if none does): equal slots over slots that either fills estimate the Jaccard likeness of
the phrase sets.  Equal texts have equal fingerprints; two empty texts have likeness 1, an empty and another one 0.

``against_edited`` compares each document with an edited version and with the next document in descending order of ids.  Rows
are dealt to buckets of that order by their rank (Spark's range partitioning of the narrow keys); the first row of a bucket
is sent to the bucket before it as well.  So each text is shuffled once and no window runs over the whole table.

Null text: empty.  Null ids come last in that order.  Rows that share an id are ordered by a hash of the text; equal rows follow
each other and are spread over buckets by a row number, so a hot id fills no task.  A single row is its own next.  Columns
other than id and text are not read; an empty table gives no rows.  Memory per task is some 40 times its longest text."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, slices, text_buffers, written

LEVELS, SLOTS, FILLED = 4, 64, 24
STEP = 1 << 20            # symbols labelled at a time
MARGIN = 32               # symbols to either side that a label and its neighbours can depend on
BUCKET_BYTES, MOST_BUCKETS = 4 << 20, 1 << 16
_ONE = np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread over all bits (a bijection of 64-bit numbers)."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _tossed() -> np.ndarray:
    """Label of a small label after its left neighbour, for every pair of bytes (at left * 256 + own)."""
    left, own = np.divmod(np.arange(1 << 16), 256)
    differ = left ^ own
    place = np.where(differ > 0, np.bitwise_count((differ & -differ) - 1), 7)
    return (2 * place + (own >> place & 1)).astype(np.uint8)


TOSSED = _tossed()


def small_labels(label: np.ndarray, starts: np.ndarray, rounds: int) -> np.ndarray:
    """Rounds of coin tossing on labels of a byte; three take any byte to a label below 6."""
    pair = np.empty(len(label), np.uint16)
    for _ in range(rounds):
        pair[1:] = label[:-1]
        pair[0] = 0
        pair[starts] = ~label[starts]             # the first symbol of a text has no left neighbour: its lowest bit counts
        pair <<= 8
        pair |= label
        label = TOSSED[pair]
    return label


def labels(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Labels 0 to 5, different from the left neighbour's; texts begin at ``starts``."""
    if names.dtype == np.uint8:
        return small_labels(names, starts, 3)
    differ = names.copy()
    differ[1:] ^= names[:-1]
    differ[starts] = 1
    place = np.minimum(np.bitwise_count((differ & (~differ + _ONE)) - _ONE), 63)
    own = ((names >> place.astype(np.uint64)) & _ONE).astype(np.uint8)
    return small_labels(2 * place + own, starts, 3)


def begins(names: np.ndarray, starts: np.ndarray, step: int = STEP) -> np.ndarray:
    """Where phrases begin: at the first symbol of a text and at local maxima inside."""
    out = np.zeros(len(names), bool)
    for lo in range(0, len(names), step):
        a, b = max(0, lo - MARGIN), min(len(names), lo + step + MARGIN)
        mine = starts[np.searchsorted(starts, a):np.searchsorted(starts, b)] - a
        label = labels(names[a:b], mine)
        label[mine] = 255                         # so neither its neighbour nor the last symbol of the text before is a maximum
        peak = np.zeros(b - a, bool)
        peak[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
        out[lo:lo + step] = peak[lo - a:min(lo + step, b) - a]
    out[starts] = True
    return out


_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) <= n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(n + 1, base, np.uint64)
            p[0] = 1
            _powers[i] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


BYTES = mixed(np.arange(1, 257, dtype=np.uint64))


def parsed(names: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next level: names of the phrases, and where texts begin among them.  Bytes are names too."""
    new = np.ones(len(names), bool)
    new[1:] = names[1:] != names[:-1]
    new[starts] = True
    kept = np.flatnonzero(new)
    run = np.diff(np.append(kept, len(names)))
    if len(kept) < len(names):
        names, starts = names[kept], np.searchsorted(kept, starts)
    cut = np.flatnonzero(begins(names, starts))
    words = BYTES[names] if names.dtype == np.uint8 else names
    more = np.flatnonzero(run > 1)
    if len(more):
        words = words.copy()
        words[more] = mixed(words[more] ^ mixed(run[more].astype(np.uint64)))
    up, down = powers(len(words))
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[:len(words)], out=total[1:])
    spelled = (total[np.append(cut[1:], len(words))] - total[cut]) * down[cut]
    return mixed(spelled), np.searchsorted(cut, starts)


def sketches(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprints (texts, LEVELS * SLOTS) of the byte strings data[offsets[i]:offsets[i + 1]]."""
    texts = len(offsets) - 1
    out = np.zeros((texts, LEVELS, SLOTS), np.uint8)
    owners = np.flatnonzero(np.diff(offsets) > 0)          # empty texts have no symbols
    if not len(owners):
        return out.reshape(texts, -1)
    names, starts = data, offsets[:-1][owners]
    for level in range(LEVELS):
        names, starts = parsed(names, starts)
        owner = np.repeat(owners, np.diff(np.append(starts, len(names))))
        key = mixed(names + np.uint64(level))
        least = np.full(texts * SLOTS, ~np.uint64(0))
        np.minimum.at(least, owner * SLOTS + (key >> np.uint64(58)).astype(np.int64), key & np.uint64((1 << 58) - 1))
        filled = least != ~np.uint64(0)
        out[:, level] = np.where(filled, 1 + mixed(least) % np.uint64(255), 0).reshape(texts, SLOTS)
    return out.reshape(texts, -1)


def sketched(texts: list[bytes]) -> np.ndarray:
    return sketches(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, 0 to 1."""
    a, b = (x.reshape(len(x), LEVELS, SLOTS) for x in (a, b))
    filled = np.minimum((a > 0).sum(axis=2), (b > 0).sum(axis=2)) >= FILLED
    level = np.where(filled.any(axis=1), LEVELS - 1 - filled[:, ::-1].argmax(axis=1), 0)
    rows = np.arange(len(a))
    a, b = a[rows, level], b[rows, level]
    either = ((a > 0) | (b > 0)).sum(axis=1)
    return np.where(either > 0, ((a == b) & (a > 0)).sum(axis=1) / np.maximum(either, 1), 1.0)


def hexed(prints: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in prints]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row; no shuffle."""
    def task(batches):
        for batch in slices(batches, 1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hexed(sketches(*text_buffers(batch.column(1)))), pa.string())],
                                             names=["doc_id", "fingerprint"])

    return id_text(docs, id_col, text_col).mapInArrow(task, "doc_id long, fingerprint string")


def compare(pairs: DataFrame, left: str, right: str, name: str = "likeness") -> DataFrame:
    """``pairs`` with the likeness of the fingerprints in two of its columns (null if one is null)."""
    @F.pandas_udf("double")
    def both(a, b):
        known = (a.notna() & b.notna()).to_numpy()
        out = a.notna().astype(float).where(known)
        if known.any():
            raw = [np.frombuffer(bytes.fromhex("".join(x[known])), np.uint8).reshape(known.sum(), -1) for x in (a, b)]
            out[known] = likeness(*raw)
        return out

    return pairs.withColumn(name, both(F.col(left), F.col(right)))


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by as much of the beginning of the next."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def dealt(docs: DataFrame, bucket_bytes: int) -> DataFrame:
    """docs (doc_id, text) -> (bucket, extra, isnull, below, hash, row, text): buckets of consecutive rows in descending order of ids;
    ``extra`` rows repeat the first row of the next bucket (of the first bucket, after the last)."""
    keyed = docs.select(F.col("doc_id").isNull().cast("int").alias("isnull"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("below"),
                        F.xxhash64("text").alias("hash"), F.xxhash64(F.monotonically_increasing_id()).alias("row"), "text")
    key = ["isnull", "below", "hash", "row"]
    keys = written(keyed.select(*key, F.octet_length("text").alias("bytes")), "order")
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(1, min(MOST_BUCKETS, -(-int(total) // bucket_bytes)))
    heads = (keys.repartitionByRange(buckets, *key).groupBy(F.spark_partition_id().alias("p"))
             .agg(F.min(F.struct(*key)).alias("first")).collect())              # a row per bucket, MOST_BUCKETS at most
    heads = sorted(tuple(r.first) for r in heads)
    sent_to = defaultdict(list)
    for i, head in enumerate(heads):
        sent_to[head[:3]].append((i - 1) % len(heads))
    types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = ["bucket", "extra", *key, "text"]

    def task(batches):
        sent = set()
        for batch in slices(batches, 1 << 22):
            rows, take = [], []
            for i, k in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)))):
                rows.append((max(0, bisect_right(heads, k) - 1), 0, *k))
                take.append(i)
                for bucket in sent_to.get(k[:3], ()):
                    if bucket not in sent:
                        sent.add(bucket)
                        rows.append((bucket, 1, *k))
                        take.append(i)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*rows), types)),
                                              batch.column(4).take(pa.array(take))], names=names)

    return keyed.mapInArrow(task, "bucket int, extra int, isnull int, below long, hash long, row long, text string")


def against_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def task(batches):
        wait = None                               # bucket, id, text and fingerprint of the row whose next one has not come
        for batch in slices(batches, 1 << 20):
            rows = list(zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 3, 6))))
            pairs, last = [], -1 if wait else None            # (row, next row) by place in the batch; -1: the waiting one
            for i, (bucket, extra, isnull, below, text) in enumerate(rows):
                if last is not None:
                    before = wait[0] if last < 0 else rows[last][0]
                    if before != bucket:
                        raise RuntimeError("the documents changed while they were read")
                    pairs.append((last, i))
                last = None if extra else i
            at = lambda i: wait if i < 0 else (rows[i][0], None if rows[i][2] else ~rows[i][3], rows[i][4])
            versions = [edited(at(a)[2], rows[b][4]).encode("utf-8") for a, b in pairs]
            prints = sketched([r[4].encode("utf-8") for r in rows] + versions)
            own = np.concatenate([prints[:len(rows)], wait[3][None] if wait else prints[:0]])     # the waiting one is at -1
            other = prints[len(rows):]
            if pairs:
                a, b = (np.array(c) for c in zip(*pairs))
                columns = [[at(i)[1] for i in a.tolist()], [len(at(i)[2]) for i in a.tolist()],
                           [hashlib.sha256(v).hexdigest() for v in versions], hexed(own[a]), hexed(other),
                           likeness(own[a], other), likeness(own[a], own[b])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
            wait = None if last is None else (*at(last), own[last]) if last >= 0 else wait
        if wait is not None:
            raise RuntimeError("the documents changed while they were read")

    order = ["bucket", "extra", "isnull", "below", "hash", "row"]
    return (dealt(id_text(docs, id_col, text_col), bucket_bytes).repartition("bucket").sortWithinPartitions(*order)
            .mapInArrow(task, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                              "near_edited double, near_next double"))
