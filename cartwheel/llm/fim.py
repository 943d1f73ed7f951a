"""Fill-in-middle: cut a document at line ends into prefix, middle and suffix and reorder them around sentinels.

A text is cut into units (lines with their line feed; the last one may lack it).  Its UTF-8 bytes are held in blocks of ``BLOCK``
bytes, and two Fenwick trees over the blocks hold the units that end in each and the code points that begin in each.  A cut
after k units is found by binary lifting: the descent gives the block in which the k-th unit ends and the code points before
that block; only that block is searched and counted.  So a cut reads one block however long the text is, and
offsets come out in code points without decoding.

Cuts and form follow from SHA-256 of ``seed:doc_id`` alone: no shuffle, the same result in every run and on every retry.
``restore`` rebuilds the text from output and form; it is exact since texts that contain a sentinel stay plain.

Null text: empty.  Empty text: plain, n 0.  Null doc_id: hashed as the empty string, so such rows share their hash (not their
cuts, which depend on n too).  Repeated rows give repeated results.  Columns other than the id and the text are not read.  An
empty table gives no rows."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, slices, text_buffers

BLOCK = 1024
MARKERS = ("<P>", "<S>", "<M>")        # before prefix, suffix, middle
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def fenwick(values: np.ndarray) -> np.ndarray:
    """The tree (from place 1; place 0 is unused) over ``values``."""
    i = np.arange(1, len(values) + 1)
    total = np.concatenate([[0], np.cumsum(values)])
    return np.concatenate([[0], total[i] - total[i - (i & -i)]])


class Blocks:
    """UTF-8 bytes with the trees of units and code points over their blocks."""

    def __init__(self, data: np.ndarray, block: int = BLOCK):
        self.data, self.block = data, block
        starts = np.arange(0, len(data), block)
        sums = lambda marks: np.add.reduceat(marks, starts, dtype=np.int64) if len(data) else np.empty(0, np.int64)
        self.ends, self.points = fenwick(sums(data == 10)), fenwick(sums(data & 0xC0 != 0x80))
        ended = self.total(self.ends)
        self.units = ended + (len(data) > 0 and int(data[-1]) != 10)

    @staticmethod
    def total(tree: np.ndarray) -> int:
        i, out = len(tree) - 1, 0
        while i:
            out += int(tree[i])
            i &= i - 1
        return out

    def cut(self, k: int) -> tuple[int, int]:
        """Byte offset and code points before the end of the k-th unit (k = 0: the beginning)."""
        if k <= 0:
            return 0, 0
        if k >= self.units:
            return len(self.data), self.total(self.points)
        at, points, n = 0, 0, len(self.ends) - 1
        step = 1 << (n.bit_length() - 1)
        while step:                              # whole blocks in which fewer than k units end
            to = at + step
            if to <= n and self.ends[to] < k:
                k -= int(self.ends[to])
                points += int(self.points[to])
                at = to
            step >>= 1
        lo = at * self.block
        inside = self.data[lo:lo + self.block]
        end = int(np.flatnonzero(inside == 10)[k - 1]) + 1
        return lo + end, points + int(np.count_nonzero(inside[:end] & 0xC0 != 0x80))


def draws(seed, doc_id) -> list[int]:
    """h1 to h4: the first four 8-digit groups of the hex SHA-256."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in range(0, 32, 8)]


def transform(docs: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50, markers: tuple[str, str, str] = MARKERS,
              id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row: doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars (code points, null if plain) and
    output, the text that a model is trained on.  ``rate`` percent of the documents are cut, ``spm_rate`` percent of these as spm."""
    p, s, m = (x.encode() for x in markers)
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def one(doc, data, raw):
        blocks = Blocks(data, block)
        h1, h2, h3, h4 = draws(seed, doc)
        n = blocks.units
        if not n or h3 % 100 >= rate or p in raw or s in raw or m in raw:
            return doc, n, "plain", None, None, raw
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        (x, before), (y, until) = blocks.cut(a), blocks.cut(b)
        prefix, middle, suffix = raw[:x], raw[x:y], raw[y:]
        spm = h4 % 100 < spm_rate
        out = s + suffix + p + prefix + m + middle if spm else p + prefix + s + suffix + m + middle
        return doc, n, "spm" if spm else "psm", before, until - before, out

    def task(batches):
        for batch in slices(batches, 1 << 22):
            data, offsets = text_buffers(batch.column(1))
            rows = []
            for doc, lo, hi in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                rows.append(one(doc, data[lo:hi], data[lo:hi].tobytes()))
            columns = list(zip(*rows))
            columns[5] = pa.array(columns[5], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)],
                                             names=names)

    return id_text(docs, id_col, text_col).mapInArrow(task, SCHEMA)


def restored(output, form, markers: tuple[str, str, str] = MARKERS):
    """The exact text as a column expression of output and form."""
    parts = F.split(output, "|".join(re.escape(x) for x in markers), 4)     # '', then the pieces in the order of the form
    piece = lambda i: F.get(parts, F.lit(i))
    return (F.when(form == "psm", F.concat(piece(1), piece(3), piece(2)))
            .when(form == "spm", F.concat(piece(2), piece(3), piece(1))).otherwise(output))


def restore(rows: DataFrame, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """``transform``'s rows with the text rebuilt from them as ``restored``."""
    return rows.withColumn("restored", restored(F.col("output"), F.col("form"), markers))


def digests(docs: DataFrame, **options) -> DataFrame:
    """``transform`` and ``restore`` with SHA-256 of both texts in their place."""
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    rows = restore(transform(docs, **options), options.get("markers", MARKERS))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha("output").alias("output_sha256"),
                       sha("restored").alias("restored_sha256"))
