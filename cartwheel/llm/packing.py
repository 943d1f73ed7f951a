"""Sequence packing with balanced attention cost.

Each task tokenises its documents and packs them in groups of about ``group_tokens`` tokens:

1. A document's full stretches of ``capacity`` tokens are sequences of their own.
2. The rests go, longest first, to the sequence of lowest cost (linear plus quadratic in the
   piece lengths) that has room for them.  A rest that fits nowhere is cut: the roomiest
   sequence takes what it can and the remainder queues again.
3. The sequences of a group hold exactly the group's tokens: as many of ``capacity`` as go, and for
   the last few tokens one sequence for each power of two in their number.  So nothing is padded.

Documents are independent, so there is no shuffle; a hot source or id changes nothing.  A group is
bounded by ``group_tokens`` (a longer document leaves as full sequences), so memory is too.

Token ids are those of the given ``tokenizers`` file.  They are computed with ``tiktoken`` from that
file's vocabulary (about five times faster, the same ids; compared in the tests), and with
``tokenizers`` itself for texts holding a run without (or of) white space over ``LONG_RUN`` characters,
on which tiktoken's merging is quadratic.

Null and empty texts are documents of one token (the end id).  Repeated rows are documents of their own.
An empty table gives no rows.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import id_text, slices

LONG_RUN = 1000
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, sequence_tokens long")
#: The split pattern of this family of byte-level BPE vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level BPE files write for each byte, as letter -> byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """text -> ids for a byte-level BPE file of ``tokenizers``."""
    import tiktoken
    from tokenizers import Tokenizer
    spec = json.load(open(path, encoding="utf-8"))
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("packing", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
    exact, run = Tokenizer.from_file(path), re.compile(r"\S{%d}|\s{%d}" % (LONG_RUN, LONG_RUN))

    def encode(text: str) -> list[int]:
        if len(text) >= LONG_RUN and run.search(text):
            return exact.encode(text, add_special_tokens=False).ids
        if any(s in text for s in special):
            return fast.encode(text, allowed_special="all", disallowed_special=())
        return fast.encode_ordinary(text)

    return encode


def pack_group(docs: list[tuple], capacity: int) -> list[tuple]:
    """Pieces (doc index, start, length, sequence, offset, sequence length) of a group of (id, ids) documents."""
    out, rest, sequence = [], [], 0
    for d, (_, ids) in enumerate(docs):
        full = len(ids) - len(ids) % capacity
        for start in range(0, full, capacity):
            out.append((d, start, capacity, sequence, 0, capacity))
            sequence += 1
        if full < len(ids):
            rest.append((-(len(ids) - full), d, full))
    total = -sum(r[0] for r in rest)
    size = np.array([capacity] * (total // capacity)
                    + [1 << b for b in reversed(range((total % capacity).bit_length())) if total % capacity >> b & 1], np.int64)
    left, cost = size.copy(), np.zeros(len(size))
    heapq.heapify(rest)
    while rest:
        length, d, start = heapq.heappop(rest)
        length = -length
        fits = np.where(left >= length, cost, np.inf)
        to = int(fits.argmin())
        if fits[to] == np.inf:
            to = int(left.argmax())
            heapq.heappush(rest, (-(length - int(left[to])), d, start + int(left[to])))
            length = int(left[to])
        out.append((d, start, length, sequence + to, int(size[to] - left[to]), int(size[to])))
        left[to] -= length
        cost[to] += length + length * length / capacity
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, group_tokens: int = 1 << 19,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence (``with_ids``: and its ids).

    ``sequence_id`` holds the partition's number above bit 40, so it is unique over all tasks and
    the same when a task is run again."""
    names = [c.split()[0] for c in SCHEMA.split(", ")] + ["ids"] * with_ids

    def task(batches):
        encode = encoder(tokenizer)
        base, group, held, used = TaskContext.get().partitionId() << 40, [], 0, 0

        def emit():
            nonlocal used
            rows = [[] for _ in names]
            last = -1
            for d, start, length, seq, offset, size in pack_group(group, capacity):
                doc_id, ids = group[d]
                piece = ids[start:start + length]
                row = (doc_id, start, length, zlib.crc32(piece.tobytes()), len(ids), base + used + seq, offset, size)
                for column, value in zip(rows, (*row, piece) if with_ids else row):
                    column.append(value)
                last = max(last, seq)
            used += last + 1
            types = [pa.int64()] * 8 + [pa.list_(pa.int64())] * with_ids
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=names)

        for batch in slices(batches, 1 << 22):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.array([*encode(text), end_id], dtype="<u4")
                group.append((doc_id, ids))
                held += len(ids)
                if held >= group_tokens:
                    yield emit()
                    group, held = [], 0
        if group:
            yield emit()

    return id_text(docs, id_col, text_col).mapInArrow(task, SCHEMA + ", ids array<long>" * with_ids)
