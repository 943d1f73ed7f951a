"""Exact removal of repeated byte strings (``length`` bytes or more) over a whole corpus.

A byte goes if some ``length``-byte window that covers it also starts earlier (smaller doc_id, or
earlier in the same document).  Only windows that can repeat are ever sorted:

1. **Families.**  Every window is assigned the least hash among its ``GRAM``-byte substrings.  The choice depends on
   the window's bytes alone, so equal windows share it.  Consecutive windows with one choice are a *family*; its *block*
   is the text they cover.  There are some 27 times fewer families than bytes; each is one small row.
2. **Equal blocks.**  Families whose blocks have the same 128-bit BLAKE2b digest repeat as a whole: all but the first are covered.
   The digest verifies what the polynomial hashes only nominate.  Tasks settle this for their own rows first, so a group
   of copies sends one row per task, however large it is.
3. **Borders.**  A choice that is left with several different blocks stands at the edge of a repeated passage.  Only
   these blocks are fetched from their documents and compared window by window (``covered_windows``): equal window hashes
   nominate starts, a hash-compared suffix mergesort groups and orders them, binary search on prefix hashes gives each match's
   extension, and the match is verified byte by byte.
4. A choice with more than ``hot`` different blocks is spread by window instead of by choice, after each task has settled
   its own windows, so it fills no single task.

The text is shuffled once (Spark reuses the exchange for the fetch and for the cut).

Null and empty texts lose nothing.  Rows that share a doc_id (or have none) are documents of their own, ordered by a hash of
the text (``row_keyed``); null ids come first.  Columns other than the id and the text are not read.  An empty table gives no rows."""

from __future__ import annotations

import hashlib
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_keyed, slices, text_buffers, written
from .suffix import Hashed, mixed, sliding

GRAM = 32
CHUNK = 1 << 19      # windows hashed at a time; also the most windows of a family
HOT_BLOCKS = 2000    # different blocks of one choice that may stay in one task
SETTLE = 1 << 18     # families a task holds while it settles its own copies
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
COVERED, BORDER, HOT = 0, 1, 2


def families(data: np.ndarray, offsets: np.ndarray, length: int, gram: int, chunk: int = CHUNK):
    """(start, count, choice, repeats itself) of the families, by offset in ``data``; documents end at ``offsets``."""
    n, width = len(data) - length + 1, length - gram + 1
    if n <= 0:
        return
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, np.clip(offsets[1:] - length + 1, 0, n), 1)
    np.add.at(edge, np.clip(offsets[1:], 0, n), -1)
    within = np.cumsum(edge[:-1]) == 0       # windows that no document's end cuts
    for at in range(0, n, chunk):
        to = min(at + chunk, n)
        keep = np.flatnonzero(within[at:to])
        if not len(keep):
            continue
        text = Hashed(data[at:to + length - 1])
        grams = text.grams(gram)
        least = sliding(grams, width, np.minimum)
        value = least[keep]
        new = np.ones(len(keep), bool)
        new[1:] = (value[1:] != value[:-1]) | (keep[1:] != keep[:-1] + 1)
        first = np.flatnonzero(new)
        start, count = keep[first], np.diff(np.append(first, len(keep)))
        choice = value[first]
        # two equal least grams in reach of one window: its family may repeat itself
        padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        anchors = np.flatnonzero(sliding(padded, width, np.maximum) == grams)
        close = (grams[anchors[1:]] == grams[anchors[:-1]]) & (anchors[1:] - anchors[:-1] < width)
        mark = np.zeros(len(start) + 1, np.int32)
        if close.any():
            i, j = anchors[:-1][close], anchors[1:][close]
            f0 = np.maximum(np.searchsorted(start, np.maximum(j - width + 1, 0), "right") - 1, 0)
            f1 = np.searchsorted(start, i, "right")
            np.add.at(mark, f0, 1)
            np.add.at(mark, f1, -1)
        yield start + at, count, choice, np.cumsum(mark[:-1]) > 0


def _span(start, count, flag):
    """start, windows (below 2^21) and two flag bits in one long."""
    return start << 23 | count << 2 | flag


def _start(span):
    return span >> 23


def _count(span):
    return span >> 2 & ((1 << 21) - 1)


def family_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """docs (doc_id, text) -> (choice, digest1, digest2, doc_id, span).  The flag's bit 0: may repeat itself; bit 1: known to be
    covered (an equal block of this task comes earlier), with a random choice so that such rows spread evenly."""
    def settle(parts):
        choice, one, two, doc, span = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(one, kind="stable")
        same = one[order][1:] == one[order][:-1]
        multi = np.zeros(len(order), bool)
        multi[1:] |= same
        multi[:-1] |= same
        rows = order[multi]
        rows = rows[np.lexsort((span[rows], doc[rows], two[rows], one[rows], choice[rows]))]
        again = np.zeros(len(rows), bool)
        again[1:] = np.logical_and.reduce([c[rows[1:]] == c[rows[:-1]] for c in (choice, one, two)])
        gone = rows[again]
        span[gone] |= 2
        choice[gone] = mixed(span[gone].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ mixed(doc[gone].astype(np.uint64)))
        return pa.RecordBatch.from_arrays([pa.array(choice.view(np.int64)), pa.array(one), pa.array(two), pa.array(doc), pa.array(span)],
                                          names=["choice", "digest1", "digest2", "doc_id", "span"])

    def task(batches):
        parts, held = [], 0
        for batch in slices(batches, 1 << 22):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = text_buffers(batch.column(1))
            raw = memoryview(np.ascontiguousarray(data))
            for start, count, choice, itself in families(data, offsets, length, gram):
                owner = np.searchsorted(offsets, start, "right") - 1
                digest = b"".join([blake2b(raw[s:e], digest_size=16).digest()
                                   for s, e in zip(start.tolist(), (start + count + length - 1).tolist())])
                one, two = np.frombuffer(digest, np.int64).reshape(-1, 2).T
                parts.append((choice, one, two, ids[owner], _span(start - offsets[owner], count, itself.astype(np.int64))))
                held += len(start)
                if held >= SETTLE:
                    yield settle(parts)
                    parts, held = [], 0
        if parts:
            yield settle(parts)

    return docs.mapInArrow(task, "choice long, digest1 long, digest2 long, doc_id long, span long")


def candidate_rows(rows: DataFrame, hot: int) -> DataFrame:
    """Family rows -> (doc_id, choice, span) with the flag COVERED, BORDER or HOT; the rest cannot repeat.

    One pass over rows sorted by (choice, digest, place).  A group waits until it is whole, or known to be hot."""
    def task(batches):
        names = ["doc_id", "choice", "span"]
        wait = np.empty((0, 5), np.int64)      # rows of the last choice, not yet decided
        over = None                            # that choice, once hot; its last digest
        over_block = None

        def decided(rows, flag):
            if not len(rows):
                return None
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in (
                rows[:, 3], rows[:, 0], rows[:, 4] & ~np.int64(3) | flag)], names=names)

        def sort_out(rows, whole):
            """Covered rows, border rows and rows of a hot, unfinished choice."""
            nonlocal over, over_block
            if not len(rows):
                return rows, rows, rows
            again = np.zeros(len(rows), bool)
            again[1:] = (rows[1:, :3] == rows[:-1, :3]).all(axis=1)
            if over is not None:
                again[0] = rows[0, 0] == over and (rows[0, 1:3] == over_block).all()
            firsts = rows[~again]
            new = np.ones(len(firsts), bool)
            new[1:] = firsts[1:, 0] != firsts[:-1, 0]
            group = np.cumsum(new) - 1
            size = np.bincount(group, minlength=1)[group] if len(firsts) else group
            itself = (firsts[:, 4] & 1) == 1
            is_hot = size > hot
            if over is not None:
                is_hot |= firsts[:, 0] == over
            if not whole and len(firsts):
                is_hot |= firsts[:, 0] == rows[-1, 0]
            border = ((size > 1) | itself) & ~is_hot
            return rows[again], firsts[border], firsts[is_hot]

        def flush(rows, whole):
            for part, flag in zip(sort_out(rows, whole), (COVERED, BORDER, HOT)):
                out = decided(part, flag)
                if out is not None:
                    yield out

        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(5)], axis=1)
            known = (rows[:, 4] & 2) == 2
            out = decided(rows[known], COVERED)
            if out is not None:
                yield out
            rows = np.concatenate([wait, rows[~known]])
            if not len(rows):
                continue
            cut = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
            if cut:
                yield from flush(rows[:cut], True)
                over = over_block = None
            wait = rows[cut:]
            if len(wait) > hot or (over is not None and over == wait[0, 0]):
                yield from flush(wait, False)
                over, over_block, wait = wait[-1, 0], wait[-1, 1:3], wait[:0]
        yield from flush(wait, True)

    return (rows.repartition("choice").sortWithinPartitions("choice", "digest1", "digest2", "doc_id", "span")
            .mapInArrow(task, "doc_id long, choice long, span long"))


def covered_windows(text: Hashed, at: np.ndarray, count: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks at ``at`` with ``count`` windows each, equal windows only between blocks listed in order of place.
    Returns (block, first window, windows) of the runs of windows that occur earlier."""
    block = np.repeat(np.arange(len(at)), count)
    inner = np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
    window = at[block] + inner
    h = text.of(window, length)
    order = np.argsort(h, kind="stable")
    same = np.zeros(len(order), bool)
    same[1:] = h[order][1:] == h[order][:-1]
    head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    link = np.empty(len(order), np.int64)
    link[order] = head                       # the earliest window with this hash
    later = np.flatnonzero(link != np.arange(len(link)))
    if not len(later):
        return later, later, later
    mine, theirs = block[later], link[later]
    new = np.ones(len(later), bool)
    new[1:] = (later[1:] != later[:-1] + 1) | (mine[1:] != mine[:-1]) | (theirs[1:] != theirs[:-1] + 1) | (block[theirs[1:]] != block[theirs[:-1]])
    first = np.flatnonzero(new)
    run, windows = later[first], np.diff(np.append(first, len(later)))
    a, b = window[run], window[link[run]]
    # suffix order of all nominated starts; equal neighbours are one class, its first the earliest place
    starts = np.unique(np.concatenate([a, b]))
    sorted_ = text.suffix_order(starts, length)
    ext = text.extension(sorted_[1:], sorted_[:-1], np.full(len(sorted_) - 1, length))
    cls = np.concatenate([[0], np.cumsum(ext < length)])
    lead = sorted_[np.searchsorted(cls, cls)]
    leader = lead[np.argsort(sorted_)][np.searchsorted(starts, a)]
    reach = np.minimum(windows + length - 1, text.extension(a, leader, np.minimum(windows + length - 1, len(text.data) - np.maximum(a, leader))))
    ok = (leader < a) & (reach >= length)
    ok[ok] = text.same_bytes(a[ok], leader[ok], reach[ok])
    found = np.where(ok, reach - length + 1, 0)
    out = [(mine[first], inner[run], found)]
    for r in np.flatnonzero(found < windows):      # a hash collision: the rest of the run byte by byte
        for w in range(int(run[r] + found[r]), int(run[r] + windows[r])):
            s = window[w]
            seen = window[:w][h[:w] == h[w]]
            if any(np.array_equal(text.data[s:s + length], text.data[e:e + length]) for e in seen):
                out.append((block[w:w + 1], inner[w:w + 1], np.ones(1, np.int64)))
    blocks, starts, found = (np.concatenate(c) for c in zip(*out))
    return blocks[found > 0], starts[found > 0], found[found > 0]


def border_blocks(joined: DataFrame, length: int) -> DataFrame:
    """(doc_id, text, spans) -> (choice, doc_id, start, count, bytes); blocks of a hot choice become single windows under their
    own hash, and a window the task has had earlier is sent as covered (bytes null, count 1)."""
    names = ["choice", "doc_id", "start", "count", "bytes"]
    types = [pa.int64()] * 4 + [pa.binary()]

    def task(batches):
        seen: dict[bytes, tuple] = {}
        for batch in slices(batches, 1 << 22):
            rows = []
            for doc, text, spans in zip(*(batch.column(c).to_pylist() for c in range(3))):
                data = text.encode("utf-8")
                for s in sorted(spans, key=lambda x: x["span"]):
                    start, n, flag = _start(s["span"]), _count(s["span"]), s["span"] & 3
                    if flag != HOT:
                        rows.append((s["choice"], doc, start, n, data[start:start + n + length - 1]))
                        continue
                    for w in range(start, start + n):
                        piece, place = data[w:w + length], (doc, w)
                        had = seen.get(piece)
                        if had is None or place < had:
                            if had is None and len(seen) >= 1 << 17:
                                seen.clear()
                            seen[piece], send = place, place
                            key = int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "big", signed=True)
                            rows.append((key, *send, 1, piece))
                        if had is not None and place != had:
                            rows.append((doc ^ w << 20, *max(place, had), 1, None))
                if len(rows) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return joined.mapInArrow(task, "choice long, doc_id long, start long, count long, bytes binary")


def settle_borders(blocks: DataFrame, length: int, chunk_bytes: int = 1 << 21) -> DataFrame:
    """Border blocks -> (doc_id, start, count) of the windows that occur earlier."""
    names = ["doc_id", "start", "count"]

    def emit(*columns):
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(c, np.int64)) for c in columns], names=names)

    def settle(rows):
        raw = b"".join(r[4] for r in rows)
        size = np.array([len(r[4]) for r in rows], np.int64)
        doc, start, count = (np.array([r[c] for r in rows], np.int64) for c in (1, 2, 3))
        block, first, n = covered_windows(Hashed(np.frombuffer(raw, np.uint8)), np.cumsum(size) - size, count, length)
        return emit(doc[block], start[block] + first, n)

    def task(batches):
        rows, held, last = [], 0, None
        for batch in batches:
            choice, doc, start, count, data = (batch.column(c).to_pylist() for c in range(5))
            done = [i for i, b in enumerate(data) if b is None]
            if done:
                yield emit([doc[i] for i in done], [start[i] for i in done], [count[i] for i in done])
            for row in zip(choice, doc, start, count, data):
                if row[4] is None:
                    continue
                if held >= chunk_bytes and row[0] != last:
                    yield settle(rows)
                    rows, held = [], 0
                last = row[0]
                # the same place may come twice from two tasks' windows; it is one window
                if rows and rows[-1][:4] == row[:4]:
                    continue
                rows.append(row)
                held += len(row[4])
        if rows:
            yield settle(rows)

    return (blocks.repartition("choice").sortWithinPartitions("choice", "doc_id", "start")
            .mapInArrow(task, "doc_id long, start long, count long"))


def runs(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The maximal runs that [from, to) spans cover."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], hi)
        else:
            out.append((lo, hi))
    return out


def without(data: bytes, gone: list[tuple[int, int]]) -> bytes:
    """The bytes outside the runs."""
    ends = [0, *(hi for _, hi in gone)]
    return b"".join(data[a:b] for a, b in zip(ends, [*(lo for lo, _ in gone), len(data)]))


def whole_characters(data: bytes, gone: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs moved inwards to characters, so that only fully repeated ones go."""
    out = []
    for lo, hi in gone:
        while lo < hi and data[lo] & 0xC0 == 0x80:
            lo += 1
        while hi > lo and hi < len(data) and data[hi] & 0xC0 == 0x80:
            hi -= 1
        out.append((lo, hi))
    return out


def dedup_substrings(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text",
                     gram: int = GRAM, hot: int = HOT_BLOCKS, with_text: bool = False,
                     keep_columns: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: its bytes, the bytes and maximal runs removed, SHA-256 of what is left (``with_text``: and
    the text without the characters of which every byte was removed; ``keep_columns``: and these columns as they were)."""
    rows = row_keyed(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                                 *[F.col(c).alias(f"__{i}") for i, c in enumerate(keep_columns)]))
    docs, kept_columns = rows.select("doc_id", "text"), rows.columns[2:]
    marks = written(candidate_rows(family_rows(docs, length, gram), hot), "families")
    flag = F.col("span").bitwiseAND(3)
    wanted = marks.filter(flag != COVERED).groupBy("doc_id").agg(F.collect_list(F.struct("choice", "span")).alias("spans"))
    fetched = border_blocks(docs.join(wanted.hint("shuffle_merge"), "doc_id"), length)
    known = marks.filter(flag == COVERED).select(
        "doc_id", F.shiftright("span", 23).alias("start"), F.shiftright("span", 2).bitwiseAND((1 << 21) - 1).alias("count"))
    gone = (known.unionByName(settle_borders(fetched, length)).groupBy("doc_id")
            .agg(F.collect_list(F.struct("start", "count")).alias("spans")))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["text"] * with_text

    def task(batches):
        for batch in slices(batches, 1 << 22):
            rows = []
            for doc, text, spans in zip(*(batch.column(c).to_pylist() for c in range(3))):
                data = text.encode("utf-8")
                gone = runs([(s["start"], s["start"] + s["count"] + length - 1) for s in spans or ()])
                row = (doc, len(data), sum(hi - lo for lo, hi in gone), len(gone), hashlib.sha256(without(data, gone)).hexdigest())
                rows.append((*row, without(data, whole_characters(data, gone)).decode("utf-8")) if with_text else row)
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*rows), types)), *batch.columns[3:]],
                                             names=names + kept_columns)

    schema = SCHEMA + ", text string" * with_text + "".join(
        f", `{c}` {rows.schema[c].dataType.simpleString()}" for c in kept_columns)
    out = rows.join(gone.hint("shuffle_merge"), "doc_id", "left").select("doc_id", "text", "spans", *kept_columns).mapInArrow(task, schema)
    return out.select(F.col("__id").alias("doc_id"), *names[1:], *[F.col(f"__{i}").alias(c) for i, c in enumerate(keep_columns)])
