"""SimHash near-duplicate groups.

* Fingerprint: a bit is 1 where more than half of the XXH64 values (seed 42) of the word shingles have it.
* Embedding: the bit counts of ``SEGMENTS`` equal segments.  Flipping a bit moves one count by one, so the Manhattan
  distance of two count vectors is a lower bound of the bit distance.
* Grid range join: two integer vectors at distance 2 or less share a grid point within distance 1 of both.
  Every distinct fingerprint goes to its own point and those one step away; at each point the fingerprints are
  verified exactly.  Distances above 2 are reached with as many steps as ``max_bits`` halved, rounded up.
* Equal fingerprints are one node (represented by their smallest doc_id) before anything is
  joined, so a group of copies of any size costs one row.

A point lists a chain of links that keeps its fingerprints connected as they are, never all pairs.
The exact check inside a point finds neighbours by flipping bits (each flip set is looked up
by sorting), so its cost grows linearly with the point's fingerprints.

Null and empty texts have fingerprint zero and link like any other; a null doc_id is smaller than every id
when the component is named.  Repeated rows give repeated results.  An empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, id_text, slices, written
from .components import components

SEGMENTS = 16


def fingerprint(text: str, shingle: int) -> int:
    """The 64-bit fingerprint of a text (see the module docstring)."""
    from xxhash import xxh64_intdigest as h
    words = text.encode("utf-8").lower().split()    # bytes: A-Z only, and the six ASCII white spaces
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [h(b" ".join(words), 42)]
    else:
        hashes = [h(b" ".join(g), 42) for g in zip(*(words[i:] for i in range(shingle)))]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at:at + (1 << 16)], dtype=">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""
    def task(batches):
        for batch in slices(batches, 1 << 22):
            fps = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))],
                                             names=["doc_id", "fp"])
    return id_text(docs, id_col, text_col).mapInArrow(task, "doc_id long, fp long")


def grid_points(fps: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, point) for every grid point within ``steps`` of each fingerprint's count vector; a point is the
    counts written in four bits each (a count is at most 64 / SEGMENTS = 4)."""
    width = 64 // SEGMENTS
    bits = np.unpackbits(fps.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    counts = bits.reshape(len(fps), SEGMENTS, width).sum(axis=2).astype(np.int64)
    place = (np.uint64(1) << (np.uint64(4) * np.arange(SEGMENTS, dtype=np.uint64)))
    rows, frontier = np.arange(len(fps)), counts
    found_rows, found = [rows], [(counts.astype(np.uint64) * place).sum(axis=1, dtype=np.uint64)]
    for _ in range(steps):
        next_rows, next_counts = [], []
        for s in range(SEGMENTS):
            for move in (-1, 1):
                ok = (frontier[:, s] + move >= 0) & (frontier[:, s] + move <= width)
                moved = frontier[ok].copy()
                moved[:, s] += move
                next_rows.append(rows[ok])
                next_counts.append(moved)
        rows, frontier = np.concatenate(next_rows), np.concatenate(next_counts)
        found_rows.append(rows)
        found.append((frontier.astype(np.uint64) * place).sum(axis=1, dtype=np.uint64))
    rows, points = np.concatenate(found_rows), np.concatenate(found)
    if steps > 1:
        rows, points = np.unique(np.stack([rows.astype(np.uint64), points]), axis=1)
    return rows.astype(np.int64), points


def near_links(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (i, j) that connect the distinct fingerprints of one grid point exactly as all pairs within
    ``max_bits`` would.  Up to 64 fingerprints: every pair is compared.  More: fingerprints within
    max_bits meet at a value that flips at most half the bits (rounded up) of either; the members of
    such a value are verified against its first member, and among themselves where max_bits is odd."""
    n = len(fps)
    if n <= 64 or max_bits % 2:
        hits_i, hits_j = [], []
        for at in range(0, n, 256):
            d = np.bitwise_count(fps[at:at + 256, None] ^ fps[None, :])
            i, j = np.nonzero(d <= max_bits)
            keep = i + at < j
            hits_i.append(i[keep] + at)
            hits_j.append(j[keep])
        return np.concatenate(hits_i), np.concatenate(hits_j)
    # even max_bits = 2r: all within r flips of one value are pairwise within 2r, so a chain is exact
    values, owner = [fps], [np.arange(n)]
    front, who = fps, np.arange(n)
    for _ in range(max_bits // 2):
        flips = np.uint64(1) << np.arange(64, dtype=np.uint64)
        front, who = (front[:, None] ^ flips[None, :]).ravel(), np.repeat(who, 64)
        values.append(front)
        owner.append(who)
    values, owner = np.concatenate(values), np.concatenate(owner)
    order = np.lexsort((owner, values))
    values, owner = values[order], owner[order]
    same = (values[1:] == values[:-1]) & (owner[1:] != owner[:-1])
    pairs = np.unique(np.stack([owner[:-1][same], owner[1:][same]]), axis=1)
    return pairs[0], pairs[1]


def spanning(i: np.ndarray, j: np.ndarray) -> list[int]:
    """Indices of a spanning forest of the links."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keep = []
    for k, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
            keep.append(k)
    return keep


def fingerprint_links(nodes: DataFrame, max_bits: int = 2) -> DataFrame:
    """nodes (fp, node), fp distinct -> links (a, b) between nodes within ``max_bits`` bits, as connected as all of them."""
    steps = (max_bits + 1) // 2

    def to_points(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                rows, points = grid_points(part.column(0).to_numpy(zero_copy_only=False).view(np.uint64), steps)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(points.view(np.int64)), part.column(0).take(pa.array(rows)), part.column(1).take(pa.array(rows))],
                    names=["point", "fp", "node"])

    def at_points(batches):
        """Sorted by point; the last point of a batch may go on in the next, so it waits."""
        held = np.empty((0, 3), np.int64)
        for batch in chain_end(batches):
            if batch is not None:
                new = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)], axis=1)
                held = np.concatenate([held, new])
                whole = int(np.searchsorted(held[:, 0], held[-1, 0])) if len(held) else 0
            else:
                whole = len(held)
            if not whole:
                continue
            done, held = held[:whole], held[whole:]
            cuts = np.flatnonzero(np.diff(done[:, 0])) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [whole]])
            a, b = [], []
            size = ends - starts
            two = starts[size == 2]            # most shared points hold just two
            near = np.bitwise_count((done[two, 1] ^ done[two + 1, 1]).view(np.uint64)) <= max_bits
            a.append(done[two[near], 2])
            b.append(done[two[near] + 1, 2])
            for s, e in zip(starts[size > 2].tolist(), ends[size > 2].tolist()):
                i, j = near_links(np.ascontiguousarray(done[s:e, 1]).view(np.uint64), max_bits)
                keep = spanning(i, j)
                a.append(done[s:e, 2][i[keep]])
                b.append(done[s:e, 2][j[keep]])
            a, b = np.concatenate(a), np.concatenate(b)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return (nodes.select("fp", "node").mapInArrow(to_points, "point long, fp long, node long")
            .repartition("point").sortWithinPartitions("point")
            .mapInArrow(at_points, "a long, b long").distinct())


def chain_end(batches):
    """The batches, then None."""
    yield from batches
    yield None


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    prints = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min(F.coalesce("doc_id", F.lit(NULL_ID))).alias("node")), "nodes")
    found = components(fingerprint_links(nodes, max_bits))
    named = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    out = prints.join(named, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.when(F.col("component_id") != NULL_ID, F.col("component_id")).alias("component_id"))
