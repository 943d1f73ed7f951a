"""Nearest vectors and largest inner products by tiled matrix products.

Rows are dealt into tiles: (query block, shard).  A shard is a hash class of the rows of about ``SHARD`` vectors, a query block
one of the queries of about ``BLOCK``; so tiles are even whatever the ids are.  Within its tile a task reads the queries
first and then streams the candidates past them, ``STEP`` at a time, so its memory does not grow with the tile.  The top lists of
the tiles are merged per query in a tree of fan-in ``FAN``.

* ``exact_top_k``: integer inner products; a tile keeps what reaches the query's k-th score, ties included.
* ``nearest``: products of int8 codes give every distance up to a proven error; pairs whose lower bound reaches the k-th
  upper bound are recomputed in float64 and go through a heap per query.  The result equals brute force (recall 1).

Vectors that are null or hold a null or non-finite component take no part (``nearest``: zero ones neither).  Rows that share a
vec_id are vectors of their own, queries each; rows without one are candidates, after all others in ties.  Distances
that overflow or underflow when squared are summed in units of their largest component.  Vectors of different lengths are not
compared.  A query without candidates, like an empty table, gives no rows.  Other columns are not read."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_keyed, written

BLOCK, SHARD, STEP, FAN = 8192, 1 << 16, 1024, 16


def usable(vectors: DataFrame, zero: bool, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v array<double>, __id): the vectors that take part; vec_id numbers the rows in the order of their ids ``__id``."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.filter(F.col("v").isNotNull() & ~bad)
    if not zero:
        v = v.filter(F.exists("v", lambda x: x != 0))
    return row_keyed(v, nulls_last=True)


def tiled(v: DataFrame, is_query, k: int, tile_lists, block: int, shard: int) -> DataFrame:
    """(query_id, top array<struct<key, vec_id>>) with the k least (key, vec_id) per query."""
    n, q = v.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    shards, blocks = max(1, math.ceil(n / shard)), max(1, math.ceil(q / block))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    dim = F.size("v").alias("dim")
    rows = (v.filter(is_query).select(dim, F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int").alias("block"),
                                      every(shards).alias("shard"), F.lit(0).alias("role"), "vec_id", "v")
            .unionByName(v.select(dim, every(blocks).alias("block"),
                                  F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(shards)).cast("int").alias("shard"),
                                  F.lit(1).alias("role"), "vec_id", "v")))
    key = ["dim", "block", "shard"]

    def task(batches):
        names = ["query_id", "shard", "top"]
        types = [pa.int64(), pa.int32(), pa.list_(pa.struct([("key", tile_lists.key), ("vec_id", pa.int64())]))]
        tile, queries, lists = None, [], None

        def emit():
            if lists is None:
                return
            rows = [(i, tile[2], [{"key": a, "vec_id": b} for a, b in top]) for i, top in lists.tops() if top]
            for at in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at:at + 4096]), types)], names=names)

        for batch in batches:
            d, b, s, role, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(5))
            edge = np.flatnonzero((np.diff(d) != 0) | (np.diff(b) != 0) | (np.diff(s) != 0) | (np.diff(role) != 0)) + 1
            for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(d)]):
                now = (int(d[lo]), int(b[lo]), int(s[lo]))
                if now != tile:
                    yield from emit()
                    tile, queries, lists = now, [], None
                flat = batch.column(5).slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False)
                part = (ids[lo:hi], flat.reshape(hi - lo, now[0]))
                if role[lo] == 0:
                    queries.append(part)
                elif queries:
                    if lists is None:
                        lists = tile_lists(np.concatenate([p[0] for p in queries]), np.concatenate([p[1] for p in queries]), k)
                    for at in range(0, hi - lo, STEP):
                        lists.add(part[0][at:at + STEP], part[1][at:at + STEP])
        yield from emit()

    kind = "bigint" if tile_lists.key == pa.int64() else "double"
    tops = (rows.repartition(*key).sortWithinPartitions(*key, "role")
            .mapInArrow(task, f"query_id long, shard int, top array<struct<key: {kind}, vec_id: bigint>>"))
    while True:
        shards = math.ceil(shards / FAN)
        tops = (tops.groupBy("query_id", F.floor(F.col("shard") / FAN).cast("int").alias("shard"))
                .agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top")))
        if shards == 1:
            return tops.select("query_id", "top")


class Products:
    """Top lists of one tile by integer inner product; keys are negated scores."""

    key = pa.int64()

    def __init__(self, ids, vectors, k):
        self.ids, self.k = ids, k
        self.q = np.floor(1024.0 * vectors)
        self.largest = np.abs(self.q).max(initial=0)
        self.floor = np.full(len(ids), -np.inf)
        self.row, self.score, self.vec = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)

    def add(self, ids, vectors):
        c = np.floor(1024.0 * vectors)
        if self.largest * np.abs(c).max(initial=0) * max(1, c.shape[1]) < 2.0 ** 53:
            scores = self.q @ c.T                        # exact in float64
        else:                                            # beyond: exact in Python integers, held to a long
            whole = np.vectorize(int, otypes=[object])
            scores = np.clip(whole(self.q) @ whole(c).T, -(1 << 63) + 1, (1 << 63) - 1) if c.size else self.q @ c.T
            if self.score.dtype != object:
                self.score, self.floor = self.score.astype(object), self.floor.astype(object)
        if scores.dtype != self.score.dtype:
            scores = scores.astype(object)
        scores[self.ids[:, None] == ids[None, :]] = -np.inf
        bar = self.floor
        if scores.shape[1] > self.k and scores.dtype != object:
            bar = np.maximum(bar, np.partition(scores, scores.shape[1] - self.k, axis=1)[:, -self.k])
        r, c = np.nonzero((scores >= bar[:, None]) & (scores > -np.inf))
        row, score, vec = np.append(self.row, r), np.append(self.score, scores[r, c]), np.append(self.vec, ids[c])
        if score.dtype == object:
            order = np.array(sorted(range(len(row)), key=lambda i: (row[i], -score[i], vec[i])), np.int64)
        else:
            order = np.lexsort((vec, -score, row))
        row, score, vec = row[order], score[order], vec[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = rank < self.k
        last = rank == self.k - 1
        self.floor[row[last]] = score[last]
        self.row, self.score, self.vec = row[keep], score[keep], vec[keep]

    def tops(self):
        cut = np.searchsorted(self.row, np.arange(len(self.ids) + 1))
        for i, q in enumerate(self.ids.tolist()):
            part = slice(cut[i], cut[i + 1])
            yield q, [(-int(s), v) for s, v in zip(self.score[part], self.vec[part].tolist())]


class Distances:
    """Top lists of one tile by Euclidean distance, through int8 codes."""

    key = pa.float64()

    def __init__(self, ids, vectors, k):
        self.ids, self.v, self.k = ids, vectors, k
        self.code = self.coded(vectors)
        self.heaps = [[] for _ in ids]           # (-distance, -vec_id), the worst first
        self.worst = np.full(len(ids), np.inf)

    @staticmethod
    def coded(v):
        """int8 codes (as floats that multiply exactly), scale, norm of the decoded vector, error norm, slack."""
        scale = np.abs(v).max(axis=1) / 127
        with np.errstate(all="ignore"):
            code = np.where(scale[:, None] > 0, np.rint(v / scale[:, None]), 0.0)
        code = np.clip(np.nan_to_num(code), -127, 127)
        back = code * scale[:, None]
        kind = np.float32 if v.shape[1] * 127 * 127 < 1 << 24 else np.float64
        with np.errstate(over="ignore"):
            norm, error = np.sqrt((back * back).sum(axis=1)), np.sqrt(((v - back) ** 2).sum(axis=1))
        return code.astype(kind), scale, norm, error, 1e-7 * norm + 1e-150

    def add(self, ids, vectors):
        q, qs, qn, qe, qx = self.code
        c, cs, cn, ce, cx = self.coded(vectors)
        tile = (q @ c.T).astype(np.float64)
        with np.errstate(all="ignore"):
            about = np.sqrt(np.maximum(qn[:, None] ** 2 + cn[None, :] ** 2 - 2 * (qs[:, None] * cs[None, :]) * tile, 0))
            error = (qe + qx)[:, None] + (ce + cx)[None, :]
            lower, upper = about - error, about + error
        known = np.isfinite(about) & np.isfinite(error)          # beyond doubles there is no bound, and the pair is recomputed
        lower[~known], upper[~known] = -np.inf, np.inf
        own = self.ids[:, None] == ids[None, :]
        upper[own] = np.inf
        bar = self.worst
        if upper.shape[1] > self.k:
            bar = np.minimum(bar, np.partition(upper, self.k - 1, axis=1)[:, self.k - 1])
        row, col = np.nonzero((lower <= bar[:, None]) & ~own)
        total = np.zeros(len(row))
        with np.errstate(over="ignore", under="ignore"):
            for j in range(self.v.shape[1]):     # in component order, as a plain loop would sum
                total += (self.v[row, j] - vectors[col, j]) ** 2
            exact = np.sqrt(total)
            odd = np.flatnonzero(~np.isfinite(total) | (total < 1e-280))
            if len(odd):
                apart = self.v[row[odd]] - vectors[col[odd]]
                unit = np.abs(apart).max(axis=1, initial=0.0)
                inside = (unit > 0) & np.isfinite(unit)
                odd, apart, unit = odd[inside], apart[inside], unit[inside]
                exact[odd] = unit * np.sqrt(((apart / unit[:, None]) ** 2).sum(axis=1))
        near = exact <= self.worst[row]
        for r, d, vec in zip(row[near].tolist(), exact[near].tolist(), ids[col[near]].tolist()):
            heap = self.heaps[r]
            if len(heap) < self.k:
                heapq.heappush(heap, (-d, -vec))
            elif (-d, -vec) > heap[0]:
                heapq.heapreplace(heap, (-d, -vec))
            if len(heap) == self.k:
                self.worst[r] = -heap[0][0]

    def tops(self):
        for q, heap in zip(self.ids.tolist(), self.heaps):
            yield q, [(-d, -v) for d, v in sorted(heap, reverse=True)]


def _search(vectors, every, k, kind, zero, id_col, vector_col, block, shard):
    v = written(usable(vectors, zero, id_col, vector_col), "vectors")
    tops = tiled(v, F.col("__id") % every == 0, k, kind, block, shard)
    hits = tops.select("query_id", F.posexplode("top").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.key").alias("key"))
    if v.filter(~F.col("vec_id").eqNullSafe(F.col("__id"))).limit(1).count():        # numbered rows: back to their ids
        for c in ("query_id", "vec_id"):
            ids = v.select(F.col("vec_id").alias(c), "__id")
            hits = hits.join(ids, c).drop(c).withColumnRenamed("__id", c)
    return hits.select("query_id", "rank", "vec_id", "key")


def exact_top_k(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding",
                block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """The k largest inner products of floor(1024 x) for each row whose id is divisible by ``every``, against all other rows."""
    hits = _search(vectors, every, k, Products, True, id_col, vector_col, block, shard)
    return hits.select("query_id", "rank", "vec_id", (-F.col("key")).alias("score"))


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding",
            block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """The k nearest rows by Euclidean distance for each row whose id is divisible by ``every``."""
    hits = _search(vectors, every, k, Distances, False, id_col, vector_col, block, shard)
    return hits.select("query_id", "rank", "vec_id", F.col("key").alias("score"))
