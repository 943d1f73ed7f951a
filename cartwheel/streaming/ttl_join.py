"""Order x line join with processing-time TTL state (the cache semantics of
the original job), for when arrival-time expiry is required instead of the
event-time watermark of :func:`cartwheel.streaming.jobs.sale_detail_stream`.

Orders and lines are unioned and grouped by (bucket, salt): the bucket is a hash of the order id, a line goes to one of ``salts``
groups by a hash of its id, an order is copied to all of them, so the lines of a hot order spread over tasks.  A call to the state
store costs far more than a row, so a group holds many orders and its state is kept in pieces of many rows (Arrow).
A ``transformWithStateInPandas`` processor keeps per group, as lists that are only appended to and expire piece by piece:

* ``info``    order versions; the last one of an order is that with the greatest arrival number.  A version expires ``ttl_ms``
  after it was written;
* ``pending`` lines that arrived before their order, expiring ``ttl_ms`` after they were cached.

A line meets its order when both arrive less than ``ttl_ms`` apart (either order), in the version that is the latest at the
end of that micro-batch.  Each pair is emitted once: waiting lines are read only for orders that had no live version before the
micro-batch.  (A line that waits is older than any version written later, so while it lives such a version does too, and the
order is not met anew.)  A group holds its live orders, and of its lines ``CHUNK`` at most, outside the state store: more
lines of one micro-batch go through the list ``spilled``.  State lives in the RocksDB state store under the query checkpoint.
The Python step is the slow path; the watermark join is the default.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..plans.orders import merge_sale_detail

INFO_COLS = ["i_id", "i_user_id", "i_status", "i_create_time", "i_dt"]
DETAIL_COLS = ["d_id", "d_order_id", "d_sku_id", "d_sku_name", "d_price"]
PIECE_SCHEMA = "rows binary"
OUT_SCHEMA = ", ".join(f"{c} string" for c in INFO_COLS + DETAIL_COLS)
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BUCKETS = 1024
CHUNK = 50_000
PIECE = 5_000       # rows of one state entry


def _pieces(rows: pd.DataFrame) -> list[tuple]:
    """The rows as entries of a list state."""
    out = []
    for i in range(0, len(rows), PIECE):
        batch = pa.RecordBatch.from_pandas(rows.iloc[i:i + PIECE], preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as writer:
            writer.write_batch(batch)
        out.append((sink.getvalue().to_pybytes(),))
    return out


def _rows(state) -> Iterator[pd.DataFrame]:
    for (piece,) in state.get():
        yield pa.ipc.open_stream(bytes(piece)).read_pandas()


def _latest(versions: list[pd.DataFrame]) -> pd.DataFrame:
    """Of each order the version with the greatest arrival number (the later one of equals)."""
    rows = pd.concat(versions, ignore_index=True)
    return rows.sort_values("arrival", kind="stable").drop_duplicates("i_id", keep="last", ignore_index=True)


def _met(info: pd.DataFrame, lines: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """(the lines whose order is there, with it; the other lines)."""
    at = pd.Index(info["i_id"]).get_indexer(lines["d_order_id"])
    found = lines[at >= 0].reset_index(drop=True)
    orders = info[INFO_COLS].take(at[at >= 0]).reset_index(drop=True)
    return pd.concat([orders, found], axis=1), lines[at < 0]


class TtlOrderLineJoin(StatefulProcessor):
    def __init__(self, ttl_ms: int = 10_000):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.info = handle.getListState("info", PIECE_SCHEMA, ttlDurationMs=self.ttl_ms)
        self.pending = handle.getListState("pending", PIECE_SCHEMA, ttlDurationMs=self.ttl_ms)
        self.spilled = handle.getListState("spilled", PIECE_SCHEMA, ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh, lines, n, spilled = [], [], 0, False
        for part in rows:
            is_order = part["side"] == "i"
            if is_order.any():
                fresh = [_latest([*fresh, part.loc[is_order, [*INFO_COLS, "arrival"]]])]
            if not is_order.all():
                lines.append(part.loc[~is_order, DETAIL_COLS])
                n += len(lines[-1])
            if n > CHUNK:
                self.spilled.appendList(_pieces(pd.concat(lines)))
                lines, n, spilled = [], 0, True
        live = [v.drop_duplicates("i_id", keep="last") for v in _rows(self.info)]
        held = _latest(live) if live else None
        info, first = held, None
        if fresh:
            info = newer = first = fresh[0]
            if held is not None:
                at = pd.Index(held["i_id"]).get_indexer(newer["i_id"])
                first = newer[at < 0]
                newer = newer[(at < 0) | (newer["arrival"].to_numpy() >= held["arrival"].to_numpy()[at])]
                info = _latest([held, newer])
            if len(newer):
                self.info.appendList(_pieces(newer))    # (re)cache the orders, TTL restarts
        if first is not None and len(first):
            for waiting in _rows(self.pending):
                found, _ = _met(first, waiting)
                if len(found):
                    yield found
        for some in self._arrived(lines, spilled):
            if info is not None:
                found, some = _met(info, some)
                if len(found):
                    yield found
            if len(some):
                self.pending.appendList(_pieces(some))  # wait for the order
        if spilled:
            self.spilled.clear()

    def _arrived(self, lines: list[pd.DataFrame], spilled: bool) -> Iterator[pd.DataFrame]:
        if spilled:
            yield from _rows(self.spilled)
        if lines:
            yield pd.concat(lines)

    def close(self) -> None:
        pass


def _ship_by_value() -> None:
    """Python workers need the processor class; pickle this module by value
    so executors do not need the package installed."""
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


@contextmanager
def rocksdb(spark: SparkSession):
    """A query started inside keeps its state in RocksDB, which this join needs; the session's own setting comes back at the end."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def ttl_sale_detail_stream(orders: DataFrame, details: DataFrame, ttl_ms: int = 10_000, salts: int = 4, arrival: str | None = None) -> DataFrame:
    """Sale-detail rows from the processing-time TTL join (see module doc).  ``arrival`` names the column of ``orders`` that numbers
    arrivals (a topic offset, say); without it any of the versions in one micro-batch may stay.  Start the query inside ``rocksdb``."""
    _ship_by_value()
    none = F.lit(None).cast("string")
    first = F.lit(-2 ** 63).cast("long")
    number = F.lit(0).cast("long") if arrival is None else F.coalesce(F.col(arrival).cast("long"), first)
    bucket = lambda c: F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(BUCKETS)).cast("int").alias("bucket")
    i = orders.select(bucket("id"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit("i").alias("side"),
                      number.alias("arrival"), *[F.col(c).cast("string").alias(a) for c, a in
                                                 zip(["id", "user_id", "order_status", "create_time", "create_date"], INFO_COLS)],
                      *[none.alias(c) for c in DETAIL_COLS])
    d = details.select(bucket("order_id"), F.pmod(F.xxhash64("id", "sku_id"), F.lit(salts)).cast("int").alias("salt"),
                       F.lit("d").alias("side"), first.alias("arrival"), *[none.alias(c) for c in INFO_COLS],
                       *[F.col(c).cast("string").alias(a) for c, a in
                         zip(["id", "order_id", "sku_id", "sku_name", "order_price"], DETAIL_COLS)])
    joined = (i.unionByName(d).groupBy("bucket", "salt")
                .transformWithStateInPandas(statefulProcessor=TtlOrderLineJoin(ttl_ms), outputStructType=OUT_SCHEMA, outputMode="Append",
                                            timeMode="ProcessingTime"))
    return merge_sale_detail(joined)
