"""Keyed tables as append-only Parquet with snapshots.

A micro-batch writes its rows into a folder of its own and then publishes a snapshot that names it (``snapshots``); the latest
(or first) row per key is picked when the table is read.  So a write costs what the batch holds, whatever the table
holds; a write that fails leaves every stored row; a replayed batch replaces its own folder only; and readers see whole
micro-batches.

``compact`` merges folders in place: ``FAN`` folders of one level become one of the next, with one row per key.  It runs beside
writers and readers.  So after n micro-batches a reader merges some ``FAN`` x log(n) folders, and a row is rewritten log(n)
times.  ``tidy``, which the streaming jobs call after every write, also deletes what was replaced ``RETAIN`` seconds ago."""

from __future__ import annotations

import functools
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import snapshots
from .dedup import pick_per_key
from .snapshots import FOLDER, Folder, Snapshot

BATCH = "batch_id"
FAN = 8
RETAIN = 3600.0
UNPUBLISHED = {"mapreduce.fileoutputcommitter.algorithm.version": "2", "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols or [])


def _write(rows: DataFrame, place: str, parts: list[str], arranged: bool = False) -> None:
    # few files per partition; AQE still splits a skewed partition value.  A folder counts only once a snapshot names it, so its
    # files are not moved again when the job ends, nor marked as whole
    (rows if arranged else rows.hint("rebalance", *parts)).write.partitionBy(*parts).options(**UNPUBLISHED).parquet(place)


def _with_columns_of(stored_schema: StructType, new: StructType) -> StructType:
    """The stored schema, and the columns that only the new rows have."""
    known = {f.name: f.dataType for f in stored_schema}
    for f in new:
        if f.name in known and known[f.name] != f.dataType:
            raise ValueError(f"column {f.name} is stored as {known[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return StructType([*stored_schema, *(f for f in new if f.name not in known)])


def append(batch: DataFrame, path: str, batch_id: int, partition_by=None, arranged: bool = False) -> None:
    """Write ``batch`` as micro-batch ``batch_id`` of the table; a replay replaces that micro-batch only.  ``arranged``: the rows lie
    in few partitions that suit the table, and are not shuffled for it."""
    spark, parts, number = batch.sparkSession, _names(partition_by), int(batch_id)
    out = batch.withColumn(BATCH, F.lit(number).cast("long"))
    snapshots.create(spark, path, out.schema, parts)
    name, place = snapshots.new_folder(path)
    _write(out, place, parts, arranged)
    filled = snapshots.Files(spark, path).holds_data(place)

    def add(s: Snapshot) -> bool:
        s.schema = _with_columns_of(s.schema, out.schema)
        s.retire({f.name for f in s.live if f.low == f.high == number and f.level == 0})
        if filled:
            s.live.append(Folder(name, number, number))
        s.last = number if s.last is None else max(s.last, number)
        return True

    snapshots.commit(spark, path, add)


def _read(spark: SparkSession, path: str, s: Snapshot, folders: list[Folder]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], s.schema)
    return (spark.read.schema(StructType(list(s.schema)).add(FOLDER, "string")).option("basePath", f"{path}/data")
            .parquet(*[f"{path}/data/{FOLDER}={f.name}" for f in folders]).select(*s.schema.names))


def stored(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """All rows of the newest snapshot (or of ``version``) with ``batch_id``, None if nothing was ever written there.
    Any other folder raises: it must not pass for an empty table."""
    s = snapshots.current(spark, path, version)
    return None if s is None else _read(spark, path, s, s.live)


def first_number(spark: SparkSession, path: str, checkpoint: str) -> int:
    """The number that a stream's micro-batch 0 gets in the table: one above those stored when this checkpoint was new.  It is
    kept beside the checkpoint, so a restarted stream goes on and a stream with a new checkpoint overwrites nothing."""
    note = f"{checkpoint}/first_number"
    try:
        return int(spark.read.text(note).first()[0])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    s = snapshots.current(spark, path)
    first = 0 if s is None or s.last is None else s.last + 1
    spark.createDataFrame([(str(first),)], "value string").coalesce(1).write.text(note)
    return first


def read_keyed(spark: SparkSession, path: str, keys, order_by=(), keep: str = "last", where=None,
               version: int | None = None) -> DataFrame | None:
    """One row per key: of the last micro-batch that wrote it (``keep='first'``: of the first), within a micro-batch the
    largest (smallest) by ``order_by``.  A filter on key columns prunes by itself; ``where`` prunes by columns that never
    change for a key.  ``version``: as that snapshot had it."""
    table = stored(spark, path, version)
    if table is None:
        return None
    if where is not None:
        table = table.where(where)
    return pick_per_key(table, _names(keys), [BATCH, *_names(order_by)], keep).drop(BATCH)


def _due(s: Snapshot, fan: int, everything: bool) -> list[Folder]:
    """The folders to merge next: ``fan`` of the lowest level that has them.  The newest micro-batch is left out, since it
    may be written again."""
    settled = [f for f in s.live if f.low < s.last or f.level]
    if everything:
        return settled if len(settled) > 1 else []
    for level in sorted({f.level for f in settled}):
        mine = sorted((f for f in settled if f.level == level), key=lambda f: f.low)
        if len(mine) >= fan:
            return mine[:fan]
    return []


def compact(spark: SparkSession, path: str, keys=None, order_by=(), keep: str = "last", fan: int = FAN, everything: bool = False) -> int:
    """Merge folders in place while ``fan`` of one level are there (``everything``: all settled ones into one), one row per
    key (all rows without ``keys``).  Returns how many merges were published; one that a replay overtakes is dropped."""
    done = 0
    while True:
        s = snapshots.current(spark, path)
        group = _due(s, fan, everything) if s is not None else []
        if not group:
            return done
        rows = _read(spark, path, s, group)
        if keys:
            rows = pick_per_key(rows, _names(keys), [BATCH, *_names(order_by)], keep)
        name, place = snapshots.new_folder(path)
        _write(rows, place, s.partition_by)
        names = {f.name for f in group}
        merged = Folder(name, min(f.low for f in group), max(f.high for f in group), 1 + max(f.level for f in group))

        def switch(now: Snapshot) -> bool:
            if not names <= {f.name for f in now.live}:
                return False
            now.retire(names)
            now.live.append(merged)
            return True

        if snapshots.commit(spark, path, switch) is None:
            snapshots.Files(spark, path).delete(place)
        else:
            done += 1


def tidy(spark: SparkSession, path: str, keys=None, order_by=(), keep: str = "last", fan: int = FAN, retain: float = RETAIN) -> None:
    """Keep the table small after a write: merge what is due, and delete what was replaced ``retain`` seconds ago."""
    if compact(spark, path, keys, order_by, keep, fan):
        snapshots.expire(spark, path, retain)


class TidyBeside:
    """``tidy`` beside a writer of many small micro-batches, which calls this after a write and does not wait: one ``tidy`` at a
    time, in a thread of its own.  A failure is raised at the next call; leaving the ``with`` block merges what is still due."""

    def __init__(self, spark: SparkSession, path: str, *args, **options):
        self.tidy = functools.partial(tidy, spark, path, *args, **options)
        self.thread, self.running = ThreadPoolExecutor(1), None

    def __call__(self) -> None:
        if self.running is None or self.running.done():
            if self.running is not None:
                self.running.result()
            self.running = self.thread.submit(self.tidy)

    def __enter__(self) -> TidyBeside:
        return self

    def __exit__(self, kind, *_) -> None:
        self.thread.shutdown(wait=True)
        if kind is None:
            if self.running is not None:
                self.running.result()
            self.tidy()


def fill_missing_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Every row without an id gets one of its own (content and place), so equal rows without ids all stay."""
    content = F.sha2(F.to_json(F.struct(*[c for c in df.columns if c != id_col])), 256)
    own = F.concat_ws("-", F.lit("auto"), content, F.monotonically_increasing_id().cast("string"))
    return df.withColumn(id_col, F.coalesce(F.col(id_col).cast("string"), own))


def split_rejected(df: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """(rows whose key columns are all set, rejected rows with a reason).
    Rejected rows are returned as data for a side output, never just logged."""
    keys = _names(keys)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    ok = df.where(~missing)
    bad = df.where(missing).withColumn("_reason", F.lit("missing key: " + ",".join(keys)))
    return ok, bad


def append_accepted(batch: DataFrame, path: str, batch_id: int, keys, partition_by=None, order_by=(), keep: str = "last") -> None:
    """Append the rows that have a key; the others go to the table ``<path>_rejected`` with a reason.  Both are tidied."""
    ok, bad = split_rejected(batch, keys)
    append(ok, path, batch_id, partition_by)
    append(bad, f"{path}_rejected", batch_id)
    tidy(batch.sparkSession, path, keys, order_by, keep)
    tidy(batch.sparkSession, f"{path}_rejected")


def append_distinct(batch: DataFrame, path: str, keys, batch_id: int, partition_by=None) -> None:
    """Set-add of key tuples; read the set with ``read_keyed(spark, path, keys)``."""
    append(batch.select(*_names(keys)).distinct(), path, batch_id, partition_by)
    tidy(batch.sparkSession, path, keys, keep="first")
