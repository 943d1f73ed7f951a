"""Order and line streams joined with nothing lost: matched and unmatched rows from the join, late rows at the side.

``split_late`` stands before the join.  It knows how far the event time of its source has come in earlier micro-batches, and
writes rows that are more than ``bound`` behind to a table of their own, with that mark; all others go on as a clean feed.  The
join's watermark never runs ahead of this mark, so the join drops nothing.  Both outputs of a micro-batch are written once: a
replay finds them and repeats nothing.

``start_outer_join`` joins a micro-batch as it lies with the rows that earlier ones left open, and keeps as Parquet only those that a
later one can still meet.  So memory does not hold the rows of a micro-batch, as the engine's state join does."""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.joins import interval_join
from ..operators.snapshots import Files
from ..operators.upsert import append, stored
from ..sources.log import write_once


def _mark(spark: SparkSession, path: str, before: int) -> int | None:
    """The greatest event time (epoch µs) of the micro-batches below ``before``."""
    files = Files(spark, path)
    found = sorted(n for n, _ in files.names(f"{path}/marks") or [] if not n.startswith(".") and n.isdigit() and int(n) < before)
    return int(files.read(f"{path}/marks/{found[-1]}")) if found else None


def late_splitter(path: str, time_col: str, bound: str):
    """foreachBatch body: rows behind the mark by more than ``bound`` to the keyed table ``<path>/late`` (with ``behind``, the time they
    missed), the others to ``<path>/clean/<batch>``; then the mark moves on.  Rows without a time are late."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, files = batch.sparkSession, Files(batch.sparkSession, path)
        mark = _mark(spark, path, batch_id)
        edge = F.lit(None).cast("timestamp") if mark is None else F.timestamp_micros(F.lit(mark)) - F.expr(f"INTERVAL {bound}")
        late = F.col(time_col).isNull() | F.coalesce(F.col(time_col) < edge, F.lit(False))
        append(batch.where(late).withColumn("behind", edge), f"{path}/late", batch_id)
        clean = f"{path}/clean/{batch_id:012d}"
        write_once(batch.where(~late), clean)
        # late rows are behind the mark, so one column of the others tells how far it moves
        top = spark.read.schema(batch.schema).parquet(clean).agg(F.max(F.unix_micros(time_col))).first()[0]
        files.create(f"{path}/marks/{batch_id:012d}", str(max(x for x in (mark, top, -1 << 62) if x is not None)))
    return write


def start_split(rows: DataFrame, path: str, checkpoint: str, time_col: str = "event_ts", bound: str = "10 seconds",
                available_now: bool = False, trigger: str = "5 seconds") -> StreamingQuery:
    w = rows.writeStream.queryName("split_late").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.foreachBatch(late_splitter(path, time_col, bound)).start()


def clean_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows on time as a stream."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path}/clean/*")


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that came too late, with ``behind``."""
    return stored(spark, f"{path}/late")


def start_outer_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str, right_time: str, path: str,
                     checkpoint: str, bound: str = "10 seconds", available_now: bool = False, trigger: str = "5 seconds") -> StreamingQuery:
    """``interval_join`` of two streams, left outer, into the table ``path``: pairs at once, rows of ``left`` without a match once the
    watermark has passed the last row that they could meet.  Column names of the two sides must differ.

    The watermark is ``bound`` behind the slower side; rows behind it are dropped (after ``start_split`` there are none).  Open rows, how
    far the sides have come and the watermark are written beside the checkpoint, per micro-batch, so a replay finds those of its
    predecessor."""
    sides = left.unionByName(right, allowMissingColumns=True)
    times, time, span = (left_time, right_time), F.coalesce(left_time, right_time), F.expr(f"INTERVAL {bound}")
    files = Files(left.sparkSession, checkpoint)
    open_rows, marks = lambda n: f"{checkpoint}/open/{n}", lambda n: f"{checkpoint}/watermarks/{n}"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spark.conf.set("spark.sql.adaptive.enabled", "true")     # of the stream's own session; nothing is kept in state stores
        before = json.loads(files.read(marks(batch_id - 1))) if batch_id else {}
        at = lambda state: F.timestamp_micros(F.lit(state["watermark"]).cast("long"))  # noqa: E731    null: no watermark yet
        fresh = batch.where(time.isNotNull()).withColumns({"_fresh": F.lit(True), "_met": F.lit(False)})
        if before.get("watermark") is not None:
            fresh = fresh.where(time >= at(before))
        found = fresh.agg(*[F.unix_micros(F.max(c)).alias(c) for c in times]).first().asDict()
        now = {c: max((ms for ms in (found[c], before.get(c)) if ms is not None), default=None) for c in times}
        slower = None if None in now.values() else min(now.values())
        passed = None if slower is None else spark.range(1).select(F.unix_micros(F.timestamp_micros(F.lit(slower)) - span)).first()[0]
        now["watermark"] = max((ms for ms in (passed, before.get("watermark")) if ms is not None), default=None)

        rows = fresh
        if batch_id:
            rows = fresh.unionByName(spark.read.schema(fresh.schema).parquet(open_rows(batch_id - 1)).withColumn("_fresh", F.lit(False)))
        side = lambda rows: (
            rows.where(F.col(left_time).isNotNull()).select(*left.columns, F.col("_fresh").alias("_l_fresh"), F.col("_met").alias("_l_met")),
            rows.where(F.col(right_time).isNotNull() & F.col(right_key).isNotNull()).select(*right.columns, F.col("_fresh").alias("_r_fresh")))
        joined = lambda i, d, how: interval_join(i, d, left_key, right_key, left_time, right_time, bound, bound, how)
        reaches = lambda t, far: F.coalesce(t + far >= at(now), F.lit(True))     # the times of rows that are not behind
        out = joined(*side(rows), "left_outer").where(F.when(F.col(right_time).isNotNull(), F.col("_l_fresh") | F.col("_r_fresh"))
                                                      .otherwise(~reaches(F.col(left_time), span) & ~F.col("_l_met")))
        append(out.select(*left.columns, *right.columns), path, batch_id)

        # rows stay open that one not behind the watermark can still meet; what those have met lies as far behind again
        near = rows.where(reaches(time, span + span)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            i, d = side(near)
            i = i.where(reaches(F.col(left_time), span))
            kept = (joined(i, d, "left_semi").withColumn("_met", F.lit(True))
                    .unionByName(joined(i, d, "left_anti").withColumn("_met", F.col("_l_met")))
                    .unionByName(d.where(reaches(F.col(right_time), span)), allowMissingColumns=True))
            (kept.select(*sides.columns, F.lit(False).alias("_fresh"), F.coalesce("_met", F.lit(False)).alias("_met")).hint("rebalance")
             .write.mode("overwrite").parquet(open_rows(batch_id)))
        finally:
            near.unpersist()
        files.delete(marks(batch_id))        # that of an attempt before
        files.create(marks(batch_id), json.dumps(now))
        for of in (open_rows, marks):
            files.delete(of(batch_id - 2))      # the engine replays the last micro-batch only

    w = sides.writeStream.queryName("outer_join").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.foreachBatch(write).start()
