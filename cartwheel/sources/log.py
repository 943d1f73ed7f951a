"""Topic log in files: partitioned, offset-numbered messages that streams read in bounded micro-batches.

``append_log`` writes a micro-batch of messages below ``<path>/<batch>/topic_=<topic>/part_=<partition>/``, files of at most ``segment`` messages
each.  A message's partition is the hash of its key; offsets count from 0 without gaps in every (topic, partition), in the
order given.  A batch that is appended again is left as it is, so a replay repeats nothing.

``read_log`` streams the topics of a pattern, at most ``most`` messages a micro-batch, from the earliest message or from those after its first
start (``latest``).  Progress lives in the stream's checkpoint: a stream that stops in mid-log goes on behind its last batch.  One stream
reads all partitions, or a group of streams one partition each (``part``), side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.snapshots import Files

SEGMENT = 100
SCHEMA = "topic string, part int, offset long, key string, value string"


def write_once(rows: DataFrame, place: str, partition_by=(), **options) -> bool:
    """Write a folder whole, unless it is there already (an earlier attempt of the same micro-batch); True if written now."""
    files = Files(rows.sparkSession, place)
    if files.names(f"{place}/_SUCCESS") is not None:
        return False
    rows.write.mode("overwrite").options(**options).partitionBy(*partition_by).parquet(place)
    if files.names(f"{place}/_SUCCESS") is None:
        files.create(f"{place}/_SUCCESS", "")
    return True


def batch_log(spark: SparkSession, path: str, topics: str = "*") -> DataFrame:
    """All messages of the topics now (no rows if there are none)."""
    files = Files(spark, path)
    if not any(files.holds_data(f"{path}/{n}") for n, _ in files.names(path) or []):
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    pattern = "".join(".*" if c == "*" else "." if c == "?" else f"\\{c}" if not c.isalnum() and c != "_" else c for c in topics)
    return rows.where(F.col("topic").rlike(f"^{pattern}$"))


def heads(spark: SparkSession, path: str) -> DataFrame:
    """(topic, part, next): the offset that the next message of each log partition gets; a row per partition."""
    return batch_log(spark, path).groupBy("topic", "part").agg((F.max("offset") + 1).alias("next"))


def append_log(messages: DataFrame, path: str, batch: int, order_by=("key",), partitions: int = 4, segment: int = SEGMENT) -> None:
    """Append (topic, key, value, columns of ``order_by``) as micro-batch ``batch``.  Each log partition is numbered by one task, so
    ``partitions`` sets how a hot topic spreads."""
    place = f"{path}/{int(batch):012d}"
    spark = messages.sparkSession
    if Files(spark, place).names(f"{place}/_SUCCESS") is not None:
        return
    part = F.pmod(F.xxhash64(F.coalesce("key", F.lit(""))), F.lit(partitions)).cast("int")
    numbered = messages.withColumn("part", part).withColumn(
        "_n", F.row_number().over(Window.partitionBy("topic", "part").orderBy(*order_by)) - 1)
    before = heads(spark, path).select("topic", "part", "next")
    rows = (numbered.join(F.broadcast(before), ["topic", "part"], "left")          # a row per log partition
            .select("topic", "part", (F.col("_n") + F.coalesce("next", F.lit(0))).cast("long").alias("offset"), F.col("key").cast("string"),
                    F.col("value").cast("string"), F.col("topic").alias("topic_"), F.col("part").alias("part_")))
    # a log partition's files come one after another: streams read the oldest first
    rows = rows.repartition("topic", "part").sortWithinPartitions("topic", "part", "offset")
    write_once(rows, place, ["topic_", "part_"], maxRecordsPerFile=segment)


def read_log(spark: SparkSession, path: str, topics: str = "*", most: int = SEGMENT, segment: int = SEGMENT, starting: str = "earliest",
             checkpoint: str | None = None, part: int | None = None) -> DataFrame:
    """The log as a stream (``SCHEMA``): topics by file pattern, ``most`` messages a micro-batch (at least one file's).  ``part``: only that
    partition of the topics; the streams of all partitions read every message once, each with a checkpoint of its own.
    ``starting='latest'`` notes where the log ends beside the ``checkpoint`` at its first start and leaves earlier messages out."""
    rows = (spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max(1, most // segment))
            .parquet(f"{path}/*/topic_={topics}" + ("" if part is None else f"/part_={part}")))
    if starting == "earliest":
        return rows
    note = f"{checkpoint}/starting_offsets"
    write_once(heads(spark, path), note)
    first = spark.read.schema("topic string, part int, next long").parquet(note)
    return (rows.join(F.broadcast(first), ["topic", "part"], "left").where(F.col("offset") >= F.coalesce("next", F.lit(0)))
            .select(*rows.columns))
