"""Helpers shared by the operators: column handling, tables in the shared folder, training folds."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.snapshots import Files
from cartwheel.session import work_path

NULL_ID = -(1 << 63)   # stands for a null id inside the operators


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only; a null text is the empty text.  Every other column is left behind,
    so names inside an operator cannot clash with it."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it again.

    The folder is shared and the table complete, so a lost executor costs no recomputation
    of what stands before it."""
    spark = df.sparkSession
    path = work_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def expire_written(spark: SparkSession, grace: float = 7 * 86400.0) -> int:
    """Delete the tables of ``written`` that are ``grace`` seconds old; returns how many.  Frames that still read them fail, so the
    grace should exceed the longest job."""
    folder = work_path(spark, "llm")
    files, before = Files(spark, folder), time.time() - grace
    old = [n for n, at in files.names(folder) or [] if at <= before]
    for n in old:
        files.delete(f"{folder}/{n}")
    return len(old)


def row_keyed(rows: DataFrame, nulls_last: bool = False) -> DataFrame:
    """``rows`` with the id (first column) replaced by a number of each row's own, and the id itself as ``__id``.

    The numbers ascend with the ids (null first, or last; rows that share an id by a hash of the second column), so "earlier"
    and ties by id can be told from them, and no row is merged with another.  Ids that are unique already (one scan of the
    id column tells) are their own numbers.  Else the rows are sorted, numbered and written once, equal ones spread by
    a row number, so that a hot id fills no task."""
    first, second, *rest = rows.columns
    rows = rows.withColumn("__id", F.col(first).cast("long"))
    unique = rows.withColumn(first, F.coalesce("__id", F.lit(NULL_ID)))
    if nulls_last:
        unique = unique.filter("__id IS NOT NULL")
    repeated = unique.groupBy(first).count().filter("count > 1").limit(1).count()
    if not repeated and not (nulls_last and rows.filter("__id IS NULL").limit(1).count()):
        return unique
    order = F.asc_nulls_last("__id") if nulls_last else F.asc_nulls_first("__id")
    keyed = rows.withColumn("__hash", F.xxhash64(second)).withColumn("__spread", F.xxhash64(F.monotonically_increasing_id()))
    return written(keyed.orderBy(order, "__hash", "__spread").withColumn(first, F.monotonically_increasing_id())
                   .drop("__hash", "__spread"), "rows")


def held_out(id_col: str = "doc_id"):
    """Fold rule of the classifiers: crc32 of the id's text mod 5 is 0 (a null id is in no training fold)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def text_buffers(column: pa.Array) -> tuple:
    """Bytes and offsets (numpy) of an Arrow string column without nulls, without copying."""
    import numpy as np
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if large else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]] if len(column) else raw[:0], offsets.astype(np.int64) - int(offsets[0])


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts take about ``max_bytes`` (one row at least)."""
    import numpy as np
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offs = text_buffers(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + max_bytes, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
