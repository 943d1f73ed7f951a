"""JSON at the edges: wire decode with casts, row -> JSON, after-image -> JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def string_schema(fields) -> T.StructType:
    """All-string wire schema: ``from_json`` does not coerce quoted numbers,
    so every field is read as text and cast afterwards."""
    return T.StructType([T.StructField(f, T.StringType(), True) for f in fields])


def decode(df: DataFrame, fields, casts: dict | None = None, value_col: str = "value",
           mode: str = "failfast", keep: tuple = ()) -> DataFrame:
    """Parse a JSON text column into typed columns.

    ``mode='failfast'`` casts with ANSI semantics (bad text raises, like the
    original); ``mode='permissive'`` uses ``try_cast`` and adds ``_corrupt``
    (true when the JSON did not parse or a cast failed).  Use
    :func:`split_corrupt` to route those rows to a side output.
    """
    casts = casts or {}
    schema = string_schema(fields)
    if mode == "failfast":
        opts = {"mode": "FAILFAST"}
    else:
        schema = schema.add("_corrupt_record", T.StringType())
        opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = df.select(*keep, F.from_json(F.col(value_col), schema, opts).alias("_j"),
                       F.col(value_col).alias("_raw"))
    cols = []
    bad = F.col("_j").isNull() | (F.col("_j")["_corrupt_record"].isNotNull() if mode != "failfast" else F.lit(False))
    for f in fields:
        raw = F.col("_j")[f]
        if f in casts:
            if mode == "failfast":
                cols.append(raw.cast(casts[f]).alias(f))
            else:
                v = raw.try_cast(casts[f])
                bad = bad | (raw.isNotNull() & v.isNull())
                cols.append(v.alias(f))
        else:
            cols.append(raw.alias(f))
    out = parsed.select(*keep, *cols, *( [bad.alias("_corrupt"), F.col("_raw")] if mode != "failfast" else []))
    return out


def split_corrupt(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the marker columns, bad rows with the raw text)."""
    good = decoded.where(~F.col("_corrupt")).drop("_corrupt", "_raw")
    bad = decoded.where(F.col("_corrupt"))
    return good, bad


def row_json(*cols) -> Column:
    """One JSON object per row (``to_json(struct(...))``)."""
    return F.to_json(F.struct(*cols) if cols else F.struct("*"))


def after_image_json(after) -> Column:
    """Array of (name, value) pairs -> JSON object text; values stay strings,
    null values are kept as JSON null, a later duplicate name wins
    (``spark.sql.mapKeyDedupPolicy=LAST_WIN``)."""
    a = F.col(after) if isinstance(after, str) else after
    return F.to_json(F.map_from_entries(a), {"ignoreNullFields": "false"})
