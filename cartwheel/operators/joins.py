"""Join operators: equi joins, interval (late-tolerant) join, dimension lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _interval(bound: str) -> Column:
    return F.expr(f"INTERVAL {bound}")


def interval_condition(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                       left_time: str, right_time: str, lower: str, upper: str) -> Column:
    """``l.key = r.key AND r.time BETWEEN l.time - lower AND l.time + upper``.

    The equality keeps it a hash-partitioned (sort-merge / shuffled-hash)
    join; the time range bounds stream-stream join state under watermarks.
    """
    lt, rt = left[left_time], right[right_time]
    return ((left[left_key] == right[right_key])
            & (rt >= lt - _interval(lower))
            & (rt <= lt + _interval(upper)))


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_time: str, right_time: str, lower: str = "10 seconds",
                  upper: str | None = None, how: str = "inner") -> DataFrame:
    cond = interval_condition(left, right, left_key, right_key, left_time, right_time,
                              lower, upper or lower)
    return left.join(right, cond, how)


HEAVY_SHARE = 1 / 200      # of a side's sampled rows; so a side has fewer than 200 heavy keys
SALTS = 16


def heavy_keys(side: DataFrame, key: str, share: float, fraction: float) -> DataFrame:
    """(key) of the keys with more than ``share`` of the sampled rows: 1 / ``share`` rows at most."""
    rows = side.select(F.col(key).alias("key")).where(F.col(key).isNotNull())
    counted = (rows.sample(fraction, 1) if fraction < 1 else rows).groupBy("key").count()
    return counted.where(F.col("count") > share * counted.agg(F.sum("count").alias("n")).scalar()).select("key")


def _salted(side: DataFrame, key: str, heavy: DataFrame, own: str, other: str, salts: int) -> DataFrame:
    """Rows whose key is heavy on this side get one of ``salts`` numbers in ``own``; rows whose key is heavy on the other
    side are copied to all numbers in ``other``.  All other rows have 0 in both."""
    marked = side.join(F.broadcast(heavy), side[key] == heavy["key"], "left")
    one = F.when(F.col(f"is_{own}"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int")).otherwise(0)
    copies = F.when(F.col(f"is_{other}"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return marked.withColumn(own, one).withColumn(other, F.explode(copies)).drop("key", f"is_{own}", f"is_{other}")


def full_outer_skew_safe(left: DataFrame, right: DataFrame, left_key: str, right_key: str, share: float = HEAVY_SHARE,
                         fraction: float = 0.01, salts: int = SALTS) -> DataFrame:
    """``left`` FULL OUTER JOIN ``right`` ON left_key = right_key, for keys that may hold a large part of either side (a full outer
    join's partitions cannot be split at run time).  Column names of the two sides must differ.

    Matches: an inner join in which heavy keys, found in a sample, are salted on their side and copied on the other.  Unmatched
    rows: anti-joins of either side, salted alike, against the other side's distinct keys.  Rows without a key match
    nothing and are set apart first, so they are not shuffled.  The sample decides how rows spread, never the result."""
    l_heavy, r_heavy = heavy_keys(left, left_key, share, fraction), heavy_keys(right, right_key, share, fraction)
    flag = lambda df, l, r: df.select("key", F.lit(l).alias("l"), F.lit(r).alias("r"))  # noqa: E731,E741
    heavy = (flag(l_heavy, True, False).unionByName(flag(r_heavy, False, True)).groupBy("key")
             .agg(F.bool_or("l").alias("is__l"), F.bool_or("r").alias("is__r")))           # 2 / share rows at most
    keyed_left, keyed_right = left.where(F.col(left_key).isNotNull()), right.where(F.col(right_key).isNotNull())
    l, r = _salted(keyed_left, left_key, heavy, "_l", "_r", salts), _salted(keyed_right, right_key, heavy, "_r", "_l", salts)  # noqa: E741
    r_on = r.withColumnsRenamed({"_l": "_l2", "_r": "_r2"})
    matched = l.join(r_on, (l[left_key] == r_on[right_key]) & (l["_l"] == r_on["_l2"]) & (l["_r"] == r_on["_r2"])).select(*left.columns, *right.columns)

    def unmatched(side, key, other, other_key, own):
        """Rows of ``side`` whose key the other side lacks: its heavy rows stay spread, the other side's keys are copied."""
        spread = _salted(side, key, heavy.withColumn("is__r" if own == "_l" else "is__l", F.lit(False)), own, "_r" if own == "_l" else "_l", salts)
        keys = other.select(F.col(other_key).alias("_k")).distinct()
        keys = keys.join(F.broadcast(heavy), F.col("_k") == F.col("key"), "left")
        copies = F.when(F.col(f"is_{own}"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        keys = keys.select("_k", F.explode(copies).alias("_s"))
        return spread.join(keys, (spread[key] == keys["_k"]) & (spread[own] == keys["_s"]), "left_anti").select(*side.columns)

    only_left = unmatched(keyed_left, left_key, keyed_right, right_key, "_l").unionByName(left.where(F.col(left_key).isNull()))
    only_right = unmatched(keyed_right, right_key, keyed_left, left_key, "_r").unionByName(right.where(F.col(right_key).isNull()))
    return matched.unionByName(only_left, allowMissingColumns=True).unionByName(only_right, allowMissingColumns=True)


def dimension_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "left") -> DataFrame:
    """Left lookup of a dimension row; the planner picks the join by its size estimate
    (``autoBroadcastJoinThreshold``) and AQE by the runtime size."""
    return fact.join(dim, fact[fact_key] == dim[dim_key], how)


def one_row(stats: DataFrame):
    """A one-row aggregate as a struct-valued scalar subquery column: Spark
    computes it once and substitutes the value, so no join pairs any rows.
    Read fields with ``one_row(stats)["name"]``."""
    return stats.select(F.struct(*stats.columns)).scalar()
