"""Row counters per stage without extra jobs (``DataFrame.observe``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observe_count(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter; read ``obs.get[stage]`` after an action.  In a
    streaming query the value appears in ``lastProgress.observedMetrics``."""
    obs = Observation(stage)
    return df.observe(obs, F.count(F.lit(1)).alias(stage)), obs


def observe_stream_count(df: DataFrame, stage: str) -> DataFrame:
    return df.observe(stage, F.count(F.lit(1)).alias(stage))
