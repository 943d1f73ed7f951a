"""Pluggable topic source: the same logical stream from Kafka, JSON-lines
files or Parquet files, as a streaming or a batch DataFrame.

Kafka and JSON files give ``value`` text (decode with
:func:`cartwheel.functions.jsonfns.decode`); Parquet files give typed rows.
Progress lives in the query checkpoint, not in a consumer group.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class TopicSource:
    kind: str                     # "kafka" | "json" | "parquet"
    topic: str = ""               # kafka topic, or with ``pattern`` a topic pattern
    pattern: bool = False         # subscribe by pattern
    path: str = ""                # folder for file kinds
    servers: str = ""             # kafka bootstrap servers
    schema: T.StructType | None = None   # parquet schema (streams need it up front)
    glob: str | None = None       # file-name filter, e.g. "events*.parquet"
    starting_offsets: str = "latest"
    options: dict = field(default_factory=dict)

    def _reader(self, reader):
        for k, v in self.options.items():
            reader = reader.option(k, v)
        if self.glob:
            reader = reader.option("pathGlobFilter", self.glob)
        return reader

    def stream(self, spark: SparkSession) -> DataFrame:
        return self._load(spark, streaming=True)

    def batch(self, spark: SparkSession) -> DataFrame:
        return self._load(spark, streaming=False)

    def _load(self, spark: SparkSession, streaming: bool) -> DataFrame:
        r = spark.readStream if streaming else spark.read
        if self.kind == "kafka":
            r = self._reader(r.format("kafka").option("kafka.bootstrap.servers", self.servers)
                             .option("subscribePattern" if self.pattern else "subscribe", self.topic))
            if streaming:
                r = r.option("startingOffsets", self.starting_offsets)
            df = r.load()
            return df.select(F.col("value").cast("string").alias("value"), "timestamp", "partition", "offset")
        if self.kind == "json":
            df = self._reader(r.format("text")).load(self.path)
            return df.select("value")
        if self.kind == "parquet":
            schema = self.schema
            if schema is None:
                schema = spark.read.parquet(self.path).schema if not self.glob else \
                    spark.read.option("pathGlobFilter", self.glob).parquet(self.path).schema
            return self._reader(r.format("parquet").schema(schema)).load(self.path)
        raise ValueError(f"unknown source kind {self.kind!r}")
