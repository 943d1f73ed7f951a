"""Inverted index: postings by term, kept up to date by micro-batches, for ranked and boolean search without reading texts.

Three keyed tables below one path:

* ``documents``: (doc, length, terms with their counts), by document; the source of what follows.
* ``postings``: (term, doc, tf, length) in ``buckets`` partitions by the hash of the term.  A document that is indexed again writes its
  terms anew, and tf 0 for terms it no longer has, so the last write per (term, doc) holds.
* ``statistics``: what each micro-batch added to the number of documents and of tokens, written last: readers see a micro-batch
  once its statistics are there.

A query prunes to the partitions of its terms and pushes the terms to the scan, so its cost follows the postings of those
terms.  A term that a third of all documents hold is spread by document where postings are written and read.  No data is read while a
query's frame is built (files are listed), and nothing is materialised for it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import analyse, tokens
from .dedup import latest_per_key, pick_per_key
from . import snapshots
from .joins import one_row
from .upsert import BATCH, append, stored, tidy

BUCKETS = 64


def _bucket(term, buckets: int):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("string")


def document_terms(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, length, terms array<struct<term, tf>>) of every document; a null text has no terms.  The texts are shuffled, by
    document, and not their terms: both counts below find their rows together."""
    together = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).repartition("doc")
    t = together.select("doc", F.explode_outer(tokens("_text")).alias("term"))
    counted = t.groupBy("doc", "term").agg(F.count("term").cast("int").alias("tf"))
    return counted.groupBy("doc").agg(F.sum("tf").cast("long").alias("length"),
                                      F.collect_list(F.when(F.col("term").isNotNull(), F.struct("term", "tf"))).alias("terms"))


def _replaced(spark: SparkSession, path: str, new: DataFrame, before: int) -> DataFrame | None:
    """The documents of ``new`` as micro-batches below ``before`` left them; None if there are no such micro-batches.  Rows outside
    the range of the new ids are dropped where they are read."""
    if not any(f.low < before for f in snapshots.current(spark, f"{path}/documents").live):
        return None
    low, high = new.agg(F.min("doc")).scalar(), new.agg(F.max("doc")).scalar()
    table = stored(spark, f"{path}/documents").where((F.col(BATCH) < before) & F.col("doc").between(low, high))
    return pick_per_key(table, "doc", [BATCH], "last").join(new.select("doc"), "doc", "left_semi").drop(BATCH)


def index_batch(docs: DataFrame, path: str, batch_id: int, id_col: str = "doc_id", text_col: str = "text", order_by=(),
                buckets: int = BUCKETS) -> None:
    """Index the documents of a micro-batch (the last one per id by ``order_by``); a replay replaces what it wrote.  Rows
    without an id are not indexed."""
    spark = docs.sparkSession
    rows = docs.where(F.col(id_col).isNotNull())
    if order_by:
        rows = latest_per_key(rows, id_col, list(order_by))
    append(document_terms(rows, id_col, text_col), f"{path}/documents", batch_id, arranged=True)
    new = stored(spark, f"{path}/documents").where(F.col(BATCH) == batch_id).drop(BATCH)     # read back, so texts are analysed once
    old = _replaced(spark, path, new, batch_id)
    postings = new.select("doc", "length", F.explode("terms").alias("t")).select(_bucket("t.term", buckets).alias("bucket"), "t.term", "doc", "t.tf", "length")
    size = lambda df, sign: df.agg((sign * F.count("*")).alias("documents"), (sign * F.coalesce(F.sum("length"), F.lit(0))).alias("tokens"))
    change = size(new, 1)
    if old is not None:
        names = lambda c: F.transform(c, lambda x: x["term"])
        gone = (old.select("doc", F.col("terms").alias("before")).join(new.select("doc", "terms"), "doc")
                .select("doc", F.explode(F.array_except(names(F.col("before")), names(F.col("terms")))).alias("term"))
                .select(_bucket("term", buckets).alias("bucket"), "term", "doc", F.lit(0).alias("tf"), F.lit(0).cast("long").alias("length")))
        postings = postings.unionByName(gone)
        change = change.unionByName(size(old, -1)).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    append(postings, f"{path}/postings", batch_id, "bucket")
    append(change, f"{path}/statistics", batch_id)
    tidy(spark, f"{path}/documents", "doc")
    tidy(spark, f"{path}/postings", ["bucket", "term", "doc"])
    tidy(spark, f"{path}/statistics")


def start_index(docs: DataFrame, path: str, checkpoint: str, id_col: str = "doc_id", text_col: str = "text", order_by=(),
                buckets: int = BUCKETS, available_now: bool = False, trigger: str = "5 seconds") -> StreamingQuery:
    """Keep an index up to date from a stream of documents."""
    w = docs.writeStream.queryName("index").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.foreachBatch(lambda batch, n: index_batch(batch, path, n, id_col, text_col, order_by, buckets)).start()


def exists(spark: SparkSession, path: str) -> bool:
    """Has a micro-batch been indexed there?"""
    s = snapshots.current(spark, f"{path}/statistics")
    return s is not None and s.last is not None


def postings_of(spark: SparkSession, path: str, terms: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(term, doc, tf, length) of the documents that hold the terms now."""
    last = snapshots.current(spark, f"{path}/statistics").last
    wanted = F.lit(False)
    for t in terms:
        wanted = wanted | ((F.col("bucket") == _bucket(F.lit(t), buckets)) & (F.col("term") == t))
    rows = stored(spark, f"{path}/postings").where(wanted & (F.col(BATCH) <= last))
    return pick_per_key(rows.drop("bucket"), ["term", "doc"], [BATCH], "last").where("tf > 0").drop(BATCH)


def statistics(spark: SparkSession, path: str) -> DataFrame:
    """One row: documents, tokens."""
    return stored(spark, f"{path}/statistics").agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))


def matching(spark: SparkSession, path: str, text: str, operator: str = "or", buckets: int = BUCKETS) -> DataFrame:
    """(doc) of the documents that hold any (``and``: every) token of the analysed ``text``."""
    q = sorted(set(analyse(text)))
    hits = postings_of(spark, path, q, buckets).groupBy("doc").agg(F.count("*").alias("n"))
    return hits.where(F.col("n") >= (len(q) if operator == "and" else 1)).select("doc")


def ranked(spark: SparkSession, path: str, query: str, k1: float = 1.2, b: float = 0.75, top_k: int | None = None,
           buckets: int = BUCKETS) -> DataFrame:
    """(doc, score): BM25 of every document that holds a token of the query, with the statistics of the whole index.

    idf = ln(1 + (N - df + 0.5) / (df + 0.5)); tf part: tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / average))."""
    q = sorted(set(analyse(query)))
    found = postings_of(spark, path, q, buckets)
    df = one_row(found.agg(F.count("*").alias("all"), *[F.count(F.when(F.col("term") == t, 1)).alias(f"df{i}") for i, t in enumerate(q)]))
    rows = found.withColumn("_s", one_row(statistics(spark, path))).withColumn("_d", df)
    count = F.lit(0)
    for i, t in enumerate(q):
        count = F.when(F.col("term") == t, F.col("_d")[f"df{i}"]).otherwise(count)
    s = F.col("_s")
    idf = F.log(F.lit(1.0) + (s["documents"] - count + 0.5) / (count + 0.5))
    norm = k1 * (1 - b + b * F.col("length") / (s["tokens"] / s["documents"]))
    scored = rows.select("doc", (idf * F.col("tf") * (k1 + 1) / (F.col("tf") + norm)).alias("part")).groupBy("doc").agg(F.sum("part").alias("score"))
    return scored.orderBy(F.desc("score"), F.asc("doc")).limit(top_k) if top_k else scored
