"""A corpus from raw documents to packed sequences.

Stages, each on all that its predecessor kept:

1. ``language``: language ID; documents without a language (null texts, texts without a letter) go.
2. ``lines``: line dedup; lines that stand earlier go from the texts, alone or in runs.
3. ``near_duplicates``: SimHash groups; the document with the smallest id of each group stays.
4. ``substrings``: suffix-array dedup; repeated strings of 100 bytes and more go from the texts.  Characters of which
   only a part repeats stay whole.
5. ``pack``: the texts as sequences of 2048 tokens; one row per piece.

All but the last return the columns of ``documents``; ``n_chars`` follows the text.  Documents are never dropped for
being short, or for having become empty.  Rows that share a doc_id, or have none, are documents of their own in every stage.  Every
stage is written as Parquet below ``spark.checkpoint.dir`` and read again, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import language_id, line_dedup, packing, simhash, substring_dedup
from cartwheel.llm.common import read, row_keyed, written
from cartwheel.llm.registry import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
OTHERS = ("lang", "source", "n_chars")


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of documents, n_chars as the text now has them."""
    return rows.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(language_id.training_rows(docs))
    named = language_id.identify(docs, model, ("doc_id", *OTHERS), with_text=True)
    # without labelled rows there is no model and nothing to reject by
    return (named.filter("lang_pred <> 'und'") if model.classes else docs).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(line_dedup.dedup_lines(docs, keep_columns=OTHERS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = row_keyed(docs.select(*COLUMNS))
    first = simhash.near_duplicates(docs, shingle=3, max_bits=2).filter(
        F.coalesce("component_id", F.lit(simhash.NULL_ID)) == F.col("doc_id"))
    return (docs.join(first.select("doc_id").hint("shuffle_merge"), "doc_id", "left_semi")
            .select(F.col("__id").alias("doc_id"), *COLUMNS[1:]))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(substring_dedup.dedup_substrings(docs, length=100, with_text=True, keep_columns=OTHERS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), capacity=2048, end_id=1)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("substrings", substrings), ("pack", pack)]

# tokens, fingerprints and byte strings are beyond SQL; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = written(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return rows
