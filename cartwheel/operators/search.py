"""Search over a document DataFrame: bool filters, term/match clauses,
terms+max bucket aggregation, total hits, paging and BM25 ranking."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import analyse, match, term, tokens
from ..session import checkpoint_root
from .joins import one_row


@dataclass
class TermsAgg:
    field: str
    size: int = 10
    max_field: str | None = None


@dataclass
class SearchResult:
    total: DataFrame      # one row: total
    hits: DataFrame       # the requested page, in order
    buckets: DataFrame | None
    matched: DataFrame    # all hits (for further facets)


def bool_query(df: DataFrame, filter_terms: dict | None = None, must_terms: dict | None = None,
               must_match: dict | None = None, match_operator: str = "or") -> DataFrame:
    """Conjunction of clauses: exact field filters (non-scoring), required
    tokens (term on analysed text) and analysed matches."""
    cond = F.lit(True)
    for f, v in (filter_terms or {}).items():
        cond = cond & (F.col(f) == F.lit(v))
    for f, v in (must_terms or {}).items():
        cond = cond & term(f, v)
    for f, v in (must_match or {}).items():
        cond = cond & match(f, v, match_operator)
    return df.where(cond)


def terms_aggregation(df: DataFrame, agg: TermsAgg) -> DataFrame:
    """Top ``size`` buckets by doc count (ties by key) with an optional max
    sub-metric.  Partial aggregation bounds the shuffle to one row per key
    per task; only the bucket rows are ordered."""
    metrics = [F.count(F.lit(1)).alias("doc_count")]
    if agg.max_field:
        metrics.append(F.max(agg.max_field).cast("double").alias(f"max_{agg.max_field}"))
    g = df.groupBy(F.col(agg.field).alias("key")).agg(*metrics)
    return g.orderBy(F.desc("doc_count"), F.asc("key")).limit(agg.size)


def page(df: DataFrame, order_cols, offset: int = 0, size: int = 10) -> DataFrame:
    """``from``/``size`` page over a total order (add a unique tie-break)."""
    return df.orderBy(*order_cols).offset(offset).limit(size)


def search(df: DataFrame, id_col: str, filter_terms=None, must_terms=None, must_match=None,
           match_operator: str = "or", aggs: TermsAgg | None = None, offset: int = 0,
           size: int = 10, order_cols=None, persist: bool = False) -> SearchResult:
    """One filtered DataFrame feeds total, page and buckets; aggregations are
    over all hits, never just the page."""
    matched = bool_query(df, filter_terms, must_terms, must_match, match_operator)
    if persist:
        matched = matched.persist(StorageLevel.MEMORY_AND_DISK)
    total = matched.agg(F.count(F.lit(1)).alias("total"))
    hits = page(matched, order_cols or [F.asc(id_col)], offset, size)
    buckets = terms_aggregation(matched, aggs) if aggs else None
    return SearchResult(total, hits, buckets, matched)


def bm25(docs: DataFrame, id_col: str, text_col: str, query: str, k1: float = 1.2,
         b: float = 0.75, top_k: int | None = None) -> DataFrame:
    """BM25 score of every document matching any query token.

    idf = ln(1 + (N - df + 0.5) / (df + 0.5)); tf part
    tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl)).

    Whole texts are tokenised once into (doc, length, tf of each query
    token); tf = ``size(tokens) - size(array_remove(tokens, term))`` (native
    expressions, no explode of token lists).  That narrow projection is
    materialised once (reliable checkpoint) and read by both consumers: the
    one-row corpus statistics (N, avgdl, df per query token, a scalar
    subquery) and the per-document scoring, which is plain column
    arithmetic -- no join pairs any rows.
    """
    q = sorted(set(analyse(query)))
    if not q:
        return docs.sparkSession.createDataFrame([], f"{id_col} long, score double")
    # the one-element explode is a projection barrier: the token list is computed
    # once per document instead of being inlined into every expression using it
    toks = docs.select(F.col(id_col), F.explode(F.array(tokens(text_col))).alias("_t"))
    tf_cols = [(F.size("_t") - F.size(F.array_remove("_t", t))).alias(f"_tf{i}") for i, t in enumerate(q)]
    # narrow (doc, length, tf per query token) rows, materialised once under
    # spark.checkpoint.dir: statistics and scoring both read them, texts are
    # tokenised a single time
    checkpoint_root(docs.sparkSession)
    per_doc = toks.select(id_col, F.size("_t").alias("dl"), *tf_cols).checkpoint(eager=True)
    stats = per_doc.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avgdl"),
                        *[F.count(F.when(F.col(f"_tf{i}") > 0, 1)).alias(f"_df{i}") for i in range(len(q))])
    # statistics: one scalar subquery, referenced once as a column (no join)
    st = F.col("_st")
    hit = F.lit(False)
    score = F.lit(0.0)
    norm = k1 * (1 - b + b * F.col("dl") / st["avgdl"])
    for i in range(len(q)):
        tf, dfq = F.col(f"_tf{i}"), st[f"_df{i}"]
        idf = F.log(F.lit(1.0) + (st["n_docs"] - dfq + 0.5) / (dfq + 0.5))
        score = score + F.when(tf > 0, idf * tf * (k1 + 1) / (tf + norm)).otherwise(F.lit(0.0))
        hit = hit | (tf > 0)
    scored = (per_doc.where(hit).withColumn("_st", one_row(stats))
                     .select(id_col, score.alias("score")))
    if top_k:
        scored = scored.orderBy(F.desc("score"), F.asc(id_col)).limit(top_k)
    return scored
