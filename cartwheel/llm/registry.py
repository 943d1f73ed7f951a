"""The operators as registered queries over their whole tables, and DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (alignment, bpe, fim, fingerprints, language_id, line_dedup, packing, quality, simhash, substring_dedup, toxicity,
               vectors)
from .common import read


def tokenizer_path(name: str) -> str:
    """A file of the installed public tokenizers."""
    import public_tokenizers
    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), capacity=2048, end_id=1)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(read(spark, sf_dir, "embeddings"), k=10, every=100)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), split_pattern())


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), fraction=0.5)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(read(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.exact_top_k(read(spark, sf_dir, "embeddings"), k=10, every=100)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(read(spark, sf_dir, "documents"), length=100)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(read(spark, sf_dir, "documents"), seed=7, rate=100, spm_rate=50)


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_edited(read(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_line_dedup, op2_packing, op3_toxicity, op4_nearest, op5_bpe, op6_quality, op7_language,
                                    op8_simhash, op9_top_k, op10_suffix_dedup, op11_fill_in_middle, op12_fingerprints, op13_alignment)}


_LINES = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents),
filled AS (
  SELECT doc_id, line, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p
  FROM lines WHERE trim(translate(line, chr(9) || chr(13), '  ')) <> ''),
dead AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY line ORDER BY doc_id, p) AS r FROM filled) WHERE r > 1),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text
  FROM lines l LEFT JOIN filled f ON f.doc_id = l.doc_id AND f.i = l.i
  LEFT JOIN dead d ON d.doc_id = f.doc_id AND d.p = f.p
  WHERE d.p IS NULL GROUP BY l.doc_id),
removed AS (
  SELECT d.doc_id, count(*) AS n, count(*) FILTER (WHERE b.p IS NULL) AS runs
  FROM dead d LEFT JOIN dead b ON b.doc_id = d.doc_id AND b.p = d.p - 1 GROUP BY d.doc_id)
SELECT o.doc_id, CASE WHEN o.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(c.n, 0)::BIGINT AS n_lines, coalesce(r.n, 0)::BIGINT AS n_removed, coalesce(r.runs, 0)::BIGINT AS n_runs
FROM documents o LEFT JOIN kept k ON k.doc_id = o.doc_id
LEFT JOIN (SELECT doc_id, count(*) AS n FROM filled GROUP BY doc_id) c ON c.doc_id = o.doc_id
LEFT JOIN removed r ON r.doc_id = o.doc_id
"""

_SEARCH = """
WITH v AS (
  SELECT vec_id, {vector} AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 {also}),
hits AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, {score} AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v))
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score {order}, vec_id) AS rank FROM hits)
WHERE rank <= 10
"""

_FIM = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT *, length(t) - length(replace(t, chr(10), '')) + CASE WHEN t = '' OR right(t, 1) = chr(10) THEN 0 ELSE 1 END AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR h3 % 100 >= 100 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
         string_split(t, chr(10)) AS l FROM u),
p AS (
  SELECT *, CASE WHEN a = 0 THEN '' WHEN a = n THEN t ELSE array_to_string(l[1:a], chr(10)) || chr(10) END AS x,
         CASE WHEN b = 0 THEN '' WHEN b = n THEN t ELSE array_to_string(l[1:b], chr(10)) || chr(10) END AS y FROM c),
q AS (
  SELECT *, substr(y, length(x) + 1) AS middle, substr(t, length(y) + 1) AS suffix FROM p)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(x)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || x || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM q
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": _LINES,
        "op4_nearest": _SEARCH.format(vector="embedding::DOUBLE[]", score="list_distance(q.v, c.v)", order="",
                                      also="AND len(list_filter(embedding, lambda x: x <> 0)) > 0"),
        "op9_top_k": _SEARCH.format(vector="list_transform(embedding::DOUBLE[], lambda x: floor(1024 * x))",
                                    score="list_inner_product(q.v, c.v)::BIGINT", order="DESC", also=""),
        "op11_fill_in_middle": _FIM,
    }
