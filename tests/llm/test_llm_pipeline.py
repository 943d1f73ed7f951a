"""The corpus pipeline, stage by stage against brute force, and the registered queries."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402
import corpus_pipeline as pipeline  # noqa: E402
from cartwheel.llm import registry  # noqa: E402
from oracle_check import compare, duck  # noqa: E402
from test_llm_operators import check_packing, odd_rows  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def as_rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def brute_run(rows):
    """From (doc_id, text) after language ID on: (rows after each stage)."""
    lines = [(d, v[0]) for d, v in brute.line_dedup(rows).items()]
    groups = brute.groups({d: brute.fingerprint(t) for d, t in lines})
    near = [(d, t) for d, t in lines if groups[d] == d]
    return lines, near


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(pipeline.STAGES)
    kept = stages["language"](spark, docs, SF)
    kept.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/stage1")
    kept = spark.read.parquet(path)
    assert as_rows(kept.orderBy("doc_id")) == as_rows(docs.orderBy("doc_id"))      # every text has letters here
    lines, near = brute_run(as_rows(kept))
    got = stages["lines"](spark, kept, SF)
    assert got.columns == list(pipeline.COLUMNS) and sorted(as_rows(got)) == sorted(lines)
    assert all(r.n_chars == len(r.text) for r in got.collect())
    got = stages["near_duplicates"](spark, got, SF)
    assert got.columns == list(pipeline.COLUMNS) and sorted(as_rows(got)) == sorted(near)
    got = stages["substrings"](spark, got, SF)
    cut = brute.substring_dedup(near, 100)
    after = got.collect()
    assert got.columns == list(pipeline.COLUMNS) and {r.doc_id for r in after} == set(cut)
    for r in after:
        assert 0 <= len(r.text.encode()) - (cut[r.doc_id][0] - cut[r.doc_id][1]) <= 6 * cut[r.doc_id][2]     # whole characters only
    packed = stages["pack"](spark, got, SF).collect()
    check_packing([(r.doc_id, r.text) for r in after], packed, 2048)
    assert {r.doc_id for r in pipeline.run(spark, SF).collect()} == {r.doc_id for r in packed}


def test_stages_take_odd_rows(spark):
    rows = [(d, t, ["en", "fr", None][i % 3], None, None) for i, (d, t) in enumerate(odd_rows())]
    rows += rows[:3] + [(None, "another text without id", "en", None, None), (900, "1234 !!", "en", "s", 7)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/odd-{name}")
        docs = spark.read.parquet(path)
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "language":
            assert 900 not in ids and 203 not in ids and 204 not in ids and 0 in ids
        assert None in ids


def test_stages_take_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        docs = out if name != "pack" else docs


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duck(SF)
    ok, n, _, _, msg = compare(spark, name, registry.queries()[name], registry.oracle_sql()[name], SF, con)
    assert ok and n, msg


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_runs_over_its_table(spark, name):
    out = registry.queries()[name](spark, SF)
    rows = out.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}


def test_suffix_query_equals_brute_force(spark):
    rows = as_rows(spark.read.parquet(f"{SF}/documents.parquet"))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in registry.op10_suffix_dedup(spark, SF).collect()}
    assert got == brute.substring_dedup(rows, 100)


def test_simhash_query_equals_brute_force(spark):
    rows = as_rows(spark.read.parquet(f"{SF}/documents.parquet"))
    prints = {d: brute.fingerprint(t) for d, t in rows}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in registry.op8_simhash(spark, SF).collect()}
    groups = brute.groups(prints)
    assert got == {d: (f"{f:016x}", groups[d]) for d, f in prints.items()}
