"""Inverted index and skew-safe full outer join against plain versions."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cartwheel.functions.text import analyse
from cartwheel.operators import index
from cartwheel.operators.joins import full_outer_skew_safe
from cartwheel.operators.upsert import stored
from test_plans import plan


def plain_bm25(docs, query, k1=1.2, b=0.75):
    terms = {d: Counter(analyse(t or "")) for d, t in docs.items()}
    average = sum(sum(c.values()) for c in terms.values()) / len(terms)
    out = Counter()
    for t in set(analyse(query)):
        df = sum(t in c for c in terms.values())
        for d, c in terms.items():
            if t in c:
                idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                out[d] += idf * c[t] * (k1 + 1) / (c[t] + k1 * (1 - b + b * sum(c.values()) / average))
    return dict(out)


def test_index_follows_changes_and_replays(spark, tmpdir_spark):
    rng, path = random.Random(4), f"{tmpdir_spark}/index"
    words = ["que", "la", "Ring", "天", "x1"] + [f"w{i}" for i in range(40)]
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))
    now = {}
    for batch in range(4):
        rows = [(rng.randrange(60), rng.choice([text(), text(), None, ""])) for _ in range(40)]
        rows = list(dict(rows).items())
        df = spark.createDataFrame([*rows, (None, "que")], "doc_id long, text string")
        index.index_batch(df, path, batch, buckets=5)
        if batch in (1, 3):
            index.index_batch(df, path, batch, buckets=5)          # the same micro-batch again
        now.update(rows)
        for query in ("que la", "ring", "天 nothing", "absent"):
            want = plain_bm25(now, query)
            got = {r.doc: r.score for r in index.ranked(spark, path, query, buckets=5).collect()}
            assert got.keys() == want.keys() and all(got[d] == pytest.approx(want[d]) for d in want)
        for operator, every in (("or", any), ("and", all)):
            hits = {d for d, t in now.items() if every(w in analyse(t or "") for w in ("que", "la"))}
            assert {r.doc for r in index.matching(spark, path, "la que", operator, 5).collect()} == hits
    top = index.ranked(spark, path, "que la", top_k=3, buckets=5).collect()
    assert [r.doc for r in top] == [d for d, _ in sorted(plain_bm25(now, "que la").items(), key=lambda x: (-x[1], x[0]))[:3]]


def test_a_query_reads_the_postings_of_its_terms(spark, tmpdir_spark):
    path = f"{tmpdir_spark}/index"
    index.index_batch(spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("que w"), F.col("id")).alias("text")), path, 0,
                      buckets=8)      # so few that files are listed without a job
    before = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
    df = index.ranked(spark, path, "que w7", buckets=8)
    assert spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs() == before            # nothing ran yet
    scan = [line for line in plan(df).splitlines() if "PartitionFilters" in line or "PushedFilters" in line]
    assert any("bucket" in line for line in scan) and any("EqualTo(term,que)" in line for line in scan)
    assert index.postings_of(spark, path, ["que", "w7"], 8).count() == 201
    read = stored(spark, f"{path}/postings").where(F.col("bucket") == index._bucket(F.lit("w7"), 8))
    assert 0 < read.count() < 100


def test_indexing_shuffles_texts_not_their_terms(spark, tmpdir_spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("que la que").alias("text"))
    p = plan(index.document_terms(docs, "doc_id", "text"))
    assert p.split("Initial Plan")[-1].count("Exchange") == 2       # the exchange in the tree and in the list of nodes
    path = f"{tmpdir_spark}/index"
    index.index_batch(docs, path, 0, buckets=2)
    new = stored(spark, f"{path}/documents")
    assert index._replaced(spark, path, new, 0) is None
    again = docs.where("doc_id >= 45").withColumn("text", F.lit("la"))
    old = index._replaced(spark, path, again.select(F.col("doc_id").alias("doc")), 1)
    assert sorted(r.doc for r in old.collect()) == [45, 46, 47, 48, 49]
    index.index_batch(again, path, 1, buckets=2)
    assert index.postings_of(spark, path, ["que"], 2).count() == 45
    assert index.statistics(spark, path).first()[:] == (50, 140)


@pytest.mark.parametrize("fraction", [1.0, 0.2, 0.0001])
def test_full_outer_equals_plain_join(spark, fraction):
    rng = random.Random(5)
    key = lambda hot: rng.choice([hot, hot, "both", None, str(rng.randrange(40)), str(rng.randrange(400))])
    left = spark.createDataFrame([(key("l"), i) for i in range(900)], "lk string, lv long").repartition(5)
    right = spark.createDataFrame([(key("r"), i) for i in range(500)], "rk string, rv long").repartition(3)
    got = full_outer_skew_safe(left, right, "lk", "rk", fraction=fraction, salts=4)
    want = left.join(right, left["lk"] == right["rk"], "full_outer")
    assert got.columns == want.columns and Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    empty = right.where("false")
    assert full_outer_skew_safe(left, empty, "lk", "rk", fraction=fraction).count() == 900
    assert full_outer_skew_safe(empty.toDF("lk", "lv"), right, "lk", "rk", fraction=fraction).count() == 500


def test_no_task_of_the_full_outer_join_holds_a_third(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled",
                                          "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(old, ("24", "false", "-1")):
            spark.conf.set(k, v)
        hot = F.when(F.col("id") % 2 == 0, F.lit(-1)).when(F.col("id") % 3 == 0, F.lit(-2)).otherwise(F.col("id"))
        left = spark.range(60_000).select(hot.alias("lk"), F.col("id").alias("lv"))          # half of the rows have one key
        right = spark.range(-1, 20_000).select(F.col("id").alias("rk"), F.col("id").alias("rv"))
        share = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()) / df.count()
        plain = left.join(right, left["lk"] == right["rk"], "full_outer")
        mine = full_outer_skew_safe(left, right, "lk", "rk", fraction=0.1)
        assert share(plain) > 1 / 3 > 0.2 > share(mine)
        assert mine.count() == plain.count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
