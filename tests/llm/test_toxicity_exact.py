"""The toxicity model's tables against exact counts in Python."""

import math
import os
import random
import re
import sys
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from cartwheel.llm import toxicity  # noqa: E402

TOP, D = toxicity.TOP, toxicity.DISCOUNT


def bytes_of(word):
    return b"\1" * (TOP - 1) + word.encode() + b"\2"


def brute_ratio(texts):
    """{toxic: texts} -> f(word): the sum over the word's bytes, from dictionaries of exact n-grams."""
    n = [Counter(), Counter(), Counter()]
    for toxic, mine in texts.items():
        for w in re.findall(r"[^\W\d_]+", " ".join(mine).lower()):
            b = bytes_of(w)
            n[toxic].update(b[i + 1 - o:i + 1] for i in range(TOP - 1, len(b)) for o in range(1, TOP + 1))
    n[2].update(g[1:] for g in {*n[0], *n[1]} if len(g) > 1)
    total, types = [defaultdict(int) for _ in n], [defaultdict(int) for _ in n]
    for c, table in enumerate(n):
        for g, x in table.items():
            total[c][len(g), g[:-1]] += x
            types[c][len(g), g[:-1]] += 1

    def ratio(word):
        b, out = bytes_of(word), 0.0
        for i in range(TOP - 1, len(b)):
            lower, now = 1 / 256, 0.0
            for o in range(1, TOP + 1):
                g = b[i + 1 - o:i + 1]
                at = (o, g[:-1])
                if not total[0][at] + total[1][at]:
                    break
                more = (toxicity.STRENGTH, toxicity.STRENGTH, 0)
                p = [(max(n[c][g] - D, 0) + (D * types[c][at] + more[c]) * lower) / (total[c][at] + more[c]) if total[c][at] + more[c] else lower
                     for c in range(3)]
                now, lower = math.log(p[1] / p[0]), p[2]
            out += now
        return out

    return ratio


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("cache", [None, 0, 60])
def test_evidence_comes_from_exact_counts_in_the_cache_and_beyond(spark, cache):
    texts = {0: corpus(1, 60), 1: corpus(2, 25)}
    rows = spark.createDataFrame([(t, c) for c in texts for t in texts[c]], "text string, part int").repartition(3)
    table = toxicity.counts(toxicity.counted(rows).withColumnRenamed("part", "toxic"))
    asked = [*corpus(1, 30), *corpus(3, 20), "", "12 !", "zzzz ßé"]
    docs = spark.createDataFrame(list(enumerate(asked)), "id long, text string").repartition(3)
    said = toxicity.looked_up(toxicity.distinct_grams(docs), table)
    ratio = brute_ratio(texts)
    for margin in (-50.0, 0.3):
        got = {r.id: r.e for r in toxicity.evidence(docs, said, cache, margin).collect()}
        for i, text in enumerate(asked):
            words = re.findall(r"[^\W\d_]+", text.lower())
            assert got[i] == pytest.approx(sum(max(0, ratio(w) - margin) for w in words) / math.sqrt(max(1, len(words))), abs=1e-9)
        assert any(got.values())


def test_no_ngrams_share_a_count(spark):
    """Every different n-gram has a row of its own."""
    letters = [chr(c) for c in range(0x4e00, 0x4e00 + 6000)]
    rows = spark.createDataFrame([(" ".join(letters), 0)], "text string, part int")
    table = toxicity.counts(toxicity.counted(rows).withColumnRenamed("part", "toxic"))
    grams = {bytes_of(x)[i + 1 - o:i + 1] for x in letters for i in range(TOP - 1, len(bytes_of(x))) for o in range(1, TOP + 1)}
    assert table.filter(F.shiftright("key", 48) < 8).count() == len(grams)


def test_fold_1_counts_in_the_final_model(spark):
    """The scores' table holds the n-grams of all training rows: those of fold 1 too, the held-out ones never."""
    import zlib
    folds = {i: zlib.crc32(str(i).encode()) % 5 for i in range(200)}
    rows = [(i, f"{'rotten' if i % 2 else 'lovely'} fold{'abcde'[folds[i]]}") for i in folds]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"),
                         spark.createDataFrame([(i, i % 2) for i in folds], "doc_id long, toxic int"))
    of = lambda f: int.from_bytes(f"fold{'abcde'[f]}".encode()[-TOP:], "big")
    key = {f: (TOP - 1 << 48) + (of(f) & ((1 << 8 * (TOP - 1)) - 1)) for f in range(5)}
    got = {r.key: (r.n0, r.n1) for r in model.table.filter(F.col("key").isin(list(key.values()))).collect()}
    assert got == {key[f]: tuple(sum(folds[i] == f and i % 2 == c for i in folds) for c in (0, 1)) for f in range(1, 5)}


def test_a_word_seen_16_times_speaks_for_toxicity():
    """No context is cut off a word that only toxic texts have, 16 times."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdeghiklmnorstuw") for _ in range(6)) for _ in range(400)]
    ordinary = lambda: " ".join(rng.choice(words) for _ in range(40))
    ratio = brute_ratio({0: [ordinary() for _ in range(150)], 1: [ordinary() + (" clown" if i < 16 else "") for i in range(100)]})
    assert ratio("clown") > toxicity.MARGIN


def test_the_curve_never_falls():
    import numpy as np
    rng = np.random.default_rng(1)
    e = rng.normal(size=90)
    for toxic in ((e < -1).astype(float), (e > 1).astype(float), rng.integers(0, 2, 90).astype(float)):
        slope, offset = toxicity.curve(e, toxic, np.ones(90))
        assert slope > 0
        assert toxicity.logistic(slope * e + offset).mean() == pytest.approx(toxic.mean(), abs=0.02)


@pytest.mark.parametrize("sf,least", [("sf0.01", 0.9), ("sf0.1", 0.93)])
def test_held_out_scores_rank_toxic_texts_first(spark, sf, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.predict_toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out AND toxic IS NOT NULL").collect()
    bad, good = ([r.score for r in rows if r.toxic == t] for t in (1, 0))
    auc = sum((b > g) + (b == g) / 2 for b in bad for g in good) / len(bad) / len(good)
    hits, alarms = sum(r.predicted and r.toxic for r in rows), sum(r.predicted and not r.toxic for r in rows)
    print(sf, "auc", auc, "found", hits, "of", len(bad), "false alarms", alarms, "of", len(good))
    assert auc > least and alarms <= max(2, 0.01 * len(good))
    assert hits >= (0.55 * len(bad) if sf == "sf0.1" else 1)
