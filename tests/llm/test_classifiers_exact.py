"""Quality resampling and language ID against plain versions."""

import math
import os
import random
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from cartwheel.llm import language_id, quality  # noqa: E402
from cartwheel.llm.suffix import _BASE, _WORDS  # noqa: E402
from test_llm_operators import documents  # noqa: E402

M = (1 << 64) - 1


def spread(h):
    h ^= h >> 29
    h = h * 0xBF58476D1CE4E5B9 & M
    return h ^ h >> 32


def plain_buckets(text):
    words = [spread(sum(int(_WORDS[b]) * pow(_BASE, i, 1 << 64) for i, b in enumerate(w)) & M) for w in text.encode().lower().split()]
    pairs = [spread((a * 0x9E3779B97F4A7C15 & M) ^ b) for a, b in zip(words, words[1:])]
    return [x >> 48 for x in words + pairs]


@pytest.mark.parametrize("temperature,fraction", [(1.0, 0.5), (7.0, 0.3)])
def test_resampling_equals_plain_version(spark, temperature, fraction):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(words[:30] if i % 3 else words) for _ in range(rng.randint(0, 40)))) for i in range(120)] + [(200, None), (201, "")]
    good = {i for i in range(0, 120, 4)}
    labels = spark.createDataFrame([(i, int(i in good)) for i in range(0, 120, 2)] + [(None, 1)], "doc_id long, quality int")
    docs = documents(spark, rows)
    got = {r.doc_id: r for r in quality.resample(docs, labels, fraction, temperature).collect()}
    bags = {d: Counter(plain_buckets(t or "")) for d, t in rows}
    raw, target = Counter(), Counter()
    for d, bag in bags.items():
        raw.update(bag)
        if d in good:
            target.update(bag)
    n = quality.BUCKETS
    log_p = lambda c, b: math.log((c[b] + 1) / (sum(c.values()) + n))
    ratio = {d: sum(k * (log_p(target, b) - log_p(raw, b)) for b, k in bag.items()) for d, bag in bags.items()}
    salt = {r.doc_id: r.s for r in docs.select("doc_id", F.xxhash64(F.lit("gumbel"), "doc_id", F.coalesce("text", F.lit(""))).alias("s")).collect()}
    key = {d: ratio[d] / temperature - math.log(-math.log((((salt[d] & M) >> 11) + 0.5) / (1 << 53))) for d in bags}
    for d, r in got.items():
        assert r.log_ratio == pytest.approx(ratio[d], abs=1e-8) and r.gumbel_key == pytest.approx(key[d], abs=1e-8)
        assert r.n_features == sum(bags[d].values())
    chosen = sorted(key, key=lambda d: (-key[d], d))[:int(len(rows) * fraction)]
    assert {d for d, r in got.items() if r.selected} == set(chosen)


def test_resampling_ties_go_to_the_smaller_id_of_any_size(spark):
    ids = [-(1 << 63), -5, 0, 7, (1 << 62) + 3, (1 << 63) - 1, None]
    rows = spark.createDataFrame([(k, 1.0) for k in ids], "doc_id long, x double")
    place = F.coalesce(F.bitwise_not("doc_id"), F.lit((1 << 63) - 1)).alias("key")
    ordered = sorted([~i if i is not None else (1 << 63) - 1 for i in ids], reverse=True)
    assert [quality.kth_largest(rows.select(place), k) for k in range(1, 8)] == ordered
    assert quality.kth_largest(rows.select(place), 8) is None


def plain_set(text):
    data = text.lower().encode()
    return {((int.from_bytes(data[i:i + n], "big") + n * 0x51ED27) * 0x9E3779B1 & 0xFFFFFFFF) >> 16
            for n in language_id.NGRAMS for i in range(len(data) - n + 1)}


def test_kernel_landmarks_and_ridge_equal_plain_versions():
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdeéß 你") for _ in range(rng.randint(1, 80))) for _ in range(40)]
    table = np.zeros(language_id.BITS, bool)
    sets = [language_id.present(language_id.lowered(t), table) for t in texts]
    assert [set(s.tolist()) for s in sets] == [plain_set(t) for t in texts]
    model = language_id.Model(sets[:12])
    k = language_id.kernel(sets, model.table.astype(np.float32), model.sizes)
    plain = np.array([[len(plain_set(a) & plain_set(b)) / math.sqrt(len(plain_set(a)) * len(plain_set(b))) for b in texts[:12]] for a in texts])
    assert np.allclose(k, plain, atol=1e-5) and np.allclose(np.diag(plain[:12]), 1)
    # Nystroem: the features' inner products give the kernel among the landmarks back
    x = k @ model.whiten
    assert np.allclose(x[:12] @ x[:12].T, plain[:12], atol=1e-3)
    # one-versus-rest ridge regression, intercept not penalised: least squares with the penalty as further rows
    labels = [rng.choice(["xx", "yy", "zz"]) for _ in texts]
    model.fit(k, labels, 0.1)
    a = np.hstack([x, np.ones((len(texts), 1))]).astype(float)
    penalty = np.sqrt(0.1) * np.eye(a.shape[1])[:-1]
    y = np.array([[lab == c for c in ("xx", "yy", "zz")] for lab in labels], float)
    w = np.linalg.lstsq(np.vstack([a, penalty]), np.vstack([y, np.zeros((len(penalty), 3))]), rcond=None)[0]
    assert model.classes == ["xx", "yy", "zz"] and np.allclose(model.weights, w, atol=1e-3)
    assert np.allclose(model.scores(k), a @ w, atol=1e-3)


def test_predictions_equal_the_model_applied_text_by_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.fit(language_id.training_rows(docs), landmarks=16, fit_rows=60)
    table = np.zeros(language_id.BITS, bool)
    for r in language_id.identify(docs, model, ("doc_id",), with_text=True).collect():
        one = model.scores(language_id.kernel([language_id.present(language_id.lowered(r.text), table)], model.table.astype(np.float32), model.sizes))[0]
        assert r.lang_pred == model.classes[int(one.argmax())] and r.score == pytest.approx(min(1, max(0, one.max())), abs=1e-4)


def test_written_tables_expire(spark):
    from cartwheel.llm.common import expire_written, written
    df = written(spark.range(3), "expire")
    assert expire_written(spark, 3600) == 0 and df.count() == 3
    assert expire_written(spark, -10) >= 1 and expire_written(spark, -10) == 0        # those of other tests go too
