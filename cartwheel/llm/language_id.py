"""Language identification with a string kernel.

* Kernel: two texts are alike by the n-grams (blended spectrum: ``NGRAMS`` bytes of the lower-cased UTF-8) that are
  present in both, over the geometric mean of how many each has.  An n-gram's presence is a bit of a table of ``BITS`` bits.
* Nyström: ``landmarks`` labelled texts span the feature space; a text's features are its kernel values with them,
  whitened by the landmarks' own kernel matrix.
* One-versus-rest ridge regression on a bounded sample of ``fit_rows`` labelled rows (documented bound; languages
  get even shares of it).  What is collected to fit is at most ``landmarks`` bit sets and ``fit_rows`` feature rows.
* Scoring: per batch, the landmarks' rows of the present n-grams are summed, then two matrix products.

Whole texts are used.  A text that is null or has no letter is ``und`` with score 0, and so is every text if no row
has a label.  Repeated rows give repeated results; an empty table none.  lang, source and doc_id are never inputs
of a prediction; lang is read only where the fold rule allows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, slices, text_buffers

NGRAMS = (1, 2, 3, 4)
BITS = 1 << 16
_MULTIPLIER = 0x9E3779B1


def present(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sorted table places of a text's n-grams.  ``table`` is BITS cleared booleans, and is left cleared."""
    code = np.zeros(len(data), np.uint32)
    for n in range(1, max(NGRAMS) + 1):
        if len(data) < n:
            break
        # code of the n bytes from each place on: (code << 8 | byte) of the n - 1 before
        code = data.astype(np.uint32) if n == 1 else (code[:-1] << np.uint32(8)) | data[n - 1:]
        if n in NGRAMS:
            h = (code + np.uint32(n * 0x51ED27)) * np.uint32(_MULTIPLIER)
            table[h >> np.uint32(16)] = True
    at = np.flatnonzero(table)
    table[at] = False
    return at


def lowered(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-8"), np.uint8)


def kernel(sets: list[np.ndarray], landmarks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """texts x landmarks kernel values."""
    out = np.zeros((len(sets), landmarks.shape[1]), np.float32)
    for row, at in enumerate(sets):
        if len(at):
            out[row] = landmarks[at].sum(axis=0) / np.sqrt(len(at) * sizes)
    return out


class Model:
    """Landmarks, whitening and class weights; a few MB whatever the corpus is."""

    def __init__(self, landmark_sets: list[np.ndarray]):
        table = np.zeros((BITS, max(1, len(landmark_sets))), np.uint8)
        for i, at in enumerate(landmark_sets):
            table[at, i] = 1
        self.table = table
        self.sizes = np.maximum(table.sum(axis=0, dtype=np.int64), 1).astype(np.float32)
        values, vectors = np.linalg.eigh(kernel(landmark_sets, table.astype(np.float32), self.sizes).astype(np.float64)
                                         if landmark_sets else np.ones((1, 1)))
        good = values > 1e-6 * values.max()
        self.whiten = (vectors[:, good] / np.sqrt(values[good])).astype(np.float32)
        self.classes: list[str] = []
        self.weights = None

    def fit(self, kernels: np.ndarray, labels: list[str], ridge: float) -> None:
        x = np.hstack([kernels @ self.whiten, np.ones((len(labels), 1))]).astype(np.float64)
        self.classes = sorted(set(labels))
        y = np.array([[lab == c for c in self.classes] for lab in labels], np.float64)
        penalty = ridge * np.eye(x.shape[1])
        penalty[-1, -1] = 1e-9
        self.weights = np.linalg.solve(x.T @ x + penalty, x.T @ y).astype(np.float32)

    def scores(self, kernels: np.ndarray) -> np.ndarray:
        return np.hstack([kernels @ self.whiten, np.ones((len(kernels), 1), np.float32)]) @ self.weights


def kernels_of(rows: DataFrame, model: Model) -> DataFrame:
    """(lang, text) -> (lang, k): kernel values with the landmarks."""
    def task(batches):
        table, landmarks = np.zeros(BITS, bool), model.table.astype(np.float32)
        for batch in slices(batches, 1 << 22):
            sets = [present(lowered(t), table) for t in batch.column(1).to_pylist()]
            k = kernel(sets, landmarks, model.sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(k), pa.list_(pa.float32()))], names=["lang", "k"])
    return rows.select("lang", "text").mapInArrow(task, "lang string, k array<float>")


def sets_of(rows: DataFrame) -> DataFrame:
    def task(batches):
        table = np.zeros(BITS, bool)
        for batch in slices(batches, 1 << 22):
            sets = [present(lowered(t), table) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.list_(pa.int64()))], names=["at"])
    return rows.select("lang", "text").mapInArrow(task, "at array<long>")


def even_sample(rows: DataFrame, n: int) -> DataFrame:
    """At most ``n`` rows (lang, text), about as many of each language: those with the least (id hash x rows of the language)."""
    share = rows.groupBy("lang").agg(F.count("*").alias("n"))
    if share.count() <= 10_000:            # a language a row: below 1 MB
        share = F.broadcast(share)
    uniform = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    picked = rows.join(share, "lang").select("doc_id", "lang", "text", (uniform * F.col("n")).alias("place"))
    return picked.orderBy("place", "doc_id", "lang", "text").limit(n)


def fit(training: DataFrame, landmarks: int = 64, fit_rows: int = 2000, ridge: float = 0.1) -> Model:
    """training (doc_id, lang, text), without nulls."""
    # choose by the narrow columns; texts are read again for the chosen ids only
    ids = even_sample(training.select("doc_id", "lang", F.lit("").alias("text")), fit_rows).select("doc_id", "place").cache()
    chosen = training.join(F.broadcast(ids), "doc_id")           # at most fit_rows ids
    model = Model([np.array(r.at, np.int64) for r in sets_of(chosen.orderBy("place", "doc_id", "lang", "text").limit(landmarks)).collect()])
    rows = kernels_of(chosen.orderBy("place", "doc_id", "lang", "text").limit(fit_rows), model).collect()   # at most fit_rows x landmarks numbers
    ids.unpersist()
    if rows:
        model.fit(np.array([r.k for r in rows], np.float32), [r.lang for r in rows], ridge)
    return model


def identify(docs: DataFrame, model: Model, columns: tuple[str, ...] = (), text_col: str = "text", with_text: bool = False) -> DataFrame:
    """The given columns of each row (unread), lang_pred and score (``with_text``: and the text, null as empty)."""
    keep = [F.col(c).alias(f"__{i}") for i, c in enumerate(columns)]
    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *keep)
    kinds = [f.dataType.simpleString() for f in rows.schema.fields[1:]]
    schema = ", ".join([*(f"`__{i}` {k}" for i, k in enumerate(kinds)), "lang_pred string", "score double", *["`__text` string"] * with_text])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        model = shared.value
        table, landmarks = np.zeros(BITS, bool), model.table.astype(np.float32)
        for batch in slices(batches, 1 << 22):
            texts = batch.column(0).to_pylist()
            wanted = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))] if model.classes else []
            names, best = ["und"] * len(texts), np.zeros(len(texts))
            if wanted:
                scores = model.scores(kernel([present(lowered(texts[i]), table) for i in wanted], landmarks, model.sizes))
                top = scores.argmax(axis=1)
                best[wanted] = np.clip(scores[np.arange(len(top)), top], 0, 1)
                for i, c in zip(wanted, top.tolist()):
                    names[i] = model.classes[c]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(names, pa.string()), pa.array(best),
                                              *[batch.column(0)] * with_text],
                                             names=[*(f"__{i}" for i in range(len(kinds))), "lang_pred", "score", *["__text"] * with_text])

    text = [F.col("__text").alias("text")] * with_text
    return rows.mapInArrow(task, schema).select(*[F.col(f"__{i}").alias(c) for i, c in enumerate(columns)], "lang_pred", "score", *text)


def training_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, text) of the labelled documents of the training folds."""
    return (docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                    F.col("text").cast("string").alias("text")))


def predict_languages(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score."""
    model = fit(training_rows(docs), **options)
    return identify(docs, model, ("doc_id",)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
