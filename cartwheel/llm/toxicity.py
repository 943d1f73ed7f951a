"""Toxicity from two class-conditional Kneser-Ney models over the bytes of words.

A word is scored byte by byte (with marks for its start and end) under a model of toxic and one of ordinary text:
absolutely discounted counts of n-grams of up to ``TOP`` bytes.  Either class gives its discounted mass, and that of ``STRENGTH`` further
counts, to the same back-off model, whose continuation counts (after how many different bytes an n-gram was seen) pool both
classes.  So a rare expression is smoothed by what both classes share, and no context is cut off.

A word speaks for toxicity by what its log P(word | toxic) - log P(word | ordinary) has above ``MARGIN``; a text's evidence is the sum of
that over its words, divided by the square root of their number (the spread of a sum of as many chance ratios).

A logistic curve from evidence to score is fitted on one training fold under the counts of the others, on a bounded sample of
``calibrate_rows`` rows per class; its slope is never below ``LEAST_SLOPE``, so more evidence never gives a lower score.  The counts that
texts are scored with are then gathered over all labelled training rows, that fold included.

Counts of all n-grams stay exact in a Spark table that grows with the corpus; the distinct n-grams of the scored texts are joined
to it.  Of the results, the most frequent ``CACHE`` go to where texts are scored; words with other n-grams are completed by a
join.  The cut-off between the two changes no result.

Words are maximal runs of letters of the whole lower-cased text.  Null, empty and wordless texts have evidence 0.  Without
toxic or without ordinary training rows every text gets that one class's score.  Labels that share a doc_id count
as toxic if one is; null labels are no labels.  Repeated documents give repeated results; an empty table none.  Labels, lang,
source and doc_id are never inputs of a score."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, id_text, slices, written

TOP = 6
CACHE = 1 << 21                    # n-grams that go to the tasks: 16 bytes each
STRENGTH, MARGIN = 20.0, 2.0
LEAST_SLOPE = 1e-3
DISCOUNT = 0.75
BROADCAST_ROWS = 200_000           # labels are broadcast up to here (some 180 bytes each in a hash table, 35 MB), else joined by shuffle
SETTLE = 1 << 19                   # different words a task counts before it sends n-grams on
START, END = 1, 2
VALUES = ("n0", "n1", "n2", "k0", "k1", "k2")
_find = re.compile(r"[^\W\d_]+").findall


def spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of order TOP that end at each byte (and the end mark) of the words, and how many each word has."""
    raw = [w.encode("utf-8") for w in words]
    sizes = np.array([len(r) + 1 for r in raw], np.int64)
    pad, stop = bytes([START]) * (TOP - 1), bytes([END])
    data = np.frombuffer(b"".join([pad + r + stop for r in raw]), np.uint8).astype(np.int64)
    code = data.copy()
    for back in range(1, TOP):
        code[back:] |= data[:-back] << (8 * back)
    live = np.ones(len(data), bool)
    first = np.cumsum(sizes + TOP - 1) - (sizes + TOP - 1)
    for i in range(TOP - 1):
        live[first + i] = False
    return code[live], sizes


def counted(rows: DataFrame) -> DataFrame:
    """(text, part) -> (part, gram, n) at order TOP; words are counted per task, then spelled once each."""
    def task(batches):
        seen = defaultdict(Counter)

        def emit():
            for part, words in seen.items():
                if words:
                    code, sizes = spelled(list(words))
                    code, at = np.unique(code, return_inverse=True)
                    n = np.bincount(at, np.repeat(np.fromiter(words.values(), np.int64, len(words)), sizes)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), part, np.int32)), pa.array(code), pa.array(n)],
                                                     names=["part", "gram", "n"])

        for batch in slices(batches, 1 << 21):
            for text, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[part].update(_find(text.lower()))
            if sum(map(len, seen.values())) >= SETTLE:
                yield from emit()
                seen = defaultdict(Counter)
        yield from emit()

    return (rows.select("text", "part").mapInArrow(task, "part int, gram long, n long")
            .groupBy("part", "gram").agg(F.sum("n").alias("n")))


def ending(order: int):
    """The n-gram of ``order`` at the end of a longer one."""
    return F.col("gram").bitwiseAND((1 << 8 * order) - 1)


def keyed(kind: int, order, gram):
    """One number for the n-gram (kind 0) or the context of n-grams (kind 1) of an order."""
    return (F.lit(kind * 8) + order).cast("long") * F.lit(1 << 48) + gram


def short(kind: int, order: int) -> bool:
    """Two bytes at most, so there are 131,329 of them at most."""
    return order - kind <= 2


def counts(grams: DataFrame) -> DataFrame:
    """(toxic, gram, n) -> (key, n0, n1, n2, k0, k1, k2): of an n-gram its count in either class and, below the top, after how many
    different bytes it was seen in either; of a context the sums of these, and how many different successors they have."""
    top = grams.groupBy("gram").agg(*[F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)])
    every = F.explode(F.array(*[F.struct(F.lit(o).alias("order"), ending(o).alias("gram")) for o in range(1, TOP + 1)])).alias("g")
    raw = written(top.select("n0", "n1", every).groupBy("g.order", "g.gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "levels")
    shorter = F.coalesce(*[F.when(F.col("order") == o + 1, ending(o)) for o in range(1, TOP)]).alias("gram")
    both = raw.filter("order > 1").groupBy((F.col("order") - 1).alias("order"), shorter).agg(F.count("*").alias("n2"))
    none = F.lit(0).cast("long")
    rows = raw.withColumn("n2", none).unionByName(both.select("order", "gram", none.alias("n0"), none.alias("n1"), "n2"))
    own = F.struct(keyed(0, F.col("order"), F.col("gram")).alias("key"), *[none.alias(f"k{c}") for c in range(3)])
    context = F.struct(keyed(1, F.col("order"), F.shiftright("gram", 8)).alias("key"),
                       *[(F.col(f"n{c}") > 0).cast("long").alias(f"k{c}") for c in range(3)])
    sums = rows.select("n0", "n1", "n2", F.explode(F.array(own, context)).alias("g")).select("n0", "n1", "n2", "g.*")
    return written(sums.groupBy("key").agg(*[F.sum(c).alias(c) for c in VALUES]), "counts")


def ratios(found: np.ndarray) -> np.ndarray:
    """(12 slots, VALUES, n-grams) -> log P(byte | toxic) - log P(byte | ordinary).  Slots: the n-gram's endings of order 1 to TOP,
    then their contexts."""
    lower = np.full(found.shape[2], 1 / 256)
    out = np.zeros(found.shape[2])
    for o in range(1, TOP + 1):
        own, context = found[o - 1], found[TOP + o - 1]
        extra = (STRENGTH, STRENGTH, 0.0)
        p = [np.where(context[c] + extra[c] > 0, (np.maximum(own[c] - DISCOUNT, 0) + (DISCOUNT * context[3 + c] + extra[c]) * lower)
                      / np.maximum(context[c] + extra[c], 1), lower) for c in range(3)]
        seen = context[0] + context[1] > 0
        out[seen] = (np.log(p[1]) - np.log(p[0]))[seen]
        lower = p[2]
    return out


def looked_up(grams: DataFrame, table: DataFrame) -> DataFrame:
    """(gram, n) -> (gram, n, r): what the byte that ends each n-gram says."""
    def slots(low):
        return F.explode(F.array(*[F.struct(F.lit(kind * TOP + o - 1).alias("slot"), keyed(kind, F.lit(o), F.shiftright(ending(o), 8 * kind)).alias("key"))
                                   for kind in (0, 1) for o in range(1, TOP + 1) if short(kind, o) == low])).alias("g")

    number = F.shiftright("key", 48)
    low = number.isin([kind * 8 + o for kind in (0, 1) for o in range(1, TOP + 1) if short(kind, o)])
    joined = [grams.select("gram", "n", slots(part)).select("gram", "n", "g.*").join(side, "key")
              for part, side in ((True, F.broadcast(table.filter(low))), (False, table.filter(~low).hint("shuffle_merge")))]
    each = F.struct("slot", *[F.col(c).cast("double").alias(c) for c in VALUES])
    rows = joined[0].unionByName(joined[1]).groupBy("gram").agg(F.max("n").alias("n"), F.collect_list(each).alias("found"))

    def task(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            found = batch.column(2)
            at = np.repeat(np.arange(batch.num_rows), found.value_lengths().to_numpy(zero_copy_only=False))
            slot, *values = (c.to_numpy(zero_copy_only=False) for c in found.flatten().flatten())
            dense = np.zeros((2 * TOP, len(VALUES), batch.num_rows))
            for i, v in enumerate(values):
                dense[slot, i, at] = v
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ratios(dense))], names=["gram", "n", "r"])

    return written(rows.mapInArrow(task, "gram long, n long, r double"), "ratios")


def evidence(docs: DataFrame, said: DataFrame, cache: int | None = None, margin: float = MARGIN) -> DataFrame:
    """(id, text), (gram, n, r) -> (id, e)."""
    bits = F.floor(F.log2("n")).alias("bits")
    sizes = sorted(((r.bits, r.n) for r in said.groupBy(bits).agg(F.count("*").alias("n")).collect()), reverse=True)     # 63 rows at most
    least, room = 64, CACHE if cache is None else cache
    for b, n in sizes:
        if n > room:
            break
        least, room = b, room - n
    whole = not sizes or least == sizes[-1][0]
    held = said.filter(bits >= least).select("gram", "r").toArrow()          # CACHE rows at most
    gram = held.column("gram").to_numpy()
    order = np.argsort(gram)
    shared = docs.sparkSession.sparkContext.broadcast((gram[order], held.column("r").to_numpy()[order]))

    def task(batches):
        known, values = shared.value
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, 1 << 21):
            texts = [_find(t.lower()) for t in batch.column(1).to_pylist()]
            number = {w: i for i, w in enumerate(set().union(*texts))}
            sums, missing = np.zeros(len(number)), {}
            if number:
                code, sizes = spelled(list(number))
                first = np.cumsum(sizes) - sizes
                at = np.minimum(np.searchsorted(known, code), max(0, len(known) - 1))
                hit = known[at] == code if len(known) else np.zeros(len(code), bool)
                each = np.zeros(len(code))
                each[hit] = values[at[hit]]
                sums = np.add.reduceat(each, first)
                if not whole:
                    for i in np.flatnonzero(np.add.reduceat(~hit, first)).tolist():
                        mine = slice(first[i], first[i] + sizes[i])
                        missing[i] = code[mine][~hit[mine]].tolist()
            excess = np.maximum(sums - margin, 0)
            excess[list(missing)] = 0
            e, rest = [], []
            for words in texts:
                mine = [number[w] for w in words]
                e.append(float(excess[mine].sum()))
                left = Counter(i for i in mine if i in missing) if missing else {}
                rest.append([{"part": float(sums[i]), "times": n, "grams": missing[i]} for i, n in left.items()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(e))), batch.column(0), pa.array(e, pa.float64()), pa.array([len(w) for w in texts], pa.int64()),
                 pa.array(rest, pa.list_(pa.struct([("part", pa.float64()), ("times", pa.int64()), ("grams", pa.list_(pa.int64()))])))],
                names=["row", "id", "e", "words", "rest"])
            row += len(e)

    rows = docs.select("id", "text").mapInArrow(
        task, "row long, id long, e double, words long, rest array<struct<part: double, times: long, grams: array<long>>>")
    spread = F.sqrt(F.greatest("words", F.lit(1)))
    if whole:
        return rows.select("id", (F.col("e") / spread).alias("e"))
    rows = written(rows, "evidence")
    open_ = rows.select("row", F.posexplode("rest").alias("at", "w")).select("row", "at", "w.part", "w.times", F.explode("w.grams").alias("gram"))
    each = (open_.join(said.filter(bits < least).hint("shuffle_merge"), "gram", "left").groupBy("row", "at", "part", "times")
            .agg(F.sum(F.coalesce("r", F.lit(0.0))).alias("r")))
    more = each.groupBy("row").agg(F.sum(F.col("times") * F.greatest(F.col("part") + F.col("r") - margin, F.lit(0.0))).alias("more"))
    return (rows.select("row", "id", "e", "words").join(more.hint("shuffle_merge"), "row", "left")
            .select("id", ((F.col("e") + F.coalesce("more", F.lit(0.0))) / spread).alias("e")))


class Model:
    """The exact counts (or None) and the slope and offset of the logistic curve."""

    def __init__(self, table: DataFrame | None, curve: tuple[float, float]):
        self.table, self.curve = table, curve


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def curve(evidence: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (``LEAST_SLOPE`` or more) and offset of a logistic curve (Newton steps, small ridge); ``weight`` undoes even sampling."""
    spread = evidence.std() or 1.0

    def newton(x, w, shift):
        for _ in range(60):
            p = logistic(x @ w + shift)
            g = x.T @ (weight * (p - toxic)) + 1e-2 * w
            h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
            w = w - np.linalg.solve(h, g)
        return w

    one = np.ones((len(evidence), 1))
    slope, offset = newton(np.column_stack([evidence / spread, one]), np.zeros(2), 0.0)
    if slope < LEAST_SLOPE:
        slope = LEAST_SLOPE
        (offset,) = newton(one, np.zeros(1), slope * evidence / spread)
    return float(slope / spread), float(offset)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic, fold) of the labelled documents outside the held-out fold."""
    marks = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")))
    if marks.count() <= BROADCAST_ROWS:
        marks = F.broadcast(marks)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return id_text(docs).join(marks, "doc_id").select("doc_id", "text", "toxic", fold.alias("fold"))


def fit(docs: DataFrame, labels: DataFrame, calibrate_rows: int = 4000) -> Model:
    """The curve from fold 1 under the counts of folds 2 to 4; then the counts of all four."""
    rows = labelled(docs, labels)
    one = rows.filter("fold = 1")
    sizes = {r.toxic: r.n for r in one.groupBy("toxic").agg(F.count("*").alias("n")).collect()}    # two rows
    if len(sizes) < 2:
        return Model(None, (0.0, 30.0 if 1 in sizes else -30.0))
    part = F.col("toxic") + F.when(F.col("fold") == 1, 2).otherwise(0)
    grams = written(counted(rows.withColumn("part", part)).withColumn("toxic", F.col("part") % 2), "grams")
    parts = []
    for toxic in sorted(sizes):
        mine = one.filter(F.col("toxic") == toxic)
        ids = mine.select("doc_id").orderBy(F.xxhash64(F.lit("fit"), "doc_id"), "doc_id").limit(calibrate_rows)
        parts.append(mine.join(F.broadcast(ids.distinct()), "doc_id").select(F.col("toxic").cast("long").alias("id"), "text").limit(calibrate_rows))
    sample = written(parts[0].unionByName(parts[1]), "sample")
    said = looked_up(distinct_grams(sample), counts(grams.filter("part < 2")))
    out = evidence(sample, said).toArrow()          # calibrate_rows rows of each class at most
    toxic, seen = out.column("id").to_numpy().astype(float), out.column("e").to_numpy()
    weight = np.where(toxic > 0, sizes[1] / max(1, (toxic > 0).sum()), sizes[0] / max(1, (toxic == 0).sum()))
    return Model(counts(grams), curve(seen, toxic, weight))


def distinct_grams(docs: DataFrame) -> DataFrame:
    """(gram, n) of order TOP in the texts."""
    return counted(docs.select("text", F.lit(0).alias("part"))).select("gram", "n")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", cache: int | None = None) -> DataFrame:
    """(doc_id, score) of every row."""
    docs = id_text(docs, id_col, text_col).withColumnRenamed("doc_id", "id")
    if model.table is None:
        return docs.select(F.col("id").alias("doc_id"), F.lit(float(logistic(model.curve[1]))).alias("score"))
    out = evidence(docs, looked_up(distinct_grams(docs), model.table), cache)
    x = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.lit(model.curve[0]) * F.col("e") + F.lit(model.curve[1])))
    return out.select(F.col("id").alias("doc_id"), (1 / (1 + F.exp(-x))).alias("score"))


def predict_toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    out = score(docs, fit(docs, labels, **options))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
