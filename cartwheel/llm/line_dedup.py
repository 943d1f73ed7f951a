"""Line dedup by winnowing, in DataFrame functions only.

A document is the sequence of its non-blank lines, each hashed to the first 128 bits of its SHA-256.  A line that also stands
earlier (in a smaller doc_id, or further up) is deleted; neighbours that go together are one run.

1. **Select.**  Every window of ``window`` consecutive lines selects its least hash (the leftmost), so a repeated run
   of that many lines is guaranteed to share a selected *fingerprint*.  Each selected position is one row, with the
   ``window`` - 1 lines to either side of it; documents shorter than a window are one window.
2. **Join and extend.**  Each position is joined to the earliest position of its fingerprint, and the match is extended line by
   line to both sides, up to where the neighbouring fingerprints take over.
3. **Shorter runs.**  The lines that no match covers go through the same join as windows of one line.  An earliest occurrence
   is never covered, so the rest loses none, and after this step no line that stands earlier is left, whatever ``window`` is.

No pairs of positions are listed: a passage that a third of the documents share costs one row per selected position, in
counts that are pre-aggregated and joins of written tables that AQE splits.

Blank lines match nothing and stay.  Null text: stays null.  Empty texts stay empty.  Rows that share a doc_id (or have none)
are documents of their own, ordered by a hash of the text (``row_keyed``); null ids come first.  Other columns are passed through
only on request.  An empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_keyed, written

WINDOW = 4


def is_blank(line):
    return F.trim(F.translate(line, "\t\r", "  ")) == ""


def line_hashes(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, h): hashes of the non-blank lines, documents without any left out."""
    lines = F.filter(F.split("text", "\n"), lambda x: ~is_blank(x))
    return docs.select("doc_id", F.transform(lines, lambda x: F.substring(F.unhex(F.sha2(x.cast("binary"), 256)), 1, 16)).alias("h")).filter(F.size("h") > 0)


def fingerprints(hashed: DataFrame, window: int) -> DataFrame:
    """(doc_id, h) -> (doc_id, at, fp, before, after): a row per selected position; before is read leftwards."""
    placed = F.transform("h", lambda x, i: F.struct(x.alias("fp"), i.alias("at")))
    least = F.transform(F.sequence(F.lit(0), F.greatest(F.size("h") - window, F.lit(0))),
                        lambda start: F.array_min(F.slice(F.col("placed"), start + 1, window)))
    rows = hashed.withColumn("placed", placed).select("doc_id", "h", F.explode(F.array_distinct(least)).alias("s"))
    left = F.least(F.col("s.at"), F.lit(window - 1))
    return rows.select("doc_id", F.col("s.at").alias("at"), F.col("s.fp").alias("fp"),
                       F.reverse(F.slice("h", F.col("s.at") - left + 1, left)).alias("before"),
                       F.slice("h", F.col("s.at") + 2, window - 1).alias("after"))


def matches(rows: DataFrame) -> DataFrame:
    """(doc_id, at, fp, ...) -> the rows whose fingerprint stands earlier, with the earliest such row as ``first``."""
    # written tables on either side of a join leave AQE free to split a hot fingerprint
    rows = written(rows, "fingerprints")
    shared = written(rows.groupBy("fp").agg(F.count("*").alias("n")).filter("n > 1").select("fp"), "shared")
    rows = written(rows.join(shared.hint("shuffle_merge"), "fp"), "candidates")
    place = [c for c in rows.columns if c != "fp"]
    first = written(rows.groupBy("fp").agg(F.min(F.struct(*place)).alias("first")), "firsts")
    return (rows.join(first.hint("shuffle_merge"), "fp")
            .filter(F.struct("doc_id", "at") > F.struct(F.col("first.doc_id"), F.col("first.at"))))


def common_length(a, b):
    """How many elements two arrays have in common from their beginning."""
    equal = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    end = F.array_position(equal, F.lit(False))
    return F.when(end == 0, F.size(equal)).otherwise(end - 1).cast("int")


def repeated_lines(docs: DataFrame, window: int) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, dead): ascending places of the non-blank lines that stand earlier."""
    hashed = written(line_hashes(docs), "lines")
    found = matches(fingerprints(hashed, window))
    run = F.sequence(F.col("at") - common_length(F.col("before"), F.col("first.before")),
                     F.col("at") + common_length(F.col("after"), F.col("first.after")))
    covered = written(found.select("doc_id", run.alias("run")).groupBy("doc_id")
                      .agg(F.array_distinct(F.flatten(F.collect_list("run"))).alias("covered")), "covered")
    left = hashed.join(covered.hint("shuffle_merge"), "doc_id", "left")
    open_ = F.filter(F.transform("h", lambda x, i: F.struct(i.alias("at"), x.alias("fp"))),
                     lambda x: ~F.coalesce(F.array_contains("covered", x["at"]), F.lit(False)))
    single = matches(left.select("doc_id", F.explode(open_).alias("l")).select("doc_id", "l.at", "l.fp"))
    rest = single.groupBy("doc_id").agg(F.collect_list("at").alias("covered"))
    return (covered.unionByName(rest).groupBy("doc_id")
            .agg(F.sort_array(F.flatten(F.collect_list("covered"))).alias("dead")))


def dedup_lines(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                keep_columns: tuple[str, ...] = ()) -> DataFrame:
    """One row per row: doc_id, text without the repeated lines, n_lines (non-blank ones), n_removed, n_runs."""
    docs = row_keyed(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                                 *[F.col(c).alias(f"__{i}") for i, c in enumerate(keep_columns)]))
    gone = repeated_lines(docs.select("doc_id", "text"), window)
    joined = docs.join(gone.hint("shuffle_merge"), "doc_id", "left")
    lines = F.split("text", "\n")
    # places of the non-blank lines; the removed ones as places among these, and among all lines
    full = F.filter(F.transform(lines, lambda x, i: F.when(~is_blank(x), i)), lambda x: x.isNotNull())
    base = joined.select("*", lines.alias("__lines"), full.alias("__full"), F.coalesce("dead", F.array().cast("array<int>")).alias("__dead"))
    base = base.withColumn("__ends", F.array_append(F.transform("__dead", lambda d: F.get("__full", d)), F.size("__lines")))
    n_runs = F.size(F.filter("__dead", lambda x, i: (i == 0) | (F.get("__dead", i - 1) != x - 1)))
    # what stands between the removed lines
    after = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get("__ends", i - 1) + 1)
    walked = F.flatten(F.transform("__ends", lambda end, i: F.slice("__lines", after(i) + 1, end - after(i))))
    text = F.when(F.size("__dead") > 0, F.array_join(walked, "\n")).otherwise(F.col("text"))
    count = lambda c: F.greatest(F.size(c), F.lit(0))
    return base.select(F.col("__id").alias("doc_id"), text.alias("text"), *[F.col(f"__{i}").alias(c) for i, c in enumerate(keep_columns)],
                       F.coalesce(count("__full"), F.lit(0)).cast("long").alias("n_lines"),
                       count("__dead").cast("long").alias("n_removed"), n_runs.cast("long").alias("n_runs"))
