"""Alignment of the tokens of two tokenizers over the bytes of a text, and how often their ids meet in the corpus.

Both tokenizers cut the bytes of `` `` + text into tokens.  Byte offsets where tokens of both end cut them into groups.  A and B
tokens of one group are linked, each with each.

* **Fragments.**  Any byte range of a text yields a fragment: the tokens that end in it before its first common end (open prefix),
  the groups between its first and last common end (closed), and the tokens after that (open suffix).  ``compose`` joins
  fragments of adjacent ranges: what is open on either side of the seam closes into one group, or stays open.  It
  is associative and the empty fragment is neutral, so any tree gives what the whole text gives.
* **Very long texts** (over ``piece`` characters) are cut between words, where neither tokenizer has a token across the cut
  (checked from the vocabulary), and their pieces are dealt to tasks.  A task emits one fragment per ``span`` bytes, wherever that
  cuts groups; a tree of fan-in ``FAN`` composes them in grouped tasks, one level after the other.
* **Counts.**  Each text has a row with its distinct linked id pairs; how many texts hold a pair is a grouped count of these.
  The ``CACHE`` most frequent pairs go to the tasks that score texts; the rest is joined.  That cut-off changes no result.

Null and empty texts, and texts whose token bytes do not spell the text again (such as those with U+2581, which the second tokenizer
writes for a space), have no tokens: zeros, and '' as digest.  Special tokens are plain text.  Rows that share an id, null ids and
repeated rows are texts of their own.  Columns other than id and text are not read; an empty table gives no rows.  A text that
has no seam between words for long stays one piece, since only its whole can be encoded."""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, slices, written
from .packing import LONG_RUN, SPLIT, byte_letters

PIECE, SPAN, FAN = 1 << 18, 1 << 16, 8
CACHE = 1 << 20                     # pairs whose counts go to the tasks: 16 bytes each
WIDE = 1 << 12                      # a group with more links than this is counted by distinct ids
SEAM = re.compile(r"(?<=\w) (?=\w)")
PAIR = 1 << 31                      # ids of either tokenizer are below


class Vocabulary:
    """Text -> ids without special tokens, and the bytes of each id."""

    def __init__(self, encode, tokens: list[bytes], seams: bool):
        self.encode, self.tokens, self.seams = encode, tokens, seams
        self.sizes = np.array([len(t) for t in tokens], np.int64)

    def spelled(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def byte_level(path: str) -> Vocabulary:
    """A byte-level BPE file of ``tokenizers``; texts get the leading space here."""
    import tiktoken
    from tokenizers import Tokenizer
    spec = json.load(open(path, encoding="utf-8"))
    special = {t["content"] for t in spec.get("added_tokens", [])}
    letters = byte_letters()
    tokens = [b""] * (1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens", []))]))
    ranks = {}
    for token, i in spec["model"]["vocab"].items():
        if token not in special:
            tokens[i] = bytes(letters[c] for c in token)
            ranks[tokens[i]] = i
    fast = tiktoken.Encoding("alignment", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    exact, run = Tokenizer.from_file(path), re.compile(r"\S{%d}|\s{%d}" % (LONG_RUN, LONG_RUN))
    exact.encode_special_tokens = True

    def encode(texts):
        out = []
        for text in texts:
            text = " " + text
            # tiktoken's merging is quadratic in unbroken runs
            out.append(exact.encode(text, add_special_tokens=False).ids if len(text) >= LONG_RUN and run.search(text)
                       else fast.encode_ordinary(text))
        return out

    # the split pattern starts anew at a space between words
    return Vocabulary(encode, tokens, True)


@lru_cache(maxsize=2)
def pieces(path: str) -> Vocabulary:
    """A ``sentencepiece`` file with byte fallback, which adds the leading space itself."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    tokens = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i) or model.is_unknown(i)
              else p.replace("▁", " ").encode("utf-8") for i, p in enumerate(names)]
    return Vocabulary(lambda texts: model.encode(list(texts), num_threads=1), tokens,
                      not any("▁" in p.lstrip("▁") for p in names))


# ---- fragments --------------------------------------------------------------------------------
# (prefix_a, prefix_b, closed, suffix_a, suffix_b): ids of the open ends; closed is None while no common end has been seen (all
# tokens are then in the prefix), else (groups text, groups, links, {a * PAIR + b: links})

EMPTY = ((), (), None, (), ())


def group_text(a, b) -> str:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}"


def group_links(a, b) -> dict[int, int]:
    ia, na = np.unique(np.asarray(a, np.int64), return_counts=True)
    ib, nb = np.unique(np.asarray(b, np.int64), return_counts=True)
    return dict(zip((ia[:, None] * PAIR + ib[None, :]).ravel().tolist(), (na[:, None] * nb[None, :]).ravel().tolist()))


def merged(x: dict, y: dict) -> dict:
    if len(x) < len(y):
        x, y = y, x
    out = dict(x)
    for k, n in y.items():
        out[k] = out.get(k, 0) + n
    return out


def compose(f, g):
    """The fragment of two adjacent ranges."""
    if f[2] is None:
        return (*(tuple(x) + tuple(y) for x, y in zip(f[:2], g[:2])), *g[2:])
    if g[2] is None:
        return (*f[:3], tuple(f[3]) + tuple(g[0]), tuple(f[4]) + tuple(g[1]))
    a, b = (*f[3], *g[0]), (*f[4], *g[1])
    texts, groups, links, pairs = [f[2][0], g[2][0]], f[2][1] + g[2][1], f[2][2] + g[2][2], merged(f[2][3], g[2][3])
    if a or b:
        texts.insert(1, group_text(a, b))
        groups, links, pairs = groups + 1, links + len(a) * len(b), merged(pairs, group_links(a, b))
    return f[0], f[1], (";".join(t for t in texts if t), groups, links, pairs), g[3], g[4]


class Groups:
    """The groups of token sequences of many texts, computed together.  ``a`` and ``b``: ids; ``a_end`` and ``b_end``: byte
    offsets of their ends in all the texts one after the other."""

    def __init__(self, a, a_end, b, b_end):
        self.a, self.b = a, b
        base = min(a_end[:1].tolist() + b_end[:1].tolist(), default=0)
        size = max(a_end[-1:].tolist() + b_end[-1:].tolist(), default=-1) + 1 - base
        in_a, in_b = np.zeros(size, bool), np.zeros(size, bool)
        in_a[a_end - base], in_b[b_end - base] = True, True
        both_a, both_b = in_b[a_end - base], in_a[b_end - base]
        self.common = a_end[both_a]
        self.ga, self.gb = np.cumsum(both_a) - both_a, np.cumsum(both_b) - both_b     # group of each token: common ends before its own
        n = len(self.common)
        self.na, self.nb = np.bincount(self.ga, minlength=n + 1)[:n], np.bincount(self.gb, minlength=n + 1)[:n]
        self.fa, self.fb = np.cumsum(self.na) - self.na, np.cumsum(self.nb) - self.nb

    def links(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(group, a * PAIR + b, links) of the groups lo to hi."""
        na, nb = self.na[lo:hi], self.nb[lo:hi]
        wide = na * nb > WIDE
        n = np.where(wide, 0, na * nb)
        group = np.repeat(np.arange(lo, hi), n)
        inner = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
        pair = self.a[self.fa[group] + inner // self.nb[group]] * PAIR + self.b[self.fb[group] + inner % self.nb[group]]
        parts = [(group, pair, np.ones(len(group), np.int64))]
        for g in (lo + np.flatnonzero(wide)).tolist():
            found = group_links(self.a[self.fa[g]:self.fa[g] + self.na[g]], self.b[self.fb[g]:self.fb[g] + self.nb[g]])
            parts.append((np.full(len(found), g), np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), np.int64, len(found))))
        return tuple(np.concatenate(c) for c in zip(*parts))

    def spelled(self, names) -> list[str]:
        """The tokens of all groups in order, each with the mark that follows it."""
        n = len(self.common)
        a, b = self.ga < n, self.gb < n
        ga, gb = self.ga[a], self.gb[b]
        at_a, at_b = np.arange(len(ga)) + self.fb[ga], np.arange(len(gb)) + (self.fa + self.na)[gb]
        last_a, last_b = self.fa + self.na - 1, self.fb + self.nb - 1
        index = np.empty(len(ga) + len(gb), np.int64)
        index[at_a] = self.a[a] * 3
        index[at_b] = self.b[b] * 3
        index[at_a[last_a]] += 1                       # '|' after the last of A
        index[at_b[last_b]] += 2                       # ';' after the last of B
        return list(map(names.__getitem__, index.tolist()))


def distinct_links(owner, pair, links, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, pair, links) sorted, with the links of equal ones added up; ids are below ``size``."""
    a, b = pair // PAIR, pair % PAIR
    if len(owner) and int(owner.max()) < (1 << 62) // size ** 2 and (links == 1).all():
        key = np.sort((owner * size + a) * size + b)               # one number for all three; equal ones are counted
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        rest, b = np.divmod(key[start], size)
        owner, a = np.divmod(rest, size)
        return owner, a * PAIR + b, np.diff(np.append(start, len(key)))
    order = np.lexsort((pair, owner))
    owner, pair, links = owner[order], pair[order], links[order]
    new = np.ones(len(pair), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])
    start = np.flatnonzero(new)
    return owner[start], pair[start], np.add.reduceat(links, start) if len(start) else links


@lru_cache(maxsize=2)
def marked(size: int) -> list[str]:
    return [f"{i}{mark}" for i in range(size) for mark in ",|;"]


def fragment(a, a_end, b, b_end, size: int):
    """The fragment of a byte range whose tokens end at these offsets; ids are below ``size``."""
    a, a_end, b, b_end = (np.asarray(x, np.int64) for x in (a, a_end, b, b_end))
    g = Groups(a, a_end, b, b_end)
    n = len(g.common)
    if not n:
        return tuple(a.tolist()), tuple(b.tolist()), None, (), ()
    first = (tuple(a[g.ga == 0].tolist()), tuple(b[g.gb == 0].tolist()))
    rest = (tuple(a[g.ga == n].tolist()), tuple(b[g.gb == n].tolist()))
    _, pair, links = g.links(1, n)
    codes, at = np.unique(pair, return_inverse=True)
    count = np.bincount(at, links, minlength=len(codes)).astype(np.int64)
    inner = "".join(g.spelled(marked(size))[int(g.na[0] + g.nb[0]):]).rstrip(";")
    return (*first, (inner, n - 1, int(links.sum()), dict(zip(codes.tolist(), count.tolist()))), *rest)


def encoded(texts: list[str], first: Vocabulary, second: Vocabulary) -> tuple[list, list, list[bytes], np.ndarray]:
    """Ids of both, the bytes they should spell, and whether both do."""
    a, b = first.encode(texts), second.encode(texts)
    raw = [(" " + t).encode("utf-8") for t in texts]
    good = np.array([first.spelled(x) == r and second.spelled(y) == r for x, y, r in zip(a, b, raw)], bool)
    return a, b, raw, good


DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, links array<int>"
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"]


def _lists(values, offsets, kind):
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def whole_texts(docs: DataFrame, first, second) -> DataFrame:
    """Short texts -> DOC rows; a batch of texts is aligned at once."""
    def task(batches):
        one, two = first(), second()
        names = marked(max(len(one.tokens), len(two.tokens)))
        for batch in slices(batches, 1 << 20):
            texts = batch.column(1).to_pylist()
            n = len(texts)
            a, b, raw, good = encoded(texts, one, two)
            live = [i for i in range(n) if good[i] and texts[i]]
            ids = [np.fromiter((t for i in live for t in side[i]), np.int64) for side in (a, b)]
            g = Groups(ids[0], np.cumsum(one.sizes[ids[0]]), ids[1], np.cumsum(two.sizes[ids[1]]))
            # a text's end is a common end, so groups do not cross texts
            size = [np.array([len(side[i]) for i in live], np.int64) for side in (a, b)]
            until = np.searchsorted(g.common, np.cumsum([len(raw[i]) for i in live], dtype=np.int64), "right")
            group_of = np.repeat(np.arange(len(live)), np.diff(np.append(0, until)))
            group, pair, links = g.links(0, len(g.common))
            owner = group_of[group]
            owner, pair, count = distinct_links(owner, pair, links, max(len(one.tokens), len(two.tokens)))
            per = np.zeros((5, n), np.int64)           # n_a, n_b, n_groups, n_links, distinct pairs
            at = np.array(live, np.int64)
            per[0, at], per[1, at], per[2, at] = size[0], size[1], np.diff(np.append(0, until))
            per[3, at] = np.bincount(owner, count, minlength=len(live))
            per[4, at] = np.bincount(owner, minlength=len(live))
            spelled, digest = g.spelled(names), [""] * n
            ends = np.cumsum(size[0] + size[1]).tolist()
            for k, i in enumerate(live):
                mine = spelled[ends[k - 1] if k else 0:ends[k]]
                digest[i] = hashlib.sha256("".join(mine)[:-1].encode()).hexdigest()
            offsets = np.cumsum(np.append(0, per[4]))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(per[c]) for c in range(4)), pa.array(digest, pa.string()),
                                              _lists(pair, offsets, pa.int64()), _lists(count, offsets, pa.int32())], names=NAMES)

    return docs.mapInArrow(task, DOC)


# ---- very long texts --------------------------------------------------------------------------

ENDS = "array<long>"
FRAGMENT = (f"row long, doc_id long, at long, good boolean, n_a long, n_b long, pa_ {ENDS}, pb {ENDS}, closed boolean, groups string, n_groups long, "
            f"n_links long, pairs {ENDS}, links {ENDS}, sa {ENDS}, sb {ENDS}")


def _packed(key, good, n, f):
    pa_, pb, closed, sa, sb = f
    text, groups, links, pairs = closed or ("", 0, 0, {})
    return (*key, good, *n, list(pa_), list(pb), closed is not None, text, groups, links, list(pairs), list(pairs.values()), list(sa), list(sb))


def _fragment_of(r):
    closed = (r["groups"], r["n_groups"], r["n_links"], dict(zip(r["pairs"], r["links"]))) if r["closed"] else None
    return tuple(r["pa_"]), tuple(r["pb"]), closed, tuple(r["sa"]), tuple(r["sb"])


def _batch(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


def _arrow(ddl_frame: DataFrame):
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(ddl_frame.schema)


def cut_pieces(docs: DataFrame, piece: int) -> DataFrame:
    """(row, doc_id, at, text): texts cut at seams about every ``piece`` characters; ``at`` counts the pieces."""
    def task(batches):
        for batch in slices(batches, 1 << 22):
            for row, doc, text in zip(*(batch.column(c).to_pylist() for c in range(3))):
                at = start = 0
                while start < len(text) or not at:
                    seam = SEAM.search(text, start + piece) if start + piece < len(text) else None
                    end = seam.start() if seam else len(text)
                    yield pa.RecordBatch.from_arrays([pa.array([row]), pa.array([doc], pa.int64()), pa.array([at]), pa.array([text[start:end]])],
                                                     names=["row", "doc_id", "at", "text"])
                    at, start = at + 1, end + 1        # the space at the seam is what both tokenizers put before a text

    return (docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
            .mapInArrow(task, "row long, doc_id long, at long, text string"))


def piece_fragments(parts: DataFrame, first, second, span: int, schema) -> DataFrame:
    """One fragment per ``span`` bytes of each piece; ``at`` orders the fragments of a text."""
    def task(batches):
        one, two = first(), second()
        for batch in slices(batches, 1 << 18):
            for row, doc, at, text in zip(*(batch.column(c).to_pylist() for c in range(4))):
                (a,), (b,), (raw,), (good,) = encoded([text], one, two)
                if not good:
                    yield _batch([_packed((row, doc, at << 32), False, (0, 0), EMPTY)], schema)
                    continue
                a, b = np.array(a, np.int64), np.array(b, np.int64)
                ea, eb = np.cumsum(one.sizes[a]), np.cumsum(two.sizes[b])
                for k, lo in enumerate(range(0, len(raw), span)):
                    x, y = (slice(*np.searchsorted(e, [lo, lo + span], "right")) for e in (ea, eb))
                    f = fragment(a[x], ea[x], b[y], eb[y], max(len(one.tokens), len(two.tokens)))
                    yield _batch([_packed((row, doc, (at << 32) + k), True, (len(a[x]), len(b[y])), f)], schema)

    return parts.select("row", "doc_id", "at", "text").mapInArrow(task, FRAGMENT)


def composed(fragments: DataFrame, fan: int, schema) -> DataFrame:
    """One level of the tree: up to ``fan`` neighbours become one fragment."""
    def task(batches):
        held = None                                    # (row, doc, group), good, counts, fragment
        for batch in batches:
            for r in batch.to_pylist():
                key = (r["row"], r["doc_id"], r["at"] // fan)
                if held is None or held[0] != key:
                    if held is not None:
                        yield _batch([_packed(*held)], schema)
                    held = (key, True, (0, 0), EMPTY)
                held = (key, held[1] and r["good"], (held[2][0] + r["n_a"], held[2][1] + r["n_b"]), compose(held[3], _fragment_of(r)))
        if held is not None:
            yield _batch([_packed(*held)], schema)

    group = F.floor(F.col("at") / fan)
    return fragments.repartition("row", group).sortWithinPartitions("row", "at").mapInArrow(task, FRAGMENT)


def long_texts(docs: DataFrame, first, second, piece: int, span: int, fan: int) -> DataFrame:
    """Long texts -> DOC rows, by a tree of fragments."""
    parts = written(cut_pieces(docs, piece), "pieces")
    empty = docs.sparkSession.createDataFrame([], FRAGMENT)
    schema = _arrow(empty)
    rows = written(piece_fragments(parts.repartition("row", "at"), first, second, span, schema), "fragments")
    # dense places: pieces have unequal numbers of fragments
    width = rows.agg(F.max(F.col("at").bitwiseAND((1 << 32) - 1)), F.max(F.shiftright("at", 32))).first()
    if width[0] is None:
        return docs.sparkSession.createDataFrame([], DOC)
    per = width[0] + 1
    rows = rows.withColumn("at", F.shiftright("at", 32) * per + F.col("at").bitwiseAND((1 << 32) - 1))
    left = (width[1] + 1) * per
    while left > 1:
        rows = written(composed(rows, fan, schema), "fragments")
        left = -(-left // fan)

    def task(batches):
        types = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                # the beginning and the end of a text are common ends
                _, _, whole, _, _ = compose(compose(((), (), ("", 0, 0, {}), (), ()), _fragment_of(r)), ((), (), ("", 0, 0, {}), (), ()))
                out.append((r["doc_id"], r["n_a"], r["n_b"], *whole[1:3], hashlib.sha256(whole[0].encode()).hexdigest(), list(whole[3]), list(whole[3].values()))
                           if r["good"] else (r["doc_id"], 0, 0, 0, 0, "", [], []))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=NAMES)

    return rows.mapInArrow(task, DOC)


# ---- counts -----------------------------------------------------------------------------------

def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, says): in how many texts each id pair is linked, times 2, plus 1 if no pair of its A id is in more."""
    counts = written(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    a = F.shiftright("pair", 31)
    best = counts.groupBy(a.alias("a")).agg(F.max("n").alias("best"))             # a row per id of the first vocabulary
    return written(counts.join(F.broadcast(best), a == F.col("a"))
                   .select("pair", (F.col("n") * 2 + (F.col("n") == F.col("best")).cast("long")).alias("says")), "counts")


def scored(aligned: DataFrame, says: DataFrame, cache: int) -> DataFrame:
    """The result columns of ``align``."""
    bits = F.floor(F.log2("says"))
    sizes = sorted(((r.bits, r.n) for r in says.groupBy(bits.alias("bits")).agg(F.count("*").alias("n")).collect()), reverse=True)   # 63 rows
    least, room = 64, cache
    for b, n in sizes:
        if n > room:
            break
        least, room = b, room - n
    whole = not sizes or least == sizes[-1][0]
    held = says.filter(bits >= least).toArrow()                                   # ``cache`` rows at most
    pair = held.column("pair").to_numpy()
    order = np.argsort(pair)
    shared = aligned.sparkSession.sparkContext.broadcast((pair[order], held.column("says").to_numpy()[order]))
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def task(batches):
        known, value = shared.value
        for batch in batches:
            pairs, links = batch.column(6), batch.column(7)
            offsets = np.cumsum(np.append(0, pairs.value_lengths().to_numpy(zero_copy_only=False)))
            pair, n = pairs.flatten().to_numpy(zero_copy_only=False), links.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.minimum(np.searchsorted(known, pair), max(0, len(known) - 1))
            hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            said = np.where(hit, value[at], 0) if len(known) else np.zeros(len(pair), np.int64)
            sums = [np.append(0, np.cumsum(x)) for x in (n * (said & 1), n * (said >> 1))]
            best, total = (s[offsets[1:]] - s[offsets[:-1]] for s in sums)
            missing = [_lists(x[~hit], np.append(0, np.cumsum(~hit))[offsets], t) for x, t in ((pair, pa.int64()), (n, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(best), pa.array(total), *missing],
                                             names=[*keep, "n_best", "count_sum", "pairs", "links"])

    schema = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, "
              "pairs array<long>, links array<long>")
    rows = aligned.select(*NAMES).mapInArrow(task, schema)
    if not whole:
        rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "scored")
        rest = (rows.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("g")).select("row", F.col("g.pairs").alias("pair"), "g.links")
                .join(says.filter(bits < least).hint("shuffle_merge"), "pair")
                .groupBy("row").agg(F.sum(F.col("links") * F.col("says").bitwiseAND(1)).alias("more_best"),
                                    F.sum(F.col("links") * F.shiftright("says", 1)).alias("more")))
        zero = lambda c: F.coalesce(F.col(c), F.lit(0))
        rows = (rows.join(rest.hint("shuffle_merge"), "row", "left").withColumn("n_best", F.col("n_best") + zero("more_best"))
                .withColumn("count_sum", F.col("count_sum") + zero("more")))
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def align(docs: DataFrame, first_path: str, second_path: str, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE,
          span: int = SPAN, fan: int = FAN, cache: int = CACHE) -> DataFrame:
    """One row per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for the byte-level BPE file
    ``first_path`` (A) and the sentencepiece file ``second_path`` (B)."""
    first, second = (lambda: byte_level(first_path)), (lambda: pieces(second_path))
    docs = id_text(docs, id_col, text_col)
    if not (first().seams and second().seams):
        aligned = whole_texts(docs, first, second)
    else:
        long = F.length("text") > piece
        aligned = whole_texts(docs.filter(~long), first, second).unionByName(
            long_texts(docs.filter(long), first, second, piece, span, fan))
    aligned = written(aligned, "aligned")
    return scored(aligned, pair_counts(aligned), cache)
