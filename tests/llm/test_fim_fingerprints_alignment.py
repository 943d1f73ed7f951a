"""Fill-in-middle, fingerprints and alignment against plain versions; odd inputs for each."""

import hashlib
import os
import random
import re
import sys
from collections import Counter, defaultdict
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from cartwheel.llm import alignment, fim, fingerprints  # noqa: E402
from cartwheel.llm.registry import tokenizer_path  # noqa: E402
from test_llm_operators import documents, odd_rows  # noqa: E402

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


def many_rows():
    rng = random.Random(9)
    return odd_rows() + [(None, "no id\neither"), (5, "again\n5"), (5, "again\n5"), (300, "x <P> y"), (301, "<S>\n"), (302, "a\nb\n<M"), (303, "\n" * 3000),
                         (304, "no line feed"), (305, "<\nP>\n<"), (306, "<|endoftext|> <s> a </s>"), (307, "a▁b c"), (308, "tab\t tab  "), (309, "日本語 テキスト 🙂\n🙂"),
                         (310, "\n".join("".join(rng.choice("ab é🙂") for _ in range(rng.randint(0, 90))) for _ in range(400)))]


def counted(rows):
    return Counter(map(tuple, rows))


# ---- fill in the middle -----------------------------------------------------------------------

def plain_fim(doc, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    h = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in fim.MARKERS) or h3 % 100 >= rate:
        return doc, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm_rate:
        return doc, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("block,rate,spm", [(1024, 100, 50), (7, 100, 100), (64, 40, 0)])
def test_fim_equals_plain_version_and_restores(spark, block, rate, spm):
    rows = many_rows()
    out = fim.restore(fim.transform(documents(spark, rows), 7, rate, spm, block=block)).collect()
    assert counted(r[:6] for r in out) == counted(plain_fim(d, t, 7, rate, spm) for d, t in rows)
    assert Counter((r.doc_id, r.restored) for r in out) == Counter((d, t or "") for d, t in rows)


def test_fim_digests_and_empty_table(spark):
    rows = many_rows()
    got = {(r.doc_id, r.n, r.form, r.output_sha256, r.restored_sha256) for r in fim.digests(documents(spark, rows)).collect()}
    want = {(d, n, form, sha(out), sha(t or "")) for (d, t), (_, n, form, _, _, out) in zip(rows, (plain_fim(*r) for r in rows))}
    assert got == want
    assert fim.digests(documents(spark, [])).collect() == []


def test_fenwick_cuts():
    rng = random.Random(3)
    for _ in range(60):
        text = "".join(rng.choice("a\né🙂") for _ in range(rng.randint(1, 200)))
        units, blocks = re.findall(r"[^\n]*\n|[^\n]+", text), fim.Blocks(np.frombuffer(text.encode(), np.uint8), rng.choice([1, 3, 16]))
        assert blocks.units == len(units)
        for k in range(len(units) + 1):
            head = "".join(units[:k])
            assert blocks.cut(k) == (len(head.encode()), len(head))


# ---- fingerprints -----------------------------------------------------------------------------

def plain_parse(names):
    """One level, symbol by symbol: [(name of the run or symbol, ...)] phrases as tuples."""
    runs = []
    for x in names:
        if runs and runs[-1][0] == x:
            runs[-1][1] += 1
        else:
            runs.append([x, 1])
    label = []
    for i, (x, _) in enumerate(runs):
        if isinstance(x, int) and x < 256:
            label.append(x)
        else:
            d = x ^ runs[i - 1][0] if i else 1
            place = (d & -d).bit_length() - 1
            label.append(2 * place + (x >> place & 1))
    for _ in range(3):
        again = []
        for i, x in enumerate(label):
            left = label[i - 1] if i else ~x & 255
            place = ((x ^ left) & -(x ^ left)).bit_length() - 1
            again.append(2 * place + (x >> place & 1))
        label = again
    assert max(label) < 6 and all(x != y for x, y in zip(label, label[1:]))
    label[0] = 255
    starts = [i for i in range(len(label)) if i == 0 or (i + 1 < len(label) and label[i - 1] < label[i] > label[i + 1])]
    return [tuple(map(tuple, runs[a:b])) for a, b in zip(starts, [*starts[1:], len(runs)])]


def test_parsing_equals_plain_version():
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"abcde  \n") for _ in range(rng.randint(1, 300))) for _ in range(40)] + [b"a" * 500, b"ab" * 300, b"x", bytes(range(256))]
    data, starts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])[:-1]
    names, current = data, [list(t) for t in texts]
    for _ in range(4):
        names, starts = fingerprints.parsed(names, starts)
        ends = np.append(starts[1:], len(names))
        meaning = {}
        for i, symbols in enumerate(current):
            phrases = plain_parse(symbols)
            mine = names[starts[i]:ends[i]].tolist()
            assert len(phrases) == len(mine)
            for phrase, name in zip(phrases, mine):        # one name, one phrase, wherever it stands
                assert meaning.setdefault(phrase, name) == name
            current[i] = mine
        assert len(set(meaning.values())) == len(meaning)


def test_equal_substrings_share_interior_names():
    rng = random.Random(2)
    shared = bytes(rng.randrange(97, 123) for _ in range(4000))
    sets = []
    for _ in range(2):
        raw = bytes(rng.randrange(97, 123) for _ in range(rng.randint(100, 999))) + shared + bytes(rng.randrange(97, 123) for _ in range(500))
        names, starts = np.frombuffer(raw, np.uint8), np.zeros(1, np.int64)
        levels = []
        for _ in range(4):
            names, starts = fingerprints.parsed(names, starts)
            levels.append(names.tolist())
        sets.append(levels)
    for level, (x, y) in enumerate(zip(*sets)):
        run = SequenceMatcher(None, x, y, autojunk=False).find_longest_match().size       # in one piece
        assert run >= 4000 / 2.9 ** (level + 1) - 15


def plain_chain(rows):
    order = sorted([r for r in rows if r[0] is not None], key=lambda r: -r[0]) + [r for r in rows if r[0] is None]
    return list(zip(order, [*order[1:], order[0]]))


@pytest.mark.parametrize("bucket", [1, 3000, 1 << 22])
def test_against_edited_follows_descending_ids(spark, bucket):
    rows = [(d, t) for d, t in many_rows() if d not in (5, None)] + [(None, "the only one without an id")]
    got = {r.doc_id: r for r in fingerprints.against_edited(documents(spark, rows), bucket_bytes=bucket).collect()}
    assert len(got) == len(rows)
    prints = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(documents(spark, rows)).collect()}
    raw = {d: np.frombuffer(bytes.fromhex(p), np.uint8)[None] for d, p in prints.items()}
    for (d, t), (e, u) in plain_chain(rows):
        version, r = fingerprints.edited(t or "", u or ""), got[d]
        third = len(t or "") // 3
        assert version == (t or "")[:len(t or "") - third] + (u or "")[:third]
        assert (r.n_chars, r.edited_sha256, r.fingerprint) == (len(t or ""), sha(version), prints[d])
        mine = fingerprints.sketched([version.encode()])
        assert r.edited_fingerprint == mine[0].tobytes().hex()
        assert r.near_edited == fingerprints.likeness(raw[d], mine)[0] and r.near_next == fingerprints.likeness(raw[d], raw[e])[0]


def test_against_edited_with_repeated_and_null_ids(spark):
    rows = [(None, f"text {i % 7}") for i in range(60)] + [(3, "same")] * 50 + [(i, f"doc {i}") for i in range(20)]
    out = fingerprints.against_edited(documents(spark, rows), bucket_bytes=40).collect()
    assert Counter(r.doc_id for r in out) == Counter(d for d, _ in rows)
    assert sum(r.doc_id == 3 and r.near_next == 1.0 for r in out) >= 49
    (one,) = fingerprints.against_edited(documents(spark, [(1, "alone here")])).collect()
    assert one.near_next == 1.0 and one.edited_sha256 == sha("alone halo")
    assert fingerprints.against_edited(documents(spark, [])).collect() == []


def test_likeness_tells_edited_from_next(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = fingerprints.against_edited(docs).collect()
    assert all(0 <= x <= 1 for r in out for x in (r.near_edited, r.near_next))
    assert np.mean([r.near_edited > r.near_next for r in out]) > 0.99
    assert np.mean([r.near_edited for r in out]) > 0.4 and np.median([r.near_next for r in out]) < 0.05
    by_text = defaultdict(set)
    for r, (text,) in zip(sorted(out, key=lambda r: r.doc_id), docs.orderBy("doc_id").select("text").collect()):
        by_text[text].add(r.fingerprint)
    assert all(len(p) == 1 for p in by_text.values())


def test_compare_column(spark):
    prints = fingerprints.fingerprints(documents(spark, [(1, "a b c d e f"), (2, "a b c d e f"), (3, "")]))
    pairs = prints.alias("x").join(prints.alias("y"), F.col("x.doc_id") <= F.col("y.doc_id")).select(
        F.col("x.doc_id").alias("i"), F.col("y.doc_id").alias("j"), F.col("x.fingerprint").alias("p"), F.col("y.fingerprint").alias("q"))
    got = {(r.i, r.j): r.likeness for r in fingerprints.compare(pairs, "p", "q").collect()}
    assert got[1, 2] == got[3, 3] == 1.0 and got[1, 3] == 0.0


# ---- alignment --------------------------------------------------------------------------------

def plain_tokens(text):
    import sentencepiece
    from tokenizers import Tokenizer
    t = plain_tokens.__dict__.setdefault("a", Tokenizer.from_file(A))
    m = plain_tokens.__dict__.setdefault("b", sentencepiece.SentencePieceProcessor(model_file=B))
    t.encode_special_tokens = True
    letters = alignment.byte_letters()
    a = t.encode(" " + text, add_special_tokens=False)
    b = m.encode(text)
    names = [m.id_to_piece(i) for i in b]
    return (a.ids, [bytes(letters[c] for c in x) for x in a.tokens], b,
            [bytes([int(x[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", x) and m.is_byte(i) else x.replace("▁", " ").encode() for x, i in zip(names, b)])


def plain_alignment(rows):
    docs, held = [], Counter()
    for d, text in rows:
        text = text or ""
        a, ab, b, bb = plain_tokens(text) if text else ([], [], [], [])
        raw = (" " + text).encode()
        if not text or b"".join(ab) != raw or b"".join(bb) != raw:
            docs.append((d, None))
            continue
        ends = [list(np.cumsum([len(x) for x in side])) for side in (ab, bb)]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in common]
        for side, ids in ((0, a), (1, b)):
            for i, e in zip(ids, ends[side]):
                groups[next(k for k, c in enumerate(common) if c >= e)][side].append(i)
        docs.append((d, (len(a), len(b), groups)))
        held.update({(x, y) for p, q in groups for x in p for y in q})
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for d, found in docs:
        if found is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        na, nb, groups = found
        links = [(x, y) for p, q in groups for x in p for y in q]
        spelled = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((d, na, nb, len(groups), len(links), sum(held[k] == best[k[0]] for k in links), sum(held[k] for k in links), sha(spelled)))
    return Counter(out)


@pytest.mark.parametrize("options", [{}, {"piece": 40, "span": 16, "fan": 8, "cache": 64}, {"piece": 150, "span": 2, "fan": 30, "cache": 0}])
def test_alignment_equals_plain_version(spark, options):
    rows = [r for r in many_rows() if len(r[1] or "") < 400][:30] + many_rows()[-14:]
    out = alignment.align(documents(spark, rows), A, B, **options).collect()
    assert counted(out) == plain_alignment(rows)


def test_fragments_compose_associatively():
    rng = random.Random(4)
    for _ in range(40):
        n = rng.randint(1, 60)
        ends = [sorted(rng.sample(range(1, n), rng.randint(0, n - 1))) + [n] for _ in range(2)]
        ids = [[rng.randrange(9) for _ in e] for e in ends]
        cuts = sorted({0, n, *(rng.randint(0, n) for _ in range(5))})
        parts = []
        for lo, hi in zip(cuts, cuts[1:]):
            x, y = ([i for i, e in enumerate(es) if lo < e <= hi] for es in ends)
            parts.append(alignment.fragment([ids[0][i] for i in x], [ends[0][i] for i in x], [ids[1][i] for i in y], [ends[1][i] for i in y], 9))
        left = alignment.EMPTY
        for p in parts:
            left = alignment.compose(left, p)
        right = alignment.EMPTY
        for p in reversed(parts):
            right = alignment.compose(p, right)
        whole = alignment.fragment(ids[0], ends[0], ids[1], ends[1], 9)
        assert left == right == whole


def test_wide_groups_are_counted_by_distinct_ids():
    a, b = np.tile([1, 2], 100), np.tile([3, 4, 5], 100)
    g = alignment.Groups(a, np.append(np.arange(1, 200) * 2, 600), b, np.append(np.arange(1, 300) * 2 - 1, 600))
    _, pair, links = g.links(0, len(g.common))
    got = Counter()
    for p, n in zip(pair.tolist(), links.tolist()):
        got[divmod(p, alignment.PAIR)] += n
    assert sum(got.values()) == int((g.na * g.nb).sum()) and len(g.common) == 1 and len(pair) == 6
    assert got[1, 3] == 100 * 100


def test_alignment_of_empty_table_and_ids(spark):
    assert alignment.align(documents(spark, []), A, B).collect() == []
    out = alignment.align(documents(spark, [(None, "a b"), (1, None), (1, ""), (1, "a b")]), A, B).collect()
    assert sorted(((r.doc_id, r.n_a, r.groups_sha256 != "") for r in out), key=str) == sorted([(None, 2, True), (1, 0, False), (1, 0, False), (1, 2, True)], key=str)
