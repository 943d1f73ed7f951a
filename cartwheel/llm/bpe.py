"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A piece (one match of the split pattern) starts as single bytes.  Leaf ``i`` of the tree holds the
rank of the pair that starts at byte ``i``; a node holds the least (rank, position) below it, so the
root names the leftmost pair of minimum rank.  A merge changes the leaves of the merged pair, of its right part
and of its live left neighbour: at most three point updates of logarithmic cost.

``encode_piece`` does this for one piece; ``encode_many`` for thousands of short ones at once, a merge of each per
round, with the trees as the rows of one numpy array.

Pieces repeat heavily in prose, so each Python worker keeps a memo from piece to ids.  It is emptied
when it holds ``memo`` pieces, which bounds its memory and never changes a result.

Null and empty texts have no ids.  Repeated rows give repeated results, an empty table none; columns other
than the id and the text are not read.  Text rows are independent: no shuffle, no hot keys.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, slices

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
NO_PAIR = 1 << 62


@lru_cache(maxsize=2)
def load_ranks(path: str) -> tuple[dict[bytes, int], list[bytes], int]:
    """token -> rank, the tokens by rank and the length of the longest of a rank file."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return ranks, tokens, max(map(len, ranks))


def encode_piece(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """Ids of one piece; a piece that is a token itself is that token."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    size = 1 << max(0, (n - 2).bit_length())
    tree = [NO_PAIR] * (2 * size)
    get = ranks.get
    for i in range(n - 1):
        r = get(piece[i:i + 2])
        if r is not None:
            tree[size + i] = r << 32 | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    end = list(range(1, n + 1))        # where the part that starts here ends
    before = list(range(-1, n - 1))    # the live part to the left

    while tree[1] != NO_PAIR:
        i = tree[1] & 0xFFFFFFFF
        gone = end[i]
        stop = end[i] = end[gone]
        if stop < n:
            before[stop] = i
        # new values of at most three leaves: the right part's, the merged part's, its left neighbour's
        c = size + gone if gone < n - 1 else size + i
        tree[c] = NO_PAIR
        r = get(piece[i:end[stop]]) if stop < n and end[stop] - i <= longest else None
        b = size + i
        tree[b] = NO_PAIR if r is None else r << 32 | i
        left = before[i]
        if left >= 0:
            r = get(piece[left:stop]) if stop - left <= longest else None
            a = size + left
            tree[a] = NO_PAIR if r is None else r << 32 | left
        else:
            a = b
        # and of their ancestors, each once (a <= b <= c at every level)
        while a > 1 or c > 1:
            a >>= 1
            b >>= 1
            c >>= 1
            x, y = tree[2 * a], tree[2 * a + 1]
            tree[a] = x if x < y else y
            if b != a:
                x, y = tree[2 * b], tree[2 * b + 1]
                tree[b] = x if x < y else y
            if c != b:
                x, y = tree[2 * c], tree[2 * c + 1]
                tree[c] = x if x < y else y
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return ids


@lru_cache(maxsize=2)
def load_pairs(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of tokens (left << 32 | right, sorted) whose bytes together are a token, that token's rank, and the byte tokens."""
    ranks, _, _ = load_ranks(path)
    pairs = [(ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
             if t[:i] in ranks and t[i:] in ranks]
    pairs.sort()
    return (np.array([k for k, _ in pairs], np.int64), np.array([r for _, r in pairs], np.int64),
            np.array([ranks[bytes([b])] for b in range(256)], np.int64))


def encode_many(pieces: list[bytes], path: str, longest: int = 64) -> list[tuple]:
    """Ids of pieces.  Short ones with trees of one size are worked on together; those over ``longest`` bytes one by one."""
    ranks, _, widest = load_ranks(path)
    out: list = [None] * len(pieces)
    groups: dict[int, list[int]] = {}
    for at, piece in enumerate(pieces):
        if piece in ranks:
            out[at] = (ranks[piece],)
        elif len(piece) > longest:
            out[at] = tuple(encode_piece(piece, ranks, widest))
        else:
            groups.setdefault(max(1, len(piece) - 2).bit_length() if len(piece) > 2 else 0, []).append(at)
    for height, members in groups.items():
        for at in range(0, len(members), 8192):
            part = members[at:at + 8192]
            for to, ids in zip(part, _encode_group([pieces[i] for i in part], 1 << height, path)):
                out[to] = ids
    return out


def _encode_group(pieces: list[bytes], size: int, path: str) -> list[tuple]:
    """Pieces of at most size + 1 bytes, by trees of ``size`` leaves."""
    keys, found, single = load_pairs(path)
    m, width = len(pieces), size + 1
    n = np.array([len(p) for p in pieces], np.int64)
    data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(m, width)
    token = single[data]
    place = np.arange(width, dtype=np.int64)
    live = place < n[:, None]
    end = np.broadcast_to(place + 1, (m, width)).copy()
    before = np.broadcast_to(place - 1, (m, width)).copy()

    def pair(left, right, at, ok):
        """The leaf of a pair of tokens at a place; NO_PAIR where they are none or ``ok`` is not."""
        key = left << 32 | right
        i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(ok & (keys[i] == key), found[i] << 32 | at, NO_PAIR)

    tree = np.full((m, 2 * size), NO_PAIR, np.int64)
    tree[:, size:] = pair(token[:, :-1], token[:, 1:], place[:-1], live[:, 1:])
    level = size
    while level > 1:
        level >>= 1
        tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
    while True:
        rows = np.flatnonzero(tree[:, 1] != NO_PAIR)
        if not len(rows):
            break
        root = tree[rows, 1]
        i, rank = root & 0xFFFFFFFF, root >> 32
        gone = end[rows, i]
        stop = end[rows, gone]
        end[rows, i], token[rows, i], live[rows, gone] = stop, rank, False
        more = stop < n[rows]
        right = np.where(more, stop, 0)
        before[rows[more], right[more]] = i[more]
        left = before[rows, i]
        some = left >= 0
        left = np.where(some, left, i)
        # new leaves: the right part's, the merged part's, its left neighbour's; then their ancestors, level by level
        c, b, a = size + np.where(gone < size, gone, i), size + i, size + left
        tree[rows, c] = NO_PAIR
        tree[rows, b] = pair(rank, token[rows, right], i, more)
        tree[rows[some], a[some]] = pair(token[rows, left], rank, left, some)[some]
        for _ in range(size.bit_length() - 1):
            for x in (a, b, c):
                x >>= 1
                tree[rows, x] = np.minimum(tree[rows, 2 * x], tree[rows, 2 * x + 1])
    ids, cut = token[live].tolist(), np.cumsum(live.sum(axis=1)).tolist()
    return [tuple(ids[i:j]) for i, j in zip([0, *cut], cut)]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str, memo: int = 600_000):
    """(texts -> for each the (ids, their decimal text) by piece, ids -> bytes)."""
    import regex
    _, tokens, _ = load_ranks(path)
    find, known = regex.compile(pattern).findall, {}

    def encode(texts: list[str]) -> list[list[tuple]]:
        if len(known) >= memo:
            known.clear()
        split = list(map(find, texts))
        got = [list(map(known.get, pieces)) for pieces in split]
        gaps = [i for i, g in enumerate(got) if None in g]
        new = list({p for i in gaps for p, g in zip(split[i], got[i]) if g is None})
        fresh = {p: (ids, ",".join(map(str, ids))) for p, ids in zip(new, encode_many([p.encode("utf-8") for p in new], path))}
        for i in gaps:
            got[i] = [g or fresh[p] for p, g in zip(split[i], got[i])]
        known.update((p, ids) for p, ids in fresh.items() if len(p) <= 256)
        return got

    def decode(ids) -> bytes:
        return b"".join(map(tokens.__getitem__, ids))

    return encode, decode


def encode_documents(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """Per document: number of ids, SHA-256 of the comma-joined ids and of the decoded bytes
    (``with_ids``: and the ids themselves)."""
    names = [c.split()[0] for c in SCHEMA.split(", ")] + ["ids"] * with_ids

    def task(batches):
        encode, decode = codec(ranks, pattern)
        for batch in slices(batches, 1 << 22):
            n, shown, back, all_ids = [], [], [], []
            for pieces in encode(batch.column(1).to_pylist()):
                ids = list(chain.from_iterable(map(itemgetter(0), pieces)))
                n.append(len(ids))
                shown.append(hashlib.sha256(",".join(map(itemgetter(1), pieces)).encode()).hexdigest())
                back.append(hashlib.sha256(decode(ids)).hexdigest())
                if with_ids:
                    all_ids.append(ids)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(shown, pa.string()), pa.array(back, pa.string())]
            columns += [pa.array(all_ids, pa.list_(pa.int64()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return id_text(docs, id_col, text_col).mapInArrow(task, SCHEMA + ", ids array<long>" * with_ids)


def decode_documents(encoded: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, ids) -> (doc_id, text); bytes that are no UTF-8 become U+FFFD, null ids the empty text."""
    def task(batches):
        _, tokens, _ = load_ranks(ranks)
        for batch in batches:
            texts = [b"".join(tokens[i] for i in ids or ()).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(task, "doc_id long, text string")
