"""Brute-force versions of the operators."""

import hashlib
from collections import defaultdict


def line_dedup(rows):
    """{doc_id: (text, n_lines, n_removed, n_runs)}"""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        if text is None:
            out[doc] = (None, 0, 0, 0)
            continue
        lines = text.split("\n")
        full = [i for i, x in enumerate(lines) if x.strip(" \t\r")]
        dead = set()
        for p, i in enumerate(full):
            if lines[i] in seen:
                dead.add(p)
            seen.add(lines[i])
        gone = {full[p] for p in dead}
        out[doc] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(full), len(dead),
                    sum(p - 1 not in dead for p in dead))
    return out


def substring_dedup(rows, length):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}"""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            piece = data[at:at + length]
            if piece in seen:
                gone[at:at + length] = b"\1" * length
            seen.add(piece)
        kept = bytes(x for x, g in zip(data, gone) if not g)
        runs = sum(1 for i in range(len(data)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[doc] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def fingerprint(text, shingle=3):
    import re

    import xxhash
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def groups(prints, max_bits=2):
    """{doc_id: smallest doc_id reachable} from {doc_id: fingerprint}"""
    parent = {d: d for d in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for d, f in prints.items():
        by[f].append(d)
    values = sorted(by)
    for i, a in enumerate(values):
        for b in values[i:]:
            if (a ^ b).bit_count() <= max_bits:
                for y in by[b]:
                    p, q = root(by[a][0]), root(y)
                    parent[max(p, q)] = min(p, q)
    return {d: root(d) for d in prints}
