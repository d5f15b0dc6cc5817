"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def decontaminated(docs, items, window=10):
    """doc_id -> (n_words, n_hit, n_items, items_sha256)"""
    phrases = {}
    for item, text in items:
        words = BENCH_WORD.findall((text or "").translate(LOWER))
        for k in range(max(1, len(words) - window + 1) if words else 0):
            phrases.setdefault(tuple(words[k : k + window]), set()).add(str(item))
    sizes = sorted({len(p) for p in phrases})
    out = []
    for doc_id, text in docs:
        words = BENCH_WORD.findall((text or "").translate(LOWER))
        hit, own = set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                found = phrases.get(tuple(words[k : k + size]))
                if found:
                    own |= found
                    hit |= set(range(k, k + size))
        digest = hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(own), digest))
    return out


def near_duplicates(docs, percent=85):
    """doc_id -> (n_shingles, component_id), by comparing all pairs that share a shingle."""
    sets = {}
    for doc_id, text in docs:
        words = SPACE_WORD.findall((text or "").translate(LOWER))
        sets[doc_id] = {tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))} if words else set()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    holders = {}
    for d in ids:
        for s in sets[d]:
            holders.setdefault(s, []).append(d)
    shared = {}
    for own in holders.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                shared[a, b] = shared.get((a, b), 0) + 1
    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), root(d)) for d in ids}


def repeated_bytes(docs, size=200):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256)"""
    texts = {d: (t or "").encode() for d, t in docs}
    starts = {}
    for t in texts.values():
        for k in range(len(t) - size + 1):
            starts[t[k : k + size]] = starts.get(t[k : k + size], 0) + 1
    out = {}
    for d, t in texts.items():
        gone = bytearray(len(t))
        for k in range(len(t) - size + 1):
            if starts[t[k : k + size]] > 1:
                gone[k : k + size] = b"\x01" * size
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out[d] = (len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out
