"""Plain Python versions of results, and checks on them, that several test modules use."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def brute(rows, words, share, of):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and of * len(a & sets[j]) >= share * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least[find(i)].append(doc)
    known = {k: min((d for d in v if d is not None), default=None) for k, v in least.items()}
    return sorted(((doc, len(sets[i]), known[find(i)]) for i, (doc, _) in enumerate(rows)), key=str), len(least)


def check_pieces(rows, ids_of, tiers, documents):
    """Every id in exactly one piece, offsets without gaps, at most one padded sequence."""
    by_sequence, by_document = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        by_document[r.doc_id].append(r)
    for doc_id, copies in documents.items():
        expected = Counter()
        for text in copies:
            expected[tuple(ids_of(text) + [1])] += 1
        starts = Counter((r.start, r.doc_tokens) for r in by_document[doc_id])
        assert sum(r.length for r in by_document[doc_id]) == sum(len(k) * n for k, n in expected.items())
        for ids, n in expected.items():
            array = np.array(ids, "<u4")
            fits = [r for r in by_document[doc_id] if r.doc_tokens == len(ids) and zlib.crc32(array[r.start : r.start + r.length].tobytes()) == r.ids_crc32]
            assert sum(r.length for r in fits) == n * len(ids)
        assert sum(starts.values()) == len(by_document[doc_id])
    short = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= tiers[-1] and len({r.tier for r in pieces}) == 1
        short += at not in tiers
    return short
