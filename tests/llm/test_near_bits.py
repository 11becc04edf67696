from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from rankframe.llm import simhash
from rankframe.llm.components import components


def brute_fingerprint(text, words=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] if len(w) >= words else ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=3):
    """The smallest position that links lead to, for every position."""
    values = np.array(prints, np.uint64)
    label = np.arange(len(values))
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= distance
    while True:
        heard = np.where(close, label[None, :], len(label)).min(axis=1)
        if (heard == label).all():
            return label.tolist()
        label = heard


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def connected(spark, prints, config):
    """Fingerprints that the edges connect, as sets, and the edges."""
    frame = spark.createDataFrame([(signed(x),) for x in set(prints)], "fp long")
    edges = simhash.connecting_edges(frame, config)
    found = {}
    for r in components(edges).collect():
        found.setdefault(r.component, set()).add(r.node)
    return {frozenset(s) for s in found.values()}, edges


def expected_sets(prints):
    prints = sorted(set(prints))
    found = {}
    for x, k in zip(prints, brute_components(prints)):
        found.setdefault(k, set()).add(signed(x))
    return {frozenset(s) for s in found.values() if len(s) > 1}


def scattered(seed, centres, near, bits):
    """Fingerprints with up to ``bits`` changed bits around centres, and far ones."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(50)] + [0, (1 << 64) - 1]
    for _ in range(centres):
        centre = rng.getrandbits(64)
        out += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, bits + 1))) for _ in range(near)]
    return out


@pytest.mark.parametrize("short_list", [64, 3, 0])
def test_edges_connect_what_links_connect(spark, short_list):
    prints = scattered(short_list, centres=4, near=60, bits=7)
    found, edges = connected(spark, prints, simhash.SimhashConfig(short_list=short_list))
    assert found == expected_sets(prints) and found
    for r in edges.collect():
        assert 0 < bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 3


def test_each_way_two_fingerprints_can_differ(spark):
    """Every split of up to four bits over the halves, bit 31, 32 and 63 included."""
    rng, prints = random.Random(1), []
    for lower, upper in [(0, 1), (1, 0), (1, 1), (0, 2), (2, 0), (0, 3), (1, 2), (2, 1), (3, 0), (2, 2), (1, 3), (0, 4)]:
        for _ in range(3):
            base = rng.getrandbits(64)
            flips = rng.sample([0, 1, 15, 16, 30, 31], lower) + rng.sample([32, 33, 47, 48, 62, 63], upper)
            prints += [base, base ^ sum(1 << b for b in flips)]
    for short_list in (64, 1):
        found, _ = connected(spark, prints, simhash.SimhashConfig(short_list=short_list))
        assert found == expected_sets(prints) and len(found) == 9 * 3


def test_a_dense_family_stores_few_edges(spark):
    """A list gives a link per member to its leader, and the family is one component then, so
    each of k near copies has at most one edge per signature, 66, and not k."""
    for size in (300, 1900):
        rng = random.Random(size)
        centre = rng.getrandbits(64)
        prints = {centre ^ (1 << a) ^ (1 << b) for a, b in (rng.sample(range(64), 2) for _ in range(size))} | {centre}
        found, edges = connected(spark, prints, simhash.SimhashConfig())
        assert found == {frozenset(map(signed, prints))}
        assert edges.count() <= 66 * len(prints)


def test_documents_match_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdEFGH", k=4))
    texts = [None, "", " \n\t", "one", "One", "one two", "one two three", "ONE two three"]
    for size in (8, 40, 200, 800):
        base = [word() for _ in range(size)]
        for k in range(12):
            copy = list(base)
            for i in rng.sample(range(size), min(size, k // 3)):
                copy[i] = word()
            texts += [" ".join(copy)] * (1 + k % 2)
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts)]
    prints = [brute_fingerprint(t) for t in texts]
    label = brute_components(prints)
    least = {k: min((i for (i, _), other in zip(rows, label) if other == k and i is not None), default=None) for k in set(label)}
    expected = sorted(((i, f"{p:016x}", least[k]) for (i, _), p, k in zip(rows, prints, label)), key=str)
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, found.collect()), key=str) == expected
    assert len(set(label)) < len(set(prints))


def test_fingerprints_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(docs).collect()}
    assert found == {r.doc_id: f"{brute_fingerprint(r.text):016x}" for r in docs.collect()}


def test_awkward_documents(awkward, nothing):
    found = simhash.near_duplicates(awkward).collect()
    prints = [brute_fingerprint(r.text) for r in awkward.collect()]
    assert sorted(r.fingerprint for r in found) == sorted(f"{p:016x}" for p in prints)
    empty = [r for r in found if r.fingerprint == "0" * 16]
    assert {r.doc_id for r in empty} == {1, 2, 3} and {r.component_id for r in empty} == {1}
    assert simhash.near_duplicates(nothing).count() == 0


def test_majority_needs_more_than_half():
    assert simhash.majority_bits(np.array([1, 2], np.int64)) == 0
    assert simhash.majority_bits(np.array([3, 3, -1], np.int64)) == 3
    assert simhash.majority_bits(np.array([-1, -1, 0], np.int64), at_once=2) == -1
    with pytest.raises(ValueError):
        simhash.SimhashConfig(distance=4)


def test_shingles_keep_repeats(spark):
    frame = spark.createDataFrame([("a b a b a b",), ("A  b\tc",)], "text string")
    sizes = [len(r[0]) for r in frame.select(simhash.shingle_hashes(F.col("text"), 3)).collect()]
    assert sizes == [4, 1]
