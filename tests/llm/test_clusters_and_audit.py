from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
from rankframe.llm import bit_planes, filter_audit


def plain_clusters(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in start[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(centroids)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    inertia = Counter()
    for _, j, d in found:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), digest[j]) for i, j, d in found), key=str)


def clusters_of(spark, rows, **config):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return sorted(map(tuple, bit_planes.cluster_vectors(frame, bit_planes.ClusterConfig(**config)).drop("centroid").collect()), key=str)


def as_floats(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def test_planes_give_exact_products():
    rng = np.random.default_rng(2)
    for low, high in [(-300, 300), (0, 0), (-1, 0), (0, 5), (-(1 << 27), 1 << 27), (-8, 7)]:
        values = rng.integers(low, high + 1, (50, 64))
        values[0], values[1] = low, high
        digits = bit_planes.digits_for(low, high)
        planes = bit_planes.pack_planes(values, digits)
        assert (bit_planes.norms(planes) == (values * values).sum(axis=1)).all()
        for k in range(3):
            assert (bit_planes.dot_products(planes, planes[k]) == values @ values[k]).all()
        assert (bit_planes.plane_sums(planes) == values.sum(axis=0)).all()
    assert [bit_planes.digits_for(-8, 7), bit_planes.digits_for(-9, 7), bit_planes.digits_for(0, 8), bit_planes.digits_for(0, 0)] == [4, 5, 5, 1]


def test_clusters_match_plain_python(spark):
    rng = random.Random(3)
    centres = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(centres)]) for i in range(200)]
    rows += [(i, rows[7][1]) for i in range(500, 560)] + [(7, rows[7][1])] * 3  # one vector many times
    assert clusters_of(spark, as_floats(rows)) == plain_clusters(as_floats(rows))


def test_awkward_vectors(spark):
    one, zero = [1.0] * 64, [0.0] * 64
    rows = as_floats(
        [(1, one), (2, None), (3, []), (4, [1.0] * 63), (5, [1.0] * 65), (6, [1.0] * 63 + [None]), (7, [float("nan")] + one[1:]), (8, one[1:] + [float("inf")])]
        + [(9, zero), (9, zero), (None, one), (None, [-0.25] * 64), (10, [-0.0001] * 64)]
    )
    assert clusters_of(spark, rows) == plain_clusters(rows)
    assert clusters_of(spark, rows, centroids=2) == plain_clusters(rows, k=2)
    assert clusters_of(spark, []) == [] and clusters_of(spark, rows[1:3]) == []
    # beyond the limit: held to it, no overflow
    huge = clusters_of(spark, as_floats([(1, [3e38] * 64), (2, [-3e38] * 64)] * 40), centroids=1)
    assert {d for _, _, d, *_ in huge} == {64 * (1 << 54)} and {r[4] for r in huge} == {(1 << 63) - 1}
    clashing = spark.createDataFrame([(1, one, "x", "y", "z")], "vec_id long, embedding array<float>, cluster string, ints string, planes string")
    assert [tuple(r)[:3] for r in bit_planes.cluster_vectors(clashing).collect()] == [(1, 0, 0)]


def plain_audit(documents, labels):
    firsts = {}
    for doc, text, _ in documents:
        if doc is not None:
            firsts[text or ""] = min(firsts.get(text or "", doc), doc)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = []
    for doc, text, lang in documents:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc is not None and text in firsts and doc > firsts[text],
        }
        rows.append((lang or "", fails, doc in good, doc in toxic))
    out = []
    for part in {r[0] for r in rows}:
        own, total = [r for r in rows if r[0] == part], Counter()
        found = []
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                fails = [r for r in own if r[1][f]]
                only = sum(sum(r[1].values()) == 1 for r in fails)
                total[f] += len(gone)
                found.append((part, order, step + 1, len(left), len(gone), len(fails) - len(gone), only, sum(r[2] for r in gone), sum(r[3] for r in gone)))
        out += [(*r, total[r[1][r[2] - 1]]) for r in found]
    return sorted(out)


def test_audit_matches_plain_python(spark):
    rng = random.Random(4)
    documents = []
    for i in range(150):
        w = rng.choices([f"w{k}" for k in range(rng.choice([20, 900]))], k=rng.choice([5, 150, 199, 200, 400]))
        text = " ".join(w) + rng.choice(["", "", " $", " A B C D E F G " * 9, " |"])
        documents.append((i, text, rng.choice(["en", "de", "", None])))
    documents += [(1000 + i, documents[rng.randrange(9)][1], rng.choice(["en", "fr"])) for i in range(60)]
    documents += [(None, documents[0][1], "en"), (5, documents[5][1], "en"), (2000, None, "en"), (2001, "", "de"), (2002, None, None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 1060, 3)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    frame = spark.createDataFrame(documents, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.audit_filters(frame, marks)
    assert sorted(map(tuple, found.collect())) == plain_audit(documents, labels)
    assert all(r.kept >= 0 and r.removed >= 0 and r.redundant >= 0 for r in found.collect())


def test_audit_of_awkward_documents(spark, awkward, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int, part string, mask string")
    rows = [(r.doc_id, r.text, r.lang) for r in awkward.collect()]
    assert sorted(map(tuple, filter_audit.audit_filters(awkward, labels).collect())) == plain_audit(rows, [])
    assert filter_audit.audit_filters(nothing, labels).count() == 0


def test_potential_differences_are_shapley_values(spark):
    """Potentials against the average over all orders, for a game with made-up masks."""
    masks = [(rng.randrange(32), 1, 0) for rng in [random.Random(9)] for _ in range(40)]
    frame = spark.createDataFrame([("p", *m) for m in masks], "part string, mask int, good int, toxic int")
    row = filter_audit.with_potentials(filter_audit.coalition_values(frame)).first()
    v = [sum(bool(m & s) for m, _, _ in masks) for s in range(32)]
    assert list(row.v_all) == v and row.n == 40
    for i in range(5):
        total = 0
        for order in itertools.permutations(range(5)):
            before = sum(1 << j for j in order[: order.index(i)])
            total += v[before | 1 << i] - v[before]
        assert row.potential[31] - 5 * row.potential[31 & ~(1 << i)] == total


