from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
from rankframe.llm.decontaminate import ItemIndex, LeakConfig, drop_leaks, find_leaks, parts_of, shingles, terms_of


def items(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randrange(1, 60)))) for i in range(n)]


def bm25(index, texts, passage, c):
    """Scores of all items by the formula, as shares of their own."""
    n, mean = len(texts), sum(map(len, texts)) / len(texts)
    df = Counter(t for w in texts for t in set(w))
    out = []
    for w in texts:
        count = Counter(w)
        rare = [t for t in count if df[t] <= max(1, c.common_share * n)]
        used = rare if len(rare) >= 3 else list(count)
        impact = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * count[t] * (c.k1 + 1) / (count[t] + c.k1 * (1 - c.b + c.b * len(w) / mean)) for t in used}
        out.append(sum(x for t, x in impact.items() if t in passage) / sum(impact.values()))
    return out


def test_retrieval_is_exact():
    rng = random.Random(1)
    for config in (LeakConfig(), LeakConfig(threshold=0.3, block=3)):
        rows = items(7)
        index, texts = ItemIndex(rows, config), [terms_of(t) for _, t in rows]
        for _ in range(60):
            passages = [sorted({index.vocabulary[t] for i in rng.sample(range(120), 3) for t in texts[i][: rng.randrange(1, 50)] if t in index.vocabulary}) for _ in range(3)]
            terms = np.array([t for p in passages for t in p], np.int64)
            numbers = np.array([k for k, p in enumerate(passages) for _ in p], np.int64)
            found = {(p, i): s for p, i, s in index.retrieve(terms, numbers)}
            names = {k: t for t, k in index.vocabulary.items()}
            for k, p in enumerate(passages):
                for i, score in enumerate(bm25(index, texts, {names[t] for t in p}, config)):
                    assert ((k, i) in found) == (score >= config.threshold - 1e-9)
                    if (k, i) in found:
                        assert abs(found[k, i] - score) < 1e-9


def test_whole_items_are_found_anywhere(spark):
    rng, rows = random.Random(3), [(i, t) for i, t in items(9) if len(t.split()) >= 12]
    filler = lambda n: " ".join(f"f{rng.randrange(5000)}" for _ in range(n))
    docs, planted = [], set()
    for k in range(150):
        if k % 2:
            item, text = rng.choice(rows)
            docs.append((k, f"{filler(rng.randrange(300))} {text.upper()}, {filler(rng.randrange(300))}"))
            planted.add((k, item))
        else:
            docs.append((k, filler(200)))
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(rows, "item_id long, text string")
    for config in (LeakConfig(), LeakConfig(index_bytes=2000)):
        found = find_leaks(frame, bench, config).collect()
        assert planted <= {(r.doc_id, r.item_id) for r in found}
        assert {r.doc_id for r in found} == {d for d, _ in planted}
        assert {r.doc_id for r in drop_leaks(frame, bench, config).collect()} == {d for d, _ in docs} - {d for d, _ in planted}


def test_long_items_are_found_by_parts(spark):
    text = " ".join(f"t{i}" for i in range(900))
    docs = [(1, f"before {text} after"), (2, " ".join(text.split()[300:560])), (3, " ".join(text.split()[:40]))]
    found = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(5, text)], "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(1, 5), (2, 5)]


def test_awkward_documents(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, "a text without an id, twice"), (2, None), (None, ""), (3, "!!"), (4, "one two three four " * 20)], "item_id long, text string")
    found = find_leaks(awkward, bench).collect()
    assert sorted(((r.doc_id, r.item_id) for r in found), key=str) == [(6, 4), (None, 1), (None, 1)]
    left = drop_leaks(awkward, bench)
    assert left.columns == awkward.columns and left.count() == awkward.count() - 3
    assert find_leaks(nothing, bench).count() == 0 and find_leaks(awkward, bench.limit(0)).count() == 0
    assert drop_leaks(awkward, bench.where("item_id = 3")).count() == awkward.count()
    assert shingles(["a"]) == {("a",)}


def test_short_items_are_found_inside_long_texts(spark):
    rng = random.Random(8)
    filler = lambda n: " ".join(f"f{rng.randrange(900)}" for _ in range(n))
    short = [(0, "Who wrote Hamlet?"), (1, "zebra"), (2, "blue green"), (3, "one small step here"), (4, "exactly five words are here")]
    rows = short + [(10 + i, filler(30)) for i in range(20)]
    docs = [(k, f"{filler(200)} {text.lower()} {filler(150)}") for k, (_, text) in enumerate(short)]
    docs += [(20, f"{filler(100)} who has written hamlet {filler(90)}"), (21, f"green blue {filler(100)} step one small here"), (22, "zebra"), (23, filler(300))]
    found = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(rows, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (22, 1)]


def test_scores_do_not_depend_on_how_items_are_split(spark):
    rows = items(21, 200)
    rng = random.Random(2)
    docs = []
    for k in range(120):
        words = rng.choice(rows)[1].split()
        cut = rng.randrange(len(words) // 2 + 1)
        docs.append((k, " ".join(words[cut:]) + " " + " ".join(rng.choice(rows)[1].split()[:8])))
    docs, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(rows, "item_id long, text string")
    whole, split = (sorted(map(tuple, find_leaks(docs, bench, LeakConfig(index_bytes=size)).collect())) for size in (1 << 25, 3000))
    assert [r[:2] for r in whole] == [r[:2] for r in split] and len(whole) > 100
    assert np.allclose([r[2:] for r in whole], [r[2:] for r in split], rtol=1e-12)


def test_long_items_have_no_short_part():
    parts = parts_of(" ".join(f"t{i}" for i in range(257)), LeakConfig())
    assert [len(p) for p in parts] == [128, 129] and sum(parts, []) == [f"t{i}" for i in range(257)]
    assert parts_of("", LeakConfig()) == [] and parts_of(None, LeakConfig()) == []
