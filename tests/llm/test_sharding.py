from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest
from rankframe.llm.sharding import ShardConfig, shard_documents


def check(rows, texts):
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in texts)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(8)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_id = dict(texts)
    for r in rows:
        raw = (by_id[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    spread = defaultdict(set)
    for r in rows:
        if by_id[r.doc_id] is not None:
            spread[by_id[r.doc_id]].add(r.shard)
    return spread


@pytest.mark.parametrize("config", [ShardConfig(), ShardConfig(priorities=64)])
def test_groups_stay_together_and_large_ones_split_little(spark, config):
    rng = random.Random(2)
    texts = [f"text {g}" for g in range(60) for _ in range(rng.randrange(2, 9))]
    texts += ["a hot text"] * 300 + [f"own {i}" for i in range(350)] + [None, None, ""]
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    spread = check(shard_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), config).collect(), docs)
    quota = len(docs) // 8
    assert len(spread.pop("a hot text")) <= -(-300 // quota) + 2
    split = [t for t, s in spread.items() if len(s) > 1]
    assert len(split) <= 3


def test_awkward_documents(awkward, nothing):
    texts = [(r.doc_id, r.text) for r in awkward.collect()]
    spread = check(shard_documents(awkward).collect(), texts)
    assert max(map(len, spread.values())) <= 2
    assert shard_documents(nothing).count() == 0


def test_only_copies(spark):
    docs = [(i, "all the same") for i in range(83)]
    check(shard_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)
