from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from plain_versions import check_pieces
from rankframe.llm import lengths, packing
from rankframe.llm.tokens import Vocabulary, encoder
from tokenizers import Tokenizer

VOCABULARY = Vocabulary.public()


@pytest.fixture(scope="module")
def exact():
    tokenizer = Tokenizer.from_file(VOCABULARY.path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_both_encoders_agree(exact):
    rng, encode = random.Random(3), encoder(VOCABULARY).encode
    signs = [chr(c) for c in range(256)] * 3 + list("  \n\n\t'sdlln't 12 ") + ["漢", "🙂", " ", "é", "<|endoftext|>"]
    for n in [1, 2, 3, 5, 20, 200] * 300:
        text = "".join(rng.choices(signs[:770], k=n)) if n % 2 else "".join(rng.choices(signs, k=n))
        assert encode(text).tolist() == exact(text)


def test_pieces_of_awkward_documents(awkward, exact):
    documents = defaultdict(list)
    for r in awkward.collect():
        documents[r.doc_id].append(r.text)
    config = packing.PackingConfig(block_tokens=3000, step_tokens=4096)
    rows = packing.pack_documents(awkward, config).collect()
    assert check_pieces(rows, exact, config.tiers, documents) <= 1
    groups = defaultdict(Counter)
    for tier, group in {r.sequence_id: (r.tier, r.step_group) for r in rows}.values():
        groups[tier][group] += 1
    n_groups = len({r.step_group for r in rows})
    assert n_groups > 10
    for counts in groups.values():
        assert max(counts.values()) - min(counts.values() if len(counts) == n_groups else [0]) <= 1


def test_many_partitions_share_one_padded_sequence(spark, exact):
    rng = random.Random(5)
    documents = {i: [" ".join(rng.choices(["alpha", "beta", "gamma delta"], k=rng.randrange(900)))] for i in range(120)}
    df = spark.createDataFrame([(i, t[0]) for i, t in documents.items()], "doc_id long, text string").repartition(7)
    config = packing.PackingConfig()
    rows = packing.pack_documents(df, config).collect()
    assert check_pieces(rows, exact, config.tiers, documents) <= 1
    assert len({r.tier for r in rows}) > 1  # several context sizes are in use


def test_pieces_hold_all_ids(spark, exact):
    """Texts come back from the pieces, also of repeated and null document ids."""
    texts = ["one two three " * n for n in (1, 40, 700, 2500)] + [None, "", "漢字 🙂"]
    df = spark.createDataFrame([(d, t) for d in (None, 7) for t in texts], "doc_id long, text string").repartition(3)
    found = Counter()
    for r in packing.pack_documents(df, packing.PackingConfig(block_tokens=3000)).collect():
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        found.update((r.doc_id, r.doc_tokens, r.start + i, int(x)) for i, x in enumerate(ids))
    expected = Counter((d, len(ids), i, x) for d in (None, 7) for t in texts for ids in [exact(t or "") + [1]] for i, x in enumerate(ids))
    assert found == expected


def test_gaps_take_whole_pieces_first():
    pool = packing._Pool()
    for n in (7, 3, 2, 1):
        pool.add(packing._Segment(n, 0, np.arange(n, dtype="<u4"), n))
    windows = [(tier, [len(s.ids) for s in segments]) for tier, segments in packing.pack_windows(pool, (2, 4, 8))]
    assert windows == [(8, [7, 1]), (4, [3, 1]), (8, [1])]


def test_nothing_to_pack(nothing):
    assert packing.pack_documents(nothing).count() == 0


def test_length_answers(awkward, nothing, exact):
    histogram = lengths.length_histogram(awkward)
    sizes = [len(exact(r.text)) for r in awkward.collect()]
    assert {r.n_tokens: r.n_docs for r in histogram.collect()} == Counter(sizes)
    limits = lengths.context_limits(histogram, block=4)
    for r in limits.collect():
        over = [s for s in sizes if s > r.n_tokens]
        assert (r.n_docs_over, r.tokens_over) == (len(over), sum(over))
        assert r.tokens_kept == sum(min(s, r.n_tokens) for s in sizes)
        assert r.tokens_kept + r.tokens_lost == sum(sizes)
    quantiles = {r.share: r.n_tokens for r in lengths.length_quantiles(limits, [0.5, 1.0]).collect()}
    assert quantiles == {0.5: sorted(sizes)[(len(sizes) + 1) // 2 - 1], 1.0: max(sizes)}
    assert lengths.context_limits(lengths.length_histogram(nothing)).count() == 0
