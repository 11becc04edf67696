from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankframe.functions.fingerprint import farm_fingerprint, fingerprints
from rankframe.functions.hashing import hash_mod
from rankframe.operators import sampling
from rankframe.spec import FeatureSpec, SampleConfig

# published values, signed; the first three from a warehouse's manual
PUBLISHED = {
    "1footrue": -1541654101129638711,
    "2applefalse": 2794438866806483259,
    "3true": -4880158226897771312,
    "test": 8581389452482819506,
    "test" * 8: -4196240717365766262,
    "test" * 64: 3500507768004279527,
}


def test_published_values():
    assert fingerprints(pa.array(list(PUBLISHED))).to_pylist() == list(PUBLISHED.values())


def test_published_chain_over_all_lengths():
    """3200 hashes of 0 to 3200 bytes, each of which changes the bytes that come after it."""
    mask, rounds = (1 << 64) - 1, 800
    data, n, h = bytearray(rounds * 4), 0, 0
    for i in range(rounds):
        for length in (lambda: i, lambda: i * i % n, lambda: i * i * i % n, lambda: n):
            h ^= fingerprints(pa.array([bytes(data[: length()])], pa.binary()))[0].as_py() & mask
            h = ((h ^ (h >> 41)) * 949921979) & mask
            data[n] = ord("a") + (h & 0xFFFFF) % 26
            n += 1
        x0, x1, x2, x3 = data[n - 1], data[n - 2], data[n - 3], data[n // 2]
        data[((x0 << 16) + (x1 << 8) + x2) % n] ^= x3
        data[((x1 << 16) + (x2 << 8) + x3) % n] ^= i % 256
    assert h == 0x7A1D67C50EC7E167  # the published end of this chain


def test_a_batch_hashes_like_its_texts_alone():
    rng = np.random.default_rng(5)
    texts = ["ä" * int(k) + "x" * int(r) for k, r in zip(rng.integers(0, 90, 300), rng.integers(0, 3, 300))]
    texts += ["", "y" * 64, "y" * 65, "y" * 128, "y" * 129, "z" * 5000]
    alone = [fingerprints(pa.array([t])).to_pylist()[0] for t in texts]
    assert fingerprints(pa.array(texts)).to_pylist() == alone
    assert fingerprints(pa.array(texts).slice(7, 50)).to_pylist() == alone[7:57]
    assert fingerprints(pa.array([None, *texts], pa.large_string())).to_pylist() == [None, *alone]
    assert fingerprints(pa.array([], pa.string())).to_pylist() == []


def test_as_a_column(spark):
    rows = spark.createDataFrame([(t,) for t in PUBLISHED] + [(None,), ("",)], "t string")
    got = {r[0]: (r[1], r[2]) for r in rows.select("t", farm_fingerprint(F.col("t")), hash_mod(F.col("t"), 100, "farm")).collect()}
    assert got.pop(None) == (None, None)
    assert got.pop("")[0] == 0x9AE16A3B2F90404F - (1 << 64)
    assert got == {t: (v, abs(v) % 100) for t, v in PUBLISHED.items()}
    assert spark.range(1).select(hash_mod(F.lit(7), 9, "farm") == hash_mod(F.lit("7"), 9, "farm")).head()[0]


def test_samples_are_those_of_the_warehouse(spark):
    """Users by the hash of their id, negatives by the hash of ``buyer|product|day``."""
    spec, cfg = FeatureSpec(), SampleConfig(stop_date="2026-03-08", hash_algo="farm")
    rows = spark.createDataFrame(
        [(t, 3 + i, "2026-03-01") for i, t in enumerate(PUBLISHED)], "b string, p long, d string"
    ).select(F.col("b").alias(spec.buyer), F.col("p").alias(spec.product), F.col("d").cast("date").alias(spec.day))
    kept = {r[0] for r in sampling.sample_users(rows, 52, spec, "farm").select(spec.buyer).collect()}
    assert kept == {t for t, v in PUBLISHED.items() if abs(v) % 100 < 52} and len(kept) not in (0, 6)
    hashes = [r[0] for r in rows.select(sampling.triple_hash(cfg, spec)).collect()]
    keys = pa.array([f"{t}|{3 + i}|2026-03-01" for i, t in enumerate(PUBLISHED)])
    assert hashes == [abs(v) % 1_000_000 for v in fingerprints(keys).to_pylist()]


@pytest.mark.parametrize("n", [1, 9_000_000_000_000])
def test_buckets_in_range(spark, n):
    got = [r[0] for r in spark.range(500).select(hash_mod(F.col("id"), n, "farm")).collect()]
    assert all(0 <= v < n for v in got) and len(set(got)) == min(n, 500)
