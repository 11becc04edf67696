from __future__ import annotations

import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from rankframe.functions.hashing import (
    buyer_hash,
    concat_key,
    hash_mod,
    hashed_id,
    user_date_key,
)


@pytest.mark.parametrize("algo", ["xxhash64", "md5"])
def test_bucket_is_stable_in_range_and_null_safe(spark, algo):
    df = spark.createDataFrame([(f"u{i}",) for i in range(2000)] + [(None,)], "u string")
    got = [r[0] for r in df.select(hash_mod(F.col("u"), 100, algo)).collect()]
    assert got[-1] is None
    assert all(0 <= v < 100 for v in got[:-1])
    assert len(set(got[:-1])) == 100
    assert got == [r[0] for r in df.select(hash_mod(F.col("u"), 100, algo)).collect()]


def test_md5_bucket_is_the_leading_sixty_bits(spark):
    value = spark.range(1).select(hash_mod(F.lit("c17"), 1_000_000, "md5")).head()[0]
    assert value == int(hashlib.md5(b"c17").hexdigest()[:15], 16) % 1_000_000


@pytest.mark.parametrize("algo", ["xxhash64", "md5"])
def test_int_and_long_ids_hash_alike(spark, algo):
    row = (
        spark.range(1)
        .select(
            hash_mod(F.lit(7).cast("int"), 1000, algo), hash_mod(F.lit(7).cast("long"), 1000, algo)
        )
        .head()
    )
    assert row[0] == row[1]


def test_unknown_algorithm(spark):
    with pytest.raises(ValueError, match="algo"):
        hash_mod(F.lit("x"), 10, "crc")


def test_user_date_key(spark):
    day = datetime.date(2024, 1, 2)
    df = spark.createDataFrame(
        [(5, day), (None, day), (5, None), (None, None)], "h long, d date"
    )
    days = (day - datetime.date(1970, 1, 1)).days
    got = [r[0] for r in df.select(user_date_key(F.col("h"), F.col("d"))).collect()]
    assert got == [500_000 + days, days, 500_000, 0]


def test_user_date_key_fits_a_long(spark):
    key = user_date_key(F.lit(9_000_000_000_000 - 1), F.lit("2200-01-01").cast("date"))
    assert spark.range(1).select(key).head()[0] > 0


def test_different_days_and_buyers_get_different_keys(spark):
    df = spark.sql(
        "select concat('b', id % 100) as b, date_add(date'2024-01-01', cast(id / 100 as int)) as d "
        "from range(3000)"
    )
    keys = df.select(user_date_key(buyer_hash(F.col("b")), F.col("d")).alias("k"))
    assert keys.distinct().count() == 3000


def test_concat_key_is_null_if_any_part_is(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1)], "x string, y int")
    got = [r[0] for r in df.select(concat_key(F.col("x"), F.col("y"))).collect()]
    assert got == ["a|1", None, None]


def test_null_ids_share_one_nonzero_bucket(spark):
    df = spark.createDataFrame([(12345,), (67890,), (None,), (None,)], "shop long")
    got = [r[0] for r in df.select(hashed_id(F.col("shop"), 50_000)).collect()]
    assert got[2] == got[3]
    assert all(1 <= v <= 50_000 for v in got)
