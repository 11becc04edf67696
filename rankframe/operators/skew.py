"""Left lookups that survive hot keys.

A lookup is a left join against a table that holds one row per key.  Its values may be wide,
so they are neither sorted nor aggregated: repeated keys are found by counting the keys
alone, and only their rows are reduced.  Rows with a hot key are served from a broadcast of
the few hot entries and spread evenly over the shuffle that finds the others.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankframe.session import materialize

# A lookup table up to this size is sent to every executor instead of being shuffled.
BROADCAST_BYTES = 64 << 20
# What a key takes in a broadcast, in a hash relation.
KEY_BYTES = 128


def hot_keys(df: DataFrame, keys: Sequence[str], parts: int, weight: str | None = None) -> DataFrame:
    """Keys holding more than 1/``parts`` of the rows, each counted ``weight`` times if given.

    Fewer than ``parts`` keys can, whatever the data, so the result may be broadcast.
    """
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.groupBy(*keys).agg(rows.alias("_rows"))
    total = df.agg(rows).scalar()
    return counts.filter(F.col("_rows") * F.lit(parts).cast("long") > total).select(*keys)


def narrow_columns(df: DataFrame) -> list[str]:
    """Columns that are cheap to hash for spreading rows: all but arrays and maps."""
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType))]


def one_row_per_key(table: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``table`` with the smallest value of each key; rows of a key that occurs once pass as they are.

    The repeated keys are stored.  While their number allows, they are broadcast, so that no value
    of a key that occurs once is shuffled to learn that.
    """
    keys = list(keys)
    counts = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    repeated = materialize(counts.filter("_rows > 1").select(*keys))
    if repeated.isEmpty():
        return table.select(*keys, value)
    if fits_broadcast(repeated, KEY_BYTES):
        repeated = F.broadcast(repeated)
    reduced = table.join(repeated, keys, "left_semi").groupBy(*keys).agg(F.min(value).alias(value))
    return table.join(repeated, keys, "left_anti").select(*keys, value).unionByName(reduced)


def fits_broadcast(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``df``, a stored table, has at most ``limit / row_bytes`` rows."""
    return df.count() <= limit // max(row_bytes, 1)


def _stand_in(row_hash: Column, kind: T.DataType) -> Column | None:
    """A key of type ``kind`` made from a row hash, or ``None`` if there is no simple one."""
    if isinstance(kind, T.LongType):
        return row_hash
    if isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
        most = {T.IntegerType: 2**31 - 1, T.ShortType: 2**15 - 1, T.ByteType: 2**7 - 1}[type(kind)]
        return F.pmod(row_hash, F.lit(most).cast("long")).cast(kind)
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(F.pmod(row_hash, F.lit(1_000_000).cast("long")).cast("int"))
    if isinstance(kind, T.DecimalType):
        digits = kind.precision - kind.scale
        return F.pmod(row_hash, F.lit(10 ** min(digits, 18)).cast("long")).cast(kind) if digits else None
    if isinstance(kind, T.BinaryType):
        return F.encode(row_hash.cast("string"), "UTF-8")
    if isinstance(kind, T.StringType):
        return row_hash.cast("string")
    return None


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    small: bool,
    unique: bool = False,
    parts: int | None = None,
    row_bytes: int = 64,
    hash_columns: Sequence[str] | None = None,
    count_on: DataFrame | None = None,
    weight: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """``left`` plus column ``value`` of ``right``, null where the key is unknown.

    Every left row comes out exactly once: a key that occurs more than once in ``right`` is
    reduced to its smallest value, unless the caller knows that keys are ``unique``.  ``small``
    says that the caller has checked the size of ``right``, whose rows take ``row_bytes``.  Key
    counts are taken from ``count_on``, which has the keys of ``left`` but may be cheaper to
    compute, or else from ``left``; a stored table is cheapest.  Where its rows stand for
    several of ``left`` each, ``weight`` names the column that says for how many.  ``buckets``
    says that ``right`` is stored in so many hash buckets of ``keys``, in this order: ``left``
    is then sent to these, and ``right`` is not shuffled.
    """
    keys, names = list(keys), left.columns
    right = right.select(*keys, value).dropna(subset=keys)
    if not unique:
        right = one_row_per_key(right, keys, value)
    if small:
        return left.join(F.broadcast(right), keys, "left").select(*names, value)

    if parts is None:
        # a hot key exceeds a shuffle partition; fewer than `parts` keys can, so their entries
        # stay below BROADCAST_BYTES
        shuffle_parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = max(1, min(shuffle_parts, BROADCAST_BYTES // max(row_bytes, 1)))
    counted = (count_on or left).select(*keys, *([weight] if weight else [])).dropna(subset=keys)
    hot = hot_keys(counted, keys, parts, weight)
    hot_values = right.join(F.broadcast(hot), keys, "left_semi").withColumnRenamed(value, "_hot_value")
    hot = hot.join(hot_values, keys, "left").withColumn("_hot", F.lit(True))

    # The rest goes through the shuffle.  Rows that need nothing from there, because their key
    # is hot or null, take a key made from the row instead and so land anywhere.  Equal rows
    # make equal keys on every attempt of a task, so a rerun cannot lose rows, and `_open`
    # keeps a made-up key from matching.
    row_hash = F.xxhash64(*(hash_columns or narrow_columns(left) or names))
    is_open = reduce(and_, [F.col(k).isNotNull() for k in keys]) & F.col("_hot").isNull()
    probes, spread = {}, False
    for k in keys:
        other = None if spread else _stand_in(row_hash, left.schema[k].dataType)
        spread = spread or other is not None
        own = F.col(k)
        probes[f"_probe_{k}"] = own if other is None else F.when(F.col("_open"), own).otherwise(other)
    probing = (
        left.join(F.broadcast(hot), keys, "left").withColumn("_open", is_open).withColumns(probes)
    )
    if buckets is not None:
        for k in keys:
            if left.schema[k].dataType != right.schema[k].dataType:
                raise ValueError(f"{k} must be {right.schema[k].dataType.simpleString()}, as it is stored")
        probing = probing.repartition(buckets, *[f"_probe_{k}" for k in keys])
    entries = right.select(*[F.col(k).alias(f"_entry_{k}") for k in keys], F.col(value).alias("_cold_value"))
    matches = reduce(and_, [F.col(f"_probe_{k}") == F.col(f"_entry_{k}") for k in keys])
    found = probing.join(entries, matches & F.col("_open"), "left")
    return found.select(*names, F.coalesce("_hot_value", "_cold_value").alias(value))
