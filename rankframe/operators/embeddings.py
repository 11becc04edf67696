"""Embedding selection, point-in-time join and lookups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankframe.functions.hashing import buyer_hash, user_date_key
from rankframe.functions.vectors import clean_vector, expand_vector, vector_or_zeros, zero_vector
from rankframe.operators.skew import (
    BROADCAST_BYTES,
    fits_broadcast,
    lookup_join,
    narrow_columns,
    one_row_per_key,
)
from rankframe.sources.buckets import BucketedTable
from rankframe.spec import FeatureSpec

PRODUCT_VECTOR = "product_emb"
USER_VECTOR = "user_emb"
USER_KEY = "user_date_key"


def _vector_columns(vector: Column, name: str, dim: int, expand: bool) -> list[Column]:
    if expand:
        return expand_vector(vector, f"{name}_", dim)
    return [vector.alias(name)]


def product_embeddings(
    table: DataFrame,
    product_ids: DataFrame,
    spec: FeatureSpec,
    vector: str = "product_search_document_embedding",
    *,
    expand: bool = False,
) -> DataFrame:
    """Embeddings of the given distinct products; duplicates in the table are kept.

    A semi-join: the ids only select, so no id column is carried and nothing can fan out.
    """
    used = table.select(spec.product, vector).join(product_ids, spec.product, "left_semi")
    packed = vector_or_zeros(F.col(vector), spec.embedding_dim)
    return used.select(
        spec.product, *_vector_columns(packed, PRODUCT_VECTOR, spec.embedding_dim, expand)
    )


def day_range(pairs: DataFrame, spec: FeatureSpec) -> DataFrame:
    return pairs.agg(F.min(spec.day).alias("min_day"), F.max(spec.day).alias("max_day"))


def _midnight(day: Column, like: T.DataType) -> Column:
    """Start of ``day`` in UTC, as the timestamp type the history uses."""
    if isinstance(like, T.TimestampNTZType):
        return day.cast("timestamp_ntz")
    return F.timestamp_seconds(F.unix_date(day.cast("date")).cast("long") * 86400)


def _midnight_literal(day: date | datetime, like: T.DataType) -> Column:
    start = datetime(day.year, day.month, day.day, tzinfo=timezone.utc)
    if isinstance(like, T.TimestampNTZType):
        return F.lit(f"{start:%Y-%m-%d} 00:00:00").cast("timestamp_ntz")
    return F.lit(start)


def prune_history(history: DataFrame, pairs: DataFrame, spec: FeatureSpec) -> DataFrame:
    """ORDER versions that can be valid at the midnight of some day in the range of ``pairs``.

    Beside the range itself this drops every version that begins and ends between two
    midnights, as no day can see it.  A buyer whose history is replaced many times a day is
    thereby cut to one version per day before the shuffle.  The range is taken first, by a
    small job over ``pairs``, so that the bounds reach the scan of the history.
    """
    kind = history.schema["valid_from"].dataType
    first, last = day_range(pairs, spec).head()
    if first is None:
        return history.limit(0)
    # literals, because a scan prunes by nothing else
    earliest, latest = (_midnight_literal(day, kind) for day in (first, last))
    # the first midnight at or after valid_from
    started = F.col("valid_from").cast("date")
    first_day = F.when(
        F.col("valid_from") > _midnight(started, kind), F.date_add(started, 1)
    ).otherwise(started)
    return (
        history.filter(F.col("interaction_type") == "ORDER")
        .filter(F.col("valid_from") <= latest)
        .filter(F.col("valid_to").isNull() | (F.col("valid_to") >= earliest))
        .filter(F.col("valid_to").isNull() | (F.col("valid_to") > _midnight(first_day, kind)))
    )


def user_embeddings_at_day(
    history: DataFrame,
    pairs: DataFrame,
    spec: FeatureSpec,
    vector: str = "user_average_product_search_document_embedding",
    *,
    hash_algo: str = "xxhash64",
    expand: bool = False,
    block_days: int | None = None,
) -> DataFrame:
    """The version of each buyer's embedding that was valid at the midnight of each day.

    Validity is half-open, so a version that starts later on the same day is not seen.
    Overlapping versions all match; a pair without a match is dropped.  ``pairs`` must be
    distinct, and stored or staged, as they are read twice.  The join is an equi-join on the buyer with the interval as extra condition,
    so both sides are shuffled by buyer only and adaptive execution splits hot buyers.

    There, all days of a buyer meet all of the buyer's versions. Where histories are long, give
    ``block_days``: days and versions then meet in blocks of so many days, see
    :func:`versions_by_block`.
    """
    kind = history.schema["valid_from"].dataType
    # a pair with a null matches nothing
    pairs = pairs.dropna()
    versions = prune_history(history, pairs, spec).select(
        F.col(spec.buyer).alias("_buyer"), "valid_from", "valid_to", vector
    )
    midnight = _midnight(F.col(spec.day), kind)
    valid = (F.col("valid_from") <= midnight) & (F.col("valid_to").isNull() | (F.col("valid_to") > midnight))
    if block_days is None:
        matched = pairs.join(versions, (F.col(spec.buyer) == F.col("_buyer")) & valid, "inner")
    else:
        matched = versions_by_block(pairs, versions, valid, spec, kind, block_days)
    key = user_date_key(buyer_hash(F.col(spec.buyer), hash_algo), F.col(spec.day))
    packed = vector_or_zeros(F.col(vector), spec.embedding_dim)
    return matched.select(
        key.alias(USER_KEY), *_vector_columns(packed, USER_VECTOR, spec.embedding_dim, expand)
    )


def versions_by_block(
    pairs: DataFrame, versions: DataFrame, valid: Column, spec: FeatureSpec, kind: T.DataType, block_days: int
) -> DataFrame:
    """``pairs`` joined with the ``versions`` that are ``valid`` on their day, block by block.

    Time is cut into blocks of ``block_days`` days.  The different validity intervals of a
    buyer, without their vectors, are repeated for every block they reach, and meet the days
    in an equi-join on (buyer, block); so a key holds at most ``block_days`` days, and the
    intervals over them.  The matches then fetch their vectors by (buyer, interval), each of
    which the history holds once, or as often as it has versions for it: every pair of a day
    and a version that overlaps it is found once.
    """
    if block_days < 1:
        raise ValueError("block_days must be positive")
    first, last = day_range(pairs, spec).head()
    if first is None:
        return pairs.join(versions, F.lit(False))
    interval = ["_buyer", "valid_from", "valid_to"]

    def block(day: Column) -> Column:
        return F.floor(F.unix_date(day) / block_days)

    # clipped to the days asked for, so that an open interval ends with them
    began = F.greatest(F.col("valid_from").cast("date"), F.lit(first).cast("date"))
    ended = F.least(F.coalesce(F.col("valid_to").cast("date"), F.lit(last).cast("date")), F.lit(last).cast("date"))
    spans = versions.select(*interval).distinct().filter(began <= ended)
    reached = spans.withColumn("_block", F.explode(F.sequence(block(began), block(ended))))
    days = pairs.withColumn("_day_block", block(F.col(spec.day).cast("date")))
    meets = (F.col(spec.buyer) == F.col("_buyer")) & (F.col("_day_block") == F.col("_block")) & valid
    matched = days.join(reached, meets).select(*pairs.columns, *interval)
    entries = versions.withColumnsRenamed({c: f"_of{c}" for c in interval})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in interval])
    return matched.join(entries, same).drop(*[f"_of{c}" for c in interval])


def unique_vectors(table: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """One vector per key: the smallest, which is the one a lookup finds."""
    return one_row_per_key(table, keys, vector)


def lookup_vectors(
    df: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    vector: str,
    dim: int,
    out: str,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    hash_columns: Sequence[str] | None = None,
    count_on: DataFrame | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """``df`` plus vector ``out``: the vector of each row's key, zeros where it is unknown.

    One output row per input row, also when the table holds a key more than once or is empty.
    The table should be stored: its keys are counted before its vectors are read.  With
    ``buckets`` it is stored in so many hash buckets of ``keys``, one row per key: nothing is
    counted then, and only ``df`` is shuffled.
    """
    cleaned = table.select(*keys, clean_vector(F.col(vector), dim).alias(out))
    small = buckets is None and fits_broadcast(table.select(*keys), 4 * dim + 64, broadcast_bytes)
    joined = lookup_join(
        df,
        cleaned,
        keys,
        out,
        small=small,
        unique=buckets is not None,
        row_bytes=4 * dim + 64,
        hash_columns=hash_columns,
        count_on=count_on,
        buckets=buckets,
    )
    return joined.withColumn(out, F.coalesce(F.col(out), zero_vector(dim)))


def _opened(
    df: DataFrame, table: DataFrame | BucketedTable | None, keys: Sequence[str]
) -> tuple[int | None, DataFrame | None]:
    """The number of buckets, if the table has them, and its rows."""
    if not isinstance(table, BucketedTable):
        return None, table
    if table.keys != tuple(keys):
        raise ValueError(f"{table.name} is bucketed by {table.keys}, not by {tuple(keys)}")
    return table.buckets, table.read(df.sparkSession)


def attach_embeddings(
    df: DataFrame,
    spec: FeatureSpec,
    products: DataFrame | BucketedTable | None,
    users: DataFrame | BucketedTable | None,
    *,
    out: str = "emb",
    user_keys: Sequence[str] = (USER_KEY,),
    product_dim: int | None = None,
    user_dim: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Add the ``[product, user]`` vector.  A missing table leaves its part out; no table, no vector.

    ``user_keys`` are the join columns of the user table: the packed (buyer, day) key, or the
    buyer and day columns themselves, which rules out hash collisions.  ``count_on`` may be a
    cheaper frame with the same id columns to find hot keys in.  Either table may be stored in
    buckets, by product id as a long and by ``user_keys``; its vectors are then not shuffled.
    """
    if products is None and users is None:
        return df
    names = df.columns
    product_buckets, products = _opened(df, products, [spec.product])
    user_buckets, users = _opened(df, users, user_keys)
    product_key = "_product_key"
    by_user_key = tuple(user_keys) == (USER_KEY,)

    def with_keys(rows: DataFrame) -> DataFrame:
        if products is not None:
            null_is_zero = F.coalesce(F.col(spec.product).cast("long"), F.lit(0).cast("long"))
            rows = rows.withColumn(product_key, null_is_zero)
        if users is not None and by_user_key:
            rows = rows.withColumn(
                USER_KEY, user_date_key(F.col(spec.buyer_hash), F.col(spec.day))
            )
        return rows

    # Rows are told apart by their own columns; vectors would be slow to hash.  Key counts come
    # from the rows before any lookup, or the second count would repeat the first join.
    own = narrow_columns(df)
    counted = with_keys(count_on or df)
    df = with_keys(df)
    parts: list[Column] = []
    if products is not None:
        df = lookup_vectors(
            df,
            products.select(F.col(spec.product).cast("long").alias(product_key), PRODUCT_VECTOR),
            [product_key],
            PRODUCT_VECTOR,
            product_dim or spec.embedding_dim,
            "_product_part",
            broadcast_bytes=broadcast_bytes,
            hash_columns=own,
            count_on=counted,
            buckets=product_buckets,
        )
        parts.append(F.col("_product_part"))
    if users is not None:
        df = lookup_vectors(
            df,
            users,
            list(user_keys),
            USER_VECTOR,
            user_dim or spec.embedding_dim,
            "_user_part",
            broadcast_bytes=broadcast_bytes,
            hash_columns=own,
            count_on=counted,
            buckets=user_buckets,
        )
        parts.append(F.col("_user_part"))
    return df.select(*names, F.concat(*parts).alias(out))
