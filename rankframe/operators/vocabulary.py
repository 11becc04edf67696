"""Category vocabularies: distinct values numbered in sorted order."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankframe.operators.batches import number_ordered

# Text bytes of a range of values that one task sorts, about.
RANGE_BYTES = 4 << 20
RANGES_PER_PARTITION = 4


def distinct_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value)`` for every distinct non-null value, as text."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct()
    )


def category_sizes(distinct: DataFrame) -> DataFrame:
    """``(feature, n_values, n_bytes)``; what is known about a vocabulary before using it."""
    return distinct.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_values"), F.sum(F.octet_length("value")).alias("n_bytes")
    )


def number_categories(distinct: DataFrame, value_bytes: float = 16.0) -> DataFrame:
    """``(feature, value, id)``: ids 1..n per feature in byte order of the values; 0 stays free.

    Values are dealt into ranges and sorted there, and the sorted ranges are stored; their sizes
    then place them after each other, so nothing that grows with the vocabulary is sent to all
    tasks.  ``value_bytes`` is the mean length of a value; the number of ranges follows the size
    of the vocabulary, so that a task sorts about ``RANGE_BYTES``, up to ``RANGES_PER_PARTITION``
    ranges for each of the session's shuffle partitions.  ``distinct`` should be stored: it is
    counted first.
    """
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = math.ceil(distinct.count() * value_bytes / RANGE_BYTES)
    ranges = max(1, min(wanted, RANGES_PER_PARTITION * parts))
    order = ["feature", "value"]
    ordered = distinct.select(*order).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    numbered = number_ordered(ordered, "_pos")
    first = numbered.groupBy("feature").agg(F.min("_pos").alias("_first"))
    return numbered.join(F.broadcast(first), "feature").select(
        *order, (F.col("_pos") - F.col("_first") + 1).cast("int").alias("id")
    )


def embedding_dim(vocab_size: int) -> int:
    """Default width of a category embedding."""
    return min(50, max(1, vocab_size // 2))


def vocabulary_sizes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, vocab_size, emb_dim)`` straight from the data, one row per column."""
    sizes = category_sizes(distinct_categories(df, columns))
    listed = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    size = F.coalesce(F.col("n_values"), F.lit(0)) + 1
    return F.broadcast(listed).join(sizes, "feature", "left").select(
        "feature",
        size.alias("vocab_size"),
        F.least(F.lit(50), F.greatest(F.lit(1), F.floor(size / 2))).cast("int").alias("emb_dim"),
    )
