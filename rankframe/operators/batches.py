"""Training batches: every row gets a position and a batch number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankframe.session import materialize

# monotonically_increasing_id: partition number above, row number inside the partition below
_ROW_BITS = 33


def _hashed(df: DataFrame) -> list[Column]:
    """All columns, so that rows which differ anywhere get hashes of their own."""
    return [
        F.sort_array(F.map_entries(f.name)) if isinstance(f.dataType, T.MapType) else F.col(f.name)
        for f in df.schema.fields
    ]


def number_rows(df: DataFrame, order: Sequence[str], out: str = "pos") -> DataFrame:
    """Zero-based position of each row when sorted by ``order``, by one range-partitioned sort.

    Rows that tie on every column take the positions in any order; the source partition number
    as last sort key lets a mass of copies spread over tasks.
    """
    return number_ordered(df.orderBy(*order, F.xxhash64(*_hashed(df)), F.spark_partition_id()), out)


def number_ordered(ordered: DataFrame, out: str = "pos") -> DataFrame:
    """Zero-based position of each row of a frame that is sorted, within and across partitions.

    Written to the checkpoint folder so that the row numbers inside the partitions are fixed;
    then the partition sizes, one row per partition, are summed up and added.
    """
    numbered = materialize(ordered.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", _ROW_BITS)
    # a window over the list of partitions, not over the rows
    before = W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        numbered.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select(*ordered.columns, (F.col("_start") + inside).alias(out))
    )


def training_batches(
    df: DataFrame,
    batch_size: int,
    *,
    order_by: Sequence[str] | None = None,
    seed: int = 0,
) -> DataFrame:
    """``df`` plus ``pos`` and ``batch_id``; the last batch may be short and is kept.

    With ``order_by`` batches follow that order, without it rows are shuffled by a seeded
    hash of their columns, so the same seed gives the same batches.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    if order_by:
        numbered = number_rows(df, order_by)
    else:
        mixed = df.withColumn("_mix", F.xxhash64(F.lit(seed), *_hashed(df)))
        numbered = number_rows(mixed, ["_mix"]).drop("_mix")
    return numbered.withColumn("batch_id", F.floor(F.col("pos") / batch_size).cast("long"))
