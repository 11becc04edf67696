"""Small helpers that the corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankframe.session import ensure_checkpoint_dir

SPLIT = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """An unused path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends here, lost
    executors cost nothing, and later joins can split its hot keys."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.array_remove(F.split(text, SPLIT), "")


def numbered(df: DataFrame, key: str, order: str, slot: str, rows_per_bucket: int = 5_000) -> DataFrame:
    """Add ``slot``: a gapless number from 0 within each ``key``.

    A key's rows are dealt into hash buckets of bounded size; bucket counts give each
    bucket's first number, so no key is ever sorted in one task.
    """
    rows = df.count()
    buckets = max(1, -(-rows // rows_per_bucket)) * 8
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(order), F.lit(buckets)).cast("int"))
    first = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_first", F.coalesce(F.sum("_n").over(first), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(key, "_bucket").orderBy(order)
    return (
        dealt.withColumn("_within", F.row_number().over(inside) - 1)
        .join(starts, [key, "_bucket"])
        .withColumn(slot, (F.col("_first") + F.col("_within")).cast("long"))
        .drop("_first", "_within", "_bucket")
    )
