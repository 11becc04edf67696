"""Distinct ids of a split."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankframe.spec import FeatureSpec


def id_columns(split: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The three id columns; over Parquet only these are read."""
    return split.select(spec.product, spec.buyer, spec.day)


def distinct_products(split: DataFrame, spec: FeatureSpec) -> DataFrame:
    return split.select(spec.product).dropna().distinct()


def distinct_buyer_days(split: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Distinct pairs; null parts stay here and find no partner in the history join."""
    return split.select(spec.buyer, spec.day).distinct()


def id_counts(split: DataFrame, spec: FeatureSpec) -> DataFrame:
    """One row: distinct products and distinct (buyer, day) pairs."""
    products = distinct_products(split, spec).agg(F.count(F.lit(1)))
    pairs = distinct_buyer_days(split, spec).agg(F.count(F.lit(1)))
    one = split.sparkSession.range(1)
    return one.select(
        products.scalar().alias("n_products"), pairs.scalar().alias("n_buyer_days")
    )


def split_summary(split: DataFrame) -> DataFrame:
    """One row: number of rows and columns."""
    return split.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(split.columns)).alias("n_cols")
    )


@contextmanager
def staged_ids(split: DataFrame, spec: FeatureSpec) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Distinct products and (buyer, day) pairs, stored while the block runs.

    Both feed a join each (the pairs also a min/max), so each is computed once.  A lost
    executor only costs recomputing its blocks.
    """
    products = distinct_products(split, spec).persist(StorageLevel.MEMORY_AND_DISK)
    pairs = distinct_buyer_days(split, spec).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield products, pairs
    finally:
        products.unpersist()
        pairs.unpersist()
