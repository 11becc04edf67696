"""Vector tables kept in hash buckets of their key.

A table that is looked up every day is written once so that all rows of a key hash lie in
one bucket, sorted by key.  A lookup then sends only its own rows over the network, into the
same buckets; the stored vectors are read where they lie.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankframe.operators.skew import one_row_per_key


@dataclass(frozen=True)
class BucketedTable:
    """A catalog table with one row per key, in ``buckets`` hash buckets of ``keys``.

    ``buckets`` bounds the tasks of a lookup, so take the table's size over what a task
    should read, and no fewer than the cluster's shuffle partitions.
    """

    name: str
    keys: tuple[str, ...]
    buckets: int

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)


def _entries(df: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """The smallest vector of every key without nulls."""
    return one_row_per_key(df.select(*keys, vector).dropna(subset=list(keys)), keys, vector)


def _write(rows: DataFrame, table: BucketedTable, mode: str, path: str | None) -> None:
    # one task per bucket, so one file per bucket and write
    dealt = rows.repartition(table.buckets, *table.keys)
    writer = dealt.write.mode(mode).format("parquet").bucketBy(table.buckets, *table.keys).sortBy(*table.keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table.name)


def write_buckets(
    df: DataFrame, name: str, keys: Sequence[str], vector: str, buckets: int, *, path: str | None = None
) -> BucketedTable:
    """Store ``keys`` and ``vector`` of ``df`` as table ``name``, replacing it.

    Rows with a null key are left out, repeated keys keep their smallest vector, which is
    what a lookup finds.  ``df`` should be stored: keys are counted before vectors are read.
    Files go to the warehouse, or to ``path``.
    """
    table = BucketedTable(name, tuple(keys), buckets)
    _write(_entries(df, keys, vector), table, "overwrite", path)
    return table


def append_buckets(df: DataFrame, table: BucketedTable) -> None:
    """Add the rows of new keys, such as another day's.

    Keys that the table has already are an error, found before anything is written: a lookup
    relies on one row per key.  The check shuffles the new keys alone.
    """
    spark = df.sparkSession
    stored = table.read(spark)
    vector = next(c for c in stored.columns if c not in table.keys)
    rows = _entries(df, table.keys, vector)
    new = rows.select(*table.keys).repartition(table.buckets, *table.keys)
    known = new.join(stored.select(*table.keys), list(table.keys), "left_semi").limit(3).collect()
    if known:
        raise ValueError(f"{table.name} has keys already: {[tuple(r) for r in known]}")
    _write(rows.select(*[F.col(f.name).cast(f.dataType) for f in stored.schema]), table, "append", None)


def open_buckets(spark: SparkSession, name: str) -> BucketedTable:
    """The layout of a stored table, from the catalog."""
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    if "Num Buckets" not in facts:
        raise ValueError(f"{name} is not bucketed")
    keys = facts["Bucket Columns"].strip("[]").replace("`", "").split(", ")
    return BucketedTable(name, tuple(keys), int(facts["Num Buckets"]))
