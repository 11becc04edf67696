"""From an exported split to the table a trainer reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankframe.functions.vectors import pack_columns
from rankframe.operators.embeddings import PRODUCT_VECTOR, USER_KEY, USER_VECTOR, attach_embeddings
from rankframe.operators.encode import encode, fit, prepare
from rankframe.sources.buckets import BucketedTable, write_buckets
from rankframe.sources.splits import read_optional_split, read_split
from rankframe.sources.state import PreprocessorState
from rankframe.spec import FeatureSpec, PreprocessConfig


def prepared_split(spark: SparkSession, root: str, split: str, spec: FeatureSpec) -> DataFrame:
    return prepare(read_split(spark, root, split), spec)


def embedding_tables(
    spark: SparkSession, root: str, spec: FeatureSpec, split: str = "base_train"
) -> tuple[DataFrame | None, DataFrame | None]:
    """Product and user embeddings exported with ``split``; ``None`` for one that was not."""

    def packed(kind: str, key: str, vector: str) -> DataFrame | None:
        table = read_optional_split(spark, root, f"{split}_{kind}")
        if table is None or vector in table.columns:
            return table
        wide = pack_columns(table.columns, [f"{vector}_"], spec.embedding_dim)
        if wide is None:
            raise ValueError(f"{split}_{kind} has neither {vector} nor all of its {vector}_<i> columns")
        return table.select(key, wide.alias(vector))

    return (
        packed("product_embeddings", spec.product, PRODUCT_VECTOR),
        packed("user_embeddings", USER_KEY, USER_VECTOR),
    )


def bucketed_embeddings(
    spark: SparkSession,
    root: str,
    spec: FeatureSpec,
    names: tuple[str, str],
    buckets: int,
    split: str = "base_train",
) -> tuple[BucketedTable | None, BucketedTable | None]:
    """The embeddings exported with ``split``, stored in buckets under these two table names, so
    that later splits are looked up in them without moving a vector."""
    products, users = embedding_tables(spark, root, spec, split)

    def stored(table: DataFrame | None, name: str, key: str, vector: str) -> BucketedTable | None:
        if table is None:
            return None
        return write_buckets(table.withColumn(key, F.col(key).cast("long")), name, [key], vector, buckets)

    return (
        stored(products, names[0], spec.product, PRODUCT_VECTOR),
        stored(users, names[1], USER_KEY, USER_VECTOR),
    )


def model_ready(
    prepared: DataFrame,
    state: PreprocessorState,
    spec: FeatureSpec,
    products: DataFrame | BucketedTable | None,
    users: DataFrame | BucketedTable | None,
    *,
    with_bins: bool = False,
) -> DataFrame:
    """Keys, ``num``, ``cat``, ``target`` and, if there are embeddings, ``emb``.

    Rows are encoded before the lookups, so that what the lookups shuffle is already packed.
    """
    encoded = encode(
        prepared, state, spec, keep=[*spec.keys, spec.buyer_hash], with_bins=with_bins
    )
    return attach_embeddings(encoded, spec, products, users, count_on=prepared)


def base_training_table(
    spark: SparkSession,
    root: str,
    spec: FeatureSpec,
    cfg: PreprocessConfig,
    split: str = "base_train",
) -> tuple[DataFrame, PreprocessorState]:
    """Fit on the base split and encode it."""
    prepared = prepared_split(spark, root, split, spec)
    state = fit(prepared, spec, cfg)
    return model_ready(prepared, state, spec, *embedding_tables(spark, root, spec, split)), state


def finetune_table(
    spark: SparkSession,
    root: str,
    spec: FeatureSpec,
    state: PreprocessorState,
    split: str = "finetune",
    tables: tuple[DataFrame | BucketedTable | None, DataFrame | BucketedTable | None] | None = None,
) -> DataFrame:
    """Encode a new day with a restored state; nothing is refitted.  ``tables``: product and
    user embeddings to use instead of those beside the split."""
    prepared = prepared_split(spark, root, split, spec)
    tables = tables or embedding_tables(spark, root, spec, split)
    return model_ready(prepared, state, spec, *tables)
