"""Parquet splits: one directory of part files per split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankframe.functions.vectors import expand_vector


def read_split(spark: SparkSession, root: str, split: str) -> DataFrame:
    """All part files of ``root/split``; raises ``FileNotFoundError`` if there are none."""
    path = f"{root.rstrip('/')}/{split}"
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"no parquet files in {path}") from problem
        raise


def read_optional_split(spark: SparkSession, root: str, split: str) -> DataFrame | None:
    """Like :func:`read_split`, but a split that was never written is ``None``."""
    try:
        return read_split(spark, root, split)
    except FileNotFoundError:
        return None


def write_split(
    df: DataFrame,
    root: str,
    split: str,
    *,
    partition_by: Sequence[str] = (),
    max_records_per_file: int | None = None,
    even_files: bool = False,
) -> str:
    """Replace ``root/split`` with ``df`` as Snappy Parquet and return the path.

    As many files as the last stage has tasks; no shuffle is added, unless ``even_files`` asks
    for files of the session's advisory partition size.  That pays off after a filter that
    keeps few rows of many files: one shuffle of what is left instead of as many tiny files.
    """
    path = f"{root.rstrip('/')}/{split}"
    if even_files:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_projected(
    df: DataFrame, root: str, source: str, dim: int, *, expand: bool = False
) -> str:
    """Projected embeddings of one source: id, projection (one vector or wide columns), flag."""
    if expand:
        others = [c for c in df.columns if c not in ("proj", "has_emb")]
        df = df.select(*others, *expand_vector(F.col("proj"), "proj_emb_", dim), "has_emb")
    return write_split(df, root, f"{source}_projected")
