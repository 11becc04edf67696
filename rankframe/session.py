"""Session helpers: recommended settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What the operators assume.  Everything else (executors, memory, shuffle partitions) is
# the cluster's business.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a row may carry two vectors of several KB
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without one gets a temporary folder; on a cluster a
    machine-local folder would be lost with its executor, so that is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="rankframe-checkpoint-")
    context.setCheckpointDir(shared)
    return shared


def scratch_path(spark: SparkSession) -> str:
    """A path in the checkpoint folder that nothing else uses."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/rankframe-{uuid.uuid4().hex}"


def materialize(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet to a new place in the checkpoint folder and read it from there.

    Cuts the lineage for good: what follows survives lost executors without recomputing, and
    still prunes columns and knows the table's size, which a plain checkpoint would not.  ``by``
    names columns whose values get a folder each.
    """
    return _write(df, scratch_path(df.sparkSession), by)


@contextmanager
def materialized(df: DataFrame) -> Iterator[DataFrame]:
    """Like :func:`materialize`, for the length of a ``with`` block; then the files go."""
    spark = df.sparkSession
    path = scratch_path(spark)
    try:
        yield _write(df, path, ())
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _write(df: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
