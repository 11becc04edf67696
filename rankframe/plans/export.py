"""Write a training split and the embeddings it needs."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from rankframe.operators.embeddings import product_embeddings, user_embeddings_at_day
from rankframe.operators.identity import staged_ids
from rankframe.plans.pointwise import explain_text, split_rows, thinned_split_rows
from rankframe.sources.catalog import TableCatalog
from rankframe.sources.splits import read_split, write_split
from rankframe.spec import FeatureSpec, SampleConfig

def export_embeddings(
    split: DataFrame,
    products: DataFrame,
    history: DataFrame,
    spec: FeatureSpec,
    root: str,
    name: str,
    *,
    hash_algo: str = "xxhash64",
    expand: bool = False,
) -> dict[str, str]:
    """Write the product and point-in-time user embeddings of the ids in split ``name``.

    They lie beside the split, so exports of several splits into one root stay apart.  The two writes are independent jobs, submitted together so that one fills the gaps the
    other leaves on the cluster.  The staged ids are released however the writes end.
    """
    spark = split.sparkSession
    with staged_ids(split, spec) as (product_ids, pairs):
        tables = {
            "product_embeddings": product_embeddings(products, product_ids, spec, expand=expand),
            "user_embeddings": user_embeddings_at_day(
                history, pairs, spec, hash_algo=hash_algo, expand=expand
            ),
        }
        write = inheritable_thread_target(spark)(write_split)
        with ThreadPoolExecutor(max_workers=len(tables)) as pool:
            jobs = {kind: pool.submit(write, df, root, f"{name}_{kind}") for kind, df in tables.items()}
            return {kind: job.result() for kind, job in jobs.items()}


def export_split(
    spark: SparkSession,
    catalog: TableCatalog,
    cfg: SampleConfig,
    spec: FeatureSpec,
    mode: str,
    root: str,
    *,
    expand: bool = False,
) -> dict[str, str]:
    """Sampled split first, then embeddings for the ids that the sampling left.

    With ``cfg.thin_share`` the interactions are read once, else twice, the first time without
    features.
    """
    select = split_rows if cfg.thin_share is None else thinned_split_rows
    rows = select(catalog.read(spark, "interactions"), cfg, spec, mode)
    # sampling leaves a few rows of every source file
    paths = {mode: write_split(rows, root, mode, even_files=True)}
    paths |= export_embeddings(
        read_split(spark, root, mode),
        catalog.read(spark, "product_embeddings"),
        catalog.read(spark, "embedding_history"),
        spec,
        root,
        mode,
        hash_algo=cfg.hash_algo,
        expand=expand,
    )
    return paths


def plan_split(
    spark: SparkSession, catalog: TableCatalog, cfg: SampleConfig, spec: FeatureSpec, mode: str
) -> str:
    """What :func:`export_split` would run first, as plan text; no data is touched."""
    return explain_text(split_rows(catalog.read(spark, "interactions"), cfg, spec, mode))
