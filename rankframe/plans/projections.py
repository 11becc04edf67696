"""Projected embeddings kept up to date: only new and changed vectors are projected."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankframe.functions.vectors import clean_vector
from rankframe.operators.embeddings import unique_vectors
from rankframe.operators.scoring import Weights, project_embeddings
from rankframe.session import materialize
from rankframe.sources.storage import publish_text, read_text
from rankframe.sources.versions import Version, open_version, publish, versions

_TABLES = {"projected": "parquet", "model": "text"}
_HASH = ("_hash_1", "_hash_2")  # 128 bits together


@dataclass(frozen=True)
class Increment:
    """What one update did: the version it published, ids projected and ids taken over."""

    version: Version
    computed: int
    kept: int


def _model_id(weights: Weights, source: str, dim: int, dtype: str) -> str:
    digest = hashlib.sha256()
    for name in sorted(n for n in weights if n.startswith(f"{source}_proj.")):
        values = np.ascontiguousarray(weights[name], dtype=dtype)
        digest.update(f"{name}{values.shape}".encode() + values.tobytes())
    return json.dumps({"source": source, "dim": dim, "dtype": dtype, "weights": digest.hexdigest()}, sort_keys=True)


def _root(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/{source}_projections"


def read_projections(spark: SparkSession, root: str, source: str, name: str | None = None) -> DataFrame:
    """``id, proj, has_emb`` of the current version, or of version ``name``."""
    version = open_version(spark, _root(root, source), name, verify=False)
    return spark.read.parquet(f"{version.path}/projected").drop(*_HASH)


def update_projections(
    df: DataFrame,
    weights: Weights,
    source: str,
    root: str,
    *,
    id_column: str,
    vector: str,
    dim: int,
    dtype: str = "float32",
    complete: bool = True,
) -> Increment:
    """Bring the stored projections of ``source`` to the vectors in ``df``.

    With ``complete`` ``df`` is the whole table and ids that left it go; otherwise it holds
    arrivals and other ids stay.  An id with several vectors has the smallest, rows without an
    id are left out.  What is stored equals projecting everything again, up to the order in
    which a matrix product sums.

    Vectors are compared by a stored 128-bit hash of their cleaned form, so the comparison
    shuffles ids and hashes alone, and only vectors that changed move.  Other weights, another
    ``dim`` or ``dtype`` change every projection: with ``complete`` all are computed again,
    without it that is an error.  ``df`` should be stored; it is read more than once.
    """
    spark, place = df.sparkSession, _root(root, source)
    model = _model_id(weights, source, dim, dtype)
    rows = unique_vectors(df.select(id_column, vector).dropna(subset=[id_column]), [id_column], vector)
    cleaned = clean_vector(F.col(vector), dim)
    hashes = [F.xxhash64(F.lit(seed), cleaned).alias(name) for seed, name in enumerate(_HASH)]
    now = materialize(rows.select(id_column, *hashes))
    keys = [id_column, *_HASH]

    stored = None
    if versions(spark, place):
        version = open_version(spark, place)
        if read_text(spark, f"{version.path}/model/projection.json") == model:
            stored = spark.read.parquet(f"{version.path}/projected")
        elif not complete:
            raise ValueError(f"{place} was projected by another model; update it from the whole table")
    if stored is None:
        changed, kept = now, None
    else:
        changed = materialize(now.join(stored.select(*keys), keys, "left_anti"))
        kept = (
            stored.join(now, keys, "left_semi")
            if complete
            else stored.join(changed.select(id_column), id_column, "left_anti")
        )
        rows = rows.join(changed.select(id_column), id_column, "left_semi")
    projected = project_embeddings(
        rows, weights, source, id_column=id_column, vector=vector, dim=dim, dtype=dtype
    )
    fresh = projected.join(changed, id_column)

    def write(path: str) -> None:
        columns = [*keys, "proj", "has_emb"]
        table = fresh.select(*columns)
        if kept is not None:
            table = table.unionByName(kept.select(*columns))
        table.write.parquet(f"{path}/projected")
        publish_text(spark, f"{path}/model/projection.json", model)

    version, computed = publish(spark, place, write, _TABLES), changed.count()
    return Increment(version, computed, version.tables["projected"][1] - computed)
