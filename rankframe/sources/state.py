"""Fitted preprocessing state, in memory and on storage."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rankframe.sources.versions import Version, open_version, publish
from rankframe.spec import FeatureSpec, ModelShape, PreprocessConfig

STATE_TABLES = {"boundaries": "parquet", "vocabulary": "parquet", "meta": "text"}
ARTIFACT_TABLES = {
    "quantile_boundaries": "parquet",
    "cat_encoders": "parquet",
    **dict.fromkeys(
        ("id_hash_config", "vocab_sizes", "vocab_bytes", "embedding_dims", "model_config", "feature_list"),
        "text",
    ),
}
BOUNDARY_SCHEMA = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),
        T.StructField("feature", T.StringType()),
        T.StructField("bounds", T.ArrayType(T.FloatType())),
    ]
)


@dataclass(frozen=True)
class PreprocessorState:
    """Everything needed to encode rows like the rows it was fitted on.

    The boundaries are a few thousand numbers, whatever the data, and live on the driver.
    The vocabulary may be large and stays a table ``(feature, value, id)``.
    """

    numeric: tuple[str, ...]
    boundaries: tuple[tuple[float, ...], ...]
    vocabulary: DataFrame
    vocab_sizes: Mapping[str, int]
    vocab_bytes: Mapping[str, int]
    embedding_dims: Mapping[str, int]
    id_hash: Mapping[str, tuple[int, int]]
    dim_overrides: Mapping[str, int] = field(default_factory=dict)
    n_bins: int = 64
    hash_algo: str = "xxhash64"

    @property
    def encoded_order(self) -> list[str]:
        """Order of the category vector."""
        return sorted(self.vocab_sizes)

    @property
    def categories(self) -> list[str]:
        return [c for c in self.encoded_order if c not in self.id_hash]

    @property
    def num_continuous(self) -> int:
        return len(self.numeric)

    def boundary_rows(self, spark: SparkSession) -> DataFrame:
        rows = [
            (pos, name, [float(v) for v in bounds])
            for pos, (name, bounds) in enumerate(zip(self.numeric, self.boundaries))
        ]
        return spark.createDataFrame(rows, BOUNDARY_SCHEMA)

    def _meta(self) -> dict:
        return {
            "numeric": list(self.numeric),
            "vocab_sizes": dict(self.vocab_sizes),
            "vocab_bytes": dict(self.vocab_bytes),
            "embedding_dims": dict(self.embedding_dims),
            "id_hash": {k: list(v) for k, v in self.id_hash.items()},
            "dim_overrides": dict(self.dim_overrides),
            "n_bins": self.n_bins,
            "hash_algo": self.hash_algo,
        }

    def save(self, spark: SparkSession, path: str) -> None:
        """Write boundaries, vocabulary and a JSON document below ``path``."""
        root = path.rstrip("/")
        self.boundary_rows(spark).coalesce(1).write.mode("overwrite").parquet(f"{root}/boundaries")
        _write_vocabulary(self.vocabulary, f"{root}/vocabulary")
        _write_document(spark, f"{root}/meta", self._meta())

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PreprocessorState:
        root = path.rstrip("/")
        meta = _read_document(spark, f"{root}/meta")
        return cls._assemble(
            spark.read.parquet(f"{root}/boundaries"),
            _read_vocabulary(spark, f"{root}/vocabulary"),
            meta,
        )

    @classmethod
    def _assemble(cls, boundaries: DataFrame, vocabulary: DataFrame, meta: dict) -> PreprocessorState:
        rows = boundaries.orderBy("pos").collect()
        names = tuple(r["feature"] for r in rows)
        if list(names) != meta["numeric"]:
            raise ValueError("boundaries and meta data name different numeric features")
        return cls(
            numeric=names,
            boundaries=tuple(tuple(r["bounds"]) for r in rows),
            vocabulary=vocabulary,
            vocab_sizes=meta["vocab_sizes"],
            vocab_bytes=meta["vocab_bytes"],
            embedding_dims=meta["embedding_dims"],
            id_hash={k: (int(v[0]), int(v[1])) for k, v in meta["id_hash"].items()},
            dim_overrides=meta["dim_overrides"],
            n_bins=int(meta["n_bins"]),
            hash_algo=meta["hash_algo"],
        )

    def same_as(self, other: PreprocessorState) -> bool:
        """Equal in everything but the vocabulary table, which is compared as rows."""
        if self._meta() != other._meta():
            return False
        if not np.array_equal(np.float32(self.boundaries), np.float32(other.boundaries)):
            return False
        columns = ["feature", "value", "id"]
        a, b = self.vocabulary.select(columns), other.vocabulary.select(columns)
        return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _write_vocabulary(vocabulary: DataFrame, path: str) -> None:
    """One folder per feature, so that using a feature reads no other."""
    columns = vocabulary.select("feature", "value", "id")
    columns.write.mode("overwrite").partitionBy("feature").parquet(path)


def _read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    table = spark.read.schema("value string, id int, feature string").parquet(path)
    return table.select("feature", "value", "id")


def _write_document(spark: SparkSession, path: str, document: object) -> None:
    frame = spark.createDataFrame([(json.dumps(document, sort_keys=True),)], "value string")
    frame.coalesce(1).write.mode("overwrite").text(path)


def _read_document(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).head()["value"])


def write_artifacts(
    spark: SparkSession,
    state: PreprocessorState,
    cfg: PreprocessConfig,
    spec: FeatureSpec,
    path: str,
) -> None:
    """One small dataset per serving artifact below ``path``."""
    if not state.boundaries:
        raise ValueError("the state has no quantile boundaries; fit it first")
    root = path.rstrip("/")
    state.boundary_rows(spark).coalesce(1).write.mode("overwrite").parquet(
        f"{root}/quantile_boundaries"
    )
    _write_vocabulary(state.vocabulary, f"{root}/cat_encoders")
    documents = {
        "id_hash_config": {
            "columns": {k: list(v) for k, v in state.id_hash.items()},
            "algorithm": state.hash_algo,
        },
        "vocab_sizes": dict(state.vocab_sizes),
        "vocab_bytes": dict(state.vocab_bytes),
        "embedding_dims": dict(state.embedding_dims),
        "model_config": cfg.model_shape(state.vocab_sizes).document(),
        "feature_list": {
            "numeric_features": list(spec.numeric),
            "cat_features": list(spec.categorical),
            "all_features": list(spec.features),
        },
    }
    for name, document in documents.items():
        _write_document(spark, f"{root}/{name}", document)


def load_model_shape(spark: SparkSession, path: str) -> ModelShape:
    """The shape of the model that the artifacts belong to."""
    return ModelShape.from_document(_read_document(spark, f"{path.rstrip('/')}/model_config"))


def load_artifacts(spark: SparkSession, path: str) -> PreprocessorState:
    """State for serving-side encoding, from what :func:`write_artifacts` wrote."""
    root = path.rstrip("/")
    boundaries = spark.read.parquet(f"{root}/quantile_boundaries")
    hashes = _read_document(spark, f"{root}/id_hash_config")
    shape = load_model_shape(spark, root)
    sizes = _read_document(spark, f"{root}/vocab_sizes")
    if sorted(sizes) != list(shape.categories):
        raise ValueError("vocab_sizes and model_config list different categories")
    numeric = [r["feature"] for r in boundaries.orderBy("pos").select("feature").collect()]
    return PreprocessorState._assemble(
        boundaries,
        _read_vocabulary(spark, f"{root}/cat_encoders"),
        {
            "numeric": numeric,
            "vocab_sizes": sizes,
            "vocab_bytes": _read_document(spark, f"{root}/vocab_bytes"),
            "embedding_dims": _read_document(spark, f"{root}/embedding_dims"),
            "id_hash": hashes["columns"],
            "dim_overrides": {},
            "n_bins": shape.n_bins,
            "hash_algo": hashes["algorithm"],
        },
    )


def publish_state(spark: SparkSession, state: PreprocessorState, root: str) -> Version:
    """Save ``state`` as the new current version below ``root``."""
    return publish(spark, root, lambda path: state.save(spark, path), STATE_TABLES)


def published_state(spark: SparkSession, root: str, name: str | None = None) -> PreprocessorState:
    """The current state below ``root``, or version ``name``, checked against its content sums."""
    return PreprocessorState.load(spark, open_version(spark, root, name).path)


def publish_artifacts(
    spark: SparkSession, state: PreprocessorState, cfg: PreprocessConfig, spec: FeatureSpec, root: str
) -> Version:
    """Write all serving artifacts as the new current version below ``root``.

    :func:`load_artifacts` and :func:`load_model_shape` of one version's path agree, whatever
    is published meanwhile.
    """
    return publish(
        spark, root, lambda path: write_artifacts(spark, state, cfg, spec, path), ARTIFACT_TABLES
    )
