"""Where the source tables are."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class TableCatalog:
    """Names of the three source tables.

    A bare name is looked up in ``namespace`` (so a whole run can be pointed at a staging
    copy), a dotted name is taken as is, and anything with a slash is a Parquet path.
    """

    namespace: str = ""
    interactions: str = "interactions"
    product_embeddings: str = "product_embeddings"
    embedding_history: str = "embedding_history"

    def resolve(self, role: str) -> str:
        if role not in ("interactions", "product_embeddings", "embedding_history"):
            raise KeyError(f"unknown table role {role!r}")
        name = getattr(self, role)
        if "/" in name or "." in name or not self.namespace:
            return name
        return f"{self.namespace}.{name}"

    def read(self, spark: SparkSession, role: str) -> DataFrame:
        name = self.resolve(role)
        return spark.read.parquet(name) if "/" in name else spark.table(name)
