"""Folders of several tables that readers see whole: all of the old ones or all of the new.

Every publication gets a folder of its own below ``root``.  When all its tables lie there, a
small file next to the folders names it, with the rows and a content sum of every table; that
file is what makes it the current one.  Nothing that was published is changed or removed, so
a reader that has begun with one version ends with it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankframe.sources.storage import list_names, publish_text, read_text

_POINTERS = "_versions"  # names grow with time, so the last one is current
_READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parquet": lambda spark, path: spark.read.parquet(path),
    "text": lambda spark, path: spark.read.text(path, wholetext=True),
}


@dataclass(frozen=True)
class Version:
    """A published folder; ``tables`` holds the format, row count and content sum of each."""

    name: str
    path: str
    tables: Mapping[str, tuple[str, int, str]]


def content_sum(df: DataFrame) -> tuple[int, str]:
    """Rows, and a sum over row hashes that does not depend on their order or on files."""
    ordered = df.select(*[F.col(c) for c in sorted(df.columns)])
    # two hashes of 64 bits; as decimals their sums cannot overflow
    hashes = [F.xxhash64(F.lit(seed), *ordered.columns).cast("decimal(38,0)") for seed in (1, 2)]
    facts = ordered.agg(
        F.count(F.lit(1)), *[F.coalesce(F.sum(h), F.lit(0)).cast("decimal(38,0)").cast("string") for h in hashes]
    ).head()
    return facts[0], f"{facts[1]}:{facts[2]}"


def _facts(spark: SparkSession, path: str, kind: str) -> tuple[str, int, str]:
    try:
        return (kind, *content_sum(_READERS[kind](spark, path)))
    except AnalysisException as problem:
        if problem.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without files
            return kind, 0, "empty"
        raise


def publish(
    spark: SparkSession, root: str, write: Callable[[str], None], tables: Mapping[str, str]
) -> Version:
    """Let ``write`` fill a new folder, then make it the current version.

    ``tables`` gives the format, ``parquet`` or ``text``, of every table that ``write``
    leaves.  If anything fails before the end, the old version stays current and the new
    folder is never read.  Of two publications at the same time, one is the later.
    """
    if unknown := set(tables.values()) - set(_READERS):
        raise ValueError(f"unknown table formats {sorted(unknown)}")
    root = root.rstrip("/")
    taken = list_names(spark, f"{root}/{_POINTERS}")
    serial = int(taken[-1].split("-")[0]) + 1 if taken else 1
    name = f"{serial:010d}-{uuid.uuid4().hex}"
    write(f"{root}/{name}")
    facts = {table: _facts(spark, f"{root}/{name}/{table}", kind) for table, kind in tables.items()}
    publish_text(spark, f"{root}/{_POINTERS}/{name}", json.dumps(facts, sort_keys=True))
    return Version(name, f"{root}/{name}", facts)


def versions(spark: SparkSession, root: str) -> list[str]:
    """Names of all published versions, the current one last."""
    return list_names(spark, f"{root.rstrip('/')}/{_POINTERS}")


def open_version(
    spark: SparkSession, root: str, name: str | None = None, *, verify: bool = True
) -> Version:
    """The current version, or ``name``.

    ``verify`` reads every table once and raises ``ValueError`` if one is not what was
    published.  Raises ``FileNotFoundError`` if there is no such version.
    """
    root, known = root.rstrip("/"), versions(spark, root)
    if not known or (name is not None and name not in known):
        raise FileNotFoundError(f"{root} has no published version {name or ''}".rstrip())
    name = name or known[-1]
    stored = json.loads(read_text(spark, f"{root}/{_POINTERS}/{name}"))
    version = Version(name, f"{root}/{name}", {t: tuple(f) for t, f in stored.items()})
    if verify:
        for table, facts in version.tables.items():
            if (found := _facts(spark, f"{version.path}/{table}", facts[0])) != facts:
                raise ValueError(f"{version.path}/{table} is {found}, published was {facts}")
    return version
