"""Small files and folders beside the tables, through the Hadoop file system of their path."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str) -> tuple[Any, Any]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Let a new small file appear whole: it is written under another name, then renamed.

    The file must not exist yet.  A reader sees all of it or none.
    """
    files, target = _locate(spark, path)
    if files.exists(target):
        raise FileExistsError(path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = files.create(draft)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not files.rename(draft, target):
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    files, target = _locate(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, drafts left out; a folder that does not exist has none."""
    files, target = _locate(spark, path)
    if not files.exists(target):
        return []
    names = (status.getPath().getName() for status in files.listStatus(target))
    return sorted(n for n in names if not n.startswith("."))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder if it is there."""
    files, target = _locate(spark, path)
    files.delete(target, True)
