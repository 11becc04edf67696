"""Splits with one folder per day, which can be written again day by day.

A day counts only once its marker is there: a small file with the day's number of rows, its
schema and the id of the write, put down after the rows.  A write takes the markers of its
days away first, so a job that dies in between leaves days that readers refuse, never old and
new rows mixed.  Other days are not touched, and jobs for different days may run together.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankframe.sources.storage import list_names, publish_text, read_text, remove

_MARKERS = "_days"  # the underscore hides the folder from table readers


@dataclass(frozen=True)
class WrittenDay:
    """What the marker of a finished day says; ``source`` is the id of the write it derives from."""

    rows: int
    write: str
    day_column: str
    schema: str
    source: str | None = None


def _marker(path: str, day: date) -> str:
    return f"{path}/{_MARKERS}/{day.isoformat()}"


def _folder(path: str, column: str, day: date) -> str:
    return f"{path}/{column}={day.isoformat()}"


def _schema_text(schema: T.StructType) -> str:
    """Names and types as JSON; whether a column can be null is a matter of the plan, not the table."""

    def plain(part: object) -> object:
        if isinstance(part, list):
            return [plain(p) for p in part]
        if not isinstance(part, dict):
            return part
        flags = ("nullable", "containsNull", "valueContainsNull")
        return {k: True if k in flags else {} if k == "metadata" else plain(v) for k, v in part.items()}

    return json.dumps(plain(schema.jsonValue()))


def _rows_by_day(spark: SparkSession, path: str, column: str, days: Iterable[date]) -> dict[date, int]:
    """Rows that lie in the folders of ``days``; reads the footers of the files alone."""
    folders = [
        _folder(path, column, d) for d in days if list_names(spark, _folder(path, column, d))
    ]
    if not folders:
        return {}
    stored = spark.read.schema(f"`{column}` date").option("basePath", path).parquet(*folders)
    return {r[0]: r[1] for r in stored.groupBy(column).agg(F.count(F.lit(1))).collect()}


def write_days(
    df: DataFrame,
    root: str,
    split: str,
    day_column: str,
    days: Iterable[date],
    *,
    even_files: bool = False,
    sources: Mapping[date, str] | None = None,
) -> dict[date, WrittenDay]:
    """Replace exactly ``days`` of ``root/split`` with the rows of ``df``.

    A day without rows is stored as empty.  A row of another day, or of none, is an error and
    leaves the stored rows as they were, though without markers.  ``even_files`` shuffles
    once so that a day gets files of the advisory size instead of one from every task.
    """
    spark, path, wanted = df.sparkSession, f"{root.rstrip('/')}/{split}", sorted(set(days))
    if not wanted:
        raise ValueError("no day to write")
    if df.schema[day_column].dataType != T.DateType():
        raise ValueError(f"{day_column} must be a date")

    for day in wanted:
        remove(spark, _marker(path, day))
    value = F.col(day_column)
    stray = F.raise_error(F.concat(F.lit("row of a day that is not written: "), F.coalesce(value.cast("string"), F.lit("null"))))
    rows = df.withColumn(day_column, F.when(value.isin(wanted), value).otherwise(stray.cast("date")))
    if even_files:
        rows = rows.hint("rebalance", day_column)
    # at most one entry per day, gathered by the job that writes
    seen = Observation()
    rows = rows.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.collect_set(F.date_format(day_column, "yyyy-MM-dd")).alias("days")
    )
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", "snappy").partitionBy(day_column).parquet(path)

    found = seen.get
    for day in wanted:  # a dynamic overwrite does not touch days without new rows
        if day.isoformat() not in found["days"]:
            remove(spark, _folder(path, day_column, day))
    counts = _rows_by_day(spark, path, day_column, wanted)
    if sum(counts.values()) != found["rows"]:
        raise RuntimeError(f"{found['rows']} rows were written to {path}, {sum(counts.values())} are there")
    write, schema = uuid.uuid4().hex, _schema_text(df.schema)
    done = {
        day: WrittenDay(counts.get(day, 0), write, day_column, schema, (sources or {}).get(day))
        for day in wanted
    }
    _finish(spark, path, done)
    return done


def _finish(spark: SparkSession, path: str, done: Mapping[date, WrittenDay]) -> None:
    for day, facts in done.items():
        publish_text(spark, _marker(path, day), json.dumps(asdict(facts), sort_keys=True))


def written_days(spark: SparkSession, root: str, split: str) -> dict[date, WrittenDay]:
    """The finished days of ``root/split``."""
    path = f"{root.rstrip('/')}/{split}"
    return {
        date.fromisoformat(name): WrittenDay(**json.loads(read_text(spark, f"{path}/{_MARKERS}/{name}")))
        for name in list_names(spark, f"{path}/{_MARKERS}")
    }


def read_days(
    spark: SparkSession, root: str, split: str, days: Iterable[date] | None = None
) -> DataFrame:
    """The rows of ``days``, or of all finished days; other days are not listed or read.

    Raises ``FileNotFoundError`` for a day that no finished write covers, ``ValueError`` if a
    day holds another number of rows than its marker says (counted from the files' footers)
    or if days differ in their columns.
    """
    path, done = f"{root.rstrip('/')}/{split}", written_days(spark, root, split)
    wanted = sorted(done if days is None else set(days))
    if open_days := [d.isoformat() for d in wanted if d not in done]:
        raise FileNotFoundError(f"{path} has no finished write of {open_days}")
    if not wanted:
        raise FileNotFoundError(f"{path} has no finished day")
    if len({(done[d].day_column, done[d].schema) for d in wanted}) > 1:
        raise ValueError(f"the days of {path} differ in their columns")
    column, schema = done[wanted[0]].day_column, T.StructType.fromJson(json.loads(done[wanted[0]].schema))
    counts = _rows_by_day(spark, path, column, wanted)
    if wrong := {d.isoformat(): (done[d].rows, counts.get(d, 0)) for d in wanted if done[d].rows != counts.get(d, 0)}:
        raise ValueError(f"{path}: rows by marker and by files differ: {wrong}")
    if not counts:
        return spark.createDataFrame([], schema)
    folders = [_folder(path, column, d) for d in sorted(counts)]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.names)
