"""Refit on a moving window of days without counting old days again."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from rankframe.operators.encode import fit, prepare
from rankframe.operators.quantiles import bucket_counts, quantile_boundaries
from rankframe.sources.days import read_days, write_days, written_days
from rankframe.sources.state import PreprocessorState
from rankframe.spec import FeatureSpec, PreprocessConfig


def counts_name(split: str) -> str:
    return f"{split}_bucket_counts"


def _outdated(
    spark: SparkSession, root: str, split: str, days: Iterable[date], columns: Sequence[str]
) -> tuple[str, dict[date, str]]:
    """The split's day column, and the days whose counts are not of its present rows and ``columns``,
    with what their counts have to be made of."""
    stored, counted = written_days(spark, root, split), written_days(spark, root, counts_name(split))
    wanted = sorted(set(days))
    if absent := [d.isoformat() for d in wanted if d not in stored]:
        raise FileNotFoundError(f"{root}/{split} has no finished write of {absent}")
    if not wanted:
        raise ValueError("no day to fit on")
    source = {d: json.dumps([stored[d].write, *sorted(columns)]) for d in wanted}
    old = {d: source[d] for d in wanted if d not in counted or counted[d].source != source[d]}
    return stored[wanted[0]].day_column, old


def count_days(
    spark: SparkSession, root: str, split: str, days: Iterable[date], columns: Sequence[str]
) -> list[date]:
    """Store the bucket counts of ``days`` beside the split; returns the days that needed it.

    Only days that were never counted, were written again since or were counted for other
    columns are read.
    """
    day, old = _outdated(spark, root, split, days, columns)
    if old:
        counts = bucket_counts(read_days(spark, root, split, old), columns, by=[day])
        write_days(counts, root, counts_name(split), day, old, even_files=True, sources=old)
    return sorted(old)


def day_counts(
    spark: SparkSession, root: str, split: str, days: Iterable[date], columns: Sequence[str]
) -> DataFrame:
    """Stored counts of ``days``; an error if any are not of the rows that the split holds now."""
    days = sorted(set(days))
    if old := _outdated(spark, root, split, days, columns)[1]:
        raise ValueError(f"count these days of {split} first: {[d.isoformat() for d in sorted(old)]}")
    return read_days(spark, root, counts_name(split), days)


def boundaries_of_days(
    spark: SparkSession, root: str, split: str, days: Iterable[date], columns: Sequence[str], n_bins: int
) -> DataFrame:
    """Quantile boundaries over all rows of ``days``, as one fit over their union gives them.

    Days without counts are counted first; then the stored counts say which buckets hold the
    wanted ranks, and one scan of the numeric columns finds the values in them.
    """
    days = sorted(set(days))
    count_days(spark, root, split, days, columns)
    counts = day_counts(spark, root, split, days, columns)
    return quantile_boundaries(read_days(spark, root, split, days), columns, n_bins, counts=counts)


def fit_days(
    spark: SparkSession, root: str, split: str, days: Iterable[date], spec: FeatureSpec, cfg: PreprocessConfig
) -> PreprocessorState:
    """A state fitted on ``days`` of a split that is kept in day folders."""
    days = sorted(set(days))
    rows = prepare(read_days(spark, root, split, days), spec)
    numeric = [c for c in spec.numeric if c in rows.columns]
    count_days(spark, root, split, days, numeric)
    return fit(rows, spec, cfg, counts=day_counts(spark, root, split, days, numeric))
