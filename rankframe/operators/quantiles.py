"""Exact quantile boundaries of many columns at once.

``percentile`` would gather every distinct value of a column in one task.  Here the order
statistics are found in two counting passes, both with map-side partial sums:

1. values are counted per (feature, bucket), where the bucket is a fixed monotone function
   of the value, and running totals tell which buckets hold the wanted ranks;
2. only values inside those buckets are counted per distinct value, and a running total
   inside each bucket finds the wanted values.

The first pass can be done ahead, day by day: bucket counts of several days add up, so they
are kept as a table (see ``plans.day_fits``) and only the second pass reads all days.

A bucket covers 1/128 of a power of two and so can hold at most about 91 000 different
32-bit floats, and a feature has at most about 71 000 buckets: no group grows with the data.
The buckets sent to all executors number at most two per wanted rank.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankframe.functions.cleaning import clean_numeric

_PER_OCTAVE = 128.0
_SMALLEST_EXPONENT = 150.0  # below log2 of the smallest positive float
_ABOVE_FLOATS = 3.5e38  # stands in for infinity


def interior_fractions(n_bins: int) -> list[float]:
    """The Q-1 inner fractions of Q equal parts."""
    return [float(f) for f in np.linspace(0, 1, n_bins + 1)[1:-1]]


def _bucket(value: Column) -> Column:
    """Monotone: a larger float never gets a smaller bucket."""
    size = F.least(F.abs(value.cast("double")), F.lit(_ABOVE_FLOATS))
    step = F.floor((F.log2(size) + _SMALLEST_EXPONENT) * _PER_OCTAVE).cast("int")
    return F.when(value > 0, step).when(value < 0, -step).otherwise(F.lit(0))


def _wanted_ranks(total: Column, fractions: Sequence[float]) -> Column:
    """Distinct zero-based ranks on both sides of every fraction."""
    exact = F.transform(
        F.array(*[F.lit(f) for f in fractions]), lambda f: f * (total - 1).cast("double")
    )
    below = F.transform(exact, lambda h: F.floor(h).cast("long"))
    above = F.transform(below, lambda r: F.least(r + 1, total - 1))
    return F.array_sort(F.array_union(below, above))


def _values(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """``(*keep, pos, value, bucket)``, one row per value."""
    cleaned = F.array(*[clean_numeric(F.col(c)) for c in columns])
    values = df.select(*keep, F.posexplode(cleaned).alias("pos", "value"))
    return values.withColumn("bucket", _bucket(F.col("value")))


def bucket_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(*by, feature, bucket, n)``: the result of the first pass, which can be added up.

    For each value of ``by`` at most about 71 000 rows per column, whatever the data.
    """
    columns = list(columns)
    if taken := {"pos", "value", "bucket", "feature", "n"} & set(by):
        raise ValueError(f"rename {sorted(taken)}")
    counted = _values(df, columns, *by).groupBy(*by, "pos", "bucket").agg(F.count(F.lit(1)).alias("n"))
    names = F.array(*[F.lit(c) for c in columns])
    return counted.select(*by, F.get(names, F.col("pos")).alias("feature"), "bucket", "n")


def quantile_boundaries(
    df: DataFrame, columns: Sequence[str], n_bins: int, *, counts: DataFrame | None = None
) -> DataFrame:
    """``(pos, feature, bounds)``: per column its Q-1 quantiles, linearly interpolated.

    Values are cleaned and narrowed to 32-bit floats first, and so is the result.  ``counts``
    are :func:`bucket_counts` of the same rows, in any number of parts; with them ``df`` is
    read once.
    """
    columns = list(columns)
    if not columns:
        raise ValueError("no numeric column to take quantiles of")
    fractions = interior_fractions(n_bins)
    values = _values(df, columns)

    # every cleaned column has as many values as there are rows
    if counts is None:
        source, rows = df, F.count(F.lit(1))
        filled = values.groupBy("pos", "bucket").agg(F.count(F.lit(1)).alias("n"))
    else:
        source = counts.filter(F.col("feature") == columns[0])
        rows = F.coalesce(F.sum("n"), F.lit(0).cast("long"))
        names = F.array(*[F.lit(c) for c in columns])
        filled = (
            counts.filter(F.col("feature").isin(columns))
            .groupBy((F.array_position(names, F.col("feature")) - 1).cast("int").alias("pos"), "bucket")
            .agg(F.sum("n").alias("n"))
        )
    counted = source.agg(
        F.struct(rows.alias("total"), _wanted_ranks(rows, fractions).alias("ranks"))
    ).scalar()
    total, ranks = counted["total"], counted["ranks"]

    def wanted_between(start: Column, stop: Column) -> Column:
        return F.filter("ranks", lambda r: (r >= start) & (r < stop))

    # pass 1: which buckets hold the wanted ranks
    upto = W.partitionBy("pos").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    wanted = (
        filled.withColumn("stop", F.sum("n").over(upto))
        .withColumn("start", F.col("stop") - F.col("n"))
        .withColumn("ranks", ranks)
        .withColumn("inside", wanted_between(F.col("start"), F.col("stop")))
        .filter(F.size("inside") > 0)
        .select(
            "pos",
            "bucket",
            "start",
            F.get("inside", F.lit(0)).alias("first_rank"),
            F.element_at("inside", -1).alias("last_rank"),
        )
    )

    # pass 2: which values these are
    ordered = (
        W.partitionBy("pos", "bucket")
        .orderBy("value")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    hits = (
        values.join(F.broadcast(wanted), ["pos", "bucket"])
        .groupBy("pos", "bucket", "start", "first_rank", "last_rank", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("stop", F.col("start") + F.sum("n").over(ordered))
        # most values lie beside the wanted ranks; only the rest is looked at closely
        .filter(
            (F.col("stop") > F.col("first_rank"))
            & (F.col("stop") - F.col("n") <= F.col("last_rank"))
        )
        .withColumn("ranks", ranks)
        .withColumn("rank", F.explode(wanted_between(F.col("stop") - F.col("n"), F.col("stop"))))
        .groupBy("pos")
        .agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))
        .withColumn("last", total - 1)
    )

    def interpolate(fraction: Column) -> Column:
        exact = fraction * F.col("last").cast("double")
        rank = F.floor(exact).cast("long")
        part = exact - F.floor(exact)
        low = F.try_element_at(F.col("at"), rank)
        high = F.try_element_at(F.col("at"), F.least(rank + 1, F.col("last")))
        # the gap is a 32-bit difference, the rest is done in doubles, from the nearer side
        gap = (high - low).cast("double")
        between = F.when(part >= 0.5, high.cast("double") - gap * (1.0 - part)).otherwise(
            low.cast("double") + gap * part
        )
        return F.when(low == high, low).otherwise(between.cast("float"))

    names = F.array(*[F.lit(c) for c in columns])
    return hits.select(
        "pos",
        F.get(names, F.col("pos")).alias("feature"),
        F.transform(F.array(*[F.lit(f) for f in fractions]), interpolate).alias("bounds"),
    )
