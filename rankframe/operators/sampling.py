"""Row selection for a training split: day window, surface, user sample, negatives."""

from __future__ import annotations

import math
import warnings
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rankframe.functions.cleaning import label_target
from rankframe.functions.hashing import concat_key, hash_mod
from rankframe.session import materialize
from rankframe.spec import SAMPLE_RESOLUTION, SURFACES, FeatureSpec, SampleConfig


def in_day_window(day: Column, start: date, stop: date) -> Column:
    """Half-open window, in a form the Parquet scan can prune on."""
    return (day >= F.lit(start)) & (day < F.lit(stop))


def on_surface(surface: str) -> Column:
    """Surface predicate.  A null ``section_id`` fails it, because NOT LIKE is then null."""
    not_recent = ~F.col("section_id").like("%recently_viewed%")
    if surface == "all":
        return F.col("page_type").isin("home_feed", "boosted_merchants") & not_recent
    if surface == "boosted_merchants":
        return (
            (F.col("page_type") == "boosted_merchants")
            & F.col("campaign_id").isNotNull()
            & not_recent
        )
    raise ValueError(f"surface must be one of {SURFACES}, got {surface!r}")


def sample_users(df: DataFrame, pct: int, spec: FeatureSpec, algo: str = "xxhash64") -> DataFrame:
    """Keep all rows of about ``pct`` percent of the buyers; 100 or more keeps everything."""
    if pct >= 100:
        return df
    return df.filter(hash_mod(F.col(spec.buyer), 100, algo) < pct)


def eligible_rows(
    source: DataFrame, cfg: SampleConfig, spec: FeatureSpec, start: date, stop: date
) -> DataFrame:
    """Rows in the window, on the surface and of sampled users.

    Only filters on scan columns, so all of it sits right above (or inside) the scan.
    """
    rows = source.filter(in_day_window(F.col(spec.day), start, stop)).filter(
        on_surface(cfg.surface)
    )
    return sample_users(rows, cfg.user_sample_pct, spec, cfg.hash_algo)


def positive_rate(rows: DataFrame, spec: FeatureSpec) -> DataFrame:
    """One row, ``pos_rate``: share of positive labels (a null label is negative)."""
    return rows.agg(F.avg(label_target(F.col(spec.label)).cast("double")).alias("pos_rate"))


def negative_threshold(rate: Column, scale: int) -> Column:
    """Largest hash (of ``SAMPLE_RESOLUTION``) at which a negative is kept.

    Null when there is no negative to keep (rate 1) or no row at all.  Rounded half away
    from zero.  Capped at the resolution, where every hash is below it anyway, so that the
    cast cannot overflow.
    """
    ratio = F.lit(float(SAMPLE_RESOLUTION * scale)) * rate / (F.lit(1.0) - rate)
    capped = F.least(F.round(ratio), F.lit(float(SAMPLE_RESOLUTION)))
    return F.when(rate < 1.0, capped.cast("long"))


def downsample_negatives(
    rows: DataFrame, cfg: SampleConfig, spec: FeatureSpec, rate: DataFrame | None = None
) -> DataFrame:
    """Keep positives, and negatives so that there are about ``negative_scale`` per positive.

    The choice depends only on (buyer, product, day), so copies of a triple share their fate
    and a rerun keeps the same rows.  The rate enters as a scalar subquery: it is computed
    once, from the label and filter columns alone, and nothing is joined or shuffled.
    """
    if rate is None:
        rate = positive_rate(rows, spec)
    threshold = rate.select(
        negative_threshold(F.col("pos_rate"), cfg.negative_scale).alias("threshold")
    ).scalar()
    return _kept(rows, triple_hash(cfg, spec), threshold, spec)


def triple_hash(cfg: SampleConfig, spec: FeatureSpec) -> Column:
    """What decides whether a negative stays: a hash of (buyer, product, day)."""
    triple = concat_key(F.col(spec.buyer), F.col(spec.product), F.col(spec.day).cast("date"))
    return hash_mod(triple, SAMPLE_RESOLUTION, cfg.hash_algo)


def _kept(rows: DataFrame, own: Column, threshold: Column, spec: FeatureSpec) -> DataFrame:
    return rows.filter(F.col(spec.label) | (own <= threshold))


def downsample_in_one_scan(
    rows: DataFrame, cfg: SampleConfig, spec: FeatureSpec, thin_share: float
) -> DataFrame:
    """The rows of :func:`downsample_negatives`, reading ``rows`` once instead of twice.

    One pass writes the positives and the negatives whose hash lies in the lowest
    ``thin_share`` of its range, and counts all rows on the way; the exact threshold, known
    then, filters what was written.  So ``thin_share`` is what the pass may write of the
    negatives, not what stays.  If the threshold turns out to lie beyond it, a warning says so
    and ``rows`` are read again.

    The counts are taken in the tasks that write, each of which counts once however often it
    is tried, so ``rows`` should need no shuffle; the source's columns that are not wanted
    should be gone.
    """
    if not 0.0 < thin_share <= 1.0:
        raise ValueError("thin_share must be above 0 and at most 1")
    bound = math.floor(SAMPLE_RESOLUTION * thin_share)
    seen = Observation()
    counted = rows.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(spec.label)).alias("positives"),
    ).withColumn("_own_hash", triple_hash(cfg, spec))
    thinned = materialize(_kept(counted, F.col("_own_hash"), F.lit(bound), spec))
    counts = seen.get
    rate = F.lit(counts["positives"] / counts["rows"] if counts["rows"] else None).cast("double")
    exact = negative_threshold(rate, cfg.negative_scale).alias("threshold")
    threshold = rows.sparkSession.range(1).select(exact).head()["threshold"]
    literal = F.lit(threshold).cast("long")
    if threshold is not None and threshold > bound:
        warnings.warn(
            f"thin_share {thin_share} holds hashes up to {bound}, the threshold is {threshold}: "
            "the source is read a second time",
            stacklevel=2,
        )
        return _kept(rows, triple_hash(cfg, spec), literal, spec)
    return _kept(thinned, F.col("_own_hash"), literal, spec).drop("_own_hash")
