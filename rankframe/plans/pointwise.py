"""The sampled, labelled training split."""

from __future__ import annotations

import contextlib
import io
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankframe.functions.cleaning import label_target
from rankframe.functions.hashing import buyer_hash
from rankframe.operators.sampling import downsample_in_one_scan, downsample_negatives, eligible_rows
from rankframe.spec import FeatureSpec, SampleConfig, resolve_window


def pointwise_rows(
    source: DataFrame, cfg: SampleConfig, spec: FeatureSpec, start: date, stop: date
) -> DataFrame:
    """Keys, features, target and buyer hash of the rows kept for ``[start, stop)``.

    No shuffle: filters over one scan, plus a scalar subquery for the positive rate over the
    few columns it needs.
    """
    kept = downsample_negatives(eligible_rows(source, cfg, spec, start, stop), cfg, spec)
    return _split_columns(kept, cfg, spec)


def _split_columns(kept: DataFrame, cfg: SampleConfig, spec: FeatureSpec) -> DataFrame:
    return kept.select(
        *spec.split_columns,
        label_target(F.col(spec.label)).alias(spec.target),
        buyer_hash(F.col(spec.buyer), cfg.hash_algo).alias(spec.buyer_hash),
    )


def split_rows(source: DataFrame, cfg: SampleConfig, spec: FeatureSpec, mode: str) -> DataFrame:
    """:func:`pointwise_rows` for the window of a ``base_train`` or ``finetune`` run."""
    return pointwise_rows(source, cfg, spec, *resolve_window(cfg, mode))


def thinned_split_rows(
    source: DataFrame, cfg: SampleConfig, spec: FeatureSpec, mode: str
) -> DataFrame:
    """The rows of :func:`split_rows` from one pass over the source, which runs here."""
    eligible = eligible_rows(source, cfg, spec, *resolve_window(cfg, mode))
    used = dict.fromkeys([*spec.split_columns, *spec.keys, spec.label])
    kept = downsample_in_one_scan(eligible.select(*used), cfg, spec, cfg.thin_share or 1.0)
    return _split_columns(kept, cfg, spec)


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as text, without running it."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()
