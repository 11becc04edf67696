"""Row terms of the losses, as plain expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bce_with_logits(logit: Column, target: Column) -> Column:
    """Binary cross-entropy of a raw logit, in the form that never overflows."""
    x, y = logit.cast("double"), target.cast("double")
    return F.greatest(x, F.lit(0.0)) - x * y + F.log1p(F.exp(-F.abs(x)))


def focal_term(logit: Column, target: Column, gamma: float = 2.0, alpha: float = 0.25) -> Column:
    """``alpha_t * (1 - p_t)^gamma * bce`` of one row."""
    x = logit.cast("double")
    positive = target.cast("double") > 0.5
    # 1 - p_t is the sigmoid of -x for positives and of x for negatives
    miss = 1.0 / (1.0 + F.exp(F.when(positive, x).otherwise(-x)))
    weight = F.when(positive, F.lit(float(alpha))).otherwise(F.lit(1.0 - float(alpha)))
    return weight * F.pow(miss, F.lit(float(gamma))) * bce_with_logits(logit, target)
