"""Losses over scored tables and agreement of two score tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankframe.functions.losses import focal_term


def focal_loss(
    scored: DataFrame,
    logit: str = "score",
    target: str = "target",
    gamma: float = 2.0,
    alpha: float = 0.25,
) -> DataFrame:
    """One row: mean focal loss."""
    return scored.agg(
        F.avg(focal_term(F.col(logit), F.col(target), gamma, alpha)).alias("focal_loss")
    )


def epoch_loss(
    scored: DataFrame,
    logit: str = "score",
    target: str = "target",
    gamma: float = 2.0,
    alpha: float = 0.25,
    penalty: float = 1e-2,
) -> DataFrame:
    """One row: rows, focal loss, weighted mean squared logit, and their sum.

    A mean over all rows is the same as the row-weighted mean of batch means.
    """
    x = F.col(logit).cast("double")
    parts = scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(focal_term(F.col(logit), F.col(target), gamma, alpha)).alias("focal_loss"),
        (F.lit(penalty) * F.avg(x * x)).alias("logit_penalty"),
    )
    return parts.withColumn("total_loss", F.col("focal_loss") + F.col("logit_penalty"))


def score_parity(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    score: str = "score",
    atol: float = 1e-4,
) -> DataFrame:
    """One row comparing two score tables by row id; a null is an id like any other.

    An id may occur several times. Both tables are reduced per id in one aggregation, never
    paired row by row: an id's largest difference is the one its extremes allow, its mean
    difference that of its means. ``passed`` needs at least one common id, each id equally
    often on both sides, no missing score, and a largest difference below ``atol``.
    """
    keys = list(keys)
    value = F.col(score).cast("double").alias("_score")
    sides = left.select(*keys, value, F.lit(0).alias("_side")).unionByName(
        right.select(*keys, value, F.lit(1).alias("_side"))
    )

    def of(side: int, aggregate) -> Column:
        return aggregate(F.when(F.col("_side") == side, F.col("_score")))

    per_id = sides.groupBy(*keys).agg(
        *[F.count_if(F.col("_side") == s).alias(f"_rows_{s}") for s in (0, 1)],
        *[
            of(s, aggregate).alias(f"_{name}_{s}")
            for s in (0, 1)
            for name, aggregate in (("min", F.min), ("max", F.max), ("avg", F.avg), ("scores", F.count))
        ],
    )
    common = (F.col("_rows_0") > 0) & (F.col("_rows_1") > 0)
    widest = F.greatest(F.col("_max_0") - F.col("_min_1"), F.col("_max_1") - F.col("_min_0"))
    complete = (F.col("_scores_0") == F.col("_rows_0")) & (F.col("_scores_1") == F.col("_rows_1"))
    agrees = common & complete & (F.col("_rows_0") == F.col("_rows_1"))
    summary = per_id.agg(
        F.count_if(common).alias("n_matched"),
        F.count_if(~common).alias("n_unmatched"),
        F.count_if((F.col("_rows_0") > 1) | (F.col("_rows_1") > 1)).alias("n_repeated"),
        F.max(F.when(common, widest)).alias("max_abs_diff"),
        F.avg(F.when(common, F.abs(F.col("_avg_0") - F.col("_avg_1")))).alias("mean_abs_diff"),
        F.count_if(~agrees).alias("_disagree"),
    )
    return summary.withColumn(
        "passed",
        F.coalesce((F.col("max_abs_diff") < atol) & (F.col("_disagree") == 0), F.lit(False)),
    ).drop("_disagree")
