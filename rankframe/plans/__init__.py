"""Whole jobs, composed from the operators."""

from rankframe.plans.day_fits import boundaries_of_days, count_days, fit_days
from rankframe.plans.export import export_embeddings, export_split, plan_split
from rankframe.plans.model_ready import base_training_table, finetune_table, prepared_split
from rankframe.plans.pointwise import explain_text, pointwise_rows, split_rows
from rankframe.plans.projections import read_projections, update_projections

__all__ = [
    "base_training_table",
    "boundaries_of_days",
    "count_days",
    "explain_text",
    "export_embeddings",
    "export_split",
    "finetune_table",
    "fit_days",
    "plan_split",
    "pointwise_rows",
    "prepared_split",
    "read_projections",
    "split_rows",
    "update_projections",
]
