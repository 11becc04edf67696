"""Training data and scores for product ranking, as Spark jobs."""

from rankframe.feature_names import CATEGORICAL_FEATURES, EMBEDDING_DIM, NUMERIC_FEATURES
from rankframe.functions import hash_mod, quantile_bins, user_date_key
from rankframe.operators.batches import training_batches
from rankframe.operators.embeddings import (
    attach_embeddings,
    product_embeddings,
    user_embeddings_at_day,
)
from rankframe.operators.encode import encode, encoding_mismatches, fit, prepare
from rankframe.operators.metrics import epoch_loss, focal_loss, score_parity
from rankframe.operators.scoring import (
    ModelShape,
    load_weights,
    project_embeddings,
    score_rows,
)
from rankframe.plans import (
    base_training_table,
    export_embeddings,
    export_split,
    finetune_table,
    plan_split,
    split_rows,
)
from rankframe.sources import (
    PreprocessorState,
    TableCatalog,
    load_artifacts,
    read_split,
    write_artifacts,
    write_split,
)
from rankframe.spec import FeatureSpec, PreprocessConfig, SampleConfig, resolve_window
from rankframe.streaming import encode_arriving_rows

__all__ = [
    "CATEGORICAL_FEATURES",
    "EMBEDDING_DIM",
    "NUMERIC_FEATURES",
    "FeatureSpec",
    "ModelShape",
    "PreprocessConfig",
    "PreprocessorState",
    "SampleConfig",
    "TableCatalog",
    "attach_embeddings",
    "base_training_table",
    "encode",
    "encode_arriving_rows",
    "encoding_mismatches",
    "epoch_loss",
    "export_embeddings",
    "export_split",
    "finetune_table",
    "fit",
    "focal_loss",
    "hash_mod",
    "load_artifacts",
    "load_weights",
    "plan_split",
    "prepare",
    "product_embeddings",
    "project_embeddings",
    "quantile_bins",
    "read_split",
    "resolve_window",
    "score_parity",
    "score_rows",
    "split_rows",
    "training_batches",
    "user_date_key",
    "user_embeddings_at_day",
    "write_artifacts",
    "write_split",
]
