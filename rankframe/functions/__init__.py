"""Column-level building blocks: hashing, cleaning, vectors, bins and losses."""

from rankframe.functions.binning import quantile_bins
from rankframe.functions.cleaning import clean_category, clean_numeric, clean_target, label_target
from rankframe.functions.hashing import (
    buyer_hash,
    concat_key,
    hash_mod,
    hashed_id,
    user_date_key,
)
from rankframe.functions.losses import bce_with_logits, focal_term
from rankframe.functions.vectors import (
    clean_vector,
    expand_vector,
    has_embedding,
    pack_columns,
    vector_or_zeros,
    zero_vector,
)

__all__ = [
    "bce_with_logits",
    "buyer_hash",
    "clean_category",
    "clean_numeric",
    "clean_target",
    "clean_vector",
    "concat_key",
    "expand_vector",
    "focal_term",
    "has_embedding",
    "hash_mod",
    "hashed_id",
    "label_target",
    "pack_columns",
    "quantile_bins",
    "user_date_key",
    "vector_or_zeros",
    "zero_vector",
]
