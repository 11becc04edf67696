from __future__ import annotations

from datetime import date

import pytest

from rankframe import (
    CATEGORICAL_FEATURES,
    EMBEDDING_DIM,
    NUMERIC_FEATURES,
    FeatureSpec,
    ModelShape,
    PreprocessConfig,
    SampleConfig,
    resolve_window,
)


def test_default_feature_counts():
    spec = FeatureSpec()
    assert len(NUMERIC_FEATURES) == len(set(NUMERIC_FEATURES)) == 185
    assert len(CATEGORICAL_FEATURES) == 6
    assert len(spec.features) == 191
    assert EMBEDDING_DIM == 768
    assert len(spec.split_columns) == 4 + 191


def test_split_columns_keep_the_first_mention():
    spec = FeatureSpec(numeric=("a", "shop_id", "b"), categorical=("c", "a"))
    assert spec.split_columns[-4:] == ("event_timestamp_day", "a", "b", "c")


@pytest.mark.parametrize(
    ("cfg", "mode", "expected"),
    [
        (SampleConfig(stop_date="2026-03-08"), "base_train", (date(2026, 2, 6), date(2026, 3, 8))),
        (SampleConfig(stop_date="2026-03-08"), "finetune", (date(2026, 3, 7), date(2026, 3, 8))),
        (
            SampleConfig(stop_date="2024-03-01", finetune_window_days=3),
            "finetune",
            (date(2024, 2, 27), date(2024, 3, 1)),
        ),
        (
            SampleConfig(base_start="2025-01-01", base_stop="2025-02-01"),
            "base_train",
            (date(2025, 1, 1), date(2025, 2, 1)),
        ),
        (
            SampleConfig(stop_date="2025-02-01", base_start="2025-01-15"),
            "base_train",
            (date(2025, 1, 15), date(2025, 2, 1)),
        ),
    ],
)
def test_windows(cfg, mode, expected):
    assert resolve_window(cfg, mode) == expected


def test_bad_values_are_refused():
    with pytest.raises(ValueError, match="mode"):
        resolve_window(SampleConfig(), "weekly")
    with pytest.raises(ValueError, match="surface"):
        SampleConfig(surface="nowhere")
    with pytest.raises(ValueError):
        SampleConfig(stop_date="yesterday")
    with pytest.raises(ValueError):
        PreprocessConfig(n_bins=1)


def test_model_shape_lists_categories_in_sorted_order():
    shape = PreprocessConfig().model_shape({"z": 3, "a": 4, "shop_id": 50_001})
    assert shape.categories == ("a", "shop_id", "z")
    assert shape.embedding_dim == 768
    assert ModelShape.from_document(shape.document()) == shape
    assert PreprocessConfig(use_pretrained_embeddings=False).model_shape({}).embedding_dim == 0
