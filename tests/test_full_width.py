"""The default column set: 185 numerics, 6 categories, 768-dimensional vectors."""

from __future__ import annotations

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankframe import (
    FeatureSpec,
    PreprocessConfig,
    SampleConfig,
    attach_embeddings,
    encode,
    encoding_mismatches,
    fit,
    load_artifacts,
    prepare,
    split_rows,
    write_artifacts,
)

SPEC = FeatureSpec()
CFG = PreprocessConfig()
N_ROWS = 500


@pytest.fixture(scope="module")
def source(spark):
    numerics = [
        F.when(F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(10)) == 0, None)
        .otherwise(F.randn(i))
        .alias(name)
        for i, name in enumerate(SPEC.numeric)
    ]
    categories = [
        F.concat(F.lit("val_"), F.pmod(F.xxhash64(F.lit(name), "id"), F.lit(8))).alias(name)
        for name in SPEC.categorical
        if name != "page_type"
    ]
    return (
        spark.range(0, N_ROWS, 1, 4)
        .select(
            F.concat(F.lit("u"), F.col("id") % 50).alias("unified_buyer_id"),
            F.col("id").alias("product_id"),
            F.when(F.col("id") % 20 > 0, F.col("id") * 7).alias("shop_id"),
            F.lit(date(2026, 3, 1)).alias("event_timestamp_day"),
            (F.col("id") % 3 == 0).alias("is_native_order"),
            F.lit("home_feed").alias("page_type"),
            F.lit("rail").alias("section_id"),
            F.lit(None).cast("long").alias("campaign_id"),
            *numerics,
            *categories,
        )
        .cache()
    )


def test_whole_path(spark, source, tmp_path):
    split = split_rows(source, SampleConfig(), SPEC, "base_train")
    assert len(split.columns) == 197
    rows = prepare(split, SPEC).cache()
    assert rows.count() == N_ROWS  # 20 negatives per positive would be allowed
    state = fit(rows, SPEC, CFG)
    assert np.array(state.boundaries).shape == (185, 63)
    values = rows.select(*SPEC.numeric).toPandas().to_numpy()
    expected = np.quantile(values, np.linspace(0, 1, 65)[1:-1], axis=0).astype(np.float32).T
    np.testing.assert_array_equal(np.float32(state.boundaries), expected)
    assert state.vocab_sizes["shop_id"] == 50_001 and state.embedding_dims["shop_id"] == 16

    coded = encode(rows, state, SPEC, keep=[*SPEC.keys, SPEC.buyer_hash], with_bins=True)
    row = coded.head()
    assert (len(row["num"]), len(row["bins"]), len(row["cat"])) == (185, 185, 7)

    write_artifacts(spark, state, CFG, SPEC, str(tmp_path / "artifacts"))
    served = load_artifacts(spark, str(tmp_path / "artifacts"))
    found = encoding_mismatches(rows, state, served, SPEC).head()
    assert tuple(found) == (N_ROWS, 0, 0)

    products = spark.range(0, N_ROWS, 2).select(
        F.col("id").alias("product_id"),
        F.transform(F.sequence(F.lit(1), F.lit(768)), lambda i: i.cast("float")).alias("product_emb"),
    )
    ready = attach_embeddings(coded, SPEC, products, None)
    lengths = ready.select(F.size("emb"), F.get("emb", F.lit(767))).collect()
    assert {r[0] for r in lengths} == {768}
    assert sorted({r[1] for r in lengths}) == [0.0, 768.0]
