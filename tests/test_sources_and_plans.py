from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankframe import PreprocessConfig, fixtures as fx
from rankframe.checks.queries import fixture_catalog
from rankframe.plans import (
    base_training_table,
    export_split,
    finetune_table,
    plan_split,
)
from rankframe.plans.model_ready import embedding_tables
from rankframe.session import ensure_checkpoint_dir, materialize
from rankframe.sources import (
    PreprocessorState,
    TableCatalog,
    load_artifacts,
    read_optional_split,
    read_split,
    write_artifacts,
    write_projected,
    write_split,
)


def test_catalog_names(spark, tmp_path):
    catalog = TableCatalog(namespace="staging", embedding_history="other.history")
    assert catalog.resolve("interactions") == "staging.interactions"
    assert catalog.resolve("embedding_history") == "other.history"
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert TableCatalog(interactions=path).read(spark, "interactions").count() == 3
    spark.range(5).createOrReplaceTempView("five")
    assert TableCatalog(product_embeddings="five").read(spark, "product_embeddings").count() == 5
    with pytest.raises(KeyError):
        catalog.resolve("labels")


def test_missing_split(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no parquet files"):
        read_split(spark, str(tmp_path), "nothing")
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        read_split(spark, str(tmp_path), "empty")
    assert read_optional_split(spark, str(tmp_path), "nothing") is None


def test_split_roundtrip_replaces_and_is_snappy(spark, tmp_path):
    root = str(tmp_path)
    write_split(spark.range(10), root, "s")
    path = write_split(spark.range(4).withColumn("day", F.lit("d")), root, "s", partition_by=["day"])
    assert read_split(spark, root, "s").count() == 4
    files = list((tmp_path / "s").rglob("*.parquet"))
    assert files and all(".snappy." in f.name for f in files)
    assert path.endswith("/s")
    write_split(spark.range(0, 100, 1, 1), root, "s", max_records_per_file=30)
    assert len(list((tmp_path / "s").rglob("*.parquet"))) == 4


def test_projected_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, [1.0, 2.0], 1.0)], "product_id long, proj array<float>, has_emb float")
    write_projected(df, str(tmp_path), "product_embeddings", 2, expand=True)
    wide = read_split(spark, str(tmp_path), "product_embeddings_projected")
    assert wide.columns == ["product_id", "proj_emb_0", "proj_emb_1", "has_emb"]
    write_projected(df, str(tmp_path), "product_embeddings", 2)
    packed = read_split(spark, str(tmp_path), "product_embeddings_projected")
    assert packed.columns == ["product_id", "proj", "has_emb"]


def test_only_needed_columns_are_read(spark, tmp_path, sf_dir):
    from rankframe.operators.identity import distinct_products

    write_split(fx.interactions(spark, sf_dir), str(tmp_path), "s")
    split = read_split(spark, str(tmp_path), "s")
    from rankframe.plans import explain_text

    plan = explain_text(distinct_products(split, fx.SPEC))
    assert "ReadSchema: struct<product_id:bigint>" in plan


def test_materialize_keeps_schema_and_uses_the_named_folder(spark):
    folder = ensure_checkpoint_dir(spark)
    df = spark.range(5).withColumn("v", F.array(F.col("id").cast("float")))
    stored = materialize(df)
    assert stored.schema.simpleString() == df.schema.simpleString()
    assert all(f.startswith(folder.split("://")[-1].replace("file:", "")) or folder in f for f in (
        x.replace("file://", "file:") for x in stored.inputFiles()
    ))


@pytest.fixture(scope="module")
def exported(spark, tmp_path_factory, sf_dir):
    root = str(tmp_path_factory.mktemp("export"))
    catalog = fixture_catalog(spark, sf_dir)
    paths = export_split(spark, catalog, fx.WHOLE_RANGE, fx.SPEC, "base_train", root)
    assert set(paths) == {"base_train", "product_embeddings", "user_embeddings"}
    export_split(spark, catalog, fx.MONTH, fx.SPEC, "finetune", root)
    return root


def test_finetune_uses_the_restored_state(spark, exported, tmp_path):
    table, state = base_training_table(spark, exported, fx.SPEC, fx.ENCODING)
    assert table.columns[-4:] == ["num", "cat", "target", "emb"]
    assert table.count() == read_split(spark, exported, "base_train").count()
    state.save(spark, str(tmp_path / "state"))
    restored = PreprocessorState.load(spark, str(tmp_path / "state"))
    assert restored.same_as(state)
    day = finetune_table(spark, exported, fx.SPEC, restored)
    assert day.count() == read_split(spark, exported, "finetune").count() > 0
    assert {len(r["emb"]) for r in day.select("emb").collect()} == {2 * fx.SPEC.embedding_dim}


def test_embedding_tables_may_be_wide_or_absent(spark, exported, tmp_path):
    root = str(tmp_path)
    assert embedding_tables(spark, root, fx.SPEC) == (None, None)
    dim = fx.SPEC.embedding_dim
    packed = read_split(spark, exported, "base_train_product_embeddings")
    wide = packed.select(
        "product_id", *[F.get("product_emb", F.lit(i)).alias(f"product_emb_{i}") for i in range(dim)]
    )
    write_split(wide, root, "base_train_product_embeddings")
    products, users = embedding_tables(spark, root, fx.SPEC)
    assert users is None
    assert products.exceptAll(packed.select(products.columns)).isEmpty()


def test_artifact_files(spark, exported, tmp_path):
    _, state = base_training_table(spark, exported, fx.SPEC, fx.ENCODING)
    path = tmp_path / "artifacts"
    write_artifacts(spark, state, fx.ENCODING, fx.SPEC, str(path))
    assert {p.name for p in path.iterdir()} == {
        "quantile_boundaries",
        "cat_encoders",
        "id_hash_config",
        "vocab_sizes",
        "vocab_bytes",
        "embedding_dims",
        "model_config",
        "feature_list",
    }
    loaded = load_artifacts(spark, str(path))
    assert loaded.same_as(state)
    np.testing.assert_array_equal(np.float32(loaded.boundaries), np.float32(state.boundaries))
    unfitted = PreprocessorState((), (), state.vocabulary, {}, {}, {}, {})
    with pytest.raises(ValueError, match="fit"):
        write_artifacts(spark, unfitted, PreprocessConfig(), fx.SPEC, str(path))


def test_dry_run_is_text_only(spark, sf_dir):
    text = plan_split(spark, fixture_catalog(spark, sf_dir), fx.WHOLE_RANGE, fx.SPEC, "base_train")
    assert "Physical Plan" in text


def test_lookups_agree_whether_broadcast_or_shuffled(spark, exported):
    from rankframe.operators.embeddings import attach_embeddings

    split = read_split(spark, exported, "base_train").select(*fx.SPEC.keys, fx.SPEC.buyer_hash)
    tables = embedding_tables(spark, exported, fx.SPEC)
    sent = attach_embeddings(split, fx.SPEC, *tables)
    shuffled = attach_embeddings(split, fx.SPEC, *tables, broadcast_bytes=0)
    assert sent.count() == split.count()
    assert sent.exceptAll(shuffled).isEmpty() and shuffled.exceptAll(sent).isEmpty()
