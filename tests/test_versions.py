from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rankframe.operators import encode as enc
from rankframe.sources import (
    load_artifacts,
    open_version,
    publish,
    publish_artifacts,
    publish_state,
    published_state,
    versions,
)
from rankframe.sources.state import STATE_TABLES
from rankframe.sources.versions import content_sum
from rankframe.spec import FeatureSpec, PreprocessConfig

SPEC = FeatureSpec(numeric=("x",), categorical=("kind", "page_type"), embedding_dim=2)
CFG = PreprocessConfig(n_bins=4, id_hash={})


@pytest.fixture(scope="module")
def states(spark):
    rows = spark.range(60).select(
        F.col("id").cast("double").alias("x"),
        F.concat(F.lit("k"), F.col("id") % 5).alias("kind"),
        F.lit("page").alias("page_type"),
    )
    return [enc.fit(enc.prepare(part, SPEC), SPEC, CFG) for part in (rows.where("x < 9"), rows)]


def test_the_last_published_state_is_current(spark, states, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError, match="no published version"):
        published_state(spark, root)
    first = publish_state(spark, states[0], root)
    assert published_state(spark, root).same_as(states[0])
    second = publish_state(spark, states[1], root)
    assert published_state(spark, root).same_as(states[1])
    assert published_state(spark, root, first.name).same_as(states[0])  # a reader that began before
    assert versions(spark, root) == [first.name, second.name]
    assert open_version(spark, root) == second
    with pytest.raises(FileNotFoundError, match="nothing"):
        open_version(spark, root, "nothing")


def test_half_a_publication_is_never_seen(spark, states, tmp_path):
    root = str(tmp_path)
    publish_state(spark, states[0], root)

    def seen_during(path):
        states[1].boundary_rows(spark).write.parquet(f"{path}/boundaries")
        assert published_state(spark, root).same_as(states[0])
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        publish(spark, root, seen_during, STATE_TABLES)
    assert published_state(spark, root).same_as(states[0]) and len(versions(spark, root)) == 1
    # a table that the writer forgot
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        publish(spark, root, states[1].boundary_rows(spark).write.parquet, STATE_TABLES)
    assert len(versions(spark, root)) == 1
    with pytest.raises(ValueError, match="unknown table formats"):
        publish(spark, root, print, {"a": "csv"})


def test_changed_tables_are_noticed(spark, states, tmp_path):
    version = publish_artifacts(spark, states[0], CFG, SPEC, str(tmp_path))
    assert load_artifacts(spark, open_version(spark, str(tmp_path)).path).same_as(states[0])
    states[1].boundary_rows(spark).write.mode("overwrite").parquet(f"{version.path}/quantile_boundaries")
    with pytest.raises(ValueError, match="quantile_boundaries is .* published was"):
        open_version(spark, str(tmp_path))
    assert open_version(spark, str(tmp_path), verify=False) == version


def test_empty_vocabulary_can_be_published(spark, tmp_path):
    rows = spark.range(5).select(F.col("id").cast("double").alias("x"))
    state = enc.fit(rows, FeatureSpec(numeric=("x",), categorical=(), embedding_dim=2), CFG)
    assert publish_state(spark, state, str(tmp_path)).tables["vocabulary"][1] == 0
    assert published_state(spark, str(tmp_path)).same_as(state)


def test_content_sums(spark):
    rows = spark.range(100).select("id", F.array(F.col("id"), F.lit(None)).alias("list"))
    total = content_sum(rows)
    assert total[0] == 100 and content_sum(rows.repartition(7).select("list", "id")) == total
    assert content_sum(rows.where("id > 0").union(rows.where("id = 1"))) != total
    assert content_sum(rows.union(rows))[1] != total[1]
    assert content_sum(rows.limit(0)) == (0, "0:0")
