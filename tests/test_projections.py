from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankframe.operators import scoring as sc
from rankframe.plans.projections import read_projections, update_projections

D, P = 3, 2
ARGS = {"id_column": "k", "vector": "v", "dim": D, "dtype": "float64"}


def make_weights(seed=1):
    rng = np.random.default_rng(seed)
    return {
        "product_proj.weight": rng.normal(size=(P, D)),
        "product_proj.bias": rng.normal(size=P),
        "product_proj.norm_weight": 1 + rng.normal(size=P) / 9,
        "product_proj.norm_bias": rng.normal(size=P),
    }


def vectors(spark, entries):
    return spark.createDataFrame([(k, v) for k, v in entries], "k long, v array<float>")


def whole(spark, entries, weights):
    full = sc.project_embeddings(vectors(spark, entries.items()), weights, "product", **ARGS)
    return {r["k"]: (r["has_emb"], r["proj"]) for r in full.collect()}


def stored(spark, root, name=None):
    rows = read_projections(spark, root, "product", name).collect()
    found = {r["k"]: (r["has_emb"], r["proj"]) for r in rows}
    assert len(found) == len(rows)
    return found


def same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == b[k][0]
        np.testing.assert_allclose(a[k][1], b[k][1], rtol=1e-12)


def test_two_increments_equal_a_full_run(spark, tmp_path):
    root, weights = str(tmp_path), make_weights()
    first = {i: [float(i), 1.0, -2.0] for i in range(40)} | {90: None, 91: [float("nan"), 0.0, 0.0]}
    done = update_projections(vectors(spark, first.items()), weights, "product", root, **ARGS)
    assert (done.computed, done.kept) == (42, 0)
    same(stored(spark, root), whole(spark, first, weights))

    second = {k: v for k, v in first.items() if k not in (3, 4)} | {5: [9.0, 9.0, 9.0], 70: [7.0, 0.0, 0.0]}
    more = update_projections(vectors(spark, second.items()), weights, "product", root, **ARGS)
    assert (more.computed, more.kept) == (2, 39)
    same(stored(spark, root), whole(spark, second, weights))
    same(stored(spark, root, done.version.name), whole(spark, first, weights))

    arrivals = {6: [1.0, 2.0, 3.0], 7: second[7], 71: [0.0, 0.0, 0.0]}
    last = update_projections(vectors(spark, arrivals.items()), weights, "product", root, complete=False, **ARGS)
    assert (last.computed, last.kept) == (2, 40)
    same(stored(spark, root), whole(spark, second | arrivals, weights))
    again = update_projections(vectors(spark, (second | arrivals).items()), weights, "product", root, **ARGS)
    assert (again.computed, again.kept) == (0, 42)


def test_other_weights_project_everything_again(spark, tmp_path):
    root, entries = str(tmp_path), {i: [float(i), 0.5, 0.0] for i in range(10)}
    update_projections(vectors(spark, entries.items()), make_weights(), "product", root, **ARGS)
    with pytest.raises(ValueError, match="another model"):
        update_projections(vectors(spark, [(1, [1.0, 1.0, 1.0])]), make_weights(2), "product", root, complete=False, **ARGS)
    done = update_projections(vectors(spark, entries.items()), make_weights(2), "product", root, **ARGS)
    assert (done.computed, done.kept) == (10, 0)
    same(stored(spark, root), whole(spark, entries, make_weights(2)))


def test_repeated_and_missing_ids_and_empty_tables(spark, tmp_path):
    root, weights = str(tmp_path), make_weights()
    none = vectors(spark, [])
    assert update_projections(none, weights, "product", root, **ARGS).computed == 0
    assert stored(spark, root) == {}
    odd = [(1, [5.0, 0.0, 0.0]), (1, [4.0, 0.0, 0.0]), (1, [4.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (2, [1.0, 1.0, 1.0])]
    assert update_projections(vectors(spark, odd), weights, "product", root, **ARGS).computed == 2
    same(stored(spark, root), whole(spark, {1: [4.0, 0.0, 0.0], 2: [1.0, 1.0, 1.0]}, weights))
    assert update_projections(none, weights, "product", root, complete=False, **ARGS).kept == 2
    assert update_projections(none, weights, "product", root, **ARGS).kept == 0
    assert read_projections(spark, root, "product").filter(F.col("k") > 0).isEmpty()


def test_unchanged_vectors_do_not_move(spark, tmp_path):
    """What reaches the projection is the changed ids alone, whatever the table holds."""
    root, weights = str(tmp_path), make_weights()
    make = F.array(F.col("id").cast("float"), F.lit(1.0).cast("float"), F.lit(2.0).cast("float"))
    table = spark.range(5000).select(F.col("id").alias("k"), make.alias("v"))
    update_projections(table, weights, "product", root, **ARGS)
    changed = table.withColumn("v", F.when(F.col("k") % 1000 == 1, F.reverse("v")).otherwise(F.col("v")))
    done = update_projections(changed, weights, "product", root, **ARGS)
    assert (done.computed, done.kept) == (5, 4995)
