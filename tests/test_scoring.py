"""The NumPy forward pass against a slow restatement, and its use over tables."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankframe import fixtures as fx
from rankframe.checks import queries
from rankframe.functions.binning import quantile_bins
from rankframe.operators import scoring as sc
from rankframe.plans import explain_text

D, P, BINS, FEATURES, CATS = 6, 4, 5, 3, ("a", "b")
SHAPE = sc.ModelShape(categories=CATS, n_bins=BINS, cross_layers=2, deep_layers=3, head_layers=2, embedding_dim=D)


def make_weights(with_embeddings=True, seed=3):
    rng = np.random.default_rng(seed)
    w = {}

    def add(name, *shape):
        w[name] = rng.normal(scale=0.4, size=shape)

    def norm(name, width):
        w[f"{name}.norm_weight"] = 1 + rng.normal(scale=0.1, size=width)
        add(f"{name}.norm_bias", width)

    add("numeric_emb", FEATURES * (BINS + 1), 2)
    for c in CATS:
        w[f"cat_emb.{c}"] = rng.normal(scale=1.5, size=(7, 3))
    dim = FEATURES * 2 + len(CATS) * 3
    if with_embeddings:
        for s in ("product", "user"):
            add(f"{s}_proj.weight", P, D)
            add(f"{s}_proj.bias", P)
            norm(f"{s}_proj", P)
        dim += 2 * P + 2
    for i in range(2):
        add(f"cross.{i}.down", 3, 2, dim)
        add(f"cross.{i}.up", 3, dim, 2)
        add(f"cross.{i}.bias", dim)
        add(f"cross.{i}.gate", 3, dim)

    def stack(name, dims):
        for i, (a, b) in enumerate(zip(dims, dims[1:])):
            if i < len(dims) - 2:
                add(f"{name}.{i}.gate", b, a)
                add(f"{name}.{i}.value", b, a)
                add(f"{name}.{i}.value_bias", b)
                norm(f"{name}.{i}", b)
            else:
                add(f"{name}.{i}.weight", b, a)
                add(f"{name}.{i}.bias", b)

    stack("deep", [dim, 9, 8, 7])
    stack("head", [dim + 7, 6, 5])
    add("logit.weight", 1, 5)
    add("logit.bias", 1)
    return w


# --- one row at a time, written out with plain loops ------------------------------------------


def slow_norm(x, w, name):
    mean = sum(x) / len(x)
    var = sum((v - mean) ** 2 for v in x) / len(x)
    return [
        (v - mean) / math.sqrt(var + 1e-5) * g + b
        for v, g, b in zip(x, w[f"{name}.norm_weight"], w[f"{name}.norm_bias"])
    ]


def slow_linear(x, weight, bias=None):
    out = [sum(a * b for a, b in zip(row, x)) for row in weight]
    return out if bias is None else [o + b for o, b in zip(out, bias)]


def slow_project(x, w, name):
    y = slow_norm(slow_linear(x, w[f"{name}.weight"], w[f"{name}.bias"]), w, name)
    return [0.5 * v * (1 + math.erf(v / math.sqrt(2))) for v in y]


def slow_stack(x, w, name, layers):
    for i in range(layers - 1):
        gate = slow_linear(x, w[f"{name}.{i}.gate"])
        value = slow_linear(x, w[f"{name}.{i}.value"], w[f"{name}.{i}.value_bias"])
        x = slow_norm(
            [v * g / (1 + math.exp(-g)) for v, g in zip(value, gate)], w, f"{name}.{i}"
        )
    return slow_linear(x, w[f"{name}.{layers - 1}.weight"], w[f"{name}.{layers - 1}.bias"])


def slow_score(w, bins, codes, vectors=None, projected=None):
    x = []
    for f, b in enumerate(bins):
        x += list(w["numeric_emb"][f * (BINS + 1) + b])
    for c, code in zip(CATS, codes):
        x += list(w[f"cat_emb.{c}"][code])
    if vectors is not None:
        product, user = vectors[:D], vectors[D:]
        x += slow_project(product, w, "product_proj") + slow_project(user, w, "user_proj")
        x += [float(any(product)), float(any(user))]
    if projected is not None:
        x += projected
    x0, xl = x, x
    for i in range(2):
        gate = slow_linear(xl, w[f"cross.{i}.gate"])
        total = sum(math.exp(g) for g in gate)
        mix = [0.0] * len(x0)
        for k, g in enumerate(gate):
            inner = slow_linear(xl, w[f"cross.{i}.down"][k])
            outer = slow_linear(inner, w[f"cross.{i}.up"][k])
            mix = [m + math.exp(g) / total * o for m, o in zip(mix, outer)]
        xl = [a * (m + b) + v for a, m, b, v in zip(x0, mix, w[f"cross.{i}.bias"], xl)]
    both = xl + slow_stack(x0, w, "deep", 3)
    return slow_linear(slow_stack(both, w, "head", 2), w["logit.weight"], w["logit.bias"])[0]


# --- tests --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoded(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(60):
        vector = rng.normal(size=2 * D)
        if i % 4 == 0:
            vector[:D] = 0
        if i % 6 == 0:
            vector[D:] = 0
        rows.append(
            (
                i,
                [int(b) for b in rng.integers(1, BINS + 1, FEATURES)],
                [int(c) for c in rng.integers(0, 7, len(CATS))],
                [float(v) for v in vector],
            )
        )
    schema = "id long, bins array<int>, cat array<int>, emb array<double>"
    return spark.createDataFrame(rows, schema).repartition(4)


def by_id(df):
    return np.array([r["score"] for r in df.orderBy("id").collect()])


def test_error_function():
    x = np.linspace(-6, 6, 4001)
    exact = np.array([math.erf(v) for v in x])
    assert np.abs(sc.erf(x) - exact).max() < 1.6e-7


def test_scores_with_vectors(encoded):
    w = make_weights()
    limited = sc.limit_norms(w)
    rows = encoded.orderBy("id").collect()
    expected = [slow_score(limited, r["bins"], r["cat"], vectors=r["emb"]) for r in rows]
    got = by_id(sc.score_rows(encoded, w, SHAPE, keep=["id"], clamp=False, dtype="float64"))
    np.testing.assert_allclose(got, expected, atol=1e-5)
    single = by_id(sc.score_rows(encoded, w, SHAPE, keep=["id"], clamp=False))
    np.testing.assert_allclose(single, expected, atol=1e-3, rtol=1e-3)


def test_absent_vectors_are_projected_zeros_with_flag_off(encoded):
    w = make_weights()
    rows = encoded.orderBy("id").collect()
    limited = sc.limit_norms(w)
    expected = [slow_score(limited, r["bins"], r["cat"], vectors=[0.0] * (2 * D)) for r in rows]
    got = by_id(
        sc.score_rows(encoded.drop("emb"), w, SHAPE, keep=["id"], clamp=False, dtype="float64")
    )
    np.testing.assert_allclose(got, expected, atol=1e-5)


def test_clamp(encoded):
    w = make_weights()
    w["logit.weight"] = w["logit.weight"] * 1000
    raw = by_id(sc.score_rows(encoded, w, SHAPE, keep=["id"], clamp=False, dtype="float64"))
    got = by_id(sc.score_rows(encoded, w, SHAPE, keep=["id"], dtype="float64"))
    np.testing.assert_allclose(got, np.clip(raw, -10, 10))
    assert got.max() == 10 and got.min() == -10


def test_model_without_embeddings(encoded):
    w = make_weights(with_embeddings=False)
    shape = sc.ModelShape(categories=CATS, n_bins=BINS, cross_layers=2)
    rows = encoded.orderBy("id").collect()
    expected = [slow_score(w, r["bins"], r["cat"]) for r in rows]
    got = by_id(sc.score_rows(encoded, w, shape, keep=["id"], inputs="none", dtype="float64"))
    np.testing.assert_allclose(got, expected, rtol=1e-9)
    with pytest.raises(ValueError, match="without text embeddings"):
        sc.score_rows(encoded, w, shape, keep=["id"], inputs="projected")


def test_bins_are_found_in_the_scoring_batches(spark, encoded):
    """Same scores as with bins made ahead, and one Python step instead of two."""
    w = make_weights(with_embeddings=False)
    shape = sc.ModelShape(categories=CATS, n_bins=BINS, cross_layers=2)
    bounds = [[0.5 * k + f for k in range(BINS - 1)] for f in range(FEATURES)]
    numeric = F.array(*[((F.col("id") * (7 + f)) % 50 / 10).cast("float") for f in range(FEATURES)])
    rows = encoded.drop("bins").withColumn("num", numeric)
    options = {"keep": ["id"], "inputs": "none", "dtype": "float64"}
    ahead = sc.score_rows(rows.withColumn("bins", quantile_bins(F.col("num"), bounds)), w, shape, **options)
    inside = sc.score_rows(rows, w, shape, boundaries=bounds, **options)
    np.testing.assert_array_equal(by_id(inside), by_id(ahead))
    assert len(set(by_id(inside))) > 10
    steps = [explain_text(df).count("ArrowEvalPython (") + explain_text(df).count("MapInArrow (") for df in (ahead, inside)]
    assert steps[0] == 2 * steps[1] > 0


def test_long_batches_go_through_in_slices(encoded, monkeypatch):
    """However long an Arrow batch is, the network holds a bounded number of its rows."""
    w = make_weights(with_embeddings=False)
    shape = sc.ModelShape(categories=CATS, n_bins=BINS, cross_layers=2)
    sizes, made, forward = [], [], sc.forward
    monkeypatch.setattr(sc, "_map_batches", lambda *args: made.append(args[-1]))
    monkeypatch.setattr(sc, "forward", lambda w, shape, bins, *rest: sizes.append(len(bins)) or forward(w, shape, bins, *rest))
    sc.score_rows(encoded, w, shape, keep=["id"], inputs="none", dtype="float64")
    rng, rows = np.random.default_rng(2), 5000
    bins, codes = rng.integers(1, BINS, (rows, FEATURES)), rng.integers(0, 7, (rows, len(CATS)))
    got = made[0](pa.array(bins.tolist()), pa.array(codes.tolist()))
    assert sum(sizes) == rows and max(sizes) <= 1024
    np.testing.assert_allclose(got.to_numpy(), forward({k: v.astype("float64") for k, v in w.items()}, shape, bins, codes), rtol=1e-9)


def test_the_query_without_embeddings_has_one_python_step(spark, sf_dir):
    text = explain_text(queries()["score_without_embeddings"](spark, sf_dir))
    assert "MapInArrow" in text and "ArrowEvalPython" not in text


def test_reading_the_weights_starts_no_python_worker(spark):
    """Same weights by their rule; no scan of pickled rows, whose workers would stay beside the scoring ones."""
    sizes = {c: 5 + i for i, c in enumerate(fx.CATEGORY_ORDER)}
    table = fx.weight_table(spark, sizes)
    assert "ExistingRDD" not in explain_text(table)
    assert table.schema.simpleString() == "struct<name:string,shape:array<int>,values:array<double>>"
    weights = sc.load_weights(table, "float64")
    layout = fx.weight_layout(sizes, True)
    assert list(weights) == [name for name, *_ in layout]
    for s, (name, shape, divisor, shift) in enumerate(layout):
        rule = [shift + ((37 * k + 11 * s) % 41 - 20) / divisor for k in range(math.prod(shape))]
        np.testing.assert_array_equal(weights[name], np.reshape(rule, shape))


def test_projecting_ahead_gives_the_same_scores(spark, encoded):
    """Vectors looked up as projections by id, one id unknown, against projecting inside."""
    w = {k: v * 0.3 if k.startswith("cat_emb") else v for k, v in make_weights().items()}
    w = {k: v / max(1.0, np.linalg.norm(v, axis=1).max()) if k.startswith("cat_emb") else v for k, v in w.items()}
    rows = encoded.withColumns(
        {"pid": F.when(F.col("id") % 4 == 0, -1).otherwise(F.col("id")), "uid": F.col("id")}
    )
    joined = rows
    for source, key, start in (("product", "pid", 1), ("user", "uid", D + 1)):
        table = rows.filter(f"{key} >= 0").select(key, F.slice("emb", start, D).alias("v"))
        projected = sc.project_embeddings(
            table, w, source, id_column=key, vector="v", dim=D, dtype="float64"
        )
        joined = sc.attach_projection(joined, projected, [key], source, w)
    inside = by_id(
        sc.score_rows(
            rows.withColumn("emb", F.col("emb").cast("array<float>")),
            w,
            SHAPE,
            keep=["id"],
            clamp=False,
            dtype="float64",
        )
    )
    ahead = by_id(
        sc.score_rows(joined, w, SHAPE, keep=["id"], inputs="projected", dtype="float64")
    )
    np.testing.assert_allclose(ahead, inside, atol=1e-4)


def test_projection_rows(spark):
    w = make_weights()
    vectors = [[0.0] * D, [1.0, None, 0.0, 0.0, 0.0, 2.0], None]
    df = spark.createDataFrame(list(enumerate(vectors)), "user_date_key long, v array<float>")
    got = sc.project_embeddings(
        df, w, "user", id_column="user_date_key", vector="v", dim=D, dtype="float64"
    )
    assert got.columns == ["user_date_key", "proj", "has_emb"]
    rows = got.orderBy("user_date_key").collect()
    assert [r["has_emb"] for r in rows] == [0.0, 1.0, 0.0]
    for row, vector in zip(rows, vectors):
        clean = [v or 0.0 for v in (vector or [0.0] * D)]
        np.testing.assert_allclose(row["proj"], slow_project(clean, w, "user_proj"), atol=1e-6)
    assert any(abs(v) > 1e-3 for v in rows[0]["proj"])
    with pytest.raises(ValueError, match="no projection"):
        sc.project_embeddings(df, {}, "user", id_column="user_date_key", vector="v", dim=D)


def test_weights_table_roundtrip_and_limit(spark):
    w = make_weights()
    rows = [(k, list(v.shape), [float(x) for x in v.ravel()]) for k, v in w.items()]
    table = spark.createDataFrame(rows, "name string, shape array<int>, values array<double>")
    loaded = sc.load_weights(table, "float64")
    assert loaded.keys() == w.keys()
    assert all(np.array_equal(loaded[k], w[k]) for k in w)
    with pytest.raises(ValueError, match="parameters"):
        sc.load_weights(table, max_parameters=100)


def test_trained_names_are_understood(spark, encoded):
    w = make_weights()
    names = sc.trained_names(SHAPE)
    assert set(names.values()) == set(w)
    trained = {ours: theirs for theirs, ours in names.items()}
    rows = [(trained[k], list(v.shape), [float(x) for x in v.ravel()]) for k, v in w.items()]
    table = spark.createDataFrame(rows, "name string, shape array<int>, values array<double>")
    loaded = sc.load_weights(table, "float64", names=names)
    assert loaded.keys() == w.keys()
    sc.check_weights(loaded, SHAPE)


def test_weights_are_checked_before_any_job(encoded):
    w = make_weights()
    del w["cross.0.down"]
    w["logit.bias"] = np.zeros(2)
    with pytest.raises(ValueError, match="cross.0.down is missing; logit.bias has shape"):
        sc.score_rows(encoded, w, SHAPE, keep=["id"])


def test_empty_table(spark, encoded):
    empty = encoded.limit(0)
    assert sc.score_rows(empty, make_weights(), SHAPE, keep=["id"]).count() == 0


@pytest.mark.parametrize("name", ["scoring_paths_agree", "score_projected"])
def test_scoring_reads_stored_codes(spark, sf_dir, name):
    """Bins and vectors are not computed again for every way of scoring and every key count."""
    plan = queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in plan and "score" in plan
