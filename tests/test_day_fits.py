from __future__ import annotations

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankframe.operators.quantiles import bucket_counts, quantile_boundaries
from rankframe.plans.day_fits import boundaries_of_days, count_days, day_counts, fit_days
from rankframe.sources import read_days, write_days
from rankframe.spec import FeatureSpec, PreprocessConfig

DAYS = [date(2026, 3, d) for d in range(1, 6)]
COLUMNS = ["x", "y"]


def frame(spark, seed, days=DAYS, n=200):
    rng = np.random.default_rng(seed)
    rows = [
        (d, float(rng.normal(0, 10.0 ** rng.integers(-3, 4))), None if i % 7 == 0 else float(i % 5))
        for d in days
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "day date, x double, y double").withColumn(
        "kind", F.col("y").cast("string")
    )


def bounds(rows):
    return {r["feature"]: r["bounds"] for r in rows.collect()}


@pytest.fixture()
def root(spark, tmp_path):
    write_days(frame(spark, 1), str(tmp_path), "s", "day", DAYS)
    return str(tmp_path)


def test_window_moves_and_one_day_is_run_again(spark, root):
    assert count_days(spark, root, "s", DAYS[:3], COLUMNS) == DAYS[:3]
    assert count_days(spark, root, "s", DAYS[1:4], COLUMNS) == [DAYS[3]]
    for window in (DAYS[:3], DAYS[1:], DAYS[2:3]):
        rows = read_days(spark, root, "s", window)
        found = bounds(boundaries_of_days(spark, root, "s", window, COLUMNS, 16))
        assert found == bounds(quantile_boundaries(rows, COLUMNS, 16))
        values = np.float32([r["x"] for r in rows.collect()])
        expected = np.quantile(values, np.linspace(0, 1, 17)[1:-1]).astype(np.float32)
        np.testing.assert_array_equal(np.float32(found["x"]), expected)
    write_days(frame(spark, 2, [DAYS[2]], n=50), root, "s", "day", [DAYS[2]])
    with pytest.raises(ValueError, match="2026-03-03"):
        day_counts(spark, root, "s", DAYS, COLUMNS)
    assert count_days(spark, root, "s", DAYS, COLUMNS) == [DAYS[2]]
    found = boundaries_of_days(spark, root, "s", DAYS, COLUMNS, 7)
    assert bounds(found) == bounds(quantile_boundaries(read_days(spark, root, "s"), COLUMNS, 7))


def test_other_columns_are_counted_anew(spark, root):
    count_days(spark, root, "s", DAYS, ["x"])
    assert count_days(spark, root, "s", DAYS[:2], COLUMNS) == DAYS[:2]
    assert count_days(spark, root, "s", DAYS[:2], COLUMNS[::-1]) == []
    assert count_days(spark, root, "s", DAYS[:2], ["x"]) == DAYS[:2]


def test_empty_days(spark, root):
    write_days(frame(spark, 1, []), root, "s", "day", DAYS[:2])
    found = boundaries_of_days(spark, root, "s", DAYS[:3], COLUMNS, 4)
    assert bounds(found) == bounds(quantile_boundaries(read_days(spark, root, "s", DAYS[:3]), COLUMNS, 4))
    assert boundaries_of_days(spark, root, "s", DAYS[:2], COLUMNS, 4).isEmpty()
    with pytest.raises(FileNotFoundError, match="2026-04-01"):
        count_days(spark, root, "s", [date(2026, 4, 1)], COLUMNS)
    with pytest.raises(ValueError, match="no day"):
        boundaries_of_days(spark, root, "s", [], COLUMNS, 4)


def test_counts_of_parts_add_up(spark):
    rows = frame(spark, 3)
    parts = bucket_counts(rows, COLUMNS, by=["day"])
    assert {r[0] for r in parts.groupBy("feature", "day").agg(F.sum("n")).select("sum(n)").collect()} == {200}
    whole = bucket_counts(rows, COLUMNS)
    merged = parts.groupBy("feature", "bucket").agg(F.sum("n").alias("n"))
    assert whole.exceptAll(merged).isEmpty() and merged.exceptAll(whole).isEmpty()
    with pytest.raises(ValueError, match="rename"):
        bucket_counts(rows.withColumnRenamed("day", "bucket"), COLUMNS, by=["bucket"])


def test_a_state_fitted_on_days(spark, root):
    spec = FeatureSpec(numeric=("x", "y"), categorical=("kind",), embedding_dim=2)
    state = fit_days(spark, root, "s", DAYS[1:], spec, PreprocessConfig(n_bins=8, id_hash={}))
    expected = bounds(quantile_boundaries(read_days(spark, root, "s", DAYS[1:]), COLUMNS, 8))
    assert dict(zip(state.numeric, map(list, state.boundaries))) == expected
    assert state.vocab_sizes == {"kind": 7}
