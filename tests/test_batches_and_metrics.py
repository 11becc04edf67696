from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from rankframe.operators.batches import training_batches
from rankframe.operators.metrics import epoch_loss, focal_loss, score_parity


def test_ordered_batches(spark):
    df = spark.range(0, 103, 1, 7).select((102 - F.col("id")).alias("k"))
    got = training_batches(df, 10, order_by=["k"]).orderBy("pos").collect()
    assert [r["k"] for r in got] == list(range(103))
    assert [r["pos"] for r in got] == list(range(103))
    assert [r["batch_id"] for r in got] == [i // 10 for i in range(103)]


def test_shuffle_is_seeded_and_whole(spark):
    df = spark.range(0, 1000, 1, 5).withColumn("v", F.array("id"))

    def order(seed):
        rows = training_batches(df, 64, seed=seed).orderBy("pos").collect()
        assert [r["pos"] for r in rows] == list(range(1000))
        return [r["id"] for r in rows]

    first = order(1)
    assert first == order(1)
    assert first != order(2)
    assert sorted(first) == list(range(1000))
    assert first != sorted(first)


def test_a_mass_of_copies_is_spread_and_numbered(spark):
    df = spark.range(0, 9000, 1, 8).select(F.when(F.col("id") < 6000, 0).otherwise(F.col("id")).alias("k"))
    for order_by in (None, ["k"]):
        got = training_batches(df, 100, order_by=order_by)
        summary = got.agg(F.count_distinct("pos"), F.min("pos"), F.max("pos")).head()
        assert tuple(summary) == (9000, 0, 8999)
        assert got.groupBy("batch_id").count().filter("count <> 100").isEmpty()


def test_small_and_bad_inputs(spark):
    df = spark.range(3)
    assert {r["batch_id"] for r in training_batches(df, 10).collect()} == {0}
    assert training_batches(df.limit(0), 10).count() == 0
    with pytest.raises(ValueError):
        training_batches(df, 0)


def scored(spark, rows):
    return spark.createDataFrame(rows, "score double, target int")


def bce(x, y):
    return max(x, 0) - x * y + math.log1p(math.exp(-abs(x)))


ROWS = [(-3.0, 0), (-0.5, 1), (0.0, 0), (0.7, 1), (4.0, 0), (60.0, 1), (-700.0, 1)]


def test_gamma_zero_is_half_the_cross_entropy(spark):
    got = focal_loss(scored(spark, ROWS), gamma=0.0, alpha=0.5).head()[0]
    assert got == pytest.approx(sum(bce(x, y) for x, y in ROWS) / len(ROWS) / 2)


def test_focal_loss_definition(spark):
    def term(x, y):
        p = 1 / (1 + math.exp(-x))
        p_t, a_t = (p, 0.25) if y else (1 - p, 0.75)
        return a_t * (1 - p_t) ** 2 * bce(x, y)

    got = focal_loss(scored(spark, ROWS)).head()[0]
    assert got == pytest.approx(sum(term(x, y) for x, y in ROWS) / len(ROWS))


def test_sure_and_right_costs_almost_nothing(spark):
    right = focal_loss(scored(spark, [(8.0, 1), (-8.0, 0)])).head()[0]
    wrong = focal_loss(scored(spark, [(-8.0, 1), (8.0, 0)])).head()[0]
    assert 0 <= right < 1e-6 < wrong


def test_epoch_loss_adds_the_penalty(spark):
    rows = [(1.0, 1), (-2.0, 0), (3.0, 0)]
    got = epoch_loss(scored(spark, rows)).head()
    assert got["n_rows"] == 3
    assert got["logit_penalty"] == pytest.approx(0.01 * (1 + 4 + 9) / 3)
    assert got["total_loss"] == pytest.approx(got["focal_loss"] + got["logit_penalty"])


def scores(spark, pairs):
    return spark.createDataFrame(pairs, "id long, score double")


@pytest.mark.parametrize(
    ("other", "expected"),
    [
        ([(1, 1.00005), (2, 2.0)], (2, 0, True)),
        ([(1, 1.1), (2, 2.0)], (2, 0, False)),
        ([(1, 1.0)], (1, 1, False)),
        ([(1, 1.0), (2, 2.0), (3, 0.0)], (2, 1, False)),
        ([(1, float("nan")), (2, 2.0)], (2, 0, False)),
        ([(1, None), (2, 2.0)], (2, 0, False)),
    ],
)
def test_score_parity(spark, other, expected):
    got = score_parity(scores(spark, [(1, 1.0), (2, 2.0)]), scores(spark, other), ["id"]).head()
    assert (got["n_matched"], got["n_unmatched"], got["passed"]) == expected


def test_parity_of_repeated_and_null_ids(spark):
    rows = [(1, float(i)) for i in range(300)] + [(None, 2.0), (None, 3.0)]
    got = score_parity(scores(spark, rows), scores(spark, [(1, 5.0)] * 300 + [(None, 2.5)] * 2), ["id"]).head()
    assert (got["n_matched"], got["n_unmatched"], got["n_repeated"]) == (2, 0, 2)
    assert got["max_abs_diff"] == 294.0 and not got["passed"]
    same = scores(spark, [(1, 4.0)] * 300 + [(None, 2.0)])
    assert score_parity(same, same, ["id"]).head()["passed"]
    fewer = scores(spark, [(1, 4.0)] * 299 + [(None, 2.0)])
    assert not score_parity(same, fewer, ["id"]).head()["passed"]


def test_rows_that_differ_in_an_array_keep_their_batch(spark):
    rows = spark.range(4000).selectExpr("1 as k", "array(id, id * 2) as v", "map('a', id) as m")

    def batches_of(df):
        return {tuple(r["v"]): r["batch_id"] for r in training_batches(df, 100, seed=3).collect()}

    assert batches_of(rows.repartition(3)) == batches_of(rows.repartition(7))


def test_parity_of_nothing_fails(spark):
    empty = scores(spark, [])
    assert score_parity(empty, empty, ["id"]).head()["passed"] is False
