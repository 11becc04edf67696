from __future__ import annotations

import re
import uuid

import pytest
from pyspark.sql import functions as F

from rankframe.operators import embeddings as emb
from rankframe.plans import explain_text
from rankframe.sources import BucketedTable, append_buckets, open_buckets, write_buckets


def vectors(spark, first, last):
    vector = F.array(F.col("id").cast("float"), F.lit(2.0).cast("float"))
    return spark.range(first, last).select(F.col("id").alias("k"), vector.alias("v"))


@pytest.fixture()
def name():
    return f"buckets_{uuid.uuid4().hex}"


@pytest.fixture()
def wide_rows(spark):
    """Two fifths of the rows have one key, some none, some an unknown one."""
    key = F.when(F.col("id") % 5 < 2, F.lit(7)).when(F.col("id") % 5 == 2, None).otherwise(F.col("id"))
    return spark.range(3000).select("id", key.cast("long").alias("k"), F.array_repeat(F.col("id"), 9).alias("wide"))


def test_lookups_move_no_vector(spark, name, wide_rows, tmp_path):
    stored = write_buckets(vectors(spark, 0, 2000), name, ["k"], "v", 12, path=f"{tmp_path}/t")
    assert open_buckets(spark, name) == stored == BucketedTable(name, ("k",), 12)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if it were large
    try:
        found = emb.lookup_vectors(wide_rows, stored.read(spark), ["k"], "v", 2, "out", buckets=12)
        text = explain_text(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanged = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text)
    assert len([x for x in exchanged if "wide#" in x]) == 1
    # vectors are exchanged only where a few hot keys are broadcast
    assert not [x for x in exchanged if re.search(r"\b(v|out|_cold_value)#", x)]
    assert "Bucketed: true" in text
    expected = {r["id"]: [float(r["k"]), 2.0] if r["k"] is not None and r["k"] < 2000 else [0.0, 0.0] for r in wide_rows.collect()}
    assert {r["id"]: r["out"] for r in found.collect()} == expected


def test_appended_days_and_repeated_keys(spark, name, wide_rows, tmp_path):
    doubled = vectors(spark, 0, 50).union(vectors(spark, 0, 50).withColumn("v", F.array(F.lit(-9.0), F.lit(1.0)).cast("array<float>")))
    odd = doubled.union(spark.createDataFrame([(None, [1.0, 1.0])], "k long, v array<float>"))
    stored = write_buckets(odd, name, ["k"], "v", 3, path=f"{tmp_path}/t")
    append_buckets(vectors(spark, 50, 90), stored)
    rows = {r["k"]: r["v"] for r in stored.read(spark).collect()}
    assert rows == {k: [-9.0, 1.0] if k < 50 else [float(k), 2.0] for k in range(90)}
    assert stored.read(spark).count() == 90 and open_buckets(spark, name).buckets == 3
    with pytest.raises(ValueError, match="has keys already"):
        append_buckets(vectors(spark, 89, 95), stored)
    assert stored.read(spark).count() == 90
    found = emb.lookup_vectors(wide_rows, stored.read(spark), ["k"], "v", 2, "out", buckets=3)
    assert found.count() == 3000 and found.where("k = 7 and out[0] = -9").count() == 1200


def test_what_is_refused(spark, name, wide_rows, tmp_path):
    stored = write_buckets(vectors(spark, 0, 5), name, ["k"], "v", 2, path=f"{tmp_path}/t")
    other = wide_rows.withColumn("k", F.col("k").cast("int"))
    with pytest.raises(ValueError, match="must be bigint"):
        emb.lookup_vectors(other, stored.read(spark), ["k"], "v", 2, "out", buckets=2)
    vectors(spark, 0, 5).write.format("parquet").option("path", f"{tmp_path}/plain").saveAsTable(f"{name}_plain")
    with pytest.raises(ValueError, match="not bucketed"):
        open_buckets(spark, f"{name}_plain")


def test_empty_table(spark, name, wide_rows, tmp_path):
    stored = write_buckets(vectors(spark, 0, 0), name, ["k"], "v", 2, path=f"{tmp_path}/t")
    found = emb.lookup_vectors(wide_rows, stored.read(spark), ["k"], "v", 2, "out", buckets=2)
    assert found.where("out[0] = 0 and out[1] = 0").count() == 3000
