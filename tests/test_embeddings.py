from __future__ import annotations

import datetime
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from rankframe import FeatureSpec
from rankframe.functions.hashing import buyer_hash, user_date_key
from rankframe.functions.vectors import clean_vector, has_embedding, pack_columns, vector_or_zeros
from rankframe.checks import queries
from rankframe.operators import embeddings as emb
from rankframe.operators import encode
from rankframe.operators.identity import distinct_buyer_days, distinct_products, staged_ids
from rankframe.operators.skew import hot_keys, lookup_join, one_row_per_key
from rankframe.plans import explain_text

SPEC = FeatureSpec(numeric=("x",), categorical=(), embedding_dim=2)
HISTORY = (
    "unified_buyer_id string, interaction_type string, valid_from timestamp, valid_to timestamp, "
    "user_average_product_search_document_embedding array<float>"
)


def at(day, hour=0):
    return datetime.datetime(2024, 1, day, hour)


def test_vector_rules(spark):
    df = spark.createDataFrame(
        [(None,), ([1.0, None, 3.0],), ([float("nan"), 0.0],), ([0.0, 0.0],)], "v array<float>"
    )
    got = [r[0] for r in df.select(clean_vector(F.col("v"), 2, cut=True)).collect()]
    assert got == [[0.0, 0.0], [1.0, 0.0], [0.0, 0.0], [0.0, 0.0]]
    flags = [r[0] for r in df.select(has_embedding(clean_vector(F.col("v"), 2, cut=True))).collect()]
    assert flags == [0.0, 1.0, 0.0, 0.0]


@pytest.mark.parametrize("vector", [[1.0], [1.0, 2.0, 3.0], []])
def test_vector_of_another_length_is_an_error(spark, vector):
    df = spark.createDataFrame([(vector,)], "v array<float>")
    with pytest.raises(Exception, match="should have 2 elements"):
        df.select(vector_or_zeros(F.col("v"), 2)).collect()


def test_pack_needs_every_column(spark):
    names = ["product_emb_0", "product_emb_1", "user_emb_0", "user_emb_1"]
    assert pack_columns(names, ("product_emb_", "user_emb_"), 2) is not None
    assert pack_columns(names[:3], ("product_emb_", "user_emb_"), 2) is None


def test_distinct_ids(spark):
    day = date(2024, 1, 1)
    df = spark.createDataFrame(
        [("a", 1, day), ("a", 1, day), ("a", None, day), (None, 2, day), ("b", 2, None)],
        "unified_buyer_id string, product_id long, event_timestamp_day date",
    )
    assert sorted(r[0] for r in distinct_products(df, SPEC).collect()) == [1, 2]
    assert distinct_buyer_days(df, SPEC).count() == 3
    with pytest.raises(RuntimeError), staged_ids(df, SPEC) as (products, pairs):
        assert products.is_cached and pairs.is_cached
        raise RuntimeError
    assert not products.is_cached and not pairs.is_cached


def test_product_embeddings_keep_table_duplicates(spark):
    table = spark.createDataFrame(
        [(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, None), (3, [9.0, 9.0])],
        "product_id long, product_search_document_embedding array<float>",
    )
    ids = spark.createDataFrame([(1,), (2,), (5,)], "product_id long")
    got = emb.product_embeddings(table, ids, SPEC).collect()
    assert sorted((r[0], r[1]) for r in got) == [(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [0.0, 0.0])]
    wide = emb.product_embeddings(table, ids, SPEC, expand=True)
    assert wide.columns == ["product_id", "product_emb_0", "product_emb_1"]


def versions(spark, rows, kind="timestamp"):
    df = spark.createDataFrame([(b, t, f, to, v) for b, t, f, to, v in rows], HISTORY)
    return df.withColumns({c: F.col(c).cast(kind) for c in ("valid_from", "valid_to")})


@pytest.mark.parametrize("block_days", [None, 1, 3, 1000])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_point_in_time_join(spark, kind, block_days):
    history = versions(
        spark,
        [
            ("a", "ORDER", at(1), at(3), [1.0, 1.0]),  # days 1 and 2
            ("a", "ORDER", at(3), None, [2.0, 2.0]),  # from day 3
            ("a", "CLICK", at(1), None, [9.0, 9.0]),  # other kind
            ("b", "ORDER", at(2, 5), at(4, 1), [3.0, 3.0]),  # begins during day 2
            ("c", "ORDER", at(1), None, [4.0, 4.0]),  # overlaps with the next
            ("c", "ORDER", at(2), None, [5.0, 5.0]),
            ("d", "ORDER", at(2, 3), at(2, 9), [6.0, 6.0]),  # seen by no midnight
            ("e", "ORDER", at(2), at(2), [7.0, 7.0]),  # empty
            ("f", "ORDER", at(9), None, [8.0, 8.0]),  # begins after all days
            (None, "ORDER", at(1), None, [8.0, 8.0]),
        ],
        kind,
    )
    wanted = [(b, date(2024, 1, d)) for b in "abcdef" for d in (1, 2, 3, 4)] + [
        (None, date(2024, 1, 2)),
        ("a", None),
    ]
    pairs = spark.createDataFrame(wanted, "unified_buyer_id string, event_timestamp_day date")
    got = emb.user_embeddings_at_day(history, pairs, SPEC, block_days=block_days)
    names = pairs.withColumn(
        "user_date_key", user_date_key(buyer_hash(F.col("unified_buyer_id")), F.col("event_timestamp_day"))
    )
    found = sorted(
        (r["unified_buyer_id"], r["event_timestamp_day"].day, r["user_emb"][0])
        for r in got.join(names, "user_date_key").collect()
    )
    assert found == [
        ("a", 1, 1.0),
        ("a", 2, 1.0),
        ("a", 3, 2.0),
        ("a", 4, 2.0),
        ("b", 3, 3.0),
        ("b", 4, 3.0),
        ("c", 1, 4.0),
        ("c", 2, 4.0),
        ("c", 2, 5.0),
        ("c", 3, 4.0),
        ("c", 3, 5.0),
        ("c", 4, 4.0),
        ("c", 4, 5.0),
    ]


def test_pruning_never_changes_the_join(spark):
    """Random histories: with and without the pruned rows, brute force over all pairs agrees."""
    rows = spark.sql(
        """select concat('b', id % 7) as unified_buyer_id, 'ORDER' as interaction_type,
           timestamp_seconds(1704067200 + pmod(xxhash64(id), 432000)) as valid_from,
           if(id % 4 = 0, null,
              timestamp_seconds(1704067200 + pmod(xxhash64(id), 432000) + pmod(xxhash64(id, 1), 200000)))
             as valid_to,
           array(float(id), 0f) as user_average_product_search_document_embedding
           from range(300)"""
    )
    pairs = spark.sql(
        "select concat('b', id % 7) as unified_buyer_id, "
        "date_add(date'2024-01-02', cast(id / 7 as int)) as event_timestamp_day from range(21)"
    )
    got = sorted(r["user_emb"][0] for r in emb.user_embeddings_at_day(rows, pairs, SPEC).collect())
    expected = []
    for p in pairs.collect():
        midnight = datetime.datetime.combine(p["event_timestamp_day"], datetime.time())
        for v in rows.collect():
            if (
                v["unified_buyer_id"] == p["unified_buyer_id"]
                and v["valid_from"] <= midnight
                and (v["valid_to"] is None or v["valid_to"] > midnight)
            ):
                expected.append(v["user_average_product_search_document_embedding"][0])
    assert got == sorted(expected)
    assert got


def lookup(spark, query, table, broadcast_bytes):
    df = spark.createDataFrame([(q, i) for i, q in enumerate(query)], "id long, row int")
    right = spark.createDataFrame(table, "id long, v array<float>")
    out = emb.lookup_vectors(df, right, ["id"], "v", 2, "out", broadcast_bytes=broadcast_bytes)
    return [r["out"] for r in out.orderBy("row").collect()]


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_lookup(spark, broadcast_bytes):
    table = [(10, [1.0, 1.0]), (30, [3.0, 3.0]), (20, [5.0, 2.0]), (20, [2.0, 2.0]), (50, None)]
    got = lookup(spark, [20, 99, 10, 20, None, 30, 50], table, broadcast_bytes)
    assert got == [
        [2.0, 2.0],
        [0.0, 0.0],
        [1.0, 1.0],
        [2.0, 2.0],
        [0.0, 0.0],
        [3.0, 3.0],
        [0.0, 0.0],
    ]
    assert lookup(spark, [], table, broadcast_bytes) == []
    assert lookup(spark, [1], [], broadcast_bytes) == [[0.0, 0.0]]


def test_hot_keys(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    hot = hot_keys(df, ["k"], 64).collect()
    assert [r["k"] for r in hot] == [-1]


def test_skewed_lookup_keeps_every_row_and_spreads_the_hot_key(spark):
    left = spark.range(0, 30_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 3 == 1, None)
        .otherwise(F.col("id"))
        .alias("k"),
    )
    right = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = lookup_join(left, right.union(right), ["k"], "v", small=False, parts=32)
    summary = out.agg(
        F.count("*"), F.count_distinct("id"), F.count_if(F.expr("k = 7 and v = 14")), F.count("v")
    ).head()
    assert summary[0] == summary[1] == 30_000
    assert summary[2] == 10_000
    assert summary[3] == 10_000 + sum(1 for i in range(20_000) if i % 3 == 2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = lookup_join(left, right.union(right), ["k"], "v", small=False, parts=32)
        sizes = out.filter("k = 7 or k is null").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in sizes) < 20_000 / 8 * 1.2


@pytest.mark.parametrize(
    ("kind", "keys"), [("string", ["k"]), ("int", ["k"]), ("date", ["k"]), ("string", ["d", "k"])]
)
def test_lookup_by_other_key_types(spark, kind, keys):
    cast = "date_add(date'2024-01-01', cast(id % 50 as int))" if kind == "date" else f"cast(id % 50 as {kind})"
    left = spark.range(3000).selectExpr("id", f"if(id % 2 = 0, {cast}, {cast.replace('id % 50', '1')}) as k")
    left = left.withColumn("d", F.expr("date'2024-01-01'"))
    right = spark.range(40).selectExpr(f"{cast} as k", "date'2024-01-01' as d", "id as v")
    got = lookup_join(left, right, keys, "v", small=False, parts=16)
    plain = left.join(right, ["k", "d"], "left").select(*left.columns, "v")
    assert got.columns == [*left.columns, "v"]
    assert got.count() == 3000
    assert got.exceptAll(plain).isEmpty()


def attach_frame(spark):
    return spark.createDataFrame(
        [(1, 5, date(1970, 1, 3)), (2, None, None), (None, 5, date(1970, 1, 4))],
        "product_id long, ubi_hash long, event_timestamp_day date",
    )


def test_combined_vector(spark):
    products = spark.createDataFrame(
        [(1, [1.0, 2.0]), (2, [3.0, 4.0])], "product_id long, product_emb array<float>"
    )
    users = spark.createDataFrame(
        [(500_002, [7.0, 8.0, 9.0])], "user_date_key long, user_emb array<float>"
    )
    df = attach_frame(spark)
    both = emb.attach_embeddings(df, SPEC, products, users, user_dim=3)
    assert sorted(r["emb"] for r in both.collect()) == [
        [0.0, 0.0, 0.0, 0.0, 0.0],
        [1.0, 2.0, 7.0, 8.0, 9.0],
        [3.0, 4.0, 0.0, 0.0, 0.0],
    ]
    assert both.columns == [*df.columns, "emb"]
    only = emb.attach_embeddings(df, SPEC, None, users, user_dim=3)
    assert sorted(r["emb"] for r in only.collect())[-1] == [7.0, 8.0, 9.0]
    assert emb.attach_embeddings(df, SPEC, None, None) is df


def test_user_lookup_on_plain_columns(spark):
    df = spark.createDataFrame(
        [("a", date(2024, 1, 1)), ("b", date(2024, 1, 1))],
        "unified_buyer_id string, event_timestamp_day date",
    )
    users = spark.createDataFrame(
        [("a", date(2024, 1, 1), [1.0, 2.0])],
        "unified_buyer_id string, event_timestamp_day date, user_emb array<float>",
    )
    got = emb.attach_embeddings(
        df, SPEC, None, users, user_keys=("unified_buyer_id", "event_timestamp_day")
    )
    assert sorted((r[0], r["emb"]) for r in got.collect()) == [("a", [1.0, 2.0]), ("b", [0.0, 0.0])]


def test_restless_history_is_cut_to_one_version_per_day(spark):
    """A buyer with thousands of versions a day must not reach the join with all of them."""
    history = spark.sql(
        """select 'hot' as unified_buyer_id, 'ORDER' as interaction_type,
           timestamp_seconds(1704067200 + id * 60) as valid_from,
           timestamp_seconds(1704067200 + (id + 1) * 60) as valid_to,
           array(float(id), 0f) as user_average_product_search_document_embedding
           from range(14400)"""  # ten days of one version per minute
    )
    pairs = spark.sql(
        "select 'hot' as unified_buyer_id, date_add(date'2024-01-02', cast(id as int)) as event_timestamp_day "
        "from range(5)"
    )
    assert emb.prune_history(history, pairs, SPEC).count() <= 6
    got = sorted(r["user_emb"][0] for r in emb.user_embeddings_at_day(history, pairs, SPEC).collect())
    assert got == [1440.0 * d for d in range(1, 6)]


def rows_scanned(df):
    """Rows that the scans of an executed query put out."""
    return rows_of(df, "Scan parquet")


def rows_of(df, operator):
    """Rows that the operators of this name put out when the query runs."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    text, found = [plan], 0
    while text:
        node = text.pop()
        if node.nodeName().startswith(operator):
            found += node.metrics().apply("numOutputRows").value()
        if node.nodeName() == "AdaptiveSparkPlan":
            text.append(node.executedPlan())
        elif node.nodeName().startswith(("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage")):
            text.append(node.plan())
        children = node.children()
        text += [children.apply(i) for i in range(children.size())]
    return found


def test_history_bounds_reach_the_scan(spark, tmp_path):
    start = datetime.datetime(2020, 1, 1, tzinfo=datetime.timezone.utc)
    history = spark.range(20_000).select(
        F.concat(F.lit("b"), F.col("id") % 50).alias("unified_buyer_id"),
        F.lit("ORDER").alias("interaction_type"),
        (F.lit(start) + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("valid_from"),
        (F.lit(start) + F.make_dt_interval(hours=(F.col("id") + 30).cast("int"))).alias("valid_to"),
        F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>").alias(
            "user_average_product_search_document_embedding"
        ),
    )
    ordered = history.repartitionByRange(20, "valid_from").sortWithinPartitions("valid_from")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")  # has statistics
    ordered.write.parquet(f"{tmp_path}/t")
    spark.conf.unset("spark.sql.parquet.outputTimestampType")
    pairs = spark.createDataFrame([("b1", date(2020, 3, 1)), ("b2", date(2020, 3, 3))], "unified_buyer_id string, event_timestamp_day date")
    pruned = emb.prune_history(spark.read.parquet(f"{tmp_path}/t"), pairs, SPEC).select("valid_from")
    assert 0 < rows_scanned(pruned) <= 4000
    none = emb.prune_history(spark.read.parquet(f"{tmp_path}/t"), pairs.limit(0), SPEC)
    assert none.count() == 0


def test_lookup_plans(spark, tmp_path):
    """Vectors of keys that occur once are neither sorted by value nor gathered in one task."""
    vector = F.array(F.col("id").cast("float"), F.lit(2.0).cast("float"))
    spark.range(2000).select(F.col("id").alias("k"), vector.alias("v")).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    found = emb.lookup_vectors(spark.range(5000).withColumnRenamed("id", "k"), table, ["k"], "v", 2, "out", broadcast_bytes=0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "LocalLimit" not in plan
    assert found.where("out[1] = 2").count() == 2000


def test_repeated_keys_move_no_other_vector(spark, tmp_path):
    """Only rows of keys that occur more than once are shuffled, though nothing is small enough to be broadcast unasked."""
    vector = F.array(F.col("id").cast("float"), F.lit(2.0).cast("float"))
    rows = spark.range(2000).select((F.col("id") % 1990).alias("k"), vector.alias("v"))
    rows.union(spark.createDataFrame([(None, [1.0, 1.0])], "k long, v array<float>")).write.parquet(f"{tmp_path}/t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        reduced = one_row_per_key(spark.read.parquet(f"{tmp_path}/t"), ["k"], "v")
        exchanged = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", explain_text(reduced))
        found = reduced.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert exchanged and not [x for x in exchanged if re.search(r"\bv#", x)]
    assert sorted((r["k"], r["v"]) for r in found if r["k"] is not None) == [(k, [float(k), 2.0]) for k in range(1990)]
    assert [r["v"] for r in found if r["k"] is None] == [[1.0, 1.0]]


def long_history(spark, n, copies=1):
    """One buyer: a version for each of ``n`` days, ``copies`` times, and one that spans all."""
    return spark.sql(
        f"""select 'hot' as unified_buyer_id, 'ORDER' as interaction_type,
           if(id = {n}, timestamp'2024-01-01', timestamp_seconds(1704067200 + id * 86400 - 3600)) as valid_from,
           if(id = {n}, null, timestamp_seconds(1704067200 + id * 86400 + 82800)) as valid_to,
           array(float(id + {n} * copy), 0f) as user_average_product_search_document_embedding
           from range({n} + 1) cross join (select explode(sequence(0, {copies - 1})) as copy)"""
    )


def days_of_one_buyer(spark, n):
    return spark.sql(
        f"select 'hot' as unified_buyer_id, date_add(date'2024-01-01', cast(id as int)) as event_timestamp_day from range({n})"
    )


def test_blocks_find_what_the_plain_join_finds(spark):
    history, pairs = long_history(spark, 40, copies=2), days_of_one_buyer(spark, 50)
    key = lambda r: (r["user_date_key"], r["user_emb"])
    expected = sorted(map(key, emb.user_embeddings_at_day(history, pairs, SPEC).collect()))
    assert len(expected) == 2 * (40 + 50)
    for block_days in (1, 7, 100):
        found = emb.user_embeddings_at_day(history, pairs, SPEC, block_days=block_days)
        assert sorted(map(key, found.collect())) == expected
    assert emb.user_embeddings_at_day(history, pairs.limit(0), SPEC, block_days=7).count() == 0
    assert emb.user_embeddings_at_day(history.limit(0), pairs, SPEC, block_days=7).count() == 0
    with pytest.raises(ValueError):
        emb.user_embeddings_at_day(history, pairs, SPEC, block_days=0)


def test_block_join_keys_stay_small(spark):
    """Twice the days and versions of one buyer give about twice the rows of the join's sides,
    and no (buyer, block) holds more than its days and the versions over them."""
    made = {}
    for n in (60, 120):
        history, pairs = long_history(spark, n), days_of_one_buyer(spark, n)
        joined = emb.user_embeddings_at_day(history, pairs, SPEC, block_days=10)
        assert "_day_block" in explain_text(joined) and "_block" in explain_text(joined)
        made[n] = rows_of(joined, "Generate")
    # a version a day, some reaching over the end of a block, and one over all blocks
    assert 60 < made[60] <= 61 + 3 * 7 and made[120] <= 2 * made[60] + 2


@pytest.mark.parametrize("name", ["user_embeddings_asof", "user_embeddings_in_blocks", "preproject_users"])
def test_pairs_are_stored_before_they_are_read_again(spark, sf_dir, monkeypatch, name):
    plans, original = [], emb.user_embeddings_at_day

    def watched(history, pairs, *args, **options):
        plans.append(pairs._jdf.queryExecution().optimizedPlan().toString())
        return original(history, pairs, *args, **options)

    monkeypatch.setattr(emb, "user_embeddings_at_day", watched)
    queries()[name](spark, sf_dir)
    assert plans and not any("Join" in p for p in plans)


def test_the_fit_does_not_join_vectors(spark, sf_dir, monkeypatch):
    plans, original = [], encode.fit

    def watched(df, *args, **options):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return original(df, *args, **options)

    monkeypatch.setattr(encode, "fit", watched)
    queries()["wide_embeddings_packed"](spark, sf_dir)
    assert plans and not any("Join" in p for p in plans)
