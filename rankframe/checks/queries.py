"""One query per operator, over the whole fixture tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankframe import fixtures as fx
from rankframe.functions.hashing import buyer_hash, concat_key, hash_mod, hashed_id, user_date_key
from rankframe.functions.vectors import has_embedding
from rankframe.operators import batches, embeddings, encode, identity, metrics, sampling, scoring
from rankframe.operators.quantiles import quantile_boundaries
from rankframe.operators.skew import narrow_columns
from rankframe.operators.vocabulary import (
    distinct_categories,
    number_categories,
    vocabulary_sizes,
)
from rankframe.plans.day_fits import boundaries_of_days, count_days, fit_days
from rankframe.plans.export import export_split
from rankframe.plans.model_ready import (
    base_training_table,
    embedding_tables,
    finetune_table,
    model_ready,
)
from rankframe.plans.pointwise import split_rows
from rankframe.plans.projections import read_projections, update_projections
from rankframe.session import materialize, scratch_path
from rankframe.sources.buckets import BucketedTable, append_buckets, write_buckets
from rankframe.sources.catalog import TableCatalog
from rankframe.sources.days import read_days, write_days
from rankframe.sources.splits import read_split, write_projected, write_split
from rankframe.sources.state import (
    PreprocessorState,
    load_artifacts,
    load_model_shape,
    publish_artifacts,
    write_artifacts,
)
from rankframe.sources.versions import open_version
from rankframe.spec import ModelShape, PreprocessConfig, resolve_window

Query = Callable[[SparkSession, str], DataFrame]

SPEC = fx.SPEC
KEYS = SPEC.keys
WINDOW = (date(1996, 6, 1), date(2001, 6, 1))
USER_SAMPLE_PCT = 30
BATCH_ROWS = 256
N_BINS = fx.ENCODING.n_bins
ONE_SCAN_SHARE = 0.5
MANY_CATEGORIES = (*SPEC.categorical, "product_text", "buyer_text", "pair_text")


# --- shared pieces ---------------------------------------------------------------------------


def shown(df: DataFrame) -> DataFrame:
    """Nulls and NaN as ordinary values, so that results compare the same way in any client."""
    stand_ins: list[Column] = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if field.dataType in (T.DoubleType(), T.FloatType()):
            value = F.coalesce(F.nanvl(value, F.lit(-2.0)), F.lit(-1.0))
        elif isinstance(field.dataType, T.IntegralType):
            value = F.coalesce(value, F.lit(-1).cast(field.dataType))
        elif field.dataType == T.StringType():
            value = F.coalesce(value, F.lit("(null)"))
        stand_ins.append(value.alias(field.name))
    return df.select(*stand_ins)


def _shown(query: Query) -> Query:
    return lambda spark, sf_dir: shown(query(spark, sf_dir))


def base_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_rows(fx.interactions(spark, sf_dir), fx.WHOLE_RANGE, SPEC, "base_train")


def month_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_rows(fx.interactions(spark, sf_dir), fx.MONTH, SPEC, "finetune")


def stored_base(spark: SparkSession, sf_dir: str, more: dict[str, Column] | None = None) -> DataFrame:
    """The base split written in even files, as an export leaves it; ``more`` columns beside its own."""
    root = scratch_path(spark)
    write_split(base_split(spark, sf_dir).withColumns(more or {}), root, "base_train", even_files=True)
    return read_split(spark, root, "base_train")


def prepared_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base split as later stages see it: written once, then read and cleaned."""
    return encode.prepare(stored_base(spark, sf_dir), SPEC)


def vector_sums(vector: Column, name: str) -> list[Column]:
    """Plain and position-weighted sum; together they notice a moved or changed element."""
    weighted = F.transform(vector, lambda x, i: x.cast("double") * (i + 1))

    def total(values: Column) -> Column:
        summed = F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double"))
        return F.round(summed, 6) + F.lit(0.0)

    return [total(vector).alias(f"{name}_sum"), total(weighted).alias(f"{name}_dot")]


def spread(vector: str, names, prefix: str, kind: str) -> list[Column]:
    return [F.get(vector, F.lit(i)).cast(kind).alias(f"{prefix}{n}") for i, n in enumerate(names)]


def fixture_catalog(spark: SparkSession, sf_dir: str) -> TableCatalog:
    """Temporary views that play the role of the source tables."""
    fx.interactions(spark, sf_dir).createOrReplaceTempView("fixture_interactions")
    fx.product_embedding_table(spark, sf_dir).createOrReplaceTempView("fixture_products")
    fx.embedding_history(spark, sf_dir).createOrReplaceTempView("fixture_history")
    return TableCatalog(
        interactions="fixture_interactions",
        product_embeddings="fixture_products",
        embedding_history="fixture_history",
    )


# --- sources and sinks -----------------------------------------------------------------------


def split_scan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark)
    write_split(base_split(spark, sf_dir), root, "base_train")
    split = read_split(spark, root, "base_train")
    ids = identity.id_counts(identity.id_columns(split, SPEC), SPEC)
    return identity.split_summary(split).select(
        "n_rows",
        "n_cols",
        ids.select("n_products").scalar().alias("n_products"),
        ids.select("n_buyer_days").scalar().alias("n_buyer_days"),
    )


def split_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark)
    write_split(base_split(spark, sf_dir), root, "base_train")
    return read_split(spark, root, "base_train").select(
        *KEYS, SPEC.target, SPEC.buyer_hash, "price", "brand"
    )


# --- row selection ---------------------------------------------------------------------------


def _surface(surface: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = fx.interactions(spark, sf_dir)
        return (
            rows.filter(sampling.in_day_window(F.col(SPEC.day), *WINDOW))
            .filter(sampling.on_surface(surface))
            .select(*KEYS, "page_type", "section_id", "campaign_id")
        )

    return run


def user_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sampling.sample_users(fx.interactions(spark, sf_dir), USER_SAMPLE_PCT, SPEC, "md5")
    return rows.select(*KEYS, "price")


def positive_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.interactions(spark, sf_dir).filter(sampling.on_surface("all"))
    return sampling.positive_rate(rows, SPEC).select(
        "pos_rate",
        sampling.negative_threshold(F.col("pos_rate"), fx.WHOLE_RANGE.negative_scale).alias(
            "threshold"
        ),
    )


def negative_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.interactions(spark, sf_dir).filter(sampling.on_surface("all"))
    kept = sampling.downsample_negatives(rows, fx.WHOLE_RANGE, SPEC)
    return kept.select(*KEYS, SPEC.label, "price")


def one_scan_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positives are a hundredth here, so half of the negatives is more than stays."""
    rows = fx.interactions(spark, sf_dir).filter(sampling.on_surface("all"))
    kept = sampling.downsample_in_one_scan(
        rows.select(*KEYS, SPEC.label, "price"), fx.WHOLE_RANGE, SPEC, thin_share=ONE_SCAN_SHARE
    )
    return kept.select(*KEYS, SPEC.label, "price")


def one_scan_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base split as an export writes it that reads the source once."""
    root = scratch_path(spark)
    cfg = replace(fx.WHOLE_RANGE, thin_share=ONE_SCAN_SHARE)
    export_split(spark, fixture_catalog(spark, sf_dir), cfg, SPEC, "base_train", root)
    return read_split(spark, root, "base_train")


def warehouse_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and negatives that a warehouse with FarmHash fingerprints would pick."""
    cfg = replace(fx.WHOLE_RANGE, hash_algo="farm", user_sample_pct=60)
    window = resolve_window(cfg, "base_train")
    rows = sampling.eligible_rows(fx.interactions(spark, sf_dir), cfg, SPEC, *window)
    kept = sampling.downsample_negatives(rows, cfg, SPEC)
    return kept.select(
        *KEYS,
        SPEC.label,
        buyer_hash(F.col(SPEC.buyer), "farm").alias("ubi_hash"),
        sampling.triple_hash(cfg, SPEC).alias("row_hash"),
    )


# --- ids and embeddings ----------------------------------------------------------------------


def distinct_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.distinct_products(base_split(spark, sf_dir), SPEC)


def distinct_buyer_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.distinct_buyer_days(base_split(spark, sf_dir), SPEC)


def product_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = identity.distinct_products(base_split(spark, sf_dir), SPEC)
    table = embeddings.product_embeddings(fx.product_embedding_table(spark, sf_dir), ids, SPEC)
    return table.select(SPEC.product, *vector_sums(F.col(embeddings.PRODUCT_VECTOR), "emb"))


def _embeddings_asof(block_days: int | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pairs = materialize(identity.distinct_buyer_days(fx.interactions(spark, sf_dir), SPEC))
        history = fx.embedding_history(spark, sf_dir)
        table = embeddings.user_embeddings_at_day(
            history, pairs, SPEC, hash_algo="md5", block_days=block_days
        )
        return table.select(
            embeddings.USER_KEY, *vector_sums(F.col(embeddings.USER_VECTOR), "emb")
        )

    return run


def embedding_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark)
    export_split(spark, fixture_catalog(spark, sf_dir), fx.WHOLE_RANGE, SPEC, "base_train", root)
    products, users = embedding_tables(spark, root, SPEC)
    return products.select(
        F.lit("product").alias("source"),
        F.col(SPEC.product).alias("id"),
        *vector_sums(F.col(embeddings.PRODUCT_VECTOR), "emb"),
    ).unionByName(
        users.select(
            F.lit("user").alias("source"),
            F.col(embeddings.USER_KEY).alias("id"),
            *vector_sums(F.col(embeddings.USER_VECTOR), "emb"),
        )
    )


def _embedding_lookup(**options) -> Query:
    return lambda spark, sf_dir: _looked_up(spark, sf_dir, **options)


def _in_buckets(table: DataFrame, name: str, key: str, vector: str) -> BucketedTable:
    """Stored in two writes: keys with an even hash, then, as another day's, the others."""
    table = table.withColumn(key, F.col(key).cast("long"))
    first = F.pmod(F.xxhash64(key), F.lit(2)) == 0
    path = scratch_path(table.sparkSession)
    name = f"{name}_{path.rpartition('-')[2]}"
    stored = write_buckets(table.where(first), name, [key], vector, 8, path=path)
    append_buckets(table.where(~first), stored)
    return stored


def _looked_up(spark: SparkSession, sf_dir: str, bucketed: bool = False, **options) -> DataFrame:
    split = stored_base(spark, sf_dir).select(*KEYS, SPEC.buyer_hash)
    pairs = identity.distinct_buyer_days(split, SPEC)
    products = fx.product_embedding_table(spark, sf_dir).withColumnRenamed(
        "product_search_document_embedding", embeddings.PRODUCT_VECTOR
    )
    users = embeddings.user_embeddings_at_day(
        fx.embedding_history(spark, sf_dir), pairs, SPEC, hash_algo="md5"
    )
    products, users = materialize(products), materialize(users)
    if bucketed:
        products = _in_buckets(products, "products", SPEC.product, embeddings.PRODUCT_VECTOR)
        users = _in_buckets(users, "users", embeddings.USER_KEY, embeddings.USER_VECTOR)
    found = embeddings.attach_embeddings(split, SPEC, products, users, **options)
    dim = SPEC.embedding_dim
    product, user = F.slice("emb", 1, dim), F.slice("emb", dim + 1, dim)
    return found.select(
        *KEYS,
        user_date_key(F.col(SPEC.buyer_hash), F.col(SPEC.day)).alias("user_date_key"),
        *vector_sums(product, "product"),
        *vector_sums(user, "user"),
        has_embedding(product).cast("double").alias("has_product"),
        has_embedding(user).cast("double").alias("has_user"),
    )


# --- cleaning, fitting, encoding ---------------------------------------------------------------


def clean_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode.prepare(base_split(spark, sf_dir), SPEC)
    return rows.select(
        *KEYS,
        *[F.col(c).cast("double").alias(c) for c in SPEC.numeric],
        *SPEC.categorical,
        F.coalesce(F.col(SPEC.target), F.lit(0)).cast("double").alias(SPEC.target),
    )


def _bound_rows(bounds: DataFrame) -> DataFrame:
    return bounds.select("feature", F.posexplode("bounds").alias("pos", "bound")).select(
        "feature", (F.col("pos") + 1).alias("pos"), F.col("bound").cast("double").alias("bound")
    )


def fitted_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bound_rows(quantile_boundaries(prepared_base(spark, sf_dir), SPEC.numeric, N_BINS))


def month_days() -> list[date]:
    start, stop = resolve_window(fx.MONTH, "finetune")
    return [start + timedelta(days=i) for i in range((stop - start).days)]


def _month_in_days(spark: SparkSession, sf_dir: str) -> str:
    """The month in day folders: wrong prices at first, then its second half is run again.

    The days are counted in between, so later fits find old and outdated counts.
    """
    root, days = scratch_path(spark), month_days()
    write_split(month_split(spark, sf_dir), root, "all", even_files=True)
    rows = read_split(spark, root, "all")
    late = F.col(SPEC.day) >= F.lit(days[15])
    wrong = F.when(late, F.col("price") * -3).otherwise(F.col("price"))
    write_days(rows.withColumn("price", wrong), root, "month", SPEC.day, days, even_files=True)
    count_days(spark, root, "month", days[:20], SPEC.numeric)
    write_days(rows.filter(late), root, "month", SPEC.day, days[15:], even_files=True)
    return root


def day_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = read_days(spark, _month_in_days(spark, sf_dir), "month", month_days())
    return stored.select(*SPEC.split_columns, SPEC.target, "ubi_hash")


def boundaries_by_day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _month_in_days(spark, sf_dir)
    return _bound_rows(boundaries_of_days(spark, root, "month", month_days(), SPEC.numeric, N_BINS))


def window_fit_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month's rows in bins that are fitted on its days."""
    root = _month_in_days(spark, sf_dir)
    state = fit_days(spark, root, "month", month_days(), SPEC, fx.ENCODING)
    rows = encode.prepare(read_days(spark, root, "month"), SPEC)
    return _binned(rows, state)


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return number_categories(distinct_categories(prepared_base(spark, sf_dir), SPEC.categorical))


def vocabulary_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interaction keys as a category: many values, numbered in many ranges."""
    rows = fx.interactions(spark, sf_dir).select(
        F.concat_ws("|", SPEC.buyer, SPEC.product, SPEC.day).alias("triple")
    )
    distinct = materialize(distinct_categories(rows, ["triple"]))
    return number_categories(distinct, value_bytes=1 << 14)


def vocab_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary_sizes(base_split(spark, sf_dir), SPEC.categorical)


def quantile_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared_base(spark, sf_dir)
    state = encode.fit(rows, SPEC, fx.ENCODING)
    return _binned(rows, state)


def _binned(rows: DataFrame, state: PreprocessorState) -> DataFrame:
    coded = encode.encode(rows, state, SPEC, with_bins=True)
    return coded.select(*KEYS, *spread("bins", SPEC.numeric, "bin_", "int"))


def category_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows on purpose: their nulls and a vocabulary that has none meet here."""
    split = stored_base(spark, sf_dir)
    state = encode.fit(split, SPEC, fx.ENCODING)
    coded = encode.category_ids(split, state, {c: c for c in state.categories})
    return coded.select(*KEYS, *[f"{c}_id" for c in state.categories])


def category_ids_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every vocabulary too large to be broadcast."""
    split = stored_base(spark, sf_dir)
    state = encode.fit(split, SPEC, fx.ENCODING)
    coded = encode.category_ids(split, state, {c: c for c in state.categories}, broadcast_bytes=0)
    return coded.select(*KEYS, *[f"{c}_id" for c in state.categories])


def category_ids_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine vocabularies, two with many values, all too large to be broadcast."""
    texts = {
        "product_text": F.col(SPEC.product).cast("string"),
        "buyer_text": F.col(SPEC.buyer),
        "pair_text": F.concat_ws("|", "brand", "segment"),
    }
    split = stored_base(spark, sf_dir, texts)
    spec = replace(SPEC, categorical=MANY_CATEGORIES)
    state = encode.fit(split, spec, fx.ENCODING)
    coded = encode.category_ids(split, state, {c: c for c in state.categories}, broadcast_bytes=0)
    return coded.select(*KEYS, *[f"{c}_id" for c in MANY_CATEGORIES])


def hashed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets, _ = fx.ENCODING.id_hash[SPEC.shop]
    return fx.interactions(spark, sf_dir).select(
        *KEYS, hashed_id(F.col(SPEC.shop), buckets, "md5").alias("shop_code")
    )


def _encoded_columns(state: PreprocessorState) -> list[Column]:
    return [
        *[F.col(k) for k in KEYS],
        *spread("num", state.numeric, "num_", "double"),
        *spread("bins", state.numeric, "bin_", "int"),
        *spread("cat", state.encoded_order, "cat_", "int"),
    ]


def full_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared_base(spark, sf_dir)
    state = encode.fit(rows, SPEC, fx.ENCODING)
    coded = encode.encode(rows, state, SPEC, with_bins=True)
    return coded.select(*_encoded_columns(state), F.col("target").cast("double").alias("target"))


def serving_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared_base(spark, sf_dir)
    root = scratch_path(spark)
    write_artifacts(spark, encode.fit(rows, SPEC, fx.ENCODING), fx.ENCODING, SPEC, root)
    state = load_artifacts(spark, root)
    coded = encode.encode(rows, state, SPEC, mode="serving", with_bins=True)
    return coded.select(*_encoded_columns(state))


def published_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving from the current artifacts, after those of the month were published and replaced."""
    root, rows = scratch_path(spark), prepared_base(spark, sf_dir)
    for fitted_on in (encode.prepare(month_split(spark, sf_dir), SPEC), rows):
        publish_artifacts(spark, encode.fit(fitted_on, SPEC, fx.ENCODING), fx.ENCODING, SPEC, root)
    state = load_artifacts(spark, open_version(spark, root).path)
    coded = encode.encode(rows, state, SPEC, mode="serving", with_bins=True)
    return coded.select(*_encoded_columns(state))


def train_serve_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared_base(spark, sf_dir)
    root = scratch_path(spark)
    state = encode.fit(rows, SPEC, fx.ENCODING)
    write_artifacts(spark, state, fx.ENCODING, SPEC, root)
    return encode.encoding_mismatches(rows, state, load_artifacts(spark, root), SPEC)


def finetune_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark)
    encode.fit(prepared_base(spark, sf_dir), SPEC, fx.ENCODING).save(spark, root)
    state = PreprocessorState.load(spark, root)
    rows = encode.prepare(month_split(spark, sf_dir), SPEC)
    coded = encode.encode(rows, state, SPEC, with_bins=True)
    return coded.select(*_encoded_columns(state), F.col("target").cast("double").alias("target"))


# --- assembled tables --------------------------------------------------------------------------


def wide_embeddings_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A split that carries its embeddings as wide columns, packed while it is encoded."""
    split = stored_base(spark, sf_dir)
    vectors = fx.product_embedding_table(spark, sf_dir)
    vector = "product_search_document_embedding"
    best = embeddings.unique_vectors(vectors, [SPEC.product], vector)
    dim = SPEC.embedding_dim
    wide = split.join(best, SPEC.product, "left").select(
        *split.columns,
        *[F.get(vector, F.lit(i)).alias(f"product_emb_{i}") for i in range(dim)],
        *[(F.get(vector, F.lit(dim - 1 - i)) * 2).alias(f"user_emb_{i}") for i in range(dim)],
    )
    # the features are the split's own: a fit on the wide rows would join the vectors for every pass
    state = encode.fit(encode.prepare(split, SPEC), SPEC, fx.ENCODING)
    coded = encode.encode(encode.prepare(wide, SPEC), state, SPEC)
    return coded.select(*KEYS, F.size("emb").alias("width"), *vector_sums(F.col("emb"), "emb"))


def two_exports_one_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base split and a later month exported into one root; both tables built afterwards."""
    root, catalog = scratch_path(spark), fixture_catalog(spark, sf_dir)
    export_split(spark, catalog, fx.WHOLE_RANGE, SPEC, "base_train", root)
    export_split(spark, catalog, fx.MONTH, SPEC, "finetune", root)
    base, state = base_training_table(spark, root, SPEC, fx.ENCODING)
    month = finetune_table(spark, root, SPEC, state)

    def columns(table: DataFrame, name: str) -> DataFrame:
        cats = spread("cat", state.encoded_order, "cat_", "int")
        return table.select(F.lit(name).alias("split"), *KEYS, *cats, *vector_sums(F.col("emb"), "emb"))

    return columns(base, "base_train").unionByName(columns(month, "finetune"))


def model_ready_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark)
    export_split(spark, fixture_catalog(spark, sf_dir), fx.WHOLE_RANGE, SPEC, "base_train", root)
    table, state = base_training_table(spark, root, SPEC, fx.ENCODING)
    return table.select(
        *KEYS,
        *spread("cat", state.encoded_order, "cat_", "int"),
        F.col("target").cast("double").alias("target"),
        *vector_sums(F.col("emb"), "emb"),
    )


def training_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base_split(spark, sf_dir).select(*KEYS, "price")
    return batches.training_batches(rows, BATCH_ROWS, order_by=[*KEYS, "price"])


def shuffled_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row lands where is arbitrary, so batches are described by size and positions, and
    all rows together by a sum that changes if any is lost, doubled or altered."""
    rows = base_split(spark, sf_dir).select(*KEYS, "price", SPEC.target)
    batched = batches.training_batches(rows, BATCH_ROWS, seed=42)
    key = concat_key(F.col(SPEC.buyer), F.col(SPEC.product), F.col(SPEC.day))
    own = F.coalesce(hash_mod(key, 1_000_000, "md5"), F.lit(0)) + F.col(SPEC.target)
    everything = batched.agg(F.sum(own)).scalar()
    return (
        batched.withColumn("row_sum", everything)
        .groupBy("batch_id", "row_sum")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("pos").alias("first_pos"),
            F.max("pos").alias("last_pos"),
        )
    )


# --- losses and parity -------------------------------------------------------------------------


def _scored_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.interactions(spark, sf_dir).select(
        ((F.col("quantity") - 25.0) / 8.0).alias("score"),
        F.when(F.col(SPEC.label), 1).otherwise(0).alias("target"),
    )


def focal_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    loss = metrics.epoch_loss(_scored_fixture(spark, sf_dir))
    plain = metrics.focal_loss(_scored_fixture(spark, sf_dir), gamma=0.0, alpha=0.5)
    names = ("focal_loss", "logit_penalty", "total_loss")
    return loss.select(
        "n_rows",
        *[F.round(n, 9).alias(n) for n in names],
        F.round(plain.scalar(), 9).alias("half_bce"),
    )


def score_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals against their dearest lines: not equal, some orders have no line; every
    seventh order occurs twice, with another total, on one side."""
    totals = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"),
        F.explode(
            F.when(F.col("o_orderkey") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        ).alias("extra"),
        "o_totalprice",
    ).select("o_orderkey", (F.col("o_totalprice") / 100000 + F.col("extra")).alias("score"))
    sums = (
        fx.table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg((F.max("l_extendedprice") / 100000).alias("score"))
    )
    return metrics.score_parity(totals, sums, ["o_orderkey"]).select(
        "n_matched",
        "n_unmatched",
        "n_repeated",
        F.round("max_abs_diff", 9).alias("max_abs_diff"),
        F.round("mean_abs_diff", 9).alias("mean_abs_diff"),
        "passed",
    )


# --- model application -------------------------------------------------------------------------


def _projected(spark: SparkSession, table: DataFrame, source: str, key: str, vector: str) -> DataFrame:
    weights = scoring.load_weights(fx.weight_table(spark, {}), "float64")
    projected = scoring.project_embeddings(
        table,
        weights,
        source,
        id_column=key,
        vector=vector,
        dim=SPEC.embedding_dim,
        dtype="float64",
    )
    root = scratch_path(spark)
    write_projected(projected, root, f"{source}_embeddings", fx.PROJECTED_DIM, expand=True)
    names = [f"proj_emb_{i}" for i in range(fx.PROJECTED_DIM)]
    return read_split(spark, root, f"{source}_embeddings_projected").select(
        key,
        *[(F.round(n, 6) + F.lit(0.0)).alias(n) for n in names],
        F.col("has_emb").cast("double").alias("has_emb"),
    )


def preproject_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = fx.product_embedding_table(spark, sf_dir)
    return _projected(
        spark, table, "product", SPEC.product, "product_search_document_embedding"
    )


def projections_in_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products without every seventh id and with old vectors first, then the whole table."""
    table = materialize(fx.product_embedding_table(spark, sf_dir))
    vector, root = "product_search_document_embedding", scratch_path(spark)
    weights = scoring.load_weights(fx.weight_table(spark, {}), "float64")
    old = F.when(F.col(SPEC.product) % 5 == 0, F.reverse(vector)).otherwise(F.col(vector))
    first = table.filter(F.col(SPEC.product) % 7 != 0).withColumn(vector, old)
    for increment in (first, table):
        update_projections(
            increment, weights, "product", root,
            id_column=SPEC.product, vector=vector, dim=SPEC.embedding_dim, dtype="float64",
        )
    return read_projections(spark, root, "product").select(
        SPEC.product,
        *[(F.round(F.get("proj", F.lit(i)), 6) + F.lit(0.0)).alias(f"proj_emb_{i}") for i in range(fx.PROJECTED_DIM)],
        F.col("has_emb").cast("double").alias("has_emb"),
    )


def preproject_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = materialize(identity.distinct_buyer_days(base_split(spark, sf_dir), SPEC))
    table = embeddings.user_embeddings_at_day(
        fx.embedding_history(spark, sf_dir), pairs, SPEC, hash_algo="md5"
    )
    return _projected(spark, table, "user", embeddings.USER_KEY, embeddings.USER_VECTOR)


def _scoring_input(
    spark: SparkSession, sf_dir: str
) -> tuple[DataFrame, PreprocessorState, DataFrame, DataFrame]:
    """Prepared base split, the state fitted on it, and the embedding tables."""
    root = scratch_path(spark)
    export_split(spark, fixture_catalog(spark, sf_dir), fx.WHOLE_RANGE, SPEC, "base_train", root)
    rows = encode.prepare(read_split(spark, root, "base_train"), SPEC)
    state = encode.fit(rows, SPEC, fx.SCORING)
    return rows, state, *embedding_tables(spark, root, SPEC)


def _coded(rows: DataFrame, state: PreprocessorState) -> DataFrame:
    """Codes and bins without vectors, stored: both ways of scoring read them, and key counts too."""
    return materialize(encode.encode(rows, state, SPEC, keep=[*KEYS, SPEC.buyer_hash], with_bins=True))


def _weights(spark: SparkSession, state: PreprocessorState, with_embeddings: bool = True):
    table = fx.weight_table(spark, dict(state.vocab_sizes), with_embeddings)
    return scoring.load_weights(table, "float64")


def _saved(
    spark: SparkSession, state: PreprocessorState, cfg: PreprocessConfig
) -> tuple[PreprocessorState, ModelShape]:
    """State and model shape as a server gets them: from artifacts."""
    root = scratch_path(spark)
    write_artifacts(spark, state, cfg, SPEC, root)
    return load_artifacts(spark, root), load_model_shape(spark, root)


def _rounded_score(scored: DataFrame) -> DataFrame:
    return scored.select(*KEYS, (F.round("score", 6) + F.lit(0.0)).alias("score"))


def score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, state, products, users = _scoring_input(spark, sf_dir)
    coded = model_ready(rows, state, SPEC, products, users, with_bins=True)
    _, shape = _saved(spark, state, fx.SCORING)
    scored = scoring.score_rows(coded, _weights(spark, state), shape, keep=KEYS, dtype="float64")
    return _rounded_score(scored)


def score_projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings projected ahead and looked up by id, as a server would."""
    rows, state, products, users = _scoring_input(spark, sf_dir)
    weights = _weights(spark, state)
    return _rounded_score(_scored_from_projections(_coded(rows, state), products, users, weights))


def scoring_paths_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores from raw vectors against scores from projections, for weights whose category
    rows need no limiting; ids repeat on both sides alike."""
    rows, state, products, users = _scoring_input(spark, sf_dir)
    weights, coded = scoring.limit_norms(_weights(spark, state)), _coded(rows, state)
    with_vectors = embeddings.attach_embeddings(coded, SPEC, products, users)
    raw = scoring.score_rows(with_vectors, weights, fx.model_shape(), keep=KEYS, clamp=False, dtype="float64")
    ahead = _scored_from_projections(coded, products, users, weights)
    return metrics.score_parity(raw, ahead, KEYS, atol=1e-9).select(
        "n_matched", "n_unmatched", "n_repeated", "passed"
    )


def _scored_from_projections(
    coded: DataFrame, products: DataFrame, users: DataFrame, weights: scoring.Weights
) -> DataFrame:
    own = narrow_columns(coded)
    coded = coded.withColumns(
        {
            "_product_row": F.coalesce(F.col(SPEC.product), F.lit(0).cast("long")),
            embeddings.USER_KEY: user_date_key(F.col(SPEC.buyer_hash), F.col(SPEC.day)),
        }
    )
    counted = coded
    for source, table, key, vector in (
        (
            "product",
            products.withColumnRenamed(SPEC.product, "_product_row"),
            "_product_row",
            embeddings.PRODUCT_VECTOR,
        ),
        ("user", users, embeddings.USER_KEY, embeddings.USER_VECTOR),
    ):
        projected = scoring.project_embeddings(
            embeddings.unique_vectors(table, [key], vector),
            weights,
            source,
            id_column=key,
            vector=vector,
            dim=SPEC.embedding_dim,
            dtype="float64",
        )
        coded = scoring.attach_projection(
            coded, materialize(projected), [key], source, weights, hash_columns=own, count_on=counted
        )
    return scoring.score_rows(
        coded, weights, fx.model_shape(), keep=KEYS, inputs="projected", dtype="float64"
    )


def score_without_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared_base(spark, sf_dir)
    state = encode.fit(rows, SPEC, fx.SCORING)
    coded = encode.encode(rows, state, SPEC)
    scored = scoring.score_rows(
        coded,
        _weights(spark, state, with_embeddings=False),
        fx.model_shape(with_embeddings=False),
        keep=KEYS,
        inputs="none",
        dtype="float64",
        boundaries=state.boundaries,
    )
    return _rounded_score(scored)


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "split_scan_summary": split_scan_summary,
        "split_roundtrip": split_roundtrip,
        "surface_window_all": _surface("all"),
        "surface_window_boosted": _surface("boosted_merchants"),
        "user_sample": user_sample,
        "positive_rate": positive_rate,
        "negative_downsample": negative_downsample,
        "warehouse_sample": warehouse_sample,
        "one_scan_downsample": one_scan_downsample,
        "one_scan_split": one_scan_split,
        "pointwise_base": base_split,
        "pointwise_finetune": month_split,
        "distinct_products": distinct_products,
        "distinct_buyer_days": distinct_buyer_days,
        "product_embeddings": product_embeddings,
        "user_embeddings_asof": _embeddings_asof(),
        "user_embeddings_in_blocks": _embeddings_asof(block_days=30),
        "embedding_export": embedding_export,
        "embedding_lookup": _embedding_lookup(),
        "embedding_lookup_shuffled": _embedding_lookup(broadcast_bytes=0),
        "embedding_lookup_bucketed": _embedding_lookup(bucketed=True),
        "clean_features": clean_features,
        "day_rerun": day_rerun,
        "quantile_boundaries": fitted_boundaries,
        "boundaries_by_day_counts": boundaries_by_day_counts,
        "window_fit_bins": window_fit_bins,
        "vocabulary": vocabulary,
        "vocabulary_in_ranges": vocabulary_in_ranges,
        "vocab_sizes": vocab_sizes,
        "quantile_bins": quantile_bins,
        "category_ids": category_ids,
        "category_ids_shuffled": category_ids_shuffled,
        "category_ids_many": category_ids_many,
        "hashed_ids": hashed_ids,
        "full_transform": full_transform,
        "serving_transform": serving_transform,
        "published_transform": published_transform,
        "train_serve_parity": train_serve_parity,
        "finetune_encode": finetune_encode,
        "model_ready": model_ready_rows,
        "wide_embeddings_packed": wide_embeddings_packed,
        "two_exports_one_root": two_exports_one_root,
        "training_batches": training_batches,
        "shuffled_batches": shuffled_batches,
        "focal_loss": focal_loss,
        "score_parity": score_parity,
        "preproject_products": preproject_products,
        "projections_in_increments": projections_in_increments,
        "preproject_users": preproject_users,
        "score_rows": score_rows,
        "score_projected": score_projected,
        "scoring_paths_agree": scoring_paths_agree,
        "score_without_embeddings": score_without_embeddings,
    }
    return {name: _shown(query) for name, query in found.items()}
