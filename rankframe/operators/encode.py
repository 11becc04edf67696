"""Fit the preprocessing state and encode rows with it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankframe.functions.binning import quantile_bins
from rankframe.functions.cleaning import clean_category, clean_numeric, clean_target
from rankframe.functions.hashing import hashed_id
from rankframe.functions.vectors import pack_columns
from rankframe.operators.quantiles import quantile_boundaries
from rankframe.operators.skew import BROADCAST_BYTES, lookup_join, narrow_columns
from rankframe.operators.vocabulary import (
    category_sizes,
    distinct_categories,
    embedding_dim,
    number_categories,
)
from rankframe.session import materialize, materialized
from rankframe.sources.state import PreprocessorState
from rankframe.spec import MISSING_CATEGORY, FeatureSpec, PreprocessConfig

MODES = ("training", "serving")
# What an entry of a broadcast vocabulary takes beside its text, in a hash relation.
ENTRY_BYTES = 96
SALTS = 16


def prepare(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Clean the feature columns (and wide embedding columns) that are present."""
    numeric = {c for c in spec.numeric if c in df.columns}
    wide = {
        c
        for prefix in ("product_emb_", "user_emb_")
        for c in (f"{prefix}{i}" for i in range(spec.embedding_dim))
        if c in df.columns
    }
    categories = set(spec.categorical)

    def cleaned(name: str) -> Column:
        if name in numeric or name in wide:
            return clean_numeric(F.col(name)).alias(name)
        if name in categories:
            return clean_category(F.col(name)).alias(name)
        return F.col(name)

    return df.select(*[cleaned(c) for c in df.columns])


def fit_vocabulary(
    df: DataFrame, categories: Sequence[str]
) -> tuple[DataFrame, dict[str, int], dict[str, int]]:
    """Stored vocabulary table, and per feature its size (values + 1) and text bytes."""
    if not categories:
        empty = df.sparkSession.createDataFrame([], "feature string, value string, id int")
        return empty, {}, {}
    with materialized(distinct_categories(df, categories)) as distinct:
        found = {r["feature"]: (r["n_values"], r["n_bytes"]) for r in category_sizes(distinct).collect()}
        sizes = {c: found.get(c, (0, 0))[0] + 1 for c in categories}
        octets = {c: found.get(c, (0, 0))[1] for c in categories}
        values = sum(n for n, _ in found.values())
        mean = sum(b for _, b in found.values()) / values if values else 1.0
        # one folder per feature, so that using a feature reads no other
        numbered = materialize(number_categories(distinct, mean), by=["feature"])
    return numbered.select("feature", "value", "id"), sizes, octets


def fit(
    df: DataFrame, spec: FeatureSpec, cfg: PreprocessConfig, *, counts: DataFrame | None = None
) -> PreprocessorState:
    """Quantile boundaries, vocabularies and embedding widths of a prepared split.

    ``counts`` are bucket counts of the same rows, if they are stored already.

    Only per-feature results reach the driver: Q-1 numbers per numeric column and two counts
    per category.  The vocabulary is written out once and stays a table.
    """
    numeric = [c for c in spec.numeric if c in df.columns]
    categories = [c for c in spec.categorical if c in df.columns]
    if not numeric:
        raise ValueError("the frame has none of the numeric features")

    def boundaries() -> list:
        return quantile_boundaries(df, numeric, cfg.n_bins, counts=counts).orderBy("pos").collect()

    # the two halves share nothing, so one can use the tasks the other leaves idle
    with ThreadPoolExecutor(max_workers=2) as pool:
        threaded = inheritable_thread_target(df.sparkSession)
        first = pool.submit(threaded(boundaries))
        second = pool.submit(threaded(lambda: fit_vocabulary(df, categories)))
        bounds, (vocabulary, sizes, octets) = first.result(), second.result()
    if len(bounds) != len(numeric):
        raise ValueError("cannot fit on a frame without rows")
    dims = {c: cfg.dim_overrides.get(c, embedding_dim(n)) for c, n in sizes.items()}
    for column, (buckets, dim) in cfg.id_hash.items():
        sizes[column] = buckets + 1
        dims[column] = dim
    return PreprocessorState(
        numeric=tuple(numeric),
        boundaries=tuple(tuple(r["bounds"]) for r in bounds),
        vocabulary=vocabulary,
        vocab_sizes=sizes,
        vocab_bytes=octets,
        embedding_dims=dims,
        id_hash=dict(cfg.id_hash),
        dim_overrides=dict(cfg.dim_overrides),
        n_bins=cfg.n_bins,
        hash_algo=cfg.hash_algo,
    )


def category_ids(
    df: DataFrame,
    state: PreprocessorState,
    columns: Mapping[str, str],
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``df`` plus one code column per feature; unseen and null values get 0.

    ``columns`` maps a fitted feature to the column of ``df`` with its values; the code column
    is called ``<that column>_id``.  These are hash joins against the vocabulary.  Sizes are
    known from the fit: the smallest features are broadcast while their sum stays below
    ``broadcast_bytes``.  A single other one, of known size or not, takes the skew-safe lookup;
    of several, the codes are found for each distinct tuple of values, and rows are joined
    once with the codes of their tuple.  Row counts of a stream are not known ahead; there the
    rows of a value are dealt over ``SALTS`` copies of its entry.
    """
    rows = df
    free = broadcast_bytes
    sizes = {
        f: state.vocab_bytes[f] + ENTRY_BYTES * state.vocab_sizes[f]
        for f in columns
        if f in state.vocab_bytes
    }
    large = []
    for feature in sorted(columns, key=lambda f: (f not in sizes, sizes.get(f, 0))):
        column = columns[feature]
        out, probe = f"{column}_id", f"_value_of_{column}"
        known = state.vocabulary.filter(F.col("feature") == feature).select(
            F.col("value").alias(probe), F.col("id").alias(out)
        )
        probing = df.withColumn(probe, F.col(column).cast("string"))
        if feature in sizes and sizes[feature] <= free:
            free -= sizes[feature]
            df = probing.join(F.broadcast(known), probe, "left")
        elif df.isStreaming:
            copies = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            salt = F.pmod(F.xxhash64(*narrow_columns(df)), F.lit(SALTS)).cast("int")
            df = probing.withColumn("_salt", salt).join(copies, [probe, "_salt"], "left").drop("_salt")
        else:
            large.append(feature)
            continue
        df = df.withColumn(out, F.coalesce(F.col(out), F.lit(0))).drop(probe)
    if len(large) == 1:
        column = columns[large[0]]
        known = state.vocabulary.filter(F.col("feature") == large[0]).select(
            F.col("value").alias("_value"), F.col("id").alias(f"{column}_id")
        )
        value = F.col(column).cast("string").alias("_value")
        df = lookup_join(
            df.withColumn("_value", value),
            known,
            ["_value"],
            f"{column}_id",
            small=False,
            unique=True,
            count_on=rows.select(value),
        ).drop("_value")
        return df.withColumn(f"{column}_id", F.coalesce(F.col(f"{column}_id"), F.lit(0)))
    if large:
        return codes_by_tuple(df, rows, state, {f: columns[f] for f in large}, free)
    return df


def codes_by_tuple(
    df: DataFrame,
    rows: DataFrame,
    state: PreprocessorState,
    columns: Mapping[str, str],
    broadcast_bytes: int,
) -> DataFrame:
    """The code columns of several features, for one shuffle of ``df`` however many they are.

    What is looked up are the distinct tuples of values in ``rows``, which are narrow: each
    gives one entry per feature, all entries go through one skew-safe join with the vocabulary
    partitioned by (feature, value), and their codes come together as one array per tuple.
    Rows are then joined with the array of their tuple: through a broadcast if the tuples fit
    ``broadcast_bytes``, else by a shuffle in which rows of hot tuples are spread.  A row is
    found by its own values, so no row number has to be the same on every attempt of a task.
    """
    features = list(columns)
    probes = [f"_value_{i}" for i in range(len(features))]
    values = [F.col(columns[f]).cast("string").alias(p) for f, p in zip(features, probes)]

    def key(parts: Sequence[Column]) -> Column:
        # lengths keep neighbours apart: no two tuples have one text
        told = [F.concat(F.char_length(v).cast("string"), F.lit(":"), v) for v in parts]
        return F.concat(*[F.coalesce(t, F.lit("-")) for t in told])

    counted = rows.select(*values).groupBy(*probes).agg(F.count(F.lit(1)).alias("_rows"))
    # stored, so the numbers stay as they are; entries carry them instead of the whole tuple
    tuples = materialize(counted.withColumn("_number", F.monotonically_increasing_id()))
    tuples = tuples.withColumn("_tuple", key([F.col(p) for p in probes]))
    entries = tuples.select("_number", F.posexplode(F.array(*probes)).alias("_place", "_value"))
    place = F.coalesce(*[F.when(F.col("feature") == f, F.lit(i)) for i, f in enumerate(features)])
    known = state.vocabulary.filter(F.col("feature").isin(features)).select(
        place.alias("_place"), F.col("value").alias("_value"), F.col("id").alias("_id")
    )
    found = lookup_join(
        entries.filter(F.col("_value").isNotNull()), known, ["_place", "_value"], "_id", small=False, unique=True
    )
    codes = [F.coalesce(F.max(F.when(F.col("_place") == i, F.col("_id"))), F.lit(0)) for i in range(len(features))]
    by_number = found.groupBy("_number").agg(F.array(*codes).alias("_codes"))
    by_tuple = tuples.select("_number", "_tuple").join(by_number, "_number").select("_tuple", "_codes")

    entry_bytes = F.octet_length("_tuple") + ENTRY_BYTES + 8 * len(features)
    size = tuples.agg(F.sum(entry_bytes)).first()[0] or 0
    coded = lookup_join(
        df.withColumn("_tuple", key(values)),
        by_tuple,
        ["_tuple"],
        "_codes",
        small=size <= broadcast_bytes,
        unique=True,
        row_bytes=ENTRY_BYTES + 32 * len(features),
        count_on=tuples,
        weight="_rows",
    )
    ids = [
        F.coalesce(F.get("_codes", F.lit(i)), F.lit(0)).alias(f"{columns[f]}_id")
        for i, f in enumerate(features)
    ]
    return coded.select(*df.columns, *ids)


def encode(
    df: DataFrame,
    state: PreprocessorState,
    spec: FeatureSpec,
    *,
    mode: str = "training",
    keep: Sequence[str] | None = None,
    skip_targets: bool = False,
    with_bins: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Encoded rows: ``keep`` columns, ``num``, ``cat``, optional ``emb``, ``target``, ``bins``.

    ``num`` holds the cleaned numerics in fitted order, ``cat`` category and hashed-id codes
    in sorted column order.  Binning is a separate late step, asked for with ``with_bins``.
    In ``serving`` mode there is no target, and an absent category column reads as missing;
    in ``training`` mode that is an error.  An absent hashed id is 0 in both modes.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    absent = [c for c in state.numeric if c not in df.columns]
    if absent:
        raise ValueError(f"fitted numeric features are missing: {absent}")
    lost = [c for c in state.categories if c not in df.columns]
    if lost and mode == "training":
        raise ValueError(f"fitted categories are missing: {lost}")

    keep = [c for c in (spec.keys if keep is None else keep) if c in df.columns]
    columns = [F.col(c) for c in keep]
    # packed at once: beyond 100 columns Spark gives up on whole-stage code generation
    columns.append(F.array(*[clean_numeric(F.col(c)) for c in state.numeric]).alias("num"))
    for c in state.categories:
        value = F.lit(MISSING_CATEGORY) if c in lost else F.col(c)
        columns.append(value.cast("string").alias(f"_cat_{c}"))
    for c, (buckets, _) in state.id_hash.items():
        code = hashed_id(F.col(c), buckets, state.hash_algo) if c in df.columns else F.lit(0)
        columns.append(code.alias(f"_code_{c}"))
    emb = pack_columns(df.columns, ("product_emb_", "user_emb_"), spec.embedding_dim)
    if emb is not None:
        columns.append(emb.alias("emb"))
    want_target = mode == "training" and not skip_targets
    if want_target:
        columns.append(clean_target(F.col(spec.target)).alias("target"))
    packed = df.select(*columns)

    coded = category_ids(
        packed,
        state,
        {c: f"_cat_{c}" for c in state.categories},
        broadcast_bytes=broadcast_bytes,
    )
    codes = [
        F.col(f"_code_{c}") if c in state.id_hash else F.col(f"_cat_{c}_id")
        for c in state.encoded_order
    ]
    out = [*keep, "num", F.array(*codes).cast("array<int>").alias("cat")]
    if emb is not None:
        out.append("emb")
    if want_target:
        out.append("target")
    if with_bins:
        out.append(quantile_bins(F.col("num"), state.boundaries).alias("bins"))
    return coded.select(*out)


def encoding_mismatches(
    df: DataFrame,
    training: PreprocessorState,
    serving: PreprocessorState,
    spec: FeatureSpec,
) -> DataFrame:
    """One row: rows compared, rows whose bins differ, rows whose category codes differ.

    Both encodings, with the fitted state and with the one that serving loaded, are computed
    side by side on the same row, so nothing has to be joined.
    """
    trained = encode(df, training, spec, keep=df.columns, skip_targets=True, with_bins=True)
    trained = trained.withColumnsRenamed({"cat": "_cat_t", "bins": "_bins_t", "num": "_num_t"})
    served = encode(
        trained,
        serving,
        spec,
        mode="serving",
        keep=["_cat_t", "_bins_t"],
        with_bins=True,
    )
    return served.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("bins") != F.col("_bins_t")).alias("bin_mismatches"),
        F.count_if(F.col("cat") != F.col("_cat_t")).alias("cat_mismatches"),
    )
