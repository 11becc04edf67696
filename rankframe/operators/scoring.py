"""Apply given model weights to tables: embedding projection and row scores.

These are row-wise maps.  Spark partitions the rows and hands Arrow batches to a short NumPy
forward pass; the weights are a table ``(name, shape, values)`` of bounded size that is
broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankframe.functions.binning import binner
from rankframe.functions.vectors import clean_vector, has_embedding
from rankframe.operators.skew import BROADCAST_BYTES, fits_broadcast, lookup_join
from rankframe.spec import ModelShape

LOGIT_LIMIT = 10.0
#: Rows that go through the network at once: its layers hold this many, however long a batch is.
ROWS_AT_ONCE = 1024
_NORM_EPS = 1e-5

Weights = Mapping[str, np.ndarray]


def load_weights(
    table: DataFrame,
    dtype: str = "float32",
    *,
    names: Mapping[str, str] | None = None,
    max_parameters: int = 50_000_000,
) -> dict[str, np.ndarray]:
    """Arrays by name from a ``(name, shape, values)`` table.

    ``names`` renames the table's entries, e.g. by :func:`trained_names`.  A model with more
    than ``max_parameters`` is refused rather than collected and broadcast; raise it to what
    the driver and one executor can hold.
    """
    total = table.agg(F.sum(F.size("values"))).head()[0] or 0
    if total > max_parameters:
        raise ValueError(f"{total} parameters, more than the {max_parameters} that may be broadcast")
    names = names or {}
    return {
        names.get(r["name"], r["name"]): np.asarray(r["values"], dtype=dtype).reshape(r["shape"])
        for r in table.select("name", "shape", "values").toLocalIterator()
    }


def trained_names(shape: ModelShape, sources: Sequence[str] = ("product", "user")) -> dict[str, str]:
    """Parameter names of the trained network to the names used here."""
    names = {"numeric_emb.weight": "numeric_emb"}
    names |= {f"embeddings.{c}.weight": f"cat_emb.{c}" for c in shape.categories}
    for source in sources if shape.embedding_dim else ():
        for kind in ("weight", "bias"):
            names[f"{source}_proj.0.{kind}"] = f"{source}_proj.{kind}"
            names[f"{source}_proj.1.{kind}"] = f"{source}_proj.norm_{kind}"
    for i in range(shape.cross_layers):
        for theirs, ours in (("U", "up"), ("V", "down"), ("bias", "bias"), ("gate.weight", "gate")):
            names[f"cross_net.layers.{i}.{theirs}"] = f"cross.{i}.{ours}"
    hidden = {
        "w_gate.weight": "gate",
        "w_val.weight": "value",
        "w_val.bias": "value_bias",
        "norm.weight": "norm_weight",
        "norm.bias": "norm_bias",
    }
    for theirs, ours, layers in (
        ("deep_net", "deep", shape.deep_layers),
        ("head_hidden", "head", shape.head_layers),
    ):
        for i in range(layers):
            last = {"weight": "weight", "bias": "bias"}
            for k, v in (hidden if i < layers - 1 else last).items():
                names[f"{theirs}.{i}.{k}"] = f"{ours}.{i}.{v}"
    return names | {f"head_logit.{kind}": f"logit.{kind}" for kind in ("weight", "bias")}


def check_weights(weights: Weights, shape: ModelShape) -> None:
    """Raise ``ValueError`` with every weight that is missing or has another shape than this:

    ==========================  ==================================================
    ``numeric_emb``             (numerics * (bins + 1), width)
    ``cat_emb.<category>``      (codes, width)
    ``<source>_proj``           ``.weight`` (P, embedding), ``.bias``, norm (P)
    ``cross.<i>``               ``.down`` (K, r, D), ``.up`` (K, D, r), ``.gate`` (K, D), ``.bias`` (D)
    ``deep.<i>``, ``head.<i>``  ``.gate``, ``.value`` (out, in), ``.value_bias``, norm (out)
    last layer of each          ``.weight`` (out, in), ``.bias`` (out)
    ``logit``                   ``.weight`` (1, in), ``.bias`` (1)
    ==========================  ==================================================

    "norm" stands for ``.norm_weight`` and ``.norm_bias``.  D is the width of all embeddings
    of a row, with two projections and two flags if the model has text embeddings.
    """
    problems: list[str] = []

    def size(name: str, *wanted: int | None) -> tuple[int, ...]:
        """The weight's shape, or the wanted one if it does not fit; 0 is not known."""
        if name not in weights:
            problems.append(f"{name} is missing")
        elif len(found := weights[name].shape) != len(wanted) or any(
            w and w != f for w, f in zip(wanted, found)
        ):
            problems.append(f"{name} has shape {found}, not {tuple(w or '*' for w in wanted)}")
        else:
            return found
        return tuple(w or 0 for w in wanted)

    def norm(name: str, width: int) -> None:
        size(f"{name}.norm_weight", width)
        size(f"{name}.norm_bias", width)

    def stack(name: str, width: int, layers: int) -> int:
        for i in range(layers - 1):
            out, _ = size(f"{name}.{i}.gate", None, width)
            size(f"{name}.{i}.value", out, width)
            size(f"{name}.{i}.value_bias", out)
            norm(f"{name}.{i}", out)
            width = out
        out, _ = size(f"{name}.{layers - 1}.weight", None, width)
        size(f"{name}.{layers - 1}.bias", out)
        return out

    rows, width = size("numeric_emb", None, None)
    if rows % (shape.n_bins + 1):
        problems.append(f"numeric_emb has {rows} rows, no multiple of {shape.n_bins + 1}")
    dim = rows // (shape.n_bins + 1) * width
    dim += sum(size(f"cat_emb.{c}", None, None)[1] for c in shape.categories)
    if shape.embedding_dim:
        projected = 0
        for source in ("product", "user"):
            projected, _ = size(f"{source}_proj.weight", projected or None, shape.embedding_dim)
            size(f"{source}_proj.bias", projected)
            norm(f"{source}_proj", projected)
        dim += 2 * projected + 2
    for i in range(shape.cross_layers):
        experts, rank, _ = size(f"cross.{i}.down", None, None, dim)
        size(f"cross.{i}.up", experts, dim, rank)
        size(f"cross.{i}.gate", experts, dim)
        size(f"cross.{i}.bias", dim)
    deep = stack("deep", dim, shape.deep_layers)
    head = stack("head", dim + deep, shape.head_layers)
    size("logit.weight", 1, head)
    size("logit.bias", 1)
    if problems:
        raise ValueError("weights do not fit the model: " + "; ".join(problems))


def erf(x: np.ndarray) -> np.ndarray:
    """Error function; rational approximation of Abramowitz and Stegun, error below 1.5e-7."""
    # Coefficients of formula 7.1.26.
    p = 0.3275911
    a = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    t = 1.0 / (1.0 + p * np.abs(x))
    series = t * (a[0] + t * (a[1] + t * (a[2] + t * (a[3] + t * a[4]))))
    return np.sign(x) * (1.0 - series * np.exp(-x * x))


def _normalize(x: np.ndarray, w: Weights, name: str) -> np.ndarray:
    centred = x - x.mean(axis=1, keepdims=True)
    spread = np.sqrt((centred * centred).mean(axis=1, keepdims=True) + _NORM_EPS)
    return centred / spread * w[f"{name}.norm_weight"] + w[f"{name}.norm_bias"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _project(x: np.ndarray, w: Weights, name: str) -> np.ndarray:
    """GELU of the normalised linear map."""
    y = _normalize(x @ w[f"{name}.weight"].T + w[f"{name}.bias"], w, name)
    return (0.5 * y * (1.0 + erf(y / np.sqrt(2.0)))).astype(x.dtype, copy=False)


def _gated_stack(x: np.ndarray, w: Weights, name: str, layers: int) -> np.ndarray:
    """Gated blocks, the last layer plain linear."""
    for i in range(layers - 1):
        gate = x @ w[f"{name}.{i}.gate"].T
        value = x @ w[f"{name}.{i}.value"].T + w[f"{name}.{i}.value_bias"]
        x = _normalize(value * gate * _sigmoid(gate), w, f"{name}.{i}")
    last = f"{name}.{layers - 1}"
    return x @ w[f"{last}.weight"].T + w[f"{last}.bias"]


def _cross_stack(x0: np.ndarray, w: Weights, layers: int) -> np.ndarray:
    """Cross layers with softmax-gated low-rank experts: ``x0 * (mix(x) + b) + x``."""
    x = x0
    for i in range(layers):
        down, up = w[f"cross.{i}.down"], w[f"cross.{i}.up"]  # (K, r, d) and (K, d, r)
        experts, rank, dim = down.shape
        logits = x @ w[f"cross.{i}.gate"].T
        share = np.exp(logits - logits.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        inner = (x @ down.reshape(experts * rank, dim).T).reshape(-1, experts, rank)
        # scaling before the second product turns the sum over experts into one product
        weighted = (inner * share[:, :, None]).reshape(-1, experts * rank)
        mix = weighted @ up.transpose(0, 2, 1).reshape(experts * rank, dim)
        x = x0 * (mix + w[f"cross.{i}.bias"]) + x
    return x


def forward(
    w: Weights,
    shape: ModelShape,
    bins: np.ndarray,
    codes: np.ndarray,
    extra: Sequence[np.ndarray] = (),
) -> np.ndarray:
    """Logit per row.  ``extra`` are the projected vectors and their flags, in model order."""
    rows, features = bins.shape
    table = w["numeric_emb"]
    flat = bins + np.arange(features) * (shape.n_bins + 1)
    parts = [table[flat].reshape(rows, -1)]
    parts += [w[f"cat_emb.{c}"][codes[:, i]] for i, c in enumerate(shape.categories)]
    x0 = np.concatenate([*parts, *extra], axis=1)
    both = np.concatenate(
        [_cross_stack(x0, w, shape.cross_layers), _gated_stack(x0, w, "deep", shape.deep_layers)],
        axis=1,
    )
    hidden = _gated_stack(both, w, "head", shape.head_layers)
    return (hidden @ w["logit.weight"].T + w["logit.bias"])[:, 0]


def limit_norms(w: Weights, max_norm: float = 1.0) -> dict[str, np.ndarray]:
    """Category embedding rows longer than ``max_norm`` scaled back to it."""
    limited = dict(w)
    for name, table in w.items():
        if name.startswith("cat_emb."):
            norms = np.linalg.norm(table, axis=1, keepdims=True)
            factor = np.where(norms > max_norm, max_norm / (norms + 1e-7), 1.0)
            limited[name] = (table * factor).astype(table.dtype)
    return limited


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    """Array column without nulls, all rows of one length, as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(dtype, copy=False)


def _map_batches(
    df: DataFrame,
    keep: Sequence[str],
    inputs: Sequence[str],
    out: str,
    out_type: T.DataType,
    compute: Callable[..., pa.Array],
) -> DataFrame:
    """``keep`` columns pass through untouched, ``out`` is computed from the ``inputs``."""
    keep, inputs = list(keep), list(inputs)
    frame = df.select(*keep, *[F.col(c).alias(f"_in_{i}") for i, c in enumerate(inputs)])
    schema = T.StructType([frame.schema[c] for c in keep] + [T.StructField(out, out_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            result = compute(*[batch.column(len(keep) + i) for i in range(len(inputs))])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], result], names=[*keep, out]
            )

    return frame.mapInArrow(run, schema)


def _float_type(dtype: str) -> T.DataType:
    return T.DoubleType() if dtype == "float64" else T.FloatType()


def project_embeddings(
    df: DataFrame,
    weights: Weights,
    source: str,
    *,
    id_column: str,
    vector: str,
    dim: int,
    dtype: str = "float32",
) -> DataFrame:
    """``id_column``, ``proj``, ``has_emb`` for the ``product`` or ``user`` source.

    A zero vector projects to something other than zero, hence the flag.
    """
    layer = f"{source}_proj"
    own = {k: v.astype(dtype) for k, v in weights.items() if k.startswith(f"{layer}.")}
    if not own:
        raise ValueError(f"the model has no projection for source {source!r}")
    shared = df.sparkSession.sparkContext.broadcast(own)
    width = own[f"{layer}.weight"].shape[0]
    cleaned = df.select(id_column, clean_vector(F.col(vector), dim).alias("_vector"))
    flagged = cleaned.withColumn("has_emb", has_embedding(F.col("_vector")))

    def compute(vectors: pa.Array) -> pa.Array:
        projected = _project(_matrix(vectors, dtype), shared.value, layer)
        offsets = np.arange(0, projected.size + 1, width, dtype=np.int32)
        return pa.ListArray.from_arrays(offsets, np.ascontiguousarray(projected).ravel())

    mapped = _map_batches(
        flagged, [id_column, "has_emb"], ["_vector"], "proj", T.ArrayType(_float_type(dtype)), compute
    )
    return mapped.select(id_column, "proj", "has_emb")


def attach_projection(
    df: DataFrame,
    projected: DataFrame,
    keys: Sequence[str],
    source: str,
    weights: Weights,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    hash_columns: Sequence[str] | None = None,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """``df`` plus ``<source>_proj`` and ``has_<source>`` looked up by id.

    An unknown id gets what a zero vector projects to and flag 0, as it would without
    projecting ahead.  ``projected`` should be stored, or it is computed for its keys and
    again for the join.  ``count_on`` is a cheap frame with the keys of ``df``.
    """
    layer = f"{source}_proj"
    width, dim = weights[f"{layer}.weight"].shape
    zero = _project(np.zeros((1, dim)), weights, layer)[0]
    kind = projected.schema["proj"].dataType
    default = F.array(*[F.lit(float(v)) for v in zero]).cast(kind)
    table = projected.select(*keys, F.struct("proj", "has_emb").alias("_found"))
    small = fits_broadcast(projected.select(*keys), 8 * width + 64, broadcast_bytes)
    return (
        lookup_join(
            df,
            table,
            keys,
            "_found",
            small=small,
            row_bytes=8 * width + 64,
            hash_columns=hash_columns,
            count_on=count_on,
        )
        .withColumns(
            {
                layer: F.coalesce(F.col("_found.proj"), default),
                f"has_{source}": F.coalesce(F.col("_found.has_emb"), F.lit(0.0).cast("float")),
            }
        )
        .drop("_found")
    )


def score_rows(
    df: DataFrame,
    weights: Weights,
    shape: ModelShape,
    *,
    keep: Sequence[str],
    inputs: str = "raw",
    clamp: bool | None = None,
    dtype: str = "float32",
    boundaries: Sequence[Sequence[float]] | None = None,
) -> DataFrame:
    """``keep`` columns plus ``score``.

    ``inputs="raw"`` takes ``bins``, ``cat`` and (for a model with text embeddings) optionally
    ``emb``, projects inside, limits category norms and clamps the logit.
    ``inputs="projected"`` takes ``product_proj``, ``user_proj``, ``has_product``, ``has_user``
    instead; ``inputs="none"`` is for a model without text embeddings.  Both leave norms and
    logits as they are.

    With fitted ``boundaries`` the bins are found here, from ``num`` instead of ``bins``: a task
    then needs one Python process, not a second one for the binning.
    """
    if inputs not in ("raw", "projected", "none"):
        raise ValueError(f"unknown inputs {inputs!r}")
    if inputs == "projected" and shape.embedding_dim == 0:
        raise ValueError("the model was made without text embeddings; use inputs='none'")
    check_weights(weights, shape)
    clamp = inputs == "raw" if clamp is None else clamp
    prepared = {k: v.astype(dtype) for k, v in weights.items()}
    if inputs == "raw":
        prepared = limit_norms(prepared)
    shared = df.sparkSession.sparkContext.broadcast(prepared)
    dim = shape.embedding_dim

    bins_of = binner(boundaries) if boundaries is not None else None
    columns = ["bins" if bins_of is None else "num", "cat"]
    if inputs == "projected":
        columns += ["product_proj", "user_proj", "has_product", "has_user"]
    elif inputs == "raw" and dim and "emb" in df.columns:
        columns.append("emb")

    def projected_pair(w: Weights, vectors: np.ndarray) -> list[np.ndarray]:
        product, user = vectors[:, :dim], vectors[:, dim:]
        flags = [(np.abs(v).sum(axis=1, keepdims=True) > 0).astype(dtype) for v in (product, user)]
        return [_project(product, w, "product_proj"), _project(user, w, "user_proj"), *flags]

    def score(bins: pa.Array, codes: pa.Array, *rest: pa.Array) -> np.ndarray:
        w = shared.value
        extra: list[np.ndarray] = []
        if inputs == "projected":
            flags = [r.to_numpy(zero_copy_only=False).astype(dtype)[:, None] for r in rest[2:]]
            extra = [_matrix(rest[0], dtype), _matrix(rest[1], dtype), *flags]
        elif inputs == "raw" and dim:
            zeros = np.zeros((1, 2 * dim), dtype=dtype)
            extra = projected_pair(w, _matrix(rest[0], dtype) if rest else zeros)
            if not rest:  # the same for all rows, so projected once
                extra = [np.repeat(e, len(bins), axis=0) for e in extra]
        if bins_of is not None:
            bins = bins_of(bins)
        logit = forward(w, shape, _matrix(bins, np.int64), _matrix(codes, np.int64), extra)
        if clamp:
            logit = np.clip(logit, -LOGIT_LIMIT, LOGIT_LIMIT)
        return logit.astype(dtype)

    def compute(*batch: pa.Array) -> pa.Array:
        starts = range(0, len(batch[0]), ROWS_AT_ONCE)
        return pa.array(np.concatenate([score(*[c.slice(i, ROWS_AT_ONCE) for c in batch]) for i in starts]))

    return _map_batches(df, keep, columns, "score", _float_type(dtype), compute)
