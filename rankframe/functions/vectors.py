"""Vector columns.  A vector stays one ``array<float>`` column; wide columns are made on request."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankframe.functions.cleaning import clean_numeric


def zero_vector(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), dim)


def _repaired(
    vector: Column, dim: int, cut: bool, repair: Callable[[Column], Column]
) -> Column:
    """``dim`` elements, ``repair`` applied to each if there is anything to repair."""
    floats = vector.cast("array<float>")
    leading = F.when(F.size(floats) == dim, floats).otherwise(F.slice(floats, 1, dim))
    wrong = F.size(floats) < dim if cut else F.size(floats) != dim
    # One compiled loop tells vectors without nulls and NaN (false) from the others (null or
    # true); only those go through the much slower element-wise function.
    intact = F.array_contains(floats, F.lit(float("nan")).cast("float")).eqNullSafe(F.lit(False))
    wanted = f"{dim} or more" if cut else f"{dim}"
    wrong_length = F.raise_error(
        F.concat(F.lit(f"vector should have {wanted} elements, has "), F.size(floats).cast("string"))
    )
    return (
        F.when(vector.isNull(), zero_vector(dim))
        .when(wrong, wrong_length)
        .when(intact, leading)
        .otherwise(F.transform(leading, repair))
    )


def vector_or_zeros(vector: Column, dim: int, *, cut: bool = False) -> Column:
    """The vector, with a null vector or element read as 0; another length is an error.

    ``cut`` takes the first ``dim`` elements of longer vectors instead.
    """
    return _repaired(vector, dim, cut, lambda x: F.coalesce(x, F.lit(0.0).cast("float")))


def clean_vector(vector: Column, dim: int, *, cut: bool = False) -> Column:
    """Like :func:`vector_or_zeros`, with NaN elements also read as 0."""
    return _repaired(vector, dim, cut, clean_numeric)


def expand_vector(vector: Column, prefix: str, dim: int) -> list[Column]:
    """``prefix0 .. prefix{dim-1}`` as separate columns."""
    return [F.get(vector, F.lit(i)).alias(f"{prefix}{i}") for i in range(dim)]


def pack_columns(available: Sequence[str], prefixes: Sequence[str], dim: int) -> Column | None:
    """One vector from ``prefix0..`` columns of every prefix; ``None`` unless all exist."""
    wanted = [f"{prefix}{i}" for prefix in prefixes for i in range(dim)]
    if not wanted or not set(wanted) <= set(available):
        return None
    return F.array(*[F.col(name).cast("float") for name in wanted])


def has_embedding(vector: Column) -> Column:
    """1.0 if any element differs from 0, else 0.0; null and NaN elements count as 0."""
    return F.exists(vector, lambda x: clean_numeric(x) != 0).cast("float")
