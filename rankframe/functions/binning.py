"""Quantile bins of packed numeric vectors."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def binner(boundaries: Sequence[Sequence[float]]) -> Callable[[pa.Array], pa.Array]:
    """What :func:`quantile_bins` does with an Arrow batch of arrays."""
    table = np.asarray(boundaries, dtype=np.float32)

    def bins(batch: pa.Array) -> pa.Array:
        sizes = pc.drop_null(pc.list_value_length(batch)).to_numpy(zero_copy_only=False)
        if (sizes != len(table)).any():
            raise ValueError(f"expected {len(table)} numerics, found {sizes[sizes != len(table)][0]}")
        flat = pc.fill_null(batch.flatten().cast(pa.float32()), 0.0).to_numpy(zero_copy_only=False)
        values = np.where(np.isnan(flat), np.float32(0), flat).reshape(-1, len(table))
        out = np.empty(values.shape, dtype=np.int32)
        for feature, bounds in enumerate(table):
            out[:, feature] = np.searchsorted(bounds, values[:, feature], side="left") + 1
        present = batch.is_valid().to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(present)]).astype(np.int32) * len(table)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()), mask=pa.array(~present))

    return bins


def quantile_bins(numeric: Column, boundaries: Sequence[Sequence[float]]) -> Column:
    """Bin of every element of ``numeric``: 1 + number of boundaries below the value.

    Bins are ``(b[k-1], b[k]]`` and run from 1 to Q; repeated boundaries are kept, so some
    bins may stay empty.  A null or NaN element is binned as 0, as it would be after
    cleaning; a null array has no bins; an array of another length than the boundaries is an
    error.  Arrow batches go through ``numpy.searchsorted`` on flat buffers.
    """
    return F.arrow_udf(binner(boundaries), T.ArrayType(T.IntegerType()))(numeric)
