"""Encode new rows as their files arrive, with a state that stays as it is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rankframe.operators.encode import encode, prepare
from rankframe.sources.state import PreprocessorState
from rankframe.spec import FeatureSpec


def encode_arriving_rows(
    rows: DataFrame,
    state: PreprocessorState,
    spec: FeatureSpec,
    out: str,
    progress: str,
    *,
    with_bins: bool = False,
) -> StreamingQuery:
    """Start a query that prepares, encodes and appends what has arrived, then stops.

    The encoding keeps no state between rows, so no watermark is needed; ``progress`` records
    which files are done, and a restart goes on after them.
    """
    if not rows.isStreaming:
        raise ValueError("rows must come from readStream")
    encoded = encode(prepare(rows, spec), state, spec, with_bins=with_bins)
    return (
        encoded.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", progress)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
