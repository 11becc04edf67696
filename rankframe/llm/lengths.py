"""Exact totals for every context limit from one histogram of encoded lengths."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankframe.llm.common import stored
from rankframe.llm.tokens import Vocabulary, encoder


def _count_partition(batches: Iterable[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    encode, seen = encoder(vocabulary).encode, Counter()
    for batch in batches:
        for text in batch.column(0):
            seen[len(encode(text.as_py()))] += 1
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int64()), pa.array(seen.values(), pa.int64())], ["n_tokens", "n_docs"])


def length_histogram(documents: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """``(n_tokens, n_docs)``: how many documents have each encoded length.

    Each task counts its own documents, so the shuffle carries one row per task and
    distinct length. A null or empty text has length 0; every row counts, repeated or not.
    """
    vocabulary = vocabulary or Vocabulary.public()
    counted = documents.select(F.col("text").cast("string")).mapInArrow(lambda it: _count_partition(it, vocabulary), "n_tokens long, n_docs long")
    return counted.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def context_limits(histogram: DataFrame, block: int = 256) -> DataFrame:
    """One row per length that occurs, taken as a context limit.

    ``n_docs_over``/``tokens_over``: documents longer than the limit and their tokens (the
    suffix sums); ``tokens_kept``: tokens if each document is cut at the limit;
    ``tokens_lost``: what the cut drops; ``docs_share``: share of documents that fit,
    whose inverse are the quantiles. Sums run over blocks of lengths first, then inside a
    block, so the histogram is never sorted in one task. Empty input gives no rows.
    """
    sized = stored(histogram, "lengths").withColumn("_block", F.floor(F.col("n_tokens") / block))
    tokens = F.col("n_tokens") * F.col("n_docs")
    blocks = sized.groupBy("_block").agg(F.sum("n_docs").alias("_docs"), F.sum(tokens).alias("_tokens"))
    later = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    blocks = blocks.select(
        "_block",
        F.coalesce(F.sum("_docs").over(later), F.lit(0)).alias("_docs_later"),
        F.coalesce(F.sum("_tokens").over(later), F.lit(0)).alias("_tokens_later"),
        F.sum("_docs").over(whole).alias("_all_docs"),
        F.sum("_tokens").over(whole).alias("_all_tokens"),
    )
    above = Window.partitionBy("_block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    over = sized.join(blocks, "_block").select(
        "n_tokens", "n_docs", "_all_docs", "_all_tokens",
        (F.coalesce(F.sum("n_docs").over(above), F.lit(0)) + F.col("_docs_later")).alias("n_docs_over"),
        (F.coalesce(F.sum(tokens).over(above), F.lit(0)) + F.col("_tokens_later")).alias("tokens_over"),
    )
    lost = F.col("tokens_over") - F.col("n_docs_over") * F.col("n_tokens")
    return over.select(
        "n_tokens", "n_docs", "n_docs_over", "tokens_over",
        (F.col("_all_tokens") - lost).alias("tokens_kept"),
        lost.alias("tokens_lost"),
        ((F.col("_all_docs") - F.col("n_docs_over")) / F.col("_all_docs")).alias("docs_share"),
    )


def length_quantiles(limits: DataFrame, shares: list[float]) -> DataFrame:
    """The least length that holds at least each share of the documents."""
    wanted = limits.sparkSession.createDataFrame([(float(s),) for s in shares], "share double")
    # a handful of shares against one row per length
    return wanted.join(F.broadcast(limits), F.col("docs_share") >= F.col("share")).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
