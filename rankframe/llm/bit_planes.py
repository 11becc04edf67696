"""Exact centroid clustering of integer vectors on packed bit planes.

A vector of 64 integers is kept as one unsigned 64-bit word per binary digit: bit i of word
p is digit p of component i, the last word holds the signs.  A dot product is then a sum of
popcounts of ANDed words, each weighted by the digits' worth, and exact.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankframe.llm.common import stored

WIDTH = 64  # components, the bits of a word


@dataclass(frozen=True)
class ClusterConfig:
    """``centroids`` start as the vectors whose ids, after ``seed:``, have the smallest
    SHA-256. ``scale``: a component x becomes floor(scale * x). ``limit``: integers beyond
    it, either way, are held to it, so that distances fit a long."""

    centroids: int = 8
    rounds: int = 10
    seed: int = 3
    scale: int = 1024
    limit: int = 1 << 27


def quantised(embedding: Column, c: ClusterConfig) -> Column:
    """The vector's integers; null for vectors that are not kept."""
    x = embedding.cast("array<double>")
    usable = (F.size(x) == WIDTH) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(F.greatest(F.least(v * c.scale, F.lit(float(c.limit))), F.lit(float(-c.limit)))).cast("int"))
    return F.when(usable, whole)


def digits_for(low: int, high: int) -> int:
    """Words that two's complement takes for integers from ``low`` to ``high``."""
    return max(int(high).bit_length(), int(-low - 1).bit_length() if low < 0 else 0) + 1


def pack_planes(values: np.ndarray, digits: int) -> np.ndarray:
    """``(rows, 64)`` integers as ``(rows, digits)`` words."""
    planes = np.empty((len(values), digits), np.uint64)
    for digit in range(digits):
        bits = (values >> digit & 1).astype(np.uint8)
        planes[:, digit] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return planes


def worths(digits: int) -> np.ndarray:
    """What a set bit of each word counts; the last is the sign."""
    out = np.int64(1) << np.arange(digits, dtype=np.int64)
    out[-1] = -out[-1]
    return out


def dot_products(planes: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Dot product of every row of ``planes`` with the one vector of words ``other``."""
    worth = worths(len(other))
    total = np.zeros(len(planes), np.int64)
    for p in range(planes.shape[1]):
        for q in range(len(other)):
            if other[q]:
                total += worth[p] * worth[q] * np.bitwise_count(planes[:, p] & other[q]).astype(np.int64)
    return total


def norms(planes: np.ndarray) -> np.ndarray:
    """Dot product of every row with itself; each pair of different digits counts twice."""
    worth = worths(planes.shape[1])
    total = np.zeros(len(planes), np.int64)
    for p in range(planes.shape[1]):
        for q in range(p + 1):
            total += (1 + (p != q)) * worth[p] * worth[q] * np.bitwise_count(planes[:, p] & planes[:, q]).astype(np.int64)
    return total


def nearest(planes: np.ndarray, squared: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every row, the smaller number in ties, and its distance."""
    best, least = np.zeros(len(planes), np.int32), np.full(len(planes), np.iinfo(np.int64).max)
    for k, (words, square) in enumerate(zip(centroids, norms(centroids))):
        distance = squared + square - 2 * dot_products(planes, words)
        closer = distance < least
        best[closer], least[closer] = k, distance[closer]
    return best, least


def plane_sums(planes: np.ndarray) -> np.ndarray:
    """Componentwise sums of the rows: set bits of each word, times its worth."""
    total = np.zeros(WIDTH, np.int64)
    for p, worth in enumerate(worths(planes.shape[1])):
        words = np.ascontiguousarray(planes[:, p]).view(np.uint8).reshape(-1, 8)
        # bits of one byte place: how often each byte value occurs, times the bits it has
        for byte in range(8):
            seen = np.bincount(words[:, byte], minlength=256)
            total[8 * byte : 8 * byte + 8] += worth * (seen @ _BYTE_BITS)
    return total


_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _words(column: pa.Array, digits: int) -> np.ndarray:
    """The words of a binary column in which every value has ``8 * digits`` bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(len(column), digits)


def _pack(batches: Iterable[pa.RecordBatch], digits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
        planes = pack_planes(values, digits)
        words = pa.array([row.tobytes() for row in planes.astype("<u8")], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), words, pa.array(norms(planes), pa.int64())], ["vec_id", "planes", "squared"])


def _partial_sums(batches: Iterable[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per task: rows and componentwise sums of every centroid that has some."""
    k, digits = centroids.shape
    rows, sums = np.zeros(k, np.int64), np.zeros((k, WIDTH), np.int64)
    for batch in batches:
        planes = _words(batch.column(0), digits)
        own, _ = nearest(planes, batch.column(1).to_numpy(), centroids)
        for c in np.unique(own):
            mine = planes[own == c]
            rows[c] += len(mine)
            sums[c] += plane_sums(mine)
    used = np.flatnonzero(rows)
    columns = [pa.array(used, pa.int32()), pa.array(rows[used], pa.int64()), pa.array(list(sums[used]), pa.list_(pa.int64()))]
    yield pa.RecordBatch.from_arrays(columns, ["cluster", "rows", "sums"])


def _assign(batches: Iterable[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own, distance = nearest(_words(batch.column(1), centroids.shape[1]), batch.column(2).to_numpy(), centroids)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])


def _next_centroids(vectors: DataFrame, centroids: list[list[int]], digits: int) -> list[list[int]]:
    """Exact floors of the means; a centroid without vectors stays."""
    planes = pack_planes(np.array(centroids, np.int64), digits)
    parts = vectors.select("planes", "squared").mapInArrow(functools.partial(_partial_sums, centroids=planes), "cluster int, rows long, sums array<long>")
    # a row per centroid: decimals, as sums over all vectors may exceed a long
    sums = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(WIDTH)]
    moved = list(centroids)
    for r in parts.groupBy("cluster").agg(F.sum("rows").alias("rows"), *sums).collect():
        moved[r["cluster"]] = [int(r[f"s{i}"]) // r["rows"] for i in range(WIDTH)]
    return moved


def cluster_vectors(embeddings: DataFrame, config: ClusterConfig | None = None) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid)``
    for ``embeddings(vec_id, embedding)``: the nearest final centroid of every kept vector,
    its squared distance, distances summed over the cluster and over all, and the centroid's
    integers with a digest of them.

    Kept are vectors of 64 components, none null, NaN or infinite; others, and null vectors,
    give no row. Every pass maps over the packed vectors and sends one partial sum per task
    and centroid to a sum over at most ``centroids`` groups; only its result, ``centroids``
    rows, reaches the driver. Rounds end early once centroids repeat, as nothing changes then.

    Repeated rows count each. A null vec_id hashes to nothing and starts a centroid only if
    there are too few others; equal ids are ordered by their integers. With fewer vectors
    than ``centroids`` each starts one. Integers beyond ``limit`` are held to it, sums beyond
    a long to the largest long. Without vectors the result is empty. Other columns are ignored.
    """
    c = config or ClusterConfig()
    source = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding"), c).alias("ints")).where("ints is not null")
    whole = stored(source, "whole-vectors")
    low, high = whole.agg(F.min(F.array_min("ints")), F.max(F.array_max("ints"))).first()
    digits = digits_for(low or 0, high or 0)
    start = F.sha2(F.concat(F.lit(f"{c.seed}:"), F.col("vec_id").cast("string")), 256)
    first = whole.select(start.alias("start"), "ints").orderBy(F.col("start").asc_nulls_last(), "ints").limit(c.centroids)
    centroids = [list(r["ints"]) for r in first.collect()]
    shape = "vec_id long, cluster int, distance long"
    if not centroids:
        assigned = whole.sparkSession.createDataFrame([], shape)
    else:
        vectors = stored(whole.mapInArrow(functools.partial(_pack, digits=digits), "vec_id long, planes binary, squared long"), "bit-planes")
        for _ in range(c.rounds):
            moved = _next_centroids(vectors, centroids, digits)
            if moved == centroids:
                break
            centroids = moved
        final = pack_planes(np.array(centroids, np.int64), digits)
        assigned = stored(vectors.mapInArrow(functools.partial(_assign, centroids=final), shape), "assigned-vectors")

    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    held = lambda total: F.least(total, most).cast("long")
    by_cluster = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    every = sum(r["total"] for r in by_cluster)
    digest = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in centroids]
    facts = whole.sparkSession.createDataFrame(
        [(r["cluster"], r["total"], every, digest[r["cluster"]], centroids[r["cluster"]]) for r in by_cluster],
        "cluster int, own decimal(38,0), every decimal(38,0), centroid_sha256 string, centroid array<int>",
    )
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", held(F.col("own")).alias("cluster_inertia"), held(F.col("every")).alias("inertia"), "centroid_sha256", "centroid",
    )


def clusters_sql(config: ClusterConfig | None = None) -> str:
    """The same in DuckDB, a step for every round."""
    c = config or ClusterConfig()
    near = """SELECT vec_id, cluster, distance FROM (
    SELECT v.vec_id, m.cluster, sum((v.x - m.x) * (v.x - m.x)) AS distance,
           row_number() OVER (PARTITION BY v.vec_id ORDER BY sum((v.x - m.x) * (v.x - m.x)), m.cluster) AS place
    FROM parts v JOIN c{k} m USING (i) GROUP BY v.vec_id, m.cluster) WHERE place = 1"""
    rounds = "".join(
        f""", a{k} AS MATERIALIZED ({near.format(k=k)}
), c{k + 1} AS MATERIALIZED (
  SELECT m.cluster, m.i, CASE WHEN n.n IS NULL THEN m.x ELSE ((n.s - ((n.s % n.n) + n.n) % n.n) // n.n)::BIGINT END AS x
  FROM c{k} m LEFT JOIN (
    SELECT a.cluster, v.i, sum(v.x) AS s, count(*) AS n FROM a{k} a JOIN parts v USING (vec_id) GROUP BY a.cluster, v.i
  ) n USING (cluster, i)
)"""
        for k in range(c.rounds)
    )
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor({c.scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, unnest(range({WIDTH})) AS i, unnest(v) AS x FROM kept
), c0 AS MATERIALIZED (
  SELECT cluster, unnest(range({WIDTH})) AS i, unnest(v) AS x
  FROM (SELECT v, row_number() OVER (ORDER BY sha256('{c.seed}:' || vec_id)) - 1 AS cluster FROM kept) WHERE cluster < {c.centroids}
){rounds}, assigned AS MATERIALIZED ({near.format(k=c.rounds)}
), named AS (
  SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{c.rounds} GROUP BY cluster
)
SELECT a.vec_id, a.cluster::INTEGER AS cluster, a.distance::BIGINT AS distance,
       sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia, sum(a.distance) OVER ()::BIGINT AS inertia, n.centroid_sha256
FROM assigned a JOIN named n USING (cluster)
"""
