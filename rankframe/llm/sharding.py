"""Balanced label propagation: linked documents move together, shards stay even."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankframe.llm.common import numbered, stored


@dataclass(frozen=True)
class ShardConfig:
    """``rounds``: at most so many propagation rounds; fewer if nothing moves.
    ``large_share``: a group above this share of a shard moves row by row, not whole."""

    shards: int = 8
    rounds: int = 10
    large_share: float = 0.125
    priorities: int = 1024


def propagate(linked: DataFrame, quotas: list[int], config: ShardConfig) -> DataFrame:
    """Place ``linked(row, hub, hub_rows)`` into shards; returns it with ``shard``.

    A hub links all its rows. Rows start spread by hash. In each round every hub names the
    shard, among those with free room, that holds most of its rows, and rows elsewhere
    want to go there. Rows are admitted up to the room of the shard, by priority: the rows
    of a hub share one, unless the hub is too large to move whole. Rooms and admitted
    numbers are read off counts by shard and priority, a table of fixed size.  Shards may
    start above their quota; they then admit nothing.
    """
    k = config.shards
    large = F.col("hub_rows") > int(config.large_share * min(quotas))
    state = stored(linked.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(k)).cast("int")), "shard-state")
    for turn in range(config.rounds):
        load = {r["shard"]: r["count"] for r in state.groupBy("shard").count().collect()}
        room = [quotas[s] - load.get(s, 0) for s in range(k)]
        free = F.element_at(F.array(*[F.lit(r > 0) for r in room]), F.col("shard") + 1)
        held = state.groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("n"))
        target = (
            held.where(free).groupBy("hub")
            .agg(F.max(F.struct("n", F.xxhash64("hub", "shard").alias("tie"), "shard")).alias("best"))
            .select("hub", F.col("best.shard").alias("target"), F.col("best.n").alias("gain"))
        )
        here = held.select("hub", "shard", F.col("n").alias("own"))
        moves = stored(here.join(target, "hub").where((F.col("shard") != F.col("target")) & _better(quotas, room)), "shard-moves")
        # a row's hub and shard say where it wants to go
        chance = F.pmod(F.when(large, F.xxhash64("row", F.lit(turn))).otherwise(F.xxhash64("hub", F.lit(turn))), F.lit(config.priorities)).cast("int")
        wanting = state.join(moves.select("hub", "shard", "target"), ["hub", "shard"], "left").withColumn("priority", chance)
        wanting = stored(wanting, "shard-wants")
        counts = wanting.where("target is not null").groupBy("target", "priority").count().collect()
        if not counts:
            return state
        admitted = (F.col("target") * config.priorities + F.col("priority")).isin(_admitted(counts, room, config.priorities))
        moved = F.when(F.coalesce(admitted, F.lit(False)), F.col("target")).otherwise(F.col("shard"))
        state = stored(wanting.select("row", "hub", "hub_rows", moved.alias("shard")), "shard-state")
    return state


def _better(quotas: list[int], room: list[int]):
    """Leave a shard for one that holds more of the hub; full shards are left only by rows
    that are few there."""
    full = F.element_at(F.array(*[F.lit(r <= 0) for r in room]), F.col("shard") + 1)
    return F.when(full, F.col("own") < F.col("gain")).otherwise(F.lit(True))


def _admitted(counts: list, room: list[int], priorities: int) -> list[int]:
    """Codes of the priorities that each shard admits: in order, whichever still fits."""
    left, codes = list(room), []
    for target, priority, rows in sorted(map(tuple, counts)):
        if rows <= left[target]:
            left[target] -= rows
            codes.append(target * priorities + priority)
    return codes


def _evicted(placed: DataFrame, quotas: list[int], config: ShardConfig) -> DataFrame:
    """Exactly the rows by which shards exceed their quotas, of split groups first."""
    large = (F.col("hub_rows") > int(config.large_share * min(quotas))).cast("int")
    kinds = placed.withColumn("kind", F.col("shard") * 2 + large)
    held = {r["kind"]: r["count"] for r in kinds.groupBy("kind").count().collect()}
    leave = []
    for s, quota in enumerate(quotas):
        excess = max(0, held.get(2 * s, 0) + held.get(2 * s + 1, 0) - quota)
        from_large = min(excess, held.get(2 * s + 1, 0))
        leave += [excess - from_large, from_large]
    if not any(leave):
        return placed.select("row").limit(0)
    limit = F.element_at(F.array(*[F.lit(n) for n in leave]), F.col("kind") + 1)
    return numbered(kinds, "kind", "row", "number").where(F.col("number") < limit).select("row")


def shard_documents(documents: DataFrame, config: ShardConfig | None = None) -> DataFrame:
    """Deal ``documents(doc_id, text)`` into shards whose row counts differ by one at most,
    keeping equal texts together where room allows; one row per input row.

    Equal texts are linked. They are placed by label propagation under each shard's quota;
    documents without a link, and rows that a shard has in excess, then fill every shard to
    its quota exactly. ``slot`` numbers
    a shard's rows from 0 without gaps.

    ``size`` is the text's UTF-8 bytes plus 1; a null text has no bytes, crc 0 and no
    links, empty texts are equal to each other. Repeated rows and null ids are rows like
    any other. Without rows the result is empty. Other columns are ignored.
    """
    config = config or ShardConfig()
    text = F.col("text").cast("string")
    rows = stored(
        documents.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(text), F.lit(0).cast("long")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("hub"),
        ),
        "shard-rows",
    )
    total = rows.count()
    quotas = [total // config.shards + (s < total % config.shards) for s in range(config.shards)]
    hubs = stored(rows.where("hub is not null").groupBy("hub").agg(F.count(F.lit(1)).alias("hub_rows")).where("hub_rows > 1"), "shard-hubs")
    placed = propagate(rows.select("row", "hub").join(hubs, "hub"), quotas, config)
    placed = stored(placed.join(_evicted(placed, quotas, config), "row", "left_anti").select("row", "shard"), "shard-linked")
    load = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}

    lone = numbered(rows.join(placed, "row", "left_anti").select("row", F.lit(0).alias("all")), "all", "row", "number")
    ends, end = [], 0
    for s in range(config.shards):
        end += max(0, quotas[s] - load.get(s, 0))
        ends.append(end)
    fill = F.coalesce(*[F.when(F.col("number") < e, F.lit(s)) for s, e in enumerate(ends)], F.lit(config.shards - 1))
    shards = stored(placed.unionByName(lone.select("row", fill.alias("shard"))), "shard-placed")
    return numbered(rows.drop("hub").join(shards, "row"), "shard", "row", "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
