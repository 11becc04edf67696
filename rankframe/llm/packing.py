"""Hierarchical packing of documents into sequences of several context sizes."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankframe.llm.common import stored
from rankframe.llm.tokens import Vocabulary, encoder


@dataclass(frozen=True)
class PackingConfig:
    """``tiers``: context sizes, each twice the one before. ``end_id`` closes a document.
    ``block_tokens``: ids that a task holds while it packs. ``step_tokens``: tokens of a
    training step. ``tails_together``: how many partitions' leftovers are packed together.
    ``broadcast_rows``: window counts (of a partition and tier) up to this number are
    broadcast, more are joined by shuffle."""

    vocabulary: Vocabulary = field(default_factory=Vocabulary.public)
    tiers: tuple[int, ...] = (256, 512, 1024, 2048)
    end_id: int = 1
    block_tokens: int = 4_000_000
    step_tokens: int = 1 << 20
    tails_together: int = 64
    broadcast_rows: int = 500_000


#: ``ids``: of the piece, 32 bits each, little-endian. ``short``: the window is packed again.
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, tier int, tier_rank long, part long, short boolean, ids binary"


@dataclass(slots=True)
class _Segment:
    """Ids [start, start + length) of a document; ``ids`` holds just these."""

    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, n: int) -> tuple[_Segment, _Segment]:
        return (
            _Segment(self.doc_id, self.start, self.ids[:n], self.doc_tokens),
            _Segment(self.doc_id, self.start + n, self.ids[n:], self.doc_tokens),
        )


class _Pool:
    """Segments by length; the set bits of ``_lengths`` are the lengths at hand."""

    def __init__(self) -> None:
        self._by_length: dict[int, list[_Segment]] = {}
        self._lengths = 0

    def add(self, segment: _Segment) -> None:
        n = len(segment.ids)
        if n:
            self._by_length.setdefault(n, []).append(segment)
            self._lengths |= 1 << n

    def take(self, n: int) -> _Segment:
        stack = self._by_length[n]
        segment = stack.pop()
        if not stack:
            self._lengths ^= 1 << n
        return segment

    def longest(self, limit: int) -> int:
        """The greatest length up to ``limit``, 0 if there is none."""
        return max(0, (self._lengths & ((1 << (limit + 1)) - 1)).bit_length() - 1)

    def shortest_beyond(self, n: int, limit: int) -> int:
        """The least length in (n, limit], 0 if there is none."""
        rest = self._lengths >> (n + 1)
        found = n + (rest & -rest).bit_length() if rest else 0
        return found if found <= limit else 0


def _fill(pool: _Pool, window: list[_Segment], gap: int, limit: int) -> int:
    """Fill a window's gap with segments up to ``limit`` long: best fits first, then the
    head of the shortest one that is too long.  Returns what stays open."""
    while gap:
        if n := pool.longest(min(gap, limit)):
            window.append(pool.take(n))
            gap -= n
        elif n := pool.shortest_beyond(gap, limit):
            head, rest = pool.take(n).cut(gap)
            window.append(head)
            pool.add(rest)
            gap = 0
        else:
            break
    return gap


def pack_windows(pool: _Pool, tiers: tuple[int, ...]) -> Iterator[tuple[int, list[_Segment]]]:
    """Yield full windows ``(tier, segments)``, longest tier first: each is opened by a
    segment of its own tier, and shorter tiers fill it.  What fills no window of its tier
    is joined into windows of the longest; the last one may stay short."""
    rest: list[_Segment] = []
    for k in reversed(range(len(tiers))):
        tier, below = tiers[k], tiers[k - 1] if k else 0
        while (n := pool.longest(tier)) > below:
            window = [pool.take(n)]
            if _fill(pool, window, tier - n, below or tier):
                rest += window
            else:
                yield tier, window
    window, room = [], tiers[-1]
    for segment in rest:
        while len(segment.ids) >= room:
            head, segment = segment.cut(room)
            yield tiers[-1], [*window, head]
            window, room = [], tiers[-1]
        if len(segment.ids):
            window.append(segment)
            room -= len(segment.ids)
    if window:
        yield tiers[-1], window


class _Writer:
    """Rows of finished sequences of one partition."""

    def __init__(self, part: int, first_id: int) -> None:
        self.part, self.next_id = part, first_id
        self.ranks: Counter[int] = Counter()
        self.rows: list[tuple] = []
        self.held = 0

    def add(self, tier: int, window: list[_Segment], short: bool = False) -> None:
        offset = 0
        for s in window:
            self.rows.append((s.doc_id, s.start, len(s.ids), s.doc_tokens, self.next_id, offset, tier, self.ranks[tier], self.part, short, s.ids.tobytes()))
            offset += len(s.ids)
        self.held += offset
        self.ranks[tier] += 1
        self.next_id += 1

    def full(self) -> bool:
        return self.held >= 2_000_000 or len(self.rows) >= 20_000

    def flush(self) -> list[tuple]:
        rows, self.rows, self.held = self.rows, [], 0
        return rows


def _pack_partition(batches: Iterable[pa.RecordBatch], config: PackingConfig, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, top = TaskContext.get().partitionId(), config.tiers[-1]
    encode, pool, held = encoder(config.vocabulary).encode, _Pool(), 0
    writer = _Writer(part, part << 32)
    out = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = np.append(encode(text.as_py()), np.uint32(config.end_id)).astype("<u4", copy=False)
            rest = _Segment(doc_id, 0, ids, len(ids))
            while len(rest.ids) >= top:
                whole, rest = rest.cut(top)
                writer.add(top, [whole])
                if writer.full():
                    yield out(writer.flush())
            pool.add(_Segment(doc_id, rest.start, rest.ids.copy(), len(ids)))
            held += len(rest.ids)
            if held >= config.block_tokens:
                held = 0
                for tier, window in pack_windows(pool, config.tiers):
                    if sum(len(s.ids) for s in window) == tier:
                        writer.add(tier, window)
                        if writer.full():
                            yield out(writer.flush())
                    else:  # waits for the next block
                        for s in window:
                            pool.add(s)
                            held += len(s.ids)
    for tier, window in pack_windows(pool, config.tiers):
        writer.add(tier, window, short=sum(len(s.ids) for s in window) < tier)
        if writer.full():
            yield out(writer.flush())
    if writer.rows:
        yield out(writer.flush())


def _pack_tails(rows: pd.DataFrame, config: PackingConfig) -> pd.DataFrame:
    """Join the short last windows of some partitions into full ones."""
    top, group = config.tiers[-1], int(rows["part"].iloc[0]) // config.tails_together
    writer, window, room = _Writer(-1 - group, (1 << 62) | (group << 32)), [], top
    for r in rows.sort_values(["part", "sequence_id", "offset"]).itertuples():
        segment = _Segment(None if pd.isna(r.doc_id) else int(r.doc_id), r.start, np.frombuffer(r.ids, "<u4"), r.doc_tokens)
        while len(segment.ids) >= room:
            head, segment = segment.cut(room)
            writer.add(top, [*window, head])
            window, room = [], top
        if len(segment.ids):
            window.append(segment)
            room -= len(segment.ids)
    if window:
        writer.add(top, window)
    out = pd.DataFrame(writer.flush(), columns=[c.split()[0] for c in PIECES.split(", ")])
    out["doc_id"] = out["doc_id"].astype("Int64")
    return out


def pack_documents(documents: DataFrame, config: PackingConfig | None = None) -> DataFrame:
    """Pack ``documents(doc_id, text)`` into sequences; one row per piece of a document
    with its ``ids`` (32 bits each, little-endian) and their ``ids_crc32``.

    A document is its ids and ``end_id``. Full windows of the longest tier are cut from it
    at once; what is left is routed to the smallest tier that holds it. Each partition
    packs its tiers in blocks of bounded size, longest first, and fills gaps from shorter
    tiers (whole pieces by best fit, else a cut). The short last window of a partition
    goes on to a second packing over many partitions. So but for these windows no text or
    id is shuffled, and less than one window per ``tails_together`` partitions is padded.

    ``step_group`` deals the windows of each tier round-robin to as many groups as there
    are ``step_tokens`` in the corpus, so groups differ by at most one window per tier.

    A null or empty text is a document of ``end_id`` alone. Rows are documents: repeated
    rows and equal or null ids are packed each on its own. Without rows the result is
    empty. Other columns are ignored.
    """
    config = config or PackingConfig()
    source = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(PIECES))
    packed = stored(source.mapInArrow(lambda it: _pack_partition(it, config, schema), PIECES), "pieces")
    tails = (
        packed.where("short")
        .groupBy(F.floor(F.col("part") / config.tails_together))
        .applyInPandas(lambda rows: _pack_tails(rows, config), PIECES)
    )
    pieces = packed.where("not short").unionByName(stored(tails, "tails"))

    counts = pieces.where("offset = 0").groupBy("tier", "part").agg(F.count(F.lit(1)).alias("_windows"))
    before = Window.partitionBy("tier").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.withColumn("_before", F.coalesce(F.sum("_windows").over(before), F.lit(0))), "window-counts")
    tokens = counts.agg(F.sum(F.col("tier") * F.col("_windows"))).first()[0] or 0
    if counts.count() <= config.broadcast_rows:  # else the pieces would be shuffled with their ids
        counts = F.broadcast(counts)
    groups = max(1, -(-tokens // config.step_tokens))
    return (
        pieces.join(counts.drop("_windows"), ["tier", "part"])
        .select(
            "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier",
            ((F.col("_before") + F.col("tier_rank")) % groups).cast("long").alias("step_group"), "ids",
        )
    )
