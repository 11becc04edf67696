"""SimHash near-duplicates over deletion-variant signatures.

Fingerprints of 64 bits that differ in at most three are cut into two segments only, so in
one of them they differ in at most one bit.  That segment is indexed whole and once for each
of its bits left out: fingerprints that link meet under the whole segment, or on different
sides of the list of the bit that differs.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankframe.llm.common import let, stored, words_of
from rankframe.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS = 64


@dataclass(frozen=True)
class SimhashConfig:
    """Fingerprints of ``words``-word shingles link at ``distance`` differing bits or fewer.
    ``short_list``: lists up to this length are compared within; longer ones are indexed
    again by the bits that are not in their signature yet.
    ``broadcast_rows``: signatures up to this number are broadcast, more are joined by
    shuffle."""

    words: int = 3
    distance: int = 3
    short_list: int = 64
    broadcast_rows: int = 1_000_000

    def __post_init__(self) -> None:
        if not 0 <= self.distance <= 3:
            raise ValueError("two segments with one bit left out find distances of 0 to 3")


def shingle_hashes(text: Column, words: int) -> Column:
    """XXH64 (seed 42) of every shingle, repeats included, in the order of the text."""

    def hashes(w: Column) -> Column:
        starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - (words - 1), F.lit(0)))
        every = F.transform(starts, lambda x, i: F.xxhash64(F.concat_ws(" ", x, *[F.get(w, i + k) for k in range(1, words)])))
        few = F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(F.array_join(w, " "))))
        return F.when(F.size(w) < words, few).otherwise(every)

    return let(words_of(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)), hashes)


def majority_bits(hashes: np.ndarray, at_once: int = 1 << 18) -> int:
    """The fingerprint of 64-bit hashes: bits that are set in over half of them."""
    ones = np.zeros(BITS, np.int64)
    octets = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)
    for start in range(0, len(octets), at_once):
        ones += np.unpackbits(octets[start : start + at_once], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(octets), bitorder="little").view("<i8")[0]) if len(octets) else 0


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(1)
        values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        found = [majority_bits(values[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])


def fingerprints(documents: DataFrame, words: int) -> DataFrame:
    """``(doc_id, fp)`` per row of ``documents(doc_id, text)``; ``fp`` is a signed long."""
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), shingle_hashes(F.col("text").cast("string"), words).alias("hashes"))
    return source.mapInArrow(_fingerprints, "doc_id long, fp long")


def _close(a: Column | str, b: Column | str, c: SimhashConfig) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.bit_count(a.bitwiseXOR(b)) <= c.distance


def _signed(entries: DataFrame, width: int) -> DataFrame:
    """Every entry under its signatures: ``rest``, the ``width`` bits that its ``path`` does
    not hold yet, is cut in two, and either half joins the path, whole or with one bit left
    out.

    ``left_out`` and ``bits`` are the levels at which a bit was left out, and the bits. Linked
    fingerprints differ in all of these, so a list holds one pattern (``side`` 0) and its
    opposite (1).
    """
    half, level = width // 2, {64: 1, 32: 2, 16: 4}[width]
    halves = [F.shiftrightunsigned("rest", upper * half).bitwiseAND(F.lit((1 << half) - 1)) for upper in (0, 1)]
    signatures = []
    for upper, value in enumerate(halves):
        for bit in (None, *range(half)):
            kept = value if bit is None else value.bitwiseAND(F.lit(~(1 << bit)))
            path = F.xxhash64("path", F.lit(2 * half * upper + (half if bit is None else bit)), kept).alias("path")
            out = F.col("left_out") if bit is None else F.col("left_out") + level
            bits = F.col("bits") if bit is None else F.col("bits") + level * F.getbit(value, F.lit(bit)).cast("int")
            signatures.append(F.struct(path, halves[1 - upper].alias("rest"), out.alias("left_out"), bits.alias("bits")))
    opposite = F.col("left_out") - F.col("bits")
    return (
        entries.select("fp", F.explode(F.array(*signatures)).alias("s")).select("fp", "s.*")
        .withColumn("key", F.xxhash64("path", F.least(F.col("bits"), opposite)))
        .withColumn("side", (F.col("bits") > opposite).cast("int"))
    )


def _lists(signed: DataFrame, c: SimhashConfig) -> DataFrame:
    """Signatures under which two fingerprints can meet: the length of their lists, and the
    smallest fingerprint of either side, the leaders."""
    lists = signed.groupBy("key").agg(
        F.count(F.lit(1)).alias("entries"), F.sum("side").alias("ones"), F.max("left_out").alias("out"),
        F.min(F.when(F.col("side") == 0, F.col("fp"))).alias("leader"), F.min(F.when(F.col("side") == 1, F.col("fp"))).alias("opposite"),
    )
    two_sided = (F.col("ones") > 0) & (F.col("ones") < F.col("entries"))
    return lists.where(F.when(F.col("out") == 0, F.col("entries") > 1).otherwise(two_sided)).drop("ones")


def _apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members, with labels, of lists that known links leave in several components."""
    label = F.coalesce("component", "fp").alias("label")
    labelled = stored(members.join(labels, members.fp == labels.node, "left").select(*members.columns, label), "labelled")
    open_lists = labelled.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("key")
    return stored(labelled.join(open_lists, "key", "left_semi"), "open-lists")


def _pairs(members: DataFrame, c: SimhashConfig) -> DataFrame:
    """Links between members of a list that are of different components."""
    p, q = members.alias("p"), members.alias("q")
    once = F.when(F.col("p.out") == 0, F.col("p.fp") < F.col("q.fp")).otherwise((F.col("p.side") == 0) & (F.col("q.side") == 1))
    found = p.join(q, (F.col("p.key") == F.col("q.key")) & (F.col("p.label") != F.col("q.label")) & once & _close("p.fp", "q.fp", c))
    return found.select(F.col("p.fp").alias("a"), F.col("q.fp").alias("b"))


def connecting_edges(prints: DataFrame, config: SimhashConfig | None = None) -> DataFrame:
    """Edges ``(a, b)`` between different fingerprints ``prints(fp)`` that link: enough of
    them that two are connected just if links connect them.

    In every list all members are first compared with the leader of the other side. Only
    lists that these links leave in several components go on, and in them only pairs of
    different components are looked for. A list beyond ``short_list`` is not compared
    within: its fingerprints are indexed again under the list's signature and a half of the
    bits outside it. After three such cuts 8 bits are left, so a list has 256 fingerprints
    a side at most. No list is gathered.
    """
    c = config or SimhashConfig()
    # every row becomes 66, so the tasks are not left to the size of the narrow rows
    dealt = prints.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    entries = dealt.select("fp", F.lit(0).cast("long").alias("path"), F.col("fp").alias("rest"), F.lit(0).alias("left_out"), F.lit(0).alias("bits"))
    edges = []
    for width in (64, 32, 16):
        signed = _signed(entries, width)
        lists = stored(_lists(signed, c), "signature-lists")
        known = F.broadcast(lists) if lists.count() <= c.broadcast_rows else lists
        members = stored(signed.join(known, "key"), "list-members")
        other = F.when((F.col("out") == 0) | (F.col("side") == 1), F.col("leader")).otherwise(F.col("opposite"))
        led = members.select(F.col("fp").alias("b"), other.alias("a")).where(F.col("a") != F.col("b")).where(_close("a", "b", c))
        edges.append(stored(led.select("a", "b").distinct(), "leader-links"))
        labels = components(functools.reduce(DataFrame.unionByName, edges))
        apart = _apart(members, labels)
        brief = F.col("entries") <= c.short_list if width > 16 else F.lit(True)
        edges.append(stored(_pairs(apart.where(brief), c).distinct(), "member-links"))
        entries = stored(apart.where(~brief).select("fp", "path", "rest", "left_out", "bits").distinct(), "long-lists")
        if entries.isEmpty():
            break
    return functools.reduce(DataFrame.unionByName, edges)


def near_duplicates(documents: DataFrame, config: SimhashConfig | None = None) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per row of ``documents(doc_id,
    text)``: the fingerprint in 16 hexadecimal digits, and the smallest doc_id that links
    lead to, its own included.

    Fingerprints are counted on whole texts. Rows with equal fingerprints are one class, and
    links are sought between classes (see ``connecting_edges``). A text that is null or has
    no word has the fingerprint 0 and links like any other; a text of fewer words than a
    shingle is one shingle. Repeated rows are copies; a null doc_id never names a component
    unless all its ids are null. Without rows the result is empty. Other columns are ignored.
    """
    c = config or SimhashConfig()
    rows = stored(fingerprints(documents, c.words), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-classes")
    label = components(connecting_edges(classes.select("fp"), c))
    joined = classes.join(label, classes.fp == label.node, "left").withColumn("component", F.coalesce("component", "fp")).drop("node")
    joined = stored(joined, "class-components")
    smallest = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stored(joined.join(smallest, "component").select("fp", "component_id"), "named-classes")
    text = F.lpad(F.lower(F.hex("fp")), BITS // 4, "0").alias("fingerprint")
    return rows.join(named, "fp").select("doc_id", text, "component_id")
