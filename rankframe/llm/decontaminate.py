"""Benchmark decontamination: BM25 retrieval of test items with block-max WAND."""

from __future__ import annotations

import functools
import itertools
import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankframe.llm.common import stored

TERM = re.compile(r"\w+")
SHINGLE = 5


@dataclass(frozen=True)
class LeakConfig:
    """``threshold``: BM25 of a passage, as a share of the item's own score, from which
    an item is retrieved. ``question``/``answer``: share of the item's five-word shingles
    (of its last fifth, for the answer) that verify a leak: either ``question_alone``, or
    both of the others. ``max_item_words``: longer items are indexed in parts.
    ``common_share``: terms in more of the items are not indexed, unless an item has few
    others. ``index_bytes``: text of items that one index may hold; more items are
    indexed, and queried, in several rounds."""

    threshold: float = 0.5
    question_alone: float = 0.8
    question: float = 0.5
    answer: float = 0.5
    max_item_words: int = 256
    common_share: float = 0.1
    k1: float = 1.2
    b: float = 0.75
    block: int = 8
    index_bytes: int = 32 << 20


def terms_of(text: str | None) -> list[str]:
    return TERM.findall(text.lower()) if text else []


@dataclass(frozen=True)
class ItemStatistics:
    """Of all parts of all items: how many, their mean length, and the parts of each term."""

    parts: int
    mean: float
    df: Mapping[str, int]


def parts_of(text: str | None, c: LeakConfig) -> list[list[str]]:
    """An item's terms, in even parts of at most ``max_item_words``."""
    words = terms_of(text)
    n = -(-len(words) // c.max_item_words)
    return [words[len(words) * k // n : len(words) * (k + 1) // n] for k in range(n)]


class ItemIndex:
    """Postings by term, items in order of number, with maxima per term and block.

    Impacts are BM25 contributions divided by the item's own score, so a text that holds
    all indexed terms of an item scores 1 on it.
    """

    def __init__(self, items: list[tuple[int, str]], config: LeakConfig, statistics: ItemStatistics | None = None) -> None:
        self.config = config
        parts = [(item, words) for item, text in items for words in parts_of(text, config)]
        self.items = [item for item, _ in parts]
        self.words = [words for _, words in parts]
        counts = [Counter(w) for w in self.words]
        if statistics is None:
            statistics = ItemStatistics(len(parts), sum(map(len, self.words)) / max(1, len(parts)), Counter(t for c in counts for t in c))
        n, mean, df = statistics.parts, statistics.mean, statistics.df
        common = max(1, config.common_share * n)
        postings: dict[str, list[tuple[int, float]]] = {}
        for i, c in enumerate(counts):
            rare = [t for t in c if df[t] <= common]
            norm = config.k1 * (1 - config.b + config.b * len(self.words[i]) / mean)
            impact = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * (config.k1 + 1) / (c[t] + norm) for t in (rare if len(rare) >= 3 else c)}
            own = sum(impact.values())
            for t, x in impact.items():
                postings.setdefault(t, []).append((i, x / own))
        self.vocabulary = {t: k for k, t in enumerate(postings)}
        sizes = np.array([len(p) for p in postings.values()], np.int64)
        term = np.repeat(np.arange(len(sizes)), sizes)
        self.ids = np.array([i for p in postings.values() for i, _ in p], np.int64)
        self.impacts = np.array([x for p in postings.values() for _, x in p])
        self.n_blocks = -(-len(parts) // config.block)
        # stretches of one term and block, in the order of the postings
        stretch, first = np.unique(term * max(1, self.n_blocks) + self.ids // config.block, return_index=True)
        self.stretch_block = stretch % max(1, self.n_blocks)
        self.stretch_most = np.maximum.reduceat(self.impacts, first) if len(first) else self.impacts
        self.stretch_ends = np.append(first, len(self.ids))
        self.term_ends = np.searchsorted(stretch, np.arange(len(sizes) + 1) * max(1, self.n_blocks))
        self.most = np.maximum.reduceat(self.impacts, np.cumsum(sizes) - sizes) if len(sizes) else self.impacts
        self.longest = max(map(len, self.words), default=0)
        fifth = [max(SHINGLE, len(w) // 5) for w in self.words]
        self.questions = [shingles(w[:-n] if len(w) > n + SHINGLE else w) for w, n in zip(self.words, fifth)]
        self.answers = [shingles(w[-n:]) for w, n in zip(self.words, fifth)]

    def retrieve(self, terms: np.ndarray, passages: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """For all passages of a text, given as (passage, distinct term) pairs in order:
        every item that scores the threshold or more, as (passage, item, score)."""
        least = self.config.threshold - 1e-9
        fit = np.bincount(passages, self.most[terms])[passages] >= least if len(terms) else []
        terms, passages = terms[fit], passages[fit]
        numbers, starts = np.unique(passages, return_index=True)
        ends = np.append(starts[1:], len(terms))
        at_once = max(1, 2_000_000 // max(1, self.n_blocks))
        for k in range(0, len(numbers), at_once):
            span = slice(starts[k], ends[min(k + at_once, len(numbers)) - 1])
            bound = self._block_bounds(terms[span], np.searchsorted(numbers, passages[span]) - k)
            for passage in np.flatnonzero((bound >= least).any(axis=1)):
                own = terms[starts[k + passage] : ends[k + passage]]
                for item, score in self._wand(own, bound[passage] >= least, least):
                    yield int(numbers[k + passage]), item, score

    def _block_bounds(self, terms: np.ndarray, passages: np.ndarray) -> np.ndarray:
        """What the terms of a passage add up to at most, by passage and block."""
        start, n = self.term_ends[terms], self.term_ends[terms + 1] - self.term_ends[terms]
        stretch = np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)
        cell = np.repeat(passages, n) * self.n_blocks + self.stretch_block[stretch]
        rows = int(passages[-1]) + 1
        return np.bincount(cell, self.stretch_most[stretch], rows * self.n_blocks).reshape(rows, self.n_blocks)

    def _wand(self, terms: np.ndarray, open_blocks: np.ndarray, least: float) -> list[tuple[int, float]]:
        """Item by item over the blocks that are left: the pivot is the first item that the
        terms up to it could lift to the threshold; items before it are skipped."""
        cursors = []
        for t in terms.tolist():
            lists = [(s, e) for k in range(self.term_ends[t], self.term_ends[t + 1]) if open_blocks[self.stretch_block[k]] for s, e in [(self.stretch_ends[k], self.stretch_ends[k + 1])]]
            if lists:
                impacts = np.concatenate([self.impacts[s:e] for s, e in lists])
                rest = np.maximum.accumulate(impacts[::-1])[::-1].tolist()  # the most from each posting on
                cursors.append([[p for s, e in lists for p in zip(self.ids[s:e].tolist(), self.impacts[s:e].tolist())], 0, rest])
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0][c[1]][0])
            possible = 0.0
            for postings, at, rest in cursors:
                possible += rest[at]
                if possible >= least:
                    pivot = postings[at][0]
                    break
            else:
                break
            score = 0.0
            for c in cursors:
                while c[1] < len(c[0]) and c[0][c[1]][0] < pivot:
                    c[1] += 1
                if c[1] < len(c[0]) and c[0][c[1]][0] == pivot:
                    score += c[0][c[1]][1]
                    c[1] += 1
            if score >= least:
                found.append((pivot, score))
            cursors = [c for c in cursors if c[1] < len(c[0])]
        return found

    def leaks(self, text: str | None) -> dict[int, tuple[float, float, float]]:
        """Verified leaks in a whole text: item to (score, question and answer overlap).

        Passages are twice the longest item long and start every such length, so any
        occurrence of an item lies in one of them. An item of fewer words than a shingle is
        compared with the passage's shingles of its own length: it has to occur as it is.
        """
        words = terms_of(text)
        if not words or not self.items:
            return {}
        step, c = self.longest, self.config
        ids = np.fromiter(map(self.vocabulary.get, words, itertools.repeat(-1)), np.int64, len(words))
        place = np.flatnonzero(ids >= 0)
        last = max(0, -(-(len(words) - step) // step) - 1)
        pairs = [(k * len(self.most) + ids[place])[(k >= 0) & (k <= last)] for k in (place // step, place // step - 1)]
        passages, terms = np.divmod(np.unique(np.concatenate(pairs)), len(self.most))
        best: dict[int, tuple[float, float, float]] = {}
        held: dict[tuple[int, int], set[tuple[str, ...]]] = {}
        for passage, part, score in self.retrieve(terms, passages):
            size = min(SHINGLE, len(self.words[part]))
            if (passage, size) not in held:
                held = {k: v for k, v in held.items() if k[0] == passage}
                held[passage, size] = shingles(words[passage * step : (passage + 2) * step], size)
            near = held[passage, size]
            question = len(self.questions[part] & near) / len(self.questions[part])
            answer = len(self.answers[part] & near) / len(self.answers[part])
            if question >= c.question_alone or question >= c.question and answer >= c.answer:
                item = self.items[part]
                best[item] = max(best.get(item, (0.0, 0.0, 0.0)), (score, question, answer))
        return best


def shingles(words: list[str], size: int = SHINGLE) -> set[tuple[str, ...]]:
    """Shingles of so many words; fewer words are one shingle."""
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def _query(index, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = index.value
    for batch in batches:
        rows = [(doc, item, *values) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)) for item, values in held.leaks(text.as_py()).items()]
        if rows:
            kinds = [pa.int64(), pa.int64()] + [pa.float64()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])


def find_leaks(documents: DataFrame, benchmark: DataFrame, config: LeakConfig | None = None) -> DataFrame:
    """Verified leaks of ``benchmark(item_id, text)`` in ``documents(doc_id, text)``: one
    row per document row and item, with the best passage's score and overlaps.

    The index of the items is a broadcast of checked size; a benchmark with more text is
    split by a hash of its items into several indexes, one of which is held at a time, and
    every document queries all of them. Scores follow statistics of all items however they
    are split. Documents are never shuffled.

    Null or empty texts and items without words give no rows, nor do empty tables. An item
    of one to four words is found where these words occur in a row. Repeated items count
    once; repeated documents, and those with null ids, are reported each. Other columns are
    ignored.
    """
    config, spark = config or LeakConfig(), documents.sparkSession
    source = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    rounds, found = _rounds(benchmark, config), []
    for load in rounds:
        index = spark.sparkContext.broadcast(load())
        found.append(source.mapInArrow(functools.partial(_query, index), schema))
        if len(rounds) > 1:
            found[-1] = stored(found[-1], "leaks")
            index.destroy()
    return functools.reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def _terms(batches: Iterable[pa.RecordBatch], config: LeakConfig) -> Iterator[pa.RecordBatch]:
    """A row for each part of an item, with its length, and for each different term of it."""
    for batch in batches:
        rows = [row for text in batch.column(0) for words in parts_of(text.as_py(), config) for row in [(None, len(words)), *((t, 0) for t in sorted(set(words)))]]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["term", "length"])


def _rounds(benchmark: DataFrame, config: LeakConfig) -> list[Callable[[], ItemIndex]]:
    """For every block of items of bounded size, what loads its index to the driver. Terms
    are counted over all items, and a block gets the counts of its own terms."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    items = stored(items, "items")
    rounds = -(-int(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // config.index_bytes)
    if not rounds:
        return []
    terms = lambda some: some.select("text").mapInArrow(functools.partial(_terms, config=config), "term string, length long")
    counts = stored(terms(items).groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("length").alias("length")), "item-terms")
    parts, length = counts.where("term is null").select("df", "length").first() or (0, 0)
    own = F.pmod(F.xxhash64("item", "text"), F.lit(rounds))

    def load(k: int) -> ItemIndex:
        block = items.where(own == k)
        wanted = terms(block).where("term is not null").select("term").distinct()
        df = {r["term"]: r["df"] for r in counts.join(wanted, "term").select("term", "df").collect()}
        return ItemIndex(sorted(map(tuple, block.collect()), key=str), config, ItemStatistics(parts, length / max(1, parts), df))

    return [functools.partial(load, k) for k in range(rounds)]


def _without_leaks(index, text_column: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = index.value
    for batch in batches:
        yield batch.filter(pa.array([not held.leaks(text.as_py()) for text in batch.column(text_column)], pa.bool_()))


def drop_leaks(documents: DataFrame, benchmark: DataFrame, config: LeakConfig | None = None) -> DataFrame:
    """``documents`` without the rows that hold a verified leak; columns are as given."""
    rounds = _rounds(benchmark, config or LeakConfig())
    for load in rounds:
        index = documents.sparkSession.sparkContext.broadcast(load())
        documents = documents.mapInArrow(functools.partial(_without_leaks, index, documents.columns.index("text")), documents.schema)
        if len(rounds) > 1:
            documents = stored(documents, "without-leaks")
            index.destroy()
    return documents
