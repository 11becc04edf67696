"""Language identification: TF-IDF character n-grams, multinomial FTRL, temperature."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from rankframe.llm.common import stored

#: Odd multipliers that spread n-grams over the features.
MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@dataclass(frozen=True)
class LanguageConfig:
    """``per_language``: different labelled texts of each language, drawn by hash, that the
    classifier is fitted on (about). ``languages``: so many are learned, those with the most
    different texts. ``features``: size of the hashed feature space.
    ``alpha, beta, l1, l2``: FTRL-proximal. ``shards``: parts of the sample that learn
    side by side in each of ``rounds`` and are then averaged. One document in
    ``calibrate_every`` of the sample sets the temperature instead."""

    per_language: int = 2000
    languages: int = 256
    features: int = 1 << 14
    orders: tuple[int, ...] = (1, 2, 3)
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.001
    l2: float = 0.01
    rounds: int = 3
    shards: int = 8
    calibrate_every: int = 5


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


@functools.cache
def _letters() -> np.ndarray:
    """Which code points of the basic plane are letters or combining marks."""
    return np.array([chr(c).isalpha() or unicodedata.category(chr(c))[0] == "M" for c in range(1 << 16)])


def letters_only(points: np.ndarray) -> np.ndarray:
    """Each run of other characters becomes one space."""
    letter = (points >= 1 << 16) | _letters()[np.minimum(points, 0xFFFF)]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return np.where(letter, points, np.uint32(32))[keep]


def gram_counts(text: str, config: LanguageConfig) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the letters of the whole lower-case text: features that occur, and
    how often."""
    points = letters_only(np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4").astype(np.uint32))
    total = np.zeros(config.features, np.int64)
    bits = np.uint32(32 - config.features.bit_length() + 1)
    hashed = np.zeros(len(points), np.uint32)
    for n in range(max(config.orders)):
        if len(points) <= n:
            break
        hashed = hashed[: len(points) - n] + points[n:] * MIX[n % 3] + np.uint32(n + 1)
        if n + 1 in config.orders:
            mixed = hashed * MIX[0]
            mixed ^= mixed >> np.uint32(15)
            total += np.bincount((mixed * MIX[1]) >> bits, minlength=config.features)
    seen = np.flatnonzero(total)
    return seen, total[seen]


def tf_idf(seen: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1.0 + np.log(counts)) * idf[seen]
    norm = np.sqrt((values * values).sum())
    return values / norm if norm else values


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl_weights(z: np.ndarray, n: np.ndarray, c: LanguageConfig) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - c.l1, 0.0)
    return -shrunk / ((c.beta + np.sqrt(n)) / c.alpha + c.l2)


def ftrl_pass(examples: Iterable[tuple[np.ndarray, np.ndarray, int]], z: np.ndarray, n: np.ndarray, c: LanguageConfig) -> None:
    """Learn from ``(features, values, class)`` one by one; the last row is the bias."""
    bias = z.shape[0] - 1
    for seen, values, label in examples:
        at, x = np.append(seen, bias), np.append(values, 1.0)
        zs, ns = z[at], n[at]
        w = ftrl_weights(zs, ns, c)
        error = softmax(x @ w)
        error[label] -= 1.0
        g = np.outer(x, error)
        root = np.sqrt(ns + g * g)
        z[at] = zs + g - (root - np.sqrt(ns)) / c.alpha * w
        n[at] = ns + g * g


def _document_frequency(batches: Iterable[pa.RecordBatch], config: LanguageConfig) -> Iterator[pa.RecordBatch]:
    df, docs = np.zeros(config.features, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            df[gram_counts(text.as_py(), config)[0]] += 1
            docs += 1
    seen = np.flatnonzero(df)
    if docs:
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1), pa.int32()), pa.array(np.append(df[seen], docs), pa.int64())], ["feature", "docs"])


def _featurise(batches: Iterable[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    config, idf, languages = shared.value
    for batch in batches:
        rows = []
        for text, lang, shard, tune, place in zip(batch.column(0), *(c.to_pylist() for c in batch.columns[1:])):
            seen, counts = gram_counts(text.as_py(), config)
            rows.append((seen.astype("<i4").tobytes(), tf_idf(seen, counts, idf).astype("<f4").tobytes(), languages.index(lang), shard, tune, place))
        kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.bool_(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds], ["seen", "values", "label", "shard", "tune", "place"])


def _examples(rows: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    for seen, values, label in zip(rows["seen"], rows["values"], rows["label"]):
        yield np.frombuffer(seen, "<i4"), np.frombuffer(values, "<f4").astype(float), label


def _learner(shared):
    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        config, z, n = shared.value
        z, n = z.copy(), n.copy()
        # the stored hash, not the order of arrival, decides what is learned first
        ftrl_pass(_examples(rows.sort_values(["place", "seen", "label"], kind="stable")), z, n, config)
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "rows": [len(rows)], "z": [z.astype("<f8").tobytes()], "n": [n.astype("<f8").tobytes()]})

    return learn


def fit_language_model(labelled: DataFrame, config: LanguageConfig | None = None) -> LanguageModel | None:
    """Fit on ``labelled(text, lang)``; None if no row has a lang and a text with a letter.

    Document frequencies come from every labelled text; the classifier learns from a
    bounded sample of whole texts, drawn by a hash of the text for each language. Copies of a
    text are drawn once. The fit depends on the rows alone, not on how they are partitioned.
    Of more than ``languages`` values of lang, those with the fewest texts are not learned.
    """
    config, spark = config or LanguageConfig(), labelled.sparkSession
    rows = labelled.select(F.col("text").cast("string"), F.col("lang").cast("string")).where(r"lang is not null and text rlike '\\p{L}'")
    different = rows.select("lang", F.xxhash64("text").alias("content")).distinct().groupBy("lang").count()
    sizes = {r["lang"]: r["count"] for r in different.orderBy(F.desc("count"), "lang").limit(config.languages).collect()}
    if not sizes:
        return None
    rows = rows.where(F.col("lang").isin(*sizes))
    languages = tuple(sorted(sizes))
    counted = rows.select("text").mapInArrow(lambda it: _document_frequency(it, config), "feature int, docs long")
    df = {r["feature"]: r["docs"] for r in counted.groupBy("feature").agg(F.sum("docs").alias("docs")).collect()}
    total = df.pop(-1)
    idf = np.full(config.features, np.log(1.0 + total))
    for feature, docs in df.items():
        idf[feature] = np.log((1.0 + total) / (1.0 + docs)) + 1e-3

    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    limits = F.create_map(*[F.lit(x) for lang in languages for x in (lang, int(min(1.0, config.per_language / sizes[lang]) * (1 << 30)))])
    sample = rows.where(draw < limits[F.col("lang")]).distinct()
    part = F.pmod(F.xxhash64(F.lit(1), "text"), F.lit(config.shards)).cast("int")
    tune = F.pmod(F.xxhash64(F.lit(2), "text"), F.lit(config.calibrate_every)) == 0
    shared = spark.sparkContext.broadcast((config, idf, languages))
    sample = sample.select("text", "lang", part.alias("shard"), tune.alias("tune"), F.xxhash64(F.lit(3), "text").alias("place"))
    sample = stored(sample.mapInArrow(lambda it: _featurise(it, shared), "seen binary, values binary, label int, shard int, tune boolean, place long"), "language-sample")

    z, n = np.zeros((2, config.features + 1, len(languages)))
    learning = sample.where(~F.col("tune")) if not sample.where(~F.col("tune")).isEmpty() else sample
    for _ in range(config.rounds):
        state = spark.sparkContext.broadcast((config, z, n))
        # about per_language * languages / shards rows each
        learnt = learning.groupBy("shard").applyInPandas(_learner(state), "shard int, rows long, z binary, n binary").collect()
        learnt.sort(key=lambda r: r["shard"])
        weight = sum(r["rows"] for r in learnt)
        z = sum(r["rows"] / weight * np.frombuffer(r["z"], "<f8") for r in learnt).reshape(z.shape)
        n = sum(r["rows"] / weight * np.frombuffer(r["n"], "<f8") for r in learnt).reshape(n.shape)
    w = ftrl_weights(z, n, config)
    model = LanguageModel(languages, idf, w[:-1], w[-1], 1.0)

    held = sample.where("tune")
    held = (held if not held.isEmpty() else sample).select("seen", "values", "label").mapInPandas(lambda it: _logits(it, model), "label int, logits array<double>")
    found = sorted((r["label"], r["logits"]) for r in held.collect())
    logits, labels = np.array([x for _, x in found]), np.array([label for label, _ in found])
    return LanguageModel(languages, idf, w[:-1], w[-1], best_temperature(logits, labels))


def _logits(frames: Iterable[pd.DataFrame], model: LanguageModel) -> Iterator[pd.DataFrame]:
    for rows in frames:
        yield pd.DataFrame({"label": rows["label"], "logits": [list(values @ model.weights[seen] + model.bias) for seen, values, _ in _examples(rows)]})


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, one pseudo-count of doubt added, so that
    an errorless sample does not drive it to 0."""

    def loss(t: float) -> float:
        p = softmax(logits / t)
        true = np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-300)).sum()
        return -true - np.log(np.maximum(p, 1e-300)).mean(axis=1).mean()

    grid = np.exp(np.linspace(np.log(0.02), np.log(20.0), 200))
    return float(min(grid, key=loss))


def predict(text: str | None, model: LanguageModel | None, config: LanguageConfig) -> tuple[str, float]:
    if model is None or not has_letter(text):
        return "und", 0.0
    seen, counts = gram_counts(text, config)
    p = softmax((tf_idf(seen, counts, model.idf) @ model.weights[seen] + model.bias) / model.temperature)
    best = int(p.argmax())
    return model.languages[best], float(p[best])


def _predict(batches: Iterable[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model, config = shared.value
    for batch in batches:
        found = [predict(text.as_py(), model, config) for text in batch.column(0)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
            names=["kept", "lang_pred", "score"],
        )


def identify(documents: DataFrame, model: LanguageModel | None, keep: list[str], config: LanguageConfig | None = None) -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score``, from the whole text alone.

    A text that is null or has no letter is ``und`` with score 0, as is every text if there
    is no model. Rows are judged each on its own; columns not kept are ignored.
    """
    config = config or LanguageConfig()
    shared = documents.sparkSession.sparkContext.broadcast((model, config))
    source = documents.select(F.col("text").cast("string").alias("text"), F.struct(*keep).alias("kept"))
    schema = StructType([source.schema["kept"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return source.mapInArrow(lambda it: _predict(it, shared), schema).select("kept.*", "lang_pred", "score")


def held_out(doc_id) -> F.Column:
    """A third of the ids, by crc32 of the id's text; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))
