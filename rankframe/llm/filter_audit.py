"""Filter interaction audit: what five filters remove in every order, from one potential.

Let v(S) be how many documents fail some filter of the coalition S, so how many S removes.
The removal game restricted to S has the Hart-Mas-Colell potential P(S) with P({}) = 0 and
|S| P(S) = v(S) + sum of P(S without i) over i in S.  A filter's Shapley value is the grand
potential less the potential without it, and the steps of any order are differences between
the coalitions before and after the step.  So 32 counts per game and part say all.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankframe.llm.common import let, stored, words_of

FILTERS = "ABCDE"
GRAND = (1 << len(FILTERS)) - 1
GAMES = ("all", "good", "toxic")
SHORT_WORDS, DISTINCT_PCT, CAPITAL_PCT, SIGNS = 200, 50, 3, "#$%&*|"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def own_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails; they need nothing but the text."""
    words = let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), F.size(F.array_distinct(w)).cast("long").alias("distinct")))
    lost = lambda signs: F.length(text) - F.length(F.translate(text, signs, ""))
    bit = lambda k, failing: F.when(failing, F.lit(1 << k)).otherwise(F.lit(0))

    def bits(w: Column) -> Column:
        return (
            bit(0, w["n"] < SHORT_WORDS)
            + bit(1, 100 * w["distinct"] < DISTINCT_PCT * w["n"])
            + bit(2, 100 * lost(CAPITALS).cast("long") > CAPITAL_PCT * F.length(text))
            + bit(3, lost(SIGNS) > 0)
        )

    return let(words, bits)


def failures(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, good, toxic)`` per row of ``documents``: the bits of the filters it
    fails, and what its labels say.

    Texts are equal if their SHA-256 is. Only texts of several ids are joined back, as one
    row each; the rows of a text stay where the shuffle can split them.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        own_failures(text).alias("own"), F.unhex(F.sha2(text, 256)).alias("content"),
    )
    rows = stored(rows, "own-failures")
    first = rows.groupBy("content").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copied = stored(first.where("first < last").select("content", "first"), "copied-texts")
    said = lambda name: F.max((F.col(name) == 1).cast("int"))
    labelled = labels.where("quality = 1 or toxic = 1").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    labelled = stored(labelled.agg(said("quality").alias("good"), said("toxic").alias("toxic")).where("doc_id is not null"), "labelled")
    copy = F.when(F.col("doc_id") > F.col("first"), F.lit(1 << 4)).otherwise(F.lit(0))
    told = rows.join(copied, "content", "left").join(labelled, "doc_id", "left")
    no = F.lit(0)
    return told.select("part", (F.col("own") + copy).alias("mask"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))


def coalition_values(failed: DataFrame) -> DataFrame:
    """Per part: ``n`` documents, and for every game ``v_<game>``, an array with the removed
    documents of each coalition, by its bits."""
    counts = failed.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("all"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    worth = lambda game, s: F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, F.col(game))), F.lit(0).cast("long"))
    games = [F.array(*[worth(game, s) for s in range(GRAND + 1)]).alias(f"v_{game}") for game in GAMES]
    return counts.groupBy("part").agg(F.sum("all").alias("n"), *games)


def with_potentials(values: DataFrame) -> DataFrame:
    """Add ``potential``: |S|! P(S) of the game ``all`` for every coalition, by its bits.

    |S|! P(S) = (|S| - 1)! v(S) + the sum of (|S| - 1)! P(S without i), all integers. One
    step per coalition size, each from the arrays of the one before.
    """
    sizes = [s.bit_count() for s in range(GRAND + 1)]
    known = values.withColumn("potential", F.array_repeat(F.lit(0).cast("long"), GRAND + 1))
    for size in range(1, len(FILTERS) + 1):

        def scaled(s: int) -> Column:
            if sizes[s] != size:
                return F.col("potential")[s]
            without = [F.col("potential")[s & ~(1 << i)] for i in range(len(FILTERS)) if s >> i & 1]
            return F.lit(math.factorial(size - 1)).cast("long") * F.col("v_all")[s] + sum(without[1:], without[0])

        known = stored(known.withColumn("potential", F.array(*[scaled(s) for s in range(GRAND + 1)])), "potentials")
    return known


def _steps() -> Column:
    """Every step of every order: the order, the step, and the bits of its filter and of the
    coalition before it."""
    steps = []
    for order in itertools.permutations(range(len(FILTERS))):
        before = 0
        for k, i in enumerate(order):
            steps.append(F.struct(F.lit("".join(FILTERS[j] for j in order)).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(1 << i).alias("bit"), F.lit(before).alias("before")))
            before |= 1 << i
    return F.array(*steps)


def audit_filters(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """What each step of each of the 120 orders of the filters keeps, removes and loses, per
    part of ``documents(doc_id, text, lang)``, with ``labels(doc_id, quality, toxic)``.

    One row per part (the values of lang; null is ''), order and step. ``shapley`` sums
    what the step's filter removes over all orders: 120 times its Shapley value. Steps in
    which nothing happens are rows too.

    A null text is empty; an empty text fails A only, and E beside a smaller id with an empty
    text. Rows that repeat an id count each and are no copies of each other; a null id
    neither is a copy nor makes one, and has no label. Where a document's labels disagree,
    one that says 1 counts. Without documents the result is empty. Other columns are ignored.
    """
    games = with_potentials(coalition_values(failures(documents, labels)))
    steps = games.select("*", F.explode(_steps()).alias("s")).select("*", "s.*").drop("s")
    after = F.col("before").bitwiseOR(F.col("bit"))
    value = lambda game, coalition: F.get(F.col(f"v_{game}"), coalition)
    gained = lambda game: value(game, after) - value(game, F.col("before"))
    rest = F.lit(GRAND) - F.col("bit")
    shapley = F.get("potential", F.lit(GRAND)) - len(FILTERS) * F.get("potential", rest)
    return steps.select(
        "part", "filter_order", "step",
        (F.col("n") - value("all", after)).alias("kept"),
        gained("all").alias("removed"),
        (value("all", F.col("bit")) - gained("all")).alias("redundant"),
        (value("all", F.lit(GRAND)) - value("all", rest)).alias("unique_fails"),
        gained("good").alias("good_lost"),
        gained("toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )


#: The same in DuckDB, order by order and step by step.
AUDIT_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), firsts AS (
  SELECT text, min(doc_id) AS first FROM docs GROUP BY text
), marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), failed AS (
  SELECT d.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         CASE WHEN len(d.words) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(d.words)) < 50 * len(d.words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 3 * length(d.text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(d.text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN d.doc_id > f.first THEN 'E' ELSE '' END AS fails
  FROM docs d JOIN firsts f USING (text) LEFT JOIN marks m USING (doc_id)
), counts AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS earlier
  FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders)
), judged AS (
  SELECT c.part, s.filter_order, s.step, s.f, c.n, c.good, c.toxic,
         contains(c.fails, s.f) AS failing, c.fails = s.f AS only_this,
         length(translate(c.fails, s.earlier, '')) < length(c.fails) AS gone
  FROM counts c, steps s
), results AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND failing THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN only_this THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND failing THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND failing THEN toxic ELSE 0 END) AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley
FROM results
"""
