"""Quality rules from a document's own words and from lines shared across documents.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankframe.llm.common import let, stored, words_of

SPACES = " \t\n\x0b\x0c\r"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class LineRules:
    """``max_share_pct``: a line in more than this share of a host's different documents is
    removed, so that hosts of every size are treated alike; None stands for any share.
    ``max_documents``: the floor, so many of them may always hold a line.
    ``max_removed_pct``: a document that loses more of its words is depleted.
    ``broadcast_rows``: removed lines up to this number are broadcast, more are joined by
    shuffle."""

    host: str = "source"
    max_documents: int = 5
    max_removed_pct: int = 50
    min_words: int = 50
    max_repeat_pct: int = 50
    broadcast_rows: int = 500_000
    max_share_pct: int | None = 5


def _covered(hashes: Column, position_bits: int) -> Column:
    """How many words lie in windows whose hash occurs twice.  Hash and position share a
    long, so one primitive sort brings equal windows together, unless two windows agree in
    the bits that are left of their hashes alone: then whole hashes are ordered."""
    low = (1 << position_bits) - 1
    place = lambda x: x.bitwiseAND(F.lit(low)).cast("int")
    alike = lambda x, y: F.shiftright(x, position_bits) == F.shiftright(y, position_bits)
    whole = lambda x, y: F.get(hashes, place(x)) == F.get(hashes, place(y))

    def count(s: Column) -> Column:
        next_one = F.transform(s, lambda x, k: F.coalesce(alike(x, F.get(s, k + 1)) & ~whole(x, F.get(s, k + 1)), F.lit(False)))
        beside = lambda x, k: F.coalesce(alike(x, F.get(s, k)) & whole(x, F.get(s, k)), F.lit(False))
        starts = F.sort_array(F.transform(F.filter(s, lambda x, k: beside(x, k - 1) | beside(x, k + 1)), place))
        return F.when(F.array_contains(next_one, True), _covered_long(hashes)).otherwise(let(starts, _words_from))

    packed = F.sort_array(F.transform(hashes, lambda x, i: x.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))
    return let(packed, count)


def _covered_long(hashes: Column) -> Column:
    """The same for a text of any length: windows are ordered by their full hashes."""

    def equal(s: Column, x: Column, k: Column) -> Column:
        return F.coalesce(x["hash"] == F.get(s, k)["hash"], F.lit(False))

    ordered = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("hash"), i.alias("place"))))
    repeated = let(ordered, lambda s: F.sort_array(F.transform(F.filter(s, lambda x, k: equal(s, x, k - 1) | equal(s, x, k + 1)), lambda x: x["place"])))
    return _words_from(repeated)


def _words_from(starts: Column) -> Column:
    """How many words lie in three-word windows that start at these sorted places."""
    gaps = lambda p: F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
    return let(starts, lambda p: F.aggregate(gaps(p), F.lit(0).cast("long"), lambda a, x: a + x))


def repeated_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more."""
    return repeats_by(words, 20)


def repeats_by(words: Column, position_bits: int) -> Column:
    """The same; windows are known by 64 bits, and positions take ``position_bits`` of a long
    where the text is short enough for that."""
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    hashes = F.transform(starts, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))

    def count(h: Column) -> Column:
        none = F.size(F.array_distinct(h)) == F.size(h)
        return F.when(none, F.lit(0).cast("long")).when(F.size(h) < (1 << position_bits), _covered(h, position_bits)).otherwise(_covered_long(h))

    return let(hashes, count)


def _line(x: Column, host: Column) -> Column:
    """A line's key hashes the host and the line in lower case with single spaces."""
    return let(words_of(F.lower(x)), lambda w: F.struct(F.xxhash64(host, F.array_join(w, " ")).alias("key"), F.size(w).alias("words")))


def line_facts(documents: DataFrame, rules: LineRules) -> DataFrame:
    """One row per document: its text, its own figures, and key and words of each of its
    lines that has a word."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    host = F.coalesce(F.col(rules.host).cast("string"), F.lit(""))
    split = documents.select(F.col("doc_id").cast("long").alias("doc_id"), host.alias("host"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(HAS_WORD))

    duplicated = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    own = let(words_of(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    facts = split.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "host",
        "text",
        F.xxhash64("text").alias("content"),
        own.alias("own"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        duplicated.alias("n_dup_lines"),
        F.transform(lines, lambda x: _line(x, F.col("host"))).alias("lines"),
    )
    return facts.select("row", "doc_id", "host", "text", "content", "own.n_words", "word_chars", "n_symbols", "n_dup_lines", "own.n_repeat_words", "lines")


def frequent_lines(facts: DataFrame, rules: LineRules) -> DataFrame:
    """Keys of lines in more different documents of their host than the rules allow.
    Exact copies of a document count once."""
    host = F.xxhash64("host").alias("host")
    held = facts.select(host, "content", F.explode(F.array_distinct("lines.key")).alias("key")).distinct()
    counted = held.groupBy("key").agg(F.count(F.lit(1)).alias("count"), F.min("host").alias("host")).where(F.col("count") > rules.max_documents)
    if rules.max_share_pct is not None:
        documents = facts.select(host, "content").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
        counted = counted.join(documents, "host").where(100 * F.col("count") > rules.max_share_pct * F.col("documents"))
    return counted.select("key")


def _without(text: Column, host: Column, keys: Column) -> Column:
    """``text`` without the lines of these keys; its other lines are as they were."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~x.rlike(HAS_WORD) | ~F.array_contains(keys, _line(x, host)["key"])), "\n")


def clean_documents(documents: DataFrame, rules: LineRules | None = None) -> DataFrame:
    """Clean and judge ``documents(doc_id, text, <host>)``; one row per input row.

    ``text``: without the lines that too many documents of the host share.
    ``base_failed``: fewer than ``min_words`` words, or too many of them in repeated
    three-word windows.  ``kept``: not ``base_failed``, and enough of the words are left.

    A null or empty text has no words, fails and is returned empty. A null host is a host of its own. Repeated
    rows are judged each on its own and count once as holders of their lines. Without rows
    the result is empty. Other columns are ignored.
    """
    rules = rules or LineRules()
    facts = stored(line_facts(documents, rules), "line-facts")
    frequent = stored(frequent_lines(facts, rules), "frequent-lines")
    if frequent.count() <= rules.broadcast_rows:  # 8 bytes each
        frequent = F.broadcast(frequent)
    held = facts.where("n_words > 0").select("row", F.explode(F.array_distinct("lines.key")).alias("key"))
    removed = stored(held.join(frequent, "key").groupBy("row").agg(F.collect_list("key").alias("keys")), "removed-lines")
    if (removed.agg(F.sum(F.size("keys"))).first()[0] or 0) <= rules.broadcast_rows:
        removed = F.broadcast(removed)
    lost = F.when(F.col("keys").isNull(), F.lit(0).cast("long")).otherwise(F.col("n_words") - F.size(words_of(F.col("cleaned"))))
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words"))
    cleaned = F.when(F.col("keys").isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col("host"), F.col("keys")))
    return (
        facts.drop("lines", "content").join(removed, "row", "left")
        .withColumn("cleaned", cleaned).withColumn("removed_words", lost)
        .select(
            "doc_id", F.col("cleaned").alias("text"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            failed.alias("base_failed"),
            (~failed & (100 * F.col("removed_words") <= rules.max_removed_pct * F.col("n_words"))).alias("kept"),
            "removed_words",
        )
    )


def judge_documents(documents: DataFrame, rules: LineRules | None = None) -> DataFrame:
    """The figures of ``clean_documents`` without the texts they were counted on."""
    return clean_documents(documents, rules).drop("text")


#: The same in DuckDB, for the default rules.
LINE_RULES_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS times
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM docs)
), repeats AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM windows WHERE times > 1) GROUP BY doc_id
), split_lines AS (
  SELECT doc_id, host, text, line,
         list_filter(string_split_regex(lower(line), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM docs)
), lines AS (
  SELECT doc_id, host, text, line, array_to_string(words, ' ') AS normal, len(words) AS n FROM split_lines WHERE len(words) > 0
), frequent AS (
  SELECT host, normal
  FROM (SELECT host, normal, count(DISTINCT text) AS n FROM lines GROUP BY host, normal)
  JOIN (SELECT host, count(DISTINCT text) AS documents FROM docs GROUP BY host) USING (host)
  WHERE n > 5 AND 100 * n > 5 * documents
), by_document AS (
  SELECT l.doc_id, count(*) - count(DISTINCT l.line) AS n_dup_lines,
         sum(CASE WHEN f.normal IS NULL THEN 0 ELSE l.n END) AS removed_words
  FROM lines l LEFT JOIN frequent f ON l.host = f.host AND l.normal = f.normal GROUP BY l.doc_id
), facts AS (
  SELECT d.doc_id, len(d.words)::BIGINT AS n_words,
         length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(b.n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(r.n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(b.removed_words, 0)::BIGINT AS removed_words
  FROM docs d LEFT JOIN repeats r USING (doc_id) LEFT JOIN by_document b USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * removed_words <= 50 * n_words AS kept,
       removed_words
FROM facts
"""
