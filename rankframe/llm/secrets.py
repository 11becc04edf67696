"""Secret scanning behind a trigram inverted index."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankframe.llm.common import stored

Query = frozenset[frozenset[str]] | None  # any of: all of these trigrams; None: no demand


@dataclass(frozen=True)
class Rule:
    """``accept`` says which matches of ``pattern`` count; the others are dropped."""

    kind: str
    pattern: str
    accept: Callable[[re.Match], bool] = bool


def _long_value(match: re.Match) -> bool:
    return len(match[2]) >= 12


def _long_key(match: re.Match) -> bool:
    return len(match[0]) >= 18


def _long_hex(match: re.Match) -> bool:
    return len(match[0]) >= 16


BASE_RULES = (
    Rule("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _long_value),
    Rule("access", r"AKIA[A-Z0-9]+", _long_key),
    Rule("hex", r"[0-9a-f]+", _long_hex),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("bearer", r"(?ai:bearer)\x20+[A-Za-z0-9._~+/-]{20,}=*"),
    Rule("url_login", r"://[A-Za-z0-9._~-]+:[^\s:@/]{4,}@"),
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*"),
)

_MOST = 64  # alternatives that are spelled out; beyond, a part demands nothing


def _demand(strings: frozenset[str]) -> Query:
    """One of the strings must occur, so all trigrams of one of them."""
    clauses = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    return _least(clauses) if all(clauses) else None


def _least(clauses) -> Query:
    """Without the clauses that demand more than another one."""
    return frozenset(c for c in clauses if not any(d < c for d in clauses))


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    joined = _least({x | y for x in a for y in b})
    return joined if len(joined) <= _MOST else min(a, b, key=len)


def _either(queries: list[Query]) -> Query:
    return None if any(q is None for q in queries) else frozenset().union(*queries)


def _analyse(items) -> tuple[frozenset[str] | None, Query]:
    """Of a parsed pattern: all strings it can match, if few, and what any match demands."""
    run, demand, exact = frozenset({""}), None, True
    for op, value in items:
        strings, own = _analyse_one(str(op), value)
        joined = frozenset(a + b for a in run for b in strings) if strings is not None else frozenset()
        if strings is None or len(joined) > _MOST:
            demand, run, exact = _both(_both(demand, _demand(run)), own), frozenset({""}), False
        else:
            run = joined
    return (run, None) if exact else (None, _both(demand, _demand(run)))


def _analyse_one(op: str, value) -> tuple[frozenset[str] | None, Query]:
    if op == "LITERAL":
        return frozenset({chr(value).lower()}), None
    if op == "IN":
        if all(str(kind) == "LITERAL" for kind, _ in value) and len(value) <= 4:
            return frozenset(chr(c).lower() for _, c in value), None
        return None, None
    if op == "AT":
        return frozenset({""}), None
    if op == "SUBPATTERN":
        return _analyse(value[-1])
    if op == "BRANCH":
        parts = [_analyse(p) for p in value[1]]
        if all(s is not None for s, _ in parts):
            return frozenset().union(*(s for s, _ in parts)), None
        return None, _either([q if s is None else _demand(s) for s, q in parts])
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        least, most, items = value
        strings, own = _analyse(items)
        if strings is not None and (int(least), int(most)) in ((0, 1), (1, 1)):
            return strings | ({""} if least == 0 else set()), None
        return None, (_demand(strings) if strings is not None else own) if least else None
    return None, None


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query, over lower-case text, that every match of ``pattern``
    satisfies; None if the pattern has no mandatory trigrams."""
    strings, query = _analyse(re._parser.parse(pattern))
    return _demand(strings) if strings is not None else query


def _key():
    """Documents without an id share one entry; a posting then means one of them."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))


def trigram_postings(documents: DataFrame, trigrams: list[str], block_documents: int = 1024) -> DataFrame:
    """``(block, trigram, docs)``: the documents of a block whose text, in lower case,
    holds the trigram.  Blocks hash the id and a posting names an id once, so no posting list
    outgrows a block, however many rows have one id or none."""
    blocks = max(1, -(-documents.count() // block_documents))
    text = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    found = F.array_compact(F.array(*[F.when(F.contains(F.col("_text"), F.lit(g)), F.lit(g)) for g in trigrams]))
    held = documents.select(_key().alias("doc"), text.alias("_text")).select("doc", F.explode(found).alias("trigram"))
    return (
        held.groupBy(F.pmod(F.xxhash64("doc"), F.lit(blocks)).alias("block"), "trigram")
        .agg(F.collect_set("doc").alias("docs"))
    )


def candidates(postings: DataFrame, queries: dict[int, Query]) -> DataFrame:
    """``(doc, rules)``: the bits of the rules whose query the document satisfies."""
    trigrams = sorted({g for q in queries.values() for clause in q for g in clause})
    lists = postings.groupBy("block").agg(*[F.flatten(F.collect_list(F.when(F.col("trigram") == g, F.col("docs")))).alias(f"p{i}") for i, g in enumerate(trigrams)])
    column = {g: F.col(f"p{i}") for i, g in enumerate(trigrams)}

    def satisfied(query: Query):
        clauses = [functools.reduce(F.array_intersect, [column[g] for g in sorted(clause)]) for clause in sorted(query, key=sorted)]
        return functools.reduce(F.array_union, clauses)

    def hits_of(bit: int, query: Query):
        return F.transform(satisfied(query), lambda d: F.struct(d.alias("doc"), F.lit(1 << bit).alias("rule")))

    hits = [hits_of(bit, q) for bit, q in queries.items()]
    return lists.select(F.explode(F.concat(*hits)).alias("hit")).select("hit.doc", "hit.rule").groupBy("doc").agg(F.bit_or("rule").alias("rules"))


def find_spans(text: str, rules: Iterable[Rule]) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` in code points, by start, then in the order of the rules."""
    return sorted(((m.start(), m.end(), r.kind) for r in rules for m in re.finditer(r.pattern, text) if r.accept(m)), key=lambda s: s[0])


def redact(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    """Put one mark for each stretch that spans cover."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


RESULT = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, redacted string"


def _scan(batches: Iterable[pa.RecordBatch], rules: tuple[Rule, ...], always: int, mark: str | None) -> Iterator[pa.RecordBatch]:
    base = [r.kind for r in BASE_RULES]
    for batch in batches:
        rows = []
        for text, hits in zip(batch.column(0), batch.column(1).to_pylist()):
            text = text.as_py() or ""
            wanted = always | (hits or 0)
            spans = find_spans(text, [r for bit, r in enumerate(rules) if wanted >> bit & 1])
            own = [s for s in spans if s[2] in base]
            n = [sum(s[2] == kind for s in own) for kind in base]
            rows.append((*n, hashlib.sha256(_joined(own).encode()).hexdigest(), _joined(spans), redact(text, spans, mark) if mark is not None and spans else None))
        found = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 3 + [pa.string()] * 3)] if rows else []
        if rows:
            yield pa.RecordBatch.from_arrays([batch.column(2), *found], names=["kept", *(c.split()[0] for c in RESULT.split(", "))])


def scan_secrets(documents: DataFrame, keep: list[str] | None = None, mark: str | None = None, broadcast_rows: int = 2_000_000) -> DataFrame:
    """Spans of secrets in every whole text of ``documents(doc_id, text)``, one row each.

    Each rule's regex gives a Boolean trigram query. An inverted index of the trigrams
    that the queries name is intersected block by block, and only candidates are verified
    with the regex; a rule without mandatory trigrams scans every text. Candidate ids up
    to ``broadcast_rows`` (16 bytes each) are broadcast, more are joined by shuffle.

    Result: the columns ``keep`` (default ``doc_id``), the counts and digest of the base
    kinds, all ``spans`` as ``kind:start:end``, and, if ``mark`` is given, ``redacted``:
    the text with spans replaced, null where there are none.

    A null text is empty. Rows with equal or null ids are each scanned. Without rows the
    result is empty. Columns not kept are ignored.
    """
    rules = BASE_RULES + MORE_RULES
    queries = {bit: q for bit, r in enumerate(rules) if (q := trigram_query(r.pattern)) is not None}
    always = sum(1 << bit for bit in range(len(rules)) if bit not in queries)
    trigrams = sorted({g for q in queries.values() for clause in q for g in clause})
    index = stored(trigram_postings(documents, trigrams), "postings")
    hits = stored(candidates(index, queries), "candidates").toDF("_doc", "_rules")
    if hits.count() <= broadcast_rows:
        hits = F.broadcast(hits)
    keep = keep or ["doc_id"]
    source = documents.select(F.col("text").cast("string").alias("text"), F.struct(*keep).alias("kept"), _key().alias("_doc"))
    schema = StructType([source.schema["kept"], *StructType.fromDDL(RESULT)])
    found = source.join(hits, "_doc", "left").select("text", "_rules", "kept")
    return found.mapInArrow(lambda it: _scan(it, rules, always, mark), schema).select("kept.*", *schema.names[1:])
