from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import pandas as pd
from pyspark.sql import functions as F
from rankframe.llm.common import let
from rankframe.llm.line_rules import LINE_RULES_SQL, LineRules, clean_documents, judge_documents, repeated_words, repeats_by

WORD = r"[^\x20\x09-\x0D]+"


def brute(rows, rules):
    holders = defaultdict(set)
    key = lambda host, line: (host or "", " ".join(re.findall(WORD, line.lower())))
    for _, text, host in rows:
        for line in (text or "").split("\n"):
            if re.search(WORD, line):
                holders[key(host, line)].add(text)
    documents = defaultdict(set)
    for _, text, host in rows:
        documents[host or ""].add(text or "")
    out = []
    for doc, text, host in rows:
        text = text or ""
        share = -1 if rules.max_share_pct is None else rules.max_share_pct * len(documents[host or ""])
        frequent = lambda x: len(holders[key(host, x)]) > rules.max_documents and 100 * len(holders[key(host, x)]) > share
        words = re.findall(WORD, text)
        windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if re.search(WORD, x)]
        removed = sum(len(re.findall(WORD, x)) for x in lines if frequent(x))
        failed = len(words) < rules.min_words or 100 * len(covered) > rules.max_repeat_pct * len(words)
        figures = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        out.append((doc, *figures, failed, not failed and 100 * removed <= rules.max_removed_pct * len(words), removed))
    return sorted(out, key=str)


def texts(seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choices(["Aa", "aa", "b#", "ç%", "d", "ee|", "漢"], k=rng.randrange(0, 8))) for _ in range(25)]
    return [(i, "\n".join(rng.choices(pool, k=rng.randrange(0, 9))) + rng.choice(["", "\n", " \t", "\x0b", "\x1c", "\u00a0"]), rng.choice(["h", "g", None])) for i in range(150)]


def test_figures_match_brute_force(spark):
    for rules in (LineRules(max_documents=3, min_words=5, max_repeat_pct=60), LineRules(max_documents=10, min_words=2, broadcast_rows=0)):
        rows = texts(rules.max_documents)
        rows += [(1000 + i, "copied line of a copied text", "h") for i in range(30)]  # one document, many copies
        found = judge_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"), rules).collect()
        assert sorted((tuple(r) for r in found), key=str) == brute(rows, rules)
        assert {r.kept for r in found} == {True, False}


def test_awkward_documents(awkward, nothing):
    rows = [(r.doc_id, r.text, r.source) for r in awkward.collect()]
    assert sorted((tuple(r) for r in judge_documents(awkward).collect()), key=str) == brute(rows, LineRules())
    assert judge_documents(nothing).count() == 0


def test_frequent_lines_leave_the_text(spark):
    for rules in (LineRules(max_documents=100, max_share_pct=None), LineRules(max_documents=100, max_share_pct=None, broadcast_rows=0)):
        rows = [(i, f"first {i}\n\nShared  LINE of\tthe host\n last {i} \nshared line of the host\n", "h") for i in range(101)]
        rows += [(1000 + i, f"first {i}\nshared line of the host", "g") for i in range(100)] + [(2000, None, "h"), (2001, "shared line of the host", "h")]
        found = {r.doc_id: r for r in clean_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"), rules).collect()}
        for i in range(101):
            assert (found[i].text, found[i].removed_words) == (f"first {i}\n\n last {i} \n", 10)
        assert all(found[d].text == text and found[d].removed_words == 0 for d, text, host in rows if host == "g")
        assert (found[2000].text, found[2001].text, found[2001].removed_words) == ("", "", 5)


def test_removed_lines_match_the_sql(spark):
    """A table on which the production limit removes lines, which the smallest tables lack."""
    rng = random.Random(4)
    line = lambda n: " ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    often, seldom = line(40), line(20)
    rows = [(i, f"{line(60)}\n{often}\n{often if i % 3 else seldom}", ("h", "g", None)[i % 3]) for i in range(310)]
    rows += [(1000 + i, f"{line(80)}\n{seldom}" if i < 6 else line(80), "few") for i in range(100 + 30)]  # 6 of 130: under 5 %
    rows += [(2000 + i, f"{line(80)}\n{seldom}" if i < 5 else line(80), "floor") for i in range(30)]  # 5: the floor
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "source"])
    duck = duckdb.connect()
    duck.register("documents", documents)
    expected = sorted(duck.execute(LINE_RULES_SQL).fetchall())
    found = judge_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted(map(tuple, found)) == expected
    assert {r.kept for r in found} == {True, False}
    assert {r.removed_words for r in found if r.doc_id < 1000} == {60, 80} and not any(r.removed_words for r in found if r.doc_id >= 1000)


def test_lines_are_removed_from_the_documents(spark):
    """The production limits remove lines on the given tables, and depleted documents go."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = clean_documents(docs).collect()
    assert sum(r.removed_words > 0 for r in found) > 50
    assert sum(r.kept for r in found) == sum(not r.base_failed and 2 * r.removed_words <= r.n_words for r in found)


def test_repeats_are_exact_whatever_the_bits(spark):
    """Few bits are left of the hashes, so different windows are often taken for neighbours."""
    rng = random.Random(12)
    rows = []
    for n in (3, 40, 700, 5000):
        words = [f"w{rng.randrange(n)}" for _ in range(n)]
        windows = [tuple(words[i : i + 3]) for i in range(n - 2)]
        times = Counter(windows)
        rows.append((" ".join(words), len({j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)})))
    frame = spark.createDataFrame(rows, "text string, expected long")
    for bits in (2, 13, 20, 55, 60):
        found = frame.select("expected", let(F.split("text", " "), lambda w: repeats_by(w, bits)).alias("n")).collect()
        assert [r.n for r in found] == [r.expected for r in found]


def test_limit_as_share_of_the_host(spark):
    sizes = {"small": 20, "large": 400}
    rows = [(i, f"own {host} {i}" + "\nin a tenth" * (10 * i < n) + "\nin a half" * (2 * i < n), host) for host, n in sizes.items() for i in range(n)]
    rows += [(i, "own small 0\nin a tenth\nin a half", "small") for i in range(500)]  # copies count once
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for floor, removed in ((0, {"small", "large"}), (10, {"large"})):
        found = clean_documents(df, LineRules(max_documents=floor, max_share_pct=10)).collect()
        assert {r.text.split()[1] for r in found if r.removed_words} == removed
        assert all(r.removed_words in (0, 3) and ("in a half" in r.text) <= (r.text.split()[1] not in removed) for r in found)
        assert any("in a tenth" in r.text for r in found if r.removed_words)


def test_long_text_with_near_equal_hashes(spark):
    """Between two equal windows lies another whose hash has the same first 33 bits."""
    hashed = spark.range(1 << 19).select(F.concat(F.lit("a"), "id").alias("w")).select("w", F.shiftright(F.xxhash64("w", F.lit("b"), F.lit("c")), 31).alias("high"))
    pair = hashed.groupBy("high").agg(F.sort_array(F.collect_list("w")).alias("w")).where("size(w) > 1").orderBy("high").first().w
    filler = [f"x{i}" for i in range(1 << 20)]
    words = [pair[0], "b", "c", "y1", "y2", pair[1], "b", "c", "y3", "y4", pair[0], "b", "c", *filler]
    found = spark.createDataFrame([(" ".join(words),)], "text string").select(let(F.split("text", " "), repeated_words).alias("n"))
    assert found.first().n == 6
