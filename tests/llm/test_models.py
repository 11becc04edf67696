from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from rankframe.llm import language, url_filter

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return docs.withColumn("held_out", language.held_out(F.col("doc_id")))


@pytest.fixture(scope="module")
def model(documents):
    return language.fit_language_model(documents.where("not held_out"))


def test_held_out_languages_are_found(documents, model):
    judged = language.identify(documents, model, ["doc_id", "lang", "held_out"]).where("held_out").collect()
    assert len(judged) > 300
    assert np.mean([r.lang == r.lang_pred for r in judged]) >= 0.97
    # calibrated: confidence and accuracy agree
    assert abs(np.mean([r.score for r in judged]) - np.mean([r.lang == r.lang_pred for r in judged])) < 0.05


def test_awkward_languages(awkward, nothing, model):
    judged = language.identify(awkward, model, awkward.columns)
    for r in judged.collect():
        letters = bool(r.text) and any(c.isalpha() for c in r.text)
        assert (r.lang_pred != "und") == letters and 0 <= r.score <= 1
    assert judged.columns == [*awkward.columns, "lang_pred", "score"]
    assert language.identify(nothing, model, ["doc_id"]).count() == 0
    assert language.fit_language_model(nothing) is None
    assert {r.lang_pred for r in language.identify(awkward, None, ["doc_id"]).collect()} == {"und"}
    assert language.fit_language_model(awkward.where("lang = 'en'")).languages == ("en",)


def test_fit_takes_copies_once_and_any_partitioning(spark, documents):
    """A text repeated 3000 times is one example, and the model depends on the rows alone."""
    rows = [(r.text, r.lang) for r in documents.where("lang is not null and text is not null").limit(150).collect()]
    rows += [("the same words in every copy of this text", "en")] * 3000
    frame = spark.createDataFrame(rows, "text string, lang string")
    config = language.LanguageConfig(per_language=40, features=1 << 10, rounds=2)
    models = [language.fit_language_model(frame.repartition(n), config) for n in (3, 11)]
    for a, b in [(models[0], models[1])]:
        assert a.languages == b.languages and a.temperature == b.temperature
        assert (a.weights == b.weights).all() and (a.bias == b.bias).all() and (a.idf == b.idf).all()
    once = language.fit_language_model(frame.distinct(), config)
    assert once.languages == models[0].languages and (once.idf != models[0].idf).any()


def test_languages_are_bounded(spark):
    rows = [(f"text number {i} of many", f"l{i % 7}") for i in range(70)] + [("a few more words", "l3"), ("other words still", "l5")]
    model = language.fit_language_model(spark.createDataFrame(rows, "text string, lang string"), language.LanguageConfig(languages=2, features=1 << 8))
    assert model.languages == ("l3", "l5")


def test_ftrl_matches_its_definition():
    config = language.LanguageConfig(features=8)
    rng = np.random.default_rng(1)
    examples = [(np.sort(rng.choice(8, 3, replace=False)), rng.random(3), int(rng.integers(3))) for _ in range(20)]
    z, n = np.zeros((2, 9, 3))
    language.ftrl_pass(examples, z, n, config)
    zz, nn = np.zeros((9, 3)), np.zeros((9, 3))
    for seen, values, label in examples:
        x = np.zeros(9)
        x[seen], x[8] = values, 1.0
        w = np.zeros((9, 3))
        for i in range(9):
            for k in range(3):
                if abs(zz[i, k]) > config.l1:
                    w[i, k] = -(zz[i, k] - np.sign(zz[i, k]) * config.l1) / ((config.beta + nn[i, k] ** 0.5) / config.alpha + config.l2)
        p = np.exp(x @ w) / np.exp(x @ w).sum()
        for i in np.flatnonzero(x):
            for k in range(3):
                g = x[i] * (p[k] - (k == label))
                sigma = ((nn[i, k] + g * g) ** 0.5 - nn[i, k] ** 0.5) / config.alpha
                zz[i, k] += g - sigma * w[i, k]
                nn[i, k] += g * g
    assert np.allclose(z, zz) and np.allclose(n, nn)


def host_and_path(url):
    """Plain restatement of the contract."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, path = rest[:end], rest[end:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_for(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, default=(0, None, None))[1:]


def test_rules_of_urls(spark):
    rng = random.Random(4)
    urls = [None, "", "no scheme", "http://", "://org/", "http://ORG/x", "http://org", "http://xorg/a", "a://b://org/", "http://example.org/en/12?q=/es/#x", "HTTP://W.Example.ORG/es/", "http://É.org/\n/x"]
    urls += [f"http{rng.choice(['', 's'])}://{rng.choice(['', 'a.', 'b.c.'])}{rng.choice(['org', 'example.org', 'com', 'x.com', 'net'])}{rng.choice(['', '/'])}{rng.choice(['', 'es/', 'en/1', 'en/2', 'fr/', 'de/', 'de'])}{rng.choice(['', '?a=1&b=2', '#/'])}" for _ in range(300)]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    found = {r.page_id: r for r in url_filter.judge_urls(pages).collect()}
    assert len(found) == len(urls)
    for i, url in enumerate(urls):
        host, path = host_and_path(url)
        rule, verdict = rule_for(host, path)
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule)
        assert found[i].verdict == verdict if verdict else found[i].verdict in ("allow", "block")
    assert url_filter.judge_urls(pages.limit(0)).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages.where("url is null")).collect()} == {"allow"}


def test_trees_find_held_out_labels(spark):
    """Labelled by what the features show: many digits and parameters mean block."""
    rng = random.Random(6)
    rows = []
    for i in range(1200):
        bad = rng.random() < 0.4
        host = "".join(rng.choices("abcdef", k=8)) + (str(rng.randrange(10**6)) if bad else "") + rng.choice([".biz" if bad else ".net", ".net"])
        rows.append((i, f"http://{host}/p/{rng.randrange(9)}" + ("?a=1&b=2&c=3" if bad else ""), int(bad)))
    labelled = spark.createDataFrame(rows[:800], "page_id long, url string, blocked int")
    judged = url_filter.judge_urls(spark.createDataFrame(rows[800:], "page_id long, url string, blocked int"), (), labelled).collect()
    truth = {r[0]: r[2] for r in rows}
    assert np.mean([(r.verdict == "block") == truth[r.page_id] for r in judged]) > 0.97


def test_suffix_rates_leave_the_own_label_out(spark):
    """Rates and features of labelled URLs against a plain count."""
    rng, config = random.Random(15), url_filter.UrlModelConfig(smoothing=3.0)
    urls = [f"https://{rng.choice(['', 'a.', '9-x.'])}{rng.choice(['p', 'q'])}.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'de', 'fr', ''])}{rng.choice(['/1', '/2/x?k=1&l', ''])}" for _ in range(120)]
    rows = [(u, *host_and_path(u), float(rng.random() < 0.3)) for u in urls]
    overall = sum(r[3] for r in rows) / len(rows)
    frame = spark.createDataFrame(rows, "url string, host string, path string, blocked double")
    rates = url_filter.suffix_rates(frame, overall, config)
    found = url_filter._without_own_label(url_filter._with_features(frame, rates, overall), config).collect()
    suffix = {"tld": lambda h, p: h.rpartition(".")[2], "domain": lambda h, p: ".".join(h.split(".")[-2:]), "segment": lambda h, p: p[1:].split("/")[0]}
    for r in found:
        for kind, of in suffix.items():
            others = [b for _, h, p, b in rows if of(h, p) == of(r.host, r.path)]
            total, n = sum(others) - r.blocked, len(others) - 1
            assert r[f"f_{kind}_weight"] == n
            assert abs(r[f"f_{kind}_rate"] - (total + 3.0 * overall) / (n + 3.0)) < 1e-9
        letters = [r.host.count(c) / len(r.host) for c in set(r.host)]
        query = r.url.partition("?")[2]
        assert (r.f_length, r.f_depth, r.f_parameters) == (len(r.url), r.path.count("/"), len(query.split("&")) if query else 0)
        assert abs(r.f_host_entropy + sum(x * np.log2(x) for x in letters)) < 1e-9
        assert abs(r.f_digit_ratio - sum(c.isdigit() for c in r.url) / len(r.url)) < 1e-9


def test_undecided_urls_are_told_apart(spark):
    """On the given pages, where rules label: the model blocks some of the others, not all."""
    found = url_filter.judge_urls(spark.read.parquet(f"{SF_DIR}/pages.parquet")).where("rule is null").collect()
    assert len({round(r.block_probability, 9) for r in found}) > 1
    assert {r.verdict for r in found} == {"allow", "block"}
