"""Registered queries against their SQL, and the pipeline against plain Python, stage by stage."""

from __future__ import annotations

import duckdb
import pytest
from plain_versions import brute, check_pieces
from pyspark.sql import functions as F

import corpus_pipeline
from rankframe.llm import language, queries
from rankframe.llm.decontaminate import terms_of
from rankframe.llm.packing import PackingConfig
from rankframe.llm.secrets import BASE_RULES, MORE_RULES, find_spans, redact
from rankframe.llm.tokens import Vocabulary, encoder

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels"):
        duck.execute(f"create view {table} as select * from read_parquet('{SF_DIR}/{table}.parquet')")
    answer = duck.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in answer.description]
    found = queries.queries()[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(*columns).collect()), key=str) == sorted(answer.fetchall(), key=str)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_every_query_covers_its_table(spark, name):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = queries.queries()[name](spark, SF_DIR)
    if name in ("op4_content_archive", "op8_boosted_urls"):
        pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
        assert sorted(r.page_id for r in rows.collect()) == sorted(r.page_id for r in pages.collect())
    elif name == "op5_length_histogram":
        assert sum(r.n_docs for r in rows.collect()) == documents.count()
    elif name == "op11_bit_plane_clusters":
        vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").where("size(embedding) = 64")
        assert sorted(r.vec_id for r in rows.collect()) == sorted(r.vec_id for r in vectors.collect())
    elif name == "op13_filter_potential":
        assert sum(r.kept + r.removed for r in rows.where("step = 1 and filter_order = 'ABCDE'").collect()) == documents.count()
        assert rows.count() == 600 * documents.select("lang").distinct().count()
    elif name == "op9_benchmark_leaks":
        assert rows.count() > 0
    else:
        assert {r.doc_id for r in rows.collect()} == {r.doc_id for r in documents.collect()}


def test_pipeline_matches_plain_python(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [set(terms_of(r.text)) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        result = spark.read.parquet(f"{tmp_path}/{name}")
        after = {r.doc_id: r for r in result.collect()}
        if name != "packing":
            assert result.columns == columns
            docs = result
        if name == "language_id":
            model = language.fit_language_model(spark.read.parquet(f"{SF_DIR}/documents.parquet").where("crc32(cast(doc_id as string)) % 3 <> 1"))
            judged = {d: language.predict(r.text, model, language.LanguageConfig()) for d, r in before.items()}
            assert set(after) == {d for d, (lang, score) in judged.items() if lang != "und" and score >= corpus_pipeline.LEAST_SCORE}
            assert len(after) >= 0.97 * len(before)
        elif name == "jaccard_join":
            expected, _ = brute([(d, r.text) for d, r in before.items()], 5, 80, 100)
            assert set(after) == {component for _, _, component in expected} and len(after) < len(before)
        elif name == "decontamination":
            leaks = {d for d, r in before.items() if any(item and len(item & set(terms_of(r.text))) >= 0.95 * len(item) for item in items)}
            assert leaks and set(after) == set(before) - leaks
        elif name == "secret_scan":
            assert set(after) == set(before)
            for d, r in before.items():
                spans = find_spans(r.text, BASE_RULES + MORE_RULES)
                assert after[d].text == (redact(r.text, spans, corpus_pipeline.SECRET_MARK) if spans else r.text)
                assert after[d].n_chars == (len(after[d].text) if spans else r.n_chars)
            assert any(find_spans(r.text, BASE_RULES) for r in before.values())
        else:
            encode = encoder(Vocabulary.public()).encode
            texts = {d: [r.text] for d, r in before.items()}
            assert check_pieces(result.collect(), lambda t: encode(t).tolist(), PackingConfig().tiers, texts) <= 1


#: Names that the stages' operators give to their own results.
CLASHING = ("score", "lang_pred", "spans", "redacted", "n_assign", "n_access", "n_hex", "base_sha256", "row", "kept", "component_id", "first", "n_shingles", "content", "set", "item_id")


def test_stages_take_awkward_documents(spark, awkward, nothing):
    for docs in (awkward, nothing):
        docs = docs.withColumns({c: F.lit(f"own {c}") for c in CLASHING if c not in docs.columns})
        wanted = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, SF_DIR)
            if name == "packing":
                result.count()
                continue
            assert result.columns == wanted
            for r in result.collect():
                assert all(r[c] == f"own {c}" for c in CLASHING if c not in awkward.columns)
