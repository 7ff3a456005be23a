import json

import pytest
from pyspark.sql import functions as F

from tillage.operators import audits, tables
from tillage.operators.audits import audit_candidates
from tillage.plans.search import Vocabulary, discover, domain_counts, run_status, variants
from tillage.sources import files
from tillage.sources.config import RunConfig
from tillage.sources.providers import SearchProviderError, checked, SearchProviderUnavailable, overfetch, provider_of, scholarly_hits, search_fixture, search_live, brave_hits, ddgs_hits, with_retries


def mapped(spark, f, payload):
    return spark.createDataFrame([(json.dumps(payload),)], "p string").select(f(F.col("p")).alias("h")).first().h


def test_payload_mappers(spark):
    hits = mapped(spark, brave_hits, {"web": {"results": [{"url": "http://a", "title": "T &amp; U", "description": "", "snippet": "s"}, {"title": "no url"}]}})
    assert [(h.url, h.title, h.snippet) for h in hits] == [("http://a", "T & U", "s")]
    hits = mapped(spark, ddgs_hits, [{"href": "http://b", "title": "t", "body": "x"}, {"url": "http://c", "title": "u", "description": "d"}])
    assert [(h.url, h.snippet) for h in hits] == [("http://b", "x"), ("http://c", "d")]
    items = [{"DOI": "10.1/x", "title": ["<i>A</i> &lt;b&gt;"], "abstract": "<p>q</p>", "subject": ["S"]}, {"title": ["none"]}, {"URL": "http://d", "type": "book"}]
    hits = mapped(spark, scholarly_hits, {"message": {"items": items}})
    assert [(h.url, h.title, h.abstract, h.source_type_hint) for h in hits] == [("https://doi.org/10.1/x", "A", "q", "scholarly_record"), ("http://d", "", "", "book")]
    assert mapped(spark, ddgs_hits, []) == []


def test_providers():
    assert provider_of("web", None) == "ddgs" and provider_of("web", "k") == "brave" and provider_of("scholarly", None) == "crossref"
    with pytest.raises(SearchProviderUnavailable):
        provider_of("radio", None)
    assert [overfetch(n) for n in (1, 5, 8, 30)] == [6, 10, 16, 20]
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 2:
            raise SearchProviderError("no")
        return "ok"

    assert with_retries(flaky, 2, 0) == ("ok", None)


    def broken():
        raise SearchProviderError("down")

    assert with_retries(broken, 2, 0) == (None, "down")


def test_fallback_texts(spark):
    v = Vocabulary({"c": ["one", "two"]}, {"s": ["rain", "wet"]}, {"a": ["water"]}, ["loss"])
    q = spark.createDataFrame([("Q1", "x", "web", "c", "s", "a", "VIETNAM"), ("Q2", "y", "scholarly", "c", "s", "a", "NONE"), ("Q3", "z", "web", "other", "s", "NONE", "NONE")], "combined_query_id string, query_text string, discovery_channel string, crop_key string, weather_scenario string, action string, search_region string")
    got = [(r.combined_query_id, r.variant_ord, r.search_text) for r in variants(q, v).orderBy("combined_query_id", "variant_ord").collect()]
    assert got == [("Q1", 0, "x"), ("Q1", 1, '"one" "rain" Việt Nam'), ("Q1", 2, '"two" rain water'), ("Q1", 3, '"one" wet thời tiết chăm sóc'), ("Q2", 0, "y"), ("Q3", 0, "z")]


def answers_for(asked):
    """Web fallbacks of type crop_scenario find a page; originals nothing; scholarly ones find a record."""
    page = lambda crop, rain: json.dumps([{"href": "http://Site.org/a/?utm_x=1", "title": f"{crop} {rain}", "body": "x"}, {"href": "http://site.org/a", "title": "", "body": f"{crop} {rain} {rain}"}, {"href": "http://other.org", "title": "nothing"}])
    rows = []
    for r in asked:
        found = r.search_variant_type == "crop_scenario"
        if r.discovery_channel == "scholarly":
            rows.append((r.search_text, json.dumps({"message": {"items": [{"DOI": "10.1/z", "title": [f"{r.crop_terms[0]} {r.scenario_terms[0]}"]}]}}), None))
        else:
            rows.append((r.search_text, page(r.crop_terms[0], r.scenario_terms[0]) if found else "[]", None))
    return rows


def test_live_run_on_fixtures(spark, bank, config):
    _, _, _, both = bank
    v = Vocabulary.fixed()

    def search(asked):
        rows = list({r[0]: r for r in answers_for(asked.collect())}.values())
        return search_fixture(asked, spark.createDataFrame(rows, "search_text string, payload string, error string"))

    run = discover(both, v, RunConfig(live=True, query_limit=4), search, "2024-01-01T00:00:00Z")
    rows = {r.canonical_url: r for r in run.candidates.collect()}
    assert set(rows) == {"http://site.org/a", "https://doi.org/10.1/z"}
    web = rows["http://site.org/a"]
    assert web.raw_result_count == len(web.query_references) == 2 * run.summary["queries_recovered_by_fallback"]
    assert web.title != "" and web.discovery_providers == ["ddgs"]
    assert run.issues.count() == 0 and run.summary["audit"] == {"issue_count": 0, "issues": []}
    assert run.summary["queries_recovered_by_fallback"] == 3 and run.summary["status"] == "READY_FOR_A4" and run.summary["query_hit_rate"] == 1.0
    # Originals of the three web queries bring nothing, their first fallback does, and no later one is asked.
    assert run.summary["executed_search_requests"] == 7 and run.summary["executed_queries"] == 4 == run.summary["original_queries_succeeded"]
    assert run.summary["raw_provider_results"] == 10 and run.summary["relevant_results_kept"] == 7 and run.summary["irrelevant_filtered"] == 3
    assert run.summary["provider_errors"] == [] and run.summary["selection"]["selected_queries"] == 96 == sum(run.summary["by_channel"].values())


def test_live_search_retries_and_keeps_errors(spark):
    asked = spark.createDataFrame([("Q", 0, "ddgs", "bad"), ("Q", 1, "ddgs", "good")], "original_query_id string, variant_ord int, provider string, search_text string")

    def call(provider, query, limit, timeout):
        if query == "bad":
            raise SearchProviderError("down")
        return "[]"

    got = {r.variant_ord: (r.payload, r.error) for r in search_live(asked, 5, 1, 2, 0, 0, call).collect()}
    assert got == {0: (None, "down"), 1: ("[]", None)}


def test_answers_must_be_json():
    assert checked('{"a": 1}') == '{"a": 1}'
    with pytest.raises(ValueError):
        checked("<html>")


def test_every_domain_is_counted(spark):
    rows = [(f"d{i % 1500}.org", [(i,)]) for i in range(1600)]
    got = domain_counts(spark.createDataFrame(rows, "source_domain string, query_references array<struct<result_rank:int>>"))
    assert got == {f"d{i}.org": 2 if i < 100 else 1 for i in range(1500)}


def test_statuses():
    assert run_status(1, 5, 5, 0, 1.0, True) == "NEEDS_A3_REVIEW" and run_status(0, 0, 3, 3, 0.0, True) == "SEARCH_PROVIDER_ERROR"
    assert run_status(0, 2, 5, 0, 0.6, True) == "READY_FOR_A4" and run_status(0, 2, 5, 0, 0.5, True) == "A3_LOW_COVERAGE"
    assert run_status(0, 0, 0, 0, 0, False) == "DRY_RUN_READY"


def test_candidate_audit_finds_each_fault(spark):
    from tillage.operators.candidates import merge_hits
    from tillage.plans.catalog import page_hits

    merged = merge_hits(page_hits(spark, "/root/testdata/sf0.001")).cache()
    known = spark.createDataFrame([("Q0",), ("Q1",), ("Q2",)], "query_id string")
    assert audit_candidates(merged, known).count() == 0
    one = merged.limit(1)
    for column, value, issue in (("title_status", "fabricated", "A3_FABRICATED_TITLE"), ("url", "x", "A3_MALFORMED_URL"), ("canonical_url", "", "A3_EMPTY_CANONICAL_URL"), ("relevance_status", "rejected_irrelevant", "A3_REJECTED_CANDIDATE_WRITTEN"), ("relevance_score", None, "A3_INVALID_RELEVANCE_SCORE"), ("query_id", "Q9", "A3_UNKNOWN_QUERY_ID"), ("raw_result_count", 99, "A3_DEDUP_PROVENANCE_LOST"), ("search_region", "MARS", "A3_INVALID_SEARCH_REGION")):
        assert [r.type for r in audit_candidates(one.withColumn(column, F.lit(value).cast(one.schema[column].dataType)), known).collect()] == [issue]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", None), (2, "b", ("x", 3))], "id int, b string, a struct<z:string,k:int>")
    files.write_jsonl(df, f"{tmp_path}/j", sort_keys=True, single=True)
    lines = [x for p in tmp_path.glob("j/part*") for x in p.read_text().splitlines()]
    assert lines[0] == '{"a":null,"b":"é","id":1}' and lines[1] == '{"a":{"k":3,"z":"x"},"b":"b","id":2}'
    assert files.read_jsonl(spark, f"{tmp_path}/j", df.schema).count() == 2
    (tmp_path / "bad.jsonl").write_text('{"id": 1}\n\n{"id": \n')
    with pytest.raises(ValueError, match="bad.jsonl:3"):
        files.read_jsonl(spark, f"{tmp_path}/bad.jsonl", "id int")
    files.write_csv(df.drop("a"), f"{tmp_path}/c", single=True)
    assert next(tmp_path.glob("c/part*")).read_bytes().startswith("\ufeffid,b\r\n".encode())
    files.write_summary(spark, {"b": 1, "a": "ñ"}, f"{tmp_path}/s")
    assert next(tmp_path.glob("s/part*")).read_text() == '{\n  "a": "ñ",\n  "b": 1\n}\n'


def test_run_config():
    with pytest.raises(ValueError):
        RunConfig(query_limit=0)
    with pytest.raises(ValueError):
        RunConfig(channels=("radio",))


def test_table_operators(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], i % 3) for i in range(12)], "id int, k string, v int")
    assert tables.coverage(df.limit(0), F.col("v")).first()["query_hit_rate"] == 0.0
    got = tables.first_per_criterion(df, [{"k": "b"}, {"k": "b"}, {"v": 2}], [F.col("id")], 5, "id").collect()
    assert [r.id for r in got] == [1, 3, 2, 0, 4]
    assert [r.type for r in audits.missing_fields(df, "M", ["id", "none"]).collect()] == ["M"]
    assert df.where(tables.matches({"k": "a", "v": 0})).count() == 2
