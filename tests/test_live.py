"""Live runs: the journal, the pace, the data source; answers come from functions and a server on this machine."""

import json
import os
import signal
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from tillage.plans.search import Vocabulary, discover, failed_run
from tillage.sources.config import RunConfig
from tillage.sources.journal import Journal
from tillage.sources.providers import SearchProviderError, SearchProviderUnavailable, brave_hits, ddgs_hits, scholarly_hits, search_live
from tillage.sources.search_source import HITS, hits_in, register

VARIANTS = "original_query_id string, variant_ord int, provider string, search_text string, selection_rank int"


def counting(folder, answer):
    """A provider that notes each request, with its time, in a file of its own."""

    def call(provider, query, limit, timeout):
        with open(f"{folder}/calls", "a") as f:
            f.write(json.dumps([query, time.time()]) + "\n")
        return answer(query)

    return call


def calls(folder):
    return [json.loads(x) for x in open(f"{folder}/calls")]


def test_answers_are_asked_once(spark, tmp_path):
    asked = spark.createDataFrame([(f"Q{i}", 0, "ddgs", f"t{i}", i) for i in range(6)], VARIANTS)
    got = search_live(asked, 5, 1, 1, 0, 0, counting(tmp_path, lambda q: "[]"))
    assert got.count() == 6 and got.where("payload = '[]'").count() == 6 and got.where("error is null").count() == 6
    assert sorted(q for q, _ in calls(tmp_path)) == [f"t{i}" for i in range(6)]


def test_a_killed_worker_asks_only_what_has_no_answer(spark, tmp_path):
    """The worker dies at its fourth request; the run that goes on repeats no answered one."""

    def answer(query):
        if query == "t3" and not os.path.exists(f"{tmp_path}/died"):
            open(f"{tmp_path}/died", "w").close()
            os.kill(os.getpid(), signal.SIGKILL)
        return json.dumps([{"href": f"http://x/{query}", "title": query}])

    asked = spark.createDataFrame([(f"Q{i}", 0, "ddgs", f"t{i}", i) for i in range(6)], VARIANTS)
    journal = Journal(f"file://{tmp_path}/journal")
    run = lambda: search_live(asked, 5, 1, 1, 0, 0.01, counting(tmp_path, answer), journal)
    with pytest.raises(Exception, match="(?i)worker|crash|EOF|lost"):
        run().collect()
    assert [q for q, _ in calls(tmp_path)] == ["t0", "t1", "t2", "t3"] and journal.answers(spark).count() == 3
    assert sorted(json.loads(r.payload)[0]["title"] for r in run().collect()) == [f"t{i}" for i in range(6)]
    assert [q for q, _ in calls(tmp_path)] == ["t0", "t1", "t2", "t3", "t3", "t4", "t5"]


def test_failures_are_answers_until_forgotten(spark, tmp_path):
    def answer(query):
        if not os.path.exists(f"{tmp_path}/up"):
            raise SearchProviderError("down")
        return "[]"

    asked = spark.createDataFrame([("Q", 0, "ddgs", "t", 1)], VARIANTS)
    journal = Journal(str(tmp_path / "journal"))
    run = lambda: [(r.payload, r.error) for r in search_live(asked, 5, 1, 2, 0, 0, counting(tmp_path, answer), journal).collect()]
    assert run() == run() == [(None, "down")] and len(calls(tmp_path)) == 2
    (tmp_path / "up").touch()
    assert journal.forget_failures(spark) == 1 and run() == [("[]", None)] and len(calls(tmp_path)) == 3
    assert Journal(str(tmp_path / "none")).answers(spark).count() == 0 and Journal(str(tmp_path / "none")).last(spark) == 0


def test_first_answer_stays(tmp_path):
    journal = Journal(str(tmp_path))
    entry = {"original_query_id": "Q", "variant_ord": 0, "payload": "1", "error": None}
    assert journal.record(entry) == entry and journal.record(entry | {"payload": "2"})["payload"] == "1"
    assert [p.suffix for p in tmp_path.iterdir()] == [".json"]


def test_pauses_hold_for_the_whole_run(spark, tmp_path):
    """Four threads, queries of two providers, and a second round: never less than the pause between two queries."""
    rows = [(f"Q{i}", 0, "ddgs" if i % 2 else "crossref", f"t{i}", 9 - i) for i in range(5)]
    journal, call = Journal(str(tmp_path / "journal")), counting(tmp_path, lambda q: "[]")
    asked = spark.createDataFrame(rows, VARIANTS).repartition(4)
    for k in (0, 1):
        assert search_live(asked.withColumn("variant_ord", F.lit(k)), 5, 1, 1, 0, 0.3, call, journal).count() == 5
    at = [t for _, t in calls(tmp_path)]
    assert len(at) == 10 and min(b - a for a, b in zip(at, at[1:], strict=False)) >= 0.3
    assert [q for q, _ in calls(tmp_path)][:5] == ["t4", "t3", "t2", "t1", "t0"]


def test_a_run_goes_on_from_its_journal(spark, bank, tmp_path):
    """A whole run whose second round breaks off; the next run with the journal repeats no request."""
    _, _, _, both = bank
    journal = Journal(str(tmp_path / "journal"))

    def answer(query):
        if len(calls(tmp_path)) == 5 and not os.path.exists(f"{tmp_path}/died"):
            open(f"{tmp_path}/died", "w").close()
            raise ValueError("not a provider's error: the run ends")
        return "[]"

    search = lambda asked: search_live(asked, 5, 1, 1, 0, 0.001, lambda p, q, n, t: '{"message": {"items": []}}' if p == "crossref" else call(p, q, n, t), journal)
    call = counting(tmp_path, answer)
    config = RunConfig(live=True, query_limit=3, channels=("web",))
    with pytest.raises(Exception, match="the run ends"):
        discover(both, Vocabulary.fixed(), config, search, "2024-01-01T00:00:00Z")
    assert len(calls(tmp_path)) == 5 and journal.answers(spark).count() == 4
    run = discover(both, Vocabulary.fixed(), config, search, "2024-01-01T00:00:00Z")
    texts = [q for q, _ in calls(tmp_path)]
    assert run.summary["executed_search_requests"] == 12 and run.candidates.count() == 0
    assert len(texts) == 13 and journal.answers(spark).count() == 12


def test_a_run_without_a_provider(spark, bank):
    _, _, _, both = bank
    for error, status in ((SearchProviderUnavailable("none"), "SEARCH_PROVIDER_UNAVAILABLE"), (SearchProviderError("bad"), "SEARCH_PROVIDER_ERROR")):
        selected, summary = failed_run(both, Vocabulary.fixed(), RunConfig(live=True), error, "2024-01-01T00:00:00Z")
        assert summary["status"] == status and summary["errors"] == [str(error)] and summary["executed_queries"] == 0 and summary["selected_queries"] == 96


# ---- the data source ----

BRAVE = {"web": {"results": [{"url": "http://a/1", "title": "A &amp; <b>B</b>", "snippet": "s  t", "description": ""}, {"title": "no address"}, {"url": "http://a/2", "title": None, "body": "x&nbsp;y"}]}}
DDGS = [{"href": "http://d/1", "title": "D", "body": "b"}, {"url": "http://d/2", "title": "E &lt;i&gt;", "description": "z"}, {"title": "none"}]
CROSSREF = {"message": {"items": [{"DOI": "10.1/x", "title": ["<i>A</i> &lt;b&gt; c"], "abstract": "<p>q</p> r", "subject": ["S", " "]}, {"title": ["none"]}, {"URL": "http://d", "type": "book", "title": []}]}}


@pytest.fixture(scope="module")
def server():
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            q = parse_qs(urlparse(self.path).query)
            text = (q.get("q") or q.get("query"))[0]
            seen.append(text)
            body = json.dumps(CROSSREF if "query" in q else BRAVE).encode()
            self.send_response(500 if text == "broken" else 200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{http.server_port}/search", seen
    http.shutdown()


def test_payloads_parse_as_in_the_engine(spark):
    for provider, mapper, payload in (("brave", brave_hits, BRAVE), ("ddgs", ddgs_hits, DDGS), ("crossref", scholarly_hits, CROSSREF)):
        text = json.dumps(payload)
        want = [tuple(h) for h in spark.createDataFrame([(text,)], "p string").select(mapper(F.col("p")).alias("h")).first().h]
        assert [(*h[:7], h[7]) for h in hits_in(provider, text)] == want


def test_hits_of_a_server(spark, server, tmp_path):
    address, seen = server
    register(spark)
    read = lambda **o: spark.read.format("tillage_search").options(endpoint=address, backoff=0, **o).load()
    df = read(provider="crossref", queries=json.dumps(["rain", "wind"]))
    assert df.schema.simpleString() == spark.createDataFrame([], HITS).schema.simpleString() and df.rdd.getNumPartitions() == 2
    rows = {(r.query, r["rank"]): r for r in df.collect()}
    assert set(rows) == {("rain", 1), ("rain", 3), ("wind", 1), ("wind", 3)}
    assert rows["rain", 1].url == "https://doi.org/10.1/x" and rows["rain", 1].subjects == ["S"] and rows["wind", 3].query_no == 1
    with pytest.raises(Exception, match="HTTP 500"):
        read(provider="crossref", query="broken").collect()
    failed = read(provider="crossref", query="broken", mode="permissive").collect()
    assert len(failed) == 1 and "HTTP 500" in failed[0].error and failed[0].url is None
    seen.clear()
    kept = read(provider="crossref", queries='["a", "b"]', journal=str(tmp_path / "j"))
    assert kept.count() == kept.where("rank > 0").count() == 4 and sorted(seen) == ["a", "b"]
    assert read(provider="crossref", queries="[]").count() == 0
    with pytest.raises(Exception, match="provider must be"):
        read(provider="radio", query="x").collect()


def test_keyed_search_over_http(spark, server, monkeypatch):
    monkeypatch.setenv("BRAVE_SEARCH_API_KEY", "k")
    from tillage.sources.providers import live_call

    assert [h[1] for h in hits_in("brave", live_call("brave", "rain", 5, 5, server[0]))] == ["http://a/1", "http://a/2"]
