"""Search providers: payload mappers, the HTTP source, and a fixture source for offline use."""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tillage.functions.text import clean_text
from tillage.sources.journal import Journal

BRAVE = "web struct<results: array<struct<url: string, title: string, description: string, snippet: string, body: string>>>"
DDGS = "array<struct<href: string, url: string, title: string, body: string, snippet: string, description: string>>"
SCHOLARLY = "message struct<items: array<struct<DOI: string, URL: string, title: array<string>, abstract: string, subject: array<string>, type: string>>>"


class SearchProviderError(RuntimeError):
    """A provider could not answer."""


class SearchProviderUnavailable(SearchProviderError):
    """There is no provider for a channel."""


def _first(*names: Column) -> Column:
    return F.coalesce(*[F.nullif(n, F.lit("")) for n in names], F.lit(""))


def _brave(payload: Column) -> Column:
    return _web(F.from_json(payload, BRAVE)["web"]["results"], lambda r: (r["url"], r["title"], _first(r["description"], r["snippet"], r["body"])))


def _ddgs(payload: Column) -> Column:
    return _web(F.from_json(payload, DDGS), lambda r: (_first(r["href"], r["url"]), r["title"], _first(r["body"], r["snippet"], r["description"])))


def _hit(rank: Column, url: Column, title: Column, snippet: Column, hint: Column, doi: Column, abstract: Column, subjects: Column) -> Column:
    fields = {"url": url, "title": title, "snippet": snippet, "source_type_hint": hint, "doi": doi, "abstract": abstract}
    return F.struct(rank.alias("rank"), *[F.coalesce(c, F.lit("")).alias(k) for k, c in fields.items()], F.coalesce(subjects, F.array().cast("array<string>")).alias("subjects"))


def _web(results: Column, pick: Callable[[Column], tuple[Column, Column, Column]]) -> Column:
    """Array of hits as they come; results without a URL are skipped but counted by rank."""
    none = F.lit("")
    return F.filter(F.transform(results, lambda r, i: _hit(i + 1, *pick(r), none, none, none, F.array().cast("array<string>"))), lambda h: h["url"] != "")


def _scholarly(payload: Column) -> Column:
    """Array of hits as they come: the URL or else that of the DOI; items without either are skipped."""

    def make(i: Column, at: Column) -> Column:
        doi = F.coalesce(i["DOI"], F.lit(""))
        url = F.coalesce(F.nullif(i["URL"], F.lit("")), F.when(doi != "", F.concat(F.lit("https://doi.org/"), doi)), F.lit(""))
        return _hit(at + 1, url, F.get(i["title"], F.lit(0)), F.lit(""), F.coalesce(i["type"], F.lit("scholarly_record")), doi, i["abstract"], i["subject"])

    return F.filter(F.transform(F.from_json(payload, SCHOLARLY)["message"]["items"], make), lambda h: h["url"] != "")


def _clean(h: Column, markup: Column) -> Column:
    """A hit with its texts cleaned, of tags too if they are ``markup``."""
    text = lambda c: clean_text(c, markup)
    subjects = F.filter(F.transform(h["subjects"], text), lambda t: t != "")
    return _hit(h["rank"], h["url"], text(h["title"]), text(h["snippet"]), h["source_type_hint"], h["doi"], text(h["abstract"]), subjects)


def brave_hits(payload: Column) -> Column:
    """Array of hits of a `web.results` payload."""
    return F.transform(_brave(payload), lambda h: _clean(h, F.lit(False)))


def ddgs_hits(payload: Column) -> Column:
    """Array of hits of a list payload."""
    return F.transform(_ddgs(payload), lambda h: _clean(h, F.lit(False)))


def scholarly_hits(payload: Column) -> Column:
    """Array of hits of a works payload."""
    return F.transform(_scholarly(payload), lambda h: _clean(h, F.lit(True)))


#: The names of the providers, which candidates keep.
WEB_KEYED, WEB_OPEN, SCHOLAR = "brave", "ddgs", "crossref"
MAPPERS = {WEB_KEYED: _brave, WEB_OPEN: _ddgs, SCHOLAR: _scholarly}


def raw_results(provider: Column, payload: Column) -> Column:
    """Results of a payload before any is left out; 0 without a payload."""
    sizes = {WEB_KEYED: F.from_json(payload, BRAVE)["web"]["results"], WEB_OPEN: F.from_json(payload, DDGS), SCHOLAR: F.from_json(payload, SCHOLARLY)["message"]["items"]}
    out = F.lit(None)
    for name, items in sizes.items():
        out = F.when(provider == name, F.size(items)).otherwise(out)
    return F.greatest(F.coalesce(out, F.lit(0)), F.lit(0))


def provider_of(channel: str, web_key: str | None) -> str:
    """The keyed web search with a key, the open one without; the scholarly one; else SearchProviderUnavailable."""
    if channel == "web":
        return WEB_KEYED if web_key else WEB_OPEN
    if channel == "scholarly":
        return SCHOLAR
    raise SearchProviderUnavailable(f"no search provider for channel {channel!r}")


def clamp(n: int, low: int = 1, high: int = 20) -> int:
    return max(low, min(high, n))


def overfetch(limit: int) -> int:
    """Records to ask of a scholarly provider so that enough are left after scoring."""
    return clamp(max(2 * limit, limit + 5))


def request_json(url: str, headers: dict[str, str], timeout: float) -> str:
    """Body of a GET; HTTP and network errors become SearchProviderError."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
            return r.read().decode("utf-8")
    except urllib.error.HTTPError as e:
        raise SearchProviderError(f"HTTP {e.code} while requesting {url}") from e
    except urllib.error.URLError as e:
        raise SearchProviderError(f"Network error while requesting {url}: {e.reason}") from e


def with_retries(call: Callable[[], str], attempts: int, backoff: float) -> tuple[str | None, str | None]:
    """(payload, None), or (None, message of the last error) after all attempts."""
    error = None
    for k in range(attempts):
        try:
            return call(), None
        except SearchProviderError as e:
            error = str(e)
            if k + 1 < attempts:
                time.sleep(backoff)
    return None, error


def checked(body: str) -> str:
    """The body of an answer, which must be JSON: json.JSONDecodeError if not, which ends the run."""
    json.loads(body)
    return body


#: The addresses of the providers that are asked by HTTP.
ENDPOINTS = {WEB_KEYED: "https://api.search.brave.com/res/v1/web/search", SCHOLAR: "https://api.crossref.org/works"}


def live_call(provider: str, query: str, limit: int, timeout: float, endpoint: str | None = None) -> str:
    """Payload of one request to a live provider, at another ``endpoint`` if given."""
    quote = urllib.parse.urlencode
    address = endpoint or ENDPOINTS.get(provider)
    if provider == WEB_KEYED:
        key = os.environ.get("BRAVE_SEARCH_API_KEY", "")
        if not key:
            raise SearchProviderUnavailable("the keyed web search needs BRAVE_SEARCH_API_KEY")
        return checked(request_json(f"{address}?{quote({'q': query, 'count': clamp(limit), 'search_lang': 'vi'})}", {"Accept": "application/json", "X-Subscription-Token": key}, timeout))
    if provider == WEB_OPEN:
        try:
            from ddgs import DDGS as Client
        except ImportError as e:
            raise SearchProviderUnavailable("the ddgs package is not installed") from e
        try:
            return json.dumps(list(Client(timeout=timeout).text(query, region="vn-vi", safesearch="moderate", max_results=max(1, limit))))
        except Exception as e:
            if "no results found" in str(e).lower():
                return "[]"
            raise SearchProviderError(f"web search failed: {e}") from e
    if provider == SCHOLAR:
        ask = {"query": query, "rows": overfetch(limit)} | ({"mailto": os.environ["A3_CROSSREF_MAILTO"]} if os.environ.get("A3_CROSSREF_MAILTO") else {})
        return checked(request_json(f"{address}?{quote(ask)}", {"Accept": "application/json"}, timeout))
    raise SearchProviderUnavailable(f"unknown provider {provider!r}")


ANSWER = "original_query_id string, variant_ord int, payload string, error string"


def search_live(variants: DataFrame, limit: int, timeout: float, attempts: int, backoff: float, pause: float, call: Callable[[str, str, int, float], str] = live_call, journal: Journal | None = None) -> DataFrame:
    """Adds payload and error to variant rows (provider, original_query_id, variant_ord, search_text).

    Answers go through ``journal`` (a new one if none is given), so the result may be read again, and tasks may run again,
    without a second request. Which variants are asked is settled by tillage.plans.search.search_rounds; retries happen here.

    ``pause`` is the least time between an answer and the request of the next query, in the whole run: the queries then go
    through one lane, a single partition in their order (selection_rank if there), which also waits for the last answer in
    the journal, that of the round before. The rate allows no parallel requests, and a lane holds no more than the run's
    queries. Without a pause the queries are asked in parallel.
    """
    spark = variants.sparkSession
    journal = journal or Journal.of(spark, uuid.uuid4().hex)
    rank = [c for c in variants.columns if c == "selection_rank"]
    asked = variants.select("original_query_id", "variant_ord", "provider", "search_text", *rank)
    order = [*rank, "original_query_id", "variant_ord"]
    lanes = asked.repartition(1).sortWithinPartitions(*order) if pause else asked.repartition("original_query_id").sortWithinPartitions(*order)
    before = journal.last(spark) if pause else 0.0

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, query = before, None
        for row in (r for f in frames for r in f.itertuples()):
            fresh = journal.held(row.original_query_id, row.variant_ord) is None
            if pause and fresh and row.original_query_id != query:
                time.sleep(max(0.0, last + pause - time.time()))
            entry = journal.answer(row.original_query_id, row.variant_ord, row.provider, row.search_text, lambda row=row: with_retries(lambda: call(row.provider, row.search_text, limit, timeout), attempts, backoff))
            if fresh:
                last, query = time.time(), row.original_query_id
            yield pd.DataFrame([(row.original_query_id, row.variant_ord, entry["payload"], entry["error"])], columns=["original_query_id", "variant_ord", "payload", "error"])

    return variants.join(lanes.mapInPandas(run, ANSWER), ["original_query_id", "variant_ord"])


def search_fixture(variants: DataFrame, payloads: DataFrame) -> DataFrame:
    """As search_live, from a table of (search_text, payload, error): for tests and repeated runs."""
    return variants.join(payloads, "search_text", "left").withColumn("payload", F.coalesce("payload", F.when(F.col("error").isNull(), F.when(F.col("provider") == WEB_OPEN, "[]").otherwise("{}"))))


def hits_of(answers: DataFrame) -> DataFrame:
    """One row per hit of answered variants: hit.* and result_rank, the place among all results from 1."""
    parsed = F.lit(None)
    for name, mapper in MAPPERS.items():
        parsed = F.when(F.col("provider") == name, mapper(F.col("payload"))).otherwise(parsed)
    # Cleaned before they are exploded: a projection behind would be repeated in every column that reads a hit.
    clean = F.transform(parsed, lambda h: _clean(h, F.col("provider") == SCHOLAR))
    return answers.select("*", F.explode(clean).alias("hit")).withColumn("result_rank", F.col("hit.rank"))
