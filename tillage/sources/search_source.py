"""Search providers as a Spark data source: spark.read.format("tillage_search")."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tillage.sources.journal import Journal
from tillage.sources.providers import MAPPERS, SCHOLAR, WEB_KEYED, SearchProviderError, live_call, with_retries

HITS = "query_no int, query string, provider string, rank int, url string, title string, snippet string, source_type_hint string, doi string, abstract string, subjects array<string>, error string"


def _clean(value: object, markup: bool = False) -> str:
    text = html.unescape(str(value or ""))
    return " ".join((re.sub("<[^>]+>", " ", text) if markup else text).split())


def hits_in(provider: str, payload: str) -> Iterator[tuple]:
    """(rank, url, title, snippet, hint, doi, abstract, subjects) of a payload, cleaned; results without a URL count by rank only."""
    data = json.loads(payload)
    if provider == SCHOLAR:
        for rank, x in enumerate((data.get("message") or {}).get("items") or [], 1):
            doi = x.get("DOI") or ""
            url = x.get("URL") or (doi and f"https://doi.org/{doi}")
            if url:
                subjects = [s for s in (_clean(s, True) for s in x.get("subject") or []) if s]
                yield rank, url, _clean(next(iter(x.get("title") or []), ""), True), "", x.get("type") or "scholarly_record", doi, _clean(x.get("abstract"), True), subjects
        return
    keyed = provider == WEB_KEYED
    for rank, x in enumerate(((data.get("web") or {}).get("results") or []) if keyed else data, 1):
        url = x.get("url") or "" if keyed else x.get("href") or x.get("url") or ""
        order = ("description", "snippet", "body") if keyed else ("body", "snippet", "description")
        if url:
            yield rank, url, _clean(x.get("title")), _clean(next((x[k] for k in order if x.get(k)), "")), "", "", "", []


class QueryPartition(InputPartition):
    def __init__(self, number: int, query: str):
        super().__init__((number, query))
        self.number, self.query = number, query


class SearchReader(DataSourceReader):
    """One partition for each query."""

    def __init__(self, options: dict[str, str]):
        self.provider = options.get("provider", "")
        if self.provider not in MAPPERS:
            raise ValueError(f"provider must be one of {', '.join(MAPPERS)}")
        self.queries = json.loads(options["queries"]) if "queries" in options else [options["query"]] if "query" in options else []
        self.limit, self.timeout = int(options.get("limit", 5)), float(options.get("timeout", 20))
        self.attempts, self.backoff = int(options.get("attempts", 2)), float(options.get("backoff", 0.5))
        self.endpoint, self.journal = options.get("endpoint"), options.get("journal")
        self.failfast = options.get("mode", "failfast").lower() == "failfast"

    def partitions(self) -> list[QueryPartition]:
        return [QueryPartition(i, q) for i, q in enumerate(self.queries)]

    def read(self, partition: QueryPartition | None) -> Iterator[tuple]:
        if partition is None:  # no queries
            return
        ask = lambda: with_retries(lambda: live_call(self.provider, partition.query, self.limit, self.timeout, self.endpoint), self.attempts, self.backoff)
        if self.journal:
            entry = Journal(self.journal).answer(f"{self.provider}/{partition.query}", 0, self.provider, partition.query, ask)
            payload, error = entry["payload"], entry["error"]
        else:
            payload, error = ask()
        if error is not None:
            if self.failfast:
                raise SearchProviderError(error)
            yield partition.number, partition.query, self.provider, *([None] * 8), error
            return
        for hit in hits_in(self.provider, payload):
            yield partition.number, partition.query, self.provider, *hit, None


class SearchSource(DataSource):
    """Hits of live searches.

    Options: ``provider``; ``queries``, a JSON array of texts, or ``query``; ``limit``, ``timeout``, ``attempts`` and
    ``backoff`` as in a run; ``endpoint``, another address of the provider; ``journal``, a shared folder where answers
    are kept, so that a task that runs again, or a second action on the table, asks nothing twice; ``mode``:
    failfast (a query that fails after all attempts fails the read) or permissive (it has one row, with ``error``).
    Each query is a partition. The schema is HITS; rank counts all results of a query from 1.
    """

    @classmethod
    def name(cls) -> str:
        return "tillage_search"

    def schema(self) -> str:
        return HITS

    def reader(self, schema) -> SearchReader:
        return SearchReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SearchSource)
