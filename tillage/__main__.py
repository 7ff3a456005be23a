"""python -m tillage bank|dry-run|live: writes the query bank, shows a selection, or runs a search."""

from __future__ import annotations

import argparse
import os
import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession, functions as F

from tillage.plans import report
from tillage.plans.outputs import write_bank
from tillage.plans.search import Vocabulary, audit_relevance_rules, discover, dry_run, failed_run
from tillage.sources import files
from tillage.sources.config import RunConfig, load_config
from tillage.sources.journal import Journal
from tillage.sources.providers import SearchProviderError, search_live
from tillage.sources.publish import Publication, published

BANK = "combined_query_id string, source_stage string, source_query_id string, query_text string, language string, channel string, query_kind string, scope_type string, crop_key string, weather_scenario string, action string, search_region string, query_origin string"


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tillage", description=__doc__)
    p.add_argument("mode", choices=("bank", "dry-run", "live"))
    p.add_argument("--config", required=True, help="crops YAML")
    p.add_argument("--bank", required=True, help="folder of the bank's files")
    p.add_argument("--output", help="folder of a live run's files")
    p.add_argument("--selection-limit", type=int, default=96)
    p.add_argument("--limit", type=int, default=8)
    p.add_argument("--results-per-query", type=int, default=5)
    p.add_argument("--channels", default="web,scholarly")
    p.add_argument("--timeout", type=float, default=20.0)
    p.add_argument("--sleep-seconds", type=float, default=1.0)
    p.add_argument("--journal", help="folder of a live run's answers; with that of a run that broke off only the rest is asked")
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    config = load_config(a.config)
    settings = RunConfig(a.mode == "live", a.selection_limit, a.limit, a.results_per_query, tuple(a.channels.split(",")), a.timeout, a.sleep_seconds)
    now = datetime.now(timezone.utc).isoformat()
    if a.mode == "bank":
        print(report.bank(*write_bank(spark, config, a.bank, now)))
        return 0
    bank, vocabulary = files.read_jsonl(spark, published(spark, a.bank, "combined"), BANK), Vocabulary.fixed()
    if a.mode == "dry-run":
        print(report.selection(*dry_run(bank, settings, audit_relevance_rules(spark, vocabulary), now)))
        return 0
    outputs = {"candidate_documents_jsonl": f"{a.output}/candidates", "candidate_discovery_summary_json": f"{a.output}/summary"}
    journal = Journal(a.journal) if a.journal else Journal.of(spark, uuid.uuid4().hex)
    search = lambda asked: search_live(asked, a.results_per_query, a.timeout, settings.attempts, settings.backoff_seconds, a.sleep_seconds, journal=journal)
    try:
        run = discover(bank, vocabulary, settings, search, now, os.environ.get("BRAVE_SEARCH_API_KEY"), outputs)
    except SearchProviderError as error:
        selected, summary = failed_run(bank, vocabulary, settings, error, now, outputs)
        with Publication(spark, a.output) as out:
            files.write_summary(spark, summary, out.path("summary"))
        print(report.selection(selected, summary))
        print(f"Search error: {error}")
        return 2
    with Publication(spark, a.output) as out:
        files.write_jsonl(run.candidates.orderBy(F.col("candidate_id")), out.path("candidates"), sort_keys=True, single=True)
        files.write_summary(spark, run.summary, out.path("summary"))
    print(report.counts("run", {k: v for k, v in run.summary.items() if not isinstance(v, dict | list)}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
