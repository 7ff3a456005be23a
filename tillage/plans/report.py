"""Plain-text reports of summaries and selections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def counts(title: str, values: Mapping[object, int]) -> str:
    return "\n".join([f"{title}:", *(f"  {str(k):<24} {n}" for k, n in values.items())])


def selection(selected: DataFrame, summary: Mapping[str, object], shown: int = 12) -> str:
    """Totals, counts by dimension, and the first rows in rank order."""
    head = [f"query bank : {summary['total_query_bank']}", f"selected   : {summary['selected_queries']}", f"skipped    : {summary['skipped_queries']}", f"status     : {summary['status']}"]
    dims = [counts(k.removeprefix("by_"), v) for k, v in summary["selection"].items() if k.startswith("by_")]
    rows = selected.orderBy("selection_rank").limit(shown).collect()
    lines = [f"{r.selection_rank:02d}. [{r.combined_query_id}] {r.discovery_channel} | {r.source_stage} | {r.query_kind} | {r.scope_type} | {r.query_text}" for r in rows]
    return "\n".join([*head, "", *dims, "", *lines])


def bank(summary: Mapping[str, object], systematic: DataFrame, questions: DataFrame, shown: int = 20) -> str:
    """Totals, counts by dimension, regions, the first issues, and the representatives of both parts."""
    head = [f"A1 queries              : {summary['a1_query_count']}", f"A2 queries              : {summary['a2_query_count']}", f"Combined unique queries : {summary['combined_unique_query_count']}"]
    head += [f"Scenarios               : {summary['weather_scenario_count']}", f"Actions                 : {summary['action_count']}", f"Status                  : {summary['status']}", f"Issues                  : {summary['audit']['issue_count']}", ""]
    dims = [counts(f"{part.upper()} {k.replace('_', ' ')}", v) for part in ("a1", "a2") for k, v in summary[part].items() if k.startswith("by_")]
    a2 = summary["a2"]
    region = ["", f"A2 queries with region    : {a2['queries_with_region']}", f"A2 queries without region : {a2['queries_without_region']}", "", "A2 review changes:", *(f"  - {c}" for c in a2["review_changes"])]
    region += ["", "Round 1 regions:", *(f"  {k}: {', '.join(v)}" for k, v in summary["round_1_search_regions"].items()), "", "Later regions, not searched yet:", ", ".join(summary["future_gap_fill_regions"])]
    issues = ["", "Audit issues:", *([f"  {x}" for x in summary["audit"]["issues"][:shown]] or ["  none"])]
    rows = ["", "Representative A1 queries:", *(f"{i:02d}. [{r.query_id}] {r.language} | {r.scope_type} | {r.crop_id or r.crop_group} | {r.weather_scenario} | {r.query_kind} | {r.action} | {r.search_region} | {r.query}" for i, r in enumerate(systematic.collect(), 1))]
    rows += ["", "Representative A2 queries:", *(f"{i:02d}. [{r.query_id}] {r.query_origin} | {r.intent} | {r.crop_scope} | {r.crop_key} | {r.scenario} | {r.action} | {r.search_region} | {r.query_text}" for i, r in enumerate(questions.collect(), 1))]
    return "\n".join([*head, *dims, *region, *issues, *rows])
