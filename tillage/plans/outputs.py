"""What the bank's writer reports: statuses, counts by dimension, representatives, and the files of a bank."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tillage.operators.audits import audit_questions, audit_systematic, audit_taxonomy
from tillage.operators.tables import conditional_counts, count_by_dims, first_per_criterion
from tillage.plans import fixed
from tillage.plans.bank import combined, questions, systematic, taxonomy
from tillage.plans.search import issue_list
from tillage.sources import files
from tillage.sources.publish import Publication
from tillage.sources.scratch import Scratch

#: Dimensions that a summary counts, by their names there.
SYSTEMATIC_COUNTS = {"by_language": "language", "by_channel": "channel", "by_scope": "scope_type", "by_query_kind": "query_kind", "by_search_region": "search_region", "by_weather_scenario": "weather_scenario"}
QUESTION_COUNTS = {"by_query_origin": "query_origin", "by_intent": "intent", "by_crop_scope": "crop_scope", "by_search_region": "search_region"}


def systematic_status(issues: int) -> str:
    return "REVIEW_REQUIRED" if issues else "READY_FOR_DISCOVERY"


def bank_status(issues: int) -> str:
    """Of the questions, and of the whole bank."""
    return "NEEDS_REVIEW" if issues else "READY_FOR_A3"


def criteria(scope: str) -> list[dict[str, str]]:
    """The values that each representative must have: of systematic queries (A1) or of questions (A2)."""
    if scope == "A2":
        return [dict(zip(("intent", "crop_scope", "crop_key", "search_region"), c, strict=True)) for c in fixed.QUESTION_CRITERIA]
    out = []
    for language, kind, key, scenario, query_kind, action, region in fixed.SYSTEMATIC_CRITERIA:
        out.append({"language": language, "scope_type": kind, "crop_id" if kind == "crop_specific" else "crop_group": key, "weather_scenario": scenario, "query_kind": query_kind, "action": action, "search_region": region})
    return out


def representatives(rows: DataFrame, stage: str, limit: int | None = None) -> DataFrame:
    """The first row of each criterion, in their order, then further rows in the bank's order (ord, query_id), up to ``limit`` (one for each criterion)."""
    wanted = criteria(stage)
    return first_per_criterion(rows, wanted, [F.col("ord"), F.col("query_id")], limit or len(wanted), "query_id")


def _counts(rows: DataFrame, dims: Mapping[str, str], defaults: Mapping[str, Sequence[str]]) -> tuple[int, dict[str, dict[str, int]]]:
    """The number of rows and the counts of each dimension, in one pass; keys in order, or the given ones with their counts."""
    found: dict[str, dict[str, int]] = {d: {} for d in dims.values()}
    for r in count_by_dims(rows, list(dims.values())).collect():
        found[r["dim"]][r["key"]] = r["n"]
    total = sum(next(iter(found.values())).values())
    return total, {name: {k: found[d].get(k, 0) for k in defaults.get(d, sorted(found[d]))} for name, d in dims.items()}


def bank_summary(a1: DataFrame, a2: DataFrame, both: int, crops: int, issues: Mapping[str, list[dict]], generated_at: str, outputs: Mapping[str, str] | None = None) -> dict:
    """The summary of a bank, in the form of its file; ``issues``: the lists of A1 and A2."""
    n1, by1 = _counts(a1, SYSTEMATIC_COUNTS, {})
    n2, by2 = _counts(a2, QUESTION_COUNTS, {"query_origin": fixed.ORIGINS})
    region = conditional_counts(a2, {"queries_with_region": F.col("search_region") != "NONE", "queries_without_region": F.col("search_region") == "NONE"}).first().asDict()
    plain = {k: [{f: v for f, v in x.items() if f != "stage"} for x in issues[k]] for k in ("A1", "A2")}
    every = [*issues["A1"], *issues["A2"]]
    audit = lambda found: {"issue_count": len(found), "issues": found}
    return {
        "generated_at": generated_at, "version": fixed.VERSION, "status": bank_status(len(every)), "strategy": fixed.STRATEGY,
        "a1_query_count": n1, "a2_query_count": n2, "combined_unique_query_count": both, "crop_count": crops, "weather_scenario_count": len(fixed.SCENARIOS), "action_count": len(fixed.ACTIONS),
        "round_1_search_regions": {lang: [r[1] for r in fixed.REGIONS if r[0] == lang] for lang in dict.fromkeys(r[0] for r in fixed.REGIONS)}, "future_gap_fill_regions": list(fixed.REGIONAL_FALLBACKS),
        "a1": {"status": systematic_status(len(plain["A1"])), "query_count": n1, **by1, "audit": audit(plain["A1"])},
        "a2": {"status": bank_status(len(plain["A2"])), "query_count": n2, **region, "review_changes": list(fixed.REVIEW_CHANGES), **by2, "audit": audit(plain["A2"])},
        "audit": audit(every), "outputs": dict(outputs or {}),
    }


def write_bank(spark, config: dict, folder: str, generated_at: str) -> tuple[dict, DataFrame, DataFrame]:
    """Build, audit and publish a bank in ``folder``: (summary, representatives of A1, of A2). All its files appear together or not at all."""
    scratch, t = Scratch(spark), taxonomy(spark, config)
    a1, a2 = scratch.save(systematic(t)), scratch.save(questions(t))
    both = scratch.save(combined(a1, a2))
    found = {"A1": issue_list(audit_systematic(a1.drop("ord"), config).union(audit_taxonomy(spark)), "A1"), "A2": issue_list(audit_questions(a2.drop("ord"), config), "A2")}
    with Publication(spark, folder) as out:
        for name, df in (("a1", a1.orderBy("ord", "query_id").drop("ord")), ("a2", a2.orderBy("ord", "query_id").drop("ord"))):
            files.write_csv(df, out.path(f"{name}_csv"), single=True)
            files.write_jsonl(df, out.path(name), single=True)
        files.write_jsonl(both.orderBy("source_stage", "source_query_id"), out.path("combined"), single=True)
        named = {"a1_csv": "a1_csv", "a1_jsonl": "a1", "a2_csv": "a2_csv", "a2_jsonl": "a2", "combined_jsonl": "combined", "summary_json": "summary"}
        summary = bank_summary(a1, a2, both.count(), len(config.get("crops", [])), found, generated_at, {k: f"{folder}/{v}" for k, v in named.items()})
        files.write_summary(spark, summary, out.path("summary"), sort_keys=False)
    return summary, representatives(a1, "A1"), representatives(a2, "A2")
