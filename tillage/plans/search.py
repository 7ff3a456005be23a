"""Search variants, the fallback chain over answers, scoring, and a whole discovery run."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillage.functions.relevance import REJECTED, assess, focused_form, folded_term, metadata_form, picked, picked_of, term_hits
from tillage.functions.text import filled, first_available, quoted, second_available, signature
from tillage.functions.urls import source_type
from tillage.operators.audits import SHOWN, audit, audit_candidates, audit_vocabularies
from tillage.operators.candidates import merge_hits
from tillage.operators.selection import select_queries
from tillage.operators.tables import coverage, domain_breakdown
from tillage.plans import fixed, vocabulary as words
from tillage.sources.config import RunConfig
from tillage.sources.providers import SearchProviderError, SearchProviderUnavailable, hits_of, provider_of, raw_results
from tillage.sources.scratch import Scratch


@dataclass(frozen=True)
class Vocabulary:
    """Search terms by crop key, scenario and action, and those shared by all queries."""

    crops: dict[str, list[str]]
    scenarios: dict[str, list[str]]
    actions: dict[str, list[str]]
    effects: list[str]
    noise: list[str] = field(default_factory=list)
    general: dict[str, str] = field(default_factory=dict)
    general_default: str = "thời tiết chăm sóc"

    @staticmethod
    def fixed() -> Vocabulary:
        """The vocabularies of tillage.plans.vocabulary."""
        lists = lambda table: {k: list(v) for k, v in table.items()}
        return Vocabulary(lists(words.CROP_TERMS), lists(words.SCENARIO_TERMS), lists(words.ACTION_TERMS), list(words.EFFECT_TERMS), list(words.NOISE_TERMS), dict(words.GENERAL_TERMS))

    @staticmethod
    def of(config: dict, noise: Sequence[str] = (), general: dict[str, str] | None = None) -> Vocabulary:
        """From a taxonomy: names, aliases and translations."""
        crops = {c["id"]: [*c["aliases_vi"], *c["aliases_en"]] for c in config.get("crops", [])} | {k: [*g["aliases_vi"], *g["aliases_en"]] for k, g in config.get("crop_groups", {}).items()}
        effects = list(dict.fromkeys(e.replace("_", " ") for s in fixed.SCENARIOS for e in s[4]))
        return Vocabulary(crops, {s[0]: [s[2], s[3]] for s in fixed.SCENARIOS}, {a: [vi, en] for a, vi, en in fixed.ACTIONS}, effects, list(noise), general or {})

    def attach(self, queries: DataFrame) -> DataFrame:
        """Adds the arrays crop_terms, scenario_terms and action_terms (empty where unknown), and their match forms, by broadcast joins of the key tables."""
        for name, column, table in (("crop_terms", "crop_key", self.crops), ("scenario_terms", "weather_scenario", self.scenarios), ("action_terms", "action", self.actions)):
            forms = name.replace("terms", "forms")
            rows = [(k, list(v), list(map(folded_term, v))) for k, v in table.items()]
            terms = queries.sparkSession.createDataFrame(rows, f"{column} string, {name} array<string>, {forms} array<string>")
            queries = queries.join(F.broadcast(terms), column, "left").withColumns({c: F.coalesce(c, F.array().cast("array<string>")) for c in (name, forms)})
        return queries

    def every(self) -> list[str]:
        """All terms that hits are matched with."""
        return [t for table in (self.crops, self.scenarios, self.actions) for terms in table.values() for t in terms] + [*self.effects, *self.noise]


def region_terms(region: Column) -> list[Column]:
    """Region of each of the three fallbacks: the country for local regions, else none."""
    local = region.isin("VIETNAM", "BINH_DINH_LEGACY", "GIA_LAI_CURRENT")
    return [F.when(local, "Việt Nam").otherwise(""), F.lit(""), F.lit("")]


def variants(queries: DataFrame, vocabulary: Vocabulary, most: int = 3) -> DataFrame:
    """One row per search text: the query (variant_ord 0), then up to ``most`` fallbacks of web queries.

    Fallbacks need a crop and a scenario term; empty and repeated texts are left out.
    """
    q = vocabulary.attach(queries)
    crop, scenario, action = F.col("crop_terms"), F.col("scenario_terms"), F.col("action_terms")
    effects = F.array(*map(F.lit, vocabulary.effects)) if vocabulary.effects else F.array().cast("array<string>")
    act = F.when(first_available(action) != "", first_available(action)).otherwise(first_available(effects))
    general = F.coalesce(F.create_map(*[F.lit(x) for p in vocabulary.general.items() for x in p])[F.col("weather_scenario")], F.lit(vocabulary.general_default)) if vocabulary.general else F.lit(vocabulary.general_default)
    near = region_terms(F.col("search_region"))
    one, two = first_available(crop), second_available(crop)
    texts = [
        ("crop_scenario", filled(quoted(one), quoted(first_available(scenario)), near[0])),
        ("crop_scenario_action", filled(quoted(two), first_available(scenario), act, near[1])),
        ("crop_weather_general", filled(quoted(one), second_available(scenario), general, near[2])),
    ]
    usable = (F.col("discovery_channel") == "web") & (one != "") & (first_available(scenario) != "")
    made = F.array(*[F.struct(F.lit(i).alias("variant_ord"), F.lit(kind).alias("search_variant_type"), text.alias("search_text"), signature(text).alias("sig")) for i, (kind, text) in enumerate(texts, 1)])
    fresh = F.filter(made, lambda v: v["sig"] != "")
    # Of equal signatures the first stays: a text is dropped if an earlier one has its signature.
    unique = F.filter(fresh, lambda v: ~F.exists(fresh, lambda w: (w["variant_ord"] < v["variant_ord"]) & (w["sig"] == v["sig"])))
    own = F.array(F.struct(F.lit(0).alias("variant_ord"), F.lit("original").alias("search_variant_type"), F.col("query_text").alias("search_text"), F.lit("").alias("sig")))
    every = F.when(usable, F.concat(own, F.slice(unique, 1, most))).otherwise(own)
    rest = [F.col(c) for c in q.columns]
    out = q.select(*rest, F.explode(every).alias("_v"))
    return out.select(*rest, F.col("combined_query_id").alias("original_query_id"), F.col("query_text").alias("original_query_text"), "_v.variant_ord", "_v.search_variant_type", "_v.search_text", F.col("_v.search_text").alias("search_variant_text"))


def score_hits(hits: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Adds matched terms, status, score and reasons to hits (hit.*, and what vocabulary.attach adds).

    A hit's texts are each read once for the whole vocabulary; its query's terms are then picked from what was found.
    """
    h = lambda c: F.col(f"hit.{c}")
    every, scenarios = vocabulary.every(), [t for v in vocabulary.scenarios.values() for t in v]
    forms = hits.withColumn("_all", metadata_form(h("title"), h("snippet"), h("abstract"), h("subjects"))).withColumn("_focus", focused_form(h("title"), h("snippet"), h("subjects")))
    found = forms.withColumns({"_found": term_hits(F.col("_all"), every), "_near_found": term_hits(F.col("_focus"), scenarios)})
    own = lambda name, hits="_found": picked_of(F.col(hits), F.col(f"{name}_terms"), F.col(f"{name}_forms"))
    terms = found.withColumns(
        {
            "matched_crop_terms": own("crop"), "matched_scenario_terms": own("scenario"), "matched_action_terms": own("action"),
            "_effect": picked(F.col("_found"), vocabulary.effects), "_near": own("scenario", "_near_found"), "_noise": picked(F.col("_found"), vocabulary.noise),
        }
    )
    r = terms.withColumn("_r", assess(*map(F.col, ("matched_crop_terms", "matched_scenario_terms", "matched_action_terms", "_effect", "_near", "_noise"))))
    out = r.withColumns({"relevance_status": F.col("_r.status"), "relevance_score": F.col("_r.score"), "relevance_reasons": F.col("_r.reasons")})
    return out.drop("_all", "_focus", "_found", "_near_found", "_effect", "_near", "_noise", "_r")


def keep_best(scored: DataFrame, limit: int) -> DataFrame:
    """Hits that aren't rejected, ``limit`` per variant, numbered by _rn: scholarly ones by status and score, web ones by rank."""
    status = F.when(F.col("relevance_status") == "direct_match", 0).otherwise(1)
    scholarly = F.col("discovery_channel") == "scholarly"
    order = Window.partitionBy("original_query_id", "variant_ord").orderBy(F.when(scholarly, status), F.when(scholarly, -F.col("relevance_score")), "result_rank")
    return scored.where(F.col("relevance_status") != REJECTED).withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= limit)


def first_successful(kept: DataFrame) -> DataFrame:
    """Of each query only the hits of its first variant that has any."""
    first = F.min("variant_ord").over(Window.partitionBy("original_query_id"))
    return kept.withColumn("_first", first).where("variant_ord = _first").drop("_first")


def query_statistics(answers: DataFrame, kept: DataFrame) -> DataFrame:
    """Per query: requests made, errors, whether one succeeded, raw results, hits kept, and whether a fallback brought them.

    ``answers`` has a row for each request with ``raw_results``, the number of results before any
    was left out. A query has zero results if no request failed and none brought a raw result.
    """
    won = kept.groupBy("original_query_id").agg(F.count(F.lit(1)).alias("hits"), F.min("variant_ord").alias("won"))
    failed = F.col("error").isNotNull()
    per = answers.groupBy("original_query_id").agg(F.count(F.lit(1)).alias("requests"), F.count_if(failed).alias("errors"), F.max(~failed).alias("succeeded"), F.sum(F.when(~failed, F.col("raw_results")).otherwise(0)).alias("raw_results"))
    both = per.join(won, "original_query_id", "left").withColumn("hits", F.coalesce("hits", F.lit(0)))
    return both.withColumn("recovered", F.coalesce(F.col("won") > 0, F.lit(False))).withColumn("zero_results", (F.col("raw_results") == 0) & (F.col("errors") == 0)).drop("won")


def run_status(issues: int, candidates: int, queries: int, failed: int, rate: float, live: bool, least: float = 0.60) -> str:
    """``failed``: queries with a provider error."""
    if not live:
        return "NEEDS_A3_REVIEW" if issues else "DRY_RUN_READY"
    if issues:
        return "NEEDS_A3_REVIEW"
    if not candidates and queries and failed == queries:
        return "SEARCH_PROVIDER_ERROR"
    return "READY_FOR_A4" if candidates and rate >= least else "A3_LOW_COVERAGE"


def domain_counts(candidates: DataFrame) -> dict[str, int]:
    """Candidates of every domain, most first; there are no more domains than hits kept."""
    ranked = candidates.withColumn("_ord", F.get("query_references", F.lit(0))["result_rank"])
    return {r["domain"]: r["n"] for r in domain_breakdown(ranked, "source_domain", "_ord").collect()}


#: Dimensions of a selection that a summary counts, by their names there.
SELECTION_COUNTS = {
    "by_discovery_channel": "discovery_channel", "by_language": "language", "by_source_stage": "source_stage", "by_query_origin": "query_origin_group", "by_query_kind": "query_kind", "by_crop_scope": "scope_type",
    "by_crop_key": "crop_key", "by_weather_scenario": "weather_scenario", "by_action": "action", "by_search_region": "search_region", "by_selection_priority": "selection_priority",
}


@dataclass(frozen=True)
class Run:
    selected: DataFrame
    candidates: DataFrame
    issues: DataFrame
    statistics: DataFrame
    summary: dict


def executable(selected: DataFrame, channels: Sequence[str], limit: int) -> DataFrame:
    """The first ``limit`` selected queries of the channels, in the order of their rank."""
    return selected.where(F.col("discovery_channel").isin(*channels)).orderBy("selection_rank").limit(limit)


def search_rounds(run: DataFrame, vocabulary: Vocabulary, config: RunConfig, search: Callable[[DataFrame], DataFrame], web_key: str | None = None, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """(answers, kept hits) of the queries ``run``: each asks its variants in order and stops at the first that brings a hit.

    One round asks one variant of every query that has no hit yet, so there are as many rounds as
    variants and no request that a query by query search wouldn't make. The variants, each round's answers and each round's
    hits are written in the shared folder before anything reads them.
    """
    scratch = scratch or Scratch(run.sparkSession)
    names = F.create_map(*[F.lit(x) for c in config.channels for x in (c, provider_of(c, web_key))])
    asked = scratch.save(variants(run, vocabulary, config.max_fallbacks).withColumn("provider", names[F.col("discovery_channel")]))
    answers, kept = [], []
    for k in range(config.max_fallbacks + 1):
        now = asked.where(F.col("variant_ord") == k)
        for hits in kept:
            now = now.join(hits.select("original_query_id").distinct(), "original_query_id", "left_anti")
        if k and now.isEmpty():
            break
        answers.append(scratch.save(search(now).withColumn("raw_results", raw_results(F.col("provider"), F.col("payload")))))
        kept.append(scratch.save(keep_best(score_hits(hits_of(answers[-1]), vocabulary), config.results_per_query)))
    return reduce(DataFrame.unionByName, answers), reduce(DataFrame.unionByName, kept)


def selection_summary(bank: DataFrame, selected: DataFrame) -> dict:
    """Totals, and the selected queries by each dimension; ``selected`` has at most the selection's limit of rows."""
    total, rows = bank.count(), [r.asDict() for r in selected.select(*SELECTION_COUNTS.values()).collect()]
    counts = {name: {k: sum(r[d] == k for r in rows) for k in sorted({r[d] for r in rows})} for name, d in SELECTION_COUNTS.items()}
    return {"total_query_bank": total, "selected_queries": len(rows), "skipped_queries": total - len(rows)} | counts


def issue_list(issues: DataFrame, stage: str = "A3") -> list[dict]:
    """The issues of a run with their stage and what they show, in order; there are no more than candidates, references and rules allow."""
    return [{"stage": stage, "type": r["type"], **json.loads(r["details"])} for r in issues.orderBy("type", "id", "details").collect()]


def run_summary(mode: str, status: str, selection: dict, statistics: DataFrame | None, errors: list[dict], candidates: int, domains: dict[str, int], issues: list[dict], config: RunConfig, generated_at: str, outputs: dict[str, str] | None = None, failures: Sequence[str] = ()) -> dict:
    """What a run did, in the form of its summary file."""
    columns = {"requests": 0, "succeeded": 0, "recovered": 0, "failed": 0, "zero": 0, "raw": 0, "hits": 0}
    cover = {"executed": 0, "with_hits": 0, "without_hits": 0, "query_hit_rate": 0.0}
    if statistics is not None:
        count = F.count_if
        s = statistics.agg(F.sum("requests"), count("succeeded"), count("recovered"), count(F.col("errors") > 0), count("zero_results"), F.sum("raw_results"), F.sum("hits")).first()
        columns = dict(zip(columns, [x or 0 for x in s], strict=True))
        cover = coverage(statistics, F.col("hits")).first().asDict()
    kept, filtered = columns["hits"], columns["raw"] - columns["hits"]
    return {
        "generated_at": generated_at, "stage": "A3", "mode": mode, "status": status,
        "total_query_bank": selection["total_query_bank"], "selected_queries": selection["selected_queries"], "skipped_queries": selection["skipped_queries"],
        "executed_queries": cover["executed"], "executed_original_queries": cover["executed"], "executed_search_requests": columns["requests"],
        "queries_with_relevant_results": cover["with_hits"], "queries_without_relevant_results": cover["without_hits"], "query_hit_rate": cover["query_hit_rate"], "minimum_query_hit_rate": config.min_hit_rate,
        "original_queries_succeeded": columns["succeeded"], "queries_recovered_by_fallback": columns["recovered"], "provider_errors": errors, "queries_with_provider_error": columns["failed"], "queries_with_zero_results": columns["zero"],
        "raw_provider_results": columns["raw"], "raw_results": kept, "relevant_results": kept, "relevant_results_kept": kept, "irrelevant_results_filtered": filtered, "irrelevant_filtered": filtered,
        "unique_candidates": candidates, "duplicate_urls_removed": kept - candidates,
        "selection": selection, "by_channel": selection["by_discovery_channel"], "by_language": selection["by_language"], "by_domain": domains, "by_search_region": selection["by_search_region"],
        "audit": {"issue_count": len(issues), "issues": issues}, "errors": list(failures), "outputs": outputs or {},
    }


def flat_hits(kept: DataFrame, retrieved_at: str) -> DataFrame:
    """Kept hits in the form that merge_hits takes, numbered in the order they were found."""
    order = Window.orderBy("selection_rank", "variant_ord", "_rn")
    return kept.select(
        F.row_number().over(order).alias("ord"), F.col("hit.url").alias("url"), *[F.col(f"hit.{c}").alias(c) for c in ("title", "snippet", "doi", "abstract", "subjects")],
        source_type(F.col("hit.url"), F.col("hit.source_type_hint"), F.col("discovery_channel")).alias("source_type"), F.lit(retrieved_at).alias("retrieved_at"),
        F.col("combined_query_id").alias("query_id"), "original_query_id", "original_query_text", "search_variant_text", "search_variant_type", "source_stage", "source_query_id", "query_origin", F.col("search_text").alias("query_text"),
        "language", "discovery_channel", "query_kind", F.col("scope_type").alias("crop_scope"), "crop_key", F.col("weather_scenario").alias("scenario"), "action", "search_region", "result_rank", "provider",
        "relevance_status", "relevance_score", "relevance_reasons", "matched_crop_terms", "matched_scenario_terms", "matched_action_terms",
    )


def discover(bank: DataFrame, vocabulary: Vocabulary, config: RunConfig, search: Callable[[DataFrame], DataFrame], retrieved_at: str, web_key: str | None = None, outputs: dict[str, str] | None = None) -> Run:
    """Select, search, score, merge, audit. ``search`` adds payload and error to variant rows; a SearchProviderError that it raises is the caller's (see failed_run)."""
    scratch = Scratch(bank.sparkSession)
    selected = scratch.save(select_queries(bank, config.selection_limit))
    run = executable(selected, config.channels, config.query_limit)
    answers, kept = search_rounds(run, vocabulary, config, search, web_key, scratch)
    candidates = scratch.save(merge_hits(flat_hits(kept, retrieved_at)))
    statistics = scratch.save(query_statistics(answers, kept))
    issues = scratch.save(audit_relevance_rules(bank.sparkSession, vocabulary).unionByName(audit_candidates(candidates, bank.select(F.col("combined_query_id").alias("query_id")))))
    failed = answers.where(F.col("error").isNotNull()).orderBy("selection_rank", "variant_ord")
    errors = [r.asDict() for r in failed.select("original_query_id", "original_query_text", "search_variant_text", "search_variant_type", "provider", F.lit(config.attempts).alias("attempts"), "error").collect()]
    cover = coverage(statistics, F.col("hits")).first()
    n, listed = candidates.count(), issue_list(issues)
    status = run_status(len(listed), n, cover["executed"], len({e["original_query_id"] for e in errors}), cover["query_hit_rate"], True, config.min_hit_rate)
    summary = run_summary("live", status, selection_summary(bank, selected), statistics, errors, n, domain_counts(candidates), listed, config, retrieved_at, outputs)
    return Run(selected, candidates, issues, statistics, summary)


def failed_run(bank: DataFrame, vocabulary: Vocabulary, config: RunConfig, error: SearchProviderError, generated_at: str, outputs: dict[str, str] | None = None) -> tuple[DataFrame, dict]:
    """The selection and the summary of a run that no provider could serve: nothing was searched."""
    selected = select_queries(bank, config.selection_limit)
    status = "SEARCH_PROVIDER_UNAVAILABLE" if isinstance(error, SearchProviderUnavailable) else "SEARCH_PROVIDER_ERROR"
    listed = issue_list(audit_relevance_rules(bank.sparkSession, vocabulary))
    return selected, run_summary("live", status, selection_summary(bank, selected), None, [], 0, {}, listed, config, generated_at, outputs, [str(error)])


def dry_run(bank: DataFrame, config: RunConfig, issues: DataFrame | None = None, generated_at: str = "") -> tuple[DataFrame, dict]:
    """The selection and its summary; nothing is searched or written."""
    selected = select_queries(bank, config.selection_limit)
    listed = issue_list(issues) if issues is not None else []
    return selected, run_summary("dry_run", run_status(len(listed), 0, 0, 0, 0.0, False), selection_summary(bank, selected), None, [], 0, {}, listed, config, generated_at)


#: A hit about weather only, which must match no crop and be rejected.
PROBE = {"crop_key": "cai_xanh", "weather_scenario": "prolonged_rain", "action": "NONE", "title": "mưa kéo dài ảnh hưởng chăm sóc Việt Nam", "snippet": "mưa kéo dài, mưa liên tục và ngập úng"}


def audit_relevance_rules(spark, vocabulary: Vocabulary) -> DataFrame:
    """(type, id, details): terms that are both a crop's and a scenario's, and faults of the built-in probe."""
    probe = spark.createDataFrame([tuple(PROBE.values())], "crop_key string, weather_scenario string, action string, title string, snippet string")
    hit = F.struct("title", "snippet", F.lit("").alias("abstract"), F.array().cast("array<string>").alias("subjects"))
    scored = score_hits(vocabulary.attach(probe.withColumn("hit", hit)), vocabulary)
    rules = {"A3_SCENARIO_TERM_MATCHED_AS_CROP": F.size("matched_crop_terms") > 0, "A3_WEATHER_ONLY_RESULT_NOT_REJECTED": F.col("relevance_status") != REJECTED}
    return audit(scored, "crop_key", rules, SHOWN).union(audit_vocabularies(spark, vocabulary.crops, vocabulary.scenarios))
