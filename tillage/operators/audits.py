"""Declarative audits: a rule is an issue type, a predicate and the fields it shows; one pass reports all of them.

Every audit gives (type, id, details); details is a JSON object of the fields that the issue shows, with nulls. An empty value
is null or an empty string; a null differs from every value it is compared with. Of rows with the same key the
one with the smallest id is the first.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillage.functions.text import normalize, normalize_public
from tillage.functions.urls import is_valid
from tillage.plans import fixed
from tillage.plans.bank import QUESTION_COLUMNS
from tillage.sources.scratch import Scratch

#: What a candidate and its references may hold.
CHANNELS = ("web", "scholarly")
STATUSES = ("direct_match", "supporting_match", "rejected_irrelevant")
VARIANTS = ("original", "crop_scenario", "crop_scenario_action", "crop_weather_general")
NO_TITLE, FABRICATED = "missing_from_search_result", "fabricated"
SYSTEMATIC_COLUMNS = ("query_id", "search_round", "language", "channel", "priority", "query_kind", "scope_type", "crop_id", "crop_name", "crop_group", "crop_term", "weather_scenario", "weather_factor", "weather_term", "effects", "action", "search_region", "search_region_term", "query")
CANDIDATE_COLUMNS = (
    "candidate_id", "url", "canonical_url", "title", "snippet", "source_domain", "source_type", "doi", "abstract", "subjects", "relevance_status", "relevance_score", "relevance_reasons", "matched_crop_terms", "matched_scenario_terms", "matched_action_terms",
    "language", "discovery_channel", "query_id", "original_query_id", "original_query_text", "search_variant_text", "search_variant_type", "query_text", "crop_scope", "crop_key", "scenario", "action", "search_region", "retrieved_at", "query_references",
)


def empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")) == ""


def outside(name: str, values: Sequence[object]) -> Column:
    return ~F.coalesce(F.col(name).isin(*values), F.lit(False))


def differs(name: str, value: Column) -> Column:
    return ~F.col(name).eqNullSafe(value)


def lookup(pairs: Mapping[str, str], key: Column) -> Column:
    """The value of a key in a small fixed table; null if it isn't there."""
    return F.create_map(*[F.lit(x) for p in pairs.items() for x in p])[key] if pairs else F.lit(None).cast("string")


ISSUE = "type string, id string, details string"
#: What an issue shows where that isn't its row's id alone; "row" is the whole row.
SHOWN = {
    "MISSING_TARGET_CROPS": ("missing",),
    "INVALID_SCENARIO": ("weather_scenario", "missing_field"),
    "UNKNOWN_SCENARIO_ACTION": ("weather_scenario", "action"),
    "MISSING_FIELD": ("field",),
    "EMPTY_QUERY_ID": ("row",),
    "DUPLICATE_QUERY": ("query",),
    "INVALID_LANGUAGE": ("query_id", "language"),
    "INVALID_CHANNEL": ("query_id", "language", "channel"),
    "INVALID_QUERY_KIND": ("query_id", "query_kind"),
    "INVALID_SCOPE_TYPE": ("query_id", "scope_type"),
    "INVALID_CROP_ID": ("query_id", "crop_id"),
    "CROP_NAME_MISMATCH": ("query_id", "crop_id"),
    "INVALID_CROP_GROUP": ("query_id", "crop_group"),
    "INVALID_WEATHER_SCENARIO": ("query_id", "weather_scenario"),
    "EFFECT_QUERY_HAS_ACTION": ("query_id", "action"),
    "INVALID_ROW_ACTION": ("query_id", "action"),
    "INVALID_SEARCH_REGION": ("query_id", "language", "search_region"),
    "SEARCH_REGION_TERM_MISMATCH": ("query_id", "search_region"),
    "MISSING_WEATHER_SCENARIO": ("crop_id", "missing"),
    "A2_MISSING_FIELD": ("field",),
    "A2_EMPTY_QUERY_ID": ("row",),
    "A2_DUPLICATE_NORMALIZED_QUERY": ("query_id", "query_text"),
    "A2_MALFORMED_STAGE": ("query_id", "stage"),
    "A2_INVALID_LANGUAGE": ("query_id", "language"),
    "A2_INVALID_QUERY_ORIGIN": ("query_id", "query_origin"),
    "A2_INVALID_INTENT": ("query_id", "intent"),
    "A2_TRANSFORMED_PARENT_NOT_FOUND": ("query_id", "parent_query_id"),
    "A2_UNKNOWN_CROP_KEY": ("query_id", "crop_key"),
    "A2_UNKNOWN_CROP_GROUP_KEY": ("query_id", "crop_key"),
    "A2_INVALID_CROP_SCOPE": ("query_id", "crop_scope"),
    "A2_INVALID_SEARCH_REGION": ("query_id", "search_region"),
    "A2_SEARCH_REGION_TERM_MISMATCH": ("query_id", "search_region"),
    "A2_UNKNOWN_SCENARIO": ("query_id", "scenario"),
    "A2_UNKNOWN_ACTION": ("query_id", "action"),
    "A2_INCOMPATIBLE_ACTION_SCENARIO": ("query_id", "scenario", "action"),
    "A3_MISSING_FIELD": ("field",),
    "A3_MALFORMED_URL": ("candidate_id", "url"),
    "A3_MALFORMED_CANONICAL_URL": ("candidate_id", "canonical_url"),
    "A3_DUPLICATE_CANONICAL_URL_RECORD": ("candidate_id", "canonical_url"),
    "A3_INVALID_DISCOVERY_CHANNEL": ("candidate_id", "discovery_channel"),
    "A3_INVALID_SEARCH_REGION": ("candidate_id", "search_region"),
    "A3_UNKNOWN_QUERY_ID": ("candidate_id", "query_id"),
    "A3_DEDUP_PROVENANCE_LOST": ("candidate_id", "raw_result_count", "query_reference_count"),
    "A3_INVALID_RELEVANCE_STATUS": ("candidate_id", "relevance_status"),
    "A3_REFERENCE_MISSING_QUERY_ID": ("candidate_id",),
    "A3_REFERENCE_INVALID_SEARCH_VARIANT_TYPE": ("candidate_id", "query_id", "search_variant_type"),
    "A3_CROP_KEYWORD_OVERLAPS_SCENARIO_KEYWORD": ("crop_key", "terms"),
    "A3_SCENARIO_TERM_MATCHED_AS_CROP": ("matched_crop_terms",),
    "A3_WEATHER_ONLY_RESULT_NOT_REJECTED": ("relevance_status",),
}


def shown(fields: Sequence[str], row: Sequence[str] = ()) -> Column:
    """The details of an issue, from columns of the row."""
    return F.to_json(F.struct(*[F.struct(*row).alias("row") if f == "row" else F.col(f) for f in fields]), {"ignoreNullFields": "false"})


def audit(df: DataFrame, ident: str, rules: Mapping[str, Column], show: Mapping[str, Sequence[str]] | None = None, default: Sequence[str] = (), row: Sequence[str] = ()) -> DataFrame:
    """(type, id, details): one row per rule that a row breaks. It shows the columns of ``show`` for its type, else ``default`` (the id)."""
    fields = lambda k: (show or {}).get(k, default or (ident,))
    found = [F.when(F.coalesce(p, F.lit(False)), F.struct(F.lit(k).alias("type"), shown(fields(k), row).alias("details"))) for k, p in rules.items()]
    each = df.select(F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("x"), F.col(ident).alias("id"))
    return each.select("x.type", "id", "x.details")


def exclusive(*steps: tuple[str, Column]) -> dict[str, Column]:
    """Rules of which only the first that applies is reported."""
    out, earlier = {}, F.lit(False)
    for name, p in steps:
        hit = F.coalesce(p, F.lit(False))
        out[name] = hit & ~earlier
        earlier = earlier | hit
    return out


def repeats(df: DataFrame, kind: str, key: Column, ident: str, text: str | None = None) -> DataFrame:
    """(type, id, details) of every row whose key an earlier one has; rows without a key are left out. ``text``: a column that the issue shows.

    Rows are counted by key, id and text before they are shuffled, so a key that very many rows share costs
    a task no more than its distinct ids; the join with the first ones can be split by AQE.
    """
    some = df.select(key.alias("key"), F.struct(F.col(ident).alias(ident), *([F.col(text)] if text else [])).alias("it")).where(F.coalesce(F.col("key"), F.lit("")) != "")
    counted = some.groupBy("key", "it").agg(F.count(F.lit(1)).alias("n"))
    first = counted.groupBy("key").agg(F.min("it").alias("first"), F.sum("n").alias("total")).where("total > 1").select("key", "first")
    more = counted.join(first, "key").select("it.*", (F.col("n") - (F.col("it") == F.col("first")).cast("int")).cast("int").alias("more")).where("more > 0")
    details = shown(SHOWN.get(kind, (ident,)) if text else (ident,))
    named = more.select(F.lit(kind).alias("type"), F.col(ident).alias("id"), details.alias("details"), F.explode(F.sequence(F.lit(1), "more")))
    return named.select("type", "id", "details")


def issues(spark: SparkSession, rows: Sequence[tuple[str, str, dict]]) -> DataFrame:
    """A few issues that are known on the driver: (type, id, what they show)."""
    return spark.createDataFrame([(t, i, json.dumps(d, ensure_ascii=False, separators=(",", ":"))) for t, i, d in rows], ISSUE)


def missing_fields(df: DataFrame, kind: str, fields: Sequence[str]) -> DataFrame:
    """A row for each required column that the table lacks: a table has one schema, so this is checked once."""
    return issues(df.sparkSession, [(kind, f, {"field": f}) for f in fields if f not in df.columns])


def _union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, [p.select("type", F.col("id").cast("string").alias("id"), "details") for p in parts])


def audit_systematic(rows: DataFrame, config: dict) -> DataFrame:
    """Issues of systematic queries against the taxonomy and the crops config."""
    spark, c = rows.sparkSession, F.col
    crops = {x["id"]: x["name_vi"] for x in config.get("crops", [])}
    groups = list(config.get("crop_groups", {}))
    scen = spark.createDataFrame([(s, factor, vi, en, "|".join(effects)) for s, factor, vi, en, effects, _ in fixed.SCENARIOS], "weather_scenario string, _factor string, _vi string, _en string, _effects string")
    regions = spark.createDataFrame([(lang, rid, text) for lang, rid, text, _ in fixed.REGIONS], "language string, search_region string, _region string")
    own = [k for k in rows.columns if not k.startswith("_")]
    # Normal forms are made once: three parts of the audit read them.
    rows = Scratch(spark).save(rows.withColumn("_norm", normalize(c("query"))))
    d = rows.join(F.broadcast(scen), "weather_scenario", "left").join(F.broadcast(regions), ["language", "search_region"], "left")
    language_ok = ~outside("language", list(fixed.CHANNELS))
    specific, group = c("scope_type").eqNullSafe("crop_specific"), c("scope_type").eqNullSafe("crop_group")
    names, known = lookup(crops, c("crop_id")), c("_factor").isNotNull()
    rules = {
        "EMPTY_QUERY_ID": empty("query_id"),
        "EMPTY_QUERY": F.coalesce("_norm", F.lit("")) == "",
        "INVALID_SEARCH_ROUND": differs("search_round", F.lit(1)),
        **exclusive(("INVALID_LANGUAGE", ~language_ok), ("INVALID_CHANNEL", differs("channel", lookup(fixed.CHANNELS, c("language"))))),
        "INVALID_QUERY_KIND": outside("query_kind", ("effect", "action")),
        "INVALID_SCOPE_TYPE": ~specific & ~group,
        "INVALID_CROP_ID": specific & outside("crop_id", list(crops)),
        **exclusive(("MISSING_CROP_NAME", specific & empty("crop_name")), ("CROP_NAME_MISMATCH", specific & names.isNotNull() & differs("crop_name", names))),
        "UNEXPECTED_CROP_GROUP": specific & ~empty("crop_group"),
        "UNEXPECTED_CROP_FIELDS": group & ~(empty("crop_id") & empty("crop_name")),
        "INVALID_CROP_GROUP": group & outside("crop_group", groups),
        "EMPTY_CROP_TERM": empty("crop_term"),
        "INVALID_WEATHER_SCENARIO": ~known,
        "WEATHER_FACTOR_MISMATCH": known & differs("weather_factor", c("_factor")),
        "WEATHER_TERM_MISMATCH": known & differs("weather_term", F.when(c("language") == "vi", c("_vi")).otherwise(c("_en"))),
        "EFFECTS_MISMATCH": known & differs("effects", c("_effects")),
        "EFFECT_QUERY_HAS_ACTION": c("query_kind").eqNullSafe("effect") & differs("action", F.lit(fixed.NO_ACTION)),
        "INVALID_ROW_ACTION": c("query_kind").eqNullSafe("action") & outside("action", [a[0] for a in fixed.ACTIONS]),
        **exclusive(("INVALID_SEARCH_REGION", language_ok & c("_region").isNull()), ("SEARCH_REGION_TERM_MISMATCH", language_ok & (F.coalesce("search_region_term", F.lit("")) != c("_region")))),
    }
    absent_crops = sorted(set(fixed.TARGET_CROPS) - set(crops))
    target = issues(spark, [("MISSING_TARGET_CROPS", ",".join(absent_crops), {"missing": absent_crops})] if absent_crops else [])
    # Each crop of the config is to have every scenario; both sides are small dimensions.
    wanted = spark.createDataFrame([(k,) for k in crops], "crop_id string").crossJoin(scen.select("weather_scenario"))
    absent = wanted.join(rows.select("crop_id", "weather_scenario").distinct(), ["crop_id", "weather_scenario"], "left_anti").groupBy("crop_id").agg(F.sort_array(F.collect_list("weather_scenario")).alias("missing"))
    return _union(
        audit(d, "query_id", rules, SHOWN, row=own), repeats(rows, "DUPLICATE_QUERY_ID", c("query_id"), "query_id"), repeats(rows, "DUPLICATE_QUERY", c("_norm"), "query_id", "query"),
        target, absent.select(F.lit("MISSING_WEATHER_SCENARIO").alias("type"), c("crop_id").alias("id"), shown(SHOWN["MISSING_WEATHER_SCENARIO"]).alias("details")), missing_fields(rows, "MISSING_FIELD", SYSTEMATIC_COLUMNS),
    )


def audit_taxonomy(spark: SparkSession, scenarios: Sequence[tuple] = fixed.SCENARIOS, actions: Sequence[tuple] = fixed.ACTIONS) -> DataFrame:
    """Scenarios with an absent field, and their actions that aren't known."""
    known, fields = {a[0] for a in actions}, ("factor", "vi", "en", "effects", "actions")
    rows = [("INVALID_SCENARIO", s[0], {"weather_scenario": s[0], "missing_field": f}) for s in scenarios for f, x in zip(fields, s[1:], strict=True) if x is None]
    rows += [("UNKNOWN_SCENARIO_ACTION", f"{s[0]}:{a}", {"weather_scenario": s[0], "action": a}) for s in scenarios for a in s[5] or () if a not in known]
    return issues(spark, rows)


def audit_questions(rows: DataFrame, config: dict) -> DataFrame:
    """Issues of natural questions. A transformed question's parent may be any row."""
    spark, c = rows.sparkSession, F.col
    crops, groups = [x["id"] for x in config.get("crops", [])], list(config.get("crop_groups", {}))
    actions = {s: set(a) for s, _, _, _, _, a in fixed.SCENARIOS}
    for s, a in fixed.QUESTION_PAIRS:
        actions[s].add(a)
    pairs = spark.createDataFrame([(s, sorted(a)) for s, a in actions.items()], "scenario string, _allowed array<string>")
    regions = spark.createDataFrame([(rid, text) for lang, rid, text, _ in fixed.REGIONS if lang == "vi"], "search_region string, _region string")
    own = [k for k in rows.columns if not k.startswith("_")]
    rows = Scratch(spark).save(rows.withColumn("_norm", normalize_public(c("query_text"))))
    parents = rows.select(c("query_id").alias("parent_query_id"), F.lit(True).alias("_parent")).where("parent_query_id is not null").distinct()
    d = rows.join(F.broadcast(pairs), "scenario", "left").join(F.broadcast(regions), "search_region", "left").join(parents, "parent_query_id", "left")
    origin, scope = c("query_origin"), c("crop_scope")
    acts = differs("action", F.lit(fixed.NO_ACTION))
    transformed = origin.eqNullSafe("transformed")
    rules = {
        "A2_EMPTY_QUERY_ID": empty("query_id"),
        "A2_EMPTY_QUERY_TEXT": F.coalesce("_norm", F.lit("")) == "",
        "A2_MALFORMED_STAGE": differs("stage", F.lit("A2")),
        "A2_INVALID_LANGUAGE": differs("language", F.lit("vi")),
        "A2_INVALID_QUERY_ORIGIN": outside("query_origin", fixed.ORIGINS),
        "A2_INVALID_INTENT": outside("intent", fixed.INTENTS),
        "A2_OBSERVED_WITHOUT_SOURCE_URL": origin.eqNullSafe("observed") & empty("source_url"),
        **exclusive(("A2_TRANSFORMED_WITHOUT_PARENT_QUERY_ID", transformed & empty("parent_query_id")), ("A2_TRANSFORMED_PARENT_NOT_FOUND", transformed & c("_parent").isNull())),
        "A2_SYNTHETIC_HAS_FAKE_PROVENANCE": origin.eqNullSafe("synthetic") & ~(empty("source_url") & empty("source_title") & empty("parent_query_id")),
        "A2_UNKNOWN_CROP_KEY": scope.eqNullSafe("crop_specific") & outside("crop_key", crops),
        "A2_UNKNOWN_CROP_GROUP_KEY": scope.eqNullSafe("crop_group") & outside("crop_key", groups),
        "A2_INVALID_CROP_SCOPE": outside("crop_scope", ("crop_specific", "crop_group")),
        **exclusive(("A2_INVALID_SEARCH_REGION", c("_region").isNull()), ("A2_SEARCH_REGION_TERM_MISMATCH", differs("search_region_term", c("_region")))),
        "A2_UNKNOWN_SCENARIO": c("_allowed").isNull(),
        "A2_UNKNOWN_ACTION": acts & outside("action", [a[0] for a in fixed.ACTIONS]),
        "A2_INCOMPATIBLE_ACTION_SCENARIO": c("_allowed").isNotNull() & acts & ~F.coalesce(F.array_contains("_allowed", c("action")), F.lit(False)),
    }
    return _union(audit(d, "query_id", rules, SHOWN, row=own), repeats(rows, "A2_DUPLICATE_QUERY_ID", c("query_id"), "query_id"), repeats(rows, "A2_DUPLICATE_NORMALIZED_QUERY", c("_norm"), "query_id", "query_text"), missing_fields(rows, "A2_MISSING_FIELD", QUESTION_COLUMNS))


def audit_candidates(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Issues of candidates and of their query references; ``known`` has the query_ids of the bank."""
    c = F.col
    ids = known.select("query_id", F.lit(True).alias("_known")).where("query_id is not null").distinct()
    refs = c("query_reference_count")
    d = candidates.withColumn("query_reference_count", F.greatest(F.coalesce(F.size("query_references"), F.lit(0)), F.lit(0))).join(ids, "query_id", "left")
    whole = dict(candidates.dtypes).get("relevance_score") in ("tinyint", "smallint", "int", "bigint")
    rules = {
        "A3_EMPTY_URL": empty("url"),
        "A3_MALFORMED_URL": ~F.coalesce(is_valid(c("url")), F.lit(False)),
        **exclusive(("A3_EMPTY_CANONICAL_URL", empty("canonical_url")), ("A3_MALFORMED_CANONICAL_URL", ~F.coalesce(is_valid(c("canonical_url")), F.lit(False)))),
        "A3_INVALID_DISCOVERY_CHANNEL": outside("discovery_channel", CHANNELS),
        "A3_INVALID_SEARCH_REGION": outside("search_region", [r[1] for r in fixed.REGIONS]),
        "A3_EMPTY_SOURCE_DOMAIN": empty("source_domain"),
        **exclusive(("A3_MISSING_QUERY_ID", empty("query_id")), ("A3_UNKNOWN_QUERY_ID", c("_known").isNull())),
        "A3_MISSING_QUERY_PROVENANCE": refs == 0,
        "A3_DEDUP_PROVENANCE_LOST": differs("raw_result_count", refs),
        "A3_EMPTY_TITLE_WITHOUT_STATUS": empty("title") & differs("title_status", F.lit(NO_TITLE)),
        "A3_FABRICATED_TITLE": c("title_status").eqNullSafe(FABRICATED),
        "A3_INVALID_RELEVANCE_STATUS": outside("relevance_status", STATUSES),
        "A3_REJECTED_CANDIDATE_WRITTEN": c("relevance_status").eqNullSafe("rejected_irrelevant"),
        "A3_INVALID_RELEVANCE_SCORE": c("relevance_score").isNull() if whole else F.lit(True),
    }
    valid = candidates.where(F.coalesce(is_valid(c("canonical_url")), F.lit(False)))
    each = candidates.select("candidate_id", F.explode("query_references").alias("r")).select("candidate_id", "r.*")
    each = each.join(ids, "query_id", "left")
    reference = {
        **exclusive(("A3_REFERENCE_MISSING_QUERY_ID", empty("query_id")), ("A3_REFERENCE_UNKNOWN_QUERY_ID", c("_known").isNull())),
        "A3_REFERENCE_MISSING_ORIGINAL_QUERY_ID": empty("original_query_id"),
        "A3_REFERENCE_MISSING_ORIGINAL_QUERY_TEXT": empty("original_query_text"),
        "A3_REFERENCE_MISSING_SEARCH_VARIANT_TEXT": empty("search_variant_text"),
        "A3_REFERENCE_INVALID_SEARCH_VARIANT_TYPE": outside("search_variant_type", VARIANTS),
        "A3_REFERENCE_INVALID_DISCOVERY_CHANNEL": outside("discovery_channel", CHANNELS),
        "A3_REFERENCE_MISSING_SOURCE_STAGE": empty("source_stage"),
        "A3_A2_REFERENCE_MISSING_QUERY_ORIGIN": c("source_stage").eqNullSafe("A2") & outside("query_origin", fixed.ORIGINS),
        "A3_REFERENCE_INVALID_RELEVANCE_STATUS": outside("relevance_status", STATUSES),
    }
    return _union(audit(d, "candidate_id", rules, SHOWN), repeats(valid, "A3_DUPLICATE_CANONICAL_URL_RECORD", c("canonical_url"), "candidate_id", "canonical_url"), audit(each, "candidate_id", reference, SHOWN, ("candidate_id", "query_id")), missing_fields(candidates, "A3_MISSING_FIELD", CANDIDATE_COLUMNS))


def audit_vocabularies(spark: SparkSession, crops: Mapping[str, Sequence[str]], scenarios: Mapping[str, Sequence[str]]) -> DataFrame:
    """Crops with terms that a scenario has too, in normal form: one row each, its id is the crop and those terms."""
    make = lambda v: spark.createDataFrame([(k, t) for k, ts in v.items() for t in ts], "key string, term string").withColumn("norm", normalize(F.col("term")))
    both = make(crops).join(make(scenarios).select("norm").distinct(), "norm", "left_semi").groupBy(F.col("key").alias("crop_key")).agg(F.array_sort(F.collect_set("term")).alias("terms"))
    kind = "A3_CROP_KEYWORD_OVERLAPS_SCENARIO_KEYWORD"
    return both.select(F.lit(kind).alias("type"), F.concat_ws(":", "crop_key", F.array_join("terms", ",")).alias("id"), shown(SHOWN[kind]).alias("details"))
