"""The query bank: systematic queries, natural questions, and their first-wins union."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillage.functions.text import english_query, local_query, normalize, normalize_public, nonempty, question, signature, stable_id
from tillage.operators.tables import first_wins, ordered_union
from tillage.plans import fixed

QUESTION_COLUMNS = ("query_id", "query_text", "language", "stage", "query_origin", "intent", "scenario", "action", "crop_scope", "crop_key", "search_region", "search_region_term", "source_url", "source_title", "parent_query_id")
SEED = "query_text string, intent string, scenario string, action string, crop_scope string, crop_key string, search_region string, source_url string, source_title string, parent_query_id string"


@dataclass(frozen=True)
class Taxonomy:
    """Small dimension tables, one row each per crop or group, scenario, pair, action, region, template."""

    scopes: DataFrame
    scenarios: DataFrame
    pairs: DataFrame
    actions: DataFrame
    regions: DataFrame
    templates: DataFrame


def taxonomy(spark: SparkSession, config: dict) -> Taxonomy:
    """From a crops config (see tillage.sources.config.load_config) and the fixed tables."""
    scopes, order = [], 0
    for c in config.get("crops", []):
        scopes.append((order, "crop_specific", c["id"], c["id"], c["name_vi"], "", c["aliases_vi"][0], c["scientific_name"]))
        order += 1
    for key, g in config.get("crop_groups", {}).items():
        scopes.append((order, "crop_group", key, "", "", key, g["aliases_vi"][0], g["aliases_en"][0]))
        order += 1
    scenarios = [(i, s, factor, vi, en, list(effects), list(actions)) for i, (s, factor, vi, en, effects, actions) in enumerate(fixed.SCENARIOS)]
    pairs = {(s, a) for s, _, _, _, _, actions in fixed.SCENARIOS for a in actions} | set(fixed.QUESTION_PAIRS)
    templates = [
        (i, intent, text, s, a, scope, list(keys), list(regions))
        for i, (intent, text, s, a, scope, keys, regions) in enumerate(fixed.QUESTIONS)
    ]
    make = spark.createDataFrame
    return Taxonomy(
        make(scopes, "scope_ord int, scope_type string, crop_key string, crop_id string, crop_name string, crop_group string, term_vi string, term_en string"),
        make(scenarios, "scenario_ord int, weather_scenario string, weather_factor string, weather_vi string, weather_en string, effects array<string>, actions array<string>"),
        make(sorted(pairs), "scenario string, action string"),
        make(fixed.ACTIONS, "action string, action_vi string, action_en string"),
        make([(i, *r) for i, r in enumerate(fixed.REGIONS)], "region_ord int, language string, search_region string, search_region_term string, region_priority int"),
        make(templates, "template_ord int, intent string, template string, scenario string, action string, crop_scope string, crop_keys array<string>, search_regions array<string>"),
    )


def expand(t: Taxonomy) -> DataFrame:
    """Scopes x scenarios x (effect or one of the scenario's actions) x the language's regions: not deduplicated.

    The dimensions hold tens of rows and are broadcast. Groups take fewer regions, which is part
    of the join condition and so never expanded.
    """
    kinds = F.posexplode(F.concat(F.array(F.lit("")), F.col("actions"))).alias("kind_ord", "action_id")
    per_scenario = t.scenarios.select("*", kinds).join(F.broadcast(t.actions), F.col("action_id") == F.col("action"), "left").drop("action")
    few = reduce(lambda a, b: a | b, [(F.col("language") == k) & F.col("search_region").isin(*v) for k, v in fixed.GROUP_REGIONS.items()])
    rows = t.scopes.crossJoin(F.broadcast(per_scenario)).join(F.broadcast(t.regions), (F.col("scope_type") == "crop_specific") | few)
    vi, effect = F.col("language") == "vi", F.col("action_id") == ""
    phrase = lambda k: F.when(effect, fixed.EFFECT_PHRASE[k]).otherwise(F.col(f"action_{k}"))
    group_priority = F.when(vi, fixed.GROUP_PRIORITY["vi"]).otherwise(fixed.GROUP_PRIORITY["en"])
    region = F.col("search_region_term")
    return rows.select(
        F.lit(1).alias("search_round"),
        "language",
        F.when(vi, fixed.CHANNELS["vi"]).otherwise(fixed.CHANNELS["en"]).alias("channel"),
        F.when(F.col("scope_type") == "crop_group", group_priority).otherwise(F.col("region_priority")).alias("priority"),
        F.when(effect, "effect").otherwise("action").alias("query_kind"),
        "scope_type",
        "crop_id",
        "crop_name",
        "crop_group",
        F.when(vi, F.col("term_vi")).otherwise(F.col("term_en")).alias("crop_term"),
        "weather_scenario",
        "weather_factor",
        F.when(vi, F.col("weather_vi")).otherwise(F.col("weather_en")).alias("weather_term"),
        F.array_join("effects", "|").alias("effects"),
        F.when(effect, fixed.NO_ACTION).otherwise(F.col("action_id")).alias("action"),
        "search_region",
        "search_region_term",
        F.when(vi, local_query(F.col("term_vi"), F.col("weather_vi"), phrase("vi"), region)).otherwise(english_query(F.col("term_en"), F.col("weather_en"), phrase("en"), region)).alias("query"),
        F.struct("scope_ord", "scenario_ord", F.when(vi, 0).otherwise(1).alias("lang_ord"), "kind_ord", "region_ord").alias("ord"),
    )


def systematic(t: Taxonomy) -> DataFrame:
    """The first row of each normalised query, with its id, sorted; ord keeps the final order."""
    unique = first_wins(expand(t), normalize(F.col("query")), F.col("ord")).drop("ord")
    order = ["priority", "language", "scope_type", "crop_id", "crop_group", "weather_scenario", "query_kind", "action", "search_region"]
    return unique.select(stable_id("DQ-", normalize(F.col("query"))).alias("query_id"), *unique.columns, F.array(*[F.col(c).cast("string") for c in order]).alias("ord"))


def question_rows(t: Taxonomy, seeds: DataFrame, origin: str) -> DataFrame:
    """Question rows of one origin from seed rows (schema SEED, and ord)."""
    text = F.trim(F.col("query_text"))
    regions = t.regions.where("language = 'vi'").select("search_region", F.col("search_region_term").alias("_term"))
    return seeds.join(F.broadcast(regions), "search_region", "left").select(
        stable_id("A2Q-", F.concat(F.lit("A2|"), normalize_public(text))).alias("query_id"), text.alias("query_text"), F.lit("vi").alias("language"), F.lit("A2").alias("stage"), F.lit(origin).alias("query_origin"),
        "intent", "scenario", "action", "crop_scope", "crop_key", "search_region", F.coalesce("_term", F.lit("")).alias("search_region_term"), "source_url", "source_title", "parent_query_id", "ord",
    )


def synthetic_seeds(t: Taxonomy) -> DataFrame:
    """Templates x their keys x their regions, with the first local term of each key filled in. A key that the taxonomy lacks is an error."""
    each = t.templates.select("*", F.posexplode("crop_keys").alias("key_ord", "crop_key")).select("*", F.posexplode("search_regions").alias("near_ord", "search_region"))
    terms = t.scopes.select(F.col("scope_type").alias("crop_scope"), "crop_key", "term_vi")
    regions = t.regions.where("language = 'vi'").select("search_region", "search_region_term")
    joined = each.join(F.broadcast(terms), ["crop_scope", "crop_key"], "left").join(F.broadcast(regions), "search_region")
    none = F.lit("")
    unknown = F.raise_error(F.concat_ws(" ", F.lit("no crop or group for"), "crop_scope", "crop_key")).cast("string")
    return joined.select(
        question(F.col("template"), F.coalesce("term_vi", unknown), F.col("search_region_term")).alias("query_text"), "intent", "scenario", "action", "crop_scope", "crop_key", "search_region",
        none.alias("source_url"), none.alias("source_title"), none.alias("parent_query_id"), F.struct("template_ord", "key_ord", "near_ord").alias("ord"),
    )


def inherit_provenance(transformed: DataFrame, observed: DataFrame) -> DataFrame:
    """Blank source_url and source_title come from the observed parent; without one they stay blank."""
    parents = observed.select(F.col("query_id").alias("parent_query_id"), F.col("source_url").alias("_url"), F.col("source_title").alias("_title"))
    take = lambda own, parent: F.coalesce(nonempty(F.col(own), F.lit(None)), F.col(parent), F.lit("")).alias(own)
    rest = [c for c in transformed.columns if c not in ("source_url", "source_title")]
    return transformed.join(parents, "parent_query_id", "left").select(*rest, take("source_url", "_url"), take("source_title", "_title"))


def questions(t: Taxonomy, observed: DataFrame | None = None, transformed: DataFrame | None = None) -> DataFrame:
    """Observed, transformed and synthetic questions; the first of each public normal form stays."""
    spark = t.scopes.sparkSession
    empty = spark.createDataFrame([], SEED)
    keyed = lambda d: (d if d is not None else empty).withColumn("ord", F.struct(F.monotonically_increasing_id().alias("n"), F.lit(0).alias("key_ord"), F.lit(0).alias("near_ord")))
    seen = question_rows(t, keyed(observed), "observed")
    changed = inherit_provenance(question_rows(t, keyed(transformed), "transformed"), seen).select(*seen.columns)
    made = question_rows(t, synthetic_seeds(t).withColumn("ord", F.struct(F.col("ord.template_ord").cast("long").alias("n"), "ord.key_ord", "ord.near_ord")), "synthetic")
    unique = ordered_union([seen, changed, made], normalize_public(F.col("query_text")), "ord").drop("ord")
    order = ["query_origin", "intent", "crop_scope", "crop_key", "scenario", "action", "search_region", "query_text"]
    return unique.withColumn("ord", F.array(*order))


def combined(a1: DataFrame, a2: DataFrame) -> DataFrame:
    """The common form of both, systematic rows first, the first of each public normal form."""
    one = a1.select(
        F.lit("A1").alias("source_stage"), F.col("query_id").alias("source_query_id"), F.col("query").alias("query_text"), "language", "channel", "query_kind", "scope_type",
        nonempty(F.col("crop_id"), F.col("crop_group")).alias("crop_key"), "weather_scenario", "action", "search_region", F.lit("").alias("query_origin"), "ord",
    )
    two = a2.select(
        F.lit("A2").alias("source_stage"), F.col("query_id").alias("source_query_id"), "query_text", "language", F.lit("public_query").alias("channel"), F.lit("natural_question").alias("query_kind"), F.col("crop_scope").alias("scope_type"),
        "crop_key", F.col("scenario").alias("weather_scenario"), "action", "search_region", "query_origin", "ord",
    )
    rows = ordered_union([one, two], normalize_public(F.col("query_text")), "ord").drop("ord")
    return rows.select(stable_id("CQ-", normalize_public(F.col("query_text"))).alias("combined_query_id"), *rows.columns)


def near_duplicate(channel: Column, text: Column | None = None) -> Column:
    """Rows that agree on all of this are near duplicates for the selection; ``text``: the signature, if it is there already."""
    sig = signature(F.col("query_text")) if text is None else text
    return F.struct(channel.alias("channel"), "language", "source_stage", "query_kind", "scope_type", "crop_key", "weather_scenario", "action", "search_region", sig.alias("text"))
