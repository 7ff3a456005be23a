import dataclasses
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillage.operators.audits import audit_questions, audit_systematic, audit_taxonomy
from tillage.operators.selection import CORE_ACTIONS, SCENARIO_ORDER, capacities, select_queries
from tillage.plans.bank import SEED, questions
from tillage.plans.search import dry_run
from tillage.sources.config import RunConfig, _simple_yaml


def by(df, column):
    return {r[column]: r["count"] for r in df.groupBy(column).count().collect()}


def test_systematic_counts(bank):
    _, a1, _, _ = bank
    assert a1.count() == 3486 == a1.select("query_id").distinct().count()
    assert by(a1, "language") == {"vi": 2324, "en": 1162}
    assert by(a1, "scope_type") == {"crop_specific": 2490, "crop_group": 996}
    assert by(a1, "query_kind") == {"effect": 630, "action": 2856}
    assert by(a1, "search_region") == {"NONE": 747, "VIETNAM": 1162, "BINH_DINH_LEGACY": 415, "GIA_LAI_CURRENT": 415, "GLOBAL": 747}
    assert by(a1, "priority") == {1: 1660, 2: 1494, 3: 332}
    assert by(a1, "weather_scenario")["heavy_rain"] == 294 and by(a1, "weather_scenario")["leaf_wetness"] == 168


def test_question_counts(bank):
    _, _, a2, both = bank
    assert a2.count() == 246 and both.count() == 3732
    assert by(a2, "intent") == {"irrigation_water": 44, "rain_effect": 27, "heat_sunlight": 32, "humidity_disease": 34, "fertilizer_weather": 26, "spraying_weather": 22, "planting_weather": 30, "weather_recovery": 31}
    assert by(a2, "crop_scope") == {"crop_specific": 180, "crop_group": 66}
    assert by(a2, "search_region") == {"NONE": 133, "VIETNAM": 59, "BINH_DINH_LEGACY": 25, "GIA_LAI_CURRENT": 29}


def test_bank_has_no_issues(spark, bank, config):
    _, a1, a2, _ = bank
    assert audit_systematic(a1, config).count() == 0
    assert audit_questions(a2, config).count() == 0
    assert audit_taxonomy(spark).count() == 0


@pytest.mark.parametrize(
    ("column", "value", "issue"),
    [("query", "", "EMPTY_QUERY"), ("language", "fr", "INVALID_LANGUAGE"), ("channel", "radio", "INVALID_CHANNEL"), ("search_round", 2, "INVALID_SEARCH_ROUND"), ("crop_term", "", "EMPTY_CROP_TERM"), ("weather_factor", "snow", "WEATHER_FACTOR_MISMATCH"), ("effects", "x|y", "EFFECTS_MISMATCH"), ("query_id", "", "EMPTY_QUERY_ID")],
)
def test_one_wrong_field_is_one_issue(bank, config, column, value, issue):
    _, a1, _, _ = bank
    one = a1.where("query_kind = 'action' and scope_type = 'crop_specific'").orderBy("query_id").limit(1)
    few = a1.where("query_kind = 'effect'").limit(630)
    changed = one.withColumn(column, F.lit(value)).unionByName(few)
    got = [r.type for r in audit_systematic(changed, config).collect()]
    assert issue in got and set(got) - {issue} <= {"INVALID_SEARCH_REGION", "WEATHER_TERM_MISMATCH", "MISSING_WEATHER_SCENARIO", "SEARCH_REGION_TERM_MISMATCH"}


def test_selection(bank):
    _, _, _, both = bank
    chosen = select_queries(both, 96).cache()
    rows = chosen.collect()
    count = lambda c: dict(Counter(r[c] for r in rows))
    assert len(rows) == 96 and sorted(r.selection_rank for r in rows) == list(range(1, 97))
    assert count("discovery_channel") == {"web": 72, "scholarly": 24} and count("source_stage") == {"A1": 64, "A2": 32}
    assert count("query_kind") == {"action": 34, "effect": 30, "natural_question": 32} and count("scope_type") == {"crop_specific": 72, "crop_group": 24}
    assert count("search_region") == {"VIETNAM": 33, "BINH_DINH_LEGACY": 14, "GIA_LAI_CURRENT": 14, "NONE": 11, "GLOBAL": 24}
    assert capacities(96)["search_region"] == {"VIETNAM": 33, "BINH_DINH_LEGACY": 14, "GIA_LAI_CURRENT": 14, "NONE": 11, "GLOBAL": 24}


def test_small_limits_and_dry_run(bank):
    _, _, _, both = bank
    assert select_queries(both, 5).count() == 5
    with pytest.raises(ValueError):
        select_queries(both, 0)
    selected, summary = dry_run(both, RunConfig(selection_limit=96))
    assert summary["total_query_bank"] == 3732 and summary["skipped_queries"] == 3636 and summary["status"] == "DRY_RUN_READY"
    assert sum(summary["selection"]["by_language"].values()) == 96 == selected.count()


def slow_selection(rows, limit):
    """Ids in rank order, a row at a time over all rows in sort order."""
    at = lambda order, v, other: order.index(v) if v in order else other

    def key(r):
        web = r["discovery_channel"] == "web"
        region = {"VIETNAM": 0, "BINH_DINH_LEGACY": 1, "GIA_LAI_CURRENT": 1, "NONE": 2} if web else {"GLOBAL": 0, "VIETNAM": 1}
        first = 1 if r["source_stage"] == "A2" or (web and r["scope_type"] == "crop_specific") else 2 if web or r["scope_type"] == "crop_specific" else 3
        ranks = (0 if web else 1, at(["A2", "A1"], r["source_stage"], 9), first, at(["natural_question", "action", "effect"], r["query_kind"], 9), at(["crop_specific", "crop_group"], r["scope_type"], 9))
        return (*ranks, region.get(r["search_region"], 9), at(SCENARIO_ORDER, r["weather_scenario"], 15), at(CORE_ACTIONS, r["action"], 10), r["crop_key"], r["query_text"], r["combined_query_id"])

    twin = lambda r: tuple(v for k, v in r.items() if k != "combined_query_id")
    rows = sorted(rows, key=key)
    chosen, twins = {}, set()

    def take(**wanted):
        for r in rows:
            if all(r[k] == v for k, v in wanted.items()):
                if r["combined_query_id"] in chosen:
                    return False
                if twin(r) not in twins:
                    chosen[r["combined_query_id"]] = r
                    twins.add(twin(r))
                    return True
        return False

    keys = {s: sorted({r["crop_key"] for r in rows if r["scope_type"] == s}) for s in ("crop_specific", "crop_group")}
    for i, s in enumerate(SCENARIO_ORDER):
        mine = {"crop_key": keys["crop_specific"][i % len(keys["crop_specific"])], "weather_scenario": s}
        asked = {"discovery_channel": "web", "source_stage": "A2", "query_kind": "natural_question"}
        take(**asked, scope_type="crop_specific", **mine) or take(**asked, weather_scenario=s)
        for c in ("web", "scholarly"):
            effect = {"discovery_channel": c, "source_stage": "A1", "scope_type": "crop_specific", "query_kind": "effect"}
            take(**effect, **mine) or take(**effect, weather_scenario=s)
    action = {"discovery_channel": "web", "source_stage": "A1", "query_kind": "action"}
    for scope in ("crop_specific", "crop_group"):
        for k in keys[scope]:
            take(**action, scope_type=scope, crop_key=k)
    for region in ("VIETNAM", "BINH_DINH_LEGACY", "GIA_LAI_CURRENT", "NONE"):
        take(**action, search_region=region)
    caps = capacities(limit)
    for r in rows:
        n = len(chosen)
        if n >= limit:
            break
        count = lambda d: sum(x[d] == r[d] for x in chosen.values())  # noqa: B023, E731
        open_ = all(count(d) < caps[d].get(r[d], 10**9) for d in caps) and count("weather_scenario") < max(3, n // 15 + 4) and count("crop_key") < max(6, n // 8 + 8)
        if r["combined_query_id"] not in chosen and twin(r) not in twins and open_:
            chosen[r["combined_query_id"]] = r
            twins.add(twin(r))
    return list(chosen)[:limit]


@pytest.mark.parametrize("page", [1, 12])
def test_selection_equals_a_pass_over_all_rows(spark, page):
    """Few values and many twins, so that rows are refused, caps grow, and combinations run out of fetched rows."""
    rng = random.Random(page)
    rows = []
    for i in range(500):
        web = rng.random() < 0.7
        rows.append({
            "combined_query_id": f"CQ-{i:04d}", "discovery_channel": "web" if web else "scholarly", "language": "vi" if web else "en", "source_stage": rng.choice(["A1", "A2"]), "query_kind": rng.choice(["effect", "action", "natural_question"]),
            "scope_type": rng.choice(["crop_specific", "crop_group"]), "crop_key": rng.choice(["a", "b", "c"]), "weather_scenario": rng.choice(["heavy_rain", "dry_spell", "strong_wind", "fog"]), "action": rng.choice(["irrigation", "shade"]),
            "search_region": rng.choice(["VIETNAM", "NONE", "GLOBAL"]), "query_text": rng.choice(["one", "two", "three", "four"]),
        })
    bank = spark.createDataFrame([{k: v for k, v in r.items() if k != "discovery_channel"} | {"channel": r["discovery_channel"], "query_origin": ""} for r in rows])
    for limit in (96, 40):
        got = [r.combined_query_id for r in select_queries(bank, limit, page).orderBy("selection_rank").collect()]
        assert got == slow_selection(rows, limit)


def test_unknown_crop_keys_are_errors(bank):
    t, _, _, _ = bank
    with pytest.raises(Exception, match="no crop or group"):
        questions(dataclasses.replace(t, scopes=t.scopes.where("crop_key <> 'ngo'"))).count()


def test_observed_and_transformed_questions(spark, bank, config):
    t, _, _, _ = bank
    seen = [("cải xanh có sao không", "rain_effect", "heavy_rain", "NONE", "crop_specific", "cai_xanh", "NONE", "http://x.org/1", "Forum", "")]
    observed = spark.createDataFrame(seen, SEED)
    parent = questions(t, observed).where("query_origin = 'observed'").first().query_id
    changed = spark.createDataFrame([("cải xanh thế nào sau mưa", "rain_effect", "post_rain", "NONE", "crop_specific", "cai_xanh", "VIETNAM", "", "", parent), ("lạc loài", "rain_effect", "post_rain", "NONE", "crop_specific", "cai_xanh", "NONE", "", "", "A2Q-NONE")], SEED)
    every = questions(t, observed, changed)
    got = {r.query_text: (r.source_url, r.source_title) for r in every.where("query_origin = 'transformed'").collect()}
    assert got == {"cải xanh thế nào sau mưa": ("http://x.org/1", "Forum"), "lạc loài": ("", "")}
    issues = sorted(r.type for r in audit_questions(every, config).collect())
    assert issues == ["A2_TRANSFORMED_PARENT_NOT_FOUND"]


def test_yaml_without_a_library():
    text = "a: 1\nlist:\n  - id: x\n    names:\n      - one\n      - two\n  - id: y\n    names:\n      - three\nmap:\n  k:\n    v: w\nlong: >\n  some words\n  more\n"
    assert _simple_yaml(text) == {"a": 1, "list": [{"id": "x", "names": ["one", "two"]}, {"id": "y", "names": ["three"]}], "map": {"k": {"v": "w"}}, "long": "some words more"}
