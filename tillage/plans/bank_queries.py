"""Registered queries over a whole bank: expansion, ids, selection, rounds of a run, audits, files.

The taxonomy comes from the small tables: nations are crops, regions crop groups, brands weather
scenarios and event types actions. Rows with planted faults are made by expressions that Spark and
the oracle's engine read alike; the rules that find the faults are written anew in each oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillage.functions import text
from tillage.operators import audits, candidates, selection, tables
from tillage.operators.order import positions
from tillage.plans import bank, catalog, fixed, outputs, search
from tillage.plans.bank import Taxonomy
from tillage.plans.registry import ORACLES, query, sql_id, sql_normalize, sql_public, sql_signature, table
from tillage.sources import files
from tillage.sources.config import RunConfig
from tillage.sources.scratch import Scratch

# ---- the bank ----


def taxonomy_of(spark: SparkSession, sf_dir: str) -> Taxonomy:
    """Nations, regions, brands and event types as a taxonomy."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    crop, group, none = F.concat(F.lit("n"), "n_nationkey"), F.concat(F.lit("r"), "r_regionkey"), F.lit("")
    term = F.when(F.col("n_nationkey") % 7 == 0, "Common crop").otherwise(F.col("n_name"))
    columns = ("scope_ord", "scope_type", "crop_key", "crop_id", "crop_name", "crop_group", "term_vi", "term_en")
    crops = n.select(F.col("n_nationkey").cast("int"), F.lit("crop_specific"), crop, crop, "n_name", none, term, F.lower(term)).toDF(*columns)
    groups = r.select((F.col("r_regionkey") + 100).cast("int"), F.lit("crop_group"), group, none, none, group, "r_name", F.lower("r_name")).toDF(*columns)
    kinds = table(spark, sf_dir, "events").agg(F.array_sort(F.collect_set("event_type")).alias("kinds"))
    brands = table(spark, sf_dir, "part").select("p_brand").distinct().withColumn("scenario_ord", F.row_number().over(Window.orderBy("p_brand")) - 1)
    scenarios = brands.crossJoin(F.broadcast(kinds)).select(
        "scenario_ord", F.col("p_brand").alias("weather_scenario"), F.concat(F.lit("f"), F.col("scenario_ord") % 3).alias("weather_factor"), F.concat("p_brand", F.lit(" mưa")).alias("weather_vi"), F.concat("p_brand", F.lit(" rain")).alias("weather_en"),
        F.array(F.lit("wet"), F.concat(F.lit("e"), F.col("scenario_ord") % 4)).alias("effects"), F.slice("kinds", F.lit(1), F.col("scenario_ord") % 3 + 1).alias("actions"),
    )
    actions = table(spark, sf_dir, "events").select("event_type").distinct().select(F.col("event_type").alias("action"), F.concat("event_type", F.lit(" vi")).alias("action_vi"), F.upper("event_type").alias("action_en"))
    pairs = scenarios.select(F.col("weather_scenario").alias("scenario"), F.explode("actions").alias("action"))
    regions = spark.createDataFrame([(i, *x) for i, x in enumerate(fixed.REGIONS)], "region_ord int, language string, search_region string, search_region_term string, region_priority int")
    k = F.col("r_regionkey")
    keys = F.when(k % 2 == 0, F.array(F.concat(F.lit("n"), k), F.concat(F.lit("n"), k + 5))).otherwise(F.array(F.concat(F.lit("r"), k), F.concat(F.lit("r"), (k + 1) % 5)))
    templates = r.select(
        k.cast("int").alias("template_ord"), F.concat(F.lit("i"), k % 3).alias("intent"), F.concat(F.lit("does {crop} in "), "r_name", F.lit(" need care?")).alias("template"), F.lit("s").alias("scenario"), F.lit("NONE").alias("action"),
        F.when(k % 2 == 0, "crop_specific").otherwise("crop_group").alias("crop_scope"), keys.alias("crop_keys"), F.array(F.lit("NONE"), F.lit("VIETNAM")).alias("search_regions"),
    )
    return Taxonomy(crops.union(groups), scenarios, pairs, actions, regions, templates)


SQL_BANK = f"""
scopes AS (SELECT n_nationkey AS so, 'crop_specific' AS scope_type, 'n' || n_nationkey AS crop_key, 'n' || n_nationkey AS crop_id, n_name AS crop_name, '' AS crop_group, CASE WHEN n_nationkey % 7 = 0 THEN 'Common crop' ELSE n_name END AS vi FROM nation
  UNION ALL SELECT 100 + r_regionkey, 'crop_group', 'r' || r_regionkey, '', '', 'r' || r_regionkey, r_name FROM region),
acts AS (SELECT event_type AS a, row_number() OVER (ORDER BY event_type) AS k FROM (SELECT DISTINCT event_type FROM events)),
scen AS (SELECT p_brand AS s, row_number() OVER (ORDER BY p_brand) - 1 AS o FROM (SELECT DISTINCT p_brand FROM part)),
kinds AS (SELECT s, o, '' AS a, 0 AS k FROM scen UNION ALL SELECT s, o, a, k FROM scen JOIN acts ON k <= o % 3 + 1),
regions(ro, language, id, term, priority) AS (VALUES (0, 'vi', 'NONE', '', 1), (1, 'vi', 'VIETNAM', 'Việt Nam', 1), (2, 'vi', 'BINH_DINH_LEGACY', 'Bình Định', 1), (3, 'vi', 'GIA_LAI_CURRENT', 'Gia Lai', 1), (4, 'en', 'GLOBAL', '', 2), (5, 'en', 'VIETNAM', 'Vietnam', 2)),
wide AS (SELECT * FROM scopes, kinds, regions WHERE scope_type = 'crop_specific' OR (language = 'vi' AND id IN ('NONE', 'VIETNAM')) OR (language = 'en' AND id = 'GLOBAL')),
bank AS (SELECT 1 AS search_round, language, CASE language WHEN 'vi' THEN 'web' ELSE 'scholarly' END AS channel, CASE WHEN scope_type = 'crop_specific' THEN priority WHEN language = 'vi' THEN 2 ELSE 3 END AS priority, CASE a WHEN '' THEN 'effect' ELSE 'action' END AS query_kind, scope_type, crop_key, crop_id, crop_name, crop_group,
  CASE language WHEN 'vi' THEN vi ELSE lower(vi) END AS crop_term, s AS weather_scenario, 'f' || (o % 3) AS weather_factor, s || CASE language WHEN 'vi' THEN ' mưa' ELSE ' rain' END AS weather_term, 'wet|e' || (o % 4) AS effects, CASE a WHEN '' THEN 'NONE' ELSE a END AS action, id AS search_region, term AS search_region_term,
  CASE language WHEN 'vi' THEN '"' || vi || '" "' || s || ' mưa" ' || CASE a WHEN '' THEN 'ảnh hưởng chăm sóc' ELSE a || ' vi' END ELSE lower(vi) || ' ' || s || ' rain ' || CASE a WHEN '' THEN 'agronomic effects management' ELSE upper(a) END END || CASE term WHEN '' THEN '' ELSE ' ' || term END AS query,
  so, o, CASE language WHEN 'vi' THEN 0 ELSE 1 END AS lo, k, ro FROM wide),
a1 AS (SELECT {sql_id('DQ-', sql_normalize('query'))} AS query_id, * FROM (SELECT *, row_number() OVER (PARTITION BY {sql_normalize('query')} ORDER BY so, o, lo, k, ro) AS rn FROM bank) WHERE rn = 1),
templates AS (SELECT r_regionkey AS t, 'i' || (r_regionkey % 3) AS intent, r_name, CASE WHEN r_regionkey % 2 = 0 THEN 'crop_specific' ELSE 'crop_group' END AS crop_scope,
  CASE WHEN r_regionkey % 2 = 0 THEN ['n' || r_regionkey, 'n' || (r_regionkey + 5)] ELSE ['r' || r_regionkey, 'r' || ((r_regionkey + 1) % 5)] END AS keys FROM region),
seeds AS (SELECT t, i.i AS ko, intent, crop_scope, keys[i.i] AS crop_key, g.id AS search_region, g.term AS search_region_term, g.ro, 'does ' || sc.vi || ' in ' || r_name || ' need care?' || CASE g.term WHEN '' THEN '' ELSE ' ' || g.term END AS query_text
  FROM templates, (VALUES (1), (2)) i(i), regions g, scopes sc WHERE g.language = 'vi' AND g.id IN ('NONE', 'VIETNAM') AND sc.crop_key = keys[i.i] AND sc.scope_type = crop_scope),
a2 AS (SELECT {sql_id('A2Q-', "concat('A2|', " + sql_public('query_text') + ")")} AS query_id, * FROM (SELECT *, row_number() OVER (PARTITION BY {sql_public('query_text')} ORDER BY t, ko, ro) AS rn FROM seeds) WHERE rn = 1)
"""
BANK_COLUMNS = ("search_round", "language", "channel", "priority", "query_kind", "scope_type", "crop_id", "crop_name", "crop_group", "crop_term", "weather_scenario", "weather_factor", "weather_term", "effects", "action", "search_region", "search_region_term", "query")


@query("bank_cross_product", f"WITH {SQL_BANK} SELECT {', '.join(BANK_COLUMNS)} FROM bank")
def bank_cross_product(spark, sf_dir):
    """Crops and groups x scenarios x effect or actions x regions."""
    return bank.expand(taxonomy_of(spark, sf_dir)).select(*BANK_COLUMNS)


@query("bank_systematic", f"WITH {SQL_BANK} SELECT query_id, {', '.join(BANK_COLUMNS)} FROM a1")
def bank_systematic(spark, sf_dir):
    return bank.systematic(taxonomy_of(spark, sf_dir)).select("query_id", *BANK_COLUMNS)


@query("bank_systematic_order", f"WITH {SQL_BANK} SELECT query_id, row_number() OVER (ORDER BY CAST(priority AS VARCHAR), language, scope_type, crop_id, crop_group, weather_scenario, query_kind, action, search_region, query_id) AS place FROM a1")
def bank_systematic_order(spark, sf_dir):
    """Each query's place in the sorted bank."""
    rows = positions(bank.systematic(taxonomy_of(spark, sf_dir)).select("query_id", "ord"), F.struct("ord", "query_id"), keep=["query_id"])
    return rows.select("query_id", (F.col("position") + 1).alias("place"))


@query("bank_questions_order", f"WITH {SQL_BANK} SELECT query_id, row_number() OVER (ORDER BY intent, crop_scope, crop_key, search_region, query_text, query_id) AS place FROM a2")
def bank_questions_order(spark, sf_dir):
    """Each question's place in the sorted bank; all are synthetic and have one scenario and action here."""
    rows = positions(bank.questions(taxonomy_of(spark, sf_dir)).select("query_id", "ord"), F.struct("ord", "query_id"), keep=["query_id"])
    return rows.select("query_id", (F.col("position") + 1).alias("place"))


@query("bank_template_expand", f"WITH {SQL_BANK} SELECT query_text, intent, crop_scope, crop_key, search_region FROM seeds")
def bank_template_expand(spark, sf_dir):
    """Templates x their keys x their regions."""
    return bank.synthetic_seeds(taxonomy_of(spark, sf_dir)).select("query_text", "intent", "crop_scope", "crop_key", "search_region")


@query("bank_questions", f"WITH {SQL_BANK} SELECT query_id, query_text, 'vi' AS language, 'A2' AS stage, 'synthetic' AS query_origin, intent, 's' AS scenario, 'NONE' AS action, crop_scope, crop_key, search_region, search_region_term, '' AS source_url, '' AS source_title, '' AS parent_query_id FROM a2")
def bank_questions(spark, sf_dir):
    return bank.questions(taxonomy_of(spark, sf_dir)).drop("ord")


SQL_COMBINED = f"""
both_ AS (SELECT 0 AS p, 'A1' AS source_stage, query_id AS source_query_id, query AS query_text, language, channel, query_kind, scope_type, crop_key, weather_scenario, action, search_region, '' AS query_origin, so * 1000000 + o * 1000 + lo * 500 + k * 10 + ro AS r FROM a1
  UNION ALL SELECT 1, 'A2', query_id, query_text, 'vi', 'public_query', 'natural_question', crop_scope, crop_key, 's', 'NONE', search_region, 'synthetic', t * 100 + ko * 10 + ro FROM a2),
combined AS (SELECT {sql_id('CQ-', sql_public('query_text'))} AS combined_query_id, * FROM (SELECT *, row_number() OVER (PARTITION BY {sql_public('query_text')} ORDER BY p, r) AS rn FROM both_) WHERE rn = 1)
"""
COMBINED_COLUMNS = ("combined_query_id", "source_stage", "source_query_id", "query_text", "language", "channel", "query_kind", "scope_type", "crop_key", "weather_scenario", "action", "search_region", "query_origin")


@query("bank_combined_union", f"WITH {SQL_BANK}, {SQL_COMBINED} SELECT {', '.join(COMBINED_COLUMNS)} FROM combined")
def bank_combined_union(spark, sf_dir):
    """Both parts of the bank in their common form, the first of each public normal form."""
    t = taxonomy_of(spark, sf_dir)
    return bank.combined(bank.systematic(t), bank.questions(t)).select(*COMBINED_COLUMNS)


def _sql_counts(part: str, rows: str, dims: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{part}' AS part, '{name}' AS name, CAST({d} AS VARCHAR) AS key, count(*) AS n FROM {rows} GROUP BY ALL" for name, d in dims.items())


_A1_DIMS = {"by_language": "language", "by_channel": "channel", "by_scope": "scope_type", "by_query_kind": "query_kind", "by_search_region": "search_region", "by_weather_scenario": "weather_scenario"}
_A2_DIMS = {"by_intent": "intent", "by_crop_scope": "crop_scope", "by_search_region": "search_region"}
SQL_SUMMARY = f"""WITH {SQL_BANK}, {SQL_COMBINED}
{_sql_counts('a1', 'a1', _A1_DIMS)} UNION ALL {_sql_counts('a2', 'a2', _A2_DIMS)}
UNION ALL SELECT 'a2', 'by_query_origin', o, CASE o WHEN 'synthetic' THEN (SELECT count(*) FROM a2) ELSE 0 END FROM (VALUES ('observed'), ('transformed'), ('synthetic')) t(o)
UNION ALL SELECT 'a2', 'queries_with_region', '', count(*) FILTER (search_region <> 'NONE') FROM a2 UNION ALL SELECT 'a2', 'queries_without_region', '', count(*) FILTER (search_region = 'NONE') FROM a2
UNION ALL SELECT 'bank', 'a1_query_count', '', count(*) FROM a1 UNION ALL SELECT 'bank', 'a2_query_count', '', count(*) FROM a2 UNION ALL SELECT 'bank', 'combined_unique_query_count', '', count(*) FROM combined
UNION ALL SELECT 'bank', 'crop_count', '', count(*) FROM nation
UNION ALL SELECT 'bank', 'status', 'NEEDS_REVIEW', 1 UNION ALL SELECT 'a1', 'status', 'REVIEW_REQUIRED', 1 UNION ALL SELECT 'a2', 'status', 'READY_FOR_A3', 1
"""


@query("bank_summary", SQL_SUMMARY)
def bank_summary(spark, sf_dir):
    """The bank's summary: counts by every dimension, with and without region, totals and statuses (with one issue in A1)."""
    t, scratch = taxonomy_of(spark, sf_dir), Scratch(spark)
    a1, a2 = scratch.save(bank.systematic(t)), scratch.save(bank.questions(t))
    made = outputs.bank_summary(a1, a2, bank.combined(a1, a2).count(), t.scopes.where("scope_type = 'crop_specific'").count(), {"A1": [{"stage": "A1", "type": "X"}], "A2": []}, "2024-01-01T00:00:00Z")
    rows = [(part, name, k, n) for part in ("a1", "a2") for name, v in made[part].items() if name.startswith("by_") for k, n in v.items()]
    rows += [("a2", name, "", made["a2"][name]) for name in ("queries_with_region", "queries_without_region")]
    rows += [("bank", name, "", made[name]) for name in ("a1_query_count", "a2_query_count", "combined_unique_query_count", "crop_count")]
    rows += [("bank", "status", made["status"], 1), ("a1", "status", made["a1"]["status"], 1), ("a2", "status", made["a2"]["status"], 1)]
    return spark.createDataFrame(rows, "part string, name string, key string, n long")


SQL_REPRESENTATIVES = """WITH r AS (SELECT o_orderkey AS k, o_orderkey % 31 AS i, lpad(CAST(o_orderkey * 7919 % 100003 AS VARCHAR), 6, '0') AS ord FROM orders),
one AS (SELECT part, n, i, k, row_number() OVER (PARTITION BY part, i ORDER BY ord, k) AS rn, ord FROM r, (VALUES ('A1', 20), ('A2', 24)) t(part, n)),
picked AS (SELECT part, n, k, CASE WHEN i < n AND rn = 1 THEN i END AS c, ord FROM one)
SELECT part, k, place FROM (SELECT part, n, k, row_number() OVER (PARTITION BY part ORDER BY c NULLS LAST, ord, k) AS place FROM picked) WHERE place <= n + 5"""


@query("bank_representatives", SQL_REPRESENTATIVES)
def bank_representatives(spark, sf_dir):
    """The representatives of systematic queries and of questions, and five further rows; orders take the values of a criterion by their key."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("query_id"), (F.col("o_orderkey") % 31).alias("i"), F.lpad((F.col("o_orderkey") * 7919 % 100003).cast("string"), 6, "0").alias("ord"))
    out = []
    for part in ("A1", "A2"):
        wanted = outputs.criteria(part)
        names = sorted({k for c in wanted for k in c})
        made = rows.select("query_id", "ord", *[F.get(F.array(*[F.lit(c.get(k, "")) for c in wanted]), F.col("i").cast("int")).alias(k) for k in names])
        first = outputs.representatives(made, part, len(wanted) + 5)
        out += [(part, r["query_id"], place) for place, r in enumerate(first.collect(), 1)]
    return spark.createDataFrame(out, "part string, k long, place long")


@query("provenance_inherit", "SELECT c.conv_id || '-' || c.turn AS query_id, coalesce(nullif(CASE WHEN c.turn % 2 = 0 THEN 'own' ELSE '' END, ''), p.role, '') AS source_url, coalesce(nullif(CASE WHEN c.turn % 3 = 0 THEN c.role ELSE '' END, ''), p.text, '') AS source_title FROM conversations c LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1 AND p.turn % 4 <> 1")
def provenance_inherit(spark, sf_dir):
    """A turn inherits what it lacks from the turn before; some turns have no parent."""
    turns = table(spark, sf_dir, "conversations")
    ident = lambda turn: F.concat_ws("-", "conv_id", turn)
    observed = turns.where("turn % 4 <> 1").select(ident(F.col("turn")).alias("query_id"), F.col("role").alias("source_url"), F.col("text").alias("source_title"))
    made = turns.select(ident(F.col("turn")).alias("query_id"), ident(F.col("turn") - 1).alias("parent_query_id"), F.when(F.col("turn") % 2 == 0, "own").otherwise("").alias("source_url"), F.when(F.col("turn") % 3 == 0, F.col("role")).otherwise("").alias("source_title"))
    return bank.inherit_provenance(made, observed).select("query_id", "source_url", "source_title")


# ---- selection ----

#: Expressions over documents that both engines read: documents as a combined bank. Copies agree on all but the id.
BANK_OF_DOCUMENTS = {
    "combined_query_id": "'CQ-' || doc_id",
    "source_stage": "CASE WHEN length(text) % 4 = 0 THEN 'A2' ELSE 'A1' END",
    "query_text": "text",
    "language": "CASE WHEN lang = 'en' THEN 'en' ELSE 'vi' END",
    "channel": "CASE WHEN lang = 'en' THEN 'scholarly' ELSE 'web' END",
    "query_kind": "CASE length(text) * 7 % 3 WHEN 0 THEN 'natural_question' WHEN 1 THEN 'action' ELSE 'effect' END",
    "scope_type": "CASE WHEN length(text) * 5 % 7 < 4 THEN 'crop_specific' ELSE 'crop_group' END",
    "crop_key": "'c' || (length(text) % 7)",
    "weather_scenario": "CASE length(text) * 11 % 16 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(selection.SCENARIO_ORDER)) + " ELSE 'other' END",
    "action": "CASE length(text) * 13 % 11 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(selection.CORE_ACTIONS)) + " ELSE 'other' END",
    "search_region": "CASE length(text) * 3 % 5 WHEN 0 THEN 'VIETNAM' WHEN 1 THEN 'BINH_DINH_LEGACY' WHEN 2 THEN 'GIA_LAI_CURRENT' WHEN 3 THEN 'NONE' ELSE 'GLOBAL' END",
    "query_origin": "CASE WHEN length(text) % 8 = 0 THEN 'observed' ELSE '' END",
}


def bank_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(*[f"{e} AS {c}" for c, e in BANK_OF_DOCUMENTS.items()])


_RANK = lambda column, order, other: f"CASE {column} " + " ".join(f"WHEN '{v}' THEN {i}" for v, i in order) + f" ELSE {other} END"
_SCENARIOS = ("heavy_rain", "prolonged_rain", "post_rain", "waterlogging", "wet_soil", "dry_spell", "hot_weather", "strong_sun", "hot_dry_wind", "high_humidity", "leaf_wetness", "strong_wind", "rainy_season", "cold_weather", "weather_change")
_ACTIONS = ("irrigation", "drainage", "post_rain_care", "field_inspection", "disease_monitoring", "crop_protection", "spray_window", "fertilization", "planting", "shade")
SQL_RANKED = f"""
rows_ AS (SELECT {', '.join(f'{e} AS {c}' for c, e in BANK_OF_DOCUMENTS.items())} FROM documents),
routed AS (SELECT *, CASE WHEN channel = 'scholarly' OR language = 'en' THEN 'scholarly' ELSE 'web' END AS discovery_channel, {sql_signature('query_text')} AS sig FROM rows_),
prior AS (SELECT *, CASE WHEN source_stage = 'A2' THEN 1 WHEN discovery_channel = 'web' AND scope_type = 'crop_specific' THEN 1 WHEN discovery_channel = 'web' OR scope_type = 'crop_specific' THEN 2 ELSE 3 END AS selection_priority, CASE query_origin WHEN '' THEN 'not_applicable' ELSE query_origin END AS query_origin_group FROM routed),
ranked AS (SELECT *, row_number() OVER (ORDER BY {_RANK('discovery_channel', [('web', 0), ('scholarly', 1)], 9)}, {_RANK('source_stage', [('A2', 0), ('A1', 1)], 9)}, selection_priority, {_RANK('query_kind', [('natural_question', 0), ('action', 1), ('effect', 2)], 9)}, {_RANK('scope_type', [('crop_specific', 0), ('crop_group', 1)], 9)},
  CASE discovery_channel WHEN 'scholarly' THEN {_RANK('search_region', [('GLOBAL', 0), ('VIETNAM', 1)], 9)} ELSE {_RANK('search_region', [('VIETNAM', 0), ('BINH_DINH_LEGACY', 1), ('GIA_LAI_CURRENT', 1), ('NONE', 2)], 9)} END,
  {_RANK('weather_scenario', [(s, i) for i, s in enumerate(_SCENARIOS)], 15)}, {_RANK('action', [(s, i) for i, s in enumerate(_ACTIONS)], 10)}, crop_key, sig, combined_query_id) AS pos,
  dense_rank() OVER (ORDER BY discovery_channel, language, source_stage, query_kind, scope_type, crop_key, weather_scenario, action, search_region, sig) AS twin FROM prior)
"""


@query("query_sort_places", f"WITH {SQL_RANKED} SELECT combined_query_id, discovery_channel, selection_priority, query_origin_group, pos FROM ranked")
def query_sort_places(spark, sf_dir):
    """Channel, priority, origin group and place of every query of the bank: the sort key of a selection."""
    kept = ["combined_query_id", "discovery_channel", "selection_priority", "query_origin_group"]
    # Written first: dealing by ranges reads its input twice, and the keys hold whole normalised texts.
    rows = Scratch(spark).save(selection.annotate(bank_of_documents(spark, sf_dir)).select(*kept, selection.sort_key().alias("key")))
    return positions(rows, F.col("key"), keep=kept).select(*kept, (F.col("position") + 1).alias("pos"))


@query("near_duplicate_groups", f"WITH {SQL_RANKED} SELECT min(pos) AS first_pos, count(*) AS n FROM ranked GROUP BY twin HAVING count(*) > 1")
def near_duplicate_groups(spark, sf_dir):
    """Near duplicates of the bank: the first one's place, and how many there are."""
    placed = positions(selection.keyed(bank_of_documents(spark, sf_dir), Scratch(spark)), F.col("key"), keep=["twin"])
    return placed.groupBy("twin").agg((F.min("position") + 1).alias("first_pos"), F.count(F.lit(1)).alias("n")).where("n > 1").select("first_pos", "n")


def _sql_seeds() -> str:
    """Every seed's predicates with their number; crop j of the sorted crops is preferred by scenario i where j = i modulo their number."""
    asked, effect = "discovery_channel = 'web' AND source_stage = 'A2' AND query_kind = 'natural_question'", "source_stage = 'A1' AND scope_type = 'crop_specific' AND query_kind = 'effect'"
    out = []
    for i, s in enumerate(_SCENARIOS):
        here, mine = f"weather_scenario = '{s}'", f"crop_key = (SELECT keys[1 + {i} % len(keys)] FROM crops)"
        for k, (first, then) in enumerate([(f"{asked} AND scope_type = 'crop_specific'", asked), (f"discovery_channel = 'web' AND {effect}",) * 2, (f"discovery_channel = 'scholarly' AND {effect}",) * 2]):
            out.append(f"SELECT {i * 3 + k} AS i, (SELECT min(pos) FROM ranked WHERE {first} AND {mine} AND {here}) AS one, (SELECT min(pos) FROM ranked WHERE {then} AND {here}) AS two")
    action = "discovery_channel = 'web' AND source_stage = 'A1' AND query_kind = 'action'"
    out.append(f"SELECT 100 + j, (SELECT min(pos) FROM ranked WHERE {action} AND scope_type = 'crop_specific' AND crop_key = k), NULL FROM (SELECT unnest(keys) AS k, generate_subscripts(keys, 1) AS j FROM crops)")
    out.append(f"SELECT 1000000 + j, (SELECT min(pos) FROM ranked WHERE {action} AND scope_type = 'crop_group' AND crop_key = k), NULL FROM (SELECT unnest(keys) AS k, generate_subscripts(keys, 1) AS j FROM groups_)")
    out += [f"SELECT {2000000 + i}, (SELECT min(pos) FROM ranked WHERE {action} AND search_region = '{r}'), NULL" for i, r in enumerate(("VIETNAM", "BINH_DINH_LEGACY", "GIA_LAI_CURRENT", "NONE"))]
    return " UNION ALL ".join(out)


def _held(column: str) -> str:
    return f"len(list_filter(chosen, lambda x: x.{column} = p.{column}))"


#: The pass, a row at a time: state is the list of chosen rows and the place up to which rows were looked at.
SQL_SELECT = f"""
crops AS (SELECT list(DISTINCT crop_key ORDER BY crop_key) AS keys FROM ranked WHERE scope_type = 'crop_specific'),
groups_ AS (SELECT list(DISTINCT crop_key ORDER BY crop_key) AS keys FROM ranked WHERE scope_type = 'crop_group'),
seeds AS (SELECT row_number() OVER (ORDER BY i) AS step, one, two FROM ({_sql_seeds()})),
slim AS (SELECT pos, twin, combined_query_id, discovery_channel, scope_type, query_kind, search_region, weather_scenario, crop_key FROM ranked),
seeded AS (SELECT 0::BIGINT AS step, []::BIGINT[] AS got UNION ALL
  SELECT s.step, CASE WHEN s.one IS NOT NULL AND NOT list_contains(got, s.one) THEN list_append(got, s.one) WHEN s.two IS NOT NULL AND NOT list_contains(got, s.two) THEN list_append(got, s.two) ELSE got END FROM seeded JOIN seeds s ON s.step = seeded.step + 1),
start AS (SELECT list(struct_pack(pos := p.pos, twin := p.twin, discovery_channel := p.discovery_channel, scope_type := p.scope_type, query_kind := p.query_kind, search_region := p.search_region, weather_scenario := p.weather_scenario, crop_key := p.crop_key) ORDER BY u.place) AS chosen
  FROM (SELECT unnest(got) AS pos, generate_subscripts(got, 1) AS place FROM seeded WHERE step = (SELECT max(step) FROM seeds)) u JOIN slim p ON p.pos = u.pos),
pass AS (SELECT 0::BIGINT AS last, chosen FROM start UNION ALL
  SELECT min(p.pos), list_append(any_value(chosen), arg_min(struct_pack(pos := p.pos, twin := p.twin, discovery_channel := p.discovery_channel, scope_type := p.scope_type, query_kind := p.query_kind, search_region := p.search_region, weather_scenario := p.weather_scenario, crop_key := p.crop_key), p.pos))
  FROM pass JOIN slim p ON p.pos > last WHERE len(chosen) < 96 AND NOT list_contains(list_transform(chosen, lambda x: x.twin), p.twin)
    AND {_held('discovery_channel')} < CASE p.discovery_channel WHEN 'web' THEN 72 ELSE 24 END
    AND {_held('scope_type')} < CASE p.scope_type WHEN 'crop_specific' THEN 72 ELSE 24 END
    AND {_held('query_kind')} < CASE p.query_kind WHEN 'natural_question' THEN 32 WHEN 'effect' THEN 24 ELSE 1000 END
    AND {_held('search_region')} < CASE p.search_region WHEN 'VIETNAM' THEN 33 WHEN 'BINH_DINH_LEGACY' THEN 14 WHEN 'GIA_LAI_CURRENT' THEN 14 WHEN 'NONE' THEN 11 WHEN 'GLOBAL' THEN 24 ELSE 1000 END
    AND {_held('weather_scenario')} < greatest(3, len(chosen) // 15 + 4) AND {_held('crop_key')} < greatest(6, len(chosen) // 8 + 8)
  GROUP BY last HAVING min(p.pos) IS NOT NULL),
done AS (SELECT chosen FROM pass ORDER BY len(chosen) DESC LIMIT 1),
placed AS (SELECT unnest(chosen).pos AS pos, generate_subscripts(chosen, 1) AS selection_rank FROM done)
"""


@query("quota_select_greedy", f"WITH RECURSIVE {SQL_RANKED}, {SQL_SELECT} SELECT combined_query_id, CAST(selection_rank AS INT) AS selection_rank, discovery_channel, query_kind, scope_type, search_region FROM placed JOIN slim USING (pos) WHERE selection_rank <= 96")
def quota_select_greedy(spark, sf_dir):
    """The whole selection, with documents as a bank."""
    return selection.select_queries(bank_of_documents(spark, sf_dir), 96).select("combined_query_id", "selection_rank", "discovery_channel", "query_kind", "scope_type", "search_region")


@query("executable_queries", f"WITH RECURSIVE {SQL_RANKED}, {SQL_SELECT} SELECT combined_query_id, CAST(selection_rank AS INT) AS selection_rank FROM placed JOIN slim USING (pos) WHERE selection_rank <= 96 AND discovery_channel = 'scholarly' ORDER BY selection_rank LIMIT 8")
def executable_queries(spark, sf_dir):
    """The queries that a live run on one channel asks: the first eight of the selection."""
    chosen = selection.select_queries(bank_of_documents(spark, sf_dir), 96)
    return search.executable(chosen, ("scholarly",), 8).select("combined_query_id", "selection_rank")


def _criterion(i: int, where: str) -> str:
    taken = " ".join(f"AND doc_id NOT IN (SELECT doc_id FROM c{j} WHERE doc_id IS NOT NULL)" for j in range(i))
    return f"c{i} AS (SELECT min(doc_id) AS doc_id, {i} AS i FROM documents WHERE {where} {taken})"


_CRITERIA = ("lang = 'en' AND source = 'src0'", "lang = 'en'", "lang = 'de'", "source = 'src3'", "lang = 'fr' AND source = 'src4'")
ORACLES["representative_by_criteria"] = (
    f"WITH {', '.join(_criterion(i, w) for i, w in enumerate(_CRITERIA))}, c AS ({' UNION ALL '.join(f'SELECT * FROM c{i}' for i in range(len(_CRITERIA)))}) SELECT doc_id, lang, source FROM (SELECT d.doc_id, lang, source, row_number() OVER (ORDER BY c.i NULLS LAST, d.doc_id) AS rn FROM documents d LEFT JOIN c USING (doc_id)) WHERE rn <= 24"
)


# ---- a run ----

SQL_ANSWERS = "answers AS (SELECT o_custkey AS original_query_id, o_orderkey % 4 AS variant_ord, CASE WHEN o_orderkey % 5 = 0 THEN 'down' END AS error, o_orderkey % 3 AS raw FROM orders), kept AS (SELECT o_custkey AS original_query_id, o_orderkey % 4 AS variant_ord FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 3 <> 0 AND o_totalprice > 200000)"
SQL_STATISTICS = f"""{SQL_ANSWERS},
per AS (SELECT original_query_id, count(*) AS requests, count(error) AS errors, bool_or(error IS NULL) AS succeeded, CAST(sum(CASE WHEN error IS NULL THEN raw ELSE 0 END) AS BIGINT) AS raw_results FROM answers GROUP BY original_query_id),
won AS (SELECT original_query_id, count(*) AS hits, min(variant_ord) AS w FROM kept GROUP BY original_query_id),
stats AS (SELECT per.*, coalesce(hits, 0) AS hits, coalesce(w > 0, false) AS recovered, raw_results = 0 AND errors = 0 AS zero_results FROM per LEFT JOIN won USING (original_query_id))
"""


def _statistics(spark, sf_dir) -> DataFrame:
    """Orders as the requests of queries, some of them failed."""
    orders = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    answers = orders.select(F.col("o_custkey").alias("original_query_id"), (k % 4).alias("variant_ord"), F.when(k % 5 == 0, "down").alias("error"), (k % 3).alias("raw_results"))
    kept = orders.where((k % 5 != 0) & (k % 3 != 0) & (F.col("o_totalprice") > 200000)).select(F.col("o_custkey").alias("original_query_id"), (k % 4).alias("variant_ord"))
    return search.query_statistics(answers, kept)


@query("query_statistics", f"WITH {SQL_STATISTICS} SELECT original_query_id, requests, errors, succeeded, raw_results, hits, recovered, zero_results FROM stats")
def query_statistics(spark, sf_dir):
    return _statistics(spark, sf_dir).select("original_query_id", "requests", "errors", "succeeded", "raw_results", "hits", "recovered", "zero_results")


SUMMARY_NUMBERS = ("total_query_bank", "selected_queries", "skipped_queries", "executed_queries", "executed_search_requests", "queries_with_relevant_results", "queries_without_relevant_results", "original_queries_succeeded", "queries_recovered_by_fallback", "queries_with_provider_error", "queries_with_zero_results", "raw_provider_results", "relevant_results_kept", "irrelevant_filtered", "unique_candidates", "duplicate_urls_removed")


@query("run_summary", f"""WITH {SQL_STATISTICS}, t AS (SELECT count(*) AS executed_queries, sum(requests) AS executed_search_requests, count(*) FILTER (WHERE hits > 0) AS queries_with_relevant_results, count(*) FILTER (WHERE hits = 0) AS queries_without_relevant_results, count(*) FILTER (WHERE succeeded) AS original_queries_succeeded, count(*) FILTER (WHERE recovered) AS queries_recovered_by_fallback,
  count(*) FILTER (WHERE errors > 0) AS queries_with_provider_error, count(*) FILTER (WHERE zero_results) AS queries_with_zero_results, sum(raw_results) AS raw_provider_results, sum(hits) AS relevant_results_kept FROM stats)
  SELECT u.key, CAST(u.value AS BIGINT) AS value FROM (UNPIVOT (SELECT (SELECT count(*) FROM documents)::BIGINT AS total_query_bank, 12::BIGINT AS selected_queries, (SELECT count(*) FROM documents)::BIGINT - 12 AS skipped_queries, executed_queries::BIGINT AS executed_queries, executed_search_requests::BIGINT AS executed_search_requests, queries_with_relevant_results::BIGINT AS queries_with_relevant_results,
    queries_without_relevant_results::BIGINT AS queries_without_relevant_results, original_queries_succeeded::BIGINT AS original_queries_succeeded, queries_recovered_by_fallback::BIGINT AS queries_recovered_by_fallback, queries_with_provider_error::BIGINT AS queries_with_provider_error, queries_with_zero_results::BIGINT AS queries_with_zero_results, raw_provider_results::BIGINT AS raw_provider_results,
    relevant_results_kept::BIGINT AS relevant_results_kept, (raw_provider_results - relevant_results_kept)::BIGINT AS irrelevant_filtered, (SELECT count(DISTINCT o_custkey) FROM orders)::BIGINT AS unique_candidates, (relevant_results_kept - (SELECT count(DISTINCT o_custkey) FROM orders))::BIGINT AS duplicate_urls_removed FROM t) ON COLUMNS(*) INTO NAME key VALUE value) u""")


def run_summary(spark, sf_dir):
    """The numbers of a run's summary: the selection from documents, the requests from orders."""
    documents = bank_of_documents(spark, sf_dir)
    chosen = selection.select_queries(documents, 12)
    candidates_ = table(spark, sf_dir, "orders").select("o_custkey").distinct().count()
    made = search.run_summary("live", "READY_FOR_A4", search.selection_summary(documents, chosen), _statistics(spark, sf_dir), [], candidates_, {}, [], RunConfig(live=True), "2024-01-01T00:00:00Z")
    return spark.createDataFrame([(k, made[k]) for k in SUMMARY_NUMBERS], "key string, value long")


@query("run_statuses", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CASE WHEN o_orderkey % 7 = 0 THEN 'NEEDS_A3_REVIEW' WHEN o_orderkey % 3 = 0 AND o_orderkey % 5 = 0 THEN 'SEARCH_PROVIDER_ERROR' WHEN o_orderkey % 3 <> 0 AND o_orderkey % 11 >= 6 THEN 'READY_FOR_A4' ELSE 'A3_LOW_COVERAGE' END WHEN o_orderkey % 7 = 0 THEN 'NEEDS_A3_REVIEW' ELSE 'DRY_RUN_READY' END AS status FROM orders")
def run_statuses(spark, sf_dir):
    """The status of a run for every combination of its inputs that occurs (few, so they are settled on the driver)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", *[(F.col("o_orderkey") % m).alias(f"m{m}") for m in (2, 3, 5, 7, 11)])
    cases = [(a, b, c, d, e, search.run_status(int(d == 0), int(b != 0), 8, 8 if c == 0 else 1, e / 10, a == 0)) for a in range(2) for b in range(3) for c in range(5) for d in range(7) for e in range(11)]
    known = spark.createDataFrame(cases, "m2 int, m3 int, m5 int, m7 int, m11 int, status string")
    return orders.join(F.broadcast(known), ["m2", "m3", "m5", "m7", "m11"]).select("o_orderkey", "status")


@query("bank_statuses", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'READY_FOR_DISCOVERY' ELSE 'REVIEW_REQUIRED' END AS a1, CASE WHEN o_orderkey % 5 = 0 THEN 'READY_FOR_A3' ELSE 'NEEDS_REVIEW' END AS a2 FROM orders")
def bank_statuses(spark, sf_dir):
    """The statuses of both parts of a bank for each number of issues that occurs."""
    known = spark.createDataFrame([(a, b, outputs.systematic_status(a), outputs.bank_status(b)) for a in range(3) for b in range(5)], "m3 int, m5 int, a1 string, a2 string")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 3).alias("m3"), (F.col("o_orderkey") % 5).alias("m5"))
    return orders.join(F.broadcast(known), ["m3", "m5"]).select("o_orderkey", "a1", "a2")


@query("keep_best_hits", "SELECT o_custkey, variant_ord, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, variant_ord ORDER BY CASE WHEN c THEN CASE st WHEN 'direct_match' THEN 0 ELSE 1 END END, CASE WHEN c THEN -sc END, o_orderkey) AS rn FROM (SELECT o_custkey, o_orderkey % 2 AS variant_ord, o_orderkey, o_custkey % 2 = 0 AS c, CASE o_orderkey % 3 WHEN 0 THEN 'direct_match' WHEN 1 THEN 'supporting_match' ELSE 'rejected_irrelevant' END AS st, o_orderkey % 9 AS sc FROM orders) WHERE st <> 'rejected_irrelevant') WHERE rn <= 2")
def keep_best_hits(spark, sf_dir):
    """The two best hits of each variant: scholarly ones by status and score, web ones by rank."""
    k = F.col("o_orderkey")
    status = F.when(k % 3 == 0, "direct_match").when(k % 3 == 1, "supporting_match").otherwise("rejected_irrelevant")
    hits = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("original_query_id"), (k % 2).alias("variant_ord"), k.alias("result_rank"), F.when(F.col("o_custkey") % 2 == 0, "scholarly").otherwise("web").alias("discovery_channel"), status.alias("relevance_status"), (k % 9).alias("relevance_score")
    )
    return search.keep_best(hits, 2).select(F.col("original_query_id").alias("o_custkey"), "variant_ord", F.col("result_rank").alias("o_orderkey"))


@query("conditional_counts", "SELECT count(*) FILTER (WHERE lang = 'en') AS english, count(*) FILTER (WHERE lang <> 'en') AS other, count(*) FILTER (WHERE lang IS NULL) AS unknown FROM documents")
def conditional_counts(spark, sf_dir):
    return tables.conditional_counts(table(spark, sf_dir, "documents"), {"english": F.col("lang") == "en", "other": F.col("lang") != "en", "unknown": F.col("lang").isNull()})


@query("row_matches", "SELECT doc_id FROM documents WHERE lang = 'en' AND source = 'src1'")
def row_matches(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(tables.matches({"lang": "en", "source": "src1"})).select("doc_id")


@query("metadata_text", f"SELECT item_id, {sql_normalize("concat_ws(' ', nullif(CASE WHEN item_id % 2 = 0 THEN split_part(text, ' ', 1) ELSE '' END, ''), nullif(text, ''))")} AS form FROM benchmark")
def metadata_text(spark, sf_dir):
    title = F.when(F.col("item_id") % 2 == 0, F.get(F.split("text", " "), F.lit(0))).otherwise("")
    return table(spark, sf_dir, "benchmark").select("item_id", text.metadata_text(title, F.lit(""), F.col("text")).alias("form"))


@query("jsonl_roundtrip", "SELECT event_id, CAST(props ->> 'k' AS BIGINT) AS k, event_type FROM events")
def jsonl_roundtrip(spark, sf_dir):
    """Events written as JSON lines and read back."""
    path = Scratch(spark).path()
    rows = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint").alias("p"), "event_type")
    files.write_jsonl(rows, path, sort_keys=True)
    return files.read_jsonl(spark, path, rows.schema).select("event_id", "p.k", "event_type")


# ---- audits, over rows with planted faults ----


def _cases(key: str, values) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


_S, _CHANNEL = [s[0] for s in fixed.SCENARIOS], "CASE {0} WHEN 'vi' THEN 'web' ELSE 'scholarly' END"
_AT = "CAST(floor(k / 25.0) AS BIGINT) % 15"
_VI = "(k % 127 <> 0 AND k % 2 = 0)"
_SPECIFIC, _GROUP = "(k % 139 <> 0 AND k % 4 <> 0)", "(k % 139 <> 0 AND k % 4 = 0)"
#: Systematic queries made of the numbers k, each fault where k is divisible by a prime.
A1_ROWS = {
    "query_id": "CASE WHEN k % 101 = 0 THEN '' WHEN k % 103 = 0 THEN 'SAME' ELSE 'Q' || k END",
    "query": "CASE WHEN k % 107 = 0 THEN '   ' WHEN k % 109 = 0 THEN 'Same  Text' WHEN k % 211 = 0 THEN 'same text ' ELSE 'text ' || k END",
    "search_round": "CASE WHEN k % 113 = 0 THEN 2 ELSE 1 END",
    "language": f"CASE WHEN k % 127 = 0 THEN 'fr' WHEN {_VI} THEN 'vi' ELSE 'en' END",
    "channel": f"CASE WHEN k % 131 = 0 THEN 'radio' WHEN {_VI} THEN 'web' ELSE 'scholarly' END",
    "priority": "1",
    "query_kind": "CASE WHEN k % 137 = 0 THEN 'other' WHEN k % 3 = 0 THEN 'effect' ELSE 'action' END",
    "scope_type": "CASE WHEN k % 139 = 0 THEN 'farm' WHEN k % 4 = 0 THEN 'crop_group' ELSE 'crop_specific' END",
    "crop_id": f"CASE WHEN k % 149 = 0 THEN 'none' WHEN {_SPECIFIC} THEN 'n' || (k % 25) WHEN k % 151 = 0 THEN 'n1' ELSE '' END",
    "crop_name": f"CASE WHEN NOT {_SPECIFIC} OR k % 157 = 0 THEN '' WHEN k % 163 = 0 THEN 'wrong' ELSE 'N' || (k % 25) END",
    "crop_group": f"CASE WHEN k % 167 = 0 THEN 'r1' WHEN NOT {_GROUP} THEN '' WHEN k % 173 = 0 THEN 'zz' ELSE 'r' || (k % 5) END",
    "crop_term": "CASE WHEN k % 179 = 0 THEN '' ELSE 'term' END",
    "weather_scenario": f"CASE WHEN k % 181 = 0 THEN 'snow' ELSE {_cases(_AT, _S)} END",
    "weather_factor": f"CASE WHEN k % 191 = 0 THEN 'x' ELSE {_cases(_AT, [s[1] for s in fixed.SCENARIOS])} END",
    "weather_term": f"CASE WHEN k % 193 = 0 THEN NULL WHEN {_VI} THEN {_cases(_AT, [s[2] for s in fixed.SCENARIOS])} ELSE {_cases(_AT, [s[3] for s in fixed.SCENARIOS])} END",
    "effects": f"CASE WHEN k % 197 = 0 THEN 'x|y' ELSE {_cases(_AT, ['|'.join(s[4]) for s in fixed.SCENARIOS])} END",
    "action": "CASE WHEN k % 199 = 0 THEN 'dance' WHEN k % 3 = 0 THEN 'NONE' ELSE 'shade' END",
    "search_region": "CASE WHEN k % 223 = 0 THEN 'MARS' ELSE 'VIETNAM' END",
    "search_region_term": f"CASE WHEN k % 227 = 0 THEN 'x' WHEN {_VI} THEN 'Việt Nam' ELSE 'Vietnam' END",
}
A1_CONFIG = {"crops": [{"id": f"n{i}", "name_vi": f"N{i}"} for i in range(25)], "crop_groups": {f"r{i}": {} for i in range(5)}}


def _values(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in rows) + ")"


#: What each issue shows beside its row's id, as the audits are to give it.
_SHOWN = {
    "EMPTY_QUERY_ID": "row", "DUPLICATE_QUERY": "query", "INVALID_LANGUAGE": "query_id language", "INVALID_CHANNEL": "query_id language channel", "INVALID_QUERY_KIND": "query_id query_kind", "INVALID_SCOPE_TYPE": "query_id scope_type", "INVALID_CROP_ID": "query_id crop_id", "CROP_NAME_MISMATCH": "query_id crop_id",
    "INVALID_CROP_GROUP": "query_id crop_group", "INVALID_WEATHER_SCENARIO": "query_id weather_scenario", "EFFECT_QUERY_HAS_ACTION": "query_id action", "INVALID_ROW_ACTION": "query_id action", "INVALID_SEARCH_REGION": "query_id language search_region", "SEARCH_REGION_TERM_MISMATCH": "query_id search_region",
    "A2_EMPTY_QUERY_ID": "row", "A2_DUPLICATE_NORMALIZED_QUERY": "query_id query_text", "A2_MALFORMED_STAGE": "query_id stage", "A2_INVALID_LANGUAGE": "query_id language", "A2_INVALID_QUERY_ORIGIN": "query_id query_origin", "A2_INVALID_INTENT": "query_id intent", "A2_TRANSFORMED_PARENT_NOT_FOUND": "query_id parent_query_id",
    "A2_UNKNOWN_CROP_KEY": "query_id crop_key", "A2_UNKNOWN_CROP_GROUP_KEY": "query_id crop_key", "A2_INVALID_CROP_SCOPE": "query_id crop_scope", "A2_INVALID_SEARCH_REGION": "query_id search_region", "A2_SEARCH_REGION_TERM_MISMATCH": "query_id search_region", "A2_UNKNOWN_SCENARIO": "query_id scenario",
    "A2_UNKNOWN_ACTION": "query_id action", "A2_INCOMPATIBLE_ACTION_SCENARIO": "query_id scenario action",
    "A3_MALFORMED_URL": "candidate_id url", "A3_MALFORMED_CANONICAL_URL": "candidate_id canonical_url", "A3_DUPLICATE_CANONICAL_URL_RECORD": "candidate_id canonical_url", "A3_INVALID_DISCOVERY_CHANNEL": "candidate_id discovery_channel", "A3_INVALID_SEARCH_REGION": "candidate_id search_region",
    "A3_UNKNOWN_QUERY_ID": "candidate_id query_id", "A3_DEDUP_PROVENANCE_LOST": "candidate_id raw_result_count query_reference_count", "A3_INVALID_RELEVANCE_STATUS": "candidate_id relevance_status", "A3_REFERENCE_MISSING_QUERY_ID": "candidate_id", "A3_REFERENCE_INVALID_SEARCH_VARIANT_TYPE": "candidate_id query_id search_variant_type",
}


def _sql_object(fields: dict[str, str]) -> str:
    """A JSON object of the fields, nulls too."""
    return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || coalesce(CAST(to_json({v}) AS VARCHAR), 'null')" for k, v in fields.items()) + " || '}'"


def _sql_shown(kind: str, default: str, ident: str, row: dict[str, str]) -> str:
    names = _SHOWN.get(kind, default).split()
    key = "candidate_id" if "candidate_id" in default else "query_id"
    values = {n: ident if n == key else n for n in names}
    if names == ["row"]:
        return "'{\"row\":' || " + _sql_object({k: k for k in row}) + " || '}'"
    return _sql_object(values)


def _issues(rows: str, ident: str, rules: dict[str, str], default: str = "query_id", row: dict[str, str] | None = None) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS type, {ident} AS id, {_sql_shown(t, default, ident, row or {})} AS details FROM {rows} WHERE {p}" for t, p in rules.items())


def _sql_repeats(rows: str, ident: str, kind: str, key: str, default: str = "query_id", text: str = "''") -> str:
    """Issues of all rows but the first of a key, by (id, text)."""
    return f"SELECT '{kind}', id, {_sql_shown(kind, default, 'id', {})} FROM (SELECT {ident} AS id, {'' if text == chr(39) * 2 else text + ','} {key} AS key, row_number() OVER (PARTITION BY {key} ORDER BY {ident}, {text}) AS rn FROM {rows}) WHERE rn > 1 AND coalesce(key, '') <> ''"


_CROP_OK = "crop_id IN (SELECT 'n' || unnest(range(25)))"
SQL_A1 = f"""WITH r AS (SELECT {', '.join(f'{e} AS {c}' for c, e in A1_ROWS.items())} FROM (SELECT o_orderkey AS k FROM orders)),
scen AS (SELECT * FROM {_values((s[0], s[1], s[2], s[3], '|'.join(s[4])) for s in fixed.SCENARIOS)} AS t(sid, sf, svi, sen, se)),
d AS (SELECT * FROM r LEFT JOIN scen ON weather_scenario = sid)
{_issues('d', 'query_id', {
    'EMPTY_QUERY_ID': "query_id = ''", 'EMPTY_QUERY': "trim(query) = ''", 'INVALID_SEARCH_ROUND': 'search_round <> 1', 'INVALID_LANGUAGE': "language NOT IN ('vi', 'en')", 'INVALID_CHANNEL': "(language = 'vi' AND channel <> 'web') OR (language = 'en' AND channel <> 'scholarly')",
    'INVALID_QUERY_KIND': "query_kind NOT IN ('effect', 'action')", 'INVALID_SCOPE_TYPE': "scope_type = 'farm'", 'INVALID_CROP_ID': f"scope_type = 'crop_specific' AND NOT {_CROP_OK}", 'MISSING_CROP_NAME': "scope_type = 'crop_specific' AND crop_name = ''",
    'CROP_NAME_MISMATCH': f"scope_type = 'crop_specific' AND crop_name <> '' AND {_CROP_OK} AND crop_name <> upper(crop_id)", 'UNEXPECTED_CROP_GROUP': "scope_type = 'crop_specific' AND crop_group <> ''", 'UNEXPECTED_CROP_FIELDS': "scope_type = 'crop_group' AND (crop_id <> '' OR crop_name <> '')",
    'INVALID_CROP_GROUP': "scope_type = 'crop_group' AND crop_group NOT IN ('r0', 'r1', 'r2', 'r3', 'r4')", 'EMPTY_CROP_TERM': "crop_term = ''", 'INVALID_WEATHER_SCENARIO': 'sid IS NULL', 'WEATHER_FACTOR_MISMATCH': 'sid IS NOT NULL AND weather_factor IS DISTINCT FROM sf',
    'WEATHER_TERM_MISMATCH': "sid IS NOT NULL AND weather_term IS DISTINCT FROM CASE language WHEN 'vi' THEN svi ELSE sen END", 'EFFECTS_MISMATCH': 'sid IS NOT NULL AND effects IS DISTINCT FROM se', 'EFFECT_QUERY_HAS_ACTION': "query_kind = 'effect' AND action <> 'NONE'", 'INVALID_ROW_ACTION': "query_kind = 'action' AND action IN ('dance', 'NONE')",
    'INVALID_SEARCH_REGION': "language <> 'fr' AND search_region = 'MARS'", 'SEARCH_REGION_TERM_MISMATCH': "search_region = 'VIETNAM' AND ((language = 'vi' AND search_region_term <> 'Việt Nam') OR (language = 'en' AND search_region_term <> 'Vietnam'))",
}, row=A1_ROWS)}
UNION ALL {_sql_repeats('r', 'query_id', 'DUPLICATE_QUERY_ID', 'query_id')} UNION ALL {_sql_repeats('r', 'query_id', 'DUPLICATE_QUERY', sql_normalize('query'), text='query')}
UNION ALL SELECT 'MISSING_TARGET_CROPS', 'cai_cuc,cai_xanh,ngo,rau_muong,xa_lach', '{{"missing":["cai_cuc","cai_xanh","ngo","rau_muong","xa_lach"]}}'
UNION ALL SELECT 'MISSING_WEATHER_SCENARIO', c, '{{"crop_id":"' || c || '","missing":' || CAST(to_json(list(sid ORDER BY sid)) AS VARCHAR) || '}}' FROM (SELECT 'n' || unnest(range(25)) AS c), scen WHERE NOT EXISTS (SELECT 1 FROM r WHERE crop_id = c AND weather_scenario = sid) GROUP BY c"""


@query("audit_systematic", SQL_A1)
def audit_systematic(spark, sf_dir):
    """The audit of systematic queries over 23 kinds of planted faults."""
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k").selectExpr(*[f"{e} AS {c}" for c, e in A1_ROWS.items()])
    return audits.audit_systematic(rows, A1_CONFIG)


A2_ROWS = {
    "query_id": "CASE WHEN k % 101 = 0 THEN '' WHEN k % 103 = 0 THEN 'SAME' ELSE 'Q' || k END",
    "query_text": "CASE WHEN k % 107 = 0 THEN '?!' WHEN k % 109 = 0 THEN 'Same, text' WHEN k % 211 = 0 THEN 'same text?' ELSE 'text ' || k END",
    "language": "CASE WHEN k % 113 = 0 THEN 'en' ELSE 'vi' END",
    "stage": "CASE WHEN k % 127 = 0 THEN 'A1' ELSE 'A2' END",
    "query_origin": "CASE WHEN k % 131 = 0 THEN 'dreamt' WHEN k % 3 = 0 THEN 'observed' WHEN k % 3 = 1 THEN 'transformed' ELSE 'synthetic' END",
    "intent": "CASE WHEN k % 137 = 0 THEN 'fun' ELSE 'rain_effect' END",
    "scenario": f"CASE WHEN k % 139 = 0 THEN 'snow' ELSE {_cases('k % 15', _S)} END",
    "action": "CASE WHEN k % 149 = 0 THEN 'dance' WHEN k % 7 = 0 THEN 'planting' WHEN k % 5 = 0 THEN 'irrigation' ELSE 'NONE' END",
    "crop_scope": "CASE WHEN k % 151 = 0 THEN 'farm' WHEN k % 4 = 0 THEN 'crop_group' ELSE 'crop_specific' END",
    "crop_key": "CASE WHEN k % 157 = 0 THEN 'zz' WHEN k % 4 = 0 THEN 'r' || (k % 5) ELSE 'n' || (k % 25) END",
    "search_region": "CASE WHEN k % 163 = 0 THEN 'GLOBAL' WHEN k % 2 = 0 THEN 'VIETNAM' ELSE 'NONE' END",
    "search_region_term": "CASE WHEN k % 167 = 0 THEN 'x' WHEN k % 2 = 0 THEN 'Việt Nam' ELSE '' END",
    "source_url": "CASE WHEN k % 173 = 0 THEN 'http://y' WHEN k % 3 = 0 AND k % 179 <> 0 THEN 'http://x' ELSE '' END",
    "source_title": "''",
    "parent_query_id": "CASE WHEN k % 3 <> 1 OR k % 181 = 0 THEN '' WHEN k % 191 = 0 THEN 'GONE' ELSE 'Q' || (SELECT_FIRST) END",
}
_FIRST = "(SELECT min(o_orderkey) FROM orders WHERE o_orderkey % 101 <> 0 AND o_orderkey % 103 <> 0)"
_ALLOWED = _values(sorted({(s[0], a) for s in fixed.SCENARIOS for a in s[5] if a in ("planting", "irrigation")} | {p for p in fixed.QUESTION_PAIRS if p[1] in ("planting", "irrigation")}))
SQL_A2 = f"""WITH r AS (SELECT {', '.join(f'{e} AS {c}' for c, e in A2_ROWS.items()).replace('(SELECT_FIRST)', _FIRST)} FROM (SELECT o_orderkey AS k FROM orders)), allowed AS (SELECT * FROM {_ALLOWED} AS t(s, a))
{_issues('r', 'query_id', {
    'A2_EMPTY_QUERY_ID': "query_id = ''", 'A2_EMPTY_QUERY_TEXT': "query_text = '?!'", 'A2_MALFORMED_STAGE': "stage <> 'A2'", 'A2_INVALID_LANGUAGE': "language <> 'vi'", 'A2_INVALID_QUERY_ORIGIN': "query_origin = 'dreamt'", 'A2_INVALID_INTENT': "intent = 'fun'",
    'A2_OBSERVED_WITHOUT_SOURCE_URL': "query_origin = 'observed' AND source_url = ''", 'A2_TRANSFORMED_WITHOUT_PARENT_QUERY_ID': "query_origin = 'transformed' AND parent_query_id = ''", 'A2_TRANSFORMED_PARENT_NOT_FOUND': "query_origin = 'transformed' AND parent_query_id <> '' AND parent_query_id NOT IN (SELECT query_id FROM r)",
    'A2_SYNTHETIC_HAS_FAKE_PROVENANCE': "query_origin = 'synthetic' AND (source_url <> '' OR source_title <> '' OR parent_query_id <> '')", 'A2_UNKNOWN_CROP_KEY': "crop_scope = 'crop_specific' AND NOT regexp_full_match(crop_key, 'n([0-9]|1[0-9]|2[0-4])')", 'A2_UNKNOWN_CROP_GROUP_KEY': "crop_scope = 'crop_group' AND NOT regexp_full_match(crop_key, 'r[0-4]')",
    'A2_INVALID_CROP_SCOPE': "crop_scope = 'farm'", 'A2_INVALID_SEARCH_REGION': "search_region = 'GLOBAL'", 'A2_SEARCH_REGION_TERM_MISMATCH': "search_region <> 'GLOBAL' AND search_region_term <> CASE search_region WHEN 'VIETNAM' THEN 'Việt Nam' ELSE '' END", 'A2_UNKNOWN_SCENARIO': "scenario = 'snow'", 'A2_UNKNOWN_ACTION': "action = 'dance'",
    'A2_INCOMPATIBLE_ACTION_SCENARIO': "scenario <> 'snow' AND action <> 'NONE' AND NOT EXISTS (SELECT 1 FROM allowed WHERE s = scenario AND a = action)",
}, row=A2_ROWS)}
UNION ALL {_sql_repeats('r', 'query_id', 'A2_DUPLICATE_QUERY_ID', 'query_id')} UNION ALL {_sql_repeats('r', 'query_id', 'A2_DUPLICATE_NORMALIZED_QUERY', sql_public('query_text'), text='query_text')}"""


@query("audit_questions", SQL_A2)
def audit_questions(spark, sf_dir):
    """The audit of questions over 19 kinds of planted faults."""
    orders = table(spark, sf_dir, "orders")
    first = orders.where("o_orderkey % 101 <> 0 AND o_orderkey % 103 <> 0").agg(F.min("o_orderkey").alias("first"))
    rows = orders.selectExpr("o_orderkey AS k").crossJoin(F.broadcast(first)).selectExpr(*[f"{e.replace('(SELECT_FIRST)', 'first')} AS {c}" for c, e in A2_ROWS.items()])
    return audits.audit_questions(rows, A1_CONFIG)


_N = "length(url) * 31 + raw_result_count"
#: Faults of candidates, by a number that both engines compute from the candidate.
A3_FAULTS = {
    "url": "CASE n % 11 WHEN 0 THEN '' WHEN 1 THEN 'no-url' ELSE url END",
    "canonical_url": "CASE n % 13 WHEN 0 THEN '' WHEN 1 THEN 'ftp://x/y' WHEN 2 THEN 'http://same.org' ELSE canonical_url END",
    "discovery_channel": "CASE WHEN n % 17 = 0 THEN 'radio' ELSE discovery_channel END",
    "search_region": "CASE WHEN n % 19 = 0 THEN 'MARS' ELSE search_region END",
    "source_domain": "CASE WHEN n % 23 = 0 THEN '' ELSE source_domain END",
    "query_id": "CASE n % 29 WHEN 0 THEN '' WHEN 1 THEN 'Q9' ELSE query_id END",
    "title_status": "CASE n % 7 WHEN 0 THEN 'fabricated' WHEN 1 THEN 'other' ELSE title_status END",
    "relevance_status": "CASE n % 31 WHEN 0 THEN 'rejected_irrelevant' WHEN 1 THEN 'fine' ELSE relevance_status END",
    "relevance_score": "CASE WHEN n % 37 = 0 THEN NULL ELSE relevance_score END",
    "raw_result_count": "CASE WHEN n % 41 = 0 THEN 99 ELSE raw_result_count END",
}
HIT_FAULTS = {
    "query_id": "CASE page_id % 11 WHEN 0 THEN '' WHEN 1 THEN 'Q9' ELSE 'Q' || (page_id % 3) END",
    "original_query_id": "CASE WHEN page_id % 13 = 0 THEN '' ELSE 'Q' END",
    "original_query_text": "CASE WHEN page_id % 17 = 0 THEN '' ELSE 'Q' END",
    "search_variant_text": "CASE WHEN page_id % 19 = 0 THEN '' ELSE 'Q' END",
    "search_variant_type": "CASE WHEN page_id % 23 = 0 THEN 'odd' ELSE 'original' END",
    "discovery_channel": "CASE WHEN page_id % 29 = 0 THEN 'radio' ELSE 'web' END",
    "source_stage": "CASE page_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'A2' ELSE 'A1' END",
    "query_origin": "CASE WHEN page_id % 3 = 0 THEN 'observed' ELSE '' END",
    "relevance_status": "CASE page_id % 31 WHEN 0 THEN 'fine' WHEN 1 THEN 'rejected_irrelevant' ELSE 'direct_match' END",
}
_FIRST_OF = ", ".join(f"arg_min({c}, page_id) AS {c}" for c in ("url", "canonical", "query_id", "discovery_channel"))
SQL_A3 = f"""WITH {catalog.SQL_URL}, h AS (SELECT page_id, url, canonical, CASE canonical WHEN '' THEN 'INVALID:' || url ELSE canonical END AS key, host, CASE WHEN page_id % 5 = 0 THEN '' ELSE trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) END AS title, CAST(page_id % 9 AS INT) AS score, {', '.join(f'{e} AS {c}' for c, e in HIT_FAULTS.items())} FROM canon),
m AS (SELECT key, {_FIRST_OF}, arg_min(host, page_id) AS host, coalesce(arg_min(title, page_id) FILTER (WHERE title <> ''), '') AS title, max(score) AS relevance_score, arg_min(relevance_status, (9 - score)::BIGINT * 1000000000 + page_id) AS relevance_status, count(*) AS raw_result_count, 'NONE' AS search_region FROM h GROUP BY key),
named AS (SELECT *, {sql_id('CD-', "CASE canonical WHEN '' THEN url ELSE canonical END")} AS id, canonical AS canonical_url, host AS source_domain, CASE title WHEN '' THEN 'missing_from_search_result' ELSE 'from_search_result' END AS title_status, raw_result_count AS refs, {_N} AS n FROM m),
f AS (SELECT id, title, refs, refs AS query_reference_count, {', '.join(f'{e} AS {c}' for c, e in A3_FAULTS.items())} FROM (SELECT id, title, refs, n, {', '.join(A3_FAULTS)} FROM named)),
each_ AS (SELECT h.*, named.id FROM h JOIN named USING (key))
{_issues('f', 'id', {
    'A3_EMPTY_URL': "url = ''", 'A3_MALFORMED_URL': "NOT regexp_matches(url, '^[ ]*https?://[^/?#]')", 'A3_EMPTY_CANONICAL_URL': "canonical_url = ''", 'A3_MALFORMED_CANONICAL_URL': "canonical_url <> '' AND NOT regexp_matches(canonical_url, '^https?://[^/?#]')", 'A3_INVALID_DISCOVERY_CHANNEL': "discovery_channel = 'radio'", 'A3_INVALID_SEARCH_REGION': "search_region = 'MARS'",
    'A3_EMPTY_SOURCE_DOMAIN': "source_domain = ''", 'A3_MISSING_QUERY_ID': "query_id = ''", 'A3_UNKNOWN_QUERY_ID': "query_id = 'Q9'", 'A3_DEDUP_PROVENANCE_LOST': 'raw_result_count <> refs', 'A3_EMPTY_TITLE_WITHOUT_STATUS': "title = '' AND title_status <> 'missing_from_search_result'", 'A3_FABRICATED_TITLE': "title_status = 'fabricated'",
    'A3_INVALID_RELEVANCE_STATUS': "relevance_status = 'fine'", 'A3_REJECTED_CANDIDATE_WRITTEN': "relevance_status = 'rejected_irrelevant'", 'A3_INVALID_RELEVANCE_SCORE': 'relevance_score IS NULL',
}, 'candidate_id')}
UNION ALL {_issues('each_', 'id', {
    'A3_REFERENCE_MISSING_QUERY_ID': "query_id = ''", 'A3_REFERENCE_UNKNOWN_QUERY_ID': "query_id = 'Q9'", 'A3_REFERENCE_MISSING_ORIGINAL_QUERY_ID': "original_query_id = ''", 'A3_REFERENCE_MISSING_ORIGINAL_QUERY_TEXT': "original_query_text = ''", 'A3_REFERENCE_MISSING_SEARCH_VARIANT_TEXT': "search_variant_text = ''",
    'A3_REFERENCE_INVALID_SEARCH_VARIANT_TYPE': "search_variant_type = 'odd'", 'A3_REFERENCE_INVALID_DISCOVERY_CHANNEL': "discovery_channel = 'radio'", 'A3_REFERENCE_MISSING_SOURCE_STAGE': "source_stage = ''", 'A3_A2_REFERENCE_MISSING_QUERY_ORIGIN': "source_stage = 'A2' AND query_origin = ''", 'A3_REFERENCE_INVALID_RELEVANCE_STATUS': "relevance_status = 'fine'",
}, 'candidate_id query_id')}
UNION ALL {_sql_repeats("(SELECT * FROM f WHERE starts_with(canonical_url, 'http'))", 'id', 'A3_DUPLICATE_CANONICAL_URL_RECORD', 'canonical_url', 'candidate_id', 'canonical_url')}"""


@query("audit_candidates", SQL_A3)
def audit_candidates(spark, sf_dir):
    """The audit of merged candidates and their references over 26 kinds of planted faults."""
    hits = catalog.page_hits(spark, sf_dir).withColumn("page_id", F.col("ord")).withColumns({c: F.expr(e) for c, e in HIT_FAULTS.items()}).drop("page_id")
    merged = candidates.merge_hits(hits).withColumn("n", F.expr(_N))
    known = spark.createDataFrame([("Q0",), ("Q1",), ("Q2",)], "query_id string")
    return audits.audit_candidates(merged.withColumns({c: F.expr(e) for c, e in A3_FAULTS.items()}).drop("n"), known)


@query("audit_vocabularies", f"WITH c AS (SELECT 'n' || n_nationkey AS key, n_name AS term FROM nation UNION ALL SELECT 'n' || n_nationkey, upper(r_name) FROM nation JOIN region ON n_nationkey % 6 = r_regionkey), s AS (SELECT DISTINCT {sql_normalize('r_name')} AS norm FROM region) SELECT 'A3_CROP_KEYWORD_OVERLAPS_SCENARIO_KEYWORD' AS type, key || ':' || string_agg(DISTINCT term, ',' ORDER BY term) AS id, '{{\"crop_key\":\"' || key || '\",\"terms\":' || CAST(to_json(list(DISTINCT term ORDER BY term)) AS VARCHAR) || '}}' AS details FROM c WHERE {sql_normalize('term')} IN (SELECT norm FROM s) GROUP BY key")
def audit_vocabularies(spark, sf_dir):
    """Nations as crops, regions as scenarios; 25 and 5 rows, which are the vocabularies."""
    regions = {r.r_regionkey: r.r_name for r in table(spark, sf_dir, "region").collect()}
    crops = {f"n{r.n_nationkey}": [r.n_name, *([regions[r.n_nationkey % 6].upper()] if r.n_nationkey % 6 in regions else [])] for r in table(spark, sf_dir, "nation").collect()}
    return audits.audit_vocabularies(spark, crops, {name: [name.lower()] for name in regions.values()})


@query("audit_duplicates", f"SELECT 'DUPLICATE_QUERY' AS type, doc_id AS id, '{{\"doc_id\":' || doc_id || '}}' AS details FROM (SELECT doc_id, row_number() OVER (PARTITION BY {sql_normalize('text')} ORDER BY doc_id) AS rn, {sql_normalize('text')} AS norm FROM documents) WHERE rn > 1 AND coalesce(norm, '') <> ''")
def audit_duplicates(spark, sf_dir):
    """Documents whose normal form an earlier one has; the forms travel as hashes."""
    norm = text.normalize(F.col("text"))
    return audits.repeats(table(spark, sf_dir, "documents"), "DUPLICATE_QUERY", F.when(norm != "", F.sha2(norm, 256)), "doc_id")
