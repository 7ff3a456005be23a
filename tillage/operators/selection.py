"""Quota-constrained selection of queries: seeds, then one greedy pass under caps."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from tillage.functions.text import signature
from tillage.plans.bank import near_duplicate
from tillage.sources.scratch import Scratch

CHANNELS = ("web", "scholarly")

#: The orders that rank scenarios and actions, and the ranks of the other columns.
SCENARIO_ORDER = ("heavy_rain", "prolonged_rain", "post_rain", "waterlogging", "wet_soil", "dry_spell", "hot_weather", "strong_sun", "hot_dry_wind", "high_humidity", "leaf_wetness", "strong_wind", "rainy_season", "cold_weather", "weather_change")
CORE_ACTIONS = ("irrigation", "drainage", "post_rain_care", "field_inspection", "disease_monitoring", "crop_protection", "spray_window", "fertilization", "planting", "shade")
SEED_REGIONS = ("VIETNAM", "BINH_DINH_LEGACY", "GIA_LAI_CURRENT", "NONE")
RANKS = {
    "discovery_channel": ("web", "scholarly"),
    "source_stage": ("A2", "A1"),
    "query_kind": ("natural_question", "action", "effect"),
    "scope_type": ("crop_specific", "crop_group"),
}
REGION_RANKS = {"scholarly": {"GLOBAL": 0, "VIETNAM": 1}, "web": {"VIETNAM": 0, "BINH_DINH_LEGACY": 1, "GIA_LAI_CURRENT": 1, "NONE": 2}}
#: Shares of the limit, in percent, that a region may take.
REGION_SHARES = {"VIETNAM": 35, "BINH_DINH_LEGACY": 15, "GIA_LAI_CURRENT": 15, "NONE": 12, "GLOBAL": 25}


def channel(language: Column, kind: Column) -> Column:
    return F.when((kind == "scholarly") | (language == "en"), "scholarly").when(kind.isin("web", "public_query") | (language == "vi"), "web").otherwise("")


def priority(given: Column | None, stage: Column, discovery: Column, scope: Column) -> Column:
    """The given priority if it is a number, else 1 to 3 by stage, channel and scope, else 9."""
    derived = (
        F.when(stage == "A2", 1)
        .when((discovery == "web") & (scope == "crop_specific"), 1)
        .when((discovery == "web") & (scope == "crop_group"), 2)
        .when((discovery == "scholarly") & (scope == "crop_specific"), 2)
        .when((discovery == "scholarly") & (scope == "crop_group"), 3)
        .otherwise(9)
    )
    return derived if given is None else F.coalesce(given.try_cast("int"), derived)


def annotate(bank: DataFrame) -> DataFrame:
    """Adds discovery_channel, selection_priority and query_origin_group."""
    given = F.col("priority") if "priority" in bank.columns else None
    out = bank.withColumn("discovery_channel", channel(F.col("language"), F.col("channel")))
    return out.withColumn("selection_priority", priority(given, F.col("source_stage"), F.col("discovery_channel"), F.col("scope_type"))).withColumn("query_origin_group", F.when(F.coalesce("query_origin", F.lit("")) == "", "not_applicable").otherwise(F.col("query_origin")))


def position(c: Column, order: Sequence[str], other: int) -> Column:
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), c), F.lit(0)) - 1, F.lit(other)).cast("int")


def sort_key(text: Column | None = None) -> Column:
    """Eleven ranks, as one struct that sorts as they do; ``text``: the signature of the query, if it is there already."""
    sig = signature(F.col("query_text")) if text is None else text
    by = lambda table: F.coalesce(F.create_map(*[F.lit(x) for p in table.items() for x in p])[F.col("search_region")], F.lit(9))
    region = F.when(F.col("discovery_channel") == "scholarly", by(REGION_RANKS["scholarly"])).otherwise(by(REGION_RANKS["web"]))
    rank = lambda c: position(F.col(c), RANKS[c], 9).alias(f"{c}_rank")
    return F.struct(
        rank("discovery_channel"), rank("source_stage"), F.col("selection_priority"), rank("query_kind"), rank("scope_type"), region.alias("region_rank"),
        position(F.col("weather_scenario"), SCENARIO_ORDER, len(SCENARIO_ORDER)).alias("scenario_rank"), position(F.col("action"), CORE_ACTIONS, len(CORE_ACTIONS)).alias("action_rank"),
        F.col("crop_key"), sig.alias("text"), F.col("combined_query_id"),
    )


def capacities(limit: int) -> dict[str, dict[str, int]]:
    """Fixed formulas: how many rows of a limit each value of a dimension may take; at least one each."""
    most = lambda n: max(1, n)
    web = most(limit * 3 // 4)
    return {
        "discovery_channel": {"web": web, "scholarly": most(limit - web)},
        "scope_type": {"crop_specific": most(limit * 3 // 4), "crop_group": most(limit // 4)},
        "query_kind": {"natural_question": min(32, most(limit // 3)), "effect": min(24, most(limit // 4))},
        "search_region": {k: most(limit * share // 100) for k, share in REGION_SHARES.items()},
    }


#: Columns that seeds and caps look at: rows that agree on them are told apart by the sort key alone.
DIMENSIONS = ("discovery_channel", "source_stage", "query_kind", "scope_type", "search_region", "weather_scenario", "crop_key")


def twin_key(text: Column | None = None) -> Column:
    """A hash of all that near duplicates agree on."""
    return F.sha2(F.to_json(near_duplicate(F.col("discovery_channel"), text)), 256)


def keyed(bank: DataFrame, scratch: Scratch) -> DataFrame:
    """(combined_query_id, DIMENSIONS, twin, key) of the rows that may be selected; written, as texts are normalised on the way."""
    rows = annotate(bank).where(F.col("discovery_channel").isin(*CHANNELS)).withColumn("_sig", signature(F.col("query_text")))
    return scratch.save(rows.select("combined_query_id", *DIMENSIONS, twin_key(F.col("_sig")).alias("twin"), sort_key(F.col("_sig")).alias("key")))


def projection(bank: DataFrame, scratch: Scratch) -> DataFrame:
    """(combined_query_id, DIMENSIONS, twin, pos) of the rows that may be selected: pos is a number that sorts as they do.

    Range-sorted and written once, so pos grows from file to file and within them; everything that follows reads this narrow table.
    """
    ordered = keyed(bank, scratch).repartitionByRange("key").sortWithinPartitions("key")
    return scratch.save(ordered.select("combined_query_id", *DIMENSIONS, "twin", F.monotonically_increasing_id().alias("pos")))


class _Pass:
    """The state of a selection: what is chosen, and how often each value was."""

    def __init__(self, limit: int):
        self.limit, self.caps = limit, capacities(limit)
        self.chosen: dict[str, None] = {}
        self.twins: set[str] = set()
        self.counts: Counter[tuple[str, str | None]] = Counter()

    def add(self, row: Row) -> None:
        self.chosen[row["combined_query_id"]] = None
        self.twins.add(row["twin"])
        self.counts.update((d, row[d]) for d in DIMENSIONS)

    def cap(self, dim: str, value: str | None, n: int) -> int | None:
        """How often a value may be taken once ``n`` rows are chosen. The caps of scenarios and crops grow with n."""
        most = {"weather_scenario": max(3, n // len(SCENARIO_ORDER) + 4), "crop_key": max(6, n // 8 + 8)}
        return most[dim] if dim in most else self.caps.get(dim, {}).get(value)

    def is_full(self, dim: str, value: str | None, at: int | None = None) -> bool:
        """No row with the value can be chosen now, or ``at`` a later number of chosen rows."""
        cap = self.cap(dim, value, len(self.chosen) if at is None else at)
        return cap is not None and self.counts[dim, value] >= cap

    def room(self, row: Row) -> bool:
        return not any(self.is_full(d, row[d]) for d in DIMENSIONS)

    def full(self, at: int | None = None) -> list[tuple[str, str | None]]:
        return [k for k in self.counts if self.is_full(*k, at)]


def _seed(table: DataFrame, scratch: Scratch, state: _Pass) -> None:
    """Take the seeds: of each predicate the first row in sort order; if that row is chosen already, that of the fallback.

    Every row says which predicates it meets, by kind and value; one aggregation gives each one's first row. The driver gets
    those of scenarios and regions, and of at most ``limit`` crops and as many groups.
    """
    c = F.col
    start = [r["crop_key"] for r in table.where("scope_type = 'crop_specific'").select("crop_key").distinct().orderBy("crop_key").limit(len(SCENARIO_ORDER)).collect()]
    preferred = {s: start[i % len(start)] for i, s in enumerate(SCENARIO_ORDER)} if start else {}
    own = F.coalesce(F.create_map(*[F.lit(x) for p in preferred.items() for x in p])[c("weather_scenario")].eqNullSafe(c("crop_key")), F.lit(False)) if preferred else F.lit(False)
    web, specific = c("discovery_channel") == "web", c("scope_type") == "crop_specific"
    asked = web & (c("source_stage") == "A2") & (c("query_kind") == "natural_question")
    effect = specific & (c("source_stage") == "A1") & (c("query_kind") == "effect")
    action = web & (c("source_stage") == "A1") & (c("query_kind") == "action")
    met = {
        "asked_own": (asked & specific & own, "weather_scenario"), "asked": (asked, "weather_scenario"),
        "web_own": (effect & web & own, "weather_scenario"), "web": (effect & web, "weather_scenario"),
        "scholarly_own": (effect & ~web & own, "weather_scenario"), "scholarly": (effect & ~web, "weather_scenario"),
        "crop": (action & specific, "crop_key"), "group": (action & (c("scope_type") == "crop_group"), "crop_key"), "region": (action, "search_region"),
    }
    tags = F.filter(F.array(*[F.when(p, F.struct(F.lit(k).alias("kind"), c(v).alias("value"))) for k, (p, v) in met.items()]), lambda x: x.isNotNull())
    row = F.struct("pos", "combined_query_id", "twin", *DIMENSIONS)
    firsts = scratch.save(table.select(F.explode(tags).alias("tag"), row.alias("row")).groupBy("tag.kind", "tag.value").agg(F.min("row").alias("row")))
    fixed_values = firsts.where(~c("kind").isin("crop", "group") & c("value").isin(*SCENARIO_ORDER, *SEED_REGIONS)).collect()
    found = {(r["kind"], r["value"]): r["row"] for r in fixed_values}
    seeds = [[found.get((f"{kind}_own", s)), found.get((kind, s))] for s in SCENARIO_ORDER for kind in ("asked", "web", "scholarly")]
    for kind in ("crop", "group"):
        seeds += [[r["row"]] for r in firsts.where(c("kind") == kind).orderBy("value").limit(state.limit).collect()]
    seeds += [[found.get(("region", r))] for r in SEED_REGIONS]
    for rows in seeds:
        for first in rows:
            if first is not None and first["combined_query_id"] not in state.chosen:
                state.add(first)
                break


def select_queries(bank: DataFrame, limit: int = 96, page: int | None = None) -> DataFrame:
    """At most ``limit`` rows of a combined bank, with selection_rank from 1.

    Seeds come first. Then the rows are gone through in sort order, and one is chosen if it is
    no near duplicate of a chosen one and no value of it has reached its cap. The pass runs on the driver over pages of
    ``page`` rows (8 times the limit) of the written projection: the next ones in sort order that are no near duplicate of a
    chosen row and have no value that stays full. If such a page has no row to choose, the next leaves out what is full now, so
    its first row is chosen, and ends once a cap has grown so that one of those values isn't full any more. So the result is that of a pass over the
    whole bank, and the driver holds a page, whatever the bank's size and number of crops.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    scratch, state, last, strict = Scratch(bank.sparkSession), _Pass(limit), -1, False
    table = projection(bank, scratch)
    _seed(table, scratch, state)
    while len(state.chosen) < limit:
        before, left_out = len(state.chosen), state.full(None if strict else limit)
        rows = table.where((F.col("pos") > last) & ~F.col("twin").isin(*state.twins))
        for dim in {d for d, _ in left_out}:
            values = [v for d, v in left_out if d == dim]
            found = F.col(dim).isin(*[v for v in values if v is not None]) | (F.col(dim).isNull() if None in values else F.lit(False))
            rows = rows.where(~F.coalesce(found, F.lit(False)))
        rows = rows.orderBy("pos").limit(page or 8 * limit).collect()
        if not rows:
            break
        for row in rows:
            last = row["pos"]
            if row["twin"] not in state.twins and state.room(row):
                state.add(row)
                if len(state.chosen) >= limit or (strict and not all(state.is_full(*k) for k in left_out)):
                    break
        strict = len(state.chosen) == before
    scratch.keep()
    ranks = bank.sparkSession.createDataFrame([(q, i) for i, q in enumerate(list(state.chosen)[:limit], 1)], "combined_query_id string, selection_rank int")
    return annotate(bank).join(F.broadcast(ranks), "combined_query_id")


def select_by_cap(df: DataFrame, dim: str, caps: dict[str, int], *order: Column) -> DataFrame:
    """The greedy pass where one dimension is capped: the first rows of each value."""
    cap = F.create_map(*[F.lit(x) for p in caps.items() for x in p])[F.col(dim)]
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(dim).orderBy(*order))).where(F.col("_rn") <= cap).drop("_rn")
