"""First-wins deduplication, ranking, counting and coverage over any DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_wins(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """The first row of each key in the given order. A row_number of 1 is pruned before the shuffle."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def ordered_union(parts: Sequence[DataFrame], key: Column, *order: str) -> DataFrame:
    """Rows of the parts, earlier parts first, the first row of each key only."""
    tagged = [p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)]
    every = reduce(lambda a, b: a.unionByName(b), tagged)
    return first_wins(every, key, F.col("_part"), *map(F.col, order)).drop("_part")


def top_k(df: DataFrame, by: Sequence[str], k: int, *order: Column, rank: str = "rank") -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def matches(criteria: Mapping[str, object]) -> Column:
    """All of the columns equal the given values; a null matches null."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(v) for c, v in criteria.items()], F.lit(True))


def first_per_criterion(df: DataFrame, criteria: Sequence[Mapping[str, object]], order: Sequence[Column], limit: int, unique: str) -> DataFrame:
    """For each criterion its first row not taken by an earlier one, then further rows in order, up to ``limit``.

    Only the first len(criteria) rows of each criterion can ever be taken, so those are ranked in
    the cluster; which of them are taken is settled among these at most len(criteria)^2 rows.
    """
    n = len(criteria)
    rank_all = df.withColumn("_pos", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))
    tagged = rank_all.withColumn("_criterion", F.explode(F.filter(F.array(*[F.when(matches(c), F.lit(i)) for i, c in enumerate(criteria)]), lambda x: x.isNotNull())))
    near = top_k(tagged, ["_criterion"], n, F.col("_pos"), rank="_rank").select(unique, "_criterion", "_rank").collect()
    taken: dict[object, int] = {}
    for i in range(n):
        for r in sorted((r for r in near if r["_criterion"] == i), key=lambda r: r["_rank"]):
            if r[unique] not in taken:
                taken[r[unique]] = i
                break
    chosen = F.lit(None).cast("int")
    for key, i in taken.items():
        chosen = F.when(F.col(unique) == F.lit(key), F.lit(i)).otherwise(chosen)
    return rank_all.withColumn("_chosen", chosen).orderBy(F.col("_chosen").asc_nulls_last(), "_pos").limit(limit).drop("_chosen", "_pos")


def representatives(df: DataFrame, dims: Sequence[str], order: Column, limit: int) -> DataFrame:
    """Up to ``limit`` rows: for each dimension in turn the first row of every value not seen before."""
    each = df.withColumn("_d", F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), F.col(d).cast("string").alias("value")) for i, d in enumerate(dims)])))
    firsts = first_wins(each.select(order.alias("_o"), "_d.dim", "_d.value"), F.struct("dim", "value"), F.col("_o"))
    marked = firsts.groupBy("_o").agg(F.min("dim").alias("_dim"))
    return df.withColumn("_o", order).join(marked, "_o", "left").orderBy(F.col("_dim").asc_nulls_last(), "_o").limit(limit).drop("_o", "_dim")


def count_by(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def count_by_dims(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """(dim, key, n) for every value of every dimension: one pass, one partial aggregation."""
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("key")) for d in dims]))
    return df.select(each.alias("x")).groupBy("x.dim", "x.key").agg(F.count(F.lit(1)).alias("n"))


def count_with_defaults(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """(key, n) over exactly the given keys; 0 for those without rows. ord keeps their order."""
    wanted = df.sparkSession.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, ord int")
    counts = df.where(F.col(column).isin(*keys)).groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return wanted.join(counts, "key", "left").select("key", "ord", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def domain_breakdown(df: DataFrame, domain: str, order: str) -> DataFrame:
    """(domain, n, first_seen) of non-empty domains, most rows first, ties by first appearance."""
    some = df.where(F.coalesce(F.col(domain), F.lit("")) != "")
    return some.groupBy(F.col(domain).alias("domain")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_seen")).orderBy(F.desc("n"), "first_seen")


def coverage(df: DataFrame, hits: Column) -> DataFrame:
    """One row: queries executed, with hits, without, and the rate to four digits (0.0 for none)."""
    n, hit = F.count(F.lit(1)), F.count_if(hits > 0)
    return df.agg(n.alias("executed"), hit.alias("with_hits"), (n - hit).alias("without_hits"), F.when(n == 0, F.lit(0.0)).otherwise(F.bround(hit / F.greatest(n, F.lit(1)), 4)).alias("query_hit_rate"))


def missing(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key isn't in the other table."""
    return df.join(other.select(*on).distinct(), list(on), "left_anti")


def missing_pairs(left: DataFrame, right: DataFrame, present: DataFrame) -> DataFrame:
    """Pairs of two small dimensions (of fixed size) that no row of ``present`` has."""
    return left.crossJoin(right).join(present.select(*left.columns, *right.columns).distinct(), [*left.columns, *right.columns], "left_anti")


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row: how many rows meet each condition. Null is not met."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
