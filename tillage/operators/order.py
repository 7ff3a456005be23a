"""Global order without a global window: range partitions, their totals, and offsets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillage.sources.scratch import Scratch


def running(df: DataFrame, order: Column, value: Column, by: Column | None = None, name: str = "before", scratch: Scratch | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """Adds ``name`` (replaced if there) to the columns ``keep`` (all): the sum of ``value`` over the rows of the same ``by`` that come earlier in ``order``.

    Rows are dealt to tasks by ranges of (by, order), so a group of any size is cut into as many
    pieces as it needs. The ranges are written, each task's totals for each group are added up across
    the tasks that the group is in, and every piece starts from the total of the pieces before it. The
    two windows hold one range of rows, and one row for each (task, group). ``order`` and ``by`` are
    single columns, structs for several; nulls are values and sort first, a null ``value`` adds nothing.
    Rows that agree on (by, order) stay in one task and stand in any order; a caller who expects many
    combines them or adds to the order. An empty table gives no rows.
    """
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in (df.columns if keep is None else keep) if c.lower() != name.lower()]).alias("row"), F.struct(F.lit(0) if by is None else by).alias("by"), F.struct(order).alias("at"), F.coalesce(value, F.lit(0)).alias("value"))
    placed = (scratch or Scratch(df.sparkSession)).save(rows.repartitionByRange("by", "at").withColumn("part", F.spark_partition_id()))
    earlier = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("part", "by").agg(F.sum("value").alias("total"))
    offsets = totals.select("part", "by", F.coalesce(F.sum("total").over(earlier("by").orderBy("part")), F.lit(0)).alias("offset"))
    within = placed.withColumn("within", F.coalesce(F.sum("value").over(earlier("part", "by").orderBy("at")), F.lit(0)))
    return within.join(offsets, ["part", "by"]).select("row.*", (F.col("within") + F.col("offset")).alias(name))


def positions(df: DataFrame, order: Column, by: Column | None = None, name: str = "position", scratch: Scratch | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """Adds the place of each row in ``order`` among the rows of the same ``by``, from 0; see running."""
    return running(df, order, F.lit(1), by, name, scratch, keep)
