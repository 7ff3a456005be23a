"""Connected components by alternating large-star and small-star over tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tillage.llm.common import Scratch, edge_batch, forest, arrow_batches

_GATHER = 200_000


def _local(gather: int):
    """Replace the edges a task reads by a spanning forest of stars, ``gather`` at a time; 0: all at once."""

    def run(batches):
        us, vs, n = [], [], 0
        for b in batches:
            us.append(b["u"].to_numpy())
            vs.append(b["v"].to_numpy())
            n += b.num_rows
            if gather and n >= gather:
                yield edge_batch(*forest(np.concatenate(us), np.concatenate(vs)))
                us, vs, n = [], [], 0
        if n:
            yield edge_batch(*forest(np.concatenate(us), np.concatenate(vs)))

    return run


def connected_components(scratch: Scratch, edges: DataFrame, small: int = 500_000) -> DataFrame:
    """(id, root) for every node that has an edge to another node; root is its component's smallest id.

    ``edges`` has long columns u and v in any order; self loops and repeats are allowed, rows with
    a null end are dropped. Each round is two aggregations that combine before the shuffle and two
    joins between written tables, which AQE can split where a node has very many edges. Nothing
    is collected but one checksum a round. Once the reduced graph has at most ``small`` edges, one
    task finishes it, which gives the same labels in fewer jobs. An empty table gives an empty table.
    """
    arrow_batches(scratch.spark)
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u is not null and v is not null and u <> v")
    e = scratch.save(e.mapInArrow(_local(_GATHER), "u long, v long").distinct())
    total = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = total(e)
    while before[0] > small:
        both = e.select(F.col("v").alias("n"), F.col("u").alias("other")).union(e.select("u", "v"))
        least = scratch.save(both.groupBy("n").agg(F.least(F.min("other"), F.col("n")).alias("m")))
        large = scratch.save(e.join(least, e.v == least.n).select("u", F.col("m").alias("v")).distinct())
        first = scratch.save(large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")))
        two = F.explode(F.array(F.struct(F.col("u"), F.col("m")), F.struct(F.col("v").alias("u"), F.col("m"))))
        star = scratch.save(
            large.join(first, large.u == first.n).select(two.alias("x")).select("x.u", F.col("x.m").alias("v")).where("u <> v").distinct()
        )
        scratch.drop(e, least, large, first)
        e, after = star, total(star)
        if after == before:
            break
        before = after
    else:
        e = scratch.save(e.coalesce(1).mapInArrow(_local(0), "u long, v long"))
    labels = e.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return labels.union(labels.select(F.col("root").alias("id"), "root").distinct())
