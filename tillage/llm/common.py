"""Shared plumbing: grouped Arrow streaming, blocked buckets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillage.sources.scratch import Scratch, shared_dir  # noqa: F401

#: Bytes of one Arrow batch sent to Python, whether its rows are whole texts or a few numbers.
BATCH_BYTES = 1_000_000


def arrow_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes: one setting for every plan, whenever it runs."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def held_out(doc_id) -> F.Column:
    """True for the rows that no model here learns from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def starts(columns: list[np.ndarray]) -> np.ndarray:
    """Positions where a new run of equal keys starts, for sorted key columns."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def map_runs(df: DataFrame, keys: list[str], work, schema: str, rows: int = 20_000) -> DataFrame:
    """Bring equal keys together, sorted, and stream them through ``work(table) -> record batches``.

    ``work`` gets whole runs only, many at a time, so tiny groups cost no call each. Keys are
    integers. Memory is that of ``rows`` rows plus the largest run; callers bound their runs.
    """

    def stream(batches):
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < rows:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            cut = int(starts([table[k].to_numpy() for k in keys])[-1])
            if cut:
                yield from work(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
            else:
                held = table.to_batches()
            n = sum(b.num_rows for b in held)
        if n:
            yield from work(pa.Table.from_batches(held).combine_chunks())

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(stream, schema)


def blocked(scratch: Scratch, members: DataFrame, keys: list[str], spread: str, block: int) -> DataFrame:
    """Split each bucket into blocks and pair the blocks, so that no bucket lands in one task.

    Adds block_i, block_j and side. Two members of one bucket meet in exactly one (block_i,
    block_j) cell: on different sides, or anywhere in it where block_i = block_j. A cell holds
    about 2 * block rows whatever the size of the bucket. Buckets of one member are dropped.
    """
    sizes = scratch.save(members.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    parts = F.ceil(F.col("_n") / block).cast("int")
    mine = F.pmod(F.xxhash64(spread), F.col("_parts")).cast("int")
    return (
        members.join(sizes, keys)
        .withColumn("_parts", parts)
        .withColumn("_mine", mine)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .withColumn("block_i", F.least("_mine", "_other"))
        .withColumn("block_j", F.greatest("_mine", "_other"))
        .withColumn("side", (F.col("_mine") > F.col("_other")).cast("int"))
        .drop("_n", "_parts", "_mine", "_other")
    )


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the nodes that aren't the smallest."""
    if not len(u):
        return u, v
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    rest = label != np.arange(len(nodes))
    return nodes[rest], nodes[label[rest]]


def edge_batch(u: np.ndarray, v: np.ndarray, names=("u", "v")) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=list(names))
