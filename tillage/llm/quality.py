"""Importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillage.llm.common import Scratch, arrow_batches

_WORD = re.compile(r"\w+|[^\w\s]+")
_hashes: dict[str, int] = {}
_WORDS = 300_000


def features(text: str | None, buckets: int) -> np.ndarray:
    """Bucket of each word and of each pair of neighbouring words, repeats included."""
    words = _WORD.findall((text or "").lower())
    if not words:
        return np.zeros(0, np.int64)
    if len(_hashes) > _WORDS:
        _hashes.clear()
    get = _hashes.get
    h = []
    for w in words:
        x = get(w)
        if x is None:
            x = _hashes[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "replace"), 7)
        h.append(x)
    one = np.array(h, np.uint64)
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]
    both = np.concatenate([one, two ^ (two >> np.uint64(29))])
    return (both % np.uint64(buckets)).astype(np.int64)


def _count(buckets: int):
    def run(batches):
        total = np.zeros((2, buckets), np.int64)
        for pdf in batches:
            for text, target in zip(pdf["text"], pdf["target"], strict=True):
                f = np.bincount(features(text, buckets), minlength=buckets)
                total[0] += f
                if target:
                    total[1] += f
        yield pd.DataFrame({"bucket": np.arange(buckets, dtype=np.int32), "raw": total[0], "target": total[1]})

    return run


def fit(docs: DataFrame, target: DataFrame, buckets: int = 16384, smooth: float = 1.0) -> np.ndarray:
    """log p_target - log p_raw of each bucket.

    The raw model counts every row of ``docs`` (doc_id, text), the target model those whose doc_id
    is in ``target`` (doc_id). Both are smoothed by ``smooth`` for each bucket. Tasks count into
    arrays of ``buckets`` numbers, which are added up; without a target row all ratios are 0. The
    target grows with the corpus, so both sides are shuffled by doc_id at every size.
    """
    arrow_batches(docs.sparkSession)
    ids = target.select("doc_id").where("doc_id is not null").distinct().withColumn("target", F.lit(True))
    marked = docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))
    parts = marked.mapInPandas(_count(buckets), "bucket int, raw long, target long")
    sums = parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, good = np.zeros(buckets), np.zeros(buckets)
    raw[sums["bucket"]], good[sums["bucket"]] = sums["raw"], sums["target"]
    if not good.sum():
        return np.zeros(buckets)
    return np.log((good + smooth) / (good.sum() + smooth * buckets)) - np.log((raw + smooth) / (raw.sum() + smooth * buckets))


def _kth_largest(rows: DataFrame, column: str, k: int) -> tuple[int, int]:
    """The k-th largest value of a long column, sixteen bits at a time, and how many of its rows are among the k."""
    low, rest = None, k
    for shift in (48, 32, 16, 0):
        bits = F.shiftright(column, shift)
        here = rows if low is None else rows.where(F.shiftright(column, shift + 16) == low)
        for value, n in sorted(((r["bits"], r["count"]) for r in here.groupBy(bits.alias("bits")).count().collect()), reverse=True):
            if rest <= n:
                low = value
                break
            rest -= n
    return low, rest


def resample(docs: DataFrame, ratios: np.ndarray, share: float = 0.5, seed: int = 17) -> DataFrame:
    """(doc_id, log_weight, gumbel_key, selected) for every row of ``docs`` (doc_id, text).

    log_weight is the sum of the log ratios of the text's features: the importance weight of target
    over raw. gumbel_key adds Gumbel noise drawn from a hash of doc_id and ``seed``, and the
    ceil(share * rows) rows with the largest keys are selected: a sample without replacement in
    proportion to the weights. Of rows with the same key at the border (repeated rows, and null doc_ids
    with texts of the same weight, which share one draw) as many are selected as there is room for.
    Null and empty texts weigh 0; repeated rows are rows of their own. An empty table gives no
    rows; extra columns are ignored.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    arrow_batches(spark)
    shared, buckets = spark.sparkContext.broadcast(ratios), len(ratios)

    @F.pandas_udf("log_weight double, gumbel_key double, place long")
    def weigh(texts: pd.Series, uniform: pd.Series) -> pd.DataFrame:
        r = shared.value
        weight = np.array([float(r[features(t, buckets)].sum()) for t in texts], np.float64)
        key = weight - np.log(-np.log(uniform.to_numpy()))
        bits = (key + 0.0).view(np.int64)
        # A long that sorts as the key does.
        return pd.DataFrame({"log_weight": weight, "gumbel_key": key, "place": np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)})

    uniform = (F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / float(1 << 52)
    scored = scratch.save(docs.select("doc_id", weigh("text", uniform).alias("w")).select("doc_id", "w.*", F.monotonically_increasing_id().alias("row")))
    n = scored.count()
    if not n:
        return scored.select("doc_id", "log_weight", "gumbel_key", F.lit(False).alias("selected"))
    border, room = _kth_largest(scored, "place", int(np.ceil(share * n)))
    last, _ = _kth_largest(scored.where(F.col("place") == border), "row", room)
    chosen = (F.col("place") > border) | ((F.col("place") == border) & (F.col("row") >= last))
    return scored.select("doc_id", "log_weight", "gumbel_key", chosen.alias("selected"))
