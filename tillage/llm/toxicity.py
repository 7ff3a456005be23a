"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tillage.llm.common import Scratch, held_out, arrow_batches
from tillage.llm.ngrams import chunks, text_ngrams


@dataclass(frozen=True)
class Model:
    """weights of the hashed n-grams (ratio times learned factor), the intercept, and how features are made."""

    weights: np.ndarray
    intercept: float
    orders: tuple[int, ...]

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of the label for each text; every distinct n-gram of the whole text counts once."""
        own, feature = distinct(texts, self.orders, len(self.weights), self.weights != 0)
        return 1 / (1 + np.exp(-np.clip(self.intercept + np.bincount(own, self.weights[feature], len(texts)), -500, 500)))


def distinct(texts: list[str], orders: tuple[int, ...], size: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of the distinct hashed n-grams of each text, sorted; only those ``wanted`` if given."""
    h, own = text_ngrams(texts, orders)
    feature = (h % np.uint64(size)).astype(np.int64)
    if wanted is not None:
        keep = wanted[feature]
        own, feature = own[keep], feature[keep]
    both = np.unique(own.astype(np.int64) * size + feature)
    return both // size, both % size


def log_count_ratio(rows: list[np.ndarray], label: np.ndarray, size: int, smooth: float, rare: int) -> np.ndarray:
    """log of the smoothed share of the positive texts' features over that of the negative ones'; 0 for rare features."""
    counts = np.zeros((2, size), np.int64)
    for features, y in zip(rows, label, strict=True):
        counts[int(y), features] += 1  # a row's features are distinct
    n, m = max(1, int(label.sum())), max(1, int((1 - label).sum()))
    ratio = np.log((counts[1] + smooth) / (n + 2 * smooth)) - np.log((counts[0] + smooth) / (m + 2 * smooth))
    return np.where(counts.sum(0) >= rare, ratio, 0.0)


def fit(rows: list[np.ndarray], label: np.ndarray, size: int, orders: tuple[int, ...], smooth: float = 1.0, rare: int = 8, strongest: float = 1.0, penalty: float = 30.0, rounds: int = 200) -> Model:
    """Logistic regression with an L2 penalty over the scaled features, by accelerated gradient descent.

    rows: each text's distinct features, shortened in place to those whose ratio is ``strongest`` or more
    either way, so memory is that of the given arrays and of what is left of them.
    """
    ratio = log_count_ratio(rows, label, size, smooth, rare)
    strong = np.abs(ratio) >= strongest
    for i, features in enumerate(rows):
        rows[i] = features[strong[features]]
    own = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    feature = np.concatenate(rows)
    rows.clear()
    # Columns by a table of all features: sorting the features would take several times their memory.
    columns = np.flatnonzero(np.bincount(feature, minlength=size))
    place = np.zeros(size, np.int32)
    place[columns] = np.arange(len(columns), dtype=np.int32)
    at = place[feature]
    del feature
    value = ratio[columns].astype(np.float32)[at]
    n = len(label)
    w, b = np.zeros(len(columns)), float(np.log((label.sum() + 1) / (n - label.sum() + 1)))
    v, c = w.copy(), b
    # A bound on the curvature: the largest squared row norm, met by power steps on the scaled features.
    x = np.ones(len(columns))
    for _ in range(15):
        y = np.bincount(own, value * x[at], n)
        x = np.bincount(at, value * y[own], len(columns))
        norm = np.linalg.norm(x) or 1.0
        x /= norm
    rate = 1 / (0.25 * (norm * 1.1 + n) + penalty)
    for k in range(rounds):
        z = np.clip(c + np.bincount(own, value * v[at], n), -500, 500)
        error = 1 / (1 + np.exp(-z)) - label
        w_new = v - rate * (np.bincount(at, value * error[own], len(columns)) + penalty * v)
        b_new = c - rate * error.sum()
        step = k / (k + 3)
        v, c = w_new + step * (w_new - w), b_new + step * (b_new - b)
        w, b = w_new, b_new
    weights = np.zeros(size)
    weights[columns] = ratio[columns] * w
    return Model(weights, b, orders)


def train(docs: DataFrame, labels: DataFrame, per_class: int = 6000, orders: tuple[int, ...] = (3, 4, 5), size: int = 1 << 18) -> Model | None:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), leaving out held-out doc_ids.

    ``per_class`` bounds the labelled documents of a class: where it has more, a share of this size
    is taken by a hash of doc_id. The model is fitted in one task over these at most 2 * per_class
    documents, in the order of their ids, so it doesn't depend on how the rows lie; the classes' shares are put
    back into the intercept. A doc_id with several labels counts as toxic if one is 1; of several
    texts of a doc_id, repeats included, one counts (the smallest hash). Null: nothing was labelled.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    arrow_batches(spark)
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    part = F.when(F.col("toxic") == 1, min(1.0, per_class / sizes[1])).otherwise(min(1.0, per_class / sizes[0]))
    sample = scratch.save(known.where(draw < part))
    made = docs.where("text is not null").select("doc_id", "text", F.xxhash64("text").alias("hash")).join(F.broadcast(sample), "doc_id")

    def features(batches):
        for pdf in batches:
            for first, texts in chunks(pdf["text"]):
                own, feature = distinct(texts, orders, size)
                cut = np.searchsorted(own, np.arange(1, len(texts)))
                rows = slice(first, first + len(texts))
                yield pd.DataFrame({**{c: pdf[c].to_numpy()[rows] for c in ("doc_id", "toxic", "hash")}, "features": [f.astype(np.int32) for f in np.split(feature, cut)]})

    each = made.mapInPandas(features, "doc_id long, toxic int, hash long, features array<int>")
    vectors = scratch.save(each.groupBy("doc_id").agg(F.min_by(F.struct("toxic", "features"), "hash").alias("v")).select("doc_id", "v.*"))
    # Each class has a share of 1 / part of the sample's odds.
    prior = min(1.0, per_class / sizes[0]) / min(1.0, per_class / sizes[1])

    def learn(batches):
        rows = []
        for pdf in batches:
            rows += [(i, y, np.array(f, np.int32)) for i, y, f in zip(pdf["doc_id"], pdf["toxic"], pdf["features"], strict=True)]
        if rows:
            rows.sort(key=lambda r: r[0])
            label = np.array([y for _, y, _ in rows], np.float64)
            rows = [f for _, _, f in rows]
            model = fit(rows, label, size, orders)
            yield pd.DataFrame({"intercept": [model.intercept + np.log(prior)], "weights": [model.weights]})

    row = vectors.coalesce(1).mapInPandas(learn, "intercept double, weights array<double>").first()
    scratch.keep()
    return Model(np.array(row["weights"]), row["intercept"], orders) if row else None


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add score (0 to 1) and predicted (1 if score >= 0.5) to ``docs``; columns of these names are replaced.

    Null and empty texts get the score of a text without n-grams; without a model every score is 0.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(column: pd.Series) -> pd.Series:
        out = np.zeros(len(column))
        if shared.value is not None:
            for first, texts in chunks(column):
                out[first : first + len(texts)] = shared.value.scores(texts)
        return pd.Series(out)

    rest = [f"`{c}`" for c in docs.columns if c.lower() not in ("score", "predicted")]
    return docs.select(*rest, run(F.col(text)).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
