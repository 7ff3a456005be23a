"""Language identification by a bit-sliced Bloom filter of n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tillage.llm.common import Scratch, held_out, arrow_batches
from tillage.llm.ngrams import chunks, word_ngrams

UNKNOWN = "und"
#: Languages up to which tables with a row for each are broadcast.
_FEW = 10_000


@dataclass(frozen=True)
class Filters:
    """languages; slots[i] has bit l set if slot i is taken by language l; noise[l] is l's false-positive rate."""

    languages: tuple[str, ...]
    slots: np.ndarray
    probes: int
    orders: tuple[int, ...]
    noise: np.ndarray

    def masks(self, h: np.ndarray) -> np.ndarray:
        """For each hash, the set of languages (a row of 64-bit words) whose filter contains it."""
        top = np.uint64(len(self.slots) - 1)
        step = (h >> np.uint64(32)) | np.uint64(1)
        found = self.slots[(h & top).astype(np.int64)]
        for k in range(1, self.probes):
            found = found & self.slots[((h + np.uint64(k) * step) & top).astype(np.int64)]
        return found

    def shares(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Each language's share of each text's n-grams, false positives taken out; and letters per text."""
        h, owner, letters = word_ngrams(texts, self.orders)
        found = self.masks(h)
        total = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
        out = np.empty((len(texts), len(self.languages)))
        for k in range(len(self.languages)):
            bit = (found[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)
            seen = np.bincount(owner, weights=bit, minlength=len(texts)) / total
            out[:, k] = np.clip((seen - self.noise[k]) / max(1e-9, 1 - self.noise[k]), 0, 1)
        return out, letters


def build(profiles: dict[str, np.ndarray], orders: tuple[int, ...], probes: int, room: int) -> Filters:
    """profiles: n-gram hashes by language. room: slots for each n-gram of the largest profile."""
    languages = tuple(sorted(profiles))
    size = 1 << int(np.ceil(np.log2(max(64, room * max((len(p) for p in profiles.values()), default=1)))))
    slots = np.zeros((size, (len(languages) + 63) // 64 or 1), np.uint64)
    for k, name in enumerate(languages):
        h = profiles[name]
        step = (h >> np.uint64(32)) | np.uint64(1)
        for j in range(probes):
            at = np.unique((h + np.uint64(j) * step) & np.uint64(size - 1)).astype(np.int64)
            slots[at, k // 64] |= np.uint64(1) << np.uint64(k % 64)
    fill = np.array([((slots[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(languages))])
    return Filters(languages, slots, probes, orders, fill**probes)


def _counts(orders: tuple[int, ...]):
    def run(batches):
        for pdf in batches:
            for lang, part in pdf.groupby("lang"):
                for _, texts in chunks(part["text"]):
                    gram, n = np.unique(word_ngrams(texts, orders)[0], return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": gram.view(np.int64), "n": n.astype(np.int64)})

    return run


def train(docs: DataFrame, per_language: int = 3000, orders: tuple[int, ...] = (3, 4, 5), least: float = 2e-5, ratio: float = 0.2, probes: int = 4, room: int = 12) -> Filters:
    """Learn filters from ``docs`` (text, lang), leaving out null and empty lang and held-out doc_ids.

    ``per_language`` bounds the labelled documents counted for a language: where it has more, the
    share that has this size is taken by a hash of doc_id. An n-gram enters a language's filter
    if it makes up ``least`` of the language's n-grams, so a profile has 1 / least n-grams at
    most, and at least ``ratio`` times the share it has in any language, which keeps out what
    leaked in with quotations and wrong labels. Languages are a dimension of the model (each has a bit of
    every slot), so their number is taken to fit the driver, as the filters do.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    arrow_batches(spark)
    known = docs.select("doc_id", "text", "lang").where("lang is not null and lang <> '' and text is not null").where(~held_out("doc_id"))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return build({}, orders, probes, room)
    few = lambda d: F.broadcast(d) if len(sizes) <= _FEW else d  # noqa: E731  a row for each language
    part = spark.createDataFrame([(k, min(1.0, per_language / n)) for k, n in sizes.items()], "lang string, part double")
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    sample = known.join(few(part), "lang").where(F.coalesce(draw, F.lit(0.0)) < F.col("part")).select("lang", "text")
    counts = scratch.save(sample.mapInPandas(_counts(orders), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    common = counts.join(few(totals), "lang").where(F.col("n") >= F.greatest(F.lit(2), F.col("total") * least))
    frame = common.select("lang", "gram", (F.col("n") / F.col("total")).alias("share")).toPandas()
    scratch.drop(counts)
    frame = frame[frame["share"] >= ratio * frame.groupby("gram")["share"].transform("max")]
    profiles = {k: np.sort(g["gram"].to_numpy().view(np.uint64)) for k, g in frame.groupby("lang")}
    return build(profiles, orders, probes, room)


def predict(docs: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """Add lang_pred and score (0 to 1) to ``docs``.

    The language with the largest corrected share of the text's n-grams wins, ties to the first in
    the alphabet; the score is that share. A null text and one without a letter are `und` with score 0. A text
    with letters gets a learned language, with score 0 (the first in the alphabet) if no filter knows any of its
    n-grams; if no language was learned it is `und` too. Columns of these two names are replaced, all others stay.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(filters)

    @F.pandas_udf("lang_pred string, score double")
    def run(column: pd.Series) -> pd.DataFrame:
        f = shared.value
        names, scores = np.full(len(column), UNKNOWN, object), np.zeros(len(column))
        if f.languages:
            for first, texts in chunks(column):
                share, letters = f.shares(texts)
                best = share.argmax(1)
                has = letters > 0
                names[first : first + len(texts)][has] = np.array(f.languages, object)[best[has]]
                scores[first : first + len(texts)][has] = share[np.arange(len(texts)), best][has]
        return pd.DataFrame({"lang_pred": names, "score": scores})

    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")])
    return docs.select(rest.alias("row"), run(F.col(text)).alias("found")).select("row.*", "found.*")
