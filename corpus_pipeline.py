"""The corpus pipeline: five stages over the documents table, each calling one operator of tillage.llm.

Every stage works on all that its predecessor kept and rereads it from a written table. All but the
last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers
from tillage.llm import language_id, toxicity
from tillage.llm.common import Scratch
from tillage.llm.line_dedup import dedup_lines
from tillage.llm.packing import pack_documents
from tillage.llm.simhash import simhash_groups

#: Share of a text's n-grams that its language must know. Running text has 0.7 and more.
LEAST_LANGUAGE = 0.3


def _whole(docs: DataFrame) -> DataFrame:
    """(text, _row): lets an operator add columns without touching those that are there."""
    return docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents without a letter, null texts, and those hardly any of whose n-grams a language knows."""
    filters = language_id.train(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    found = language_id.predict(_whole(docs), filters)
    return found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE)).select("_row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier, learned from the labels table, predicts to be toxic."""
    model = toxicity.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.predict(_whole(docs), model).where("predicted = 0").select("_row.*")


def dedup_document_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one line of each near-duplicate group; a document all of whose text went is dropped. n_chars follows the text."""
    out = dedup_lines(docs)
    gone = (F.col("n_removed") > 0) & (F.btrim("text", F.lit(" \t\r\n\f\x0b")) == "")
    columns = [F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return out.where(~F.coalesce(gone, F.lit(False))).select(*columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each SimHash group; rows without a doc_id stay.

    Groups are op3's: 3-word shingles, links of at most 3 differing bits. That reaches copies and all but
    identical texts, not the similarity of 0.8 of the line stage (README). A doc_id with several texts,
    or other columns, is as many documents, each in the group of its own text; of one group's the
    smallest by (doc_id, a hash of the row) stays. Rows repeated in full count once.
    """
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    keyed = docs.where("doc_id is not null").select(F.xxhash64("doc_id", "text", F.to_json(others)).alias("key"), "doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    groups = simhash_groups(keyed.select(F.col("key").alias("doc_id"), "text")).select(F.col("doc_id").alias("key"), "component_id").distinct()
    placed = groups.join(keyed.select("key", "doc_id").distinct(), "key")
    first = placed.groupBy("component_id").agg(F.min(F.struct("doc_id", "key")).alias("first")).select("first.key")
    kept = keyed.join(first, "key", "left_semi").dropDuplicates(["key"]).select("row.*")
    return kept.unionByName(docs.where("doc_id is null"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_document_lines),
    ("simhash_dedup", dedup_documents),
    ("packing", pack),
]

#: The stages learn, iterate or tokenize, which SQL can't express; tests/llm/test_pipeline.py holds
#: run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir))
        scratch.keep(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
