"""Merging search hits into one candidate per document, with every query kept as provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillage.functions.text import nonempty, stable_id
from tillage.functions.urls import canonicalize, domain

#: Fields of the hit that found a document first stand for it.
FIRST = ("url", "language", "discovery_channel", "query_id", "original_query_id", "original_query_text", "search_variant_text", "search_variant_type", "query_text", "crop_scope", "crop_key", "scenario", "action", "search_region", "source_type", "retrieved_at")
#: The first non-empty value of all hits.
FIRST_FILLED = ("title", "snippet", "doi", "abstract")
#: Ordered unions of lists, and of single values.
LISTS = ("subjects", "relevance_reasons", "matched_crop_terms", "matched_scenario_terms", "matched_action_terms")
VALUES = {"discovery_providers": "provider", "languages": "language", "discovery_channels": "discovery_channel", "source_stages": "source_stage", "query_origins": "query_origin"}
REFERENCE = (
    "query_id", "original_query_id", "original_query_text", "search_variant_text", "search_variant_type", "source_stage", "source_query_id", "query_origin", "query_text", "language", "discovery_channel", "query_kind",
    "crop_scope", "crop_key", "scenario", "action", "search_region", "result_rank", "provider", "relevance_status", "relevance_score", "relevance_reasons", "matched_crop_terms", "matched_scenario_terms", "matched_action_terms",
)


def document_key(url: Column) -> Column:
    """The canonical URL, or the URL itself marked as invalid."""
    c = canonicalize(url)
    return F.when(c != "", c).otherwise(F.concat(F.lit("INVALID:"), F.coalesce(url, F.lit(""))))


def _sorted(ord_: str, value: Column) -> Column:
    """Values of a group in the order of ``ord_``; collect_list alone keeps no order after a shuffle."""
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(ord_).alias("o"), value.alias("v")))), lambda x: x["v"])


def _union(values: Column) -> Column:
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != "")))


def merge_hits(hits: DataFrame, ord_: str = "ord") -> DataFrame:
    """One row per document key.

    Scalars come from the first hit by ``ord_`` (unique), texts from the first that has one, the
    score is the largest and its status that of the first hit that reaches it; lists are ordered
    unions; every hit is a query reference. What is gathered per document is bounded by the
    queries that found it, a property of the query bank and not of the corpus.
    """
    first = lambda c: F.min_by(c, ord_)
    some = lambda c: F.coalesce(F.min_by(c, F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(ord_))), F.lit(""))
    keyed = hits.withColumn("_key", document_key(F.col("url"))).withColumn("canonical_url", canonicalize(F.col("url")))
    by_score = F.struct(-F.col("relevance_score"), F.col(ord_))
    merged = keyed.groupBy("_key").agg(
        first("canonical_url").alias("canonical_url"),
        *[first(c).alias(c) for c in FIRST],
        *[some(c).alias(c) for c in FIRST_FILLED],
        F.max("relevance_score").alias("relevance_score"),
        F.min_by("relevance_status", by_score).alias("relevance_status"),
        *[_union(F.flatten(_sorted(ord_, F.coalesce(F.col(c), F.array().cast("array<string>"))))).alias(c) for c in LISTS],
        *[_union(_sorted(ord_, F.col(c))).alias(k) for k, c in VALUES.items()],
        F.count(F.lit(1)).cast("int").alias("raw_result_count"),
        _sorted(ord_, F.struct(*REFERENCE)).alias("query_references"),
    )
    ident = stable_id("CD-", nonempty(F.col("canonical_url"), F.col("url")))
    status = F.when(F.col("title") != "", "from_search_result").otherwise("missing_from_search_result")
    return merged.drop("_key").withColumns({"candidate_id": ident, "title_status": status, "source_domain": domain(F.col("canonical_url"))})
