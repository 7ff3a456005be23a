"""Each registered query against its contract: columns, types, one row for each row of its table."""

import zlib

import pytest
from pyspark.sql import functions as F

from tillage.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_line_dedup": {"doc_id": "bigint", "text": "string", "n_lines": "int", "n_removed": "int"},
    "op2_best_two_fit_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op3_simhash_dedup": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op4_token_counts": {"doc_id": "bigint", "section": "int", "n_chars": "bigint", "n_tokens": "bigint", "doc_tokens": "bigint"},
    "op5_embedding_dedup": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op6_nearest_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op7_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8_importance_resampling": {"doc_id": "bigint", "log_weight": "double", "gumbel_key": "double", "selected": "boolean"},
    "op9_sentencepiece_nbest": {"doc_id": "bigint", "rank": "int", "score": "double", "n_ids": "bigint", "ids_crc32": "bigint", "exact": "boolean"},
    "op10_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op11_source_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op12_embedding_whitening": {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"},
    "op13_target_resampling": {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"},
}


@pytest.fixture(scope="module")
def results(spark):
    return {name: (df := f(spark, SF), df.toPandas()) for name, f in QUERIES.items()}


def test_every_query_is_here():
    assert list(COLUMNS) == list(QUERIES)


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns_and_types(results, name):
    assert dict(results[name][0].dtypes) == COLUMNS[name]


@pytest.mark.parametrize("name", ["op1_line_dedup", "op3_simhash_dedup", "op7_toxicity", "op8_importance_resampling", "op10_language_id", "op11_source_mixing", "op13_target_resampling"])
def test_one_row_for_each_document(spark, results, name):
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    assert sorted(results[name][1].doc_id) == ids


@pytest.mark.parametrize("name", ["op7_toxicity", "op10_language_id"])
def test_held_out_rows(results, name):
    got = results[name][1]
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all() and got.score.between(0, 1).all()


def test_packing(results):
    got = results["op2_best_two_fit_packing"][1]
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part.offset.tolist() == [0, *part.length.cumsum().tolist()[:-1]] and part.length.sum() <= 4096
    for _, part in got.groupby("doc_id"):
        part = part.sort_values("piece")
        assert part.piece.tolist() == list(range(len(part))) and part.start.tolist() == [0, *part.length.cumsum().tolist()[:-1]] and (part.length.iloc[:-1] == 4096).all()
    assert got.ids_crc32.between(0, 2**32 - 1).all()


def test_fingerprints_and_components(results):
    got = results["op3_simhash_dedup"][1]
    assert got.fingerprint.str.fullmatch("[0-9a-f]{16}").all() and (got.component_id <= got.doc_id).all()


def test_token_counts_add_up(results):
    got = results["op4_token_counts"][1].groupby("doc_id").agg(n=("n_tokens", "sum"), all=("doc_tokens", "max"))
    assert (got.n == got["all"]).all()


def test_vectors(spark, results):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    links, near = results["op5_embedding_dedup"][1], results["op6_nearest_neighbours"][1]
    assert len(links) == vectors.count() and (links.kept == (links.vec_id == links.component_id)).all()
    sizes = near.groupby("query_id")["rank"].apply(lambda r: sorted(r) == list(range(1, 21)))
    assert sizes.all() and set(near.query_id) == {r.vec_id for r in vectors.where(F.col("vec_id") % 20 == 0).collect()}


def test_samples_and_segmentations(results):
    sample, ways = results["op8_importance_resampling"][1], results["op9_sentencepiece_nbest"][1]
    assert sample.selected.sum() == -(-len(sample) // 2) and ways.exact.all()
    assert (ways.sort_values(["doc_id", "rank"]).groupby("doc_id").score.apply(lambda s: s.is_monotonic_decreasing)).all()
