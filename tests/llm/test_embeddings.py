from math import inf, nan

import numpy as np
import pyarrow as pa
import pytest

from tillage.llm.ann import Index, Space, chi_square_cdf, chi_square_quantile, nearest
from tillage.llm.embedding_dedup import bands_for, embedding_links, encode, estimate, margin, quantise, restored, rotations, turned


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(10)
    base = rng.standard_normal((300, 32))
    near = base[rng.integers(0, 20, 300)] + 0.25 * rng.standard_normal((300, 32))
    x = np.concatenate([base, near, base[:5], 3 * base[5:8]]).astype(np.float32)
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


ODD = [(9001, None), (9002, [0.0] * 32), (9003, [nan] + [1.0] * 31), (9004, [inf] + [1.0] * 31), (9005, [None] + [1.0] * 31), (9006, [1.0]), (None, [1.0] * 32)]


def test_links_equal_brute_force(spark, vectors):
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_links(spark.createDataFrame(vectors + ODD, "vec_id long, embedding array<float>")).collect()}
    x = np.array([v for _, v in vectors], np.float64)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    label = np.arange(len(x))
    for _ in range(len(x)):
        new = np.where(link, label[None, :], label[:, None]).min(1)
        new = np.minimum(new, label)
        if (new == label).all():
            break
        label = new
    wrong = [i for i in range(len(x)) if got[i] != (link[i].sum(), label[i], label[i] == i)]
    assert len(wrong) <= 0.02 * len(x)
    assert all(got[i][0] <= link[i].sum() for i in range(len(x)))
    for i, _ in ODD:
        assert got[i] == (0, i, i is not None)


def _truth(x, least=0.9):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = u @ u.T >= least
    np.fill_diagonal(link, False)
    return link


def test_thousands_of_planted_links_are_found(spark):
    rng = np.random.default_rng(16)
    base = rng.standard_normal((400, 64))
    # Copies with a cosine around the threshold, a large group of near copies, and exact copies.
    noise = rng.uniform(0.2, 0.55, (2000, 1)) * rng.standard_normal((2000, 64))
    x = np.concatenate([base, base[rng.integers(0, 400, 2000)] + noise, base[0] + 0.1 * rng.standard_normal((400, 64)), np.repeat(base[1:2], 50, 0)]).astype(np.float32).astype(np.float64)
    link = _truth(x)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    got = {r.vec_id: r.n_links for r in embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), block=64).collect()}
    want = link.sum(1)
    assert want.sum() > 100_000 and all(got[i] <= want[i] for i in range(len(x)))
    near = np.arange(400, 2400)  # pairs around the threshold, without the large group
    assert sum(got[i] for i in near) >= 0.99 * want[near].sum() and sum(got.values()) >= 0.99 * want.sum()


def test_vectors_of_other_sizes_link_among_themselves(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (2, [1.0, 0.01, 0.0]), (3, [0.0, 1.0, 0.0]), (4, [1.0, 0.0]), (5, [2.0, 0.1]), (6, []), (7, [5.0])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True), 4: (1, 4, True), 5: (1, 4, False), 6: (0, 6, True), 7: (0, 7, True)}


def test_nearest_over_many_slots_ties_and_repeats(spark):
    """Cells, hot groups of copies and repeated ids; in clusters the stopping test leaves most leaves out."""
    rng = np.random.default_rng(17)
    centres = 3 * rng.standard_normal((40, 24))
    x = np.concatenate([centres[rng.integers(0, 40, 3000)] + 0.3 * rng.standard_normal((3000, 24)), np.repeat(centres[:1], 900, 0)])
    rows = [(i, [float(v) for v in r], "x", 1, True) for i, r in enumerate(x)] + [(0, [0.0] * 24, "x", 1, True)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string, slot int, ask boolean")
    got = nearest(df, df.where("vec_id % 20 = 0"), k=20, block=150, sample=600).toPandas()
    assert list(got.columns) == ["query_id", "rank", "vec_id", "score"] and got.groupby("query_id").size().eq(20).all()
    hit = total = 0
    for q, part in got.sort_values("rank").groupby("query_id"):
        s = (x * x[q]).sum(1)
        s[q] = -inf
        want = np.lexsort((np.arange(len(s)), -s))[:20]
        assert (s[part.vec_id] == part.score).all() and part.vec_id.is_unique
        hit += len(set(want) & set(part.vec_id))
        total += 20
    assert hit >= 0.95 * total
    hot = got[got.query_id == 3000].sort_values("rank").vec_id.tolist()
    assert len(hot) == 20


def test_the_stopping_test_stops():
    rng = np.random.default_rng(18)
    centres = rng.standard_normal((64, 256))
    x = centres[rng.integers(0, 64, 4000)] + 0.2 * rng.standard_normal((4000, 256))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = Index(Space(256, 1.000001, 16, 0.95, 5), np.arange(4000), x, 20)
    row, found, score = index.search(np.arange(0, 4000, 20), x[::20], np.full(200, -inf), 20)
    assert index.visited < 0.5 * index.offered
    true = x[::20] @ x.T
    true[np.arange(200), np.arange(0, 4000, 20)] = -inf
    best = np.argsort(-true, axis=1)[:, :20]
    assert np.mean([len(set(best[q]) & set(found[row == q])) / 20 for q in range(200)]) >= 0.95


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(11)
    dim = 64
    a, b = rng.standard_normal((200, dim)), rng.standard_normal((200, dim))
    b += a
    true = (a * b).sum(1) / np.linalg.norm(a, axis=1) / np.linalg.norm(b, axis=1)
    error = []
    for seed in range(40):
        turn = rotations(dim, 2, seed)
        code, factor = encode(a, turn)
        y = turned(b, turn)
        guess = np.diag(estimate(code, factor, y, dim))
        error.append(guess - true)
        assert (np.abs(guess - true) <= margin(factor, len(turn), dim, 5)).mean() > 0.995
        packed, step = quantise(y[:, :dim])
        bits, rounded = restored(packed, step, dim)
        assert (bits == (y[:, :dim] >= 0)).all() and (np.abs(rounded - y[:, :dim]) <= 0.5 * step[:, None] * 1.001).all()
        rounded = rounded @ (turn[:dim] @ turn.T)
        coarse = np.diag(estimate(code, factor, rounded, dim))
        assert (np.abs(coarse - true) <= np.diag(margin(factor, len(turn), dim, 5, step))).mean() > 0.995
    assert abs(np.mean(error)) < 0.005


def test_bands_keep_the_miss_rate():
    for n in (1, 1000, 10**6, 10**10):
        bands, bits = bands_for(n, 0.9)
        assert (1 - (1 - np.arccos(0.9) / np.pi) ** bits) ** bands <= 0.002


def test_what_travels_is_bounded_by_the_bands():
    """At 64 dimensions a band row is 68 bytes at any number of vectors."""
    from tillage.llm.embedding_dedup import _code

    x = np.random.default_rng(3).standard_normal((10, 64)).astype(np.float32)
    for n in (10**3, 10**9):
        bands, bits = bands_for(n, 0.9)
        hashes = rotations(64, -(-bands * bits // 64), 1)
        batch = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array([1] * 10), pa.array(list(x))], names=["node", "copies", "embedding"])
        row = next(_code(rotations(64, 2, 2), hashes, bands, bits)([batch])).to_pylist()[0]
        assert len(row["buckets"]) == bands and (len(row["code"]), len(row["more"])) == (32, 8)
    assert bands * (32 + 36) < 40 * 256


def test_chi_square():
    assert abs(chi_square_cdf(15.507, 8) - 0.95) < 1e-4 and abs(chi_square_quantile(0.95, 8) - 15.507) < 1e-2


def test_nearest_against_brute_force(spark, vectors):
    scaled = [(i, [x * (1 + i % 3) for x in v]) for i, v in vectors]
    df = spark.createDataFrame(scaled + ODD, "vec_id long, embedding array<float>")
    got = nearest(df, df.where("vec_id % 20 = 0"), k=10).toPandas()
    x = np.array([v for _, v in scaled], np.float32).astype(np.float64)
    hit = total = 0
    for q, part in got.groupby("query_id"):
        part = part.sort_values("rank")
        assert part["rank"].tolist() == list(range(1, 11)) and q not in part.vec_id.tolist()
        s = x @ x[q]
        assert np.allclose(part.score, s[part.vec_id], rtol=0, atol=1e-9)
        assert (np.diff(part.score) <= 0).all()
        s[q] = -inf
        hit += len(set(np.argsort(-s)[:10]) & set(part.vec_id))
        total += 10
    assert got.query_id.nunique() == len([1 for i, _ in vectors if i % 20 == 0]) and hit >= 0.95 * total


def test_few_or_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id long, embedding array<double>").withColumnRenamed("vec_id", "vec_id")
    assert [(r["rank"], r.vec_id) for r in nearest(df, df.where("vec_id = 0"), k=20).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert nearest(df.limit(0), df, k=3).count() == 0 and embedding_links(df.limit(0)).count() == 0
    extra = df.selectExpr("*", "1 as node", "2 as band", "'x' as ok")
    assert extra.count() == embedding_links(extra).count() == 3
