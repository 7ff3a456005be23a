import math

import numpy as np
import pytest

from tillage.llm.whitening import fit, whiten

SCHEMA = "vec_id long, embedding array<double>, x int, component string"


def slow(vectors):
    """Dense, over whole numbers: (n, deviations, whitened, shares) of the vectors in the order given."""
    x = np.array([[math.floor(256 * c) for c in v] for v in vectors], object)
    fit_list = np.array(sorted({tuple(r) for r in x.tolist()}), object)
    n, s = len(fit_list), fit_list.sum(0)
    far = ((n * x - s) ** 2).sum(1)
    c = ((n * fit_list - s) / n).astype(float)
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    return n, far, ((n * x - s) / n).astype(float) @ u, e


def frame(spark, vectors, extra=()):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)] + list(extra)
    return spark.createDataFrame([(*r, 1, "c") for r in rows], SCHEMA).repartition(6)


@pytest.mark.parametrize(("n", "dim", "tile"), [(700, 12, 5), (300, 3, 32), (5000, 70, 16)])
def test_against_a_dense_one(spark, n, dim, tile):
    rng = np.random.default_rng(dim)
    v = rng.standard_normal((n, dim)) * np.linspace(2, 0.3, dim)
    v[n // 2 :: 3] = v[1]
    odd = [(9000, None), (9001, [1.0] * (dim - 1) + [float("nan")]), (9002, [1.0] * (dim - 1) + [None]), (9003, [float("inf")] * dim), (9004, [0.5] * (dim + 1)), (9005, [])]
    table = frame(spark, v, odd)
    model = fit(table, tile=tile)
    got = whiten(table, model).toPandas().sort_values(["component", "vec_id"])
    m, far, w, e = slow(v)
    k = min(4, dim)
    assert model.n == m and set(got.vec_id) == set(range(n)) and len(got) == n * k
    assert (got[got.component == 1].deviation.to_numpy() == far.astype(np.int64)).all()
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9
    for c in range(k):
        part, want = got[got.component == c + 1], w[:, c] / math.sqrt(e[c])
        sign = np.sign(part.whitened.to_numpy() @ want)
        assert np.abs(sign * part.whitened.to_numpy() - want).max() < 1e-6
        assert np.allclose(part.explained, e[c] / e.sum(), rtol=1e-9)


def test_components_without_variance(spark):
    table = frame(spark, [[1.0, 2.0, 0.0], [1.0, 3.0, 0.0], [1.0, 2.0, 0.0]])
    got = whiten(table, fit(table)).toPandas().sort_values(["vec_id", "component"])
    assert len(got) == 9 and got[got.component > 1].whitened.isna().all()
    assert np.allclose(np.abs(got[got.component == 1].whitened), 1) and np.allclose(got[got.component == 1].explained, 1)
    same = frame(spark, [[0.25, 0.5]] * 3)
    got = whiten(same, fit(same)).toPandas()
    assert len(got) == 6 and got.whitened.isna().all() and got.explained.isna().all() and (got.deviation == 0).all() and (got.n == 1).all()


def test_exact_sums_of_large_numbers(spark):
    v = [[1e12, -3.0], [-1e12, 5.0], [2e12, 0.125], [2e12, 0.125]]
    table = frame(spark, v)
    model = fit(table)
    n, far, _, _ = slow(v)
    assert model.n == n == 3
    got = whiten(table, model).toPandas()
    assert got.deviation.isna().all() and all(int(f) >= 2**63 for f in far)  # no longs
    assert model.distances(np.array([[math.floor(256 * c) for c in r] for r in [[1e2, 1.0]]])) == [None]


def test_tables_without_rows_and_repeated_ids(spark):
    none = frame(spark, [], [(1, None), (2, [])])
    assert whiten(none, fit(none)).count() == 0 and whiten(none.limit(0), fit(none.limit(0))).count() == 0
    table = frame(spark, [[1.0, 0.0]], [(0, [0.0, 1.0]), (0, [1.0, 0.0]), (None, [0.5, 0.5]), (None, [0.5, 0.5])])
    got = whiten(table, fit(table)).toPandas()
    assert len(got) == 10 and got.vec_id.isna().sum() == 4 and (got.n == 3).all()
