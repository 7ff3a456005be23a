import numpy as np

from tillage.llm.common import Scratch, forest
from tillage.llm.graph import connected_components


def slow(edges):
    root = {x: x for e in edges for x in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def test_components_of_paths_stars_and_random_graphs(spark):
    rng = np.random.default_rng(8)
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, i) for i in range(1001, 1300)] + [(5000 - i, 5001) for i in range(50)]
    edges += [(int(a), int(b)) for a, b in rng.integers(10_000, 10_300, (200, 2)) if a != b]
    frame = spark.createDataFrame([*edges, (7, 7)], "u long, v long").repartition(7)
    for small in (0, 500_000):
        got = connected_components(Scratch(spark), frame, small).collect()
        assert {r.id: r.root for r in got} == slow(edges) and len(got) == len({r.id for r in got})


def test_no_edges(spark):
    assert connected_components(Scratch(spark), spark.createDataFrame([(None, 1), (3, 3)], "u long, v long")).count() == 0


def test_forest():
    u, v = forest(np.array([3, 9, 4]), np.array([2, 4, 9]))
    assert dict(zip(u.tolist(), v.tolist(), strict=True)) == {3: 2, 9: 4}
