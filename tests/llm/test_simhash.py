from itertools import product

import numpy as np
import pytest
import xxhash

from tillage.llm.simhash import allocate, fingerprint, group_bits, simhash_groups


def slow_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_groups(fps, tau=3):
    """Smallest id reachable, by comparing all pairs."""
    root = {i: i for i, _ in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in fps:
        for j, b in fps:
            if i < j and bin(a ^ b).count("1") <= tau:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


@pytest.mark.parametrize("text", ["", None, "One", "One two", "A b C d e f", "É\x85a b\x0bc\xa0d e", "x y z " * 50])
def test_fingerprint(text):
    assert fingerprint(text) == slow_fingerprint(text)


def test_groups_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(500)]
    docs = []
    for base in range(60):
        text = list(rng.choice(words, 120))
        for copy in range(4):
            own = list(text)
            for _ in range(copy):
                own[rng.integers(len(own))] = "changed"
            docs.append((base * 10 + copy, " ".join(own)))
    docs += [(5000, None), (5001, ""), (5002, " ")]
    got = {r.doc_id: (r.fp, r.component_id) for r in simhash_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    fps = [(i, slow_fingerprint(t)) for i, t in docs]
    want = slow_groups(fps)
    assert {i: f % (1 << 64) for i, (f, _) in got.items()} == dict(fps)
    assert {i: c for i, (_, c) in got.items()} == want
    assert len(set(want.values())) < len(docs) - 20


def test_every_threshold_finds_all_links(spark):
    rng = np.random.default_rng(2)
    from tillage.llm.simhash import plan
    from tillage.llm.common import Scratch

    fps = [int(x) for x in rng.integers(-(1 << 63), 1 << 63, 50)]
    parts = plan(Scratch(spark), spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, node long"), 3)
    covered = 0
    for mask, _ in parts:
        covered |= mask & ((1 << 64) - 1)
    for _ in range(2000):
        flips = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(bin(flips & mask & ((1 << 64) - 1)).count("1") <= t for mask, t in parts)


def test_allocate_takes_the_cheapest():
    cost = np.random.default_rng(7).random((3, 4))
    ways = [p for p in product(range(-1, 4), repeat=3) if sum(p) == 1]
    least = min(sum(cost[i][t] for i, t in enumerate(p) if t >= 0) for p in ways)
    got, picks = allocate(cost, 1)
    assert abs(got - least) < 1e-12 and sum(picks) == 1


def test_correlated_bits_share_a_group():
    n, rng = 4000, np.random.default_rng(3)
    x = rng.integers(0, 2, (n, 64))
    x[:, 40] = x[:, 3]
    groups = group_bits(x.T @ x, n, 4)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert any(3 in g and 40 in g for g in groups)


def test_awkward_rows(awkward):
    rows = simhash_groups(awkward).collect()
    assert len(rows) == 9
    assert {r.component_id for r in rows if r.fp == 0} == {2}
    assert simhash_groups(awkward.limit(0)).count() == 0
