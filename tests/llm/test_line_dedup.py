from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash

from tillage.llm import line_dedup
from tillage.llm.line_dedup import _bands, band_keys, dedup_lines, signatures


def slow_dedup(docs, least=0.8, size=5):
    """doc_id -> lines that stay, by comparing all pairs of lines."""
    lines = [(d, p, s.strip(" \t\r\f\x0b").lower()) for d, t in docs if t is not None for p, s in enumerate(t.split("\n"))]
    some = [x for x in lines if x[2]]
    sets = [{s[i : i + size] for i in range(max(1, len(s) - size + 1))} for _, _, s in some]
    root = list(range(len(some)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(some)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= least * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    first = {}
    for k, (d, p, _) in enumerate(some):
        r = find(k)
        first[r] = min(first.get(r, (d, p)), (d, p))
    stay = set(first.values())
    return {d: None if t is None else "\n".join(s for p, s in enumerate(t.split("\n")) if (d, p) in stay or not s.strip(" \t\r\f\x0b")) for d, t in docs}


def test_equal_to_brute_force(spark):
    rng = np.random.default_rng(5)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "lambda", "theta", "zeta", "rho", "tau"]
    pool = [" ".join(rng.choice(words, 25)) for _ in range(40)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(6):
            s = pool[rng.integers(len(pool))]
            if rng.random() < 0.5:
                k = rng.integers(len(s))
                s = s[:k] + "#" + s[k + 1 :]
            lines.append(s.upper() if rng.random() < 0.2 else s)
        docs.append((i, "\n".join([*lines, "", "  x"])))
    docs += [(100, None), (101, ""), (102, "\n\n")]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), bands=64, rows=2).collect()}
    assert got == slow_dedup(docs)


def slow_rows(rows):
    """As slow_dedup, with every row as a document of its own; null doc_ids first."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    got = slow_dedup([(n, rows[i][1]) for n, i in enumerate(order)])
    return Counter((rows[i][0], got[n]) for n, i in enumerate(order))


def test_repeated_and_null_doc_ids(spark):
    """At production parameters: rows of one doc_id, or of none, lose each other's lines, equal rows too; also in two steps of ranges."""
    rng = np.random.default_rng(12)
    pool = [_random(rng, int(rng.integers(3, 200))).strip() or "z" for _ in range(50)]
    rows = []
    for i in range(150):
        doc = [None, 7, i][rng.integers(3)]
        lines = [pool[k] for k in rng.integers(len(pool), size=3)]
        rows.append((doc, "\n".join([*[""] * (i * 5), *lines])))  # no two lines share a position
    rows += [rows[0]] * 4 + [rows[5]] * 3 + [(9, None)] * 2 + [(None, "")] * 2 + [(1, "hello world line"), (1, "foo\n\nhello world line"), (None, "\nhello world line"), (None, "\n\n\nfoo")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string").repartition(5)
    want = slow_rows(rows)
    for ranges in (1024, 2):
        got = dedup_lines(frame, ranges=ranges).collect()
        assert Counter((r.doc_id, r.text) for r in got) == want
        assert all(r.source == "x" and r.n_lines - r.n_removed == (0 if r.text is None else len(r.text.split("\n")) if r.n_lines > r.n_removed else 0) for r in got)


def test_routing_rows_grow_as_the_lines():
    """Rows that a task sends: one for each range that gets anything, so at most one for each key however many ranges there are."""
    rng = np.random.default_rng(13)

    def sent(n, parts):
        lines = [_random(rng, 40) + str(i) for i in range(n)]
        batch = pa.RecordBatch.from_pydict({"doc_id": [1], "row": [1], "text": ["\n".join(lines)]})
        return sum(b.num_rows for b in _bands(5, 16, 6, parts)([batch]))

    assert sent(4, 100_000) <= 4 * (16 + 2) and sent(400, 100_000) <= 400 * 18 and sent(4, 4) <= 4
    assert sent(40_000, 64) <= 2 * 64


def test_bands_meet_as_often_as_they_should():
    rng = np.random.default_rng(6)
    met = 0
    for _ in range(150):
        s = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 300))
        t = s[:150] + "Q" * 4 + s[154:]
        a, b = (band_keys(signatures([x], 5, 96), 16)[0] for x in (s, t))
        met += bool((a == b).any())
    assert met >= 149


def _random(rng, n):
    return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), n))


def test_lines_of_neighbouring_lengths_meet(spark):
    rng = np.random.default_rng(8)
    for n in (50, 60, 64, 66, 67, 80, 120):
        pairs = [(s, s + "".join(rng.choice(list("QRSTUV"), 4))) for s in (_random(rng, n) for _ in range(100))]
        a, b = (band_keys(signatures(list(x), 5, 96), 16) for x in zip(*pairs, strict=True))
        assert (a == b).any(1).all(), n
    docs = [(i, "x" + _random(rng, 64) + "x") for i in range(10)]
    docs += [(100 + i, t + "QRST") for i, t in docs]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == slow_dedup(docs) and not any(got[100 + i] for i in range(10))


def test_short_lines_meet_as_often_as_long_ones():
    rng = np.random.default_rng(9)
    for n, m in ((20, 2), (64, 7), (70, 7), (80, 8), (100, 11), (300, 33)):  # shingles, and how many of them differ
        lines = [_random(rng, n + 4) for _ in range(2000)]
        near = [s[: n // 2] + _random(rng, m - 4).upper().replace(" ", "#") + s[n // 2 + m - 4 :] if m > 4 else s[:-m] + "Q" * m for s in lines]
        met = (band_keys(signatures(lines, 5, 96), 16) == band_keys(signatures(near, 5, 96), 16)).any(1).mean()
        assert met >= 0.988, (n, met)


def test_lines_that_share_only_a_far_leader(spark):
    rng = np.random.default_rng(10)
    while True:
        x = _random(rng, 60).replace(" ", "_")
        y, leader = x + "QRST", x[:30] + _random(rng, 30).replace(" ", "_")
        keys = {int(k) for k in band_keys(signatures([x, y.lower(), leader], 5, 1), 1).ravel()}
        ids = [int(np.uint64(xxhash.xxh64_intdigest(s.lower().encode(), 42)).view(np.int64)) for s in (x, y, leader)]
        if len(keys) == 1 and ids[2] == min(ids):
            break
    docs = [(1, f"{leader}\n{x}\n{y}")]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), bands=1, rows=1).collect()}
    assert got == slow_dedup(docs) == {1: f"{leader}\n{x}"}


def test_awkward_rows(awkward):
    got = dedup_lines(awkward)
    assert set(awkward.columns) <= set(got.columns)
    rows = got.collect()
    assert len(rows) == 9 and sorted(r.text for r in rows if r.text and "b" in r.text and len(r.text) < 9) == ["a b c"]
    assert [r.text for r in rows if r.doc_id == 2] == [None] and [r.text for r in rows if r.doc_id == 3] == [""]
    assert [r.n_lines for r in rows if r.doc_id == 2] == [0]
    assert dedup_lines(awkward.limit(0)).count() == 0


def test_common_against_sets():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 80)).astype(np.uint64)) for _ in range(120)]
    rows = np.flatnonzero(rng.random(120) < 0.4)
    want = [[len(np.intersect1d(sets[k], x)) for x in sets] for k in rows]
    for often, width in ((64, 1024), (2, 3), (1, 7), (1000, 5)):
        assert (line_dedup.common(sets, rows, often, width) == want).all()
    assert (line_dedup.common([np.array([i], np.uint64) for i in range(3)], np.array([1])) == [[0, 1, 0]]).all()


def test_large_cells_are_not_compared_line_by_line(monkeypatch):
    """Near copies of one line, in families too far apart to be linked; the components are those of all pairs."""
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), 6))
    base, norms = [word() for _ in range(40)], []
    for _ in range(30):
        family = list(base)
        for i in rng.choice(40, rng.integers(2, 9), replace=False):
            family[i] = word()
        for _ in range(10):
            one = list(family)
            one[rng.integers(40)] = word()
            norms.append(" ".join(one))
    n, grams = len(norms), [{s[i : i + 5] for i in range(len(s) - 4)} for s in norms]
    root = np.where(np.arange(n) < 60, 0, np.arange(n))
    columns = {"key": np.ones(n, np.int64), "line": np.arange(n), "root": root, "leader_root": np.zeros(n, np.int64), "similarity": np.full(n, np.nan), "block_i": np.zeros(n, np.int32), "block_j": np.zeros(n, np.int32), "side": np.zeros(n, np.int32)}
    monkeypatch.setattr(line_dedup, "shared", None)
    found = [e for b in line_dedup._across(5, 0.8)(pa.table({**columns, "norm": norms})) for e in zip(*b.to_pydict().values(), strict=True)]
    links = [(a, b) for a in range(n) for b in range(a) if len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b])]

    def components(edges):
        of = root.copy()
        while True:
            before = of.copy()
            for a, b in edges:
                of[of == max(of[a], of[b])] = min(of[a], of[b])
            if (of == before).all():
                return of.tolist()

    assert components(found) == components(links) and 1 < len(set(components(links))) < n - 60
