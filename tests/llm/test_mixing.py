import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillage.llm.mixing import mix_plan, mixed_documents, source_targets, taken_words

SCHEMA = "doc_id long, text string, source string, size int, before int, row int, key string, times int"


def slow_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, out = share * sum(sizes.values()), {}
    while True:
        level = left / (sum(w[s] for s in names if s not in out) or 1)
        above = [s for s in names if s not in out and w[s] * level > most * sizes[s]]
        if not above:
            return out | {s: w[s] * level for s in names if s not in out}
        for s in above:
            out[s] = float(most * sizes[s])
            left -= out[s]


def slow_mix(rows, quality, seed=11):
    """One document at a time, in the order of the keys: (doc_id, size, taken) of every row."""
    known = lambda x: "-" if x is None else f"+{x}"
    by = defaultdict(list)
    for i, text, source in rows:
        draw = hashlib.md5(f"{seed}:{known(i)}:{known(text)}".encode()).hexdigest()
        key = -math.log((int(draw[:13], 16) + 0.5) / 2**52) / quality.get(i, 1.0)
        by[source].append((key, draw, i, len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))))
    sizes = {s: sum(r[3] for r in v) for s, v in by.items()}
    targets, out = slow_targets(sizes), []
    for s, v in by.items():
        whole = int(targets[s] // sizes[s]) if sizes[s] else 0
        rest, total = targets[s] - whole * sizes[s], 0
        for _, _, i, n in sorted(v):
            out.append((i, n, n * (whole + (abs(total + n - rest) <= abs(total - rest)))))
            total += n
    return targets, sizes, out


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), " ".join(["w"] * int(rng.integers(0, 60))) + f" t{i}", rng.choice(["hot", "hot", "hot", "b", "é", "z"])) for i in range(900)]
    rows += [(7, "one two three", "b")] * 40 + [(None, "x y", None)] * 30 + [(None, None, "b"), (3, "", "tiny"), (4, "only", "tiny2"), (5, "a\tb\x0bc d", None), (6, "long " * 20_000, "z")]
    return rows, spark.createDataFrame([(*r, 1, 2, 3, "k", 4) for r in rows], SCHEMA).repartition(5)


def test_against_one_document_at_a_time(spark, corpus):
    rows, docs = corpus
    quality = {i: 3.0 if i % 2 else 0.5 for i in range(0, 900, 3)}
    labels = spark.createDataFrame([*quality.items(), (12, None), (12, -1.0), (None, 9.0), (13, float("nan")), (0, 0.1)], "doc_id long, weight double")
    plan = mix_plan(docs, labels).cache()
    targets, sizes, want = slow_mix(rows, quality)
    got = taken_words(plan).collect()
    assert Counter((r.doc_id, r["size"], r.taken) for r in got) == Counter(want)
    assert {(r.source, r.source_size, r.target) for r in plan.collect()} == {(s, sizes[s], targets[s]) for s in sizes}
    taken, biggest = Counter(), Counter()
    for r in plan.collect():
        taken[r.source] += (r.epochs * r.copies + r.extra) * r["size"]
        biggest[r.source] = max(biggest[r.source], r["size"])
        assert r.epochs + (r.extra > 0) <= 2 or not r["size"]
    assert all(abs(taken[s] - targets[s]) <= biggest[s] / 2 + 1e-6 for s in sizes)
    texts = mixed_documents(docs, plan)
    assert [c for c in texts.columns] == docs.columns
    words = F.size(F.split("text", r"[\x20\x09-\x0D]+"))
    mixed = texts.where(F.length("text") > 5).groupBy("source").agg(F.sum("times").alias("n"), F.sum(words * F.col("times"))).collect()
    assert {r.source for r in mixed} >= {"hot", "b", "é", "z"}
    again = Counter((r.doc_id, r["size"], r.taken) for r in taken_words(mix_plan(docs.repartition(3), labels)).collect())
    assert again == Counter(want)


def test_quality_comes_first(spark):
    rows = [(i, f"a b c d e f g h i {i}", "s") for i in range(3000)] + [(10_000 + i, f"x {i}", "t") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    good = spark.createDataFrame([(i, 4.0) for i in range(1500)], "doc_id long, weight double")
    plan = mix_plan(docs, good, weights=(1,), share=0.4).where("source = 's'").collect()
    chosen = [r.doc_id for r in plan if r.extra]
    assert 0.70 < sum(i < 1500 for i in chosen) / len(chosen) < 0.85


def test_targets_without_room_and_tables_without_rows(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 0), (None, 30)], "source string, source_size long")
    assert {r.source: r.target for r in source_targets(sizes).collect()} == slow_targets({"a": 10, "b": 0, None: 30})
    assert {r.source: r.target for r in source_targets(sizes, share=2.0).collect()} == {"a": 20.0, "b": 0.0, None: 60.0}
    zero = spark.createDataFrame([("a", 0)], "source string, source_size long")
    assert [r.target for r in source_targets(zero).collect()] == [0.0]
    empty = spark.createDataFrame([], SCHEMA)
    assert taken_words(mix_plan(empty)).count() == 0
    with pytest.raises(ValueError):
        source_targets(sizes, share=3)


def test_main_path_stays_in_the_jvm(corpus):
    plan = taken_words(mix_plan(corpus[1]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
