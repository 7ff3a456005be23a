import hashlib
import math
import random
import re
import zlib
from collections import Counter

from tillage.llm.target_resampling import merge_tree, merged, resample_to_target

SCHEMA = "doc_id long, text string, score int, run int, rank string, n_words int"


def slow_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def slow(docs, target, longest=1, buckets=10_000, seed=2024, share=(10, 100), least=20):
    def runs(text):
        w = slow_words(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    raw, good = (Counter(b for t in texts for b in runs(t)) for texts in ([t for _, t in docs], target))
    s_all, t_all = raw.total(), good.total()
    out = []
    for i, text in docs:
        f = runs(text)
        gain = [math.floor(1000 * math.log((good[b] + 1) * (s_all + buckets) / ((raw[b] + 1) * (t_all + buckets)))) for b in f]
        weight = math.floor(sum(gain) / len(f)) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(slow_words(text)) >= least])
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = order[: len(order) * share[0] // share[1]]
    return out, [(r[0], r[3]) for r in drawn]


def corpus(n=1500):
    rng = random.Random(4)
    common, rare = [f"w{i}" for i in range(300)], [f"Ünï{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choice(rare if rng.random() < (i % 7) / 10 else common) for _ in range(rng.randrange(5, 90))) + ". X-1_y\x7fZ") for i in range(n)]
    docs += [(5, docs[0][1])] * 300 + [(None, docs[1][1] + " " + docs[2][1])] * 40 + [(n + 1, None), (n + 2, ""), (n + 3, " .,\n"), (n + 4, "Word " * 30_000), (-9, docs[3][1] * 3)]
    return docs, [" ".join(rng.choices(rare, k=50)) for _ in range(30)] + [None, ""]


def test_against_a_plain_pass(spark):
    docs, target = corpus()
    frame = spark.createDataFrame([(*r, 1, 2, "r", 3) for r in docs], SCHEMA).repartition(7)
    wanted = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    for longest, share in ((1, (10, 100)), (3, (1, 3)), (1, (1, 1))):
        got = resample_to_target(frame, wanted, longest=longest, share=share).collect()
        rows, drawn = slow(docs, target, longest, share=share)
        assert Counter(tuple(r)[:4] for r in got) == Counter(tuple(r[:4]) for r in rows)
        ranked = sorted((r.rank, r.doc_id, r.score) for r in got if r["rank"] is not None)
        assert [r[0] for r in ranked] == list(range(1, len(drawn) + 1)) and [(r[1], r[2]) for r in ranked] == drawn


def test_small_and_empty_tables(spark):
    docs, target = corpus(30)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    frame = spark.createDataFrame(docs[:9], "doc_id long, text string")
    rows = resample_to_target(frame, wanted).collect()
    assert len(rows) == 9 and all(r["rank"] is None for r in rows)
    assert resample_to_target(frame.limit(0), wanted).count() == 0
    alone = resample_to_target(frame, wanted.limit(0), share=(1, 1), least_words=0).collect()
    want, drawn = slow(docs[:9], [], share=(1, 1), least=0)
    assert Counter(tuple(r)[:4] for r in alone) == Counter(tuple(r[:4]) for r in want) and sorted(r["rank"] for r in alone) == list(range(1, 10))


def test_tournament_trees():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7, 64, 65, 200):
        runs = [sorted((rng.randrange(50),) for _ in range(rng.randrange(12))) for _ in range(k)]
        want = sorted(x for r in runs for x in r)
        assert list(merged(list(runs))) == want and list(merge_tree(list(runs), fan=8)) == want
    lazy = merged([iter([(1,), (4,)]), (x for x in [(2,), (3,)])])
    assert [next(lazy) for _ in range(3)] == [(1,), (2,), (3,)]
