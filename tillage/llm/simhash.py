"""SimHash near-duplicates by the generalised pigeonhole principle."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillage.llm.common import Scratch, blocked, edge_batch, forest, map_runs, arrow_batches, starts
from tillage.llm.graph import connected_components

BITS = 64


def fingerprint(text: str | None, words: int = 3) -> int:
    """Majority of the XXH64 (seed 42) bits of the word shingles, repeats counted; no word: 0."""
    tokens = (text or "").encode("utf-8", "replace").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    h = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def _fingerprints(words: int):
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).astype(np.int64), dtype="int64")

    return run


def _cooccurrence(batches):
    """Per task, how often each pair of bits is set together; row 64 has the number of fingerprints."""
    total = np.zeros((BITS + 1, BITS), np.int64)
    for b in batches:
        x = np.unpackbits(b["fp"].to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        total[:BITS] += (x.T @ x).astype(np.int64)
        total[BITS] += len(x)
    i, j = np.indices(total.shape)
    yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "n"])


def group_bits(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Split the bits into ``parts`` groups of similar size with the strongest correlations inside groups."""
    p = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(p, p)
    spread = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    left, groups = set(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        rest = sorted(left)
        group = [rest[int(np.argmax(corr[np.ix_(rest, rest)].max(1)))]]
        while len(group) < size:
            rest = sorted(left - set(group))
            group.append(rest[int(np.argmax(corr[np.ix_(rest, group)].mean(1)))])
        groups.append(sorted(group))
        left -= set(group)
    return groups


def _within(p: np.ndarray, most: int) -> np.ndarray:
    """Chance that two independent fingerprints differ in at most t of these bits, t = 0..most."""
    dist = np.zeros(most + 2)
    dist[0] = 1
    for d in 2 * p * (1 - p):
        dist[1:-1] = dist[1:-1] * (1 - d) + dist[:-2] * d
        dist[0] *= 1 - d
    return np.cumsum(dist[: most + 1])


def allocate(cost: np.ndarray, total: int) -> tuple[float, list[int]]:
    """Thresholds (-1: skip the part) with the given sum and the least total cost; cost[i][t]."""
    best = {0: (0.0, [])}
    for row in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for done, (c, picks) in best.items():
            for t in range(-1, len(row)):
                new = c + (row[t] if t >= 0 else 0.0)
                if done + t not in step or new < step[done + t][0]:
                    step[done + t] = (new, [*picks, t])
        best = step
    return best[total]


def plan(scratch: Scratch, fps: DataFrame, tau: int) -> list[tuple[int, int]]:
    """(bit mask, threshold) of each part, from statistics over all fingerprints.

    Candidate numbers are estimated from the bits' marginals, scaled by the measured number of
    pairs that agree on the part, which catches skew and correlation. Partitionings into 2 to
    tau + 1 parts are compared: few documents get narrow parts probed exactly, many get wide parts
    probed with neighbours.
    """
    rows = fps.mapInArrow(_cooccurrence, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    table = np.zeros((BITS + 1, BITS), np.int64)
    for r in rows:
        table[r.i, r.j] = r.n
    n = int(table[BITS, 0])
    p = np.diag(table[:BITS]) / max(n, 1)
    choices = [(m, g) for m in range(2, tau + 2) for g in group_bits(table[:BITS], n, m)]
    masks = [_signed(sum(1 << b for b in g)) for _, g in choices]
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for k, m in enumerate(masks)]))
    same = {
        r.part: r.pairs
        for r in fps.select(values.alias("x")).groupBy("x.part", "x.value").count().groupBy("part").agg(F.sum(F.col("count").cast("double") ** 2).alias("pairs")).collect()
    }
    best = (float("inf"), [])
    for m in range(2, tau + 2):
        cost, own = [], [k for k, (parts, _) in enumerate(choices) if parts == m]
        for k in own:
            bits = choices[k][1]
            chance = _within(p[bits], tau)
            probes = np.cumsum([_choose(len(bits), t) for t in range(tau + 1)])
            agree = max(same.get(k, 0.0) / max(n, 1) ** 2, chance[0])
            cost.append(float(n) ** 2 * np.minimum(1, chance * agree / max(chance[0], 1e-300)) + 20.0 * n * probes)
        found = allocate(np.array(cost), tau - m + 1)
        if found[0] < best[0]:
            best = (found[0], [(masks[k], t) for k, t in zip(own, found[1], strict=True) if t >= 0])
    return best[1]


def _choose(n: int, k: int) -> int:
    return len(list(combinations(range(n), k)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _probes(parts: list[tuple[int, int]]):
    """Array column of (part, value, home) to look up: the fingerprint's own values and all that differ in at most t bits."""
    out = []
    for k, (mask, t) in enumerate(parts):
        bits = [b for b in range(BITS) if (mask & ((1 << 64) - 1)) >> b & 1]
        flips = [_signed(sum(1 << b for b in c)) for r in range(t + 1) for c in combinations(bits, r)]
        out.append(F.transform(F.array(*[F.lit(f) for f in flips]), _probe(k, F.col("fp").bitwiseAND(F.lit(mask)))))
    return F.flatten(F.array(*out))


def _probe(part: int, own: F.Column):
    return lambda flip: F.struct(F.lit(part).alias("part"), own.bitwiseXOR(flip).alias("value"), (flip == 0).alias("home"))


def _verify(tau: int):
    def work(table: pa.Table):
        fp, node = table["fp"].to_numpy().view(np.uint64), table["node"].to_numpy()
        side, home = table["side"].to_numpy(), table["home"].to_numpy(zero_copy_only=False)
        diagonal = table["block_i"].to_numpy() == table["block_j"].to_numpy()
        first = starts([table[k].to_numpy() for k in ("part", "value", "block_i", "block_j")])
        run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(fp))))
        us, vs = [], []
        at = np.arange(len(fp))
        step, pending = 0, 0
        while True:
            step += 1
            at = at[at + step < len(fp)]
            at = at[run[at] == run[at + step]]
            if not len(at):
                break
            to = at + step
            ok = (np.bitwise_count(fp[at] ^ fp[to]) <= tau) & (diagonal[at] | (side[at] != side[to])) & (home[at] | home[to])
            us.append(node[at[ok]])
            vs.append(node[to[ok]])
            pending += int(ok.sum())
            if pending > 1_000_000:
                u, v = forest(np.concatenate(us), np.concatenate(vs))
                us, vs, pending = [u], [v], 0
        if us:
            yield edge_batch(*forest(np.concatenate(us), np.concatenate(vs)))

    return work


def simhash_groups(docs: DataFrame, tau: int = 3, words: int = 3, block: int = 512) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text).

    fp is the 64-bit fingerprint as a signed long, component_id the smallest doc_id reachable by
    links of at most ``tau`` differing bits. Null and wordless texts have fingerprint zero and link
    like any other. Of a doc_id with several texts each row is linked by its own fingerprint; these
    fingerprints are joined only where it is the smallest doc_id of both. A row whose doc_id is null gets the component of its fingerprint, null if no other row has it. Extra
    columns are ignored; an empty table gives no rows.
    Copies collapse to distinct fingerprints first; buckets are cut into blocks; a block pair
    reports a spanning forest of its links, so no group is expanded into all its pairs.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    arrow_batches(spark)
    made = scratch.save(docs.select("doc_id", _fingerprints(words)(F.col("text")).alias("fp")))
    fps = scratch.save(made.groupBy("fp").agg(F.min("doc_id").alias("node")))
    parts = plan(scratch, fps.where("node is not null"), tau)
    members = fps.where("node is not null").withColumn("x", F.explode(_probes(parts))).select("x.part", "x.value", "x.home", "fp", "node")
    cells = blocked(scratch, members, ["part", "value"], "fp", block)
    edges = map_runs(cells, ["part", "value", "block_i", "block_j"], _verify(tau), "u long, v long")
    roots = connected_components(scratch, edges)
    classes = scratch.save(fps.join(roots, fps.node == roots.id, "left").select("fp", F.coalesce("root", "node").alias("component_id")))
    scratch.keep(made, classes)
    return made.join(classes, "fp").select("doc_id", "fp", "component_id")
