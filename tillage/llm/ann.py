"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil, exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tillage.llm.common import Scratch, arrow_batches, starts
from tillage.llm.embedding_dedup import dimension, valid

#: Queries whose distances to all boxes are held at once.
_ASKS = 512
_FOUND = "query_id long, vec_id long, score double"
_ROWS = "slot int, ask boolean, vec_id long, embedding array<double>, bound double"


def chi_square_cdf(x: float, m: int) -> float:
    """For an even number m of degrees of freedom."""
    term = total = 1.0
    for i in range(1, m // 2):
        term *= x / 2 / i
        total += term
    return 1 - exp(-x / 2) * total


def chi_square_quantile(p: float, m: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, m) < p else (low, mid)
    return high


def kd_tree(points: np.ndarray, most: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Cells of at most ``most`` of the points, split at the median of the widest axis: the points of each, and the space it covers.

    The spaces' lower and upper corners reach to infinity at the outside, so they part all space.
    """
    m = points.shape[1]
    todo, out = [(np.arange(len(points)), np.full(m, -np.inf), np.full(m, np.inf))], []
    while todo:
        at, low, high = todo.pop()
        p = points[at]
        spread = p.max(0) - p.min(0) if len(at) else np.zeros(m)
        axis = int(np.argmax(spread))
        if len(at) <= most or not spread[axis] > 0:
            out.append((at, low, high))
            continue
        cut = float(np.median(p[:, axis]))
        left = p[:, axis] < cut
        if not left.any():  # the median is the smallest value
            cut = float(p[:, axis][p[:, axis] > cut].min())
            left = p[:, axis] < cut
        upper, lower = high.copy(), low.copy()
        upper[axis] = lower[axis] = cut
        todo += [(at[left], low, upper), (at[~left], lower, high)]
    return [a for a, _, _ in out], np.array([a for _, a, _ in out]), np.array([a for _, _, a in out])


def distances(p: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes, (points, boxes)."""
    out = np.zeros((len(p), len(low)))
    for j in range(p.shape[1]):
        x = p[:, j : j + 1]
        out += np.maximum(np.maximum(low[:, j] - x, x - high[:, j]), 0) ** 2
    return out


class Space:
    """Stable (Gaussian) projections; inner products become distances.

    A vector x gets the extra component sqrt(top^2 - |x|^2), where top is the largest norm of all
    vectors, and a query the extra component 0: then |q - x|^2 = |q|^2 + top^2 - 2 <q, x>. A squared
    projected distance, over the squared distance, is chi-square distributed with ``axes`` degrees of freedom.
    """

    def __init__(self, dim: int, top: float, axes: int, confidence: float, seed: int):
        self.top, self.projection = top, np.random.default_rng(seed).standard_normal((dim + 1, axes))
        self.limit = chi_square_quantile(confidence, axes)

    def vectors(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.top**2 - (x**2).sum(1), 0))
        return np.concatenate([x, rest[:, None]], 1) @ self.projection

    def queries(self, q: np.ndarray) -> np.ndarray:
        return q @ self.projection[:-1]

    def radius(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        """The squared projected distance from which on a search stops that has ``score`` as its k-th best.

        A vector with a larger score would, with the test's confidence, have been projected nearer.
        """
        return self.limit * np.maximum(0.0, (q**2).sum(1) + self.top**2 - 2 * score)


class Index:
    """Vectors of one slot in a kd-tree of their projections. Of equal vectors the ``k`` + 1 smallest ids are kept: no more can be asked for."""

    def __init__(self, space: Space, ids: np.ndarray, x: np.ndarray, k: int, leaf: int = 64):
        order = np.lexsort((ids, *x.T))
        ids, x = ids[order], x[order]
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]).any(1)
        first = np.flatnonzero(new)
        keep = np.arange(len(x)) - np.repeat(first, np.diff(np.append(first, len(x)))) <= k
        self.space, self.ids, self.x = space, ids[keep], x[keep]
        points = space.vectors(self.x)
        self.leaves = kd_tree(points, leaf)[0]
        self.low, self.high = (np.array([f(points[a], 0) for a in self.leaves]) for f in (np.min, np.max))
        self.visited = self.offered = 0

    def search(self, own: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of the query, id, inner product) of up to k vectors for each query that may be among its k best; ``bound``: its k-th best so far.

        Leaves come in the order of their projected distance, some at first and twice as many each
        time; all queries that are at a leaf are answered together. A query stops at the first leaf that fails the test.
        """
        space, n = self.space, len(q)
        far = distances(space.queries(q), self.low, self.high)
        order = np.argsort(far, axis=1, kind="stable")
        far = np.take_along_axis(far, order, 1)
        rows, ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        bound = bound.copy()
        at, step = 0, 2
        self.offered += far.size
        while at < far.shape[1]:
            open_ = far[:, at : at + step] < space.radius(q, bound)[:, None]
            row, j = np.nonzero(open_)
            if not len(row):
                break
            self.visited += len(row)
            leaf = order[row, at + j]
            by = np.argsort(leaf, kind="stable")
            row, leaf = row[by], leaf[by]
            cut = starts([leaf])
            near, who = [], []
            for a, b in zip(cut, np.append(cut[1:], len(row)), strict=True):
                members, asking = self.leaves[leaf[a]], row[a:b]
                # A matrix product rules out most; what is left is computed in the same way for every copy.
                i, o = np.nonzero(q[asking] @ self.x[members].T >= (bound[asking] - 1e-9 * (1 + np.abs(bound[asking])))[:, None])
                who.append(asking[i])
                near.append(members[o])
            who, near = np.concatenate(who), np.concatenate(near)
            other = self.ids[near] != own[who]
            who, near = who[other], near[other]
            rows, ids = np.concatenate([rows, who]), np.concatenate([ids, self.ids[near]])
            scores = np.concatenate([scores, (self.x[near] * q[who]).sum(1)])
            best = np.lexsort((ids, -scores, rows))
            rows, ids, scores = rows[best], ids[best], scores[best]
            first = starts([rows])
            place = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
            last = place == k - 1
            bound[rows[last]] = np.maximum(bound[rows[last]], scores[last])
            keep = place < k
            rows, ids, scores = rows[keep], ids[keep], scores[keep]
            at += step
            step *= 2
        return rows, ids, scores


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.float64)


def _answer(space: Space, k: int):
    """Rows sorted by slot, a slot's vectors before its queries: one index at a time, queries as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, ids, xs, index = None, [], [], None
        for b in batches:
            if not b.num_rows:
                continue
            slots, ask, names, x = b["slot"].to_numpy(), b["ask"].to_numpy(zero_copy_only=False), b["vec_id"].to_numpy(), _matrix(b["embedding"], b.num_rows)
            bound = b["bound"].to_numpy(zero_copy_only=False)
            first = starts([slots, ask])
            for low, high in zip(first, np.append(first[1:], b.num_rows), strict=True):
                if slots[low] != slot:
                    slot, ids, xs, index = slots[low], [], [], None
                if not ask[low]:
                    ids.append(names[low:high])
                    xs.append(x[low:high])
                    continue
                if not ids:
                    continue
                if index is None:
                    index = Index(space, np.concatenate(ids), np.concatenate(xs), k)
                for a in range(low, high, _ASKS):
                    z = slice(a, min(a + _ASKS, high))
                    row, found, score = index.search(names[z], x[z], bound[z], k)
                    yield pa.RecordBatch.from_arrays([pa.array(names[z][row]), pa.array(found), pa.array(score)], names=["query_id", "vec_id", "score"])

    return run


def _place(space: Space, low: np.ndarray, high: np.ndarray, parts: np.ndarray | None, offset: np.ndarray | None, ask: bool):
    """Give each row its cell's slot; of a cell with several, the one that a hash of the id names. Without parts: the cell."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b["embedding"], b.num_rows)
            p = space.queries(x) if ask else space.vectors(x)
            cell = np.empty(len(p), np.int64)
            for a in range(0, len(p), _ASKS):
                cell[a : a + _ASKS] = distances(p[a : a + _ASKS], low, high).argmin(1)
            if parts is None:
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), b["vec_id"], b["embedding"]], names=["cell", "vec_id", "embedding"])
                continue
            slot = offset[cell] + (b["vec_id"].to_numpy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % parts[cell]
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), b["vec_id"], b["embedding"]], names=["slot", "vec_id", "embedding"])

    return run


def _others(space: Space, low: np.ndarray, high: np.ndarray, parts: np.ndarray, offset: np.ndarray):
    """Each query once for every other slot that may hold a better vector than its k-th best at home."""
    cell_of = np.repeat(np.arange(len(parts)), parts)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            home, bound, x = b["slot"].to_numpy(), b["bound"].to_numpy(zero_copy_only=False), _matrix(b["embedding"], b.num_rows)
            for a in range(0, len(x), _ASKS):
                z = slice(a, a + _ASKS)
                open_ = distances(space.queries(x[z]), low, high) < space.radius(x[z], bound[z])[:, None]
                row, slot = np.nonzero(open_[:, cell_of])
                other = slot != home[z][row]
                row, slot = row[other] + a, slot[other]
                for c in range(0, len(row), 8192):
                    r, t = pa.array(row[c : c + 8192]), slot[c : c + 8192]
                    yield pa.RecordBatch.from_arrays([pa.array(t.astype(np.int32)), pa.array(np.ones(len(t), bool)), b["vec_id"].take(r), b["embedding"].take(r), b["bound"].take(r)], names=["slot", "ask", "vec_id", "embedding", "bound"])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, axes: int = 16, confidence: float = 0.95, block: int = 4096, sample: int = 20_000, seed: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its k rows of ``vectors`` with the largest inner products.

    Both have vec_id and embedding; a query's own vec_id is no candidate. Ties go to the smaller
    vec_id. Vectors that are null, zero, or hold null or non-finite components, or an unusual number
    of them, take no part, nor do rows with a null vec_id. With fewer than k candidates all are
    returned; an empty side gives no rows. Repeated rows are candidates of their own; a vec_id asks
    once, with the smallest of its vectors. Extra columns are ignored.

    All vectors are indexed. A kd-tree of the projections of at most about ``sample`` vectors parts the space
    into cells, each cell's rows are dealt to slots of about ``block`` rows, and every slot is a task with a
    kd-tree of its own. A query first searches one slot of its home cell; its k-th best there
    bounds which other slots it is sent to. Both that choice and the search in a slot end by the
    chi-square test, so each of the k best is found with the given confidence at least.

    What that saves depends on the vectors: in clusters a query visits few slots and fewer than half of their leaves; where
    directions are nearly uniform, 16 projections rule out hardly anything at 95 %, and queries go to nearly every slot, so the work
    grows with queries times vectors.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    arrow_batches(spark)
    dim = dimension(vectors, "embedding")
    take = lambda d: d.where("vec_id is not null").where(valid("embedding", dim)).select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    data, asks = take(vectors), scratch.save(take(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    n, top = data.agg(F.count(F.lit(1)), F.max(F.sqrt(square))).first()
    if not n or not asks.head(1):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    space = Space(dim, top * (1 + 1e-9), axes, confidence, seed)
    share = min(1.0, sample / n)
    some = data.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_003)) < share * 1_000_003).select("embedding").limit(2 * sample).toPandas()["embedding"]
    points = space.vectors(np.array(some.tolist(), np.float64).reshape(-1, dim))
    # No more cells than the sample has sixteens, however many vectors there are: larger cells have more slots.
    _, low, high = kd_tree(points, max(16, ceil(len(points) * min(1.0, block / n))))
    placed = scratch.save(data.mapInArrow(_place(space, low, high, None, None, False), "cell int, vec_id long, embedding array<double>"))
    sizes = np.zeros(len(low), np.int64)
    for r in placed.groupBy("cell").count().collect():
        sizes[r["cell"]] = r["count"]
    parts = np.maximum(1, -(-sizes // (2 * block)))
    offset = np.cumsum(parts) - parts
    slots = int(parts.sum())
    by_cell = F.broadcast(spark.createDataFrame([(i, int(o), int(p)) for i, (o, p) in enumerate(zip(offset, parts, strict=True))], "cell int, offset int, parts int"))
    slot = (F.col("offset") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).cast("int")
    stored = placed.join(by_cell, "cell").select(slot.alias("slot"), F.lit(False).alias("ask"), "vec_id", "embedding", F.lit(0.0).alias("bound"))

    def answer(asking: DataFrame) -> DataFrame:
        rows = stored.unionByName(asking).repartitionById(slots, "slot").sortWithinPartitions("slot", "ask")
        return scratch.save(rows.mapInArrow(_answer(space, k), _FOUND))

    home = scratch.save(asks.mapInArrow(_place(space, low, high, parts, offset, True), "slot int, vec_id long, embedding array<double>"))
    answers = [answer(home.select("slot", F.lit(True).alias("ask"), "vec_id", "embedding", F.lit(float("-inf")).alias("bound")))]
    if slots > 1:
        worst = answers[0].groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst"))
        known = home.join(worst, "vec_id", "left").select("slot", "vec_id", "embedding", F.when(F.col("n") >= k, F.col("worst")).otherwise(F.lit(float("-inf"))).alias("bound"))
        answers.append(answer(known.mapInArrow(_others(space, low, high, parts, offset), _ROWS)))
    scratch.keep(*answers)
    found = reduce(DataFrame.union, answers)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
