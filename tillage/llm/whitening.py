"""Embedding whitening by a tiled covariance."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tillage.llm.common import Scratch, arrow_batches, map_runs, starts

#: Whole numbers a component is rounded to: steps of 1/256.
SCALE = 256
_LONG = 1 << 63
#: Rows of column blocks that a task holds at a time.
_BLOCKS = 16


def whole(vector: Column) -> Column:
    """Components as whole numbers floor(256 * c), in long; null for a null vector and one with a null or non-finite component."""
    c = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(F.coalesce(finite, F.lit(False)), F.transform(c, lambda x: F.floor(x * SCALE)))


@dataclass(frozen=True)
class Whitening:
    """What was learned of n distinct vectors: sums of each dimension, eigenvalues (falling) and unit eigenvectors (columns) of the covariance."""

    n: int
    sums: tuple[int, ...]
    largest: int
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None

    @property
    def dim(self) -> int:
        return len(self.sums)

    def rank(self, k: int) -> int:
        """How many of the first k components have a variance that isn't zero within double precision."""
        return int((self.values[:k] > 1e-12 * max(self.trace, 0)).sum()) if self.trace > 0 else 0

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: in 64 bits where they suffice, else in Python's whole numbers."""
        reach = self.n * max(self.largest, 1) + max(map(abs, self.sums), default=0)
        if reach < _LONG:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)

    def projected(self, x: np.ndarray, k: int) -> np.ndarray:
        """Whitened coordinates of the first k components."""
        return self.centred(x) @ self.vectors[:, :k] / np.sqrt(self.values[:k])

    def distances(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - S)^2, exact; None where it isn't a long."""
        d = self.deviations(x)
        if d.dtype != object and (not d.size or self.dim * int(np.abs(d).max()) ** 2 < _LONG):
            return (d * d).sum(1).tolist()
        return [s if s < _LONG else None for s in (d.astype(object) ** 2).sum(1).tolist()]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _sums(dim: int):
    """What a task's vectors add to each dimension, in two halves of 32 bits, and to n."""

    def run(batches):
        high, low, n, largest = np.zeros(dim, np.int64), np.zeros(dim, np.int64), 0, 0
        for b in batches:
            if b.num_rows:
                x = _matrix(b["x"], dim)
                high += (x >> 32).sum(0)
                low += (x & 0xFFFFFFFF).sum(0)
                n += len(x)
                largest = max(largest, int(x.max()), -int(x.min()) - 1)
        columns = [np.arange(dim, dtype=np.int32), high, low, np.full(dim, n), np.full(dim, largest)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["d", "high", "low", "n", "largest"])

    return run


def _column_blocks(model: Whitening, tile: int):
    """Centred column blocks of a row block, which is one batch of a task."""

    def run(batches):
        task = TaskContext.get().partitionId()
        for k, b in enumerate(batches):
            if not b.num_rows:
                continue
            x = model.centred(_matrix(b["x"], model.dim))
            cuts = range(0, model.dim, tile)
            blocks = [np.ascontiguousarray(x[:, c : c + tile]).tobytes() for c in cuts]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(blocks), (task << 32) + k)), pa.array(np.arange(len(blocks), dtype=np.int32)), pa.array(np.full(len(blocks), len(x), np.int32)), pa.array(blocks, pa.binary())], names=["row_block", "col", "n_rows", "block"])

    return run


def _tile_rows(tiles: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
    i, j = (np.array(x, np.int32) for x in zip(*tiles, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array([t.tobytes() for t in tiles.values()], pa.binary())], names=["i", "j", "product"])


def _multiply(table: pa.Table):
    """Products of the two column blocks of each tile and row block, summed by tile."""
    keys = [table[k].to_numpy() for k in ("i", "j", "row_block")]
    first, col, n_rows = starts(keys), table["col"].to_numpy(), table["n_rows"].to_numpy()
    blocks, tiles = table["block"], {}
    for a in first.tolist():
        i, j = int(keys[0][a]), int(keys[1][a])
        one = np.frombuffer(blocks[a].as_py()).reshape(n_rows[a], -1)
        if i == j:
            both = one.T @ one
        else:
            two = np.frombuffer(blocks[a + 1].as_py()).reshape(n_rows[a], -1)
            both = one.T @ two if col[a] == i else two.T @ one
        tiles[i, j] = tiles[i, j] + both if (i, j) in tiles else both
    yield _tile_rows(tiles)


def _add(batches):
    """Sum of each tile that a task reads: one matrix a tile is held."""
    tiles: dict[tuple[int, int], np.ndarray] = {}
    for b in batches:
        for i, j, product in zip(b["i"].to_pylist(), b["j"].to_pylist(), b["product"], strict=True):
            part = np.frombuffer(product.as_buffer())
            if (i, j) in tiles:
                tiles[i, j] += part
            else:
                tiles[i, j] = part.copy()
    if tiles:
        yield _tile_rows(tiles)


def _spread(model: Whitening, k: int):
    """Sums of the whitened coordinates and of their products, of a task."""

    def run(batches):
        n, sums, cross = 0, np.zeros(k), np.zeros((k, k))
        for b in batches:
            if b.num_rows:
                w = model.projected(_matrix(b["x"], model.dim), k)
                n, sums, cross = n + len(w), sums + w.sum(0), cross + w.T @ w
        columns = [np.repeat(np.arange(k, dtype=np.int32), k), np.tile(np.arange(k, dtype=np.int32), k), cross.ravel(), np.repeat(sums, k), np.tile(sums, k)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "j", "both", "one", "other"])

    return run


def fit(vectors: DataFrame, k: int = 4, tile: int = 32) -> Whitening:
    """Learn a whitening of ``vectors`` (embedding): the covariance of its distinct vectors of whole numbers, divided by their number.

    Of vectors with different numbers of components the most frequent number counts (the larger of a tie);
    the others are left out, as are null vectors and those with null or non-finite components. Without
    any vector, or without dimensions, the result has no dimension and whitens nothing.

    The distinct vectors are found by an aggregation, so copies are combined before the shuffle. Their exact sums come
    first. Then each batch of rows is a row block; its centred columns, in blocks of ``tile`` (more where there are over 8
    blocks), go to the tiles (i, j), i <= j, that they take part in, by row block; a task multiplies the two blocks of a
    tile, sums by tile what it has, and a second shuffle adds up each tile, one matrix a task. The driver gets the
    dimensions' sums, the tiles (d^2 / 2 numbers) and the k x k covariance of the whitened vectors.
    """
    scratch = Scratch(vectors.sparkSession)
    arrow_batches(vectors.sparkSession)
    counted = scratch.save(vectors.select(whole(F.col("embedding")).alias("x")).where("x is not null").groupBy("x").agg(F.count(F.lit(1)).alias("copies")))
    sizes = counted.groupBy(F.size("x").alias("d")).agg(F.sum("copies").alias("copies")).orderBy(F.desc("copies"), F.desc("d")).first()
    dim = sizes["d"] if sizes else 0
    if not dim:
        return Whitening(0, (), 0, np.zeros(0), np.zeros((0, 0)), 0.0, None)
    distinct = counted.where(F.size("x") == dim).select("x")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    sums = distinct.mapInArrow(_sums(dim), "d int, high long, low long, n long, largest long").groupBy("d").agg(exact("high"), exact("low"), F.sum("n").alias("n"), F.max("largest").alias("largest")).orderBy("d").collect()
    n = sums[0]["n"]
    model = Whitening(n, tuple((int(r["high"]) << 32) + int(r["low"]) for r in sums), max(r["largest"] for r in sums) + 1, np.zeros(0), np.zeros((dim, 0)), 0.0, None)

    tile = max(tile, -(-dim // 8))
    count = -(-dim // tile)
    blocks = distinct.mapInArrow(_column_blocks(model, tile), "row_block long, col int, n_rows int, block binary")
    partners = F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    keyed = blocks.withColumn("other", partners).select("row_block", F.least("col", "other").alias("i"), F.greatest("col", "other").alias("j"), "col", "n_rows", "block")
    products = map_runs(keyed, ["i", "j", "row_block"], _multiply, "i int, j int, product binary", rows=_BLOCKS)
    tiles = products.mapInArrow(_add, "i int, j int, product binary").repartition("i", "j").mapInArrow(_add, "i int, j int, product binary").collect()
    v = np.zeros((dim, dim))
    for t in tiles:
        rows, columns = slice(t["i"] * tile, (t["i"] + 1) * tile), slice(t["j"] * tile, (t["j"] + 1) * tile)
        part = np.frombuffer(t["product"]).reshape(v[rows, columns].shape) / n
        v[rows, columns] = part
        v[columns, rows] = part.T
    values, turns = np.linalg.eigh(v)
    values, turns = values[::-1], turns[:, ::-1]
    turns = turns * np.where(turns[np.abs(turns).argmax(0), np.arange(dim)] < 0, -1.0, 1.0)
    model = Whitening(n, model.sums, model.largest, values, turns, float(np.trace(v)), None)
    k = model.rank(min(k, dim))
    error = None
    if k:
        total = lambda c: F.sum(c).alias(c)
        spread = distinct.mapInArrow(_spread(model, k), "i int, j int, both double, one double, other double").groupBy("i", "j").agg(total("both"), total("one"), total("other")).collect()
        error = max(abs(r["both"] / n - r["one"] / n * (r["other"] / n) - (r["i"] == r["j"])) for r in spread)
    scratch.keep()
    return Whitening(n, model.sums, model.largest, values, turns, model.trace, error)


def whiten(vectors: DataFrame, model: Whitening, k: int = 4) -> DataFrame:
    """A row for each vector of ``vectors`` (vec_id, embedding) and each of the first ``k`` components of ``model``.

    vec_id; component, from 1 by falling variance; n, the distinct vectors learned from; deviation, the exact sum of
    (n * x - S)^2 over the dimensions (null where it is no long); whitened, the coordinate (null for a component
    without variance); explained, the component's share of the trace (null where that is zero); identity_error, the largest entry by which
    the covariance of the whitened coordinates of all distinct vectors differs from the identity (null without one).

    Null vectors, those with null or non-finite components and those with another number of components than
    the model's have no rows. Repeated rows and null vec_ids are rows of their own; an empty table gives none;
    extra columns are ignored. There are no more components than dimensions.
    """
    arrow_batches(vectors.sparkSession)
    k = min(k, model.dim)
    some, explained = model.rank(k), [float(v) / model.trace if model.trace > 0 else None for v in model.values[:k]]
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, rows = _matrix(b["x"], model.dim), b.num_rows
            out = np.full((rows, k), np.nan)
            out[:, :some] = model.projected(x, some)
            ids, far = (pa.array(c.to_pylist() if isinstance(c, pa.Array) else c, pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))) for c in (b["vec_id"], model.distances(x)))
            columns = [ids, np.tile(np.arange(1, k + 1, dtype=np.int32), rows), np.full(rows * k, model.n), far, pa.array(out.ravel(), mask=np.tile(np.arange(k) >= some, rows)), explained * rows, [model.identity_error] * (rows * k)]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    x = whole(F.col("embedding"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(F.size("x") == (model.dim or -2))
    return rows.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
