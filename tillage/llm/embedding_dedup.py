"""Embedding near-duplicates by randomly rotated binary codes with correction factors."""

from __future__ import annotations

from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillage.llm.common import Scratch, blocked, forest, map_runs, arrow_batches, starts
from tillage.llm.graph import connected_components


def sound(column: str) -> F.Column:
    """The vector has components, none null or non-finite, and isn't zero."""
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def valid(column: str, dim: int) -> F.Column:
    """The vector is sound and has ``dim`` components."""
    return sound(column) & F.coalesce(F.size(column) == dim, F.lit(False))


def dimension(vectors: DataFrame, column: str) -> int:
    """The most frequent number of components, the larger one of a tie; 0 for none."""
    row = vectors.where(f"{column} is not null").groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return row["d"] if row else 0


def rotations(dim: int, times: int, seed: int) -> np.ndarray:
    """(times * dim, dim): random orthogonal matrices one below the other."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(times):
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        out.append(q * np.sign(np.diag(r)))
    return np.concatenate(out)


def bands_for(n: int, cosine: float, miss: float = 0.002) -> tuple[int, int]:
    """(bands, bits) so that buckets hold up to about a thousand of n vectors and a pair at ``cosine`` meets in none with chance ``miss``."""
    bits = int(min(24, max(4, ceil(log2(max(n, 1) / 1024 + 1)))))
    same = (1 - acos(cosine) / pi) ** bits
    return ceil(log(miss) / log(1 - same)), bits


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits of the rotated unit vectors, and the inner product of each with its own code: the correction factor."""
    y = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ turn.T
    return y > 0, np.abs(y).sum(1) / np.sqrt(turn.shape[0] * (turn.shape[0] / x.shape[1]))


def turned(x: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """The rotated unit vectors."""
    return (x / np.linalg.norm(x, axis=1, keepdims=True)) @ turn.T


def quantise(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rotated vectors in 4 bits a component, two in a byte, and the step between levels: (bytes, step).

    Levels lie symmetrically around zero, none on it, so the upper half of them are the sign bits.
    """
    step = np.maximum(np.abs(y).max(1) / 8, 1e-30).astype(np.float32)
    q = np.clip(np.floor(y / step[:, None]) + 8, 0, 15).astype(np.uint8)
    q = np.concatenate([q, np.zeros((len(q), q.shape[1] % 2), np.uint8)], 1)
    return q[:, ::2] << 4 | q[:, 1::2], step


def restored(packed: np.ndarray, step: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sign bits, rounded components) of quantised vectors."""
    q = np.stack([packed >> 4, packed & 15], 2).reshape(len(packed), -1)[:, :size]
    return q >= 8, (q.astype(np.float32) - 7.5) * step[:, None]


def estimate(bits: np.ndarray, factor: np.ndarray, y: np.ndarray, dim: int) -> np.ndarray:
    """Unbiased estimates of the cosines between the coded vectors and the rotated unit vectors y."""
    size = y.shape[1]
    signs = (2.0 * bits - 1).astype(np.float32)
    return (signs @ y.T.astype(np.float32)) / (np.sqrt(size * (size / dim)) * factor[:, None])


def margin(factor: np.ndarray, size: int, dim: int, width: float, step: np.ndarray | None = None) -> np.ndarray:
    """Half the confidence interval of an estimate, ``width`` standard deviations wide: of each code, or of each code with each vector rounded to ``step``.

    Rounding is that of one rotation, from which the others are computed, so its errors don't average out over them.
    """
    variance = np.maximum(1 - factor**2, 0) / factor**2 / max(1, dim - 1) / (size / dim)
    if step is not None:
        variance = variance[:, None] + (step[None, :] / factor[:, None]) ** 2 / 12
    return width * np.sqrt(variance)


def _code(turn: np.ndarray, hashes: np.ndarray, bands: int, bits: int):
    """Everything that is kept of a vector, once: its bands' buckets, code, correction factor, step, and itself.

    The buckets come from ``bands * bits`` signs of their own rotations, the code from those of ``turn``: the first
    rotated vector in 4 bits a component, which hold its signs, and the signs of the others.
    """
    weights = 1 << np.arange(bits, dtype=np.int64)
    names = ["node", "copies", "buckets", "code", "more", "factor", "step", "vector"]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = b["embedding"].flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(np.float64)
            signs = turned(x, hashes) > 0
            buckets = signs[:, : bands * bits].reshape(len(x), bands, bits) @ weights
            all_signs, factor = encode(x, turn)
            code, step = quantise(turned(x, turn[: x.shape[1]]))
            more = np.packbits(all_signs[:, x.shape[1] :], axis=1)
            raw = x.astype(np.float32) if b["embedding"].type.value_type == pa.float32() else x
            blobs = [pa.array([r.tobytes() for r in m], pa.binary()) for m in (code, more, raw)]
            yield pa.RecordBatch.from_arrays([b["node"], b["copies"], pa.array(list(buckets)), blobs[0], blobs[1], pa.array(factor.astype(np.float32)), pa.array(step), blobs[2]], names=names)

    return run


#: Rows of a cell that are compared with all others at once.
_ROWS = 256
CELL = ("band", "bucket", "block_i", "block_j")


def _cells(table: pa.Table):
    """(columns, first row, end, left rows, right rows, same) of each cell that can hold a pair."""
    c = {k: table[k].to_numpy() for k in (*CELL, "node", "side")}
    first = starts([c[k] for k in CELL])
    for low, high in zip(first, np.append(first[1:], table.num_rows), strict=True):
        same, side = c["block_i"][low] == c["block_j"][low], c["side"][low:high]
        left, right = (np.arange(high - low),) * 2 if same else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        if len(left) and len(right) and high - low > 1:
            yield c, low, high, left, right, same


def _blob(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _open(turn: np.ndarray, cosine: float, width: float):
    """The rows of each cell that have a partner whose confidence interval reaches the threshold.

    A pair is judged by the wider of both directions, code against rounded vector, so it is open in every cell or in none.
    """

    size, dim = turn.shape

    def work(table: pa.Table):
        table, out = table.combine_chunks(), []
        for _, low, high, left, right, same in _cells(table):
            part = table.slice(low, high - low)
            factor, step = part["factor"].to_numpy().astype(np.float64), part["step"].to_numpy()
            bits, y = restored(_blob(part["code"], "u1"), step, dim)
            bits = np.concatenate([bits, np.unpackbits(_blob(part["more"], "u1"), axis=1, count=size - dim).astype(bool)], 1)
            y = y @ (turn[:dim] @ turn.T).astype(np.float32)
            reach = lambda a, b: estimate(bits[a], factor[a], y[b], dim) + margin(factor[a], size, dim, width, step[b])  # noqa: B023, E731
            some = np.zeros(high - low, bool)
            for k in range(0, len(left), _ROWS):
                mine = left[k : k + _ROWS]
                open_ = np.maximum(reach(mine, right), reach(right, mine).T) >= cosine
                if same:
                    open_[np.arange(len(mine)), mine] = False
                some[mine] |= open_.any(1)
                some[right] |= open_.any(0)
            out.append(low + np.flatnonzero(some))
        if out and len(rows := np.concatenate(out)):
            yield table.select([*CELL, "side", "node"]).take(pa.array(rows)).combine_chunks().to_batches()[0]

    return work


def _links(kind: str, cosine: float):
    """Exact cosines of the open rows of a cell: per node the vectors linked (kind 0), and a forest (kind 1)."""

    def work(table: pa.Table):
        table, found = table.combine_chunks(), []
        copies = table["copies"].to_numpy()
        for c, low, high, left, right, same in _cells(table):
            part = table.slice(low, high - low)
            x = _blob(part["vector"], kind).astype(np.float64)
            u = x / np.linalg.norm(x, axis=1, keepdims=True)
            i, j = np.nonzero(u[left] @ u[right].T >= cosine - 1e-9)
            if same:
                i, j = i[i < j], j[i < j]
            i, j = left[i], right[j]
            ok = np.concatenate([np.einsum("ij,ij->i", u[i[k : k + 50_000]], u[j[k : k + 50_000]]) >= cosine for k in range(0, len(i), 50_000)] or [np.zeros(0, bool)])
            i, j = i[ok], j[ok]
            buckets = part["buckets"].combine_chunks().flatten().to_numpy().reshape(high - low, -1)
            mine = np.concatenate([(buckets[i[k : k + 50_000]] == buckets[j[k : k + 50_000]]).argmax(1) == c["band"][low] for k in range(0, len(i), 50_000)] or [np.zeros(0, bool)])
            i, j = i[mine], j[mine]  # the first band that a pair shares counts it
            if len(i):
                n = np.bincount(i, copies[low + j], high - low) + np.bincount(j, copies[low + i], high - low)
                node, some = c["node"][low:high], np.flatnonzero(n)
                a, b = forest(node[i], node[j])
                found.append((np.repeat(np.array([0, 1], np.int32), [len(some), len(a)]), np.concatenate([node[some], a]), np.concatenate([n[some].astype(np.int64), b])))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=["kind", "a", "b"])

    return work


def embedding_links(vectors: DataFrame, cosine: float = 0.9, width: float = 4.0, block: int = 1024, seed: int = 11) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    Two vectors of the same number of components are linked if their cosine in double precision is
    ``cosine`` or more. n_links counts the other rows linked directly, component_id is the smallest
    vec_id reachable, kept marks it. Null and zero vectors and those with null or non-finite
    components link with nothing. Rows of the same vec_id are vertices of their own for n_links
    and one for components; a row with a null vec_id links with nothing, has no component and isn't
    kept. An empty table gives no rows; extra columns are ignored.

    Vectors are rotated at random and stored once: the rotated vector in 4 bits a component, which hold its
    signs, the signs of a second rotation, a correction factor, and the vector itself. Bands of the signs of further rotations give buckets, up to a
    thousand vectors each; a pair at the threshold meets in one with chance 99.8 %. Only codes
    travel to the buckets, five bits a component and 28 bytes, however many vectors there are. There they estimate all inner products; rows with a partner whose confidence
    interval of ``width`` standard deviations reaches the threshold fetch their vectors, and the pairs among
    these are computed exactly. A pair is counted in the first band it shares. Copies are one
    vector with a weight; cells of large buckets report counts and a spanning forest instead of pairs.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    arrow_batches(spark)
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding")
    rows = scratch.save(rows.withColumn("dim", F.when(F.col("vec_id").isNotNull() & sound("embedding"), F.size("embedding"))))
    id_ = F.col("vec_id")
    out = rows.where("dim is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), id_.alias("component_id"), id_.isNotNull().alias("kept"))
    # A table has few numbers of components; each is a space of its own.
    parts: list[DataFrame] = []
    for r in rows.where("dim is not null").groupBy("dim").count().collect():
        done = _linked(scratch, rows.where(F.col("dim") == r["dim"]), r["dim"], cosine, width, block, seed)
        parts.append(done)
        scratch.keep(rows, *parts)
        linked = rows.where(F.col("dim") == r["dim"]).join(done, "embedding")
        out = out.unionByName(linked.select("vec_id", "n_links", "component_id", (id_ == F.col("component_id")).alias("kept")))
    return out


def _linked(scratch: Scratch, good: DataFrame, dim: int, cosine: float, width: float, block: int, seed: int) -> DataFrame:
    """(embedding, n_links, component_id) of distinct sound vectors of ``dim`` components."""
    classes = scratch.save(good.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")))
    bands, bits = bands_for(classes.count(), cosine)
    turn, hashes = rotations(dim, 2, seed), rotations(dim, ceil(bands * bits / dim), seed + 1)
    kind = "<f4" if dict(classes.dtypes)["embedding"] == "array<float>" else "<f8"
    schema = "node long, copies long, buckets array<long>, code binary, more binary, factor float, step float, vector binary"
    coded = scratch.save(classes.mapInArrow(_code(turn, hashes, bands, bits), schema))
    members = coded.select("node", "code", "more", "factor", "step", F.posexplode("buckets").alias("band", "bucket"))
    cells = blocked(scratch, members, ["band", "bucket"], "node", block)
    spots = "band int, bucket long, block_i int, block_j int, side int, node long"
    open_ = scratch.save(map_runs(cells, list(CELL), _open(turn, cosine, width), spots, rows=4000))
    exact = open_.join(coded.select("node", "copies", "buckets", "vector"), "node")
    found = scratch.save(map_runs(exact, list(CELL), _links(kind, cosine), "kind int, a long, b long", rows=4000))
    links = found.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("links"))
    roots = connected_components(scratch, found.where("kind = 1").select(F.col("a").alias("u"), F.col("b").alias("v")))
    done = classes.join(links, "node", "left").join(roots, classes.node == roots.id, "left")
    return scratch.save(done.select("embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id")))
