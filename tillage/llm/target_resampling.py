"""Importance resampling towards a target: array-scored weights, sorted runs, tournament trees, exact ranks."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillage.llm.common import Scratch, arrow_batches

#: ASCII letters in lower case, digits as they are, all other ASCII characters blank; other bytes belong to words.
_FOLD = bytes(ord(chr(i).lower()) if chr(i).isascii() and chr(i).isalnum() else 0x20 if i < 0x80 else i for i in range(256))
#: Features whose buckets a task remembers.
_REMEMBERED = 300_000
#: Drawn rows of one range, about, and entries of the runs that are looked at to cut the ranges.
_RANGE, _LOOKED_AT = 100_000, 100_000
#: Null doc_ids come last of their score.
_LAST = 1 << 63


def words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of characters beyond ASCII, A-Z in lower case."""
    return text.translate(_FOLD).split()


def hashed(buckets: int, longest: int) -> Callable[[bytes | None], tuple[int, np.ndarray]]:
    """A function that gives the number of words of a text and the bucket of every run of 1 to ``longest`` consecutive ones, repeats included."""
    known: dict[bytes, int] = {}

    def of(feature: bytes) -> int:
        if len(known) >= _REMEMBERED:
            known.clear()
        known[feature] = h = zlib.crc32(feature) % buckets
        return h

    def run(text: bytes | None) -> tuple[int, np.ndarray]:
        own, get = words(text or b""), known.get
        every = own if longest == 1 else [b" ".join(own[i : i + n]) for n in range(1, longest + 1) for i in range(len(own) - n + 1)]
        return len(own), np.array([h if (h := get(f)) is not None else of(f) for f in every], np.int32)

    return run


def _features(buckets: int, longest: int):
    """Number of words and the buckets of the features of each text, as 32-bit numbers."""

    def run(batches):
        buckets_of = hashed(buckets, longest)
        for b in batches:
            n, found = zip(*map(buckets_of, b["text"].cast(pa.large_binary()).to_pylist()), strict=True) if b.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(n, pa.int64()), pa.array([f.tobytes() for f in found], pa.binary())], names=["doc_id", "n_words", "features"])

    return run


def _counts(buckets: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b["features"].to_pylist()), np.int32), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    return run


def features(docs: DataFrame, buckets: int, longest: int) -> DataFrame:
    """(doc_id, n_words, features) of ``docs`` (doc_id, text)."""
    arrow_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_features(buckets, longest), "doc_id long, n_words long, features binary")


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall into each bucket; tasks send one number for each bucket that they have."""
    sums = found.select("features").mapInArrow(_counts(buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[sums["bucket"]] = sums["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket 1000 times the log of its share of the target over its share of the corpus, both smoothed by one, rounded down."""
    n, s_all, t_all = len(raw), int(raw.sum()), int(target.sum())
    ratio = lambda s, t: (float(t + 1) * float(s_all + n)) / (float(s + 1) * float(t_all + n))
    return np.array([floor(1000 * log(ratio(s, t))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths, rounded down, drawn from a hash of seed and doc_id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return floor(-1000 * log(-log((h + 0.5) / 4294967296)))


def _score(table: np.ndarray, seed: int):
    def run(batches):
        for b in batches:
            ids, n, weights = b["doc_id"].to_pylist(), [], []
            for blob in b["features"].to_pylist():
                f = np.frombuffer(blob, np.int32)
                n.append(len(f))
                weights.append(int(table[f].sum()) // len(f) if len(f) else 0)
            scores = [w + gumbel(i, seed) for i, w in zip(ids, weights, strict=True)]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["n_words"], *(pa.array(x, pa.int64()) for x in (n, weights, scores))], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return run


# ---- ranks ----


def merged(runs: list[Iterable[tuple]]) -> Iterator[tuple]:
    """The entries of sorted runs in order, by a tournament tree of losers: one comparison a level for each entry.

    Of equal entries that of the earlier run comes first.
    """
    k = len(runs)
    if k <= 1:
        yield from (runs[0] if runs else ())
        return
    heads = [iter(r) for r in runs]
    # A leaf is (spent, entry, run); node i has the loser of the match below it, and 0 the winner.
    leaves = [(0, x, i) if (x := next(h, None)) is not None else (1, (), i) for i, h in enumerate(heads)]
    tree: list[tuple] = [()] * k
    winners = [()] * k + leaves
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], tree[node] = (a, b) if a < b else (b, a)
    best = winners[1]
    while not best[0]:
        yield best[1]
        run = best[2]
        x = next(heads[run], None)
        best = (0, x, run) if x is not None else (1, (), run)
        node = (run + k) // 2
        while node:
            if tree[node] < best:
                tree[node], best = best, tree[node]
            node //= 2


def merge_tree(runs: list[Iterable[tuple]], fan: int = 64) -> Iterator[tuple]:
    """merged, with no more than ``fan`` runs in one tree: beyond, trees of trees."""
    while len(runs) > fan:
        runs = [merged(runs[i : i + fan]) for i in range(0, len(runs), fan)]
    return merged(runs)


@dataclass(frozen=True)
class _Cuts:
    """Where the ranges of keys (-score, doc_id) begin; keys before the first cut are in range 0."""

    score: np.ndarray
    doc: np.ndarray

    def ranges(self, score: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The range of each key; both columns sort together as the keys do."""
        if not len(self.score):
            return np.zeros(len(score), np.int64)
        every = np.lexsort((np.repeat([1, 0], [len(score), len(self.score)]), np.concatenate([doc, self.doc]), np.concatenate([score, self.score])))
        at = np.cumsum(every >= len(score))
        out = np.empty(len(every), np.int64)
        out[every] = at
        return out[: len(score)]


def _keys(b) -> tuple[np.ndarray, np.ndarray]:
    """(-score, doc_id as an unsigned number that sorts as it does, null last)."""
    doc = b["doc_id"].to_numpy(zero_copy_only=False) if not b["doc_id"].null_count else np.array([0 if d is None else d for d in b["doc_id"].to_pylist()], np.int64)
    doc = doc.astype(np.int64).view(np.uint64) ^ np.uint64(_LAST)
    doc[np.asarray(b["doc_id"].is_null())] = np.uint64(2**64 - 1)
    return -b["score"].to_numpy(), doc


def _pieces(b):
    """Stretches of a batch that come from one sorted run: (first row, end, -scores, doc keys)."""
    score, doc = _keys(b)
    run = b["run"].to_numpy()
    down = (run[1:] != run[:-1]) | (score[1:] < score[:-1]) | ((score[1:] == score[:-1]) & (doc[1:] < doc[:-1]))
    ends = [*(np.flatnonzero(down) + 1).tolist(), len(score)]
    for a, z in zip([0, *ends[:-1]], ends, strict=True):
        yield a, z, score[a:z], doc[a:z]


def _looked_at(every: int):
    """Each ``every``-th entry of a task's runs."""

    def run(batches):
        n = 0
        for b in batches:
            score, doc = _keys(b)
            take = np.arange(-n % every, len(score), every)
            n += len(score)
            yield pa.RecordBatch.from_arrays([pa.array(score[take]), pa.array((doc[take] ^ np.uint64(_LAST)).view(np.int64))], names=["score", "doc"])

    return run


def _range_sizes(cuts: _Cuts):
    def run(batches):
        total = np.zeros(len(cuts.score) + 1, np.int64)
        for b in batches:
            for _, _, score, doc in _pieces(b):
                total += np.bincount(cuts.ranges(score, doc), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["range", "n"])

    return run


def _slices(cuts: _Cuts, last: int):
    """The rows of a run that fall into each of the ranges up to ``last``, packed: one row for each range that has any.

    Rows of the ranges beyond go on as they are, with range -1 and one packed slice a batch.
    """
    names = ["doc_id", "n_features", "weight", "score"]

    def run(batches):
        for b in batches:
            columns = [np.asarray(b["doc_id"].fill_null(0)), np.asarray(b["doc_id"].is_null()).astype(np.int64), *(np.asarray(b[c]) for c in names[1:])]
            table = np.stack([c.astype(np.int64) for c in columns], 1)
            where, blobs = [], []
            for a, z, score, doc in _pieces(b):
                r = cuts.ranges(score, doc)
                r[r > last] = -1
                ends = np.append(np.flatnonzero(r[1:] != r[:-1]) + 1, z - a)
                for low, high in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
                    where.append(int(r[low]))
                    blobs.append(table[a + low : a + high].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array(blobs, pa.binary())], names=["range", "slice"])

    return run


_RANKED = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_features", "weight", "score", "rank")])


def _ranked(rows: list[tuple], ranks: list[int | None]) -> pa.RecordBatch:
    doc, null, *rest = zip(*rows, strict=True)
    columns = [pa.array(np.array(doc, np.int64), mask=np.array(null, bool)), *(pa.array(c, pa.int64()) for c in rest), pa.array(ranks, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, schema=_RANKED)


def _merge(before: dict[int, int], drawn: int, rows: int = 20_000):
    """Merge the slices of each range that a task has, and number the rows from those of the ranges before; beyond ``drawn`` there is no rank."""

    def entries(blob: bytes) -> Iterator[tuple]:
        for row in np.frombuffer(blob, np.int64).reshape(-1, 5).tolist():
            yield (-row[4], row[1], row[0], row)

    def run(batches):
        slices: dict[int, list[bytes]] = {}
        for b in batches:
            for r, blob in zip(b["range"].to_pylist(), b["slice"].to_pylist(), strict=True):
                slices.setdefault(r, []).append(blob)
        for r in sorted(slices):
            rank, some, ranks = before[r], [], []
            for entry in merge_tree([entries(blob) for blob in slices.pop(r)]):
                rank += 1
                some.append(tuple(entry[3]))
                ranks.append(rank if rank <= drawn else None)
                if len(some) == rows:
                    yield _ranked(some, ranks)
                    some, ranks = [], []
            if some:
                yield _ranked(some, ranks)

    return run


def _unranked(batches):
    """The rows of slices that are beyond the draw."""
    for b in batches:
        for blob in b["slice"].to_pylist():
            rows = [tuple(r) for r in np.frombuffer(blob, np.int64).reshape(-1, 5).tolist()]
            yield _ranked(rows, [None] * len(rows))


def draw(scored: DataFrame, share: tuple[int, int], scratch: Scratch) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of ``scored`` (doc_id, n_features, weight, score, eligible).

    Of the eligible rows the floor(share * their number) with the highest scores get ranks from 1, ties in the order
    of doc_id, null last. Each task sorts its eligible rows into a run, which is written. Every so many entries of the
    runs are looked at, at most some 100,000 in all and one a task, to cut the keys into ranges of about as many rows;
    the runs' rows are counted by range, so each range knows the rank it starts from, and the draw which range is the last.
    The runs' slices of these ranges are merged, a range a task, by tournament trees; numbering stops after the exact count.
    """
    spark = scored.sparkSession
    columns = ["doc_id", "n_features", "weight", "score"]
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    runs = scratch.save(scored.where("eligible").select(*columns, F.spark_partition_id().alias("run")).sortWithinPartitions(*order))
    out = scored.where("not eligible").select(*columns, F.lit(None).cast("long").alias("rank"))
    n = runs.count()
    drawn = n * share[0] // share[1]
    if not drawn:
        return out.unionByName(runs.select(*columns, F.lit(None).cast("long").alias("rank")))
    seen = runs.mapInArrow(_looked_at(max(1, n // _LOOKED_AT)), "score long, doc long").orderBy("score", "doc").toPandas()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // _RANGE)
    at = np.unique(np.linspace(0, len(seen), min(parts, len(seen)) + 1).astype(np.int64)[1:-1])
    cuts = _Cuts(seen["score"].to_numpy(np.int64)[at], seen["doc"].to_numpy(np.int64)[at].view(np.uint64) ^ np.uint64(_LAST))
    sizes = {r["range"]: r["n"] for r in runs.mapInArrow(_range_sizes(cuts), "range long, n long").groupBy("range").agg(F.sum("n").alias("n")).collect()}
    before, total, last = {}, 0, 0
    for r in sorted(sizes):
        before[r], total, last = total, total + sizes[r], r
        if total >= drawn:
            break
    schema = "doc_id long, n_features long, weight long, score long, rank long"
    slices = scratch.save(runs.mapInArrow(_slices(cuts, last), "range long, slice binary"))
    ranked = slices.where("range >= 0").repartition(max(1, len(before)), "range").mapInArrow(_merge(before, drawn), schema)
    return out.unionByName(ranked).unionByName(slices.where("range < 0").select("slice").mapInArrow(_unranked, schema))


def resample_to_target(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (10, 100), least_words: int = 20, buckets: int = 10_000, longest: int = 1, seed: int = 2024) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of ``docs`` (doc_id, text): a sample of it that resembles ``target`` (text).

    Features are the runs of 1 to ``longest`` words; a feature's bucket is its crc32 modulo ``buckets``. A bucket gains 1000
    times the log of its share of the target's features over that of the documents' (smoothed by one, rounded down). A
    document's weight is the mean gain of its features (rounded down, 0 without any), looked up in one array; its score adds
    Gumbel noise from a hash of ``seed`` and doc_id, which makes the highest scores a sample without replacement. Of the
    documents with ``least_words`` words or more the share[0] / share[1] with the highest scores have a rank; see draw.

    Null and empty texts have no words; a null doc_id draws as an empty one and comes last of its score; rows that repeat a
    doc_id share its noise, are rows of their own and may all be drawn. Empty tables give no rows, an empty target leaves weights that favour rare
    buckets. Extra columns are ignored. The driver gets one number for each bucket and range, and the entries looked at.
    """
    scratch = Scratch(docs.sparkSession)
    found = scratch.save(features(docs, buckets, longest))
    wanted = features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets, longest)
    table = gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets))
    rows = found.mapInArrow(_score(table, seed), "doc_id long, n_words long, n_features long, weight long, score long")
    scored = scratch.save(rows.withColumn("eligible", F.col("n_words") >= least_words))
    scratch.drop(found)
    return draw(scored, share, scratch)
