"""Fuzzy line deduplication: MinHash, banding, exact Jaccard, union-find."""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillage.llm.common import Scratch, arrow_batches, edge_batch, forest, map_runs, starts
from tillage.llm.graph import connected_components
from tillage.llm.ngrams import _ODD, mix

#: Characters whose shingles are hashed at once; they fit a core's cache.
_CHARS = 200_000
#: Band keys that a task combines before it sends them on.
_KEYS = 600_000
#: Characters of the corpus for each partition of band keys: some 1.5 million keys.
_PART = 32_000_000
#: Ranges that a task's numbers are cut into at once; with more partitions they are cut in two steps.
_RANGES = 1024
#: Rows that one task makes of a group of rows that are equal in all columns.
_CHUNK = 50_000
#: Lines of a large cell whose shingles are counted against all its lines at once.
_ROWS = 1024
_BLANK = " \t\r\f\x0b"
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64(0xFFFFFFFF)


def shingles(lines: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, line) of every run of ``size`` characters; a shorter line is one shingle."""
    length = np.array([len(s) for s in lines], np.int64)
    points = np.frombuffer("".join([*lines, "\0" * size]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    end = np.cumsum(length)
    h = points[: end[-1]] * _ODD[0]
    for j in range(1, size):
        h += points[j : end[-1] + j] * _ODD[j]
    line = np.repeat(np.arange(len(lines)), length)
    whole = np.ones(len(h), bool)
    for j in range(1, size):  # the last runs of a line would reach into the next one
        whole[(end - j)[length >= j]] = False
    for i in np.flatnonzero(length < size).tolist():
        first = end[i] - length[i]
        h[first] = (points[first : end[i]] * _ODD[: length[i]]).sum(dtype=np.uint64) + np.uint64(length[i] + 1)
        whole[first] = True
    return mix(h[whole]), line[whole]


def signatures(lines: list[str], size: int, values: int) -> np.ndarray:
    """MinHash sketches of the lines' shingles: ``values`` numbers, each equal for two lines with the chance of their similarity.

    Fast similarity sketching: in round r every shingle falls into one place at random with a value
    of this round; a place keeps its smallest, and earlier rounds win. Lines go on until every place
    is taken, long ones for a round or two; after ``values`` rounds, which only the shortest lines
    reach, each round fills one place from all shingles. The rounds are the same hash functions for
    lines of every length, so any two are comparable.
    """
    h, line = shingles(lines, size)
    out = np.full(len(lines) * values, _EMPTY)
    base, done = line * values, 0
    while len(h):
        # Later rounds change nothing where a place is taken, so several can go at once.
        count = min(max(1, _CHARS // len(h)), max(1, done), 2 * values - done)
        r = np.arange(done, done + count, dtype=np.uint64)[:, None]
        x = h ^ (r * _ODD[3])
        x *= _ODD[4]
        x ^= x >> np.uint64(32)
        x *= _ODD[5]
        place = ((x & _LOW) * np.uint64(values) >> np.uint64(32)).view(np.int64)
        last = max(0, values - done)
        place[last:] = r[last:].view(np.int64) - values
        place += base
        x >>= np.uint64(32)
        x |= r << np.uint64(32)
        np.minimum.at(out, place.ravel(), x.ravel())
        done += count
        todo = (out.reshape(-1, values) == _EMPTY).any(1)
        if not todo.any():
            break
        keep = todo[base // values]
        h, base = h[keep], base[keep]
    return out.reshape(-1, values)


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    rows = sig.shape[1] // bands
    part = sig.reshape(len(sig), rows, bands).transpose(0, 2, 1)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _ODD[1], part.shape[:2])
    for j in range(rows):
        h = mix(h ^ (part[:, :, j] * _ODD[2]))
    return h.view(np.int64)


def normal_lines(text: str) -> list[str]:
    """The lines of a text as they are compared; blank ones are empty."""
    return [s.strip(_BLANK).lower() for s in text.split("\n")]


def line_id(norm: str) -> int:
    """XXH64 of a normal line, unsigned."""
    return xxhash.xxh64_intdigest(norm.encode("utf-8", "replace"), 42)


def _stars(key: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort by key (unsigned), and give each row its key's smallest line: (key, line, leader)."""
    order = np.argsort(key.view(np.uint64))
    key, line = key[order], line[order]
    first = starts([key])
    return key, line, np.repeat(np.minimum.reduceat(line, first), np.diff(np.append(first, len(key))))


def _cuts(values: np.ndarray, parts: int) -> np.ndarray:
    """Where each of ``parts`` equal ranges of 64-bit numbers starts in sorted values, and the end."""
    part = (values.view(np.uint64) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    return np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))


def _packed(columns: list[np.ndarray], by: np.ndarray, parts: int) -> dict[int, bytes]:
    """The columns' rows of each of ``parts`` ranges of the sorted numbers ``by`` that has any, as bytes."""
    cuts, table = _cuts(by, parts), np.stack(columns, 1)
    return {int(i): table[cuts[i] : cuts[i + 1]].tobytes() for i in np.flatnonzero(np.diff(cuts))}


def _unpacked(blobs: list[bytes], width: int) -> list[np.ndarray]:
    return list(np.frombuffer(b"".join(blobs), np.int64).reshape(-1, width).T.copy())


def _first_places(line: np.ndarray, some: np.ndarray, doc: np.ndarray, pos: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which rows are the smallest place, by (null first, doc, position, row), of each line, in the lines' order (unsigned)."""
    order = np.lexsort((row, pos, doc, some, line.view(np.uint64)))
    return order[starts([line[order]])]


def _routed(line: np.ndarray, places: list[np.ndarray], key: np.ndarray, member: np.ndarray, linked: list[np.ndarray], parts: int) -> pa.RecordBatch:
    """Rows for the partitions that get any of: first places by line, the leader of each key by key, and what is linked to a leader by line."""
    at = _first_places(line, *places)
    some, doc, pos, row = (x[at] for x in places)
    one = _packed([line[at], doc, pos * 2 + some, row], line[at], parts)
    key, member, leader = _stars(key, member)
    first = starts([key])
    two = _packed([key[first], leader[first]], key[first], parts)
    more = np.flatnonzero(member != leader)
    linked = [np.concatenate(x) for x in zip(linked, (key[more], leader[more], member[more]), strict=True)]
    order = np.argsort(linked[2].view(np.uint64))
    linked = [x[order] for x in linked]
    three = _packed(linked, linked[2], parts)
    which = sorted({*one, *two, *three})
    blobs = [pa.array([x.get(i, b"") for i in which], pa.binary()) for x in (one, two, three)]
    return pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), *blobs], names=["part", "places", "own", "linked"])


def _bands(size: int, bands: int, rows: int, parts: int):
    """Lines of whole documents: their first places, and their band keys as stars.

    Equal lines and equal keys are combined for some ten thousand lines at a time. Each time one row
    goes to every partition that gets anything, with the packed numbers of its range: first places (line, doc_id, place, row) by
    line, leaders (key, line) by key, and what a leader already has linked (key, leader, line) by line.
    """
    none = [np.zeros(0, np.int64)] * 3

    def flush(ids: list[int], firsts: list[tuple[bool, int, int, int]], keys: list[np.ndarray]) -> pa.RecordBatch:
        line = np.array(ids, np.uint64).view(np.int64)
        places = [np.array(x, np.int64) for x in zip(*firsts, strict=True)]
        return _routed(line, places, np.concatenate(keys).ravel(), np.repeat(line, bands), none, parts)

    def run(batches):
        met, ids, firsts, keys, lines, chars = {}, [], [], [], [], 0

        def learn():
            keys.append(band_keys(signatures(lines, size, bands * rows), bands))

        for b in batches:
            for doc, row, text in zip(b["doc_id"].to_pylist(), b["row"].to_pylist(), b["text"].to_pylist(), strict=True):
                for pos, norm in enumerate(normal_lines(text) if text else ()):
                    if not norm:
                        continue
                    i = line_id(norm)
                    here, at = (doc is not None, doc or 0, pos, row), met.get(i)
                    if at is not None:
                        firsts[at] = min(firsts[at], here)
                        continue
                    met[i] = len(ids)
                    ids.append(i)
                    firsts.append(here)
                    lines.append(norm)
                    chars += len(norm)
                    if chars >= _CHARS:
                        learn()
                        lines, chars = [], 0
                if len(ids) * bands >= _KEYS:
                    if lines:
                        learn()
                        lines, chars = [], 0
                    yield flush(ids, firsts, keys)
                    met, ids, firsts = {}, [], []
                    keys.clear()
        if lines:
            learn()
        if ids:
            yield flush(ids, firsts, keys)

    return run


def _read(blobs: dict[str, list[bytes]]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray, list[np.ndarray]]:
    """What _routed packed: lines, their places, keys, their members, links."""
    line, doc, pos, row = _unpacked(blobs["places"], 4)
    return line, [pos & 1, doc, pos >> 1, row], *_unpacked(blobs["own"], 2), _unpacked(blobs["linked"], 3)


_BLOBS = ("places", "own", "linked")


def _regroup(parts: int):
    """The numbers of a wide range, combined again some 600,000 keys at a time, for its narrow ranges."""

    def run(batches):
        held, size = {k: [] for k in _BLOBS}, 0
        for b in batches:
            for values in zip(*(b[k].to_pylist() for k in _BLOBS), strict=True):
                for k, blob in zip(_BLOBS, values, strict=True):
                    held[k].append(blob)
                    size += len(blob)
                if size >= _KEYS * 16:
                    yield _routed(*_read(held), parts)
                    held, size = {k: [] for k in _BLOBS}, 0
        if size:
            yield _routed(*_read(held), parts)

    return run


def _lead(batches):
    """All numbers of a partition: each line's first place (kind 0), and the stars of its keys (kind 1).

    Lines and keys are dealt by hashes and combined on the way, so a partition holds its share of the distinct ones,
    and of one that every task has no more than a row from each batch of tasks.
    """
    held = {k: [] for k in _BLOBS}
    for b in batches:
        for k in _BLOBS:
            held[k] += b[k].to_pylist()
    if not held["places"]:
        return
    line, places, key, member, done = _read(held)
    at = _first_places(line, *places)
    some, doc, pos, row = (x[at] for x in places)
    yield _rows(0, line[at], row, pos, pa.array(doc, mask=some == 0))
    key, member, leader = _stars(key, member)
    more = member != leader
    links = [np.concatenate(x) for x in zip((key[more], leader[more], member[more]), done, strict=True)]
    yield _rows(1, *links, pa.nulls(len(links[0]), pa.int64()))


def _rows(kind: int, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(arrays[0]), kind, np.int32)), *arrays], names=["kind", "x", "y", "z", "doc"])


#: Bits of a shingle's hash that are compared; the others number the lines of a batch.
_BITS = 52


def sets_of(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text one after the other, and where each text's start, with the end."""
    hashes, counts, low = [np.zeros(0, np.uint64)], [], 0
    while low < len(texts):
        high, chars = low, 0
        while high < len(texts) and high - low < 1 << (64 - _BITS) and (high == low or chars < _CHARS):
            chars += len(texts[high])
            high += 1
        h, own = shingles(texts[low:high], size)
        x = np.sort((h >> np.uint64(64 - _BITS)) | (own.astype(np.uint64) << np.uint64(_BITS)))
        x = x[starts([x])]
        hashes.append(x & np.uint64((1 << _BITS) - 1))
        counts.append(np.bincount((x >> np.uint64(_BITS)).astype(np.int64), minlength=high - low))
        low = high
    return np.concatenate(hashes), np.concatenate([[0], *counts]).cumsum()


def overlaps(hashes: np.ndarray, at: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many hashes the texts ``a`` and ``b`` have in common, pair by pair."""
    n_a, n_b = at[a + 1] - at[a], at[b + 1] - at[b]
    total, out, low = np.cumsum(n_a + n_b), np.zeros(len(a), np.int64), 0
    while low < len(a):
        high = int(np.searchsorted(total, (total[low - 1] if low else 0) + 2 * _CHARS, "right"))
        high = min(max(high, low + 1), low + (1 << (64 - _BITS)))
        which = np.concatenate([a[low:high], b[low:high]])
        n = np.concatenate([n_a[low:high], n_b[low:high]])
        pair = np.repeat(np.tile(np.arange(high - low, dtype=np.uint64), 2), n)
        x = hashes[np.arange(n.sum()) + np.repeat(at[which] - np.cumsum(n) + n, n)] | (pair << np.uint64(_BITS))
        x.sort()
        same = x[1:][x[1:] == x[:-1]]
        out[low:high] = np.bincount((same >> np.uint64(_BITS)).astype(np.int64), minlength=high - low)
        low = high
    return out


def shared(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many values a sorted array has in common with each of the others."""
    every = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, every), len(one) - 1)
    return np.add.reduceat((one[at] == every).astype(np.int64), np.cumsum([0, *map(len, others[:-1])]))


def common(sets: list[np.ndarray], rows: np.ndarray, often: int = 64, width: int = 1024) -> np.ndarray:
    """How many values each of the sets ``rows`` has in common with each of all sets; a set has distinct values, fewer than 2^24.

    Values in over ``often`` sets are counted by products of 0-1 matrices of ``width`` columns, the others by listing the sets that have them.
    """
    n, every = len(sets), np.concatenate(sets)
    own = np.repeat(np.arange(n, dtype=np.int32), [len(x) for x in sets])
    order = np.argsort(every, kind="stable")
    value = np.empty(len(every), np.int32)
    value[order] = np.cumsum(np.append(False, every[order][1:] != every[order][:-1])[: len(every)])
    del every, order
    met = np.bincount(value)
    own, value = own[met[value] > 1], value[met[value] > 1]
    out = np.zeros((len(rows), n), np.float32)
    # Values of many sets: blocks of columns.
    dense = met > often
    column = (np.cumsum(dense, dtype=np.int32) - 1)[value]
    for low in range(0, int(dense.sum()), width):
        at = np.flatnonzero(dense[value] & (column >= low) & (column < low + width))
        table = np.zeros((n, width), np.float32)
        table[own[at], column[at] - low] = 1
        out += table[rows] @ table.T
    # The others: the sets of each value one after the other, looked up for some rows at a time.
    own, value = own[~dense[value]], value[~dense[value]]
    size = np.bincount(own, minlength=n)
    first, holders, met = np.cumsum(size) - size, own[np.argsort(value, kind="stable")], np.bincount(value)
    begin = np.cumsum(met) - met
    step = max(1, 4 * _CHARS // (often * max(1, int(size.max()))))
    for low in range(0, len(rows), step):
        part = rows[low : low + step]
        ends = np.cumsum(size[part])
        at = value[np.arange(size[part].sum()) + np.repeat(first[part] - ends + size[part], size[part])]
        row, ends = np.repeat(np.repeat(np.arange(len(part)), size[part]), met[at]), np.cumsum(met[at])
        to = holders[np.arange(len(row)) + np.repeat(begin[at] - ends + met[at], met[at])]
        out[low : low + step] += np.bincount(row * n + to, minlength=len(part) * n).reshape(len(part), n)
    out[np.arange(len(rows)), rows] = [len(sets[k]) for k in rows]  # values of one set only count for itself
    return out


def _verify(size: int):
    """Exact similarity of pairs of texts, and the number of distinct shingles of each."""

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            first = starts([pdf["a"].to_numpy()])
            hashes, at = sets_of([*pdf["text_a"].iloc[first], *pdf["text_b"]], size)
            a = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(pdf))))
            b = np.arange(len(pdf)) + len(first)
            n = np.diff(at)
            both = overlaps(hashes, at, a, b)
            yield pd.DataFrame({"a": pdf["a"].to_numpy(), "b": pdf["b"].to_numpy(), "similarity": both / (n[a] + n[b] - both), "n_a": n[a].astype(np.int32), "n_b": n[b].astype(np.int32)})

    return run


def _across(size: int, least: float, first: int = 6, many: int = 50_000):
    """Links between lines of different components in the cells of open keys.

    A line is compared with ``first`` lines of a component before the rest: most join there. In a cell with over
    ``many`` pairs to look at, what its lines have in common is counted for some hundred of them at once.
    """

    def cell(rows: dict[str, np.ndarray], sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        line, root, near, odd = rows["line"], rows["root"], rows["similarity"], rows["root"] != rows["leader_root"]
        n = np.array([len(x) for x in sets])
        same = rows["block_i"][0] == rows["block_j"][0]
        us, vs = [], []
        outer, counts = np.flatnonzero(odd), None
        at_once = len(outer) * len(line) > many and n.max() < 1 << 24

        def compare(k: int, at: np.ndarray) -> np.ndarray:
            both = shared(sets[k], [sets[i] for i in at]) if counts is None else counts[at].astype(np.int64)
            return at[both >= least * (n[k] + n[at] - both)]

        for i, k in enumerate(outer):
            if at_once:
                if i % _ROWS == 0:
                    block = common(sets, outer[i : i + _ROWS])
                counts = block[i % _ROWS]
            fit = ~(np.abs(near - near[k]) > 1 - least + 1e-9) & (np.minimum(n, n[k]) >= (least - 1e-9) * np.maximum(n, n[k]))
            fit &= ~odd | (np.arange(len(line)) > k)
            if not same:
                fit &= rows["side"] != rows["side"][k]
            for tried in (first, len(line)) if counts is None else (len(line),):
                at = np.flatnonzero(fit & (root != root[k]))
                if tried < len(at):
                    order = at[np.argsort(root[at], kind="stable")]
                    runs = starts([root[order]])
                    at = order[np.arange(len(order)) - np.repeat(runs, np.diff(np.append(runs, len(order)))) < tried]
                if not len(at):
                    break
                fit[at] = False
                hit = compare(k, at)
                if len(hit):
                    us.append(np.full(len(hit), line[k]))
                    vs.append(line[hit])
                    root = np.where(np.isin(root, root[hit]), root[k], root)
        return (np.concatenate(us), np.concatenate(vs)) if us else (line[:0], line[:0])

    def run(table: pa.Table):
        names = ("line", "root", "leader_root", "similarity", "side", "block_i", "block_j")
        columns = {c: table[c].to_numpy() for c in names}
        first = starts([table["key"].to_numpy(), columns["block_i"], columns["block_j"]])
        cells = [(a, b) for a, b in zip(first, np.append(first[1:], table.num_rows), strict=True) if (columns["root"][a:b] != columns["root"][a]).any() and (columns["root"][a:b] != columns["leader_root"][a:b]).any()]
        if not cells:
            return
        # Each line's set once, however many cells it is in.
        rows = np.concatenate([np.arange(a, b) for a, b in cells])
        lines, at = np.unique(columns["line"][rows], return_index=True)
        hashes, bounds = sets_of(table["norm"].take(rows[at]).to_pylist(), size)
        u, v = [], []
        for a, b in cells:
            part = {c: x[a:b] for c, x in columns.items()}
            i = np.searchsorted(lines, part["line"])
            found = cell(part, [hashes[bounds[k] : bounds[k + 1]] for k in i])
            u.append(found[0])
            v.append(found[1])
        yield edge_batch(*forest(np.concatenate(u), np.concatenate(v)))

    return run


def _texts(batches):
    """(line, norm) of the wanted lines at given places of documents."""
    for b in batches:
        lines, norms = [], []
        for text, wanted in zip(b["text"].to_pylist(), b["wanted"].to_pylist(), strict=True):
            every = normal_lines(text)
            for place in wanted:
                norm = every[place["pos"]] if place["pos"] < len(every) else ""
                if norm and (line := np.uint64(line_id(norm)).view(np.int64)) == place["line"]:
                    lines.append(line)
                    norms.append(norm)
        yield pa.RecordBatch.from_arrays([pa.array(np.array(lines, np.int64)), pa.array(norms, pa.string())], names=["line", "norm"])


def _rebuild(texts: pd.Series, kept: pd.Series) -> pd.DataFrame:
    """Each text without the lines that are neither blank nor kept."""
    rows = []
    for text, places in zip(texts, kept, strict=True):
        if text is None:
            rows.append((None, 0, 0))
            continue
        lines, stay = text.split("\n"), set() if places is None else set(places.tolist())
        out = [s for p, s in enumerate(lines) if p in stay or not s.strip(_BLANK)]
        rows.append(("\n".join(out), len(lines), len(lines) - len(out)))
    return pd.DataFrame(rows, columns=["text", "n_lines", "n_removed"])


def dedup_lines(docs: DataFrame, least: float = 0.8, size: int = 5, bands: int = 16, rows: int = 6, ranges: int = _RANGES) -> DataFrame:
    """Keep one line of each group of near-duplicate lines of ``docs`` (doc_id, text, ...); doc_id is an integer.

    Lines end at a line feed. They are compared in lower case without white space at the ends;
    two are linked if the Jaccard similarity of their sets of ``size``-character shingles is
    ``least`` or more. Of each connected component the line with the smallest (doc_id, position)
    stays, ties broken by a hash of the row; documents keep their other columns and the order of their lines. Added columns (replaced if there):
    n_lines and n_removed. Blank lines are no duplicates and stay. Null text stays null with no
    lines; empty text stays empty. Every row is a document of its own: rows that repeat a doc_id, or have none (these sort first), lose
    each other's lines, and of rows that are equal in all columns one keeps its lines. An empty table gives no rows.

    A pair is found if one of ``bands`` bands of ``rows`` MinHash values agrees: over 99 % of pairs at
    similarity 0.8, over 99.9 % from 0.85, whatever the lines' lengths. Each key's lines are compared with its smallest line
    (a star; tasks combine equal keys and send on only leaders, to at most ``ranges`` places at a time), so a huge group costs no more than its size. Keys that
    still hold several components have their outer lines compared with some lines of each other
    component, then with all that similarity to the leader and set sizes allow; no pair within the bands is lost.
    Lines are told apart by 64-bit hashes, shingles by 52-bit ones.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    arrow_batches(spark)
    others = [c for c in docs.columns if c.lower() not in ("doc_id", "text", "n_lines", "n_removed")]
    rest = F.struct(*[F.col(f"`{c}`") for c in others] or [F.lit(0)])
    # A row is known by a hash of all of it; rows with the same are equal.
    whole = docs.select(F.col("doc_id").alias("given_id"), F.col("doc_id").cast("long").alias("doc_id"), "text", rest.alias("rest"))
    whole = whole.withColumn("row", F.xxhash64("doc_id", "text", F.to_json("rest")))
    given = whole.select("doc_id", "text", "row")
    counted = scratch.save(given.groupBy("row").agg(F.count(F.lit(1)).alias("copies"), F.sum(F.octet_length("text")).alias("size")))
    repeated = scratch.save(counted.where("copies > 1").select("row", "copies"))
    chars = counted.agg(F.sum("size")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(chars / _PART))
    wide = min(parts, ranges)
    parts = wide * ceil(parts / wide)
    schema = "part int, places binary, own binary, linked binary"
    blobs = given.mapInArrow(_bands(size, bands, rows, wide), schema)
    if parts > wide:
        blobs = blobs.repartitionById(wide, "part").mapInArrow(_regroup(parts), schema)
    found = scratch.save(blobs.repartitionById(parts, "part").mapInArrow(_lead, "kind int, x long, y long, z long, doc long"))
    classes = found.where("kind = 0").select(F.col("x").alias("line"), F.col("doc").alias("doc_id"), F.col("z").cast("int").alias("pos"), F.col("y").alias("row"))
    stars = found.where("kind = 1").select(F.col("x").alias("key"), F.col("y").alias("a"), F.col("z").alias("b"))

    first = scratch.save(stars.select("a", "b").distinct())
    needed = first.select(F.explode(F.array("a", "b")).alias("line")).distinct()
    places = classes.join(needed.hint("shuffle_hash"), "line").groupBy("row").agg(F.collect_list(F.struct("line", "pos")).alias("wanted"))
    holders = given.where("text is not null").join(places.hint("shuffle_hash"), "row").select("text", "wanted")
    # The text of each line that shares a key, from its first place.
    texts = scratch.save(holders.mapInArrow(_texts, "line long, norm string").distinct())

    def verified(pairs: DataFrame) -> DataFrame:
        one = pairs.join(texts.select(F.col("line").alias("b"), F.col("norm").alias("text_b")), "b")
        two = one.join(texts.select(F.col("line").alias("a"), F.col("norm").alias("text_a")), "a")
        return scratch.save(two.select("a", "b", "text_a", "text_b").mapInPandas(_verify(size), "a long, b long, similarity double, n_a int, n_b int"))

    def links(pairs: DataFrame) -> DataFrame:
        return pairs.where(F.col("similarity") >= least).select(F.col("a").alias("u"), F.col("b").alias("v"))

    checked = verified(first)
    roots = scratch.save(connected_components(scratch, links(checked)))
    cells = _open(scratch, stars, checked, roots, least)
    if not cells.isEmpty():
        joined = map_runs(cells.join(texts, "line"), ["key", "block_i", "block_j"], _across(size, least), "u long, v long")
        roots = scratch.save(connected_components(scratch, links(checked).union(joined)))
    rooted = classes.join(roots.withColumnRenamed("id", "line").hint("shuffle_hash"), "line", "left")
    grouped = rooted.where("root is not null").groupBy("root").agg(F.min(F.struct("doc_id", "pos", "row")).alias("first")).select("first.row", "first.pos")
    kept = rooted.where("root is null").select("row", "pos").union(grouped).groupBy("row").agg(F.collect_set("pos").alias("kept"))
    kept = scratch.save(kept)
    scratch.keep(kept, repeated)
    rebuild = F.pandas_udf(_rebuild, "text string, n_lines int, n_removed int")
    columns, spare = ["given_id", "rest"], None
    if not repeated.isEmpty():
        # Of equal rows one is rebuilt with its lines, and the others, whose number is known, without.
        one = whole.join(repeated, "row", "left_semi").groupBy("row").agg(F.first(F.struct("given_id", "text", "rest")).alias("it")).join(repeated, "row")
        last = F.greatest(F.ceil((F.col("copies") - 1) / _CHUNK) - 1, F.lit(0))
        chunks = one.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last))).repartition("row", "chunk")
        low = F.col("chunk") * _CHUNK
        spare = chunks.select("it.*", F.explode(F.sequence(low + 1, F.least(low + _CHUNK, F.col("copies") - 1))))
        spare = spare.select(*columns, rebuild("text", F.array().cast("array<int>")).alias("new"))
        whole = whole.join(repeated, "row", "left_anti").unionByName(one.select("it.given_id", F.col("it.given_id").cast("long").alias("doc_id"), "it.text", "it.rest", "row"))
    out = whole.join(kept.hint("shuffle_hash"), "row", "left").select(*columns, rebuild("text", "kept").alias("new"))
    if spare is not None:
        out = out.unionByName(spare)
    return out.select(F.col("given_id").alias("doc_id"), "new.text", *[F.col(f"rest.`{c}`") for c in others], "new.n_lines", "new.n_removed")


def _open(scratch: Scratch, stars: DataFrame, checked: DataFrame, roots: DataFrame, least: float, block: int = 2048) -> DataFrame:
    """The lines of keys that still hold several components, in cells of blocks, with root and leader's root.

    A key of two lines has one pair, which was compared. Of two lines of different components one is
    outside the leader's. Jaccard distance is a metric, so _across leaves out pairs whose similarities
    to the leader are too far apart; where a line was compared with another leader first, that is null.
    """
    failed = checked.select("a", "b", (F.col("similarity") < least).cast("int").alias("failed"))
    keys = stars.join(failed, ["a", "b"]).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("failed").alias("failed")).where("n > 1 and failed > 0").select("key")
    inside = stars.join(keys, "key", "left_semi").select("key", F.explode(F.array("a", "b")).alias("line")).distinct()
    members = scratch.save(inside.join(roots.withColumnRenamed("id", "line"), "line", "left").select("key", "line", F.coalesce("root", "line").alias("root")))
    # Longs in every buffer, so that the groups are hashed and combined before the shuffle.
    lead = members.groupBy("key").agg(F.min("line").alias("leader"), F.min_by("root", "line").alias("leader_root"), F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    lead = lead.where("n > 2 and low <> high").select("key", "leader", "leader_root", F.ceil((F.col("n") - 1) / block).cast("int").alias("blocks"))
    known = checked.select("a", "b", "similarity").union(checked.select("b", "a", "similarity")).toDF("leader", "line", "similarity").dropDuplicates(["leader", "line"])
    placed = members.join(lead, "key").where("line <> leader").join(known, ["leader", "line"], "left")
    own = F.pmod(F.xxhash64("line"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = placed.select("key", "line", "root", "leader_root", "similarity", "blocks", own.alias("own")).withColumn("other", other)
    cells = cells.select("key", "line", "root", "leader_root", "similarity", F.least("own", "other").alias("block_i"), F.greatest("own", "other").alias("block_j"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    return scratch.save(cells)
