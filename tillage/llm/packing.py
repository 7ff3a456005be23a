"""Best-two-fit packing of tokenized documents into sequences."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tillage.llm.common import Scratch, arrow_batches

#: Words kept in a task's memory with their ids, about 200 bytes each.
_WORDS = 300_000
#: New words that are encoded as one text.
_TOGETHER = 200
#: Characters whose lower case, composition and class are the same in Python and in the tokenizer;
#: a text with others, or with the start of a special token, goes through the tokenizer whole.
_PLAIN = re.compile("[\\t-\\r -~ -ÿŒœ]*")
_LETTER = "a-zªµºß-öø-ÿœ"
_NUMBER = "0-9²³¹¼-¾"
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\\s{_LETTER}{_NUMBER}]+")
_encoders: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Ids of whole texts under a tokenizer that encodes each word on its own.

    Words recur, so each one's ids are made once by the tokenizer and looked up afterwards. New words
    go through it some hundred at a time, with spaces between them; the ids that end a word tell where
    each one's stop. The results are those of ``Tokenizer.encode(text, add_special_tokens=False)``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.words = Tokenizer.from_file(path), {}
        suffix, vocabulary = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        split: list[list[str] | None] = [_SPLIT.findall(t.lower()) if "<|" not in t and _PLAIN.fullmatch(t) else None for t in texts]
        if len(self.words) > _WORDS:
            self.words.clear()
        words = self.words
        new = [w for w in set().union(*filter(None, split)) if w not in words]
        for i in range(0, len(new), 20 * _TOGETHER):
            parts = [new[j : j + _TOGETHER] for j in range(i, min(i + 20 * _TOGETHER, len(new)), _TOGETHER)]
            for part, e in zip(parts, self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False), strict=True):
                words.update(zip(part, self._cut(part, np.array(e.ids, "<u4")), strict=True))
        return [_pack(self.tokenizer.encode(t, add_special_tokens=False).ids) if s is None else b"".join([words[w] for w in s]) for t, s in zip(texts, split, strict=True)]

    def _cut(self, part: list[str], ids: np.ndarray) -> list[bytes]:
        """The ids of each of some words that were encoded together."""
        ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
        if len(ends) != len(part) or ends[-1] != 4 * len(ids):  # a tokenizer that doesn't end each word so
            return [_pack(e.ids) for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        every = ids.tobytes()
        return [every[a:b] for a, b in zip([0, *ends], ends)]


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _pieces(path: str, end: int, size: int):
    last = struct.pack("<I", end)

    def run(batches):
        met: Counter[int] = Counter()
        task = TaskContext.get().partitionId()
        for pdf in batches:
            rows = []
            for doc, ids in zip(pdf["doc_id"], encoder(path).encode([t or "" for t in pdf["text"]]), strict=True):
                ids += last
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    n = len(part) // 4
                    rows.append((doc, k, at // 4, n, zlib.crc32(part), task, met[n]))
                    met[n] += 1
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return run


def best_two_fit(counts: np.ndarray, size: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Pack ``counts[n]`` pieces of each length n into bins of ``size``; [(((length, how many), ...), bins)].

    A bin starts with the longest piece left and takes the longest one that fits, again and again.
    Then its smallest piece goes back if two others fill its place and the gap more tightly, and
    again until none do. A bin's content depends on the lengths alone, so a filling is repeated
    as often as the pieces allow: the work and the result grow with ``size``, not with the corpus.
    """
    left = counts.astype(np.int64).copy()
    fills: list[tuple[tuple[tuple[int, int], ...], int]] = []

    def below() -> np.ndarray:
        """The longest length left that is at most i; 0 if none."""
        return np.maximum.accumulate(np.where(left > 0, np.arange(size + 1), 0))

    longest = below()
    while longest[size]:
        first = int(longest[size])
        used = Counter({first: 1})
        left[first] -= 1
        gap = size - first
        fit = below()
        while gap and (n := int(fit[gap])):
            many = min(int(left[n]), gap // n)
            used[n] += many
            left[n] -= many
            gap -= many * n
            if not left[n]:
                fit = below()
        while gap and used.total() > 1:
            small = min(used)
            room = gap + small
            a = np.arange(1, room)
            b = fit[room - a]
            ok = (left[a] > 0) & (b > 0) & ((a != b) | (left[a] > 1)) & (a + b > small)
            if not ok.any():
                break
            k = int(np.argmax(np.where(ok, a + b, 0)))
            for n, d in ((int(a[k]), -1), (int(b[k]), -1), (small, 1)):
                left[n] += d
                used[n] -= d
            used = +used
            gap = room - int(a[k]) - int(b[k])
            fit = below()
        more = min(int(left[n]) // c for n, c in used.items())
        for n, c in used.items():
            left[n] -= more * c
        fills.append((tuple(sorted(used.items(), reverse=True)), more + 1))
        longest = below()
    return fills


def places(fills: list, size: int) -> pd.DataFrame:
    """Where the pieces of each length go, as ranges of their running number within the length.

    Columns: length, low (first running number), bin (first bin), each (pieces of the length in a
    bin), offset (of the first of them in the bin). At most a few ranges for each filling.
    """
    seen, rows, start = np.zeros(size + 1, np.int64), [], 0
    for used, many in fills:
        at = 0
        for n, c in used:
            rows.append((n, int(seen[n]), start, c, at))
            seen[n] += many * c
            at += n * c
        start += many
    return pd.DataFrame(rows, columns=["length", "low", "bin", "each", "offset"]).sort_values(["length", "low"])


def _place(shared, size: int):
    def run(batches):
        table = shared.value
        key = table["length"].to_numpy() * (1 << 48) + table["low"].to_numpy()
        for pdf in batches:
            n, nth = pdf["length"].to_numpy(), (pdf["base"] + pdf["nth"]).to_numpy()
            row = table.iloc[np.searchsorted(key, n * (1 << 48) + nth, side="right") - 1]
            k = nth - row["low"].to_numpy()
            each = row["each"].to_numpy()
            pdf["sequence_id"] = row["bin"].to_numpy() + k // each
            pdf["offset"] = row["offset"].to_numpy() + k % each * n
            yield pdf[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = 4096, end: int = 1) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``size`` tokens.

    A document is its text's ids, then ``end``; null counts as empty, so the shortest document
    is one token. Documents of over ``size`` tokens are cut into pieces of ``size``, the last one
    maybe shorter. One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. Repeated rows and rows without a doc_id are packed as documents of their own; an
    empty table gives no rows; extra columns are ignored.

    The packing is global and exact: what it needs of the corpus is how many pieces have each of
    ``size`` lengths, however many documents there are. Pieces are numbered within their length by
    (task, running number), both written with them, so no length is gathered or sorted.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    arrow_batches(spark)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
    made = scratch.save(docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(_pieces(tokenizer_path, end, size), schema))
    each = scratch.save(made.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")))
    counts = np.zeros(size + 1, np.int64)
    for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    table = places(best_two_fit(counts, size), size)
    base = scratch.save(_running(each))
    scratch.keep(made, base)
    # One row for each length and task: it grows with the corpus, so it isn't broadcast.
    numbered = made.join(base.hint("shuffle_hash"), ["length", "task"])
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return numbered.mapInPandas(_place(spark.sparkContext.broadcast(table), size), schema)


def _running(each: DataFrame) -> DataFrame:
    """(length, task, base): pieces of the length in earlier tasks. One row per length and task goes in."""
    step = 1 << 10
    near = each.withColumn("group", (F.col("task") / step).cast("int"))
    sums = near.groupBy("length", "group").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("length", "group").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    outer = sums.select("length", "group", before.alias("outer"))
    return near.select("length", "group", "task", inside.alias("inner")).join(outer, ["length", "group"]).select("length", "task", (F.col("outer") + F.col("inner")).alias("base"))
