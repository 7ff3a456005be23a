"""SentencePiece encoding and decoding with N-best segmentations of the piece lattice."""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tillage.llm.common import arrow_batches

SPACE = "▁"
#: Units (words) kept in a task's memory, and the longest unit that is kept.
_UNITS, _LONGEST = 600_000, 40
#: Characters whose units are learnt together.
_CHARS = 2_000_000
_models: dict[str, "Pieces"] = {}
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _hash(text: str) -> int:
    h = 0
    for c in text:
        h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return h


class Pieces:
    """The vocabulary of a SentencePiece model and its lattice.

    The score of a segmentation is the sum of its pieces' scores. A character that is no piece is
    spelt by its UTF-8 bytes, at ten below the worst score. A text is cut into units where no piece
    reaches over, from one run of spaces or line feed to the next: its segmentations are those of its units.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(size)]
        self.byte = {int(self.text[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        # What each id stands for, as UTF-8: one array of bytes, and where an id's begin in it.
        spelt = {i: bytes([b]) for b, i in self.byte.items()}
        parts = [spelt.get(i, t.encode()) for i, t in enumerate(self.text)]
        self.data, self.sizes = np.frombuffer(b"".join(parts), np.uint8), np.array([len(x) for x in parts])
        self.begins = np.cumsum(self.sizes) - self.sizes
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.pieces = {self.text[i]: (i, model.get_score(i)) for i in plain if self.text[i] != "\n" and model.get_score(i) > -1e8}
        self.worst = min((s for _, s in self.pieces.values()), default=0.0) - 10
        self.longest = max(map(len, self.pieces), default=1)
        apart = all(SPACE not in p[1:] or not p.strip(SPACE) for p in self.pieces)
        line = not any("\n" in p for p in self.pieces)
        self.unit = re.compile(f"{SPACE}*\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+" if line else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+") if apart else re.compile(".+", re.S)
        every = sorted((_hash(t), i, score) for t, (i, score) in self.pieces.items())
        self.keys = np.array([h for h, _, _ in every], np.uint64)
        self.key_ids = np.array([i for _, i, _ in every], np.int32)
        self.key_scores = np.array([x for _, _, x in every])
        self._index()
        self.forget()

    def lattice(self, unit: str) -> tuple[list[float], list[list[tuple[int, float, bytes]]]]:
        """Best score up to each position (forward Viterbi), and the arcs that end there: (start, score, ids)."""
        n, pieces, longest = len(unit), self.pieces, self.longest
        best, arcs = [0.0] * (n + 1), [[] for _ in range(n + 1)]
        for end in range(1, n + 1):
            here, top = arcs[end], -1e300
            for start in range(max(0, end - longest), end):
                found = pieces.get(unit[start:end])
                if found:
                    here.append((start, found[1], found[0]))
                    if best[start] + found[1] > top:
                        top = best[start] + found[1]
            if not here or here[-1][0] != end - 1:
                here.append((end - 1, self.worst, unit[end - 1]))
                if best[end - 1] + self.worst > top:
                    top = best[end - 1] + self.worst
            best[end] = top
        return best, arcs

    def ids(self, token) -> list[int]:
        """Ids of an arc: a piece's id, or the bytes of a character."""
        if isinstance(token, int):
            return [token]
        return [self.byte[b] for b in token.encode("utf-8", "replace")]

    def nbest(self, unit: str, n: int) -> list[tuple[float, bytes]]:
        """The n segmentations with the highest scores: A* from the end, guided by the forward scores.

        The forward Viterbi score of a position is exactly the best that can still be reached, so
        hypotheses leave the queue in the order of their final scores. Of equal ones the one nearest
        to the start goes first, so many equal segmentations of a long unit aren't all begun.
        """
        best, arcs = self.lattice(unit)
        queue, count, out = [(-best[-1], len(unit), 0, 0.0, None)], 0, []
        while queue and len(out) < n:
            _, at, _, done, path = heapq.heappop(queue)
            if not at:
                ids = []
                while path:
                    ids += self.ids(path[0])
                    path = path[1]
                out.append((done, struct.pack(f"<{len(ids)}I", *ids)))
                continue
            for start, score, token in arcs[at]:
                count += 1
                heapq.heappush(queue, (-(best[start] + done + score), start, count, done + score, (token, path)))
        return out

    def first(self, unit: str) -> tuple[float, bytes, float]:
        """(score, ids, how much lower the second best scores) of a unit."""
        best = self.nbest(unit, 2)
        return best[0][0], best[0][1], best[0][0] - best[1][0] if len(best) > 1 else 1e300

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Where in ``keys`` each hash would be; what stands there must be compared with it."""
        one = self.slots[0][h >> self.shift]
        miss = np.flatnonzero(self.keys[one] != h)
        one[miss] = self.slots[1][(h[miss] * _BASE) >> self.shift]
        return one

    def _index(self) -> None:
        """Two tables of slots for the keys: the second takes those whose slot in the first is taken."""
        for bits in range(20, 40):
            self.shift = np.uint64(64 - bits)
            self.slots = np.zeros((2, 1 << bits), np.int32)
            at = np.arange(len(self.keys), dtype=np.int32)
            for table, slot in zip(self.slots, (self.keys >> self.shift, (self.keys * _BASE) >> self.shift), strict=True):
                table[slot[at]] = at
                at = at[table[slot[at]] != at]
            if not len(at):
                return
        raise ValueError("the vocabulary has pieces with equal hashes")

    def learn(self, units: list[str]) -> None:
        """Number new units and keep their best segmentations: forward Viterbi over all units of a length at once.

        With each position's best score goes its second best, so the loss of a unit's second
        segmentation comes with the first. Substrings are looked up by 64-bit hashes. Ties go
        to the shorter last piece.
        """
        by_length: dict[int, list[str]] = {}
        for u in units:
            by_length.setdefault(len(u), []).append(u)
        for n, every in by_length.items():
            for at in range(0, len(every), 20_000):
                self._learn(every[at : at + 20_000], n)

    def _learn(self, part: list[str], n: int) -> None:
        codes = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n).T.astype(np.uint64)
        m, low = len(part), -1e290
        best, second = np.full((n + 1, m), low), np.full((n + 1, m), low)
        best[0] = 0
        came, token = np.zeros((n + 1, m), np.int8), np.full((n + 1, m), -1, np.int32)
        hashes: list[np.ndarray] = []
        for end in range(1, n + 1):
            c = codes[end - 1] + np.uint64(1)
            hashes = [h * _BASE + c for h in [*hashes, np.zeros(m, np.uint64)]]
            top, next_ = best[end], second[end]
            for start in range(end - 1, max(0, end - self.longest) - 1, -1):
                k = self.lookup(hashes[start])
                known = self.keys[k] == hashes[start]
                if start == end - 1:
                    score = np.where(known, self.key_scores[k], self.worst)
                    top[:], next_[:] = best[start] + score, second[start] + score
                    came[end], token[end] = start, np.where(known, self.key_ids[k], -1)
                    continue
                at = np.flatnonzero(known)
                if not len(at):
                    continue
                k = k[at]
                one, two = best[start][at] + self.key_scores[k], second[start][at] + self.key_scores[k]
                old = top[at]
                next_[at] = np.maximum(np.where(one > old, old, np.maximum(one, next_[at])), two)
                won = one > old
                at, k = at[won], k[won]
                top[at], came[end][at], token[end][at] = one[won], start, self.key_ids[k]
        # Back along the best pieces, all units a step at a time.
        at, steps, rows = np.full(m, n), [], np.arange(m)
        while at.any():
            steps.append(np.where(at > 0, token[at, rows], -2))
            at = came[at, rows].astype(np.int64)
        path = np.array(steps[::-1]).T
        some = path > -2
        ends = 4 * np.cumsum(some.sum(1))
        flat, spelt = path[some].astype("<u4").tobytes(), (path == -1).any(1)
        first = len(self.blobs)
        begin = 0
        for i, (u, end) in enumerate(zip(part, ends.tolist(), strict=True)):
            self.units[u] = first + i
            self.blobs.append(self.first(u)[1] if spelt[i] else flat[begin:end])
            begin = end
        self.scores.append(best[n])
        self.losses.append(np.where(second[n] > low / 2, best[n] - second[n], 1e300))

    def keep(self, unit: str) -> int:
        """The number of a unit too long to be learnt with others."""
        score, ids, loss = self.first(unit)
        self.units[unit] = len(self.blobs)
        self.blobs.append(ids)
        self.scores.append(np.array([score]))
        self.losses.append(np.array([loss]))
        return self.units[unit]

    def forget(self) -> None:
        self.units: dict[str, int] = {}
        self.blobs: list[bytes] = []
        self.scores: list[np.ndarray] = []
        self.losses: list[np.ndarray] = []

    def split(self, text: str) -> list[str]:
        return self.unit.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode_all(self, texts: list[str], n: int) -> Iterator[list[tuple[float, bytes]]]:
        """The n best segmentations of each text; the units of some million characters are learnt together."""
        low = 0
        while low < len(texts):
            high, chars = low, 0
            while high < len(texts) and (high == low or chars < _CHARS):
                chars += len(texts[high])
                high += 1
            split = [self.split(t) for t in texts[low:high]]
            if len(self.units) > _UNITS:
                self.forget()
            new = [u for u in set(chain.from_iterable(split)) if u not in self.units]
            self.learn([u for u in new if len(u) <= _LONGEST])
            long = [u for u in new if len(u) > _LONGEST]
            for u in long:
                self.keep(u)
            for made in (self.scores, self.losses):
                made[:] = [np.concatenate(made)] if made else []
            for units in split:
                yield self.encode(units, n)
            if sum(map(len, long)) > _CHARS:
                self.forget()
            low = high

    def encode(self, units: list[str], n: int) -> list[tuple[float, bytes]]:
        """The n best segmentations of a whole text, given as its learnt units: (score, ids), best first; no unit: one, without ids."""
        if not units:
            return [(0.0, b"")]
        numbers = np.fromiter(map(self.units.__getitem__, units), np.int64, len(units))
        ids = list(map(self.blobs.__getitem__, numbers.tolist()))
        score = float(self.scores[0][numbers].sum())
        if n == 1:
            return [(score, b"".join(ids))]
        # A place outside the n - 1 smallest losses changes in none of the n best.
        loss = self.losses[0][numbers]
        near = np.sort(np.argsort(loss, kind="stable")[: n - 1])
        ways: list[tuple[float, tuple[tuple[int, bytes], ...]]] = [(0.0, ())]
        for k in near:
            if loss[k] > 1e299:
                continue
            options = self.nbest(units[k], n)
            ids[k] = options[0][1]
            ways = sorted(((d + options[0][0] - s, (*w, (k, i)) if j else w) for d, w in ways for j, (s, i) in enumerate(options)), key=lambda x: x[0])[:n]
        out = []
        for d, changes in ways:
            own = list(ids)
            for k, i in changes:
                own[k] = i
            out.append((score - d, b"".join(own)))
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        numbers = np.frombuffer(ids, "<u4")
        n = self.sizes[numbers]
        at = np.repeat(self.begins[numbers] - np.cumsum(n) + n, n)
        at += np.arange(len(at))
        text = self.data[at].tobytes().decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


def model(path: str) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def encode_nbest(docs: DataFrame, path: str, n: int = 3) -> DataFrame:
    """The n best segmentations of each text of ``docs`` (doc_id, text): doc_id, rank, score, ids.

    rank counts from 1, highest score first; a text with fewer segmentations has fewer rows; null
    and empty texts have one, with score 0 and no ids. Repeated rows are encoded each, extra columns
    are ignored, an empty table gives no rows. The text is taken as it is, with spaces as the
    model's space marks and one in front; the model's own normalisation is not applied. Which of two
    segmentations with equal scores comes first isn't fixed: words of up to 40 characters and longer ones are
    searched by different passes.
    """
    arrow_batches(docs.sparkSession)

    def run(batches):
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            rows = [(doc, r, s, np.frombuffer(i, "<u4").astype(np.int32)) for doc, ways in zip(pdf["doc_id"], model(path).encode_all(texts, n), strict=True) for r, (s, i) in enumerate(ways, 1)]
            out = pd.DataFrame(rows, columns=["doc_id", "rank", "score", "ids"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, "doc_id long, rank int, score double, ids array<int>")


def nbest_digest(docs: DataFrame, path: str, n: int = 3) -> DataFrame:
    """As encode_nbest, with the ids' number and CRC-32 in their place, and whether they decode to the text.

    Columns: doc_id, rank, score, n_ids, ids_crc32 (of little-endian unsigned 32-bit ids), exact.
    """
    arrow_batches(docs.sparkSession)

    def run(batches):
        for pdf in batches:
            rows, pieces, texts = [], model(path), [t or "" for t in pdf["text"]]
            for doc, t, ways in zip(pdf["doc_id"], texts, pieces.encode_all(texts, n), strict=True):
                for r, (s, i) in enumerate(ways, 1):
                    rows.append((doc, r, s, len(i) // 4, zlib.crc32(i), pieces.decode(i) == t))
            out = pd.DataFrame(rows, columns=["doc_id", "rank", "score", "n_ids", "ids_crc32", "exact"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, "doc_id long, rank int, score double, n_ids long, ids_crc32 long, exact boolean")
