"""Token counts of sections by offset-mapped attribution."""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tillage.llm.common import arrow_batches

#: Ways to allocate a token that lies in several sections.
RULES = ("most", "first", "last")
_encodings: dict[tuple[str, str], tuple] = {}


def encoding(path: str, pattern: str) -> tuple:
    """(tiktoken encoding, bytes of each id) of a ranks file."""
    if (path, pattern) not in _encodings:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            length[rank] = len(token)
        _encodings[path, pattern] = (tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), length)
    return _encodings[path, pattern]


def attribute(ends: np.ndarray, sections: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section.

    ends: where each token ends, rising; tokens lie one after the other from 0. sections: (start,
    end) rows, rising and not overlapping; an empty section gets none. Tokens outside all sections
    count nowhere. Of the sections that a token overlaps, `first` and `last` take the first and the
    last, `most` the one that holds most of it, ties to the first.
    """
    out = np.zeros(len(sections), np.int64)
    if not len(ends) or not len(sections):
        return out
    begins = np.concatenate([[0], ends[:-1]])
    real = np.flatnonzero(sections[:, 1] > sections[:, 0])
    low, high = sections[real, 0], sections[real, 1]
    if not len(real):
        return out
    first = np.searchsorted(high, begins, side="right")
    last = np.searchsorted(low, ends, side="left") - 1
    inside = (first <= last) & (ends > begins)
    chosen = np.where(inside, last if rule == "last" else first, 0)
    if rule == "most":
        for i in np.flatnonzero(inside & (first < last)):
            k = np.arange(first[i], last[i] + 1)
            chosen[i] = k[np.argmax(np.minimum(high[k], ends[i]) - np.maximum(low[k], begins[i]))]
    out[real] = np.bincount(chosen[inside], minlength=len(real))
    return out


def line_sections(data: bytes) -> np.ndarray:
    """Byte ranges of the lines, each with its line feed; they tile the text. An empty text is one empty section."""
    cut = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    cut = cut if len(cut) and cut[-1] == len(data) and len(data) else np.append(cut, len(data))
    return np.stack([np.concatenate([[0], cut[:-1]]), cut], 1).astype(np.int64)


def _bytes_at(data: bytes, points: np.ndarray) -> np.ndarray:
    """Byte offsets of character offsets."""
    lead = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return np.append(lead, len(data))[np.clip(points, 0, len(lead))]


def _count(path: str, pattern: str, rule: str, given: bool):
    def run(batches):
        enc, size = encoding(path, pattern)
        for pdf in batches:
            docs, sections, chars, tokens, all_tokens = [], [], [], [], []
            for row in range(len(pdf)):
                text = pdf["text"].iat[row] or ""
                data = text.encode("utf-8", "replace")
                ids = np.array(enc.encode_ordinary(text), np.int64)
                ends = np.cumsum(size[ids])
                if given:
                    spans = pdf["sections"].iat[row]
                    points = np.array([(s["start"], s["end"]) for s in (spans if spans is not None else [])], np.int64).reshape(-1, 2)
                    where, n = _bytes_at(data, points), points[:, 1] - points[:, 0]
                else:
                    where = line_sections(data)
                    lead = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
                    n = lead[where[:, 1]] - lead[where[:, 0]]
                docs += [pdf["doc_id"].iat[row]] * len(where)
                sections.append(np.arange(len(where)))
                chars.append(n)
                tokens.append(attribute(ends, where, rule))
                all_tokens.append(np.full(len(where), len(ids)))
            if docs:
                yield pd.DataFrame({"doc_id": pd.array(docs, "Int64"), "section": np.concatenate(sections), "n_chars": np.concatenate(chars), "n_tokens": np.concatenate(tokens), "doc_tokens": np.concatenate(all_tokens)})

    return run


def section_tokens(docs: DataFrame, ranks_path: str, pattern: str, rule: str = "most", sections: str | None = None) -> DataFrame:
    """Tokens of each section of ``docs`` (doc_id, text): doc_id, section, n_chars, n_tokens, doc_tokens.

    Each whole text is encoded once, byte by byte lossless, so tokens tile it; they are joined to
    the sections by position. ``sections`` names an array<struct<start, end>> column of character
    ranges, rising and not overlapping; without it the sections are the lines, each with its line
    feed, and n_tokens of a document's sections add up to doc_tokens. A token that crosses a
    boundary goes to one section by ``rule``: `most` (the largest part, ties to the first), `first` or
    `last`. Null and empty texts have one empty section of 0 tokens; a null sections value has no
    section. Repeated rows are counted each; extra columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    arrow_batches(docs.sparkSession)
    columns = [F.col("doc_id").cast("long"), "text"]
    if sections:
        columns.append(F.transform(sections, lambda s: F.struct(s["start"].cast("long").alias("start"), s["end"].cast("long").alias("end"))).alias("sections"))
    schema = "doc_id long, section int, n_chars long, n_tokens long, doc_tokens long"
    return docs.select(*columns).mapInPandas(_count(ranks_path, pattern, rule, bool(sections)), schema)
