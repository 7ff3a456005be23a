"""Hashed character n-grams of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

#: Characters worked on at once; a longer text is a chunk of its own.
CHUNK = 200_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


@cache
def _letters() -> np.ndarray:
    """True at the code points that are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@cache
def _spaces() -> np.ndarray:
    return np.fromiter((chr(i).isspace() for i in range(0x110000)), bool, 0x110000)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def chunks(texts) -> Iterator[tuple[int, list[str]]]:
    """(index of the first text, texts) of about CHUNK characters; null counts as empty."""
    held, n, first = [], 0, 0
    for i, t in enumerate(texts):
        held.append(t or "")
        n += len(held[-1])
        if n >= CHUNK:
            yield first, held
            held, n, first = [], 0, i + 1
    if held:
        yield first, held


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased texts' code points, each text followed by a 0, and the index of each one's text."""
    low = [t.lower() for t in texts]
    points = np.frombuffer("\0".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.repeat(np.arange(len(low)), [len(t) + 1 for t in low])


def word_ngrams(texts: list[str], orders: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text index) of every n-gram of letters inside a word, word ends included, and letters per text."""
    points, owner = code_points(texts)
    letter = _letters()[points]
    letters = np.bincount(owner[letter], minlength=len(texts))
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:1] = True
    c, o, inner = np.where(letter, points, 0)[keep].astype(np.uint64), owner[keep], letter[keep]
    c, o, inner = np.concatenate([np.zeros(1, np.uint64), c]), np.concatenate([o[:1], o]), np.concatenate([[False], inner])
    hashes, owners = [], []
    for n in orders:
        m = len(c) - n + 1
        if m <= 0:
            continue
        ok = np.ones(m, bool)
        h = np.full(m, n, np.uint64)
        for j in range(n):
            h += c[j : j + m] * _ODD[j]
            if 0 < j < n - 1:
                ok &= inner[j : j + m]
        ok &= inner[:m] | inner[n - 1 :]
        hashes.append(mix(h[ok]))
        owners.append(o[n - 1 :][ok])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), letters
    return np.concatenate(hashes), np.concatenate(owners), letters


def text_ngrams(texts: list[str], orders: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every character n-gram of each text, runs of white space as one space, with one before and after it.

    An n-gram's characters are all of one text, but for a first space: that before a text ends the one in front.
    """
    points, owner = code_points(texts)
    space = _spaces()[points] | (points == 0)
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    c, o = np.where(space, 32, points)[keep].astype(np.uint64), owner[keep]
    c, o = np.concatenate([np.full(1, 32, np.uint64), c]), np.concatenate([o[:1], o])
    hashes, owners = [], []
    for n in orders:
        m = len(c) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint64)
        for j in range(n):
            h += c[j : j + m] * _ODD[j]
        one = (o[:m] == o[n - 1 :]) | ((c[:m] == 32) & (o[1 : m + 1] == o[n - 1 :]))
        hashes.append(mix(h[one]))
        owners.append(o[n - 1 :][one])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)
