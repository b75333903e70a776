"""Words and their hashes: maximal runs of Unicode letters and digits, in lower case."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\W_]+")
_MASK = 0xFFFFFFFFFFFFFFFF


def words(text: str | None) -> list[str]:
    """The words of ``text``; a null text has none."""
    return WORD.findall(text.lower()) if text else []


class WordHashes(dict):
    """A 64-bit hash per word, remembered up to a bound."""

    BOUND = 400_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over whole arrays."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def hashed_words(texts: list[str | None], memo: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """All word hashes of the texts, one after the other, and where each text begins (one entry more than texts)."""
    flat: list[int] = []
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    for i, text in enumerate(texts):
        if text:
            flat.extend([memo[w] for w in WORD.findall(text.lower())])
        starts[i + 1] = len(flat)
    return np.array(flat, dtype=np.uint64), starts


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` words in a row, by the position of the first; the caller drops windows over a text's end."""
    if len(h) < width:
        return np.zeros(0, dtype=np.uint64)
    n = len(h) - width + 1
    acc = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
        acc = acc ^ (acc >> np.uint64(29))
    return mix(acc)


def windows(h: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number and position in the text of every window of ``width`` words that lies within one text."""
    r = rolling(h, width)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    pos = np.arange(len(h)) - starts[owner]
    n = len(r)
    inside = owner[:n] == owner[width - 1 : width - 1 + n]
    return r[inside], owner[:n][inside], pos[:n][inside]
