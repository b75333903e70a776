"""Exact token counts of a byte-pair vocabulary, by an automaton and without building the ids.

Every token ending at a byte is found by an Aho-Corasick automaton over the vocabulary. The encoding of a prefix ends in
exactly one of them: the one whose pair with the last token of the shorter prefix would not be merged differently. So a
piece is counted in one pass, with a constant number of pair checks a byte.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from pathlib import Path

import ahocorasick
import regex

#: The public pre-tokenizer pattern of the 50k byte-level vocabularies (a fixed value).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class BpeCounter:
    """Counts of one vocabulary. ``count`` equals the length of the usual merge-by-rank encoding."""

    MEMO = 200_000

    def __init__(self, path: str, pattern: str = PATTERN):
        rows = (line.split() for line in Path(path).read_bytes().splitlines() if line.strip())
        self.rank = {base64.b64decode(a): int(b) for a, b in rows}
        self.split = regex.compile(pattern)
        self.halves: dict[int, tuple[int, int]] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        self.auto = ahocorasick.Automaton()
        for token, r in sorted(self.rank.items(), key=lambda x: x[1]):
            self.auto.add_word(token.decode("latin-1"), (len(token), r))
            if len(token) > 1:
                a, b = self._last_merge(token, r)
                self.halves[r] = (a, b)
                if a != r:
                    self.pairs[a, b] = r
            else:
                self.halves[r] = (r, r)
        self.auto.make_automaton()
        self.memo: dict[str, int] = {}
        self.fits: dict[tuple[int, int], bool] = {}

    def _last_merge(self, token: bytes, limit: int) -> tuple[int, int]:
        """The two parts that the merge rules join last to make ``token``; the token itself if they never make it."""
        parts = [bytes([b]) for b in token]
        while len(parts) > 2:
            best, at = limit, -1
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1], limit)
                if r < best:
                    best, at = r, i
            if at < 0:
                return limit, limit
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.rank[parts[0]], self.rank[parts[1]]

    def _fits(self, left: int, right: int) -> bool:
        """Whether ``left`` followed by ``right`` stays these two tokens when their bytes are encoded together."""
        known = self.fits.get((left, right))
        if known is not None:
            return known
        a, b, limit, ok = left, right, 1 << 62, True
        while True:
            joined = self.pairs.get((a, b))
            if joined is not None and joined < limit:
                ok = False
                break
            if a > b:
                limit, (lo, hi) = a, self.halves[a]
                if lo == a:
                    limit, (lo, hi) = b + 1, self.halves[b]
                    if lo == b:
                        break
                    b = lo
                else:
                    a = hi
            else:
                limit, (lo, hi) = b + 1, self.halves[b]
                if lo == b:
                    limit, (lo, hi) = a, self.halves[a]
                    if lo == a:
                        break
                    a = hi
                else:
                    b = lo
        if len(self.fits) > 2_000_000:
            self.fits.clear()
        self.fits[left, right] = ok
        return ok

    def piece(self, piece: str) -> int:
        """The number of tokens of one pre-token."""
        n = self.memo.get(piece)
        if n is None:
            if len(self.memo) >= self.MEMO:
                self.memo.clear()
            n = self.memo[piece] = self._scan(piece.encode("utf-8", "replace"))
        return n

    def _scan(self, data: bytes) -> int:
        if data in self.rank:
            return 1
        size = len(data)
        ends: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for at, hit in self.auto.iter(data.decode("latin-1")):
            ends[at].append(hit)
        last, count = [-1] * (size + 1), [0] * (size + 1)
        for i in range(size):
            for length, r in sorted(ends[i], reverse=True):
                start = i + 1 - length
                if start == 0 or (last[start] >= 0 and self._fits(last[start], r)):
                    last[i + 1], count[i + 1] = r, count[start] + 1
                    break
        return count[size]

    def count(self, text: str | None) -> int:
        """The number of tokens of ``text``; null and empty texts have none."""
        if not text:
            return 0
        memo, total = self.memo, 0
        for p in self.split.findall(text):
            n = memo.get(p)
            total += self.piece(p) if n is None else n
        return total


@lru_cache(maxsize=2)
def counter(path: str) -> BpeCounter:
    """One counter per vocabulary file and worker process."""
    return BpeCounter(path)
