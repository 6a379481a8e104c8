"""An FM-index over word ids, in both directions, with all intervals of one depth extended at once.

Symbols are integers from 0; 0 stands for a border that no phrase crosses. Suffixes are ordered by their first ``depth`` symbols,
which is enough for the intervals of all phrases of up to ``depth`` symbols. An interval of a phrase is the run of suffixes
that start with it; the symbol before each of these suffixes (the transform) tells which phrases extend it to the left
and how often. The index of the reversed sequence does the same to the right.
"""

from __future__ import annotations

import numpy as np


def transform(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The symbol before each suffix, suffixes in the order of their first ``depth`` symbols; the sequence is circular."""
    n = len(symbols)
    rank, known = symbols.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while known < depth:
        step = min(known, depth - known)
        key = rank * (int(rank.max(initial=0)) + 1) + np.roll(rank, -step) if n else rank
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1]))
        known += step
    return symbols[order - 1].astype(np.int32) if n else symbols.astype(np.int32)


class Transform:
    """Counts over one transform: where the suffixes of a symbol begin, and occurrences of a symbol before a row."""

    def __init__(self, before: np.ndarray, sigma: int):
        self.before = before
        self.first = np.concatenate([[0], np.cumsum(np.bincount(before, minlength=sigma))])
        # rows by symbol: the rows of symbol c are places[first[c]:first[c + 1]], in order
        self.places = np.argsort(before, kind="stable")
        self._keys = before[self.places].astype(np.int64) * (len(before) + 1) + self.places

    def occurrences(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the rows before ``row``."""
        return np.searchsorted(self._keys, symbol * (len(self.before) + 1) + row) - self.first[symbol]

    def extended(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Every extension of every interval by one symbol but 0: interval number, symbol, occurrences, and how many rows of the
        interval have a smaller symbol."""
        number = np.repeat(np.arange(len(low)), size)
        row = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        key = np.sort(number * np.int64(len(self.first)) + self.before[row])
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
        count = np.diff(np.append(start, len(key)))
        number, symbol = np.divmod(key[start], len(self.first))
        smaller = start - (np.cumsum(size) - size)[number]
        inner = symbol > 0
        return number[inner], symbol[inner], count[inner], smaller[inner]


class BidirectionalIndex:
    """Intervals of phrases in a sequence and in its reverse."""

    def __init__(self, forward: np.ndarray, reverse: np.ndarray):
        sigma = int(forward.max(initial=0)) + 1
        self.forward, self.reverse = Transform(forward, sigma), Transform(reverse, sigma)

    @classmethod
    def of(cls, symbols: np.ndarray, depth: int) -> BidirectionalIndex:
        return cls(transform(symbols, depth), transform(symbols[::-1], depth))

    def symbols(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(low, low in the reverse, size) of single symbols; both transforms hold the same symbols."""
        low = self.forward.first[wanted]
        return low, low, self.forward.first[wanted + 1] - low

    def extend(self, low: np.ndarray, low_reverse: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Phrases one symbol longer whose first and last part are both among the given ones.

        Returns number of the first part, number of the last part, low, low in the reverse, size. A phrase is met twice, as an extension
        of its last part to the left and of its first part to the right; both name the same interval of the forward index.
        """
        last, symbol, count, _ = self.forward.extended(low, size)
        left = self.forward.first[symbol] + self.forward.occurrences(symbol, low[last])
        first, following, _, smaller = self.reverse.extended(low_reverse, size)
        right = low[first] + smaller
        _, i, j = np.intersect1d(left, right, assume_unique=True, return_indices=True)
        first, following = first[j], following[j]
        back = self.reverse.first[following] + self.reverse.occurrences(following, low_reverse[first])
        return first, last[i], left[i], back, count[i]

    def low_reverse(self, low: np.ndarray, length: int) -> np.ndarray:
        """Low in the reverse of phrases of so many symbols, of which there are fewer than suffixes are ordered by.

        The k-th suffix that starts with a symbol goes on as the k-th row that follows this symbol; both orders agree but for the
        last symbol, so each step reads one more symbol of the phrase and narrows its interval in the reverse.
        """
        row, back = low, np.zeros_like(low)
        for k in range(length):
            symbol = np.searchsorted(self.forward.first, row, side="right") - 1
            back = self.reverse.first[symbol] + (self.reverse.occurrences(symbol, back) if k else 0)
            row = self.forward.places[row]
        return back
