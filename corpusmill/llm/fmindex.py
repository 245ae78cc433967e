"""FM-index of a sequence of symbols in numpy: wavelet matrix, backward search, sampled positions.

Symbols are 1 and up; 0 separates runs, and no suffix is compared beyond the
separator that follows it, so equal runs are told apart by their position.
Searches are made for many patterns at once.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, by doubling the compared length until none are equal."""
    n = len(text)
    separators = np.cumsum(text == 0)
    rank = np.where(text == 0, separators - 1, text.astype(np.int64) + separators[-1] if n else 0)
    _, rank = np.unique(rank, return_inverse=True)
    step, kinds = 1, int(rank.max(initial=-1)) + 1
    while kinds < n:
        after = np.zeros(n, dtype=np.int64)
        after[:-step] = rank[step:] + 1
        found, rank = np.unique(rank * (n + 1) + after, return_inverse=True)
        kinds, step = len(found), 2 * step
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return order


class WaveletMatrix:
    """``rank(c, i)``: how often c is among the first i symbols."""

    def __init__(self, values: np.ndarray, most: int):
        self.levels = max(1, int(most).bit_length())
        self.zeros, self.split = [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (values >> level) & 1
            count = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(bit == 0, out=count[1:])
            self.zeros.append(count)
            self.split.append(int(count[-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        low = np.zeros(len(c), dtype=np.int64)
        i = i.astype(np.int64)
        for k in range(self.levels):
            one = ((c >> (self.levels - 1 - k)) & 1).astype(bool)
            zi, zl = self.zeros[k][i], self.zeros[k][low]
            i = np.where(one, self.split[k] + i - zi, zi)
            low = np.where(one, self.split[k] + low - zl, zl)
        return i - low


class FmIndex:
    """Index of ``text``, which must end in 0; ``most`` is the largest symbol."""

    def __init__(self, text: np.ndarray, most: int, sample: int = 8):
        order = suffix_order(text)
        self.last = text[order - 1]  # the symbol before each suffix; before the first is the final 0
        self.wavelet = WaveletMatrix(self.last, most)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=most + 1))])
        # Positions are kept for every so many suffixes and where a run begins; from others one walks back.
        kept = (order % sample == 0) | (self.last == 0)
        self.kept = kept
        self.slot = np.cumsum(kept) - 1
        self.position = order[kept]

    def search(self, patterns: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes that begin with each pattern, a row of symbols aligned to the right."""
        width = patterns.shape[1]
        low, high = self.first[patterns[:, -1]], self.first[patterns[:, -1] + 1]
        for k in range(1, width):
            live = np.flatnonzero((length > k) & (low < high))
            if not len(live):
                break
            c = patterns[live, width - 1 - k]
            low[live] = self.first[c] + self.wavelet.rank(c, low[live])
            high[live] = self.first[c] + self.wavelet.rank(c, high[live])
        return low, high

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Position in the text of each suffix."""
        row, steps = row.copy(), np.zeros(len(row), dtype=np.int64)
        live = np.flatnonzero(~self.kept[row])
        while len(live):
            c = self.last[row[live]]
            row[live] = self.first[c] + self.wavelet.rank(c, row[live])
            steps[live] += 1
            live = live[~self.kept[row[live]]]
        return self.position[self.slot[row]] + steps
