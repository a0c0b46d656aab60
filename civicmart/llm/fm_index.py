"""A compressed FM-index over integer symbols, searched for many patterns at once.

The text is a concatenation of pieces, each followed by the separator symbol 0. Suffixes are
sorted by their first ``depth`` symbols (prefix doubling), which is all that patterns of up to
``depth`` symbols can tell apart: a pattern's rows lie together, and a backward step counts the
occurrences of a symbol before both ends of that interval. The Burrows-Wheeler transform is held
in a Huffman-shaped wavelet tree: a symbol's path is its Huffman code, the bits of a level are
packed, and ``rank`` adds the ones before a 64-bit word to a population count. Frequent symbols
so take few bits and few steps.
"""

from __future__ import annotations

import heapq

import numpy as np


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Huffman code length of each symbol (``counts`` positive)."""
    n = len(counts)
    if n == 1:
        return np.ones(1, dtype=np.int64)
    heap = [(int(c), k) for k, c in enumerate(counts.tolist())]
    heapq.heapify(heap)
    parent = np.zeros(2 * n - 1, dtype=np.int64)
    for node in range(n, 2 * n - 1):
        (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
        parent[i] = parent[j] = node
        heapq.heappush(heap, (a + b, node))
    deep = np.zeros(2 * n - 1, dtype=np.int64)
    for node in range(2 * n - 3, -1, -1):
        deep[node] = deep[parent[node]] + 1
    return deep[:n]


class BitRank:
    """Packed bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        padded = np.zeros((len(bits) // 64 + 1) * 8, dtype=np.uint8)
        padded[:len(packed)] = packed
        self.words = padded.view(np.uint64)
        ones = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)
        self.before = np.concatenate([[0], ones[:-1]]).astype(np.uint32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below).astype(np.int64)


class WaveletTree:
    """Huffman-shaped wavelet tree of a sequence of symbols 0 .. n-1, each used at least once."""

    def __init__(self, seq: np.ndarray, symbols: int) -> None:
        lengths = code_lengths(np.bincount(seq, minlength=symbols))
        order = np.lexsort((np.arange(symbols), lengths))
        per_length = np.bincount(lengths, minlength=int(lengths.max()) + 1)
        self.lengths = lengths
        self.codes = np.zeros(symbols, dtype=np.int64)
        self.inner_from = []  # at each depth: the smallest prefix that isn't a whole code
        code, at = 0, 0
        for length, n in enumerate(per_length.tolist()):
            code <<= 1
            self.codes[order[at:at + n]] = np.arange(code, code + n)
            code, at = code + n, at + n
            self.inner_from.append(code)
        self.levels = []  # (bits, first place of each inner node, ones before that place)
        cur, code_of, len_of = seq, self.codes, self.lengths
        for level in range(int(lengths.max())):
            own, left = code_of[cur], len_of[cur] - level
            bits = ((own >> (left - 1)) & 1).astype(bool)
            node = (own >> left) - self.inner_from[level]
            first = np.zeros((1 << level) - self.inner_from[level], dtype=np.int64)
            change = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            first[node[change]] = change
            ranks = BitRank(bits)
            self.levels.append((ranks, first, ranks.rank(first)))
            goes_on = left > 1
            cur = np.concatenate([cur[~bits & goes_on], cur[bits & goes_on]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbols[k]`` before each place ``at[.., k]``."""
        lengths = self.lengths[symbols]
        order = np.argsort(-lengths.astype(np.int8), kind="stable")  # long codes first
        lengths, codes, at = lengths[order], self.codes[symbols[order]], at[:, order]
        live = len(symbols) - np.searchsorted(lengths[::-1], np.arange(len(self.levels)), "right")
        for level, k in enumerate(live.tolist()):
            if not k:
                break
            bits, first, ones = self.levels[level]
            left, code = lengths[:k] - level, codes[:k]
            node = (code >> left) - self.inner_from[level]
            high = bits.rank(at[:, :k] + first[node]) - ones[node]
            at[:, :k] = np.where((code >> (left - 1)) & 1, high, at[:, :k] - high)
        out = np.empty_like(at)
        out[:, order] = at
        return out


class FMIndex:
    """Index of a text of symbols (0 separates pieces and ends the text), for patterns up to ``cap``."""

    def __init__(self, text: np.ndarray, cap: int) -> None:
        n = len(text)
        self.n, self.cap = n, cap
        ranks, step = [text.astype(np.int64)], 1
        while step < cap + 1:  # two suffixes are told apart up to ``cap`` symbols at least
            ahead = np.zeros(n, dtype=np.int64)
            ahead[:max(n - step, 0)] = ranks[-1][step:]
            key = ranks[-1] * (int(ranks[-1].max()) + 1) + ahead
            order = np.argsort(key)
            key = key[order]
            own = np.empty(n, dtype=np.int64)
            own[order] = np.cumsum(np.append(False, key[1:] != key[:-1]))
            ranks.append(own)
            step *= 2
        self.order = np.argsort(ranks[-1], kind="stable")
        self.symbols = int(text.max()) + 1
        counts = np.bincount(text, minlength=self.symbols)
        self.first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.tree = WaveletTree(text[self.order - 1], self.symbols)
        # Symbols that neighbours in the order share, up to ``step``; 0 before the first and behind the last.
        a, b = self.order[:-1], self.order[1:]
        shared = np.zeros(n - 1, dtype=np.int64)
        for k in range(len(ranks) - 1, -1, -1):
            i, j = a + shared, b + shared
            inside = (i < n) & (j < n)
            same = inside & (ranks[k][np.minimum(i, n - 1)] == ranks[k][np.minimum(j, n - 1)])
            shared += same * (1 << k)
        self.shared = np.concatenate([[0], shared, [0]]).astype(np.int32)
        self._starts: dict[int, np.ndarray] = {}

    def starts(self, depth: int) -> np.ndarray:
        """First row of each block of suffixes that agree on ``depth`` symbols, and ``n`` at the end."""
        if depth not in self._starts:
            self._starts[depth] = np.append(np.flatnonzero(self.shared[:-1] < depth), self.n)
        return self._starts[depth]

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Backward step: rows of the patterns with ``symbols`` put before them."""
        return self.first[symbols] + self.tree.rank(symbols, np.stack([low, high]))

    def _shorten(self, depth: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the patterns cut to their first ``depth`` symbols."""
        lo, hi = np.zeros_like(low), np.full_like(low, self.n)
        for d in np.unique(depth).tolist():
            if d:
                at, starts = depth == d, self.starts(d)
                k = np.searchsorted(starts, low[at], "right") - 1
                lo[at], hi[at] = starts[k], starts[k + 1]
        return lo, hi

    def matching_statistics(self, queries: np.ndarray, begins: np.ndarray,
                            ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place of ``queries``: the longest match that starts there, up to ``cap``, and its first row.

        Each query ``queries[begins[k]:ends[k]]`` is read from right to left: the match is extended by a
        symbol while the text holds it, and cut on the right where it doesn't. A symbol unknown to the
        index is -1 (or 0, the separator) and matches nothing.
        """
        length = np.zeros(len(queries), dtype=np.int32)
        row = np.zeros(len(queries), dtype=np.int64)
        live = np.flatnonzero(ends > begins)
        begin, at = begins[live], ends[live].copy()
        low, high = np.zeros(len(live), np.int64), np.full(len(live), self.n, np.int64)
        depth = np.zeros(len(live), np.int64)
        while len(at):
            whole = np.flatnonzero(depth == self.cap)
            if len(whole):
                depth[whole] -= 1
                low[whole], high[whole] = self._shorten(depth[whole], low[whole])
            symbol = queries[at - 1]
            known = (symbol > 0) & (symbol < self.symbols)
            new_low, new_high = self.extend(np.where(known, symbol, 0), low, high)
            found = known & (new_high > new_low)
            lost = np.flatnonzero(~found)
            low, high = np.where(found, new_low, low), np.where(found, new_high, high)
            depth += found
            if len(lost):
                none = lost[(depth[lost] == 0) | ~known[lost]]
                at[none] -= 1  # no match starts at this symbol
                depth[none], low[none], high[none] = 0, 0, self.n
                cut = lost[(depth[lost] > 0)]
                if len(cut):
                    depth[cut] = np.maximum(self.shared[low[cut]], self.shared[high[cut]])
                    low[cut], high[cut] = self._shorten(depth[cut], low[cut])
            at -= found
            length[at[found]], row[at[found]] = depth[found], low[found]
            more = at > begin
            if not more.all():
                begin, at, low, high, depth = (x[more] for x in (begin, at, low, high, depth))
        return length, row
