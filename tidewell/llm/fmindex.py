"""A compressed full-text index over sequences of numbers, searched for many patterns at once."""

from __future__ import annotations

import numpy as np


class Bits:
    """Packed bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        room = -(-max(1, len(bits)) // 64) * 64
        padded = np.zeros(room, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]).astype(np.int32)
        self.words = np.append(self.words, np.uint64(0))

    def ones(self, places: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = places >> 6
        mask = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class Wavelet:
    """Wavelet tree in levels: how often a symbol occurs before a place."""

    def __init__(self, symbols: np.ndarray, depth: int):
        self.depth, self.levels, self.zeros = depth, [], []
        for level in range(depth - 1, -1, -1):
            bits = ((symbols >> level) & 1).astype(np.uint8)
            self.levels.append(Bits(bits))
            self.zeros.append(int(len(bits) - bits.sum()))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])
        # where the symbols of a value begin after the last level
        self.order = symbols

    def rank(self, symbols: np.ndarray, places: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before its place; ``starts`` as ``begin`` gives them."""
        for level, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = ((symbols >> (self.depth - 1 - level)) & 1).astype(bool)
            ones = bits.ones(places)
            places = np.where(one, zeros + ones, places - ones)
        return places - starts

    def begin(self, symbols: np.ndarray) -> np.ndarray:
        return self.rank(symbols, np.zeros(len(symbols), np.int64), np.zeros(len(symbols), np.int64))


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the length they are compared on."""
    n = len(symbols)
    _, rank = np.unique(symbols, return_inverse=True)
    length = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - length] = rank[length:] + 1
        key = rank.astype(np.int64) * (n + 1) + after
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        if n < 2 or rank[order[-1]] == n - 1:
            return order
        length *= 2


class FMIndex:
    """Index of some sequences, each with a value; finds what a pattern's occurrences have least.

    ``length`` is the length that matters: windows of that many symbols.
    """

    def __init__(self, sequences: list[np.ndarray], values: np.ndarray, length: int):
        self.length = length
        sizes = np.array([len(s) for s in sequences], np.int64)
        whole = np.concatenate([np.empty(0, np.uint64), *[s.astype(np.uint64) for s in sequences]])
        self.alphabet = np.unique(whole)
        # symbol 0 ends a sequence
        total = self.total = int(sizes.sum()) + len(sizes)
        if not total:
            return
        text = np.zeros(total, np.int64)
        owner = np.repeat(np.arange(len(sizes)), sizes + 1)
        inside = np.ones(total, bool)
        inside[np.cumsum(sizes + 1) - 1] = False
        text[inside] = np.searchsorted(self.alphabet, whole) + 1
        left = (np.cumsum(sizes + 1) - 1)[owner] - np.arange(total)
        order = suffix_order(text)
        # neighbours that share the first ``length`` symbols form a class
        same = left[order][1:] >= length
        same &= left[order][:-1] >= length
        equal = np.flatnonzero(same)
        code = _window_codes(text, length)
        same[equal] = code[order[equal]] == code[order[equal + 1]]
        first = np.concatenate([[True], ~same])
        self.group = np.cumsum(first) - 1
        starts = np.flatnonzero(first)
        self.group_low = starts
        self.group_high = np.append(starts[1:], total)
        self.least = np.minimum.reduceat(np.asarray(values, np.int64)[owner[order]], starts)
        before = text[order - 1]
        depth = max(1, int(len(self.alphabet)).bit_length())
        self.tree = Wavelet(before, depth)
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(self.alphabet) + 1))])

    def _symbols(self, pattern: np.ndarray) -> np.ndarray:
        """Numbers of the index's alphabet; -1 for symbols it lacks."""
        if not len(self.alphabet):
            return np.full(len(pattern), -1)
        at = np.minimum(np.searchsorted(self.alphabet, pattern), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == pattern, at + 1, -1)

    def least_values(self, patterns: list[np.ndarray], none: int) -> list[np.ndarray]:
        """For every window of every pattern, the least value of the sequences it occurs in.

        All patterns are read from right to left in step.  Each keeps the interval of
        suffixes that begin with the symbols read, capped at ``length`` of them: this is
        its matching statistic.  Where no suffix goes on, the last symbol is given up and
        the pattern is read anew from there.
        """
        out = [np.full(max(0, len(p) - self.length + 1), none, np.int64) for p in patterns]
        todo = np.array([k for k, o in enumerate(out) if len(o)], np.int64)
        if not len(todo) or not self.total:
            return out
        sizes = np.array([len(patterns[k]) for k in todo], np.int64)
        base = np.cumsum(sizes) - sizes
        flat = self._symbols(np.concatenate([patterns[k].astype(np.uint64) for k in todo]))
        begin = self.tree.begin(np.arange(len(self.alphabet) + 1))
        found = np.full(len(flat), none, np.int64)
        end, at = sizes.copy(), sizes.copy()
        low, high = np.zeros(len(todo), np.int64), np.full(len(todo), self.total, np.int64)
        # a window that ends at ``end`` or before may still be found
        live = np.flatnonzero(end >= self.length)
        while len(live):
            symbol = flat[base[live] + at[live] - 1]
            known = np.maximum(symbol, 0)
            new_low = self.counts[known] + self.tree.rank(known, low[live], begin[known])
            new_high = self.counts[known] + self.tree.rank(known, high[live], begin[known])
            goes = (symbol > 0) & (new_low < new_high)
            on, off = live[goes], live[~goes]
            at[on] -= 1
            low[on], high[on] = new_low[goes], new_high[goes]
            # nothing that crosses an unknown symbol occurs; else one symbol less is tried
            end[off] = np.where(symbol[~goes] > 0, end[off] - 1, at[off] - 1)
            end[off] = np.where(end[off] < at[off], at[off] - 1, end[off])
            at[off], low[off], high[off] = end[off], 0, self.total
            full = on[end[on] - at[on] >= self.length]
            group = self.group[low[full]]
            found[base[full] + at[full]] = self.least[group]
            low[full], high[full] = self.group_low[group], self.group_high[group]
            end[full] = at[full] + self.length
            # a window that ends after ``length`` symbols more must still fit
            live = live[(end[live] >= self.length) & (at[live] > 0)]
        for k, start in zip(todo, base):
            out[k] = found[start : start + len(out[k])]
        return out


def _window_codes(text: np.ndarray, length: int) -> np.ndarray:
    """Ranks of windows by doubling: equal codes mean equal windows of ``length`` symbols."""
    n = len(text)
    code, size = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while size < length:
        step = min(size, length - size)
        after = np.zeros(n, np.int64)
        after[: n - step] = code[step:] + 1
        code = np.unique(code * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        size += step
    return code
