"""Suffix arrays by induced sorting, in numpy steps over whole buckets.

Suffixes are classified as smaller or larger than their successor, leftmost
smaller ones are sorted by their substrings, recursively where these tie, and all
others are induced from them in two scans. A scan's bucket is one or a few
array operations: what stands in a bucket when the scan reaches it puts its
predecessors into later buckets in order, and only equal neighbouring symbols
make a bucket feed itself.
"""

from __future__ import annotations

import numpy as np

#: Alphabets up to this size are scanned bucket by bucket; names of larger ones are ranked by doubling.
BUCKETS = 4096


def _kinds(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; the last one (the end mark) is."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int64)))
    at = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(at[::-1])[::-1]
    smaller = np.ones(n, bool)
    inner = following < n
    smaller[:-1][inner] = step[following[inner]] > 0
    return smaller


class _Scan:
    """The two inducing scans over one text."""

    def __init__(self, text: np.ndarray, smaller: np.ndarray, size: int):
        self.text, self.smaller, self.size = text, smaller, size
        counts = np.bincount(text, minlength=size)
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts
        self.larger_counts = np.bincount(text[~smaller], minlength=size)
        self.present = np.flatnonzero(counts).tolist()

    def _predecessors(self, batch: np.ndarray, smaller: bool) -> tuple[np.ndarray, np.ndarray]:
        """Predecessors of a kind, grouped by symbol in the order of the batch."""
        before = batch[batch > 0] - 1
        before = before[self.smaller[before] == smaller]
        symbols = self.text[before]
        order = np.argsort(symbols, kind="stable")
        return before[order], symbols[order]

    def run(self, leftmost: np.ndarray) -> np.ndarray:
        """The suffix array induced from leftmost smaller suffixes in the given order."""
        text, size = self.text, self.size
        array = np.full(len(text), -1, np.int64)
        symbols = text[leftmost]
        order = np.argsort(symbols, kind="stable")
        first_counts = np.bincount(symbols, minlength=size)
        first_starts = self.ends - first_counts
        base = np.cumsum(first_counts) - first_counts
        array[first_starts[symbols[order]] + np.arange(len(order)) - base[symbols[order]]] = leftmost[order]

        heads = self.starts.copy()
        for symbol in self.present:
            done = int(self.starts[symbol])
            while done < heads[symbol]:
                upto = int(heads[symbol])
                self._ahead(array, array[done:upto], heads)
                done = upto
            if first_counts[symbol]:
                self._ahead(array, array[first_starts[symbol] : self.ends[symbol]], heads)

        tails = self.ends.copy()
        for symbol in reversed(self.present):
            done = int(self.ends[symbol])
            while done > tails[symbol]:
                upto = int(tails[symbol])
                self._behind(array, array[upto:done][::-1], tails)
                done = upto
            start, larger = int(self.starts[symbol]), int(self.larger_counts[symbol])
            if larger:
                self._behind(array, array[start : start + larger][::-1], tails)
            if symbol == 0:
                array[0] = len(text) - 1
        return array

    def _ahead(self, array: np.ndarray, batch: np.ndarray, heads: np.ndarray) -> None:
        before, symbols = self._predecessors(batch, smaller=False)
        if len(before):
            counts = np.bincount(symbols, minlength=self.size)
            base = np.cumsum(counts) - counts
            array[heads[symbols] + np.arange(len(before)) - base[symbols]] = before
            heads += counts

    def _behind(self, array: np.ndarray, batch: np.ndarray, tails: np.ndarray) -> None:
        before, symbols = self._predecessors(batch, smaller=True)
        if len(before):
            counts = np.bincount(symbols, minlength=self.size)
            base = np.cumsum(counts) - counts
            array[tails[symbols] - 1 - (np.arange(len(before)) - base[symbols])] = before
            tails -= counts


def _same_substrings(text: np.ndarray, leftmost: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Whether each sorted leftmost substring equals the one before it."""
    lengths = np.r_[np.diff(leftmost), 0][order] + 1  # up to and with the next leftmost place
    starts = leftmost[order]
    same = np.r_[False, lengths[1:] == lengths[:-1]]
    active, offset = np.flatnonzero(same), 0
    while len(active):
        equal = text[starts[active] + offset] == text[starts[active - 1] + offset]
        same[active[~equal]] = False
        offset += 1
        active = active[equal]
        active = active[lengths[active] > offset]
    return same


def _by_doubling(text: np.ndarray) -> np.ndarray:
    """The suffix array of a text with a large alphabet; its last symbol is the only smallest."""
    rank, width, n = np.unique(text, return_inverse=True)[1], 1, len(text)
    while True:
        second = np.zeros(n, np.int64)
        second[: n - width] = rank[width:] + 1
        key = rank * (n + 2) + second
        order = np.argsort(key)  # equal keys may stand in any order
        changed = np.r_[0, (np.diff(key[order]) != 0).astype(np.int64)].cumsum()
        rank = np.empty(n, np.int64)
        rank[order] = changed
        if changed[-1] == n - 1:
            return order
        width *= 2


def suffix_array(text: np.ndarray, size: int) -> np.ndarray:
    """Starts of the suffixes of a text in order; its symbols lie below size, 0 stands at its end only."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    if size > BUCKETS:
        return _by_doubling(text)
    text = text.astype(np.uint16)  # numpy sorts short integers by counting
    smaller = _kinds(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    scan = _Scan(text, smaller, size)
    place = np.full(n, -1, np.int32 if n < 1 << 31 else np.int64)
    place[leftmost] = np.arange(len(leftmost))
    order = place[scan.run(leftmost)]
    order = order[order >= 0]
    del place  # memory for what follows
    names_in_order = np.cumsum(~_same_substrings(text, leftmost, order)) - 1
    names = np.empty(len(order), np.int64)
    names[order] = names_in_order
    if names_in_order[-1] < len(order) - 1:
        order = suffix_array(names, int(names_in_order[-1]) + 1)
    return scan.run(leftmost[order])


def common_prefixes(data: np.ndarray, array: np.ndarray, most: int) -> np.ndarray:
    """For each text place the length of the prefix its suffix shares with the one before it in the array, up to most.

    data: the text's bytes with at least `most` + 8 more behind them. array: all suffixes in order, or some.
    """
    n = int(array.max()) + 1
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    shared = np.zeros(n, np.int64)
    active = np.flatnonzero(before >= 0)
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    offset = 0
    while offset + 8 <= most and len(active):  # eight bytes at a time, as long as they agree
        equal = words[active + offset] == words[before[active] + offset]
        rest = active[~equal]
        _count_single(data, rest, before, offset, offset + 8, shared)
        active = active[equal]
        offset += 8
        shared[active] = offset
    _count_single(data, active, before, offset, most, shared)
    return shared


def _count_single(data, places, before, start, end, shared) -> None:
    shared[places] = start
    for offset in range(start, end):
        places = places[data[places + offset] == data[before[places] + offset]]
        shared[places] = offset + 1
        if not len(places):
            return
