"""Exact byte-pair encoding by a table over prefixes, without running merges.

For every prefix of a text the encoding ends in one token only. It is found
among the vocabulary entries that end there (the matches of an automaton over
the vocabulary) as the one whose pair with the last token of what is left
of it stays as it is when the two are encoded together. The table of last
tokens gives the encoding of every prefix backwards, and with a running count
the exact number of tokens of every prefix.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import ahocorasick


class PrefixTable:
    """Last token of each prefix for a merge-based vocabulary.

    tokens: the entries' symbol strings by id (None: takes no part).
    merged: what two adjacent tokens merge into and with what rank (lower first), or None.
    fallback: ids for a symbol no entry holds.
    """

    def __init__(
        self,
        tokens: Sequence[str | None],
        merge_rank: Callable[[int, int], tuple[int, int] | None],
        fallback: Callable[[str], list[int]],
    ):
        self.tokens, self.merge_rank, self.fallback = tokens, merge_rank, fallback
        self.symbols = {t: i for i, t in enumerate(tokens) if t is not None and len(t) == 1}
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(tokens):
            if t and (len(t) == 1 or self._merge_all(t) == [i]):
                self.automaton.add_word(t, (i, len(t)))
        self.automaton.make_automaton()
        self.fits_cache: dict[int, bool] = {}  # by left * number of tokens + right

    def _merge_all(self, text: str) -> list[int]:
        """Merge step by step; only for vocabulary entries and pairs of them."""
        ids = [self.symbols.get(c, -1) for c in text]
        if -1 in ids:
            return []
        while len(ids) > 1:
            best = None
            for k in range(len(ids) - 1):
                found = self.merge_rank(ids[k], ids[k + 1])
                if found is not None and (best is None or found[0] < best[0]):
                    best = (found[0], k, found[1])
            if best is None:
                break
            ids[best[1] : best[1] + 2] = [best[2]]
        return ids

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are when encoded together."""
        known = self._merge_all(self.tokens[left] + self.tokens[right]) == [left, right]
        if len(self.fits_cache) >= 400_000:  # forget, so that memory stays bounded
            self.fits_cache.clear()
        self.fits_cache[left * len(self.tokens) + right] = known
        return known

    def table(self, text: str) -> tuple[list[int], list[int]]:
        """Last token and token count of each prefix of a text of known symbols."""
        last = [-1] * (len(text) + 1)
        count = [0] * (len(text) + 1)
        cache, many = self.fits_cache, len(self.tokens)
        for end, (token, length) in self.automaton.iter(text):  # of one end, the longest first
            end += 1
            if last[end] >= 0:
                continue
            at = end - length
            if at:
                before = last[at]
                fit = cache.get(before * many + token)
                if not (self.fits(before, token) if fit is None else fit):
                    continue
            last[end] = token
            count[end] = count[at] + 1
        if -1 in last[1:]:
            raise ValueError("a symbol has no entry of its own")
        return last, count

    def encode(self, text: str) -> list[int]:
        """Ids of a text, recovered backwards; symbols without an entry take the fallback."""
        ids: list[int] = []
        start = 0
        symbols = self.symbols
        for at, c in enumerate(text):
            if c not in symbols:
                ids += self._known(text[start:at])
                ids += self.fallback(c)
                start = at + 1
        return ids + self._known(text[start:])

    def _known(self, text: str) -> list[int]:
        if not text:
            return []
        last, _ = self.table(text)
        at, ids = len(text), []
        while at:
            ids.append(last[at])
            at -= len(self.tokens[last[at]])
        return ids[::-1]

    def counts(self, text: str) -> list[int]:
        """Tokens of each prefix, the empty one first; for a text of known symbols."""
        return self.table(text)[1]


class Recent(dict):
    """Results by unit in two generations, so that memory stays bounded and frequent units stay.

    A lookup of an unknown unit computes and keeps it. Only the work done
    depends on what is kept, never a result.
    """

    def __init__(self, compute: Callable[[str], object], most: int = 400_000, longest: int = 64):
        super().__init__()
        self.compute, self.most, self.longest, self.old = compute, most, longest, {}

    def __missing__(self, unit: str):
        value = self.old.get(unit)
        if value is None:
            value = self.compute(unit)
            if len(unit) > self.longest:
                return value
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[unit] = value
        return value
