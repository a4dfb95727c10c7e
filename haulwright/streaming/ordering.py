"""Rows of one key in order, with bounded memory, however many a micro-batch brings.

Up to `most` rows are sorted in memory. Beyond, each `most` rows become a sorted run in the
state store, cut into blocks, and the runs are merged holding one block of each. More runs than
are merged at once are merged into longer ones first. A block is taken out of the state as it
is read, so nothing stays behind when the last row has been handed on; a micro-batch that is
repeated begins from the state before it.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

#: Rows sorted in memory, rows in a block of a run, and runs that are merged at once.
IN_MEMORY, BLOCK, FAN_IN = 20_000, 500, 32


class Runs:
    """Sorted runs as blocks of rows in a map state (run and block number to a JSON text)."""

    def __init__(self, state, block: int = BLOCK) -> None:
        self.state, self.block, self.count = state, block, 0

    def write(self, rows: Iterable[tuple]) -> int:
        """Store rows that are in order; returns the number of the run."""
        rows, run, number = iter(rows), self.count, 0
        self.count += 1
        while held := list(islice(rows, self.block)):
            self.state.updateValue((run, number), (json.dumps(held),))
            number += 1
        return run

    def read(self, run: int) -> Iterator[tuple]:
        number = 0
        while (held := self.state.getValue((run, number))) is not None:
            self.state.removeKey((run, number))
            yield from map(tuple, json.loads(held[0]))
            number += 1


def in_order(
    rows: Iterable[tuple], state, key: Callable[[tuple], tuple], most: int = IN_MEMORY, block: int = BLOCK, fan_in: int = FAN_IN
) -> Iterator[tuple]:
    """Rows (tuples of plain values) sorted by `key`."""
    rows = iter(rows)
    first = sorted(islice(rows, most), key=key)
    more = sorted(islice(rows, most), key=key)
    if not more:
        yield from first
        return
    runs = Runs(state, block)
    waiting = [runs.write(first), runs.write(more)]
    del first
    while more := sorted(islice(rows, most), key=key):
        waiting.append(runs.write(more))
        if len(waiting) == fan_in * fan_in:  # keeps their number small, too
            waiting = _merged(runs, waiting, key, fan_in)
    while len(waiting) > fan_in:
        waiting = _merged(runs, waiting, key, fan_in)
    yield from heapq.merge(*map(runs.read, waiting), key=key)


def _merged(runs: Runs, waiting: list[int], key: Callable[[tuple], tuple], fan_in: int) -> list[int]:
    groups = [waiting[at : at + fan_in] for at in range(0, len(waiting), fan_in)]
    return [runs.write(heapq.merge(*map(runs.read, group), key=key)) for group in groups]
