"""External induced suffix sorting with common-prefix values, in numpy.

The suffixes that begin a fall after a rise (the leftmost of a rising stretch) are named
by what they span, sorted by recursion on those names, and induce all others: first the
falling suffixes in ascending order, then the rising ones in descending order.  Both
passes pop suffix tuples (position, common prefix with the tuple before) from a priority
queue by first symbol and push the tuples of the positions before them.  Within a symbol
tuples come in sorted order, so the queue is a file of runs for each symbol; beyond
``memory`` bytes it lies on disk.  Common prefixes are cut off at ``limit``, and suffixes
that agree so far may come in any order.
"""

from __future__ import annotations

import os
import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

Pair = tuple[np.ndarray, np.ndarray]


class Queue:
    """Tuples by symbol, first in, first out; kept in a file beyond ``memory`` bytes."""

    def __init__(self, memory: int) -> None:
        self.memory, self.held, self.file = memory, 0, None
        self.runs: dict[int, list] = defaultdict(list)

    def push(self, symbol: int, position: np.ndarray, prefix: np.ndarray) -> None:
        self.runs[symbol].append((position, prefix))
        self.held += position.nbytes + prefix.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, os.SEEK_END)
        for runs in self.runs.values():
            for i, run in enumerate(runs):
                if isinstance(run[0], np.ndarray):
                    at = self.file.tell()
                    self.file.write(run[0].tobytes())
                    self.file.write(run[1].tobytes())
                    runs[i] = (at, len(run[0]), run[0].dtype, run[1].dtype)
        self.held = 0

    def pop(self, symbol: int) -> Pair | None:
        """All tuples of a symbol that are there now."""
        runs = self.runs.pop(symbol, None)
        if not runs:
            return None
        loaded = []
        for run in runs:
            if not isinstance(run[0], np.ndarray):
                at, n, kind, small = run
                self.file.seek(at)
                run = (np.frombuffer(self.file.read(n * kind.itemsize), kind), np.frombuffer(self.file.read(n * small.itemsize), small))
            else:
                self.held -= run[0].nbytes + run[1].nbytes
            loaded.append(run)
        return loaded[0] if len(loaded) == 1 else (np.concatenate([r[0] for r in loaded]), np.concatenate([r[1] for r in loaded]))

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def rising(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is less than the one after it; the end is less than all."""
    out = np.zeros(len(text), bool)
    step = text[1:].astype(np.int64) - text[:-1]
    at = np.flatnonzero(step)
    if len(at):
        out[: at[-1] + 1] = np.repeat(step[at] > 0, np.diff(at, prepend=-1))
    return out


def named(text: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ranks of the stretches from each start to the next one, that one included.

    A stretch that begins another one is the greater of the two.
    """
    m = len(start)
    size = np.append(np.diff(start) + 1, len(text) - start[-1] + 1)
    wide = np.append(text.astype(np.uint64) + np.uint64(1), np.uint64(0))  # the end is less than all
    rank, offset = np.zeros(m, np.int64), 0
    active = np.arange(m)
    while len(active):
        word = np.zeros(len(active), np.uint64)
        for j in range(offset, offset + 3):
            inside = size[active] > j
            symbol = np.full(len(active), (1 << 21) - 1, np.uint64)
            symbol[inside] = wide[start[active[inside]] + j]
            word = word << np.uint64(21) | symbol
        order = np.lexsort((word, rank[active]))
        active, word = active[order], word[order]
        old = rank[active]
        index = np.arange(len(active))
        new_old = np.concatenate([[True], old[1:] != old[:-1]])
        slot = old + index - np.maximum.accumulate(np.where(new_old, index, 0))
        new = new_old.copy()
        new[1:] |= word[1:] != word[:-1]
        rank[active] = np.maximum.accumulate(np.where(new, slot, 0))
        offset += 3
        alone = new & np.append(new[1:], True)
        active = active[~alone & (size[active] >= offset)]
    values, dense = np.unique(rank, return_inverse=True)
    return dense, len(values)


def doubled(text: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of the suffixes by ``depth`` symbols, in memory, and the ranks by 1, 2, 4 ... symbols."""
    n = len(text)
    rank, levels, length = text.astype(np.int64), [text.astype(np.int32)], 1
    while True:
        key = rank * (n + 1)
        key[: n - length] += rank[length:] + 1
        order = np.argsort(key)
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
        length *= 2
        if length >= depth or rank[order[-1]] == n - 1 or length >= n:
            return order, levels
        levels.append(rank.astype(np.int32))


def prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int, known: np.ndarray | int = 0) -> np.ndarray:
    """Common prefixes of the suffixes at a and b, from ``known`` on, up to ``limit``."""
    out = np.zeros(len(a), np.int64) + known
    active = np.flatnonzero(out < limit)
    n = len(text)
    while len(active):
        i, j = a[active] + out[active], b[active] + out[active]
        inside = (i < n) & (j < n)
        active, i, j = active[inside], i[inside], j[inside]
        same = text[i] == text[j]
        active = active[same]
        out[active] += 1
        active = active[out[active] < limit]
    return np.minimum(out, limit)


class Sorter:
    """Sorted suffixes of ``text``, symbol by symbol, with common prefixes up to ``limit``."""

    def __init__(self, text: np.ndarray, limit: int, memory: int = 64 << 20, inner: int = 1 << 22, depth: int = 0) -> None:
        self.text, self.limit, self.memory, self.inner = text, limit, memory, inner
        self.depth = max(limit, depth)  # symbols by which suffixes are told apart
        self.up = rising(text)
        self.kind = np.int32 if len(text) < 1 << 31 else np.int64
        self.symbols = int(text.max()) + 1 if len(text) else 0

    def starts(self) -> Pair:
        """The leftmost rising suffixes in sorted order, and their common prefixes."""
        start = np.flatnonzero(self.up[1:] & ~self.up[:-1]) + 1
        if not len(start):
            return start, np.zeros(0, np.uint8)
        names, count = named(self.text, start)
        levels: list[np.ndarray] = []
        if count == len(start):
            order = np.argsort(names)
        elif len(start) <= self.inner:
            order, levels = doubled(names, self.depth // 2 + 2)
        else:
            order = np.concatenate([p for p, _ in Sorter(names, 0, self.memory, self.inner, self.depth // 2 + 2).by_symbol()][::-1])
        # Equal names are equal stretches: what the levels agree on is common already.
        a, b = order[:-1].copy(), order[1:].copy()
        for j in range(len(levels) - 1, -1, -1):
            inside = (a < len(names)) & (b < len(names))
            same = np.zeros(len(a), bool)
            same[inside] = levels[j][a[inside]] == levels[j][b[inside]]
            a[same] += 1 << j
            b[same] += 1 << j
        ends = np.append(start, len(self.text))
        known = ends[np.minimum(a, len(start))] - start[order[:-1]]
        known = np.minimum(known, ends[np.minimum(b, len(start))] - start[order[1:]])
        common = np.zeros(len(start), np.int64)
        if self.limit:
            common[1:] = prefixes(self.text, start[order[:-1]], start[order[1:]], self.limit, np.minimum(known, self.limit))
        return start[order], common.astype(np.uint8)

    def _run(self, position: int) -> int:
        """How often the symbol at ``position`` stands there in a row."""
        part = self.text[position : position + self.limit]
        other = np.flatnonzero(part != part[0])
        return int(other[0]) if len(other) else len(part)

    def _scan(self, queue: Queue, position: np.ndarray, prefix: np.ndarray, up: bool) -> None:
        """Push the tuples that the popped ones induce."""
        before = position - 1
        chosen = np.flatnonzero((position > 0) & (self.up[before] == up))
        symbol = self.text[before[chosen]]
        order = np.argsort(symbol, kind="stable")
        chosen, symbol = chosen[order], symbol[order]
        if not self.limit:
            common = np.zeros(len(chosen), np.uint8)
        else:
            least = np.minimum.accumulate(prefix)
            new = np.ones(len(chosen), bool)
            new[1:] = symbol[1:] != symbol[:-1]
            common = np.empty(len(chosen), np.uint8)
            common[new] = np.minimum(self.since[symbol[new]], least[chosen[new]])
            old = np.flatnonzero(~new)
            common[old] = _least(prefix, chosen[old - 1] + 1, chosen[old])
            common = np.minimum(common, self.limit - 1) + np.uint8(1)
            common[new & ~self.seen[symbol]] = 0
            # What the next tuple of each symbol has in common with this scan.
            self.since = np.minimum(self.since, least[-1] if len(least) else 255)
            last = np.append(new[1:], True) if len(new) else new
            rest = np.append(np.minimum.accumulate(prefix[::-1])[::-1], np.uint8(255))
            self.since[symbol[last]] = rest[chosen[last] + 1]
            self.seen[symbol] = True
        ends = np.flatnonzero(np.append(symbol[1:] != symbol[:-1], True)) + 1 if len(symbol) else []
        first = 0
        found = before[chosen].astype(self.kind)
        for end in ends:
            queue.push(int(symbol[first]), found[first:end], common[first:end])
            first = end

    def _fresh(self) -> Queue:
        if self.limit:
            self.since, self.seen = np.full(self.symbols, 255, np.uint8), np.zeros(self.symbols, bool)
        return Queue(self.memory)

    def by_symbol(self) -> Iterator[Pair]:
        """(positions, common prefixes with the suffix before) of each first symbol, the
        greatest symbol first, the suffixes of a symbol in ascending order."""
        n = len(self.text)
        if not n:
            return
        start, common = self.starts()
        first = self.text[start] if len(start) else np.zeros(0, np.int64)
        present = np.unique(self.text)
        bounds = dict(zip(present.tolist(), zip(np.searchsorted(first, present, "left").tolist(), np.searchsorted(first, present, "right").tolist(), strict=True), strict=True))
        queue, falling = self._fresh(), Queue(self.memory)
        # The end of the text is the least suffix of all; it induces the last position.
        queue.push(int(self.text[-1]), np.array([n - 1], self.kind), np.zeros(1, np.uint8))
        if self.limit:
            self.seen[self.text[-1]], self.since[self.text[-1]] = True, 0
            self.since[:] = 0
        for c in present.tolist():
            last = -1
            while (popped := queue.pop(c)) is not None:
                falling.push(c, *popped)
                self._scan(queue, *popped, up=False)
                last = int(popped[0][-1])
            lo, hi = bounds[c]
            if lo < hi:
                prefix = common[lo:hi].copy()
                prefix[0] = 0 if last < 0 or not self.limit else min(self._run(last), self._run(int(start[lo])))
                self._scan(queue, start[lo:hi], prefix, up=False)
        queue.close()
        queue = self._fresh()
        for c in present[::-1].tolist():
            runs: list[Pair] = []
            while (popped := queue.pop(c)) is not None:
                runs.append(popped)
                self._scan(queue, *popped, up=True)
            high = (np.concatenate([r[0] for r in runs]), np.concatenate([r[1] for r in runs])) if runs else None
            low = falling.pop(c)
            border = min(self._run(int(high[0][-1])), self._run(int(low[0][-1]))) if high and low and self.limit else 0
            if low:
                self._scan(queue, low[0][::-1], np.append(np.uint8(border), low[1][:0:-1]), up=True)
            position = [low[0]] if low else []
            prefix = [low[1]] if low else []
            if high:
                position.append(high[0][::-1])
                prefix.append(np.append(np.uint8(border), high[1][:0:-1]))
            yield np.concatenate(position), np.concatenate(prefix)
        queue.close()
        falling.close()


def _least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of values[first..last], both included, for each pair."""
    out = np.empty(len(first), values.dtype)
    if not len(first):
        return out
    width = last - first + 1
    level = np.frexp(width.astype(np.float64))[1] - 1
    table, step = values, 1
    for k in range(int(level.max()) + 1):
        at = np.flatnonzero(level == k)
        if len(at):
            out[at] = np.minimum(table[first[at]], table[last[at] - step + 1])
        table, step = np.minimum(table[:-step], table[step:]) if len(table) > step else table, step * 2
    return out
