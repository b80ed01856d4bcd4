"""Adaptive context-mixing range coder for token ids, many blocks in step.

A block is coded by itself: its models start empty, so any block can be read alone.
Blocks of one call are lanes of numpy arrays, longest first, and every step codes one id
of each lane that still has one.

A payload begins with the block's distinct ids and how often each is coded by order 0;
within the block an id is its rank among them.  An id is coded as one of three cases: it is
what followed the last two ids before (order 2), what followed the last id (order 1), or
neither.  How likely each case is, three adaptive count tables say, one per order, and
their opinions are mixed with weights that count how often each order was right.  This
narrows the range once; an id outside the predictions narrows it again, by its order-0 count.
Models learn after each epoch, from whole numbers only, so that the reader repeats the
writer's steps exactly.  Epochs grow from EPOCH ids to LONG_EPOCH.  All opinions of an
epoch are mixed once for each pair of contexts, and what it saw is counted by these pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np

BLOCK = 4096
EPOCH, LONG_EPOCH = 32, 256
RANK_BITS = 12
SLOTS = 1 << RANK_BITS
RANK = np.uint16(SLOTS - 1)
BITS = 16
TOTAL = 1 << BITS
WORD_BITS = 32
U = np.uint64
TOP, SHIFT, HALF = U(1 << WORD_BITS), U(WORD_BITS), U(BITS)
ORDER_0, MASK = U(RANK_BITS), U(TOTAL - 1)
#: The place of all parts together.
EVERY = np.uint32(SLOTS << BITS)
#: Confidences of orders 2 and 1, and the cases.
TWO, ONE, CASES = 4, 4, 3
#: Pairs of contexts, and lanes that learn together, so that their arrays stay in a processor's cache.
PAIRS, LANES = TWO * ONE, 128


class Encoder:
    """Range coder of all lanes: 64 bits of low, 32-bit words out, carries settled at the end."""

    def __init__(self, lanes: int, words: int) -> None:
        self.low, self.range = np.zeros(lanes, U), np.full(lanes, (1 << 64) - 1, U)
        self.out, self.lanes = np.zeros(words * lanes, U), lanes
        self.next = np.arange(lanes)  # the words of all lanes alternate, as they are written at about one pace

    def put(self, start: np.ndarray, size: np.ndarray, bits: np.uint64) -> None:
        """Narrow the ranges of the first lanes to ``size`` of 2**bits parts from ``start`` on."""
        k = len(start)
        low, part = self.low[:k], self.range[:k]
        part >>= bits
        add = part * start
        low += add
        part *= size
        over = (low < add).nonzero()[0]
        if len(over):
            self.out[self.next.take(over) - self.lanes] += U(1)
        at = (part < TOP).nonzero()[0]
        if len(at):
            low_at, next_at = low.take(at), self.next.take(at)
            self.out[next_at] = low_at >> SHIFT
            low[at] = low_at << SHIFT
            part[at] = part.take(at) << SHIFT
            self.next[at] = next_at + self.lanes

    def finish(self) -> list[bytes]:
        for _ in range(2):
            self.out[self.next] = self.low >> SHIFT
            self.low <<= SHIFT
            self.next += self.lanes
        used = self.next // self.lanes
        out = self.out[: used.max() * self.lanes].reshape(-1, self.lanes)
        # A carry seldom goes on: as many rounds as the longest chain of full words.
        while (carry := out >> SHIFT).any():
            out &= TOP - U(1)
            out[:-1] += carry[1:]
        small = np.ascontiguousarray(out.T, "<u4")
        return [row[:n].tobytes() for row, n in zip(small, used.tolist(), strict=True)]


class Decoder:
    """Reads what ``Encoder`` wrote."""

    def __init__(self, payloads: list[bytes]) -> None:
        lanes, words = len(payloads), max(map(len, payloads)) // 4 + 4
        rows = np.zeros((lanes, words), np.uint32)
        for row, p in zip(rows, payloads, strict=True):
            row[: len(p) // 4] = np.frombuffer(p, "<u4", len(p) // 4)
        self.words, self.lanes = rows.T.astype(U, "C").reshape(-1), lanes
        self.code = (self.words[:lanes] << SHIFT) | self.words[lanes : 2 * lanes]
        self.next = np.arange(2 * lanes, 3 * lanes)
        self.last = lanes * (words - 1)
        self.range = np.full(lanes, (1 << 64) - 1, U)

    def refill(self, k: int) -> None:
        """A further word for each of the first lanes whose range is small."""
        part = self.range[:k]
        at = (part < TOP).nonzero()[0]
        if len(at):
            next_at = np.minimum(self.next.take(at), self.last)  # a damaged payload may run out
            self.code[at] = (self.code.take(at) << SHIFT) | self.words.take(next_at)
            part[at] = part.take(at) << SHIFT
            self.next[at] = next_at + self.lanes

    def case(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the code of each lane is at or beyond either bound of 2**BITS parts; takes that case."""
        k = len(first)
        code, part = self.code[:k], self.range[:k]
        end = part >> HALF
        first, second = end * first, end * second
        end <<= HALF
        above, rest = code >= first, code >= second
        start = first * above
        np.copyto(start, second, where=rest)
        np.copyto(first, second, where=above)
        np.copyto(first, end, where=rest)
        code -= start
        np.subtract(first, start, out=part)
        self.refill(k)
        return above, rest

    def peek(self, k: int, bits: np.uint64) -> np.ndarray:
        part = self.range[:k]
        part >>= bits
        return np.minimum(self.code[:k] // part, (U(1) << bits) - U(1))

    def take(self, start: np.ndarray, size: np.ndarray) -> None:
        """Take ``size`` parts from ``start`` on, after ``peek``."""
        k = len(start)
        part = self.range[:k]
        self.code[:k] -= part * start
        part *= size
        self.refill(k)


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """Whole numbers of at least one, in proportion to the counts, that add up to ``total``."""
    n = counts.shape[-1]
    out = counts * (total - n) // counts.sum(-1, keepdims=True) + 1
    out[..., -1] += total - out.sum(-1)
    return out


class Models:
    """Predictions and counts of all lanes, frozen between two calls of ``learn``."""

    def __init__(self, lanes: int) -> None:
        # The rank that followed a context, and above it two bits of confidence.
        self.two, self.one = np.zeros(lanes * SLOTS, np.uint16), np.zeros(lanes * SLOTS, np.uint16)
        # Opinions on the three cases: by confidence of order 2, by that of order 1, and by nothing.
        start = np.array([1, 1, 4])
        self.cases = [np.tile(start, (lanes, *n, 1)) for n in ((TWO, 1), (1, ONE), (1, 1))]
        self.right = np.ones((lanes, 3), np.int64)
        self.scaled = [np.empty_like(c) for c in self.cases]
        #: Where the second case begins and, above it, where the third does, for each pair of contexts.
        self.mixed = np.empty(lanes * PAIRS, U)
        self.freeze(slice(0, lanes))

    def freeze(self, some: slice) -> None:
        # The shares add up to 2**12 and the weights to 2**4, a mixture so to TOTAL.
        weight, mixed = shares(self.right[some], 16), 0
        for i, (scaled, counts) in enumerate(zip(self.scaled, self.cases, strict=True)):
            scaled[some] = shares(counts[some], TOTAL >> 4)
            mixed = mixed + np.cumsum(scaled[some, ..., :2], -1) * weight[:, i, None, None, None]
        self.mixed[some.start * PAIRS : some.stop * PAIRS] = (mixed[..., 0] | mixed[..., 1] << BITS).reshape(-1)

    def predict(self, before: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(slot of order 2, entry 2, entry 1, pair of contexts) after the ranks before and last.

        To the ranks the first slot of their lane is added, so the last one is the slot of order 1.
        """
        two = before * 40503
        two &= SLOTS - 1
        two ^= last
        e2, e1 = self.two.take(two), self.one.take(last)
        # A confidence has two bits.
        pair = e2 >> RANK_BITS
        pair <<= 2
        pair |= e1 >> RANK_BITS
        return two, e2, e1, pair

    def learn(self, ranks: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """(lanes, cases, starts, sizes) of the ranks of an epoch, which are taken in then.

        Lanes are rows; the first two ranks are those before the epoch.  A size of TOTAL is 0.
        """
        for first in range(0, len(ranks), LANES):
            some = slice(first, min(first + LANES, len(ranks)))
            lane, now = np.arange(some.start, some.stop)[:, None], ranks[some, 2:]
            wide = ranks[some, :-1] + lane * SLOTS
            one = wide[:, 1:]
            two, e2, e1, pair = self.predict(wide[:, :-1], one)
            same_2, same_1 = (e2 & RANK) == now, (e1 & RANK) == now
            # A prediction without confidence is none.
            hit_2 = same_2 & (e2 > RANK)
            hit_1 = same_1 & (e1 > RANK) & ~hit_2
            case = np.full(now.shape, 2, np.uint8)
            case -= hit_1
            case -= hit_2.view(np.uint8) << 1
            bounds = self.mixed.take(lane * PAIRS + pair)
            after = bounds.astype(np.uint16)
            bounds >>= HALF
            third = bounds.astype(np.uint16)
            start = np.where(hit_1, after, third)
            start[hit_2] = 0
            size = np.where(hit_2, after, np.where(hit_1, third, np.uint16(0))) - start
            for table, slot, entry, same in ((self.two, two, e2, same_2), (self.one, one, e1, same_1)):
                # The confidence of a right prediction grows up to 3; any other begins at 1.
                entry >>= RANK_BITS
                np.minimum(entry, 2, out=entry)
                entry *= same
                entry += 1
                entry <<= RANK_BITS
                entry |= now
                table[slot] = entry
            self.count(some, (lane - first) * (4 * PAIRS) + (pair * np.uint16(4) + case))
            yield some, case, start, size

    def count(self, some: slice, at: np.ndarray) -> None:
        """Count the cases of some lanes, given as 4 times the pair and the case, by lane."""
        n = some.stop - some.start
        seen = np.bincount(at.reshape(-1), minlength=n * PAIRS * 4).reshape(n, TWO, ONE, 4)[..., :CASES]
        a, b, c = (s[some] for s in self.scaled)
        first = (a >= b) & (a >= c)
        second = ~first & (b >= c)
        every = seen.sum((1, 2, 3))
        firsts, seconds = (seen * first).sum((1, 2, 3)), (seen * second).sum((1, 2, 3))
        self.right[some] += np.stack([firsts, seconds, every - firsts - seconds], 1)
        for counts, axes in zip(self.cases, (2, 1, (1, 2)), strict=True):
            counts[some] += 8 * seen.sum(axes, keepdims=True)
        self.freeze(some)


def epochs(sizes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first step, end, lanes that have the first step's id) of each epoch; sizes are descending."""
    first, longest = 0, int(sizes[0])
    while first < longest:
        end = min(first + min(max(first, EPOCH), LONG_EPOCH), longest)
        yield first, end, int(np.searchsorted(-sizes, -first, "left"))
        first = end


def order_0(counts: np.ndarray) -> np.ndarray:
    """Bounds of each rank, from 0 to SLOTS; with no more than SLOTS counts in all, none that counts is empty."""
    bounds = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=bounds[1:])
    return bounds * SLOTS // max(int(bounds[-1]), 1)


def places(bounds: np.ndarray) -> np.ndarray:
    """Where each rank begins and, above that, how many parts it has."""
    return (bounds[:-1] | np.diff(bounds) << BITS).astype(np.uint32)


def _small(values: np.ndarray) -> tuple[bytes, bytes]:
    """Whole numbers below 2**16 as bytes; 255 and more are 255, with the number in the second string."""
    return np.minimum(values, 255).astype(np.uint8).tobytes(), values[values >= 255].astype("<u2").tobytes()


def head(known: np.ndarray, counts: np.ndarray) -> bytes:
    """What a payload begins with: distinct ids, ascending, and their counts."""
    gaps, wide_gaps = _small(np.diff(known, prepend=0))
    few, many = _small(counts)
    return len(known).to_bytes(2, "little") + gaps + few + wide_gaps + many


def behead(payload: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Ids, counts, and what follows; missing bytes of a damaged payload are read as zeros."""
    n = min(int.from_bytes(payload[:2], "little"), BLOCK)
    start = payload[2 : 2 + 2 * n].ljust(2 * n, b"\0")
    values = np.frombuffer(start, np.uint8).astype(np.int64)
    wide = (values == 255).nonzero()[0]
    end = 2 + 2 * n + 2 * len(wide)
    values[wide] = np.frombuffer(payload[2 + 2 * n : end].ljust(2 * len(wide), b"\0"), "<u2")
    return (np.cumsum(values[:n]) & 0xFFFF).astype(np.uint32), values[n:], payload[end:]


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """The payload of each block of at most BLOCK ids below 65,536."""
    if not blocks:
        return []
    sizes = np.array([len(b) for b in blocks])
    if sizes.max() > BLOCK:
        raise ValueError(f"a block has at most {BLOCK} ids")
    order = np.argsort(-sizes, kind="stable")
    sizes, longest, lanes = sizes[order], int(sizes.max()), len(blocks)
    # Ids as ranks; two of rank 0 stand before each block, others behind the short ones.
    ranks = np.zeros((lanes, longest + 2), np.uint16)
    known, rank, present = [], np.zeros(1 << 16, np.uint16), np.zeros(1 << 16, bool)
    for row, n, b in zip(ranks, sizes.tolist(), order.tolist(), strict=True):
        small = blocks[b].astype(np.uint16)
        present[small] = True
        ids = present.nonzero()[0]
        present[ids] = False
        rank[ids] = np.arange(len(ids))
        row[2 : 2 + n] = rank.take(small)
        known.append(ids)
    models = Models(lanes)
    rest = np.zeros((lanes, longest), bool)
    starts, parts = np.zeros((longest, lanes), np.uint16), np.zeros((longest, lanes), np.uint16)
    for first, end, k in epochs(sizes):
        for some, case, start, part in models.learn(ranks[:k, first : end + 2]):
            rest[some, first:end] = case == 2
            starts[first:end, some], parts[first:end, some] = start.T, part.T
    # Order 0: how often it codes each rank of its block.
    table, heads = np.zeros((lanes, SLOTS), np.uint32), []
    for row, ids, own, out, n in zip(table, known, ranks, rest, sizes.tolist(), strict=True):
        counts = np.bincount(own[2 : 2 + n][out[:n]], minlength=len(ids))
        row[: len(ids)] = places(order_0(counts))
        heads.append(head(ids, counts))
    table = table.reshape(-1)
    coder = Encoder(lanes, longest + longest // 8 + 8)
    base = (np.arange(lanes) * SLOTS)[:, None]
    active = np.searchsorted(-sizes, -np.arange(longest), "left").tolist()
    for first in range(0, longest, LONG_EPOCH):
        end = min(first + LONG_EPOCH, longest)
        start, size = starts[first:end].astype(U), parts[first:end].astype(U)
        place = np.where(rest[:, first:end], table.take(ranks[:, first + 2 : end + 2] + base), EVERY).T
        zero_start, zero_size = (place & np.uint32(TOTAL - 1)).astype(U, "C"), (place >> np.uint32(BITS)).astype(U, "C")
        for i, k in enumerate(active[first:end]):
            coder.put(start[i, :k], size[i, :k], HALF)
            coder.put(zero_start[i, :k], zero_size[i, :k], ORDER_0)
    payloads = coder.finish()
    out = [b""] * lanes
    for i, b in enumerate(order.tolist()):
        out[b] = heads[i] + payloads[i]
    return out


def decode(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each payload, given how many there are."""
    if not payloads:
        return []
    size = np.array(sizes)
    order = np.argsort(-size, kind="stable")
    size, longest, lanes = size[order], int(size.max()), len(payloads)
    # Order 0: the rank of each of SLOTS parts, and the place of each rank.
    known, rest = [], []
    parts, table = np.zeros((lanes, SLOTS), np.uint16), np.zeros((lanes, SLOTS), np.uint32)
    for i, b in enumerate(order.tolist()):
        ids, counts, words = behead(payloads[b])
        bounds = order_0(counts)
        if not bounds[-1]:  # without ids, or damaged
            ids, bounds = np.zeros(1, np.uint32), np.array([0, SLOTS])
        parts[i] = np.repeat(np.arange(len(ids), dtype=np.uint16), np.diff(bounds))
        table[i, : len(ids)] = places(bounds)
        known.append(ids)
        rest.append(words)
    parts, table = parts.reshape(-1), table.reshape(-1)
    ranks = np.zeros((longest + 2, lanes), np.uint16)
    models, coder = Models(lanes), Decoder(rest)
    every, lane = np.arange(lanes) * SLOTS, np.arange(lanes) * PAIRS
    for first, end, k in epochs(size):
        base, row = every[:k], lane[:k]
        before, last = (ranks[first + j, :k] + base for j in range(2))
        for i in range(first + 2, end + 2):
            _, e2, e1, pair = models.predict(before, last)
            bounds = models.mixed.take(row + pair)
            above, outside = coder.case(bounds & MASK, bounds >> HALF)
            at = coder.peek(k, ORDER_0).view(np.int64)
            at += base
            now, hit = parts.take(at), ~outside
            np.copyto(e1, e2, where=~above)
            e1 &= RANK
            np.copyto(now, e1, where=hit)
            ranks[i, :k] = now
            before, last = last, base + now
            place = table.take(last)
            np.copyto(place, EVERY, where=hit)
            coder.take((place & np.uint32(TOTAL - 1)).astype(U), (place >> np.uint32(BITS)).astype(U))
        for _ in models.learn(np.ascontiguousarray(ranks[first : end + 2, :k].T)):
            pass
    out = [np.zeros(0, np.uint32)] * lanes
    for b, n, ids, own in zip(order.tolist(), size.tolist(), known, np.ascontiguousarray(ranks[2:].T), strict=True):
        out[b] = ids.take(own[:n], mode="clip")
    return out


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
