"""Words, lines and windows of many texts at once, as numpy arrays.

The bytes of a chunk are joined by one separator and hashed by a polynomial whose
prefix sums give the hash of any stretch in constant time.  The polynomial is taken modulo
the prime 2**61 - 1: modulo a power of two, texts of a regular build such as the Thue-Morse
word and its complement have one hash whatever the base.  Sums modulo 2**64 are only used
to deal out short grams.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Space, tab, line feed, vertical tab, form feed and carriage return.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Every ASCII byte that is neither a letter nor a digit.
NOT_WORD = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])

PRIME = np.uint64((1 << 61) - 1)
PRIME_BASE = 0x1B5F3C6D9A4E2871
#: Sums of products of a byte and a limb of LIMB bits fit 63 bits for so many bytes;
#: beyond, powers have three limbs of SHORT bits.
LIMB, SHORT, LIMB_BYTES = 31, 21, 1 << 22
#: Stretches that are hashed at a time, few enough to stay in a core's cache.
BLOCK = 1 << 14
STEP = 1 << 12


def _reduced(x: np.ndarray) -> np.ndarray:
    """Values below 2**63 modulo the prime."""
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of values below the prime, modulo the prime."""
    low = np.uint64((1 << 32) - 1)
    a1, a0, b1, b0 = a >> np.uint64(32), a & low, b >> np.uint64(32), b & low
    cross, least = a1 * b0 + a0 * b1, a0 * b0
    return _reduced(
        (a1 * b1 << np.uint64(3))
        + (cross >> np.uint64(29))
        + ((cross & np.uint64((1 << 29) - 1)) << np.uint64(32))
        + (least & PRIME)
        + (least >> np.uint64(61))
    )


def _steps(base: int, n: int) -> np.ndarray:
    return np.array([pow(base, i, int(PRIME)) for i in range(n)], np.uint64)


_near, _far = _steps(pow(PRIME_BASE, -1, int(PRIME)), STEP), np.ones(1, np.uint64)


def inverse_powers(at: np.ndarray) -> np.ndarray:
    """The inverse of the prime base to the given powers."""
    global _far
    most = int(at.max(initial=0)) // STEP + 1
    if len(_far) < most:
        _far = _steps(pow(PRIME_BASE, -STEP, int(PRIME)), most + 256)
    return times(_near[at % STEP], _far[at // STEP])


# Powers of the prime base, their low and high limbs; grown as long texts come.
_low, _high = np.ones(1, np.uint32), np.zeros(1, np.uint32)


def prime_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Low and high limbs of the first n powers of the prime base."""
    global _low, _high
    if len(_low) < n:
        size = max(n + n // 4, 1 << 16)
        low, high = np.empty(size, np.uint32), np.empty(size, np.uint32)
        near = np.array([pow(PRIME_BASE, i, int(PRIME)) for i in range(BLOCK)], np.uint64)
        step, at = pow(PRIME_BASE, BLOCK, int(PRIME)), 1
        for i in range(0, size, BLOCK):
            part = times(near, np.uint64(at))[: size - i]
            low[i : i + BLOCK], high[i : i + BLOCK] = part & np.uint64((1 << LIMB) - 1), part >> np.uint64(LIMB)
            at = at * step % int(PRIME)
        _low, _high = low, high
    return _low[:n], _high[:n]


_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, 1 << 16)
        for name, base in (("_powers", BASE), ("_inverses", INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers[:n], _inverses[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Text:
    """Texts joined by ``joint``; ``at`` holds where each begins, one more at the end."""

    def __init__(self, raw: list[bytes], joint: bytes = b" ") -> None:
        self.n = len(raw)
        self.buffer = joint.join(raw) + joint
        self.bytes = np.frombuffer(self.buffer, np.uint8)
        self.sizes = np.fromiter(map(len, raw), np.int64, self.n)
        self.at = np.concatenate([[0], np.cumsum(self.sizes + 1)])
        self._sums = self._limbs = None

    @property
    def sums(self) -> np.ndarray:
        """Prefix sums modulo 2**64, fit for short grams."""
        if self._sums is None:
            power, _ = powers(len(self.bytes))
            sums = np.empty(len(self.bytes) + 1, np.uint64)
            sums[0] = 0
            np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * power, out=sums[1:])
            self._sums = sums
        return self._sums

    @property
    def limbs(self) -> list[tuple[np.uint64, np.ndarray]]:
        """(weight, prefix sums) of the bytes times each limb of the prime's powers."""
        if self._limbs is None:
            low, high = prime_powers(len(self.bytes))
            value = self.bytes.astype(np.uint16) + np.uint16(1)
            if len(value) <= LIMB_BYTES:
                parts = [(0, low), (LIMB, high)]
            else:
                power, mask = high.astype(np.uint64) << np.uint64(LIMB) | low, np.uint64((1 << SHORT) - 1)
                parts = [(n * SHORT, power >> np.uint64(n * SHORT) & mask) for n in range(3)]
            self._limbs = []
            for bits, limb in parts:
                sums = np.zeros(len(value) + 1, np.uint64)
                np.multiply(limb, value, out=sums[1:], dtype=np.uint64)
                np.cumsum(sums, out=sums)
                self._limbs.append((np.uint64(1 << bits), sums))
        return self._limbs

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from each start to each end."""
        start, end = np.asarray(start), np.asarray(end)
        out = np.empty(len(start), np.uint64)
        for i in range(0, len(start), BLOCK):
            a, b = start[i : i + BLOCK], end[i : i + BLOCK]
            total = np.zeros(len(a), np.uint64)
            for weight, sums in self.limbs:
                part = _reduced(sums[b] - sums[a])
                total += part if weight == 1 else times(part, weight)
            h = times(_reduced(total), inverse_powers(a))
            out[i : i + BLOCK] = mix(h ^ ((b - a).astype(np.uint64) << np.uint64(48)))
        return out

    def stretches(self, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs without a separator."""
        out = np.ones(len(self.bytes) + 1, bool)
        out[1:] = separator[self.bytes]
        edges = np.flatnonzero(out[1:] != out[:-1])
        return edges[0::2], edges[1::2]

    def owner(self, position: np.ndarray) -> np.ndarray:
        """The text that each position lies in."""
        return np.searchsorted(self.at, position, "right") - 1

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many of the flagged bytes each text has."""
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[np.minimum(self.at[1:], len(flags))] - sums[self.at[:-1]]


def windows(h: np.ndarray, owner: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the runs of k neighbours that have one owner."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    power, _ = powers(k + 1)
    w = np.zeros(n, np.uint64)
    for j in range(k):
        w += h[j : j + n] * power[k - j]
    at = np.flatnonzero(owner[:n] == owner[k - 1 :])
    return at, mix(w[at])


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it is found twice or more, and whether an earlier one is equal."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return twice, later


def owned(h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within one owner."""
    return mix(h ^ mix(owner.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)))
