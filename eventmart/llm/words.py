"""Words and n-grams of a whole Arrow text column at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from eventmart.llm.common import bytes_of

#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing: 0-9, a-z, all of UTF-8 beyond ASCII.
PLAIN = np.array([b >= 0x80 or chr(b).isdigit() or chr(b).isalpha() for b in range(256)])
#: Bytes of words `[^\x20\x09-\x0D]+`.
SPACED = np.array([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}
#: Powers that a worker keeps; those beyond, for a longer text, are made when they are needed.
KEPT_POWERS = 1 << 21


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2 ** 64, up to KEPT_POWERS kept between calls."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps, out=steps)
        if n <= KEPT_POWERS:
            _powers[int(base)] = have
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """h with h[j] - h[i] == sum(byte_value[data[t]] * base ** t for i <= t < j). Only for strings of some hundred bytes:
    such sums modulo 2 ** 64 agree for certain pairs of strings of 1,024 bytes, whatever the base."""
    h = np.zeros(len(data) + 1, np.uint64)
    np.take(_BYTE, data, out=h[1:])
    h[1:] *= powers(_BASE, len(data))
    np.cumsum(h[1:], out=h[1:])
    return h


def span_hash(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[starts:ends], the same wherever the span lies. h: prefix_hash(data)."""
    return mixed((h[ends] - h[starts]) * powers(_BACK, len(h))[starts] + (ends - starts).astype(np.uint64))


def chunks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans data[starts:ends] in numbers of 8 bytes, the last one filled up with zeros: the numbers, the place of
    each within its span, and the first of each span. An empty span has one number, 0."""
    size = ends - starts
    n = np.maximum(1, (size + 7) >> 3)
    first = np.cumsum(n) - n
    place = np.arange(int(n.sum())) - np.repeat(first, n)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))  # the number that begins at each byte
    out = words[np.repeat(starts, n) + 8 * place].astype(np.uint64)
    last = first + n - 1
    rest = size - 8 * (n - 1)  # bytes of the last number
    out[last] &= np.where(rest >= 8, np.uint64((1 << 64) - 1), (np.uint64(1) << (np.uint64(8) * np.minimum(rest, 7).astype(np.uint64))) - np.uint64(1))
    return out, place, first


def string_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of data[starts:ends]: sums of mixed values of 8 bytes and their place, so that no two strings agree
    by their form. Another seed gives an independent hash."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    value, place, first = chunks(data, starts, ends)
    salt = mixed(place.astype(np.uint64) * _BASE + np.uint64(2 * seed + 1))
    value = mixed((mixed(value ^ salt) + salt) ^ (salt >> np.uint64(7)))
    return mixed(np.add.reduceat(value, first) + mixed((ends - starts).astype(np.uint64) + np.uint64(seed)))


def same_strings(data: np.ndarray, starts: np.ndarray, other: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether data[starts : starts + sizes] equals other[places : places + sizes], byte by byte."""
    if not len(starts):
        return np.zeros(0, bool)
    a, _, first = chunks(data, starts, starts + sizes)
    return np.logical_and.reduceat(a == chunks(other, places, places + sizes)[0], first)


#: The prime 2 ** 61 - 1 of sums over lines, which repeat as no power of two does.
PRIME = np.uint64((1 << 61) - 1)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, of values below it."""
    low, high, mask = a & np.uint64(0x7FFFFFFF), a >> np.uint64(31), np.uint64((1 << 30) - 1)
    c, d = b & np.uint64(0x7FFFFFFF), b >> np.uint64(31)
    middle = low * d + high * c  # below 2 ** 62
    out = high * d * np.uint64(2) + (middle >> np.uint64(30)) + ((middle & mask) << np.uint64(31)) + low * c
    return _reduced(out)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def _prime_powers(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo PRIME, by doubling."""
    out, done = np.ones(n, np.uint64), 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = _product(out[:more], np.uint64(pow(base, done, int(PRIME))))
        done += more
    return out


class Sequences:
    """Hashes of stretches of a sequence of 64-bit values: polynomials modulo PRIME, values and base mixed by a seed."""

    def __init__(self, values: np.ndarray, seed: int = 0):
        base = int(mixed(np.array([2 * seed + 5], np.uint64))[0] % PRIME)
        self.back = _prime_powers(pow(base, -1, int(PRIME)), len(values) + 1)
        terms = _product(_reduced(mixed(values ^ mixed(np.array([seed], np.uint64)))), _prime_powers(base, len(values)))
        # halves of 31 bits are summed apart, for up to 2 ** 32 values
        low, high = (np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)]) for x in (terms & np.uint64(0x7FFFFFFF), terms >> np.uint64(31)))
        self.sums = _reduced(_reduced(low) + _product(_reduced(high), np.uint64(1 << 31)))

    def hash(self, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Of values[first:stop], the same wherever the stretch lies."""
        moved = _product(_reduced(self.sums[stop] + PRIME - self.sums[first]), self.back[first])
        return mixed(moved + mixed((stop - first).astype(np.uint64)))


class Words:
    """The words of a column without nulls: byte places, row bounds and hashes.

    data: lower-cased bytes; starts, ends: of each word; rows: first word of each row (one more than
    rows); hash: of each word, 64 bits.
    """

    def __init__(self, column: pa.Array, letters: np.ndarray = PLAIN):
        raw, offsets = bytes_of(column)
        self.data = _LOWER[raw]
        mask = letters[self.data]
        before, after = np.zeros(len(mask) + 1, bool), np.zeros(len(mask) + 1, bool)
        before[1:] = mask
        before[offsets] = False
        after[:-1] = mask
        after[offsets] = False
        self.starts = np.flatnonzero(mask & ~before[:-1])
        self.ends = np.flatnonzero(mask & ~after[1:]) + 1
        self.offsets, self.rows = offsets, np.searchsorted(self.starts, offsets)
        self.hash = string_hash(self.data, self.starts, self.ends)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))

    def strings(self, which: np.ndarray) -> list[str]:
        data = self.data.tobytes()
        return [data[s:e].decode() for s, e in zip(self.starts[which].tolist(), self.ends[which].tolist(), strict=True)]


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive values (across rows too; the caller keeps those within a row)."""
    size = max(0, len(hashes) - n + 1)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = (out + hashes[k : k + size]) * _BASE
    return mixed(out)
