"""Words of many texts at once, as places and 64-bit hashes in the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes handled by one round of array operations; keeps the arrays in cache.
PORTION = 1 << 18
#: Bytes of a word that are hashed eight at a time; longer words are hashed one by one.
LANES = 16
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_PRIMES, _BASES = ((1 << 31) - 1, (1 << 31) - 19), (1_103_515_245, 1_566_083_941)

#: Bytes that end a word: space, tab, line feed, vertical tab, form feed, carriage return.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: As BLANK, and all ASCII that is neither letter nor digit.
NOT_ALNUM = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = h ^ (h >> np.uint64(29))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def lane_hashes(lanes: np.ndarray, step: int, starts: np.ndarray, ends: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the units from each start to end.

    ``lanes[i]`` holds the ``step`` units from unit i on, ``masks[k]`` keeps the first k of them.  Each
    lane goes through a mixing that is no sum, so no pattern of units makes hashes meet; units of one
    lane and length never share a hash.
    """
    length = ends - starts
    h = mix(length.astype(np.uint64))
    rows, at, left = np.arange(len(starts)), starts, length
    while len(rows):
        h[rows] = mix(h[rows] ^ (lanes[at] & masks[np.minimum(left, step)]))
        more = left > step
        rows, at, left = rows[more], at[more] + step, left[more] - step
    return h


def digest(unit_bytes: bytes) -> int:
    """The hash of something too long for lanes."""
    return int.from_bytes(hashlib.blake2b(unit_bytes, digest_size=8).digest(), "little")


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    long = ends - starts > 8 * LANES
    hashes = np.zeros(len(starts), np.uint64)
    hashes[~long] = lane_hashes(lanes, 8, starts[~long], ends[~long], _MASKS)
    for i in np.flatnonzero(long).tolist():
        hashes[i] = digest(data[starts[i] : ends[i]].tobytes())
    return hashes


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
        done += more
    return out


def range_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the sequence of hashes in each range: polynomials modulo two primes, from running sums."""
    n = len(hashes)
    found = np.zeros((2, len(starts)), np.uint64)
    for k, (prime, base) in enumerate(zip(_PRIMES, _BASES, strict=True)):
        p = np.uint64(prime)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((hashes ^ hashes >> np.uint64(32)) % p * _powers(base, prime, n) % p, out=sums[1:])
        down = _powers(pow(base, -1, prime), prime, n + 1)
        found[k] = (sums[ends] - sums[starts]) % p * down[starts] % p
    return mix(mix(found[0] << np.uint64(32) | found[1]) + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of neighbouring rows of a column: ``first`` row, then for each word its place and hash.

    ``cuts`` has, for each text and the end, the number of its first word, and ``bounds`` its first byte.
    """

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    cuts: np.ndarray
    bounds: np.ndarray

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.cuts) - 1), np.diff(self.cuts))


def words_of(
    column: pa.Array, separators: np.ndarray = BLANK, lower: bool = False, portion: int = PORTION
) -> Iterator[Words]:
    """Portions of the column with their words; null and empty texts have none."""
    column = column.cast(pa.large_string())
    if lower:
        column = pc.utf8_lower(column)
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    everything = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    begin = 0
    while begin < n:
        end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + portion, "right")) - 1)
        end = min(end, n)
        part = everything[bounds[begin] : bounds[end]]
        yield _find(begin, part, bounds[begin : end + 1] - bounds[begin], separators)
        begin = end


def _find(first: int, data: np.ndarray, bounds: np.ndarray, separators: np.ndarray) -> Words:
    n = len(data)
    inside = ~separators[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    hashes = _word_hashes(data, starts, ends)
    return Words(first, data, starts, ends, hashes, np.searchsorted(starts, bounds), bounds)
