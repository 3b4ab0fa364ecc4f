"""Hamming distances of many fingerprints at once, on bit planes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LANES = 64
#: Planes counted between two looks at which blocks can still hold a match.
STRIDE = 12
#: (query, block) pairs counted together; keeps the counters in cache.
PAIRS = 1 << 15
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def planes_of(fingerprints: np.ndarray) -> np.ndarray:
    """Vertical form of ``[n, words]`` fingerprints: bit i of (b, t) is bit b of fingerprint ``64 t + i``."""
    n, words = fingerprints.shape
    blocks = -(-n // LANES)
    padded = np.zeros((blocks * LANES, words), np.uint64)
    padded[:n] = fingerprints
    bits = np.unpackbits(padded.view(np.uint8).reshape(blocks, LANES, 8 * words), axis=2, bitorder="little")
    packed = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64).reshape(64 * words, blocks)


def lanes_below(count: np.ndarray) -> np.ndarray:
    """Masks with the lowest ``count`` (0 to 64) lanes set."""
    count = count.astype(np.uint64)
    return np.where(count >= 64, _ONES, (np.uint64(1) << (count & np.uint64(63))) - np.uint64(1))


def within(
    planes: np.ndarray, block: np.ndarray, queries: np.ndarray, query: np.ndarray, allowed: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Which (query, block) pairs have allowed lanes at most ``radius`` bits away, and which lanes.

    ``query`` numbers rows of ``queries``.  Differing bits are added up for 64 lanes at a time:
    three planes go through a full adder, its sum and carry into bitwise counters.  A pair is
    abandoned once all its lanes are too far.
    """
    width = max(1, radius.bit_length())
    found: list[np.ndarray] = []
    masks: list[np.ndarray] = []

    def add(bits: np.ndarray, level: int, counters: list, alive: np.ndarray) -> None:
        for i in range(level, width):
            carry = counters[i] & bits
            counters[i] ^= bits
            bits = carry
        alive &= ~bits  # beyond the counters

    def differ(b: int, where: np.ndarray, asked: np.ndarray) -> np.ndarray:
        bit = (asked[:, b >> 6] >> np.uint64(b & 63)) & np.uint64(1)
        return planes[b][where] ^ (np.uint64(0) - bit)

    for begin in range(0, len(block), PAIRS):
        pair = np.arange(begin, min(begin + PAIRS, len(block)))
        pair = pair[allowed[pair] != 0]
        where, asked, alive = block[pair], queries[query[pair]], allowed[pair].copy()
        counters = [np.zeros(len(pair), np.uint64) for _ in range(width)]
        last = len(planes) - 2
        for b in range(0, last, 3):
            x, y, z = (differ(b + i, where, asked) for i in range(3))
            half = x ^ y
            add(half ^ z, 0, counters, alive)
            add((x & y) | (half & z), 1, counters, alive)
            if b % STRIDE == STRIDE - 3:
                alive &= ~_exceeds(counters, radius)
                stay = alive != 0
                if not stay.all():
                    pair, where, asked, alive = pair[stay], where[stay], asked[stay], alive[stay]
                    counters = [c[stay] for c in counters]
            if not len(pair):
                break
        if len(pair):
            for b in range(last - last % -3, len(planes)):
                add(differ(b, where, asked), 0, counters, alive)
            alive &= ~_exceeds(counters, radius)
            stay = alive != 0
            found.append(pair[stay])
            masks.append(alive[stay])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(found), np.concatenate(masks)


def _exceeds(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is larger than ``radius``."""
    larger = np.zeros(len(counters[0]), np.uint64)
    equal = np.full(len(counters[0]), _ONES)
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            equal &= counters[i]
        else:
            larger |= equal & counters[i]
            equal &= ~counters[i]
    return larger


def set_lanes(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and lane of every set bit."""
    bits = np.unpackbits(masks.view(np.uint8).reshape(len(masks), 8), axis=1, bitorder="little")
    return np.nonzero(bits)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each of ``n`` rows is connected to."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], least)
        np.minimum.at(root, root[b], least)
        while not np.array_equal(root, again := root[root]):
            root = again
        if np.array_equal(root[a], root[b]):
            return root


def near_pairs(
    fingerprints: np.ndarray, bucket_ends: np.ndarray, radius: int, together: int = 1 << 20
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows ``a < b`` of one bucket at most ``radius`` bits apart; buckets are neighbouring rows.

    ``bucket_ends`` has, for each row, the end of its bucket.  About ``together`` blocks of rows are
    compared at a time.
    """
    planes = planes_of(fingerprints)
    rows = np.arange(len(fingerprints))
    each = (bucket_ends - 1) // LANES - rows // LANES + 1
    portion = (np.cumsum(each) - 1) // together
    for some in np.split(rows, np.flatnonzero(np.diff(portion)) + 1):
        count = each[some]
        query = np.repeat(some, count)
        block = query // LANES + np.arange(len(query)) - np.repeat(np.cumsum(count) - count, count)
        base = block * LANES
        lanes = lanes_below(np.clip(bucket_ends[query] - base, 0, LANES)) & ~lanes_below(
            np.clip(query + 1 - base, 0, LANES)
        )
        pairs, masks = within(planes, block, fingerprints, query, lanes, radius)
        row, lane = set_lanes(masks)
        yield query[pairs[row]], block[pairs[row]] * LANES + lane


def linked(fingerprints: np.ndarray, bucket_ends: np.ndarray, radius: int) -> np.ndarray:
    """Root row of each fingerprint among those of its bucket."""
    found = list(near_pairs(fingerprints, bucket_ends, radius))
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    return _roots(len(fingerprints), a, b)


def linked_by_search(fingerprints: np.ndarray, radius: int, together: int = 256) -> np.ndarray:
    """As ``linked`` for one large bucket: breadth first, so that what is reached is asked for no more."""
    root = np.full(len(fingerprints), -1)
    left = np.arange(len(fingerprints))
    while len(left):
        seed, left = left[0], left[1:]
        root[seed] = seed
        frontier = np.array([seed])
        while len(frontier) and len(left):
            now, frontier = frontier[:together], frontier[together:]
            planes = planes_of(fingerprints[left])
            blocks = planes.shape[1]
            query = np.repeat(now, blocks)
            block = np.tile(np.arange(blocks), len(now))
            lanes = lanes_below(np.clip(len(left) - block * LANES, 0, LANES))
            pairs, masks = within(planes, block, fingerprints, query, lanes, radius)
            row, lane = set_lanes(masks)
            reached = np.unique(block[pairs[row]] * LANES + lane)
            root[left[reached]] = seed
            frontier = np.append(frontier, left[reached])
            left = np.delete(left, reached)
    return root
