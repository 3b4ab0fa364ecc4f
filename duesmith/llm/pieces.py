"""Pre-tokens of byte-level BPE over many texts at once, and their token ids.

A text is cut into the pre-tokens that the published pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` describes.
Here the cuts come from runs of character classes, computed for a whole portion of texts with
array operations.  Each pre-token is looked up by a 64-bit hash; those that the table lacks go to
the tokenizer library, once for each worker as long as the table holds them.
"""

from __future__ import annotations

import functools
import os
import unicodedata
from dataclasses import dataclass

import numpy as np
from tokenizers import Tokenizer

from duesmith.llm.common import in_portions
from duesmith.llm.words import digest, lane_hashes

# Spark runs a worker for each core; more threads below it would only cost memory.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LETTER, NUMBER, SPACE, OTHER = range(4)
#: The code points with the Unicode property White_Space.
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
#: Characters handled by one round of array operations; keeps the arrays in cache.
PORTION = 200_000
#: Slots of the table of known pre-tokens; it is emptied when half of them are taken.
SLOTS_LOG2 = 21
#: Code points of a piece that are hashed two at a time; longer pieces are hashed one by one.
LONG_PIECE = 64
_MASKS = np.array([0, (1 << 32) - 1, (1 << 64) - 1], np.uint64)


@functools.cache
def _classes() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        first = unicodedata.category(chr(point))[0]
        if first == "L":
            kinds[point] = LETTER
        elif first == "N":
            kinds[point] = NUMBER
    kinds[WHITE_SPACE] = SPACE
    return kinds


def piece_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in the joined code points of several non-empty texts."""
    n = len(points)
    kinds = _classes()[points]
    first = np.zeros(n + 1, bool)
    first[text_starts] = True
    first[n] = True
    run = first[:n].copy()
    run[1:] |= kinds[1:] != kinds[:-1]
    white = kinds == SPACE
    before_word = np.zeros(n, bool)
    before_word[:-1] = ~white[1:] & ~first[1:n]
    start = run | (white & before_word)
    glued = np.zeros(n, bool)
    glued[1:] = run[1:] & ~white[1:] & (points[:-1] == 32) & ~first[1:n]
    start &= ~glued

    marks = np.flatnonzero((points == 39) & start)
    marks = marks[marks + 1 < n]
    marks = marks[(kinds[marks + 1] == LETTER) & ~first[marks + 1]]
    if len(marks):
        one = points[marks + 1]
        after = np.minimum(marks + 2, n - 1)
        two = np.where((marks + 2 < n) & ~first[marks + 2], points[after], 0)
        length = np.where(np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
        for a, b in ("re", "ve", "ll"):
            length = np.where((one == ord(a)) & (two == ord(b)), 3, length)
        marks, length = marks[length > 0], length[length > 0]
        start[marks + 1] = False
        ends = marks + length
        start[ends[ends < n]] = True
    return np.flatnonzero(start)


def piece_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece's code points and length; never 0."""
    padded = np.concatenate([points.astype("<u4"), np.zeros(2, "<u4")])
    lanes = np.ndarray((len(points) + 1,), "<u8", padded, strides=(4,))
    long = ends - starts > LONG_PIECE
    h = np.zeros(len(starts), np.uint64)
    h[~long] = lane_hashes(lanes, 2, starts[~long], ends[~long], _MASKS)
    for i in np.flatnonzero(long).tolist():
        h[i] = digest(padded[starts[i] : ends[i]].tobytes())
    h[h == 0] = 1
    return h


@dataclass(frozen=True)
class WholeTokens:
    """Vocabulary strings that are one pre-token and encode alone as one token."""

    hashes: np.ndarray
    ids: np.ndarray


def prove_whole_tokens(tokenizer_path: str) -> WholeTokens:
    """Check every vocabulary string against the library, once, before any text is read."""
    tokenizer = Tokenizer.from_file(tokenizer_path)
    special = {added.content for added in tokenizer.get_added_tokens_decoder().values()}
    ids = [i for token, i in tokenizer.get_vocab().items() if token not in special]
    texts = tokenizer.decode_batch([[i] for i in ids])
    proven = [
        (text, i)
        for text, i, encoded in zip(
            texts, ids, tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True
        )
        if text and encoded.ids == [i]
    ]
    points, bounds = _joined([text for text, _ in proven])
    starts = piece_starts(points, bounds[:-1])
    ends = np.append(starts[1:], len(points))
    # A string that is cut further would never be looked up whole.
    whole = np.isin(starts, bounds[:-1]) & np.isin(ends, bounds[1:])
    of_start = dict(zip(bounds[:-1].tolist(), [i for _, i in proven], strict=True))
    starts, ends = starts[whole], ends[whole]
    return WholeTokens(
        piece_hashes(points, starts, ends), np.array([of_start[s] for s in starts.tolist()], np.uint32)
    )


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(text) for text in texts], out=bounds[1:])
    return points, bounds


class PieceEncoder:
    """Token ids of whole texts: known pre-tokens by table, the rest by the library."""

    def __init__(self, tokenizer_path: str, whole: WholeTokens):
        self._tokenizer = Tokenizer.from_file(tokenizer_path)
        self._special = [added.content for added in self._tokenizer.get_added_tokens_decoder().values()]
        self._whole = whole
        self._clear()

    def _clear(self) -> None:
        slots = 1 << SLOTS_LOG2
        self._keys = np.zeros(slots, np.uint64)
        self._offset = np.zeros(slots, np.int64)
        self._length = np.zeros(slots, np.int32)
        self._pool = np.zeros(1 << 20, np.uint32)
        self._pooled = self._held = 0
        n = len(self._whole.ids)
        self._insert(self._whole.hashes, np.ones(n, np.int64), self._whole.ids)

    def _insert(self, hashes: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        """New, distinct hashes."""
        need = self._pooled + len(ids)
        if need > len(self._pool):
            self._pool = np.concatenate([self._pool, np.zeros(max(need, len(self._pool)), np.uint32)])
        self._pool[self._pooled : need] = ids
        offsets = self._pooled + np.cumsum(lengths) - lengths
        self._pooled = need
        self._held += len(hashes)
        slot = (hashes >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            at = slot[left]
            free = self._keys[at] == 0
            rows, at = left[free], at[free]
            self._keys[at] = hashes[rows]  # of several rows for one slot, one stays
            won = self._keys[at] == hashes[rows]
            self._offset[at[won]] = offsets[rows[won]]
            self._length[at[won]] = lengths[rows[won]]
            lost = np.ones(len(hashes), bool)
            lost[rows[won]] = False
            left = left[lost[left]]
            slot[left] = (slot[left] + 1) & ((1 << SLOTS_LOG2) - 1)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash, -1 where it is not known."""
        slot = (hashes >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)
        found = np.full(len(hashes), -1, np.int64)
        left = np.arange(len(hashes))
        while len(left):
            at = slot[left]
            keys = self._keys[at]
            hit = keys == hashes[left]
            found[left[hit]] = at[hit]
            left = left[~hit & (keys != 0)]
            slot[left] = (slot[left] + 1) & ((1 << SLOTS_LOG2) - 1)
        return found

    def _learn(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        hashes, rows = np.unique(hashes, return_index=True)
        text = points.tobytes()
        pieces = [
            text[4 * s : 4 * e].decode("utf-32-le", "surrogatepass")
            for s, e in zip(starts[rows].tolist(), ends[rows].tolist(), strict=True)
        ]
        encoded = [e.ids for e in self._tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        lengths = np.array([len(ids) for ids in encoded], np.int64)
        self._insert(hashes, lengths, np.array([i for ids in encoded for i in ids], np.uint32))

    def _portion(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the pre-tokens of several texts: slots, and the number of them in each text."""
        points, bounds = _joined(texts)
        if not len(points):
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64), points
        starts = piece_starts(points, bounds[:-1][bounds[:-1] < bounds[1:]])
        ends = np.append(starts[1:], len(points))
        hashes = piece_hashes(points, starts, ends)
        slots = self._find(hashes)
        new = slots < 0
        if new.any():
            if self._held + np.count_nonzero(new) > 1 << (SLOTS_LOG2 - 1):
                self._clear()
                new = self._find(hashes) < 0
            self._learn(points, starts[new], ends[new], hashes[new])
            slots = self._find(hashes)
        return slots, np.searchsorted(starts, bounds), points

    def _has_special(self, text: str) -> bool:
        return any(content in text for content in self._special)

    def counts(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text."""
        result: list[int] = []
        for begin, end in in_portions([len(text) for text in texts], PORTION):
            part = texts[begin:end]
            odd = {i for i, text in enumerate(part) if self._has_special(text)}
            slots, cuts, _ = self._portion(["" if i in odd else text for i, text in enumerate(part)])
            sums = np.zeros(len(slots) + 1, np.int64)
            np.cumsum(self._length[slots], out=sums[1:])
            numbers = (sums[cuts[1:]] - sums[cuts[:-1]]).tolist()
            for i in odd:
                numbers[i] = len(self._tokenizer.encode(part[i], add_special_tokens=False).ids)
            result += numbers
        return result

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The token ids of each text."""
        result: list[np.ndarray] = []
        for begin, end in in_portions([len(text) for text in texts], PORTION):
            part = texts[begin:end]
            odd = {i for i, text in enumerate(part) if self._has_special(text)}
            slots, cuts, _ = self._portion(["" if i in odd else text for i, text in enumerate(part)])
            lengths = self._length[slots].astype(np.int64)
            sums = np.zeros(len(slots) + 1, np.int64)
            np.cumsum(lengths, out=sums[1:])
            shift = np.repeat(self._offset[slots] - sums[:-1], lengths)
            flat = self._pool[shift + np.arange(sums[-1])]
            ends = sums[cuts]
            for i in range(len(part)):
                if i in odd:
                    ids = self._tokenizer.encode(part[i], add_special_tokens=False).ids
                    result.append(np.array(ids, np.uint32))
                else:
                    result.append(flat[ends[i] : ends[i + 1]])
        return result


_encoders: dict[str, PieceEncoder] = {}


def encoder(tokenizer_path: str, whole: WholeTokens) -> PieceEncoder:
    """One encoder for each worker process, so that later tasks find its table filled."""
    if tokenizer_path not in _encoders:
        _encoders[tokenizer_path] = PieceEncoder(tokenizer_path, whole)
    return _encoders[tokenizer_path]
