"""How many guesses a password takes: the cheapest way to split it into things people choose.

The guesses of a split are the product of its parts' guesses, so the smallest sum of logarithms
over all splits is found by dynamic programming from left to right.  Parts are common words, dates,
repeats, keyboard walks and single characters tried at random.
"""

from __future__ import annotations

from collections.abc import Iterable
from heapq import heappop, heappush
from itertools import product
from math import inf, log10

#: Words that are tried first, in this order.
COMMON = (
    "password 123456 qwerty admin welcome login letmein monkey dragon master hello freedom whatever trustno1 "
    "sunshine princess football baseball shadow superman batman michael jordan iloveyou secret abc123 test "
    "user root guest changeme default example sample pass token key private public temp demo none null true false "
    "required optional here your enter value string text field reset forgot new old change summer winter spring "
    "autumn monday friday love money computer internet server service system office company account access security "
    "apple orange flower cookie cheese pepper ginger silver golden purple yellow green black white"
).split()
#: What often stands for a letter.
LOOKALIKES = str.maketrans("@4301!5$7", "aaeoiisst")
#: The rows of a keyboard.
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")

_RANK = {word: rank for rank, word in enumerate(COMMON, 1)}
_PLACE = {c: (x + 0.5 * y, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
_NEAR = {
    a + b
    for (a, (ax, ay)), (b, (bx, by)) in product(_PLACE.items(), repeat=2)
    if a != b and abs(ax - bx) <= 1 and abs(ay - by) <= 1
}
#: A-Z in lower case; other letters stay, so that places do not shift.
_LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
#: Logarithm of the ways to order one more part.
_JOIN = log10(2)
_YEARS = 150


class Words:
    """Words by rank: the fixed ones first, then others in the order given."""

    def __init__(self, others: Iterable[str] = ()):
        self.rank = dict(_RANK)
        for word in others:
            self.rank.setdefault(word, len(self.rank) + 1)
        self.longest = max(map(len, self.rank))


_FIXED = Words()


class _Runs:
    """How far runs go from a place in a text.  What was found for one place serves all within the run."""

    def __init__(self, value: str, low: str):
        self.value, self.low = value, low
        self.repeats: dict[int, tuple[int, int]] = {}
        self.walk = (0, 0)

    def repeat_end(self, i: int, size: int) -> int:
        """Where the text stops to repeat itself after ``size`` characters, counted from ``i``."""
        begin, end = self.repeats.get(size, (0, 0))
        if not begin <= i < end:
            value, end, step = self.value, i, 16
            while step:  # ever larger pieces while they are alike, then ever smaller ones
                alike = value[end : end + step] == value[end + size : end + size + step] and end + size + step <= len(value)
                end, step = (end + step, step * 2) if alike else (end, step // 2)
                if not alike and step:
                    break
            while step:
                if end + size + step <= len(value) and value[end : end + step] == value[end + size : end + size + step]:
                    end += step
                else:
                    step //= 2
            self.repeats[size] = (i, end)
        return end

    def walk_end(self, i: int) -> int:
        """Where the walk over neighbouring keys from ``i`` ends."""
        begin, end = self.walk
        if not begin <= i < end:
            low, n, end = self.low, len(self.low), i + 1
            while end < n and low[end - 1 : end + 1] in _NEAR:
                end += 1
            self.walk = (i, end)
        return end


def _at_random(c: str) -> float:
    if c.isdigit():
        return 1.0
    return log10(26) if c.isalpha() and c.isascii() else log10(33)


def _date(text: str) -> float | None:
    """Guesses of a year, or of a day with its year; separators are allowed between the numbers."""
    digits = "".join(c for c in text if c not in "-/._")
    if not digits.isdigit() or not digits.isascii():
        return None
    if text == digits and len(digits) == 4 and 1900 <= int(digits) < 1900 + _YEARS:
        return log10(_YEARS)
    if len(digits) in (6, 8):
        year = len(digits) - 4
        for y, a, b in ((digits[:year], digits[year : year + 2], digits[year + 2 :]), (digits[4:], digits[:2], digits[2:4])):
            full = year == 2 or 1900 <= int(y) < 1900 + _YEARS
            if full and {1 <= int(a) <= 12 and 1 <= int(b) <= 31, 1 <= int(b) <= 12 and 1 <= int(a) <= 31} != {False}:
                return log10(365 * _YEARS)
    return None


def guess_cost(value: str, words: Words = _FIXED, enough: float = inf) -> float:
    """Base-10 logarithm of the guesses that ``value`` takes; infinite if it is ``enough`` or more.

    Places are taken from left to right, and only those that some split reaches for less than
    ``enough``; so a long value is given up as soon as none is left.
    """
    n = len(value)
    low = value.translate(_LOWER)
    plain = low.translate(LOOKALIKES)
    runs = _Runs(value, low)
    best = {0: 0.0}
    open_ = [0]

    def reach(j: int, cost: float) -> None:
        if cost < min(enough, best.get(j, inf)):
            if j not in best:
                heappush(open_, j)
            best[j] = cost

    while open_:
        i = heappop(open_)
        if i == n:
            break
        so_far = best[i]
        reach(i + 1, so_far + _at_random(value[i]))
        for j in range(i + 3, min(n, i + words.longest) + 1):
            for form, extra in ((low, 0.0), (plain, log10(4))):
                if (rank := words.rank.get(form[i:j])) is not None:
                    mixed = 0.0 if value[i:j] in (low[i:j], low[i:j].upper()) else log10(4)
                    reach(j, so_far + log10(rank + 1) + mixed + extra + _JOIN)
        for j in range(i + 4, min(n, i + 10) + 1):
            if (cost := _date(value[i:j])) is not None:
                reach(j, so_far + cost + _JOIN)
        for size in (1, 2, 3, 4):
            if i + size > n:
                break
            copies = 1 + (runs.repeat_end(i, size) - i) // size
            if size * copies > max(2, size):
                unit = sum(map(_at_random, value[i : i + size]))
                reach(i + size * copies, so_far + unit + log10(copies) + _JOIN)
                break
        j = runs.walk_end(i)
        if j - i >= 4:
            reach(j, so_far + log10(len(_PLACE) * (j - i) * 4) + _JOIN)
    return best.get(n, inf)
