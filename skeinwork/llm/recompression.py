"""Grammar symbols of texts by recompression, and content-defined sampling points on top of them.

Recompression renames a string in rounds. A round first replaces runs of one symbol by a run symbol, then, after parting
all symbols into left and right ones, every left symbol followed by a right one by a pair symbol. Names are 64-bit hashes
of what they replace and the sides are hash bits, so equal substrings get equal symbols everywhere, in whatever
partition they stand, but for a few symbols at their ends: naming is global without any exchange between tasks.

All work is on flat arrays of many texts at once.
"""

from __future__ import annotations

import numpy as np

#: No symbol grows beyond so many characters, which bounds what a shared stretch loses at its ends.
CAP = 16
LEVELS = 6
#: Runs are replaced in the first rounds only; longer repetitions stay as equal symbols in a row.
RUN_LEVELS = 3
#: Every window of so many characters holds a sampling point.
WINDOW = 64

_U = np.uint64
_MIX = (_U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB))
_BASE = _U(0x9E3779B97F4A7C15)
#: Bases of the polynomials by seed, and their inverses.
_BASES = {1: 0x9E3779B97F4A7C15, 2: 0xC2B2AE3D27D4EB4F, 3: 0x165667B19E3779F9}


def _cap(level: int) -> int:
    return min(CAP, 2**level)


def lost_at_an_end() -> int:
    """Characters of a shared stretch, at either end, whose symbols may depend on what is outside of it.

    A round loses at most one cut run and one symbol that pairs outwards.
    """
    lost, size = 0, 1
    for level in range(1, LEVELS + 1):
        if level <= RUN_LEVELS:
            lost, size = lost + _cap(level), _cap(level)
        lost, size = lost + size, _cap(level)
    return lost


def reach() -> int:
    """The first sampling point common to two equal stretches is less than so many characters after their start."""
    return lost_at_an_end() + WINDOW


def run_size(stretch: int) -> int:
    """Characters that a run may fill to lie whole inside of every stretch of that length, where symbols are its own."""
    return stretch - reach() - lost_at_an_end()


def shortest_stretch() -> int:
    """Stretches must be as long as this to be sure of a common run of two symbols or more."""
    return reach() + lost_at_an_end() + 3 * CAP


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every element."""
    x = x * _MIX[0]
    x ^= x >> _U(32)
    x *= _MIX[1]
    x ^= x >> _U(29)
    return x


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def symbols(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and first positions of the symbols of the last level. starts: where a text begins; none spans two texts."""
    name = mix(codes.astype(_U) + _U(0x51))
    pos = np.arange(len(codes), dtype=np.int64 if len(codes) >= 2**31 else np.int32)
    first = np.zeros(len(codes), dtype=bool)
    first[starts[starts < len(codes)]] = True
    for level in range(1, LEVELS + 1):
        if len(name) < 2:
            break
        size = np.diff(pos, append=pos.dtype.type(len(codes)))
        if level <= RUN_LEVELS:
            same = name[1:] == name[:-1]
            same &= ~first[1:]
            if same.any():
                head = np.flatnonzero(np.concatenate(([True], ~same)))
                count = np.diff(head, append=len(name))
                fits = (count > 1) & (count * size[head] <= _cap(level))
                at = head[fits]
                name[at] = mix(name[at] + count[fits].astype(_U) * _BASE)
                keep = np.concatenate(([True], ~same)) | np.repeat(~fits, count)
                name, pos, first = name[keep], pos[keep], first[keep]
                size = np.diff(pos, append=pos.dtype.type(len(codes)))
        left = ((name * _U((0xD1342543DE82EF95 * (2 * level + 1)) % 2**64)) >> _U(63)).astype(bool)
        pair = left[:-1] & ~left[1:]
        pair &= ~first[1:]
        pair &= (size[:-1] + size[1:]) <= _cap(level)
        at = np.flatnonzero(pair)
        name[at] = mix(name[at] * _BASE + name[at + 1])
        keep = np.ones(len(name), dtype=bool)
        keep[at + 1] = False
        name, pos, first = name[keep], pos[keep], first[keep]
    return name, pos


def run_names(codes: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, name) of the last, highest symbols: runs of symbols from every sampling point on that fill `size` characters.

    A run ends with the last symbol that ends within `size` characters of the point, so it has more than size - CAP of them. Equal
    stretches give equal runs, whatever is around them, from lost_at_an_end() characters inside on.
    """
    name, pos = symbols(codes, starts)
    at = _least(name, pos, len(codes))
    at = at[pos[at] + size <= len(codes)]
    end = np.searchsorted(np.append(pos, len(codes)), pos[at] + size, side="right") - 1
    return pos[at].astype(np.int64), WindowHash(name, 3)(at, end - at)


def sampling_points(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Symbol starts whose name is the least of some window of WINDOW characters."""
    name, pos = symbols(codes, starts)
    return pos[_least(name, pos, len(codes))].astype(np.int64)


def _least(name: np.ndarray, pos: np.ndarray, length: int) -> np.ndarray:
    """Which symbols have the least name of some window of WINDOW characters."""
    if length < WINDOW:
        return np.arange(len(pos))
    top = np.iinfo(np.uint32).max
    value = np.full(length + WINDOW - 1, top, dtype=np.uint32)  # the last windows reach past the end
    value[pos] = np.minimum((name >> _U(32)).astype(np.uint32), top - 1)
    least = _slide(value, np.minimum)  # least[x] is that of the window from x
    most = _slide(np.concatenate((np.zeros(WINDOW - 1, dtype=np.uint32), least)), np.maximum)  # over all windows that hold p
    return np.flatnonzero(most[pos] == value[pos])


def _slide(x: np.ndarray, op) -> np.ndarray:
    step = 1
    while step < WINDOW:
        x = op(x[:-step], x[step:])
        step *= 2
    return x


class WindowHash:
    """64-bit names of any window of one array of code points or symbols, by prefix sums of a polynomial modulo 2**64; a seed has its own base."""

    def __init__(self, codes: np.ndarray, seed: int = 1):
        power = np.full(len(codes) + 1, _BASES[seed], dtype=_U)
        power[0] = 1
        inverse = np.full(len(codes) + 1, pow(_BASES[seed], -1, 2**64), dtype=_U)
        inverse[0] = 1
        self.inverse = np.multiply.accumulate(inverse)
        self.sums = np.zeros(len(codes) + 1, dtype=_U)
        np.cumsum(mix(codes.astype(_U) + _U(0x1000003 * seed)) * np.multiply.accumulate(power)[:-1], out=self.sums[1:])

    def __call__(self, at: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        return mix((self.sums[at + size] - self.sums[at]) * self.inverse[at]).view(np.int64)
