"""Bounded edit distances of many short texts at once, and keys that texts within a few edits share."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_INVERSES = np.array([pow(0x9E3779B97F4A7C15, -k, 2**64) for k in range(4)], dtype=_U)
_MIX = (_U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB))
#: Texts up to so many letters are keyed by what is left of them after so many deletions; longer ones by their parts.
DELETION_LETTERS = {0: 32, 1: 32, 2: 32, 3: 16}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _MIX[0]
    x = (x ^ (x >> _U(29))) * _MIX[1]
    return x ^ (x >> _U(32))


def codes(texts: list[str], width: int, fill: int) -> np.ndarray:
    flat = np.frombuffer("".join(t.ljust(width, "\0") for t in texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(texts), width)
    return np.where(np.arange(width) < np.array([len(t) for t in texts])[:, None], flat, _U(fill)).astype(np.uint32)


def osa(left: list[str], right: list[str], most: int) -> np.ndarray:
    """Edits between left[i] and right[i], exchanges of neighbours included (optimal string alignment); most + 1 if more than `most`.

    Pairs are handled together by size, and of each table only the band of `most` cells around the diagonal.
    """
    out = np.full(len(left), most + 1, dtype=np.int32)
    n, m = np.array([len(x) for x in left], dtype=np.int64), np.array([len(x) for x in right], dtype=np.int64)
    able = np.flatnonzero(np.abs(n - m) <= most)
    sizes = np.maximum(n[able], m[able])
    for k in np.unique(sizes):
        pick = able[sizes == k]
        out[pick] = _osa_of_a_size([left[i] for i in pick], [right[i] for i in pick], n[pick], m[pick], int(k), most)
    return out


def _osa_of_a_size(left: list[str], right: list[str], n: np.ndarray, m: np.ndarray, width: int, most: int) -> np.ndarray:
    a, b = codes(left, width, 0xFFFFFFFE).T, codes(right, width, 0xFFFFFFFF).T
    over = np.int32(most + 1)
    far = np.full(len(left), over)
    ends = np.minimum(m, over).astype(np.int32)
    result = np.where(n == 0, ends, over).astype(np.int32)
    before: dict[int, np.ndarray] = {}
    row = {j: np.full(len(left), j, dtype=np.int32) for j in range(min(most, width) + 1)}
    for i in range(1, width + 1):
        new: dict[int, np.ndarray] = {}
        for j in range(max(0, i - most), min(width, i + most) + 1):
            if j == 0:
                new[0] = np.full(len(left), min(i, over), dtype=np.int32)
                result[(n == i) & (m == 0)] = new[0][0]
                continue
            v = np.minimum(row.get(j, far), new.get(j - 1, far)) + 1
            v = np.minimum(v, row.get(j - 1, far) + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and j - 2 in before:
                crossed = (a[i - 1] == b[j - 2]) & (a[i - 2] == b[j - 1])
                v = np.where(crossed, np.minimum(v, before[j - 2] + 1), v)
            new[j] = np.minimum(v, over)
            done = (n == i) & (m == j)
            result[done] = new[j][done]
        before, row = row, new
    return result


@lru_cache(maxsize=256)
def _gone(size: int, count: int) -> np.ndarray:
    found = list(combinations(range(size), count))
    return np.array(found, dtype=np.int64).reshape(len(found), count)


def _sums(points: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial modulo 2**64, a row a text."""
    power = np.full(points.shape[1] + 1, _BASE, dtype=_U)
    power[0] = 1
    sums = np.zeros((len(points), points.shape[1] + 1), dtype=_U)
    np.cumsum(mix(points.astype(_U) + _U(0x51)) * np.multiply.accumulate(power)[:-1], axis=1, out=sums[:, 1:])
    return sums


def edit_keys(texts: list[str], most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which text, 64-bit key): two texts within min(most of both) edits share a key.

    Short texts are keyed by all that is left after up to `most` deletions, so few texts can share a key, however many there
    are. Long ones are keyed by parts: an edit touches two neighbouring parts at most, so one of 2 * most + 1 parts is whole, a few
    letters off its place. Texts about as long as DELETION_LETTERS have both.
    """
    owners, keys = [], []
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    for size, limit in set(zip(sizes.tolist(), most.tolist())):
        at = np.flatnonzero((sizes == size) & (most == limit))
        sums = _sums(codes([texts[i] for i in at], size, 0)) if size else np.zeros((len(at), 1), dtype=_U)
        top = DELETION_LETTERS[limit]
        found = []
        if size <= top:
            for count in range(min(limit, size) + 1):
                gone = _gone(size, count)
                h, begin = np.zeros((len(at), len(gone)), dtype=_U), np.zeros(len(gone), dtype=np.int64)
                for c in range(count):
                    h += (sums[:, gone[:, c]] - sums[:, begin]) * _INVERSES[c]
                    begin = gone[:, c] + 1
                found.append(h + (sums[:, [size]] - sums[:, begin]) * _INVERSES[count])
        if size > top - limit and limit:
            inverse = np.full(size + 1, _INVERSE, dtype=_U)
            inverse[0] = 1
            inverse = np.multiply.accumulate(inverse)
            parts = 2 * limit + 1
            for length in range(size - limit, size + limit + 1):
                for k in range(parts):
                    x, y = k * length // parts, (k + 1) * length // parts
                    for shift in range(-limit, limit + 1):
                        if 0 <= x + shift and y + shift <= size and y > x:
                            h = (sums[:, y + shift] - sums[:, x + shift]) * inverse[x + shift]
                            found.append(mix(h + _U(1 + length * 64 + k))[:, None])
        rows = np.concatenate(found, axis=1)
        owners.append(np.repeat(at, rows.shape[1]))
        keys.append(mix(rows).ravel())
    return (np.concatenate(owners), np.concatenate(keys)) if owners else (np.empty(0, np.int64), np.empty(0, _U))
