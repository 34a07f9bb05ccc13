"""Betweenness by biconnected blocks, on vertex numbers.

Every path between two blocks passes the vertices that cut them apart, so what a vertex gets is told block by block: inside a block
by Brandes, its vertices weighted by how many others hang on them, and across blocks by the sizes of the branches at the vertex.
Inside a large block, what goes by its hub is told by one search from the hub, so that the search from each source stays around it.
Trees, which are most of a sparse graph, have blocks of two vertices and need no search at all; the sum is the exact one.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass

import numpy as np

#: Searches that go on at the same time have so many places together: four bytes each.
_TOGETHER = 4_000_000
#: They walk along about so many edges, which stay near the processor.
_WALKED = 100_000
#: A block of at most so many places is searched as a whole from each of them.
_SMALL = 100


@dataclass
class Blocks:
    """Places are vertices inside blocks of three or more; a block's places are consecutive, and first, to, weight are their edges both ways."""

    base: np.ndarray  # by vertex: pairs apart by it
    vertex: np.ndarray  # by place
    hangs: np.ndarray  # by place: vertices that are reached through it, itself among them
    start: np.ndarray  # by place: the first place of its block
    end: np.ndarray
    first: np.ndarray
    to: np.ndarray
    weight: np.ndarray


def _numbers(x: np.ndarray) -> array:
    """Numbers that loops read one by one: as quick as a list in a quarter of its memory."""
    return array("q", x.astype(np.int64).tobytes())


def _search(n: int, first: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Depth first, without recursion: vertices in their order, the one before each (itself at a root), and the least position reached around it."""
    begin, near, at = _numbers(first), _numbers(to), _numbers(first[:-1])
    place, up, low, order = array("q", [-1]) * n, _numbers(np.arange(n)), array("q", [0]) * n, array("q")
    for root in range(n):
        if place[root] >= 0:
            continue
        place[root] = low[root] = len(order)
        order.append(root)
        v, least = root, len(order) - 1
        while True:
            k, stop, before = at[v], begin[v + 1], up[v]
            down = -1
            while k < stop:
                w = near[k]
                k += 1
                p = place[w]
                if p < 0:
                    down = w
                    break
                if p < least and w != before:
                    least = p
            at[v] = k
            low[v] = least
            if down >= 0:
                up[down] = v
                v, least = down, len(order)
                place[v] = least
                order.append(v)
            elif v == root:
                break
            else:
                v, below = before, least
                least = low[v] if low[v] < below else below
    return tuple(np.frombuffer(x, dtype=np.int64) if len(x) else np.empty(0, np.int64) for x in (order, up, low))


def split(n: int, a: np.ndarray, b: np.ndarray, m: np.ndarray) -> Blocks:
    """The blocks of a simple graph on the vertices 0 to n - 1; m: parallel edges, which count as paths of their own."""
    src, dst = np.concatenate((a, b)), np.concatenate((b, a))
    turn = np.argsort(src, kind="stable")
    order, up, low = _search(n, np.concatenate(([0], np.cumsum(np.bincount(src, minlength=n)))), dst[turn])
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    root = up == np.arange(n)
    opens = ~root & (low >= place[up])  # the first of its block below the vertex that cuts it off
    # in the order of the search a vertex comes after the one before it, and its tree is consecutive
    size, block, top = array("q", [1]) * n, _numbers(np.arange(n)), _numbers(np.arange(n))
    ups, is_open, is_root, walk = _numbers(up), opens.tolist(), root.tolist(), _numbers(order)
    for v in reversed(walk):
        if not is_root[v]:
            size[ups[v]] += size[v]
    for v in walk:
        if not is_root[v]:
            top[v] = top[ups[v]]
            if not is_open[v]:
                block[v] = block[ups[v]]
    size, block, whole = np.array(size, dtype=np.float64), np.array(block, dtype=np.int64), np.array(size, dtype=np.float64)[np.array(top, dtype=np.int64)]
    below, squares = (np.bincount(up[opens], x[opens], minlength=n) for x in (size, size * size))
    base = (whole - 1) ** 2 - squares - (whole - 1 - below) ** 2
    # an edge is in the block of its end that was found later
    owner = block[np.where(place[a] > place[b], a, b)]
    keep = np.bincount(owner, minlength=n)[owner] > 1  # one edge alone is between two vertices only
    a, b, m, owner = a[keep], b[keep], m[keep], owner[keep]
    inside = np.zeros(n, dtype=bool)
    inside[owner] = True
    members = np.flatnonzero(inside[block] & ~root)
    tops = np.flatnonzero(inside)  # a block is known by its first vertex; the one that cuts it off belongs to it as well
    vertex, of = np.concatenate((members, up[tops])), np.concatenate((block[members], tops))
    hangs = np.concatenate((1 + below[members], whole[tops] - size[tops]))
    turn = np.lexsort((place[vertex], of))  # in the order of the search, so neighbours are near in memory
    vertex, of, hangs = vertex[turn], of[turn], hangs[turn]
    # the place of a vertex in a block: as a member it has one only, as the one that cuts off one for each block
    member, cutter = np.full(n, -1, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    is_member = block[vertex] == of
    is_member &= ~root[vertex]
    member[vertex[is_member]] = np.flatnonzero(is_member)
    cutter[of[~is_member]] = np.flatnonzero(~is_member)
    x, y = (np.where(e == up[owner], cutter[owner], member[e]) for e in (a, b))
    counts = np.bincount(of, minlength=n)
    ends = np.cumsum(counts)
    src, dst, wt = np.concatenate((x, y)), np.concatenate((y, x)), np.concatenate((m, m)).astype(np.float64)
    turn = np.lexsort((dst, src))
    first = np.concatenate(([0], np.cumsum(np.bincount(src, minlength=len(vertex)))))
    return Blocks(base, vertex, hangs, (ends - counts)[of], ends[of], first, dst[turn], wt[turn])


def costs(g: Blocks) -> np.ndarray:
    """By place: the edges that a search from it walks along, and what a search costs at least."""
    return g.first[g.end] - g.first[g.start] + 50.0


def dependencies(g: Blocks, low: int, high: int) -> np.ndarray:
    """What the places low to high - 1 as sources add to every place, weighted by what hangs on both ends.

    In a large block most shortest paths pass its hub, the place with the most edges: see _by_hub.
    """
    score = np.zeros(len(g.vertex))
    at = low
    while at < high:
        start, end = int(g.start[at]), int(g.end[at])
        begin, finish = int(g.first[start]), int(g.first[end])
        weight = g.weight[begin:finish]
        part = _Part(g.first[start : end + 1] - begin, np.diff(g.first[start : end + 1]), g.to[begin:finish] - start, None if (weight == 1).all() else weight)
        sources = np.arange(at, min(end, high)) - start
        score[start:end] += (_by_hub if end - start > _SMALL else _whole)(part, g.hangs[start:end], sources)
        at = min(end, high)
    return score


@dataclass
class _Part:
    """The edges of one block by the places in it: first and sizes by place, to and weight (None: 1 everywhere) by edge."""

    first: np.ndarray
    sizes: np.ndarray
    to: np.ndarray
    weight: np.ndarray | None


@dataclass
class _Level:
    """What searches reach at one distance. up, down, share: the edges that lead there, by number in the level before and in this one, and the paths along them."""

    search: np.ndarray
    place: np.ndarray
    paths: np.ndarray
    up: np.ndarray | None = None
    down: np.ndarray | None = None
    share: np.ndarray | None = None


def _levels(part: _Part, sources: np.ndarray, slot: np.ndarray, bound: np.ndarray | None = None, reach: np.ndarray | None = None) -> list[_Level]:
    """Searches from all sources at the same time, level by level. slot: -1 for every place of every search, and so again at the end.

    With bound, a search keeps only places that are no farther than their bound and the reach of the search together.
    """
    n = len(part.sizes)
    levels = [_Level(np.arange(len(sources)), sources, np.ones(len(sources)))]
    cells = [levels[0].search * n + sources]
    slot[cells[0]] = 0
    while True:
        last = levels[-1]
        sizes = part.sizes[last.place]
        ends = np.cumsum(sizes)
        up = np.repeat(np.arange(len(sizes)), sizes)
        edge = np.arange(ends[-1]) + (part.first[last.place] - ends + sizes)[up]
        place, search = part.to[edge], last.search[up]
        cell = search * n + place
        fresh = slot[cell] < 0
        if bound is not None:
            fresh &= bound[place] + reach[search] >= len(levels)
        fresh = np.flatnonzero(fresh)
        if not len(fresh):
            break
        up, cell = up[fresh], cell[fresh]
        share = last.paths[up] if part.weight is None else last.paths[up] * part.weight[edge[fresh]]
        count = np.arange(len(cell))
        slot[cell] = count
        once = np.flatnonzero(slot[cell] == count)
        new = cell[once]
        slot[new] = np.arange(len(new))
        down = slot[cell]
        cells.append(new)
        levels.append(_Level(search[fresh[once]], place[fresh[once]], np.bincount(down, share, minlength=len(new)), up, down, share))
    for c in cells:
        slot[c] = -1
    return levels


def _needs(levels: list[_Level], loads: list[np.ndarray]) -> list[np.ndarray]:
    """By level: what lies beyond each place on the paths to others; loads: what there is to reach at the places of the levels after the first."""
    needs = [np.zeros(len(levels[-1].place))]
    for k in range(len(levels) - 1, 0, -1):
        at, beyond = levels[k], (loads[k - 1] + needs[-1]) / levels[k].paths
        needs.append(np.bincount(at.up, at.share * beyond[at.down], minlength=len(levels[k - 1].place)))
    return needs[::-1]


def _whole(part: _Part, hangs: np.ndarray, sources: np.ndarray) -> np.ndarray:
    """Brandes from each source over the whole block."""
    n, score = len(hangs), np.zeros(len(hangs))
    most = max(1, min(_TOGETHER // n, _WALKED // len(part.to), len(sources)))
    slot = np.full(most * n, -1, dtype=np.int32)
    for at in range(0, len(sources), most):
        some = sources[at : at + most]
        levels = _levels(part, some, slot)
        needs = _needs(levels, [hangs[x.place] for x in levels[1:]])
        for x, need in zip(levels[1:], needs[1:]):
            score += np.bincount(x.place, hangs[some[x.search]] * need, minlength=n)
    return score


def _by_hub(part: _Part, hangs: np.ndarray, sources: np.ndarray) -> np.ndarray:
    """The same sums, in which a source searches only around itself.

    A shortest path passes the hub or avoids it. Those that pass it are the paths from the source to the hub followed by the paths
    from there to the target, both told by one search from the hub. Those that avoid it are found by a search without the hub; it goes
    on only to places that it reaches no later than the way by the hub does, and the places before such a place are such places too.
    What goes by the hub is all there is to reach less what is reached around the source, and is handed down the levels of the
    hub for all sources together. It is counted for both ends there, as every pair is met from either.
    """
    n, score, by_hub = len(hangs), np.zeros(len(hangs)), np.zeros(len(hangs))
    hub = int(np.argmax(part.sizes))
    from_hub = _levels(part, np.array([hub]), np.full(n, -1, dtype=np.int32))
    far, ways = np.zeros(n, dtype=np.int64), np.ones(n)
    for k, x in enumerate(from_hub):
        far[x.place], ways[x.place] = k, x.paths
    bound = far.copy()
    bound[hub] = -2 * n  # no search around a source enters it
    sources, all_of_them = sources[sources != hub], hangs.sum() - hangs[hub]
    most = max(1, min(_TOGETHER // n, len(sources)))
    slot, at, together = np.full(most * n, -1, dtype=np.int32), 0, min(most, 8)
    while at < len(sources):
        some = sources[at : at + together]
        levels = _levels(part, some, slot, bound, far[some])
        loads, near = [], hangs[some].astype(np.float64)
        for k, x in enumerate(levels[1:], 1):
            s = some[x.search]
            load = hangs[x.place] * (x.paths / (x.paths + np.where(far[x.place] + far[s] == k, ways[x.place] * ways[s], 0.0)))
            near += np.bincount(x.search, load, minlength=len(some))
            loads.append(load)
        for x, need in zip(levels[1:], _needs(levels, loads)[1:]):
            np.add.at(score, x.place, hangs[some[x.search]] * need)
        by_hub[some] = hangs[some] * np.maximum(all_of_them - near, 0.0)
        at += len(some)
        walked = sum(part.sizes[x.place].sum() for x in levels) / len(some)
        together = int(max(1, min(most, _WALKED // walked)))
    ends = np.zeros(n)
    ends[sources] = 2 * (by_hub[sources] + hangs[sources] * hangs[hub])  # the hub as an end of its own, too
    for x, need in zip(from_hub[1:], _needs(from_hub, [ends[x.place] for x in from_hub[1:]])[1:]):
        score[x.place] += need
    score[hub] = by_hub.sum()
    return score
