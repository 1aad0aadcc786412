"""Deep-shallow sorting of byte suffixes.

Suffixes of many groups are sorted at once, each by its first ``depth`` bytes.  They are
dealt into buckets by group and first two bytes; then

* shallow: multikey quicksort with characters of eight bytes.  Each run of suffixes is
  partitioned around a pivot character (the median of three) into less, equal and greater;
  the equal part goes one character deeper, until SHALLOW characters are equal;
* deep: the runs that still hold together are ordered by blind tries.  A node knows only
  the bit at which its two subtrees differ.  A suffix descends by those bits alone, is
  compared once with the suffix of the leaf it reaches, which gives the first bit they
  differ in, and is hung in above the first node of a later bit.  Equal suffixes share a
  leaf.  Reading the leaves in order sorts the run.

All runs advance together in numpy: a step of the quicksort partitions every run; in a turn
of the deep phase every suffix that waits descends, equal ones are done, and one is hung in
for each place where some leave the trie.
"""

from __future__ import annotations

import numpy as np

#: Eight-byte characters of the shallow phase.
SHALLOW = 3
_BITS = np.uint64(63)


def characters(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position, as a big-endian number; zeros follow the data."""
    x = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    for shift in (1, 2, 4):
        higher = x[:-shift] << np.uint64(8 * shift)
        higher |= x[shift:]
        x = higher
    return x[: len(data)]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... of ``size[0]`` numbers, then those of the next."""
    return np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)


def _median(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))


def _quicksort(chars: np.ndarray, at: np.ndarray, order: np.ndarray, start: np.ndarray, size: np.ndarray, steps: list[int], tail: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Sort the runs (start, size) of ``order`` in place by the characters at ``steps``; the runs that are equal in all of them."""
    offset = np.array(steps, np.int64)
    level = np.zeros(len(start), np.int64)
    equal: list[tuple[np.ndarray, np.ndarray]] = []
    while len(start):
        place, run = _ranges(start, size), np.repeat(np.arange(len(start)), size)
        first = np.cumsum(size) - size
        members = order[place]
        char = chars[at[members] + offset[level][run]] & tail
        pivot = _median(char[first], char[first + size // 2], char[first + size - 1])[run]
        side = (char > pivot).astype(np.int64) + (char >= pivot)  # 0 less, 1 equal, 2 greater
        at_run = np.zeros(len(side), np.int64)
        counts, before = [], np.zeros(len(start), np.int64)
        for k in (0, 1, 2):
            mine = side == k
            seen = np.cumsum(mine)
            base = seen[first] - mine[first]
            np.copyto(at_run, seen - 1 - base[run] + before[run], where=mine)
            counts.append(seen[first + size - 1] - base)
            before = before + counts[-1]
        order[place[first][run] + at_run] = members
        # Less and greater stay at this character, equal ones go on to the next.
        starts = np.concatenate([start, start + counts[0], start + counts[0] + counts[1]])
        sizes, levels = np.concatenate(counts), np.concatenate([level, level + 1, level])
        done = (levels == len(steps)) & (sizes > 1)
        equal.append((starts[done], sizes[done]))
        go = (levels < len(steps)) & (sizes > 1)
        start, size, level = starts[go], sizes[go], levels[go]
    return (np.concatenate([e[0] for e in equal]), np.concatenate([e[1] for e in equal])) if equal else (start, size)


def _first_difference(chars: np.ndarray, a: np.ndarray, b: np.ndarray, steps: list[int]) -> np.ndarray:
    """Number of the first bit in which the suffixes at ``a`` and ``b`` differ, over the characters at ``steps``; 64 * len(steps) if none."""
    out = np.full(len(a), 64 * len(steps))
    left = np.arange(len(a))
    for k, offset in enumerate(steps):
        x = chars[a[left] + offset] ^ chars[b[left] + offset]
        off = x != 0
        if off.any():
            y, high = x[off], np.zeros(int(off.sum()), np.int64)
            for shift in (32, 16, 8, 4, 2, 1):  # place of the highest bit
                big = y >= np.uint64(1 << shift)
                y = np.where(big, y >> np.uint64(shift), y)
                high += shift * big
            out[left[off]] = 64 * k + 63 - high
            left = left[~off]
            if not len(left):
                break
    return out


def _bit(chars: np.ndarray, at: np.ndarray, offset: np.ndarray, number: np.ndarray) -> np.ndarray:
    return ((chars[at + offset[number >> 6]] >> (_BITS - (number & 63).astype(np.uint64))) & np.uint64(1)).astype(np.int64)


def _blind_tries(chars: np.ndarray, at: np.ndarray, order: np.ndarray, start: np.ndarray, size: np.ndarray, steps: list[int]) -> np.ndarray:
    """Sort the runs (start, size) of ``order`` in place; whether each place of the runs, in order, is equal to the one before."""
    total, last = int(size.sum()), 64 * len(steps)
    base = np.cumsum(size) - size
    members = order[_ranges(start, size)]
    offset = np.array([*steps, 0], np.int64)
    # Node i < total is the leaf that member i opens; the node that hangs it in is total + i.
    bit, child, leaf = np.full(2 * total, last), np.full((2 * total, 2), -1), np.arange(total)
    root, trie = base.copy(), np.repeat(np.arange(len(base)), size)
    waiting = np.flatnonzero(~np.isin(np.arange(total), base, assume_unique=True))
    while len(waiting):
        own, mine = at[members[waiting]], trie[waiting]
        # Blind descent to a leaf, and the one comparison.
        node = root[mine]
        inner = np.flatnonzero(bit[node] < last)
        while len(inner):
            node[inner] = child[node[inner], _bit(chars, own[inner], offset, bit[node[inner]])]
            inner = inner[bit[node[inner]] < last]
        differ = _first_difference(chars, own, at[members[node]], steps)
        # Equal suffixes share the leaf; the others go down to the edge that the difference lies on.
        same = differ == last
        leaf[waiting[same]] = node[same]
        waiting, own, mine, differ = (x[~same] for x in (waiting, own, mine, differ))
        above, side, node = np.full(len(waiting), -1), np.zeros(len(waiting), np.int64), root[mine]
        inner = np.flatnonzero(bit[node] < differ)
        while len(inner):
            here = node[inner]
            above[inner], side[inner] = here, _bit(chars, own[inner], offset, bit[here])
            node[inner] = child[here, side[inner]]
            inner = inner[bit[node[inner]] < differ[inner]]
        # One suffix is hung in for each bit of an edge, in the order of the bits; the rest wait for the next turn.
        turn = np.lexsort((differ, node))
        edge, number = node[turn], differ[turn]
        new_edge = np.concatenate([[True], edge[1:] != edge[:-1]])[: len(turn)]
        first = new_edge | np.concatenate([[True], number[1:] != number[:-1]])[: len(turn)]
        new, new_edge = turn[first], new_edge[first]
        fork, way = total + waiting[new], _bit(chars, own[new], offset, differ[new])
        bit[fork] = differ[new]
        below = np.append(fork[1:], -1)[: len(fork)]
        below = np.where(np.append(new_edge[1:], True)[: len(fork)], node[new], below)
        child[fork, way], child[fork, 1 - way] = waiting[new], below
        top = new[new_edge]
        highest, is_root = fork[new_edge], above[top] < 0
        root[mine[top[is_root]]] = highest[is_root]
        child[above[top[~is_root]], side[top[~is_root]]] = highest[~is_root]
        waiting = np.sort(waiting[turn[~first]])
    # Leaves in order: sizes from the bottom, then a left subtree keeps its node's place and a right one comes after it.
    count = np.bincount(leaf, minlength=2 * total)
    levels, node = [], root
    while len(node := node[bit[node] < last]):
        levels.append(node)
        node = child[node].ravel()
    for node in reversed(levels):
        count[node] = count[child[node, 0]] + count[child[node, 1]]
    place = np.zeros(2 * total, np.int64)
    place[root] = base
    for node in levels:
        left, right = child[node, 0], child[node, 1]
        place[left], place[right] = place[node], place[node] + count[left]
    sorted_members = np.argsort(place[leaf], kind="stable")
    order[_ranges(start, size)] = members[sorted_members]
    leaf = leaf[sorted_members]
    return np.concatenate([[False], leaf[1:] == leaf[:-1]])


def sort(chars: np.ndarray, at: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, equal): the suffixes ``at`` sorted by group and by their first ``depth`` bytes, and whether each agrees with the one before in group and all of them.

    ``group`` holds sorted numbers from 0 and ``chars`` comes from ``characters``; every suffix has ``depth`` bytes.
    """
    n = len(at)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    # Characters start at these offsets; the last may overlap so that none reads beyond the depth.
    steps, tail = [*range(0, depth - 7, 8)], np.uint64(0xFFFFFFFFFFFFFFFF)
    if depth >= 8 and depth % 8:
        steps.append(depth - 8)
    elif depth < 8:
        steps, tail = [0], np.uint64((1 << 64) - (1 << 8 * (8 - depth)))
    two = ((chars[at] & tail) >> np.uint64(48)).astype(np.uint16)
    order = np.argsort(two, kind="stable")
    order = order[np.argsort(group[order].astype(np.uint16 if group[-1] < 1 << 16 else np.int64), kind="stable")]
    g, b = group[order], two[order]
    start = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (b[1:] != b[:-1])]))
    size = np.diff(np.append(start, n))
    start, size = _quicksort(chars, at, order, start[size > 1], size[size > 1], steps[:SHALLOW], tail)
    equal = np.zeros(n, bool)
    if len(steps) <= SHALLOW:
        equal[_ranges(start, size)] = True
        equal[start] = False
    elif len(start):
        equal[_ranges(start, size)] = _blind_tries(chars, at, order, start, size, steps[SHALLOW:])
    return order, equal


def repeated(chars: np.ndarray, at: np.ndarray, group: np.ndarray, depth: int) -> np.ndarray:
    """Which suffixes ``at`` agree with another one of their ``group`` in ``depth`` bytes."""
    order, equal = sort(chars, at, group, depth)
    out = np.zeros(len(at), bool)
    out[order] = equal | np.append(equal[1:], False)
    return out
