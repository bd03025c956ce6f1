"""Deep-shallow sorting of equally long strings that start at given places of a buffer.

Multikey quicksort splits the strings of all groups at once, by eight bytes at a time, down to a
shallow depth.  Strings that still agree there go into blind tries, which look at one byte per
branch and at one whole string per insertion, however long the common prefix is.
"""

from __future__ import annotations

import numpy as np

#: Bytes that the quicksort looks at, a multiple of 8.
SHALLOW = 32


def quicksort(data: bytes, starts: np.ndarray, groups: np.ndarray, length: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings within their groups by their first bytes, and the runs that agree there.

    ``groups`` must not decrease.  Returns the starts in order and the number of each one's run;
    runs are numbered in order and lie within a group.
    """
    words = np.ndarray(max(len(data) - 7, 0), ">u8", data, strides=(1,)) if len(data) >= 8 else np.empty(0, ">u8")
    order = starts.copy()
    last = min(shallow, length) // 8
    runs = np.cumsum(np.concatenate([[0], (np.diff(groups) != 0).astype(np.int64)])) if len(groups) else groups
    depth = np.zeros(len(starts), np.int64)
    while len(order):
        cuts = np.flatnonzero(np.diff(runs)) + 1
        first = np.concatenate([[0], cuts])
        sizes = np.diff(np.concatenate([first, [len(runs)]]))
        live = np.repeat((sizes > 1) & (depth[first] < last), sizes)
        at = np.flatnonzero(live)
        if not len(at):
            break
        pivots = np.repeat(first + sizes // 2, sizes)[at]
        own = words[order[at] + 8 * depth[at]]
        pivot = words[order[pivots] + 8 * depth[pivots]]
        side = (own > pivot).astype(np.int64) - (own < pivot)
        keys = runs[at] * 3 + side + 1
        by = np.argsort(keys, kind="stable")
        order[at] = order[at][by]
        depth[at] = (depth[at] + (side == 0))[by]
        # three new runs for each old one
        numbers = runs * 3
        numbers[at] = keys[by]
        runs = np.cumsum(np.concatenate([[0], (np.diff(numbers) != 0).astype(np.int64)]))
    return order, runs


class BlindTrie:
    """Strings of one run, ordered by inserting them one by one.

    An inner node knows the depth at which its children differ and their bytes there; a leaf is a
    list of places whose strings are equal.
    """

    def __init__(self, data: bytes, length: int, known: int):
        self.data, self.length, self.known, self.root = data, length, known, None

    def _common(self, a: int, b: int) -> int:
        """Length of the common prefix of two strings."""
        one, two = self.data[a : a + self.length], self.data[b : b + self.length]
        if one == two:
            return self.length
        differ = (int.from_bytes(one, "big") ^ int.from_bytes(two, "big")).bit_length()
        return self.length - (differ + 7) // 8

    def add(self, start: int) -> None:
        node = self.root
        if node is None:
            self.root = [start]
            return
        data = self.data
        while type(node) is tuple:
            depth, kids = node
            node = kids.get(data[start + depth]) or next(iter(kids.values()))
        same = self._common(start, node[0])
        if same == self.length:
            node.append(start)
            return
        above, node = None, self.root
        while type(node) is tuple and node[0] < same:
            above, node = node, node[1][data[start + node[0]]]
        if type(node) is tuple and node[0] == same:
            node[1][data[start + same]] = [start]
            return
        leaf = node
        while type(leaf) is tuple:
            leaf = next(iter(leaf[1].values()))
        split = (same, {data[leaf[0] + same]: node, data[start + same]: [start]})
        if above is None:
            self.root = split
        else:
            above[1][data[start + above[0]]] = split

    def ordered(self) -> list[list[int]]:
        """Places in the order of their strings; equal strings together."""
        out, work = [], [self.root] if self.root is not None else []
        while work:
            node = work.pop()
            if type(node) is tuple:
                work += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out.append(node)
        return out


def deep_shallow(data: bytes, starts: np.ndarray, groups: np.ndarray, length: int, shallow: int = SHALLOW):
    """Places in the order of group and string, as lists of places with equal strings."""
    order, runs = quicksort(data, starts, groups, length, shallow)
    if not len(order):
        return
    known = min(shallow, length) // 8 * 8
    firsts = np.flatnonzero(np.diff(runs, prepend=-1)).tolist()
    places = order.tolist()
    for k, end in zip(firsts, [*firsts[1:], len(places)], strict=True):
        if end - k == 1:
            yield [places[k]]
            continue
        trie = BlindTrie(data, length, known)
        for start in places[k:end]:
            trie.add(start)
        yield from trie.ordered()
