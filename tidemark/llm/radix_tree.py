"""Adaptive radix tree over keys of fixed-width turn ids, for the keys of one task.

Inner nodes hold 4, 16, 48 or 256 children and change their layout as they grow; chains without a
branch are one compressed prefix.  Only byte depths that are whole turns are nodes of the trie, so
branches inside an id are never reported, and a compressed prefix may stand for several nodes.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from os.path import commonprefix


class Few:
    """Up to 4 or 16 children: sorted bytes beside their children."""

    def __init__(self, room: int):
        self.room, self.bytes, self.kids = room, bytearray(), []

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, kid):
        """The layout that holds the child: this one, or a larger one that takes its place."""
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.kids[at] = kid
            return self
        if len(self.bytes) < self.room:
            self.bytes.insert(at, byte)
            self.kids.insert(at, kid)
            return self
        larger = Few(16) if self.room < 16 else Some()
        for b, k in self:
            larger.put(b, k)
        return larger.put(byte, kid)

    def __iter__(self):
        return zip(self.bytes, self.kids, strict=True)


class Some:
    """Up to 48 children: a place for each byte, in a list of children."""

    ROOM = 48

    def __init__(self):
        self.place, self.kids = bytearray(256), []

    def get(self, byte: int):
        at = self.place[byte]
        return self.kids[at - 1] if at else None

    def put(self, byte: int, kid):
        if self.place[byte]:
            self.kids[self.place[byte] - 1] = kid
            return self
        if len(self.kids) < self.ROOM:
            self.kids.append(kid)
            self.place[byte] = len(self.kids)
            return self
        larger = Every()
        for b, k in self:
            larger.put(b, k)
        return larger.put(byte, kid)

    def __iter__(self):
        return ((b, self.kids[at - 1]) for b, at in enumerate(self.place) if at)


class Every:
    """A child for each byte."""

    def __init__(self):
        self.kids = [None] * 256

    def get(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid):
        self.kids[byte] = kid
        return self

    def __iter__(self):
        return ((b, k) for b, k in enumerate(self.kids) if k is not None)


class Node:
    """Bytes after the branch, children, and what is known of the keys that pass or end here."""

    __slots__ = ("prefix", "kids", "count", "least", "words", "ends")

    def __init__(self, prefix: bytes, words):
        self.prefix, self.kids, self.words = prefix, None, words
        self.count, self.least, self.ends = 0, None, None

    def pass_by(self, name: int) -> None:
        self.count += 1
        self.least = name if self.least is None else min(self.least, name)

    def kid(self, byte: int) -> Node | None:
        return self.kids.get(byte) if self.kids is not None else None

    def set_kid(self, byte: int, kid: Node) -> None:
        self.kids = (Few(4) if self.kids is None else self.kids).put(byte, kid)


class RadixTree:
    """Keys of whole turns, each with the name of its conversation and the words of its turns."""

    def __init__(self, width: int):
        self.width, self.root = width, Node(b"", ())
        self.first = self.last = None

    def add(self, key: bytes, name: int, words) -> None:
        """Adds one conversation; keys must come in ascending order."""
        if self.first is None:
            self.first = key
        self.last = key
        node, at = self.root, 0
        while True:
            same = len(commonprefix((node.prefix, key[at : at + len(node.prefix)])))
            if same < len(node.prefix):
                self._split(node, same)
            node.pass_by(name)
            at += same
            if at == len(key):
                if node.ends is None:
                    node.ends, node.words = [], words
                node.ends.append(name)
                return
            below = node.kid(key[at])
            if below is None:
                below = Node(key[at + 1 :], words)
                node.set_kid(key[at], below)
            node, at = below, at + 1

    @staticmethod
    def _split(node: Node, same: int) -> None:
        """The node ends after ``same`` bytes of its prefix; the rest becomes a child."""
        rest = Node(node.prefix[same + 1 :], node.words)
        rest.kids, rest.count, rest.least, rest.ends = node.kids, node.count, node.least, node.ends
        branch = node.prefix[same]
        node.prefix, node.kids, node.ends = node.prefix[:same], None, None
        node.set_kid(branch, rest)

    def nodes(self) -> Iterator[dict]:
        """All nodes of whole turns, children before parents.

        Nodes on the way to the first or the last key may have members in other tasks: they are
        ``open`` and count only complete children.  A node says its parent's least name, or by
        ``under`` the depth of its open parent on the way to the first (0) or last (1) key.
        """
        if self.first is None:
            return
        shared = len(commonprefix((self.first, self.last))) // self.width
        work = [[self.root, 0, b"", True, True, None, iter(()), None, None]]
        frame = work[0]
        self._enter(frame)
        while work:
            node, start, edge, _, _, _, kids, low, below = frame = work[-1]
            branch = next(kids, None)
            if branch is not None:
                byte, kid = branch
                on_first, on_last, parent = low
                end = start + len(edge)
                work.append([
                    kid, end, bytes((byte,)) + kid.prefix,
                    on_first and self.first[end : end + 1] == bytes((byte,)), on_last and self.last[end : end + 1] == bytes((byte,)),
                    parent, iter(()), None, None,
                ])
                self._enter(work[-1])
                continue
            work.pop()
            yield from self._leave(frame, shared)
            if work:
                work[-1][8] = [a + b for a, b in zip(work[-1][8], frame[8], strict=True)]

    def _enter(self, frame: list) -> None:
        node, start, edge, on_first, on_last, parent, *_ = frame
        end = start + len(edge)
        on_first = on_first and self.first[start:end] == edge
        on_last = on_last and self.last[start:end] == edge
        if end // self.width > start // self.width or end == 0:
            depth = end // self.width
            # the deepest whole turn may lie on a way that the whole prefix leaves
            parent = self._is_open(frame, depth) or ("closed", node.least)
        frame[6] = iter(node.kids or ())
        frame[7], frame[8] = (on_first, on_last, parent), [0, 0, 0]

    def _is_open(self, frame: list, depth: int):
        _, start, edge, on_first, on_last, *_ = frame
        end = depth * self.width
        for side, on, key in ((0, on_first, self.first), (1, on_last, self.last)):
            if on and len(key) >= end and key[start:end] == edge[: end - start]:
                return ("open", side, depth)
        return None

    def _leave(self, frame: list, shared: int) -> Iterator[dict]:
        node, start, edge, _, _, parent, _, _, below = frame
        end = start + len(edge)
        bottom = end // self.width
        top = 0 if end == 0 else start // self.width + 1
        for depth in range(bottom, top - 1, -1):
            opened = self._is_open(frame, depth)
            ends = node.ends if node.ends is not None and depth * self.width == end else []
            if depth == 0:
                above = None
            elif depth == top:
                above = parent
            else:
                above = self._is_open(frame, depth - 1) or ("closed", node.least)
            children, leaves, saved = below
            words = node.words[depth - 1] if depth else 0
            row = {
                "depth": depth, "least": node.least, "count": node.count, "words": words, "above": above,
                "children": children, "ends": ends, "open": opened, "shared": bool(opened) and depth <= shared,
            }
            if opened:
                # its totals are known when the other tasks' parts are added
                row |= {"leaves": leaves, "saved": saved}
                below = [0, 0, 0]
            else:
                leaves = leaves if children else 1
                saved += (node.count - 1) * words
                row |= {"leaves": leaves, "saved": saved}
                below = [1, leaves, saved]
            yield row
        frame[8] = below


def names_digest(names: list[int]) -> str:
    """SHA-256 of decimal names in their order, joined by commas."""
    return hashlib.sha256(",".join(map(str, names)).encode()).hexdigest()
