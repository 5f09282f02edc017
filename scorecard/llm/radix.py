"""Adaptive radix trees over fixed-width ids, and the turn nodes in them.

A tree node has a compressed path and children by their first byte, in a layout
that grows with their number: few sorted bytes, an index of 256 places into a short
list, or a list of 256. Keys are ids of equal width put end to end, so a key may end
where others go on. Byte nodes are an inner matter: what is given out is a node for
each depth that is a whole number of ids.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

# Children of the two sorted layouts and of the indexed one.
SORTED_SIZES = (4, 16)
INDEXED_SIZE = 48


class Sorted:
    """Up to 4 or 16 children, their bytes in order."""

    __slots__ = ("size", "bytes", "nodes")

    def __init__(self, size: int = SORTED_SIZES[0]):
        self.size, self.bytes, self.nodes = size, bytearray(), []

    def get(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return None if at < 0 else self.nodes[at]

    def put(self, byte: int, node: Node):
        """The layout that has the child: this one, or a larger one when full."""
        at = self.bytes.find(byte)
        if at >= 0:
            self.nodes[at] = node
            return self
        if len(self.nodes) == self.size:
            larger = Sorted(SORTED_SIZES[1]) if self.size < SORTED_SIZES[1] else Indexed()
            for b, n in self.items():
                larger.put(b, n)
            return larger.put(byte, node)
        at = bisect.bisect(self.bytes, byte)
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def items(self) -> Iterable[tuple[int, Node]]:
        return zip(self.bytes, self.nodes, strict=True)


class Indexed:
    """Up to 48 children, found through a place for each byte."""

    __slots__ = ("places", "nodes")

    def __init__(self) -> None:
        self.places, self.nodes = bytearray(256), []

    def get(self, byte: int) -> Node | None:
        place = self.places[byte]
        return self.nodes[place - 1] if place else None

    def put(self, byte: int, node: Node):
        if self.places[byte]:
            self.nodes[self.places[byte] - 1] = node
            return self
        if len(self.nodes) == INDEXED_SIZE:
            larger = Full()
            for b, n in self.items():
                larger.put(b, n)
            return larger.put(byte, node)
        self.nodes.append(node)
        self.places[byte] = len(self.nodes)
        return self

    def items(self) -> Iterable[tuple[int, Node]]:
        return ((b, self.nodes[p - 1]) for b, p in enumerate(self.places) if p)


class Full:
    """A place for each byte."""

    __slots__ = ("nodes",)

    def __init__(self) -> None:
        self.nodes: list[Node | None] = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> Full:
        self.nodes[byte] = node
        return self

    def items(self) -> Iterable[tuple[int, Node]]:
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


class Node:
    __slots__ = ("path", "kids", "held")

    def __init__(self, path: bytes):
        self.path, self.kids, self.held = path, Sorted(), None


@dataclass
class Held:
    """Who has just the key: members that end with it, in order, and those that go on."""

    ends: list[int] = field(default_factory=list)
    going_on: int = 0
    least: int | None = None
    onward: tuple[int, int] | None = None

    def add(self, member: int, ends: bool, onward: tuple[int, int]) -> None:
        self.least = member if self.least is None else min(self.least, member)
        if ends:
            self.ends.append(member)
        else:
            self.going_on += 1
            self.onward = onward


class Tree:
    def __init__(self) -> None:
        self.root = Node(b"")

    def insert(self, key: bytes) -> Node:
        """The node whose path from the root is ``key``."""
        node, at = self.root, 0
        while at < len(key):
            child = node.kids.get(key[at])
            if child is None:
                child = Node(key[at:])
                node.kids = node.kids.put(key[at], child)
                return child
            path = child.path
            if key.startswith(path, at):
                shared = len(path)
            else:
                shared = next(
                    (i for i, (a, b) in enumerate(zip(path, key[at:], strict=False)) if a != b), len(key) - at
                )
                upper = Node(path[:shared])
                child.path = path[shared:]
                upper.kids = upper.kids.put(child.path[0], child)
                node.kids = node.kids.put(key[at], upper)
                child = upper
            node, at = child, at + shared
        return node


@dataclass
class Turn:
    """A node at a whole number of ids, with what its closed part of the tree adds up to.

    ``is_open`` nodes may have more members elsewhere; their sums leave open children
    out. ``key`` is known for open nodes and where something below goes on.
    """

    depth: int
    turn_id: bytes
    size: int
    members: int
    least: int
    children: int
    leaves: int
    saved: int
    is_open: bool
    key: bytes | None
    parent: int | None = None
    parent_key: bytes | None = None
    held: Held | None = None


@dataclass
class _Sums:
    members: int = 0
    least: int | None = None
    children: int = 0
    leaves: int = 0
    saved: int = 0
    onward: bool = False
    orphans: list[Turn] = field(default_factory=list)

    def add(self, other: _Sums) -> None:
        self.members += other.members
        if other.least is not None:
            self.least = other.least if self.least is None else min(self.least, other.least)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.onward |= other.onward
        self.orphans += other.orphans


def turns(tree: Tree, width: int, sizes: dict[bytes, int], open_keys: list[bytes]) -> Iterator[Turn]:
    """The turn nodes of a tree, children before parents.

    ``sizes`` has the bytes of each id's text; a node is open if one of ``open_keys``
    starts with its key.
    """
    spine = bytearray()
    waiting = [(tree.root, 0, iter(tree.root.kids.items()), _Sums())]
    while waiting:
        node, start, kids, sums = waiting[-1]
        following = next(kids, None)
        if following is not None:
            child = following[1]
            spine += child.path
            waiting.append((child, start + len(node.path), iter(child.kids.items()), _Sums()))
            continue
        waiting.pop()
        end = start + len(node.path)
        if node.held is not None:
            held = node.held
            sums.add(_Sums(len(held.ends) + held.going_on, held.least, onward=held.going_on > 0))
        first = start + 1 if waiting else 0
        for depth in range(end // width * width, -1, -width):
            if depth < first:
                break
            key = bytes(spine[:depth])
            held = node.held if depth == end else None
            turn_id = key[-width:] if depth else b""
            is_open = any(k.startswith(key) for k in open_keys)
            turn = Turn(
                depth // width, turn_id, sizes[turn_id] if depth else 0, sums.members, sums.least,
                sums.children, sums.leaves, sums.saved, is_open,
                key if is_open or sums.onward else None, held=held,
            )
            for orphan in sums.orphans:
                if is_open:
                    orphan.parent_key = key
                else:
                    orphan.parent = turn.least
            yield from sums.orphans
            if is_open:
                sums.children = sums.leaves = sums.saved = 0
                sums.orphans = []
                yield turn
            else:
                if not turn.children and not (held and held.going_on):
                    turn.leaves = 1
                turn.saved += (turn.members - 1) * turn.size
                sums.children, sums.leaves, sums.saved, sums.orphans = 1, turn.leaves, turn.saved, [turn]
        if waiting:
            waiting[-1][3].add(sums)
            del spine[start:]
        else:
            yield from sums.orphans


def digest_of(ends: Iterable[int]) -> str:
    return hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
