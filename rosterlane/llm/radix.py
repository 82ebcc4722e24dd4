"""Adaptive radix tree over byte strings that are whole numbers of fixed-width ids.

Inner nodes have one of four layouts, by how many children they hold, and are exchanged for the next
larger one when full. A node keeps the bytes that all strings below it share (path compression), so a
chain without a branch is one node, however long it is. Strings are inserted with a row number; a walk
in byte order then reports what lies at every depth that is a whole number of ids, also inside a
compressed path.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

ABSENT = -1


class Sorted:
    """Up to 4, then up to 16 children: their bytes in order, and the children beside them."""

    __slots__ = ("room", "bytes", "children")

    def __init__(self, room: int = 4):
        self.room = room
        self.bytes = bytearray()
        self.children: list[Node] = []

    def get(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return self.children[at] if at >= 0 else None

    def put(self, byte: int, child: Node) -> Sorted | Indexed:
        """The layout that holds the child now: this one or, if it is full, the next larger."""
        if byte not in self.bytes and len(self.children) == self.room:
            larger = Sorted(16) if self.room == 4 else Indexed()
            for b, c in self.items():
                larger.put(b, c)
            return larger.put(byte, child)
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.children[at] = child
        else:
            self.bytes.insert(at, byte)
            self.children.insert(at, child)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.children)


class Indexed:
    """Up to 48 children: a place for each of the 256 bytes, and the children in order of arrival."""

    __slots__ = ("place", "children")

    def __init__(self):
        self.place = bytearray(256)
        self.children: list[Node] = []

    def get(self, byte: int) -> Node | None:
        at = self.place[byte]
        return self.children[at - 1] if at else None

    def put(self, byte: int, child: Node) -> Indexed | Direct:
        if self.place[byte]:
            self.children[self.place[byte] - 1] = child
            return self
        if len(self.children) == 48:
            larger = Direct()
            for b, c in self.items():
                larger.put(b, c)
            return larger.put(byte, child)
        self.children.append(child)
        self.place[byte] = len(self.children)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, self.children[at - 1]) for b, at in enumerate(self.place) if at)


class Direct:
    """Up to 256 children, each at its byte."""

    __slots__ = ("children",)

    def __init__(self):
        self.children: list[Node | None] = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.children[byte]

    def put(self, byte: int, child: Node) -> Direct:
        self.children[byte] = child
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, c) for b, c in enumerate(self.children) if c is not None)


class Node:
    """``path``: bytes that all strings below share after the byte that leads here; ``row``: of the
    string that ends here."""

    __slots__ = ("path", "row", "layout")

    def __init__(self, path: bytes, row: int = ABSENT):
        self.path = path
        self.row = row
        self.layout: Sorted | Indexed | Direct | None = None

    def put(self, byte: int, child: Node) -> None:
        self.layout = (self.layout or Sorted()).put(byte, child)

    def children(self) -> Iterator[Node]:
        return (c for _, c in self.layout.items()) if self.layout is not None else iter(())


def shared(one: bytes, other: bytes) -> int:
    """How many leading bytes agree."""
    width = min(len(one), len(other))
    differ = int.from_bytes(one[:width]) ^ int.from_bytes(other[:width])
    return width - -(-differ.bit_length() // 8)


def insert(root: Node | None, key: bytes, row: int) -> Node:
    """Add a string that is not there yet; returns the root."""
    if root is None:
        return Node(key, row)
    node, at, above, led = root, 0, None, 0
    while True:
        rest = key[at:]
        same = len(node.path) if rest.startswith(node.path) else shared(node.path, rest)
        if same < len(node.path):
            # The path is cut where the strings part; the old node keeps what is behind.
            upper = Node(node.path[:same])
            upper.put(node.path[same], node)
            node.path = node.path[same + 1 :]
            if same == len(rest):
                upper.row = row
            else:
                upper.put(rest[same], Node(rest[same + 1 :], row))
            if above is None:
                return upper
            above.put(led, upper)
            return root
        if same == len(rest):
            node.row = row
            return root
        byte = rest[same]
        child = node.layout.get(byte) if node.layout is not None else None
        if child is None:
            node.put(byte, Node(rest[same + 1 :], row))
            return root
        node, at, above, led = child, at + same + 1, node, byte
