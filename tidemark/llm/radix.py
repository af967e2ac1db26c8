"""Adaptive radix tree over byte strings: node layouts that grow, and compressed paths.

A node has its path (the bytes below its own branch byte that all its keys
share) and branches by the next byte, in one of four layouts: up to 4 or 16
branches in byte order, up to 48 behind an index of 256 bytes, or a full table
of 256. A key may be the beginning of another: a node also has the value of
the key that ends at it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator


class Sorted:
    """Up to 4 or 16 branches in byte order."""

    __slots__ = ("room", "bytes", "nodes")

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.nodes = room, bytearray(), []

    def find(self, byte: int) -> Node | None:
        i = bisect_left(self.bytes, byte)
        return self.nodes[i] if i < len(self.bytes) and self.bytes[i] == byte else None

    def full(self) -> bool:
        return len(self.nodes) == self.room

    def put(self, byte: int, node: Node) -> None:
        i = bisect_left(self.bytes, byte)
        if i < len(self.bytes) and self.bytes[i] == byte:
            self.nodes[i] = node
        else:
            self.bytes.insert(i, byte)
            self.nodes.insert(i, node)

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.nodes, strict=True)

    def grown(self) -> Sorted | Indexed:
        out = Sorted(16) if self.room == 4 else Indexed()
        for byte, node in self.items():
            out.put(byte, node)
        return out


class Indexed:
    """Up to 48 branches behind an index of 256 bytes."""

    __slots__ = ("at", "nodes")

    def __init__(self):
        self.at, self.nodes = bytearray(256), []  # one more than the branch's place; 0: none

    def find(self, byte: int) -> Node | None:
        i = self.at[byte]
        return self.nodes[i - 1] if i else None

    def full(self) -> bool:
        return len(self.nodes) == 48

    def put(self, byte: int, node: Node) -> None:
        if self.at[byte]:
            self.nodes[self.at[byte] - 1] = node
        else:
            self.nodes.append(node)
            self.at[byte] = len(self.nodes)

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, self.nodes[i - 1]) for byte, i in enumerate(self.at) if i)

    def grown(self) -> Table:
        out = Table()
        for byte, node in self.items():
            out.put(byte, node)
        return out


class Table:
    """A branch for every byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def find(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def full(self) -> bool:
        return False

    def put(self, byte: int, node: Node) -> None:
        self.nodes[byte] = node

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, node) for byte, node in enumerate(self.nodes) if node is not None)


class Node:
    __slots__ = ("path", "value", "branches")

    def __init__(self, path: bytes, value=None):
        self.path, self.value, self.branches = path, value, None

    def find(self, byte: int) -> Node | None:
        return self.branches.find(byte) if self.branches else None

    def put(self, byte: int, node: Node) -> None:
        if self.branches is None:
            self.branches = Sorted()
        if self.branches.full() and self.branches.find(byte) is None:
            self.branches = self.branches.grown()
        self.branches.put(byte, node)

    def items(self) -> Iterator[tuple[int, Node]]:
        return self.branches.items() if self.branches else iter(())


def _shared(path: bytes, key: bytes, at: int) -> int:
    """How many bytes of ``path`` stand in ``key`` from ``at`` on."""
    if key.startswith(path, at):
        return len(path)
    n = min(len(path), len(key) - at)
    return next((i for i in range(n) if path[i] != key[at + i]), n)


class RadixTree:
    """Values by byte string; ``merge`` joins the values of equal keys and of branches."""

    def __init__(self, merge: Callable):
        self.merge, self.root = merge, Node(b"")

    def add(self, key: bytes, value) -> None:
        node, at, above = self.root, 0, None
        while True:
            n = _shared(node.path, key, at)
            if n < len(node.path):  # the paths part inside of this node: a node of what they share comes above it
                top = Node(node.path[:n])
                top.put(node.path[n], node)
                node.path = node.path[n + 1 :]
                if above is None:
                    self.root = top
                else:
                    above.put(edge, top)
                node = top
            at += n
            if at == len(key):
                node.value = value if node.value is None else self.merge(node.value, value)
                return
            above, edge = node, key[at]
            at += 1
            node = above.find(edge)
            if node is None:
                above.put(edge, Node(key[at:], value))
                return

    def walk(self) -> Iterator[tuple[int, int, object]]:
        """``from, to, value`` of every node, branches first: the node stands for the depths
        ``from < depth <= to``; ``value`` merges all keys at and below it."""
        stack, done = [(self.root, 0, None, [])], None
        while stack:
            node, above, branches, values = stack[-1]
            if branches is None:
                branches = node.items()
                stack[-1] = (node, above, branches, values)
            below = next(branches, None)
            to = above + len(node.path) + (node is not self.root)
            if below is not None:
                stack.append((below[1], to, None, []))
                continue
            stack.pop()
            done = node.value
            for v in values:
                done = v if done is None else self.merge(done, v)
            if done is not None:
                yield above, to, done
                if stack:
                    stack[-1][3].append(done)
