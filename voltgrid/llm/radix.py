"""An adaptive radix tree over byte strings: nodes change their layout with the
number of their children, and a run of bytes without a branch is one path.

A node keeps its path as a place in one of the keys below it (``key``, and
``end``, where the path ends), so paths cost no copies. Children are found by
their next byte:

==========  =========================================================
up to 4     sorted bytes and links side by side
up to 16    the same, larger
up to 48    256 slot numbers that point into the links
up to 256   one link for every byte
==========  =========================================================
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

SMALL, MIDDLE, LARGE = 4, 16, 48


class Sorted:
    """Up to 16 children: bytes in order, links beside them."""

    __slots__ = ("bytes", "links", "room")

    def __init__(self, room: int = SMALL):
        self.bytes, self.links, self.room = bytearray(), [], room

    def get(self, b: int) -> Node | None:
        i = bisect_left(self.bytes, b)
        return self.links[i] if i < len(self.bytes) and self.bytes[i] == b else None

    def put(self, b: int, child: Node) -> Sorted | Indexed:
        i = bisect_left(self.bytes, b)
        if i < len(self.bytes) and self.bytes[i] == b:
            self.links[i] = child
            return self
        if len(self.links) == self.room == MIDDLE:
            return Indexed(self).put(b, child)
        if len(self.links) == self.room:
            self.room = MIDDLE
        self.bytes.insert(i, b)
        self.links.insert(i, child)
        return self

    def __iter__(self) -> Iterator[Node]:
        return iter(self.links)

    def __len__(self) -> int:
        return len(self.links)


class Indexed:
    """Up to 48 children: a slot number for every byte, 0 for none."""

    __slots__ = ("slots", "links")

    def __init__(self, smaller: Sorted):
        self.slots, self.links = bytearray(256), list(smaller.links)
        for i, b in enumerate(smaller.bytes):
            self.slots[b] = i + 1

    def get(self, b: int) -> Node | None:
        return self.links[self.slots[b] - 1] if self.slots[b] else None

    def put(self, b: int, child: Node) -> Indexed | Direct:
        if self.slots[b]:
            self.links[self.slots[b] - 1] = child
        elif len(self.links) == LARGE:
            return Direct(self).put(b, child)
        else:
            self.links.append(child)
            self.slots[b] = len(self.links)
        return self

    def __iter__(self) -> Iterator[Node]:
        return (self.links[s - 1] for s in self.slots if s)

    def __len__(self) -> int:
        return len(self.links)


class Direct:
    """A link for every byte."""

    __slots__ = ("links",)

    def __init__(self, smaller: Indexed):
        self.links = [smaller.get(b) for b in range(256)]

    def get(self, b: int) -> Node | None:
        return self.links[b]

    def put(self, b: int, child: Node) -> Direct:
        self.links[b] = child
        return self

    def __iter__(self) -> Iterator[Node]:
        return (x for x in self.links if x is not None)

    def __len__(self) -> int:
        return sum(x is not None for x in self.links)


class Node:
    """A branch, or the place where a key ends (``value``), or both."""

    __slots__ = ("key", "end", "children", "value")

    def __init__(self, key: bytes, end: int, value: object = None):
        self.key, self.end, self.value = key, end, value
        self.children: Sorted | Indexed | Direct = Sorted()


def common(a: bytes, b: bytes, start: int, stop: int) -> int:
    """Up to where ``a`` and ``b``, equal before ``start``, agree; ``stop`` at most."""
    if a[start:stop] == b[start:stop]:
        return stop
    low, high = start, stop                 # equal up to low, not up to high
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


def insert(node: Node, key: bytes, stop: int) -> Node:
    """The node at which ``key[:stop]`` ends, made where there is none.
    ``node`` is one that lies on the way."""
    while node.end < stop:
        b = key[node.end]
        child = node.children.get(b)
        if child is None:
            child = Node(key, stop)
            node.children = node.children.put(b, child)
            return child
        meet = common(child.key, key, node.end, min(child.end, stop))
        if meet < child.end:                # the path parts, or the key ends, inside it
            upper = Node(key, meet)
            upper.children = upper.children.put(child.key[meet], child)
            node.children = node.children.put(b, upper)
            child = upper
        node = child
    return node


def bottom_up(root: Node) -> Iterator[tuple[Node, Node | None]]:
    """Every node after all nodes below it, with the node above it."""
    stack: list[tuple[Node, Node | None, bool]] = [(root, None, False)]
    while stack:
        node, above, done = stack.pop()
        if done:
            yield node, above
        else:
            stack.append((node, above, True))
            stack.extend((child, node, False) for child in node.children)
