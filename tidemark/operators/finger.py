"""A finger B-tree of partial aggregates keyed by event time.

Leaves hold (time, partial) pairs, and each node the combined partial of its subtree. Two fingers point at the outermost
leaves: an insert climbs from the nearer one only as far as its time lies away, then changes the partials of its
ancestors, so it costs O(log distance). `evict` drops whole subtrees left of a cut-off, and `offer` takes nothing from
before it any more.

A partial is a tuple of numbers that add up elementwise. It can be pickled, and so kept in a stream's state.
"""

from __future__ import annotations

MOST = 16


class Node:
    __slots__ = ("agg", "kids", "parent", "times", "values")

    def __init__(self, leaf: bool):
        self.times: list = []  # of a leaf: keys; of an inner node: the least key of each child
        self.values: list | None = [] if leaf else None
        self.kids: list | None = None if leaf else []
        self.agg: tuple | None = None
        self.parent: Node | None = None

    def refresh(self) -> None:
        parts = self.values if self.kids is None else [k.agg for k in self.kids]
        self.agg = add_all(parts)


def add_all(parts: list) -> tuple | None:
    parts = [p for p in parts if p is not None]
    return tuple(map(sum, zip(*parts))) if parts else None


def _position(times: list, t) -> int:
    """Index of the last entry at or before t, -1 if none; from the right, where late rows are near."""
    i = len(times) - 1
    while i >= 0 and times[i] > t:
        i -= 1
    return i


class FingerTree:
    def __init__(self) -> None:
        self.root = self.left = self.right = Node(True)
        self.floor = None

    def offer(self, t, partial: tuple) -> bool:
        """Inserts unless t lies in what was evicted; whether it did."""
        if self.floor is not None and t < self.floor:
            return False
        self.insert(t, partial)
        return True

    def insert(self, t, partial: tuple) -> None:
        """Adds a partial at time t."""
        leaf = self._leaf_for(t)
        i = _position(leaf.times, t)
        if i >= 0 and leaf.times[i] == t:
            leaf.values[i] = tuple(map(sum, zip(leaf.values[i], partial)))
        else:
            leaf.times.insert(i + 1, t)
            leaf.values.insert(i + 1, partial)
            if i < 0:
                self._lower(leaf, t)
        node = leaf
        while node is not None:
            node.agg = partial if node.agg is None else tuple(map(sum, zip(node.agg, partial)))
            node = node.parent
        if len(leaf.times) > MOST:
            self._split(leaf)

    def _leaf_for(self, t) -> Node:
        node = self.right
        if node.times and t < node.times[0]:
            if self.left.times and t <= self.left.times[-1]:
                return self.left
            while node.parent is not None and t < node.times[0]:
                node = node.parent
        while node.kids is not None:
            node = node.kids[max(0, _position(node.times, t))]
        return node

    @staticmethod
    def _lower(node: Node, t) -> None:
        while node.parent is not None:
            parent = node.parent
            i = parent.kids.index(node)
            parent.times[i] = t
            if i:
                return
            node = parent

    def _split(self, node: Node) -> None:
        while len(node.times) > MOST:
            half = len(node.times) // 2
            other = Node(node.kids is None)
            other.times, node.times = node.times[half:], node.times[:half]
            if node.kids is None:
                other.values, node.values = node.values[half:], node.values[:half]
                if self.right is node:
                    self.right = other
            else:
                other.kids, node.kids = node.kids[half:], node.kids[:half]
                for k in other.kids:
                    k.parent = other
            node.refresh()
            other.refresh()
            parent = node.parent
            if parent is None:
                parent = self.root = Node(False)
                parent.times, parent.kids, node.parent = [node.times[0]], [node], parent
                parent.agg = add_all([node.agg, other.agg])
            i = parent.kids.index(node) + 1
            parent.kids.insert(i, other)
            parent.times.insert(i, other.times[0])
            other.parent = parent
            node = parent

    def total(self, low, high) -> tuple | None:
        """The combined partial of low <= time < high."""
        return self._total(self.root, low, high)

    def _total(self, node: Node, low, high) -> tuple | None:
        if not node.times or node.times[0] >= high:
            return None
        if node.kids is None:
            return add_all([v for t, v in zip(node.times, node.values) if low <= t < high])
        parts, last = [], len(node.kids) - 1
        for i, kid in enumerate(node.kids):
            if node.times[i] >= high:
                break
            until = node.times[i + 1] if i < last else None
            if until is not None and until <= low:
                continue
            inside = node.times[i] >= low and until is not None and until <= high
            parts.append(kid.agg if inside else self._total(kid, low, high))
        return add_all(parts)

    def evict(self, before) -> None:
        """Drops all entries with time < before, whole subtrees at a time."""
        self.floor = before if self.floor is None else max(self.floor, before)
        self._evict(self.root, before)
        while self.root.kids is not None and len(self.root.kids) == 1:
            self.root = self.root.kids[0]
            self.root.parent = None
        if self.root.kids is not None and not self.root.kids:
            self.root = self.left = self.right = Node(True)
        node = self.root
        while node.kids is not None:
            node = node.kids[0]
        self.left = node
        node = self.root
        while node.kids is not None:
            node = node.kids[-1]
        self.right = node

    def _evict(self, node: Node, before) -> None:
        if not node.times or node.times[0] >= before:
            return
        if node.kids is None:
            n = sum(t < before for t in node.times)
            del node.times[:n], node.values[:n]
        else:
            n = max(0, _position(node.times, before))  # children left of this one lie before the cut-off as a whole
            del node.times[:n], node.kids[:n]
            self._evict(node.kids[0], before)
            if node.kids[0].times:
                node.times[0] = node.kids[0].times[0]
            else:
                del node.times[0], node.kids[0]
        node.refresh()

    def items(self) -> list[tuple]:
        """All (time, partial), in order."""
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if node.kids is None:
                out += zip(node.times, node.values)
            else:
                todo += reversed(node.kids)
        return out

    def __getstate__(self):
        return self.floor, self.items()

    def __setstate__(self, state) -> None:
        self.__init__()
        self.floor, items = state
        for t, v in items:
            self.insert(t, v)
