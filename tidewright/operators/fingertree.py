"""A finger B-tree of partial aggregates keyed by event time.

Every node holds the combined partial of its subtree. An insert climbs from the finger at the newest leaf only as far as the time's
distance from the end demands, then updates the partials of the leaf's ancestors; eviction cuts whole subtrees off at the left spine.

The tree judges what is inserted: times below `edge`, up to which it was evicted, are refused; those below `mark`, up to which it was reported, are
corrections of what was reported."""

from __future__ import annotations

from bisect import bisect_left, bisect_right

WIDTH = 32  # most entries of a leaf, most children of an inner node
ON_TIME, CORRECTION, TOO_LATE = 0, 1, 2


class _Node:
    __slots__ = ("keys", "values", "children", "total", "parent")

    def __init__(self, keys: list, values: list, children: list | None, parent: _Node | None):
        self.keys, self.values, self.children, self.parent, self.total = keys, values, children, parent, 0


class FingerTree:
    """Times (any ordered keys) to partials, combined by +. In an inner node keys[i] is the least time that belongs to children[i + 1]."""

    def __init__(self):
        self.root = self.finger = _Node([], [], None, None)
        self.edge = self.mark = None

    def report(self, before) -> None:
        """From now on what comes below `before` is a correction."""
        if self.mark is None or before > self.mark:
            self.mark = before

    def add(self, time, partial, late=None) -> int:
        """Combines partial, or late if time was reported, into the entry at time. Returns ON_TIME, CORRECTION or TOO_LATE (then nothing is kept)."""
        if self.edge is not None and time < self.edge:
            return TOO_LATE
        outcome = ON_TIME
        if self.mark is not None and time < self.mark:
            outcome, partial = CORRECTION, partial if late is None else late
        node = self.finger
        while node.parent is not None and not (node.keys and node.keys[0] <= time):
            node = node.parent
        while node.children is not None:
            node = node.children[bisect_right(node.keys, time)]
        i = bisect_left(node.keys, time)
        if i < len(node.keys) and node.keys[i] == time:
            node.values[i] = node.values[i] + partial
        else:
            node.keys.insert(i, time)
            node.values.insert(i, partial)
        up = node
        while up is not None:
            up.total = up.total + partial
            up = up.parent
        while node is not None and len(node.keys if node.children is None else node.children) > WIDTH:
            node = self._split(node)
        return outcome

    def _split(self, node: _Node) -> _Node:
        half = WIDTH // 2
        if node.children is None:
            right = _Node(node.keys[half:], node.values[half:], None, node.parent)
            fence = right.keys[0]
            del node.keys[half:], node.values[half:]
            right.total = sum(right.values[1:], right.values[0])
            if self.finger is node:
                self.finger = right
        else:
            right = _Node(node.keys[half:], [], node.children[half:], node.parent)
            fence = node.keys[half - 1]
            del node.keys[half - 1 :], node.children[half:]
            right.total = 0
            for c in right.children:
                c.parent = right
                right.total = right.total + c.total
        node.total = node.total - right.total
        parent = node.parent
        if parent is None:
            self.root = parent = _Node([], [], [node], None)
            parent.total = node.total + right.total
            node.parent = right.parent = parent
        at = parent.children.index(node)
        parent.keys.insert(at, fence)
        parent.children.insert(at + 1, right)
        return parent

    def total(self, low, high):
        """The combined partial of the times from low up to, not including, high."""

        def walk(node: _Node, covered_low: bool, covered_high: bool):
            if covered_low and covered_high:
                return node.total
            if node.children is None:
                out = 0
                for v in node.values[0 if covered_low else bisect_left(node.keys, low) : len(node.keys) if covered_high else bisect_left(node.keys, high)]:
                    out = out + v
                return out
            first = 0 if covered_low else bisect_right(node.keys, low)
            last = len(node.children) - 1 if covered_high else bisect_left(node.keys, high)
            out = 0
            for i in range(first, last + 1):
                out = out + walk(node.children[i], covered_low or i > first, covered_high or i < last)
            return out

        return walk(self.root, False, False) if low < high else 0

    def evict(self, before) -> int:
        """Cuts off all times below `before`; returns how many subtrees and entries were cut."""
        if self.edge is None or before > self.edge:
            self.edge = before
        node, cuts, path = self.root, 0, []
        while node.children is not None:
            i = bisect_right(node.keys, before)
            if i:
                cuts += i
                del node.children[:i], node.keys[:i]
            path.append(node)
            node = node.children[0]
        i = bisect_left(node.keys, before)
        cuts += i
        del node.keys[:i], node.values[:i]
        node.total = sum(node.values[1:], node.values[0]) if node.values else 0
        for up in reversed(path):
            up.total = 0
            for c in up.children:
                up.total = up.total + c.total
        while self.root.children is not None and len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
        return cuts

    def items(self):
        def walk(node):
            if node.children is None:
                yield from zip(node.keys, node.values)
            else:
                for c in node.children:
                    yield from walk(c)

        return walk(self.root)
