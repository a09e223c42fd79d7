"""K-d trees over letter counts, and what one edit can do to them.

Replacing a letter takes one from one count and adds one to another; deleting a letter takes one. So a word's near words
lie within an L1 distance of two, with at most one count up and one down: a box further away, either way, is pruned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: a-z have a count each, all other characters one for each remainder of their code point by 64.
DIMENSIONS = 26 + 64
#: Points below which a node isn't split.
BUCKET = 24


def code_points(words: list[str]) -> np.ndarray:
    """A row of code points for each of ``words``, all of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def letter_counts(points: np.ndarray) -> np.ndarray:
    """Counts per dimension of each row of code points."""
    rows, width = points.shape
    at = np.where((points >= 97) & (points <= 122), points - 97, 26 + points % 64).astype(np.int64)
    at += np.arange(rows)[:, None] * DIMENSIONS
    counts = np.bincount(at.ravel(), minlength=rows * DIMENSIONS).reshape(rows, DIMENSIONS)
    return counts.astype(np.int16 if width < 1 << 15 else np.int32)


def widest(counts: np.ndarray) -> tuple[int, int] | None:
    """The dimension of greatest variance, and the count that parts it best in halves; None if all are equal."""
    spread = counts.var(axis=0)
    dimension = int(spread.argmax())
    if spread[dimension] == 0:
        return None
    column = counts[:, dimension]
    middle = min(int(np.median(column)), int(column.max()) - 1)
    if middle > column.min():  # the median, or one below, whichever leaves more equal halves
        middle = min((middle, middle - 1), key=lambda t: abs(2 * int((column <= t).sum()) - len(column)))
    return dimension, middle


@dataclass
class Split:
    """Counts up to ``at`` go left, others right; ``low`` and ``high`` bound the node's box in that dimension."""

    dimension: int
    at: int
    low: float
    high: float
    left: Split | int
    right: Split | int


def grow(sample: np.ndarray, words: float, most: float, leaves: list[float]) -> Split | int:
    """The upper part of a tree, over a sample of ``words`` words; leaves of about ``most`` words are numbered on into ``leaves``."""

    def node(rows: np.ndarray, bounds: dict[int, tuple[float, float]]) -> Split | int:
        share = words * len(rows) / max(1, len(sample))
        found = widest(rows) if share > most and len(rows) >= 4 else None
        if found is None:
            leaves.append(share)
            return len(leaves) - 1
        dimension, at = found
        low, high = bounds.get(dimension, (-np.inf, np.inf))
        goes_left = rows[:, dimension] <= at
        return Split(dimension, at, low, high, node(rows[goes_left], bounds | {dimension: (low, at)}), node(rows[~goes_left], bounds | {dimension: (at + 1, high)}))

    return node(sample, {})


def home(tree: Split | int, counts: np.ndarray) -> np.ndarray:
    """The leaf of each row of counts."""
    out = np.empty(len(counts), dtype=np.int64)
    todo = [(tree, np.arange(len(counts)))]
    while todo:
        node, rows = todo.pop()
        if isinstance(node, Split):
            goes_left = counts[rows, node.dimension] <= node.at
            todo += [(node.left, rows[goes_left]), (node.right, rows[~goes_left])]
        else:
            out[rows] = node
    return out


def reached(tree: Split | int, counts: np.ndarray, most_up: int, most_down: int) -> Iterator[tuple[int, np.ndarray]]:
    """Leaves, each with the rows whose counts reach its box by raising ``most_up`` letters and lowering ``most_down``."""
    todo = [(tree, np.arange(len(counts)), np.zeros(len(counts)), np.zeros(len(counts)))]
    while todo:
        node, rows, up, down = todo.pop()
        if not len(rows):
            continue
        if not isinstance(node, Split):
            yield node, rows
            continue
        c = counts[rows, node.dimension]
        for child, low, high in ((node.left, node.low, node.at), (node.right, node.at + 1, node.high)):
            # what the box costs in this dimension now, in place of what it cost before the split
            raised = up + np.maximum(low - c, 0) - np.maximum(node.low - c, 0)
            lowered = down + np.maximum(c - high, 0) - np.maximum(c - node.high, 0)
            keep = (raised <= most_up) & (lowered <= most_down)
            todo.append((child, rows[keep], raised[keep], lowered[keep]))


class PointTree:
    """A tree over points, with the box that its points fill at each node."""

    def __init__(self, counts: np.ndarray):
        #: the dimensions in which points differ; in the others all of them have one count
        self.varying = np.flatnonzero((counts != counts[:1]).any(axis=0))
        self.fixed = np.setdiff1d(np.arange(counts.shape[1]), self.varying)
        self.common = counts[0, self.fixed]
        self.counts = np.ascontiguousarray(counts[:, self.varying])
        self.root = self._node(np.arange(len(counts)))

    def _node(self, rows: np.ndarray):
        own = self.counts[rows]
        low, high = (own.min(axis=0), own.max(axis=0)) if own.shape[1] else (own[:0], own[:0])
        found = widest(own) if len(rows) > BUCKET and own.shape[1] else None
        if found is None:
            return low, high, rows, None
        goes_left = own[:, found[0]] <= found[1]
        return low, high, self._node(rows[goes_left]), self._node(rows[~goes_left])

    def near(self, queries: np.ndarray, most_up: int, most_down: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query row, point row) within the bounds, all of them, in blocks."""
        apart = self.common - queries[:, self.fixed]
        up, down = np.maximum(apart, 0).sum(axis=1), np.maximum(-apart, 0).sum(axis=1)
        inside = queries[:, self.varying]
        start = np.flatnonzero((up <= most_up) & (down <= most_down))
        todo = [(self.root, start)]
        while todo:
            (low, high, left, right), rows = todo.pop()
            if low.size:
                q = inside[rows]
                keep = (np.maximum(low - q, 0).sum(axis=1) + up[rows] <= most_up) & (np.maximum(q - high, 0).sum(axis=1) + down[rows] <= most_down)
                rows = rows[keep]
            if not len(rows):
                continue
            if right is not None:
                todo += [(left, rows), (right, rows)]
                continue
            for at in range(0, len(left), BUCKET):
                points = left[at : at + BUCKET]
                for some in np.array_split(rows, -(-len(rows) // 4096)):
                    apart = self.counts[points][None, :, :] - inside[some][:, None, :]
                    met = (np.maximum(apart, 0).sum(axis=2) + up[some][:, None] <= most_up) & (np.maximum(-apart, 0).sum(axis=2) + down[some][:, None] <= most_down)
                    which, point = np.nonzero(met)
                    yield some[which], points[point]


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of code points, of one length, that differ in exactly one place."""
    return (a != b).sum(axis=1) == 1


def one_deleted(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Rows in which ``longer``, by one character, gives ``shorter`` without one of its characters."""
    head = np.logical_and.accumulate(longer[:, :-1] == shorter, axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((longer[:, 1:] == shorter)[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= shorter.shape[1]
