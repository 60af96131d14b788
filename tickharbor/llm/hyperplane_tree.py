"""A multiway hyperplane tree whose split points know how far away the subtrees beside them reach.

Rows are whole-numbered vectors compared by inner product. A row x gets one more component, so that all rows
have the length R of the longest; a query a gets a zero there. Then |a - x|**2 = |a|**2 + R**2 - 2 a.x, and
a window of scores is a ring of distances around the query.

A node has split points, and each row goes to the nearest. For every split point i and subtree j the node stores the
least and largest distance from i to the rows of j. By the triangle inequality these, with the query's distance to i,
bound the distance from the query to any row of j; a subtree whose range misses the ring is left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np

ARITY, LEAF_ROWS, DEPTH = 16, 128, 24
# Rows among which a node's split points are chosen, for each of them.
CHOICE = 4
# Share of the distances' scale that rounding may take; rings and ranges are that much wider.
SLACK = 1e-6


@dataclass
class Node:
    """Split points with their last components, distance ranges by (split point, subtree), and subtrees.

    A subtree is a node, or whatever stands for a leaf.
    """

    points: np.ndarray
    low: np.ndarray
    high: np.ndarray
    parts: list = field(default_factory=list)


def lifted(rows: np.ndarray, longest: float) -> np.ndarray:
    """Rows with the component that makes them as long as the longest, whose squared length is given."""
    rest = np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", rows, rows), 0))
    return np.column_stack([rows, rest])


def _apart(x: np.ndarray, y: np.ndarray, squared: float | np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(squared - 2 * (x @ y.T), 0))


def distances(rows: np.ndarray, points: np.ndarray, longest: float) -> np.ndarray:
    """From lifted rows to lifted split points."""
    return _apart(rows, points, 2 * longest)


def split_points(rows: np.ndarray, longest: float, arity: int) -> np.ndarray:
    """Rows far from each other, greedily, among evenly spread ones; fewer where the rest are copies of them."""
    some = rows[np.linspace(0, len(rows) - 1, min(len(rows), CHOICE * arity)).astype(np.int64)]
    chosen = [0]
    nearest = distances(some, some[:1], longest)[:, 0]
    while len(chosen) < arity:
        best = int(nearest.argmax())
        if nearest[best] <= SLACK * np.sqrt(longest):
            break
        chosen.append(best)
        nearest = np.minimum(nearest, distances(some, some[best:best + 1], longest)[:, 0])
    return some[chosen]


def split(rows: np.ndarray, longest: float, arity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Split points, distances to them, and the nearest of each row."""
    points = split_points(rows, longest, arity)
    far = distances(rows, points, longest)
    return points, far, far.argmin(axis=1)


def ranges(far: np.ndarray, nearest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest distance from each split point to the rows of each subtree."""
    size = far.shape[1]
    low, high = np.full((size, size), np.inf), np.full((size, size), -np.inf)
    for j in range(size):
        own = far[nearest == j]
        if len(own):
            low[:, j], high[:, j] = own.min(axis=0), own.max(axis=0)
    return low, high


def grow(rows: np.ndarray, longest: float, own: np.ndarray | None = None, depth: int = 0) -> Node | np.ndarray:
    """A tree whose leaves are the numbers of their rows."""
    own = np.arange(len(rows)) if own is None else own
    if len(own) <= LEAF_ROWS or depth == DEPTH:
        return own
    points, far, nearest = split(rows[own], longest, ARITY)
    if len(points) < 2:
        return own
    node = Node(points, *ranges(far, nearest))
    node.parts = [grow(rows, longest, own[nearest == j], depth + 1) for j in range(len(points))]
    return node


def rings(squares: np.ndarray, longest: float, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances that scores from ``low`` to ``high`` stand for; whole scores leave a half of room."""
    scale = squares + longest
    slack = SLACK * np.sqrt(scale)
    return (np.sqrt(np.maximum(scale - 2 * (high + 0.5), 0)) - slack, np.sqrt(np.maximum(scale - 2 * (low - 0.5), 0)) + slack)


def descend(node, queries: np.ndarray, squares: np.ndarray, longest: float, asked: np.ndarray, low: np.ndarray,
            high: np.ndarray, alive: np.ndarray, leaf: Callable) -> None:
    """Call ``leaf(part, alive)`` for every leaf with the windows that may hold rows of it.

    Window w asks for scores from low[w] to high[w] of query asked[w]; ``leaf`` may raise ``low`` as it finds rows.
    """
    if not isinstance(node, Node):
        leaf(node, alive)
        return
    own, at = np.unique(asked[alive], return_inverse=True)
    far = _apart(queries[own], node.points[:, :-1], (squares[own] + longest)[:, None])
    slack = SLACK * np.sqrt(squares[own] + longest)[:, None]
    for j, part in enumerate(node.parts):
        # Nearer than the first, or further than the second, no row of the subtree can be.
        nearest = np.max(np.maximum(node.low[:, j] - far, far - node.high[:, j]) - slack, axis=1)
        furthest = np.min(far + node.high[:, j] + slack, axis=1)
        inner, outer = rings(squares[asked[alive]], longest, low[alive], high[alive])
        missed = (nearest[at] > outer) | (furthest[at] < inner)
        if not missed.all():
            descend(part, queries, squares, longest, asked, low, high, alive[~missed], leaf)
