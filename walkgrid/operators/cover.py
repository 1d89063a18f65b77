"""Quadtree cover of polygons: square cells that lie inside a polygon, and border cells that carry only the edges they touch.

Inside means that an odd number of edges cross a point's parallel to its east (``straddles`` and ``crossing_lng``). A border cell
answers that for its points with its own edges alone: of all other edges to its east only the parity matters, which changes at a
few latitudes, those of vertices where an edge that touches the cell goes on in one that does not. ``odd`` is that parity at the
foot of the cell, ``turns`` the latitudes above where it changes. Vertex latitudes are compared, never computed, so the answer is
the same as with all edges. Cell sides are powers of two, so that cells of positions and cells' bounds are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Degrees by which a cell is taken larger, so that rounding cannot make an edge miss it.
SLACK = 1e-9


@dataclass(frozen=True)
class Cell:
    """Square ``side * [x, x + 1) x [y, y + 1)`` with the edges (rows x1, y1, x2, y2; none horizontal) that touch it."""

    side: float
    x: int
    y: int
    edges: np.ndarray
    odd: bool
    turns: np.ndarray

    def part(self, side: float, x: int, y: int) -> Cell:
        """The cell ``x, y`` of smaller ``side`` inside this one."""
        left, right, low, high = side * x - SLACK, side * (x + 1) + SLACK, side * y - SLACK, side * (y + 1) + SLACK
        e = self.edges
        dx, dy = e[:, 2] - e[:, 0], e[:, 3] - e[:, 1]
        bottom, top = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
        across, along = (left + right) / 2, (low + high) / 2
        off = dx * (along - e[:, 1]) - dy * (across - e[:, 0])
        reach = (np.abs(dx) * (high - low) + np.abs(dy) * (right - left)) / 2
        beside = (np.maximum(e[:, 0], e[:, 2]) < left) | (np.minimum(e[:, 0], e[:, 2]) > right)
        level = (top >= low) & (bottom <= high)
        touches = level & ~beside & (np.abs(off) <= reach * (1 + 1e-9))
        rest = level & ~touches
        at = (np.maximum(bottom, low) + np.minimum(top, high)) / 2
        east = rest & (dx * (at - e[:, 1]) / dy + e[:, 0] > across)
        turns = np.concatenate((self.turns, bottom[east], top[east]))
        odd = self.odd ^ bool((turns <= side * y).sum() % 2)
        turns, times = np.unique(turns[(turns > side * y) & (turns < side * (y + 1))], return_counts=True)
        return Cell(side, x, y, e[touches], odd, turns[times % 2 == 1])

    def whole(self) -> bool:
        """Whether no edge touches the cell, nor a parallel that is one, so that ``odd`` holds for all of it."""
        return not len(self.edges) and not len(self.turns)

    def split(self, times: int) -> list[Cell]:
        """Its parts after ``times`` halvings of the side, but for those outside; a part that no edge touches is not halved again."""
        if self.whole():
            return [self] if self.odd else []
        if not times:
            return [self]
        return [c for i in (0, 1) for j in (0, 1) for c in self.part(self.side / 2, 2 * self.x + i, 2 * self.y + j).split(times - 1)]


def base_cells(rings: list, side: float) -> list[Cell]:
    """Cells of one side over a polygon's bounding box, but for those outside. Rings: lists of (lng, lat); the last vertex joins the
    first; vertices without a coordinate end no edge."""
    edges = []
    for ring in rings:
        points = np.array([(p["lng"], p["lat"]) if p is not None else (None, None) for p in ring or []], float).reshape(-1, 2)
        edges.append(np.concatenate((points, np.roll(points, -1, 0)), 1))
    all_edges = np.concatenate(edges) if edges else np.empty((0, 4))
    all_edges = all_edges[~np.isnan(all_edges).any(1) & (all_edges[:, 1] != all_edges[:, 3])]
    if not len(all_edges):
        return []
    xs, ys = all_edges[:, [0, 2]], all_edges[:, [1, 3]]
    plane = Cell(np.inf, 0, 0, all_edges, False, np.empty(0))
    out = []
    for y in range(int(np.floor(ys.min() / side)), int(np.floor(ys.max() / side)) + 1):
        for x in range(int(np.floor(xs.min() / side)), int(np.floor(xs.max() / side)) + 1):
            cell = plane.part(side, x, y)
            if cell.odd or not cell.whole():
                out.append(cell)
    return out
