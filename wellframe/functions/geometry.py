"""Polygons as flat edge arrays and vectorised point tests."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

EARTH_RADIUS_M = 6_371_008.8


@dataclass(frozen=True)
class Region:
    """All rings of a (multi)polygon; holes and parts follow from the even-odd rule."""

    key: object
    x1: np.ndarray
    y1: np.ndarray
    x2: np.ndarray
    y2: np.ndarray

    @property
    def bounds(self) -> tuple[float, float, float, float]:
        if not len(self.x1):
            return np.inf, np.inf, -np.inf, -np.inf
        return self.x1.min(), self.y1.min(), self.x1.max(), self.y1.max()


def parse_wkt(key: object, wkt: str | None) -> Region:
    """A region from POLYGON or MULTIPOLYGON text; null, empty and unreadable texts hold no point."""
    edges = []
    for ring in re.findall(r"\(([^()]+)\)", wkt or ""):
        try:
            pts = np.array([[float(v) for v in p.split()[:2]] for p in ring.split(",")])
        except ValueError:
            continue
        if pts.ndim == 2 and pts.shape[1] == 2 and len(pts) >= 3:
            edges.append(np.hstack([pts, np.roll(pts, -1, axis=0)]))
    e = np.vstack(edges) if edges else np.zeros((0, 4))
    return Region(key, *e.T)


def inside(region: Region, x: np.ndarray, y: np.ndarray, boundary: bool = True) -> np.ndarray:
    """Which points the region holds; points on an edge count as ``boundary`` says."""
    out = np.zeros(len(x), bool)
    x_min, y_min, x_max, y_max = region.bounds
    near = np.flatnonzero((x >= x_min) & (x <= x_max) & (y >= y_min) & (y <= y_max))
    step = max(1, 2_000_000 // max(1, len(region.x1)))
    for at in range(0, len(near), step):
        i = near[at : at + step]
        px, py = x[i, None], y[i, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            crossing = region.x1 + (py - region.y1) * (region.x2 - region.x1) / (region.y2 - region.y1)
        up = (region.y1 > py) != (region.y2 > py)
        odd = (up & (px < crossing)).sum(axis=1) % 2 == 1
        cross = (region.x2 - region.x1) * (py - region.y1) - (region.y2 - region.y1) * (px - region.x1)
        within = (px >= np.minimum(region.x1, region.x2)) & (px <= np.maximum(region.x1, region.x2))
        within &= (py >= np.minimum(region.y1, region.y2)) & (py <= np.maximum(region.y1, region.y2))
        edge = ((np.abs(cross) <= 1e-12) & within).any(axis=1)
        out[i] = np.where(edge, boundary, odd)
    return out


def outline_distance_m(region: Region, x: np.ndarray, y: np.ndarray, within: float = np.inf) -> np.ndarray:
    """Metres from each point to the region's outline, on a plane around the point; infinite where its box is further than ``within``."""
    out = np.full(len(x), np.inf)
    metre = np.pi * EARTH_RADIUS_M / 180
    x_min, y_min, x_max, y_max = region.bounds
    reach = within / metre * 1.01
    wide = reach / np.maximum(0.01, np.cos(np.radians(np.abs(y) + min(reach, 80))))
    near = np.flatnonzero((x >= x_min - wide) & (x <= x_max + wide) & (y >= y_min - reach) & (y <= y_max + reach))
    step = max(1, 1_000_000 // max(1, len(region.x1)))
    for at in range(0, len(near), step):
        i = near[at : at + step]
        across = np.cos(np.radians(y[i]))[:, None] * metre
        ax, ay, bx, by = (region.x1 - x[i, None]) * across, (region.y1 - y[i, None]) * metre, (region.x2 - x[i, None]) * across, (region.y2 - y[i, None]) * metre
        dx, dy = bx - ax, by - ay
        length = dx * dx + dy * dy
        t = np.clip(-(ax * dx + ay * dy) / np.where(length > 0, length, 1), 0, 1)
        out[i] = np.hypot(ax + t * dx, ay + t * dy).min(axis=1)
    return out


def haversine_m(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Great-circle distance in metres."""
    a1, a2 = np.radians(lat1), np.radians(lat2)
    h = np.sin((a2 - a1) / 2) ** 2 + np.cos(a1) * np.cos(a2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(np.clip(h, 0, 1)))
