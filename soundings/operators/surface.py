"""Linear surfaces: Delaunay triangles of points tile by tile, and the value of grid cells in them.

A triangle whose circumcircle has a radius of ``reach`` at most has its corners, and every point that could lie in that circle, within twice that of any cell it
covers. A tile that has all points of a halo so wide finds exactly the triangles that a triangulation of all points has there; wider triangles are
gaps and give no value. So tiles need nothing of each other, and every cell belongs to one.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How far points are moved, in steps, so that no four lie on a circle: the triangulation is then one, in every tile.
MOVED = 1e-5


def triangles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Corners of the Delaunay triangles of distinct points (in a few degrees, no four on a circle), by inserting one point after the other.

    A table of directed edges holds each triangle three times: an edge and the corner to its left. Three far points surround all others; triangles with one
    of them are left out at the end."""
    n = len(x)
    if n < 3:
        return np.zeros((0, 3), np.int64)
    mx, my, far = float(x.mean()), float(y.mean()), 1e4 * max(float(np.ptp(x)), float(np.ptp(y)), 1e-9)
    xs, ys = [*(x - mx).tolist(), -far, far, 0.0], [*(y - my).tolist(), -far, -far, far]
    left: dict[tuple[int, int], int] = {}

    def put(a: int, b: int, c: int) -> None:
        left[a, b], left[b, c], left[c, a] = c, a, b

    def side(a: int, b: int, p: int) -> float:
        return (xs[b] - xs[a]) * (ys[p] - ys[a]) - (ys[b] - ys[a]) * (xs[p] - xs[a])

    def inside(a: int, b: int, c: int, p: int) -> bool:
        ax, ay, bx, by, cx, cy = xs[a] - xs[p], ys[a] - ys[p], xs[b] - xs[p], ys[b] - ys[p], xs[c] - xs[p], ys[c] - ys[p]
        return (ax * ax + ay * ay) * (bx * cy - cx * by) - (bx * bx + by * by) * (ax * cy - cx * ay) + (cx * cx + cy * cy) * (ax * by - bx * ay) > 0

    put(n, n + 1, n + 2)
    at = (n, n + 1)
    strips = max(1, int(np.sqrt(n / 2)))
    strip = np.minimum(((x - x.min()) / max(float(np.ptp(x)), 1e-9) * strips).astype(int), strips - 1)
    for p in np.lexsort((np.where(strip % 2, -y, y), strip)).tolist():  # up and down strips, so that the next point is near
        a, b = at
        c = left[a, b]
        while True:  # walk to the triangle that holds the point
            if side(a, b, p) < 0:
                a, b = b, a
            elif side(b, c, p) < 0:
                a, b = c, b
            elif side(c, a, p) < 0:
                a, b = a, c
            else:
                break
            c = left[a, b]
        todo = [(a, b), (b, c), (c, a)]
        while todo:  # triangles whose circle holds the point make room for those between their outer edges and it
            a, b = todo.pop()
            c = left.get((b, a))
            if c is not None and inside(b, a, c, p):
                del left[b, a], left[a, b]
                todo += [(a, c), (c, b)]
            else:
                left[a, b], left[b, p], left[p, a] = p, a, b
        at = (p, a)
    found = {tuple(sorted((a, b, c))) for (a, b), c in left.items() if a < n and b < n and c < n and a < b and a < c}
    return np.array(sorted(found), np.int64).reshape(-1, 3)


def circles(x: np.ndarray, y: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres and radii of the circles through the corners of triangles."""
    ax, ay = x[t[:, 0]], y[t[:, 0]]
    bx, by, cx, cy = x[t[:, 1]] - ax, y[t[:, 1]] - ay, x[t[:, 2]] - ax, y[t[:, 2]] - ay
    d = 2 * (bx * cy - by * cx)
    d = np.where(d == 0, np.nan, d)
    ux, uy = (cy * (bx * bx + by * by) - by * (cx * cx + cy * cy)) / d, (bx * (cx * cx + cy * cy) - cx * (bx * bx + by * by)) / d
    return ax + ux, ay + uy, np.hypot(ux, uy)


def _valued(x: np.ndarray, y: np.ndarray, v: np.ndarray, step: float, radius: float, reach: float, cells: tuple[int, int, int]) -> Iterable[tuple[int, int, float]]:
    """Cells of a square (first row, first column, cells each way) that lie in a triangle and within ``radius`` of a point, with their values."""
    y0, x0, n = cells
    gy, gx = (y0 + np.arange(n)) * step, (x0 + np.arange(n)) * step
    near = np.zeros((n, n), bool)
    k = int(np.ceil(radius / step)) + 1
    py, px = np.rint(y / step).astype(int), np.rint(x / step).astype(int)
    for dy in range(-k, k + 1):
        for dx in range(-k, k + 1):
            iy, ix = py + dy, px + dx
            hit = (iy >= y0) & (iy < y0 + n) & (ix >= x0) & (ix < x0 + n) & ((iy * step - y) ** 2 + (ix * step - x) ** 2 <= radius * radius)
            near[iy[hit] - y0, ix[hit] - x0] = True
    t = triangles(x, y)
    if not len(t) or not near.any():
        return
    t = t[circles(x, y, t)[2] <= reach]
    out = np.full((n, n), np.nan)
    lo_x, hi_x, lo_y, hi_y = (f(c[t], axis=1) for c in (x, y) for f in (np.min, np.max))
    lo_x, lo_y = (np.maximum(np.ceil(lo / step).astype(int) - o, 0) for lo, o in ((lo_x, x0), (lo_y, y0)))
    hi_x, hi_y = (np.minimum(np.floor(hi / step).astype(int) - o, n - 1) for hi, o in ((hi_x, x0), (hi_y, y0)))
    for i in np.flatnonzero((lo_x <= hi_x) & (lo_y <= hi_y)):
        a, b, c = t[i]
        ys, xs = gy[lo_y[i] : hi_y[i] + 1, None], gx[None, lo_x[i] : hi_x[i] + 1]
        d = (y[b] - y[c]) * (x[a] - x[c]) + (x[c] - x[b]) * (y[a] - y[c])
        wa = ((y[b] - y[c]) * (xs - x[c]) + (x[c] - x[b]) * (ys - y[c])) / d
        wb = ((y[c] - y[a]) * (xs - x[c]) + (x[a] - x[c]) * (ys - y[c])) / d
        wc = 1 - wa - wb
        own = (wa >= -1e-12) & (wb >= -1e-12) & (wc >= -1e-12)
        part = out[lo_y[i] : hi_y[i] + 1, lo_x[i] : hi_x[i] + 1]
        part[own] = (wa * v[a] + wb * v[b] + wc * v[c])[own]
    for iy, ix in np.argwhere(near & ~np.isnan(out)).tolist():
        yield y0 + iy, x0 + ix, float(out[iy, ix])


def merged_points(points: DataFrame, value: str, step: float, merge: float) -> DataFrame:
    """``x``, ``y``, ``v``: the mean place and value of the points of each square of ``merge`` degrees (0: of each position), moved by a hair."""
    own = points.where(F.col(value).isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    keys = [F.floor(F.col(c) / merge).alias(f"_{c}") if merge else F.col(c).alias(f"_{c}") for c in ("lat", "lon")]
    own = own.groupBy(*keys).agg(F.avg("lon").alias("x"), F.avg("lat").alias("y"), F.avg(value).alias("v"))
    whole = lambda c: F.floor(F.col(c) * 10_000 + 0.5).cast("long")
    hair = lambda a, b: (F.pmod(whole("x") * a + whole("y") * b, F.lit(10_007)) / 10_007.0 - 0.5) * (2 * MOVED * step)
    return own.select((F.col("x") + hair(7919, 5147)).alias("x"), (F.col("y") + hair(3571, 6007)).alias("y"), "v")


def linear_surface(points: DataFrame, value: str, step: float, radius: float, reach: float | None = None, tile_cells: int = 64, merge: float | None = None) -> DataFrame:
    """``iy``, ``ix`` and ``value`` of the cells of a grid of ``step`` degrees that lie in a Delaunay triangle of the points and within ``radius`` of one.

    Triangles with a circumcircle wider than ``reach`` (twice the radius unless given) are gaps. Points of a square of ``merge`` degrees (half a step
    unless given; 0: none) count as one, their mean: so a tile's points are bounded however many there are. Points without a position or value are left out."""
    reach, merge = 2 * radius if reach is None else reach, step / 2 if merge is None else merge
    own, side = merged_points(points, value, step, merge), tile_cells * step
    halo = max(2 * reach, radius) + step
    tiles = lambda c: F.sequence(F.floor((F.col(c) - halo) / side), F.floor((F.col(c) + halo) / side))
    dealt = own.withColumn("ty", F.explode(tiles("y"))).withColumn("tx", F.explode(tiles("x")))

    def surface(rows: pd.DataFrame) -> pd.DataFrame:
        ty, tx = int(rows["ty"].iloc[0]), int(rows["tx"].iloc[0])
        rows = rows.sort_values(["x", "y"])
        found = list(_valued(*(rows[c].to_numpy(float) for c in ("x", "y", "v")), step, radius, reach, (ty * tile_cells, tx * tile_cells, tile_cells)))
        return pd.DataFrame(found, columns=["iy", "ix", value]).astype({"iy": "int64", "ix": "int64", value: "float64"})

    return dealt.groupBy("ty", "tx").applyInPandas(surface, f"iy long, ix long, `{value}` double")
