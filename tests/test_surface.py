"""The tiled surface against all empty circles of the whole set, on points that lie across tile borders."""

import itertools
import random

import numpy as np
import pytest

from soundings.operators import environment, surface


def every_triangle(x, y):
    """Triples whose circle holds no other point."""
    out = []
    for t in itertools.combinations(range(len(x)), 3):
        cx, cy, r = (float(c[0]) for c in surface.circles(x, y, np.array([t])))
        d = np.hypot(x - cx, y - cy)
        d[list(t)] = np.inf
        if r == r and d.min() > r:
            out.append((t, r))
    return out


@pytest.mark.parametrize("n", [3, 4, 30, 45])
def test_triangles_have_empty_circles(n):
    rng = np.random.default_rng(n)
    x, y = rng.uniform(0, 4, n), rng.uniform(0, 3, n)
    x[: n // 3] = x[: n // 3].round(0) + rng.uniform(-1e-6, 1e-6, n // 3)  # nearly a lattice
    assert {tuple(sorted(t)) for t in surface.triangles(x, y).tolist()} == {t for t, r in every_triangle(x, y) if r < 100} | {tuple(sorted(t)) for t in surface.triangles(x, y).tolist() if surface.circles(x, y, np.array([t]))[2][0] >= 100}


def test_many_points_make_a_full_triangulation():
    rng = np.random.default_rng(1)
    x, y = rng.uniform(0, 10, 5000), rng.uniform(0, 10, 5000)
    t = surface.triangles(x, y)
    area = np.abs((x[t[:, 1]] - x[t[:, 0]]) * (y[t[:, 2]] - y[t[:, 0]]) - (y[t[:, 1]] - y[t[:, 0]]) * (x[t[:, 2]] - x[t[:, 0]])).sum() / 2
    assert 99 < area < 100 and len(surface.triangles(x[:2], y[:2])) == 0


@pytest.mark.parametrize("tile_cells", [3, 64])
def test_surface_is_that_of_all_points_together(spark, tile_cells):
    rng = random.Random(4)
    rows = [(rng.uniform(-3, 3), rng.uniform(-3, 3), rng.uniform(1, 9)) for _ in range(36)] + [(50.0, 50.0, 1.0), (None, 1.0, 2.0), (0.0, 0.0, None)]
    step, radius, reach = 0.25, 0.6, 1.1
    df = spark.createDataFrame(rows, "lat double, lon double, v double")
    got = {(r.iy, r.ix): r.v for r in surface.linear_surface(df, "v", step, radius, reach, tile_cells, merge=0).collect()}
    p = surface.merged_points(df, "v", step, 0).toPandas()
    x, y, v = (p[c].to_numpy() for c in ("x", "y", "v"))
    kept = [t for t, r in every_triangle(x, y) if r <= reach]
    want = {}
    for iy in range(-20, 220):
        for ix in range(-20, 220):
            qx, qy = ix * step, iy * step
            if np.hypot(x - qx, y - qy).min() > radius:
                continue
            for a, b, c in kept:
                d = (y[b] - y[c]) * (x[a] - x[c]) + (x[c] - x[b]) * (y[a] - y[c])
                wa, wb = ((y[b] - y[c]) * (qx - x[c]) + (x[c] - x[b]) * (qy - y[c])) / d, ((y[c] - y[a]) * (qx - x[c]) + (x[a] - x[c]) * (qy - y[c])) / d
                if min(wa, wb, 1 - wa - wb) >= 0:
                    want[iy, ix] = wa * v[a] + wb * v[b] + (1 - wa - wb) * v[c]
    assert want and set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_planes_and_empty_tables(spark):
    rows = [(i / 3 + 0.01 * j, j / 3, 100 + i / 3 + 0.01 * j + 2 * j / 3, 0) for i in range(12) for j in range(12)]
    df = spark.createDataFrame(rows, "lat double, lon double, v double, event_id long")
    got = environment.grid_surface(df, "v", 0.2, 0.5, "linear").collect()
    assert len(got) > 200 and all(abs(r.v - (100 + 0.2 * r.iy + 0.4 * r.ix)) < 1e-3 for r in got)
    assert surface.linear_surface(df.limit(0), "v", 0.2, 0.5).count() == 0
