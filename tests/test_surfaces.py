"""Surfaces, rasters and volumes against brute force on small tables."""

import itertools
import math
import os
import random
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from test_operators import clipped

from lattica.operators import raster, surfaces, volumes
from lattica.plans import QUERIES, surface_queries
from lattica.session import ship

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

CORNERS = ", ".join(f"{a}{k} double" for k in range(3) for a in "xyz")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def near(p, t):
    """The nearest place of a triangle on a fine net of weights, then refined around the best."""
    best, low, high = math.inf, (0.0, 0.0), (1.0, 1.0)
    for _ in range(14):
        for i, j in itertools.product(range(7), repeat=2):
            u, v = (a + (b - a) * k / 6 for a, b, k in zip(low, high, (i, j), strict=True))
            if u + v <= 1 + 1e-12:
                d = float(np.linalg.norm(p - (u * t[0] + v * t[1] + (1 - u - v) * t[2])))
                if d < best:
                    best, at = d, (u, v)
        wide = [(b - a) * 0.35 for a, b in zip(low, high, strict=True)]
        low, high = (tuple(max(0.0, min(1.0, c + s * w)) for c, w in zip(at, wide, strict=True)) for s in (-1, 1))
    return best


def test_nearest_triangles(spark):
    rng = random.Random(3)
    tris = [[[rng.uniform(0, 6) + o for _ in range(3)] for o in [0] * 3] for _ in range(25)]
    tris += [[[1.0, 1.0, 1.0]] * 3, [[0.0, 0.0, 0.0], [2.0, 0.0, 0.0], [4.0, 0.0, 0.0]]]  # a point and a line
    points = [[rng.uniform(-2, 8) for _ in range(3)] for _ in range(20)] + [[40.0, -30.0, 5.0], [1.0, 1.0, 1.0]]
    t = spark.createDataFrame([(i, *itertools.chain(*x)) for i, x in enumerate(tris)], f"fid int, {CORNERS}")
    p = spark.createDataFrame([(i, *x) for i, x in enumerate(points)] + [(90, None, 1.0, 1.0), (91, float("nan"), 1.0, 1.0)], "pid int, px double, py double, pz double")
    nearest = [[near(np.array(x), np.array(c)) for c in tris] for x in points]
    for cell in (0.7, 5.0):
        got = {r.pid: r for r in surfaces.nearest_triangles(p, t, cell).collect()}
        assert set(got) == {*range(len(points)), 90, 91} and got[90].fid is None and got[91].distance is None
        for i, x in enumerate(points):
            every = nearest[i]
            assert abs(got[i].distance - min(every)) < 1e-4 and every[got[i].fid] - min(every) < 1e-4
            at = sum(w * np.array(c) for w, c in zip((got[i].u, got[i].v, got[i].w), tris[got[i].fid], strict=True))
            assert abs(np.linalg.norm(at - np.array(x)) - got[i].distance) < 1e-9
    assert {r.fid for r in surfaces.nearest_triangles(p, t.limit(0), 1.0).collect()} == {None}
    assert surfaces.nearest_triangles(p.limit(0), t, 1.0).count() == 0


def test_nearest_without_broadcast(spark):
    """Points and triangles may both be large: no join collects a side in the driver, however small Spark takes it to be."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsList().size()
    faces = spark.createDataFrame([(i, 3 * i, 3 * i + 1, 3 * i + 2) for i in range(20)], "fid int, v0 int, v1 int, v2 int")
    vertices = spark.createDataFrame([(i, float(i % 7), float(i % 5), float(i % 3)) for i in range(60)], "vid int, x double, y double, z double")
    points = spark.createDataFrame([(i, i * 0.3, 1.0, i * 9.0) for i in range(20)], "pid int, px double, py double, pz double")
    found = surfaces.nearest_triangles(points, surfaces.corners_of(faces, vertices), 1.0)
    assert found.filter("distance is not null").count() == 20
    made = store.executionsList()
    plans = [made.apply(k).physicalPlanDescription() for k in range(before, made.size())]
    assert any("SortMergeJoin" in x for x in plans) and not any("BroadcastHashJoin" in x for x in plans)


def net(n, holes):
    """Faces of an n x n net of vertices without the quads in ``holes``."""
    quads = [(i, j) for i in range(n - 1) for j in range(n - 1) if (i, j) not in holes]
    return [f for i, j in quads for f in ((i * n + j, (i + 1) * n + j, i * n + j + 1), (i * n + j + 1, (i + 1) * n + j, (i + 1) * n + j + 1))]


def framed(spark, faces, vertices):
    f = spark.createDataFrame([(i, *x) for i, x in enumerate(faces)], "fid long, v0 long, v1 long, v2 long")
    return f, spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(vertices)], "vid long, x double, y double, z double")


def test_boundary_loops(spark):
    n = 9
    faces = net(n, {(2, 2), (5, 5), (5, 6), (1, 5), (2, 6)})  # the last two touch at a vertex: chains through it are left out
    f, v = framed(spark, faces, [(i // n, i % n, 0) for i in range(n * n)])
    loops = {}
    for r in surfaces.boundary_loops(f).collect():
        loops.setdefault(r.loop, set()).add((r.s, r.e))
    sizes = {k: len(x) for k, x in loops.items()}
    assert sizes == {0: 4 * (n - 1), 2 * n + 2: 4, 5 * n + 5: 6}
    for edges in loops.values():
        after = dict(edges)
        start = at = next(iter(after))
        for _ in range(len(after)):
            at = after[at]
        assert at == start and len(after) == len(edges)
    of = {r.loop: r for r in surfaces.measured(surfaces.boundary_loops(f), v).collect()}
    assert of[5 * n + 5].perimeter == 6.0 and (of[2 * n + 2].cx, of[2 * n + 2].cy) == (2.5, 2.5)
    faces2, vertices2 = surfaces.filled(f, v, 6.0)
    rows = faces2.collect()
    assert len(rows) == len(faces) + 10 and len({r.fid for r in rows}) == len(rows) and vertices2.count() == n * n + 2
    assert {len(x) for x in [{(r.s, r.e) for r in surfaces.boundary_edges(faces2).collect()}]} == {4 * (n - 1) + 8}


def test_closed_mesh(spark):
    corners = [(1, 0, 0), (0, 1, 0), (-1, 0, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)]
    faces = [(0, 1, 4), (1, 2, 4), (2, 3, 4), (3, 0, 4), (1, 0, 5), (2, 1, 5), (3, 2, 5), (0, 3, 5)]
    f, v = framed(spark, faces, corners)
    assert surfaces.boundary_loops(f).count() == 0
    assert surfaces.filled(f, v)[0].count() == 8 and surfaces.boundary_loops(f.limit(0)).count() == 0
    for gone in ([0], [0, 1], [0, 6], [0, 1, 2, 3]):
        open_, v = framed(spark, [x for i, x in enumerate(faces) if i not in gone], corners)
        closed, _ = surfaces.filled(open_, v)
        assert surfaces.boundary_edges(closed).count() == 0
        ways = [(r[p], r[q]) for r in closed.collect() for p, q in (("v0", "v1"), ("v1", "v2"), ("v2", "v0"))]
        assert len(set(ways)) == len(ways)  # every edge once in each direction: the new faces look outwards as well


def test_raster(spark):
    rng = random.Random(5)
    view = ((0.98, 0.0, 0.199, 0.1), (0.0, 1.0, 0.0, -0.2), (-0.199, 0.0, 0.98, 3.0), (0.0, 0.0, 0.0, 1.0))
    camera = raster.Camera(view, 40, 24, 0.8, 0.9, 0.5, 0.5)
    boxes = [(i, *(round(rng.uniform(-2, 2), 3) for _ in range(3))) for i in range(150)] + [(200, 0.0, 0.0, -3.1), (201, None, 0.0, 0.0)]
    df = spark.createDataFrame(boxes, "id int, x double, y double, z double")
    got = {(r.py, r.px): (r.id, round(r.distance, 9)) for r in raster.rasterised(df, camera, 0.3, tile=8).collect()}
    want = {}
    for y, x in itertools.product(range(24), range(40)):
        ray = camera.rays(np.array([x]), np.array([y]))
        for depth, i, middle in sorted((float(np.array(view)[2] @ np.array([*m, 1])), i, m) for i, *m in boxes if None not in m):
            entry, leave = raster.passed(camera.origin, ray, np.array([middle]), 0.3)
            if depth > 0.2 and leave[0, 0] > entry[0, 0]:
                want[(y, x)] = (i, round(float(entry[0, 0]), 9))
                break
    assert got == want and len(got) > 100
    parts, raster.PART = raster.PART, 5  # crowded tiles in several parts
    try:
        assert {(r.py, r.px): (r.id, round(r.distance, 9)) for r in raster.rasterised(df, camera, 0.3, tile=8).collect()} == want
    finally:
        raster.PART = parts
    assert raster.rasterised(df.limit(0), camera, 0.3).count() == 0


def passes(one, two, cell):
    """Whether a segment has a stretch within a unit cell."""
    low, high = 0.0, 1.0
    for a, b, c in zip(one, two, cell, strict=True):
        if a == b:
            if not c <= a <= c + 1:
                return False
            continue
        near, far = sorted(((c - a) / (b - a), (c + 1 - a) / (b - a)))
        low, high = max(low, near), min(high, far)
    return high - low > 1e-9


@pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")
def test_surface_dual_grid(spark):
    """The whole query: crossings, flags and vertices against loops over lines, cells, planes and borders."""
    tris = [np.array([r[f"{a}{k}"] for k in range(3) for a in "xyz"]).reshape(3, 3) for r in surface_queries.textured(spark, SF).collect()]
    cells = defaultdict(lambda: {"flags": [False] * 3, "points": [], "q": np.zeros((3, 3)), "b": np.zeros(3)})
    boxes = lambda p: itertools.product(*[range(int(np.floor(p[:, a].min())), int(np.floor(p[:, a].max())) + 1) for a in range(3)])
    extra = []
    for p in tris:
        n = np.cross(p[1] - p[0], p[2] - p[0])
        n /= np.linalg.norm(n)
        for axis in range(3):
            a, b = (axis + 1) % 3, (axis + 2) % 3
            for i, j in itertools.product(*[range(int(np.floor(p[:, k].min())) + 1, int(np.floor(p[:, k].max())) + 1) for k in (a, b)]):
                if abs(n[axis]) < 1e-12:
                    continue
                w = np.linalg.solve(np.array([p[:, a], p[:, b], np.ones(3)]), [i, j, 1])
                if (w > 0).all():
                    at = w @ p
                    for di, dj in itertools.product((1, 0), repeat=2):
                        c = [0, 0, 0]
                        c[axis], c[a], c[b] = int(np.floor(at[axis])), i - di, j - dj
                        got = cells[tuple(c)]
                        got["flags"][axis] |= di + dj == 2
                        got["points"].append(at)
                        got["q"] += np.outer(n, n)
                        got["b"] += n * (n @ p[0])
        extra += [(c, np.outer(n, n), n * (n @ p[0])) for c in boxes(p) if clipped(p, c)]
    for r in surface_queries.borders(spark, SF).collect():
        p = np.array([r[f"{a}{k}"] for k in (0, 1) for a in "xyz"]).reshape(2, 3)
        d = (p[1] - p[0]) / np.linalg.norm(p[1] - p[0])
        across = np.eye(3) - np.outer(d, d)
        extra += [(c, across, across @ p[0]) for c in boxes(p) if passes(*p, c)]
    for c, q, b in extra:
        if c in cells:
            cells[c]["q"] += q
            cells[c]["b"] += b
    found = QUERIES["surface_dual_grid"](spark, SF).collect()
    assert {(r.x, r.y, r.z): (r.n, [r.ix, r.iy, r.iz]) for r in found} == {c: (len(v["points"]), v["flags"]) for c, v in cells.items() if min(c) >= 0}
    for r in found:
        of = cells[(r.x, r.y, r.z)]
        n = len(of["points"])
        q, b = of["q"] + 0.1 * n * np.eye(3), of["b"] + 0.1 * n * np.mean(of["points"], axis=0)
        corner, v = np.array([r.x, r.y, r.z]), np.array([r.vx, r.vy, r.vz])
        steps = corner + np.array(list(itertools.product(np.linspace(0, 1, 7), repeat=3)))
        cost = lambda x: np.einsum("...i,ij,...j", x, q, x) / 2 - x @ b  # noqa: E731, B023
        assert cost(v) <= cost(steps).min() + 1e-5 and (v >= corner - 1e-6).all() and (v <= corner + 1 + 1e-6).all()


def test_taps():
    """Texels and weights against a plain sampler of one texture."""
    rng = np.random.default_rng(2)
    for size, mode, linear in itertools.product((1, 8), ("repeat", "clamp", "mirror"), (True, False)):
        image = rng.integers(0, 256, (size, size)).astype(float)
        levels = [image]
        while len(levels[-1]) > 1:
            x = levels[-1]
            levels.append((x[::2, ::2] + x[1::2, ::2] + x[::2, 1::2] + x[1::2, 1::2]) // 4)

        def texel(t, y, x, mode=mode):
            n = len(t)
            fold = lambda i: min(max(i, 0), n - 1) if mode == "clamp" else i % n if mode == "repeat" else (i % (2 * n) if i % (2 * n) < n else 2 * n - 1 - i % (2 * n))  # noqa: E731, B023
            return t[fold(y), fold(x)]

        def plain(t, u, v):
            x, y = u * len(t) - 0.5, (1 - v) * len(t) - 0.5
            i, j = math.floor(x), math.floor(y)
            return sum(texel(t, j + b, i + a) * (x - i if a else 1 - x + i) * (y - j if b else 1 - y + j) for a in (0, 1) for b in (0, 1))

        u, v = rng.uniform(-2, 3, 60), rng.uniform(-2, 3, 60)
        length = np.concatenate([rng.uniform(0, 2, 57), [0.0, np.inf, np.nan]])
        row, level, ty, tx, w = volumes.taps(u, v, length, np.full(60, size), np.full(60, linear), np.full(60, mode), 0.25)
        got = np.zeros(60)
        for r, k, y, x, s in zip(row, level, ty, tx, w, strict=True):
            got[int(r)] += levels[int(k)][int(y), int(x)] * s
        for i in range(60):
            if not linear:
                want = texel(image, math.floor((1 - v[i]) * size), math.floor(u[i] * size))
            else:
                wanted = math.log2(length[i] * size) + 0.25 if 0 < length[i] < math.inf else 0.0
                at = min(max(wanted, 0.0), len(levels) - 1.0)
                low = math.floor(at)
                want = plain(levels[low], u[i], v[i]) * (1 - at + low) + (plain(levels[low + 1], u[i], v[i]) * (at - low) if at > low else 0)
            assert abs(got[i] - want) < 1e-9
