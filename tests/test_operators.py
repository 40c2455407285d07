"""Golden values, round trips and properties of the operators."""

import itertools
import random
import time

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lattica.functions import expr
from lattica.operators import attention, filters, geometry, logs, mapping, numbering, registry, sampling, sparse, spatial, textures
from lattica.plans import QUERIES
from lattica.session import ship
from lattica.sources import files, voxels
from lattica.streaming import records, state


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect())


def grid(spark, n, **more):
    axis = lambda a: spark.range(n).select(F.col("id").cast("int").alias(a))
    return axis("x").crossJoin(axis("y")).crossJoin(axis("z")).withColumns({"b": F.lit(0)} | {k: F.lit(v) for k, v in more.items()})


# registry


def test_combine_first(spark):
    left = spark.createDataFrame([("a", None), ("c", 1)], "k string, x int")
    right = spark.createDataFrame([("a", 8), ("b", 9)], "k string, x int")
    assert rows(registry.combine_first(left, right, "k"), "k", "x") == [("a", 8), ("b", 9), ("c", 1)]
    assert rows(registry.combine_first_many([left, right], "k"), "k", "x") == [("a", 8), ("b", 9), ("c", 1)]
    assert rows(registry.combine_first(left, left, "k"), "k") == ["a", "c"]


def test_flags(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "i int, flag boolean")
    assert rows(df.filter(registry.done("flag")), "i") == [1]
    assert rows(df.filter(registry.pending("flag")), "i") == [2, 3]
    assert rows(registry.where_column(df, "none", F.lit(False)), "i") == [1, 2, 3]


def test_nan_is_below_every_bound(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 5.0), (4, 4.0)], "i int, v double")
    assert rows(df.filter(registry.at_least("v", 5)), "i") == [3]


def test_upsert_ignores_order(spark):
    data = [(1, 3, None, "z"), (1, 1, 5, "x"), (1, 2, 6, None)]
    for order in itertools.permutations(data):
        df = spark.createDataFrame(list(order), "k int, seq int, a int, c string")
        assert [tuple(r) for r in registry.upsert(df, "k", "seq").collect()] == [(1, 6, "z")]


# numbering


@pytest.mark.parametrize("n,world", [(10, 4), (0, 3), (5, 8), (64, 8)])
def test_shards(spark, n, world):
    df = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    keys = rows(df, "k")
    parts = [rows(numbering.shard_slice(df, "k", r, world), "k") for r in range(world)]
    assert [k for p in parts for k in p] == keys
    assert [len(p) for p in parts] == [n * (r + 1) // world - n * r // world for r in range(world)]
    ranked = {r.k: r["rank"] for r in numbering.shard_bounds(df, "k", world).collect()}
    assert all(ranked[k] == r for r, p in enumerate(parts) for k in p)
    padded = numbering.strided(df, "k", world, pad=True).collect()
    want = [keys[i % n] for i in range(-(-n // world) * world)] if n else []
    assert sorted((r["rank"], r.slot, r.k) for r in padded) == sorted((i % world, i // world, k) for i, k in enumerate(want))


def test_epochs_differ(spark):
    df = spark.range(50).select(F.col("id").alias("k"))
    one, two = ({r.k: r.place for r in numbering.epoch_order(df, "k", 1, e).collect()} for e in (0, 1))
    assert sorted(one.values()) == sorted(two.values()) == list(range(50)) and one != two


# curves and integers


def test_zorder_golden(spark):
    df = spark.createDataFrame([(0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1), (1023, 1023, 1023)], "x int, y int, z int")
    assert [r.c for r in df.select(expr.zorder("x", "y", "z").alias("c")).collect()] == [0, 4, 2, 1, 2**30 - 1]


def test_curves_round_trip(spark):
    rng = random.Random(1)
    points = [tuple(rng.randrange(1024) for _ in range(3)) for _ in range(300)] + [(0, 0, 0), (1023, 1023, 1023), (1023, 0, 512)]
    df = spark.createDataFrame(points, "x int, y int, z int")
    for permute in itertools.permutations(range(3)):
        back = df.withColumn("c", expr.zorder("x", "y", "z", permute)).select(*[c.alias(a) for c, a in zip(expr.zorder_back("c", permute), "xyz", strict=True)])
        assert rows(back, "x", "y", "z") == sorted(points)
    back = df.withColumn("c", expr.hilbert("x", "y", "z")).select(expr.hilbert_back("c").alias("p")).select("p.*")
    assert rows(back, "p0", "p1", "p2") == sorted(points)


def test_hilbert_is_a_path(spark):
    df = grid(spark, 8).select(expr.hilbert("x", "y", "z", bits=3).alias("c"), "x", "y", "z")
    path = rows(df, "c", "x", "y", "z")
    assert [p[0] for p in path] == list(range(512))
    assert all(sum(abs(a - b) for a, b in zip(p[1:], q[1:], strict=True)) == 1 for p, q in itertools.pairwise(path))


def test_floor_division(spark):
    df = spark.createDataFrame([(v,) for v in range(-9, 10)], "v int")
    assert [r.q for r in df.select(expr.floordiv("v", 4).alias("q")).collect()] == [v // 4 for v in range(-9, 10)]


def test_linear_index(spark):
    df = grid(spark, 4).withColumn("c", expr.linear([("b", 2), ("x", 4), ("y", 4), ("z", 4)]))
    back = df.select("x", "y", "z", *[c.alias(f"r{k}") for k, c in enumerate(expr.linear_back("c", [2, 4, 4, 4]))])
    assert all((r.x, r.y, r.z) == (r.r1, r.r2, r.r3) for r in back.collect())


# sparse tensors


def test_block_golden(spark):
    block = grid(spark, 2).withColumn("f", (F.col("x") + 2 * F.col("y") + 4 * F.col("z") + 1).cast("double"))
    one = sparse.downsampled(block, 2, mean=F.avg("f"), top=F.max("f")).first()
    assert (one["mean"], one.top) == (4.5, 8.0)
    assert [sparse.to_channels(block, "f").first()[f"c{k}"] for k in range(8)] == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]
    octree = geometry.octree_bytes(block.select("b", expr.zorder("x", "y", "z").alias("c")), "b", "c", 2).first().octree
    assert bytes(octree) == bytes([1, 255])


def test_down_and_up(spark):
    rng = random.Random(2)
    points = {tuple(rng.randrange(16) for _ in range(3)) for _ in range(200)}
    df = spark.createDataFrame([(0, *p) for p in points], "b int, x int, y int, z int")
    assert rows(sparse.upsampled(sparse.subdivision(df)), "x", "y", "z") == sorted(points)


@pytest.mark.parametrize("depth", [2, 3, 5])
def test_octree_round_trip(spark, depth):
    rng = random.Random(3)
    leaves = [(g, c) for g in range(3) for c in sorted({rng.randrange(8**depth) for _ in range(30)})]
    df = spark.createDataFrame(leaves, "g int, c long")
    assert rows(geometry.octree_leaves(geometry.octree_bytes(df, "g", "c", depth), "g", depth), "g", "code") == leaves


def test_sibling_deltas_golden(spark):
    """Leaves 0, 1, 9, 10 at depth 2: 1 follows 0; 9 starts the subtree after that of 0; 10 follows 9."""
    ship(spark)
    df = spark.createDataFrame([(0, 0, 10), (0, 1, 13), (0, 9, 5), (0, 10, 4)], "c int, code long, v int")
    deltas = filters.sibling_deltas(df, "c", "code", "v", 2)
    assert rows(deltas, "code", "delta") == [(0, 10), (1, 3), (9, 251), (10, 255)]
    assert rows(filters.sibling_values(deltas, "c", "code", "delta", 2), "code", "value") == [(0, 10), (1, 13), (9, 5), (10, 4)]


def test_neighbour_values(spark):
    """A later neighbour of the fixed order overrides an earlier one, and bytes wrap around."""
    ship(spark)
    df = spark.createDataFrame([(0, 0, 0, 0, 250), (0, 1, 0, 0, 10), (0, 0, 1, 0, 1), (0, 1, 1, 0, 7)], "c int, x int, y int, z int, d int")
    assert rows(filters.neighbour_values(df, "c", "d"), "x", "y", "value") == [(0, 0, 250), (0, 1, 251), (1, 0, 4), (1, 1, 1)]


def test_row_function_errors(spark):
    ship(spark)
    df = spark.createDataFrame([(1, 2), (2, 0)], "k int, v int")
    got = mapping.mapped(df, "k", lambda r: {"w": 10 // r["v"]}, "w long")
    assert [(r.k, r.w, r.error and r.error.split(":")[0]) for r in got.orderBy("k").collect()] == [(1, 5, None), (2, None, "ZeroDivisionError")]


def test_fallback(spark):
    df = spark.createDataFrame([(i, i % 3 == 0 if i else None) for i in range(20)], "k long, good boolean")
    used = {r.k: r.used for r in mapping.with_fallback(df, "k", "good").collect()}
    assert set(used) == set(range(20)) and all(u % 3 == 0 and u for u in used.values()) and all(used[k] == k for k in range(3, 20, 3))
    assert {r.used for r in mapping.with_fallback(df.filter("false").union(df.filter("not good")), "k", "good").collect()} == {None}


def test_resumed(spark):
    df = spark.range(30).select(F.col("id").alias("k"))
    whole = {r.k: r.place for r in numbering.epoch_order(df, "k", 3, 1).collect()}
    rest = {r.k: r.place for r in mapping.resumed(df, "k", 3, 1, 12).collect()}
    assert rest == {k: p for k, p in whole.items() if p >= 12} and len(rest) == 18


def test_layout(spark):
    df = spark.createDataFrame([(b,) for b in [0, 0, 2, 2, 2, 5]], "b int")
    assert rows(sparse.layout(df), "b", "n", "start", "stop") == [(0, 2, 0, 2), (2, 3, 2, 5), (5, 1, 5, 6)]


def test_quad_golden(spark):
    df = grid(spark, 2).withColumn("v", F.col("x") * 4 + F.col("y") * 2 + F.col("z"))
    found = spatial.quads(df, "z", "v").collect()
    assert {(r.x, r.y, r.z, r.q0, r.q1, r.q2, r.q3) for r in found} == {(0, 0, 0, 0, 2, 6, 4), (0, 0, 1, 1, 3, 7, 5)}
    assert spatial.triangles_of(spatial.quads(df, "x", "v")).count() == 4


def test_around(spark):
    """Neighbours against a loop, with cells that have no row."""
    rng = random.Random(1)
    cells = {(b, *c) for b in range(2) for c in itertools.product(range(4), repeat=3) if rng.random() < 0.5}
    df = spark.createDataFrame([(*c, i) for i, c in enumerate(sorted(cells))], "b int, x int, y int, z int, v int")
    moves = [(1, 0, 0), (0, -1, 1), (0, 0, 2)]
    got = spatial.around(df, moves, ["v"], own=spatial.at_move(-1, "v"), total=F.sum("v"), **{f"m{k}": spatial.at_move(k, "v") for k in range(3)}).collect()
    number = {c: i for i, c in enumerate(sorted(cells))}
    assert len(got) == len(cells)
    for r in got:
        near = [number.get((r.b, r.x + dx, r.y + dy, r.z + dz)) for dx, dy, dz in moves]
        assert (r.own, [r.m0, r.m1, r.m2]) == (number[r.b, r.x, r.y, r.z], near) and r.total == r.own + sum(v for v in near if v is not None)


def test_dual_mesh(spark):
    """A closed box of crossed edges gives a closed mesh; the flatter diagonal or the heavier corners split a quad."""
    df = grid(spark, 3).withColumn("vid", F.expr("x * 9 + y * 3 + z")).withColumns({f"v{a}": F.col(a) + 0.5 for a in "xyz"})
    inner = {"x": "y = 0 and z = 0", "y": "x = 0 and z = 0", "z": "x = 0 and y = 0"}
    none = df.withColumns({f"i{a}": F.expr(c) for a, c in inner.items()})
    found = spatial.dual_mesh(none).collect()
    assert len(found) == 2 * 9 and {(r.axis, r.x if r.axis == "x" else r.y if r.axis == "y" else r.z) for r in found} == {(a, k) for a in "xyz" for k in range(3)}
    one = df.withColumns({"ix": F.lit(False), "iy": F.lit(False), "iz": F.expr("x = 0 and y = 0 and z = 0"), "w": F.when(F.col("vid").isin(0, 12), 2.0).otherwise(1.0)})
    corners = lambda d: sorted((r.v0, r.v1, r.v2) for r in d.collect())
    assert corners(spatial.dual_mesh(one, "w")) == [(0, 3, 12), (0, 12, 9)]
    assert corners(spatial.dual_mesh(one.withColumn("w", 3 - F.col("w")), "w")) == [(0, 3, 9), (3, 12, 9)]
    lifted = lambda v: one.withColumn("vz", F.when(F.col("vid") == v, 5.0).otherwise(F.col("vz")))
    assert corners(spatial.dual_mesh(lifted(12))) == [(0, 3, 9), (3, 12, 9)]
    assert corners(spatial.dual_mesh(lifted(3))) == [(0, 3, 12), (0, 12, 9)]


def test_edges_golden(spark):
    one = spark.createDataFrame([(0, 1, 2)], "v0 int, v1 int, v2 int")
    assert spatial.edges(one).filter("n = 1").count() == 3
    tetra = spark.createDataFrame([(0, 1, 2), (0, 2, 3), (0, 3, 1), (1, 3, 2)], "v0 int, v1 int, v2 int")
    assert spatial.edges(tetra).filter("n = 1").count() == 0


# geometry


def clipped(tri, cell):
    """Whether a triangle meets a closed unit cell: its polygon clipped by the six sides."""
    poly = [np.array(p, dtype=float) for p in tri]
    for axis, sign, at in [(a, s, c) for a in range(3) for s, c in ((1, cell[a]), (-1, -(cell[a] + 1)))]:
        out = []
        for p, q in zip(poly, poly[1:] + poly[:1], strict=True):
            dp, dq = sign * p[axis] - at, sign * q[axis] - at
            if dp >= 0:
                out.append(p)
            if dp * dq < 0:
                out.append(p + (q - p) * dp / (dp - dq))
        poly = out
    return bool(poly)


def test_triangle_voxels(spark):
    rng = random.Random(4)
    tris = [(i, *[round(rng.uniform(0, 5), 3) for _ in range(9)]) for i in range(40)]
    df = spark.createDataFrame(tris, "fid int, " + ", ".join(f"{a}{k} double" for k in range(3) for a in "xyz"))
    got = set(rows(geometry.triangle_voxels(df, 5), "fid", "x", "y", "z"))
    want = {(t[0], *c) for t in tris for c in itertools.product(range(5), repeat=3) if clipped([t[1:4], t[4:7], t[7:10]], c)}
    assert got == want


def test_dual_grid(spark):
    """Crossings, flags and vertices of a mesh against loops over all grid lines, cells and sides of the cells' boxes."""
    rng = random.Random(8)
    tris = [(i, *[round(rng.uniform(0.2, 3.8), 3) for _ in range(9)]) for i in range(6)]
    frame = spark.createDataFrame(tris, "fid int, " + ", ".join(f"{a}{k} double" for k in range(3) for a in "xyz"))
    border = spark.createDataFrame([(0, *tris[0][1:7])], "sid int, " + ", ".join(f"{a}{k} double" for k in (0, 1) for a in "xyz"))
    cells = {}
    planes = []
    for t in tris:
        p = np.array(t[1:]).reshape(3, 3)
        n = np.cross(p[1] - p[0], p[2] - p[0])
        planes.append((n / np.linalg.norm(n), p[0]))
        for axis in range(3):
            a, b = (axis + 1) % 3, (axis + 2) % 3
            for i, j in itertools.product(range(1, 4), repeat=2):
                w = np.linalg.solve(np.array([p[:, a], p[:, b], np.ones(3)]), [i, j, 1])
                if (w > 0).all():
                    at = w @ p
                    for di, dj in itertools.product((1, 0), repeat=2):
                        c = [0, 0, 0]
                        c[axis], c[a], c[b] = int(np.floor(at[axis])), i - di, j - dj
                        got = cells.setdefault(tuple(c), {"flags": [False] * 3, "points": [], "q": np.zeros((3, 3)), "b": np.zeros(3)})
                        got["flags"][axis] |= di + dj == 2
                        got["points"].append(at)
                        got["q"] += np.outer(planes[-1][0], planes[-1][0])
                        got["b"] += planes[-1][0] * (planes[-1][0] @ p[0])
    touched = rows(geometry.triangle_voxels(frame, 4), "fid", "x", "y", "z")
    passed = rows(geometry.segment_voxels(border), "x", "y", "z")
    d = np.array(tris[0][4:7]) - np.array(tris[0][1:4])
    across = np.eye(3) - np.outer(d, d) / (d @ d)
    found = geometry.dual_grid(frame, 4, border, border_weight=0.2).collect()
    assert {(r.x, r.y, r.z): (r.n, [r.ix, r.iy, r.iz]) for r in found} == {c: (len(v["points"]), v["flags"]) for c, v in cells.items()}
    for r in found:
        c = (r.x, r.y, r.z)
        q, b, mean, n = cells[c]["q"].copy(), cells[c]["b"].copy(), np.mean(cells[c]["points"], axis=0), len(cells[c]["points"])
        for f, *at in touched:
            if tuple(at) == c:
                q += np.outer(planes[f][0], planes[f][0])
                b += planes[f][0] * (planes[f][0] @ planes[f][1])
        if c in passed:
            q += 0.2 * across
            b += 0.2 * across @ np.array(tris[0][1:4])
        q += 0.1 * n * np.eye(3)
        b += 0.1 * n * mean
        cost = lambda v: v @ q @ v / 2 - b @ v  # noqa: E731, B023
        best = min(cost(np.array(c) + np.array(o)) for o in itertools.product(np.linspace(0, 1, 13), repeat=3))
        v = np.array([r.vx, r.vy, r.vz])
        assert cost(v) <= best + 1e-9 and (v >= np.array(c) - 1e-9).all() and (v <= np.array(c) + 1 + 1e-9).all()


def test_segment_voxels(spark):
    rng = random.Random(5)
    segments = [(i, *[round(rng.uniform(-3, 5), 3) for _ in range(6)]) for i in range(30)] + [(90, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5), (91, 0.5, 0.5, 0.5, 3.5, 0.5, 0.5)]
    df = spark.createDataFrame(segments, "sid int, " + ", ".join(f"{a}{k} double" for k in (0, 1) for a in "xyz"))
    got = set(rows(geometry.segment_voxels(df), "sid", "x", "y", "z"))
    t = np.linspace(0, 1, 20001)[:, None]
    for s in segments:
        p, q = np.array(s[1:4]), np.array(s[4:7])
        own = {c[1:] for c in got if c[0] == s[0]}
        assert {tuple(c) for c in np.floor(p + t * (q - p)).astype(int).tolist()} - own == set()
    assert {c[1:] for c in got if c[0] == 91} == {(k, 0, 0) for k in range(4)}


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10**6))
def test_box_solution(seed):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(4, 3, 3))
    a, b = m @ m.transpose(0, 2, 1) + 0.1 * np.eye(3), rng.normal(size=(4, 3)) * 3
    low = np.zeros((4, 3))
    p = geometry.solved_in_box(a, b, low, low + 1)
    assert ((p >= -1e-9) & (p <= 1 + 1e-9)).all()
    cost = lambda x: np.einsum("...i,...ij,...j->...", x, a, x) / 2 - np.einsum("...i,...i->...", b, x)
    for x in rng.uniform(size=(200, 4, 3)):
        assert (cost(p) <= cost(x) + 1e-9).all()


# logs and sampling


def test_lpt_golden():
    groups = sampling.lpt([5, 4, 3, 3, 3], 2)
    assert sorted(sum(v for v, g in zip([5, 4, 3, 3, 3], groups, strict=True) if g == k) for k in range(2)) == [8, 10]
    assert groups[0] == groups[3] and groups[1] == groups[2] == groups[4]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 100), max_size=40), st.integers(1, 6), st.booleans())
def test_lpt_properties(loads, groups, equal):
    out = sampling.lpt(loads, groups, equal)
    assert len(out) == len(loads) and all(0 <= g < groups for g in out)
    if equal:
        assert all(out.count(g) <= -(-len(loads) // groups) for g in range(groups))


def test_clip_waits_until_full(spark):
    df = spark.createDataFrame([(0, i, float("inf") if i == 3 else float(i)) for i in range(10)], "run int, step int, v double")
    got = {r.step: r.limit for r in logs.clip_limit(df, "run", "step", "v", 4, 0.5, 100.0).collect()}
    assert got[2] == 100.0 and got[3] == 100.0 and got[7] == 5.5 and got[9] == 7.5


def test_ema(spark):
    values = [3.0, 1.0, 4.0, 1.0, 5.0]
    want = values[0]
    for v in values[1:]:
        want = 0.9 * want + 0.1 * v
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate(values)], "run int, step int, v double")
    assert abs(logs.ema(df, "run", "step", "v", 0.9).first().ema - want) < 1e-12


def test_log_lines(spark):
    df = spark.createDataFrame([('7: {"a": {"b": 1.5}, "c": 2}',), ("noise",), ('8: {"c": 3}',)], "line string")
    got = logs.parsed(df, "line", "a struct<b: double>, c double").select("step", F.inline(logs.leaves(F.col("log"), ["a.b", "c"])))
    assert rows(got, "step", "key", "value") == [(7, "a.b", 1.5), (7, "c", 2.0), (8, "c", 3.0)]


# sources


def test_npz(spark, tmp_path):
    ship(spark)
    df = spark.createDataFrame([("a", 1, 2, 3, [1.0, 2.0]), ("a", 0, 5, 3, [3.0, 4.0]), ("b", 9, 9, 9, [5.0, 6.0])], "k string, x int, y int, z int, feats array<float>")
    for r in files.npz_contents(df, "k").collect():
        (tmp_path / f"{r.k}.npz").write_bytes(r.content)
    back = files.read_npz(spark, str(tmp_path))
    assert rows(back, "x", "y", "z", "feats") == [(0, 5, 3, [3.0, 4.0]), (1, 2, 3, [1.0, 2.0]), (9, 9, 9, [5.0, 6.0])]


def test_ply(spark, tmp_path):
    ship(spark)
    head = "ply\nformat {} 1.0\ncomment c\nelement vertex 4\nproperty float x\nproperty float y\nproperty float z\nelement face 2\nproperty list uchar int vertex_indices\nend_header\n"
    points = np.array([[0, 0, 0], [1, 0, 0], [1, 1, 0], [0, 1, 0.5]], dtype="<f4")
    text = "".join(" ".join(map(str, p)) + "\n" for p in points.tolist()) + "3 0 1 2\n4 0 1 2 3\n"
    (tmp_path / "a.ply").write_bytes((head.format("ascii") + text).encode())
    body = points.tobytes() + b"\x03" + np.array([0, 1, 2], "<i4").tobytes() + b"\x04" + np.array([0, 1, 2, 3], "<i4").tobytes()
    (tmp_path / "b.ply").write_bytes(head.format("binary_little_endian").encode() + body)
    v, f = files.read_ply_vertices(spark, str(tmp_path)), files.read_ply_faces(spark, str(tmp_path))
    for name in ("a.ply", "b.ply"):
        mine = F.col("path").endswith(name)
        assert rows(v.filter(mine), "vid", "x", "y", "z") == [(i, *p) for i, p in enumerate(points.tolist())]
        assert rows(f.filter(mine), "fid", "v0", "v1", "v2") == [(0, 0, 1, 2), (1, 0, 1, 2), (1, 0, 2, 3)]


@pytest.mark.parametrize("codec", ["none", "gzip", "zstd"])
def test_voxel_store(spark, tmp_path, codec):
    df = grid(spark, 6).withColumn("v", F.col("x") * 36 + F.col("y") * 6 + F.col("z"))
    path = str(tmp_path / "v")
    voxels.write_voxels(df, path, size=4, codec=codec)
    assert rows(voxels.read_voxels(spark, path), "v") == list(range(216))
    box = voxels.read_voxels(spark, path, (0, 1, 2), (3, 1, 5))
    assert rows(box, "v") == sorted(x * 36 + 6 + z for x in range(4) for z in range(2, 6))
    info = voxels.voxel_info(spark, path)
    assert info.count() == 8 and info.agg(F.sum("n")).first()[0] == 216


def test_part_files(spark, tmp_path):
    source = tmp_path / "new_records"
    source.mkdir()
    for rank in range(3):
        (source / f"part_{rank}.csv").write_text(f"sha256,done\nk{rank},true\nbad,line,too,long\nworse,maybe\n")
    (source / "other.txt").write_text("x")
    read = lambda *start: files.read_parts(spark, str(source), "sha256 string, done boolean", *start)
    assert rows(files.good_lines(read()), "sha256", "done", "rank") == [(f"k{k}", True, k) for k in range(3)]
    assert rows(files.bad_lines(read()), "rank", "bad") == [(k, x) for k in range(3) for x in ("bad,line,too,long", "worse,maybe")]
    assert rows(files.good_lines(read("part_1.csv")), "rank") == [1, 2]
    moved = files.archived(spark, read("part_1.csv"), str(tmp_path / "merged"), "2024")
    assert [m.rpartition("/")[2] for m in moved] == ["2024_part_1.csv", "2024_part_2.csv"] and rows(files.good_lines(read()), "rank") == [0]
    assert rows(files.good_lines(spark.read.csv(str(tmp_path / "merged"), header=True).withColumn("bad", F.lit(None))), "sha256").count("k1") == 1


def test_log_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "step long, name string, loss double")
    files.write_log_lines(df, str(tmp_path / "log"))
    back = logs.parsed(spark.read.text(str(tmp_path / "log")), "value", "name string, loss double").select("step", "log.*")
    assert sorted(map(tuple, back.collect())) == [(1, "a", 2.5), (2, "b", None)]


def test_dispatch(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    for kind in ("parquet", "csv", "json"):
        path = str(tmp_path / f"t.{kind}")
        files.write(df, path)
        assert [int(k) for k in rows(files.read(spark, path), "k")] == [1, 2]
    for call in (lambda: files.read(spark, "x.zip"), lambda: files.write(df, "x.zip")):
        with pytest.raises(ValueError):
            call()


def test_ply_voxels(spark, tmp_path):
    ship(spark)
    df = grid(spark, 3).withColumns({"color": F.array(*[F.col(a).cast("float") / 4 for a in "xyz"]), "mask_on": F.array(F.col("x").cast("float"))})
    for r in files.ply_voxel_contents(df, "b", ["color", "mask_on"]).collect():
        (tmp_path / f"{r.b}.ply").write_bytes(bytes(r.content))
    back = files.read(spark, str(tmp_path / "0.ply"), attributes=["color", "mask_on"]).collect()
    assert sorted((r.x, r.y, r.z, r.color, r.mask_on) for r in back) == sorted((x, y, z, [x / 4, y / 4, z / 4], [float(x)]) for x in range(3) for y in range(3) for z in range(3))


def test_repeated_keys_fail(spark):
    left, right = (spark.createDataFrame(x, "k string, v int") for x in ([("a", 1)], [("a", 2), ("a", 3)]))
    with pytest.raises(Exception, match="repeats"):
        registry.combine_first(left, right, "k").collect()
    assert rows(registry.combine_first(left, left, "k"), "k", "v") == [("a", 1)]


def test_attention(spark):
    """Attention in tiles against the plain formula, with a batch of one row and null arrays."""
    ship(spark)
    rng = np.random.default_rng(1)
    data = [(i, i % 3 if i < 40 else 9, *(rng.normal(size=n).tolist() for n in (4, 4, 2))) for i in range(41)] + [(99, 0, None, [0.0] * 4, [1.0, 1.0])]
    df = spark.createDataFrame(data, "id long, b int, q array<double>, k array<double>, v array<double>")
    for tile in (5, 512):
        got = {r.id: r.out for r in attention.attended(df, ["b"], "id", "q", "k", "v", tile).collect()}
        assert set(got) == set(range(41))
        for i, b, q, _, _ in data[:41]:
            mine = [d for d in data[:41] if d[1] == b]
            s = np.array([np.dot(q, d[3]) / 2 for d in mine])
            w = np.exp(s - s.max())
            assert np.allclose(got[i], w @ np.array([d[4] for d in mine]) / w.sum())


def test_attention_of_a_large_batch(spark, tmp_path):
    """A batch of more than a tile costs its pairs, not a call and copies for every 64 rows; values against the plain formula."""
    rng = np.random.default_rng(6)
    feats = rng.normal(size=(20000, 64)).astype(np.float32)
    table = pa.table({"vec_id": np.arange(len(feats)), "embedding": list(feats), "label": np.zeros(len(feats), dtype=np.int32)})
    pq.write_table(table, tmp_path / "embeddings.parquet")
    start = time.monotonic()
    got = {r.vec_id: (r.o0, r.o1) for r in QUERIES["batch_attention"](ship(spark), str(tmp_path)).collect()}
    assert time.monotonic() - start < 90
    assert len(got) == len(feats)
    wide = feats.astype(np.float64)
    for i in range(0, len(feats), 97):
        s = wide[:, 32:] @ wide[i, :32] / np.sqrt(32)
        w = np.exp(s - s.max())
        assert np.allclose(got[i], w @ wide[:, :2] / w.sum(), rtol=0, atol=6e-6)


def test_attention_of_unlike_groups(spark):
    """Groups below, at and above a tile under two columns, float arrays, text as row; a null group has no rows, arrays of two lengths fail."""
    ship(spark)
    rng = np.random.default_rng(7)
    data = [(g, 1, f"{g}{i}", *(rng.normal(size=n).astype(np.float32).tolist() for n in (3, 3, 1))) for g, n in (("a", 1), ("b", 4), ("c", 5), ("d", 23)) for i in range(n)]
    kinds = "g string, h int, id string, q array<float>, k array<float>, v array<float>"
    lost = [(None, 1, "x", [1.0] * 3, [1.0] * 3, [1.0])]
    got = attention.attended(spark.createDataFrame(data + lost, kinds), ["g", "h"], "id", "q", "k", "v", 4).collect()
    assert sorted(r.id for r in got) == sorted(d[2] for d in data)
    for r in got:
        mine = [d for d in data if d[0] == r.g]
        s = np.array([np.dot(next(d[3] for d in mine if d[2] == r.id), d[4]) for d in mine]) / np.sqrt(3)
        assert np.allclose(r.out, np.exp(s) @ np.array([d[5] for d in mine]) / np.exp(s).sum())
    nan = spark.createDataFrame([(float("nan"), i, [1.0], [1.0], [float(i)]) for i in range(5)], "g double, id int, q array<double>, k array<double>, v array<double>")
    for tile in (2, 8):
        assert np.allclose([r.out[0] for r in attention.attended(nan, ["g"], "id", "q", "k", "v", tile).collect()], [2.0] * 5)
    uneven = [("a", 1, "p", [1.0], [1.0], [1.0]), ("a", 1, "q", [1.0] * 3, [1.0] * 3, [1.0])]
    with pytest.raises(Exception, match="differ in length"):
        attention.attended(spark.createDataFrame(uneven, kinds), ["g", "h"], "id", "q", "k", "v").collect()


def test_rescaled_guidance_once_a_row(spark):
    """Spreads are computed once a row, so long arrays cost no more than their length; values against the plain formula."""
    rng = np.random.default_rng(4)
    p, n = rng.normal(size=(2, 2, 400))
    df = spark.createDataFrame([(i, ((p + n) / 2)[i].tolist(), p[i].tolist(), n[i].tolist()) for i in range(2)], "id int, xt array<double>, p array<double>, n array<double>")
    start = time.monotonic()
    got = {r.id: r.g for r in df.select("id", expr.rescaled_guidance("xt", "p", "n", F.lit(0.3), 3.0, 0.7).alias("g")).collect()}
    assert time.monotonic() - start < 30
    k = 1e-5 + (1 - 1e-5) * 0.3
    for i in range(2):
        xt = (1 - 1e-5) * (p[i] + n[i]) / 2
        one, two = xt - k * p[i], xt - k * (3 * p[i] - 2 * n[i])
        assert np.allclose(got[i], (xt - two * (0.7 * one.std(ddof=1) / two.std(ddof=1) + 0.3)) / k)


def test_trilinear_keeps_points_single(spark):
    """Weighted means against a loop, with holes, a null value, a point met twice and one outside; no point is multiplied."""
    rng = np.random.default_rng(5)
    cells = {(x, y, z): float(rng.normal()) for x in range(4) for y in range(4) for z in range(4) if rng.random() < 0.6}
    table = spark.createDataFrame([(0, *c, v) for c, v in cells.items()] + [(0, 9, 9, 9, None)], "b int, x int, y int, z int, v double")
    points = [(i, 0, *rng.uniform(-1, 4, size=3).tolist()) for i in range(30)] + [(0, 0, 1.5, 1.25, 2.0), (40, 0, 9.0, 9.0, 9.0), (41, 1, 1.0, 1.0, 1.0)]
    out = spatial.trilinear(spark.createDataFrame(points, "pid int, b int, px double, py double, pz double"), table, "v")
    got = {r.pid: (r.weight, r.value) for r in out.collect()}
    want = {p[0]: [0.0, 0.0] for p in points}
    for pid, b, *at in points:
        for d in itertools.product((0, 1), repeat=3):
            low = np.floor(at)
            v = None if b else cells.get(tuple((low + d).astype(int).tolist()))
            if v is not None:
                w = np.prod([f if k else 1 - f for f, k in zip(at - low, d, strict=True)])
                want[pid] = [want[pid][0] + w, want[pid][1] + w * v]
    assert set(got) == set(want)
    for pid, (w, t) in want.items():
        assert np.isclose(got[pid][0], w) and (np.isclose(got[pid][1], t / w) if w else got[pid][1] is None)
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()


def test_textures(spark):
    """Samples of a mip chain against a loop, under each wrap mode."""
    tex = np.arange(64, dtype=float).reshape(8, 8) % 7
    chain = [tex]
    while len(chain[-1]) > 1:
        t = chain[-1]
        chain.append((t[::2, ::2] + t[1::2, ::2] + t[::2, 1::2] + t[1::2, 1::2]) / 4)
    levels = textures.mipmaps(spark.createDataFrame([(y, x, float(tex[y, x])) for y in range(8) for x in range(8)], "ty int, tx int, value double"), 8)
    assert all(abs(r.value - chain[r.level][r.ty, r.tx]) < 1e-12 for r in levels.collect()) and levels.count() == 64 + 16 + 4 + 1
    wrap = {"repeat": lambda i, n: i % n, "clamp": lambda i, n: min(max(i, 0), n - 1), "mirror": lambda i, n: i % (2 * n) if i % (2 * n) < n else 2 * n - 1 - i % (2 * n)}
    rng = random.Random(2)
    points = [(i, rng.uniform(-1, 2), rng.uniform(-1, 2), rng.choice([0.0, 0.01, 0.2, 0.37, 5.0])) for i in range(60)]

    def flat(t, u, v, mode):
        n = len(t)
        x, y = u * n - 0.5, (1 - v) * n - 0.5
        x0, y0 = int(np.floor(x)), int(np.floor(y))
        return sum(t[wrap[mode](y0 + b, n), wrap[mode](x0 + a, n)] * (x - x0 if a else 1 - x + x0) * (y - y0 if b else 1 - y + y0) for a in (0, 1) for b in (0, 1))

    df = spark.createDataFrame(points, "id int, u double, v double, len double")
    for mode in wrap:
        got = {r.id: r.value for r in textures.sampled(df, "id", levels, 8, mode).collect()}
        for i, u, v, length in points:
            level = min(max(np.log2(length * 8), 0), 3) if length else 0
            low = int(level)
            want = flat(chain[low], u, v, mode) * (1 - level + low) + (flat(chain[low + 1], u, v, mode) * (level - low) if level > low else 0)
            assert abs(got[i] - want) < 1e-9


def test_file_hashes(spark, tmp_path):
    import hashlib

    (tmp_path / "f.bin").write_bytes(b"abc" * 5000)
    assert files.file_hashes(spark, str(tmp_path)).first().sha256 == hashlib.sha256(b"abc" * 5000).hexdigest()


# streams


def test_stream_goes_on(spark, tmp_path):
    """A second run takes only new files, and the result is that of one batch over all."""
    source, state, check = (str(tmp_path / n) for n in ("in", "state", "check"))
    kind = "k int, seq long, a int, c int"
    first, second = [(1, 1, 5, None), (2, 2, None, 7)], [(1, 3, None, 9), (2, 0, 4, 1), (3, 4, None, None)]
    spark.createDataFrame(first, kind).coalesce(1).write.parquet(source)
    got = records.merged(records.file_stream(spark, source), "k", "seq", state, check)
    assert rows(got.fillna(-1), "k", "a", "c") == [(1, 5, -1), (2, -1, 7)]
    spark.createDataFrame(second, kind).coalesce(1).write.mode("append").parquet(source)
    got = records.merged(records.file_stream(spark, source), "k", "seq", state, check)
    want = registry.upsert(spark.createDataFrame(first + second, kind), "k", "seq")
    assert rows(got.fillna(-1), "k", "a", "c") == rows(want.fillna(-1), "k", "a", "c") == [(1, 5, 9), (2, 4, 7), (3, -1, -1)]


def test_state_is_kept_between_batches(spark, tmp_path):
    ship(spark)
    source = str(tmp_path / "in")
    data = [(r, i, float((i * 7 + r) % 11)) for i in range(12) for r in range(2)]
    for part in (data[:8], data[8:14], data[14:]):
        spark.createDataFrame(part, "run int, step int, v double").coalesce(1).write.mode("append").parquet(source)
    stream = state.clip_limits(records.file_stream(spark, source, files_per_batch=1), "run", "step", "v", 4, 0.5, 100.0)
    got = rows(records.drained(stream, "append", "clips"), "run", "step", "limit")
    want = logs.clip_limit(spark.createDataFrame(data, "run int, step int, v double"), "run", "step", "v", 4, 0.5, 100.0)
    assert got == rows(want, "run", "step", "limit")


def test_state_takes_two_calls_a_run():
    """A run's state is read once and written once a micro-batch."""
    from unittest.mock import MagicMock

    import pandas as pd

    handle, ring = MagicMock(), state.RingBuffer("run", "step", "value", 2, 0.5, 50.0)
    handle.getValueState.return_value.get.return_value = None
    ring.init(handle)
    out = list(ring.handleInputRows((7,), iter([pd.DataFrame({"step": [1, 0], "value": [4.0, 2.0]})]), None))
    assert out[0]["limit"].tolist() == [50.0, 3.0]
    made = [c for c in handle.mock_calls if c[0].rpartition(".")[2] in ("get", "exists", "put", "clear", "update")]
    assert len(made) == 2
