"""Meshes and voxels: which voxels a triangle touches, dual vertices, octrees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.operators.numbering import with_row_number

AXES = ("x", "y", "z")


#: Squares of triangles' shadows that are worked on at once.
SQUARES = 1 << 18


def touched_cells(corners: np.ndarray, size: tuple[int, int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the triangle, cell) of the unit cells that triangles (n x 3 corners x 3 axes) touch, so many squares of
    their shadows at once: a triangle of any size is worked on in parts."""
    shape = np.array(size)
    low, high = corners.min(axis=1), corners.max(axis=1)
    number = np.flatnonzero(((high >= 0) & (low < shape)).all(axis=1) & np.isfinite(corners).all(axis=(1, 2)))
    corners, low, high = corners[number], low[number], high[number]
    normal = np.cross(corners[:, 1] - corners[:, 0], corners[:, 2] - corners[:, 0])
    faces = 2 - np.argmax(np.abs(normal[:, ::-1]), axis=1)  # the last axis among equals
    axes = np.stack([faces, (faces + 1) % 3, (faces + 2) % 3], axis=1)  # along, and the two of the shadow
    cell = lambda v, of: np.clip(np.floor(v), 0, of - 1).astype(np.int64)
    each = np.arange(len(number))
    first, last = cell(low, shape), cell(high, shape)
    starts = [first[each, axes[:, k]] for k in (1, 2)]
    wide = [last[each, axes[:, k]] - first[each, axes[:, k]] + 1 for k in (1, 2)]
    ends = np.cumsum(wide[0] * wide[1])
    for at in range(0, int(ends[-1]) if len(ends) else 0, SQUARES):
        square = np.arange(at, min(at + SQUARES, ends[-1]))
        t = np.searchsorted(ends, square, side="right")
        square = square - (ends - wide[0] * wide[1])[t]
        a, p, q = axes[t].T
        c, n = corners[t], normal[t]
        mine = np.arange(len(t))
        up, vp, vq = starts[0][t] + square // wide[1][t], n[mine, p], n[mine, q]
        uq, va = starts[1][t] + square % wide[1][t], n[mine, a]
        flat = va == 0  # no area: its box
        safe = np.where(flat, 1.0, va)
        # the plane's height over the middle of the square, and how far it goes up and down from there
        middle = c[mine, 0, a] - (vp * (up + 0.5 - c[mine, 0, p]) + vq * (uq + 0.5 - c[mine, 0, q])) / safe
        reach = (np.abs(vp) + np.abs(vq)) / np.abs(safe) / 2 + 1e-6
        bottom, top = low[t][mine, a], high[t][mine, a]
        most = np.where(flat, top, np.minimum(top, middle + reach))
        least = np.where(flat, bottom, np.maximum(bottom, middle - reach))
        # a plane on the border of two cells touches both, but no cell below the triangle's own lowest
        lowest = np.maximum(first[t][mine, a], cell(np.where(flat, least, np.ceil(least) - 1), shape[a]))
        count = np.maximum(cell(most, shape[a]) - lowest + 1, 0)
        which = np.repeat(mine, count)
        cells = np.empty((len(which), 3), dtype=np.int64)
        rows = np.arange(len(which))
        cells[rows, a[which]] = lowest[which] + rows - np.repeat(np.cumsum(count) - count, count)
        cells[rows, p[which]], cells[rows, q[which]] = up[which], uq[which]
        hit = _meets(c[which], n[which], cells)
        yield number[t[which[hit]]], cells[hit]


def _meets(c: np.ndarray, n: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Whether each cell meets its triangle: the cell's farthest corners along the normal lie on both sides of the plane, and
    in no projection is the cell's square wholly outside one of the three edges."""
    at = (n * (cells - c[:, 0])).sum(axis=1)
    hit = (at + np.minimum(n, 0).sum(axis=1) <= 0) & (at + np.maximum(n, 0).sum(axis=1) >= 0)
    for a, b, along in ((0, 1, 2), (1, 2, 0), (2, 0, 1)):
        sign = np.where(n[:, along] < 0, -1.0, 1.0)
        for k in range(3):
            side = c[:, (k + 1) % 3] - c[:, k]
            na, nb = -side[:, b] * sign, side[:, a] * sign
            hit &= na * (cells[:, a] - c[:, k, a]) + nb * (cells[:, b] - c[:, k, b]) + np.maximum(na, 0) + np.maximum(nb, 0) >= 0
    return hit


CORNERS = [f"{a}{k}" for k in range(3) for a in AXES]


def triangle_voxels(triangles: DataFrame, size: int | tuple[int, int, int]) -> DataFrame:
    """(fid, x, y, z) of the unit cells of a grid that each triangle (fid, x0..z2) touches. The cells of its shadow along the
    axis that it faces most are listed, and over each the three or fewer that its plane passes; those that the plane or one
    of the three projections misses are left out. So a triangle costs work in proportion to its area, and is worked on in
    parts. Triangles with a null corner touch nothing."""
    shape = (size,) * 3 if isinstance(size, int) else size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            corners = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in CORNERS], axis=1).reshape(-1, 3, 3)
            for number, cells in touched_cells(corners, shape):
                columns = [pa.array(cells[:, k].astype(np.int32)) for k in range(3)]
                yield pa.RecordBatch.from_arrays([batch.column("fid").take(pa.array(number)), *columns], ["fid", *AXES])

    return triangles.select("fid", *[F.col(c).cast("double").alias(c) for c in CORNERS]).mapInArrow(run, f"fid {dict(triangles.dtypes)['fid']}, x int, y int, z int")


RING = {"x": ("y", "z"), "y": ("z", "x"), "z": ("x", "y")}


def normals(triangles: DataFrame) -> DataFrame:
    """Adds the triangle's normal nx, ny, nz, as long as twice its area."""
    edge = lambda k, a: F.col(f"{a}{k}") - F.col(f"{a}0")
    return triangles.withColumns({f"n{a}": edge(1, p) * edge(2, q) - edge(1, q) * edge(2, p) for a, (p, q) in RING.items()})


def line_crossings(triangles: DataFrame) -> DataFrame:
    """(fid, axis, px, py, pz): where triangles (fid, x0..z2) cross the grid's lines, which run along each axis through whole
    coordinates. Row by row: the ends of the triangle in a row follow from the two sides that the row crosses (the lower end
    of a side isn't part of it), and whole places from the one end, itself not included, to the other are crossed. So a
    triangle costs rows in proportion to its area."""
    parts = None
    flat = normals(triangles)
    for axis, (p, q) in RING.items():
        low, high = (f(*[F.col(f"{q}{k}") for k in range(3)]) for f in (F.least, F.greatest))
        rows = flat.filter(F.col(f"n{axis}") != 0).filter(F.floor(low) < F.floor(high)).withColumn("_q", F.explode(F.sequence(F.floor(low) + 1, F.floor(high))))
        ends = []
        for k, m in ((0, 1), (1, 2), (2, 0)):
            a, b = F.col(f"{q}{k}"), F.col(f"{q}{m}")
            met = (F.least(a, b) < F.col("_q")) & (F.col("_q") <= F.greatest(a, b))
            ends.append(F.when(met, F.col(f"{p}{k}") + (F.col("_q") - a) * (F.col(f"{p}{m}") - F.col(f"{p}{k}")) / F.nullif(b - a, F.lit(0.0))))
        rows = rows.withColumns({"_from": F.floor(F.least(*ends)) + 1, "_to": F.floor(F.greatest(*ends))}).filter("_from <= _to").withColumn("_p", F.explode(F.sequence("_from", "_to")))
        height = F.col(f"{axis}0") - (F.col(f"n{p}") * (F.col("_p") - F.col(f"{p}0")) + F.col(f"n{q}") * (F.col("_q") - F.col(f"{q}0"))) / F.col(f"n{axis}")
        at = {f"p{axis}": height, f"p{p}": F.col("_p").cast("double"), f"p{q}": F.col("_q").cast("double")}
        part = rows.select("fid", F.lit(axis).alias("axis"), *[at[f"p{a}"].alias(f"p{a}") for a in AXES])
        parts = part if parts is None else parts.unionAll(part)
    return parts


def crossed_cells(crossings: DataFrame, size: int) -> DataFrame:
    """(fid, axis, px, py, pz, x, y, z, own): the four cells around each crossing, within the grid; ``own`` is the one whose
    edge, from its far corner along the axis, is crossed."""
    cells = None
    for axis, (p, q) in RING.items():
        four = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (1, 0) for j in (1, 0)])
        part = crossings.filter(F.col("axis") == axis).select("*", F.inline(four))
        at = {axis: F.floor(F.col(f"p{axis}")), p: F.col(f"p{p}") - F.col("i"), q: F.col(f"p{q}") - F.col("j")}
        part = part.select("fid", "axis", "px", "py", "pz", *[at[a].cast("int").alias(a) for a in AXES], (F.col("i") + F.col("j") == 2).alias("own"))
        cells = part if cells is None else cells.unionAll(part)
    return cells.filter(" and ".join(f"{a} between 0 and {size - 1}" for a in AXES))


def dual_grid(triangles: DataFrame, size: int, borders: DataFrame | None = None, face_weight: float = 1.0, border_weight: float = 1.0, regularisation: float = 0.1) -> DataFrame:
    """(x, y, z, n, ix, iy, iz, vx, vy, vz): the dual grid of a mesh (fid, x0..z2). A cell is active if a triangle crosses a grid
    line at its border; it holds the number of crossings, which of its edges are crossed, and the point that fits best the
    planes of the triangles at its crossings, those of all triangles that touch it (by ``face_weight``), and the lines of the
    open borders (sid, x0..z1) that pass it (by ``border_weight``), drawn to the mean crossing."""
    square = normals(triangles)
    length = F.nullif(F.sqrt(F.col("nx") * F.col("nx") + F.col("ny") * F.col("ny") + F.col("nz") * F.col("nz")), F.lit(0.0))
    unit = square.select("fid", *[(F.col(f"n{a}") / length).alias(f"n{a}") for a in AXES], *[f"{a}0" for a in AXES]).filter("nx is not null")
    plane = unit.select("fid", "nx", "ny", "nz", (-(F.col("nx") * F.col("x0") + F.col("ny") * F.col("y0") + F.col("nz") * F.col("z0"))).alias("d"))
    met = crossed_cells(line_crossings(triangles), size)
    pairs = [("x", "x"), ("x", "y"), ("x", "z"), ("y", "y"), ("y", "z"), ("z", "z")]
    entries = {f"a{a}{b}": F.col(f"n{a}") * F.col(f"n{b}") for a, b in pairs} | {f"b{a}": -F.col(f"n{a}") * F.col("d") for a in AXES}
    names = list(entries)

    def part(rows: DataFrame, weight: float, crossing: bool) -> DataFrame:
        none = F.lit(None)
        point = [(F.col(f"p{a}") if crossing else none.cast("double")).alias(f"p{a}") for a in AXES]
        flags = [((F.col("axis") == a) & F.col("own") if crossing else F.lit(False)).alias(f"i{a}") for a in AXES]
        return rows.select(*AXES, *[(F.col(n) * weight).alias(n) for n in names], *point, F.lit(int(crossing)).alias("one"), *flags)

    rows = part(met.join(plane, "fid").withColumns(entries), 1.0, True)
    rows = rows.unionByName(part(triangle_voxels(triangles, size).join(plane, "fid").withColumns(entries), face_weight, False))
    if borders is not None:
        along = {a: F.col(f"{a}1") - F.col(f"{a}0") for a in AXES}
        norm = F.nullif(F.sqrt(sum((v * v for v in list(along.values())[1:]), along["x"] * along["x"])), F.lit(0.0))
        lines = borders.select("sid", *[(v / norm).alias(f"d{a}") for a, v in along.items()], *[f"{a}0" for a in AXES]).filter("dx is not null")
        across = {f"a{a}{b}": F.lit(float(a == b)) - F.col(f"d{a}") * F.col(f"d{b}") for a, b in pairs}
        both = lines.withColumns(across)
        entry = lambda a, b: F.col(f"a{min(a, b)}{max(a, b)}")
        both = both.withColumns({f"b{a}": sum((entry(a, b) * F.col(f"{b}0") for b in AXES[1:]), entry(a, "x") * F.col("x0")) for a in AXES})
        rows = rows.unionByName(part(segment_voxels(borders).join(both.drop(*[f"{a}0" for a in AXES]), "sid"), border_weight, False))
    cells = rows.groupBy(*AXES).agg(*[F.sum(n).alias(n) for n in names], *[F.avg(f"p{a}").alias(f"m{a}") for a in AXES], F.sum("one").alias("n"), *[F.max(f"i{a}").alias(f"i{a}") for a in AXES])
    return dual_vertices(cells.filter("n > 0"), regularisation).select(*AXES, "n", "ix", "iy", "iz", "vx", "vy", "vz")


def quadrics(planes: DataFrame, key: list[str]) -> DataFrame:
    """Sums of the quadrics of planes (nx, ny, nz, d: n.p + d = 0), all ten entries, and the mean of sample points (px, py, pz)
    and the number of planes per cell."""
    n = {"x": "nx", "y": "ny", "z": "nz"}
    pairs = [("x", "x"), ("x", "y"), ("x", "z"), ("y", "y"), ("y", "z"), ("z", "z")]
    return planes.groupBy(*key).agg(
        *[F.sum(F.col(n[a]) * F.col(n[b])).alias(f"a{a}{b}") for a, b in pairs],
        *[F.sum(-F.col(n[a]) * F.col("d")).alias(f"b{a}") for a in AXES],
        F.sum(F.col("d") * F.col("d")).alias("c"),
        *[F.avg(f"p{a}").alias(f"m{a}") for a in AXES],
        F.count("*").alias("n"),
    )


def solved_in_box(a: np.ndarray, b: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each row the point of a box that is least in p'ap/2 - b'p, ``a`` symmetric and positive: the best of the free
    solution and those with one, two or three coordinates fixed at a side of the box, as far as they lie in it."""
    best, least = np.clip(np.zeros_like(b), low, high), np.full(len(b), np.inf)
    for fixed in product((None, 0, 1), repeat=3):
        p = np.zeros_like(b)
        free = [k for k in range(3) if fixed[k] is None]
        for k in range(3):
            if fixed[k] is not None:
                p[:, k] = (low, high)[fixed[k]][:, k]
        if free:
            rest = b[:, free] - np.einsum("nij,nj->ni", a[:, free, :], p)
            p[:, free] = np.linalg.solve(a[np.ix_(range(len(a)), free, free)], rest[:, :, None])[:, :, 0]
        inside = ((p >= low - 1e-9) & (p <= high + 1e-9)).all(axis=1)
        cost = np.einsum("ni,nij,nj->n", p, a, p) / 2 - np.einsum("ni,ni->n", b, p)
        better = inside & (cost < least - 1e-12)
        best[better], least[better] = p[better], cost[better]
    return best


def dual_vertices(cells: DataFrame, regularisation: float = 0.1) -> DataFrame:
    """Adds vx, vy, vz: the point of the unit cell (x, y, z) that fits its quadric best, drawn to the mean sample."""
    schema = cells.withColumns({f"v{a}": F.lit(0.0) for a in AXES}).schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            a = np.empty((len(f), 3, 3))
            for i, p in enumerate(AXES):
                for j, q in enumerate(AXES):
                    a[:, i, j] = f[f"a{min(p, q)}{max(p, q)}"]
            weight = regularisation * f["n"].to_numpy()
            a += weight[:, None, None] * np.eye(3)
            b = f[["bx", "by", "bz"]].to_numpy() + weight[:, None] * f[["mx", "my", "mz"]].to_numpy()
            low = f[list(AXES)].to_numpy(dtype=float)
            v = solved_in_box(a, b, low, low + 1)
            yield f.assign(vx=v[:, 0], vy=v[:, 1], vz=v[:, 2])

    return cells.mapInPandas(run, schema)


def concatenated(vertices: DataFrame, mesh: str, order: str) -> DataFrame:
    """Adds ``vid``, the vertex's number when the meshes are put behind each other, and ``start``, that of its mesh's first
    vertex: what a mesh's own face indices are raised by."""
    numbered, _ = with_row_number(vertices, mesh, order, name="vid")
    starts = numbered.groupBy(mesh).agg(F.min("vid").alias("start"))
    return numbered.join(starts, mesh)


def normalised(vertices: DataFrame, margin: float = 0.99999) -> DataFrame:
    """The vertices moved and scaled into the unit cube around 0; the bounds are one row."""
    bounds = vertices.agg(*[((F.min(a) + F.max(a)) / 2).alias(f"_c{a}") for a in AXES], (margin / F.nullif(F.greatest(*[F.max(a) - F.min(a) for a in AXES]), F.lit(0.0))).alias("_scale"))
    return vertices.join(F.broadcast(bounds)).withColumns({a: (F.col(a) - F.col(f"_c{a}")) * F.col("_scale") for a in AXES}).drop("_scale", *[f"_c{a}" for a in AXES])


def crossings(one: Column, two: Column) -> Column:
    """The shares of the way from ``one`` to ``two`` at which whole numbers lie."""
    first, last = F.ceil(F.least(one, two)), F.floor(F.greatest(one, two))
    shares = F.transform(F.sequence(first, last), lambda w: (w - one) / (two - one))
    return F.when((one != two) & (first <= last), shares).otherwise(F.array().cast("array<double>"))


def segment_voxels(segments: DataFrame) -> DataFrame:
    """(sid, x, y, z) of the unit cells that each segment (sid, x0..z1) passes: the cells at the middle between successive
    crossings of whole coordinates, so each is met once however short the way through it."""
    length = F.greatest(*[F.abs(F.col(f"{a}1") - F.col(f"{a}0")) for a in AXES])
    cuts = F.array(F.lit(0.0), F.lit(1.0))
    for a in AXES:
        one, two = F.col(f"{a}0"), F.col(f"{a}1")
        cuts = F.concat(cuts, crossings(one, two))
    ts = F.array_sort(F.array_distinct(cuts))
    pairs = F.zip_with(F.slice(ts, 1, F.size(ts) - 1), F.slice(ts, 2, F.size(ts) - 1), lambda s, e: (s + e) / 2)
    rows = segments.filter(length >= 0).withColumn("_t", F.explode(pairs))
    return rows.select("sid", *[F.floor(F.col(f"{a}0") + F.col("_t") * (F.col(f"{a}1") - F.col(f"{a}0"))).cast("int").alias(a) for a in AXES]).distinct()


def octree_bytes(leaves: DataFrame, key: str, code: str, depth: int) -> DataFrame:
    """(key, octree): the child masks of each group's octree in depth-first order, from the z-order codes of its voxels. Masks
    come level by level from below; a node stands before its children, so it is ordered by its first leaf and its depth. A
    group should be a chunk of bounded size."""
    nodes, parts = leaves.select(key, F.col(code).cast("long").alias("node")), None
    for level in range(depth):
        masks = nodes.groupBy(key, F.shiftright("node", 3).alias("up")).agg(F.bit_or(F.expr("shiftleft(1, cast(node & 7 as int))")).alias("mask"))
        part = masks.select(key, F.expr(f"shiftleft(up, {3 * (level + 1)})").alias("first"), F.lit(depth - level).alias("deep"), "mask")
        parts = part if parts is None else parts.unionAll(part)
        nodes = masks.select(key, F.col("up").alias("node"))
    listed = parts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("first", "deep", "mask"))).alias("l"))
    return listed.select(key, F.unhex(F.array_join(F.transform("l", lambda n: F.lpad(F.hex(n["mask"]), 2, "0")), "")).alias("octree"))


def octree_leaves(octrees: DataFrame, key: str, depth: int) -> DataFrame:
    """(key, code): the way back, with one pass over each octree's bytes."""

    def leaves(data: bytes) -> list[int]:
        found, stack = [], []
        at = 0
        stack.append((0, 0))
        while stack:
            prefix, level = stack.pop()
            kids = [prefix << 3 | k for k in range(8) if data[at] >> k & 1]
            at += 1
            if level == depth - 1:
                found += kids
            else:
                stack += [(k, level + 1) for k in reversed(kids)]
        return found

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({key: f[key], "code": [leaves(bytes(o)) if len(o) else [] for o in f["octree"]]}).explode("code").dropna()

    return octrees.select(key, "octree").mapInPandas(run, f"{key} {dict(octrees.dtypes)[key]}, code long")
