"""Surfaces: the nearest triangle of points, boundary loops of meshes, filled holes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.operators.geometry import AXES, CORNERS, triangle_voxels
from lattica.operators.numbering import fixed, with_row_number
from lattica.operators.spatial import gathered


def closest(p: np.ndarray, corners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of points (n x 3) from triangles (n x 3 corners x 3), and the weights of the corners at the nearest
    places: a corner, a place on an edge or in the face, as the point's place in the regions around them says. A flat triangle
    has its corners and edges."""
    a, b, c = corners[:, 0], corners[:, 1], corners[:, 2]
    dot = lambda u, v: (u * v).sum(axis=1)
    ab, ac = b - a, c - a
    (a1, a2), (b1, b2), (c1, c2) = ((dot(ab, p - q), dot(ac, p - q)) for q in (a, b, c))
    of_c, of_b, of_a = a1 * b2 - b1 * a2, c1 * a2 - a1 * c2, b1 * c2 - c1 * b2
    share = lambda n, d: n / np.where(d == 0, 1.0, d)
    on_ab, on_ac, on_bc = share(a1, a1 - b1), share(a2, a2 - c2), share(b2 - b1, (b2 - b1) + (c1 - c2))
    zero, one = np.zeros(len(p)), np.ones(len(p))
    regions = [(a1 <= 0) & (a2 <= 0), (b1 >= 0) & (b2 <= b1), (c2 >= 0) & (c1 <= c2), (of_c <= 0) & (a1 >= 0) & (b1 <= 0), (of_b <= 0) & (a2 >= 0) & (c2 <= 0), (of_a <= 0) & (b2 >= b1) & (c1 >= c2)]
    at = [(one, zero, zero), (zero, one, zero), (zero, zero, one), (1 - on_ab, on_ab, zero), (1 - on_ac, zero, on_ac), (zero, 1 - on_bc, on_bc)]
    inside = [share(x, of_a + of_b + of_c) for x in (of_a, of_b, of_c)]
    weights = np.stack([np.select(regions, [w[k] for w in at], inside[k]) for k in range(3)], axis=1)
    away = p - (weights[:, :, None] * corners).sum(axis=1)
    return dot(away, away), weights


def best_of(met: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """(pid, best: d, fid, u, v, w) of rows (pid, px.., fid, x0..z2): each batch gives its best row a point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda names: np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1)  # noqa: E731, B023
            d, weights = closest(get([f"p{a}" for a in AXES]), get(CORNERS).reshape(-1, 3, 3))
            part = pa.table({"pid": batch.column("pid"), "fid": batch.column("fid"), "d": d, "row": np.arange(len(d))})
            part = part.filter(pc.is_finite(part.column("d"))).sort_by([("d", "ascending"), ("fid", "ascending")])
            rows = part.group_by("pid", use_threads=False).aggregate([("row", "first")]).column("row_first").to_numpy()
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays([batch.column("pid").take(take), pa.array(d[rows]), batch.column("fid").take(take), *(pa.array(weights[rows, k]) for k in range(3))], ["pid", "d", "fid", "u", "v", "w"])

    found = met.select("pid", *[f"p{a}" for a in AXES], "fid", *CORNERS).mapInArrow(run, f"pid {kinds['pid']}, d double, fid {kinds['fid']}, u double, v double, w double")
    return found.groupBy("pid").agg(F.min(F.struct("d", "fid", "u", "v", "w")).alias("best"))


def nearest_triangles(points: DataFrame, triangles: DataFrame, cell: float) -> DataFrame:
    """(pid, fid, distance, u, v, w): the triangle (fid, x0..z2) nearest to each point (pid, px, py, pz), the least fid among
    equals, and the weights of its corners at the nearest place.

    Triangles lie in the cells of a grid that they touch. A point looks at the 27 cells around it, which hold all that is
    within a cell's edge; it is done if its best distance is no more than that. Else it goes on where cells are as wide as
    that distance, or twice as wide if it met nothing. Levels come from the same cells by halving their numbers, so each is
    an equi-join, and only points that aren't done go on. ``cell`` should be some times the size of a triangle: points far
    from the surface meet as many triangles as lie in their distance. Null coordinates or no triangles give nulls. Both tables
    may be large, so every join is shuffled, whatever sizes Spark expects, and none goes through the driver."""
    triangles = fixed(triangles.select("fid", *CORNERS))
    edges = [c for a in AXES for c in (F.min(F.least(*[f"{a}{k}" for k in range(3)])).alias(f"low_{a}"), F.max(F.greatest(*[f"{a}{k}" for k in range(3)])).alias(f"high_{a}"))]
    bounds = triangles.agg(*edges).first()
    own = points.select("pid", *[F.col(f"p{a}").cast("double").alias(f"p{a}") for a in AXES])
    kind = dict(triangles.dtypes)["fid"]
    none = [F.lit(None).cast(t).alias(n) for n, t in (("fid", kind), *((c, "double") for c in ("distance", "u", "v", "w")))]
    if bounds["low_x"] is None:
        return own.select("pid", *none)
    low = {a: bounds[f"low_{a}"] for a in AXES}
    shape = tuple(int((bounds[f"high_{a}"] - low[a]) / cell) + 1 for a in AXES)
    scaled = triangles.select("fid", *[((F.col(c) - low[c[0]]) / cell).alias(c) for c in CORNERS])
    cells = fixed(triangle_voxels(scaled, shape).hint("merge").join(triangles.select("fid", *[F.col(c).cast("double").alias(c) for c in CORNERS]), "fid"))

    known = own.filter(" and ".join(f"p{a} is not null and not isnan(p{a}) and abs(p{a}) < double('inf')" for a in AXES))
    left = fixed(known.select("*", *[F.floor((F.col(f"p{a}") - low[a]) / cell).cast("long").alias(f"c{a}") for a in AXES], F.lit(0).alias("level")))
    done: list[DataFrame] = []
    while (level := left.agg(F.min("level")).first()[0]) is not None:
        at = left.filter(F.col("level") == level)
        around = F.array(*[F.struct(*[F.lit(d).alias(f"d{a}") for a, d in zip(AXES, move, strict=True)]) for move in moves()])
        asked = at.select("*", F.inline(around)).select("pid", *[f"p{a}" for a in AXES], *[(F.shiftright(F.col(f"c{a}"), level) + F.col(f"d{a}")).cast("int").alias(a) for a in AXES])
        held = cells.select("fid", *CORNERS, *[F.shiftright(a, level).alias(a) for a in AXES])
        met = asked.hint("merge").join(held.distinct() if level else held, list(AXES))
        best = best_of(met, {"pid": dict(points.dtypes)["pid"], "fid": kind})
        reached = fixed(at.hint("merge").join(best, "pid", "left").withColumn("distance", F.sqrt("best.d")))
        sure = F.coalesce(F.col("distance") <= cell * 2.0**level, F.lit(False))
        done.append(reached.filter(sure).select("pid", "best.fid", "distance", "best.u", "best.v", "best.w"))
        wider = F.greatest(F.coalesce(F.ceil(F.log2(F.col("distance") / cell)), F.lit(level + 1)), F.lit(level + 1)).cast("int")
        rest = reached.filter(~sure).withColumn("level", wider).select(*left.columns)
        left = fixed(left.filter(F.col("level") != level).unionByName(rest))
    found = done[0] if done else own.limit(0).select("pid", *none)
    for part in done[1:]:
        found = found.unionByName(part)
    return own.select("pid").hint("merge").join(found, "pid", "left")


def moves() -> list[tuple[int, int, int]]:
    return [(x, y, z) for x in (-1, 0, 1) for y in (-1, 0, 1) for z in (-1, 0, 1)]


def boundary_edges(faces: DataFrame) -> DataFrame:
    """(s, e): the edges that only one face (v0, v1, v2) has, against the face's own direction, as a face that closes the hole
    would run along them."""
    ways = F.array(*[F.struct(F.col(p).alias("e"), F.col(q).alias("s")) for p, q in (("v0", "v1"), ("v1", "v2"), ("v2", "v0"))])
    one = faces.select(F.inline(ways)).groupBy(F.least("s", "e").alias("a"), F.greatest("s", "e").alias("b"))
    return one.agg(F.count("*").alias("n"), F.min("s").alias("s"), F.min("e").alias("e")).filter("n = 1").select("s", "e")


def boundary_loops(faces: DataFrame) -> DataFrame:
    """(s, e, loop): the boundary edges that lie on a loop, named by its least vertex. A loop runs through vertices with one
    boundary edge in and one out; edges on chains through others are left out. Pointers to the next vertex are doubled round
    by round, and each vertex keeps the least vertex met on its way, so a loop of n edges takes log n joins; chains run out
    and drop. Two numbers a round reach the driver."""
    edges = fixed(boundary_edges(faces))
    plain = edges.groupBy(F.col("s").alias("v")).count().filter("count = 1").join(edges.groupBy(F.col("e").alias("v")).count().filter("count = 1"), "v").select("v")
    through = edges.join(plain.select(F.col("v").alias("s")), "s", "left_semi").join(plain.select(F.col("v").alias("e")), "e", "left_semi")
    now = fixed(through.select(F.col("s").alias("v"), F.col("e").alias("next"), F.least("s", "e").alias("loop")))
    seen = (now.count(), None)
    while seen[0]:
        ahead = now.select(F.col("v").alias("next"), F.col("next").alias("far"), F.col("loop").alias("other"))
        after = fixed(now.join(ahead, "next").select("v", F.col("far").alias("next"), F.least("loop", "other").alias("loop"), (F.col("other") < F.col("loop")).alias("changed")))
        count, changed = after.agg(F.count("*"), F.count_if("changed")).first()
        now = after.drop("changed")
        if count == seen[0] and not changed:
            break
        seen = (count, changed)
    return through.join(now.select(F.col("v").alias("s"), "loop"), "s").select("s", "e", "loop")


def measured(loops: DataFrame, vertices: DataFrame) -> DataFrame:
    """(loop, n, perimeter, cx, cy, cz) of loops (s, e, loop): edges, length and the mean of its vertices (vid, x, y, z)."""
    end = lambda v: vertices.select(F.col("vid").alias(v), *[F.col(a).alias(f"{a}_{v}") for a in AXES])
    both = loops.join(end("s"), "s").join(end("e"), "e")
    length = F.sqrt(sum(((F.col(f"{a}_s") - F.col(f"{a}_e")) ** 2 for a in AXES[1:]), (F.col("x_s") - F.col("x_e")) ** 2))
    return both.groupBy("loop").agg(F.count("*").alias("n"), F.sum(length).alias("perimeter"), *[F.avg(f"{a}_s").alias(f"c{a}") for a in AXES])


def filled(faces: DataFrame, vertices: DataFrame, most: float = math.inf) -> tuple[DataFrame, DataFrame]:
    """Faces (fid, v0, v1, v2) and vertices (vid, x, y, z) of the mesh with its holes closed whose perimeter is ``most`` or less:
    a new vertex in the middle of each, and a fan of faces around it. New numbers go on behind the greatest ones."""
    loops = fixed(boundary_loops(faces))
    holes = measured(loops, vertices).filter(F.col("perimeter") <= most)
    last_v, last_f = vertices.agg(F.max("vid")).first()[0], faces.agg(F.max("fid")).first()[0]
    numbered, _ = with_row_number(holes, "loop", name="place")
    numbered = numbered.withColumn("centre", F.col("place") + (0 if last_v is None else last_v) + 1)
    kinds, corner = dict(faces.dtypes), dict(vertices.dtypes)
    fan, _ = with_row_number(loops.join(numbered.select("loop", "centre"), "loop"), "loop", "s", name="place")
    new = fan.select((F.col("place") + (0 if last_f is None else last_f) + 1).cast(kinds["fid"]).alias("fid"), *[F.col(c).cast(kinds[v]).alias(v) for c, v in (("s", "v0"), ("e", "v1"), ("centre", "v2"))])
    middle = numbered.select(F.col("centre").cast(corner["vid"]).alias("vid"), *[F.col(f"c{a}").cast(corner[a]).alias(a) for a in AXES])
    return faces.select("fid", "v0", "v1", "v2").unionByName(new), vertices.select("vid", *AXES).unionByName(middle)


def corners_of(faces: DataFrame, vertices: DataFrame) -> DataFrame:
    """(fid, x0..z2) of faces; their vertices are shuffled to them, as there are about as many."""
    return gathered(faces, vertices.hint("merge")).select("fid", *CORNERS)
