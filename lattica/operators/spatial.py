"""Joins in space: neighbours, edges, tiles, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.functions.expr import floordiv
from lattica.operators.numbering import fixed

AXES = ("x", "y", "z")


def offsets(values: list[tuple[int, int, int]]) -> Column:
    """An array of (k, dx, dy, dz) to explode."""
    return F.array(*[F.struct(F.lit(k).alias("k"), *[F.lit(d).alias(f"d{a}") for a, d in zip(AXES, v, strict=True)]) for k, v in enumerate(values)])


def neighbours(df: DataFrame, table: DataFrame, moves: list[tuple[int, int, int]], keep: list[str], value: list[str]) -> DataFrame:
    """For every row and move the row of ``table`` that lies there (``k`` is the move): one explode and one equi-join."""
    at = df.select("b", *AXES, *keep, F.inline(offsets(moves)))
    probe = at.select("b", *[F.col(a).alias(f"from_{a}") for a in AXES], *keep, "k", *[(F.col(a) + F.col(f"d{a}")).cast("int").alias(a) for a in AXES])
    return probe.join(table.select("b", *AXES, *[F.col(v).alias(f"near_{v}") for v in value]), ["b", *AXES])


def around(df: DataFrame, moves: list[tuple[int, int, int]], values: list[str], **aggregates: Column) -> DataFrame:
    """Aggregates over the rows that lie at a move from each row of ``df``, itself included, in one shuffle: every row goes to
    the cells that it is a neighbour of, and cells that have no row themselves are dropped. In the aggregates ``k`` is the
    move's number, -1 for the row itself. Cells are unique in ``df``."""
    sent = F.array(*[F.struct(F.lit(k).alias("k"), *[(F.col(a) - d).cast("int").alias(a) for a, d in zip(AXES, v, strict=True)]) for k, v in enumerate([(0, 0, 0), *moves], -1)])
    met = df.select("b", F.explode(sent).alias("_to"), *values).select("b", "_to.*", *values)
    return met.groupBy("b", *AXES).agg(F.min("k").alias("_self"), *[c.alias(n) for n, c in aggregates.items()]).filter("_self = -1").drop("_self")


def at_move(k: int, value: str | Column) -> Column:
    """Aggregate for around(): the value of the row at move ``k``."""
    return F.max(F.when(F.col("k") == k, F.col(value) if isinstance(value, str) else value))


#: The four voxels around the edge of a voxel along each axis, in their order around it.
QUADS = {
    "x": [(0, 0, 0), (0, 0, 1), (0, 1, 1), (0, 1, 0)],
    "y": [(0, 0, 0), (1, 0, 0), (1, 0, 1), (0, 0, 1)],
    "z": [(0, 0, 0), (0, 1, 0), (1, 1, 0), (1, 0, 0)],
}


def quads(df: DataFrame, axis: str, vertex: str) -> DataFrame:
    """The edges along ``axis`` whose four voxels all exist, with their vertex numbers q0..q3."""
    near = QUADS[axis][1:]
    out = around(df.select("b", *AXES, vertex), near, [vertex], q0=at_move(-1, vertex), **{f"q{k + 1}": at_move(k, vertex) for k in range(3)})
    return out.dropna(subset=[f"q{k}" for k in range(4)]).select("b", *AXES, F.lit(axis).alias("axis"), "q0", "q1", "q2", "q3")


def triangles_of(quad: DataFrame) -> DataFrame:
    """Two triangles of each quad, split along q0-q2."""
    return quad.select("b", "axis", F.inline(F.array(*[F.struct(F.lit(t).alias("t"), *[F.col(f"q{q}").alias(f"v{j}") for j, q in enumerate(c)]) for t, c in enumerate(((0, 1, 2), (0, 2, 3)))])))


def dual_mesh(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Triangles (b, axis, x, y, z, t, v0, v1, v2) of a dual grid: rows (b, x, y, z) with a vertex number ``vid``, its place
    vx, vy, vz, and a flag for each axis (ix, iy, iz) that the surface crosses the voxel's edge along it. A crossed edge whose
    four voxels exist is a quad. With ``weight`` it is split along q0-q2 if the product of these two corners' weights is
    greater than that of q1 and q3; else along the diagonal at which the two triangles are less bent. One shuffle."""
    moves = sorted({m for quad in QUADS.values() for m in quad[1:]})
    fields = ["vid", "vx", "vy", "vz", *([weight] if weight else [])]
    corner = F.struct(*fields)
    rows = df.select("b", *AXES, corner.alias("_c"), *[f"i{a}" for a in AXES])
    met = around(rows, moves, ["_c", *[f"i{a}" for a in AXES]], c=at_move(-1, "_c"), **{f"i{a}": at_move(-1, f"i{a}") for a in AXES}, **{f"c{k}": at_move(k, "_c") for k in range(len(moves))})
    of_axis = [
        F.struct(F.lit(a).alias("axis"), F.col(f"i{a}").alias("crossed"), F.col("c").alias("q0"), *[F.col(f"c{moves.index(m)}").alias(f"q{j + 1}") for j, m in enumerate(QUADS[a][1:])]) for a in AXES
    ]
    quad = met.select("b", *AXES, F.inline(F.array(*of_axis))).filter("crossed").dropna(subset=["q1", "q2", "q3"])
    if weight:
        first = F.col(f"q0.{weight}") * F.col(f"q2.{weight}") > F.col(f"q1.{weight}") * F.col(f"q3.{weight}")
    else:
        first = bend(0, 1, 2, 0, 2, 3) >= bend(0, 1, 3, 1, 2, 3)
    cut = lambda *corners: F.array(*[F.struct(F.lit(t).alias("t"), *[F.col(f"q{q}.vid").alias(f"v{j}") for j, q in enumerate(c)]) for t, c in enumerate(corners)])
    return quad.select("b", "axis", *AXES, F.inline(F.when(first, cut((0, 1, 2), (0, 2, 3))).otherwise(cut((0, 1, 3), (1, 2, 3)))))


def bend(*corners: int) -> Column:
    """Cosine of the angle between the normals of two triangles of a quad (six corner numbers), 0 where one is flat; rounded,
    so that equal angles compare as equal."""

    def normal(i: int, j: int, k: int) -> list[Column]:
        one, two = ([F.col(f"q{m}.v{a}") - F.col(f"q{i}.v{a}") for a in AXES] for m in (j, k))
        return [one[p] * two[q] - one[q] * two[p] for p, q in ((1, 2), (2, 0), (0, 1))]

    n, m = normal(*corners[:3]), normal(*corners[3:])
    dot = lambda u, v: u[0] * v[0] + u[1] * v[1] + u[2] * v[2]
    return F.round(F.coalesce(dot(n, m) / F.nullif(F.sqrt(dot(n, n) * dot(m, m)), F.lit(0.0)), F.lit(0.0)), 9)


def edges(faces: DataFrame) -> DataFrame:
    """Unordered edges (a, b) with the number of faces that hold them; a boundary edge has one."""
    pairs = F.array(*[F.struct(F.least(p, q).alias("a"), F.greatest(p, q).alias("b")) for p, q in (("v0", "v1"), ("v1", "v2"), ("v2", "v0"))])
    return faces.select(F.inline(pairs)).groupBy("a", "b").agg(F.count("*").alias("n"))


def gathered(faces: DataFrame, vertices: DataFrame) -> DataFrame:
    """Faces with the coordinates of their corners; the vertex table is joined once per corner."""
    out = faces
    for k in range(3):
        out = out.join(vertices.select(F.col("vid").alias(f"v{k}"), *[F.col(a).alias(f"{a}{k}") for a in AXES]), f"v{k}")
    return out


def window_ids(window: int, shift: int) -> list[Column]:
    """Number of the shifted window on each axis."""
    return [floordiv(F.col(a) + shift, window).cast("int").alias(f"w{a}") for a in AXES]


#: Cells with their corners' values up to so many are broadcast.
BROADCAST_CELLS = 500_000


def trilinear(points: DataFrame, table: DataFrame, value: str) -> DataFrame:
    """(pid, weight, value): the weighted mean of a volume's values at the eight cells around each point (px, py, pz), over
    the cells that exist. ``value`` is null where none does. Each voxel goes to the eight cells that it is a corner of, so a
    point meets one row that holds all its corners and isn't multiplied; up to BROADCAST_CELLS of these rows are broadcast."""
    base = points.select("pid", "b", *[F.floor(f"p{a}").cast("int").alias(a) for a in AXES], *[(F.col(f"p{a}") - F.floor(f"p{a}")).alias(f"f{a}") for a in AXES])
    bit = lambda k, j: k >> j & 1
    spread = F.array(*[F.struct(F.lit(k).alias("k"), *[(F.col(a) - bit(k, j)).cast("int").alias(f"i{a}") for j, a in enumerate(AXES)]) for k in range(8)])
    each = table.select("b", *AXES, F.col(value).cast("double").alias("_v")).filter("_v is not null").select("b", "_v", F.inline(spread))
    at = lambda k, c: F.when(F.col("k") == k, F.col(c))
    cells = fixed(each.groupBy("b", *[F.col(f"i{a}").alias(a) for a in AXES]).agg(*[F.sum(at(k, "_v")).alias(f"v{k}") for k in range(8)], *[F.count(at(k, "_v")).alias(f"n{k}") for k in range(8)]))
    few = cells.count() <= BROADCAST_CELLS
    hit = base.join(F.broadcast(cells) if few else cells, ["b", *AXES], "left")
    weight, total = F.lit(0.0), F.lit(0.0)
    for k in range(8):
        w = F.lit(1.0)
        for j, a in enumerate(AXES):
            w = w * (F.col(f"f{a}") if bit(k, j) else 1 - F.col(f"f{a}"))
        weight = weight + F.coalesce(w * F.col(f"n{k}"), F.lit(0.0))
        total = total + F.coalesce(w * F.col(f"v{k}"), F.lit(0.0))
    found = sum((F.coalesce(F.col(f"n{k}"), F.lit(0)) for k in range(8)), F.lit(0))
    one = hit.select("pid", weight.alias("_w"), total.alias("_t"), found.alias("_n"))
    return one.groupBy("pid").agg(F.sum("_w").alias("weight"), (F.when(F.sum("_n") > 0, F.sum("_t")) / F.nullif(F.when(F.sum("_n") > 0, F.sum("_w")), F.lit(0.0))).alias("value"))


def overlapping(boxes: DataFrame, table: DataFrame, chunk: int = 8) -> DataFrame:
    """Voxels of ``table`` in each box (id, b, lo_*, hi_*): the chunks that a box meets are listed and joined on equality, and
    their voxels filtered. Rows of a box grow with its volume over chunk**3."""
    out, at = boxes, {a: floordiv(a, chunk).alias(f"_{a}") for a in AXES}
    for a in AXES:
        out = out.withColumn(f"_{a}", F.explode(F.sequence(floordiv(f"lo_{a}", chunk), floordiv(f"hi_{a}", chunk))))
    met = out.join(table.select("*", *at.values()), ["b", *(f"_{a}" for a in AXES)])
    for a in AXES:
        met = met.filter(F.col(a).between(F.col(f"lo_{a}"), F.col(f"hi_{a}")))
    return met.drop(*(f"_{a}" for a in AXES))


def first_hits(fragments: DataFrame, pixel: list[str], depth: str, value: str) -> DataFrame:
    """The nearest value at each pixel; of equal depths the least value."""
    return fragments.groupBy(*pixel).agg(F.min(F.struct(depth, value)).alias("_m")).select(*pixel, F.col(f"_m.{depth}").alias(depth), F.col(f"_m.{value}").alias(value))
