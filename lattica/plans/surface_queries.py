"""Nearest surfaces, boundary loops, rasters over a surface that grows with its table."""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import functions as F

from lattica.operators import geometry, raster, surfaces, volumes
from lattica.plans import views
from lattica.plans.catalog import query

CORNER_SQL = f"""t AS (SELECT fid, {', '.join(f'c{k}.{a} AS {a}{k}' for k in range(3) for a in 'xyz')} FROM v_surface JOIN v_node c0 ON c0.vid = v0 JOIN v_node c1 ON c1.vid = v1 JOIN v_node c2 ON c2.vid = v2)"""
PROBE_SQL = "p AS (SELECT c_custkey AS pid, c_custkey * 0.0237::DOUBLE AS px, c_custkey * 7919 % 1000 * 0.021::DOUBLE AS py, c_custkey * 31 % 200 * 0.05::DOUBLE AS pz FROM customer)"


def probes(spark, sf_dir):
    """A point for each customer, over and under the surface."""
    c = views.load(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("pid"), (F.col("c_custkey") * 0.0237).alias("px"), (F.col("c_custkey") * 7919 % 1000 * 0.021).alias("py"), (F.col("c_custkey") * 31 % 200 * 0.05).alias("pz"))


def distance_sql() -> str:
    """Squared distance by the three edges and, where the point lies over the face, the plane."""
    dot = lambda u, v: " + ".join(f"({a}) * ({b})" for a, b in zip(u, v, strict=True))
    edge = lambda i, j: [f"{a}{j} - {a}{i}" for a in "xyz"]
    out, inside = [], []
    for i, j in ((0, 1), (1, 2), (2, 0)):
        e, d = edge(i, j), [f"p{a} - {a}{i}" for a in "xyz"]
        share = f"least(1.0, greatest(0.0, ({dot(d, e)}) / ({dot(e, e)})))"
        away = [f"{x} - {share} * ({y})" for x, y in zip(d, e, strict=True)]
        out.append(dot(away, away))
        cross = [f"({e[q]}) * ({d[r]}) - ({e[r]}) * ({d[q]})" for q, r in ((1, 2), (2, 0), (0, 1))]
        inside.append(f"{dot(cross, ['nx', 'ny', 'nz'])} >= 0")
    d = [f"p{a} - {a}0" for a in "xyz"]
    plane = f"({dot(d, ['nx', 'ny', 'nz'])}) * ({dot(d, ['nx', 'ny', 'nz'])}) / (nx * nx + ny * ny + nz * nz)"
    return f"least({', '.join(out)}, CASE WHEN {' AND '.join(inside)} THEN {plane} ELSE 'Infinity'::DOUBLE END)"


NORMAL_SQL = "n AS (SELECT *, (y1 - y0) * (z2 - z0) - (z1 - z0) * (y2 - y0) AS nx, (z1 - z0) * (x2 - x0) - (x1 - x0) * (z2 - z0) AS ny, (x1 - x0) * (y2 - y0) - (y1 - y0) * (x2 - x0) AS nz FROM t)"


@query(f"WITH {CORNER_SQL}, {NORMAL_SQL}, {PROBE_SQL} SELECT pid, round(sqrt(min({distance_sql()})), 6) AS distance FROM p, n GROUP BY pid")
def nearest_surface(spark, sf_dir):
    """How far each point is from the surface."""
    t = surfaces.corners_of(views.surface(spark, sf_dir), views.nodes(spark, sf_dir))
    return surfaces.nearest_triangles(probes(spark, sf_dir), t, 1.0).select("pid", F.round("distance", 6).alias("distance"))


LOOP_SQL = """e AS (SELECT v0 AS a, v1 AS b FROM v_surface UNION ALL SELECT v1, v2 FROM v_surface UNION ALL SELECT v2, v0 FROM v_surface),
    o AS (SELECT min(b) AS s, min(a) AS e FROM e GROUP BY least(a, b), greatest(a, b) HAVING count(*) = 1),
    m AS (SELECT s, e FROM o WHERE s IN (SELECT s FROM o GROUP BY s HAVING count(*) = 1) AND s IN (SELECT e FROM o GROUP BY e HAVING count(*) = 1) AND e IN (SELECT s FROM o GROUP BY s HAVING count(*) = 1) AND e IN (SELECT e FROM o GROUP BY e HAVING count(*) = 1)),
    w AS (SELECT s AS home, e AS here, least(s, e) AS low, 1 AS k FROM m UNION ALL SELECT w.home, m.e, least(w.low, m.e), w.k + 1 FROM w JOIN m ON m.s = w.here WHERE w.here <> w.home),
    l AS (SELECT home AS s, low AS loop FROM w WHERE here = home),
    g AS (SELECT m.s, m.e, l.loop FROM m JOIN l ON l.s = m.s),
    h AS (SELECT loop, count(*) AS n, sum(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z))) AS perimeter, avg(a.x) AS cx, avg(a.y) AS cy, avg(a.z) AS cz FROM g JOIN v_node a ON a.vid = g.s JOIN v_node b ON b.vid = g.e GROUP BY loop)"""


@query(f"WITH RECURSIVE {LOOP_SQL} SELECT loop, n, round(perimeter, 6) AS perimeter FROM h")
def boundary_loops(spark, sf_dir):
    """The holes of the surface and its outer border, by their least vertex."""
    loops = surfaces.boundary_loops(views.surface(spark, sf_dir))
    return surfaces.measured(loops, views.nodes(spark, sf_dir)).select("loop", "n", F.round("perimeter", 6).alias("perimeter"))


@query(
    f"""WITH RECURSIVE {LOOP_SQL}, c AS (SELECT loop, (SELECT max(vid) FROM v_node) + row_number() OVER (ORDER BY loop) AS v, cx, cy, cz FROM h WHERE perimeter <= 4)
    SELECT v0, v1, v2, CAST(NULL AS DOUBLE) AS cx, CAST(NULL AS DOUBLE) AS cy, CAST(NULL AS DOUBLE) AS cz FROM v_surface UNION ALL SELECT s, e, v, round(cx, 6), round(cy, 6), round(cz, 6) FROM g JOIN c ON c.loop = g.loop"""
)
def filled_surface(spark, sf_dir):
    """The surface with its small holes closed by fans; new vertices with their places."""
    f, v = surfaces.filled(views.surface(spark, sf_dir), views.nodes(spark, sf_dir), 4.0)
    new = v.join(views.nodes(spark, sf_dir).select("vid"), "vid", "left_anti")
    return f.join(new.withColumnRenamed("vid", "v2"), "v2", "left").select("v0", "v1", "v2", *[F.round(a, 6).alias(f"c{a}") for a in "xyz"])


def looking(place: tuple[float, float, float], tilt: float, turn: float) -> tuple[tuple[float, ...], ...]:
    """View matrix of a camera at a place that looks along z, turned around y and tilted around x."""
    c, s, d, t = math.cos(turn), math.sin(turn), math.cos(tilt), math.sin(tilt)
    rows = ((c, 0.0, -s), (s * t, d, c * t), (s * d, -t, c * d))
    return (*((*r, -sum(x * y for x, y in zip(r, place, strict=True))) for r in rows), (0.0, 0.0, 0.0, 1.0))


#: Over the surface's first rows, a little askew.
CAMERA = raster.Camera(looking((6.0, 9.0, -9.0), 0.13, -0.11), 96, 64, 0.9, 1.1)


def raster_sql(c: raster.Camera, size: float, tile: int) -> str:
    view, p, o = np.array(c.view), c.projection, c.origin
    lin = lambda row, point: " + ".join([f"{float(row[3])!r}::DOUBLE", *(f"{float(w)!r}::DOUBLE * ({v})" for w, v in zip(row[:3], point, strict=True))])
    us, vs = [], []
    for i in (-0.5, 0.5):
        for j in (-0.5, 0.5):
            for k in (-0.5, 0.5):
                corner = [f"{a} + {d * size!r}::DOUBLE" for a, d in zip("xyz", (i, j, k), strict=True)]
                w = f"1 / ({lin(p[2], corner)} + 1e-7::DOUBLE)"
                us.append(f"CAST(trunc((({lin(p[0], corner)}) * ({w}) + 1) * {0.5 * c.width!r}::DOUBLE) AS INT)")
                vs.append(f"CAST(trunc((({lin(p[1], corner)}) * ({w}) + 1) * {0.5 * c.height!r}::DOUBLE) AS INT)")
    ways = [f"{float(view[0][k])!r}::DOUBLE * a + {float(view[1][k])!r}::DOUBLE * b + {float(view[2][k])!r}::DOUBLE" for k in range(3)]
    near = [f"least(({a} - {size / 2!r}::DOUBLE - ({float(o[k])!r}::DOUBLE)) / d{a}, ({a} + {size / 2!r}::DOUBLE - ({float(o[k])!r}::DOUBLE)) / d{a})" for k, a in enumerate("xyz")]
    far = [x.replace("least", "greatest", 1) for x in near]
    return f"""WITH v AS (SELECT vid AS id, x, y, z, {lin(view[2], 'xyz')} AS depth FROM v_node), b AS (SELECT *, greatest(0, least({', '.join(us)})) AS u0, least({c.width}, greatest({', '.join(us)}) + 1) AS u1, greatest(0, least({', '.join(vs)})) AS v0, least({c.height}, greatest({', '.join(vs)}) + 1) AS v1 FROM v WHERE depth > 0.2),
    q AS (SELECT i.range AS px, j.range AS py, (2 * (i.range + 0.5::DOUBLE) / {c.width} - 1) * {0.5 / c.fx!r}::DOUBLE AS a, (2 * (j.range + 0.5::DOUBLE) / {c.height} - 1) * {0.5 / c.fy!r}::DOUBLE AS b FROM range({c.width}) i, range({c.height}) j),
    r AS (SELECT px, py, {', '.join(f'{w} AS e{a}' for w, a in zip(ways, 'xyz', strict=True))} FROM q), d AS (SELECT px, py, {', '.join(f'e{a} / sqrt(ex * ex + ey * ey + ez * ez) AS d{a}' for a in 'xyz')} FROM r),
    h AS (SELECT py, px, id, depth, greatest({', '.join(near)}) AS entry, least({', '.join(far)}) AS leave FROM b JOIN d ON px >= u0 // {tile} * {tile} AND px < (u1 + {tile - 1}) // {tile} * {tile} AND py >= v0 // {tile} * {tile} AND py < (v1 + {tile - 1}) // {tile} * {tile} WHERE u0 < u1 AND v0 < v1)
    SELECT CAST(py AS INT) AS py, CAST(px AS INT) AS px, arg_min(id, {{'d': depth, 'i': id}}) AS id, round(arg_min(entry, {{'d': depth, 'i': id}}), 6) AS distance FROM h WHERE leave > entry GROUP BY py, px"""


@query(raster_sql(CAMERA, 0.6, 16))
def voxel_raster(spark, sf_dir):
    """The surface's vertices as boxes in perspective: which one each pixel shows, and how far away."""
    v = views.nodes(spark, sf_dir).withColumnRenamed("vid", "id")
    return raster.rasterised(v, CAMERA, 0.6).select("py", "px", "id", F.round("distance", 6).alias("distance"))


#: Voxels are so many times finer than the surface's unit; texels of a texture's edge; cells of the grid.
FINER, TEXELS, CELLS = 2.0, 8, 4096
#: Which of a material's textures exist, and how they are read: by the material's number m and the texture's k.
SLOT_RULES = {"tex": "m * 6 + k", "linear": "(m + k) % 5 <> 0", "wrap": "CASE (m + k) % 3 WHEN 0 THEN 'repeat' WHEN 1 THEN 'clamp' ELSE 'mirror' END"}
FACTORS = {
    **{f"base_{k}": f"1 - m * 0.0{k + 3}" for k in range(3)}, "metallic": "0.3 + m * 0.1", "roughness": "0.9 - m * 0.07", **{f"emissive_{k}": f"m * 0.{k + 2}" for k in range(3)}, "alpha": "0.95 - m * 0.02", "cutoff": "0.45",
    "mode": "CASE m % 3 WHEN 0 THEN 'OPAQUE' WHEN 1 THEN 'MASK' ELSE 'BLEND' END",
}
#: What a vertex has besides its place.
EXTRA = {"nx": "vid % 3 * 0.1 - 0.1", "ny": "vid % 5 * 0.1 - 0.2", "nz": "1.0", "s": "x * 0.37 + vid % 7 * 0.021", "t": "y * 0.29 - vid % 4 * 0.017 - 1.3"}


def doubled(sql: str) -> str:
    """Numbers with a point as doubles, in both engines."""
    return re.sub(r"(\d+\.\d+)", r"CAST(\1 AS DOUBLE)", sql)


def textured(spark, sf_dir):
    """The surface in voxels, a material for each triangle, and normals and texture coordinates from the vertices' numbers."""
    v = views.nodes(spark, sf_dir).select("vid", *[F.expr(f"{a} * {FINER}").alias(a) for a in "xyz"], *[F.expr(doubled(e)).alias(c) for c, e in EXTRA.items()])
    out = views.surface(spark, sf_dir).withColumn("mid", F.col("fid") % 5)
    for k in range(3):
        out = out.join(v.select(F.col("vid").alias(f"v{k}"), *[F.col(c).alias(f"{c}{k}") for c in v.columns[1:]]), f"v{k}")
    return out


def borders(spark, sf_dir):
    """The surface's open edges as segments, in voxels."""
    v = views.nodes(spark, sf_dir)
    end = lambda k, c: v.select(F.col("vid").alias(c), *[(F.col(a) * FINER).alias(f"{a}{k}") for a in "xyz"])
    b = surfaces.boundary_edges(views.surface(spark, sf_dir)).join(end(0, "s"), "s").join(end(1, "e"), "e")
    return b.select(F.xxhash64("s", "e").alias("sid"), *[f"{a}{k}" for k in (0, 1) for a in "xyz"])


@query()
def surface_dual_grid(spark, sf_dir):
    """The dual grid of the surface with its vertices, drawn to faces and open borders as well; a test holds the query against
    loops over all lines, cells and planes."""
    t = textured(spark, sf_dir).select("fid", *geometry.CORNERS)
    out = geometry.dual_grid(t, CELLS, borders(spark, sf_dir))
    return out.select("x", "y", "z", "n", "ix", "iy", "iz", *[F.round(f"v{a}", 6).alias(f"v{a}") for a in "xyz"])


def texels(spark, sf_dir):
    """Six textures for each of five materials, out of quantities."""
    i = views.load(spark, sf_dir, "lineitem")
    cells = i.groupBy((F.col("l_suppkey") % 5).alias("m"), (F.col("l_partkey") % TEXELS).cast("int").alias("ty"), (F.col("l_orderkey") % TEXELS).cast("int").alias("tx")).agg(F.sum(F.col("l_quantity").cast("long")).alias("q"), F.count("*").alias("c"))
    each = cells.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(5))))
    return each.select(F.expr(SLOT_RULES["tex"]).alias("tex"), "ty", "tx", *[F.expr(f"cast((q * (2 * k + 3) + {j} * 67 + c) % 256 as int)").alias(f"c{j}") for j in range(3)])


def volume_sql() -> str:
    parts, cells = [], []
    for c, (p, q) in (("x", ("y", "z")), ("y", ("z", "x")), ("z", ("x", "y"))):
        ends = ", ".join(f"CASE WHEN least({q}{k}, {q}{m}) < w AND w <= greatest({q}{k}, {q}{m}) THEN {p}{k} + (w - {q}{k}) * ({p}{m} - {p}{k}) / ({q}{m} - {q}{k}) END" for k, m in ((0, 1), (1, 2), (2, 0)))
        rows = f"SELECT *, unnest(range(CAST(floor(least({q}0, {q}1, {q}2)) AS BIGINT) + 1, CAST(floor(greatest({q}0, {q}1, {q}2)) AS BIGINT) + 1)) AS w FROM n WHERE n{c} <> 0"
        spans = f"SELECT *, unnest(range(CAST(floor(list_min([{ends}])) AS BIGINT) + 1, CAST(floor(list_max([{ends}])) AS BIGINT) + 1)) AS o FROM ({rows})"
        parts.append(f"h{c} AS (SELECT fid, CAST(o AS BIGINT) AS o, CAST(w AS BIGINT) AS w, CAST(floor({c}0 - (n{p} * (o - {p}0) + n{q} * (w - {q}0)) / n{c}) AS BIGINT) AS h FROM ({spans}))")
        at = {c: "h", p: "o - i.range", q: "w - j.range"}
        cells.append(f"SELECT fid, {', '.join(f'{at[a]} AS {a}' for a in 'xyz')} FROM h{c}, range(2) i, range(2) j")
    columns = ", ".join(f"c{k}.{c} AS {c}{k}" for k in range(3) for c in ("x", "y", "z", *EXTRA))
    e, f, g = ([f"({a}{j} - {a}0)" for a in "xyz"] for j in (1, 2, 9))
    dot = lambda u, v: " + ".join(f"({a}) * ({b})" for a, b in zip(u, v, strict=True))
    g = [f"({a} + CAST(0.5 AS DOUBLE) - {a}0 - d * u{a})" for a in "xyz"]
    mean = lambda c: f"(1 - b1 - b2) * {c}0 + b1 * {c}1 + b2 * {c}2"
    wrap = lambda i: f"CASE wrap WHEN 'clamp' THEN least(greatest({i}, 0), n - 1) WHEN 'mirror' THEN CASE WHEN (({i}) % (2 * n) + 2 * n) % (2 * n) < n THEN (({i}) % (2 * n) + 2 * n) % (2 * n) ELSE 2 * n - 1 - (({i}) % (2 * n) + 2 * n) % (2 * n) END ELSE (({i}) % n + n) % n END"
    tops = (TEXELS - 1).bit_length()
    mips = "".join(f", m{k} AS (SELECT tex, {k} AS level, ty // 2 AS ty, tx // 2 AS tx, {', '.join(f'CAST(sum(c{j}) AS BIGINT) // 4 AS c{j}' for j in range(3))} FROM m{k - 1} GROUP BY tex, ty // 2, tx // 2)" for k in range(1, tops + 1))
    values = ", ".join(f"sum(CASE WHEN slot = '{s}' THEN w * c{k} / 255 END) AS s_{s}_{k}" for s, n in volumes.SLOTS.items() for k in range(n))
    one = lambda s, k=0: f"coalesce(s_{s}_{k}, 1)"
    out = {f"{s}_{k}": f"{one(s, k)} * {s}_{k}" for s in ("base", "emissive") for k in range(3)} | {s: f"{one(s)} * {s}" for s in ("metallic", "roughness")}
    out["alpha"] = f"CASE mode WHEN 'OPAQUE' THEN 1.0 WHEN 'MASK' THEN CASE WHEN {one('alpha')} * alpha < cutoff THEN 0.0 ELSE 1.0 END ELSE {one('alpha')} * alpha END"
    bent = {a: f"(2 * s_normal_0 - 1) * t{a} + (2 * s_normal_1 - 1) * o{a} + (2 * s_normal_2 - 1) * i{a}" for a in "xyz"}
    size = f"nullif(sqrt({' + '.join(f'({b}) * ({b})' for b in bent.values())}), 0)"
    out |= {f"normal_{k}": f"CASE WHEN s_normal_0 IS NULL THEN i{a} ELSE coalesce(({bent[a]}) / {size}, 0.0) END" for k, a in enumerate("xyz")}
    sums = ", ".join(f"round(sum(({out[c]}) * weight) / sum(weight), 5) + 0 AS {c}" for c in volumes.ATTRIBUTES)
    nodes = f"v AS (SELECT vid, {', '.join(f'{a} * {FINER}::DOUBLE AS {a}' for a in 'xyz')}, {', '.join(f'{doubled(x)} AS {c}' for c, x in EXTRA.items())} FROM v_node)"
    tangent = {a: f"((t2 - t0) * {e[k]} - (t1 - t0) * {f[k]})" for k, a in enumerate("xyz")}
    other = {a: f"((s1 - s0) * {f[k]} - (s2 - s0) * {e[k]})" for k, a in enumerate("xyz")}
    norm = lambda v: f"sqrt({' + '.join(f'{x} * {x}' for x in v.values())})"
    flat = "abs(det) < 1e-6"
    return f"""WITH {nodes}, t AS (SELECT fid, fid % 5 AS mid, {columns} FROM v_surface JOIN v c0 ON c0.vid = v0 JOIN v c1 ON c1.vid = v1 JOIN v c2 ON c2.vid = v2), {NORMAL_SQL}, {', '.join(parts)},
    x AS (SELECT DISTINCT * FROM ({' UNION ALL '.join(cells)}) WHERE x BETWEEN 0 AND {CELLS - 1} AND y BETWEEN 0 AND {CELLS - 1} AND z BETWEEN 0 AND {CELLS - 1}),
    a AS (SELECT x.*, n.* EXCLUDE (fid), {', '.join(f'n{a} / sqrt(nx * nx + ny * ny + nz * nz) AS u{a}' for a in 'xyz')}, (s1 - s0) * (t2 - t0) - (t1 - t0) * (s2 - s0) AS det FROM x JOIN n ON n.fid = x.fid),
    b AS (SELECT *, {dot([f'{a} + CAST(0.5 AS DOUBLE) - {a}0' for a in 'xyz'], ['ux', 'uy', 'uz'])} AS d FROM a),
    c AS (SELECT *, {dot(e, e)} AS ee, {dot(e, f)} AS ef, {dot(f, f)} AS ff, {dot(g, e)} AS ge, {dot(g, f)} AS gf FROM b),
    d AS (SELECT *, (ff * ge - ef * gf) / (ee * ff - ef * ef) AS b1, (ee * gf - ef * ge) / (ee * ff - ef * ef) AS b2 FROM c),
    p AS (SELECT fid, mid, x, y, z, 1 - d AS weight, {mean('s')} AS u, {mean('t')} AS v, {', '.join(f'{mean("n" + a)} AS i{a}' for a in 'xyz')}, CASE WHEN {flat} THEN 1e-6::DOUBLE ELSE 1 / sqrt({norm(tangent)} * {norm(other)} / (det * det)) END AS length,
    {', '.join(f'CASE WHEN {flat} THEN {v} ELSE {tangent[a]} / {norm(tangent)} END AS t{a}' for a, v in zip('xyz', (1.0, 0.0, 0.0), strict=True))}, {', '.join(f'CASE WHEN {flat} THEN {v} ELSE {other[a]} / {norm(other)} END AS o{a}' for a, v in zip('xyz', (0.0, 1.0, 0.0), strict=True))} FROM d),
    mt AS (SELECT m, {', '.join(f'{doubled(x)} AS {c}' for c, x in FACTORS.items())} FROM (SELECT r_regionkey AS m FROM region)), sl AS (SELECT m, slot, {', '.join(f'{x} AS {c}' for c, x in SLOT_RULES.items())} FROM (SELECT r_regionkey AS m FROM region), (VALUES {', '.join(f"('{s}', {k})" for k, s in enumerate(volumes.SLOTS))}) q(slot, k) WHERE (m + k) % 4 <> 0),
    lc AS (SELECT l_suppkey % 5 AS m, l_partkey % {TEXELS} AS ty, l_orderkey % {TEXELS} AS tx, sum(CAST(trunc(l_quantity) AS BIGINT)) AS q, count(*) AS c FROM lineitem GROUP BY ALL),
    m0 AS (SELECT {SLOT_RULES['tex']} AS tex, 0 AS level, ty, tx, {', '.join(f'CAST((q * (2 * k + 3) + {j} * 67 + c) % 256 AS BIGINT) AS c{j}' for j in range(3))} FROM lc, (SELECT range AS k FROM range(6))){mips}, ml AS ({' UNION ALL '.join(f'SELECT * FROM m{k}' for k in range(tops + 1))}),
    w AS (SELECT p.fid, x, y, z, u, v, slot, tex, linear, wrap, least(greatest(log2(length * {TEXELS}), 0), {tops}) AS l FROM p JOIN sl ON sl.m = p.mid),
    k AS (SELECT *, 0 AS level, CAST(1 AS DOUBLE) AS s FROM w WHERE NOT linear UNION ALL SELECT *, CAST(floor(l) AS INT), 1 - (l - floor(l)) FROM w WHERE linear UNION ALL SELECT *, least(CAST(floor(l) AS INT) + 1, {tops}), l - floor(l) FROM w WHERE linear AND l > floor(l)),
    y AS (SELECT *, {TEXELS} >> level AS n, CASE WHEN linear THEN u * ({TEXELS} >> level) - 0.5::DOUBLE ELSE u * {TEXELS} END AS px, CASE WHEN linear THEN (1 - v) * ({TEXELS} >> level) - 0.5::DOUBLE ELSE (1 - v) * {TEXELS} END AS py FROM k),
    z AS (SELECT y.*, i.range AS di, j.range AS dj, CAST(floor(px) AS BIGINT) + i.range AS ix, CAST(floor(py) AS BIGINT) + j.range AS iy FROM y, range(2) i, range(2) j WHERE linear OR (i.range = 0 AND j.range = 0)),
    q AS (SELECT fid, x, y, z, slot, tex, level, {wrap('ix')} AS tx, {wrap('iy')} AS ty, CASE WHEN linear THEN s * CASE di WHEN 1 THEN px - floor(px) ELSE 1 - (px - floor(px)) END * CASE dj WHEN 1 THEN py - floor(py) ELSE 1 - (py - floor(py)) END ELSE 1 END AS w FROM z),
    o AS (SELECT fid, x, y, z, {values} FROM q JOIN ml USING (tex, level, ty, tx) GROUP BY fid, x, y, z)
    SELECT CAST(x AS INT) AS x, CAST(y AS INT) AS y, CAST(z AS INT) AS z, count(*) AS n, {sums} FROM p LEFT JOIN o USING (fid, x, y, z) JOIN mt ON mt.m = p.mid GROUP BY x, y, z"""


@query(volume_sql())
def textured_volume(spark, sf_dir):
    """The six attributes of a textured surface as voxels: its own mip levels for each texture, all wraps, alpha modes, bent normals."""
    region = views.load(spark, sf_dir, "region").select(F.col("r_regionkey").alias("m"))
    materials = region.select(F.col("m").alias("mid"), *[F.expr(doubled(e)).alias(c) for c, e in FACTORS.items()])
    kinds = F.explode(F.array(*[F.struct(F.lit(s).alias("slot"), F.lit(k).alias("k")) for k, s in enumerate(volumes.SLOTS)]))
    slots = region.select("m", kinds.alias("q")).select("m", "q.*").filter("(m + k) % 4 <> 0")
    slots = slots.select(F.col("m").alias("mid"), "slot", F.lit(TEXELS).alias("size"), *[F.expr(e).alias(c) for c, e in SLOT_RULES.items()])
    out = volumes.volumetric(textured(spark, sf_dir), materials, slots, volumes.byte_mipmaps(texels(spark, sf_dir), TEXELS), CELLS)
    return out.select("x", "y", "z", "n", *[(F.round(c, 5) + 0).alias(c) for c in volumes.ATTRIBUTES])
