"""Lookups, projections and contracts that the other modules don't show."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from lattica.functions import expr
from lattica.operators import geometry, mapping, sparse, spatial
from lattica.operators.numbering import fixed
from lattica.plans import views
from lattica.plans.catalog import query
from lattica.plans.geometry_queries import triangles


def r(c, digits=6):
    return F.round(c, digits) + F.lit(0.0)


@query(
    """SELECT p.k, t.v FROM (SELECT DISTINCT CAST(o_custkey % 200 AS BIGINT) AS k FROM orders) p LEFT JOIN
    (SELECT l_suppkey % 97 AS k, CAST(max(l_orderkey * 8 + l_linenumber) AS BIGINT) AS v FROM lineitem GROUP BY 1) t ON p.k = t.k"""
)
def hash_probe(spark, sf_dir):
    """Key to value with the last writer winning, probed with keys of which some miss."""
    i = views.load(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 97).alias("k"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("v"))
    table = i.groupBy("k").agg(F.max("v").alias("v"))
    return views.load(spark, sf_dir, "orders").select((F.col("o_custkey") % 200).alias("k")).distinct().join(table, "k", "left").select("k", "v")


@query(
    """WITH p AS (SELECT o_orderkey AS pid, CAST(o_custkey % 4 AS INT) AS b, CAST(o_orderkey % 40 - 4 AS INT) AS x, CAST(o_custkey % 32 AS INT) AS y, CAST(o_orderkey % 37 AS INT) AS z FROM orders)
    SELECT p.pid, v.n FROM p LEFT JOIN v_voxel v ON p.x BETWEEN 0 AND 31 AND p.z BETWEEN 0 AND 31 AND v.b = p.b AND v.x = p.x AND v.y = p.y AND v.z = p.z"""
)
def coords_lookup(spark, sf_dir):
    """Points looked up by one packed key; those outside the grid miss."""
    o = views.load(spark, sf_dir, "orders")
    p = o.select("o_orderkey", (F.col("o_custkey") % 4).alias("b"), (F.col("o_orderkey") % 40 - 4).alias("x"), (F.col("o_custkey") % 32).alias("y"), (F.col("o_orderkey") % 37).alias("z"))
    digits = [("b", 4), ("x", 32), ("y", 32), ("z", 32)]
    inside = F.col("x").between(0, 31) & F.col("z").between(0, 31)
    probe = p.select(F.col("o_orderkey").alias("pid"), F.when(inside, expr.linear(digits)).alias("key"))
    return probe.join(views.voxels(spark, sf_dir).select(expr.linear(digits).alias("key"), "n"), "key", "left").select("pid", "n")


@query("SELECT b, round(avg(0.5 * (m * m + exp(l) - 1 - l)), 6) AS kl FROM (SELECT b, CAST(unnest(feats) AS DOUBLE) AS m, CAST(unnest(list_reverse(feats)) AS DOUBLE) AS l FROM v_latent) GROUP BY b")
def kl_divergence(spark, sf_dir):
    v = views.latents(spark, sf_dir).select("b", F.inline(F.arrays_zip(F.col("feats").alias("m"), F.reverse("feats").alias("l")))).toDF("b", "m", "l")
    m, log = F.col("m").cast("double"), F.col("l").cast("double")
    return v.groupBy("b").agg(F.round(F.avg(0.5 * (m * m + F.exp(log) - 1 - log)), 6).alias("kl"))


@query("SELECT b, min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy FROM v_voxel WHERE n > 2 GROUP BY b")
def mask_bounds(spark, sf_dir):
    """Bounding box of the pixels of a mask."""
    return views.voxels(spark, sf_dir).filter("n > 2").groupBy("b").agg(F.min("x").alias("lx"), F.max("x").alias("hx"), F.min("y").alias("ly"), F.max("y").alias("hy"))


@query(
    """WITH p AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, row_number() OVER (PARTITION BY conv_id ORDER BY length(text), turn) - 1 AS j FROM conversations)
    SELECT conv_id, CAST(j AS INT) AS slot, CAST(i AS INT) AS source FROM p"""
)
def inverse_permutation(spark, sf_dir):
    """Which row each slot of a sorted batch came from."""
    c = views.load(spark, sf_dir, "conversations")
    by = lambda *o: (F.row_number().over(Window.partitionBy("conv_id").orderBy(*o)) - 1).cast("int")
    return c.select("conv_id", by(F.length("text"), "turn").alias("slot"), by("turn").alias("source"))


@query("SELECT b, x, y, z, (CAST((y // 8) * 4 + x // 8 AS BIGINT) << 32) | CAST(z AS BIGINT) AS key FROM v_voxel")
def tile_sort_keys(spark, sf_dir):
    """Tile and depth in one 64-bit key."""
    tile = expr.floordiv("y", 8) * 4 + expr.floordiv("x", 8)
    return views.voxels(spark, sf_dir).select("b", "x", "y", "z", F.shiftleft(tile, 32).bitwiseOR(F.col("z").cast("long")).alias("key"))


@query("SELECT fid, list_sort([v0, v1, v2]) AS corners FROM v_face")
def sorted_corners(spark, sf_dir):
    return views.faces(spark, sf_dir).select("fid", F.array_sort(F.array("v0", "v1", "v2")).alias("corners"))


@query("SELECT event_id, value FROM events WHERE value IS NOT NULL ORDER BY value DESC, event_id LIMIT 25")
def top_values(spark, sf_dir):
    return views.load(spark, sf_dir, "events").filter("value is not null").orderBy(F.desc("value"), "event_id").limit(25).select("event_id", "value")


@query("SELECT b, x, y, z, round((x + 0.5) / 32 - 0.5, 6) + 0 AS px, round((y + 0.5) / 32 - 0.5, 6) + 0 AS py, round((z + 0.5) / 32 - 0.5, 6) + 0 AS pz FROM v_voxel")
def voxel_centres(spark, sf_dir):
    return views.voxels(spark, sf_dir).select("b", "x", "y", "z", *[r(expr.centre(a, 1 / 32, -0.5)).alias(f"p{a}") for a in "xyz"])


@query(
    """SELECT b, CAST(x * 2 + k.range % 2 AS INT) AS x, CAST(y * 2 + k.range // 2 % 2 AS INT) AS y, CAST(z * 2 + k.range // 4 AS INT) AS z
    FROM v_voxel, range(8) k WHERE (n >> k.range) & 1 = 1"""
)
def subdivided_coords(spark, sf_dir):
    """Children named by a mask's bits."""
    return sparse.upsampled(views.voxels(spark, sf_dir).select("b", "x", "y", "z", F.col("n").cast("int").alias("mask")))


@query(
    """WITH g AS (SELECT fid, a.x AS ax, a.y AS ay, a.z AS az, b.x - a.x AS ex, b.y - a.y AS ey, b.z - a.z AS ez, c.x - a.x AS fx, c.y - a.y AS fy, c.z - a.z AS fz FROM (SELECT DISTINCT v0 * 2500 + v1 * 50 + v2 AS fid, v0, v1, v2 FROM v_face)
    JOIN v_vertex a ON a.vid = v0 JOIN v_vertex b ON b.vid = v1 JOIN v_vertex c ON c.vid = v2),
    d AS (SELECT fid, ex*ex+ey*ey+ez*ez AS ee, ex*fx+ey*fy+ez*fz AS ef, fx*fx+fy*fy+fz*fz AS ff, (4-ax)*ex+(4-ay)*ey+(4-az)*ez AS ge, (4-ax)*fx+(4-ay)*fy+(4-az)*fz AS gf FROM g)
    SELECT fid, round((ff*ge-ef*gf) / nullif(ee*ff-ef*ef, 0), 6) + 0 AS v, round((ee*gf-ef*ge) / nullif(ee*ff-ef*ef, 0), 6) + 0 AS w FROM d"""
)
def barycentric_weights(spark, sf_dir):
    f = views.faces(spark, sf_dir).select(F.expr("v0 * 2500 + v1 * 50 + v2").alias("fid"), "v0", "v1", "v2").distinct()
    g = spatial.gathered(f, views.vertices(spark, sf_dir))
    _, v, w = expr.barycentric([F.lit(4.0)] * 3, *[[f"{a}{k}" for a in "xyz"] for k in range(3)])
    return g.select("fid", r(v).alias("v"), r(w).alias("w"))


@query(
    """WITH q AS (SELECT p_partkey, CAST(p_size % 5 AS DOUBLE) AS a, CAST(p_size % 7 AS DOUBLE) AS b, CAST(p_partkey % 3 AS DOUBLE) AS c FROM part),
    n AS (SELECT p_partkey, [-a, -b, 1.0] AS u, [a - c, b - 1, 1.0] AS v FROM q) SELECT p_partkey, round(acos(least(greatest(list_dot_product(u, v) / nullif(sqrt(list_dot_product(u, u) * list_dot_product(v, v)), 0), -1), 1)), 6) AS angle FROM n"""
)
def fold_angles(spark, sf_dir):
    """Angle between the normals of two triangles of a quad."""
    p = views.load(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 5).cast("double").alias("a"), (F.col("p_size") % 7).cast("double").alias("b"), (F.col("p_partkey") % 3).cast("double").alias("c"))
    return p.select("p_partkey", F.round(expr.angle_between([-F.col("a"), -F.col("b"), F.lit(1.0)], [F.col("a") - F.col("c"), F.col("b") - 1, F.lit(1.0)]), 6).alias("angle"))


@query("SELECT p_partkey, round(2 * (0.5 / tan(f / 2)), 6) AS m00, round(100 / 99.9, 6) AS m22, round(-0.1 * 100 / 99.9, 6) AS m23 FROM (SELECT p_partkey, 0.4 + p_size * 0.01 AS f FROM part)")
def perspective_matrix(spark, sf_dir):
    p = views.load(spark, sf_dir, "part").select("p_partkey", expr.focal(0.4 + F.col("p_size") * 0.01).alias("f"))
    m = p.select("p_partkey", expr.perspective(F.col("f"), F.col("f"), 0.1, 100.0).alias("m"))
    return m.select("p_partkey", F.round(F.col("m")[0][0], 6).alias("m00"), F.round(F.col("m")[2][2], 6).alias("m22"), F.round(F.col("m")[2][3], 6).alias("m23"))


@query("SELECT vec_id, CAST(pos // 8 AS INT) AS channel, CAST(pos // 4 % 2 AS INT) AS dx, CAST(pos // 2 % 2 AS INT) AS dy, CAST(pos % 2 AS INT) AS dz, round(CAST(v AS DOUBLE), 6) AS value FROM (SELECT vec_id, unnest(range(64)) AS pos, unnest(feats) AS v FROM v_latent)")
def pixel_shuffle(spark, sf_dir):
    """Channels spread over the eight children of a cell."""
    v = views.latents(spark, sf_dir).select("vec_id", F.posexplode("feats").alias("pos", "v"))
    at = expr.linear_back(F.col("pos").cast("long"), [8, 2, 2, 2])
    return v.select("vec_id", *[c.cast("int").alias(n) for c, n in zip(at, ("channel", "dx", "dy", "dz"), strict=True)], F.round(F.col("v").cast("double"), 6).alias("value"))


@query("SELECT event_id, CAST(CASE WHEN user_id % 2 = 0 THEN user_id ELSE event_id END AS BIGINT) AS a, event_id + 1 AS b, true AS any_even, user_id % 2 = 0 AND event_id % 2 = 0 AS all_even FROM (SELECT * FROM events WHERE user_id % 2 = 0 OR event_id % 2 = 0)")
def map_functions(spark, sf_dir):
    """Merged maps (the right one wins), values changed, any and all."""
    e = views.load(spark, sf_dir, "events").filter("user_id % 2 = 0 or event_id % 2 = 0")
    left = F.create_map(F.lit("a"), F.col("event_id"), F.lit("b"), F.col("event_id"))
    right = F.create_map(F.lit("a"), F.when(F.col("user_id") % 2 == 0, F.col("user_id").cast("long")).otherwise(F.col("event_id")))
    both = F.map_concat(F.map_filter(left, lambda k, v: ~F.map_contains_key(right, k)), right)
    e = e.select("event_id", both.alias("m"), F.array("user_id", "event_id").alias("l"))
    even = lambda x: x % 2 == 0
    return e.select("event_id", F.col("m")["a"].alias("a"), F.transform_values("m", lambda k, v: v + 1)["b"].alias("b"), F.exists("l", even).alias("any_even"), F.forall("l", even).alias("all_even"))


@query("SELECT vec_id, abs(a - b) <= 0.05 + 0.1 * abs(b) AS close FROM (SELECT vec_id, CAST(feats[1] AS DOUBLE) AS a, CAST(feats[2] AS DOUBLE) AS b FROM v_latent)")
def tolerance(spark, sf_dir):
    v = views.latents(spark, sf_dir)
    return v.select("vec_id", expr.within(F.element_at("feats", 1).cast("double"), F.element_at("feats", 2).cast("double"), 0.05, 0.1).alias("close"))


@query(
    """WITH c AS (SELECT b, x, y, z, k.range AS k, (x + k.range % 2 - 16) AS cx, (y + k.range // 2 % 2 - 16) AS cy, (z + k.range // 4 + 10.0) AS cz FROM v_voxel, range(8) k)
    SELECT b, x, y, z, round(min(cx / cz), 6) + 0 AS lu, round(max(cx / cz), 6) + 0 AS hu, round(min(cy / cz), 6) + 0 AS lv, round(max(cy / cz), 6) + 0 AS hv FROM c GROUP BY 1, 2, 3, 4 HAVING max(cx / cz) >= -1 AND min(cx / cz) <= 1 AND max(cy / cz) >= -1 AND min(cy / cz) <= 1"""
)
def frustum_cull(spark, sf_dir):
    """Voxels that a camera sees, with the box of their eight projected corners. The voxels are fixed first: a filter on their
    coordinates alone is else pushed below the grouping and the corners are projected for every line."""
    v = fixed(views.voxels(spark, sf_dir).select("b", "x", "y", "z"))
    corners = [[(F.col(a) + (k >> j & 1) - 16) / (F.col("z") + (k >> 2 & 1) + 10.0) for k in range(8)] for j, a in enumerate("xy")]
    out = v.select("b", "x", "y", "z", *[f(*c).alias(n) for c, names in zip(corners, (("lu", "hu"), ("lv", "hv")), strict=True) for f, n in zip((F.least, F.greatest), names, strict=True)])
    out = out.filter("hu >= -1 and lu <= 1 and hv >= -1 and lv <= 1")
    return out.select("b", "x", "y", "z", *[r(c).alias(c) for c in ("lu", "hu", "lv", "hv")])


@query("SELECT vid, x, -z AS y, y AS z, round(1 - y / 11, 6) AS v FROM v_vertex")
def axis_swap(spark, sf_dir):
    """Axes exchanged and the texture row turned over."""
    return views.vertices(spark, sf_dir).select("vid", "x", (-F.col("z")).alias("y"), F.col("y").alias("z"), F.round(1 - F.col("y") / 11, 6).alias("v"))


@query("SELECT vec_id, round(a * (1 + b) + c, 5) + 0 AS y, CAST(least(ceil(24 * abs(b)), 24) AS INT) AS blocks FROM (SELECT vec_id, CAST(feats[1] AS DOUBLE) AS a, CAST(feats[2] AS DOUBLE) AS b, CAST(feats[3] AS DOUBLE) AS c FROM v_latent)")
def modulate(spark, sf_dir):
    v = views.latents(spark, sf_dir).select("vec_id", *[F.element_at("feats", k).cast("double").alias(n) for k, n in ((1, "a"), (2, "b"), (3, "c"))])
    return v.select("vec_id", r(expr.modulated("a", "b", "c"), 5).alias("y"), F.least(F.ceil(24 * F.abs("b")), F.lit(24)).cast("int").alias("blocks"))


@query("SELECT asset_id, CAST(frame AS BIGINT) AS frame, concat(role, '.png') AS file, round(CAST(frame AS DOUBLE) * 0.1, 6) AS angle, CAST(frame AS DOUBLE) AS m03 FROM v_view")
def views_json(spark, sf_dir):
    """Nested view files: one JSON text an asset, parsed and exploded to frames."""
    matrix = F.array(*[F.array(*[(F.col("frame") if (i, j) == (0, 3) else F.lit(float(i == j))).cast("double") for j in range(4)]) for i in range(4)])
    frame = F.struct(F.col("frame").cast("long").alias("frame"), F.concat("role", F.lit(".png")).alias("file_path"), (F.col("frame") * 0.1).alias("camera_angle_x"), matrix.alias("transform_matrix"))
    texts = views.views_of_assets(spark, sf_dir).groupBy("asset_id").agg(F.to_json(F.struct(F.collect_list(frame).alias("frames"))).alias("json"))
    kind = "frames array<struct<frame: bigint, file_path: string, camera_angle_x: double, transform_matrix: array<array<double>>>>"
    f = texts.select("asset_id", F.inline(F.from_json("json", kind)["frames"]))
    return f.select("asset_id", "frame", F.col("file_path").alias("file"), F.round("camera_angle_x", 6).alias("angle"), F.col("transform_matrix")[0][3].alias("m03"))


@query("SELECT doc_id, CASE WHEN n_chars < 200 THEN 'ValueError: short' END AS error, CASE WHEN n_chars >= 200 THEN n_chars // 100 END AS hundreds FROM documents")
def instance_errors(spark, sf_dir):
    """A row function that fails for some rows: failures are data, not a failed job."""

    def hundreds(row: dict) -> dict:
        if row["n_chars"] < 200:
            raise ValueError("short")
        return {"hundreds": row["n_chars"] // 100}

    return mapping.mapped(views.load(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", hundreds, "hundreds long")


@query()
def fallback_samples(spark, sf_dir):
    """Bad samples replaced by good ones, picked by a hash."""
    d = views.load(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") >= 500).alias("good"))
    return mapping.with_fallback(d, "doc_id", "good")


@query()
def resumed_epoch(spark, sf_dir):
    """What is left of an epoch after its first half."""
    d = views.load(spark, sf_dir, "documents").select("doc_id")
    return mapping.resumed(d, "doc_id", 17, 2, d.count() // 2)


@query()
def volumetric_attributes(spark, sf_dir):
    """A textured mesh as voxels: cells of each triangle, the nearest point of its plane, its texture there, and the mean by
    one less the signed distance to the plane."""
    t = triangles(spark, sf_dir)
    both = geometry.triangle_voxels(t, 4).join(t, "fid")
    p = [(F.col(a) + 0.5).alias(f"p{a}") for a in "xyz"]
    at = both.select("*", *p)
    weights = expr.barycentric([f"p{a}" for a in "xyz"], *[[f"{a}{k}" for a in "xyz"] for k in range(3)])
    clamped = [F.least(F.greatest(w, F.lit(0.0)), F.lit(1.0)) for w in weights]
    side = lambda k, a: F.col(f"{a}{k}") - F.col(f"{a}0")
    n = [side(1, "y") * side(2, "z") - side(1, "z") * side(2, "y"), side(1, "z") * side(2, "x") - side(1, "x") * side(2, "z"), side(1, "x") * side(2, "y") - side(1, "y") * side(2, "x")]
    size = F.nullif(F.sqrt(n[0] * n[0] + n[1] * n[1] + n[2] * n[2]), F.lit(0.0))
    distance = (n[0] * (F.col("px") - F.col("x0")) + n[1] * (F.col("py") - F.col("y0")) + n[2] * (F.col("pz") - F.col("z0"))) / size
    u = (clamped[1] + 2 * clamped[2]) * 5
    at = at.select("x", "y", "z", (1 - distance).alias("w"), expr.wrapped(F.floor(u), 32, "repeat").cast("int").alias("tx"), expr.wrapped(F.floor(u * math.pi), 32, "mirror").cast("int").alias("ty")).filter("w is not null")
    texels = views.voxels(spark, sf_dir).groupBy(F.col("x").alias("tx"), F.col("y").alias("ty")).agg(F.sum("n").alias("texel"))
    hit = at.join(texels, ["tx", "ty"])
    return hit.groupBy("x", "y", "z").agg(F.count("*").alias("n"), F.round(F.sum(F.col("w") * F.col("texel")) / F.sum("w"), 4).alias("value"))
