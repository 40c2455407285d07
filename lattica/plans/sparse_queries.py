"""Sparse tensors, curves and joins in space."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lattica.functions import expr
from lattica.operators import filters, sparse, spatial
from lattica.plans import views
from lattica.plans.catalog import query


def spread_sql(v: str) -> str:
    out = f"(CAST({v} AS BIGINT) & 1023)"
    for shift, mask in expr.SPREAD:
        out = f"(({out} | ({out} << {shift})) & {mask})"
    return out


def gather_sql(v: str) -> str:
    out = f"(({v}) & {0x9249249})"
    for shift, mask in zip((2, 4, 8, 16), (0x30C30C3, 0x300F00F, 0x30000FF, 0x3FF), strict=True):
        out = f"(({out} | ({out} >> {shift})) & {mask})"
    return out


ZCODE = f"({spread_sql('x')} * 4 + {spread_sql('y')} * 2 + {spread_sql('z')})"
DOWN = "b, x // 2 AS x, y // 2 AS y, z // 2 AS z"
CHILD = "(x % 2 + (y % 2) * 2 + (z % 2) * 4)"


def money(c):
    """Exact sum of two-digit amounts."""
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


def rounded(c, digits=4):
    return F.round(c.cast("double"), digits)


@query("SELECT b, x, y, z, CAST(f0 AS DOUBLE) AS f0, f1, n FROM v_voxel")
def sparse_dedupe_voxels(spark, sf_dir):
    return views.voxels(spark, sf_dir).withColumn("f0", F.col("f0").cast("double"))


@query(f"SELECT {DOWN}, round(CAST(sum(f0) AS DOUBLE) / count(*), 4) AS f0, round(CAST(sum(CAST(f1 AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS f1 FROM v_voxel GROUP BY 1,2,3,4")
def sparse_downsample_mean(spark, sf_dir):
    v = views.voxels(spark, sf_dir)
    return sparse.downsampled(v, 2, f0=F.round(F.sum("f0").cast("double") / F.count("*"), 4), f1=F.round(money("f1") / F.count("*"), 6))


@query(f"SELECT {DOWN}, CAST(max(f0) AS DOUBLE) AS f0, max(f1) AS f1 FROM v_voxel GROUP BY 1,2,3,4")
def sparse_downsample_max(spark, sf_dir):
    return sparse.downsampled(views.voxels(spark, sf_dir), 2, f0=F.max("f0").cast("double"), f1=F.max("f1"))


@query(
    f"""SELECT v.b, v.x, v.y, v.z, c.n FROM v_voxel v JOIN (SELECT {DOWN}, CAST(sum(n) AS BIGINT) AS n FROM v_voxel GROUP BY 1,2,3,4) c
    ON v.b = c.b AND v.x // 2 = c.x AND v.y // 2 = c.y AND v.z // 2 = c.z"""
)
def sparse_upsample_nearest(spark, sf_dir):
    """Down by two and up again over the subdivision mask."""
    v = views.voxels(spark, sf_dir)
    coarse = sparse.downsampled(v, 2, n=F.sum("n"), mask=sparse.child_bits())
    return sparse.upsampled(coarse)


@query(f"SELECT {DOWN}, CAST(bit_or(1 << {CHILD}) AS INT) AS mask FROM v_voxel GROUP BY 1,2,3,4")
def subdivision_mask(spark, sf_dir):
    v = views.voxels(spark, sf_dir)
    return sparse.downsampled(v, 2, mask=sparse.child_bits())


@query(f"SELECT {DOWN}, " + ", ".join(f"CAST(coalesce(max(n) FILTER (WHERE {CHILD} = {k}), 0) AS BIGINT) AS c{k}" for k in range(8)) + " FROM v_voxel GROUP BY 1,2,3,4")
def spatial_to_channel(spark, sf_dir):
    return sparse.to_channels(views.voxels(spark, sf_dir), "n")


@query("SELECT b, x, y, z, n FROM v_voxel")
def channel_to_spatial(spark, sf_dir):
    """To channels and back is the table itself."""
    v = views.voxels(spark, sf_dir)
    mask = sparse.downsampled(v, 2, mask=sparse.child_bits())
    return sparse.from_channels(sparse.to_channels(v, "n"), mask, name="n")


@query(
    """SELECT b, count(*) AS t, round(CAST(sum(f0) AS DOUBLE), 4) AS total, round(CAST(sum(f0) AS DOUBLE) / count(*), 4) AS mean,
    round(sqrt(greatest(CAST(sum(f0 * f0) AS DOUBLE) / count(*) - (CAST(sum(f0) AS DOUBLE) / count(*)) ** 2, 0)), 3) AS std, CAST(min(f0) AS DOUBLE) AS least, CAST(max(f0) AS DOUBLE) AS most FROM v_voxel GROUP BY b"""
)
def segment_mean_std(spark, sf_dir):
    """Reductions of each batch; the deviation is that of the population."""
    return views.voxels(spark, sf_dir).groupBy("b").agg(
        F.count("*").alias("t"), rounded(F.sum("f0")).alias("total"), F.round(F.sum("f0").cast("double") / F.count("*"), 4).alias("mean"), F.round(F.stddev_pop(F.col("f0").cast("double")), 3).alias("std"), F.min("f0").cast("double").alias("least"), F.max("f0").cast("double").alias("most")
    )


@query("SELECT s.b, coalesce(t.n, 0) AS n FROM (SELECT CAST(range AS INT) AS b FROM range(6)) s LEFT JOIN (SELECT b, count(*) AS n FROM v_voxel GROUP BY b) t ON s.b = t.b")
def segments_with_empty(spark, sf_dir):
    """Empty batches appear through a spine."""
    spine = spark.range(6).select(F.col("id").cast("int").alias("b"))
    return spine.join(views.voxels(spark, sf_dir).groupBy("b").agg(F.count("*").alias("n")), "b", "left").select("b", F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT b, n, CAST(sum(n) OVER (ORDER BY b) - n AS BIGINT) AS start, CAST(sum(n) OVER (ORDER BY b) AS BIGINT) AS stop FROM (SELECT b, count(*) AS n FROM v_voxel GROUP BY b)")
def layout_offsets(spark, sf_dir):
    return sparse.layout(views.voxels(spark, sf_dir))


@query("SELECT v.b, v.x, v.y, v.z, round(CAST(v.f0 AS DOUBLE) - m.mean, 4) AS centred FROM v_voxel v JOIN (SELECT b, CAST(sum(f0) AS DOUBLE) / count(*) AS mean FROM v_voxel GROUP BY b) m ON v.b = m.b")
def batch_broadcast(spark, sf_dir):
    v = views.voxels(spark, sf_dir)
    mean = v.groupBy("b").agg((F.sum("f0").cast("double") / F.count("*")).alias("mean"))
    return v.join(mean, "b").select("b", "x", "y", "z", F.round(F.col("f0").cast("double") - F.col("mean"), 4).alias("centred"))


@query(
    """SELECT v.b, v.x, v.y, v.z, round((v.f1 - m.mu) / sqrt(m.var + 1e-5), 3) + 0 AS normed FROM v_voxel v JOIN (SELECT b, avg(f1) AS mu, var_pop(f1) AS var FROM v_voxel GROUP BY b) m ON v.b = m.b"""
)
def batch_norm(spark, sf_dir):
    v = views.voxels(spark, sf_dir)
    stats = v.groupBy("b").agg(F.avg("f1").alias("mu"), F.var_pop("f1").alias("var"))
    return v.join(stats, "b").select("b", "x", "y", "z", (F.round((F.col("f1") - F.col("mu")) / F.sqrt(F.col("var") + 1e-5), 3) + F.lit(0.0)).alias("normed"))


@query("SELECT b, x, y, z, n FROM v_voxel UNION ALL SELECT b + 4, x, y, z, -n FROM v_voxel")
def sparse_cat_offset(spark, sf_dir):
    v = views.voxels(spark, sf_dir).select("b", "x", "y", "z", "n")
    return sparse.concatenated([v, v.withColumn("n", -F.col("n"))], [4, 4])


@query("SELECT vec_id, CAST(len(list_concat(feats, list_reverse(feats))) AS INT) AS channels, round(CAST(feats[1] AS DOUBLE), 5) AS first, round(CAST(list_concat(feats, list_reverse(feats))[128] AS DOUBLE), 5) AS last FROM v_latent")
def channel_concat(spark, sf_dir):
    v = views.latents(spark, sf_dir)
    both = v.join(v.select("vec_id", F.reverse("feats").alias("other")), "vec_id").select("vec_id", F.concat("feats", "other").alias("c"))
    return both.select("vec_id", F.size("c").alias("channels"), F.round(F.element_at("c", 1).cast("double"), 5).alias("first"), F.round(F.element_at("c", -1).cast("double"), 5).alias("last"))


@query("SELECT vec_id, CAST(pos AS INT) AS channel, round(CAST(v AS DOUBLE), 6) AS value FROM (SELECT vec_id, unnest(range(64)) AS pos, unnest(feats) AS v FROM v_latent) WHERE pos < 4")
def channel_unbind(spark, sf_dir):
    v = views.latents(spark, sf_dir).select("vec_id", F.posexplode(F.slice("feats", 1, 4)).alias("channel", "value"))
    return v.select("vec_id", "channel", F.round(F.col("value").cast("double"), 6).alias("value"))


@query("SELECT vec_id, CAST(pos AS INT) AS channel, round(CAST(v AS DOUBLE), 6) AS value FROM (SELECT vec_id, unnest(range(64)) AS pos, unnest(feats) AS v FROM v_latent)")
def channel_unbind_all(spark, sf_dir):
    v = views.latents(spark, sf_dir).select("vec_id", F.posexplode("feats").alias("channel", "value"))
    return v.select("vec_id", "channel", F.round(F.col("value").cast("double"), 6).alias("value"))


@query("SELECT i.new AS b, v.x, v.y, v.z, v.n FROM v_voxel v JOIN (VALUES (3, 0), (1, 1), (3, 2)) i(old, new) ON v.b = i.old")
def batch_select_renumber(spark, sf_dir):
    return sparse.selected(views.voxels(spark, sf_dir).select("b", "x", "y", "z", "n"), [3, 1, 3])


@query("SELECT max(b) + 1 AS batches, max(x) + 1 AS sx, max(y) + 1 AS sy, max(z) + 1 AS sz FROM v_voxel")
def spatial_shape(spark, sf_dir):
    return views.voxels(spark, sf_dir).agg(*[(F.max(c) + 1).alias(n) for c, n in (("b", "batches"), ("x", "sx"), ("y", "sy"), ("z", "sz"))])


@query("SELECT DISTINCT b, x // 4 AS x, y // 4 AS y, z // 4 AS z FROM v_voxel")
def maxpool_distinct(spark, sf_dir):
    return views.voxels(spark, sf_dir).select(*sparse.cells(4)).distinct()


@query("SELECT CAST(gx.range AS INT) AS x, CAST(gy.range AS INT) AS y, CAST(gz.range AS INT) AS z, coalesce(v.n, 0) AS n FROM range(32) gx, range(32) gy, range(32) gz LEFT JOIN (SELECT * FROM v_voxel WHERE b = 1) v ON v.x = gx.range AND v.y = gy.range AND v.z = gz.range")
def dense_grid(spark, sf_dir):
    return sparse.densified(views.voxels(spark, sf_dir), 1, 32, "n")


@query("SELECT x, y, z, dense_rank() OVER (ORDER BY x, y, z) - 1 AS inverse, b FROM v_voxel")
def unique_inverse(spark, sf_dir):
    return sparse.unique_inverse(views.voxels(spark, sf_dir).select("b", "x", "y", "z"), ["x", "y", "z"]).select("x", "y", "z", "inverse", "b")


@query(f"SELECT b, x, y, z, {ZCODE} AS code FROM v_voxel")
def zorder_encode(spark, sf_dir):
    return views.voxels(spark, sf_dir).select("b", "x", "y", "z", expr.zorder("x", "y", "z").alias("code"))


@query(f"SELECT code, {gather_sql('code >> 2')} AS x, {gather_sql('code >> 1')} AS y, {gather_sql('code')} AS z FROM (SELECT l_orderkey * 7919 % 1073741824 AS code FROM lineitem)")
def zorder_decode(spark, sf_dir):
    i = views.load(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 7919 % 1073741824).alias("code"))
    x, y, z = expr.zorder_back("code")
    return i.select("code", x.alias("x"), y.alias("y"), z.alias("z"))


@query("SELECT b, x, y, z FROM v_voxel")
def zorder_roundtrip(spark, sf_dir):
    v = views.voxels(spark, sf_dir).select("b", expr.zorder("x", "y", "z", (2, 0, 1)).alias("code"))
    return v.select("b", *[c.cast("int").alias(a) for c, a in zip(expr.zorder_back("code", (2, 0, 1)), "xyz", strict=True)])


@query("SELECT b, x, y, z, ((CAST(b AS BIGINT) * 32 + x) * 32 + y) * 32 + z AS code FROM v_voxel")
def linear_index(spark, sf_dir):
    return views.voxels(spark, sf_dir).select("b", "x", "y", "z", expr.linear([("b", 4), ("x", 32), ("y", 32), ("z", 32)]).alias("code"))


@query("SELECT b, x // 8 AS cx, y // 8 AS cy, z // 8 AS cz, x % 8 AS lx, y % 8 AS ly, z % 8 AS lz, n FROM v_voxel")
def chunk_split(spark, sf_dir):
    v = views.voxels(spark, sf_dir)
    return v.select("b", *[expr.floordiv(a, 8).cast("int").alias(f"c{a}") for a in "xyz"], *[F.pmod(a, F.lit(8)).alias(f"l{a}") for a in "xyz"], "n")


@query("SELECT b, CAST(floor((x - 3) / 8.0) AS INT) AS wx, CAST(floor((y - 3) / 8.0) AS INT) AS wy, CAST(floor((z - 3) / 8.0) AS INT) AS wz, count(*) AS n FROM v_voxel GROUP BY 1,2,3,4")
def window_partition(spark, sf_dir):
    """Sizes of the shifted windows; coordinates below the shift floor downwards."""
    return views.voxels(spark, sf_dir).groupBy("b", *spatial.window_ids(8, -3)).agg(F.count("*").alias("n"))


@query(
    """SELECT b, wx, wy, wz, CAST(sum(n) AS BIGINT) AS keys, round(sum(exp(f / 100.0) * n) / sum(exp(f / 100.0)), 4) AS attended FROM
    (SELECT b, x // 8 AS wx, y // 8 AS wy, z // 8 AS wz, n, CAST(f0 AS DOUBLE) AS f FROM v_voxel) GROUP BY 1,2,3,4"""
)
def windowed_attention(spark, sf_dir):
    """Softmax-weighted mean within each window: keys meet only rows of their window, so it is one aggregation."""
    v = views.voxels(spark, sf_dir).withColumn("w", F.exp(F.col("f0").cast("double") / 100))
    return v.groupBy("b", *spatial.window_ids(8, 0)).agg(F.sum("n").alias("keys"), F.round(F.sum(F.col("w") * F.col("n")) / F.sum("w"), 4).alias("attended"))


@query(
    """WITH e AS (SELECT b, x, y, z, n AS v FROM v_voxel), j AS (SELECT a.b, a.x, a.y, a.z, 'z' AS axis, a.v AS q0, c1.v AS q1, c2.v AS q2, c3.v AS q3 FROM e a
    JOIN e c1 ON c1.b = a.b AND c1.x = a.x AND c1.y = a.y + 1 AND c1.z = a.z JOIN e c2 ON c2.b = a.b AND c2.x = a.x + 1 AND c2.y = a.y + 1 AND c2.z = a.z
    JOIN e c3 ON c3.b = a.b AND c3.x = a.x + 1 AND c3.y = a.y AND c3.z = a.z) SELECT * FROM j"""
)
def neighbour_quads(spark, sf_dir):
    return spatial.quads(views.voxels(spark, sf_dir).select("b", "x", "y", "z", F.col("n").alias("v")), "z", "v")


@query(
    """WITH e AS (SELECT b, x, y, z, n AS v FROM v_voxel), j AS (SELECT a.b, a.v AS q0, c1.v AS q1, c2.v AS q2, c3.v AS q3 FROM e a
    JOIN e c1 ON c1.b = a.b AND c1.x = a.x AND c1.y = a.y AND c1.z = a.z + 1 JOIN e c2 ON c2.b = a.b AND c2.x = a.x AND c2.y = a.y + 1 AND c2.z = a.z + 1
    JOIN e c3 ON c3.b = a.b AND c3.x = a.x AND c3.y = a.y + 1 AND c3.z = a.z) SELECT b, 'x' AS axis, 0 AS t, q0 AS v0, q1 AS v1, q2 AS v2 FROM j UNION ALL SELECT b, 'x', 1, q0, q2, q3 FROM j"""
)
def dual_grid_triangles(spark, sf_dir):
    q = spatial.quads(views.voxels(spark, sf_dir).select("b", "x", "y", "z", F.col("n").alias("v")), "x", "v")
    return spatial.triangles_of(q)


@query(
    """SELECT a, b, count(*) AS n FROM (SELECT least(v0, v1) AS a, greatest(v0, v1) AS b FROM v_face UNION ALL SELECT least(v1, v2), greatest(v1, v2) FROM v_face
    UNION ALL SELECT least(v2, v0), greatest(v2, v0) FROM v_face) GROUP BY a, b"""
)
def edge_counts(spark, sf_dir):
    return spatial.edges(views.faces(spark, sf_dir))


@query(
    """WITH f AS (SELECT * FROM v_face WHERE fid % 400 = 9) SELECT a, b FROM (SELECT least(v0, v1) AS a, greatest(v0, v1) AS b FROM f UNION ALL SELECT least(v1, v2), greatest(v1, v2) FROM f
    UNION ALL SELECT least(v2, v0), greatest(v2, v0) FROM f) GROUP BY a, b HAVING count(*) = 1"""
)
def boundary_edges(spark, sf_dir):
    """The open border of a mesh: the faces of one of its parts, given by their number."""
    return spatial.edges(views.faces(spark, sf_dir).filter("fid % 400 = 9")).filter("n = 1").select("a", "b")


@query(
    """WITH f AS (SELECT * FROM v_face) SELECT a, b FROM (SELECT least(v0, v1) AS a, greatest(v0, v1) AS b FROM f UNION ALL SELECT least(v1, v2), greatest(v1, v2) FROM f
    UNION ALL SELECT least(v2, v0), greatest(v2, v0) FROM f) GROUP BY a, b HAVING count(*) = 1"""
)
def boundary_edges_all(spark, sf_dir):
    """The open border of the whole mesh; none is a right answer."""
    return spatial.edges(views.faces(spark, sf_dir)).filter("n = 1").select("a", "b")


@query(
    """SELECT fid, v0, v1, v2, round(sqrt(((b.y-a.y)*(c.z-a.z)-(b.z-a.z)*(c.y-a.y))**2 + ((b.z-a.z)*(c.x-a.x)-(b.x-a.x)*(c.z-a.z))**2 + ((b.x-a.x)*(c.y-a.y)-(b.y-a.y)*(c.x-a.x))**2) / 2, 5) AS area
    FROM v_face JOIN v_vertex a ON a.vid = v0 JOIN v_vertex b ON b.vid = v1 JOIN v_vertex c ON c.vid = v2"""
)
def face_areas(spark, sf_dir):
    g = spatial.gathered(views.faces(spark, sf_dir), views.vertices(spark, sf_dir))
    d = {f"{a}{k}": F.col(f"{a}{k}") - F.col(f"{a}0") for a in "xyz" for k in (1, 2)}
    cross = [d[f"{p}1"] * d[f"{q}2"] - d[f"{q}1"] * d[f"{p}2"] for p, q in (("y", "z"), ("z", "x"), ("x", "y"))]
    return g.select("fid", "v0", "v1", "v2", F.round(F.sqrt(sum((c * c for c in cross[1:]), cross[0] * cross[0])) / 2, 5).alias("area"))


@query(
    """SELECT min(x) AS lx, min(y) AS ly, min(z) AS lz, max(x) AS hx, max(y) AS hy, max(z) AS hz, round(0.99999 / greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)), 8) AS scale FROM v_vertex"""
)
def mesh_bounds(spark, sf_dir):
    v = views.vertices(spark, sf_dir)
    return v.agg(
        *[F.min(a).alias(f"l{a}") for a in "xyz"], *[F.max(a).alias(f"h{a}") for a in "xyz"], F.round(0.99999 / F.greatest(*[F.max(a) - F.min(a) for a in "xyz"]), 8).alias("scale")
    )


@query(
    """WITH p AS (SELECT l_orderkey * 8 + l_linenumber + l_partkey * 1000000 AS pid, CAST(l_suppkey % 4 AS INT) AS b, l_partkey % 31 + l_discount * 5 AS px, l_orderkey % 31 + l_tax * 5 AS py, l_suppkey % 31 + 0.25 AS pz FROM lineitem WHERE l_linenumber = 1),
    q AS (SELECT DISTINCT pid, b, round(px, 2) AS px, round(py, 2) AS py, pz FROM p),
    c AS (SELECT q.*, k.range AS k, CAST(floor(px) AS INT) + k.range % 2 AS x, CAST(floor(py) AS INT) + k.range // 2 % 2 AS y, CAST(floor(pz) AS INT) + k.range // 4 AS z FROM q, range(8) k),
    w AS (SELECT c.pid, (CASE WHEN k % 2 = 1 THEN px - floor(px) ELSE 1 - (px - floor(px)) END) * (CASE WHEN k // 2 % 2 = 1 THEN py - floor(py) ELSE 1 - (py - floor(py)) END) * (CASE WHEN k // 4 = 1 THEN pz - floor(pz) ELSE 1 - (pz - floor(pz)) END) AS w, v.f1
    FROM c LEFT JOIN v_voxel v ON v.b = c.b AND v.x = c.x AND v.y = c.y AND v.z = c.z)
    SELECT pid, round(coalesce(sum(w) FILTER (WHERE f1 IS NOT NULL), 0), 7) AS weight, round(sum(w * f1) / nullif(sum(w) FILTER (WHERE f1 IS NOT NULL), 0), 6) AS value FROM w GROUP BY pid"""
)
def trilinear_query(spark, sf_dir):
    i = views.load(spark, sf_dir, "lineitem").filter("l_linenumber = 1")
    points = i.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber") + F.col("l_partkey") * 1000000).alias("pid"),
        (F.col("l_suppkey") % 4).cast("int").alias("b"),
        F.round(F.col("l_partkey") % 31 + F.col("l_discount") * 5, 2).alias("px"),
        F.round(F.col("l_orderkey") % 31 + F.col("l_tax") * 5, 2).alias("py"),
        (F.col("l_suppkey") % 31 + 0.25).alias("pz"),
    ).distinct()
    out = spatial.trilinear(points, views.voxels(spark, sf_dir), "f1")
    return out.select("pid", F.round("weight", 7).alias("weight"), F.round("value", 6).alias("value"))


@query(
    """WITH p AS (SELECT l_orderkey * 8 + l_linenumber AS pid, CAST(l_suppkey % 4 AS INT) AS b, l_partkey % 31 + l_discount * 5 AS px, l_orderkey % 31 + l_tax * 5 AS py, l_suppkey % 31 + 0.25 AS pz FROM lineitem),
    q AS (SELECT DISTINCT pid, b, round(px, 2) AS px, round(py, 2) AS py, pz FROM p),
    c AS (SELECT q.*, k.range AS k, CAST(floor(px) AS INT) + k.range % 2 AS x, CAST(floor(py) AS INT) + k.range // 2 % 2 AS y, CAST(floor(pz) AS INT) + k.range // 4 AS z FROM q, range(8) k),
    w AS (SELECT c.pid, (CASE WHEN k % 2 = 1 THEN px - floor(px) ELSE 1 - (px - floor(px)) END) * (CASE WHEN k // 2 % 2 = 1 THEN py - floor(py) ELSE 1 - (py - floor(py)) END) * (CASE WHEN k // 4 = 1 THEN pz - floor(pz) ELSE 1 - (pz - floor(pz)) END) AS w, v.f1
    FROM c LEFT JOIN v_voxel v ON v.b = c.b AND v.x = c.x AND v.y = c.y AND v.z = c.z)
    SELECT pid, round(coalesce(sum(w) FILTER (WHERE f1 IS NOT NULL), 0), 7) AS weight, round(sum(w * f1) / nullif(sum(w) FILTER (WHERE f1 IS NOT NULL), 0), 6) AS value FROM w GROUP BY pid"""
)
def trilinear_query_all(spark, sf_dir):
    i = views.load(spark, sf_dir, "lineitem")
    points = i.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pid"),
        (F.col("l_suppkey") % 4).cast("int").alias("b"),
        F.round(F.col("l_partkey") % 31 + F.col("l_discount") * 5, 2).alias("px"),
        F.round(F.col("l_orderkey") % 31 + F.col("l_tax") * 5, 2).alias("py"),
        (F.col("l_suppkey") % 31 + 0.25).alias("pz"),
    ).repartition("pid").distinct()
    out = spatial.trilinear(points, views.voxels(spark, sf_dir), "f1")
    return out.select("pid", F.round("weight", 7).alias("weight"), F.round("value", 6).alias("value"))


MOVES = [(dx, dy, dz) for dx in (-1, 0, 1) for dy in (-1, 0, 1) for dz in (-1, 0, 1)]


@query(
    """WITH p AS MATERIALIZED (SELECT b, x, y, z, x + dx.range - 1 AS nx, y + dy.range - 1 AS ny, z + dz.range - 1 AS nz, dx.range * 9 + dy.range * 3 + dz.range AS k
    FROM v_voxel, range(3) dx, range(3) dy, range(3) dz) SELECT p.b, p.x, p.y, p.z, count(*) AS near, CAST(sum(c.n * p.k) AS BIGINT) AS conv
    FROM p JOIN v_voxel c ON c.b = p.b AND c.x = p.nx AND c.y = p.ny AND c.z = p.nz GROUP BY 1,2,3,4"""
)
def submanifold_neighbours(spark, sf_dir):
    """A 3x3x3 convolution over the voxels that exist, with the move's number as its weight."""
    v = views.voxels(spark, sf_dir).select("b", "x", "y", "z", "n")
    near = F.col("k") >= 0
    return spatial.around(v, MOVES, ["n"], near=F.count_if(near), conv=F.sum(F.when(near, F.col("n") * F.col("k"))))


@query(
    """WITH e AS (SELECT b, x, y, z, CAST(n % 256 AS INT) AS v FROM v_voxel) SELECT a.b, a.x, a.y, a.z,
    CAST((a.v - coalesce(xyz.v, yz.v, xz.v, xy.v, pz.v, py.v, px.v, 0) + 256) % 256 AS INT) AS delta FROM e a """
    + " ".join(
        f"LEFT JOIN e {name} ON {name}.b = a.b AND {name}.x = a.x - {dx} AND {name}.y = a.y - {dy} AND {name}.z = a.z - {dz}"
        for name, dx, dy, dz in (("px", 1, 0, 0), ("py", 0, 1, 0), ("pz", 0, 0, 1), ("xy", 1, 1, 0), ("xz", 1, 0, 1), ("yz", 0, 1, 1), ("xyz", 1, 1, 1))
    )
)
def neighbour_delta_filter(spark, sf_dir):
    """Each attribute less that of its last existing neighbour in the order x, y, z, xy, xz, yz, xyz, as a byte."""
    v = views.voxels(spark, sf_dir).select("b", "x", "y", "z", F.pmod("n", F.lit(256)).cast("int").alias("v"))
    return filters.neighbour_deltas(v, "v")


@query(
    f"""WITH z AS MATERIALIZED (SELECT b, {ZCODE} AS code, CAST(n % 256 AS INT) AS v FROM v_voxel), l AS (SELECT *, lag(code) OVER (PARTITION BY b ORDER BY code) AS before FROM z),
    k AS (SELECT *, CASE WHEN before IS NULL THEN NULL WHEN xor(code, before) >> 12 > 0 THEN 4 WHEN xor(code, before) >> 9 > 0 THEN 3 WHEN xor(code, before) >> 6 > 0 THEN 2 WHEN xor(code, before) >> 3 > 0 THEN 1 ELSE 0 END AS level FROM l),
    f AS (SELECT b, level, node, arg_min(v, code) AS first FROM (SELECT b, code, v, r.range AS level, code >> (3 * r.range) AS node FROM z, range(5) r) GROUP BY 1, 2, 3)
    SELECT k.b, k.code, CAST((k.v - coalesce(f.first, 0) + 256) % 256 AS INT) AS delta FROM k LEFT JOIN f ON k.b = f.b AND k.level = f.level AND k.before >> (3 * k.level) = f.node"""
)
def sibling_delta_filter(spark, sf_dir):
    """Each leaf's byte less that of the subtree before its own, in the octree of its batch."""
    z = views.voxels(spark, sf_dir).select("b", expr.zorder("x", "y", "z").alias("code"), (F.col("n") % 256).cast("int").alias("v"))
    return filters.sibling_deltas(z, "b", "code", "v", 5)


def chunk_and_code():
    """A voxel's chunk of 8x8x8, numbered through all batches along the curve, and its code there."""
    code = expr.zorder("x", "y", "z")
    return (F.col("b").cast("long") * 64 + F.shiftright(code, 9)).alias("chunk"), code.bitwiseAND(511).alias("code")


def batch_and_code():
    return F.expr("cast(chunk div 64 as int)").alias("b"), F.expr("shiftleft(chunk % 64, 9) + code").alias("code")


@query(f"SELECT b, {ZCODE} AS code, CAST(n * 37 % 256 AS INT) AS value FROM v_voxel")
def sibling_delta_roundtrip(spark, sf_dir):
    """Bytes to deltas and back, in chunks of 8x8x8 voxels."""
    z = views.voxels(spark, sf_dir).select(*chunk_and_code(), (F.col("n") * 37 % 256).cast("int").alias("v"))
    back = filters.sibling_values(filters.sibling_deltas(z, "chunk", "code", "v", 3), "chunk", "code", "delta", 3)
    return back.select(*batch_and_code(), "value")


@query("SELECT b, x, y, z, CAST(n % 256 AS INT) AS value FROM v_voxel")
def neighbour_delta_roundtrip(spark, sf_dir):
    """Bytes to deltas and back, in chunks of 8x8x8 voxels."""
    chunk = expr.linear([("b", 4), *[(expr.floordiv(a, 8), 4) for a in "xyz"]])
    v = views.voxels(spark, sf_dir).select(chunk.alias("b"), *[F.pmod(a, F.lit(8)).cast("int").alias(a) for a in "xyz"], F.pmod("n", F.lit(256)).cast("int").alias("v"))
    back = filters.neighbour_values(filters.neighbour_deltas(v, "v"), "b", "delta")
    b, *at = expr.linear_back("b", [4] * 4)
    return back.select(b.cast("int").alias("b"), *[(c * 8 + F.col(a)).cast("int").alias(a) for a, c in zip("xyz", at, strict=True)], "value")


@query(
    " UNION ALL ".join(
        f"SELECT b, {level} AS level, code >> {3 * (level + 1)} AS node, CAST(bit_or(1 << CAST((code >> {3 * level}) & 7 AS INT)) AS INT) AS mask FROM (SELECT b, {ZCODE} AS code FROM v_voxel) GROUP BY 1, 2, 3" for level in range(5)
    )
)
def svo_level_masks(spark, sf_dir):
    """The octree of each batch: for each inner node which of its eight children exist, one level after the other from the
    masks below."""
    nodes = views.voxels(spark, sf_dir).select("b", expr.zorder("x", "y", "z").alias("code"))
    out = None
    for level in range(5):
        masks = nodes.groupBy("b", F.shiftright("code", 3).alias("node")).agg(F.bit_or(F.expr("shiftleft(1, cast(code & 7 as int))")).alias("mask"))
        part = masks.select("b", F.lit(level).alias("level"), "node", "mask")
        out = part if out is None else out.unionAll(part)
        nodes = masks.select("b", F.col("node").alias("code"))
    return out


@query(
    """WITH f AS (SELECT b, x // 8 AS tx, y // 8 AS ty, x, y, z, n FROM v_voxel) SELECT b, x AS px, y AS py, min(z) AS depth, CAST(arg_min(n, z) AS BIGINT) AS hit FROM f GROUP BY 1, 2, 3"""
)
def tile_first_hit(spark, sf_dir):
    """The front-most voxel of each pixel, seen along z."""
    v = views.voxels(spark, sf_dir)
    out = spatial.first_hits(v.select("b", F.col("x").alias("px"), F.col("y").alias("py"), F.col("z").alias("depth"), F.col("n").alias("hit")), ["b", "px", "py"], "depth", "hit")
    return out.select("b", "px", "py", "depth", "hit")


@query(
    """WITH f AS (SELECT (y // 8) * 4 + x // 8 AS tile, z, b, x, y FROM v_voxel), r AS (SELECT tile, row_number() OVER (ORDER BY tile, z, b, x, y) - 1 AS i FROM f)
    SELECT CAST(tile AS INT) AS tile, min(i) AS start, max(i) + 1 AS stop FROM r GROUP BY tile"""
)
def tile_ranges(spark, sf_dir):
    """Where each tile's fragments lie in the order (tile, depth): counts and an exclusive sum over one row a tile."""
    tiles = views.voxels(spark, sf_dir).select((expr.floordiv("y", 8) * 4 + expr.floordiv("x", 8)).cast("int").alias("b"))
    return sparse.layout(tiles).select(F.col("b").alias("tile"), "start", "stop")


@query(
    """WITH l AS (SELECT b, x, y, z, (n % 5) / 10.0 AS a, f1 AS c FROM v_voxel), t AS (SELECT *, coalesce(exp(sum(ln(1 - a)) OVER (PARTITION BY b, x, y ORDER BY z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 1) AS left_over FROM l)
    SELECT b, x, y, round(sum(left_over * a * c), 6) AS colour, round(sum(left_over * a), 5) AS alpha FROM t GROUP BY 1, 2, 3"""
)
def front_to_back(spark, sf_dir):
    """Layers composited by depth; the window is one pixel."""
    v = views.voxels(spark, sf_dir).select("b", "x", "y", "z", ((F.col("n") % 5) / 10.0).alias("a"), F.col("f1").alias("c"))
    w = Window.partitionBy("b", "x", "y").orderBy("z").rowsBetween(Window.unboundedPreceding, -1)
    t = v.withColumn("w", F.coalesce(F.product(1 - F.col("a")).over(w), F.lit(1.0)) * F.col("a"))
    return t.groupBy("b", "x", "y").agg(F.round(F.sum(F.col("w") * F.col("c")), 6).alias("colour"), F.round(F.sum("w"), 5).alias("alpha"))


@query(
    """WITH box AS (SELECT c_custkey AS id, CAST(c_custkey % 4 AS INT) AS b, CAST(c_custkey % 29 AS INT) AS lx, CAST(c_nationkey AS INT) AS ly, CAST(c_custkey * 3 % 29 AS INT) AS lz FROM customer)
    SELECT id, count(*) AS hits, CAST(sum(v.n) AS BIGINT) AS n FROM box JOIN v_voxel v ON v.b = box.b AND v.x BETWEEN lx AND lx + 2 AND v.y BETWEEN ly AND ly + 2 AND v.z BETWEEN lz AND lz + 2 GROUP BY id"""
)
def box_overlap(spark, sf_dir):
    c = views.load(spark, sf_dir, "customer")
    low = {"x": F.col("c_custkey") % 29, "y": F.col("c_nationkey"), "z": F.col("c_custkey") * 3 % 29}
    boxes = c.select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 4).cast("int").alias("b"), *[e.cast("int").alias(f"lo_{a}") for a, e in low.items()], *[(e + 2).cast("int").alias(f"hi_{a}") for a, e in low.items()])
    return spatial.overlapping(boxes, views.voxels(spark, sf_dir)).groupBy("id").agg(F.count("*").alias("hits"), F.sum("n").alias("n"))


@query(
    """SELECT r.range AS resolution, count(DISTINCT (b, x * 512 // (512 // r.range * 16), y * 512 // (512 // r.range * 16), z * 512 // (512 // r.range * 16))) AS tokens FROM v_voxel, (SELECT unnest([1, 2, 4]) AS range) r GROUP BY 1"""
)
def resolution_tokens(spark, sf_dir):
    """Distinct cells at each candidate resolution, all from one pass; the largest within a budget is then the first."""
    v = views.voxels(spark, sf_dir).withColumn("resolution", F.explode(F.array(*[F.lit(k).cast("int") for k in (1, 2, 4)])))
    cell = [F.expr("({0} * 512) div ((512 div resolution) * 16)".format(a)).alias(f"c{a}") for a in "xyz"]
    return v.select("resolution", "b", *cell).distinct().groupBy("resolution").agg(F.count("*").alias("tokens"))


@query("SELECT b, ux, uy, uz, CAST(sum(q00) AS BIGINT) AS q00, CAST(sum(q01) AS BIGINT) AS q01, CAST(sum(q11) AS BIGINT) AS q11, round(CAST(sum(CAST(f1 AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS mean, bool_or(n > 2) AS crossed FROM (SELECT b, x // 4 AS ux, y // 4 AS uy, z // 4 AS uz, x * x AS q00, x * y AS q01, y * y AS q11, f1, n FROM v_voxel) GROUP BY 1,2,3,4")
def qef_accumulate(spark, sf_dir):
    """Sums of a quadric's entries, mean position and crossings per cell."""
    v = views.voxels(spark, sf_dir)
    keys = [expr.floordiv(a, 4).cast("int").alias(f"u{a}") for a in "xyz"]
    return v.groupBy("b", *keys).agg(
        F.sum(F.col("x") * F.col("x")).alias("q00"), F.sum(F.col("x") * F.col("y")).alias("q01"), F.sum(F.col("y") * F.col("y")).alias("q11"), F.round(money("f1") / F.count("*"), 6).alias("mean"), F.bool_or(F.col("n") > 2).alias("crossed")
    )


@query("SELECT b, x // 2 AS x, y // 2 AS y, z // 2 AS z, round(CAST(sum(CAST(f1 AS DECIMAL(18,2)) * n) AS DOUBLE) / sum(n), 6) AS value, CAST(sum(n) AS BIGINT) AS weight FROM v_voxel GROUP BY 1,2,3,4")
def weighted_voxel_mean(spark, sf_dir):
    return sparse.downsampled(views.voxels(spark, sf_dir), 2, value=F.round(F.sum(F.col("f1").cast("decimal(18,2)") * F.col("n")).cast("double") / F.sum("n"), 6), weight=F.sum("n"))


@query(
    """WITH l0 AS (SELECT x, y, CAST(sum(n) AS BIGINT) AS v FROM v_voxel GROUP BY 1, 2), l1 AS (SELECT x // 2 AS x, y // 2 AS y, CAST(sum(v) // 4 AS BIGINT) AS v FROM l0 GROUP BY 1, 2),
    l2 AS (SELECT x // 2 AS x, y // 2 AS y, CAST(sum(v) // 4 AS BIGINT) AS v FROM l1 GROUP BY 1, 2) SELECT 0 AS level, x, y, v FROM l0 UNION ALL SELECT 1, x, y, v FROM l1 UNION ALL SELECT 2, x, y, v FROM l2"""
)
def mipmap_pyramid(spark, sf_dir):
    """2x2 means, truncated, level by level (texels that don't exist count as zero)."""
    level = views.voxels(spark, sf_dir).groupBy("x", "y").agg(F.sum("n").alias("v"))
    out = level.select(F.lit(0).alias("level"), "x", "y", "v")
    for k in (1, 2):
        level = level.groupBy(*[expr.floordiv(a, 2).cast("int").alias(a) for a in "xy"]).agg(F.expr("sum(v) div 4").alias("v"))
        out = out.unionAll(level.select(F.lit(k).alias("level"), "x", "y", "v"))
    return out
