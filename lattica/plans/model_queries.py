"""Dual grids to meshes, attention, textures, and channel arithmetic over whole latents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lattica.functions import expr
from lattica.operators import attention, geometry, registry, sparse, spatial, textures
from lattica.plans import views
from lattica.plans.catalog import query
from lattica.plans.geometry_queries import triangles


def r(c, digits=6):
    return F.round(c, digits) + F.lit(0.0)


VID = "((CAST(b AS BIGINT) * 32 + x) * 32 + y) * 32 + z"
GRID_SQL = f"""g AS MATERIALIZED (SELECT b, x, y, z, {VID} AS vid, x + (n % 5) / 5.0::DOUBLE AS vx, y + (x + y) % 4 / 4.0::DOUBLE AS vy, z + (y + z) % 3 / 4.0::DOUBLE AS vz, (x + n) % 2 = 0 AS ix, (y + n) % 2 = 0 AS iy, (z + n) % 3 = 0 AS iz, 1 + n % 3 AS w FROM v_voxel)"""


def dual_grid(spark, sf_dir):
    v = views.voxels(spark, sf_dir)
    return v.select(
        "b", "x", "y", "z", F.expr("((cast(b as bigint) * 32 + x) * 32 + y) * 32 + z").alias("vid"),
        (F.col("x") + F.col("n") % 5 / 5.0).alias("vx"), (F.col("y") + (F.col("x") + F.col("y")) % 4 / 4.0).alias("vy"), (F.col("z") + (F.col("y") + F.col("z")) % 3 / 4.0).alias("vz"),
        ((F.col("x") + F.col("n")) % 2 == 0).alias("ix"), ((F.col("y") + F.col("n")) % 2 == 0).alias("iy"), ((F.col("z") + F.col("n")) % 3 == 0).alias("iz"), (1 + F.col("n") % 3).alias("w"),
    )


def quads_sql() -> str:
    """Each axis' quads by three joins."""
    parts = []
    for axis, moves in (("x", ((0, 0, 1), (0, 1, 1), (0, 1, 0))), ("y", ((1, 0, 0), (1, 0, 1), (0, 0, 1))), ("z", ((0, 1, 0), (1, 1, 0), (1, 0, 0)))):
        joins = " ".join(f"JOIN g q{k} ON q{k}.b = q0.b AND q{k}.x = q0.x + {dx} AND q{k}.y = q0.y + {dy} AND q{k}.z = q0.z + {dz}" for k, (dx, dy, dz) in enumerate(moves, 1))
        fields = ", ".join(f"q{k}.{c} AS {c}{k}" for k in range(4) for c in ("vid", "vx", "vy", "vz", "w"))
        parts.append(f"SELECT q0.b, '{axis}' AS axis, q0.x, q0.y, q0.z, {fields} FROM g q0 {joins} WHERE q0.i{axis}")
    return " UNION ALL ".join(parts)


def normal_sql(i: int, j: int, k: int) -> list[str]:
    d = lambda m, a: f"(v{a}{m} - v{a}{i})"
    return [f"({d(j, p)} * {d(k, q)} - {d(j, q)} * {d(k, p)})" for p, q in (("y", "z"), ("z", "x"), ("x", "y"))]


def bend_sql(*c: int) -> str:
    n, m = normal_sql(*c[:3]), normal_sql(*c[3:])
    dot = lambda u, v: f"({u[0]} * {v[0]} + {u[1]} * {v[1]} + {u[2]} * {v[2]})"
    return f"round(coalesce({dot(n, m)} / nullif(sqrt({dot(n, n)} * {dot(m, m)}), 0), 0), 9)"


def mesh_sql(first: str) -> str:
    cut = lambda t, c, when: f"SELECT b, axis, x, y, z, {t} AS t, vid{c[0]} AS v0, vid{c[1]} AS v1, vid{c[2]} AS v2 FROM s WHERE {when}"
    cuts = [cut(0, (0, 1, 2), "f"), cut(1, (0, 2, 3), "f"), cut(0, (0, 1, 3), "NOT f"), cut(1, (1, 2, 3), "NOT f")]
    return f"WITH {GRID_SQL}, q AS ({quads_sql()}), s AS (SELECT *, {first} AS f FROM q) {' UNION ALL '.join(cuts)}"


@query(mesh_sql(f"{bend_sql(0, 1, 2, 0, 2, 3)} >= {bend_sql(0, 1, 3, 1, 2, 3)}"))
def dual_grid_mesh(spark, sf_dir):
    """The mesh of a dual grid: crossed edges on three axes, quads split where they are less bent."""
    return spatial.dual_mesh(dual_grid(spark, sf_dir))


@query(mesh_sql("w0 * w2 > w1 * w3"))
def dual_grid_mesh_weighted(spark, sf_dir):
    """The same, with quads split by the corners' weights."""
    return spatial.dual_mesh(dual_grid(spark, sf_dir), "w")


@query(
    """SELECT p_size, round(sum(nx * nx), 4) AS axx, round(sum(nx * ny), 4) AS axy, round(sum(nx * nz), 4) AS axz, round(sum(ny * ny), 4) AS ayy, round(sum(ny * nz), 4) AS ayz, round(sum(nz * nz), 4) AS azz,
    round(sum(-nx * d), 3) + 0 AS bx, round(sum(-ny * d), 3) + 0 AS by, round(sum(-nz * d), 3) + 0 AS bz, round(sum(d * d), 3) AS c, count(*) AS n
    FROM (SELECT p_size, p_partkey % 7 / 7.0::DOUBLE AS nx, p_partkey % 5 / 5.0::DOUBLE AS ny, p_partkey % 3 / 4.0::DOUBLE AS nz, p_partkey % 11 - 5.5::DOUBLE AS d FROM part) GROUP BY p_size"""
)
def quadric_entries(spark, sf_dir):
    """All ten entries of the summed quadrics of each cell."""
    p = views.load(spark, sf_dir, "part").select("p_size", *[(F.col("p_partkey") % m / d).alias(a) for a, m, d in (("nx", 7, 7.0), ("ny", 5, 5.0), ("nz", 3, 4.0))], (F.col("p_partkey") % 11 - 5.5).alias("d"))
    q = geometry.quadrics(p.withColumns({f"p{a}": F.lit(0.0) for a in "xyz"}), ["p_size"])
    return q.select("p_size", *[F.round(f"a{i}", 4).alias(f"a{i}") for i in ("xx", "xy", "xz", "yy", "yz", "zz")], *[r(f"b{a}", 3).alias(f"b{a}") for a in "xyz"], F.round("c", 3).alias("c"), "n")


@query(
    """WITH v AS (SELECT p_partkey % 6 AS mesh, p_partkey, CAST(p_size AS DOUBLE) AS x, CAST(p_partkey % 17 AS DOUBLE) AS y, CAST(p_partkey % 23 AS DOUBLE) AS z FROM part),
    b AS (SELECT (min(x) + max(x)) / 2 AS cx, (min(y) + max(y)) / 2 AS cy, (min(z) + max(z)) / 2 AS cz, 0.99999 / greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)) AS s FROM v)
    SELECT mesh, p_partkey, vid, min(vid) OVER (PARTITION BY mesh) AS start, round((x - cx) * s, 6) + 0 AS x, round((y - cy) * s, 6) + 0 AS y, round((z - cz) * s, 6) + 0 AS z
    FROM (SELECT *, row_number() OVER (ORDER BY mesh, p_partkey) - 1 AS vid FROM v), b"""
)
def mesh_concat(spark, sf_dir):
    """Meshes put behind each other, their vertices numbered through and scaled to the unit cube."""
    p = views.load(spark, sf_dir, "part")
    v = p.select((F.col("p_partkey") % 6).alias("mesh"), "p_partkey", F.col("p_size").cast("double").alias("x"), *[(F.col("p_partkey") % m).cast("double").alias(a) for a, m in (("y", 17), ("z", 23))])
    out = geometry.normalised(geometry.concatenated(v, "mesh", "p_partkey"))
    return out.select("mesh", "p_partkey", "vid", "start", *[r(a).alias(a) for a in "xyz"])


ATTENTION_SQL = """s AS (SELECT q.{row}, {groups}, list_dot_product(q.q, k.k) / sqrt(len(q.q)) AS s, k.v AS v FROM f q JOIN f k ON {on}),
    m AS (SELECT *, max(s) OVER (PARTITION BY {row}) AS m FROM s), e AS (SELECT {row}, {names}, exp(s - m) AS w, v FROM m)
    SELECT {row}, {names}, round(sum(w * v[1]) / sum(w), 5) + 0 AS o0, round(sum(w * v[2]) / sum(w), 5) + 0 AS o1 FROM e GROUP BY ALL"""


@query("WITH f AS (SELECT vec_id, b, CAST(feats[1:32] AS DOUBLE[]) AS q, CAST(feats[33:64] AS DOUBLE[]) AS k, CAST(feats[1:2] AS DOUBLE[]) AS v FROM v_latent), " + ATTENTION_SQL.format(row="vec_id", groups="q.b", names="b", on="q.b = k.b"))
def batch_attention(spark, sf_dir):
    """Attention of every row to all rows of its batch, in tiles of queries and keys."""
    v = views.latents(spark, sf_dir)
    rows = v.select("vec_id", "b", F.slice("feats", 1, 32).alias("q"), F.slice("feats", 33, 32).alias("k"), F.slice("feats", 1, 2).alias("v"))
    out = attention.attended(rows, ["b"], "vec_id", "q", "k", "v")
    return out.select("vec_id", "b", *[r(F.col("out")[k], 5).alias(f"o{k}") for k in range(2)])


@query(f"WITH f AS (SELECT {VID} AS vid, b, x // 4 AS wx, y // 4 AS wy, z // 4 AS wz, [x / 32.0::DOUBLE, n / 4.0::DOUBLE] AS q, [y / 16.0::DOUBLE, 1.0::DOUBLE] AS k, [CAST(n AS DOUBLE), CAST(z AS DOUBLE)] AS v FROM v_voxel), " + ATTENTION_SQL.format(row="vid", groups="q.b, q.wx, q.wy, q.wz", names="b, wx, wy, wz", on="q.b = k.b AND q.wx = k.wx AND q.wy = k.wy AND q.wz = k.wz"))
def window_attention(spark, sf_dir):
    """Attention with scores within each spatial window."""
    v = views.voxels(spark, sf_dir)
    num = lambda c, d=1.0: F.col(c) / d
    rows = v.select(
        F.expr("((cast(b as bigint) * 32 + x) * 32 + y) * 32 + z").alias("vid"), "b", *[F.floor(F.col(a) / 4).cast("int").alias(f"w{a}") for a in "xyz"],
        F.array(num("x", 32.0), num("n", 4.0)).alias("q"), F.array(num("y", 16.0), F.lit(1.0)).alias("k"), F.array(num("n"), num("z")).alias("v"),
    )
    out = attention.attended(rows, ["b", "wx", "wy", "wz"], "vid", "q", "k", "v")
    return out.select("vid", "b", "wx", "wy", "wz", *[r(F.col("out")[k], 5).alias(f"o{k}") for k in range(2)])


@query("SELECT b, x, y, z, coalesce(v.n, 0) AS n, v.n IS NOT NULL AS mask FROM (SELECT b, CAST(c.range // 1024 AS INT) AS x, CAST(c.range // 32 % 32 AS INT) AS y, CAST(c.range % 32 AS INT) AS z FROM (SELECT DISTINCT b FROM v_voxel), range(32768) c) LEFT JOIN v_voxel v USING (b, x, y, z)")
def dense_grids(spark, sf_dir):
    """All batches as dense grids with their masks."""
    return sparse.densified_all(views.voxels(spark, sf_dir), 32, "n")


@query(
    """WITH c AS (SELECT DISTINCT b, h AS resolution, CAST(floor((x + 0.5) / 32 * (h // 16)) AS INT) AS x, CAST(floor((y + 0.5) / 32 * (h // 16)) AS INT) AS y, CAST(floor((z + 0.5) / 32 * (h // 16)) AS INT) AS z
    FROM v_voxel, (SELECT CAST(unnest([256, 192, 128, 64]) AS INT) AS h)), n AS (SELECT b, resolution, count(*) AS tokens FROM c GROUP BY 1, 2)
    SELECT b, max(resolution) AS resolution, arg_max(tokens, resolution) AS tokens FROM n WHERE tokens < 400 OR resolution = 64 GROUP BY b"""
)
def token_budget(spark, sf_dir):
    """The highest resolution at which a batch's tokens stay below a budget."""
    return sparse.within_budget(views.voxels(spark, sf_dir), 32, [256, 192, 128, 64], 400)


@query("SELECT b, x, y, z, [CAST(f0 AS DOUBLE), f1, CAST(n AS DOUBLE)] AS channels, {'f': [CAST(f0 AS DOUBLE), f1], 'n': n}.n AS n FROM v_voxel")
def interleaved(spark, sf_dir):
    """Attributes side by side in one array, and as a struct of arrays, from which one is read back."""
    v = views.voxels(spark, sf_dir)
    parts = [F.col(c).cast("double") for c in ("f0", "f1", "n")]
    return v.select("b", "x", "y", "z", F.array(*parts).alias("channels"), F.struct(F.array(*parts[:2]).alias("f"), F.col("n").alias("n"))["n"].alias("n"))


@query("SELECT c.vec_id, c.pos, round((c.v - s.m) / sqrt(s.s + 1e-5), 4) + 0 AS value FROM v_channel c JOIN (SELECT b, pos // 8 AS g, avg(v) AS m, var_pop(v) AS s FROM v_channel GROUP BY 1, 2) s ON s.b = c.b AND s.g = c.pos // 8")
def group_norm(spark, sf_dir):
    """Each batch's groups of eight channels, less their mean and over their deviation."""
    c = views.channels(spark, sf_dir).withColumn("g", F.expr("pos div 8"))
    stats = c.groupBy("b", "g").agg(F.avg("v").alias("m"), F.var_pop("v").alias("s"))
    return c.join(stats, ["b", "g"]).select("vec_id", "pos", r((F.col("v") - F.col("m")) / F.sqrt(F.col("s") + 1e-5), 4).alias("value"))


@query("SELECT vec_id, pos, round(greatest(v, 0), 6) + 0 AS relu, round(v / (1 + exp(-v)), 6) + 0 AS silu, round(v / 2 * (1 + tanh(sqrt(2 / pi()) * (v + 0.044715 * v * v * v))), 6) + 0 AS gelu FROM v_channel")
def activations(spark, sf_dir):
    c = views.channels(spark, sf_dir)
    return c.select("vec_id", "pos", *[r(f("v")).alias(n) for n, f in (("relu", expr.relu), ("silu", expr.silu), ("gelu", expr.gelu))])


@query(
    """WITH x AS (SELECT vec_id, pos, v AS x0, w AS n, (vec_id % 10) / 10.0::DOUBLE AS t FROM v_channel), y AS (SELECT *, (1 - t) * x0 + (1e-5::DOUBLE + (1 - 1e-5::DOUBLE) * t) * n AS xt, (1 - 1e-5::DOUBLE) * n - x0 AS v FROM x)
    SELECT vec_id, pos, round(xt, 5) + 0 AS xt, round((1 - 1e-5::DOUBLE) * xt - (1e-5::DOUBLE + (1 - 1e-5::DOUBLE) * t) * v, 5) + 0 AS x0, round(xt + (1 - t) * v, 5) + 0 AS noise, round((xt - (1e-5::DOUBLE + (1 - 1e-5::DOUBLE) * t) * n) / (1 - t), 4) + 0 AS back FROM y"""
)
def flow_channels(spark, sf_dir):
    """Diffused values of all channels, and sample and noise found back from velocity and from noise."""
    c = views.channels(spark, sf_dir).withColumn("t", (F.col("vec_id") % 10) / 10.0)
    c = c.withColumns({"xt": expr.diffused("v", "w", "t"), "s": expr.velocity("v", "w")})
    return c.select("vec_id", "pos", r("xt", 5).alias("xt"), r(expr.x0_from_velocity("xt", "s", "t"), 5).alias("x0"), r(expr.velocity_to_noise("xt", "s", "t"), 5).alias("noise"), r(expr.x0_from_noise("xt", "w", "t"), 4).alias("back"))


@query(
    """WITH x AS (SELECT vec_id, pos, (v + w) / 2 AS xt, v AS p, w AS n, (vec_id % 9) / 10.0::DOUBLE + 0.05 AS t FROM v_channel),
    y AS (SELECT *, 1e-5::DOUBLE + (1 - 1e-5::DOUBLE) * t AS k, 3 * p - 2 * n AS g FROM x), z AS (SELECT *, (1 - 1e-5::DOUBLE) * xt - k * p AS a, (1 - 1e-5::DOUBLE) * xt - k * g AS b FROM y),
    s AS (SELECT *, 0.7 * stddev_samp(a) OVER w / stddev_samp(b) OVER w + 0.3 AS gain FROM z WINDOW w AS (PARTITION BY vec_id)) SELECT vec_id, pos, round(((1 - 1e-5::DOUBLE) * xt - b * gain) / k, 4) + 0 AS guided FROM s"""
)
def guided_rescaled(spark, sf_dir):
    """Guidance with the sample's spread drawn back to that of the conditional one; a row is one array, so nothing is shuffled."""
    v = views.latents(spark, sf_dir).select("vec_id", F.col("feats").cast("array<double>").alias("p"), F.reverse("feats").cast("array<double>").alias("n"), ((F.col("vec_id") % 9) / 10.0 + 0.05).alias("t"))
    v = v.withColumn("xt", F.zip_with("p", "n", lambda a, b: (a + b) / 2))
    return v.select("vec_id", F.posexplode(expr.rescaled_guidance("xt", "p", "n", F.col("t"), 3.0, 0.7)).alias("pos", "g")).select("vec_id", "pos", r("g", 4).alias("guided"))


def uniform_sql(seed: int) -> str:
    return f"CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':{seed}'), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496"


@query(f"SELECT doc_id, round(u, 9) AS uniform, round(1 / (1 + exp(-(0.5 + 1.2 * sqrt(-2 * ln(1 - u)) * cos(2 * pi() * v)))), 6) AS logit_normal, CASE WHEN w >= 0.1 THEN lang END AS condition FROM (SELECT doc_id, lang, {uniform_sql(5)} AS u, {uniform_sql(6)} AS v, {uniform_sql(7)} AS w FROM documents)")
def random_times(spark, sf_dir):
    """Times and dropped conditions of training samples, each from its id and a seed alone."""
    d = views.load(spark, sf_dir, "documents")
    return d.select("doc_id", F.round(expr.uniform("doc_id", 5), 9).alias("uniform"), F.round(expr.logit_normal("doc_id", 5, 0.5, 1.2), 6).alias("logit_normal"), F.when(expr.uniform("doc_id", 7) >= 0.1, F.col("lang")).alias("condition"))


@query("SELECT vec_id, pos, (pos // 16 // 2) * 4 + (pos // 4 % 4 // 2) * 2 + pos % 4 // 2 AS cell, (pos // 16 % 2) * 4 + (pos // 4 % 4 % 2) * 2 + pos % 4 % 2 AS channel, pos AS back FROM v_channel")
def patches(spark, sf_dir):
    """A 4x4x4 volume as patches of 2x2x2, and the way back."""
    c = views.channels(spark, sf_dir)
    cell, channel = expr.patched(F.col("pos").cast("long"), 4, 2)
    return c.select("vec_id", "pos", cell.cast("int").alias("cell"), channel.cast("int").alias("channel")).withColumn("back", expr.unpatched(F.col("cell").cast("long"), F.col("channel").cast("long"), 4, 2).cast("int"))


@query("SELECT p_partkey, least(greatest(l // 16, 0), 4) AS low, least(greatest((h + 15) // 16, 0), 4) AS high FROM (SELECT p_partkey, p_size * 3 - 40 AS l, p_size * 3 - 40 + p_partkey % 50 AS h FROM part) WHERE l >= 0 UNION ALL SELECT p_partkey, 0, least(greatest(trunc((h + 15) / 16)::INT, 0), 4) FROM (SELECT p_partkey, p_size * 3 - 40 AS l, p_size * 3 - 40 + p_partkey % 50 AS h FROM part) WHERE l < 0")
def tile_rects(spark, sf_dir):
    """Tiles that a pixel range covers."""
    p = views.load(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 3 - 40).alias("l"), (F.col("p_size") * 3 - 40 + F.col("p_partkey") % 50).alias("h"))
    low, high = expr.tile_rect("l", "h", 16, 4)
    return p.select("p_partkey", low.alias("low"), high.alias("high"))


POINT_SQL = "p AS (SELECT p_partkey, p_partkey % 37 / 20.0::DOUBLE - 0.4 AS u, p_partkey % 29 / 15.0::DOUBLE - 0.3 AS v, p_size / 40.0::DOUBLE AS len FROM part)"
TEXTURE_SQL = """t0 AS (SELECT 0 AS level, CAST(a.range AS INT) AS ty, CAST(c.range AS INT) AS tx, CAST((a.range * 7 + c.range * 3) % 11 AS DOUBLE) AS value FROM range(16) a, range(16) c),
    t1 AS (SELECT 1 AS level, ty // 2 AS ty, tx // 2 AS tx, sum(value) / 4 AS value FROM t0 GROUP BY 2, 3), t2 AS (SELECT 2 AS level, ty // 2 AS ty, tx // 2 AS tx, sum(value) / 4 AS value FROM t1 GROUP BY 2, 3),
    t3 AS (SELECT 3 AS level, ty // 2 AS ty, tx // 2 AS tx, sum(value) / 4 AS value FROM t2 GROUP BY 2, 3), t4 AS (SELECT 4 AS level, ty // 2 AS ty, tx // 2 AS tx, sum(value) / 4 AS value FROM t3 GROUP BY 2, 3),
    t AS (SELECT * FROM t0 UNION ALL SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3 UNION ALL SELECT * FROM t4)"""


def texture(spark):
    cells = spark.range(256)
    return cells.select(F.expr("cast(id div 16 as int)").alias("ty"), F.expr("cast(id % 16 as int)").alias("tx"), F.expr("cast((id div 16 * 7 + id % 16 * 3) % 11 as double)").alias("value"))


def points(spark, sf_dir):
    p = views.load(spark, sf_dir, "part")
    return p.select("p_partkey", (F.col("p_partkey") % 37 / 20.0 - 0.4).alias("u"), (F.col("p_partkey") % 29 / 15.0 - 0.3).alias("v"), (F.col("p_size") / 40.0).alias("len"))


@query(
    f"""WITH {POINT_SQL}, {TEXTURE_SQL}, l AS (SELECT *, least(greatest(log2(len * 16), 0), 4) AS l FROM p), m AS (SELECT p_partkey, u, v, CAST(floor(l) AS INT) AS level, 1 - (l - floor(l)) AS s FROM l UNION ALL SELECT p_partkey, u, v, least(CAST(floor(l) AS INT) + 1, 4), l - floor(l) FROM l),
    x AS (SELECT p_partkey, level, s, 16 >> level AS n, u * (16 >> level) - 0.5 AS x, (1 - v) * (16 >> level) - 0.5 AS y FROM m WHERE s > 0),
    k AS (SELECT p_partkey, level, s * (CASE WHEN k.range % 2 = 1 THEN x - floor(x) ELSE 1 - (x - floor(x)) END) * (CASE WHEN k.range // 2 = 1 THEN y - floor(y) ELSE 1 - (y - floor(y)) END) AS w,
    ((CAST(floor(x) AS INT) + CAST(k.range AS INT) % 2) % n + n) % n AS tx, ((CAST(floor(y) AS INT) + CAST(k.range AS INT) // 2) % n + n) % n AS ty FROM x, range(4) k)
    SELECT p_partkey, round(sum(w * value), 6) AS value FROM k JOIN t USING (level, ty, tx) GROUP BY 1"""
)
def mip_samples(spark, sf_dir):
    """A texture sampled between the two levels of its mip chain that a point's footprint asks for."""
    levels = textures.mipmaps(texture(spark), 16)
    out = textures.sampled(points(spark, sf_dir), "p_partkey", F.broadcast(levels), 16)
    return out.select("p_partkey", F.round("value", 6).alias("value"))


@query(f"WITH {POINT_SQL}, {TEXTURE_SQL}, i AS (SELECT p_partkey, least(greatest(CAST(floor(u * 16) AS INT), 0), 15) AS tx, least(greatest(CAST(floor((1 - v) * 16) AS INT), 0), 15) AS ty FROM p) SELECT p_partkey, value FROM i JOIN t0 USING (ty, tx)")
def nearest_samples(spark, sf_dir):
    """The nearest texel, held at the border."""
    return textures.sampled(points(spark, sf_dir), "p_partkey", F.broadcast(textures.mipmaps(texture(spark), 16)), 16, "clamp", linear=False)


@query(
    """WITH u AS (SELECT vid, x, y, z, vid * 3 % 7 / 7.0::DOUBLE AS u, vid * 5 % 9 / 9.0::DOUBLE AS v FROM v_vertex), f AS (SELECT DISTINCT v0, v1, v2 FROM v_face),
    e AS (SELECT v0, v1, v2, b.x - a.x AS ex, b.y - a.y AS ey, b.z - a.z AS ez, c.x - a.x AS fx, c.y - a.y AS fy, c.z - a.z AS fz, b.u - a.u AS du1, b.v - a.v AS dv1, c.u - a.u AS du2, c.v - a.v AS dv2 FROM f JOIN u a ON a.vid = v0 JOIN u b ON b.vid = v1 JOIN u c ON c.vid = v2),
    t AS (SELECT *, du1 * dv2 - dv1 * du2 AS det, dv2 * ex - dv1 * fx AS tx, dv2 * ey - dv1 * fy AS ty, dv2 * ez - dv1 * fz AS tz, du1 * fx - du2 * ex AS bx, du1 * fy - du2 * ey AS bty, du1 * fz - du2 * ez AS bz FROM e),
    n AS (SELECT *, sqrt(tx * tx + ty * ty + tz * tz) AS tn, sqrt(bx * bx + bty * bty + bz * bz) AS bn FROM t)
    SELECT v0, v1, v2, CASE WHEN abs(det) < 1e-6 THEN 1.0 ELSE round(tx / nullif(tn, 0), 6) + 0 END AS tx, CASE WHEN abs(det) < 1e-6 THEN 1.0 ELSE round(bty / nullif(bn, 0), 6) + 0 END AS bt,
    CASE WHEN abs(det) < 1e-6 THEN 1e6::DOUBLE ELSE round(tn / det, 4) + 0 END AS mt, CASE WHEN abs(det) < 1e-6 THEN 1e6::DOUBLE ELSE round(bn / det, 4) + 0 END AS mb FROM n"""
)
def tangent_frames(spark, sf_dir):
    """Tangents of textured triangles, and the length of the texture's unit along them."""
    v = views.vertices(spark, sf_dir).withColumns({"u": F.col("vid") * 3 % 7 / 7.0, "w": F.col("vid") * 5 % 9 / 9.0})
    f = views.faces(spark, sf_dir).select("v0", "v1", "v2").distinct()
    for k in range(3):
        f = f.join(v.select(F.col("vid").alias(f"v{k}"), *[F.col(c).alias(f"{c}{k}") for c in ("x", "y", "z", "u", "w")]), f"v{k}")
    t, b, lengths = textures.tangent_frame([[f"{a}{k}" for a in "xyz"] for k in range(3)], [[f"u{k}", f"w{k}"] for k in range(3)])
    return f.select("v0", "v1", "v2", r(t[0]).alias("tx"), r(b[1]).alias("bt"), r(lengths[0], 4).alias("mt"), r(lengths[1], 4).alias("mb"))


@query("SELECT vec_id, pos, abs(v - w) <= 0.05 + 0.1 * abs(w) AS close, round(v * (1 + w) + pos / 64.0::DOUBLE, 5) + 0 AS modulated FROM v_channel")
def channel_arithmetic(spark, sf_dir):
    """Tolerance and modulation over all channels."""
    c = views.channels(spark, sf_dir)
    return c.select("vec_id", "pos", expr.within("v", "w", 0.05, 0.1).alias("close"), r(expr.modulated("v", "w", F.col("pos") / 64.0), 5).alias("modulated"))


@query("SELECT doc_id, list_filter([CASE WHEN NOT coalesce(n_chars >= 100, false) THEN 'short' END, CASE WHEN NOT coalesce(lang IN ('en', 'de'), false) THEN 'lang' END, CASE WHEN NOT coalesce(source <> 'src3', false) THEN 'source' END], lambda x: x IS NOT NULL) AS reasons FROM documents")
def quarantine(spark, sf_dir):
    """Which rules each row breaks; rows with none are good."""
    d = views.load(spark, sf_dir, "documents")
    rules = {"short": F.col("n_chars") >= 100, "lang": F.col("lang").isin("en", "de"), "source": F.col("source") != "src3"}
    return registry.validated(d, rules).select("doc_id", "reasons")


@query("SELECT asset_id, arg_min(frame, md5(asset_id || ':' || frame || ':3')) AS frame FROM v_view GROUP BY asset_id")
def random_view(spark, sf_dir):
    """One view of each asset, picked by a hash."""
    v = views.views_of_assets(spark, sf_dir)
    order = F.md5(F.concat_ws(":", F.col("asset_id").cast("string"), F.col("frame").cast("string"), F.lit("3")).cast("binary"))
    return v.groupBy("asset_id").agg(F.min_by("frame", order).alias("frame"))


def crossings_sql() -> str:
    parts = []
    for c, (p, q) in (("x", ("y", "z")), ("y", ("z", "x")), ("z", ("x", "y"))):
        end = lambda k, m: f"CASE WHEN least({q}{k}, {q}{m}) < w AND w <= greatest({q}{k}, {q}{m}) THEN {p}{k} + (w - {q}{k}) * ({p}{m} - {p}{k}) / ({q}{m} - {q}{k}) END"  # noqa: E731, B023
        ends = ", ".join(end(k, m) for k, m in ((0, 1), (1, 2), (2, 0)))
        rows = f"SELECT t.*, CAST(w.range AS DOUBLE) AS w FROM t, range(-1, 9) w WHERE n{c} <> 0 AND w.range > least({q}0, {q}1, {q}2) AND w.range <= greatest({q}0, {q}1, {q}2)"
        spans = f"SELECT *, list_min([{ends}]) AS e0, list_max([{ends}]) AS e1 FROM ({rows})"
        at = {c: f"{c}0 - (n{p} * (u.range - {p}0) + n{q} * (w - {q}0)) / n{c}", p: "CAST(u.range AS DOUBLE)", q: "w"}
        parts.append(f"SELECT fid, '{c}' AS axis, {', '.join(f'{at[a]} AS p{a}' for a in 'xyz')} FROM ({spans}), range(-1, 9) u WHERE u.range > e0 AND u.range <= e1")
    return " UNION ALL ".join(parts)


CROSSING_SQL = f"""v AS (SELECT vid, x / 4 + 0.11031773149 AS x, y / 4 + 0.23071944737 AS y, z / 4 + 0.37013177713 AS z FROM v_vertex),
    g AS (SELECT fid, {', '.join(f'c{k}.{a} AS {a}{k}' for k in range(3) for a in 'xyz')} FROM (SELECT DISTINCT v0 * 2500 + v1 * 50 + v2 AS fid, v0, v1, v2 FROM v_face) JOIN v c0 ON c0.vid = v0 JOIN v c1 ON c1.vid = v1 JOIN v c2 ON c2.vid = v2),
    t AS (SELECT *, (y1 - y0) * (z2 - z0) - (z1 - z0) * (y2 - y0) AS nx, (z1 - z0) * (x2 - x0) - (x1 - x0) * (z2 - z0) AS ny, (x1 - x0) * (y2 - y0) - (y1 - y0) * (x2 - x0) AS nz FROM g), c AS ({crossings_sql()})"""


def shifted_triangles(spark, sf_dir):
    shift = {"x": 0.11031773149, "y": 0.23071944737, "z": 0.37013177713}  # no height lies on a tie of its sixth digit (a test holds it)
    return triangles(spark, sf_dir).withColumns({f"{a}{k}": F.col(f"{a}{k}") + shift[a] for a in "xyz" for k in range(3)})


@query(f"WITH {CROSSING_SQL} SELECT fid, axis, round(px, 6) AS px, round(py, 6) AS py, round(pz, 6) AS pz FROM c")
def mesh_line_crossings(spark, sf_dir):
    """Where the triangles of a mesh cross the grid's lines."""
    c = geometry.line_crossings(shifted_triangles(spark, sf_dir))
    return c.select("fid", "axis", *[F.round(f"p{a}", 6).alias(f"p{a}") for a in "xyz"])


@query(
    f"""WITH {CROSSING_SQL}, k AS (SELECT c.*, i.range AS i, j.range AS j FROM c, range(2) i, range(2) j), m AS (
    SELECT axis, px, py, pz, CAST(CASE axis WHEN 'x' THEN floor(px) WHEN 'y' THEN px - j ELSE px - i END AS INT) AS x, CAST(CASE axis WHEN 'y' THEN floor(py) WHEN 'z' THEN py - j ELSE py - i END AS INT) AS y,
    CAST(CASE axis WHEN 'z' THEN floor(pz) WHEN 'x' THEN pz - j ELSE pz - i END AS INT) AS z, i + j = 2 AS own FROM k)
    SELECT x, y, z, count(*) AS n, bool_or(own AND axis = 'x') AS ix, bool_or(own AND axis = 'y') AS iy, bool_or(own AND axis = 'z') AS iz FROM m WHERE x BETWEEN 0 AND 3 AND y BETWEEN 0 AND 3 AND z BETWEEN 0 AND 3 GROUP BY 1, 2, 3"""
)
def mesh_dual_grid(spark, sf_dir):
    """The dual grid of a mesh: active cells, their crossings and crossed edges; a test holds the vertices."""
    return geometry.dual_grid(shifted_triangles(spark, sf_dir), 4).select("x", "y", "z", "n", "ix", "iy", "iz")
