"""Meshes, octrees, Hilbert order, stores and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lattica.functions import expr, sql
from lattica.operators import geometry, spatial
from lattica.plans import views
from lattica.plans.catalog import query
from lattica.plans.log_queries import CLIP_SQL, odd_log
from lattica.plans.sparse_queries import ZCODE, batch_and_code, chunk_and_code
from lattica.session import shared_dir
from lattica.sources import plugin
from lattica.sources import voxels as store
from lattica.streaming import records, state


def triangles(spark, sf_dir):
    """The distinct faces, with the mesh at a quarter of its size."""
    v = views.vertices(spark, sf_dir).withColumns({a: F.col(a) / 4 for a in "xyz"})
    return spatial.gathered(views.faces(spark, sf_dir).dropDuplicates(["v0", "v1", "v2"]), v).select(
        F.expr("v0 * 2500 + v1 * 50 + v2").alias("fid"), *[f"{a}{k}" for k in range(3) for a in "xyz"]
    )


@query()
def hilbert_encode(spark, sf_dir):
    """Codes along the Hilbert curve; tests hold that they are one to one and that neighbours on the curve touch."""
    return views.voxels(spark, sf_dir).select("b", "x", "y", "z", expr.hilbert("x", "y", "z").alias("code"))


@query("SELECT b, x, y, z FROM v_voxel")
def hilbert_roundtrip(spark, sf_dir):
    v = views.voxels(spark, sf_dir).select("b", expr.hilbert("x", "y", "z").alias("code")).withColumn("p", expr.hilbert_back("code"))
    return v.select("b", *[F.col(f"p.p{k}").alias(a) for k, a in enumerate("xyz")])


def touched_cells_sql() -> str:
    """Every cell of the grid, from a triangle's lowest to its highest, against every triangle: the plane parts two of its corners,
    and no edge's line parts its square from the triangle in any projection."""
    n = {"x": "(y1 - y0) * (z2 - z0) - (z1 - z0) * (y2 - y0)", "y": "(z1 - z0) * (x2 - x0) - (x1 - x0) * (z2 - z0)", "z": "(x1 - x0) * (y2 - y0) - (y1 - y0) * (x2 - x0)"}
    tests = ["nx * (x - x0) + ny * (y - y0) + nz * (z - z0) + least(nx, 0) + least(ny, 0) + least(nz, 0) <= 0", "nx * (x - x0) + ny * (y - y0) + nz * (z - z0) + greatest(nx, 0) + greatest(ny, 0) + greatest(nz, 0) >= 0"]
    for a, b, c in (("x", "y", "z"), ("y", "z", "x"), ("z", "x", "y")):
        for k in range(3):
            m = (k + 1) % 3
            p, q = f"({b}{k} - {b}{m})", f"({a}{m} - {a}{k})"
            sign = f"CASE WHEN n{c} < 0 THEN -1 ELSE 1 END"
            tests.append(f"{sign} * {p} * ({a} - {a}{k}) + {sign} * {q} * ({b} - {b}{k}) + greatest({sign} * {p}, 0) + greatest({sign} * {q}, 0) >= 0")
    held = lambda v: f"least(greatest(floor({v}), 0), 3)"
    for a in "xyz":
        low, high = f"least({a}0, {a}1, {a}2)", f"greatest({a}0, {a}1, {a}2)"
        tests.append(f"{high} >= 0 AND {low} < 4 AND {a} BETWEEN {held(low)} AND {held(high)}")
    corners = ", ".join(f"c{k}.{a} / 4 AS {a}{k}" for k in range(3) for a in "xyz")
    return f"""WITH g AS (SELECT fid, {corners} FROM (SELECT DISTINCT v0 * 2500 + v1 * 50 + v2 AS fid, v0, v1, v2 FROM v_face) JOIN v_vertex c0 ON c0.vid = v0 JOIN v_vertex c1 ON c1.vid = v1 JOIN v_vertex c2 ON c2.vid = v2),
    t AS (SELECT *, {', '.join(f'{e} AS n{a}' for a, e in n.items())} FROM g), q AS (SELECT t.*, CAST(i.range AS INT) AS x, CAST(j.range AS INT) AS y, CAST(k.range AS INT) AS z FROM t, range(4) i, range(4) j, range(4) k)
    SELECT fid, x, y, z FROM q WHERE {' AND '.join(f'({x})' for x in tests)}"""


@query(touched_cells_sql())
def triangle_voxels(spark, sf_dir):
    """Cells that triangles touch."""
    return geometry.triangle_voxels(triangles(spark, sf_dir), 4)


@query(
    """WITH t AS (SELECT DISTINCT v0, v1 FROM v_face), s AS (SELECT v0 * 50 + v1 AS sid, a.x + 0.5 AS x0, a.y + 0.5 AS y0, a.z + 0.5 AS z0, b.x + 0.5 AS x1, b.y + 0.5 AS y1, b.z + 0.5 AS z1 FROM t JOIN v_vertex a ON a.vid = v0 JOIN v_vertex b ON b.vid = v1)
    SELECT sid, CAST(floor(x0) AS INT) AS x, CAST(floor(y0) AS INT) AS y, CAST(floor(z0) AS INT) AS z FROM s UNION SELECT sid, CAST(floor(x1) AS INT), CAST(floor(y1) AS INT), CAST(floor(z1) AS INT) FROM s"""
)
def segment_ends(spark, sf_dir):
    """The first and last cell of every mesh edge, out of all cells it passes."""
    t = views.faces(spark, sf_dir).select("v0", "v1").distinct()
    v = views.vertices(spark, sf_dir)
    ends = [v.select(F.col("vid").alias(f"v{k}"), *[(F.col(a) + 0.5).alias(f"{a}{k}") for a in "xyz"]) for k in (0, 1)]
    s = t.join(ends[0], "v0").join(ends[1], "v1").withColumn("sid", F.expr("v0 * 50 + v1"))
    cells = geometry.segment_voxels(s.select("sid", *[f"{a}{k}" for k in (0, 1) for a in "xyz"]))
    at_end = [s.select("sid", *[F.floor(f"{a}{k}").cast("int").alias(a) for a in "xyz"]) for k in (0, 1)]
    return cells.join(at_end[0].union(at_end[1]).distinct(), ["sid", "x", "y", "z"], "left_semi").select("sid", "x", "y", "z")


def cells_sql(segments: str) -> str:
    """All cells of segments (sid, x0..z1): the middles between the crossings of the three axes in order."""
    cross = lambda a: f"CASE WHEN {a}0 <> {a}1 THEN [(w - {a}0) / ({a}1 - {a}0) FOR w IN range(CAST(ceil(least({a}0, {a}1)) AS BIGINT), CAST(floor(greatest({a}0, {a}1)) AS BIGINT) + 1)] ELSE [] END"
    at = lambda a: f"CAST(floor({a}0 + t * ({a}1 - {a}0)) AS INT) AS {a}"
    return f"""c AS (SELECT *, list_sort(list_distinct([0.0::DOUBLE, 1.0::DOUBLE] || {cross('x')} || {cross('y')} || {cross('z')})) AS ts FROM {segments}),
    m AS (SELECT *, (unnest(ts[1:len(ts) - 1]) + unnest(ts[2:])) / 2 AS t FROM c) SELECT DISTINCT sid, {at('x')}, {at('y')}, {at('z')} FROM m"""


EDGE_SQL = "s AS (SELECT v0 * 50 + v1 AS sid, a.x + 0.5 AS x0, a.y + 0.5 AS y0, a.z + 0.5 AS z0, b.x + 0.5 AS x1, b.y + 0.5 AS y1, b.z + 0.5 AS z1 FROM (SELECT DISTINCT v0, v1 FROM v_face) JOIN v_vertex a ON a.vid = v0 JOIN v_vertex b ON b.vid = v1)"


@query(f"WITH {EDGE_SQL}, {cells_sql('s')}")
def segment_cells(spark, sf_dir):
    """All cells that every mesh edge passes."""
    t = views.faces(spark, sf_dir).select("v0", "v1").distinct()
    v = views.vertices(spark, sf_dir)
    ends = [v.select(F.col("vid").alias(f"v{k}"), *[(F.col(a) + 0.5).alias(f"{a}{k}") for a in "xyz"]) for k in (0, 1)]
    s = t.join(ends[0], "v0").join(ends[1], "v1").withColumn("sid", F.expr("v0 * 50 + v1"))
    return geometry.segment_voxels(s.select("sid", *[f"{a}{k}" for k in (0, 1) for a in "xyz"])).select("sid", "x", "y", "z")


@query()
def qef_solve(spark, sf_dir):
    """Dual vertices: the planes of the triangles in each cell, their quadric, and its best point in the cell."""
    t = triangles(spark, sf_dir)
    d = {f"{a}{k}": F.col(f"{a}{k}") - F.col(f"{a}0") for a in "xyz" for k in (1, 2)}
    n = {"x": d["y1"] * d["z2"] - d["z1"] * d["y2"], "y": d["z1"] * d["x2"] - d["x1"] * d["z2"], "z": d["x1"] * d["y2"] - d["y1"] * d["x2"]}
    size = F.sqrt(n["x"] * n["x"] + n["y"] * n["y"] + n["z"] * n["z"])
    planes = t.withColumns({f"n{a}": n[a] / F.nullif(size, F.lit(0.0)) for a in "xyz"}).filter("nx is not null")
    planes = planes.withColumn("d", -(F.col("nx") * F.col("x0") + F.col("ny") * F.col("y0") + F.col("nz") * F.col("z0")))
    both = geometry.triangle_voxels(t, 4).join(planes.select("fid", "nx", "ny", "nz", "d", *[((F.col(f"{a}0") + F.col(f"{a}1") + F.col(f"{a}2")) / 3).alias(f"p{a}") for a in "xyz"]), "fid")
    cells = geometry.quadrics(both, ["x", "y", "z"])
    return geometry.dual_vertices(cells).select("x", "y", "z", "n", *[F.round(f"v{a}", 6).alias(f"v{a}") for a in "xyz"])


@query(f"SELECT b, {ZCODE} AS code FROM v_voxel")
def svo_roundtrip(spark, sf_dir):
    """Octree bytes of each chunk of 8x8x8 voxels, and the voxels' codes found back from them."""
    z = views.voxels(spark, sf_dir).select(*chunk_and_code())
    return geometry.octree_leaves(geometry.octree_bytes(z, "chunk", "code", 3), "chunk", 3).select(*batch_and_code())


@query("SELECT b, x, y, z, n FROM v_voxel WHERE x BETWEEN 3 AND 20 AND y BETWEEN 8 AND 15 AND z BETWEEN 0 AND 30")
def voxel_store_box(spark, sf_dir):
    """A table written by chunk along the z-order curve, and a box read back from it."""
    path = f"{shared_dir(spark)}/voxels-{uuid.uuid4().hex}"
    store.write_voxels(views.voxels(spark, sf_dir).select("b", "x", "y", "z", "n"), path, size=8)
    return store.read_voxels(spark, path, (3, 8, 0), (20, 15, 30)).select("b", "x", "y", "z", "n")


@query(
    """SELECT asset_id, arg_max(c_click, seq) FILTER (WHERE c_click IS NOT NULL) AS c_click, arg_max(c_view, seq) FILTER (WHERE c_view IS NOT NULL) AS c_view FROM v_record GROUP BY asset_id"""
)
def record_stream_merge(spark, sf_dir):
    """The registry that a stream of records leaves behind; the batch answer is the same."""
    shape = lambda e: e.select(
        F.col("user_id").cast("long").alias("asset_id"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "click", F.col("value")).alias("c_click"), F.when(F.col("event_type") == "view", F.col("value")).alias("c_view")
    )
    return records.merged_once(spark, f"{sf_dir}/events.parque[t]", shape, "asset_id", "seq")


@query("SELECT CAST(time_bucket(INTERVAL 1 DAY, ts) AS VARCHAR) AS start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY 1, 2")
def log_stream_agg(spark, sf_dir):
    stream = records.file_stream(spark, f"{sf_dir}/events.parque[t]")
    out = records.drained(records.log_sums(stream, "ts", "10 minutes", "1 day", "event_type", "value"), "complete", "log-sums")
    return out.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


@query(CLIP_SQL)
def clip_stream(spark, sf_dir):
    """The bound of rolling_percentile_clip in a stream of many micro-batches, with each run's last values kept as state."""
    path, log = f"{shared_dir(spark)}/log-{uuid.uuid4().hex}", views.log(spark, sf_dir).select("step", "rank", "value")
    cuts = log.agg(F.percentile_approx("step", [0.25, 0.5, 0.75])).first()[0]
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):  # written one after the other, as a log grows
        part = log.filter(F.col("step") >= low) if low is not None else log
        (part.filter(F.col("step") < high) if high is not None else part).coalesce(1).write.mode("append").parquet(path)
    stream = odd_log(records.file_stream(spark, path, files_per_batch=1))
    out = records.drained(state.clip_limits(stream, "rank", "step", "value", 20, 0.95, 50.0), "append", "clips")
    return out.select("step", "rank", F.round("limit", 6).alias("clip"))


PART_SQL = "r AS (SELECT CAST(user_id AS BIGINT) AS asset_id, event_id * 4 // (SELECT max(event_id) + 1 FROM events) AS part, CASE WHEN event_type = 'click' THEN value END AS c_click, CASE WHEN event_type = 'view' THEN value END AS c_view FROM events)"
NEWEST_SQL = "SELECT asset_id, arg_max(c_click, {'p': part, 'v': c_click}) FILTER (WHERE c_click IS NOT NULL) AS c_click, arg_max(c_view, {'p': part, 'v': c_view}) FILTER (WHERE c_view IS NOT NULL) AS c_view FROM r"


def written_parts(spark, sf_dir):
    """Four part files of records one after the other, as jobs would leave them: the folder, and what is in a line."""
    home = f"{shared_dir(spark)}/parts-{uuid.uuid4().hex}"
    e = views.load(spark, sf_dir, "events")
    value = lambda kind: F.when(F.col("event_type") == kind, F.col("value")).alias(f"c_{kind}")
    last = e.agg(F.max("event_id")).first()[0]
    jvm, config = spark._jvm, spark._jsc.hadoopConfiguration()
    for k in range(4):
        rows = e.filter(F.expr(f"event_id * 4 div {last + 1} = {k}")).select(F.col("user_id").cast("long").alias("asset_id"), value("click"), value("view"))
        rows.coalesce(1).write.option("header", "true").csv(f"{home}/made/{k}")
        made = jvm.org.apache.hadoop.fs.Path(f"{home}/made/{k}/part-*.csv")
        fs, to = made.getFileSystem(config), jvm.org.apache.hadoop.fs.Path(f"{home}/stage_{k % 2}/new_records/part_{k}.csv")
        fs.mkdirs(to.getParent())
        for status in fs.globStatus(made):
            fs.rename(status.getPath(), to)
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{home}/made"), True)
    return home, "asset_id long, c_click double, c_view double"


@query(f"WITH {PART_SQL} {NEWEST_SQL} GROUP BY asset_id")
def part_stream_merge(spark, sf_dir):
    """The registry that a stream of part files leaves behind, one file a micro-batch, those done with moved to an archive."""
    home, schema = written_parts(spark, sf_dir)
    return records.merged_parts(spark, home, schema, "asset_id", f"{home}-state", f"{home}-checkpoint", f"{home}-archive", 1)


@query(f"WITH {PART_SQL} {NEWEST_SQL} WHERE part >= 1 AND part < 3 GROUP BY asset_id")
def part_replay(spark, sf_dir):
    """The registry made anew from the second and third file, wherever the stream has left them."""
    home, schema = written_parts(spark, sf_dir)
    records.merged_parts(spark, home, schema, "asset_id", f"{home}-state", f"{home}-checkpoint", f"{home}-archive", 1)
    return records.replayed(spark, [f"{home}-archive", home], schema, "asset_id", "part_1.csv", "part_3.csv")


@query("SELECT b, x, y, z, n FROM v_voxel WHERE x BETWEEN 3 AND 20 AND y BETWEEN 8 AND 15 AND z > 4")
def voxel_source_box(spark, sf_dir):
    """A box read by the source's name: only the chunks that it meets are opened."""
    plugin.register(spark)
    path = f"{shared_dir(spark)}/voxels-{uuid.uuid4().hex}"
    store.write_voxels(views.voxels(spark, sf_dir).select("b", "x", "y", "z", "n"), path, size=8)
    return spark.read.format("voxels").load(path).filter("x >= 3 and x <= 20 and y >= 8 and y <= 15 and z > 4").select("b", "x", "y", "z", "n")


@query("SELECT CAST(x // 8 AS INT) AS chunk_x, CAST(y // 8 AS INT) AS chunk_y, CAST(z // 8 AS INT) AS chunk_z, count(*) AS n, min(x) AS low_x, max(x) AS high_x, min(z) AS low_z, max(z) AS high_z FROM v_voxel GROUP BY 1, 2, 3")
def voxel_chunk_info(spark, sf_dir):
    """Rows and bounds of each chunk from the files' footers."""
    path = f"{shared_dir(spark)}/voxels-{uuid.uuid4().hex}"
    store.write_voxels(views.voxels(spark, sf_dir).select("b", "x", "y", "z", "n"), path, size=8)
    return plugin.chunk_info(spark, path).select("chunk_x", "chunk_y", "chunk_z", "n", "low_x", "high_x", "low_z", "high_z")


LINE_SQL = "s AS (SELECT fid * 3 AS sid, a.x * 3::DOUBLE AS x0, a.y * 3::DOUBLE AS y0, a.z * 3::DOUBLE AS z0, b.x * 3::DOUBLE AS x1, b.y * 3::DOUBLE AS y1, b.z * 3::DOUBLE AS z1 FROM v_surface JOIN v_node a ON a.vid = v0 JOIN v_node b ON b.vid = v2)"


@query(f"WITH {LINE_SQL}, {cells_sql('s')}")
def sql_segment_cells(spark, sf_dir):
    """Cells of the surface's lines, asked for in SQL: a table function for each line."""
    sql.register(spark)
    views.surface(spark, sf_dir).createOrReplaceTempView("lattica_surface")
    views.nodes(spark, sf_dir).createOrReplaceTempView("lattica_nodes")
    return spark.sql(
        """SELECT sid, c.x, c.y, c.z FROM (SELECT fid * 3 AS sid, a.x * 3 AS x0, a.y * 3 AS y0, a.z * 3 AS z0, b.x * 3 AS x1, b.y * 3 AS y1, b.z * 3 AS z1
        FROM lattica_surface JOIN lattica_nodes a ON a.vid = v0 JOIN lattica_nodes b ON b.vid = v2) s, LATERAL segment_cells(x0, y0, z0, x1, y1, z1) c"""
    )


def spread_sql(v: str) -> str:
    return " + ".join(f"(({v} >> {k}) & 1) * {8 ** k}" for k in range(10))


@query(
    f"SELECT b, x, y, z, CAST(4 * ({spread_sql('x')}) + 2 * ({spread_sql('y')}) + ({spread_sql('z')}) AS BIGINT) AS code, CAST(floor((x - 17) / 8.0) AS BIGINT) AS chunk, CAST(CASE WHEN ((x - 9) % 16 + 16) % 16 < 8 THEN ((x - 9) % 16 + 16) % 16 ELSE 15 - ((x - 9) % 16 + 16) % 16 END AS BIGINT) AS texel, (z + 0.5::DOUBLE) * 0.25::DOUBLE - 1 AS middle FROM v_voxel"
)
def sql_scalars(spark, sf_dir):
    """Codes, chunks, texels and centres by the library's functions in SQL."""
    sql.register(spark)
    views.voxels(spark, sf_dir).createOrReplaceTempView("lattica_voxels")
    return spark.sql("SELECT b, x, y, z, z_order(x, y, z) AS code, floor_div(x - 17, 8) AS chunk, texel(x - 9, 8, 'mirror') AS texel, voxel_centre(z, 0.25D, -1D) AS middle FROM lattica_voxels")
