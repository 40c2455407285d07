"""Logs, schedules, scalar functions and sampling."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from lattica.functions import expr
from lattica.operators import logs, sampling
from lattica.plans import views
from lattica.plans.catalog import query


def r(c, digits=6):
    return F.round(c, digits) + F.lit(0.0)


@query(
    """WITH l AS (SELECT step, name, value, step // 1000 AS block FROM v_log)
    SELECT CAST(block AS BIGINT) AS block, 'loss.' || name AS key, round(CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) / count(*), 5) AS value FROM l WHERE name NOT IN ('click', 'view') GROUP BY 1, 2
    UNION ALL SELECT CAST(block AS BIGINT), 'loss.click', round(min(CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE)), 5) FROM l WHERE name = 'click' GROUP BY 1 UNION ALL SELECT CAST(block AS BIGINT), 'loss.view', round(max(CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE)), 5) FROM l WHERE name = 'view' GROUP BY 1"""
)
def log_nested_reduce(spark, sf_dir):
    """Mean per key and block of steps, with the minimum of one key and the maximum of another."""
    e = views.log(spark, sf_dir).select(expr.floordiv("step", 1000).alias("block"), F.concat(F.lit("loss."), "name").alias("key"), F.col("value").cast("decimal(18,4)").alias("value"))
    mean = F.sum("value").cast("double") / F.count("*")
    out = e.groupBy("block", "key").agg(mean.alias("mean"), F.min("value").cast("double").alias("least"), F.max("value").cast("double").alias("most"))
    value = F.when(F.col("key") == "loss.click", F.col("least")).when(F.col("key") == "loss.view", F.col("most")).otherwise(F.col("mean"))
    return out.select("block", "key", F.round(value, 5).alias("value"))


@query("SELECT step, regexp_extract(line, '\"name\": \"([a-z]+)\"', 1) AS name, rank FROM (SELECT step, concat(CAST(step AS VARCHAR), ': {\"name\": \"', name, '\", \"at\": {\"rank\": ', CAST(rank AS VARCHAR), '}}') AS line, CAST(rank AS BIGINT) AS rank FROM v_log)")
def log_parse(spark, sf_dir):
    """Lines of ``step: json`` with nested values."""
    e = views.log(spark, sf_dir)
    line = F.concat(F.col("step").cast("string"), F.lit(": "), F.to_json(F.struct("name", F.struct("rank").alias("at"))))
    return logs.parsed(e.select(line.alias("line")), "line", "name string, at struct<rank: bigint>").select("step", F.col("log.name").alias("name"), F.col("log.at.rank").alias("rank"))


@query("SELECT CAST(floor(t * 10) AS INT) AS bin, count(*) AS n, round(CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) / count(*), 5) AS mean FROM (SELECT (step % 101) / 100.0 AS t, value FROM v_log) WHERE t < 1 GROUP BY 1")
def log_time_bins(spark, sf_dir):
    e = views.log(spark, sf_dir).select(((F.col("step") % 101) / 100.0).alias("t"), F.col("value").cast("decimal(18,4)").alias("value"))
    return logs.time_bins(e, "t", 10, n=F.count("*"), mean=F.round(F.sum("value").cast("double") / F.count("*"), 5))


#: Every 37th value is NaN and every 41st infinite: neither counts, and the bound stays.
ODD_VALUE = "CASE WHEN step % 37 = 0 THEN {nan} WHEN step % 41 = 0 THEN {inf} ELSE value END"
CLIP_SQL = f"""WITH o AS (SELECT step, rank, {ODD_VALUE.format(nan="'NaN'::DOUBLE", inf="'Infinity'::DOUBLE")} AS value FROM v_log),
    c AS (SELECT *, count(*) FILTER (WHERE isfinite(value)) OVER (PARTITION BY rank ORDER BY step) AS k FROM o),
    l AS (SELECT rank, k, CASE WHEN count(*) OVER w = 20 THEN least(50.0, quantile_cont(value, 0.95) OVER w) ELSE 50.0 END AS bound FROM c WHERE isfinite(value) WINDOW w AS (PARTITION BY rank ORDER BY k ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
    SELECT step, c.rank, round(coalesce(l.bound, 50.0), 6) AS clip FROM c LEFT JOIN l ON c.rank = l.rank AND c.k = l.k"""


def odd_log(log):
    return log.withColumn("value", F.expr(ODD_VALUE.format(nan="double('NaN')", inf="double('Infinity')")))


@query(CLIP_SQL)
def rolling_percentile_clip(spark, sf_dir):
    """A bound from the last 20 finite values of each run, active once there are 20."""
    return logs.clip_limit(odd_log(views.log(spark, sf_dir)), "rank", "step", "value", 20, 0.95, 50.0).select("step", "rank", F.round("limit", 6).alias("clip"))


@query(
    """WITH f AS (SELECT step, rank, value, CASE WHEN row_number() OVER (PARTITION BY rank ORDER BY step) % 10 = 0 THEN regr_slope(value, CAST(step AS DOUBLE)) OVER w END AS s FROM v_log
    WINDOW w AS (PARTITION BY rank ORDER BY step ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
    SELECT step, rank, round(last_value(s IGNORE NULLS) OVER (PARTITION BY rank ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 5) + 0 AS slope FROM f"""
)
def rolling_ols(spark, sf_dir):
    e = views.log(spark, sf_dir).withColumn("x", F.col("step").cast("double"))
    return logs.rolling_fit(e, "rank", "step", "value", "x", 30, 10).select("step", "rank", r("slope", 5).alias("slope"))


@query(
    """WITH e AS (SELECT step, rank, value, 100 + step % 900 AS size, (1 + step % 9) / 10.0::DOUBLE AS ratio, row_number() OVER (PARTITION BY rank ORDER BY step) AS i FROM v_log),
    m AS (SELECT *, 3 + size * ratio / 200 + value / 1000 AS memory, size * ratio AS x FROM e),
    f AS (SELECT *, CASE WHEN i % 10 = 0 THEN regr_slope(memory, x) OVER w END AS s, CASE WHEN i % 10 = 0 THEN regr_intercept(memory, x) OVER w END AS c FROM m WINDOW w AS (PARTITION BY rank ORDER BY step ROWS BETWEEN 39 PRECEDING AND CURRENT ROW)),
    g AS (SELECT *, last_value(s IGNORE NULLS) OVER u AS slope, last_value(c IGNORE NULLS) OVER u AS intercept FROM f WINDOW u AS (PARTITION BY rank ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT step, rank, round(slope, 6) + 0 AS slope, round(intercept, 6) + 0 AS intercept, round(CASE WHEN slope IS NOT NULL AND slope <> 0 THEN least(least(1.0, 0.5 + (i // 10) * 0.1), greatest(0.0, (4.5 - intercept) / (slope * size))) END, 6) + 0 AS ratio FROM g"""
)
def memory_controller(spark, sf_dir):
    """Memory fitted over size * ratio on a run's last 40 rows, and the ratio that the fit asks for next."""
    e = views.log(spark, sf_dir).withColumns({"size": 100 + F.col("step") % 900, "used": (1 + F.col("step") % 9) / 10.0})
    e = e.withColumns({"x": F.col("size") * F.col("used"), "memory": 3 + F.col("size") * F.col("used") / 200 + F.col("value") / 1000})
    fits = logs.with_place(logs.rolling_fit(e, "rank", "step", "memory", "x", 40, 10), "rank", "step", "i").withColumn("i", F.col("i") + 1)
    out = logs.memory_ratio(fits, "size", 5.0, 0.9, 0.5, 10, "i")
    return out.select("step", "rank", r("slope", 6).alias("slope"), r("intercept", 6).alias("intercept"), r("ratio", 6).alias("ratio"))


@query(
    """WITH n AS (SELECT rank, value, row_number() OVER (PARTITION BY rank ORDER BY step) AS i, count(*) OVER (PARTITION BY rank) AS n FROM v_log)
    SELECT rank, round(sum(value * CASE WHEN i = 1 THEN power(0.9, n - 1) ELSE (1 - 0.9) * power(0.9, n - i) END), 6) AS ema FROM n GROUP BY rank"""
)
def ema(spark, sf_dir):
    return logs.ema(views.log(spark, sf_dir), "rank", "step", "value", 0.9).select("rank", F.round("ema", 6).alias("ema"))


@query(
    """WITH n AS (SELECT rank, step, row_number() OVER (PARTITION BY rank ORDER BY step) AS i, step * 0.5 AS elapsed FROM v_log), m AS (SELECT rank, i, 10 / nullif(elapsed - lag(elapsed) OVER (PARTITION BY rank ORDER BY step), 0) AS speed FROM n WHERE i % 10 = 0)
    SELECT rank, CAST(i AS INT) AS i, round(speed, 6) AS speed, round((1000 - i) / speed, 4) AS eta FROM m"""
)
def throughput_eta(spark, sf_dir):
    e = views.log(spark, sf_dir).withColumn("elapsed", F.col("step") * 0.5)
    return logs.throughput(e, "rank", "step", "elapsed", 10, 1000).select("rank", "i", F.round("speed", 6).alias("speed"), F.round("eta", 4).alias("eta"))


@query(
    """SELECT b, count(*) AS n, round(avg(l1), 6) AS l1, round(avg(l2), 6) AS l2, round(avg(sl1), 6) AS smooth_l1, round(-10 * log10(avg(l2)), 5) AS psnr FROM
    (SELECT b, abs(p - q) AS l1, (p - q) ** 2 AS l2, CASE WHEN abs(p - q) < 1 THEN 0.5 * (p - q) ** 2 ELSE abs(p - q) - 0.5 END AS sl1 FROM
     (SELECT b, CAST(unnest(feats) AS DOUBLE) AS p, CAST(unnest(list_reverse(feats)) AS DOUBLE) AS q FROM v_latent)) GROUP BY b"""
)
def loss_metrics(spark, sf_dir):
    """Losses between two feature columns of each batch."""
    v = views.latents(spark, sf_dir).select("b", F.inline(F.arrays_zip(F.col("feats").alias("p"), F.reverse("feats").alias("q"))))
    v = v.toDF("b", "p", "q").select("b", (F.col("p").cast("double") - F.col("q").cast("double")).alias("d"))
    smooth = F.when(F.abs("d") < 1, 0.5 * F.col("d") ** 2).otherwise(F.abs("d") - 0.5)
    return v.groupBy("b").agg(
        F.count("*").alias("n"), F.round(F.avg(F.abs("d")), 6).alias("l1"), F.round(F.avg(F.col("d") ** 2), 6).alias("l2"), F.round(F.avg(smooth), 6).alias("smooth_l1"), F.round(-10 * F.log10(F.avg(F.col("d") ** 2)), 5).alias("psnr")
    )


@query(
    """WITH v AS (SELECT b, 1 / (1 + exp(-CAST(unnest(feats) AS DOUBLE))) AS p, CAST(unnest(list_reverse(feats)) > 0 AS INT) AS y FROM v_latent)
    SELECT b, round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS bce, round(1 - (2 * sum(p * y) + 1) / (sum(p) + sum(y) + 1), 6) AS dice FROM v GROUP BY b"""
)
def bce_dice(spark, sf_dir):
    v = views.latents(spark, sf_dir).select("b", F.inline(F.arrays_zip(F.col("feats").alias("p"), F.reverse("feats").alias("q")))).toDF("b", "p", "q")
    v = v.select("b", (1 / (1 + F.exp(-F.col("p").cast("double")))).alias("p"), (F.col("q") > 0).cast("int").alias("y"))
    bce = -(F.col("y") * F.ln("p") + (1 - F.col("y")) * F.ln(1 - F.col("p")))
    return v.groupBy("b").agg(F.round(F.avg(bce), 6).alias("bce"), F.round(1 - (2 * F.sum(F.col("p") * F.col("y")) + 1) / (F.sum("p") + F.sum("y") + 1), 6).alias("dice"))


@query("SELECT vec_id, list_transform(list_slice(feats, 1, 4), lambda x, i: round((CAST(x AS DOUBLE) - 0.1 * i) / (0.5 + i), 6) + 0) AS z FROM v_latent")
def standardise_latents(spark, sf_dir):
    v = views.latents(spark, sf_dir)
    z = expr.standardised(F.slice("feats", 1, 4), [0.1 * i for i in (1, 2, 3, 4)], [0.5 + i for i in (1, 2, 3, 4)])
    return v.select("vec_id", F.transform(z, lambda x: F.round(x, 6) + F.lit(0.0)).alias("z"))


@query("SELECT vec_id, true AS same FROM v_latent")
def standardise_roundtrip(spark, sf_dir):
    v = views.latents(spark, sf_dir)
    mean, std = [i / 64 for i in range(64)], [1 + i / 64 for i in range(64)]
    back = expr.unstandardised(expr.standardised("feats", mean, std), mean, std)
    return v.select("vec_id", F.forall(F.zip_with(back, "feats", lambda a, b: F.abs(a - b) < 1e-5), lambda x: x).alias("same"))


@query("SELECT vec_id, CAST((a > 0)::INT + 2 * (b > 0)::INT + 4 * (c > 0)::INT AS INT) AS mask, a > 0 AS f0, b > 0 AS f1, c > 0 AS f2 FROM (SELECT vec_id, feats[1] AS a, feats[2] AS b, feats[3] AS c FROM v_latent)")
def bitpack_unpack(spark, sf_dir):
    v = views.latents(spark, sf_dir).select("vec_id", expr.packed_flags(*[F.element_at("feats", k) > 0 for k in (1, 2, 3)]).alias("mask"))
    return v.select("vec_id", "mask", *[c.alias(f"f{k}") for k, c in enumerate(expr.unpacked_flags("mask"))])


@query("SELECT vec_id, CAST(floor(least(greatest(v, 0), 1) * 255) AS INT) AS q, round(floor(least(greatest(v, 0), 1) * 255) / 255.0 * 2 - 1, 6) AS back FROM (SELECT vec_id, CAST(feats[1] AS DOUBLE) * 3 AS v FROM v_latent)")
def quantise_dequantise(spark, sf_dir):
    v = views.latents(spark, sf_dir).select("vec_id", expr.quantised(F.element_at("feats", 1).cast("double") * 3).alias("q"))
    return v.select("vec_id", "q", r(F.col("q") / 255.0 * 2 - 1).alias("back"))


@query("SELECT step, round(r, 7) AS t, round(least(1, (step + 1) / 5000.0), 6) AS warm, round(t0 - r, 7) AS moved FROM (SELECT step, (step % 1000) / 1000.0 AS t0, 3.0 * ((step % 1000) / 1000.0) / (1 + 2.0 * ((step % 1000) / 1000.0)) AS r FROM v_log)")
def flow_schedule(spark, sf_dir):
    """Warped time steps and a linear warm-up."""
    t = (F.col("step") % 1000) / 1000.0
    warped = expr.schedule(t, 3.0)
    return views.log(spark, sf_dir).select("step", F.round(warped, 7).alias("t"), F.round(expr.warm_up("step", 5000), 6).alias("warm"), r(t - warped, 7).alias("moved"))


@query(
    """SELECT vec_id, round((1 - t) * x + (1e-5 + (1 - 1e-5) * t) * n, 6) + 0 AS xt, round((1 - 1e-5) * n - x, 6) + 0 AS v, round((1 - 1e-5) * ((1 - t) * x + (1e-5 + (1 - 1e-5) * t) * n) - (1e-5 + (1 - 1e-5) * t) * ((1 - 1e-5) * n - x), 5) + 0 AS x0
    FROM (SELECT vec_id, CAST(feats[1] AS DOUBLE) AS x, CAST(feats[2] AS DOUBLE) AS n, (vec_id % 10) / 10.0 AS t FROM v_latent)"""
)
def flow_roundtrip(spark, sf_dir):
    """Diffused value, its velocity, and the start found back from both."""
    v = views.latents(spark, sf_dir).select("vec_id", F.element_at("feats", 1).cast("double").alias("x"), F.element_at("feats", 2).cast("double").alias("n"), ((F.col("vec_id") % 10) / 10.0).alias("t"))
    v = v.withColumns({"xt": expr.diffused("x", "n", "t"), "v": expr.velocity("x", "n")})
    return v.select("vec_id", r("xt").alias("xt"), r("v").alias("v"), r(expr.x0_from_velocity("xt", "v", "t"), 5).alias("x0"))


@query("SELECT vec_id, round(CASE WHEN t BETWEEN 0.2 AND 0.7 THEN 7.5 * p - 6.5 * n ELSE p END, 5) + 0 AS guided FROM (SELECT vec_id, CAST(feats[1] AS DOUBLE) AS p, CAST(feats[2] AS DOUBLE) AS n, (vec_id % 11) / 10.0 AS t FROM v_latent)")
def cfg_blend(spark, sf_dir):
    v = views.latents(spark, sf_dir)
    out = expr.guided(F.element_at("feats", 1).cast("double"), F.element_at("feats", 2).cast("double"), (F.col("vec_id") % 11) / 10.0, 7.5, (0.2, 0.7))
    return v.select("vec_id", r(out, 5).alias("guided"))


@query(
    """WITH h AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS i FROM conversations),
    v AS (SELECT conv_id, turn, i, i / 16.0 AS u, list_sum(list_transform(range(24), lambda k: (i // CAST(2 ** k AS BIGINT)) % 2 / 2.0 ** (k + 1))) AS w FROM h)
    SELECT conv_id, turn, round(u, 6) AS u, round(w, 6) AS v, round(u * 2 * pi(), 6) AS phi, round(acos(1 - 2 * w) - pi() / 2, 6) + 0 AS theta FROM v"""
)
def hammersley_views(spark, sf_dir):
    """View directions for each frame of an asset."""
    c = views.load(spark, sf_dir, "conversations")
    i = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1
    u, v = expr.hammersley("i", 16)
    phi, theta = expr.on_sphere(u, v)
    return c.select("conv_id", "turn", i.alias("i")).select("conv_id", "turn", F.round(u, 6).alias("u"), F.round(v, 6).alias("v"), F.round(phi, 6).alias("phi"), r(theta).alias("theta"))


@query(
    """SELECT p_partkey, round(2 * sin(yaw) * cos(pitch), 6) + 0 AS x, round(2 * cos(yaw) * cos(pitch), 6) + 0 AS y, round(2 * sin(pitch), 6) + 0 AS z, round(0.5 / tan(0.7 / 2), 6) AS f FROM (SELECT p_partkey, p_partkey % 360 * pi() / 180 AS yaw, p_size * 0.01 AS pitch FROM part)"""
)
def camera_positions(spark, sf_dir):
    p = views.load(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 360 * F.lit(math.pi) / 180).alias("yaw"), (F.col("p_size") * 0.01).alias("pitch"))
    x, y, z = expr.look_at("yaw", "pitch", 2.0)
    return p.select("p_partkey", r(x).alias("x"), r(y).alias("y"), r(z).alias("z"), r(expr.focal(F.lit(0.7))).alias("f"))


@query(
    """SELECT p_partkey, CAST(((i % 16) + 16) % 16 AS BIGINT) AS repeat, CAST(least(greatest(i, 0), 15) AS BIGINT) AS clamp, CAST(CASE WHEN ((i % 32) + 32) % 32 < 16 THEN ((i % 32) + 32) % 32 ELSE 31 - ((i % 32) + 32) % 32 END AS BIGINT) AS mirror FROM (SELECT p_partkey, p_size - 25 AS i FROM part)"""
)
def texture_wrap(spark, sf_dir):
    p = views.load(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") - 25).alias("i"))
    return p.select("p_partkey", *[expr.wrapped("i", 16, m).alias(m) for m in ("repeat", "clamp", "mirror")])


@query(
    """WITH t AS (SELECT x, y, CAST(sum(n) AS BIGINT) AS v FROM v_voxel GROUP BY 1, 2), p AS (SELECT p_partkey, (p_partkey % 31) + 0.25 AS u, (p_size % 31) + 0.5 AS w FROM part),
    c AS (SELECT p_partkey, k.range AS k, CAST(floor(u) AS INT) + k.range % 2 AS x, CAST(floor(w) AS INT) + k.range // 2 AS y, CASE WHEN k.range % 2 = 1 THEN 0.25 ELSE 0.75 END * 0.5 AS wt FROM p, range(4) k)
    SELECT p_partkey, round(CAST(sum(wt * v) AS DOUBLE), 4) AS value FROM c JOIN t ON c.x = t.x AND c.y = t.y GROUP BY 1"""
)
def texture_bilinear(spark, sf_dir):
    """Four texels of each sample, joined on equality and weighted."""
    t = views.voxels(spark, sf_dir).groupBy("x", "y").agg(F.sum("n").alias("v"))
    p = views.load(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 31 + 0.25).alias("u"), (F.col("p_size") % 31 + 0.5).alias("w"))
    c = p.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
    part = lambda a, bit: F.when(bit == 1, F.col(a) - F.floor(a)).otherwise(1 - (F.col(a) - F.floor(a)))
    one, two = F.col("k") % 2, F.floor(F.col("k") / 2)
    at = c.select("p_partkey", (F.floor("u") + one).cast("int").alias("x"), (F.floor("w") + two).cast("int").alias("y"), (part("u", one) * part("w", two)).alias("wt"))
    return at.join(t, ["x", "y"]).groupBy("p_partkey").agg(F.round(F.sum(F.col("wt") * F.col("v")), 4).alias("value"))


@query("SELECT p_partkey, p_size, CASE m WHEN 0 THEN 1.0 WHEN 1 THEN CASE WHEN a < 0.5 THEN 0.0 ELSE 1.0 END ELSE a END AS alpha FROM (SELECT p_partkey, p_size, p_partkey % 3 AS m, CAST(p_size AS DOUBLE) / 50 AS a FROM part)")
def alpha_modes(spark, sf_dir):
    mode = F.element_at(F.array(*map(F.lit, ("OPAQUE", "MASK", "BLEND"))), (F.col("p_partkey") % 3 + 1).cast("int"))
    return views.load(spark, sf_dir, "part").select("p_partkey", "p_size", expr.alpha(mode, F.col("p_size").cast("double") / 50, F.lit(0.5)).alias("alpha"))


@query("SELECT p_partkey, round(least(greatest((x * (2.51 * x + 0.03)) / (x * (2.43 * x + 0.59) + 0.14), 0), 1), 6) AS tone, round(power(x, 1 / 2.2), 6) AS gamma FROM (SELECT p_partkey, CAST(p_retailprice AS DOUBLE) / 1000 AS x FROM part)")
def tone_map(spark, sf_dir):
    x = F.col("p_retailprice").cast("double") / 1000
    return views.load(spark, sf_dir, "part").select("p_partkey", F.round(expr.aces(x), 6).alias("tone"), F.round(expr.gamma(x), 6).alias("gamma"))


@query("SELECT p_partkey, p_size, bit_count(p_size) = 1 AS is_power, CAST(power(2, round(log2(p_size))) AS BIGINT) AS nearest FROM part")
def powers_of_two(spark, sf_dir):
    return views.load(spark, sf_dir, "part").select("p_partkey", "p_size", expr.power_of_two("p_size").alias("is_power"), expr.nearest_power_of_two("p_size").alias("nearest"))


@query("SELECT p_partkey, list_concat(list_transform(range(4), lambda k: round(cos(t * exp(-ln(10000.0) * k / 4)), 6) + 0), list_transform(range(4), lambda k: round(sin(t * exp(-ln(10000.0) * k / 4)), 6) + 0)) AS embedding FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) AS t FROM part)")
def timestep_embedding(spark, sf_dir):
    e = expr.positions(F.col("p_size").cast("double"), 8)
    return views.load(spark, sf_dir, "part").select("p_partkey", F.transform(e, lambda x: F.round(x, 6) + F.lit(0.0)).alias("embedding"))


@query(
    """SELECT vec_id, [round(a * cos(p) - b * sin(p), 5) + 0, round(a * sin(p) + b * cos(p), 5) + 0, round(c * cos(p / 2) - d * sin(p / 2), 5) + 0, round(c * sin(p / 2) + d * cos(p / 2), 5) + 0] AS rotated FROM
    (SELECT vec_id, CAST(feats[1] AS DOUBLE) AS a, CAST(feats[2] AS DOUBLE) AS b, CAST(feats[3] AS DOUBLE) AS c, CAST(feats[4] AS DOUBLE) AS d, (vec_id % 16) * 0.1 AS p FROM v_latent)"""
)
def rope_rotation(spark, sf_dir):
    v = views.latents(spark, sf_dir).select("vec_id", F.transform(F.slice("feats", 1, 4), lambda x: x.cast("double")).alias("f"), ((F.col("vec_id") % 16) * 0.1).alias("p"))
    return v.select("vec_id", F.transform(expr.rotated(F.col("f"), "p"), lambda x: F.round(x, 5) + F.lit(0.0)).alias("rotated"))


@query(
    """WITH s AS (SELECT c_custkey, CAST(c_custkey % 7 - 3 AS DOUBLE) AS dx, CAST(c_nationkey % 5 - 2 AS DOUBLE) AS dy, 1.0 AS dz FROM customer),
    i AS (SELECT c_custkey, CASE WHEN dx = 0 THEN 1e10 ELSE 1 / dx END AS ix, CASE WHEN dy = 0 THEN 1e10 ELSE 1 / dy END AS iy, 1 / dz AS iz FROM s)
    SELECT c_custkey, round(greatest(least(-1 * ix, ix), least(-1 * iy, iy), least(2 * iz, 4 * iz)), 4) AS near, round(least(greatest(-1 * ix, ix), greatest(-1 * iy, iy), greatest(2 * iz, 4 * iz)), 4) AS far FROM i"""
)
def ray_box(spark, sf_dir):
    c = views.load(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 7 - 3).cast("double").alias("dx"), (F.col("c_nationkey") % 5 - 2).cast("double").alias("dy"))
    near, far = expr.slab([F.lit(0.0)] * 3, ["dx", "dy", F.lit(1.0)], [-1.0, -1.0, 2.0], [1.0, 1.0, 4.0])
    return c.select("c_custkey", F.round(near, 4).alias("near"), F.round(far, 4).alias("far"))


@query("SELECT conv_id, CAST(count(*) AS BIGINT) AS frames, CAST(max(i // 4) AS INT) AS last_row, CAST(max(i % 4) AS INT) AS last_col FROM (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations) GROUP BY conv_id")
def image_grid(spark, sf_dir):
    c = views.load(spark, sf_dir, "conversations").select("conv_id", (F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1).alias("i"))
    return c.groupBy("conv_id").agg(F.count("*").alias("frames"), F.max(expr.floordiv("i", 4)).cast("int").alias("last_row"), F.max(F.pmod("i", F.lit(4))).alias("last_col"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, len(props) AS n FROM events")
def json_values(spark, sf_dir):
    return views.load(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.length("props").cast("long").alias("n"))


def dealt_sql(equal: bool) -> str:
    """Loads of a batch one after the other, heaviest first, each to the least loaded of the open groups."""
    room = "(m + 3) // 4" if equal else "m"
    return f"""WITH RECURSIVE a AS (SELECT sha256, num_faces AS l, row_number() OVER (ORDER BY sha256) - 1 AS r FROM v_asset),
    k AS (SELECT r // 64 AS batch_id, sha256, l, row_number() OVER (PARTITION BY r // 64 ORDER BY l DESC, r) AS o, count(*) OVER (PARTITION BY r // 64) AS m FROM a),
    w AS (SELECT batch_id, CAST(0 AS BIGINT) AS o, [0, 0, 0, 0]::BIGINT[] AS loads, [0, 0, 0, 0]::BIGINT[] AS sizes, CAST(-1 AS INT) AS g FROM k WHERE o = 1 UNION ALL
    SELECT batch_id, o, [CASE WHEN i = g THEN loads[i + 1] + l ELSE loads[i + 1] END FOR i IN range(4)], [CASE WHEN i = g THEN sizes[i + 1] + 1 ELSE sizes[i + 1] END FOR i IN range(4)], g FROM
    (SELECT batch_id, o, l, loads, sizes, CAST(list_position(open, list_min(open)) - 1 AS INT) AS g FROM (SELECT k.batch_id, k.o, k.l, w.loads, w.sizes, [CASE WHEN w.sizes[i + 1] < {room} THEN w.loads[i + 1] END FOR i IN range(4)] AS open FROM w JOIN k ON k.batch_id = w.batch_id AND k.o = w.o + 1)))
    SELECT k.batch_id, k.sha256, k.l AS num_faces, w.g AS "group" FROM k JOIN w ON w.batch_id = k.batch_id AND w.o = k.o"""


@query(dealt_sql(False))
def lpt_groups(spark, sf_dir):
    """Loads of each global batch of 64 assets dealt to 4 groups, one after the other within a batch."""
    return sampling.balanced(views.assets(spark, sf_dir), "sha256", "num_faces", 64, 4)


@query(dealt_sql(True))
def balanced_plan(spark, sf_dir):
    """The same with as many assets in each group."""
    return sampling.balanced(views.assets(spark, sf_dir), "sha256", "num_faces", 64, 4, equal_size=True)
