"""Similarity of pictures, render losses and feature colours."""

from __future__ import annotations

from pyspark.sql import functions as F

from lattica.operators import images
from lattica.plans import views
from lattica.plans.catalog import query

#: Two pictures for each batch of voxels, seen along z: values between 0 and 1.
PICTURE = {"mask": "least(1.0, n / 24.0)", "depth": "(low + 1) / 40.0", "normal_0": "(f % 97) / 97.0", "normal_1": "(f % 31) / 31.0", "normal_2": "(n * 7 % 13) / 13.0"}
OTHER = {"mask": "least(1.0, n / 20.0)", "depth": "(high + 1) / 40.0", "normal_0": "(f % 89) / 89.0", "normal_1": "(f % 37) / 37.0", "normal_2": "(n * 5 % 11) / 11.0"}
SEEN_SQL = "s AS (SELECT b, y, x, CAST(sum(n) AS BIGINT) AS n, CAST(trunc(sum(f0)) AS BIGINT) AS f, min(z) AS low, max(z) AS high FROM v_voxel GROUP BY b, y, x)"


def as_double(sql: str) -> str:
    return sql.replace(".0", ".0::DOUBLE")


def pictures(spark, sf_dir):
    v = views.voxels(spark, sf_dir)
    s = v.groupBy("b", "y", "x").agg(F.sum("n").cast("long").alias("n"), F.sum("f0").cast("long").alias("f"), F.min("z").alias("low"), F.max("z").alias("high"))
    return [s.select("b", "y", "x", *[F.expr(e.replace(".0", ".0D")).cast("double").alias(c) for c, e in kind.items()]) for kind in (PICTURE, OTHER)]


def ssim_sql(rows: str, keys: str) -> str:
    """Windows by pairs of pixels: ``rows`` (keys, y, x, p, q)."""
    half = images.WIDTH // 2
    weight = f"exp(-(dy * dy + dx * dx) / (2 * {images.SPREAD}::DOUBLE * {images.SPREAD}::DOUBLE)) / (SELECT sum(exp(-(a.range * a.range + c.range * c.range) / (2 * {images.SPREAD}::DOUBLE * {images.SPREAD}::DOUBLE))) FROM range({-half}, {half + 1}) a, range({-half}, {half + 1}) c)"
    on = " AND ".join(f"a.{k} = c.{k}" for k in keys.split(", "))
    return f"""g AS (SELECT {', '.join(f'a.{k}' for k in keys.split(', '))}, a.y, a.x, c.p, c.q, {weight.replace('dy', '(c.y - a.y)').replace('dx', '(c.x - a.x)')} AS w FROM {rows} a JOIN {rows} c ON {on} AND abs(a.y - c.y) <= {half} AND abs(a.x - c.x) <= {half}),
    h AS (SELECT {keys}, y, x, sum(w * p) AS mp, sum(w * q) AS mq, sum(w * p * p) AS pp, sum(w * q * q) AS qq, sum(w * p * q) AS pq FROM g GROUP BY {keys}, y, x),
    i AS (SELECT {keys}, y, x, (2 * mp * mq + {images.C1!r}::DOUBLE) * (2 * (pq - mp * mq) + {images.C2!r}::DOUBLE) / ((mp * mp + mq * mq + {images.C1!r}::DOUBLE) * (pp - mp * mp + qq - mq * mq + {images.C2!r}::DOUBLE)) AS ssim FROM h)"""


@query(f"WITH {SEEN_SQL}, k AS (SELECT b, y, x, {as_double(PICTURE['normal_0'])} AS p, {as_double(OTHER['normal_0'])} AS q FROM s), {ssim_sql('k', 'b')} SELECT b, y, x, round(ssim, 6) + 0 AS ssim FROM i")
def ssim_map(spark, sf_dir):
    """Structural similarity of two pictures at every pixel."""
    one, two = pictures(spark, sf_dir)
    both = one.select("b", "y", "x", F.col("normal_0").alias("p")).join(two.select("b", "y", "x", F.col("normal_0").alias("q")), ["b", "y", "x"])
    return images.ssim(both, ["b"], "p", "q", 8).select("b", "y", "x", (F.round("ssim", 6) + 0).alias("ssim"))


PAIRS = {c: (as_double(PICTURE[c]), as_double(OTHER[c])) for c in PICTURE}


@query(
    f"""WITH {SEEN_SQL}, k AS (SELECT b, {', '.join(f'CAST({k} AS INT) AS channel' for k in (0,))}, y, x, {PAIRS['normal_0'][0]} AS p, {PAIRS['normal_0'][1]} AS q FROM s UNION ALL SELECT b, 1, y, x, {PAIRS['normal_1'][0]}, {PAIRS['normal_1'][1]} FROM s UNION ALL SELECT b, 2, y, x, {PAIRS['normal_2'][0]}, {PAIRS['normal_2'][1]} FROM s), {ssim_sql('k', 'b, channel')},
    m AS (SELECT b, avg(abs({PAIRS['mask'][0]} - {PAIRS['mask'][1]})) AS mask, avg(abs({PAIRS['depth'][0]} - {PAIRS['depth'][1]})) AS depth, avg((abs({PAIRS['normal_0'][0]} - {PAIRS['normal_0'][1]}) + abs({PAIRS['normal_1'][0]} - {PAIRS['normal_1'][1]}) + abs({PAIRS['normal_2'][0]} - {PAIRS['normal_2'][1]})) / 3) AS l1 FROM s GROUP BY b),
    a AS (SELECT b, 1 - avg(ssim) AS far FROM i GROUP BY b)
    SELECT b, round(mask, 6) AS mask, round(depth, 6) AS depth, round(l1, 6) AS normal_l1, round(far, 6) AS normal_ssim, round(1.5::DOUBLE * mask + 10 * depth + 1 * (l1 + 0.2::DOUBLE * far), 5) AS loss FROM m JOIN a USING (b)"""
)
def render_losses(spark, sf_dir):
    """Losses between two renders of each batch and their weighted sum."""
    out = images.render_losses(*pictures(spark, sf_dir), ["b"], {"mask": 1.5, "depth": 10.0, "normal": 1.0, "ssim": 0.2})
    return out.select("b", *[F.round(c, 6).alias(c) for c in ("mask", "depth", "normal_l1", "normal_ssim")], F.round("loss", 5).alias("loss"))


@query()
def feature_colours(spark, sf_dir):
    """Colours of latents by their three main axes; a test holds them against a full decomposition."""
    out = images.feature_colours(views.latents(spark, sf_dir), "feats")
    return out.select("vec_id", *[F.round(F.col("colour")[k], 6).alias(c) for k, c in enumerate("rgb")])
