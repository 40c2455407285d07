"""Textures as tables (level, ty, tx, value): mip chains, samples, and the frames of textured triangles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.functions.expr import col, wrapped


def mipmaps(texture: DataFrame, size: int) -> DataFrame:
    """(level, ty, tx, value): the square texture (ty, tx, value) of a power of two as level 0, and the 2x2 means above it."""
    levels = now = texture.select(F.lit(0).alias("level"), "ty", "tx", F.col("value").cast("double").alias("value"))
    for level in range(1, size.bit_length()):
        half = [F.shiftright(c, 1).alias(c) for c in ("ty", "tx")]
        now = now.groupBy(*half).agg((F.sum("value") / 4).alias("value")).select(F.lit(level).alias("level"), "ty", "tx", "value")
        levels = levels.unionByName(now)
    return levels


def sampled(points: DataFrame, key: str, levels: DataFrame, size: int, mode: str = "repeat", linear: bool = True, offset: float = 0.0) -> DataFrame:
    """(key, value) of points (key, u, v, len): the texture there. Nearest, or bilinear at the level log2(len * size) + offset,
    with a blend of the two levels around it; below level 0 and where it isn't finite level 0, above the last the last. Rows of
    the texture run against v. Eight texels a point are joined on equality."""
    top = size.bit_length() - 1
    if not linear:
        at = points.select(key, F.lit(0).alias("level"), wrapped(F.floor(F.col("u") * size), size, mode).cast("int").alias("tx"), wrapped(F.floor((1 - F.col("v")) * size), size, mode).cast("int").alias("ty"))
        return at.join(levels, ["level", "ty", "tx"]).select(key, "value")
    exact = F.when(F.col("len") > 0, F.log2(F.col("len") * size) + offset).otherwise(F.lit(0.0))
    level = F.least(F.greatest(F.coalesce(exact, F.lit(0.0)), F.lit(0.0)), F.lit(float(top)))
    rows = points.withColumn("_l", level).withColumn("_low", F.floor("_l").cast("int"))
    share = F.col("_l") - F.col("_low")
    rows = rows.select(key, "u", "v", F.inline(F.array(F.struct(F.col("_low").alias("level"), (1 - share).alias("_s")), F.struct(F.least(F.col("_low") + 1, F.lit(top)).alias("level"), share.alias("_s")))))
    n = F.expr(f"shiftright({size}, level)")
    x, y = F.col("u") * n - 0.5, (1 - F.col("v")) * n - 0.5
    rows = rows.filter("_s > 0").withColumns({"_n": n, "_x": x, "_y": y, "_k": F.explode(F.sequence(F.lit(0), F.lit(3)))})
    dx, dy = F.col("_k") % 2, F.floor(F.col("_k") / 2)
    weight = lambda c, d: F.when(d == 1, F.col(c) - F.floor(c)).otherwise(1 - (F.col(c) - F.floor(c)))
    at = rows.select(key, "level", _wrapped(F.floor("_x") + dx, F.col("_n"), mode).alias("tx"), _wrapped(F.floor("_y") + dy, F.col("_n"), mode).alias("ty"), (weight("_x", dx) * weight("_y", dy) * F.col("_s")).alias("_w"))
    return at.join(levels, ["level", "ty", "tx"]).groupBy(key).agg(F.sum(F.col("_w") * F.col("value")).alias("value"))


def _wrapped(i: Column, n: Column, mode: str) -> Column:
    """wrapped() for a size that is a column."""
    i = i.cast("long")
    if mode == "clamp":
        return F.least(F.greatest(i, F.lit(0)), n - 1).cast("int")
    if mode == "repeat":
        return F.pmod(i, n).cast("int")
    folded = F.pmod(i, 2 * n)
    return F.when(folded < n, folded).otherwise(2 * n - 1 - folded).cast("int")


def tangent_frame(corners: list[list], uvs: list[list]) -> tuple[list[Column], list[Column], list[Column]]:
    """Unit tangent and bitangent of a textured triangle, and the lengths that the texture's unit spans along them; the x and y
    axes and 1e6 where the texture has no area there."""
    sub = lambda p, q: [col(a) - col(b) for a, b in zip(p, q, strict=True)]
    e1, e2, d1, d2 = sub(corners[1], corners[0]), sub(corners[2], corners[0]), sub(uvs[1], uvs[0]), sub(uvs[2], uvs[0])
    det = d1[0] * d2[1] - d1[1] * d2[0]
    none = F.abs(det) < 1e-6
    out = []
    for one, two, default in ((d2[1], d1[1], (1.0, 0.0, 0.0)), (d1[0], d2[0], (0.0, 1.0, 0.0))):
        v = [one * a - two * b for a, b in zip(e1, e2, strict=True)] if default[0] else [one * b - two * a for a, b in zip(e1, e2, strict=True)]
        norm = F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
        out.append(([F.when(none, d).otherwise(c / F.nullif(norm, F.lit(0.0))) for c, d in zip(v, default, strict=True)], F.when(none, F.lit(1e6)).otherwise(norm / F.nullif(det, F.lit(0.0)))))
    return out[0][0], out[1][0], [out[0][1], out[1][1]]
