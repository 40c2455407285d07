"""Images as pixel tables: structural similarity by tiles, render losses, colours of features."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.functions.expr import floordiv
from lattica.operators.numbering import unused

#: Fixed values of the published index: the window's width and spread, and the two constants for values in 0..1.
WIDTH, SPREAD, C1, C2 = 11, 1.5, 0.01**2, 0.03**2
TILE = 64


def window() -> np.ndarray:
    w = np.exp(-((np.arange(WIDTH) - WIDTH // 2) ** 2) / (2 * SPREAD**2))
    return w / w.sum()


def ssim(pixels: DataFrame, image: list[str], one: str, two: str, tile: int = TILE) -> DataFrame:
    """(image, y, x, ssim) of the pixels (image columns, y, x) of two pictures ``one`` and ``two``: the similarity of their
    Gaussian windows. What is outside a picture, missing or null counts as 0.

    A pixel goes to its tile and to the tiles whose windows reach it, two to four at most, and each tile is smoothed on its
    own, rows first and then columns; so a picture of any size is many tasks, each with one tile."""
    half = WIDTH // 2
    rows = pixels.select(*image, "y", "x", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(n) for c, n in ((one, "one"), (two, "two"))])
    for a in ("y", "x"):
        rows = rows.withColumn(f"t{a}", F.explode(F.sequence(floordiv(F.col(a) - half, tile), floordiv(F.col(a) + half, tile))))
    wide, weights = tile + 2 * half, window()
    band = np.zeros((tile, wide))
    for k in range(tile):
        band[k, k : k + WIDTH] = weights

    def smoothed(group: pa.Table) -> pa.Table:
        ty, tx = group.column("ty")[0].as_py(), group.column("tx")[0].as_py()
        y, x = group.column("y").to_numpy() - ty * tile + half, group.column("x").to_numpy() - tx * tile + half
        p, q = np.zeros((wide, wide)), np.zeros((wide, wide))
        p[y, x], q[y, x] = group.column("one").to_numpy(), group.column("two").to_numpy()
        mean = lambda v: band @ v @ band.T
        mp, mq = mean(p), mean(q)
        vp, vq, both = mean(p * p) - mp * mp, mean(q * q) - mq * mq, mean(p * q) - mp * mq
        index = (2 * mp * mq + C1) * (2 * both + C2) / ((mp * mp + mq * mq + C1) * (vp + vq + C2))
        own = np.flatnonzero((y >= half) & (y < tile + half) & (x >= half) & (x < tile + half))
        return group.select([*image, "y", "x"]).take(pa.array(own)).append_column("ssim", pa.array(index[y[own] - half, x[own] - half]))

    kinds = dict(pixels.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in (*image, "y", "x"))
    return rows.groupBy(*image, "ty", "tx").applyInArrow(smoothed, f"{schema}, ssim double")


def render_losses(predicted: DataFrame, truth: DataFrame, image: list[str], weights: dict[str, float]) -> DataFrame:
    """(image, mask, depth, normal_l1, normal_ssim, loss) of renders as pixel rows (image columns, y, x, mask, depth, normal_0..2):
    mean absolute differences, 1 less the mean similarity of the normals' channels, and their sum by ``weights`` (mask, depth,
    normal, ssim: the last within the normal's). Pixels that one side lacks count as 0 there."""
    keys, values = [*image, "y", "x"], ["mask", "depth", *[f"normal_{k}" for k in range(3)]]
    side = lambda df, n: df.select(*keys, *[F.col(v).alias(f"{n}_{v}") for v in values])
    met = side(predicted, "p").join(side(truth, "t"), keys, "full").fillna(0.0)
    apart = {v: F.abs(F.col(f"p_{v}") - F.col(f"t_{v}")) for v in values}
    means = met.groupBy(*image).agg(F.avg(apart["mask"]).alias("mask"), F.avg(apart["depth"]).alias("depth"), F.avg((apart["normal_0"] + apart["normal_1"] + apart["normal_2"]) / 3).alias("normal_l1"))
    channels = met.select(*keys, F.inline(F.array(*[F.struct(F.lit(k).alias("channel"), F.col(f"p_normal_{k}").alias("p"), F.col(f"t_normal_{k}").alias("t")) for k in range(3)])))
    alike = ssim(channels, [*image, "channel"], "p", "t").groupBy(*image).agg((1 - F.avg("ssim")).alias("normal_ssim"))
    loss = weights["mask"] * F.col("mask") + weights["depth"] * F.col("depth") + weights["normal"] * (F.col("normal_l1") + weights["ssim"] * F.col("normal_ssim"))
    return means.join(alike, image).withColumn("loss", loss)


def main_axes(rows: DataFrame, features: str, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first right singular vectors of the rows' features, uncentred, and all singular values. Tasks sum the products of
    features; the driver gets one matrix a partition's sum, of features x features, whatever the rows. A vector points to
    where its component of greatest size is positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            column = batch.column(features)
            if len(column):
                x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["i", "v"])

    valid = rows.filter(F.col(features).isNotNull()).select(F.col(features).cast("array<double>").alias(features))
    found = valid.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    size = math.isqrt(len(found))
    gram = np.zeros(size * size)
    for i, v in found:
        gram[i] = v
    values, vectors = np.linalg.eigh(gram.reshape(size, size))
    vectors = vectors[:, ::-1][:, :count]
    signs = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])]) if size else np.zeros(0)
    return vectors * signs, np.sqrt(np.maximum(values[::-1], 0))


def feature_colours(rows: DataFrame, features: str, channels: tuple[int, int, int] = (0, 1, 2)) -> DataFrame:
    """Adds ``colour``: the rows' places along the given main axes of all features (arrays of one length), each scaled to 0..1
    between the least and the greatest; null where the features are."""
    axes, _ = main_axes(rows, features, max(channels) + 1)
    if not axes.size:
        return rows.withColumn("colour", F.lit(None).cast("array<double>"))
    along, low = unused(rows, "along"), unused(rows, "bounds")
    x = F.col(features).cast("array<double>")
    place = lambda k: F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in axes[:, k]]), lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)
    placed = rows.withColumn(along, F.when(F.col(features).isNotNull(), F.array(*map(place, channels))))
    ends = placed.agg(F.array(*[F.min(F.col(along)[k]) for k in range(3)]).alias("least"), F.array(*[F.max(F.col(along)[k]) for k in range(3)]).alias("most")).select(F.struct("least", "most").alias(low))
    scaled = [(F.col(along)[k] - F.col(low)["least"][k]) / F.nullif(F.col(low)["most"][k] - F.col(low)["least"][k], F.lit(0.0)) for k in range(3)]
    return placed.join(F.broadcast(ends)).withColumn("colour", F.when(F.col(along).isNotNull(), F.array(*scaled))).drop(along, low)
