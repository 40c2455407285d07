"""Voxels seen by a perspective camera: boxes dealt to screen tiles, and the first one hit at each pixel."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AXES = ("x", "y", "z")
#: Voxels with their centre nearer to the camera than this along its axis aren't drawn; what is added to w.
NEAR, TINY = 0.2, 1e-7
TILE = 16
#: Boxes of a tile that are tested against its pixels at once, and boxes of a tile that one task works through.
TESTED, PART = 64, 1 << 20


@dataclass(frozen=True)
class Camera:
    """``view``: rows of the 4x4 matrix from world to camera; focal lengths and centre in shares of the picture."""

    view: tuple[tuple[float, ...], ...]
    width: int
    height: int
    fx: float = 1.0
    fy: float = 1.0
    cx: float = 0.5
    cy: float = 0.5

    @property
    def projection(self) -> np.ndarray:
        """Rows for x, y and w of world points, as the picture's -1..1."""
        lens = np.array([[2 * self.fx, 0, 2 * self.cx - 1, 0], [0, 2 * self.fy, 1 - 2 * self.cy, 0], [0, 0, 1, 0]])
        return lens @ np.array(self.view)

    @property
    def origin(self) -> np.ndarray:
        return np.linalg.inv(np.array(self.view))[:3, 3]

    def rays(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Unit directions through the middles of pixels."""
        near = np.stack([(2 * (x + 0.5) / self.width - 1) * 0.5 / self.fx, (2 * (y + 0.5) / self.height - 1) * 0.5 / self.fy, np.ones(len(x))], axis=1)
        ways = near @ np.array(self.view)[:3, :3]
        return ways / np.linalg.norm(ways, axis=1, keepdims=True)


RECT = ["tx_low", "tx_high", "ty_low", "ty_high"]


def tile_rects(middles: np.ndarray, camera: Camera, size: float, tile: int) -> tuple[np.ndarray, np.ndarray]:
    """Depths of boxes along the camera's axis, and the tiles (first and behind the last, x then y) that the picture of their
    eight corners lies in, cut to the picture; none for boxes before the near plane."""
    depth = middles @ np.array(camera.view)[2, :3] + camera.view[2][3]
    places = []
    for i in (-0.5, 0.5):
        for j in (-0.5, 0.5):
            for k in (-0.5, 0.5):
                u, v, w = (camera.projection @ np.concatenate([middles + np.array([i, j, k]) * size, np.ones((len(middles), 1))], axis=1).T)
                w = 1 / (w + TINY)
                places.append(np.stack([(u * w + 1) * (0.5 * camera.width), (v * w + 1) * (0.5 * camera.height)]))
    places = np.trunc(np.clip(places, -(2.0**31), 2.0**31 - 1))
    pixels = np.array([camera.width, camera.height])[:, None]
    low, high = np.maximum(places.min(axis=0), 0), np.minimum(places.max(axis=0) + 1, pixels)
    seen = (low < high).all(axis=0) & (depth > NEAR)
    rect = np.stack([np.where(seen, low // tile, 0), np.where(seen, -(-high // tile), 0)], axis=1)  # axis, end, box
    return depth, rect.reshape(4, -1).astype(np.int32)


def dealt_to_tiles(voxels: DataFrame, camera: Camera, size: float, tile: int = TILE) -> DataFrame:
    """Voxels (id, x, y, z: their middles) with ``depth`` along the camera's axis, once for each tile (tx, ty) that the picture
    of their eight corners lies in; those behind the near plane or outside go."""
    rows = voxels.select("id", *[F.col(a).cast("double").alias(a) for a in AXES]).dropna(subset=list(AXES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth, rect = tile_rects(np.stack([batch.column(a).to_numpy() for a in AXES], axis=1), camera, size, tile)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(depth), *map(pa.array, rect)], ["id", *AXES, "depth", *RECT])

    rows = rows.mapInArrow(run, f"id {dict(voxels.dtypes)['id']}, x double, y double, z double, depth double, " + ", ".join(f"{c} int" for c in RECT)).filter("tx_low < tx_high and ty_low < ty_high")
    for t in ("tx", "ty"):
        rows = rows.withColumn(t, F.explode(F.sequence(F.col(f"{t}_low"), F.col(f"{t}_high") - 1)))
    return rows.select("tx", "ty", "id", "depth", *AXES)


def rasterised(voxels: DataFrame, camera: Camera, size: float, tile: int = TILE) -> DataFrame:
    """(py, px, id, distance): the voxel of edge ``size`` that each pixel shows, and how far along the ray it is entered. Of the
    voxels that a ray passes the one whose middle has the least depth counts, the least id among equals. Pixels that show
    nothing have no row.

    Boxes are sorted by tile and depth within partitions, and one pass a tile tests them in that order and skips the rest once
    all its pixels are hit; it holds a tile's pixels and some boxes. A tile of more than PART boxes is passed in several
    parts, whose pixels are merged by depth."""
    boxes = dealt_to_tiles(voxels, camera, size, tile)
    crowded = boxes.groupBy("tx", "ty").count().filter(F.col("count") > PART).select("tx", "ty", F.ceil(F.col("count") / PART).alias("parts"))
    parted = boxes.join(F.broadcast(crowded), ["tx", "ty"], "left")  # no more rows than the picture has tiles
    parted = parted.withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1)))).drop("parts")
    sorted_ = parted.repartition("tx", "ty", "part").sortWithinPartitions("tx", "ty", "part", "depth", "id")
    origin = camera.origin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pixels, rays, hit = None, None, None, None  # hit: (row of ids, depth, distance) by pixel

        def out() -> pa.RecordBatch:
            at = [k for k, h in enumerate(hit) if h is not None]
            columns = [pa.array(pixels[at, 1], pa.int32()), pa.array(pixels[at, 0], pa.int32()), pa.array([hit[k][0] for k in at], kind), *(pa.array([hit[k][i] for k in at], pa.float64()) for i in (1, 2))]
            return pa.RecordBatch.from_arrays(columns, ["py", "px", "id", "depth", "distance"])

        for batch in batches:
            kind = batch.schema.field("id").type
            keys = np.stack([batch.column(c).to_numpy() for c in ("tx", "ty", "part")], axis=1)
            middle, depth, ids = np.stack([batch.column(a).to_numpy() for a in AXES], axis=1), batch.column("depth").to_numpy(), batch.column("id")
            bounds = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for start, end in zip(bounds, bounds[1:], strict=False):
                if start == end:
                    continue
                key = tuple(keys[start].tolist())
                if key != now:
                    if now is not None:
                        yield out()
                    now = key
                    x, y = np.meshgrid(np.arange(key[0] * tile, min((key[0] + 1) * tile, camera.width)), np.arange(key[1] * tile, min((key[1] + 1) * tile, camera.height)))
                    pixels = np.stack([x.ravel(), y.ravel()], axis=1)
                    rays = camera.rays(pixels[:, 0], pixels[:, 1])
                    hit = [None] * len(pixels)
                for k in range(start, end, TESTED):
                    open_ = [i for i, h in enumerate(hit) if h is None]
                    if not open_:
                        break
                    at = slice(k, min(k + TESTED, end))
                    entry, leave = passed(origin, rays[open_], middle[at], size)
                    through = leave > entry
                    first = np.argmax(through, axis=1)
                    for i in np.flatnonzero(through.any(axis=1)):
                        row = k + int(first[i])
                        hit[open_[i]] = (ids[row].as_py(), float(depth[row]), float(entry[i, first[i]]))
        if now is not None:
            yield out()

    shown = sorted_.mapInArrow(run, f"py int, px int, id {dict(voxels.dtypes)['id']}, depth double, distance double")
    best = shown.groupBy("py", "px").agg(F.min(F.struct("depth", "id", "distance")).alias("best"))
    return best.select("py", "px", "best.id", "best.distance")


def passed(origin: np.ndarray, rays: np.ndarray, middles: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray]:
    """Entry and exit (rays x boxes) of rays through boxes; a direction of 0 counts as a slope of 1e10."""
    slope = np.where(rays == 0, 1e10, 1 / np.where(rays == 0, 1, rays))[:, None, :]
    one, two = ((middles[None, :, :] + d * size - origin) * slope for d in (-0.5, 0.5))
    return np.minimum(one, two).max(axis=2), np.maximum(one, two).min(axis=2)
