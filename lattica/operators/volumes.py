"""Textured meshes as voxel attributes: cells that triangles cross, their texture samples, and weighted means by cell."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.functions.expr import alpha
from lattica.operators.geometry import AXES, CORNERS, crossed_cells, line_crossings
from lattica.operators.numbering import fixed

NORMALS = [f"n{a}{k}" for k in range(3) for a in AXES]
UVS = [f"{a}{k}" for k in range(3) for a in "st"]
#: Textures of a material, and their channels.
SLOTS = {"base": 3, "metallic": 1, "roughness": 1, "emissive": 3, "alpha": 1, "normal": 3}
CHANNELS = ["c0", "c1", "c2"]
#: Texture coordinates of less area than this (twice a triangle's) have no tangents, and a footprint of this length.
LEAST_AREA, NO_LENGTH = 1e-6, 1e6
PLACE = ["weight", "u", "v", "length", *[f"{v}{a}" for v in "ntb" for a in AXES]]


def byte_mipmaps(texels: DataFrame, largest: int) -> DataFrame:
    """(tex, level, ty, tx, c0, c1, c2): whole-number textures (tex, ty, tx, c0..c2), squares of a power of two up to
    ``largest``, as level 0, and above it the means of 2x2 texels, rounded down."""
    levels = now = texels.select("tex", F.lit(0).alias("level"), "ty", "tx", *[F.col(c).cast("int").alias(c) for c in CHANNELS])
    for level in range(1, largest.bit_length()):
        half = [F.shiftright(c, 1).alias(c) for c in ("ty", "tx")]
        four = now.groupBy("tex", *half).agg(F.count("*").alias("n"), *[F.floor(F.sum(c) / 4).cast("int").alias(c) for c in CHANNELS])
        now = four.filter("n = 4").select("tex", F.lit(level).alias("level"), "ty", "tx", *CHANNELS)
        levels = levels.unionByName(now)
    return levels


def placed(cells: np.ndarray, corners: np.ndarray, normals: np.ndarray, uvs: np.ndarray) -> np.ndarray:
    """The columns PLACE for cells (n x 3) and their triangles: 1 less the signed distance of the cell's middle from the plane, the
    texture coordinates and the mean normal at the foot on the plane, the length of the texture that a cell spans, and the
    texture's tangents. Weights of corners aren't held within the triangle."""
    a, e, f = corners[:, 0], corners[:, 1] - corners[:, 0], corners[:, 2] - corners[:, 0]
    dot = lambda p, q: (p * q).sum(axis=1)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    n = unit(np.cross(e, f))
    middle = cells + 0.5 - a
    distance = dot(middle, n)
    g = middle - distance[:, None] * n
    ee, ef, ff, ge, gf = dot(e, e), dot(e, f), dot(f, f), dot(g, e), dot(g, f)
    area = ee * ff - ef * ef
    v, w = (ff * ge - ef * gf) / area, (ee * gf - ef * ge) / area
    share = np.stack([1 - v - w, v, w], axis=1)
    uv, normal = ((share[:, :, None] * x).sum(axis=1) for x in (uvs, normals))
    d, h = uvs[:, 1] - uvs[:, 0], uvs[:, 2] - uvs[:, 0]
    det = d[:, 0] * h[:, 1] - d[:, 1] * h[:, 0]
    none = (np.abs(det) < LEAST_AREA)[:, None]
    tangent, other = h[:, 1:] * e - d[:, 1:] * f, d[:, :1] * f - h[:, :1] * e
    lengths = np.prod([np.linalg.norm(t, axis=1) for t in (tangent, other)], axis=0) / np.where(none[:, 0], 1, det) ** 2
    length = 1 / np.sqrt(np.where(none[:, 0], NO_LENGTH**2, lengths))
    t, b = (np.where(none, default, unit(x)) for x, default in ((tangent, (1.0, 0.0, 0.0)), (other, (0.0, 1.0, 0.0))))
    return np.concatenate([(1 - distance)[:, None], uv, length[:, None], normal, t, b], axis=1)


def in_texture(i: np.ndarray, size: np.ndarray, wrap: np.ndarray) -> np.ndarray:
    """Texel numbers under ``repeat``, ``clamp`` or ``mirror``."""
    folded = np.mod(i, 2 * size)
    return np.select([wrap == "clamp", wrap == "mirror"], [np.clip(i, 0, size - 1), np.where(folded < size, folded, 2 * size - 1 - folded)], np.mod(i, size))


def taps(u: np.ndarray, v: np.ndarray, length: np.ndarray, size: np.ndarray, linear: np.ndarray, wrap: np.ndarray, offset: float) -> tuple[np.ndarray, ...]:
    """(row, level, ty, tx, weight) of the texels that samples are made of: the nearest one; or four of level 0, of the last
    level, or of each of the two levels around log2(length * size) + offset. Rows of a texture run against v."""
    with np.errstate(divide="ignore", invalid="ignore"):
        wanted = np.log2(length * size) + offset
    top = np.log2(size).astype(np.int64)
    level = np.where(np.isfinite(wanted), np.clip(wanted, 0, top), 0.0)
    low = np.floor(level).astype(np.int64)
    found = []
    each = np.arange(len(u))
    near = each[~linear]
    if len(near):
        n = size[near]
        found.append((near, np.zeros(len(near), dtype=np.int64), *(in_texture(np.floor(x).astype(np.int64), n, wrap[near]) for x in ((1 - v[near]) * n, u[near] * n)), np.ones(len(near))))
    for up, part in ((0, 1 - (level - low)), (1, level - low)):
        rows = each[linear & (part > 0)]
        at = np.minimum(low[rows] + up, top[rows])
        n = size[rows] >> at
        x, y = u[rows] * n - 0.5, (1 - v[rows]) * n - 0.5
        left, above = np.floor(x).astype(np.int64), np.floor(y).astype(np.int64)
        for dx in (0, 1):
            for dy in (0, 1):
                weight = np.where(dx, x - left, 1 - (x - left)) * np.where(dy, y - above, 1 - (y - above)) * part[rows]
                found.append((rows, at, in_texture(above + dy, n, wrap[rows]), in_texture(left + dx, n, wrap[rows]), weight))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else tuple(np.zeros(0) for _ in range(5))


def crossings_placed(triangles: DataFrame, size: int) -> DataFrame:
    """(fid, mid, x, y, z, PLACE): each triangle with each cell at whose border it crosses a grid line, once."""
    cells = crossed_cells(line_crossings(triangles.select("fid", *CORNERS)), size).select("fid", *AXES).distinct()
    met = cells.join(triangles.select("fid", "mid", *CORNERS, *NORMALS, *UVS), "fid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda names, *shape: np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names], axis=1).reshape(-1, *shape)  # noqa: E731, B023
            out = placed(get(AXES, 3), get(CORNERS, 3, 3), get(NORMALS, 3, 3), get(UVS, 3, 2))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("fid", "mid", *AXES)), *(pa.array(np.ascontiguousarray(c)) for c in out.T)], ["fid", "mid", *AXES, *PLACE])

    kinds = dict(triangles.dtypes)
    return met.mapInArrow(run, f"fid {kinds['fid']}, mid {kinds['mid']}, x int, y int, z int, " + ", ".join(f"{c} double" for c in PLACE))


def sampled(rows: DataFrame, slots: DataFrame, texels: DataFrame, offset: float = 0.0) -> DataFrame:
    """(fid, x, y, z, <slot>_<channel>): samples between 0 and 1 of the textures that the rows' materials have. Each texel that a
    sample needs is one row, joined with the textures' levels on equality."""
    met = rows.select("fid", *AXES, "mid", "u", "v", "length").join(slots, "mid").withColumn("wrap", F.lower("wrap"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, length, size, linear, wrap = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("u", "v", "length", "size", "linear", "wrap"))
            row, level, ty, tx, weight = taps(u, v, length, size.astype(np.int64), linear.astype(bool), wrap.astype(str), offset)
            row = pa.array(row.astype(np.int64))
            new = [*(pa.array(c.astype(np.int32)) for c in (level, ty, tx)), pa.array(weight.astype(float))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(row) for c in ("fid", *AXES, "slot", "tex")), *new], ["fid", *AXES, "slot", "tex", "level", "ty", "tx", "w"])

    kinds = {**dict(rows.dtypes), **dict(slots.dtypes)}
    at = met.mapInArrow(run, f"fid {kinds['fid']}, x int, y int, z int, slot string, tex {kinds['tex']}, level int, ty int, tx int, w double")
    hit = at.join(texels, ["tex", "level", "ty", "tx"])
    values = [F.sum(F.when(F.col("slot") == s, F.col("w") * F.col(f"c{k}") / 255)).alias(f"{s}_{k}") for s, n in SLOTS.items() for k in range(n)]
    return hit.groupBy("fid", *AXES).agg(*values)


ATTRIBUTES = [*(f"base_{k}" for k in range(3)), "metallic", "roughness", *(f"emissive_{k}" for k in range(3)), "alpha", *(f"normal_{k}" for k in range(3))]


def volumetric(triangles: DataFrame, materials: DataFrame, slots: DataFrame, texels: DataFrame, size: int, offset: float = 0.0) -> DataFrame:
    """(x, y, z, n, base_0..2, metallic, roughness, emissive_0..2, alpha, normal_0..2): a textured mesh as voxels of edge 1 in a
    grid of ``size`` cells an axis.

    ``triangles``: fid, mid, corners x0..z2, normals nx0..nz2 and texture coordinates s0..t2 of the corners. ``materials``: mid,
    factors base_0..2, metallic, roughness, emissive_0..2, alpha, mode (OPAQUE, MASK, BLEND) and cutoff. ``slots``: mid, slot
    (a name of SLOTS), tex, size, linear, wrap (repeat, clamp, mirror). ``texels``: levels of the textures, as byte_mipmaps()
    gives them; a texture is in the levels that its samples ask for.

    A cell is met by the triangles that cross a grid line at its border. Each gives it the samples at the foot of its middle on
    the triangle's plane, times the material's factors; without a texture the factor alone, and for the normal the mean of the
    corners'. The cell gets the mean by weight 1 less the signed distance from the plane, in the grid's units; a sum of weights
    of 0 gives nulls. Every texture has mip levels of its own, the emissive one as well."""
    rows = fixed(crossings_placed(triangles, size))
    colours = sampled(rows, slots, texels, offset).withColumnsRenamed({f"{s}_{k}": f"s_{s}_{k}" for s, n in SLOTS.items() for k in range(n)})
    factors = materials.withColumnsRenamed({c: f"f_{c}" for c in materials.columns if c != "mid"})
    met = rows.join(colours, ["fid", *AXES], "left").join(factors, "mid")
    one = F.lit(1.0)
    sample = lambda s, k=0: F.coalesce(F.col(f"s_{s}_{k}"), one)
    out = {f"{s}_{k}": sample(s, k) * F.col(f"f_{s}_{k}") for s in ("base", "emissive") for k in range(3)}
    out |= {s: sample(s) * F.col(f"f_{s}") for s in ("metallic", "roughness")}
    out["alpha"] = alpha("f_mode", sample("alpha") * F.col("f_alpha"), "f_cutoff")
    bent = [sum(((2 * F.col(f"s_normal_{k}") - 1) * F.col(f"{v}{a}") for k, v in ((1, "b"), (2, "n"))), (2 * F.col("s_normal_0") - 1) * F.col(f"t{a}")) for a in AXES]
    met = met.withColumns({f"m{a}": c for a, c in zip(AXES, bent, strict=True)})
    norm = F.nullif(F.sqrt(F.col("mx") * F.col("mx") + F.col("my") * F.col("my") + F.col("mz") * F.col("mz")), F.lit(0.0))
    out |= {f"normal_{k}": F.when(F.col("s_normal_0").isNull(), F.col(f"n{a}")).otherwise(F.coalesce(F.col(f"m{a}") / norm, F.lit(0.0))) for k, a in enumerate(AXES)}
    total = F.nullif(F.sum("weight"), F.lit(0.0))
    return met.withColumns(out).groupBy(*AXES).agg(F.count("*").alias("n"), *[(F.sum(F.col(c) * F.col("weight")) / total).alias(c) for c in ATTRIBUTES])
