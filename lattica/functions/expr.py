"""Column functions: curves, integer arithmetic, packing, sampling, colour, schedules."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Masks that leave two free bits after each of 10 bits.
SPREAD = ((16, 0x30000FF), (8, 0x300F00F), (4, 0x30C30C3), (2, 0x9249249))


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floordiv(a: str | Column, b: int) -> Column:
    """Floor division of whole numbers, also below zero."""
    a = col(a).cast("long")
    return ((a - F.pmod(a, F.lit(b))) / b).cast("long")


def spread3(v: str | Column) -> Column:
    out = col(v).cast("long").bitwiseAND(1023)
    for shift, mask in SPREAD:
        out = out.bitwiseOR(F.shiftleft(out, shift)).bitwiseAND(mask)
    return out


def gather3(v: str | Column) -> Column:
    out = col(v).cast("long").bitwiseAND(SPREAD[-1][1])
    for shift, mask in zip((2, 4, 8, 16), (0x30C30C3, 0x300F00F, 0x30000FF, 0x3FF), strict=True):
        out = out.bitwiseOR(F.shiftright(out, shift)).bitwiseAND(mask)
    return out


def zorder(x, y, z, permute: tuple[int, int, int] = (0, 1, 2)) -> Column:
    """z-order code of three 10-bit coordinates, taken in the order ``permute``."""
    c = [(x, y, z)[k] for k in permute]
    return spread3(c[0]) * 4 + spread3(c[1]) * 2 + spread3(c[2])


def zorder_back(code, permute: tuple[int, int, int] = (0, 1, 2)) -> list[Column]:
    """x, y, z of a z-order code."""
    c = [gather3(F.shiftright(col(code), 2)), gather3(F.shiftright(col(code), 1)), gather3(code)]
    return [c[permute.index(k)] for k in range(3)]


def linear(digits: list[tuple[str | Column, int]]) -> Column:
    """Mixed-radix number of (digit, radix) pairs, most significant first."""
    out = F.lit(0).cast("long")
    for digit, radix in digits:
        out = out * radix + col(digit).cast("long")
    return out


def linear_back(code: str | Column, radices: list[int]) -> list[Column]:
    out, rest = [], col(code)
    for radix in radices[::-1]:
        out.append(F.pmod(rest, F.lit(radix)))
        rest = floordiv(rest, radix)
    return out[::-1]


def quantised(v) -> Column:
    """0..1 to 0..255, truncated."""
    return F.floor(F.least(F.greatest(col(v), F.lit(0.0)), F.lit(1.0)) * 255).cast("int")


def packed_flags(a, b, c) -> Column:
    return col(a).cast("int") + col(b).cast("int") * 2 + col(c).cast("int") * 4


def unpacked_flags(v) -> list[Column]:
    return [F.shiftright(col(v), k).bitwiseAND(1) == 1 for k in range(3)]


def wrapped(i, n: int, mode: str) -> Column:
    """Texel number under a texture's wrap mode."""
    i = col(i).cast("long")
    if mode == "repeat":
        return F.pmod(i, F.lit(n))
    if mode == "clamp":
        return F.least(F.greatest(i, F.lit(0)), F.lit(n - 1))
    folded = F.pmod(i, F.lit(2 * n))
    return F.when(folded < n, folded).otherwise(2 * n - 1 - folded)


def standardised(values, mean: list[float], std: list[float]) -> Column:
    stats = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(s).alias("s")) for m, s in zip(mean, std, strict=True)])
    return F.zip_with(values, stats, lambda v, t: (v - t["m"]) / t["s"])


def unstandardised(values, mean: list[float], std: list[float]) -> Column:
    stats = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(s).alias("s")) for m, s in zip(mean, std, strict=True)])
    return F.zip_with(values, stats, lambda v, t: v * t["s"] + t["m"])


def radical_inverse(n, base: int, digits: int = 24) -> Column:
    """The digits of n in ``base``, mirrored at the point."""
    n = col(n).cast("long")
    terms = F.transform(F.sequence(F.lit(0), F.lit(digits - 1)), lambda k: F.pmod(F.floor(n / F.pow(F.lit(float(base)), k)), F.lit(base)) / F.pow(F.lit(float(base)), k + 1))
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)


def hammersley(i, n: int) -> tuple[Column, Column]:
    return col(i) / float(n), radical_inverse(i, 2)


def on_sphere(u: Column, v: Column) -> tuple[Column, Column]:
    """Longitude and latitude of a point of the unit square, uniform on the sphere."""
    return u * (2 * math.pi), F.acos(1 - 2 * v) - math.pi / 2


def look_at(yaw, pitch, radius: float) -> list[Column]:
    """Camera position."""
    yaw, pitch = col(yaw), col(pitch)
    return [radius * F.sin(yaw) * F.cos(pitch), radius * F.cos(yaw) * F.cos(pitch), radius * F.sin(pitch)]


def focal(fov) -> Column:
    """Focal length for a field of view in radians, in units of the image width."""
    return 0.5 / F.tan(col(fov) / 2)


def schedule(t, rescale: float) -> Column:
    """Warped time step r*t / (1 + (r-1)*t)."""
    return rescale * col(t) / (1 + (rescale - 1) * col(t))


def diffused(x0, noise, t, sigma: float = 1e-5) -> Column:
    return (1 - col(t)) * col(x0) + (sigma + (1 - sigma) * col(t)) * col(noise)


def velocity(x0, noise, sigma: float = 1e-5) -> Column:
    return (1 - sigma) * col(noise) - col(x0)


def x0_from_velocity(xt, v, t, sigma: float = 1e-5) -> Column:
    return (1 - sigma) * col(xt) - (sigma + (1 - sigma) * col(t)) * col(v)


def guided(positive, negative, t, strength: float, interval: tuple[float, float]) -> Column:
    """Blend of a conditional and an unconditional value while t lies in the interval, else the conditional one."""
    mix = strength * col(positive) + (1 - strength) * col(negative)
    return F.when((col(t) >= interval[0]) & (col(t) <= interval[1]), mix).otherwise(col(positive))


def velocity_to_noise(xt, v, t) -> Column:
    return col(xt) + (1 - col(t)) * col(v)


def x0_from_noise(xt, noise, t, sigma: float = 1e-5) -> Column:
    return (col(xt) - (sigma + (1 - sigma) * col(t)) * col(noise)) / F.nullif(1 - col(t), F.lit(0.0))


def velocity_from_x0(xt, x0, t, sigma: float = 1e-5) -> Column:
    return ((1 - sigma) * col(xt) - col(x0)) / (sigma + (1 - sigma) * col(t))


def once(value, body) -> Column:
    """``body`` of a value that is computed once a row: what a lambda refers to is else computed for each of its elements."""
    return F.transform(F.array(value), body)[0]


def deviation(values) -> Column:
    """Sample standard deviation of an array."""
    mean = lambda v: F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.size(v)
    about = lambda v, m: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + (x - m) * (x - m)) / (F.size(v) - 1))
    return once(values, lambda v: once(mean(v), lambda m: about(v, m)))


def rescaled_guidance(xt, positive, negative, t, strength: float, rescale: float, sigma: float = 1e-5) -> Column:
    """Array of guided velocities, with the spread of the guided sample drawn by ``rescale`` to that of the conditional one."""
    mixed = F.zip_with(positive, negative, lambda p, n: strength * p + (1 - strength) * n)
    one, two = (F.zip_with(xt, v, lambda x, y: x0_from_velocity(x, y, t, sigma)) for v in (positive, mixed))
    gain = lambda g: rescale * deviation(one) / F.nullif(deviation(g), F.lit(0.0)) + (1 - rescale)
    drawn = lambda g, s: F.zip_with(xt, g, lambda x, x0: velocity_from_x0(x, x0 * s, t, sigma))
    return once(two, lambda g: once(gain(g), lambda s: drawn(g, s)))


def uniform(key, seed: int) -> Column:
    """A number in [0, 1) from the key and the seed alone: the same wherever and however often the row is computed."""
    digest = F.md5(F.concat_ws(":", col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def logit_normal(key, seed: int, mean: float = 0.0, std: float = 1.0) -> Column:
    """The logistic function of a normal number, by Box and Muller."""
    z = F.sqrt(-2 * F.ln(1 - uniform(key, seed))) * F.cos(2 * math.pi * uniform(key, seed + 1))
    return 1 / (1 + F.exp(-(mean + std * z)))


def relu(x) -> Column:
    return F.greatest(col(x), F.lit(0.0))


def silu(x) -> Column:
    return col(x) / (1 + F.exp(-col(x)))


def gelu(x) -> Column:
    """By its usual approximation with the hyperbolic tangent."""
    x = col(x)
    return x / 2 * (1 + F.tanh(math.sqrt(2 / math.pi) * (x + 0.044715 * x * x * x)))


def patched(cell, side: int, patch: int) -> tuple[Column, Column]:
    """(coarse cell, place in the patch) of a cell of a cube of ``side``, both numbered with x highest."""
    axes = linear_back(cell, [side] * 3)
    return linear([(floordiv(a, patch), side // patch) for a in axes]), linear([(F.pmod(a, F.lit(patch)), patch) for a in axes])


def unpatched(coarse, place, side: int, patch: int) -> Column:
    one, two = linear_back(coarse, [side // patch] * 3), linear_back(place, [patch] * 3)
    return linear([(a * patch + b, side) for a, b in zip(one, two, strict=True)])


def tile_rect(low, high, tile: int, tiles: int) -> tuple[Column, Column]:
    """First tile and the one behind the last of a pixel range, within the grid; division drops what is behind the point."""
    clamp = lambda v: F.least(F.greatest((v / tile).cast("int"), F.lit(0)), F.lit(tiles))
    return clamp(col(low)), clamp(col(high) + tile - 1)


def alpha(mode, a, cutoff) -> Column:
    """Alpha under a material's mode; the cutoff itself is opaque."""
    return F.when(col(mode) == "OPAQUE", 1.0).when(col(mode) == "MASK", F.when(col(a) < col(cutoff), 0.0).otherwise(1.0)).otherwise(col(a))


def aces(x) -> Column:
    """Filmic tone map (a published fit), clamped to 0..1."""
    x = col(x)
    return F.least(F.greatest((x * (2.51 * x + 0.03)) / (x * (2.43 * x + 0.59) + 0.14), F.lit(0.0)), F.lit(1.0))


def gamma(x) -> Column:
    return F.pow(F.greatest(col(x), F.lit(0.0)), F.lit(1 / 2.2))


def power_of_two(n) -> Column:
    n = col(n).cast("long")
    return (n > 0) & (n.bitwiseAND(n - 1) == 0)


def nearest_power_of_two(n) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.round(F.log2(col(n).cast("double"))).cast("int"))


def warm_up(step, steps: int) -> Column:
    return F.when(col(step) < steps, (col(step) + 1) / float(steps)).otherwise(1.0)


def within(a, b, absolute: float, relative: float) -> Column:
    return F.abs(col(a) - col(b)) <= absolute + relative * F.abs(col(b))


def positions(t, size: int, period: float = 10000.0) -> Column:
    """Sinusoidal embedding of t: cosines, then sines."""
    half = size // 2
    angles = F.transform(F.sequence(F.lit(0), F.lit(half - 1)), lambda k: col(t) * F.exp(-math.log(period) * k / half))
    return F.concat(F.transform(angles, F.cos), F.transform(angles, F.sin))


def rotated(pairs, angle) -> Column:
    """Array of (re, im) pairs laid flat, each pair turned by ``angle`` over its number and one."""
    n = F.size(pairs) / 2
    turn = lambda k: col(angle) / (k + 1)
    return F.flatten(
        F.transform(
            F.sequence(F.lit(0), n.cast("int") - 1),
            lambda k: F.array(
                F.get(pairs, 2 * k) * F.cos(turn(k)) - F.get(pairs, 2 * k + 1) * F.sin(turn(k)),
                F.get(pairs, 2 * k) * F.sin(turn(k)) + F.get(pairs, 2 * k + 1) * F.cos(turn(k)),
            ),
        )
    )


def slab(origin: list, direction: list, low: list[float], high: list[float]) -> tuple[Column, Column]:
    """Entry and exit of a ray through a box; a direction of 0 counts as a slope of 1e10."""
    near, far = [], []
    for o, d, a, b in zip(origin, direction, low, high, strict=True):
        inv = F.when(col(d) == 0, 1e10).otherwise(1 / col(d))
        one, two = (a - col(o)) * inv, (b - col(o)) * inv
        near.append(F.least(one, two))
        far.append(F.greatest(one, two))
    return F.greatest(*near), F.least(*far)


def _turn(p: list[np.ndarray], q: int, i: int) -> None:
    """One step of Skilling's transform (2004) at bit q: invert the low bits of p0, or exchange them with those of p[i]."""
    set_ = (p[i] & q) != 0
    t = np.where(set_, 0, (p[0] ^ p[i]) & (q - 1))
    p[0] = np.where(set_, p[0] ^ (q - 1), p[0] ^ t)
    if i:
        p[i] = p[i] ^ t


def hilbert(x, y, z, bits: int = 10) -> Column:
    """Hilbert code of three coordinates of ``bits`` bits (20 at most), by Skilling's transform: turn, Gray code, interleave.
    Its steps depend on those before, so it runs over Arrow batches in NumPy."""

    @F.pandas_udf("long")
    def code(x: pd.Series, y: pd.Series, z: pd.Series) -> pd.Series:
        p = [v.to_numpy(dtype=np.int64, na_value=0) for v in (x, y, z)]
        for k in range(bits - 1, 0, -1):
            for i in range(3):
                _turn(p, 1 << k, i)
        p[1] = p[1] ^ p[0]
        p[2] = p[2] ^ p[1]
        t = np.zeros_like(p[0])
        for k in range(bits - 1, 0, -1):
            t = np.where((p[2] >> k) & 1, t ^ ((1 << k) - 1), t)
        out = np.zeros_like(t)
        for k in range(bits):
            for i, v in enumerate(p):  # the first coordinate is the highest bit of each three
                out = out | (((v ^ t) >> k) & 1) << (3 * k + 2 - i)
        return pd.Series(out)

    return F.when(col(x).isNotNull() & col(y).isNotNull() & col(z).isNotNull(), code(col(x), col(y), col(z)))


def hilbert_back(code, bits: int = 10) -> Column:
    """Struct p0, p1, p2 of the coordinates of a Hilbert code."""

    @F.pandas_udf("p0 int, p1 int, p2 int")
    def point(code: pd.Series) -> pd.DataFrame:
        c = code.to_numpy(dtype=np.int64, na_value=0)
        p = [sum(((c >> (3 * k + place)) & 1) << k for k in range(bits)) for place in (2, 1, 0)]
        t = p[2] >> 1
        p[2] = p[2] ^ p[1]
        p[1] = p[1] ^ p[0]
        p[0] = p[0] ^ t
        for k in range(1, bits):
            for i in (2, 1, 0):
                _turn(p, 1 << k, i)
        return pd.DataFrame({f"p{i}": v.astype(np.int32) for i, v in enumerate(p)})

    return F.when(col(code).isNotNull(), point(col(code)))


def centre(axis, size: float, origin: float) -> Column:
    """Middle of a voxel."""
    return (col(axis) + 0.5) * size + origin


def barycentric(p: list, a: list, b: list, c: list) -> list[Column]:
    """Weights of the corners a, b, c at the point of their plane that is nearest to p; null for a flat triangle."""
    sub = lambda u, v: [col(m) - col(n) for m, n in zip(u, v, strict=True)]
    dot = lambda u, v: u[0] * v[0] + u[1] * v[1] + u[2] * v[2]
    e, f, g = sub(b, a), sub(c, a), sub(p, a)
    ee, ef, ff, ge, gf = dot(e, e), dot(e, f), dot(f, f), dot(g, e), dot(g, f)
    area = F.nullif(ee * ff - ef * ef, F.lit(0.0))
    v, w = (ff * ge - ef * gf) / area, (ee * gf - ef * ge) / area
    return [1 - v - w, v, w]


def perspective(fx: Column, fy: Column, near: float, far: float) -> Column:
    """Projection matrix, rows first, depth to 0..1."""
    zero = F.lit(0.0)
    rows = [[2 * fx, zero, zero, zero], [zero, 2 * fy, zero, zero], [zero, zero, F.lit(far / (far - near)), F.lit(-near * far / (far - near))], [zero, zero, F.lit(1.0), zero]]
    return F.array(*[F.array(*r) for r in rows])


def angle_between(u: list[Column], v: list[Column]) -> Column:
    dot = u[0] * v[0] + u[1] * v[1] + u[2] * v[2]
    size = F.sqrt((u[0] * u[0] + u[1] * u[1] + u[2] * u[2]) * (v[0] * v[0] + v[1] * v[1] + v[2] * v[2]))
    return F.acos(F.least(F.greatest(dot / F.nullif(size, F.lit(0.0)), F.lit(-1.0)), F.lit(1.0)))


def modulated(x, scale, shift) -> Column:
    return col(x) * (1 + col(scale)) + col(shift)
