"""Delta filters over voxels of a chunk in z-order, and the way back."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lattica.operators.spatial import around, at_move

AXES = ("x", "y", "z")
#: Neighbours in the order in which a later one overrides an earlier one (fixed values).
NEIGHBOURS = [(1, 0, 0), (0, 1, 0), (0, 0, 1), (1, 1, 0), (1, 0, 1), (0, 1, 1), (1, 1, 1)]


def sibling_deltas(df: DataFrame, chunk: str, code: str, value: str, depth: int) -> DataFrame:
    """(chunk, code, delta): each leaf's byte less that of the first leaf of the subtree before its own under their common
    parent; the first leaf of a chunk keeps its byte. The subtree before is that of the leaf before, cut at the highest
    octree level at which the two differ."""
    order = Window.partitionBy(chunk).orderBy(code)
    rows = df.select(chunk, F.col(code).cast("long").alias(code), value).withColumn("_before", F.lag(code).over(order))
    differs = F.col(code).bitwiseXOR(F.col("_before"))
    level = F.aggregate(F.sequence(F.lit(0), F.lit(depth - 1)), F.lit(0), lambda a, k: F.when(F.call_function("shiftright", differs, k * 3) > 0, k).otherwise(a))
    rows = rows.withColumn("_level", F.when(F.col("_before").isNotNull(), level)).withColumn("_node", F.call_function("shiftright", F.col("_before"), F.col("_level") * 3))
    levels = df.select(chunk, F.col(code).cast("long").alias("_c"), F.col(value).alias("_v"), F.explode(F.sequence(F.lit(0), F.lit(depth - 1))).alias("_level"))
    firsts = levels.groupBy(chunk, "_level", F.call_function("shiftright", F.col("_c"), F.col("_level") * 3).alias("_node")).agg(F.min_by("_v", "_c").alias("_first"))
    return rows.join(firsts, [chunk, "_level", "_node"], "left").select(chunk, code, F.pmod(F.col(value) - F.coalesce("_first", F.lit(0)), F.lit(256)).cast("int").alias("delta"))


def sibling_values(df: DataFrame, chunk: str, code: str, delta: str, depth: int) -> DataFrame:
    """(chunk, code, value) from sibling_deltas(): a recurrence along the leaves of a chunk, one chunk at a time."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(code, ignore_index=True)
        codes, deltas = part[code].tolist(), part[delta].tolist()
        firsts: dict[tuple[int, int], int] = {}
        values = []
        for i, (c, d) in enumerate(zip(codes, deltas, strict=True)):
            base = 0
            if i:
                level = max(((c ^ codes[i - 1]).bit_length() - 1) // 3, 0)
                base = firsts[level, codes[i - 1] >> 3 * level]
            values.append((d + base) % 256)
            for level in range(depth):
                firsts.setdefault((level, c >> 3 * level), values[-1])
        return pd.DataFrame({chunk: part[chunk], code: codes, "value": values})

    kinds = dict(df.dtypes)
    return df.select(chunk, code, delta).groupBy(chunk).applyInPandas(run, f"{chunk} {kinds[chunk]}, {code} {kinds[code]}, value int")


def neighbour_deltas(df: DataFrame, value: str) -> DataFrame:
    """(b, x, y, z, delta): each voxel's byte less that of its last existing neighbour in the fixed order, within its ``b`` (a
    batch or a chunk); one shuffle."""
    back = [tuple(-d for d in move) for move in NEIGHBOURS]
    met = around(df.select("b", *AXES, value), back, [value], own=at_move(-1, value), p=F.max_by(value, F.when(F.col("k") >= 0, F.col("k"))))
    return met.select("b", *AXES, F.pmod(F.col("own") - F.coalesce("p", F.lit(0)), F.lit(256)).alias("delta"))


def neighbour_values(df: DataFrame, chunk: str, delta: str) -> DataFrame:
    """(chunk, x, y, z, value) from bytes less those of the last existing neighbour, one chunk at a time."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(list(AXES), ignore_index=True)
        found: dict[tuple[int, int, int], int] = {}
        for x, y, z, d in part[[*AXES, delta]].itertuples(index=False):
            base = 0
            for dx, dy, dz in NEIGHBOURS:
                base = found.get((x - dx, y - dy, z - dz), base)
            found[x, y, z] = (int(d) + base) % 256
        return part[[chunk, *AXES]].assign(value=list(found.values()))

    return df.select(chunk, *AXES, delta).groupBy(chunk).applyInPandas(run, f"{chunk} {dict(df.dtypes)[chunk]}, x int, y int, z int, value int")
