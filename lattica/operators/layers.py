"""Layers over feature arrays: norm over channels, linear maps, ragged sequences as padded arrays with masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def layer_norm(values: str | Column, weight: list[float] | None = None, bias: list[float] | None = None, eps: float = 1e-5) -> Column:
    """An array less its mean and over its deviation, times weights and plus biases by channel; null for a null or empty array."""
    v = (F.col(values) if isinstance(values, str) else values).cast("array<double>")
    mean = lambda x: F.aggregate(x, F.lit(0.0), lambda a, b: a + b) / F.size(x)
    once = lambda x, f: F.transform(F.array(x), f)[0]  # a value named, so that it is computed once
    centred = once(mean(v), lambda m: F.transform(v, lambda x: x - m))
    out = once(centred, lambda c: once(F.sqrt(mean(F.transform(c, lambda y: y * y)) + eps), lambda d: F.transform(c, lambda x: x / d)))
    if weight is not None:
        out = F.zip_with(out, F.array(*map(F.lit, weight)), lambda a, b: a * b)
    if bias is not None:
        out = F.zip_with(out, F.array(*map(F.lit, bias)), lambda a, b: a + b)
    return F.when(F.size(v) > 0, out)


def linear(values: str | Column, matrix: list[list[float]], bias: list[float] | None = None) -> Column:
    """matrix . values + bias as an array, one number a row of the matrix."""
    v = (F.col(values) if isinstance(values, str) else values).cast("array<double>")
    dot = lambda row: F.aggregate(F.zip_with(v, F.array(*map(F.lit, row)), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    return F.when(v.isNotNull(), F.array(*[dot(r) + (0.0 if bias is None else b) for r, b in zip(matrix, bias or [0.0] * len(matrix), strict=True)]))


def padded(rows: DataFrame, group: str, order: str, value: str, fill: Column | None = None) -> DataFrame:
    """(group, values, mask, n): each group's values in order as an array of the longest group's length, with ``fill`` behind its
    end, and which places hold a value of the group. Equal places of the order come by value. A group is a row of the result,
    so it has to be a sequence of bounded length; the longest length is one row that all groups meet."""
    listed = rows.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col(value).alias("v")))).alias("l"))
    longest = listed.agg(F.max(F.size("l")).alias("longest"))
    met = listed.join(F.broadcast(longest))
    rest = F.col("longest") - F.size("l")
    kind = dict(rows.dtypes)[value]
    behind = F.array_repeat(F.lit(None).cast(kind) if fill is None else fill.cast(kind), rest)
    mask = F.concat(F.array_repeat(F.lit(True), F.size("l")), F.array_repeat(F.lit(False), rest))
    return met.select(group, F.concat(F.transform("l", lambda x: x["v"]), behind).alias("values"), mask.alias("mask"), F.size("l").cast("long").alias("n"))


def nested_objects(objects: DataFrame, asset: str, order: str, *fields: str, size: str) -> DataFrame:
    """(asset, objects, dropped): the objects of each asset as an array in order, without those whose ``size`` is 0 or null, and
    how many these were."""
    kept = F.collect_list(F.when(F.col(size) > 0, F.struct(F.col(order), F.col(size), *fields)))
    return objects.groupBy(asset).agg(F.array_sort(kept).alias("objects"), F.count_if(~F.coalesce(F.col(size) > 0, F.lit(False))).alias("dropped"))


def packed(left: DataFrame, right: DataFrame, key: list[str], one: str, two: str) -> DataFrame:
    """(key, one, two): two features of one set of coordinates side by side. A coordinate that one side lacks, or has twice, fails
    the job."""
    from lattica.operators.registry import checked

    both = left.select(*key, F.col(one), F.lit(1).alias("_l")).join(right.select(*key, F.col(two), F.lit(1).alias("_r")), key, "full")
    return checked(both, F.col("_l").isNotNull() & F.col("_r").isNotNull(), "a coordinate has one side only").select(*key, one, two)
