"""The library's column functions as SQL functions, for queries written in SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lattica.functions.expr import SPREAD

AXES = ("x", "y", "z")


def spread3(v: str) -> str:
    out = f"(cast({v} as bigint) & 1023)"
    for shift, mask in SPREAD:
        out = f"(({out} | shiftleft({out}, {shift})) & {mask})"
    return out


def zorder() -> str:
    return " | ".join(f"shiftleft(spread_bits({a}), {2 - k})" if k < 2 else f"spread_bits({a})" for k, a in enumerate(AXES))


#: name -> (arguments, result, body). Bodies name only functions above them.
SCALARS = {
    "floor_div": ("a bigint, b bigint", "bigint", "(a - pmod(a, b)) div b"),
    "spread_bits": ("v bigint", "bigint", spread3("v")),
    "z_order": ("x int, y int, z int", "bigint", zorder()),
    "texel": ("i bigint, n bigint, mode string", "bigint", "CASE mode WHEN 'clamp' THEN least(greatest(i, 0), n - 1) WHEN 'mirror' THEN CASE WHEN pmod(i, 2 * n) < n THEN pmod(i, 2 * n) ELSE 2 * n - 1 - pmod(i, 2 * n) END ELSE pmod(i, n) END"),
    "quantised": ("v double", "int", "cast(round(least(greatest(v, 0.0D), 1.0D) * 255) as int)"),
    "voxel_centre": ("i int, size double, origin double", "double", "(i + 0.5D) * size + origin"),
}

#: The cells between successive crossings of whole coordinates: their middles lie inside them.
SEGMENT = """SELECT DISTINCT cast(floor(x0 + t * (x1 - x0)) as int), cast(floor(y0 + t * (y1 - y0)) as int), cast(floor(z0 + t * (z1 - z0)) as int) FROM (
    SELECT explode(zip_with(slice(ts, 1, size(ts) - 1), slice(ts, 2, size(ts) - 1), (s, e) -> (s + e) / 2)) AS t FROM (
    SELECT array_sort(array_distinct(concat(array(0.0D, 1.0D), whole_crossings(x0, x1), whole_crossings(y0, y1), whole_crossings(z0, z1)))) AS ts))"""

SCALARS["whole_crossings"] = (
    "a double, b double", "array<double>",
    "CASE WHEN a <> b AND ceil(least(a, b)) <= floor(greatest(a, b)) THEN transform(sequence(cast(ceil(least(a, b)) as bigint), cast(floor(greatest(a, b)) as bigint)), w -> (w - a) / (b - a)) ELSE cast(array() as array<double>) END",
)

TABLES = {
    "segment_cells": ("x0 double, y0 double, z0 double, x1 double, y1 double, z1 double", "x int, y int, z int", SEGMENT),
    "cells_around": ("x int, y int, z int, reach int", "dx int, dy int, dz int", "SELECT p.v, q.v, r.v FROM (SELECT explode(sequence(-reach, reach)) AS v) p, (SELECT explode(sequence(-reach, reach)) AS v) q, (SELECT explode(sequence(-reach, reach)) AS v) r"),
}


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to the session under their names, replacing functions of its own of these names. Spark puts
    their bodies into the plan, so they are optimised like any expression; table functions are for ``LATERAL``."""
    for name, (arguments, result, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    for name, (arguments, columns, body) in TABLES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE ({columns}) RETURN {body}")
    return [*SCALARS, *TABLES]
