"""Attention between the rows of a group, in tiles of bounded size."""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a tile of queries or keys: a row is copied once for each tile of its group and side, and two tiles take seconds.
TILE = 16384
#: Scores held at a time.
BLOCK = 1 << 18


def attended(rows: DataFrame, group: list[str], row: str, query: str, key: str, value: str, tile: int = TILE) -> DataFrame:
    """(group, row, out): for each row the mean of the ``value`` arrays of its group's rows, weighted by the softmax of
    query.key / sqrt(d). A group's queries and keys are dealt to tiles and each pair of tiles is worked on in one place; a
    query's parts (greatest score, sum of weights, weighted sum) are then merged, so no group must fit in a task. Groups of
    more than a tile are counted first, as there are as many tasks as pairs of their tiles: at most one row for ``tile``
    rows reaches the driver. Rows of a group are told apart by ``row``; null arrays are left out."""
    fine = rows.select(*group, row, query, key, value).dropna(subset=[query, key, value]).filter(reduce(and_, (F.col(c).isNotNull() for c in group)))
    counts = fine.groupBy(*group).agg(F.ceil(F.count("*") / tile).cast("int").alias("_tiles")).filter("_tiles > 1")
    large = counts.collect()
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), sum(r["_tiles"] ** 2 for r in large))
    tiles = F.lit(1)
    if large:
        counts = rows.sparkSession.createDataFrame(large, counts.schema)
        fine, tiles = fine.repartition(parts, row).join(F.broadcast(counts), group, "left"), F.coalesce("_tiles", F.lit(1))
    # a row's query meets the tiles after its own, its key those before it, and both their own
    dealt = fine.withColumn("_n", tiles).withColumn("_own", F.pmod(F.xxhash64(row), F.col("_n")).cast("int")).withColumn("_step", F.explode(F.sequence(1 - F.col("_n"), F.col("_n") - 1)))
    met = F.pmod(F.col("_own") + F.abs("_step"), F.col("_n"))
    is_query, is_key = F.col("_step") >= 0, F.col("_step") <= 0
    pairs = dealt.select(
        *group, F.when(is_query, F.col("_own")).otherwise(met).alias("_i"), F.when(is_key, F.col("_own")).otherwise(met).alias("_j"),
        row, F.when(is_query, F.col(query)).alias("_q"), F.when(is_key, F.col(key)).alias("_k"), F.when(is_key, F.col(value)).alias("_v"),
    )
    if large:
        pairs = pairs.repartition(parts, *group, "_i", "_j")

    def matrix(arrays: pa.ChunkedArray) -> np.ndarray:
        """The arrays that aren't null, one a line."""
        lists = arrays.combine_chunks().drop_null()
        if len(pc.unique(pc.list_value_length(lists))) > 1:
            raise ValueError("arrays of a group differ in length")
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return flat.reshape(len(lists), len(flat) // max(len(lists), 1))

    def part(table: pa.Table) -> pa.Table:
        out = table.filter(table["_q"].is_valid()).select([*group, row])
        q, k, v = (matrix(table[c]) for c in ("_q", "_k", "_v"))
        if not len(k):
            out = out.slice(0, 0)
        top, total, summed = np.empty(len(out)), np.empty(len(out)), np.empty((len(out), v.shape[1]))
        q, k, step = q / np.sqrt(max(q.shape[1], 1)), k.T, max(BLOCK // max(len(k), 1), 1)
        for at in (slice(a, a + step) for a in range(0, len(out), step)):
            weights = q[at] @ k
            top[at] = weights.max(axis=1)
            weights -= top[at, None]
            np.exp(weights, out=weights)
            total[at], summed[at] = weights.sum(axis=1), weights @ v
        ends = pa.array(np.arange(len(out) + 1, dtype=np.int32) * v.shape[1], pa.int32())
        for name, column in (("_top", pa.array(top)), ("_sum", pa.array(total)), ("_out", pa.ListArray.from_arrays(ends, pa.array(summed.ravel())))):
            out = out.append_column(name, column)
        return out

    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in [*group, row]), "_top double, _sum double, _out array<double>"])
    merged = pairs.groupBy(*group, "_i", "_j").applyInArrow(part, schema).groupBy(*group, row).agg(F.max("_top").alias("_m"), F.collect_list(F.struct("_top", "_sum", "_out")).alias("_p"))  # one entry a tile of keys
    scale = lambda p: F.exp(p["_top"] - F.col("_m"))
    total = F.aggregate("_p", F.lit(0.0), lambda a, p: a + p["_sum"] * scale(p))
    summed = F.aggregate("_p", F.transform(F.col("_p")[0]["_out"], lambda x: F.lit(0.0)), lambda a, p: F.zip_with(a, p["_out"], lambda x, y: x + y * scale(p)))
    return merged.select(*group, row, F.transform(summed, lambda x: x / total).alias("out"))
