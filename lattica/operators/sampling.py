"""Balanced batches: longest-processing-time assignment inside bounded global batches."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.operators.numbering import with_row_number


def lpt(loads: list[int], groups: int, equal_size: bool = False) -> list[int]:
    """Group of each load: heaviest first, to the group with the least total (the lowest number among equals). ``equal_size``
    closes a group that holds its share of the items."""
    room = -(-len(loads) // groups) if equal_size else len(loads)
    heap, size, out = [(0, g) for g in range(groups)], [0] * groups, [0] * len(loads)
    for i in sorted(range(len(loads)), key=lambda i: (-loads[i], i)):
        total, g = heapq.heappop(heap)
        out[i] = g
        size[g] += 1
        if size[g] < room:
            heapq.heappush(heap, (total + loads[i], g))
    return out


def balanced(df: DataFrame, key: str, load: str, batch: int, groups: int, equal_size: bool = False) -> DataFrame:
    """(batch_id, key, load, group): rows in order of ``key`` form global batches of ``batch`` rows, and each batch is dealt to
    ``groups`` groups. A batch is bounded, so the sequential step runs in one group of rows each."""
    rows, _ = with_row_number(df.select(key, load), key)
    rows = rows.select(F.expr(f"row_number div {batch}").alias("batch_id"), key, F.col(load).cast("long").alias(load))

    def deal(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(key, ignore_index=True)
        return part.assign(group=lpt(part[load].tolist(), groups, equal_size))

    kind = dict(df.dtypes)[key]
    return rows.groupBy("batch_id").applyInPandas(deal, f"batch_id long, {key} {kind}, {load} long, group int")
