"""Row numbers, shards and offsets over everything, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattica.session import shared_dir


#: Groups up to so many are broadcast with their first row's number.
BROADCAST_GROUPS = 1_000_000


def fixed(df: DataFrame) -> DataFrame:
    """The rows with their partitions held fast by a checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame doesn't have in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_number(df: DataFrame, *order: str | Column, name: str = "row_number") -> tuple[DataFrame, int]:
    """Adds the row's number from 0 in ``order`` and returns the row count: dealt by range, sorted in each partition, and
    shifted by the rows of the partitions before. One count per partition reaches the driver. Rows that are equal in
    ``order`` are interchangeable; a hash of their places parts them, so that many of them don't meet in one task. A
    column called ``name`` is replaced, all others stay."""
    df = df.drop(name)
    at, tie, part, start = (unused(df, c) for c in ("_at", "_tie", "_part", "_start"))
    dealt = df.withColumn(tie, F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(*order, tie).sortWithinPartitions(*order, tie)
    placed = fixed(dealt.drop(tie).withColumn(at, F.monotonically_increasing_id()))
    number, within = F.shiftright(at, 33), F.col(at).bitwiseAND((1 << 33) - 1)
    counts = sorted(tuple(r) for r in placed.groupBy(number.alias("p")).count().collect())
    starts, n = [], 0
    for p, count in counts:
        starts.append((p, n))
        n += count
    offsets = F.broadcast(df.sparkSession.createDataFrame(starts, f"{part} long, {start} long"))
    return placed.withColumn(part, number).join(offsets, part).withColumn(name, F.col(start) + within).drop(part, start, at), n


def running_totals(df: DataFrame, order: str, value: str) -> DataFrame:
    """Adds ``start`` and ``stop``: the total of ``value`` over the rows before in ``order``, and with the row's own. Totals of
    range partitions reach the driver, one number each; within a partition the rows are added up in their order."""
    part = unused(df, "_part")
    placed = fixed(df.repartitionByRange(order).withColumn(part, F.spark_partition_id()))
    before, starts = 0, []
    for p, total in sorted(tuple(r) for r in placed.groupBy(part).agg(F.sum(value)).collect()):
        starts.append((p, before))
        before += total or 0
    offsets = F.broadcast(df.sparkSession.createDataFrame(starts, f"{part} int, _before long"))
    own = F.sum(value).over(Window.partitionBy(part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    out = placed.withColumn("_own", F.coalesce(own, F.lit(0))).join(offsets, part)
    return out.withColumns({"stop": F.col("_before") + F.col("_own"), "start": F.col("_before") + F.col("_own") - F.coalesce(F.col(value), F.lit(0))}).drop(part, "_before", "_own")


def with_place(df: DataFrame, group: str, order: str, name: str = "place", count: str | None = None) -> DataFrame:
    """Adds the row's number from 0 within its group, in ``order``, and the group's size as ``count``: row numbers over
    everything less that of the group's first row. No group has to fit in a task."""
    number = unused(df, "_number")
    rows, _ = with_row_number(df, group, order, name=number)
    firsts = rows.groupBy(F.col(group).alias("_group")).agg(F.min(number).alias("_first"), F.count("*").alias("_count"))
    few = firsts.count() <= BROADCAST_GROUPS
    out = rows.join(F.broadcast(firsts) if few else firsts, F.col(group).eqNullSafe(F.col("_group"))).withColumn(name, F.col(number) - F.col("_first"))
    return (out.withColumn(count, F.col("_count")) if count else out).drop(number, "_group", "_first", "_count")


def shard_slice(df: DataFrame, key: str, rank: int, world: int) -> DataFrame:
    """The contiguous slice ``[n*rank//world, n*(rank+1)//world)`` of the rows in order of ``key``."""
    rows, n = with_row_number(df, key)
    return rows.filter((F.col("row_number") >= n * rank // world) & (F.col("row_number") < n * (rank + 1) // world)).drop("row_number")


def shard_bounds(df: DataFrame, key: str, world: int) -> DataFrame:
    """Adds ``rank``, the slice each row falls in."""
    rows, n = with_row_number(df, key)
    if not n:
        return rows.withColumn("rank", F.lit(0)).drop("row_number")
    # the least r with row < n*(r+1)//world
    return rows.withColumn("rank", F.floor(((F.col("row_number") + 1) * world - 1) / n).cast("int")).drop("row_number")


def strided(df: DataFrame, key: str, world: int, pad: bool) -> DataFrame:
    """Adds ``rank`` and ``slot`` of every ``world``-th row. ``pad``: repeats rows from the start until all ranks have as
    many; else drops the tail."""
    rows, n = with_row_number(df, key)
    total = -(-n // world) * world if pad else n // world * world
    out = rows.filter(F.col("row_number") < total)
    k = 1
    while pad and n and total > n * k:  # at most ``world`` rows in all
        out = out.unionByName(rows.filter(F.col("row_number") < total - n * k).withColumn("row_number", F.col("row_number") + n * k))
        k += 1
    return out.withColumns({"rank": (F.col("row_number") % world).cast("int"), "slot": F.expr(f"row_number div {world}")}).drop("row_number")


def epoch_order(df: DataFrame, key: str, seed: int, epoch: int) -> DataFrame:
    """A reproducible shuffle: the row's place in the order of a hash of its key and seed + epoch."""
    return with_row_number(df.withColumn("_h", F.xxhash64(key, F.lit(seed + epoch))), "_h", key, name="place")[0].drop("_h")


def micro_batches(df: DataFrame, key: str, parts: int) -> DataFrame:
    """Adds ``part``: row i of n goes to the part whose bounds i*n//parts hold it."""
    return shard_bounds(df, key, parts).withColumnRenamed("rank", "part")
