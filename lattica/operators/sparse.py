"""Sparse tensors as tables: unique (b, x, y, z) rows with feature columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.functions.expr import floordiv
from lattica.operators.numbering import running_totals, with_row_number

AXES = ("x", "y", "z")
COORDS = ("b", *AXES)


def cells(factor: int) -> list[Column]:
    return ["b", *[floordiv(a, factor).cast("int").alias(a) for a in AXES]]


def child(factor: int) -> Column:
    """Number of a voxel within its cell, x fastest."""
    out = F.lit(0).cast("int")
    for k, a in enumerate(AXES):
        out = out + (F.pmod(F.col(a), F.lit(factor)) * factor**k).cast("int")
    return out


def downsampled(df: DataFrame, factor: int, **aggregates: Column) -> DataFrame:
    """One row per coarse cell with the given aggregates."""
    return df.groupBy(*cells(factor)).agg(*[a.alias(n) for n, a in aggregates.items()])


def child_bits(factor: int = 2) -> Column:
    """Aggregate: the bits of the children that exist (a factor of 2 has 8)."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1), child(factor)))


def subdivision(df: DataFrame, factor: int = 2) -> DataFrame:
    """One row per coarse cell with the bits of its children."""
    return downsampled(df, factor, mask=child_bits(factor))


def upsampled(coarse: DataFrame, mask: str = "mask", factor: int = 2) -> DataFrame:
    """The children whose bits are set, with the cell's other columns."""
    n = factor**3
    rest = [c for c in coarse.columns if c not in (*COORDS, mask)]
    kids = F.explode(F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.col(mask).bitwiseAND(F.call_function("shiftleft", F.lit(1), k)) != 0))
    out = coarse.withColumn("_k", kids)
    at = [(F.col(a) * factor + F.floor(F.col("_k") / factor**k).cast("int") % factor).cast("int").alias(a) for k, a in enumerate(AXES)]
    return out.select("b", *at, *rest)


def to_channels(df: DataFrame, value: str, factor: int = 2) -> DataFrame:
    """Coarse cells with the children's values as columns c0.. in child order, zero where a child is missing."""
    n = factor**3
    wide = df.withColumn("_c", child(factor)).groupBy(*cells(factor)).pivot("_c", list(range(n))).agg(F.first(value))
    return wide.select(*COORDS, *[F.coalesce(F.col(f"`{k}`"), F.lit(0)).alias(f"c{k}") for k in range(n)])


def from_channels(wide: DataFrame, mask: DataFrame, factor: int = 2, name: str = "value") -> DataFrame:
    """The way back: the channel of each child that ``mask`` has."""
    n = factor**3
    both = wide.join(mask, list(COORDS)).withColumn("_v", F.array(*[F.col(f"c{k}") for k in range(n)]))
    out = both.select(*COORDS, "mask", F.posexplode("_v").alias("_k", name)).filter(F.expr("mask & shiftleft(1, _k)") != 0)
    at = [(F.col(a) * factor + F.floor(F.col("_k") / factor**k).cast("int") % factor).cast("int").alias(a) for k, a in enumerate(AXES)]
    return out.select("b", *at, name)


def layout(df: DataFrame, batch: str = "b") -> DataFrame:
    """(batch, n, start, stop): where each batch's rows lie, however many batches there are."""
    return running_totals(df.groupBy(batch).agg(F.count("*").alias("n")), batch, "n").select(batch, "n", "start", "stop")


def concatenated(frames: list[DataFrame], batches: list[int]) -> DataFrame:
    """Union in which each frame's batch numbers follow those of the frames before."""
    out, offset = None, 0
    for f, n in zip(frames, batches, strict=True):
        part = f.withColumn("b", (F.col("b") + offset).cast("int"))
        out = part if out is None else out.unionByName(part)
        offset += n
    return out


def selected(df: DataFrame, wanted: list[int], batch: str = "b") -> DataFrame:
    """The batches ``wanted``, numbered anew in that order; a batch may be wanted twice."""
    index = df.sparkSession.createDataFrame([(old, new) for new, old in enumerate(wanted)], f"{batch} int, _new int")
    return df.join(F.broadcast(index), batch).withColumn(batch, F.col("_new")).drop("_new")


def densified(df: DataFrame, batch: int, size: int, value: str) -> DataFrame:
    """Every cell of a dense grid of one batch, zero where the table has none."""
    axis = lambda a: df.sparkSession.range(size).select(F.col("id").cast("int").alias(a))
    spine = axis("x").join(F.broadcast(axis("y"))).join(F.broadcast(axis("z")))
    return spine.join(df.filter(F.col("b") == batch).select(*AXES, value), list(AXES), "left").withColumn(value, F.coalesce(F.col(value), F.lit(0)))


def densified_all(df: DataFrame, size: int, value: str) -> DataFrame:
    """(b, x, y, z, value, mask): every cell of the dense grids of all batches; where the table has none the value is zero and
    the mask false. The batches are listed once and their cells made where they are."""
    cell = F.explode(F.sequence(F.lit(0), F.lit(size**3 - 1)))
    at = [F.expr(f"cast(_cell div {size**k} % {size} as int)").alias(a) for k, a in ((2, "x"), (1, "y"), (0, "z"))]
    spine = df.select("b").distinct().select("b", cell.alias("_cell")).select("b", *at)
    out = spine.join(df.select("b", *AXES, F.col(value).alias("_v")), ["b", *AXES], "left")
    return out.select("b", *AXES, F.coalesce("_v", F.lit(0)).alias(value), F.col("_v").isNotNull().alias("mask"))


def within_budget(df: DataFrame, coarse: int, resolutions: list[int], most: int, patch: int = 16) -> DataFrame:
    """(b, resolution, tokens): of the resolutions, given from high to low, the first at which a batch has fewer than ``most``
    different cells, else the last. All are counted in one pass."""
    tried = F.explode(F.array(*map(F.lit, resolutions)))
    rows = df.select("b", *AXES, tried.alias("resolution"))
    cells = [F.floor((F.col(a) + 0.5) / coarse * F.expr(f"resolution div {patch}")).cast("int").alias(a) for a in AXES]
    counts = rows.select("b", "resolution", *cells).distinct().groupBy("b", "resolution").agg(F.count("*").alias("tokens"))
    fits = F.max(F.when((F.col("tokens") < most) | (F.col("resolution") == resolutions[-1]), F.struct("resolution", "tokens"))).alias("r")
    return counts.groupBy("b").agg(fits).select("b", "r.*")


def unique_inverse(df: DataFrame, key: list[str]) -> DataFrame:
    """Adds ``inverse``: the number of the row's key among the sorted distinct keys."""
    numbers, _ = with_row_number(df.select(*key).distinct(), *key, name="inverse")
    return df.join(numbers, key)
