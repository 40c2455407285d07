"""Voxel tables on disk: Parquet by chunk, clustered along the z-order curve."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.functions.expr import floordiv, zorder

AXES = ("x", "y", "z")
CHUNKS = [f"chunk_{a}" for a in AXES]


def chunked(df: DataFrame, size: int) -> DataFrame:
    """Adds the chunk's number on each axis and the voxel's z-order code in its chunk (``size`` up to 1024)."""
    local = [F.pmod(F.col(a), F.lit(size)) for a in AXES]
    return df.withColumns({c: floordiv(a, size).cast("int") for c, a in zip(CHUNKS, AXES, strict=True)} | {"zcode": zorder(*local)})


def write_voxels(df: DataFrame, path: str, size: int = 256, codec: str = "zstd") -> None:
    """Writes rows with x, y, z: partitioned by the chunks' size and chunk, sorted along the curve in each file. ``codec``: none,
    gzip or zstd. Rows are dealt by ranges of (chunk, code), so one crowded chunk is spread over several files."""
    rows = chunked(df, size).withColumn("chunk_size", F.lit(size))
    rows.repartitionByRange(*CHUNKS, "zcode").sortWithinPartitions(*CHUNKS, "zcode").write.option("compression", codec).partitionBy("chunk_size", *CHUNKS).mode("overwrite").parquet(path)


def read_voxels(spark: SparkSession, path: str, low: tuple[int, int, int] | None = None, high: tuple[int, int, int] | None = None) -> DataFrame:
    """Reads the voxels of a box (both ends inside; None: all). The chunks' size stands in the folders' names, so whole chunks
    outside are pruned whatever size they were written with."""
    df = spark.read.parquet(path)
    if low is not None and high is not None:
        for a, c, lo, hi in zip(AXES, CHUNKS, low, high, strict=True):
            first, last = (F.floor(F.lit(v) / F.col("chunk_size")) for v in (lo, hi))
            df = df.filter((F.col(c) >= first) & (F.col(c) <= last) & F.col(a).between(lo, hi))
    return df.drop("chunk_size", *CHUNKS, "zcode")


def voxel_info(spark: SparkSession, path: str) -> DataFrame:
    """Voxels and bounds of each chunk."""
    return spark.read.parquet(path).groupBy(*CHUNKS).agg(F.count("*").alias("n"), *[F.min(a).alias(f"low_{a}") for a in AXES], *[F.max(a).alias(f"high_{a}") for a in AXES])
