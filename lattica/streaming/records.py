"""Streams of records and logs: incremental merge and windowed sums."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.operators.registry import upsert
from lattica.session import shared_dir


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet table as a stream of its files; ``files_per_batch`` holds back the source. A table that is one file is named
    by a pattern, as the source takes plain paths for folders."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


#: Buckets of a registry's keys: a micro-batch rewrites those that it has keys of.
BUCKETS = 64


def _versions(spark: SparkSession, state: str) -> dict[int, list[int]]:
    """bucket -> numbers of the micro-batches that have written it, in order."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/*/_bucket=*")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    out: dict[int, list[int]] = {}
    for status in fs.globStatus(at) or []:
        number, bucket = status.getPath().toString().rsplit("/", 2)[1:]
        if number.isdigit() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{state}/{number}/_SUCCESS")):
            out.setdefault(int(bucket.partition("=")[2]), []).append(int(number))
    return {b: sorted(n) for b, n in out.items()}


def merged(stream: DataFrame, key: str, seq: str, state: str, checkpoint: str, buckets: int = BUCKETS) -> DataFrame:
    """Merges a stream of sparse records into a registry: the newest non-null value of each column, by ``seq``.

    The registry lies in buckets by a hash of the key. Each micro-batch is reduced to one row a key with each column's value
    and its seq, merged with the buckets it touches and written under its own number, so a batch that is run again writes
    the same; versions before the one it has read are deleted. What there is is worked off, then the stream ends; a later
    call with the same folders goes on from there."""
    names = [c for c in stream.columns if c not in (key, seq)]
    kinds = dict(stream.dtypes)
    spark = stream.sparkSession
    table = f"{key} {kinds[key]}, " + ", ".join(f"{c} struct<at: {kinds[seq]}, value: {kinds[c]}>" for c in names)

    def held(versions: dict[int, int]) -> DataFrame:
        paths = [f"{state}/{n}/_bucket={b}" for b, n in versions.items()]
        return spark.read.schema(table).parquet(*paths) if paths else spark.createDataFrame([], table)

    def take(batch: DataFrame, number: int) -> None:
        rows = batch.select(key, *[F.struct(F.col(seq).alias("at"), F.col(c).alias("value")).alias(c) for c in names])
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        touched = {r[0] for r in rows.select(bucket).distinct().collect()}
        versions = {b: [n for n in found if n < number] for b, found in _versions(spark, state).items() if b in touched}
        rows = rows.unionByName(held({b: n[-1] for b, n in versions.items() if n}))
        latest = rows.groupBy(key).agg(*[F.max(F.when(F.col(f"{c}.value").isNotNull(), F.struct(f"{c}.at", f"{c}.value"))).alias(c) for c in names])
        latest.withColumn("_bucket", bucket).write.mode("overwrite").partitionBy("_bucket").parquet(f"{state}/{number}")
        for b, found in versions.items():
            for n in found[:-1]:
                at = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/{n}/_bucket={b}")
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

    stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    out = held({b: n[-1] for b, n in _versions(spark, state).items()})
    return out.select(key, *[F.col(f"{c}.value").alias(c) for c in names])


def merged_once(spark: SparkSession, path: str, shape, key: str, seq: str) -> DataFrame:
    """merged() over all files of a Parquet table, in new folders of the shared place. ``shape`` turns source rows to records."""
    home = f"{shared_dir(spark)}/records-{uuid.uuid4().hex}"
    return merged(shape(file_stream(spark, path)), key, seq, f"{home}/state", f"{home}/checkpoint")


def _parts(reader, schema: str, *paths: str) -> DataFrame:
    """The good lines of ``part_*.csv`` files with ``seq`` and ``file``, from a reader of either kind."""
    lines = reader.schema(f"{schema}, bad string").option("header", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "bad").option("pathGlobFilter", "part_*.csv").option("recursiveFileLookup", "true").csv(*paths)
    names = [c for c in lines.columns if c != "bad"]
    bad = F.when(F.hash(*names) >= -(1 << 31), F.col("bad"))  # a line is judged by all its columns
    seq = F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("file"))
    return lines.select(*names, bad.alias("bad"), seq.alias("seq"), F.col("_metadata.file_name").alias("file")).filter("bad is null").drop("bad")


def part_stream(spark: SparkSession, root: str, schema: str, archive: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Part files below ``root`` as a stream. With ``archive`` Spark moves the files of a micro-batch there once the next one
    begins, so a file is moved only after what was made of it is committed; a run that breaks off in between finds the
    file where it was and makes the same of it again."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _parts(reader, schema, root).drop("file")


def merged_parts(spark: SparkSession, root: str, schema: str, key: str, state: str, checkpoint: str, archive: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """The registry of all part files so far, each column with its newest non-null value: merged() over part_stream()."""
    return merged(part_stream(spark, root, schema, archive, files_per_batch), key, "seq", state, checkpoint)


def replayed(spark: SparkSession, paths: list[str], schema: str, key: str, start: str | None = None, stop: str | None = None) -> DataFrame:
    """The registry made anew from part files, archived ones and others (a path that isn't there is left out); ``start`` and
    ``stop`` bound the files by name, the second left out. A file that lies in several places counts once."""
    there = [p for p in paths if (at := spark._jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)]
    if not there:
        return spark.createDataFrame([], schema)
    rows = _parts(spark.read, schema, there)
    if start is not None:
        rows = rows.filter(F.col("file") >= start)
    if stop is not None:
        rows = rows.filter(F.col("file") < stop)
    names = [c for c in rows.columns if c not in (key, "seq", "file")]
    rows = rows.withColumn("seq", F.struct("seq.at", "file"))
    return upsert(rows.select(key, "seq", *names), key, "seq")


def log_sums(stream: DataFrame, time: str, late: str, window: str, key: str, value: str) -> DataFrame:
    """Count and sum per key and tumbling window of a stream; rows later than ``late`` are dropped by the watermark."""
    rows = stream.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    out = rows.groupBy(F.window("_t", window).alias("w"), key).agg(F.count("*").alias("n"), F.sum(F.col(value).cast("decimal(18,4)")).cast("double").alias("total"))
    return out.select(F.col("w.start").alias("start"), key, "n", "total")


def drained(stream: DataFrame, mode: str, name: str) -> DataFrame:
    """Runs a stream over what there is: the rows of all micro-batches (``append``), or the last one's full result
    (``complete``). A micro-batch that is run again overwrites its own folder."""
    spark = stream.sparkSession
    home = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    seen: list[int] = []

    def take(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{home}/out/{number}")
        seen.append(number)

    stream.writeStream.outputMode(mode).foreachBatch(take).option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    if not seen:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(*[f"{home}/out/{n}" for n in ([max(seen)] if mode == "complete" else sorted(set(seen)))])
