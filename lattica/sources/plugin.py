"""Sources by name: chunked voxel tables as a data source of Spark's, and a table of sources a user adds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

AXES = ("x", "y", "z")
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def chunk_files(path: str) -> list[tuple[dict[str, int], str]]:
    """({chunk_size, chunk_x, chunk_y, chunk_z}, file) of a table that write_voxels() wrote, in order."""
    fs, at = opened(path)
    found = []
    for info in fs.get_file_info(pafs.FileSelector(at, recursive=True)):
        if info.type == pafs.FileType.File and info.path.endswith(".parquet"):
            keys = dict(p.split("=") for p in info.path.split("/") if p.startswith("chunk_"))
            found.append(({k: int(v) for k, v in keys.items()}, info.path))
    return sorted(found, key=lambda f: (sorted(f[0].items()), f[1]))


class Chunk(InputPartition):
    """The files of one chunk."""

    def __init__(self, files: list[str]):
        self.files = files


class VoxelReader(DataSourceReader):
    """One partition a chunk of those that the box meets. Comparisons of x, y and z with numbers bound the box; Spark checks
    them once more on the rows."""

    def __init__(self, path: str, schema: StructType, with_file: bool):
        self.path, self.schema, self.with_file = path, schema, with_file
        self.low, self.high = dict.fromkeys(AXES, float("-inf")), dict.fromkeys(AXES, float("inf"))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            axis = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if axis in AXES and hasattr(f, "value") and isinstance(f.value, int | float):
                if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
                    self.low[axis] = max(self.low[axis], f.value)
                if isinstance(f, EqualTo | LessThan | LessThanOrEqual):
                    self.high[axis] = min(self.high[axis], f.value)
            yield f

    def partitions(self) -> list[Chunk]:
        chunks: dict[tuple, list[str]] = {}
        for keys, file in chunk_files(self.path):
            size = keys["chunk_size"]
            if all(self.low[a] < (keys[f"chunk_{a}"] + 1) * size and self.high[a] >= keys[f"chunk_{a}"] * size for a in AXES):
                chunks.setdefault(tuple(sorted(keys.items())), []).append(file)
        return [Chunk(files) for files in chunks.values()] or [Chunk([])]

    def read(self, partition: Chunk) -> Iterator[pa.RecordBatch]:
        fs, _ = opened(self.path)
        names = [n for n in self.schema.names if n != "file"]
        for file in partition.files:
            with fs.open_input_file(file) as f:
                for batch in pq.ParquetFile(f).iter_batches(columns=names):
                    keep = None
                    for a in AXES:
                        inside = pc.and_(pc.greater_equal(batch.column(a), self.low[a]), pc.less_equal(batch.column(a), self.high[a]))
                        keep = inside if keep is None else pc.and_(keep, inside)
                    batch = batch.filter(keep).select(names)
                    yield batch.append_column("file", pa.array([file] * batch.num_rows, pa.string())) if self.with_file else batch


class VoxelSource(DataSource):
    """``spark.read.format("voxels").load(path)``: a table of write_voxels(). Option ``file``: true adds the file of each row."""

    @classmethod
    def name(cls) -> str:
        return "voxels"

    def _with_file(self) -> bool:
        return self.options.get("file", "false").lower() == "true"

    def schema(self) -> StructType:
        fs, _ = opened(self.options["path"])
        files = chunk_files(self.options["path"])
        if not files:
            raise FileNotFoundError(self.options["path"])
        with fs.open_input_file(files[0][1]) as f:
            fields = [c for c in pq.read_schema(f) if not c.name.startswith("chunk_") and c.name != "zcode"]
        if self._with_file():
            fields.append(pa.field("file", pa.string()))
        return from_arrow_schema(pa.schema(fields))

    def reader(self, schema: StructType) -> DataSourceReader:
        return VoxelReader(self.options["path"], schema, self._with_file())


def register(spark: SparkSession, *sources: type[DataSource]) -> None:
    """Makes sources known to the session by their names, the voxel tables' among them, and lets Spark hand them filters."""
    spark.conf.set(PUSHDOWN, "true")
    for source in (VoxelSource, *sources):
        spark.dataSource.register(source)


def chunk_info(spark: SparkSession, path: str) -> DataFrame:
    """(chunk_x, chunk_y, chunk_z, n, low_x.., high_x..) of each chunk, from the footers of its files alone: tasks open the
    files and read no rows. A file without statistics is an error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path).select("path")
    names = [f"chunk_{a}" for a in AXES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file in batch.column("path").to_pylist():
                fs, at = opened(file)
                keys = dict(p.split("=") for p in at.split("/") if p.startswith("chunk_"))
                with fs.open_input_file(at) as f:
                    meta = pq.ParquetFile(f).metadata
                where = {meta.schema.column(k).name: k for k in range(meta.num_columns)}
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    stats = [group.column(where[a]).statistics for a in AXES]
                    rows.append([*(int(keys[n]) for n in names), group.num_rows, *(s.min for s in stats), *(s.max for s in stats)])
            columns = list(zip(*rows, strict=True)) or [[]] * 10
            kinds = [pa.int32()] * 3 + [pa.int64()] + [pa.int32()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*names, "n", *[f"low_{a}" for a in AXES], *[f"high_{a}" for a in AXES]])

    found = files.mapInArrow(run, ", ".join([f"{n} int" for n in names] + ["n long"] + [f"{e}_{a} int" for e in ("low", "high") for a in AXES]))
    return found.groupBy(*names).agg(F.sum("n").alias("n"), *[F.min(f"low_{a}").alias(f"low_{a}") for a in AXES], *[F.max(f"high_{a}").alias(f"high_{a}") for a in AXES])
