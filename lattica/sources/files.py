"""Array and mesh files as tables: each file is parsed in the task that reads it."""

from __future__ import annotations

import io
import os
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Scalar types of the PLY format (fixed values).
PLY_TYPES = {"char": "i1", "uchar": "u1", "short": "i2", "ushort": "u2", "int": "i4", "uint": "u4", "float": "f4", "double": "f8", "int8": "i1", "uint8": "u1", "int16": "i2", "uint16": "u2", "int32": "i4", "uint32": "u4", "float32": "f4", "float64": "f8"}


def _parsed(spark: SparkSession, path: str, glob: str, parse: Callable[[bytes], pd.DataFrame], schema: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, content in zip(f["path"], f["content"], strict=True):
                yield parse(bytes(content)).assign(path=name)[[c.strip().split()[0] for c in f"path string, {schema}".split(",")]]

    return files.mapInPandas(run, f"path string, {schema}")


def read_npz(spark: SparkSession, path: str) -> DataFrame:
    """(path, x, y, z, feats) of ``*.npz`` files with ``coords`` or ``coord`` [n, 3] and one more array [n, c]."""

    def parse(content: bytes) -> pd.DataFrame:
        with np.load(io.BytesIO(content), allow_pickle=False) as z:
            name = "coords" if "coords" in z.files else "coord"
            rest = [z[k] for k in sorted(z.files) if k != name]
            xyz = z[name].astype(np.int32).reshape(-1, 3)
            feats = np.concatenate([r.reshape(len(xyz), -1) for r in rest], axis=1).astype(np.float32) if rest else np.zeros((len(xyz), 0), np.float32)
        return pd.DataFrame({"x": xyz[:, 0], "y": xyz[:, 1], "z": xyz[:, 2], "feats": list(feats)})

    return _parsed(spark, path, "*.npz", parse, "x int, y int, z int, feats array<float>")


def npz_contents(df: DataFrame, key: str) -> DataFrame:
    """(key, content): one ``.npz`` file for each key's rows (x, y, z, feats), ordered by coordinates."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["x", "y", "z"])
        out = io.BytesIO()
        np.savez_compressed(out, coords=part[["x", "y", "z"]].to_numpy(dtype=np.uint16), feats=np.stack(part["feats"].to_numpy()).astype(np.float32))
        return pd.DataFrame({key: [part[key].iloc[0]], "content": [out.getvalue()]})

    return df.select(key, "x", "y", "z", "feats").groupBy(key).applyInPandas(pack, f"{key} {dict(df.dtypes)[key]}, content binary")


def ply_elements(content: bytes) -> dict[str, dict[str, list]]:
    """Elements of a PLY file, ASCII or little-endian binary, as columns; a list property is a column of arrays."""
    head, _, body = content.partition(b"end_header")
    body = body[body.index(b"\n") + 1 :]
    lines = [line.split() for line in head.decode("ascii").splitlines()]
    kind = next(line[1] for line in lines if line and line[0] == "format")
    elements: list[tuple[str, int, list[list[str]]]] = []
    for line in lines:
        if line[:1] == ["element"]:
            elements.append((line[1], int(line[2]), []))
        elif line[:1] == ["property"]:
            elements[-1][2].append(line[1:])
    out: dict[str, dict[str, list]] = {}
    words, at = (iter(body.split()), 0) if kind == "ascii" else (iter(()), 0)

    def number(t: str):
        nonlocal at
        if kind == "ascii":
            w = next(words)
            return float(w) if PLY_TYPES[t][0] == "f" else int(w)
        d = np.dtype("<" + PLY_TYPES[t])
        value = np.frombuffer(body, d, 1, at)[0].item()
        at += d.itemsize
        return value

    for name, n, properties in elements:
        columns: dict[str, list] = {p[-1]: [] for p in properties}
        if kind != "ascii" and all(p[0] != "list" for p in properties):
            d = np.dtype([(p[-1], "<" + PLY_TYPES[p[0]]) for p in properties])
            rows = np.frombuffer(body, d, n, at)
            at += d.itemsize * n
            columns = {c: rows[c].tolist() for c in columns}
        else:
            for _ in range(n):
                for p in properties:
                    columns[p[-1]].append([number(p[2]) for _ in range(number(p[1]))] if p[0] == "list" else number(p[0]))
        out[name] = columns
    return out


def read_ply_vertices(spark: SparkSession, path: str) -> DataFrame:
    """(path, vid, x, y, z) of ``*.ply`` files."""

    def parse(content: bytes) -> pd.DataFrame:
        v = ply_elements(content)["vertex"]
        return pd.DataFrame({"vid": np.arange(len(v["x"]), dtype=np.int32), **{a: np.array(v[a], dtype=float) for a in "xyz"}})

    return _parsed(spark, path, "*.ply", parse, "vid int, x double, y double, z double")


def read_ply_faces(spark: SparkSession, path: str) -> DataFrame:
    """(path, fid, v0, v1, v2) of ``*.ply`` files; a face with more corners is a fan of triangles."""

    def parse(content: bytes) -> pd.DataFrame:
        faces = ply_elements(content).get("face", {})
        corners = next(iter(faces.values()), [])
        rows = [(i, f[0], f[k], f[k + 1]) for i, f in enumerate(corners) for k in range(1, len(f) - 1)]
        return pd.DataFrame(rows, columns=["fid", "v0", "v1", "v2"], dtype=np.int32)

    return _parsed(spark, path, "*.ply", parse, "fid int, v0 int, v1 int, v2 int")


def file_hashes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length, sha256) of files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def read_parts(spark: SparkSession, path: str, schema: str, start: str | None = None) -> DataFrame:
    """CSV part files named ``<stage>/new_records/part_<rank>.csv``, with file name, rank and ``bad``: the text of a line that
    doesn't fit the schema, whose columns may be null then. ``good_lines`` and ``bad_lines`` part them. ``start``: only files
    named from there on."""
    reader = spark.read.schema(f"{schema}, bad string").option("header", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "bad")
    lines = reader.option("pathGlobFilter", "part_*.csv").csv(path)
    names = [c for c in lines.columns if c != "bad"]
    # a line is judged by all its columns, also where a query reads few of them
    bad = F.when(F.hash(*names) >= -(1 << 31), F.col("bad"))
    df = lines.select(*names, bad.alias("bad"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_path").alias("file_path"))
    df = df.withColumn("rank", F.regexp_extract("file", r"part_(\d+)\.csv$", 1).cast("int"))
    return df.filter(F.col("file") >= start) if start else df


def good_lines(parts: DataFrame) -> DataFrame:
    return parts.filter("bad is null").drop("bad")


def bad_lines(parts: DataFrame) -> DataFrame:
    """The quarantine: (file, rank, bad) of the lines that don't fit, to be counted and kept."""
    return parts.filter("bad is not null").select("file", "rank", "bad")


def archived(spark: SparkSession, parts: DataFrame, target: str, stamp: str) -> list[str]:
    """Moves the files that ``parts`` (read_parts) came from to ``target``/<stage>/<stamp>_<name>, once what was made of them is
    written; returns the new paths. The stage is the file's folder below the one that all share, without ``new_records``, so
    that files of one name from several stages don't meet. The driver sees one name a file. A file that is gone already is
    left out, so a run that broke off can be repeated; a file that can't be moved is an error."""
    jvm, moved = spark._jvm, []
    files = parts.select("file_path", "file").distinct()
    ends = files.agg(F.min("file_path").alias("low"), F.max("file_path").alias("high")).first()
    shared = os.path.commonprefix([ends.low or "", ends.high or ""]).rpartition("/")[0]
    for row in files.orderBy("file_path").toLocalIterator():
        stage = [p for p in unquote(row.file_path[len(shared) :]).split("/")[1:-1] if p != "new_records"]
        source = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row.file_path))
        at = jvm.org.apache.hadoop.fs.Path("/".join([target, *stage, f"{stamp}_{unquote(row.file)}"]))
        fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(source):
            continue
        if fs.exists(at):
            raise FileExistsError(at.toString())
        fs.mkdirs(at.getParent())
        if not fs.rename(source, at):
            raise OSError(f"{source.toString()} can't be moved to {at.toString()}")
        moved.append(at.toString())
    return moved


def write_log_lines(logs: DataFrame, path: str, step: str = "step", mode: str = "append") -> None:
    """One line ``step: {json of the other columns}`` a row, as logs.parsed() reads them."""
    rest = [c for c in logs.columns if c != step]
    logs.select(F.concat(F.col(step).cast("string"), F.lit(": "), F.to_json(F.struct(*rest))).alias("value")).write.mode(mode).text(path)


def ply_voxel_contents(df: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """(key, content): a binary PLY file of each key's voxels (x, y, z) whose array columns ``attributes`` become properties
    ``<attribute>_<channel>``. A key should be a chunk of bounded size."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["x", "y", "z"])
        columns = {a: part[a].to_numpy(dtype="<i4") for a in "xyz"}
        for name in attributes:
            values = np.array(part[name].tolist(), dtype="<f4").reshape(len(part), -1)
            columns |= {f"{name}_{k}": values[:, k] for k in range(values.shape[1])}
        table = np.rec.fromarrays(list(columns.values()), names=list(columns))
        kinds = {"i": "int", "f": "float"}
        head = ["ply", "format binary_little_endian 1.0", f"element vertex {len(part)}", *(f"property {kinds[c.dtype.kind]} {n}" for n, c in columns.items()), "end_header", ""]
        return pd.DataFrame({key: [part[key].iloc[0]], "content": ["\n".join(head).encode() + table.tobytes()]})

    return df.select(key, "x", "y", "z", *attributes).groupBy(key).applyInPandas(pack, f"{key} {dict(df.dtypes)[key]}, content binary")


def read_ply_voxels(spark: SparkSession, path: str, attributes: list[str]) -> DataFrame:
    """(path, x, y, z, attributes) of ``*.ply`` files: the properties ``<attribute>_<channel>`` as one array an attribute."""

    def parse(content: bytes) -> pd.DataFrame:
        v = ply_elements(content)["vertex"]
        out = pd.DataFrame({a: np.array(v[a], dtype=np.int32) for a in "xyz"})
        for name in attributes:
            channels = sorted((c for c in v if c.rpartition("_")[0] == name), key=lambda c: int(c.rpartition("_")[2]))
            out[name] = list(np.array([v[c] for c in channels], dtype=np.float32).reshape(len(channels), len(out)).T)
        return out

    return _parsed(spark, path, "*.ply", parse, "x int, y int, z int, " + ", ".join(f"{a} array<float>" for a in attributes))


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    """Reads a table by the extension of its path; an unknown one is an error."""
    kind = path.rstrip("/").rpartition(".")[2].lower()
    if kind == "npz":
        return read_npz(spark, path)
    if kind == "ply":
        return read_ply_voxels(spark, path, **options)
    if kind not in ("parquet", "csv", "json", "orc"):
        raise ValueError(f"no reader for .{kind}")
    return spark.read.options(**({"header": "true"} | options if kind == "csv" else options)).format(kind).load(path)


def write(df: DataFrame, path: str, mode: str = "errorifexists", **options) -> None:
    """Writes a table by the extension of its path; an unknown one is an error."""
    kind = path.rstrip("/").rpartition(".")[2].lower()
    if kind not in ("parquet", "csv", "json", "orc"):
        raise ValueError(f"no writer for .{kind}")
    df.write.mode(mode).options(**({"header": "true"} | options if kind == "csv" else options)).format(kind).save(path)
