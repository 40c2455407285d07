"""What the operators share: word rules, the shared work folder, guarded columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.session import put_bytes, shared_dir

#: Texts are worked on in slices of about so many bytes, which bounds the memory of a task.
SLICE_BYTES = 4 << 20

#: Tables of up to so many narrow rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: A group of more rows than this isn't shuffled by its key.
HOT_ROWS = 1024

#: A-Z to lower case; ``[0-9a-z]`` and every byte of a non-ASCII character stay; all else parts words.
ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


#: A-Z to lower case; ``[a-z]`` and every byte of a non-ASCII character stay; all else parts terms.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def alnum_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; none for null."""
    return text.translate(ALNUM).split() if text else []


def word_parts(text: bytes | None, letters: bytes = ALNUM, limit: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, so many bytes at once: a very long text needs no list of all its words."""
    rest = text.translate(letters) if text else b""
    start = 0
    while start < len(rest):
        end = len(rest)
        if start + limit < end:
            cut = rest.rfind(b" ", start, start + limit)
            cut = rest.find(b" ", start + limit) if cut < start else cut
            end = end if cut < 0 else cut + 1
        yield rest[start:end].split()
        start = end


def space_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; none for null."""
    return text.lower().split() if text else []


class WordHashes(dict):
    """64-bit hashes of words, kept for words seen before up to ``bound`` of them."""

    bound = 1 << 16

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column`` (a longer row is alone in its batch)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size + 64
        if start < batch.num_rows:
            yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def work_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_MADE: list[list[DataFrame]] = []


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Cuts the lineage: the rows as a Parquet table in the shared folder (in a folder for each value of ``by``), read again."""
    spark, path = df.sparkSession, work_path(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    again = spark.read.schema(df.schema).parquet(path)
    again._work = path  # for dropped()
    for made in _MADE:
        made.append(again)
    return again


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The rows of ``make()`` as a written table; all tables that it has written on its way are deleted."""
    _MADE.append(made := [])
    try:
        out = written(make(), name)
    finally:
        _MADE.pop()
    for df in made:
        if df is not out:
            dropped(df)
    return out


def dropped(df: DataFrame) -> None:
    """Deletes a table made by written() that nothing reads any more."""
    path = getattr(df, "_work", None)
    if path:
        jvm = df.sparkSession._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def joined(rows: DataFrame, groups: DataFrame, on: list[str], count: str = "rows", how: str = "inner") -> DataFrame:
    """Join with ``groups``, a written table of one row a key whose ``count`` says how many of ``rows`` it has. Keys with more
    than HOT_ROWS rows aren't shuffled: their part of ``groups`` is broadcast. If they are more than BROADCAST_ROWS, only
    the largest are, and none of the others has a millionth of the rows. ``how``: inner or left."""
    bound, n = HOT_ROWS, groups.filter(F.col(count) > HOT_ROWS).count()
    if not n:
        return rows.join(groups, on, how)
    if n > BROADCAST_ROWS:
        bound = groups.orderBy(F.desc(count)).limit(BROADCAST_ROWS).agg(F.min(count)).first()[0]
    hot = groups.filter(F.col(count) > bound)
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(groups.filter(F.col(count) <= bound), on, how)
    return rest.unionByName(rows.join(F.broadcast(hot), on))


def stored_bytes(spark: SparkSession, name: str, data: bytes) -> str:
    """Writes one file to the shared folder; returns its path."""
    return put_bytes(spark, work_path(spark, name), data)


def in_fold(column: str, folds: int, fold: int):
    """True where crc32 of the column as text leaves ``fold``; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds) == fold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
