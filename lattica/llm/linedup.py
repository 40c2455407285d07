"""Line dedup on levelled sorted runs of line hashes.

A line's key is hashed to 128 bits. The hashes that are known lie in runs: tables bucketed and sorted by hash, of which
none shares a hash with another. A new batch of documents is reduced to its different keys with their least document each,
merge-anti-joined with every run bucket by bucket, and what is left becomes a run of its own. When a level has ``fanout``
runs, they are merged into one run of the next level, so that a key is rewritten as often as there are levels. All of it is
DataFrame operations; nothing but the split points of the batches reaches the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm.common import LOWERED, UPPER, dropped, work_path, written
from lattica.operators.numbering import unused

#: Shorter keys (in code points) are never dropped.
LEAST = 10
BATCHES, FANOUT = 4, 2
HASHES = ["h1", "h2"]
#: Fixed value: the characters that are stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWERED)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


@contextmanager
def in_order(spark: SparkSession) -> Iterator[None]:
    """Bucketed tables are read in their order, so that a merge needs no sort; for the jobs run inside only."""
    before = spark.conf.get(ORDERED, "false")
    spark.conf.set(ORDERED, "true")
    try:
        yield
    finally:
        spark.conf.set(ORDERED, before)


class LineRuns:
    """The runs of a corpus that grows batch by batch. ``levels[k]`` holds the names of the runs of level k."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.paths: dict[str, str] = {}

    def _saved(self, keys: DataFrame) -> str:
        name, path = f"line_run_{uuid.uuid4().hex}", work_path(self.spark, "line-run")
        with in_order(self.spark):
            keys.write.format("parquet").bucketBy(self.buckets, *HASHES).sortBy(*HASHES).option("path", path).saveAsTable(name)
        self.paths[name] = path
        return name

    def _forgotten(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        jvm, path = self.spark._jvm, self.paths.pop(name)
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def _compacted(self) -> None:
        """Merges full levels into one run of the next; a level that gets full by this is merged in turn."""
        for k, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                merged = self._saved(reduce(DataFrame.unionByName, [self.spark.table(n).select(*HASHES) for n in level]))
                for name in level:
                    self._forgotten(name)
                self.levels[k] = []
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(merged)

    def added(self, lines: DataFrame) -> DataFrame:
        """Takes the lines (doc_id, h1, h2 and more columns) of a new batch; returns those that are to be dropped: their key
        is in a run, or in a smaller doc_id of the batch (null is the largest). The batch's new keys become a run."""
        self._compacted()
        keys = lines.groupBy(*HASHES).agg(F.min("doc_id").alias("owner"))
        for name in (n for level in self.levels for n in level):
            keys = keys.join(self.spark.table(name).select(*HASHES), HASHES, "left_anti")
        name = self._saved(keys)
        self.levels[0].append(name)
        kept = self.spark.table(name).select(*(F.col(h).alias(f"kept_{h}") for h in HASHES), "owner")
        return lines.join(kept, (F.col("h1") == F.col("kept_h1")) & (F.col("h2") == F.col("kept_h2")) & F.col("doc_id").eqNullSafe(F.col("owner")), "left_anti")

    def clear(self) -> None:
        for name in list(self.paths):
            self._forgotten(name)
        self.levels = [[]]


def hashed_lines(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, text_hash, place, h1, h2) of every line whose key has ``least`` code points or more."""
    rows = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(lines_of(F.col("text"))).alias("place", "line"))
    key = rows.select("doc_id", "text_hash", "place", line_key(F.col("line")).alias("key")).filter(F.length("key") >= least)
    return key.select("doc_id", "text_hash", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))


def split_points(documents: DataFrame, batches: int) -> list[int]:
    """Bounds of doc_id that deal the documents to about equal batches; none if ids aren't whole numbers."""
    if batches < 2 or dict(documents.dtypes)["doc_id"] not in ("tinyint", "smallint", "int", "bigint"):
        return []
    found = documents.agg(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)], 1000)).first()[0]
    return sorted(set(found or []))


OURS = ["n_lines", "n_dropped"]


def without_repeated_lines(documents: DataFrame, least: int = LEAST, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """All rows and columns of ``documents`` with their ``text`` rid of repeated lines, and n_lines (before) and n_dropped.

    Lines end at \\n. A line's key is the line without blanks at both ends and with A-Z lower-cased. A key of ``least`` code
    points or more that stands in several documents stays only in the smallest doc_id (all its lines there); a key that
    repeats within one document stays. Documents go through the runs in ``batches`` ranges of doc_id, smallest first, so
    the result doesn't depend on how many there are; ids that aren't whole numbers are one batch.

    Defined results: a null text stays null, null and empty texts are one empty line; rows that share a doc_id are one
    document and are each cut by the same rule; a null doc_id is one document behind all others; texts of any length are
    cut whole; an empty table stays empty; input columns called n_lines or n_dropped are replaced, all others stay. Keys
    are told by 128 bits of two hashes. A key that a third of all documents hold is one row a task before the shuffle, and
    its lines are shuffled with their document's id."""
    spark, rows = documents.sparkSession, documents.drop(*OURS)
    points = split_points(documents, batches)
    batch = reduce(lambda a, p: a + (F.coalesce(F.col("doc_id") >= p, F.lit(True))).cast("int"), points, F.lit(0))
    lines = written(hashed_lines(rows, least).withColumn("batch", batch), "lines", by="batch")
    runs, cut = LineRuns(spark, fanout), []
    try:
        for k in range(len(points) + 1):
            found = runs.added(lines.filter(F.col("batch") == k).drop("batch"))
            cut.append(written(found.groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("places")), "dropped-lines"))
    finally:
        runs.clear()
    dropped(lines)
    own = {c: unused(rows, c) for c in ("cut_id", "cut_hash", "places", "text_hash", "lines", "no_text")}
    gone = reduce(DataFrame.unionByName, cut).select(F.col("doc_id").alias(own["cut_id"]), F.col("text_hash").alias(own["cut_hash"]), F.col("places").alias(own["places"]))
    # the texts are shuffled as lines: what stands above a join isn't merged with what stands below it, so that they are split once
    split = rows.withColumns({own["text_hash"]: F.xxhash64("text"), own["lines"]: lines_of(F.col("text")), own["no_text"]: F.col("text").isNull()}).drop("text")
    met = split.join(gone, F.col("doc_id").eqNullSafe(F.col(own["cut_id"])) & (F.col(own["text_hash"]) == F.col(own["cut_hash"])), "left")
    all_lines, places = F.col(own["lines"]), F.col(own["places"])
    stay = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), places)
    kept = F.when(places.isNull(), all_lines).otherwise(F.transform(stay, lambda i: F.get(all_lines, i)))
    out = met.withColumns({"text": F.when(~F.col(own["no_text"]), F.array_join(kept, "\n")), "n_lines": F.size(all_lines).cast("long"), "n_dropped": F.coalesce(F.size(places), F.lit(0)).cast("long")})
    return out.select(*rows.columns, *OURS)


def line_report(documents: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    rows = without_repeated_lines(documents.select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
