"""URL filters: a sorted array of 64-bit digests, probed by vectorised binary search.

Rules ``host + path prefix`` and blocked sites come from tables of any size. Their xxhash64 digests are dealt to shards by
range; tasks sort each shard and write it beside the full strings to one file, which Spark hands to each executor once.
Tasks memory-map the files, so all workers of a machine share their pages. A url probes its host and each parent domain,
whose keys and digests are column expressions, and then the path lengths of those that have rules. A probe counts only
where the stored string equals the probed one, so digest collisions never decide.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm.common import dropped, stored_bytes, written

UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Spark's xxhash64 is xxhash's with this seed.
SEED = 42
#: Keys of a shard, about.
SHARD_KEYS = 1_000_000

#: Base rules (fixed values): verdict, host, path.
BASE_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

#: Sites that the index blocks besides the base rules, with all their subdomains.
BLOCKED_SITES = [f"{name}.example.{top}" for name in ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm") for top in ("com", "net", "org")]


#: Codes of entries: a rule's verdict, a blocked site, and from LENGTHS on the length of a path that a rule of the host has.
ALLOW, BLOCK, SITE, LENGTHS = 0, 1, 2, 16
#: What stands behind the host in the keys of sites and of hosts with rules; no url's host and path hold it there.
LISTED, RULED = "\0", "\1"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWERED)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*(/[^?#]*)", 1), F.lit(""))


def shard_of(digests: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each digest: equal ranges of the digests' upper 32 bits."""
    return ((digests.astype(np.uint64) >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


class DigestArray:
    """Keys in the order of their digests: digests, offsets into the strings, lengths in characters, codes; equal digests lie
    side by side."""

    def __init__(self, digests: np.ndarray, offsets: np.ndarray, chars: np.ndarray, codes: np.ndarray, blob: np.ndarray):
        self.digests, self.offsets, self.chars, self.codes, self.blob = digests, offsets, chars, codes, blob

    @staticmethod
    def built(digests: np.ndarray, keys: list[str], codes: np.ndarray) -> bytes:
        order = np.argsort(digests.astype(np.uint64), kind="stable")
        stored = [keys[i].encode() for i in order]
        out = io.BytesIO()
        for column in ([len(stored)], digests[order], np.cumsum([0, *map(len, stored)]), [len(keys[i]) for i in order], codes[order]):
            out.write(np.asarray(column).astype(np.uint64).tobytes())
        out.write(b"".join(stored))
        return out.getvalue()

    @classmethod
    def mapped(cls, path: str) -> DigestArray:
        n = int(np.memmap(path, dtype=np.uint64, mode="r", shape=(1,))[0])
        body = np.memmap(path, dtype=np.uint64, mode="r", offset=8, shape=(4 * n + 1,))
        parts = np.split(body, [n, 2 * n + 1, 3 * n + 1])
        size = int(parts[1][-1])
        return cls(*parts, np.memmap(path, dtype=np.uint8, mode="r", offset=8 * (4 * n + 2), shape=(size,)) if size else np.zeros(0, np.uint8))

    def stored(self, i: int) -> bytes:
        return self.blob[int(self.offsets[i]) : int(self.offsets[i + 1])].tobytes()

    def probe(self, digests: np.ndarray, key) -> tuple[np.ndarray, np.ndarray]:
        """(number of the probe, entry) of those held; ``key(j)`` is the probed string of a probe whose digest was found."""
        if not len(self.digests) or not len(digests):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        at = np.searchsorted(self.digests, digests)
        probes, entries = [], []
        for j in np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == digests).tolist():
            i, wanted = int(at[j]), key(j)
            while i < len(self.digests) and self.digests[i] == digests[j]:
                if self.stored(i) == wanted:
                    probes.append(j)
                    entries.append(i)
                i += 1
        return np.array(probes, dtype=np.int64), np.array(entries, dtype=np.int64)


def indexed(entries: DataFrame) -> list[str]:
    """Builds the shards of ``entries`` (key, code) in tasks; returns the names of their files. The driver hands on one shard's
    file at a time."""
    spark, entries = entries.sparkSession, entries.distinct().withColumn("digest", F.xxhash64("key"))
    n = entries.count()
    shards = -(-n // SHARD_KEYS)

    @F.pandas_udf("int")
    def shard(digests: pd.Series) -> pd.Series:
        return pd.Series(shard_of(digests.to_numpy().view(np.uint64), shards).astype(np.int32))

    def build(group: pa.Table) -> pa.Table:
        data = DigestArray.built(group.column("digest").to_numpy().view(np.uint64), group.column("key").to_pylist(), group.column("code").to_numpy())
        return pa.table({"shard": group.column("shard")[:1], "data": pa.array([data], pa.binary())})

    files: list[str] = [""] * shards
    if n:
        made = written(entries.withColumn("shard", shard("digest")).groupBy("shard").applyInArrow(build, "shard int, data binary"), "url-shards")
        for number, data in made.toLocalIterator():
            path = stored_bytes(spark, "url-index", bytes(data))
            spark.sparkContext.addFile(path)
            files[number] = path.rpartition("/")[2]
        dropped(made)
    return files


def judged(spark: SparkSession, pages: DataFrame, rules: DataFrame | None = None, sites: DataFrame | None = None) -> DataFrame:
    """Judges every row of ``pages`` (page_id, url): page_id, host, path, rule, verdict. ``rules`` (verdict, host, path) and
    ``sites`` (site) are tables; None stands for the base rules and the sites above. The index must fit on each machine's
    disk; rows of either with a null are left out.

    The longest fitting rule decides (``block`` where two of one length differ); without a rule, hosts that are a
    blocked site or lie below one are blocked, all others allowed. Null and empty urls and urls without ``://`` have an
    empty host and path, fit no rule and are allowed; very long urls are read whole. Duplicate rows are judged each; an
    empty table gives an empty result; other columns, whatever their names, are ignored.

    A host and its parents are probed first; the index has an entry for each host with rules and each length of their paths,
    and only these lengths of the url's path are then probed with that host. So a url costs as many keys as its host has
    labels, and as many more as rules could fit it."""
    rules = (spark.createDataFrame(BASE_RULES, "verdict string, host string, path string") if rules is None else rules).dropna()
    sites = (spark.createDataFrame([(s,) for s in BLOCKED_SITES], "site string") if sites is None else sites).dropna()
    by_rule = rules.select(F.concat("host", "path").alias("key"), F.when(F.col("verdict") == "block", BLOCK).otherwise(ALLOW).alias("code"))
    hosts = rules.select(F.concat("host", F.lit(RULED)).alias("key"), (F.length("path") + LENGTHS).alias("code"))
    files = indexed(by_rule.unionAll(hosts).unionAll(sites.select(F.concat("site", F.lit(LISTED)).alias("key"), F.lit(SITE).alias("code"))))
    # keys need no more labels of a host than the rules and sites have
    labels = [f.select(F.max(F.size(F.split(c, "[.]", -1)))).first()[0] or 1 for f, c in ((rules, "host"), (sites, "site"))]
    host, path = host_path(F.col("url"))
    kind = dict(pages.dtypes)["page_id"]
    parts, most = F.split("host", "[.]", -1), max(labels)
    n = F.size(parts)
    parents = F.transform(F.sequence(F.greatest(F.lit(1), n - most + 1), n), lambda i: F.array_join(F.slice(parts, i, n), "."))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("keys", F.when(F.col("host") != "", F.flatten(F.transform(parents, lambda p: F.array(F.concat(p, F.lit(LISTED)), F.concat(p, F.lit(RULED)))))).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("digests", F.transform("keys", lambda k: F.xxhash64(k)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = [DigestArray.mapped(SparkFiles.get(f)) if f else None for f in files]

        def probed(digests: np.ndarray, key) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, DigestArray]]:
            """(number of the probe, entry, code, shard) of the keys that are held."""
            home = shard_of(digests, len(shards)) if shards else np.zeros(len(digests), dtype=np.uint64)
            for number, shard in enumerate(shards):
                mine = np.flatnonzero(home == number)
                if shard is not None and len(mine):
                    probes, entries = shard.probe(digests[mine], lambda j, mine=mine: key(int(mine[j])))
                    yield mine[probes], entries, shard.codes[entries].astype(np.int64), shard

        for batch in batches:
            keys, digests = batch.column("keys").flatten(), batch.column("digests").flatten().to_numpy().view(np.uint64)
            row = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("digests").offsets.to_numpy()))
            paths, listed = batch.column("path").to_pylist(), np.zeros(batch.num_rows, dtype=bool)
            asked: list[tuple[int, bytes]] = []
            for probes, _, codes, _ in probed(digests, lambda j: keys[j].as_py().encode()):
                listed[row[probes[codes == SITE]]] = True
                for j, code in zip(probes[codes >= LENGTHS].tolist(), codes[codes >= LENGTHS].tolist(), strict=True):
                    r, size = int(row[j]), code - LENGTHS
                    if size <= len(paths[r]):
                        asked.append((r, (keys[j].as_py()[: -len(RULED)] + paths[r][:size]).encode()))
            found: list[tuple[int, int, int, str]] = []
            wanted = np.array([xxhash.xxh64_intdigest(k, seed=SEED) for _, k in asked], dtype=np.uint64)
            for probes, entries, codes, shard in probed(wanted, lambda j: asked[j][1]):
                found += zip([asked[j][0] for j in probes.tolist()], shard.chars[entries].tolist(), codes.tolist(), [shard.stored(i).decode() for i in entries.tolist()], strict=True)
            best = {r: (code, rule) for r, _, code, rule in sorted(found)}
            rule = [best[i][1] if i in best else None for i in range(batch.num_rows)]
            verdict = [("allow", "block")[best[i][0]] if i in best else "block" if listed[i] else "allow" for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "host", "path")), pa.array(rule, pa.string()), pa.array(verdict, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    return rows.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")
