"""Embedding near-duplicates: int8 tile products with rigorous error bounds.

Equal vectors of a label form a class; one row a class goes on, with its weight. Each unit vector u is quantised once to
s * q + r with q in int8, and |u.v - s_u s_v q_u.q_v| <= |s_u q_u| |r_v| + |r_u| |v|, whose norms are stored with the codes.
The rows of a label are dealt to tiles of bounded size, rows near to each other together, and every pair of tiles of a label
that aren't too far apart is one group, to which only codes, scales and norms are shuffled. Pairs whose upper bound is below the threshold are out, pairs whose lower bound is
above it are in. What is left open is named by rows, not pairs: the rows of a group that have an open pair are grouped
once more, now with their full vectors, and only their open pairs are computed in full precision. A group returns counts
and a spanning star of its links, so a group of many near copies costs rows in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattica.llm.common import BROADCAST_ROWS, dropped, joined, written
from lattica.llm.components import components

#: Rows of a tile, about: a group holds the codes of two tiles.
TILE = 4096
#: Room for rounding in the float64 arithmetic of the bounds.
SLACK = 1e-9
#: Pivots of a label, one for so many rows and so many at most: rows near to one are dealt to tiles of its own.
PIVOT_ROWS, PIVOTS = 64, 1024
#: Bytes of pivots that are handed to all tasks at most; labels beyond are dealt by a hash alone.
PIVOT_BYTES = 64 << 20
#: Rows whose products with a tile are held at once, and pairs that are computed in full precision at once.
BLOCK, EXACT_AT_ONCE = 128, 1 << 16


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the coded part, norms of the error, for rows of unit length."""
    scales = np.abs(units).max(axis=1) / 127
    codes = np.rint(units / scales[:, None]).astype(np.int8)
    coded = codes * scales[:, None]
    return codes, scales, np.linalg.norm(coded, axis=1), np.linalg.norm(units - coded, axis=1)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row number reachable from each of ``n`` rows over the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, root[a], low)
        np.minimum.at(after, root[b], low)
        after = after[after]
        if np.array_equal(after, root):
            return root
        root = after


def _units(column: pa.Array, dimension: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


class Codes:
    """Quantised rows: int8 codes, scales, norms of the coded part and of the error."""

    def __init__(self, codes: np.ndarray, scales: np.ndarray, norms: np.ndarray, errors: np.ndarray):
        # products of whole numbers below 2**24 are exact in float32
        self.codes = codes.astype(np.float32 if 127 * 127 * codes.shape[1] < 1 << 24 else np.float64)
        self.scales, self.norms, self.errors = scales, norms, errors

    def bounded(self, left: np.ndarray, right: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(a, b, sure) in blocks: pairs of a row of ``left`` and one of ``right`` whose upper bound reaches the threshold, and
        whether the lower one does. Each pair comes once where both are the same array."""
        same, columns = left is right, np.ascontiguousarray(self.codes[right].T)
        for start in range(0, len(left), BLOCK):
            rows = left[start : start + BLOCK]
            about = (self.codes[rows] @ columns).astype(np.float64) * self.scales[rows][:, None] * self.scales[right][None, :]
            bound = self.norms[rows][:, None] * self.errors[right][None, :] + self.errors[rows][:, None] + SLACK
            a, b = np.nonzero(about + bound >= threshold)
            if same:
                once = b > a + start
                a, b = a[once], b[once]
            yield rows[a], right[b], (about[a, b] - bound[a, b]) >= threshold


class Links:
    """Counts of links, by weight, and the least row reachable, added up block by block."""

    def __init__(self, weight: np.ndarray):
        self.weight, self.counts, self.root = weight, np.zeros(len(weight), dtype=np.int64), np.arange(len(weight))

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            np.add.at(self.counts, a, self.weight[b])
            np.add.at(self.counts, b, self.weight[a])
            each = np.arange(len(self.root))
            self.root = roots(len(each), np.concatenate([each, a]), np.concatenate([self.root, b]))


CODED = ["codes", "scale", "norm", "error"]
GROUP = ["label", "d", "i", "j"]


def coded(rows: DataFrame) -> DataFrame:
    """Adds codes, scale, norm and error to rows with a fit ``embedding``."""
    schema = rows.withColumns({"codes": F.lit(b""), "scale": F.lit(0.0), "norm": F.lit(0.0), "error": F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = [()] * batch.num_rows
            sizes = batch.column("d").to_numpy()
            for d in np.unique(sizes):  # rows of one length at once
                at = np.flatnonzero(sizes == d)
                codes, *rest = quantised(_units(batch.column("embedding").take(pa.array(at)), int(d)))
                for k, c, *r in zip(at, codes, *rest, strict=True):
                    found[k] = (c.tobytes(), *r)
            columns = list(zip(*found, strict=True)) or [[]] * 4
            new = [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.float64(), pa.float64(), pa.float64()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], schema.names)

    return rows.mapInArrow(run, schema)


def _group(group: pa.Table) -> tuple[Codes, Links, np.ndarray, np.ndarray]:
    """The codes and empty links of a group, and the rows of its two tiles."""
    d = group.column("d")[0].as_py()
    codes = np.frombuffer(b"".join(group.column("codes").to_pylist()), dtype=np.int8).reshape(-1, d)
    weight, t, *norms = (group.column(c).to_numpy() for c in ("weight", "t", "scale", "norm", "error"))
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    left = np.flatnonzero(t == i)
    return Codes(codes, *norms), Links(weight), left, left if i == j else np.flatnonzero(t == j)


def _table(group: pa.Table, links: Links, open_: np.ndarray) -> pa.Table:
    """Linked rows (n, root), and those with an open pair (n null)."""
    held, left = np.flatnonzero(links.counts), np.flatnonzero(open_)
    ids, at = group.column("id").to_numpy(), np.concatenate([held, left])
    part = group.select([*GROUP, "h1", "h2", "t", "id"]).take(pa.array(at))
    fixed = np.arange(len(at)) >= len(held)
    return part.append_column("n", pa.array(links.counts[at], mask=fixed)).append_column("root", pa.array(ids[links.root[at]], mask=fixed))


RESULT = "label string, d int, i long, j long, h1 long, h2 long, t long, id long, n long, root long"


def clustered(rows: DataFrame, tile: int, threshold: float) -> DataFrame:
    """The rows of labels with more than ``tile`` rows, with ``t``, the tile each belongs to. Some rows of the label, picked by
    a hash, are pivots; a row within twice the threshold's angle of one belongs to the nearest, the rest belong together. What
    is more than a tile holds is parted by a hash. Which rows are together decides how much can be skipped, not what is found."""
    spark = rows.sparkSession
    near = float(np.cos(min(2 * np.arccos(np.clip(threshold, -1, 1)), np.pi)))
    sizes = rows.groupBy("label", "d").agg(F.count("*").alias("rows")).filter(F.col("rows") > tile)
    sizes = written(sizes.withColumn("pivots", F.least(F.lit(PIVOTS), F.ceil(F.col("rows") / PIVOT_ROWS)).cast("int")), "label-sizes")
    room = sizes.agg(F.sum(F.col("pivots") * F.col("d"))).first()[0] or 0
    few = room <= PIVOT_BYTES and sizes.count() <= BROADCAST_ROWS
    large = rows.join(F.broadcast(sizes) if few else sizes, ["label", "d"])
    if few:
        order = Window.partitionBy("label", "d").orderBy(F.xxhash64("h1", "h2", F.lit(11)), "h1", "h2")
        picked = large.withColumn("pivot", F.row_number().over(order)).filter(F.col("pivot") <= PIVOTS).filter("pivot <= pivots")
        found: dict[tuple, list[np.ndarray]] = {}
        for r in picked.select("label", "d", "pivot", "codes").toLocalIterator():
            found.setdefault((r.label, r.d), []).append((r.pivot, np.frombuffer(bytes(r.codes), dtype=np.int8).astype(np.float32)))
        held = {k: np.stack([v / max(float(np.linalg.norm(v)), 1e-9) for _, v in sorted(x, key=lambda p: p[0])]) for k, x in found.items()}
        shared = spark.sparkContext.broadcast(held)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pivots = shared.value
            for batch in batches:
                nearest = np.zeros(batch.num_rows, dtype=np.int32)
                keys = list(zip(batch.column("label").to_pylist(), batch.column("d").to_pylist(), strict=True))
                codes = batch.column("codes")
                for key in set(keys):
                    at = np.array([i for i, k in enumerate(keys) if k == key])
                    mine = np.frombuffer(b"".join(codes.take(pa.array(at)).to_pylist()), dtype=np.int8).reshape(len(at), -1).astype(np.float32)
                    cosine = mine @ pivots[key].T / np.maximum(np.linalg.norm(mine, axis=1, keepdims=True), 1e-9)
                    nearest[at] = np.where(cosine.max(axis=1) >= near, cosine.argmax(axis=1), -1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest)], schema.names)

        schema = large.withColumn("pivot", F.lit(0)).schema
        large = large.mapInArrow(run, schema)
    else:
        large = large.withColumn("pivot", F.lit(-1))
    large = written(large.drop("rows", "pivots"), "clustered")
    counts = large.groupBy("label", "d", "pivot").agg(F.count("*").alias("size"))
    parts = large.join(F.broadcast(counts) if few else counts, ["label", "d", "pivot"]).withColumn("parts", F.ceil(F.col("size") / tile))
    part = F.pmod(F.xxhash64("h1", "h2", F.lit(3)), F.col("parts"))
    return parts.withColumn("t", _tile(F.col("pivot"), part)).drop("pivot", "size", "parts")


def _tile(kind: Column, part: Column) -> Column:
    """Tiles are numbered by pivot and part; the rest is pivot -1, and blocks of rows from all pivots are -2."""
    return F.shiftleft(kind.cast("long"), 40) + part.cast("long")


def paired_tiles(rows: DataFrame, tile: int, threshold: float) -> DataFrame:
    """The rows of clustered() once for each group that they are compared in: i, j, and t, the side they are on. Tiles of pivots
    meet those that aren't too far; the rest's tiles meet each other, and all rows of pivots in blocks as large as a tile, so
    that a row of the rest doesn't go to every pivot."""
    tight, rest = rows.filter("t >= 0"), rows.filter("t < 0")
    near = tight.join(met_tiles(tight, threshold), ["label", "d", "t"]).withColumns({"i": F.least("t", "o"), "j": F.greatest("t", "o")}).drop("o")
    layout = rows.groupBy("label", "d").agg(F.ceil(F.count_if(F.col("t") < 0) / tile).alias("rests"), F.ceil(F.count_if(F.col("t") >= 0) / tile).alias("blocks"))
    up_to = lambda c: F.explode(F.when(F.col(c) > 0, F.sequence(F.lit(0).cast("long"), F.col(c) - 1)).otherwise(F.array().cast("array<bigint>")))
    own, others = rest.join(layout, ["label", "d"]), tight.join(layout, ["label", "d"])
    among = own.withColumn("o", up_to("rests")).withColumn("o", _tile(F.lit(-1), F.col("o"))).withColumns({"i": F.least("t", "o"), "j": F.greatest("t", "o")}).drop("o", "rests", "blocks")
    to_blocks = own.withColumn("i", up_to("blocks")).withColumn("i", _tile(F.lit(-2), F.col("i"))).withColumn("j", F.col("t")).drop("rests", "blocks")
    block = _tile(F.lit(-2), F.pmod(F.xxhash64("h1", "h2", F.lit(5)), F.col("blocks")))
    to_rest = others.withColumn("j", up_to("rests")).withColumn("j", _tile(F.lit(-1), F.col("j"))).withColumns({"t": block}).withColumn("i", F.col("t")).drop("rests", "blocks")
    return near.unionByName(among).unionByName(to_blocks).unionByName(to_rest)


def _ball(group: pa.Table) -> pa.Table:
    """A tile's mean direction and the greatest angle of a row from it, with room for the codes' errors."""
    d = group.column("d")[0].as_py()
    codes = np.frombuffer(b"".join(group.column("codes").to_pylist()), dtype=np.int8).reshape(-1, d).astype(np.float64)
    rows = codes * group.column("scale").to_numpy()[:, None]
    mean = rows.sum(axis=0)
    size = np.linalg.norm(mean)
    if size == 0:
        mean, size = rows[0], max(np.linalg.norm(rows[0]), 1e-9)
    # |u.c - (s q).c| is at most the error's norm, so the angle of u from c is at most that of the lower cosine
    cosine = rows @ (mean / size) - group.column("error").to_numpy() - SLACK
    angle = float(np.arccos(np.clip(cosine, -1, 1)).max())
    part = group.select(["label", "d", "t"]).slice(0, 1)
    return part.append_column("centre", pa.array([(mean / size).tolist()], pa.list_(pa.float64()))).append_column("angle", pa.array([angle]))


def met_tiles(rows: DataFrame, threshold: float) -> DataFrame:
    """(label, d, t, o): the tiles that a tile has to be compared with. Two tiles are far apart if the angle between their means,
    less the greatest angles of their rows, is over that of the threshold: then no pair of theirs reaches it."""
    balls = written(rows.groupBy("label", "d", "t").applyInArrow(_ball, "label string, d int, t long, centre array<double>, angle double"), "tile-balls")
    other = balls.select("label", "d", F.col("t").alias("o"), F.col("centre").alias("centre_o"), F.col("angle").alias("angle_o"))
    widest = float(np.arccos(np.clip(threshold - SLACK, -1, 1)))
    dot = F.aggregate(F.zip_with("centre", "centre_o", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    apart = F.acos(F.least(F.greatest(dot, F.lit(-1.0)), F.lit(1.0))) - F.col("angle") - F.col("angle_o")
    return balls.join(other, ["label", "d"]).filter(apart <= widest + 1e-6).select("label", "d", "t", "o")


def near_vectors(embeddings: DataFrame, threshold: float = 0.98, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``embeddings`` (vec_id, embedding, label).

    Rows of one non-null label and one length are linked if their cosine is ``threshold`` or more. ``n_links`` counts the
    other rows linked directly, ``component_id`` is the least vec_id reachable. Null, empty and zero vectors, vectors
    with a null or non-finite component, and rows without a label or vec_id are linked with nothing and kept. Rows that
    share a vec_id are counted each and are one node; vectors of any length are taken whole; an empty table gives an
    empty result; other columns are ignored. Every pair of different vectors of a label is compared, so the products
    grow with the square of a label's different vectors."""
    vector = F.col("embedding")
    fine = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
        & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))
    )
    given = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    keyed = given.withColumn("fine", F.coalesce(fine, F.lit(False))).withColumns({"h1": F.xxhash64("label", "embedding"), "h2": F.xxhash64("embedding", F.lit(7), "label")})
    classes = keyed.filter("fine").groupBy("h1", "h2").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"))
    firsts = keyed.filter("fine").select("h1", "h2", F.col("vec_id").alias("id"), "label", "embedding", F.size("embedding").alias("d")).join(classes, ["h1", "h2", "id"])
    rows = written(coded(firsts.dropDuplicates(["h1", "h2"])), "vectors")
    # rows of labels with several tiles go to the tiles that theirs has to be compared with; the others' are one tile
    large = clustered(rows, tile, threshold)
    sizes = rows.groupBy("label", "d").agg(F.count("*").alias("rows")).filter(F.col("rows") <= tile).select("label", "d")
    columns = ["label", "d", "i", "j", "t", "h1", "h2", "id", "weight", *CODED]
    zero = F.lit(0).cast("long")
    small = rows.join(sizes, ["label", "d"], "left_semi").select("label", "d", zero.alias("i"), zero.alias("j"), zero.alias("t"), "h1", "h2", "id", "weight", *CODED)
    paired = paired_tiles(large, tile, threshold).select(columns).unionAll(small.select(columns))

    def by_codes(group: pa.Table) -> pa.Table:
        codes, links, left, right = _group(group)
        open_ = np.zeros(group.num_rows, dtype=bool)
        for a, b, sure in codes.bounded(left, right, threshold):
            links.add(a[sure], b[sure])
            open_[a[~sure]] = open_[b[~sure]] = True
        return _table(group, links, open_)

    def in_full(group: pa.Table) -> pa.Table:
        codes, links, left, right = _group(group)
        units = _units(group.column("embedding").combine_chunks(), codes.codes.shape[1])
        for a, b, sure in codes.bounded(left, right, threshold):
            a, b = a[~sure], b[~sure]
            for k in range(0, len(a), EXACT_AT_ONCE):
                u, v = a[k : k + EXACT_AT_ONCE], b[k : k + EXACT_AT_ONCE]
                hit = np.einsum("ij,ij->i", units[u], units[v]) >= threshold
                links.add(u[hit], v[hit])
        return _table(group, links, np.zeros(group.num_rows, dtype=bool))

    found = written(paired.groupBy(*GROUP).applyInArrow(by_codes, RESULT), "vector-links")
    left = found.filter("n is null").select(*GROUP, "h1", "h2", "t").join(rows.select("h1", "h2", "id", "weight", "embedding", *CODED), ["h1", "h2"])
    more = written(left.groupBy(*GROUP).applyInArrow(in_full, RESULT), "vector-links")
    links = found.filter("n is not null").select("id", "n", "root").unionAll(more.select("id", "n", "root"))
    labels = components(links.select(F.col("id").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "id")
    by_class = classes.join(links.groupBy("id").agg(F.sum("n").alias("n")), "id", "left").join(labels, "id", "left")
    by_class = by_class.select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("label", "id").alias("component_id"), F.lit(True).alias("fine"), "weight")
    out = joined(keyed.select("vec_id", "h1", "h2", "fine"), written(by_class, "classes"), ["h1", "h2", "fine"], "weight", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
