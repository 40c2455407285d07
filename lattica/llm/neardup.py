"""MinHash near-duplicates by an LSH forest.

Texts with equal shingle sets form a class (told by a 128-bit digest of the set); one row a class goes on. The forest
holds several trees, each one fixed permutation of the places of the MinHash signature. The rows of a tree are sorted by
the permuted signature, so that the neighbours of a row are those with the longest common prefix, and those are its first
candidates. A region of a tree is what shares a prefix of the region's depth, and depth adapts: where too many different
components share a prefix, their rows go on to a longer prefix of the same trees, and of more trees over longer
signatures. Depths, trees and values follow from the threshold (``levels``): a pair exactly at it shares no prefix with
odds of 1e-5 or less at each depth.

Candidates are not all pairs of a region. First neighbours in a few trees are tested, then the neighbours in all trees
that are still apart; and only rows then outside the main component of a region meet all of it and its other outsiders.
Every link is confirmed on the full sets, and two rows of one component need no further test. So components are those of
the whole graph, while a large group of copies costs time in proportion to its size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import BROADCAST_ROWS, WordHashes, dropped, joined, sliced, space_words, texts, written
from lattica.llm.components import components
from lattica.llm.vectors import roots
from lattica.operators.numbering import unused

#: Odds of a pair at the threshold to share no prefix, at each depth.
MISS = 1e-5
#: Values a signature may have at the deeper levels; at the first the trees share no value.
VALUES = (128, 192, 256, 384, 512, 768, 1024)
#: A region with more components than this is searched deeper (at the last depth none is).
REGION_COMPONENTS = 512
#: Trees whose neighbours are tested first: enough to join most of a large group of copies.
FIRST_TREES = 3
#: Outer and inner rows of a tile, and bytes of either's sets, about.
TILE, TILE_BYTES = (256, 1024), 4 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(20)
MULTIPLIERS = _random.integers(0, 1 << 63, VALUES[-1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADDENDS = _random.integers(0, 1 << 63, VALUES[-1], dtype=np.uint64)


def miss(share: float, depth: int, trees: int, values: int) -> float:
    """Odds that two rows of similarity ``share`` share no prefix, over trees drawn at random: the mean, over how many (m) of
    the values agree, of (1 - C(m, depth) / C(values, depth)) ** trees."""
    m = range(values + 1)
    log_c = [math.lgamma(values + 1) - math.lgamma(k + 1) - math.lgamma(values - k + 1) for k in m]
    return sum(math.exp(log_c[k] + k * math.log(share) + (values - k) * math.log(1 - share)) * (1 - math.comb(k, depth) / math.comb(values, depth)) ** trees for k in m)


def levels(share: float) -> list[tuple[int, int, int]]:
    """(depth, trees, values of the signature) of each level, for links at ``share`` (0.5 or more) and above."""
    if not 0.5 <= share < 1:
        raise ValueError("the forest is made for similarities from 0.5 up to, not including, 1")
    base, out = min(4, max(1, round(math.log(0.41) / math.log(share)))), []
    for depth in (base, 2 * base, 3 * base):
        alone = -(-math.ceil(math.log(MISS) / math.log(1 - share**depth)) // 8) * 8
        if not out:
            out.append((depth, alone, depth * alone))
            continue
        fit = ((depth, t, v) for v in VALUES if v >= out[-1][2] for t in range(alone, 2 * alone + 8, 8) if miss(share, depth, t, v) <= MISS)
        out.append(next(fit))
    return out


def forest(plan: list[tuple[int, int, int]]) -> np.ndarray:
    """The order in which each tree reads the signature, as far as the deepest level does. A tree's order is the same at all
    levels; trees of a level read the values it has. Those of the first level start with values of their own."""
    random, deepest, orders = np.random.default_rng(7), plan[-1][0], []
    for level, (depth, trees, values) in enumerate(plan):
        lead = random.permutation(values).reshape(-1, depth) if not level else np.zeros((trees, 0), dtype=int)
        for tree in range(len(orders), trees):
            order = random.permutation(values)
            orders.append(np.concatenate([lead[tree], order[~np.isin(order, lead[tree])]])[:deepest])
    return np.array(orders)


def shingle_set(words: list[bytes], width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; the whole sequence is one if it has fewer words than a shingle."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(len(h) - width + 1, 1)
    out = np.full(n, min(width, len(h)), dtype=np.uint64)
    for j in range(min(width, len(h))):
        out = out * MIX + h[j : j + n]
    return np.unique(out ^ (out >> np.uint64(29)))


def signature(shingles: np.ndarray, values: int) -> bytes:
    out = np.full(values, 0xFFFFFFFF, dtype=np.uint64)
    for start in range(0, len(shingles), 2048):
        part = shingles[start : start + 2048]
        out = np.minimum(out, ((part[:, None] * MULTIPLIERS[:values] + ADDENDS[:values]) >> np.uint64(32)).min(axis=0))
    return out.astype(np.uint32).tobytes()


def features(documents: DataFrame, width: int, least: int, values: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set (two longs), signature of ``values`` (null for sets smaller than ``least``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in sliced(batches):
            sizes, one, two, signatures = [], [], [], []
            for text in texts(batch):
                s = shingle_set(space_words(text), width, hashes)
                digest = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype=np.int64)
                sizes.append(len(s))
                one.append(int(digest[0]))
                two.append(int(digest[1]))
                signatures.append(signature(s, values) if len(s) >= least else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(signatures, pa.binary())],
                ["doc_id", "n_shingles", "d1", "d2", "signature"],
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, d1 long, d2 long, signature binary"
    )


def sets_of(documents: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, n, shingles) of the documents whose doc_id is in ``ids`` (id, distinct)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in sliced(batches):
            found = [shingle_set(space_words(t), width, hashes) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], ["id", "n", "shingles"])

    few = ids.count() <= BROADCAST_ROWS
    rows = documents.select(F.col("doc_id").cast("long").alias("id"), "text")
    return rows.join(F.broadcast(ids) if few else ids, "id", "left_semi").mapInArrow(run, "id long, n long, shingles binary")


def signed(sets: DataFrame, values: int) -> DataFrame:
    """(id, n, signature) of ``sets`` (id, n, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "shingles"):
            found = [signature(np.frombuffer(s.as_buffer(), dtype=np.uint64), values) for s in batch.column("shingles")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n"), pa.array(found, pa.binary())], ["id", "n", "signature"])

    return sets.select("id", "n", "shingles").mapInArrow(run, "id long, n long, signature binary")


def tree_rows(rows: DataFrame, orders: np.ndarray, values: int) -> tuple[DataFrame, list[str]]:
    """(tree, w0, w1, .., id, n): each row once a tree, with the first of the signature's values in the tree's order, 16 bits
    of each, four to a word. Sorted by the words, rows with a longer common prefix are closer."""
    trees, depth = orders.shape
    names = [f"w{k}" for k in range(-(-depth // 4))]
    padded = 4 * len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                ids, sizes = part.column("id").to_numpy(), part.column("n").to_numpy()
                held = np.frombuffer(b"".join(part.column("signature").to_pylist()), dtype=np.uint32).reshape(len(ids), values)
                read = np.zeros((trees, len(ids), padded), dtype=np.uint64)
                read[:, :, :depth] = (held[:, orders] & 0xFFFF).transpose(1, 0, 2)
                read = read.reshape(-1, len(names), 4)
                words = (read[:, :, 0] << np.uint64(48)) | (read[:, :, 1] << np.uint64(32)) | (read[:, :, 2] << np.uint64(16)) | read[:, :, 3]
                columns = [np.repeat(np.arange(trees, dtype=np.int32), len(ids)), *(np.ascontiguousarray(words[:, k]).view(np.int64) for k in range(len(names))), np.tile(ids, trees), np.tile(sizes, trees)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["tree", *names, "id", "n"])

    return rows.select("id", "n", "signature").mapInArrow(run, f"tree int, {', '.join(f'{w} long' for w in names)}, id long, n long"), names


class Walk:
    """Walks through the sorted rows of a partition, batch by batch: which rows share a prefix of ``depth``, and the neighbour
    before each. A row is decided when the next one is known."""

    def __init__(self, words: int, depth: int, numerator: int, denominator: int):
        self.numerator, self.denominator = numerator, denominator
        kept = [min(4, max(0, depth - 4 * k)) for k in range(words)]
        self.masks = np.array([((1 << 64) - (1 << (64 - 16 * k))) & ((1 << 64) - 1) for k in kept], dtype=np.uint64)
        self.held: tuple[np.ndarray, ...] | None = None

    def regions(self, tree: np.ndarray, words: np.ndarray) -> np.ndarray:
        out = (tree.astype(np.uint64) + np.uint64(1)) * MIX
        for w, mask in zip(words, self.masks, strict=True):
            out = (out ^ (w.view(np.uint64) & mask)) * MIX
            out ^= out >> np.uint64(31)
        return out.view(np.int64)

    def step(self, tree: np.ndarray, words: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Adds rows; returns (region, tree, id, other, fit, edge) of those decided. ``other``: the row before, and ``fit``: it
        shares the prefix and its set's size allows a link. ``edge``: at an end of the partition, so that rows of its
        region may lie in the next one."""
        region = self.regions(tree, words)
        same = np.zeros(len(ids), dtype=bool)
        same[1:] = region[1:] == region[:-1]
        edge, before, before_size = np.zeros(len(ids), dtype=bool), np.roll(ids, 1), np.roll(sizes, 1)
        if self.held is None:
            edge[0] = True
        else:
            same[0] = self.held[0][0] == region[0]
            before[0], before_size[0] = self.held[2][0], self.held[6][0]
        fit = same & (before != ids) & (self.denominator * np.minimum(sizes, before_size) >= self.numerator * np.maximum(sizes, before_size))
        now = (region, tree, ids, before, fit, edge, sizes, same)
        if self.held is not None:
            now = tuple(np.concatenate([h, x]) for h, x in zip(self.held, now, strict=True))
        self.held = tuple(x[-1:] for x in now)
        shared = now[7][:-1] | now[7][1:] | now[5][:-1]
        return tuple(x[:-1][shared] for x in now[:6])

    def rest(self) -> tuple[np.ndarray, ...]:
        """The last row, which is at the partition's end."""
        if self.held is None:
            return ()
        return (*self.held[:5], np.ones(1, dtype=bool))


def sorted_members(rows: DataFrame, orders: np.ndarray, values: int, depth: int, numerator: int, denominator: int) -> DataFrame:
    """(region, tree, id, other, edge) of the rows that share a prefix of ``depth`` in some tree. All trees are dealt by range
    and sorted in one shuffle; a range ends anywhere, also within a region, so no region is too large for a task."""
    found, names = tree_rows(rows, orders, values)
    key = ["tree", *names, "id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk(len(names), depth, numerator, denominator)

        def out(region, tree, ids, other, fit, edge) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(region), pa.array(tree), pa.array(ids), pa.array(other, mask=~fit), pa.array(edge)], ["region", "tree", "id", "other", "edge"])

        for batch in batches:
            if batch.num_rows:
                yield out(*walk.step(batch.column("tree").to_numpy(), np.stack([batch.column(w).to_numpy() for w in names]), batch.column("id").to_numpy(), batch.column("n").to_numpy()))
        if last := walk.rest():
            yield out(*last)

    return found.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(run, "region long, tree int, id long, other long, edge boolean")


def confirmed(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough. One set a pair is shuffled."""
    one = pairs.join(sets.select(F.col("id").alias("u"), F.col("shingles").alias("a")), "u")
    both = one.join(sets.select(F.col("id").alias("v"), F.col("shingles").alias("b")), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = []
            for a, b in zip(batch.column("a"), batch.column("b"), strict=True):
                x, y = np.frombuffer(a.as_buffer(), dtype=np.uint64), np.frombuffer(b.as_buffer(), dtype=np.uint64)
                merged = np.concatenate([x, y])
                merged.sort(kind="stable")  # two sorted runs: a merge
                common = int((merged[1:] == merged[:-1]).sum())
                hits.append(common > 0 and denominator * common >= numerator * (len(merged) - common))
            keep = pa.array(hits, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("u").filter(keep), batch.column("v").filter(keep)], ["u", "v"])

    return both.select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def compared_pairs(ids: np.ndarray, labels: np.ndarray, outer: np.ndarray, sets: list[np.ndarray], numerator: int, denominator: int) -> tuple[np.ndarray, np.ndarray]:
    """(u, v) that span the links between outer rows and all inner ones of another label. Intersections are counted exactly:
    pair by pair for a few, else as products of 0/1 matrices over blocks of the shingles that two rows at least hold."""
    x, y = np.flatnonzero(outer), np.flatnonzero(~outer)
    if not len(x) or not len(y):
        return ids[:0], ids[:0]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    near = denominator * np.minimum(sizes[x][:, None], sizes[y][None, :]) >= numerator * np.maximum(sizes[x][:, None], sizes[y][None, :])
    near &= labels[x][:, None] != labels[y][None, :]
    both = np.zeros(near.shape, dtype=np.int64)
    if near.sum() <= 64:
        for i, j in np.argwhere(near):
            both[i, j] = len(np.intersect1d(sets[x[i]], sets[y[j]], assume_unique=True))
    else:
        _, place, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), sizes)
        common = held > 1
        number = np.cumsum(common) - 1
        row, place = row[common[place]], number[place[common[place]]]
        for start in range(0, int(common.sum()), 4096):
            part = (place >= start) & (place < start + 4096)
            block = np.zeros((len(sets), 4096), dtype=np.float32)
            block[row[part], place[part] - start] = 1
            both += np.rint(block[x] @ block[y].T).astype(np.int64)
    hit = near & (both > 0) & (denominator * both >= numerator * (sizes[x][:, None] + sizes[y][None, :] - both))
    a, b = np.nonzero(hit)
    known, at = np.unique(ids, return_inverse=True)
    root = roots(len(known), at[x[a]], at[y[b]])
    moved = np.flatnonzero(root != np.arange(len(root)))
    return known[moved], known[root[moved]]


def compared(rows: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Links (u, v), confirmed on full sets, that join the same components as all links between the outer and inner rows of
    each region, for ``rows`` (region, id, label, outer) without repeats. Outer and inner rows of a region are dealt to
    tiles of bounded rows and bytes, and each pair of tiles is compared in one place; no pair is ever a row."""
    width = F.col("n") * 8
    sized = rows.join(sets.select("id", "n"), "id").groupBy("region").agg(
        F.count("*").alias("rows"),
        F.greatest(F.sum(F.col("outer").cast("long")) / TILE[0], F.sum(F.when(F.col("outer"), width)) / TILE_BYTES).alias("x"),
        F.greatest(F.sum((~F.col("outer")).cast("long")) / TILE[1], F.sum(F.when(~F.col("outer"), width)) / TILE_BYTES).alias("y"),
    )
    sized = written(sized.filter("x > 0 and y > 0").select("region", "rows", F.ceil("x").cast("int").alias("x"), F.ceil("y").cast("int").alias("y")), "tiles")
    own = F.when(F.col("outer"), F.col("x")).otherwise(F.col("y"))
    other = F.when(F.col("outer"), F.col("y")).otherwise(F.col("x"))
    dealt = joined(rows, sized, ["region"]).withColumns({"own": F.pmod(F.xxhash64("id", F.lit(5)), own).cast("int"), "other": other})
    dealt = dealt.join(sets.select("id", "shingles"), "id").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("other") - 1)))
    dealt = dealt.select("region", F.when(F.col("outer"), F.col("own")).otherwise(F.col("o")).alias("i"), F.when(F.col("outer"), F.col("o")).otherwise(F.col("own")).alias("j"), "id", "label", "outer", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None

        def out() -> pa.RecordBatch:
            group = pa.Table.from_batches(held)
            sets = [np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in group.column("shingles")]
            u, v = compared_pairs(*(group.column(c).to_numpy() for c in ("id", "label", "outer")), sets, numerator, denominator)
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("region", "i", "j")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:], strict=False):
                if start == end:
                    continue
                now = tuple(keys[:, start].tolist())
                if held and now != key:
                    yield out()
                    held = []
                key = now
                held.append(batch.slice(start, end - start))
        if held:
            yield out()

    return dealt.repartition("region", "i", "j").sortWithinPartitions("region", "i", "j").mapInArrow(run, "u long, v long")


class Linked:
    """The labels so far, as a written table (node, label) of the linked rows."""

    def __init__(self, rows: DataFrame):
        self.labels = rows.sparkSession.createDataFrame([], "node long, label long")

    def take(self, links: DataFrame) -> None:
        links = written(links, "links")
        if links.limit(1).count():
            known = self.labels.filter("node <> label").select(F.col("node").alias("u"), F.col("label").alias("v"))
            last, self.labels = self.labels, written(components(links.unionAll(known)), "labels")
            dropped(last)
        dropped(links)

    def on(self, rows: DataFrame, column: str = "id") -> DataFrame:
        """Adds ``label``: that of the row's component, or the row itself."""
        return rows.join(self.labels.withColumnRenamed("node", column), column, "left").withColumn("label", F.coalesce("label", column))


def main_components(linked: Linked, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members with their labels; and of each region with several components that hasn't been tested as a pair of
    neighbours: its rows, how many components it has (``k``) and the label of the largest (``main``)."""
    known = linked.on(members.select("region", "id", "edge"))
    each = known.groupBy("region", "label").agg(F.count("*").alias("n"), F.max("edge").alias("edge"))
    mains = each.groupBy("region").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("k"), F.sum("n").alias("rows"), F.max("edge").alias("edge"))
    return known.select("region", "id", "label"), mains.filter("k > 1 and (rows > 2 or edge)").select("region", "main", "k", "rows")


def forest_links(documents: DataFrame, rows: DataFrame, width: int, numerator: int, denominator: int, start: int = 0) -> Linked:
    """Components over ``rows`` (id, n, signature of the level ``start``), found by the forest and confirmed on the sets of
    ``documents``. Only rows that go deeper get the longer signatures of the deeper levels."""
    plan = levels(numerator / denominator)
    orders = forest(plan)
    linked, active = Linked(rows), rows
    for level in range(start, len(plan)):
        depth, trees, values = plan[level]
        last = level + 1 == len(plan)
        read = orders[:trees, : depth if last else plan[level + 1][0]]
        members = written(sorted_members(active, read, values, depth, numerator, denominator), "members")
        ids = written(members.select("id").distinct(), "candidates")
        sets = written(sets_of(documents, ids, width), "sets")
        pairs = members.filter("other is not null").select("tree", F.least("id", "other").alias("u"), F.greatest("id", "other").alias("v"))
        linked.take(confirmed(pairs.filter(F.col("tree") < FIRST_TREES).select("u", "v").distinct(), sets, numerator, denominator))
        apart = linked.on(linked.on(pairs.select("u", "v").distinct(), "u").withColumnRenamed("label", "lu"), "v").filter("lu <> label").select("u", "v")
        linked.take(confirmed(apart, sets, numerator, denominator))
        # what is still outside a main component, and all of it and of its other outsiders
        known, mains = main_components(linked, members)
        mains = written(mains, "mains")
        known = written(joined(known, mains, ["region"]).select("region", "id", "label", "main", "k"), "known")
        near = known if last else known.filter(F.col("k") <= REGION_COMPONENTS)
        outside = near.filter("label <> main").select(F.col("main").alias("region"), "id", "label").distinct()
        inside = linked.on(ids).select(F.col("label").alias("region"), "id", "label").join(outside.select("region").distinct(), "region", "left_semi")
        rows_of = lambda r, outer: r.select("region", "id", "label", F.lit(outer).alias("outer"))
        linked.take(compared(rows_of(outside, True).unionAll(rows_of(outside, False)).unionAll(rows_of(inside, False)), sets, numerator, denominator))
        if not last:
            deeper = written(known.filter(F.col("k") > REGION_COMPONENTS).select("id").distinct(), "deeper")
            longer = written(signed(sets.filter("n > 0").join(deeper, "id", "left_semi"), plan[level + 1][2]), "signatures")
        for used in (known, mains, members, ids, sets):
            dropped(used)
        if last or not deeper.limit(1).count():
            break
        active = longer
    return linked


def near_duplicates(documents: DataFrame, width: int = 5, numerator: int = 80, denominator: int = 100, start: int = 0) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``documents`` (doc_id, text).

    Words are runs other than white space, A-Z lower-cased; a set holds the distinct ``width``-word shingles, or the
    whole sequence of a shorter text. Two rows are linked if denominator * intersection >= numerator * union, which must
    be half or more. ``component_id`` is the least doc_id reachable. ``start``: the level of the forest at which the search
    begins; deeper ones cost more and find the same.

    Defined results: null and empty texts, and texts of white space, have an empty set and are linked with nothing; very
    long texts are compared by their whole sets; a null doc_id is linked with nothing, its component_id is null and it is
    kept; rows that share a doc_id are one node; an empty table gives an empty result; other columns are ignored."""
    equal = numerator >= denominator  # only equal sets are linked: no forest
    least = 1 << 62 if equal else -(-numerator // (denominator - numerator))
    values = 1 if equal else levels(numerator / denominator)[start][2]
    found = written(features(documents, width, least, values), "features")
    classes = found.filter("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("id"), F.count("*").alias("rows"))
    rows = found.filter("signature is not null").select("d1", "d2", F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "signature")
    rows = written(rows.join(classes, ["d1", "d2", "id"], "left_semi").select("id", "n", "signature"), "forest")
    linked = Linked(rows) if equal else forest_links(documents, rows, width, numerator, denominator, start)
    by_set = written(linked.on(classes).select("d1", "d2", F.col("label").alias("component_id"), "rows"), "classes")
    out = joined(found.select("doc_id", "n_shingles", "d1", "d2"), by_set, ["d1", "d2"], how="left")
    component = F.when((F.col("n_shingles") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    dropped(rows)
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(documents: DataFrame, width: int = 5, numerator: int = 80, denominator: int = 100) -> DataFrame:
    """The documents, with their own columns, less all but one row of each component: that with the least doc_id, null ids
    last. Where doc_ids repeat or are null, rows are told apart by a number of their own, so that rows which only share an
    id all stay, and equal texts under null ids don't."""
    ids = documents.groupBy("doc_id").count()
    if not ids.filter("doc_id is null or count > 1").limit(1).count():
        gone = written(near_duplicates(documents, width, numerator, denominator).filter("not kept").select("doc_id"), "near")
        small = gone.count() <= BROADCAST_ROWS
        return documents.join(F.broadcast(gone) if small else gone, "doc_id", "left_anti").select(*documents.columns)
    row = unused(documents, "row")
    rows = written(documents.withColumn(row, F.monotonically_increasing_id()), "rows")
    near = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), width, numerator, denominator)
    near = near.select(F.col("doc_id").alias(row), "component_id").join(rows.select(row, "doc_id"), row)
    kept = near.groupBy("component_id").agg(F.min_by(row, F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias(row)).select(row)
    return rows.join(kept, row, "left_semi").select(*documents.columns)
