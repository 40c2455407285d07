"""Benchmark decontamination by training suffix arrays.

The words of the benchmark are numbered once. Its items are dealt to blocks of bounded size, and tasks turn each block
into one file: the suffixes of its items in sorted order. Each slice of the training texts is a shard: the suffixes that
can hold a whole window are sorted (a suffix array down to the window's depth), every test suffix is found in it by
binary search, and each place found is lengthened word by word within the sorted test suffixes to its longest verbatim
match. Documents stay where they are: nothing of them is shuffled, they are read once, and the blocks' files are
memory-mapped one after the other.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import alnum_words, dropped, sliced, stored_bytes, texts, written
from lattica.operators.numbering import unused

WINDOW = 13
#: Words of a block, about.
BLOCK_WORDS = 2_000_000
#: Windows that are searched for at once.
PROBES = 1 << 18
#: Matches are lengthened by so many words at once (powers of two over the window), as far as items are that long.
STRIDES = (16, 256, 4096)


def suffix_array(ids: np.ndarray) -> np.ndarray:
    return suffix_order(ids)[0]


def suffix_order(ids: np.ndarray, keep: tuple[int, ...] = ()) -> tuple[np.ndarray, list[np.ndarray]]:
    """The places of ``ids`` in the order of their suffixes, by doubling; and for each length in ``keep``, powers of two, the
    ranks by which places share a number if so many words from there on are the same."""
    n, step, ranks = len(ids), 1, {}
    _, rank = np.unique(ids, return_inverse=True)
    order = np.argsort(rank, kind="stable")
    while n and rank[order[-1]] < n - 1 and step < n:
        if step in keep:
            ranks[step] = rank
        key = rank * np.int64(n + 1)
        key[:-step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        new = np.empty(n, dtype=np.int64)
        new[order] = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]))
        rank, step = new, 2 * step
    return order, [ranks.get(k, rank) for k in keep]


@dataclass
class TestBlock:
    """A block of benchmark items: ``flat`` holds their words' numbers with a 0 after each, ``starts`` where each begins,
    ``places`` the starts of whole windows in the order of their suffixes, ``groups`` where each different window begins
    among these, ``short`` the items of fewer words than a window, which are one window each. ``ranks`` has for each stride a
    number a place: it is shared by places with so many equal words, and grows in the order of suffixes."""

    __test__ = False

    flat: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    groups: np.ndarray
    short: np.ndarray
    names: list[str]
    window: int
    ranks: list[np.ndarray]

    @staticmethod
    def built(items: list[tuple[str, list[int]]], window: int = WINDOW) -> bytes:
        flat = np.array([i for _, ids in items for i in (*ids, 0)], dtype=np.int64)
        sizes = np.array([len(ids) for _, ids in items], dtype=np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        left = np.repeat(starts + sizes, sizes + 1) - np.arange(len(flat))
        order, ranks = suffix_order(flat, tuple(k for k in STRIDES if window < k <= sizes.max(initial=0)))
        places = order[left[order] >= window]
        new = np.zeros(len(places), dtype=bool)
        new[:1] = True
        for j in range(window):
            column = flat[places + j]
            new[1:] |= column[1:] != column[:-1]
        arrays = [flat, starts, places, np.flatnonzero(new), np.flatnonzero((sizes > 0) & (sizes < window)), *ranks]
        head = json.dumps({"sizes": [len(a) for a in arrays], "names": [name for name, _ in items], "window": window}).encode()
        head += b" " * (-len(head) % 4)
        return b"".join([np.array([len(head)], dtype=np.int32).tobytes(), head, *(a.astype(np.int32).tobytes() for a in arrays)])

    @classmethod
    def mapped(cls, path: str) -> TestBlock:
        size = int(np.memmap(path, dtype=np.int32, mode="r", shape=(1,))[0])
        head = json.loads(np.memmap(path, dtype=np.uint8, mode="r", offset=4, shape=(size,)).tobytes())
        body = np.memmap(path, dtype=np.int32, mode="r", offset=4 + size)
        cuts = np.cumsum([0, *head["sizes"]])
        parts = [body[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return cls(*parts[:5], head["names"], head["window"], parts[5:])

    def item(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, side="right") - 1

    def windows(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(number, words as columns with 0 behind the end, width) of all windows, so many at once. Short items are numbered
        behind the groups."""
        for k in range(0, len(self.groups), PROBES):
            at = self.places[self.groups[k : k + PROBES]].astype(np.int64)
            yield np.arange(k, k + len(at)), np.stack([self.flat[at + j] for j in range(self.window)]), np.full(len(at), self.window)
        for k in range(0, len(self.short), PROBES):
            at = self.starts[self.short[k : k + PROBES]].astype(np.int64)
            columns, going = np.zeros((self.window, len(at)), dtype=np.int64), np.ones(len(at), dtype=bool)
            for j in range(self.window):
                word = self.flat[np.minimum(at + j, len(self.flat) - 1)]
                going &= word != 0
                columns[j] = np.where(going, word, 0)
            yield len(self.groups) + np.arange(k, k + len(at)), columns, (columns != 0).sum(axis=0)

    def longest(self, ids: np.ndarray, at: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many words of ``ids`` from each place of ``at``, in order, stand in some item, and where there, given the window
        there. Places of ``at`` that have a whole stride learn its number; matches are then lengthened by the longest stride
        first, so that the work grows with the places, not with the lengths of their matches."""
        low, high = self.groups[group].astype(np.int64), np.append(self.groups, len(self.places))[group + 1].astype(np.int64)
        length, number = np.full(len(at), self.window, dtype=np.int64), np.full(len(ids) + 1, -1, dtype=np.int64)
        number[at] = np.arange(len(at))
        strides = [1, *(k for k in STRIDES if k > self.window)][: 1 + len(self.ranks)]
        of_place = [ids] + [np.full(len(at), -1, dtype=np.int64) for _ in self.ranks]  # what has to follow, by stride

        def lengthened(who: np.ndarray, k: int) -> np.ndarray:
            """Those of ``who`` that go on by stride k; their bounds are narrowed to it."""
            ahead = at[who] + length[who]
            who, ahead = who[ahead < len(ids)], ahead[ahead < len(ids)]
            if k:
                met = number[ahead]
                wanted = np.where(met < 0, -1, of_place[k][met])
                there = wanted >= 0
            else:
                wanted = ids[ahead]
                there = wanted != 0
            who, wanted = who[there], wanted[there]
            keys, bounds = self.ranks[k - 1] if k else self.flat, []
            for after in (False, True):
                lo, hi = low[who].copy(), high[who].copy()
                while (open_ := lo < hi).any():
                    mid = np.where(open_, (lo + hi) >> 1, 0)
                    x = keys[np.minimum(self.places[mid].astype(np.int64) + length[who], len(self.flat) - 1)]
                    right = (x <= wanted) if after else (x < wanted)
                    lo, hi = np.where(open_ & right, mid + 1, lo), np.where(open_ & ~right, mid, hi)
                bounds.append(lo)
            more = bounds[0] < bounds[1]
            who = who[more]
            low[who], high[who] = bounds[0][more], bounds[1][more]
            length[who] += strides[k]
            return who

        whole = np.arange(len(at))
        for k in range(1, len(strides)):  # by the stride below up to this one
            while len(whole) and (going := whole[length[whole] < strides[k]]).size:
                gone = np.setdiff1d(going, lengthened(going, k - 1), assume_unique=True)
                whole = np.setdiff1d(whole, gone, assume_unique=True)
            of_place[k][whole] = self.ranks[k - 1][self.places[low[whole]]]
        for k in reversed(range(len(strides))):
            going = np.flatnonzero(length >= strides[k])
            while len(going):
                going = lengthened(going, k)
        return length, self.places[low].astype(np.int64)


class Shard:
    """Suffix array of a slice of training texts (0: a word outside the benchmark, or an end), to the depth of a window. Only
    suffixes that hold ``least`` words of the benchmark are in it."""

    def __init__(self, ids: np.ndarray, bits: int, least: int, window: int):
        self.bits, self.per, self.window = bits, max(1, 63 // bits), window
        ends = np.where(ids == 0, np.arange(len(ids)), len(ids))
        run = np.minimum.accumulate(ends[::-1])[::-1] - np.arange(len(ids))
        self.suffixes = np.flatnonzero(run >= least)
        tail = np.concatenate([ids, np.zeros(window, dtype=np.int64)])
        self.keys = self._packed([tail[self.suffixes + j] for j in range(window)])
        order = np.lexsort(self.keys[::-1])
        self.suffixes, self.keys = self.suffixes[order], [k[order] for k in self.keys]

    def _packed(self, columns: list[np.ndarray]) -> list[np.ndarray]:
        out = []
        for k in range(0, self.window, self.per):
            part = columns[k : k + self.per]
            key = np.zeros(len(columns[0]), dtype=np.int64)
            for c in part:
                key = (key << self.bits) | c
            out.append(key << (self.bits * (self.per - len(part))))
        return out

    def found(self, columns: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the slice, window) of every occurrence of the windows."""
        if not len(self.suffixes):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        beyond = np.arange(self.window)[:, None] >= widths[None, :]
        low, high = self._packed(list(columns)), self._packed(list(np.where(beyond, (1 << self.bits) - 1, columns)))
        lo, hi = np.searchsorted(self.keys[0], low[0]), np.searchsorted(self.keys[0], high[0], side="right")
        some = np.flatnonzero(lo < hi)
        lo, hi = self._bound(low, some, lo, hi, False), self._bound(high, some, lo, hi, True)
        count = np.maximum(hi - lo, 0)
        window = np.repeat(some, count)
        at = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
        return self.suffixes[at], window

    def _bound(self, probes: list[np.ndarray], some: np.ndarray, lo: np.ndarray, hi: np.ndarray, after: bool) -> np.ndarray:
        """For each probe of ``some`` the first suffix that isn't before it (``after``: nor equal), by binary search."""
        lo, hi, probes = lo[some], hi[some], [p[some] for p in probes]
        while (open_ := lo < hi).any():
            mid = np.where(open_, (lo + hi) >> 1, 0)
            less, equal = np.zeros(len(lo), dtype=bool), np.ones(len(lo), dtype=bool)
            for k, p in zip(self.keys, probes, strict=True):
                x = k[mid]
                less |= equal & (x < p)
                equal &= x == p
            right = (less | equal) if after else less
            lo, hi = np.where(open_ & right, mid + 1, lo), np.where(open_ & ~right, mid, hi)
        return lo


@dataclass
class Benchmark:
    """What tasks need: the broadcast vocabulary, the names of the blocks' files, and the words of the shortest window."""

    vocabulary: object
    files: list[str]
    least: int
    window: int


def indexed(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Benchmark:
    """Builds the blocks of (item_id, text) in tasks. The driver gets the different words of the benchmark, and hands on one
    block's file at a time."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            words = [alnum_words(t) for t in texts(batch)]
            different = sorted({w for part in words for w in part})
            sizes = [sum(map(len, words))] + [0] * len(different)
            yield pa.RecordBatch.from_arrays([pa.array([b"", *different], pa.binary()), pa.array(sizes, pa.int64())], ["word", "n"])

    words = {bytes(r[0]): r[1] for r in items.mapInArrow(words_of, "word binary, n long").groupBy("word").agg(F.sum("n")).toLocalIterator()}
    total = words.pop(b"", 0)
    vocabulary = spark.sparkContext.broadcast({w: k + 1 for k, w in enumerate(sorted(words))})

    def build(group: pa.Table) -> pa.Table:
        get, held = vocabulary.value.__getitem__, []
        for batch in group.to_batches():
            for name, text in zip(batch.column("item").to_pylist(), texts(batch), strict=True):
                if ids := [get(w) for w in alnum_words(text)]:
                    held.append((name, ids))
        data = TestBlock.built(sorted(held), window)
        return pa.table({"data": pa.array([data], pa.binary()), "least": pa.array([min((min(len(i), window) for _, i in held), default=window)], pa.int32())})

    files, least = [], window
    if total:
        blocks = items.distinct().withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(-(-total // block_words))))
        made = written(blocks.groupBy("block").applyInArrow(build, "data binary, least int"), "benchmark-blocks")
        for data, shortest in made.toLocalIterator():
            path = stored_bytes(spark, "benchmark", bytes(data))
            spark.sparkContext.addFile(path)
            files.append(path.rpartition("/")[2])
            least = min(least, shortest)
        dropped(made)
    return Benchmark(vocabulary, files, least, window)


def matched(batch: pa.RecordBatch, test: Benchmark) -> tuple[list[list[bytes]], np.ndarray, Iterator[tuple]]:
    """The words of a slice's texts and where each text starts among them all; and for each block (block, matches, windows).
    matches: (place, words, place in the block) of every longest match that isn't part of the one before, and of every
    occurrence of a short item; windows: (place, item numbers) of each different window in each text."""
    words = [alnum_words(t) for t in texts(batch)]
    get, flat, starts = test.vocabulary.value.get, [], []
    for part in words:
        starts.append(len(flat))
        flat.extend([get(w, 0) for w in part])
        flat.append(0)
    ids, starts = np.array(flat, dtype=np.int64), np.array(starts, dtype=np.int64)
    shard = Shard(ids, max(1, len(test.vocabulary.value).bit_length()), test.least, test.window)

    def run() -> Iterator[tuple]:
        for name in test.files if len(shard.suffixes) else []:
            block = TestBlock.mapped(SparkFiles.get(name))
            at, window = [], []
            for numbers, columns, widths in block.windows():
                a, w = shard.found(columns, widths)
                at.append(a)
                window.append(numbers[w])
            at, window = np.concatenate(at), np.concatenate(window)
            whole = window < len(block.groups)
            order = np.argsort(at[whole], kind="stable")
            a, g = at[whole][order], window[whole][order]
            length, place = block.longest(ids, a, g)
            first = np.ones(len(a), dtype=bool)
            first[1:] = (a[1:] != a[:-1] + 1) | (length[1:] > length[:-1] - 1)
            short = block.short[window[~whole] - len(block.groups)]
            ends = np.append(block.starts, len(block.flat)).astype(np.int64)
            matches = [
                np.concatenate([x, y]) for x, y in zip((a[first], length[first], place[first]), (at[~whole], ends[short + 1] - ends[short] - 1, ends[short]), strict=True)
            ]
            # each different window of a text once: which items hold it
            doc = np.searchsorted(starts, at, side="right") - 1
            n = len(block.groups) + len(block.short)
            pairs = [divmod(k, n) for k in np.unique(doc * n + window).tolist()]
            bounds = np.append(block.groups, len(block.places)).astype(np.int64)
            held = [(d, np.unique(block.item(block.places[bounds[w] : bounds[w + 1]])) if w < len(block.groups) else block.short[w - len(block.groups) :][:1]) for d, w in pairs]
            yield block, matches, held

    return words, starts, run()


OURS = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match"]


def marked(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """All rows and columns of ``documents`` (with a ``text``) and n_words, n_hit, n_items, items_sha256, contaminated,
    longest_match (words of the longest verbatim match).

    A document word inside an occurrence of a benchmark window (13 words, or a whole shorter item) is hit: these are the
    words of the longest matches. A document is contaminated if n_hit > 0 and 20 * n_hit >= n_words. Null and empty texts
    have no words and no hits; very long texts are searched whole; an empty benchmark hits nothing; repeated rows are judged
    each; an empty table gives an empty result; a null item id is named by the empty string; items that share an id count
    once. Input columns called as one of ours are replaced, all others stay."""
    rows = documents.drop(*OURS)
    test, found = indexed(benchmark, window, block_words), unused(rows, "found")
    schema = rows.withColumns({c: F.lit(0).cast("long") for c in ("n_words", "n_hit", "longest_match")} | {found: F.array().cast("array<string>")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            words, starts, blocks = matched(batch, test)
            sizes = [len(w) for w in words]
            cover = np.zeros(sum(sizes) + len(sizes) + 1, dtype=np.int64)
            longest, names = np.zeros(len(words), dtype=np.int64), [set() for _ in words]
            for block, (at, length, _), held in blocks:
                np.add.at(cover, at, 1)
                np.add.at(cover, at + length, -1)
                np.maximum.at(longest, np.searchsorted(starts, at, side="right") - 1, length)
                for d, items in held:
                    names[d].update(block.names[k] for k in items.tolist())
            covered = np.concatenate([[0], np.cumsum(np.cumsum(cover)[:-1] > 0)])
            hit = covered[starts + sizes] - covered[starts] if sizes else []
            new = [pa.array(sizes, pa.int64()), pa.array(hit, pa.int64()), pa.array(longest), pa.array([sorted(n) for n in names], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], schema.names)

    return rows.mapInArrow(run, schema).withColumns(
        {
            "n_items": F.size(found).cast("long"),
            "items_sha256": F.sha2(F.array_join(F.array_sort(found), ",").cast("binary"), 256),
            "contaminated": (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")),
        }
    ).drop(found)


def verbatim_matches(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The longest verbatim matches: doc_id, item_id, doc_start, item_start, n_words (words from 0). For each place of a
    document at which a whole window stands, the longest match from there, unless it is part of the one before; one item
    that holds it is named, the first of the block in sorted order (each block of the benchmark names its own). Edge cases
    as in marked()."""
    test, kind = indexed(benchmark, window, block_words), dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            _, starts, blocks = matched(batch, test)
            for block, (at, length, place), _ in blocks:
                doc, item = np.searchsorted(starts, at, side="right") - 1, block.item(place)
                columns = [batch.column("doc_id").take(pa.array(doc, pa.int64())), pa.array([block.names[k] for k in item], pa.string())]
                columns += [pa.array(x.astype(np.int64)) for x in (at - starts[doc], place - block.starts[item], length)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "doc_start", "item_start", "n_words"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, item_id string, doc_start long, item_start long, n_words long")


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns whatever their names."""
    own = {c: unused(documents, f"own_{c}") for c in documents.columns if c.lower() in OURS}
    rows = marked(documents.withColumnsRenamed(own), benchmark)
    return rows.filter(~F.col("contaminated")).select(*[F.col(own.get(c, c)).alias(c) for c in documents.columns])
