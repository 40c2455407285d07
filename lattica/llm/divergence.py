"""Source divergence audit by joint count histograms.

Terms are counted by language and source. For each pair of sources of a language the combinations (count here, count there)
over the language's kept terms are tallied, implied zero cells included, and the divergence is evaluated once a combination
and multiplied by how many terms have it. Cells are dealt to tiles, two blocks of sources and a stripe of terms each, so
that a task sees a dense count matrix of bounded size. All arithmetic is exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattica.llm.common import LETTERS, joined, sliced, texts, word_parts, written

#: A language keeps the terms in at least so many of its documents.
LEAST_DOCUMENTS = 10
#: Sources of a block, and terms of a stripe, about.
BLOCK, STRIPE = 64, 4096
#: Different (language, source, term) that a task holds before it hands them on.
HELD = 1 << 18
#: Terms listed of each group.
TOP = 10


def term_counts(documents: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents that hold the term, summed within tasks; a triple may come
    several times."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), (counts, docs) in held.items():
                size, terms = len(counts), list(counts)
                columns = [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()), pa.array(terms, pa.binary()).cast(pa.string())]
                columns += [pa.array(list(counts.values()), pa.int64()), pa.array([docs[t] for t in terms], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
            held.clear()

        for batch in sliced(batches):
            for lang, source, raw in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts(batch), strict=True):
                counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
                seen: set[bytes] = set()
                for part in word_parts(raw, LETTERS):
                    counts.update(part)
                    seen.update(part)
                docs.update(seen)
            if sum(len(c) for c, _ in held.values()) >= HELD:
                yield from out()
        yield from out()

    return documents.select(text("lang"), text("source"), text("text")).mapInArrow(run, "lang string, source string, term string, n long, docs long")


def probability(count: Column, total: Column) -> Column:
    """1 + floor(10^9 (count + 2) / total), exact for counts up to 10^19."""
    return F.lit(1) + F.call_function("div", (count + 2).cast("decimal(20,0)") * F.lit(10**9).cast("decimal(10,0)"), total.cast("decimal(20,0)"))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def tallied(group: pa.Table, size: int = BLOCK) -> pa.Table:
    """Joint histogram of one tile: for each pair of a source of block i and one of block j the combinations of counts over
    the terms of the stripe that at least one of the two has, with the number of such terms."""
    lang, i, j, sources = (group.column(c)[0].as_py() for c in ("lang", "i", "j", "sources"))
    term = group.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
    place, n = group.column("place").to_numpy(), group.column("n").to_numpy()
    counts, code = np.unique(n, return_inverse=True)
    counts, k = np.concatenate([[0], counts]), len(counts) + 1
    sides = []
    for block in (i, j):
        dense = np.zeros((int(term.max()) + 1, min(size, sources - block * size)), dtype=np.int64)
        own = place // size == block
        dense[term[own], place[own] - block * size] = code[own] + 1
        sides.append(dense)
    left, right = sides
    found: list[tuple[np.ndarray, ...]] = []

    def add(fixed: int, keys: np.ndarray, of_left: bool) -> None:
        keys, m = np.unique(keys, return_counts=True)
        other, x, y = keys // (k * k), keys // k % k, keys % k
        a, b = (np.full(len(keys), fixed), other) if of_left else (other, np.full(len(keys), fixed))
        found.append((a + i * size, b + j * size, counts[x], counts[y], m))

    for a in range(left.shape[1]):  # terms that the source of the left block has, with the counts on the right, zeros included
        rows = np.flatnonzero(left[:, a])
        b = np.arange(a + 1 if i == j else 0, right.shape[1])
        add(a, ((b[None, :] * k + left[rows, a][:, None]) * k + right[rows][:, b]).ravel(), True)
    for b in range(right.shape[1]):  # terms that only the source of the right block has
        rows = np.flatnonzero(right[:, b])
        a = np.arange(b if i == j else left.shape[1])
        only = left[rows][:, a] == 0
        add(b, (a[None, :] * k * k + right[rows, b][:, None])[only], False)
    a, b, x, y, m = (np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True))
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": a, "b": b, "x": x, "y": y, "m": m})


def in_tiles(rows: DataFrame, block: int) -> DataFrame:
    """Each row to the tiles (i, j), i <= j, of its block and every block of its language."""
    blocks = F.expr(f"cast(ceil(sources / {block}) as int)")
    own = F.expr(f"cast(place div {block} as int)")
    spread = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return spread.withColumns({"i": F.least(own, F.col("other")), "j": F.greatest(own, F.col("other"))}).drop("other")


def audited(documents: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, block: int = BLOCK, stripe: int = STRIPE) -> DataFrame:
    """(lang, source, part, item, value, rank). Terms are runs of letters and non-ASCII characters with A-Z lower-cased; a
    language keeps those in at least ``least`` of its documents, V of them. Every group (lang, source) that occurs, and each
    language, gives a kept term p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N its occurrences of kept terms, and
    f = floor((p - q)^2 / (p + q)).

    Part ``pair``: each other source of the language, value the sum of f over all kept terms (0 without any). Part ``term``:
    kept terms of the group with p above the language's q, the ``top`` by f. Ranks go from 1 by falling value, ties by item
    in UTF-8 order.

    Defined results: null text, lang and source count as empty strings; documents without terms make their group occur;
    repeated rows count each; texts of any length are counted in parts; a lone source has no pairs; an empty table gives
    an empty result; other columns are ignored. A language or source with most of the rows costs a task no more than its
    own share of cells: counts are summed in tasks before the shuffle, by (lang, term), and large groups are met without one."""
    by_term = Window.partitionBy("lang", "term")
    sums = term_counts(documents).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = sums.withColumns(
        {"docs": F.sum("docs").over(by_term), "lang_n": F.sum("n").over(by_term), "first": (F.row_number().over(by_term.orderBy("source")) == 1).cast("long")}
    )
    cells = written(whole.filter(F.col("docs") >= least).drop("docs"), "cells")

    seen = documents.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("cells"), F.sum("first").alias("firsts"))
    zero, by_lang = F.lit(0).cast("long"), Window.partitionBy("lang")
    groups = seen.join(totals, ["lang", "source"], "left").fillna(0, ["total", "cells", "firsts"]).withColumns(
        {
            "kept": F.sum("firsts").over(by_lang),
            "lang_total": F.sum("total").over(by_lang),
            "sources": F.count("*").over(by_lang),
            "place": (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long"),
        }
    )
    groups = written(groups.drop("firsts"), "groups")
    dealt = joined(cells, groups, ["lang", "source"], "cells")

    q = probability(F.col("lang_n"), F.col("lang_total") + 2 * F.col("kept"))
    terms = dealt.withColumns({"p": probability(F.col("n"), F.col("total") + 2 * F.col("kept")), "q": q}).filter("p > q")
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))

    part = F.pmod(F.xxhash64("term"), F.expr(f"1 + kept div {stripe}"))
    tiles = in_tiles(dealt.select("lang", "place", "sources", "term", "n", part.alias("stripe")), block)
    joint = tiles.groupBy("lang", "i", "j", "stripe").applyInArrow(lambda group: tallied(group, block), "lang string, a long, b long, x long, y long, m long")
    joint = joint.groupBy("lang", "a", "b", "x", "y").agg(F.sum("m").alias("m"))
    sides = in_tiles(groups.select("lang", "place", "sources", "source", "total", "kept"), block)
    left = sides.filter(F.col("i") == F.expr(f"place div {block}")).select("lang", "i", "j", F.col("place").alias("a"), F.col("source").alias("source"), (F.col("total") + 2 * F.col("kept")).alias("total_a"), "kept")
    right = sides.filter(F.col("j") == F.expr(f"place div {block}")).select("lang", "i", "j", F.col("place").alias("b"), F.col("source").alias("item"), (F.col("total") + 2 * F.col("kept")).alias("total_b"))
    pairs = left.join(right, ["lang", "i", "j"]).filter("a < b").drop("i", "j")
    at = lambda count, side: F.when(F.col("kept") > 0, probability(count, F.col(side)))
    met = pairs.join(joint, ["lang", "a", "b"], "left").withColumn("f", divergence(at(F.coalesce("x", zero), "total_a"), at(F.coalesce("y", zero), "total_b")))
    summed = met.groupBy("lang", "a", "b", "source", "item", "total_a", "total_b", "kept").agg(
        F.coalesce(F.sum(F.col("m") * F.col("f")), zero).alias("some"), F.coalesce(F.sum("m"), zero).alias("terms")
    )
    none = F.coalesce(divergence(at(zero, "total_a"), at(zero, "total_b")), zero)  # terms that neither source has
    value = summed.select("lang", "source", "item", (F.col("some") + (F.col("kept") - F.col("terms")) * none).alias("value"))
    both = value.unionByName(value.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked(both).withColumn("part", F.lit("pair")).select(columns).unionByName(ranked(terms).filter(F.col("rank") <= top).select(columns))
