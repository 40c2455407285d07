"""Connected components by alternating large-star and small-star steps, all as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import dropped, written


def _print_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(hi, lo))")).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (u, v): the label is the least node reachable.

    Each round hangs the higher end of an edge under the least neighbour of its lower end (large star), then the
    lower neighbours of a node under the least of them (small star); a round that changes nothing ends it. Rounds grow
    with the logarithm of a component's diameter. Edges are written between rounds; nothing is collected but a count
    and a hash. Null ends and loops are left out."""
    now = written(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct(), "edges"
    )
    before = _print_of(now)
    while before[0]:
        lower = now.groupBy(F.col("hi").alias("at")).agg(F.min("lo").alias("m"))
        large = now.join(lower, F.col("lo") == F.col("at"), "left").select("hi", F.coalesce("m", "lo").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        after = written(small.unionAll(least.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
        last, now = now, after
        dropped(last)
        found = _print_of(now)
        if found == before:
            break
        before = found
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("label")).unionAll(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("label")).distinct()
    )
