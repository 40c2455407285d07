"""Asset registries: merging, pending work, filter cascades and statistics."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def combine_first(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The rows of both by a unique key; a left value wins unless it is null; the columns are those of both. A key that repeats
    in one of them fails the job."""
    return combine_first_many([left, right], key)


def combine_first_many(frames: list[DataFrame], key: str) -> DataFrame:
    """combine_first over many frames in one aggregation: the first frame with a value wins."""
    marked = [f.withColumn("_prio", F.lit(i)) for i, f in enumerate(frames)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    names = [c for c in rows.columns if c not in (key, "_prio")]
    merged = rows.groupBy(key).agg(F.count("*").alias("_n"), F.count_distinct("_prio").alias("_frames"), *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_prio"))).alias(c) for c in names])
    repeats = F.concat(F.lit(f"{key} repeats: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    return checked(merged, F.col("_n") == F.col("_frames"), repeats).select(key, *names)


def checked(df: DataFrame, rule: Column, message: str | Column) -> DataFrame:
    """The same rows; the job fails with ``message`` at one that breaks the rule (a null does), whatever columns are read: a
    filter isn't pruned as a column is."""
    told = F.lit(message) if isinstance(message, str) else message
    return df.filter(F.when(F.coalesce(rule, F.lit(False)), True).otherwise(F.raise_error(told).cast("boolean")))


def upsert(records: DataFrame, key: str, seq: str) -> DataFrame:
    """The newest non-null value of each column by ``seq``; of values with one ``seq`` the greatest."""
    names = [c for c in records.columns if c not in (key, seq)]
    return records.groupBy(key).agg(*[F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(seq).alias("at"), F.col(c).alias("value"))))["value"].alias(c) for c in names])


def validated(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds ``reasons``: the names of the rules that a row breaks, a null counting as broken. The rows without a reason are
    the good ones, the others the quarantine; both come from one scan."""
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("reasons", F.filter(F.array(*broken), lambda x: x.isNotNull()))


def at_least(column: str, bound: float) -> Column:
    """``>=`` under which null and NaN are false (engines rank NaN above all numbers)."""
    return F.coalesce(F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double")) >= bound, F.lit(False))


def done(column: str) -> Column:
    return F.col(column).eqNullSafe(True)


def pending(column: str) -> Column:
    """Not known to be done: false and null."""
    return ~done(column)


def pending_any(df: DataFrame, columns: list[str]) -> Column:
    """Pending in any of the columns; a column the frame lacks counts as pending."""
    return reduce(or_, [pending(c) if c in df.columns else F.lit(True) for c in columns], F.lit(False))


def where_column(df: DataFrame, column: str, predicate: Column) -> DataFrame:
    """Filters only if the frame has the column."""
    return df.filter(predicate) if column in df.columns else df


def cascade_counts(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """(step, name, n): rows left after each step, all from one aggregation."""
    masks = [reduce(and_, [p for _, p in steps[: k + 1]]) for k in range(len(steps))]
    one = df.agg(F.count("*").alias("c0"), *[F.count_if(m).alias(f"c{k + 1}") for k, m in enumerate(masks)])
    names = ["all", *(n for n, _ in steps)]
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("step"), F.lit(n).alias("name"), F.col(f"c{k}").alias("n")) for k, n in enumerate(names)])))


def split_errors(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Rows without and with an error."""
    return df.filter(F.col(error).isNull()).drop(error), df.filter(F.col(error).isNotNull())


def finite(column: str) -> Column:
    """All components of an array are finite numbers."""
    return F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
