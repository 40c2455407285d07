"""Training logs: nested values, running statistics, time bins."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattica.operators.numbering import with_place


def parsed(lines: DataFrame, line: str, schema: str) -> DataFrame:
    """``step: {json}`` lines as (step, log); lines of another form are left out."""
    pattern = r"^(\d+): (\{.*\})$"
    rows = lines.filter(F.col(line).rlike(pattern))
    return rows.select(F.regexp_extract(line, pattern, 1).cast("long").alias("step"), F.from_json(F.regexp_extract(line, pattern, 2), schema).alias("log"))


def leaves(struct: Column, fields: list[str]) -> Column:
    """An array of (key, value) of the dotted ``fields`` of a struct that aren't null."""

    def at(path: str) -> Column:
        out = struct
        for part in path.split("."):
            out = out[part]
        return out

    pairs = F.array(*[F.struct(F.lit(f).alias("key"), at(f).cast("double").alias("value")) for f in fields])
    return F.filter(pairs, lambda p: p["value"].isNotNull())


#: Rows of a run that are worked on in one place.
BLOCK = 100_000


def _spread(at: DataFrame, place: Column, overlap: int, block: int) -> DataFrame:
    """Rows in blocks (``_block``) of ``block`` places, each with the ``overlap`` rows before it, which are marked ``_again``."""
    size = max(block, overlap, 1)
    own = F.floor(place / size)
    late = F.array(*[F.struct(own.alias("_block"), F.lit(False).alias("_again"))])
    both = F.array(F.struct(own.alias("_block"), F.lit(False).alias("_again")), F.struct((own + 1).alias("_block"), F.lit(True).alias("_again")))
    return at.select("*", F.inline(F.when(place % size >= size - overlap, both).otherwise(late)))


def clip_limit(rows: DataFrame, run: str, step: str, value: str, size: int, share: float, cap: float, block: int = BLOCK) -> DataFrame:
    """Adds ``limit``: min(cap, the ``share`` percentile of the last ``size`` finite values of a run), once so many have come; a
    null or non-finite value leaves the bound as it is. Rows are numbered in their run, finite ones among themselves too; the
    percentiles are taken in blocks of finite rows that overlap, so a long run is many tasks, and every row meets the bound of
    the last finite row up to it on equality."""
    finite = F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    at = with_place(rows, run, step, "_i").withColumn("_block", F.floor(F.col("_i") / block))
    blocks = at.groupBy(F.col(run).alias("_run"), F.col("_block").alias("_at")).agg(F.count_if(finite).alias("_finite"))
    earlier = Window.partitionBy("_run").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_finite").over(earlier), F.lit(0)))
    met = at.join(blocks, F.col(run).eqNullSafe(F.col("_run")) & (F.col("_block") == F.col("_at")))
    within = Window.partitionBy(run, "_block").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    met = met.withColumn("_f", F.col("_before") + F.count_if(finite).over(within)).drop("_run", "_at", "_finite", "_before", "_block")
    window = Window.partitionBy(run, "_block").orderBy("_f").rowsBetween(-(size - 1), 0)
    limits = _spread(met.filter(finite).select(run, "_f", value), F.col("_f") - 1, size - 1, block)
    limits = limits.withColumn("_limit", F.when(F.count("*").over(window) == size, F.least(F.lit(cap), F.percentile(value, F.lit(share)).over(window))))
    limits = limits.filter(~F.col("_again")).select(F.col(run).alias("_run"), F.col("_f").alias("_at"), "_limit")
    out = met.join(limits, F.col(run).eqNullSafe(F.col("_run")) & (F.col("_f") == F.col("_at")), "left")
    return out.withColumn("limit", F.coalesce("_limit", F.lit(cap))).drop("_run", "_at", "_limit", "_f", "_i")


def rolling_fit(rows: DataFrame, run: str, step: str, y: str, x: str, size: int, every: int) -> DataFrame:
    """Adds slope and intercept of y over x on the last ``size`` rows, fitted at every ``every``-th row and carried on. Sums are
    taken over blocks of rows that the fits share, and a fit adds up its blocks, so a row is read once whatever ``size`` over
    ``every`` is; each row takes the last fit up to it by equality: no run is one task. Sums are around each run's means."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    means = rows.filter(both).groupBy(F.col(run).alias("_run")).agg(F.avg(x).alias("_mx"), F.avg(y).alias("_my"))
    at = with_place(rows, run, step, "_i").withColumn("_i", F.col("_i") + 1)
    unit = math.gcd(size, every)  # a fit at row k * every covers the blocks after k * every - size up to there
    cut = at.filter(both).join(means, F.col(run).eqNullSafe(F.col("_run"))).withColumns({"_x": F.col(x) - F.col("_mx"), "_y": F.col(y) - F.col("_my"), "_b": F.ceil(F.col("_i") / unit)})
    sums = {"n": F.count("*"), "sx": F.sum("_x"), "sy": F.sum("_y"), "sxx": F.sum(F.col("_x") * F.col("_x")), "sxy": F.sum(F.col("_x") * F.col("_y"))}
    blocks = cut.groupBy("_run", "_b", "_mx", "_my").agg(*[a.alias(n) for n, a in sums.items()])
    first, last = F.ceil(F.col("_b") * unit / every), F.floor((F.col("_b") * unit - unit + size) / every)
    fits = F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>")))
    fitted = blocks.select("*", fits.alias("_at")).groupBy("_run", "_at", "_mx", "_my").agg(*[F.sum(n).alias(n) for n in sums])
    spread = F.nullif(F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n"), F.lit(0.0))
    fitted = fitted.withColumn("slope", F.when(F.col("n") > 1, (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / spread))
    fitted = fitted.withColumn("intercept", F.col("_my") + F.col("sy") / F.col("n") - F.col("slope") * (F.col("_mx") + F.col("sx") / F.col("n")))
    own = at.withColumn("_fit", F.floor(F.col("_i") / every)).join(fitted.filter("_at > 0").select("_run", "_at", "slope", "intercept"), F.col(run).eqNullSafe(F.col("_run")) & (F.col("_fit") == F.col("_at")), "left")
    return own.drop("_i", "_fit", "_run", "_at")


def memory_ratio(fits: DataFrame, size: str, available: float, target: float, start: float, every: int, place: str) -> DataFrame:
    """Adds ``ratio``, the share of a job's work to hold in memory so that it takes ``target`` of what is ``available``: from the
    fit of memory over size * ratio (slope, intercept), between 0 and a bound that begins at ``start`` and grows by a tenth at
    every ``every``-th row (``place``: rows of the run so far, from 1). Null without a fit or a slope."""
    bound = F.least(F.lit(1.0), F.lit(start) + F.floor(F.col(place) / every) * 0.1)
    wanted = (F.lit(available * target) - F.col("intercept")) / (F.nullif(F.col("slope"), F.lit(0.0)) * F.nullif(F.col(size), F.lit(0.0)))
    return fits.withColumn("ratio", F.when(wanted.isNotNull(), F.least(bound, F.greatest(F.lit(0.0), wanted))))


def ema(rows: DataFrame, run: str, step: str, value: str, rate: float) -> DataFrame:
    """Last exponential mean of each run: its values summed with powers of the rate by their place, in one aggregation."""
    at = with_place(rows, run, step, "_i", "_n")
    weight = F.when(F.col("_i") == 0, F.pow(F.lit(rate), F.col("_n") - 1)).otherwise((1 - rate) * F.pow(F.lit(rate), F.col("_n") - 1 - F.col("_i")))
    return at.groupBy(run).agg(F.sum(weight * F.col(value)).alias("ema"))


def throughput(rows: DataFrame, run: str, step: str, elapsed: str, every: int, total: int) -> DataFrame:
    """At every ``every``-th row ``i`` of a run: rows a second since the last such row, and seconds left to ``total`` rows. A row
    and the one before it are joined by their number."""
    marks = with_place(rows, run, step, "i").withColumn("i", F.col("i") + 1).filter(F.col("i") % every == 0)
    before = marks.select(F.col(run), (F.col("i") + every).alias("i"), F.col(elapsed).alias("_before"))
    out = marks.join(before, [run, "i"], "left").withColumn("speed", every / F.nullif(F.col(elapsed) - F.col("_before"), F.lit(0.0))).drop("_before")
    return out.withColumn("eta", (total - F.col("i")) / F.col("speed"))


def time_bins(rows: DataFrame, t: str, bins: int, **aggregates: Column) -> DataFrame:
    """Aggregates by uniform bins of t in [0, 1); t = 1 falls in none, and empty bins have no row."""
    at = F.floor(F.col(t) * bins).cast("int")
    return rows.withColumn("bin", at).filter((F.col("bin") >= 0) & (F.col("bin") < bins)).groupBy("bin").agg(*[a.alias(n) for n, a in aggregates.items()])
