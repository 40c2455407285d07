"""Row functions with errors kept apart, fallbacks for bad samples, resumable order."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.operators.numbering import epoch_order


def mapped(df: DataFrame, key: str, function: Callable[[dict], dict], schema: str) -> DataFrame:
    """(key, ``schema``, error): the function's dict for each row; where it raises, nulls and the error's text."""
    names = [c.strip().split()[0] for c in schema.split(",")]

    def one(row: dict) -> dict:
        try:
            return {key: row[key], "error": None} | function(row)
        except Exception as e:  # the row's own failure, kept as data
            return {key: row[key], "error": f"{type(e).__name__}: {e}"}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = pd.DataFrame([one(r) for r in f.to_dict("records")], columns=[key, *names, "error"])
            yield out.astype(object).where(out.notna(), None)

    return df.mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, {schema}, error string")


def with_fallback(df: DataFrame, key: str, good: str, seed: int = 0) -> DataFrame:
    """(key, used): each row's own key if it is good, else a good row's, picked by a hash. Good rows are numbered, and the hash
    picks a number, so it is one equi-join. ``used`` is null where no row is good."""
    numbers, n = epoch_order(df.filter(F.col(good)).select(key), key, seed, 0), df.filter(F.col(good)).count()
    bad = df.filter(~F.coalesce(F.col(good), F.lit(False))).select(key)
    own = df.filter(F.col(good)).select(key, F.col(key).alias("used"))
    if not n:
        return bad.withColumn("used", F.lit(None).cast(dict(df.dtypes)[key]))
    wanted = bad.withColumn("place", F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(n)))
    return own.unionAll(wanted.join(numbers.withColumnRenamed(key, "used"), "place").select(key, "used"))


def resumed(df: DataFrame, key: str, seed: int, epoch: int, done: int) -> DataFrame:
    """What an epoch has left after ``done`` rows, with each row's place."""
    return epoch_order(df, key, seed, epoch).filter(F.col("place") >= done)
