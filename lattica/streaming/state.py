"""State of one run kept between micro-batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: The state store that keeps lists by key (a fixed name of Spark's).
LISTS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_lists(spark: SparkSession) -> SparkSession:
    """Sets the state store that bounds() needs, for streams started from now on."""
    spark.conf.set(PROVIDER, LISTS)
    return spark


class RingBuffer(StatefulProcessor):
    """The last ``size`` - 1 finite values of a run, and the bound that they gave, as one value in the state store. A micro-batch's
    rows of a run are put in order of their step (Spark doesn't promise one behind a shuffle), so a task holds those, which
    the source's rate bounds, and the buffer."""

    def __init__(self, run: str, step: str, value: str, size: int, share: float, cap: float):
        self.run, self.step, self.value, self.size, self.share, self.cap = run, step, value, size, share, cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", "held array<double>, bound double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = pd.concat([part[[self.step, self.value]] for part in rows]).sort_values(self.step, ignore_index=True)
        held, bound = self.kept.get() or ([], self.cap)  # one call to read and one to write: each is a trip to the state store
        limits, kept = clipped(np.array(held, dtype=float), new[self.value].to_numpy(dtype=float), bound, self.size, self.share, self.cap)
        self.kept.update((kept.tolist(), float(limits[-1])))
        yield pd.DataFrame({self.run: [key[0]] * len(new), self.step: new[self.step], "limit": limits})

    def close(self) -> None:
        pass


def clipped(kept: np.ndarray, values: np.ndarray, bound: float, size: int, share: float, cap: float) -> tuple[np.ndarray, np.ndarray]:
    """The bound after each of ``values``, given the finite values ``kept`` before them (size - 1 at most) and the bound so far;
    and what is kept after them."""
    finite = np.isfinite(values)
    line = np.concatenate([kept, values[finite]])
    bounds = np.full(len(line) + 1, bound)  # after so many finite values
    if len(line) >= size:
        windows = np.lib.stride_tricks.sliding_window_view(line, size)
        for start in range(0, len(windows), 1 << 14):  # quantile copies its windows
            part = windows[start : start + (1 << 14)]
            bounds[size + start : size + start + len(part)] = np.minimum(cap, np.quantile(part, share, axis=1))
    return bounds[len(kept) + np.cumsum(finite)], line[max(0, len(line) - size + 1) :]


def clip_limits(stream: DataFrame, run: str, step: str, value: str, size: int, share: float, cap: float) -> DataFrame:
    """(run, step, limit) of a stream whose rows come in order of ``step`` for each run: min(cap, the ``share`` percentile of the
    last ``size`` finite values), once so many have come; other values leave the bound as it is. The state of a run is its
    last size - 1 finite values, in a list of the state store, and its bound."""
    kinds = dict(stream.dtypes)
    with_lists(stream.sparkSession)
    grouped = stream.select(run, step, value).groupBy(run)
    return grouped.transformWithStateInPandas(RingBuffer(run, step, value, size, share, cap), f"{run} {kinds[run]}, {step} {kinds[step]}, limit double", "append", "none")
