"""Mixing sources to target weights with soft membership.

A softmax classifier learned from a labelled table gives every document a posterior over domains. Rates r between 0 and a
greatest one are then fitted so that the expected tokens of each domain, sum_i r_i * tokens_i * p_i, match the targets in
the least squares sense. Projected gradient from r = 1: r_i <- clip(r_i - p_i . y_k), with y_k the residual preconditioned
by the damped domains x domains Gram matrix of the rows that aren't at a bound. A rate depends on its own posterior and on the y's so far alone, so no rates
are stored: each iteration replays the y's in a column expression and sums residual and matrix, and the driver sees a few
whole numbers a domain. Sums are of whole numbers, so they don't depend on the order of rows, and neither do rates and copies.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import dropped, sliced, texts, written
from lattica.operators.numbering import unused


@dataclass(frozen=True)
class Target:
    """A domain: its name, the values of the label columns that mark it, and the share of the tokens it is to have."""

    name: str
    values: tuple
    share: float


#: Label columns, and the domains of the given labels with the shares that the mixture aims at.
LABELS = ("quality", "toxic")
TARGETS = (Target("low_clean", (0, 0), 0.07), Target("low_toxic", (0, 1), 0.005), Target("high_clean", (1, 0), 0.905), Target("high_toxic", (1, 1), 0.02))
#: The classifier is fitted on about so many rows of each domain at most, and so many bytes of each.
MAX_FIT_ROWS, MAX_FIT_BYTES = 1500, 8 << 20
WORDS, SHAPES = 1 << 13, 1 << 8
EPOCHS, RATE, DECAY = 12, 0.05, 1e-4
#: No document is repeated more often.
MAX_RATE = 4.0
#: Iterations at most, the share of all tokens at which the residual or a step's change ends them, and the share of the
#: tokens within which a target counts as met.
ITERATIONS, CLOSE, MET = 40, 1e-6, 1e-3
#: Damping, as a share of the Gram matrix's trace: keeps domains with hardly any tokens from driving all rates.
DAMPING = 1e-6
#: Unit of the whole-number sums: tokens are counted in so many parts.
PARTS = 1 << 28
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


class Features(dict):
    """A text as log counts of hashed words, of hashed shapes (what punctuation ends a word, upper case) and a constant. The
    dictionary keeps the numbers of tokens seen before: word * SHAPES + shape."""

    size = WORDS + SHAPES + 1
    bound = 1 << 16

    def __missing__(self, token: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        core = token.strip(PUNCTUATION)
        shape = token[len(token.rstrip(PUNCTUATION)) :] + (b"A" if core.isupper() and len(core) > 1 else b"a" if core else b"-")
        value = self[token] = xxhash.xxh32_intdigest(core.lower()) % WORDS * SHAPES + xxhash.xxh32_intdigest(shape) % SHAPES
        return value

    def features(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Feature numbers, their values, and the number of tokens."""
        tokens = text.split() if text else []
        ids = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        held, values = [], []
        for part, first in ((ids // SHAPES, 0), (ids % SHAPES, WORDS)):
            numbers, counts = np.unique(part, return_counts=True)
            logs = np.log1p(counts.astype(np.float32))
            held.append(numbers + first)
            values.append(logs * (2 / float(np.linalg.norm(logs))) if len(logs) else logs)
        return np.concatenate([*held, [self.size - 1]]), np.concatenate([*values, np.ones(1, np.float32)]), len(tokens)


@dataclass
class Classifier:
    """Softmax regression; ``learned`` marks the domains it has seen. The others have a posterior of 0; all are equally likely
    where none was seen."""

    weights: np.ndarray
    learned: np.ndarray

    def posteriors(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        z = np.array([values @ self.weights[held] for held, values in rows], dtype=np.float64).reshape(len(rows), -1)
        if self.learned.any():
            z[:, ~self.learned] = -np.inf
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def domain_sample(
    documents: DataFrame, labels: DataFrame, targets: Sequence[Target] = TARGETS, by: Sequence[str] = LABELS, max_rows: int = MAX_FIT_ROWS, max_bytes: int = MAX_FIT_BYTES, seed: int = 9
) -> tuple[DataFrame, np.ndarray]:
    """(text, y) of at most about ``max_rows`` labelled texts and ``max_bytes`` of each domain (y: its number among the
    targets), picked by hashes, and how many labelled documents each domain has in all. Labels of no domain, null ones among
    them, are left out; of several domains of a document the last counts; equal texts under one id count once."""
    y = F.lit(None).cast("int")
    for k, target in enumerate(targets):
        match = F.lit(True)
        for column, value in zip(by, target.values, strict=True):
            match = match & (F.col(column) == F.lit(value))
        y = F.when(match, k).otherwise(y)
    known = labels.filter("doc_id is not null").select("doc_id", y.alias("y")).filter("y is not null").groupBy("doc_id").agg(F.max("y").alias("y"))

    def thinned(rows: DataFrame, parts: dict[int, float], *key: str) -> DataFrame:
        spread = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
        keep = F.lit(False)
        for domain, part in parts.items():
            keep = F.when(F.col("y") == domain, spread < part).otherwise(keep)
        return rows.filter(keep)

    counts = {r[0]: r[1] for r in known.groupBy("y").count().collect()}
    few = thinned(known, {k: min(1.0, max_rows / n) for k, n in counts.items()}, "doc_id")
    rows = written(documents.select("doc_id", "text").join(F.broadcast(few), "doc_id").distinct(), "labelled")
    sizes = {r[0]: (r[1], r[2] or 0) for r in rows.groupBy("y").agg(F.count("*"), F.sum(F.length("text"))).collect()}
    rows = thinned(rows, {k: min(1.0, 1.5 * max_rows / n, max_bytes / max(size, 1)) for k, (n, size) in sizes.items()}, "doc_id", "text")
    return rows.orderBy("doc_id", F.xxhash64("text")).select("text", "y"), np.array([counts.get(k, 0) for k in range(len(targets))])


def fitted(sample: DataFrame, counts: np.ndarray, seed: int = 4) -> Classifier:
    """Softmax regression by Adam over shuffled blocks, balanced between the domains; their true shares, from ``counts``, are
    then put back into the constant."""
    features, random = Features(), np.random.default_rng(seed)
    x, y = [], []
    for text, label in sample.toLocalIterator():
        x.append(features.features(text.encode() if text else None)[:2])
        y.append(label)
    weights = np.zeros((Features.size, len(counts)), dtype=np.float32)
    if not y:
        return Classifier(weights, np.zeros(len(counts), dtype=bool))
    y = np.array(y)
    seen = np.bincount(y, minlength=len(counts))
    weights[-1] = np.where(seen > 0, 0, -20)
    balance = np.where(seen > 0, len(y) / np.maximum(seen, 1) / max((seen > 0).sum(), 1), 0)
    first, second, step = np.zeros_like(weights), np.zeros_like(weights), 0
    for _ in range(EPOCHS):
        order = random.permutation(len(y))
        for start in range(0, len(y), 64):
            part = order[start : start + 64]
            block = np.zeros((len(part), Features.size), dtype=np.float32)
            for k, i in enumerate(part):
                block[k, x[i][0]] = x[i][1]
            z = (block @ weights).astype(np.float64)
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), y[part]] -= 1
            grad = (block.T @ (p * balance[y[part]][:, None]).astype(np.float32)) / len(part) + DECAY * weights
            step += 1
            first += 0.1 * (grad - first)
            second += 0.001 * (grad * grad - second)
            weights -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights[-1] += np.log(np.maximum(counts, 0.5) / counts.sum() * (seen > 0).sum())
    return Classifier(weights, seen > 0)


def with_posteriors(documents: DataFrame, classifier: Classifier, tokens: str = "tokens", posteriors: str = "posteriors") -> DataFrame:
    """All columns of ``documents``, ``tokens`` (words between white space) and ``posteriors``, one of each domain. Null and
    empty texts have no tokens and the posteriors of the constant alone; very long texts are read whole."""
    shared = documents.sparkSession.sparkContext.broadcast(classifier)
    schema = documents.withColumns({tokens: F.lit(0).cast("long"), posteriors: F.array(F.lit(0.0))}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, model = Features(), shared.value
        for batch in sliced(batches):
            found = [features.features(t) for t in texts(batch)]
            p = model.posteriors([f[:2] for f in found])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f[2] for f in found], pa.int64()), pa.array(list(p), pa.list_(pa.float64()))], schema.names)

    return documents.mapInArrow(run, schema)


def rate(steps: list[np.ndarray], posteriors: str = "posteriors", max_rate: float = MAX_RATE) -> Column:
    """The rate of a row after the steps so far."""
    if not steps:
        return F.lit(1.0)
    ys = F.from_json(F.lit(json.dumps([y.tolist() for y in steps])), "array<array<double>>")  # folded to a constant
    dot = lambda y: F.aggregate(F.zip_with(posteriors, y, lambda p, v: p * v), F.lit(0.0), lambda a, v: a + v)
    return F.aggregate(ys, F.lit(1.0), lambda r, y: F.least(F.lit(float(max_rate)), F.greatest(F.lit(0.0), r - dot(y))))


def whole_sums(rows: DataFrame, *amounts: Column) -> np.ndarray:
    """Sums of amounts, each row's rounded to PARTS; the same whatever the order of rows. Two halves, so that none overflows."""
    parts = [F.round(a * PARTS).cast("long") for a in amounts]
    halves = [F.sum(h) for p in parts for h in (F.shiftright(p, 24), p.bitwiseAND((1 << 24) - 1))]
    found = rows.agg(*halves).first()
    return np.array([((high or 0) * 2**24 + (low or 0)) / PARTS for high, low in zip(found[::2], found[1::2], strict=True)])


@dataclass
class Fit:
    """The steps, the domains' shares of the expected tokens before and after, and the residual: expected less wanted tokens as
    a share of all tokens wanted. ``met``: it lies within MET."""

    targets: Sequence[Target]
    steps: list[np.ndarray] = field(default_factory=list)
    before: np.ndarray | None = None
    after: np.ndarray | None = None
    residual: np.ndarray | None = None

    def rows(self) -> list[tuple]:
        none = [None] * len(self.targets)
        parts = [none if x is None else x.tolist() for x in (self.before, self.after, self.residual)]
        return [(t.name, t.share, *p, p[2] is not None and abs(p[2]) <= MET) for t, *p in zip(self.targets, *parts, strict=True)]


def fitted_rates(
    rows: DataFrame, targets: Sequence[Target] = TARGETS, max_rate: float = MAX_RATE, iterations: int = ITERATIONS, close: float = CLOSE, tokens: str = "tokens", posteriors: str = "posteriors"
) -> Fit:
    """Projected gradient over ``rows`` (tokens, posteriors), one aggregation a step, preconditioned by the Gram matrix of the
    rows that are still free, or of all rows after a step that made things worse. The mixture has as many tokens as lets the
    domain with the largest target keep its own. It stops when the residual is a ``close`` share of all tokens, when a step
    changes no more than that, and after ``iterations``; what is then missing stands in ``residual``. A target of a
    domain without tokens can't be met and stays so. There are no steps, so that all rates are 1, where they bring the
    domains' shares no nearer to the targets: posteriors that are the same for all rows tell nothing of what to drop."""
    k, fit = len(targets), Fit(targets)
    p = [F.col(posteriors)[i] for i in range(k)]
    upper = np.triu_indices(k)

    def measured(steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Expected tokens of each domain, and the Gram matrix of the rows between the bounds."""
        r, free = F.col("r"), F.when((F.col("r") > 0) & (F.col("r") < max_rate), F.col(tokens)).otherwise(0)
        at = rows.select(tokens, posteriors, rate(steps, posteriors, max_rate).alias("r"))
        sums = whole_sums(at, *[r * F.col(tokens) * x for x in p], *[free * p[i] * p[j] for i, j in zip(*upper, strict=True)])
        matrix = np.zeros((k, k))
        matrix[upper] = sums[k:]
        return sums[:k], matrix + np.triu(matrix, 1).T

    reached, everywhere = measured([])
    share, total = np.array([t.share for t in targets], dtype=float), reached.sum()
    if not total or not share.sum():
        return fit
    share = share / share.sum()
    main = int(np.argmax(np.where(reached > 0, share, -1)))
    want = share * reached[main] / share[main] if share[main] else share * total
    inverse = lambda matrix: np.linalg.inv(matrix + np.eye(k) * DAMPING * np.trace(everywhere))
    residual = lambda tokens: (tokens - want) / want.sum()
    metric = inverse(everywhere)
    cost = lambda tokens: (tokens - want) @ metric @ (tokens - want)
    fit.before = fit.after = reached / total
    fit.residual = residual(reached)
    steps, free = [], everywhere
    while len(steps) < iterations and np.abs(reached - want).sum() > close * total:
        steps.append(inverse(free) @ (reached - want))
        last, (reached, free) = reached, measured(steps)
        if cost(reached) > cost(last):
            free = everywhere
        elif np.abs(reached - last).sum() <= close * total:
            break
    after = reached / max(reached.sum(), 1e-12)
    if reached.sum() > 0 and np.abs(after - share).sum() < np.abs(fit.before - share).sum() - close:
        fit.steps, fit.after, fit.residual = steps, after, residual(reached)
    return fit


def copies(rates: Column, coin: str) -> Column:
    """How often a row goes into the mixture: the rate, rounded up with the odds of its fraction by the row's hash."""
    return F.floor(rates + F.pmod(F.col(coin), F.lit(1 << 40)) / float(1 << 40)).cast("int")


def coin(seed: int = 11) -> Column:
    """Hash of id and text: rows that share only one of them are rounded apart."""
    return F.xxhash64("doc_id", "text", F.lit(seed))


def _scored(documents: DataFrame, labels: DataFrame, targets: Sequence[Target], by: Sequence[str], keep: list[str]) -> DataFrame:
    rows = documents.select("doc_id", "text", coin().alias("coin"))
    return written(with_posteriors(rows, fitted(*domain_sample(documents, labels, targets, by))).select(*keep, "tokens", "posteriors"), "posteriors")


def mixture(documents: DataFrame, labels: DataFrame, targets: Sequence[Target] = TARGETS, by: Sequence[str] = LABELS, max_rate: float = MAX_RATE) -> DataFrame:
    """doc_id, tokens, posteriors (in the order of the targets), rate and copies of every document, and ``residual``, how far
    the expected tokens of the mixture are from the wanted ones in all, and ``met``, whether every domain is within MET.

    Empty tables give an empty result; rows without tokens have no weight in the fit and get the rate of their posterior;
    very long texts count whole; repeated rows count each; other columns are ignored; where no domain was learned (no labels,
    null labels, or none of a document here) all posteriors are equal and every rate is 1, whatever the targets."""
    rows = _scored(documents, labels, targets, by, ["doc_id", "coin"])
    fit = fitted_rates(rows, targets, max_rate)
    off = float(np.abs(fit.residual).sum()) if fit.residual is not None else None
    out = rows.withColumn("rate", rate(fit.steps, max_rate=max_rate)).withColumn("copies", copies(F.col("rate"), "coin"))
    return out.withColumns({"residual": F.lit(off).cast("double"), "met": F.lit(all(r[-1] for r in fit.rows()))}).drop("coin")


def mixture_report(documents: DataFrame, labels: DataFrame, targets: Sequence[Target] = TARGETS, by: Sequence[str] = LABELS, max_rate: float = MAX_RATE) -> DataFrame:
    """One row a domain: name, target, its share of the expected tokens before and after, the residual and whether it is met."""
    rows = _scored(documents, labels, targets, by, [])
    fit = fitted_rates(rows, targets, max_rate)
    dropped(rows)
    return documents.sparkSession.createDataFrame(fit.rows(), "domain string, target double, share_before double, share_after double, residual double, met boolean")


def mixed(documents: DataFrame, labels: DataFrame, targets: Sequence[Target] = TARGETS, by: Sequence[str] = LABELS, max_rate: float = MAX_RATE) -> DataFrame:
    """The documents, with their own columns whatever their names, each as often as its copies. Texts are scored once: they
    are written with their posteriors, of which alone the fit reads. Where no domain was learned each stays once."""
    tokens, posteriors, toss, copy = (unused(documents, name) for name in ("tokens", "posteriors", "coin", "copy"))
    scored = with_posteriors(documents.withColumn(toss, coin()), fitted(*domain_sample(documents, labels, targets, by)), tokens, posteriors)
    rows = written(scored, "posteriors")
    fit = fitted_rates(rows.select(F.col(tokens).alias("tokens"), F.col(posteriors).alias("posteriors")), targets, max_rate)
    out = rows.withColumn(copy, copies(rate(fit.steps, posteriors, max_rate), toss)).filter(F.col(copy) > 0)
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy)))).select(*documents.columns)
