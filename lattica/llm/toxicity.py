"""Toxicity: a convolutional text classifier in numpy.

A word's vector is the sum of hashed embeddings of the word and of its prefixes. Filters of several widths run over the
words, the maximum of each is kept, and a logistic layer weighs them. The first coordinate of the embeddings starts as
the smoothed log-odds of its bucket, which tells a filter where to look; everything is then trained by back-propagation
through the maxima. The threshold is chosen for each language, told from the words alone, and scores are shifted so that
it lies at 0.7.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import alnum_words, in_fold, sliced, texts, word_parts, written

#: The classifier is fitted on at most about so many labelled rows of each class, and so many bytes of each.
MAX_FIT_ROWS, MAX_FIT_BYTES = 3000, 8 << 20
BUCKETS, DIMENSIONS, FILTERS, WIDTHS = 1 << 18, 8, 6, (1, 2, 3)
#: Prefixes by bytes: a word longer than so many bytes has such a prefix.
PREFIXES = (4, 5, 6, 7, 8, 10)
PAD = max(WIDTHS) - 1
CUT = 0.7
EPOCHS, RATE = 3, 0.05
#: A threshold is set on so many held-back examples of each class at least.
LEAST_HELD = 20
#: Bytes of a long text that are scored at once.
PART_BYTES = 1 << 20
#: Words whose vectors are kept between texts.
KEPT = 1 << 16


def buckets(word: bytes) -> list[int]:
    """Buckets of the word and of its prefixes, -1 where it has no such prefix."""
    mask = BUCKETS - 1
    return [xxhash.xxh32_intdigest(word) & mask] + [xxhash.xxh32_intdigest(word[:n], seed=n) & mask if len(word) > n - 1 else -1 for n in PREFIXES]


@dataclass
class Model:
    """table: bucket vectors (the last row is zero); conv: width -> (width, dimensions, filters); bias; out; shift."""

    table: np.ndarray
    conv: dict[int, np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    shift: float
    languages: list[str]
    language_table: np.ndarray
    thresholds: np.ndarray
    slope: float = 1.0

    def score(self, logits: np.ndarray, languages: np.ndarray) -> np.ndarray:
        """0 to 1, and 0.7 at the language's threshold."""
        x = (logits - self.thresholds[languages]) * self.slope + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Vectors:
    """Word vectors of a model, kept for words seen before: the first DIMENSIONS columns are the embedding, the others the
    log-probabilities by language. Row 0 is zero, for padding."""

    def __init__(self, model: Model):
        self.model, self.rows = model, {}
        self.values = np.zeros((1024, DIMENSIONS + len(model.languages)), dtype=np.float32)

    def number(self, words: list[bytes]) -> list[int]:
        rows = self.rows
        try:
            return [rows[w] for w in words]
        except KeyError:
            fresh = [w for w in dict.fromkeys(words) if w not in rows]
            if len(rows) + len(fresh) > KEPT:
                rows.clear()
                fresh = list(dict.fromkeys(words))
            start = len(rows) + 1
            while start + len(fresh) > len(self.values):
                self.values = np.concatenate([self.values, np.zeros_like(self.values)])
            for k in range(0, len(fresh), 4096):
                part = np.array([buckets(w) for w in fresh[k : k + 4096]])
                at = slice(start + k, start + k + len(part))
                self.values[at, :DIMENSIONS] = self.model.table[part].sum(axis=1)
                self.values[at, DIMENSIONS:] = self.model.language_table[part[:, 0]]
            rows.update(zip(fresh, range(start, start + len(fresh)), strict=True))
            return [rows[w] for w in words]


def pooled(model: Model, vectors: Vectors, documents: list[list[bytes]], seen: int = 0, ended: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Greatest value of each filter, and sums by language, of each document; its first ``seen`` words don't count in the sums.
    The words of all stand in one array with padding after each document; windows over it count if the documents ``ended``."""
    flat: list[bytes] = [w for words in documents for w in words]
    numbers = np.array(vectors.number(flat), dtype=np.int64)
    sizes = np.array([len(w) for w in documents]) + PAD
    ends = np.cumsum(sizes)
    starts = ends - sizes
    inside = np.ones(int(ends[-1]), dtype=bool)
    for j in range(1, PAD + 1):
        inside[ends - j] = False
    at = np.zeros(len(inside), dtype=np.int64)
    at[inside] = numbers
    x = vectors.values[at]
    languages = np.add.reduceat(x[:, DIMENSIONS:], starts, axis=0)
    for j in range(seen):
        languages -= np.where((sizes - PAD > j)[:, None], x[np.minimum(starts + j, len(x) - 1), DIMENSIONS:], 0)
    x = np.concatenate([x[:, :DIMENSIONS], np.zeros((PAD, DIMENSIONS), dtype=np.float32)])
    tops = []
    for k, width in enumerate(WIDTHS):
        z = sum(x[j : j + len(inside)] @ model.conv[width][j] for j in range(width)) + model.bias[k]
        for j in range(1, width if ended else width + PAD):
            z[np.maximum(ends - j, starts)] = -np.inf  # windows that would reach into the next document
        tops.append(np.maximum.reduceat(z, starts, axis=0))
    return np.concatenate(tops, axis=1), languages


def judged(model: Model, tops: np.ndarray, languages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logit and language of each document."""
    best = np.argmax(languages, axis=1) if len(model.languages) else np.zeros(len(tops), dtype=np.int64)
    return np.maximum(tops, 0).astype(np.float64) @ model.out + model.shift, best


def forward(model: Model, vectors: Vectors, documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    return judged(model, *pooled(model, vectors, documents))


def forward_long(model: Model, vectors: Vectors, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """forward() of one text of any length, part by part; each part begins with the last words of the one before, so that
    every window is whole in one of them."""
    parts, carry, tops, languages = word_parts(text, limit=PART_BYTES), [], [], 0
    part = next(parts, [])
    while part is not None:
        after = next(parts, None)
        top, sums = pooled(model, vectors, [carry + part], len(carry), after is None)
        tops.append(top)
        languages = languages + sums
        carry, part = (carry + part)[-PAD:], after
    return judged(model, np.max(tops, axis=0), languages)


def sample(documents: DataFrame, labels: DataFrame, label: str, max_rows: int = MAX_FIT_ROWS, max_bytes: int = MAX_FIT_BYTES, seed: int = 5) -> DataFrame:
    """(text, lang, y) of at most about ``max_rows`` labelled texts and ``max_bytes`` of each class, picked by hashes; with
    several labels of a document the largest. The labels are thinned before anything is joined, and equal texts under one id
    count once."""
    labelled = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y"))
    counts = {r[0]: r[1] for r in labelled.groupBy("y").count().collect()}

    def thinned(rows: DataFrame, parts: dict[int, float], *key: str) -> DataFrame:
        spread = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
        keep = F.lit(False)
        for y, part in parts.items():
            keep = F.when(F.col("y") == y, spread < part).otherwise(keep)
        return rows.filter(keep)

    few = thinned(labelled, {y: max_rows / n for y, n in counts.items()}, "doc_id")
    rows = written(documents.select("doc_id", "text", "lang").join(F.broadcast(few), "doc_id").distinct(), "labelled")
    sizes = {r[0]: (r[1], r[2] or 0) for r in rows.groupBy("y").agg(F.count("*"), F.sum(F.length("text"))).collect()}
    rows = thinned(rows, {y: min(1.0, 1.5 * max_rows / n, max_bytes / max(size, 1)) for y, (n, size) in sizes.items()}, "doc_id", "text")
    return rows.orderBy("doc_id", F.xxhash64("text", "lang")).select("text", "lang", "y")


def trained(examples: list[tuple[list[bytes], str | None, int]], seed: int = 3) -> Model:
    """Trains on four fifths of the examples (words, language, 0 or 1) and sets the thresholds on the fifth that is held back;
    on all where that holds fewer than LEAST_HELD of a class."""
    random = np.random.default_rng(seed)
    languages = sorted({lang for _, lang, _ in examples if lang is not None})
    table = np.zeros((BUCKETS + 1, DIMENSIONS), dtype=np.float32)
    language_table = np.zeros((BUCKETS + 1, len(languages)), dtype=np.float32)
    conv = {w: random.normal(0, 0.1, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS}
    for w in WIDTHS:
        conv[w][0, 0, :] = random.uniform(0.3, 1.0, FILTERS)
    bias = np.zeros((len(WIDTHS), FILTERS), dtype=np.float32)
    out = np.full(len(WIDTHS) * FILTERS, 1.0 / (len(WIDTHS) * FILTERS))
    model = Model(table, conv, bias, out, -1.0, languages, language_table, np.zeros(max(1, len(languages))))
    known: dict[bytes, list[int]] = {}
    grams = [np.array([known[w] if w in known else known.setdefault(w, buckets(w)) for w in words], dtype=np.int32).reshape(-1, len(PREFIXES) + 1) for words, _, _ in examples]
    y = np.array([t for _, _, t in examples], dtype=np.float64)
    if not len(y):
        model.shift = -20.0
        return model
    fit = np.arange(len(y)) % 5 != 0
    found, totals = np.zeros((2, BUCKETS + 1)), np.array([1 + (y[fit] == c).sum() for c in (0, 1)], dtype=np.float64)
    for g, t, use, (_, lang, _) in zip(grams, y, fit, examples, strict=True):
        if use:
            found[int(t), np.unique(g)] += 1
        if lang is not None:
            np.add.at(language_table[:, languages.index(lang)], g[:, 0], 1)
    if languages:
        shares = language_table / np.maximum(language_table.sum(axis=0), 1)
        language_table[:] = np.log(shares + 1e-6) - np.log(shares.mean(axis=1, keepdims=True) + 1e-6)
    prior, weight = totals / totals.sum(), 4.0
    odds = np.log((found[1] + weight * prior[1]) / prior[1]) - np.log((found[0] + weight * prior[0]) / prior[0])
    table[:, 1:] = random.normal(0, 0.05, (BUCKETS + 1, DIMENSIONS - 1))
    table[:, 0] = odds
    table[-1] = language_table[-1] = 0
    sums = {k: np.full(v.shape, 1e-3) for k, v in (("bias", bias), ("out", out), *conv.items())}
    table_sums = np.full(BUCKETS + 1, 1e-3)
    balance = np.where(y == 1, totals[0], totals[1]) / totals.sum() * 2
    shift_sum = 1e-3
    for _ in range(EPOCHS):
        for i in random.permutation(np.flatnonzero(fit)):
            g = grams[i]
            x = np.concatenate([table[g].sum(axis=1), np.zeros((PAD, DIMENSIONS), dtype=np.float32)])
            tops, places = [], []
            for k, width in enumerate(WIDTHS):
                n = len(x) - width + 1
                if n < 1:  # a text without words has no window of this width
                    places.append(np.zeros(FILTERS, dtype=np.int64))
                    tops.append(np.zeros(FILTERS))
                    continue
                z = sum(x[j : j + n] @ conv[width][j] for j in range(width)) + bias[k]
                places.append(z.argmax(axis=0))
                tops.append(z[places[-1], np.arange(FILTERS)])
            h = np.maximum(np.concatenate(tops), 0).astype(np.float64)
            p = 1 / (1 + np.exp(-np.clip(h @ out + model.shift, -30, 30)))
            d = (p - y[i]) * balance[i]
            back = np.where(h > 0, d * out, 0)
            step = d * h
            sums["out"] += step * step
            out -= RATE * step / np.sqrt(sums["out"])
            shift_sum += d * d
            model.shift -= RATE * d / np.sqrt(shift_sum)
            dx: dict[int, np.ndarray] = {}
            for k, width in enumerate(WIDTHS):
                b = back[k * FILTERS : (k + 1) * FILTERS]
                step = np.zeros_like(conv[width], dtype=np.float64)
                for f in np.flatnonzero(b):
                    for j in range(width):
                        row = int(places[k][f]) + j
                        step[j, :, f] = b[f] * x[row]
                        if row < len(g):
                            dx[row] = dx.get(row, 0) + b[f] * conv[width][j, :, f]
                sums[width] += step * step
                conv[width] -= RATE * step / np.sqrt(sums[width])
                sums["bias"][k] += b * b
                bias[k] -= RATE * b / np.sqrt(sums["bias"][k])
            for row, grad in dx.items():
                ids = g[row][g[row] >= 0]
                table_sums[ids] += float(grad @ grad)
                np.subtract.at(table, ids, (RATE * 0.2 * grad[None, :] / np.sqrt(table_sums[ids])[:, None]).astype(np.float32))
    table[-1] = 0
    vectors, logits, told = Vectors(model), [], []
    for start in range(0, len(examples), 64):
        a, b = forward(model, vectors, [words for words, _, _ in examples[start : start + 64]])
        logits.append(a)
        told.append(b)
    held = ~fit if min((y[~fit] == 1).sum(), (y[~fit] == 0).sum()) >= LEAST_HELD else np.ones(len(y), dtype=bool)
    logits, told, y = np.concatenate(logits)[held], np.concatenate(told)[held], y[held]
    everywhere = threshold(logits, y)
    for k in range(len(languages)):
        own = told == k
        enough = min((y[own] == 1).sum(), (y[own] == 0).sum()) >= LEAST_HELD
        model.thresholds[k] = threshold(logits[own], y[own]) if enough else everywhere
    if not languages:
        model.thresholds[:] = everywhere
    return model


def threshold(logits: np.ndarray, y: np.ndarray) -> float:
    """The cut with the best F1, in the middle between its neighbours."""
    order = np.argsort(-logits, kind="stable")
    hits, n = np.cumsum(y[order]), np.arange(1, len(y) + 1)
    f1 = 2 * hits / (n + max(y.sum(), 1))
    f1[:-1][np.diff(logits[order]) == 0] = -1  # no cut between equal logits
    k = int(np.argmax(f1))
    below = logits[order[k + 1]] if k + 1 < len(y) else logits[order[k]] - 1
    return float((logits[order[k]] + below) / 2)


def examples_of(rows: DataFrame) -> list[tuple[list[bytes], str | None, int]]:
    return [(alnum_words(t.encode() if t else None), lang, int(y)) for t, lang, y in rows.toLocalIterator()]


def scored(documents: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, from its text alone. Labels are learned only from rows outside
    the held-out fold of crc32(doc_id as text). Null and empty texts are scored as texts without a word; very long texts are
    scored whole; repeated rows and ties are scored each; without labels every score is near 0; an empty table gives an empty
    result; other columns, whatever their names, are ignored."""
    examples = examples_of(sample(documents.filter(~in_fold("doc_id", folds, held_out)), labels.filter(~in_fold("doc_id", folds, held_out)), "toxic"))
    shared = documents.sparkSession.sparkContext.broadcast(trained(examples))
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        vectors = Vectors(model)
        for batch in sliced(batches, limit=1 << 20):
            held = texts(batch)
            found = forward_long(model, vectors, held[0]) if len(held) == 1 and held[0] else forward(model, vectors, [alnum_words(t) for t in held])
            score = model.score(*found)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= CUT).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = documents.select("doc_id", "text", in_fold("doc_id", folds, held_out).alias("held_out"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
