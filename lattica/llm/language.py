"""Language ID by hyperdimensional profiles.

Each letter has a random vector of +1 and -1 drawn from its code point. A letter n-gram binds (multiplies) the vectors
of its letters, each permuted (rolled) by its place in the n-gram; a text bundles (adds) its n-grams; a language's
prototype bundles the texts known to be in it. A text is compared with the centred prototypes by cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import in_fold, sliced, written
from lattica.operators.numbering import unused

DIMENSIONS = 1024
ORDER = 3
#: Prototypes are fitted on about so many different texts at most, in equal parts by language, chosen by a hash of text and
#: language; of each language on about so many at least, if it has them.
MAX_FIT_ROWS, LEAST_FIT_ROWS = 20_000, 30
#: Sharpness of the softmax that turns cosines into a score.
SHARPNESS = 12.0
#: A text whose best cosine is below such a share of the least one in a thousand of the learned texts is in no learned language.
BOUND_PART, BOUND_QUANTILE = 0.5, 0.001
LETTERS = regex.compile(r"\p{L}+")
#: n-grams whose vectors are kept between texts.
KEPT = 1 << 14


class Encoder:
    """Turns texts into bundled vectors. Vectors depend on code points alone, so every task draws the same ones."""

    def __init__(self, dimensions: int = DIMENSIONS, order: int = ORDER):
        self.dimensions, self.order = dimensions, order
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.vectors = np.zeros((256, dimensions), dtype=np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            self.letters[code] = np.random.default_rng([17, code]).integers(0, 2, self.dimensions, dtype=np.int8) * 2 - 1
        return self.letters[code]

    def gram(self, key: int) -> int:
        """Row of an n-gram's vector; the key holds its code points, 21 bits each."""
        row = self.rows.get(key)
        if row is None:
            row = self.rows[key] = len(self.rows)
            if row == len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
            out = np.ones(self.dimensions, dtype=np.int8)
            for place in range(self.order):
                out = out * np.roll(self.letter((key >> (21 * (self.order - 1 - place))) & 0x1FFFFF), self.order - 1 - place)
            self.vectors[row] = out
        return row

    def encoded(self, text: str | None) -> np.ndarray | None:
        """Unit vector of the text; None if it holds no letter."""
        words = LETTERS.findall(text.lower()) if text else []
        if not words:
            return None
        codes = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        keys = codes[: len(codes) - self.order + 1].copy()
        for place in range(1, self.order):
            keys = (keys << 21) | codes[place : len(codes) - self.order + 1 + place]
        keys, counts = np.unique(keys, return_counts=True)
        if len(self.rows) + len(keys) > KEPT:
            self.rows.clear()
        out = np.zeros(self.dimensions, dtype=np.float32)
        for start in range(0, len(keys), KEPT // 4):  # texts with very many different n-grams
            part = keys[start : start + KEPT // 4].tolist()
            if len(self.rows) + len(part) > KEPT:
                self.rows.clear()
            at = [self.gram(k) for k in part]
            out += counts[start : start + KEPT // 4].astype(np.float32) @ self.vectors[at].astype(np.float32)
        norm = float(np.linalg.norm(out))
        return out / norm if norm else out


def unit(v: np.ndarray) -> np.ndarray:
    return v / max(np.linalg.norm(v), 1e-12)


def different(rows: DataFrame) -> DataFrame:
    """Different (text, lang) of the rows with both."""
    return rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", F.col("lang").cast("string").alias("lang")).distinct()


def sample(rows: DataFrame, max_fit_rows: int = MAX_FIT_ROWS, seed: int = 17) -> DataFrame:
    """Different (text, lang) of the rows with both. A language with more texts than its part of ``max_fit_rows`` is thinned
    to about that part by a hash of text and lang; one with fewer is taken whole. Equal texts count once."""
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", F.col("lang").cast("string").alias("lang"))
    key = F.xxhash64("text", "lang", F.lit(seed))
    counts = {r[0]: r[1] for r in rows.select("lang", key.alias("key")).distinct().groupBy("lang").count().collect()}
    most = max(max_fit_rows / max(len(counts), 1), LEAST_FIT_ROWS)
    spread = F.pmod(key, F.lit(1 << 30)) / float(1 << 30)
    if any(n > most for n in counts.values()):
        parts = rows.sparkSession.createDataFrame([(k, min(1.0, most / n)) for k, n in counts.items()], "lang string, part double")
        rows = rows.join(F.broadcast(parts), "lang").filter(spread < F.col("part"))
    return written(rows.select("text", "lang").distinct(), "learning")


def bundled(rows: DataFrame) -> dict[str, np.ndarray]:
    """Sum of the texts' vectors by language. Each task sends one sum a language, and the driver gets languages x dimensions
    numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sums = Encoder(), {}
        for batch in sliced(batches):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                if (v := encoder.encoded(text)) is not None:
                    sums[lang] = sums.get(lang, 0) + v.astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "v"])

    parts = rows.mapInArrow(run, "lang string, v array<double>")
    summed = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    frame = summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v")).toPandas()
    sums = {r.lang: np.array([x["x"] for x in r.v]) for r in frame.itertuples()}
    return {k: sums[k] for k in sorted(sums)}


def middle(sums: dict[str, np.ndarray]) -> np.ndarray | float:
    """What is taken from all prototypes: their mean, if there are several."""
    return np.mean([unit(v) for v in sums.values()], axis=0) if len(sums) > 1 else 0.0


def centred(sums: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {k: unit(unit(v) - middle(sums)) for k, v in sums.items()}


def fitted(rows: DataFrame, max_fit_rows: int = MAX_FIT_ROWS, seed: int = 17) -> dict[str, np.ndarray]:
    """Centred prototypes by language, from the non-null ``lang`` of a sample of ``rows``."""
    return centred(bundled(sample(rows, max_fit_rows, seed)))


def least_cosine(rows: DataFrame, sums: dict[str, np.ndarray]) -> float:
    """The bound below which a text is in no learned language, from the texts ``rows`` that were bundled to ``sums``. Each is
    compared as if it hadn't been learned: its own language's prototype is made without it."""
    names, prototypes, mean = list(sums), centred(sums), middle(sums)
    matrix = np.array([prototypes[k] for k in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in sliced(batches):
            found = []
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                if (v := encoder.encoded(text)) is None:
                    continue
                cosines = matrix @ v
                rest = unit(sums[lang] - v)
                own = unit(rest - (mean + (rest - unit(sums[lang])) / len(names) if len(names) > 1 else 0.0))
                cosines[names.index(lang)] = own @ v
                found.append(float(cosines.max()))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64())], ["best"])

    least = rows.mapInArrow(run, "best double").agg(F.percentile_approx("best", BOUND_QUANTILE, 100_000)).first()[0]
    return -1.0 if least is None else BOUND_PART * least if least > 0 else least


def predicted(documents: DataFrame, prototypes: dict[str, np.ndarray], bound: float = -1.0) -> DataFrame:
    """All rows and columns of ``documents`` with lang_pred and score (0 to 1), from the text alone. ``und`` and 0 for null
    and empty texts, texts without a letter, texts whose best cosine is below ``bound``, and when no language was learned; very long
    texts are read whole. Input columns so called are replaced, all others stay."""
    rows = documents.drop("lang_pred", "score")
    names, own = list(prototypes), rows.columns
    matrix = np.array([prototypes[k] for k in names], dtype=np.float32).reshape(len(names), DIMENSIONS)
    shared = rows.sparkSession.sparkContext.broadcast((names, matrix))
    schema = rows.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = shared.value
        encoder = Encoder()
        for batch in sliced(batches):
            found, scores = [], []
            for text in batch.column("text").to_pylist():
                v = encoder.encoded(text) if names else None
                if v is None:
                    found.append("und")
                    scores.append(0.0)
                    continue
                cosines = (matrix @ v).astype(np.float64)
                best = int(np.argmax(cosines))
                if cosines[best] < bound:
                    found.append("und")
                    scores.append(0.0)
                    continue
                found.append(names[best])
                scores.append(float(1 / np.exp(SHARPNESS * (cosines - cosines[best])).sum()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(found, pa.string()), pa.array(scores, pa.float64())], schema.names)

    return rows.mapInArrow(run, schema)


def identified(documents: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; languages are learned from the rows outside the held-out fold
    of crc32(doc_id as text). Null and empty texts are ``und`` with a score of 0; very long texts are read whole; repeated rows
    are predicted each; of languages with equal cosines the first by name is taken; an empty table gives an empty result;
    other columns, whatever their names, are ignored."""
    prototypes = fitted(documents.filter(~in_fold("doc_id", folds, held_out)))
    rows = documents.select("doc_id", "text", in_fold("doc_id", folds, held_out).alias("held_out"))
    return predicted(rows, prototypes).select("doc_id", "held_out", "lang_pred", "score")


def accepted(documents: DataFrame, languages: list[str] | None = None, least_score: float = 0.0, folds: int = 4, held_out: int = 2) -> DataFrame:
    """The documents, with their own columns, whose predicted language is one of ``languages`` (None: any learned one) with a
    score of ``least_score`` or more. Texts without a letter are rejected, and texts further from every learned language than
    nearly all learned texts (least_cosine). Languages and that bound come from all texts outside the held-out fold. Where no
    language was learned nothing tells against a text: with ``languages`` None all with a letter stay; none is in a language
    asked for by name."""
    learning = written(different(documents.filter(~in_fold("doc_id", folds, held_out))), "learning")
    sums = bundled(learning)
    if not sums and languages is None:
        return documents.filter(F.col("text").rlike(r"\p{L}"))
    own = {c: unused(documents, f"own_{c}") for c in documents.columns if c.lower() in ("lang_pred", "score")}
    rows = predicted(documents.withColumnsRenamed(own), centred(sums), least_cosine(learning, sums) if sums else -1.0)
    kept = rows.filter(F.col("lang_pred") != "und" if languages is None else F.col("lang_pred").isin(languages)).filter(F.col("score") >= least_score)
    return kept.select(*[F.col(own.get(c, c)).alias(c) for c in documents.columns])
