"""License scans: a positional rare-token index.

Licence templates, whole licence texts and short notices, are word sequences. The index holds the positions of each
template's words of highest inverse document frequency (counted over all documents). A text looks up the rarest such words
that it holds; each posting votes for the place at which the template would start, and the postings are intersected by
relative position: a template counts at a place where enough of the words looked up that it has stand in line, and where
its mandatory key phrase stands word for word.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import alnum_words, sliced, texts, word_parts
from lattica.llm.license_texts import FULL_TEXTS

#: Words of a template that are in the index (its rarest), and words that a text looks up (the rarest it holds). Beside these
#: the rarest word of each key phrase is always in both, so that no phrase is missed.
RARE, LOOKED_UP = 12, 16
#: Share of the words looked up that a template has which must stand in line.
QUORUM = 0.5
#: Votes that are counted one by one; a text with more is worked on in stretches of STRETCH starts. Longer texts (bytes) are
#: held as numbers of words, not as words.
PLAIN_VOTES, STRETCH, LONG_TEXT = 1 << 16, 1 << 16, 1 << 20


@dataclass(frozen=True)
class Template:
    """A licence text and the phrase in it without which it doesn't count. ``base``: every place is counted."""

    label: str
    text: str
    phrase: str
    base: bool = False


#: The base phrases and their labels.
BASE_TEMPLATES = [
    Template("cc-by", "cc by", "cc by", True),
    Template("gpl", "general public license", "general public license", True),
    Template("reserved", "all rights reserved", "all rights reserved", True),
]

TEMPLATES = [
    *BASE_TEMPLATES,
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache license version 2 0"),
    Template("mit", "Released under the MIT License", "mit license"),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", "gnu general public license version 3"),
    Template("gpl-2.0", "This work is licensed under the GNU General Public License, version 2", "gnu general public license version 2"),
    Template("lgpl", "Licensed under the GNU Lesser General Public License", "lesser general public license"),
    Template("agpl", "Licensed under the GNU Affero General Public License", "affero general public license"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc"),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc by sa"),
    Template("cc-by-nd", "Licensed under CC BY-ND 4.0", "cc by nd"),
    Template("cc0", "Released under CC0 1.0 Universal", "cc0"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", "redistribution and use in source and binary forms"),
    Template("mpl-2.0", "Subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license"),
    *(Template(*t) for t in FULL_TEXTS),
]


def document_frequencies(documents: DataFrame, vocabulary: list[bytes]) -> tuple[int, dict[bytes, int]]:
    """Rows in all, and how many texts hold each word of the vocabulary. Each task sends one row a word at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, n = set(vocabulary), Counter(), 0
        for batch in sliced(batches):
            for text in texts(batch):
                n += 1
                counts.update({w for part in word_parts(text) for w in known.intersection(part)})
        counts[b""] = n
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    rows = documents.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {bytes(r[0]): r[1] for r in rows}
    return found.pop(b"", 0), found


class RareTokenIndex:
    """word -> {template: positions} for the rarest words of each template and the rarest of its key phrase."""

    def __init__(self, templates: list[Template], n: int, frequencies: dict[bytes, int], rare: int = RARE, looked_up: int = LOOKED_UP, quorum: float = QUORUM):
        self.templates, self.looked_up, self.quorum = templates, looked_up, quorum
        idf = {w: math.log((n + 1) / (frequencies.get(w, 0) + 1)) + 1 for t in templates for w in alnum_words(t.text.encode())}
        self.rank = {w: (-x, w) for w, x in idf.items()}
        self.words = [alnum_words(t.text.encode()) for t in templates]
        self.phrases = [alnum_words(t.phrase.encode()) for t in templates]
        self.starts = [next(i for i in range(len(w)) if w[i : i + len(p)] == p) for w, p in zip(self.words, self.phrases, strict=True)]
        self.weights = [[idf[w] for w in words] for words in self.words]
        self.always = {min(phrase, key=self.rank.__getitem__) for phrase in self.phrases}
        self.postings: dict[bytes, dict[int, list[int]]] = defaultdict(dict)
        for k, (words, phrase) in enumerate(zip(self.words, self.phrases, strict=True)):
            for w in {*sorted(set(words), key=self.rank.__getitem__)[:rare], min(phrase, key=self.rank.__getitem__)}:
                self.postings[w][k] = [j for j, x in enumerate(words) if x == w]
        self.postings = dict(self.postings)
        self.vocabulary = sorted({w for side in (*self.words, *self.phrases) for w in side})
        self.numbers = {w: i for i, w in enumerate(self.vocabulary)}

    def chosen(self, held: set[bytes]) -> list[bytes]:
        """The words that a text with the words ``held`` looks up."""
        by_rank = sorted(held, key=self.rank.__getitem__)
        return by_rank[: self.looked_up] + [w for w in by_rank[self.looked_up :] if w in self.always]

    def places(self, words: list[bytes]) -> dict[int, list[tuple[int, float]]]:
        """template -> [(word at which its key phrase starts, share of its IDF weight that stands in line)]."""
        held: dict[bytes, list[int]] = defaultdict(list)
        for i, w in enumerate(words):
            if w in self.postings:
                held[w].append(i)
        chosen = self.chosen(set(held))
        if sum(len(held[w]) * len(j) for w in chosen for j in self.postings[w].values()) > PLAIN_VOTES:
            return self.long_places(np.array([self.numbers.get(w, -1) for w in words], dtype=np.int32))
        votes, asked = Counter(), Counter()
        for w in chosen:
            for k, positions in self.postings[w].items():
                asked[k] += 1
                votes.update({(k, i - j) for j in positions for i in held[w]})
        out: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for (k, offset), n in votes.items():
            at = offset + self.starts[k]
            if n >= self.quorum * asked[k] and at >= 0 and words[at : at + len(self.phrases[k])] == self.phrases[k]:
                weights = self.weights[k]
                in_line = sum(x for j, (w, x) in enumerate(zip(self.words[k], weights, strict=True)) if 0 <= offset + j < len(words) and words[offset + j] == w)
                out[k].append((at, in_line / sum(weights)))
        return out

    def numbered(self, text: bytes) -> np.ndarray:
        """The text's words as their numbers, -1 for one that no template has."""
        return np.concatenate([np.zeros(0, dtype=np.int32), *(np.array([self.numbers.get(w, -1) for w in part], dtype=np.int32) for part in word_parts(text))])

    def long_places(self, ids: np.ndarray) -> dict[int, list[tuple[int, float]]]:
        """places() of a text whose words are given as numbers: votes are counted in arrays over a stretch of starts at once."""
        chosen = self.chosen({self.vocabulary[i] for i in np.unique(ids) if i >= 0 and self.vocabulary[i] in self.postings})
        at_word = {w: np.flatnonzero(ids == self.numbers[w]) for w in chosen}
        out: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for k in sorted({k for w in chosen for k in self.postings[w]}):
            own = [w for w in chosen if k in self.postings[w]]
            phrase, words = ([self.numbers[w] for w in side[k]] for side in (self.phrases, self.words))
            for start in range(-len(words), len(ids), STRETCH):
                votes = np.zeros(STRETCH, dtype=np.int32)
                for w in own:
                    hit = np.zeros(STRETCH, dtype=bool)
                    for j in self.postings[w][k]:
                        a, b = np.searchsorted(at_word[w], [start + j, start + j + STRETCH])
                        hit[at_word[w][a:b] - j - start] = True
                    votes += hit
                offsets = start + np.flatnonzero((votes > 0) & (votes >= self.quorum * len(own)))
                offsets = offsets[(offsets + self.starts[k] >= 0) & (offsets + self.starts[k] + len(phrase) <= len(ids))]
                for j, w in enumerate(phrase):
                    offsets = offsets[ids[offsets + self.starts[k] + j] == w]
                in_line = np.zeros(len(offsets))
                for j, (w, x) in enumerate(zip(words, self.weights[k], strict=True)):
                    there = (offsets + j >= 0) & (offsets + j < len(ids))
                    in_line += np.where(there & (ids[np.where(there, offsets + j, 0)] == w), x, 0.0)
                if len(offsets):
                    out[k] += zip((offsets + self.starts[k]).tolist(), (in_line / sum(self.weights[k])).tolist(), strict=True)
        return out


def scanned(documents: DataFrame, templates: list[Template] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places.

    ``n_base`` counts every place of a base phrase, ``first_word`` and ``last_word`` are the least and greatest start of
    one (words from 0; null without). ``score`` is the largest share of a template's IDF weight that stands in line at
    a verified place, 0 without any. ``places`` lists label@word. Null and empty texts have no words; very long texts are
    scanned whole; repeated rows are scanned each; other columns are ignored; an empty table gives an empty result."""
    templates = TEMPLATES if templates is None else templates
    vocabulary = sorted({w for t in templates for w in alnum_words(t.text.encode())})
    n, frequencies = document_frequencies(documents, vocabulary)
    kind = dict(documents.dtypes)["doc_id"]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RareTokenIndex(templates, n, frequencies)
        base = {k for k, t in enumerate(templates) if t.base}
        for batch in sliced(batches):
            rows = []
            for text in texts(batch):
                if text and len(text) > LONG_TEXT:
                    words = index.numbered(text)
                    found = index.long_places(words)
                else:
                    words = alnum_words(text)
                    found = index.places(words)
                at = sorted(p for k in base & found.keys() for p, _ in found[k])
                rows.append(
                    (
                        len(words),
                        len(at),
                        at[0] if at else None,
                        at[-1] if at else None,
                        ",".join(sorted({templates[k].label for k in base & found.keys()})),
                        ",".join(sorted({templates[k].label for k in found})),
                        max((min(1.0, s) for x in found.values() for _, s in x), default=0.0),
                        ",".join(f"{templates[k].label}@{p}" for p, k in sorted((p, k) for k, x in found.items() for p, _ in x)),
                    )
                )
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)

    schema = f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, places string"
    return documents.select("doc_id", "text").mapInArrow(run, schema)
