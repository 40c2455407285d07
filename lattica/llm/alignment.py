"""Cross-tokenizer alignment with id-striped dense count matrices.

Two tokenizers cut a text at byte offsets; where both cut, a group of tokens ends, and every token of one side in a group is
linked with every one of the other. Texts are tokenised where they lie, once. Links are dealt to stripes by the first
side's id (``id mod stripes``), so that frequent ids are spread. A task adds up a stripe in a dense matrix (ids of
the stripe x ids of the other side): documents that hold a pair linked. Row maxima tell each id's best partner, and the
stripe's links, dealt to the same key as its matrix, are scored against it.

Tokenisers work on chunks between single spaces, over which neither of them merges, so that a chunk met before costs a
lookup; where that can't be shown for a text, the text is one chunk.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import dropped, sliced, written
from lattica.llm.packing import ByteCodec, token_ids

#: Files of public tokenizers that the driver reads: byte-level BPE (A), and pieces with byte fallback (B).
BYTE_VOCABULARY, PIECE_MODEL = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Stripes of A's ids: with 50,000 and 32,000 ids a stripe's matrix has 130 MB.
STRIPES = 99
#: Blobs of a stripe that meet in one task; more are added up level by level, and scored in as many groups.
FAN = 1024
#: Chunks kept with their alignment, and bytes of them.
KEPT_CHUNKS, KEPT_BYTES = 1 << 18, 64 << 20
#: Chunks expanded to links at once, characters of a text split at once, and pairs of a group written out one by one.
EXPANDED, SPLIT_CHARS, PLAIN_PAIRS = 1 << 18, 1 << 20, 1 << 12
#: Bits of a document's number in its slice.
DOC_BITS = 20
#: A space between two characters that no tokenizer takes for white space.
BETWEEN = re.compile(r"(?<=[^\s\x00-\x20▁]) (?=[^\s\x00-\x20▁])")
#: A chunk between two such spaces.
INNER = re.compile(r"[^\s\x00-\x20▁](?:.*[^\s\x00-\x20▁])?", re.DOTALL)


def byte_level() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_tokens(vocabulary: bytes) -> dict[bytes, int]:
    """Bytes of each entry and its id, without the special tokens."""
    found, alphabet = json.loads(vocabulary), byte_level()
    special = {t["content"] for t in found.get("added_tokens", [])}
    return {bytes(alphabet[c] for c in token): i for token, i in found["model"]["vocab"].items() if token not in special}


def piece_bytes(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]


def packed(*arrays: np.ndarray) -> bytes:
    """Whole numbers from 0 on, each array in its narrowest type, compressed."""
    out = []
    for x in arrays:
        kind = np.min_scalar_type(int(x.max()) if len(x) else 0)
        out += [np.array([len(x), kind.itemsize], dtype=np.int64).tobytes(), x.astype(kind).tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpacked(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        n, size = np.frombuffer(raw, np.int64, 2, at).tolist()
        out.append(np.frombuffer(raw, f"u{size}", n, at + 16).astype(np.int64))
        at += 16 + n * size
    return out


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places starts[i] .. starts[i] + counts[i] - 1, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts - starts, counts)


class Grown:
    """Columns of whole numbers to which more are added at the end; room is doubled when it runs out."""

    def __init__(self, rows: int):
        self.room, self.size = np.zeros((rows, 1024), dtype=np.int64), 0

    def add(self, values: np.ndarray) -> None:
        more = self.size + values.shape[1]
        if more > self.room.shape[1]:
            room = np.zeros((len(self.room), max(more, 2 * self.room.shape[1])), dtype=np.int64)
            room[:, : self.size] = self.room[:, : self.size]
            self.room = room
        self.room[:, self.size : more] = values
        self.size = more


class Aligner:
    """Both tokenizers, and the chunks met so far with their tokens, groups and links. A link's key is
    ``stripe * width + row * n_b + b``."""

    def __init__(self, vocabulary: bytes, model: bytes, stripes: int = STRIPES):
        ranks = byte_tokens(vocabulary)
        self.codec = ByteCodec(ranks)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = piece_bytes(self.pieces)
        self.a_size, self.b_size = (np.array([len(x) for x in side], dtype=np.int64) for side in (self.a_bytes, self.b_bytes))
        self.n_a, self.n_b, self.stripes = len(self.a_bytes), len(self.b_bytes), stripes
        self.width = -(-self.n_a // stripes) * self.n_b
        self.words = [f"{i}{end}" for i in range(self.n_a) for end in ",|"] + [f"{i}{end}" for i in range(self.n_b) for end in (",", ";", "\n")]
        # A's pattern always cuts before a space between two other characters; B does if none of its pieces has a space behind one
        self.splits = not any(re.search(rb"[^ ] ", x) for x in self.b_bytes)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.bytes, self.texts = 0, []
        #: Of each chunk: tokens of A, of B, groups, links, 1 if the bytes are the text's, where its different links start, how
        #: many, and how often the chunk was met.
        self.counts = Grown(8)
        self.links = Grown(2)  # keys, and how often

    def thinned(self) -> None:
        """Forgets the chunks that were met once; all, if that leaves more than half of them."""
        keep = np.flatnonzero(self.counts.room[7, : self.counts.size] > 1)
        known, texts, counts, links = list(self.known), self.texts, self.counts.room[:, keep], self.links.room
        self.clear()
        if len(keep) > KEPT_CHUNKS // 2:
            return
        self.known = {known[k]: i for i, k in enumerate(keep.tolist())}
        self.texts = [texts[k] for k in keep.tolist()]
        self.bytes = sum(map(len, self.known)) + sum(map(len, self.texts))
        self.links.add(links[:, spread(counts[5], counts[6])])
        counts[5], counts[7] = np.cumsum(counts[6]) - counts[6], 0
        self.counts.add(counts)

    def numbers(self, chunks: list[str]) -> list[int]:
        found = list(map(self.known.get, chunks))
        if None in found:
            self._add(list(dict.fromkeys(c for c, k in zip(chunks, found, strict=True) if k is None)))
            found = list(map(self.known.get, chunks))
        return found

    def _tokens(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The chunks in another order, the tokens of A and B of all, how many each chunk has, and whether its bytes are right.
        Chunks that end in no white space at either side are given to the tokenizers as one text."""
        inner = [c for c in chunks if INNER.fullmatch(c)] if self.splits else []
        single = [c for c in chunks if not INNER.fullmatch(c)] if inner else chunks
        a, b, na, nb = (np.zeros(0, dtype=np.int64) for _ in range(4))
        if inner:
            text = " ".join(inner)
            x, y = token_ids(self.codec, " " + text), self.pieces.encode(text)
            ends = np.cumsum([1 + len(c.encode()) for c in inner])
            raw, a, b = b" " + text.encode(), np.array(x, dtype=np.int64), np.array(y, dtype=np.int64)
            last = [np.searchsorted(e, ends, side="right") for e in (np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]))]
            if b"".join(map(self.a_bytes.__getitem__, x)) == raw and b"".join(map(self.b_bytes.__getitem__, y)) == raw:
                na, nb = (np.diff(k, prepend=0) for k in last)
            else:  # some chunk isn't given back
                inner, single, a, b = [], chunks, a[:0], b[:0]
        of_a, of_b, right = [token_ids(self.codec, " " + c) for c in single], self.pieces.encode(single, num_threads=1), []
        for k, (c, x, y) in enumerate(zip(single, of_a, of_b, strict=True)):
            raw = b" " + c.encode()
            right.append(b"".join(map(self.a_bytes.__getitem__, x)) == raw and b"".join(map(self.b_bytes.__getitem__, y)) == raw)
            if not right[k]:
                of_a[k], of_b[k] = [], []
        sides = [(np.append(n, [len(x) for x in side]).astype(np.int64), np.append(t, np.fromiter(chain.from_iterable(side), np.int64))) for n, t, side in ((na, a, of_a), (nb, b, of_b))]
        return inner + single, sides[0][1], sides[1][1], sides[0][0], sides[1][0], np.append(np.ones(len(inner), dtype=bool), right).astype(bool)

    def _add(self, chunks: list[str]) -> None:
        chunks, a, b, na, nb, right = self._tokens(chunks)
        ends_a, ends_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        ga, gb = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        ca, cb = np.bincount(ga, minlength=len(cuts)), np.bincount(gb, minlength=len(cuts))
        sa, sb = np.cumsum(ca) - ca, np.cumsum(cb) - cb
        chunk_a = np.repeat(np.arange(len(chunks)), na)
        chunk = chunk_a[sa]  # of each group

        large = ca * cb > PLAIN_PAIRS
        counts = np.where(large, 0, cb)[ga]
        x, y = np.repeat(a, counts), b[spread(sb[ga], counts)]
        at, times = np.repeat(chunk_a, counts), np.ones(counts.sum(), dtype=np.int64)
        for g in np.flatnonzero(large):  # different ids only, with how often they are linked
            u, m = np.unique(a[sa[g] : sa[g] + ca[g]], return_counts=True)
            v, n = np.unique(b[sb[g] : sb[g] + cb[g]], return_counts=True)
            x, y = np.append(x, np.repeat(u, len(v))), np.append(y, np.tile(v, len(u)))
            at, times = np.append(at, np.full(len(u) * len(v), chunk[g])), np.append(times, np.outer(m, n).ravel())
        keys = x % self.stripes * self.width + x // self.stripes * self.n_b + y
        order = np.argsort(at, kind="stable")

        last_a = np.arange(len(a)) == (sa + ca - 1)[ga]
        last_b = np.arange(len(b)) == (sb + cb - 1)[gb]
        final = np.zeros(len(b), dtype=bool)
        final[(np.cumsum(nb) - 1)[nb > 0]] = True
        codes = np.empty(len(a) + len(b), dtype=np.int64)
        codes[np.arange(len(a)) + sb[ga]] = 2 * a + last_a
        codes[np.arange(len(b)) + (sa + ca)[gb]] = 2 * self.n_a + 3 * b + last_b + final
        words = "".join(map(self.words.__getitem__, codes.tolist())).split("\n")[:-1]
        texts = iter(words)
        words = [next(texts) if n else "" for n in nb.tolist()]
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + len(chunks)), strict=True))
        self.texts += words
        self.bytes += sum(map(len, chunks)) + sum(map(len, words))
        per = lambda weights: np.bincount(chunk, weights, len(chunks)).astype(np.int64)
        own = np.bincount(at, minlength=len(chunks))
        self.counts.add(np.stack([na, nb, np.bincount(chunk, minlength=len(chunks)), per((ca * cb).astype(float)), right, self.links.size + np.cumsum(own) - own, own, np.zeros(len(chunks))]))
        self.links.add(np.stack([keys[order], times[order]]))

    def chunks(self, text: str) -> Iterator[list[str]]:
        """The text's chunks, those of about SPLIT_CHARS characters at once."""
        start = 0
        while self.splits and start + SPLIT_CHARS < len(text) and (cut := BETWEEN.search(text, start + SPLIT_CHARS)):
            yield BETWEEN.split(text[start : cut.start()])
            start = cut.end()
        rest = text[start:]
        yield BETWEEN.split(rest) if self.splits else [rest]

    def aligned(self, rows: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """For a slice of texts: tokens of A, of B, groups and links of each; the digests of their groups; the different
        ``key << DOC_BITS | text`` in order, and how often each is linked."""
        totals, digests = np.zeros((len(rows), 4), dtype=np.int64), {}
        done: list[tuple[np.ndarray, np.ndarray]] = []
        held: list[tuple[int, list[str]]] = []
        wrong: set[int] = set()

        def work() -> None:
            """Looks up the chunks held, those of many texts at once."""
            if len(self.known) > KEPT_CHUNKS or self.bytes > KEPT_BYTES:
                self.thinned()
            number = np.array(self.numbers([c for _, part in held for c in part]), dtype=np.int64)
            sizes = [len(part) for _, part in held]
            doc, counts = np.repeat([d for d, _ in held], sizes).astype(np.int64), self.counts.room[:, number]
            self.counts.room[7] += np.bincount(number, minlength=self.counts.room.shape[1])
            wrong.update(np.unique(doc[counts[4] == 0]).tolist())
            for k in range(4):
                totals[:, k] += np.bincount(doc, counts[k], len(rows)).astype(np.int64)
            at = spread(counts[5], counts[6])
            done.append(summed(self.links.room[0, at] << DOC_BITS | np.repeat(doc, counts[6]), self.links.room[1, at]))
            texts, start = list(map(self.texts.__getitem__, number.tolist())), 0
            for (d, _), size in zip(held, sizes, strict=True):
                line = ";".join(texts[start : start + size]).encode()
                if d in digests:
                    digests[d].update(b";" + line)
                else:
                    digests[d] = hashlib.sha256(line)
                start += size
            held.clear()

        size = 0
        for d, text in enumerate(rows):
            for part in self.chunks(text) if text else ():
                held.append((d, part))
                size += len(part)
                if size > EXPANDED:
                    work()
                    size = 0
        work()
        if wrong:  # some chunk's bytes differ: these texts are judged as one chunk each
            done = [(k[keep], n[keep]) for k, n in done if (keep := ~np.isin(k & ((1 << DOC_BITS) - 1), list(wrong))).any()]
            again = sorted(wrong)
            totals[again] = 0
            for d in again:
                digests.pop(d)
            if self.splits:
                held += [(d, [rows[d]]) for d in again]
                wrong.clear()
                work()
                for d in wrong:
                    digests.pop(d)
        return totals, [digests[d].hexdigest() if d in digests else "" for d in range(len(rows))], *summed(*(np.concatenate([x[k] for x in done]) if done else np.zeros(0, dtype=np.int64) for k in (0, 1)))


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order and the sum of ``n`` of each."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[starts], np.add.reduceat(n, starts) if len(keys) else n


def encoded(documents: DataFrame, vocabulary: str, model: str, stripes: int) -> DataFrame:
    """Rows of two kinds: one a document (stripe -1), and one a slice and stripe: the different pairs of the slice with the
    documents that hold them."""
    with open(vocabulary, "rb") as f, open(model, "rb") as g:
        files = documents.sparkSession.sparkContext.broadcast((f.read(), g.read()))
    kind = dict(documents.dtypes)["doc_id"]
    schema = f"slice long, stripe int, place int, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, links binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = Aligner(*files.value, stripes), TaskContext.get().partitionId() << 32
        for batch in sliced(batches):
            totals, digests, keys, times = aligner.aligned(batch.column("text").to_pylist())
            size, number = batch.num_rows, number + 1
            nothing = pa.nulls(size, pa.binary())
            columns = [pa.array([number] * size, pa.int64()), pa.array([-1] * size, pa.int32()), pa.array(np.arange(size, dtype=np.int32)), batch.column("doc_id")]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(np.ascontiguousarray(c)) for c in totals.T), pa.array(digests, pa.string()), nothing, nothing], names)
            pair, doc = keys >> DOC_BITS, keys & ((1 << DOC_BITS) - 1)
            bounds = np.searchsorted(pair, np.arange(stripes + 1) * aligner.width)
            some = [s for s in range(stripes) if bounds[s] < bounds[s + 1]]
            pairs, links = [], []
            for s in some:
                part = slice(bounds[s], bounds[s + 1])
                different, counts = np.unique(pair[part] - s * aligner.width, return_counts=True)
                pairs.append(packed(np.diff(different, prepend=0), counts))
                links.append(packed(doc[part], times[part] - 1))
            empty = [pa.nulls(len(some), k) for k in (pa.int32(), batch.schema.field("doc_id").type, *[pa.int64()] * 4, pa.string())]
            columns = [pa.array([number] * len(some), pa.int64()), pa.array(some, pa.int32()), *empty, pa.array(pairs, pa.binary()), pa.array(links, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def dealt(rows: DataFrame, groups: int) -> DataFrame:
    """Rows of a stripe in ``groups`` groups by their slice, each together and in order."""
    return rows.withColumn("part", F.pmod(F.xxhash64("slice"), F.lit(groups))).repartition("stripe", "part").sortWithinPartitions("stripe", "part", "slice")


def counted(pairs: DataFrame, slices: int, width: int) -> DataFrame:
    """(stripe, slice, pairs) with one blob a stripe: its pairs and in how many documents each is linked. Up to FAN blobs are
    added into a dense block at once; the sums of these are added up in the same way until one is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, now = np.zeros(width, dtype=np.int64), None

        def out() -> pa.RecordBatch:
            keys = np.flatnonzero(block)
            blob = packed(np.diff(keys, prepend=0), block[keys])
            block.fill(0)
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int64()), pa.array([blob], pa.binary())], ["stripe", "slice", "pairs"])

        for batch in batches:
            for stripe, part, data in zip(*(batch.column(c).to_pylist() for c in ("stripe", "part", "pairs")), strict=True):
                if now and now != (stripe, part):
                    yield out()
                now = (stripe, part)
                steps, counts = unpacked(data)
                np.add.at(block, np.cumsum(steps), counts)
        if now:
            yield out()

    while True:
        slices = -(-slices // FAN)
        pairs = dealt(pairs, max(1, slices)).select("stripe", "part", "pairs").mapInArrow(run, "stripe int, slice long, pairs binary")
        if slices <= 1:
            return pairs


def scored(rows: DataFrame, counts: DataFrame, slices: int, width: int, n_b: int) -> DataFrame:
    """(slice, scores) for each slice and stripe: of each document the links to a best partner, and the sum of counts. A
    stripe's matrix goes to each group of its links and comes first there."""
    groups = max(1, -(-slices // FAN))
    matrix = counts.select("stripe", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), F.lit(-1).cast("long").alias("slice"), "pairs", F.lit(None).cast("binary").alias("links"))
    links = rows.withColumn("part", F.pmod(F.xxhash64("slice"), F.lit(groups)).cast("int")).select(*matrix.columns)
    met = matrix.unionByName(links).repartition("stripe", "part").sortWithinPartitions("stripe", "part", "slice")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best = np.zeros(width, dtype=np.int64), None
        for batch in batches:
            numbers, out = [], []
            for number, pairs, data in zip(*(batch.column(c).to_pylist() for c in ("slice", "pairs", "links")), strict=True):
                steps, n = unpacked(pairs)
                keys = np.cumsum(steps)
                if number < 0:
                    block.fill(0)
                    block[keys] = n
                    best = block.reshape(-1, n_b).max(axis=1)
                    continue
                doc, more = unpacked(data)
                count, hit = np.repeat(block[keys], n), np.repeat(block[keys] == best[keys // n_b], n)
                sums = np.zeros((2, int(doc.max()) + 1), dtype=np.int64)
                np.add.at(sums[0], doc, (more + 1) * hit)
                np.add.at(sums[1], doc, (more + 1) * count)
                numbers.append(number)
                out.append(packed(sums[0], sums[1]))
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(out, pa.binary())], ["slice", "scores"])

    return met.mapInArrow(run, "slice long, scores binary")


def added_up(scores: DataFrame) -> DataFrame:
    """(slice, place, n_best, count_sum): the stripes' sums added up, one slice at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros((2, 0), dtype=np.int64)

        def out() -> pa.RecordBatch:
            n = sums.shape[1]
            return pa.RecordBatch.from_arrays([pa.array([now] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), pa.array(sums[0]), pa.array(sums[1])], ["slice", "place", "n_best", "count_sum"])

        for batch in batches:
            for number, data in zip(batch.column("slice").to_pylist(), batch.column("scores").to_pylist(), strict=True):
                if now is not None and now != number:
                    yield out()
                    sums = np.zeros((2, 0), dtype=np.int64)
                now, part = number, np.stack(unpacked(data))
                if part.shape[1] > sums.shape[1]:
                    sums = np.pad(sums, ((0, 0), (0, part.shape[1] - sums.shape[1])))
                sums[:, : part.shape[1]] += part
        if now is not None:
            yield out()

    return scores.repartition("slice").sortWithinPartitions("slice").mapInArrow(run, "slice long, place int, n_best long, count_sum long")


def best_partners(counts: DataFrame, stripes: int, n_b: int) -> DataFrame:
    """(a, b, count): the pairs with the highest count of each id of A, ties included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stripe, data in zip(batch.column("stripe").to_pylist(), batch.column("pairs").to_pylist(), strict=True):
                steps, n = unpacked(data)
                keys = np.cumsum(steps)
                row = keys // n_b
                starts = np.flatnonzero(np.diff(row, prepend=-1))
                top = np.repeat(np.maximum.reduceat(n, starts), np.diff(np.append(starts, len(row)))) == n
                columns = [row[top] * stripes + stripe, keys[top] % n_b, n[top]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "count"])

    return counts.mapInArrow(run, "a long, b long, count long")


def pair_counts(documents: DataFrame, vocabulary: str = BYTE_VOCABULARY, model: str = PIECE_MODEL, stripes: int = STRIPES) -> tuple[DataFrame, DataFrame, int]:
    """The table of encoded(), that of counted(), and the number of slices."""
    rows = written(encoded(documents, vocabulary, model, stripes), "encoded")
    slices = rows.filter("stripe < 0 and place = 0").count()
    n_a, n_b = sizes(vocabulary, model)
    counts = counted(rows.filter("stripe >= 0").select("stripe", "slice", "pairs"), slices, -(-n_a // stripes) * n_b)
    return rows, written(counts, "pair-counts"), slices


def sizes(vocabulary: str, model: str) -> tuple[int, int]:
    with open(vocabulary, "rb") as f:
        n_a = max(byte_tokens(f.read()).values()) + 1
    return n_a, sentencepiece.SentencePieceProcessor(model_file=model).vocab_size()


def token_map(documents: DataFrame, vocabulary: str = BYTE_VOCABULARY, model: str = PIECE_MODEL, stripes: int = STRIPES) -> DataFrame:
    """(a, b, count): for each id of A that occurs, its best partners in B over all documents."""
    rows, counts, _ = pair_counts(documents, vocabulary, model, stripes)
    dropped(rows)
    return best_partners(counts, stripes, sizes(vocabulary, model)[1])


def alignment(documents: DataFrame, vocabulary: str = BYTE_VOCABULARY, model: str = PIECE_MODEL, stripes: int = STRIPES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document.

    A reads a space and the text, B the text, to which it adds the space; special tokens are plain text. Groups end at byte
    offsets at which tokens of both end; each token of A in a group is linked with each of B there. A pair's count is the
    number of documents that hold it linked; ``n_best`` counts links whose pair has the highest count of its id of A, ties
    included; ``count_sum`` adds up the counts of all links.

    Defined results: null and empty texts, and texts whose tokens don't give back a space and the text, have zeros and an
    empty digest; repeated rows are documents each; a null doc_id stays null; very long texts are aligned whole, part by
    part; an empty table gives an empty result; other columns are ignored. A pair that most documents hold is one
    entry a slice and document, spread over the groups of its stripe."""
    rows, counts, slices = pair_counts(documents, vocabulary, model, stripes)
    n_a, n_b = sizes(vocabulary, model)
    scores = added_up(scored(rows.filter("stripe >= 0").select("stripe", "slice", "pairs", "links"), counts, slices, -(-n_a // stripes) * n_b, n_b))
    own = rows.filter("stripe < 0").select("slice", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return own.join(scores, ["slice", "place"], "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
