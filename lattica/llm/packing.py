"""Token-ID output: documents as token numbers, packed into rows of one length.

Documents are tokenised where they lie. Those longer than a row are split losslessly into whole rows and a rest; the
pieces of a run of documents are packed by best-fit decreasing: longest first, each into the fullest row that still has
room, found in a segment tree over free capacities. A packed row holds the ids as little-endian binary, the cumulative
segment lengths, and the places at which positions start again from 0.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from lattica.llm.common import sliced

#: A public byte-level vocabulary; the path is a parameter, and only the driver reads it.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern by which that vocabulary splits texts.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs of white space as long as this aren't given to the pattern, whose look-ahead backs up over them on a stack.
LONG_RUN = 1 << 16
#: Number that ends each document; it is free in the vocabulary. It also fills what is left of a row.
END = 50256
LENGTH = 2048
#: Tokens that are packed together: bounds the memory of a task.
RUN_TOKENS = 1 << 20

SCHEMA = "ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, piece_starts array<long>"


class ByteCodec(tiktoken.Encoding):
    """The pattern and the vocabulary; ``whole`` merges a text without the pattern, as one piece."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.ranks = ranks

    @cached_property
    def whole(self) -> tiktoken.Encoding:
        return tiktoken.Encoding("whole", pat_str="(?s:.+)", mergeable_ranks=self.ranks, special_tokens={})


def encoding(path: str = VOCABULARY) -> ByteCodec:
    with open(path, "rb") as f:
        return encoding_of(f.read())


def encoding_of(vocabulary: bytes) -> ByteCodec:
    return ByteCodec({base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())})


def token_ids(codec: ByteCodec, text: str, long_run: int = LONG_RUN) -> list[int]:
    """The tokens of the text, as the pattern and the vocabulary give them, for runs of white space of any length. The
    pattern takes a run less its last character as one piece, and that character with what follows; a run that ends the
    text is one piece. So a long run is cut out there, merged without the pattern, and the ids stay the same. A text is
    looked through once, and only if it can hold such a run."""
    ids: list[int] = []
    start = 0
    for run in regex.finditer(r"\p{White_Space}+", text) if len(text) >= long_run else ():
        if run.end() - run.start() < long_run:
            continue
        end = run.end() if run.end() == len(text) else run.end() - 1
        if end > run.start():
            ids += codec.encode_ordinary(text[start : run.start()])
            ids += codec.whole.encode_ordinary(text[run.start() : end])
            start = end
    return ids + codec.encode_ordinary(text[start:])


class Capacities:
    """Segment tree over capacities 1..size: how many open rows have each; the least that is at least n in log(size)."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def push(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        self._add(capacity, 1)

    def _add(self, capacity: int, by: int) -> None:
        at = self.leaves + capacity
        while at:
            self.counts[at] += by
            at >>= 1

    def pop(self, n: int) -> tuple[int, int] | None:
        """(row, capacity) with the least capacity of n or more, taken out; None if there is none."""
        at, counts = self.leaves + n, self.counts
        if not counts[at]:
            while at & 1 or not counts[at + 1]:  # up to the first ancestor with rows to its right
                at >>= 1
                if at <= 1:
                    return None
            at += 1
            while at < self.leaves:
                at = 2 * at + (not counts[2 * at])
        capacity = at - self.leaves
        self._add(capacity, -1)
        return self.rows[capacity].pop(), capacity


def packed_rows(lengths: list[int], length: int) -> list[list[int]]:
    """Best-fit decreasing: the numbers of the pieces in each row. Every length is 1..``length``; ties by number."""
    tree, rows = Capacities(length), []
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[piece]
        found = tree.pop(n)
        if found is None:
            rows.append([piece])
            left = length - n
            at = len(rows) - 1
        else:
            at, capacity = found
            rows[at].append(piece)
            left = capacity - n
        if left:
            tree.push(left, at)
    return rows


def packed(documents: DataFrame, length: int = LENGTH, end: int = END, vocabulary: str = VOCABULARY) -> DataFrame:
    """``vocabulary``: a file that the driver reads. One row per packed sequence of ``length`` ids: ids (uint16 where the numbers fit, else uint32), n_tokens (before the
    filling), cu_seqlens (from 0 to n_tokens), position_resets (start of each segment), doc_ids and piece_starts (the
    document of each segment, and where in its tokens the segment starts).

    Every document ends with ``end``, so null and empty texts are one segment of that alone and no document is lost.
    Very long texts become several segments, runs of one character of any length included. Repeated rows are packed each; a null doc_id stays null; an empty table gives
    an empty result; other columns are ignored. Nothing is shuffled; the rows that share a packed row depend on how the
    input is split into partitions."""

    with open(vocabulary, "rb") as f:
        shared = documents.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoding_of(shared.value)
        kind = np.uint16 if max(codec.max_token_value, end) < 1 << 16 else np.uint32
        pieces: list[tuple[int | None, int, np.ndarray]] = []
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            rows = packed_rows([len(x) for _, _, x in pieces], length)
            for start in range(0, len(rows), 256):
                part = rows[start : start + 256]
                matrix = np.full((len(part), length), end, dtype=kind)
                sizes, docs, starts = [], [], []
                for k, row in enumerate(part):
                    cut = np.cumsum([0] + [len(pieces[i][2]) for i in row])
                    matrix[k, : cut[-1]] = np.concatenate([pieces[i][2] for i in row])
                    sizes.append(cut.tolist())
                    docs.append([pieces[i][0] for i in row])
                    starts.append([pieces[i][1] for i in row])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r.tobytes() for r in matrix], pa.binary()),
                        pa.array([s[-1] for s in sizes], pa.int32()),
                        pa.array(sizes, pa.list_(pa.int32())),
                        pa.array([s[:-1] for s in sizes], pa.list_(pa.int32())),
                        pa.array(docs, pa.list_(pa.int64())),
                        pa.array(starts, pa.list_(pa.int64())),
                    ],
                    ["ids", "n_tokens", "cu_seqlens", "position_resets", "doc_ids", "piece_starts"],
                )

        for batch in sliced(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.array([*token_ids(codec, text or ""), end], dtype=kind)
                for start in range(0, len(ids), length):
                    pieces.append((doc, start, ids[start : start + length]))
                    held += len(pieces[-1][2])
                if held >= RUN_TOKENS:
                    yield from out()
                    pieces, held = [], 0
        if pieces:
            yield from out()

    return documents.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)


def unpacked(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, start, ids) of every segment of packed rows: the way back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, starts, ids = [], [], []
            for raw, cut, doc, start in zip(*(batch.column(c).to_pylist() for c in ("ids", "cu_seqlens", "doc_ids", "piece_starts")), strict=True):
                row = np.frombuffer(raw, dtype=np.uint16 if len(raw) == 2 * length else np.uint32)
                docs += doc
                starts += start
                ids += [row[a:b].tolist() for a, b in zip(cut, cut[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "start", "ids"])

    return rows.mapInArrow(run, "doc_id long, start long, ids array<int>")
