"""Best-fit-decreasing packing of token sequences.

Documents are tokenised where they are read; a document longer than a window is first cut into full windows
and a rest. Places and lengths of the pieces are written once; the rests, without tokens, are dealt by a hash of
their number to as many tasks as their total length asks for, so every task holds a mixed set of lengths however
the input is laid out. Each packs its rests in order of decreasing length: a segment tree indexed by remaining
capacity finds the tightest open window that still takes the piece, else a new window is opened. A retried task
gives the same sequences.

Defined results: a NULL or empty text is the end id alone; pieces of one document may lie in several
sequences; repeated rows are packed as often as they occur; a NULL `doc_id` stays NULL. An empty table gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import os
from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.scratch import stored

WINDOW, END_ID = 1024, 0
#: Windows and rests that one packing task is meant to hold.
TASK_WINDOWS, TASK_RESTS = 1024, 200_000
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: The matcher behind the ranks gives up on some million characters of white space in a row: blocks of so many go to the tokenizer.
SPACE_BLOCK = 100_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    `vocabulary` names the tokenizer file; `ranks` the same vocabulary as merge ranks, which give the same ids
    some three times faster, for texts of any length. Texts beyond Latin-1, where the two could know different versions of
    Unicode, and texts with `SPACE_BLOCK` to twice as many characters of white space in a row go to the tokenizer.
    """

    def __init__(self, vocabulary: str, ranks: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.by_ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if is_latin(text) and not holds_space_block(text):
            ids = self.by_ranks.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def holds_space_block(text: str, size: int = 0) -> bool:
    """Whether one of the blocks of `size` that `text` falls into is white space; then no other run is longer than two blocks."""
    size = size or SPACE_BLOCK
    return any(text[at : at + size].isspace() for at in range(0, len(text) - size + 1, size))


@functools.cache
def encoder(vocabulary: str | None = None, ranks: str | None = None) -> Encoder:
    """One encoder per Python worker; the files are the public ones unless named."""
    import public_tokenizers

    return Encoder(vocabulary or public_tokenizers.path(VOCABULARY), ranks or public_tokenizers.path(RANKS))


class CapacityTree:
    """Open windows by remaining capacity; the tree counts them, so the tightest fit is one climb and descent."""

    def __init__(self, window: int):
        self.base = 1 << window.bit_length()
        self.count = [0] * (2 * self.base)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, change: int) -> None:
        node = capacity + self.base
        while node:
            self.count[node] += change
            node >>= 1

    def put(self, capacity: int, window: int) -> None:
        if capacity:
            self.open[capacity].append(window)
            self._add(capacity, 1)

    def tightest(self, length: int) -> int:
        """The least capacity of at least `length` with an open window, or 0."""
        count, node = self.count, length + self.base
        if count[node]:
            return length
        while node > 1:
            if node % 2 == 0 and count[node + 1]:
                node += 1
                while node < self.base:
                    node = 2 * node if count[2 * node] else 2 * node + 1
                return node - self.base
            node >>= 1
        return 0

    def take(self, capacity: int) -> int:
        self._add(capacity, -1)
        return self.open[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset of each piece, and the number of windows; longest pieces first, ties in input order."""
    tree, windows = CapacityTree(window), 0
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        capacity = tree.tightest(length)
        if capacity:
            chosen = tree.take(capacity)
        else:
            chosen, capacity, windows = windows, window, windows + 1
        where[i], offset[i] = chosen, window - capacity
        tree.put(capacity - length, chosen)
    return where, offset, windows


def pack(docs: DataFrame, vocabulary: str | None = None, ranks: str | None = None, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents with their place: columns of `SCHEMA`."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Full windows with their number, rests with -1 minus theirs."""
        encode = encoder(vocabulary, ranks)
        first_id = TaskContext.get().partitionId() << 40
        windows, rests, end = 0, 0, end_id.to_bytes(4, "little")
        for batch in batches:
            pieces = [array("q") for _ in range(6)]
            ids, texts = batch.column("doc_id"), batch.column("text")
            for row in range(batch.num_rows):
                tokens = encode(texts[row].as_py() or "") + end
                total = len(tokens) // 4
                for start in range(0, total, window):
                    piece = tokens[4 * start : 4 * (start + window)]
                    length = len(piece) // 4
                    number = first_id + windows if length == window else -1 - first_id - rests
                    windows, rests = windows + (length == window), rests + (length < window)
                    for column, value in zip(pieces, (row, start, length, crc32(piece), total, number), strict=True):
                        column.append(value)
            rows, *columns = (np.frombuffer(c, np.int64) for c in pieces)
            yield _rows(ids.take(pa.array(rows)), columns, np.zeros(len(rows), np.int64))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # full windows have the numbers below
        first_id = (1 << 62) + (TaskContext.get().partitionId() << 40)
        rests = list(batches)
        if rests:
            held = pa.Table.from_batches(rests).sort_by([("sequence_id", "descending")])
            columns = [held[c].combine_chunks() for c in held.column_names]
            where, offset, _ = best_fit_decreasing(columns[2].to_numpy(), window)
            yield pa.RecordBatch.from_arrays([*columns[:5], pa.array(first_id + where), pa.array(offset)], names=NAMES)

    pieces = stored(docs.select(docs.doc_id.cast("long").alias("doc_id"), "text").mapInArrow(cut, SCHEMA), "packing-pieces")
    rests = pieces.where("sequence_id < 0")
    n, tokens = rests.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(1, -(-tokens // (window * TASK_WINDOWS)), -(-n // TASK_RESTS))
    return pieces.where("sequence_id >= 0").unionByName(rests.repartition(tasks, "sequence_id").mapInArrow(fill, SCHEMA))


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _rows(doc_id: pa.Array, columns: list[np.ndarray], offset: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([doc_id, *map(pa.array, columns), pa.array(offset)], names=NAMES)
