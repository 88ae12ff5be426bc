"""Alignment of two tokenizers over a corpus: which tokens of the one stand where tokens of the other stand.

Tokenizer A is a byte-level BPE, tokenizer B a SentencePiece model; both read the text after one space (B adds
it). Offsets in bytes where tokens of both end cut a document into groups; an A and a B token are linked where
their byte ranges overlap. A pair of ids counts once for every document that holds it linked.

The fast path is the identity map: for every A id the B id of the same bytes, an array as long as A's
vocabulary. A group of one token on either side is such a pair, so it is counted in a vector of that length, one
per task; the vectors are summed by id. Only the other pairs, of irregular groups, are shuffled as pairs: each
batch of documents names its distinct ones with their number of documents, the sums are joined back to the
batches that asked, and a batch meets its answer as one group and works out its documents from that and the summed
vector. So a frequent pair moves once a batch, not once a document, and texts are tokenised once and never shuffled.

Memory: a task holds one batch (`BATCH_DOCS` documents, or `BATCH_CHARS` characters and the document that passes
them) and vectors of A's vocabulary; two such vectors, document counts and greatest counts by A id, are all that
the driver sees. What Spark holds is rows of one document (an identity pair by its A id, another by its place in what
the batch asks for) or of `ROW_PAIRS` asked pairs, so its buffers, which count rows, stay small; texts come to Python
in Arrow batches of `ARROW_BYTES`, and a batch and its answer as one. B splits `SPLIT_CHARS` characters at a time and
remembers their words, which is right because no piece of a model that is handled so crosses a space; other models
encode whole texts.

Defined results: a NULL or empty text, and one whose joined token bytes of A or B differ from space and text, has
no tokens, zeros and an empty `groups_sha256`. Repeated rows are documents of their own. Names of special tokens
inside a text are plain text. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.functions.scratch import stored
from parcelflow.llm import packing

VOCABULARY_A, RANKS_A, MODEL_B = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
BATCH_DOCS, BATCH_CHARS = 2000, 4_000_000
#: Characters of whole texts that tokenizer B splits into words at once; words that a worker remembers, when there are more it starts anew.
SPLIT_CHARS, WORDS_KEPT = 500_000, 200_000
#: Bytes of an Arrow batch of texts, unless the session names its own; a longer text is a batch of its own.
ARROW_BYTES = 8 << 20
#: Asked pairs in one row.
ROW_PAIRS = 10_000
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
#: A row is a document, with its distinct linked pairs and how often it holds each: identity pairs by their A id (`same`), irregular
#: ones by their place among the sorted pairs of the batch (`odd`). Or, without a digest, pairs that its batch asks for and their numbers
#: of documents in it; or, with a negative batch, the vector of a task: A ids and their numbers of documents.
BATCH = "batch long, doc_id long, groups_sha256 string, n_a long, n_b long, n_groups long, n_links long, same array<int>, same_times array<int>, odd array<int>, odd_times array<int>, pair array<long>, docs array<long>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself if it is printable, else the next from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def bytes_of_a(vocabulary: str) -> list[bytes]:
    with open(vocabulary, encoding="utf-8") as file:
        ids = json.load(file)["model"]["vocab"]
    of_char, tokens = byte_of_char(), [b""] * (max(ids.values()) + 1)
    for token, number in ids.items():
        tokens[number] = bytes(of_char[c] for c in token) if all(c in of_char for c in token) else token.encode()
    return tokens


class PieceEncoder:
    """Ids of tokenizer B for whole texts, and the bytes of its ids."""

    def __init__(self, model: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.is_byte = [self.model.is_byte(i) for i in range(size)]
        self.bytes = [bytes([int(p[1:-1], 16)]) if b else p.replace("▁", " ").encode() for p, b in zip(pieces, self.is_byte, strict=True)]
        self.by_word = not any(re.search("[^▁]▁", p) for p, b in zip(pieces, self.is_byte, strict=True) if not b)
        self.space = array("i", [self.model.piece_to_id("▁")]).tobytes()
        self.words: dict[str, bytes] = dict.fromkeys(" ▁", self.space)

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text. A word is a run of spaces (U+2581 is one for the model) and what follows up to the next."""
        for some in slices(texts, SPLIT_CHARS):
            if not self.by_word:
                yield from (np.array(ids, np.int64) for ids in self.model.encode(some, num_threads=1))
                continue
            split = [re.findall("[ ▁]*[^ ▁]+|[ ▁]+", " " + text) for text in some]
            if len(self.words) > WORDS_KEPT:
                self.words = dict.fromkeys(" ▁", self.space)
            fresh = list({word for words in split for word in words} - self.words.keys())
            ids = self.model.encode([word[1:] for word in fresh], num_threads=1)
            self.words.update((word, array("i", x).tobytes()) for word, x in zip(fresh, ids, strict=True))
            for words in split:
                yield np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.int32).astype(np.int64)


def slices(texts: list[str], chars: int) -> Iterator[list[str]]:
    """The texts in order, each list at an end with the text that brings it to so many characters."""
    some, held = [], 0
    for text in texts:
        some.append(text)
        held += len(text)
        if held >= chars:
            yield some
            some, held = [], 0
    if some:
        yield some


class Aligner:
    """Both tokenizers with the bytes and lengths of their ids, and the identity map."""

    def __init__(self, vocabulary: str, ranks: str, model: str):
        self.encode_a, self.encode_b = packing.encoder(vocabulary, ranks), PieceEncoder(model)
        self.bytes_a, self.bytes_b = bytes_of_a(vocabulary), self.encode_b.bytes
        self.size_a, self.size_b = (np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        # a piece comes before a byte of the same content
        ids = sorted(range(len(self.bytes_b)), key=lambda i: (self.encode_b.is_byte[i], i))
        of_bytes = {self.bytes_b[i]: i for i in reversed(ids)}
        self.same = np.array([of_bytes.get(x, -1) for x in self.bytes_a], np.int64)
        self.names = [f"{i}{end}" for i in range(max(len(self.bytes_a), len(self.bytes_b))) for end in (",", "|", ";", "")]

    def align(self, text: str, a: np.ndarray, b: np.ndarray) -> tuple[list[int], str, np.ndarray, np.ndarray] | None:
        """Counts, digest of the groups, and the distinct pairs (A id in the upper half) with their numbers of links."""
        whole = (" " + text).encode("utf-8", "surrogatepass")
        if not self._joins(a, self.bytes_a, whole) or not self._joins(b, self.bytes_b, whole):
            return None
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        start_a, start_b = end_a - self.size_a[a], end_b - self.size_b[b]
        cuts = end_a[end_b[np.searchsorted(end_b, end_a)] == end_a]  # the last ends are equal, so every place exists
        first, after = np.searchsorted(end_b, start_a, side="right"), np.searchsorted(start_b, end_a, side="left")
        width = after - first
        of_b = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(first, width)
        keys, times = np.unique((np.repeat(a, width) << 32) | b[of_b], return_counts=True)
        return [len(a), len(b), len(cuts), int(width.sum())], self._digest(a, b, end_a, end_b, cuts), keys, times

    @staticmethod
    def _joins(ids: np.ndarray, table: list[bytes], whole: bytes) -> bool:
        return b"".join([table[i] for i in ids.tolist()]) == whole

    def _digest(self, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray, cuts: np.ndarray) -> str:
        """SHA-256 of the groups as text: of each group A's ids, then B's."""
        sides = []
        for ids, ends, last in ((a, end_a, 1), (b, end_b, 2)):
            group = np.searchsorted(cuts, ends)
            closing = np.where(cuts[group] == ends, last, 0)
            sides.append((4 * ids + closing, 2 * group + (last == 2)))
        names, places = (np.concatenate(x) for x in zip(*sides, strict=True))
        ordered = names[np.argsort(places, kind="stable")]
        ordered[-1] += 1  # nothing after the last id
        return hashlib.sha256("".join([self.names[i] for i in ordered.tolist()]).encode()).hexdigest()

    def batch(self, number: int, doc_ids: list, texts: list[str], vector: np.ndarray) -> dict:
        """Columns of `BATCH` for these documents, lists as their values and numbers of values; `vector` gains a document for every identity pair."""
        ids_b = self.encode_b([text for text in texts if text])
        found = {"batch": number, "doc_id": doc_ids, "groups_sha256": [], **{c: [] for c in COUNTS}}
        held, keys, times = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for text in texts:
            aligned = self.align(text, np.frombuffer(self.encode_a(" " + text), "<u4").astype(np.int64), next(ids_b)) if text else None
            counts, digest, key, count = aligned or ([0, 0, 0, 0], "", keys[0], times[0])
            for c, n in zip(COUNTS, counts, strict=True):
                found[c].append(n)
            found["groups_sha256"].append(digest)
            held.append(len(key))
            keys.append(key)
            times.append(count)
        key, times, ends = np.concatenate(keys), np.concatenate(times), np.cumsum(held)
        identity = self.same[key >> 32] == (key & 0xFFFFFFFF)
        same_held = np.diff(np.concatenate(([0], np.cumsum(identity)))[ends], prepend=0)
        same = key[identity] >> 32
        vector += np.bincount(same, minlength=len(vector))
        asked, odd, docs = np.unique(key[~identity], return_inverse=True, return_counts=True)
        found |= {"same": (same, same_held), "same_times": (times[identity], same_held)}
        found |= {"odd": (odd, held - same_held), "odd_times": (times[~identity], held - same_held)}
        return found | {"asked": asked, "asked_docs": docs}


@functools.cache
def aligner(vocabulary: str | None = None, ranks: str | None = None, model: str | None = None) -> Aligner:
    """One aligner per Python worker; the files are the public ones unless named."""
    import public_tokenizers as public

    return Aligner(vocabulary or public.path(VOCABULARY_A), ranks or public.path(RANKS_A), model or public.path(MODEL_B))


def _arrow(spark, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def _rows(schema: pa.Schema, size: int, **columns) -> pa.RecordBatch:
    """So many rows; a column that is not given is NULL, one number is repeated, and values with numbers of values are lists."""
    made = []
    for field in schema:
        column = columns.get(field.name)
        if isinstance(column, tuple):
            values, held = column
            made.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(held))), pa.int32()), pa.array(values, field.type.value_type), type=field.type))
        else:
            made.append(pa.array(column if isinstance(column, list) else [column] * size, field.type))
    return pa.RecordBatch.from_arrays(made, schema=schema)


def _pair_rows(schema: pa.Schema, number: int, pairs: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    held = [min(ROW_PAIRS, len(pairs) - at) for at in range(0, len(pairs), ROW_PAIRS)]
    return _rows(schema, len(held), batch=number, pair=(pairs, held), docs=(docs, held))


@contextmanager
def _arrow_bytes(spark: SparkSession) -> Iterator[None]:
    """What runs inside hands Python Arrow batches of `ARROW_BYTES`, unless the session names its own size."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(name, None)
    if own is None:
        spark.conf.set(name, str(ARROW_BYTES))
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(name)


def align(docs: DataFrame, vocabulary: str | None = None, ranks: str | None = None, model: str | None = None) -> DataFrame:
    """Columns of `RESULT` for every document."""
    spark = docs.sparkSession
    batch_schema, result_schema = _arrow(spark, BATCH), _arrow(spark, RESULT)

    def rows(found: dict) -> Iterator[pa.RecordBatch]:
        yield _rows(batch_schema, len(found["doc_id"]), **found)
        if len(found["asked"]):
            yield _pair_rows(batch_schema, found["batch"], found["asked"], found["asked_docs"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(vocabulary, ranks, model)
        task = TaskContext.get().partitionId()
        vector = np.zeros(len(own.bytes_a), np.int64)
        number, ids, texts, chars = task << 32, [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids.append(doc_id.as_py())
                texts.append(text.as_py() or "")
                chars += len(texts[-1])
                if len(ids) >= BATCH_DOCS or chars >= BATCH_CHARS:
                    yield from rows(own.batch(number, ids, texts, vector))
                    number, ids, texts, chars = number + 1, [], [], 0
        if ids:
            yield from rows(own.batch(number, ids, texts, vector))
        found = np.flatnonzero(vector)
        if len(found):
            yield _pair_rows(batch_schema, -1 - task, found, vector[found])

    with _arrow_bytes(spark):
        batches = stored(docs.select(docs.doc_id.cast("long").alias("doc_id"), "text").mapInArrow(cut, BATCH), "align-batches")
    listed = batches.select("batch", F.explode(F.arrays_zip("pair", "docs")).alias("x")).select("batch", "x.pair", "x.docs")
    identity = {r.id: r.n for r in listed.where("batch < 0").groupBy(F.col("pair").alias("id")).agg(F.sum("docs").alias("n")).collect()}
    asked = listed.where("batch >= 0")
    pairs = stored(asked.groupBy("pair").agg(F.sum("docs").alias("n")), "align-pairs")
    best = {r.id: r.n for r in pairs.groupBy(F.shiftright("pair", 32).alias("id")).agg(F.max("n").alias("n")).collect()}
    shared, highest = np.zeros((2, 1 + max([0, *identity, *best])), np.int64)
    shared[list(identity)] = list(identity.values())
    highest[list(best)] = list(best.values())
    highest = np.maximum(highest, shared)

    def finish(found: pa.Table, answer: pa.Table) -> pa.Table:
        pair, n = (answer.column(c).to_numpy() for c in ("pair", "n"))
        order = np.argsort(pair)
        pair, n = pair[order] >> 32, n[order]
        sums = {"n_best": 0, "count_sum": 0}
        for kind, count, most in (("same", shared, highest), ("odd", n, highest[pair])):
            of, times = (pc.list_flatten(found.column(c)).to_numpy() for c in (kind, f"{kind}_times"))
            held = pc.list_value_length(found.column(kind)).to_numpy()
            ends = np.cumsum(held)
            for c, x in (("n_best", times * (count == most)[of]), ("count_sum", times * count[of])):
                total = np.concatenate(([0], np.cumsum(x)))
                sums[c] = sums[c] + total[ends] - total[ends - held]
        return pa.table([pa.array(sums[c]) if c in sums else found.column(c) for c in result_schema.names], schema=result_schema)

    lists = ["batch", "doc_id", "groups_sha256", *COUNTS, "same", "same_times", "odd", "odd_times"]
    answers = asked.join(pairs, "pair").select(F.col("batch").alias("asked_by"), "pair", "n")
    found = batches.where(batches.groups_sha256.isNotNull()).select(*lists)
    return found.groupBy("batch").cogroup(answers.groupBy("asked_by")).applyInArrow(finish, RESULT)
