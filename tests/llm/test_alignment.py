"""Cross-tokenizer alignment against a plain version that walks over the bytes of every document."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import public_tokenizers as public
import pyarrow as pa
import sentencepiece
from cases import ROWS, SF, docs
from parcelflow.llm import alignment, common, queries
from pyspark.sql import functions as F
from tokenizers import Tokenizer

FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    """Whole texts through both tokenizers, one byte at a time."""

    def __init__(self):
        self.a = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
        chars, fresh = {}, 256
        for byte in range(256):
            if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
                chars[chr(byte)] = byte
            else:
                chars[chr(fresh)], fresh = byte, fresh + 1
        with open(public.path("byte_bpe_50k.json"), encoding="utf-8") as file:
            self.of_a = {i: bytes(chars.get(c, 0) for c in t) for t, i in json.load(file)["model"]["vocab"].items()}

    def of_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if piece.startswith("<0x") and len(piece) == 6 else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        whole = (" " + text).encode()
        a = [(i, self.of_a[i]) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, self.of_b(i)) for i in self.b.encode(text)]
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            return []
        ends = [{}, {}]
        for side, tokens in enumerate((a, b)):
            at = 0
            for i, x in tokens:
                ends[side][at + len(x)] = (i, at)
                at += len(x)
        found, now = [], ([], [])
        for at in range(1, len(whole) + 1):
            for side in (0, 1):
                if at in ends[side]:
                    now[side].append((ends[side][at][0], ends[side][at][1], at))
            if at in ends[0] and at in ends[1]:
                found.append(now)
                now = ([], [])
        return found

    def rows(self, texts):
        groups = [self.groups(text) for text in texts]
        links = [[(x[0], y[0]) for a, b in found for x in a for y in b if x[1] < y[2] and y[1] < x[2]] for found in groups]
        count = Counter(pair for found in links for pair in set(found))
        best = defaultdict(int)
        for (a, _), n in count.items():
            best[a] = max(best[a], n)
        for found, pairs in zip(groups, links, strict=True):
            text = ";".join(",".join(str(x[0]) for x in a) + "|" + ",".join(str(x[0]) for x in b) for a, b in found)
            yield (
                sum(len(a) for a, _ in found), sum(len(b) for _, b in found), len(found), len(pairs),
                sum(count[p] == best[p[0]] for p in pairs), sum(count[p] for p in pairs),
                hashlib.sha256(text.encode()).hexdigest() if found else "",
            )


def compare(found, rows):
    wanted = Counter((doc_id, *row) for doc_id, row in zip([r[0] for r in rows], Plain().rows([r[1] for r in rows]), strict=True))
    assert Counter((r.doc_id, *(r[f] for f in FIELDS)) for r in found) == wanted


def test_against_brute_force(spark):
    rows = common.read(spark, SF, "documents").select("doc_id", "text").collect()
    found = queries.op12_identity_alignment(spark, SF).collect()
    assert sum(r.n_links for r in found) > 10_000
    compare(found, rows)


def test_small_batches_give_the_same_rows(spark, monkeypatch):
    frame = common.read(spark, SF, "documents").repartition(7)
    wanted = sorted(alignment.align(frame).collect(), key=str)
    monkeypatch.setattr(alignment, "BATCH_DOCS", 3)
    monkeypatch.setattr(alignment, "BATCH_CHARS", 500)
    cut = alignment.align(frame)
    assert sorted(cut.collect(), key=str) == wanted


def test_odd_rows(spark):
    odd = ["<|endoftext|> and </s><s> <unk> <0x41>", "▁ is no space", " two  leading and trailing  ", "\x00\x01 nul", "   ", " ", "é" * 5000, "a" * 100_000, "́‍👨‍👩‍👧 ﬁ Ⅷ", "x\r\n\ty"]
    rows = ROWS + [(100 + i, text, "en", "a", 0) for i, text in enumerate(odd)] + [(100, odd[0], "en", "a", 0)]
    compare(alignment.align(docs(spark, rows)).collect(), rows)
    assert alignment.align(docs(spark, [])).count() == 0


def test_frequent_text_is_asked_for_once_a_batch(spark):
    """A third of the rows under one text: its pairs are asked for by batches, not by documents."""
    rows = [(i, "Unaufhörlich rauschte der Wasserfall" if i % 3 == 0 else "Zugspitzbahn vor Sonnenaufgang", "de", "a", 0) for i in range(900)]
    compare(alignment.align(docs(spark, rows)).collect(), rows)
    own = alignment.aligner()
    row = own.batch(0, [r[0] for r in rows], [r[1] for r in rows], own.same * 0)
    assert len(row["asked"]) == len(set(row["asked"].tolist())) < 60 and max(row["asked_docs"]) >= 300


def test_no_row_that_spark_holds_grows_with_a_batch(spark, monkeypatch):
    """Rows of a batch's documents in one fill buffers that count rows: each holds one document, or what a batch asks for."""
    rows = [(i, f"Unaufhörlich rauschte Wasserfall {i % 7}", "de", "a", 0) for i in range(900)]
    tables, name = {}, "spark.sql.execution.arrow.maxBytesPerBatch"

    def stored(df, table, write=alignment.stored):
        tables[table] = spark.conf.get(name, None), write(df, table)
        return tables[table][1]

    monkeypatch.setattr(alignment, "stored", stored)
    compare(alignment.align(docs(spark, rows).coalesce(1)).collect(), rows)
    set_to, batches = tables["align-batches"]
    values = sum(F.greatest(F.size(c), F.lit(0)) for c, kind in batches.dtypes if kind.startswith("array"))
    assert batches.select(values.alias("n")).agg(F.max("n")).first()[0] < 400
    assert set_to == str(alignment.ARROW_BYTES) and spark.conf.get(name, None) is None


def test_texts_come_in_small_arrow_batches(spark):
    texts, name = docs(spark, [(i, "x" * 1_000_000, "en", "a", 0) for i in range(40)]).coalesce(1), "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    with alignment._arrow_bytes(spark):
        found = [r.n for r in texts.select("text").mapInArrow(sizes, "n long").collect()]
    assert sum(found) >= 40_000_000 and max(found) <= alignment.ARROW_BYTES + 2_000_000
    spark.conf.set(name, "1m")
    try:
        with alignment._arrow_bytes(spark):
            assert spark.conf.get(name) == "1m"
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.unset(name)


def test_only_documents_without_tokens(spark):
    rows = [(1, None, "en", "a", 0), (None, "", "en", "a", 0), (1, None, "en", "a", 0)]
    compare(alignment.align(docs(spark, rows)).collect(), rows)


def test_words_kept_do_not_grow_with_a_batch(monkeypatch):
    monkeypatch.setattr(alignment, "WORDS_KEPT", 300)
    monkeypatch.setattr(alignment, "SPLIT_CHARS", 1000, raising=False)
    own = alignment.PieceEncoder(public.path(alignment.MODEL_B))
    texts = [" ".join(f"w{i}x{j}" for j in range(20)) for i in range(500)]
    assert [x.tolist() for x in own(texts)] == own.model.encode(texts)
    assert len(own.words) < 1000


def test_words_encode_as_the_whole_text():
    own, draw = alignment.aligner().encode_b, random.Random(5)
    assert own.by_word
    signs = "ab éß▁ \n\t.,'-0123中😀́ 　<>x Z"
    texts = ["".join(draw.choices(signs, k=draw.randrange(1, 60))) for _ in range(5000)]
    assert [x.tolist() for x in own(texts)] == own.model.encode(texts)


def test_identity_map_has_equal_bytes():
    own = alignment.aligner()
    there = [(i, j) for i, j in enumerate(own.same.tolist()) if j >= 0]
    assert len(there) > 20_000 and all(own.bytes_a[i] == own.bytes_b[j] for i, j in there)
    assert not any(own.encode_b.is_byte[j] for i, j in there if own.bytes_a[i].isalpha())
