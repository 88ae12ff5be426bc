"""Exact dedup, SimHash groups, sharding and packing against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from cases import CLASHING, DOCS, ROWS, SF, docs, least_labels, normalised
from compare import connect, difference
from parcelflow.llm import common, exact_dedup, packing, queries, sharding, simhash
from parcelflow.llm.oracles import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def test_exact_dedup_of_odd_rows(spark):
    found = exact_dedup.dedup(docs(spark)).collect()
    groups = defaultdict(list)
    for doc_id, text, *_ in ROWS:
        groups[normalised(text)].append((-len(text or ""), doc_id is None, doc_id or 0))
    wanted = Counter()
    for plain, members in groups.items():
        for at, (_, none, doc_id) in enumerate(sorted(members)):
            best = min(members)
            wanted[None if none else doc_id, None if best[1] else best[2], len(members), at == 0, hashlib.sha256(plain.encode()).hexdigest()] += 1
    assert Counter(map(tuple, found)) == wanted


@pytest.mark.parametrize(("at_once", "most_runs"), [(1, 1 << 14), (2, 1 << 14), (3, 1 << 14), (5, 1 << 14), (2, 4), (3, 1)])
def test_runs_merge_alike_in_any_rounds(spark, at_once, most_runs):
    """13 runs, of which one text is in all; rounds of two, several at once, neighbouring runs folded."""
    rows = [(i, f"text {i % 97}" if i % 3 else "copied  everywhere", "en", None, 0) for i in range(1300)]
    found = exact_dedup.digests(docs(spark, rows).repartitionByRange(13, "doc_id"))
    merged = [(r.best.key_id, r.n) for r in exact_dedup.merge_runs(found, at_once, most_runs).collect()]
    wanted = defaultdict(list)
    for doc_id, text, *_ in rows:
        wanted[text].append(doc_id)
    assert Counter(merged) == Counter((min(ids), len(ids)) for ids in wanted.values())


def test_rounds_exchange_between_partners_only(spark):
    """No hash exchange after the runs are made: each round is one exchange by task, sorted and combined."""
    rows = [(i, f"text {i % 97}", "en", None, 0) for i in range(1300)]
    found = exact_dedup.merge_runs(exact_dedup.digests(docs(spark, rows).repartitionByRange(13, "doc_id")), 2)
    plan = found._jdf.queryExecution().executedPlan().toString().split("SortAggregate")
    exchanges = [part for step in plan for part in step.splitlines() if "Exchange" in part]
    assert [("hashpartitioning(run" in e, "task" in e and "16" in e) for e in exchanges[:3]] == [(False, True), (False, True), (True, False)]


def test_kept_rows_keep_their_columns(spark):
    frame = docs(spark)
    kept = exact_dedup.keep_first(frame)
    assert kept.columns == frame.columns
    texts = [normalised(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({normalised(t) for _, t, *_ in ROWS})
    assert {r.doc_id for r in kept.collect() if r.text and "the same" in r.text} == {5}


def plain_simhash(text) -> int:
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_is_the_plain_one(spark):
    texts = [t for _, t, *_ in ROWS if t != ROWS[-2][1]] + ["a b c", "a b c d", "a b c d e", "ÀB çd"]
    assert [simhash.simhash(t) % 2**64 for t in texts] == [plain_simhash(t) for t in texts]


def test_simhash_hashes_as_spark_does(spark):
    text = "one two three fouř"
    assert simhash.simhash(text) == spark.sql(f"SELECT xxhash64('{text}')").first()[0]


def test_simhash_groups(spark):
    found = queries.op5_simhash_groups(spark, SF).collect()
    prints = [int(r.fingerprint, 16) for r in found]
    near = [(i, j) for i in range(len(found)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    label = least_labels(len(found), near)
    least = defaultdict(lambda: 1 << 62)
    for r, at in zip(found, label, strict=True):
        least[at] = min(least[at], r.doc_id)
    assert [r.component_id for r in found] == [least[at] for at in label]
    texts = {r.doc_id: r.text for r in common.read(spark, SF, "documents").collect()}
    assert prints == [plain_simhash(texts[r.doc_id]) for r in found]


def test_links_find_every_distance(spark):
    """Chains, rings around a centre and lone values; brute force over all pairs."""
    rng = np.random.default_rng(5)
    values = [int(v) for v in rng.integers(0, 2**63, 30)]
    for bits in (1, 2, 3, 4, 5, 6):
        values += [values[bits] ^ sum(1 << int(b) for b in rng.choice(64, bits, replace=False)) for _ in range(12)]
    chain = values[0]
    for _ in range(10):
        chain ^= sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        values.append(chain)
    values = sorted(set(values))
    frame = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fp long")
    linked = simhash.links(frame, values_per_bucket=3000)
    found = {r.node: r.root for r in common.components(linked, "test-links").collect()}
    near = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4]
    label = least_labels(len(values), near)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    groups, wanted = defaultdict(set), defaultdict(set)
    for v, at in zip(signed, label, strict=True):
        groups[found.get(v, v)].add(v)
        wanted[at].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))
    with pytest.raises(ValueError):
        simhash.links(frame, 3)


def test_simhash_of_odd_rows(spark):
    grouped = {(r.doc_id, r.key_text): r.component_id for r in simhash.near_groups(docs(spark)).collect()}
    assert len(grouped) == len({(r[0], r[1]) for r in ROWS})
    zero = {r.component_id for r in simhash.near_groups(docs(spark)).collect() if r.fp == 0}
    assert zero == {1}  # NULL, empty and blank texts; the NULL id is not the least
    kept = simhash.keep_one(docs(spark))
    assert kept.columns == DOCS_COLUMNS and kept.count() == len(set(grouped.values()))


def test_simhash_keeps_unrelated_texts_of_one_id(spark):
    """Groups without ids, or with one repeated id, are still different groups."""
    texts = [hashlib.sha256(str(i).encode()).hexdigest()[:40].translate(str.maketrans("0123456789", "ghijk lmno")) + f" of row {i} alone" for i in range(8)]
    rows = [(None, t, "en", None, 0) for t in texts[:4]] + [(7, t, "en", None, 0) for t in texts[4:]] + [(None, texts[0], "en", None, 0), (9, texts[1], "en", None, 0)]
    prints = [plain_simhash(t) for t in texts]
    assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(docs(spark, rows)).collect()]
    assert Counter(kept) == Counter([(None, texts[0]), (9, texts[1]), (None, texts[2]), (None, texts[3]), *((7, t) for t in texts[4:])])


DOCS_COLUMNS = [c.split()[0] for c in DOCS.split(", ")] + CLASHING


def test_shards(spark):
    rows = queries.op4_feistel_sharding(spark, SF).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in common.read(spark, SF, "documents").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = defaultdict(list)
    for r in rows:
        assert (r["size"], r.text_crc32) == (len(texts[r.doc_id]) + 16, zlib.crc32(texts[r.doc_id]))
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert set(slots) == set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_shards_of_odd_rows(spark):
    rows = sharding.shard(docs(spark), 3).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in ROWS)
    assert sorted(r.row_number for r in rows) == list(range(len(ROWS)))
    assert sorted((r.shard, r.slot) for r in rows) == sorted((i % 3, i // 3) for i in range(len(ROWS)))


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 40, 1000, 1523, 1524])
def test_permutation_and_its_inverse(spark, rows):
    from pyspark.sql import functions as F

    there = spark.range(rows).select("id", sharding.permuted(F.col("id"), rows).alias("p"))
    back = there.select("id", "p", sharding.permuted(F.col("p"), rows, inverse=True).alias("again")).collect()
    assert sorted(r.p for r in back) == list(range(rows)) and all(r.again == r.id for r in back)


def test_packing_round_trip(spark):
    frame = docs(spark)
    pieces = packing.pack(frame).collect()
    encode = packing.encoder()
    wanted = Counter()
    for doc_id, text, *_ in ROWS:
        ids = encode.tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for start in range(0, len(ids), 1024):
            part = ids[start : start + 1024]
            wanted[doc_id, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)] += 1
    assert Counter(tuple(p)[:5] for p in pieces) == wanted
    filled = defaultdict(list)
    for p in pieces:
        filled[p.sequence_id].append((p.offset, p.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_padding_does_not_follow_the_layout(spark):
    """Rests of two thirds of a window in some partitions, of a third in others."""
    rows = [(i, " a" * (600 if i < 40 else 400), "en", None, 0) for i in range(80)]
    frame = docs(spark, rows).repartitionByRange(8, "doc_id")
    pieces = packing.pack(frame).collect()
    assert sorted(p.doc_id for p in pieces) == list(range(80)) and {p.doc_tokens for p in pieces} == {601, 401}
    assert len({p.sequence_id for p in pieces}) == 40
    assert sorted(map(tuple, pieces)) == sorted(map(tuple, packing.pack(frame).collect()))


def test_ranks_give_the_tokenizers_ids(spark):
    encode = packing.encoder()
    texts = [r.text for r in common.read(spark, SF, "documents").collect()] + ["", " ", "a  b\n c\t", "it's <|endoftext|> 12,3 é\xa0\x85", "日本 x"]
    for text in texts:
        assert encode(text) == np.array(encode.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_ranks_give_the_tokenizers_ids_of_random_texts():
    encode, rng = packing.encoder(), np.random.default_rng(11)
    latin = np.array([chr(c) for c in range(256)])
    usual = np.array(list("abcdeABC 019  '\n\t.,!sd") + ["'s", "'ll", "\xa0", "\x85", "é"])
    for nth in range(6000):
        text = "".join(rng.choice(usual if nth % 2 else latin, rng.integers(0, 80)))
        assert encode.by_ranks.encode_ordinary(text) == encode.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("text", ["x" * 300_000, "ab " * 200_000, "é1" * 200_000, " " * 199_999 + "a", "a" + "\n " * 2_000_000, "a b" * 10 + " " * 3_000_000 + "c"], ids=lambda t: f"{t[:2]!r}-{len(t)}")
def test_long_texts_and_long_white_space(text):
    encode = packing.encoder()
    assert encode(text) == np.array(encode.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_blocks_of_white_space():
    assert [packing.holds_space_block(t, 3) for t in ("", "  ", "   ", "a   b", "a     b", "ab   c", "abc   ")] == [False, False, True, False, True, False, True]


def test_best_fit_decreasing_is_the_plain_one():
    rng = np.random.default_rng(3)
    for window in (8, 64, 100):
        lengths = rng.integers(1, window, 300)
        where, offset, windows = packing.best_fit_decreasing(lengths, window)
        open_, used = [], 0
        for length in sorted(lengths.tolist(), reverse=True):
            fits = [c for c in open_ if c >= length]
            if fits:
                open_.remove(min(fits))
                open_.append(min(fits) - length)
            else:
                used += 1
                open_.append(window - length)
        assert windows == used
        held = Counter()
        for w, size in zip(where.tolist(), lengths.tolist(), strict=True):
            held[w] += size
        assert sorted(window - h for h in held.values()) == sorted(open_)
        for w in set(where.tolist()):
            at = 0
            for o, size in sorted(zip(offset[where == w].tolist(), lengths[where == w].tolist(), strict=True)):
                assert o == at
                at += size


def test_empty_tables(spark):
    none = docs(spark, [])
    assert exact_dedup.dedup(none).count() == exact_dedup.keep_first(none).count() == 0
    assert simhash.near_groups(none).count() == sharding.shard(none).count() == packing.pack(none).count() == 0
