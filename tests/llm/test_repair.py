"""Conversation repair against a search over all edits, and the parser against CYK over every split."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from cases import SF
from parcelflow.llm import common, queries, repair

SPACE = "[\x20\x09-\x0d]"
FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
TABLE = "conv_id long, turn long, role string, text string"


def damage(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv]
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        found[conv] += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return found


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][: repair.HEAD], hashlib.md5(r[2].encode()).digest()))


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        last = re.sub(f"{SPACE}+\\Z", "", text)[-1:]
        found.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(rows):
    """Least (cost, audit, lines) by going from left to right over all edits, rows and states."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", [])}

    def insert(now):
        for _ in range(3):
            for state, (cost, audit, lines) in list(now.items()):
                role = "a" if state == "u" else "u"
                full = {"u": "user", "a": "assistant"}[role]
                better = (cost + 2, audit + "I", [*lines, f"{full}:"])
                if role not in now or better[:2] < now[role][:2]:
                    now[role] = better
        return now

    insert(best)
    for (_, role, text), fault in zip(rows, faults(rows), strict=True):
        now = {}

        def offer(state, cost, audit, lines, now=now):
            if state not in now or (cost, audit) < now[state][:2]:
                now[state] = (cost, audit, lines)

        for state, (cost, audit, lines) in best.items():
            offer(state, cost + 3, audit + "D", lines)
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if (state, role[:1]) in step:
                    offer(step[state, role[:1]], cost + more, audit + "K", [*lines, f"{role}:{text}"])
                new = "assistant" if state == "u" else "user"
                offer(new[0], cost + 2 + more, audit + "R", [*lines, f"{new}:{text}"])
        best = insert(now)
    return min(best[s] for s in ("", "a") if s in best)


def plain(rows):
    for conv, damaged in damage(rows).items():
        now = ordered(damaged)
        if not now:
            yield conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
            continue
        turns, found = [r[0] for r in now if r[0] is not None], faults(now)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(now))
        cost, audit, lines = cheapest(now)
        yield conv, gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def order(row):
    return row[0] is None, row


def compare(found, rows):
    assert sorted([(r.conv_id, *(r[f] for f in FIELDS)) for r in found], key=order) == sorted(plain(rows), key=order)


def odd(n, seed):
    draw = random.Random(seed)
    texts = [None, "", " \t", "yes.", "yes", "no!", "what?  ", "a long answer. ", "x" * 70 + "1.", "x" * 70 + "2", "é😀\n."]
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "unit"]
    return [(draw.choice([None, 1, 2, 3, 4, 5, 6]), draw.choice([None, *range(12)]), draw.choice(roles), draw.choice(texts)) for _ in range(n)]


def test_against_brute_force(spark):
    rows = [tuple(r) for r in common.read(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = queries.op13_conversation_repair(spark, SF).collect()
    assert sum(r.cost for r in found) > 50
    compare(found, rows)


@pytest.mark.parametrize("size", [512, 3])
def test_odd_rows(spark, monkeypatch, size):
    """NULLs, ties, repeats, strange roles; with small spans the same rows go through the joins of parts."""
    monkeypatch.setattr(repair, "SPAN", size)
    monkeypatch.setattr(repair, "BLOCK", 200 if size == 3 else repair.BLOCK)
    rows = odd(160, size) + [(100 + i, i, "user", "a.") for i in range(20)]
    frame = spark.createDataFrame(rows, TABLE).selectExpr("*", "1 AS n", "2 AS conv", "3 AS digest", "4 AS audit")
    compare(repair.repair(frame).collect(), rows)
    assert repair.repair(spark.createDataFrame([], TABLE)).count() == 0


def test_one_conversation_holds_most_rows(spark, monkeypatch):
    """It is cut over tasks; its copies are one entry; very long texts are hashed in blocks."""
    monkeypatch.setattr(repair, "SPAN", 50)
    monkeypatch.setattr(repair, "BLOCK", 10_000)
    draw = random.Random(4)
    hot = [(7, i, draw.choice(["user", "assistant"]), f"text {i}" + draw.choice([".", "", "!"]) * draw.randrange(40)) for i in range(2500)]
    rows = hot + [(7, 77, "user", "again.")] * 900 + [(8, 0, "user", "word " * 300_000)] + [(i, j, r, f"{r}.") for i in range(20, 90) for j, r in enumerate(["user", "assistant"])]
    frame = spark.createDataFrame(rows, TABLE).repartition(5)
    counted = repair.entries(repair.damaged(frame))
    assert counted.where("conv = '7' AND turn = 77 AND head = 'again.'").count() <= 1
    compare(repair.repair(frame).collect(), rows)


@pytest.mark.parametrize("size", [512, 3])
def test_bounds_of_tasks_part_no_edit_from_its_text(spark, monkeypatch, size):
    """Every conversation comes once and whole, also where each task holds a few rows only."""
    monkeypatch.setattr(repair, "SPAN", size)
    draw = random.Random(6)
    rows = [(i, j, draw.choice(["user", "assistant"]), f"row {j} of {i}" + draw.choice([".", "", "!"])) for i in range(40) for j in range(draw.randrange(1, 9))]
    rows += odd(60, 5) + [(50, i, draw.choice(["user", "assistant"]), f"text {i}.") for i in range(120)]
    wanted = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "24"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        compare(repair.repair(spark.createDataFrame(rows, TABLE)).collect(), rows)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def full_cyk(entries):
    """Every split of every span."""
    n, cell = len(entries), {}
    for i, entry in enumerate(entries):
        cell[i, i + 1] = repair.entry_cells(*entry)
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            best = {}
            for k in range(i + 1, i + length):
                for key, (cost, audit, _) in repair.joined(cell[i, k], cell[k, i + length]).items():
                    if key not in best or (cost, audit) < best[key][:2]:
                        best[key] = (cost, audit, [])
            cell[i, i + length] = best
    return cell[0, n]


def test_one_split_gives_the_cells_of_all_splits():
    draw = random.Random(9)
    for _ in range(60):
        entries = [(draw.choice("suax"), draw.random() < 0.8, draw.random() < 0.3, draw.choice([0, 0, 1, 3])) for _ in range(draw.randrange(1, 9))]
        entries = [(a, live, opened and live, max(d, int(not live))) for a, live, opened, d in entries]
        facts = {"blank": 0, "duplicate": 0, "truncated": 0, "turn": 1, "n": 1}
        parts = (repair.Span.of_entry({"role": a, "live": b, "open": c, "deletes": d, **facts}) for a, b, c, d in entries)
        found = {key: x[:2] for key, x in repair.parsed(parts).cells.items()}
        assert found == {key: x[:2] for key, x in full_cyk(entries).items()}
