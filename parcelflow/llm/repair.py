"""Repair of the structure of conversations by weighted CYK parsing over spans.

A sound conversation has the role initials (s?(ua)+)?. Every row is kept (free), given the role user or assistant
(2) or deleted (3, required for blank rows and repeats); empty rows are inserted anywhere (2); an undeleted
truncated row costs 1 more. The grammar in Chomsky normal form has one nonterminal N[p,q] for every pair of
states: a span of rows derives N[p,q] if some edits of it lead from p to q. Its rules are N[p,q] -> N[p,r] N[r,q],
N[p,q] -> an edited row, and the insertion closure N[p,q] -> inserted rows, which surrounds every row. A cell holds the
least (cost, audit), the audit being the initials of the edits. For one span and one nonterminal, audits of
equal cost are never prefixes of each other (they differ in inserted rows only if their costs do), so the least
audit of a span is made of least audits of its parts. As nonterminals name the states at both ends, joining
spans is associative: every split of a span gives the same cell, and one split is enough. So spans of 2, 4, 8 rows
and more are built bottom-up from neighbours, first inside a task, then across tasks, whatever the length.

Spark's part: rows without their texts (a 16-byte digest stands for one) are counted by turn, role and text, so a
row that is repeated any number of times is one entry; first occurrences are joined back for repeats; entries
are range-partitioned in the order of their conversation, so a conversation of any number of rows is cut over tasks into
spans of `SPAN` entries. Conversations in one span are finished there. Of the others, cells are joined `FAN` at a
time in rounds and the states at the seams are handed back to the spans. The edits then meet the texts, which are
shuffled once by the same order and hashed as they pass; only a conversation cut between tasks, or of more than `BLOCK`
characters, sends its blocks of text on to one task, as SHA-256 reads in sequence. That task streams them.

Defined results: a NULL role or text is one space, in the damage's key also a NULL id or turn; rows of a NULL id are
one conversation. Rows of one turn stand in the order of role, the text's first `HEAD` characters and its MD5. A
conversation without rows after damage has zeros, an empty audit and the hash of the empty string. An empty table gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.scratch import stored

SPAN, FAN, HEAD, BLOCK = 512, 16, 64, 1_000_000
#: States by the last role: none, system, user, assistant. A conversation may end in none and assistant.
STATES, ENDS = range(4), (0, 3)
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
FULL = {"u": "user", "a": "assistant"}
#: What the next role after each state is, if it is inserted or changed.
AFTER = {0: "u", 1: "u", 2: "a", 3: "u"}
RECAST, DELETE, INSERT, OPEN = 2, 3, 2, 1
LEGAL = {"su", "ua", "au"}

#: Cost, audit, and the states at the seams of joined spans.
Cell = tuple[int, str, list[int]]
Cells = dict[tuple[int, int], Cell]

ORDER = ["conv", "turn", "role", "head", "digest"]
CELLS = "cells array<struct<p:int,q:int,cost:long,audit:string,path:array<int>>>"
COUNTS = ["blank", "duplicate", "truncated", "illegal"]
EDGES = "turns long, low long, high long, first_turn long, last_turn long, first_role string, last_role string"
SUMMARY = f"conv string, pid int, chunk long, {CELLS}, {', '.join(f'{c} long' for c in COUNTS)}, {EDGES}, spans array<struct<pid:int,chunk:long>>"
ENTRIES = {"turn": "long", "role": "string", "head": "string", "digest": "binary", "live": "boolean", "open": "boolean", "deletes": "long"}
SPANS = f"{SUMMARY}, part boolean, {', '.join(f'{c} array<{t}>' for c, t in ENTRIES.items())}"
OUTCOME = f"conv string, gaps long, {', '.join(f'{c} long' for c in COUNTS)}, cost long, audit string"
EDITS = "conv string, turn long, role string, head string, digest binary, lead string, new_role string, tail string, first boolean, last boolean"
HASHED = "conv string, pid int, seq long, block string, sha256 string"


def _least(found: Cells, key: tuple[int, int], cost: int, left: str, right: str, path: list[int]) -> None:
    best = found.get(key)
    if best is None or cost < best[0] or (cost == best[0] and left + right < best[1]):
        found[key] = (cost, left + right, path)


def joined(left: Cells, right: Cells, seam: bool = False) -> Cells:
    """N[p,q] -> N[p,r] N[r,q]; `seam` notes the state r."""
    found: Cells = {}
    for (p, r), (cost, audit, path) in left.items():
        for q in STATES:
            other = right.get((r, q))
            if other is not None:
                _least(found, (p, q), cost + other[0], audit, other[1], [*path, r, *other[2]] if seam else [])
    return found


def _insertions() -> Cells:
    """The insertion closure: the cheapest inserted rows from one state to another."""
    once: Cells = {(p, p): (0, "", []) for p in STATES}
    for p in STATES:
        _least(once, (p, NEXT[AFTER[p]][p]), INSERT, "I", "", [])
    return joined(once, once)


INSERTED = _insertions()


@functools.lru_cache(maxsize=4096)
def entry_cells(initial: str, live: bool, opened: bool, deletes: int) -> Cells:
    """Cells of one entry: a row that may stay, if it is `live`, and `deletes` rows after it that must not."""
    found: Cells = {(p, p): (0, "", []) for p in STATES}
    if live:
        found = {(p, p): (DELETE, "D", []) for p in STATES}
        for p, q in NEXT.get(initial, {}).items():
            _least(found, (p, q), OPEN * opened, "K", "", [])
        for p in STATES:
            _least(found, (p, NEXT[AFTER[p]][p]), RECAST + OPEN * opened, "R", "", [])
    after = {key: (cost + DELETE * deletes, audit + "D" * deletes, []) for key, (cost, audit, _) in found.items()}
    return joined(joined(INSERTED, after), INSERTED)


class Span:
    """What is known of neighbouring rows of one conversation."""

    FIELDS = [*COUNTS, "turns", "low", "high", "first_turn", "last_turn", "first_role", "last_role"]

    def __init__(self, cells: Cells, facts: dict, spans: list[dict]):
        self.cells, self.facts, self.spans = cells, facts, spans

    @classmethod
    def of_entry(cls, entry: dict) -> Span:
        turn, initial = entry["turn"], entry["role"][:1]
        counts = {c: entry[c] for c in COUNTS[:3]}
        # rows of one entry have the same initial, which no two neighbours may
        facts = counts | {"illegal": entry["n"] - 1, "turns": int(turn is not None), "first_role": initial, "last_role": initial}
        return cls(entry_cells(initial, entry["live"], entry["open"], entry["deletes"]), facts | dict.fromkeys(("low", "high", "first_turn", "last_turn"), turn), [])

    @classmethod
    def of_row(cls, row: dict) -> Span:
        cells = {(c["p"], c["q"]): (c["cost"], c["audit"], c["path"]) for c in row["cells"]}
        return cls(cells, {f: row[f] for f in cls.FIELDS}, row["spans"])

    def then(self, other: Span, seam: bool = False) -> Span:
        a, b = self.facts, other.facts
        facts = {c: a[c] + b[c] for c in (*COUNTS, "turns")}
        facts["illegal"] += a["last_role"] + b["first_role"] not in LEGAL
        facts["turns"] -= a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
        for name, least in (("low", min), ("high", max)):
            facts[name] = least((x for x in (a[name], b[name]) if x is not None), default=None)
        facts |= {f"first_{x}": a[f"first_{x}"] for x in ("turn", "role")} | {f"last_{x}": b[f"last_{x}"] for x in ("turn", "role")}
        return Span(joined(self.cells, other.cells, seam), facts, self.spans + other.spans)

    def row(self, conv: str, pid: int, chunk: int) -> dict:
        cells = [{"p": p, "q": q, "cost": cost, "audit": audit, "path": path} for (p, q), (cost, audit, path) in self.cells.items()]
        return {"conv": conv, "pid": pid, "chunk": chunk, "cells": cells, "spans": self.spans, **self.facts}

    def best(self) -> tuple[int, str, list[int]]:
        """Cost, audit, and the states before, between and after the spans."""
        cost, audit, path, end = min((*self.cells[0, q], q) for q in ENDS if (0, q) in self.cells)
        return cost, audit, [0, *path, end]

    def outcome(self, conv: str) -> dict:
        f = self.facts
        cost, audit, _ = self.best()
        gaps = 0 if f["low"] is None else f["high"] - f["low"] + 1 - f["turns"]
        return {"conv": conv, "gaps": gaps, "cost": cost, "audit": audit, **{c: f[c] for c in COUNTS}}


def parsed(parts: Iterator[Span], seam: bool = False) -> Span:
    """The span of all parts, bottom-up by length: neighbours of 1, 2, 4, 8 parts are joined as they arrive."""
    open_spans: list[tuple[int, Span]] = []
    for part in parts:
        length = 1
        while open_spans and open_spans[-1][0] == length:
            part, length = open_spans.pop()[1].then(part, seam), 2 * length
        open_spans.append((length, part))
    whole = open_spans.pop()[1]
    while open_spans:
        whole = open_spans.pop()[1].then(whole, seam)
    return whole


def _key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """`conv, turn, role, text, n`: the rows after damage, `n` times each."""
    fate = F.crc32(F.concat_ws(":", _key("conv_id"), _key("turn")).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    seen = rows.select(_key("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), fate.alias("fate")).where("fate <> 0")
    changed = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return seen.select(
        "conv", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        changed.alias("text"), F.when(F.col("fate") == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def _identity(rows: DataFrame) -> list[Column]:
    return [F.substring("text", 1, HEAD).alias("head"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest")]


def entries(rows: DataFrame) -> DataFrame:
    """One row per conversation, turn, role and text of the damaged `rows`: columns of `ORDER`, `n`, faults and what must be deleted."""
    # faults of a text are worked out where it is read; the shuffle carries its digest
    flags = [(~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("is_blank"), (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("is_open")]
    slim = rows.select("conv", "turn", "role", *_identity(rows), *flags, "n")
    counted = stored(slim.groupBy(*ORDER).agg(F.sum("n").alias("n"), F.first("is_blank").alias("is_blank"), F.first("is_open").alias("is_open")), "repair-entries")
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    several = counted.where("NOT is_blank").groupBy("conv", "role", "digest").agg(F.min(at).alias("first_at"), F.count(F.lit(1)).alias("times"))
    several = stored(several.where("times > 1").select("conv", "role", "digest", "first_at"), "repair-repeats")
    seen = counted.join(several, ["conv", "role", "digest"], "left").withColumn("later", F.coalesce(F.col("first_at") != at, F.lit(False)))
    live = ~F.col("is_blank") & ~F.col("later")
    return seen.select(
        *ORDER, "n", live.alias("live"), (live & F.col("is_open")).alias("open"), (F.col("n") - live.cast("long")).alias("deletes"),
        F.when(F.col("is_blank"), F.col("n")).otherwise(0).alias("blank"),
        F.when(F.col("is_blank"), 0).otherwise(F.col("n") - live.cast("long")).alias("duplicate"),
        (live & F.col("is_open")).cast("long").alias("truncated"),
    )


def _schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def spans(ordered: DataFrame) -> DataFrame:
    """Rows of `SPANS` over entries in the order of their conversations, `part` where a conversation may have others."""
    schema, size = _schema(SPANS), SPAN

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        pid = TaskContext.get().partitionId()
        conv, chunk, held, first = None, 0, [], True

        def closed(part: bool) -> dict:
            whole = parsed(Span.of_entry(e) for e in held)
            whole.spans = [{"pid": pid, "chunk": chunk}]
            if not part:
                # nothing will be joined to it
                whole.cells = dict([min(((key, whole.cells[key]) for key in ((0, q) for q in ENDS) if key in whole.cells), key=lambda x: x[1])])
            return whole.row(conv, pid, chunk) | {"part": part} | {c: [e[c] for e in held] for c in ENTRIES}

        for entry in _each(batches):
            if held and entry["conv"] != conv:
                # the first and the last conversation of a task may go on in others
                yield closed(first or chunk > 0)
                held, chunk, first = [], 0, False
            elif len(held) == size:
                yield closed(True)
                held, chunk = [], chunk + 1
            conv = entry["conv"]
            held.append(entry)
        if held:
            yield closed(True)

    return stored(ordered.mapInArrow(lambda batches: _batches(cut(batches), schema, 64), SPANS), "repair-spans")


def _joined_parts(parts: DataFrame) -> DataFrame:
    """One row of `SUMMARY` per conversation, from neighbouring spans `FAN` at a time, at last over the tasks' parts."""
    schema = _schema(SUMMARY)

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["pid"], r["chunk"]))
        whole = parsed((Span.of_row(r) for r in rows), seam=True)
        return pa.Table.from_pylist([whole.row(rows[0]["conv"], rows[0]["pid"], rows[0]["chunk"] // FAN)], schema=schema)

    found = parts.select(*schema.names)
    while (found.agg(F.max("chunk")).first()[0] or 0) > 0:
        found = stored(found.groupBy("conv", "pid", F.floor(F.col("chunk") / FAN)).applyInArrow(join, SUMMARY), "repair-joined")
    return stored(found.groupBy("conv").applyInArrow(join, SUMMARY), "repair-whole")


def edits_of(row: dict, p: int, q: int) -> list[tuple[str, str | None, str]]:
    """For each entry of a span: inserted rows before it, the role of the row that stays (None: it is deleted), and, at the end, inserted rows after."""
    audit = next(c["audit"] for c in row["cells"] if (c["p"], c["q"]) == (p, q))
    state, at, found, lead = p, 0, [], ""

    def inserted() -> str:
        nonlocal state, at
        lines = ""
        while audit[at : at + 1] == "I":
            lines += f"\n{FULL[AFTER[state]]}:"
            state, at = NEXT[AFTER[state]][state], at + 1
        return lines

    for role, live, deletes in zip(row["role"], row["live"], row["deletes"], strict=True):
        lead, new_role = inserted(), None
        if live:
            edit, at = audit[at], at + 1
            if edit == "K":
                new_role, state = role, NEXT[role[:1]][state]
            elif edit == "R":
                new_role, state = FULL[AFTER[state]], NEXT[AFTER[state]][state]
        after = ""
        while deletes:
            plain = audit.find("I", at, at + deletes)
            run = deletes if plain < 0 else plain - at
            at, deletes = at + run, deletes - run
            after += inserted() if deletes else ""
        found.append((lead, new_role, after))
    lead, new_role, after = found[-1]
    found[-1] = (lead, new_role, after + inserted())
    return found


def _edits(chosen: DataFrame) -> DataFrame:
    """Rows of `EDITS` for spans with the states `p`, `q` at their ends and `is_first`, `is_last` in their conversation."""
    schema = _schema(EDITS)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for row in _each(batches):
            last = len(row["role"]) - 1
            for i, (lead, new_role, tail) in enumerate(edits_of(row, row["p"], row["q"])):
                yield {
                    "conv": row["conv"], **{c: row[c][i] for c in ORDER[1:]}, "lead": lead, "new_role": new_role, "tail": tail,
                    "first": row["is_first"] and i == 0, "last": row["is_last"] and i == last,
                }

    return stored(chosen.mapInArrow(lambda batches: _batches(edit(batches), schema, 4096), EDITS), "repair-edits")


def _hashed(edits: DataFrame, rows: DataFrame) -> DataFrame:
    """`conv, sha256` of the repaired rows: edits and texts in one order, hashed as they pass."""
    schema = _schema(HASHED)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        pid = TaskContext.get().partitionId()
        conv, held, size, seq, opens, closes, wanted = None, [], 0, 0, False, False, None

        def block() -> dict:
            return {"conv": conv, "pid": pid, "seq": seq, "block": "".join(held), "sha256": None}

        def closed() -> dict:
            if seq == 0 and opens and closes:
                return {"conv": conv, "sha256": hashlib.sha256("".join(held)[1:].encode("utf-8", "surrogatepass")).hexdigest()}
            return block()

        for row in _each(batches):
            if row["conv"] != conv:
                if conv is not None:
                    yield closed()
                conv, held, size, seq, opens, closes, wanted = row["conv"], [], 0, 0, False, False, None
            if row["text"] is None:
                opens, closes = opens or row["first"], closes or row["last"]
                held.append(row["lead"] if row["new_role"] is None else f"{row['lead']}\n{row['new_role']}:")
                if row["new_role"] is None:
                    held.append(row["tail"])
                    wanted = None
                else:
                    wanted = row["tail"]
            elif wanted is not None:
                # the first of equal texts
                held += [row["text"], wanted]
                size, wanted = size + len(row["text"]), None
                if size >= BLOCK:
                    yield block()
                    held, size, seq = [], 0, seq + 1
        if conv is not None:
            yield closed()

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv, state, fresh = None, None, True
        for row in _each(batches):
            if row["conv"] != conv:
                if conv is not None:
                    yield {"conv": conv, "sha256": state.hexdigest()}
                conv, state, fresh = row["conv"], hashlib.sha256(), True
            text = row["block"][1:] if fresh else row["block"]
            fresh = fresh and not row["block"]
            state.update(text.encode("utf-8", "surrogatepass"))
        if conv is not None:
            yield {"conv": conv, "sha256": state.hexdigest()}

    # equal rows of other batches are left; `assemble` takes the first
    texts = rows.select("conv", "turn", "role", *_identity(rows), "text")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("lead", "string"), ("new_role", "string"), ("tail", "string"), ("first", "boolean"), ("last", "boolean"))]
    both = edits.withColumn("text", F.lit(None).cast("string")).unionByName(_thinned(texts).select("*", *none))
    # an edit and its text are told apart by the sort only: a bound between them would part them
    order = [*ORDER, F.col("text").isNotNull()]
    passed = both.repartitionByRange(*ORDER).sortWithinPartitions(*order).mapInArrow(lambda batches: _batches(assemble(batches), schema, 256), HASHED)
    passed = stored(passed, "repair-hashed")
    blocks = passed.where("sha256 IS NULL").repartition("conv").sortWithinPartitions("conv", "pid", "seq")
    rest = blocks.mapInArrow(lambda batches: _batches(chained(batches), schema, 256), HASHED)
    return passed.where("sha256 IS NOT NULL").unionByName(rest).select("conv", "sha256")


def _thinned(texts: DataFrame) -> DataFrame:
    """`texts` without rows that stood in the same Arrow batch before: a row of very many copies is not shuffled once for each."""
    schema = texts.schema

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, kept = set(), []
            for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "digest")), strict=True)):
                if key not in seen:
                    seen.add(key)
                    kept.append(i)
            yield batch.take(pa.array(kept, pa.int64()))

    return texts.mapInArrow(thin, schema)


def repair(rows: DataFrame) -> DataFrame:
    """`conv_id`, `gaps`, the counts of faults, `cost`, `audit` and `repaired_sha256` for every conversation of `rows` after damage."""
    hurt = damaged(rows)
    found = spans(entries(hurt).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER))
    outcome_schema, whole = _schema(OUTCOME), found.where("NOT part")
    top = _joined_parts(found.where("part"))

    def outcomes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((Span.of_row(r).outcome(r["conv"]) for r in _each(batches)), outcome_schema, 4096)

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for row in _each(batches):
            own = Span.of_row(row)
            path = own.best()[2]
            for i, place in enumerate(own.spans):
                yield {"conv": row["conv"], **place, "p": path[i], "q": path[i + 1], "is_first": i == 0, "is_last": i == len(own.spans) - 1}

    summary = top.columns
    seams_ddl = "conv string, pid int, chunk long, p int, q int, is_first boolean, is_last boolean"
    seams_schema = _schema(seams_ddl)
    results = whole.select(*summary).unionByName(top).mapInArrow(outcomes, OUTCOME)
    alone = whole.select(*summary).unionByName(top).mapInArrow(lambda batches: _batches(states(batches), seams_schema, 4096), seams_ddl)
    edits = _edits(found.join(stored(alone, "repair-seams"), ["conv", "pid", "chunk"]))
    every = rows.select(_key("conv_id").alias("conv")).distinct()
    done = every.join(stored(results, "repair-results"), "conv", "left").join(stored(_hashed(edits, hurt), "repair-digests"), "conv", "left")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", *COUNTS, "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return done.select(
        F.when(F.col("conv") != " ", F.col("conv").cast("long")).alias("conv_id"), *zeros,
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
