"""Personal data: patterns, and information-theoretic sanitisation of the terms that give it away.

Emails, IP addresses, card and phone numbers are found by pattern and check (`KINDS`). They are the protected
entities. A term is a run of letters and marks, with inner hyphens and apostrophes, anywhere outside of emails;
a final 's is no part of it. Over whole documents, the pointwise mutual information of term and entity,
log(N n_et / (n_e n_t)), says how much of the entity's information log(N / n_e) the term discloses. Where a
document holds an entity, every occurrence of a term that discloses at least the share `THRESHOLD` of it gets a
span of kind `term`, wherever it stands. Of n_et, `SHRINK` (1 - 1 / n_e) is taken off: a meeting in a single document says
all about an entity of that document alone, and the less the more documents the entity has without the term. Terms
are generalised to their first letters if those are fewer than all and disclose less than the threshold, and removed
otherwise.

All expressions are built-in functions. Java regular expressions with possessive loops find the same matches
as the plain patterns, in time linear in the text and without recursion. Positions come from the lengths of
the matches and of the text between them: one row each, summed by a window over the matches of a text, which sorts and
spills, so a text of millions of words costs no more than its words. Words and counts are shuffled; texts only where they hold
an entity, once. Counts are combined first. The threshold bounds n_t by n_e^THRESHOLD N^(1 - THRESHOLD) for any n_et,
so commoner terms are left out before they are paired with entities, without change of the result. Entities of the same documents
disclose alike and are paired as one, so a list of many entities has one pair a term. Texts that hold an entity
are written once.

Defined results: a NULL text counts as empty and has no spans. Repeated rows have the same spans, and each
counts as a document. A term that discloses several entities has one span. If every document holds an entity,
it has no information to disclose. In scripts without spaces a run of letters is one term, whatever words are in
it. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelflow.functions.scratch import stored
from parcelflow.llm import common

THRESHOLD, SHRINK, PREFIX = 0.8, 0.9, 3
#: Patterns by kind, in the order of the result. A start inside a run of its own characters cannot be leftmost
#: unless a match ends there, so starts are tied to run beginnings and ends of matches.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for a kind to be looked for at all.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
#: Runs of letters and marks, also across a hyphen or apostrophe, without a final 's.
TERM = r"(?<![\p{L}\p{M}]['\u2019](?=[sS](?![\p{L}\p{M}])))[\p{L}\p{M}]++(?:(?:-|['\u2019](?![sS](?![\p{L}\p{M}])))[\p{L}\p{M}]++)*+"
SPANS = "array<struct<start:int,end:int,text:string>>"


def matches(text: Column, pattern: str) -> Column:
    """All matches of `pattern` as `gap` (the characters since the match before), `size` and `text`; NULL text gives NULL."""
    return F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1),
        # there is one part of text more than there are matches
        lambda m, before: F.struct(F.length(before).alias("gap"), F.length(m).alias("size"), m.alias("text")),
    )


def located(rows: DataFrame, *text: str) -> DataFrame:
    """`start` and `end` of matches, given one row each with `pos`, `gap` and `size`, and the columns `text` that tell texts apart."""
    so_far = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy(*text).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("end", so_far.cast("int")).withColumn("start", F.col("end") - F.col("size"))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the check digit of a string of digits fits."""
    back = F.reverse(number)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(number)),
        F.lit(0),
        lambda s, i: s + F.when(i % 2 == 1, F.substring(back, i, F.lit(1)).cast("int")).otherwise(
            F.floor(F.substring(back, i, F.lit(1)).cast("int") * 2 / 10).cast("int") + F.substring(back, i, F.lit(1)).cast("int") * 2 % 10
        ),
    )
    return total % 10 == 0


def valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return text.rlike(rf"\A{part}(?:\.{part}){{3}}\z")
    size = F.length(digits(text))
    if kind == "card":
        return F.when(size.between(16, 19), luhn(digits(text))).otherwise(F.lit(False))
    return size.between(8, 15) if kind == "phone" else F.lit(True)


def entity(kind: str, text: Column) -> Column:
    """The name under which mentions count as one entity."""
    return F.concat(F.lit(f"{kind}:"), F.lower(text) if kind in ("email", "ip") else digits(text))


def _checked(kind: str):
    """A match with its kind and place, and its text if it passes the check of its kind."""
    return lambda m, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), m["gap"], m["size"], F.when(valid(kind, m["text"]), m["text"]).alias("text"))


def base_matches(docs: DataFrame) -> DataFrame:
    """`doc_id`, row key, `items`: the matches of all kinds, those that fail their check without their text; and `text` where any passes."""
    rows = docs.select("doc_id", *common.row_key(), common.whole_text().alias("text"))
    rows = rows.withColumn("has_digit", F.col("text").rlike("[0-9]"))
    for kind, pattern in KINDS.items():
        needed = F.contains("text", F.lit(NEEDS[kind])) if kind in NEEDS else F.lit(True)
        if kind != "email":
            needed &= F.col("has_digit")
        # a column first: the check would work the matches out again
        rows = rows.withColumn(f"{kind}_found", F.when(needed, matches(F.col("text"), pattern)))
    checked = [F.transform(F.slice(f"{kind}_found", F.lit(1), F.greatest(F.size(f"{kind}_found") - 1, F.lit(0))), _checked(kind)) for kind in KINDS]
    none = F.array().cast("array<struct<kind:string,pos:int,gap:int,size:int,text:string>>")
    rows = rows.select("doc_id", *common.KEY, "text", F.concat(*(F.coalesce(c, none) for c in checked)).alias("items"))
    any_valid = F.exists("items", lambda m: m["text"].isNotNull())
    return rows.select("doc_id", *common.KEY, F.when(any_valid, F.col("items")).alias("items"), F.when(any_valid, F.col("text")).alias("text"))


def base_spans(rows: DataFrame) -> DataFrame:
    """Row key and one array of valid spans per kind (columns named by kind) for the rows of `base_matches` that have any; one row a key."""
    each = rows.where(F.col("items").isNotNull()).select(*common.KEY, F.explode("items").alias("m")).select(*common.KEY, "m.*")
    # rows that are equal have the same matches; a task sends them once
    found = located(each.distinct(), *common.KEY, "kind").where(F.col("text").isNotNull())
    spans = [F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("start", "end", "text")))).alias(kind) for kind in KINDS]
    return found.groupBy(*common.KEY).agg(*spans)


def _written(kind: str, found: Column) -> Column:
    return F.transform(found, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def _entities(kind: str) -> Column:
    return F.transform(kind, lambda s: entity(kind, s["text"]))


def _marks(kind: str) -> Column:
    return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(f"[{kind.upper()}]").alias("replacement")))


def _general(term: Column) -> Column:
    """What stands for all terms with the same first letters; no term has a star."""
    return F.concat(F.substring(term, 1, PREFIX), F.lit("*"))


def terms_of(rows: DataFrame, text: Column, *columns: str) -> DataFrame:
    """`columns` and `term`: the distinct terms of each text and their general forms."""
    plain = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, KINDS["email"], "@")).otherwise(text)
    words = F.array_distinct(F.transform(F.array_distinct(F.regexp_extract_all(plain, F.lit(TERM), F.lit(0))), F.lower))
    # a column first: it is used twice
    found = rows.select(*columns, words.alias("w"))
    return found.select(*columns, F.explode(F.concat("w", F.array_distinct(F.transform(F.filter("w", lambda w: F.length(w) > PREFIX), _general)))).alias("term"))


def occurrences(held: DataFrame) -> DataFrame:
    """Every term of the texts in `held`: row key, `term`, `start`, `end`."""
    # texts go to their keys once; the window below needs no further shuffle of their words
    once = held.groupBy(*common.KEY).agg(F.first("text").alias("text"), F.first("email").alias("email"))
    starts = F.concat(F.array(F.lit(0)), F.transform("email", lambda s: s["end"]))
    sides = F.zip_with(F.split("text", KINDS["email"], -1), starts, lambda text, at: F.struct(text.alias("side"), at.alias("at")))
    side = once.select(*common.KEY, F.explode(sides).alias("s")).select(*common.KEY, "s.at", matches(F.col("s.side"), TERM).alias("found"))
    each = side.select(*common.KEY, "at", F.posexplode("found").alias("pos", "m")).where(F.col("m.text").isNotNull())
    terms = located(each.select(*common.KEY, "at", "pos", "m.gap", "m.size", F.lower("m.text").alias("term")), *common.KEY, "at")
    return terms.select(*common.KEY, "term", (F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("end")).alias("end"))


def entity_sets(held: DataFrame) -> DataFrame:
    """Row key, `times` (the rows of that key), `n_e`, and `a`, `b`: entities of the same documents are one set."""
    each = held.select(*common.KEY, F.explode(F.array_distinct(F.concat(*(_entities(kind) for kind in KINDS)))).alias("entity"))
    # a row that is repeated counts as often as it occurs
    entities = stored(each.groupBy(*common.KEY, "entity").agg(F.count(F.lit(1)).alias("times")), "pii-entities-held")
    prints = [F.bit_xor(F.xxhash64(*common.KEY, F.lit(seed))).alias(name) for name, seed in (("a", 1), ("b", 2))]
    of_entity = stored(entities.groupBy("entity").agg(F.sum("times").alias("n_e"), *prints), "pii-entities")
    return entities.join(of_entity, "entity").select(*common.KEY, "times", "n_e", "a", "b").distinct()


SET = ["n_e", "a", "b"]


def disclosing(docs: DataFrame, held: DataFrame, threshold: float = THRESHOLD, shrink: float = SHRINK) -> DataFrame:
    """Row key, `term` and `replacement` for the terms that disclose at least the threshold of an entity of the rows in `held`."""
    total = float(docs.count())
    sets = stored(entity_sets(held).where(F.col("n_e") < total), "pii-sets")
    most = float(sets.agg(F.max("n_e")).first()[0] or 0)

    def bound(n_e: Column) -> Column:
        # n_et is n_e at most; the last factor is for rounding
        return F.pow(n_e, F.lit(threshold)) * max(total, 1.0) ** (1 - threshold) * (1 + 1e-9)

    in_text = terms_of(docs, common.whole_text())
    of_term = stored(in_text.groupBy("term").agg(F.count(F.lit(1)).alias("n_t")).where(F.col("n_t") <= bound(F.lit(most))), "pii-terms-rare")
    each = terms_of(held, F.col("text"), *common.KEY).distinct()
    rare = stored(each.join(of_term, "term"), "pii-rare")
    pairs = stored(rare.join(sets, common.KEY).where(F.col("n_t") <= bound(F.col("n_e"))), "pii-pairs")
    together = pairs.groupBy(*SET, "term", "n_t").agg(F.sum("times").alias("n_et"))
    information = F.log(F.lit(total) / F.col("n_e"))
    shrunk = F.col("n_et") - shrink * (1 - 1 / F.col("n_e"))
    shared = F.log(F.lit(total) * shrunk / (F.col("n_e") * F.col("n_t")))
    rated = stored(together.where(shared / information >= threshold).select(*SET, "term"), "pii-disclosure")
    general_form = rated.where(F.col("term").endswith("*")).select(*SET, F.col("term").alias("general"), F.lit(True).alias("reveals"))
    words = rated.where(~F.col("term").endswith("*")).withColumn("general", _general(F.col("term")))
    kept = words.join(general_form, [*SET, "general"], "left")
    safe = F.col("reveals").isNull() & (F.length("term") > PREFIX)
    revealing = stored(kept.select(*SET, "term", F.when(safe, F.col("general")).otherwise("").alias("replacement")), "pii-revealing")
    return pairs.join(revealing, [*SET, "term"]).groupBy(*common.KEY, "term").agg(F.min("replacement").alias("replacement"))


def find(docs: DataFrame) -> DataFrame:
    """`doc_id`, row key, the arrays of `KINDS` and `terms` (`start`, `end`, `replacement`) for every row."""
    rows = stored(base_matches(docs), "pii-rows")
    spans = stored(base_spans(rows), "pii-base")
    held = stored(rows.where(F.col("text").isNotNull()).select(*common.KEY, "text").join(spans, common.KEY), "pii-held")
    revealing = stored(disclosing(docs, held), "pii-flagged")
    flagged = occurrences(held).join(revealing, [*common.KEY, "term"]).groupBy(*common.KEY, "start", "end").agg(F.min("replacement").alias("replacement"))
    terms = flagged.groupBy(*common.KEY).agg(F.sort_array(F.collect_list(F.struct("start", "end", "replacement"))).alias("terms"))
    found = rows.select("doc_id", *common.KEY).join(spans, common.KEY, "left").join(stored(terms, "pii-terms"), common.KEY, "left")
    return found.withColumns({kind: F.coalesce(kind, F.array().cast(SPANS)) for kind in KINDS})


def report(docs: DataFrame) -> DataFrame:
    """`doc_id`, counts per kind, hash of the base spans, and all spans as text, for every row."""
    base = F.concat(*(_written(kind, F.col(kind)) for kind in KINDS))
    terms = F.coalesce(_written("term", F.col("terms")), F.array().cast("array<string>"))
    return find(docs).select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, terms), ",").alias("spans"),
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """The documents with all their columns; entities in `text` become `[KIND]`, terms their general form or nothing."""
    marks = F.concat(*(_marks(kind) for kind in KINDS))
    terms = F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,replacement:string>>"))
    found = find(docs).select(*common.KEY, F.sort_array(F.concat(marks, terms)).alias("marks")).where(F.size("marks") > 0).distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), *common.row_key())
    joined = rows.join(stored(found, "pii-marks"), common.KEY, "left")
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def cut(s: Column, m: Column) -> Column:
        plain = F.substring(F.col("doc.text"), s["at"] + 1, F.greatest(m["start"] - s["at"], F.lit(0)))
        return F.struct(F.greatest(s["at"], m["end"]).alias("at"), F.concat(s["out"], plain, F.when(m["start"] >= s["at"], m["replacement"]).otherwise("")).alias("out"))

    rest = F.aggregate("marks", state, cut)
    text = F.when(F.col("marks").isNull(), F.col("doc.text")).otherwise(F.concat(rest["out"], F.substring(F.col("doc.text"), rest["at"] + 1, F.length("doc.text"))))
    return joined.select(*((text.alias(c) if c == "text" else F.col(f"doc.`{c}`")) for c in docs.columns))
