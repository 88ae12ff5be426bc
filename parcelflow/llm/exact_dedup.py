"""Exact dedup by a tree merge of sorted digest runs.

Each partition of the input is a run: its digests, sorted, one row per digest with the number of copies and the best
identifier. Runs merge in binomial rounds. After t rounds of two, 2^t neighbouring runs have become one, which 2^t
tasks hold together, each a range of the digests: in a round, partner tasks exchange the ranges that the other one
goes on with, so every round has the same number of tasks and each task hands rows to its partners only. `ROUND` rounds
are taken at once, as a merge of 2^ROUND sorted runs: the blocks that reach a task are sorted, so its sort is a merge,
and neighbours that are equal in digest, second hash and length combine. After the last round one run is left, spread
over all tasks by digest. Copies of one text cost one row per run and round however many there are.

Texts are equal when they are identical without the white space `[\\x20\\x09-\\x0D]`. The digest is
SHA-256; a second hash and the length go with it, and only rows equal in all three are merged. Runs are sorted
by the second hash first, whose leading bits name the range.

Beyond `MOST_RUNS` partitions, neighbouring ones share a run, as an exchange among more tasks would cost more than it spreads.

Defined results: a NULL text counts as empty, empty texts equal each other; among equal texts the longest
original stays, then the least `doc_id` (a NULL one last), then the least hash of the original text; of
wholly equal rows exactly one stays. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.scratch import stored
from parcelflow.llm import common

#: Rounds of two that one exchange takes together, and runs before the first of them.
ROUND, MOST_RUNS = 3, 1 << 14
WHITE_SPACE = "\t\n\x0b\x0c\r "
SAME = ["check", "digest", "n_bytes"]


def normalised(text: Column) -> Column:
    for char in WHITE_SPACE:
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def digests(docs: DataFrame) -> DataFrame:
    """One small row per document: its row key, digest, check hash, lengths, and a row number within the job."""
    plain = docs.select("doc_id", *common.row_key(), F.length(common.whole_text()).alias("n_chars"), normalised(common.whole_text()).alias("plain"))
    return plain.select(
        "doc_id", *common.KEY, "n_chars",
        F.unhex(F.sha2("plain", 256)).alias("digest"),
        F.xxhash64("plain").alias("check"),
        F.octet_length("plain").alias("n_bytes"),
        F.monotonically_increasing_id().alias("row_id"),
        F.spark_partition_id().alias("run"),
    )


def merge_runs(rows: DataFrame, at_once: int = ROUND, most_runs: int = MOST_RUNS) -> DataFrame:
    """One row per distinct text: `best` identifier and number of copies `n`. `rows` is read twice, so it should be stored."""
    last = rows.agg(F.max("run")).first()[0] or 0
    folded = max(0, last.bit_length() - (most_runs - 1).bit_length())
    bits = last.bit_length() - folded
    best = F.struct((-F.col("n_chars")).alias("longest"), "key_no_id", "key_id", "key_text", "row_id")
    leaves = rows.select(F.shiftright("run", folded).alias("run"), *SAME, best.alias("best"), F.lit(1).cast("long").alias("n"))
    merged = _combined(leaves, "run")
    for done in range(0, bits, at_once):
        taken = min(done + at_once, bits)
        piece = F.shiftrightunsigned("check", 64 - taken).cast("int")
        runs = merged.withColumn("run", F.shiftright("run", taken - done))
        # task: the run, then its range of digests
        sent = runs.withColumn("task", F.shiftleft("run", taken).bitwiseOR(piece))
        merged = _combined(sent.repartitionById(1 << bits, "task"), "task", "run").drop("task")
    return merged.drop("run")


def _combined(rows: DataFrame, *run: str) -> DataFrame:
    """One row per run and text. The minimum of a struct makes Spark sort by the keys and combine neighbours."""
    return rows.groupBy(*run, *SAME).agg(F.min("best").alias("best"), F.sum("n").alias("n"))


def dedup(docs: DataFrame) -> DataFrame:
    """`doc_id, keep_id, group_size, kept, text_sha256` for every row.

    Digests and merged groups are written, so texts are hashed once and the join between them has a plain
    exchange on both sides: adaptive execution splits the rows of a hot group.
    """
    rows = stored(digests(docs), "exact-digests")
    groups = stored(merge_runs(rows).select(*SAME, "best", F.col("n").alias("group_size")), "exact-groups")
    return rows.join(groups, SAME).select(
        "doc_id",
        F.when(~F.col("best.key_no_id"), F.col("best.key_id")).alias("keep_id"),
        "group_size",
        (F.col("best.row_id") == F.col("row_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    groups = stored(merge_runs(stored(digests(docs), "exact-digests")).select("best.*"), "exact-kept")
    return common.keep_only(docs, groups)
