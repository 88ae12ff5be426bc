"""Shuffle and shard by a Feistel permutation with cycle walking over global row numbers.

Rows get gapless numbers in a fixed order (hash bucket of id, text CRC and size, then these values). The
permutation of 0..rows-1 is a keyed alternating Feistel network on Z_a x Z_b with a*b just above the number
of rows; a value outside is walked on until it falls inside. Position p of the shuffled corpus is slot
p div shards of shard p mod shards, so sizes differ by one row at most, and where a row goes, or which row
is in a slot, is arithmetic on its number.

Defined results: NULL text has size 16 and the CRC of empty text; rows equal in id, size and CRC are
interchangeable and get one place each; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.scratch import stored
from parcelflow.llm import common

ROUNDS, SEED, BUCKETS = 6, 20240607, 4096
#: A walk leaves the domain with a chance below 1/sqrt(rows) a step; this many steps cover every small domain fully.
STEPS = 48


def domain(rows: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    return a, max(1, -(-rows // a))


def _keyed(value: Column, key: int, round_no: int, modulus: int) -> Column:
    return F.pmod(F.xxhash64(value.cast("long"), F.lit(round_no), F.lit(key).cast("long")), F.lit(modulus).cast("long"))


def feistel(x: Column, a: int, b: int, key: int = SEED, rounds: int = ROUNDS, inverse: bool = False) -> Column:
    """One pass over Z_a x Z_b. Even rounds add a keyed hash of the right part to the left one, odd rounds the reverse."""
    right = F.pmod(x, F.lit(b).cast("long"))
    left = ((x - right) / b).cast("long")
    sign = -1 if inverse else 1
    for i in reversed(range(rounds)) if inverse else range(rounds):
        if i % 2 == 0:
            left = F.pmod(left + sign * _keyed(right, key, i, a), F.lit(a).cast("long"))
        else:
            right = F.pmod(right + sign * _keyed(left, key, i, b), F.lit(b).cast("long"))
    return left * F.lit(b).cast("long") + right


def permuted(number: Column, rows: int, key: int = SEED, inverse: bool = False) -> Column:
    """The place of row `number` in the shuffled order of `rows` rows; `inverse` gives the row of a place."""
    a, b = domain(rows)
    once = feistel(number, a, b, key, inverse=inverse)
    if a * b == rows:
        return once
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), once, lambda x, _: F.when(x < rows, x).otherwise(feistel(x, a, b, key, inverse=inverse)))
    return F.when(once < rows, once).when(walked < rows, walked).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long"))


def place(number: Column, rows: int, shards: int, key: int = SEED) -> tuple[Column, Column]:
    """Shard and slot of a row number, from the number alone."""
    position = permuted(number, rows, key)
    shard_no = F.pmod(position, F.lit(shards).cast("long"))
    return shard_no.cast("int"), ((position - shard_no) / shards).cast("long")


def shard(docs: DataFrame, shards: int = 40, key: int = SEED) -> DataFrame:
    """`doc_id, size, text_crc32, row_number, shard, slot` for every row.

    Only 20 bytes a document are shuffled. Equal rows are counted, numbered together and spread again after
    the numbering, in runs of bounded length, so repeated rows are no hot key.
    """
    text = common.whole_text()
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    counted = stored(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n")), "shard-rows")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    numbers = common.numbered(counted, BUCKETS, ["doc_id", "text_crc32", "size"], "first")
    each = common.spread(numbers.select("doc_id", "size", "text_crc32", "n", "first"), "n", "nth").withColumn("row_number", F.col("first") + F.col("nth"))
    of_shard, of_slot = place(F.col("row_number"), total, shards, key)
    return each.select("doc_id", "size", "text_crc32", "row_number", of_shard.alias("shard"), of_slot.alias("slot"))
