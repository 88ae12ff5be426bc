"""URL filters by a Bloom filter cascade.

Keys are strings `host/path-prefix` or plain hosts. The key universe are all keys that the corpus's urls can
match: every host suffix, alone and with every path prefix of a length that a listed key has. Level 0 of a
cascade encodes the listed keys, level 1 the universe's false positives of level 0, level 2 the listed keys
that level 1 wrongly holds, and so on until no false positive is left. For every key of the universe the
first level that lacks it then tells exactly whether it is listed, so urls are judged in place: no join, no
shuffle, only the url and id columns are read.

Cascades go into the plan as constants. Their size is bounded: a cascade holds about `MAX_LISTED` listed keys (some 1.5 MB of
filter words). A longer list is cut into parts by a hash of its keys, with a cascade over each part's own share of the
universe, and the pages are judged part after part, each pass written before the next. So a list of any length is
answered by cascades, without joins of pages; passes grow with the list.

Defined results: a NULL url or one without `://` has empty host and path and is allowed. Of several listed
keys that fit, the longest decides, then the greatest. Repeated rows are judged alike. An empty table gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.scratch import stored

MAX_LISTED = 1_000_000
#: Bits per key of the first and of all other levels.
BITS = (10, 4)

# The rules of the query, as host, path prefix and verdict.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: Blocked hosts and all their subdomains, where no rule fits; a parameter of `judge`.
BLOCKED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
BLOCKED_HOSTS = [f"{name}.example.{top}" for name in BLOCKED_NAMES for top in ("com", "net", "org")]


def host(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def keys_of(host_: Column, path_: Column, labels: int, lengths: Sequence[int]) -> Column:
    """All keys of a url: host suffixes of up to `labels` labels, with path prefixes of the given lengths (0: none)."""
    parts = F.split(host_, r"\.")
    suffixes = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(parts) - labels + 1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.lit(labels)), "."),
    )
    lengths_ = F.array(*(F.lit(n) for n in lengths))
    fitting = F.filter(lengths_, lambda n: n <= F.length(path_))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(fitting, lambda n: F.concat(s, F.substring(path_, F.lit(1), n)))))


@dataclass
class Cascade:
    """Levels as (bits, hashes, bytes); empty if nothing is listed."""

    levels: list[tuple[int, int, bytes]]

    def holds(self, key: Column) -> Column:
        """Whether `key`, if it is of the universe, is listed."""
        listed = F.lit(len(self.levels) % 2 == 1)
        for number in reversed(range(len(self.levels))):
            listed = F.when(self._has(key, number), listed).otherwise(F.lit(number % 2 == 1))
        return listed

    def _has(self, key: Column, number: int) -> Column:
        bits, hashes, table = self.levels[number]
        found = F.lit(True)
        for position in _positions(key, number, bits, hashes):
            byte = F.substring(F.lit(table), (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))
            found &= F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (position % 8).cast("int")) == 1
        return found


def _positions(key: Column, number: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(number), F.lit(i)), F.lit(bits).cast("long")) for i in range(hashes)]


def fit(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade of `listed` over `universe` (both: distinct `key`). Only filter words reach the driver: ten bits a listed key, 12 bytes a word of 64."""
    cascade, remaining = Cascade([]), listed
    others = universe.join(listed, "key", "left_anti")
    while n := remaining.count():
        number = len(cascade.levels)
        per_key = BITS[min(number, 1)]
        bits, hashes = 64 * max(1, math.ceil(per_key * n / 64)), max(1, round(per_key * math.log(2)))
        position = remaining.select(F.explode(F.array(*_positions(F.col("key"), number, bits, hashes))).alias("p"))
        word = F.floor(F.col("p") / 64).cast("int")
        ored = position.groupBy(word.alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(p % 64 AS INT))")).alias("mask")).toArrow()
        words = np.zeros(bits // 64, np.int64)
        words[ored["word"].to_numpy()] = ored["mask"].to_numpy()
        cascade.levels.append((bits, hashes, words.astype("<i8").tobytes()))
        if number > 60:
            raise ValueError("a key of the universe collides at every level")
        # the set that the next level encodes: keys of the other kind that pass all levels so far
        side = others if number % 2 == 0 else listed
        for k in range(number + 1):
            side = side.where(cascade._has(F.col("key"), k))
        remaining = side
    return cascade


def judge(pages: DataFrame, rules: DataFrame, blocked_hosts: DataFrame) -> DataFrame:
    """`page_id, host, path, rule, verdict` of every page.

    `rules` has `host`, `path` and `verdict`; `blocked_hosts` has `host`, and decides where no rule fits.
    """
    allow = rules.where("verdict = 'allow'").select(F.concat("host", "path").alias("key")).distinct()
    block = rules.where("verdict = 'block'").select(F.concat("host", "path").alias("key")).distinct()
    hosts = blocked_hosts.select(F.col("host").alias("key")).distinct()
    shape = rules.select("host", F.length("path").alias("n")).unionByName(blocked_hosts.select("host", F.lit(0).alias("n")))
    labels = shape.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1
    lengths = sorted({0} | {r.n for r in shape.select("n").distinct().collect()})
    parsed = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    keys = keys_of(F.col("host"), F.col("path"), labels, lengths)
    universe = stored(parsed.select(F.explode(keys).alias("key")).distinct(), "url-universe")
    nothing = F.lit(None).cast("struct<n:int,key:string>")
    found = parsed.select("page_id", "host", "path", nothing.alias("allow"), nothing.alias("block"), F.lit(False).alias("bad"))
    for kind, listed in (("allow", allow), ("block", block), ("bad", hosts)):
        listed = stored(listed, "url-listed")
        parts = -(-listed.count() // MAX_LISTED)
        for number in range(parts):
            cascade = fit(listed.where(_part(F.col("key"), parts) == number), universe.where(_part(F.col("key"), parts) == number))
            holds = _holder(cascade, number, parts)
            if kind == "bad":
                seen = F.col("bad") | F.exists(keys, holds)
            else:
                longest = F.array_max(F.transform(F.filter(keys, holds), lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))))
                seen = F.greatest(kind, longest)
            found = found.withColumn(kind, seen)
            if parts > 1:
                found = stored(found, "url-judged")
    return _verdict(found)


def _holder(cascade: Cascade, number: int, parts: int):
    """Whether a key is of the part `number` and listed there."""
    return lambda key: (_part(key, parts) == number) & cascade.holds(key)


def _part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts))


def _verdict(found: DataFrame) -> DataFrame:
    rule = F.greatest("allow", "block")
    verdict = F.when(rule.isNull(), F.when(F.col("bad"), "block").otherwise("allow")).otherwise(F.when(rule == F.col("block"), "block").otherwise("allow"))
    return found.select("page_id", "host", "path", rule["key"].alias("rule"), verdict.alias("verdict"))
