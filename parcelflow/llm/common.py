"""What several operators share: row keys, kept rows, gapless numbers and connected components.

Documents are read by `doc_id` and `text` only, so any further column may have any name. Rows that are
equal in both are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelflow.functions.scratch import stored


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: Column | str = "text") -> Column:
    """The text, a NULL one as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Whether CRC-32 of the id as text leaves 2 modulo 4; a NULL id counts as empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def draw(*of: Column | str) -> Column:
    """A hash from 0 to 2^63 - 1: rows whose draw is at most `share_of(wanted, size)` are about `wanted` of `size`, whatever the size."""
    return F.xxhash64(*of).bitwiseAND(F.lit(2**63 - 1))


def share_of(wanted: int, size: int) -> int:
    return min(2**63 - 1, (wanted << 63) // max(size, 1))


def row_key(columns: tuple[str, str, str] = ("key_id", "key_no_id", "key_text")) -> list[Column]:
    """Columns without NULLs that tell documents apart: the id, whether it is NULL, and a hash of the text."""
    of_id, of_none, of_text = columns
    return [
        F.coalesce("doc_id", F.lit(0).cast("long")).alias(of_id),
        F.col("doc_id").isNull().alias(of_none),
        F.xxhash64(whole_text(), F.col("text").isNull()).alias(of_text),
    ]


KEY = ["key_id", "key_no_id", "key_text"]


def keep_only(docs: DataFrame, keepers: DataFrame) -> DataFrame:
    """Exactly one row of `docs` for each row key in `keepers`, all columns as they were.

    Equal rows are thinned before they are shuffled (one per task stays), so a row that is repeated any
    number of times is no hot key. One shuffle of the documents, on the key that the join uses too.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), *row_key())
    first = Window.partitionBy(*KEY).orderBy(F.lit(0))
    rows = rows.withColumn("nth", F.row_number().over(first)).where("nth = 1")
    return rows.join(keepers.select(*KEY), KEY, "left_semi").select("doc.*")


def one_per_document(rows: DataFrame, *document: str) -> DataFrame:
    """One of the rows (`text` and others) for each value of the columns `document`: that of the least text hash.

    Each task keeps one row per document before the shuffle, so an id of very many rows is no hot key.
    """
    best = F.min_by(F.struct(*(F.col(c) for c in rows.columns)), F.struct(F.col("text").isNull(), F.xxhash64("text")))
    return rows.groupBy(*(F.col(c).alias(f"document_{i}") for i, c in enumerate(document))).agg(best.alias("best")).select("best.*")


#: Copies of a row that one array holds at most: 8 MB of numbers.
RUN = 1_000_000


def spread(rows: DataFrame, times: str, nth: str) -> DataFrame:
    """Every row as often as its column `times` says, numbered from 0 in `nth`; `rows` should be cheap to read twice.

    A row of more than `RUN` copies is first cut into runs of so many, which are dealt to all tasks, so neither an array nor a task grows
    with the number of copies.
    """
    n, run = F.col(times), F.lit(RUN).cast("long")
    few = rows.where((n > 0) & (n <= run)).withColumn(nth, F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    runs = rows.where(n > run).withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / run))))
    runs = runs.repartition(F.xxhash64("_run")).withColumn(nth, F.explode(F.sequence(F.col("_run") * run, F.least((F.col("_run") + 1) * run, n) - 1)))
    return few.unionByName(runs.drop("_run"))


def components(edges: DataFrame, name: str) -> DataFrame:
    """`node, root` for every node of `edges` (`u`, `v`: longs): `root` is the least node that it reaches.

    Alternating stars: each node hands its larger, then its smaller neighbours to the least node it knows,
    until nothing changes; the number of rounds grows with the logarithm of the longest path. Every round
    is a written table of at most one row per node and edge. Minima are combined before they are shuffled
    and written, so the joins with them have plain exchanges and a node with very many edges is split.
    """
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("least")), f"{name}-least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("least", "u").alias("v")).where("u <> v").distinct()
        large = stored(large, f"{name}-large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("least")), f"{name}-least")
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("least").alias("v")), F.struct(F.col("u"), F.col("least").alias("v")))).alias("e"))
        edges = stored(small.select("e.u", "e.v").where("u <> v").distinct(), f"{name}-edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    """Number and hash of the edges: equal exactly when a round has changed nothing."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def numbered(df: DataFrame, buckets: int, order: list[str], number: str, within: list[str] = ()) -> DataFrame:
    """Gapless numbers from 0 over `df` (per value of `within`), which must hold a count in `n` per distinct row.

    Rows are dealt to hash buckets of `order`; bucket sizes are summed into offsets, so no sort and no
    task sees more than a bucket. `number` is the first number of the row's `n` copies.
    """
    within = list(within)
    dealt = df.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = dealt.groupBy(*within, "bucket").agg(F.sum("n").alias("bucket_n"))
    before = Window.partitionBy(*within).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*within, "bucket", F.coalesce(F.sum("bucket_n").over(before), F.lit(0)).alias("bucket_from"))
    inside = Window.partitionBy(*within, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.withColumn("inside_from", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    joined = ranked.join(offsets, [*within, "bucket"])
    return joined.withColumn(number, F.col("bucket_from") + F.col("inside_from")).drop("bucket", "bucket_from", "inside_from")
