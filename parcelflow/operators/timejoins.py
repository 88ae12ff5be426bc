"""Joins on time: the latest earlier row of a key (as-of), and pairs of overlapping intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelflow.functions.scratch import stored

#: Points of one key that one chunk is meant to hold.
CHUNK_POINTS = 1_000_000


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def _known(df: DataFrame, by: Sequence[str], on: str) -> DataFrame:
    for c in (*by, on):
        df = df.where(F.col(c).isNotNull())
    return df


def chunk_micros(points: DataFrame, by: Sequence[str], points_each: int = CHUNK_POINTS) -> int:
    """The width of time chunks (`at` in microseconds) of which the busiest key has about `points_each` points in each."""
    keys = points.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"), F.max("at").alias("high"))
    width = ((F.col("high") - F.col("low") + 1) * points_each / F.col("n")).cast("long")
    return max(1, keys.agg(F.min(F.when(F.col("n") > points_each, width))).first()[0] or 2**62)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str],
    columns: Sequence[str],
    order: Sequence[str] = (),
    strict: bool = False,
    tolerance_seconds: float | None = None,
    how: str = "left",
    points_each: int = CHUNK_POINTS,
) -> DataFrame:
    """`left` with, as struct `latest`, `on` and `columns` of the latest row of `right` of the same key `by` at or before `left`'s time.

    `strict` takes earlier rows only; `tolerance_seconds` none that lie further back. Of `right` rows of one key and
    time the greatest by (`order`, `columns`) counts. Keys and times that are NULL match nothing; `how="left"` keeps
    such rows of `left`, `"inner"` drops all without a match.

    Both sides are reduced to one point per key and time, tagged and united. A key's points fall into chunks of time, so that
    one key, however hot, is spread over tasks: inside a chunk a running last value answers, and the last row of each
    chunk is carried on over the chunks of the key, of which there are few. Rows of `left` then meet their
    answers by key and time, a join that adaptive execution splits where many rows share both.
    """
    by, payload = list(by), F.struct(*(F.col(c) for c in dict.fromkeys([on, *columns])))
    rank = F.struct(*(F.col(c) for c in dict.fromkeys([*order, *columns])))
    given = _known(right, by, on).select(*by, _micros(on).alias("at"), rank.alias("rank"), payload.alias("latest"))
    given = given.groupBy(*by, "at").agg(F.max_by("latest", "rank").alias("latest")).withColumn("asks", F.lit(False))
    asking = _known(left, by, on).select(*by, _micros(on).alias("at")).distinct()
    points = stored(given.unionByName(asking.withColumn("asks", F.lit(True)), allowMissingColumns=True), "asof-points")

    width = chunk_micros(points, by, points_each)
    chunked = points.withColumn("chunk", F.floor(F.col("at") / F.lit(width)).cast("long"))
    # at one time, what is given stands before what asks, or after it if only earlier rows count
    inside = Window.partitionBy(*by, "chunk").orderBy("at", F.col("asks") if not strict else ~F.col("asks")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = chunked.withColumn("latest", F.last("latest", ignorenulls=True).over(inside)).where("asks")
    ends = chunked.groupBy(*by, "chunk").agg(F.max_by("latest", F.when(~F.col("asks"), F.col("at"))).alias("carried"))
    before = Window.partitionBy(*by).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("carried", F.last("carried", ignorenulls=True).over(before))
    answers = running.join(carried, [*by, "chunk"]).select(*by, "at", F.coalesce("latest", "carried").alias("latest"))
    if tolerance_seconds is not None:
        near = F.col("at") - F.unix_micros(F.col("latest").getField(on).cast("timestamp")) <= int(tolerance_seconds * 1_000_000)
        answers = answers.withColumn("latest", F.when(near, F.col("latest")))
    answers = stored(answers.where(F.col("latest").isNotNull()).withColumnsRenamed({c: f"asof_{i}" for i, c in enumerate(by)} | {"at": "asof_at"}), "asof-answers")

    same = _micros(on) == F.col("asof_at")
    for i, c in enumerate(by):
        same &= left[c] == F.col(f"asof_{i}")
    return left.join(answers, same, how).drop("asof_at", *(f"asof_{i}" for i in range(len(by))))


def overlap_join(
    left: DataFrame, right: DataFrame, left_interval: tuple[str, str], right_interval: tuple[str, str], by: Sequence[str] = (), bins_each: int = 64
) -> DataFrame:
    """All pairs of a `left` and a `right` row (structs `l`, `r`) whose closed intervals of time share a moment, and that agree in `by`.

    A NULL bound, or an end before its start, overlaps nothing; a NULL key agrees with none.

    Time is cut into bins of two widths. The narrow one is the greater of both sides' 90th percentiles of length, so an interval of at
    most this length lies in two narrow bins at most; two such short intervals meet there. Pairs with a longer one meet in wide bins,
    of which the longest interval covers about `bins_each`. Both meet by equality of key, width and bin, and each pair is
    reported in the one bin that holds its later start: no nested loop, no pair twice, and a crowded bin is a skewed
    join key, which adaptive execution splits.
    """
    sides, lengths = [], []
    for name, df, (start, end) in (("l", left, left_interval), ("r", right, right_interval)):
        rows = df.select(F.struct(*(F.col(c) for c in df.columns)).alias(name), *(F.col(c).alias(f"key_{i}") for i, c in enumerate(by)), _micros(start).alias(f"{name}_from"), _micros(end).alias(f"{name}_to"))
        rows = rows.where(F.col(f"{name}_from") <= F.col(f"{name}_to"))
        sides.append(rows)
        lengths.append(rows.select((F.col(f"{name}_to") - F.col(f"{name}_from")).alias("length")).agg(F.percentile_approx("length", 0.9).alias("usual"), F.max("length").alias("longest")))
    usual, longest = lengths[0].unionByName(lengths[1]).agg(F.max("usual"), F.max("longest")).first()
    narrow = max(int(usual or 0), 1)
    wide, any_long = max(narrow, int(longest or 0) // bins_each), int(longest or 0) > narrow

    def binned(rows: DataFrame, name: str) -> DataFrame:
        """Every interval in the wide bins that it covers, a short one also in its narrow bins."""
        start, end = F.col(f"{name}_from"), F.col(f"{name}_to")
        short = (end - start) <= narrow

        def covered(width: int, sign: int) -> Column:
            # the sign tells the widths apart where they are equal
            return F.transform(F.sequence(F.floor(start / width), F.floor(end / width)), lambda b: F.struct(F.lit(sign * width).cast("long").alias("width"), b.alias("bin")))

        both = F.concat(covered(narrow, 1), covered(wide, -1)) if any_long else covered(narrow, 1)
        placed = F.explode(F.when(short, both).otherwise(covered(wide, -1)))
        return rows.withColumn(f"{name}_short", short).withColumn("place", placed).select("*", "place.width", "place.bin").drop("place")

    keys = ["width", "bin", *(f"key_{i}" for i in range(len(by)))]
    later = F.greatest("l_from", "r_from")
    met = binned(sides[0], "l").join(binned(sides[1], "r"), keys)
    # short pairs meet in narrow bins only
    met = met.where((F.col("l_from") <= F.col("r_to")) & (F.col("r_from") <= F.col("l_to")) & ((F.col("width") > 0) == (F.col("l_short") & F.col("r_short"))))
    return met.where(F.floor(later / F.abs("width")) == F.col("bin")).select("l", "r")
