"""Approximate nearest neighbours by inner product over shifted space-filling curves.

One more component gives all vectors the same length, so that the order by inner product is the order by distance; a
query has nothing there. `CURVES` random projections to `DIMS` dimensions, each with its own quantile scale and
shift, are laid on a Hilbert curve each. Spark range-partitions all curves at once by curve and key, which gives
every entry its rank on every curve. A query's candidates are the entries within `window` ranks of its own place on any
curve; blocks of neighbouring ranks meet the queries whose windows reach them, the best of all curves are merged, and
scores are inner products of the original vectors in double precision.

The window is fitted to the data: for a sample of about `SAMPLE` queries the true neighbours are found by one scan of all
entries, and the window is what `AIM` of them need on their best curve. On data of few degrees of freedom it is a few
ranks; on vectors without any structure no curve helps and it grows to a share of the table. `Index.share` tells the
pairs it compares.

Memory and movement: samples of about `SCALED` and `SAMPLE` vectors come to the driver, scales and the smaller sample go
to all tasks. Keys and ranks are shuffled as numbers; vectors are shuffled once by id and once a
curve. A task holds one block of `BLOCK_VALUES` components and streams the queries; a block that very many queries reach is
handed out with several parts of them. Equal vectors are one entry with their k + 1 least ids, which is all that any
query can return.

Defined results: vectors that are NULL, empty or zero, or hold a NULL, NaN or infinite component, NULL ids, and vectors whose
length is not the most common one (ties: the longer) take no part; rows equal in id and vector count once, of
different vectors under one id the least in array order counts. Equal scores go to the smaller id. With k + 1 entries or fewer all are returned. An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelflow.functions.scratch import stored

K = 20
CURVES, DIMS, BITS = 6, 8, 7
#: Sampled entries for the window, steps of a projection's scale, and the share of true neighbours that the window must reach.
SAMPLE, QUANTILES, AIM = 256, 65, 0.95
#: Sampled entries for the scales of the projections.
SCALED = 10_000
#: Components of vectors in a block, queries a part of a block, queries that are multiplied at once.
BLOCK_VALUES, PART, AT_ONCE = 1 << 20, 20_000, 256
ENTRY, QUERY = 0, 1
KEYS = "rep long, kind int, curve int, key long"
PLACED = "rep long, kind int, curve int, pid int, nth long"
FOUND = "query long, rep long, score double, ids array<long>"


def taking_part(vectors: DataFrame) -> DataFrame:
    """`vec_id, vector` of the rows that take part, one per id."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    there = F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = vectors.where(F.col("vec_id").isNotNull() & there).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return rows.where(F.size("vector") == (lengths.length if lengths else 0)).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def entries_of(rows: DataFrame, k: int = K) -> DataFrame:
    """One row per distinct vector of `rows` (`vec_id, vector`): `rep` (its least id), `vector`, and its k + 1 least `ids`.

    Each task keeps so many of a vector's ids before they are shuffled, so a vector of very many rows is no hot key.
    """
    first = Window.partitionBy("vector").orderBy("vec_id")
    least = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    return least.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("ids")).select("rep", "vector", "ids")


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (rows of `bits`-bit coordinates) on the Hilbert curve through all cells.

    From the highest bit to the lowest, the part of a cube that a cell lies in is turned so that the curve enters and leaves it
    as it does the whole; the Gray code of the turned coordinates is the place.
    """
    axes = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(len(axes)):
            upper = (axes[i] >> bit) & 1 == 1
            swap = np.where(upper, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(upper, axes[0] ^ low, axes[0] ^ swap)
            axes[i] = axes[i] ^ swap
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turned = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, 0, -1):
        turned ^= np.where((axes[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    place = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            place = (place << 1) | (((axis ^ turned) >> bit) & 1)
    return place


class Curves:
    """Projections, scales and shifts; all are made from a seed and a bounded sample."""

    def __init__(self, sample: np.ndarray, largest: float, curves: int = CURVES, dims: int = DIMS, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.largest, width = largest, sample.shape[1] + 1
        self.axes = [np.linalg.qr(draw.normal(size=(width, min(dims, width))))[0] for _ in range(curves)]
        self.shifts = [draw.random(a.shape[1]) for a in self.axes]
        steps = np.linspace(0, 1, QUANTILES)
        self.scales = [np.quantile(self.lifted(sample) @ a, steps, axis=0) for a in self.axes]

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.clip(self.largest - (vectors**2).sum(axis=1), 0, None))
        return np.hstack([vectors, rest[:, None]])

    def asking(self, vectors: np.ndarray) -> np.ndarray:
        """Queries at the length of all entries, with nothing in the added component."""
        size = np.sqrt((vectors**2).sum(axis=1))
        return np.hstack([vectors * (np.sqrt(self.largest) / size)[:, None], np.zeros((len(vectors), 1))])

    def keys(self, points: np.ndarray, curve: int) -> np.ndarray:
        flat = points @ self.axes[curve]
        steps = np.linspace(0, 1, QUANTILES)
        even = np.column_stack([np.interp(flat[:, i], self.scales[curve][:, i], steps) for i in range(flat.shape[1])])
        # shifted within a cube of twice the side
        cells = ((even + self.shifts[curve]) / 2 * (1 << BITS)).astype(np.int64)
        return hilbert(np.clip(cells, 0, (1 << BITS) - 1), BITS)


def _drawn(rows: DataFrame, column: str, wanted: int) -> DataFrame:
    """About `wanted` rows by a hash of `column`, one at least: the bound of what is sent to the driver."""
    size = rows.count()
    draw = F.pmod(F.xxhash64(column, F.lit(29)), F.lit(2**62)) / F.lit(float(2**62))
    drawn = rows.where(draw < wanted / max(size, 1))
    return drawn if drawn.take(1) else rows.limit(1)


def _keys(points: DataFrame, curves: Curves, kind: int) -> DataFrame:
    """The key of `points` (`rep, vector`) on every curve."""

    def key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                vectors = np.stack(batch["vector"]).astype(np.float64)
                placed = curves.lifted(vectors) if kind == ENTRY else curves.asking(vectors)
                for c in range(len(curves.axes)):
                    yield pd.DataFrame({"rep": batch["rep"], "kind": kind, "curve": c, "key": curves.keys(placed, c)})

    return points.select("rep", "vector").mapInPandas(key, KEYS)


def _placed(keys: DataFrame) -> DataFrame:
    """`rep, kind, curve, rank`: the number of entries before each point on its curve."""

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid, before = TaskContext.get().partitionId(), {}
        for batch in batches:
            counts, curve = (batch["kind"] == ENTRY).to_numpy(), batch["curve"].to_numpy()
            nth = np.zeros(len(batch), np.int64)
            for c in np.unique(curve).tolist():
                here = curve == c
                so_far = before.get(c, 0) + np.cumsum(counts[here])
                nth[here], before[c] = so_far - counts[here], int(so_far[-1])
            yield batch[["rep", "kind", "curve"]].assign(pid=pid, nth=nth)

    order = ["curve", "key", "kind", "rep"]
    local = stored(keys.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(number, PLACED), "curves-placed")
    # one row per task and curve that meet: no more than tasks and curves together
    counts = local.groupBy("curve", "pid").agg(F.count(F.when(F.col("kind") == ENTRY, 1)).alias("n"))
    before = Window.partitionBy("curve").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(counts.select("curve", "pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("from")), "curves-offsets")
    return stored(local.join(offsets, ["curve", "pid"]).select("rep", "kind", "curve", (F.col("nth") + F.col("from")).alias("rank")), "curves-ranks")


def _nearest(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k greatest scores of each row, in any order."""
    width = scores.shape[1]
    return np.argpartition(-scores, k - 1, axis=1)[:, :k] if width > k else np.tile(np.arange(width), (len(scores), 1))


def true_neighbours(entries: DataFrame, ids: np.ndarray, sample: np.ndarray, k: int) -> DataFrame:
    """`probe, rep`: the k entries of the greatest inner product with each vector of the sample, known by its id, by one scan."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = np.zeros((len(sample), 0)), np.zeros((len(sample), 0), np.int64)
        for batch in batches:
            if len(batch):
                scores = np.hstack([best[0], sample @ np.stack(batch["vector"]).astype(np.float64).T])
                reps = np.hstack([best[1], np.tile(batch["rep"].to_numpy(), (len(sample), 1))])
                kept = _nearest(scores, k)
                best = np.take_along_axis(scores, kept, 1), np.take_along_axis(reps, kept, 1)
        yield pd.DataFrame({"probe": np.repeat(ids, best[0].shape[1]), "rep": best[1].ravel(), "score": best[0].ravel()})

    order = Window.partitionBy("probe").orderBy(F.desc("score"), "rep")
    every = entries.select("rep", "vector").mapInPandas(scan, "probe long, rep long, score double")
    return every.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k).select("probe", "rep")


@dataclasses.dataclass
class Index:
    """`entries` with `rep, vector, ids`, `queries` with `rep, vector`, and `ranks` with `rep, kind, curve, rank` of both."""

    entries: DataFrame
    queries: DataFrame
    ranks: DataFrame
    size: int
    curves: int
    window: int

    def share(self) -> float:
        """A query is compared with this share of all entries at most, counting an entry once a curve."""
        return self.curves * (2 * self.window + 1) / self.size


def build(entries: DataFrame, asked: DataFrame, k: int = K, aim: float = AIM, curves: int = CURVES, dims: int = DIMS) -> Index | None:
    """The index over `entries` (of `entries_of`, written) and the places of the queries in it; None without entries or queries.

    `asked` has a row per query, `query` being the `rep` of its entry. The window reaches `aim` of the k nearest entries of the
    sampled rows, on the best curve for each; a vector that many rows ask for counts as often.
    """
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    size = entries.agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("largest")).first()
    if not size.n or not asked.take(1):
        return None
    scaling = _drawn(entries.select("rep", "vector"), "rep", SCALED).toPandas().sort_values("rep")
    made = Curves(np.stack(scaling["vector"]).astype(np.float64), size.largest, curves, dims)
    queries = stored(entries.join(asked.select(F.col("query").alias("rep")).distinct(), "rep", "left_semi").select("rep", "vector"), "curves-queries")
    drawn = _drawn(asked, "query_id", SAMPLE).groupBy("query").agg(F.count(F.lit(1)).alias("times"))
    probes = stored(drawn.join(queries, F.col("query") == F.col("rep")).select("rep", "vector", "times"), "curves-probes")
    trial = probes.toPandas()
    ranks = _placed(_keys(entries, made, ENTRY).unionByName(_keys(queries, made, QUERY)))
    truth = true_neighbours(entries, trial["rep"].to_numpy(), np.stack(trial["vector"]).astype(np.float64), k + 1).where("probe <> rep")
    there = ranks.where(F.col("kind") == ENTRY).select("rep", "curve", "rank").join(truth, "rep")
    place = ranks.where(F.col("kind") == QUERY).join(probes, "rep").select(F.col("rep").alias("probe"), "curve", F.col("rank").alias("place"), "times")
    apart = there.join(place, ["probe", "curve"]).groupBy("probe", "rep", "times").agg(F.min(F.abs(F.col("rank") - F.col("place"))).alias("apart"))
    reach = apart.agg(F.percentile("apart", F.lit(aim), F.col("times"))).first()[0] or 0
    return Index(entries, queries, ranks, size.n, curves, max(int(np.ceil(reach)), 4 * k))


def search(index: Index, k: int = K) -> DataFrame:
    """`query, rep, score, ids`: for each query of the index the k best of its candidates, and further ones."""
    window, queries = index.window, index.queries
    length = queries.select(F.size("vector")).first()
    block = max(1, BLOCK_VALUES // max(length[0] if length else 1, 1))
    last = (index.size - 1) // block
    entries = index.ranks.where(F.col("kind") == ENTRY).join(index.entries, "rep")
    entries = entries.select("curve", F.floor(F.col("rank") / block).alias("block"), "rank", "rep", "vector", "ids")
    places = index.ranks.where(F.col("kind") == QUERY)
    reached = F.sequence(F.greatest(F.floor((F.col("rank") - window) / block), F.lit(0)), F.least(F.floor((F.col("rank") + window) / block), F.lit(last)))
    wanted = stored(places.select("rep", "curve", "rank", F.explode(reached).alias("block")), "curves-wanted")
    most = wanted.groupBy("curve", "block").count().agg(F.max("count")).first()[0] or 0
    parts = max(1, -(-most // PART))
    asking = wanted.join(queries.select("rep", "vector"), "rep").withColumn("part", F.pmod(F.xxhash64("rep"), F.lit(parts)).cast("int"))
    asking = asking.select("curve", "block", "part", F.lit(QUERY).alias("kind"), "rank", "rep", "vector", F.lit(None).cast("array<bigint>").alias("ids"))
    given = entries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("kind", F.lit(ENTRY)).select(*asking.columns)

    def found(queries: pd.DataFrame, ranks: np.ndarray, reps: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> Iterator[pd.DataFrame]:
        for at in range(0, len(queries), AT_ONCE):
            some = queries.iloc[at : at + AT_ONCE]
            place, asked = some["rank"].to_numpy(), np.stack(some["vector"]).astype(np.float64)
            low, high = np.searchsorted(ranks, place - window), np.searchsorted(ranks, place + window, side="right")
            first, after = low.min(), high.max()
            scores = asked @ vectors[first:after].T
            column = np.arange(first, after)
            scores[(column < low[:, None]) | (column >= high[:, None])] = -np.inf
            kept = _nearest(scores, k)
            row, nth = np.nonzero(np.take_along_axis(scores, kept, 1) > -np.inf)
            entry = first + kept[row, nth]
            # by components, in one order: an entry has the same score on every curve
            exact = (asked[row] * vectors[entry]).sum(axis=1)
            yield pd.DataFrame({"query": some["rep"].to_numpy()[row], "rep": reps[entry], "score": exact, "ids": ids[entry]})

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, held, ready = None, [], None
        for batch in batches:
            for key, rows in batch.groupby(["curve", "block", "part"], sort=False):
                if key != of:
                    of, held, ready = key, [], None
                here = rows["kind"] == ENTRY
                if here.any():
                    own = rows[here]
                    held.append((own["rank"].to_numpy(), own["rep"].to_numpy(), own["ids"].to_numpy(), np.stack(own["vector"]).astype(np.float64)))
                if not here.all() and held:
                    ready = ready or tuple(np.concatenate(x) for x in zip(*held, strict=True))
                    yield from found(rows[~here], *ready)

    keys = ["curve", "block", "part"]
    met = given.unionByName(asking).repartition(*keys).sortWithinPartitions(*keys, "kind", "rank", "rep")
    # an entry is found on several curves
    return met.mapInPandas(meet, FOUND).groupBy("query", "rep").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))


def nearest(vectors: DataFrame, k: int = K, every: int = 20, aim: float = AIM) -> DataFrame:
    """`query_id, rank, vec_id, score` for every row whose id is divisible by `every`, against all other rows.

    A query vector is searched once for its k + 1 best; each of its ids then leaves itself out.
    """
    rows = stored(taking_part(vectors), "curves-rows")
    entries = stored(entries_of(rows, k), "curves-entries")
    asking = rows.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    owners = stored(asking.join(entries.select("rep", "vector"), "vector").select("query_id", F.col("rep").alias("query")), "curves-owners")
    index = build(entries, owners, k, aim)
    if index is None:
        return entries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = stored(search(index, k + 1), "curves-found")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    each = found.select("query", "score", F.explode("ids").alias("vec_id"))
    best = each.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1).drop("nth")
    mine = owners.join(best, "query").where(F.col("query_id") != F.col("vec_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return mine.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
