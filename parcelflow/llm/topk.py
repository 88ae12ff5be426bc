"""Exact top-k search by inner product over a pivot-distance index.

One component more gives all vectors the same length; then the order by inner product is the order by angle,
wherever the query lies, and angles are a distance: the triangle inequality holds. The index keys every vector by its
nearest pivot and its distance from it; the vectors of a pivot fall into annuli of neighbouring distances. An annulus
knows the range [lo, hi] of its vectors' distances from every pivot. For a query at distance d from a pivot, nothing in
the annulus is nearer than max(d - hi, lo - d); the greatest of these over all pivots is its bound. A query first
expands its annuli in the order of that bound, from its own distance outwards, until they hold k vectors, which gives
a k-th best score, and then only those annuli whose bound does not exclude a better one. So results are exact whatever
the pivots are. Pivots and annuli grow with the root of the number of vectors, up to `MOST`.

Queries and annuli meet in blocks: neighbouring annuli of up to `BLOCK` vectors together are a run, which is
sent to its queries once; a larger annulus is a run of its own, split into blocks of about `BLOCK` vectors.
A run's queries are split into blocks of about `QUERIES`, so a task's memory does not grow with the data.
Inside a run a query is compared with those annuli only that it has to open. Equal vectors are one entry
with their k + 1 least ids, which is all that any query can return, so copies make no hot block.

Only pivots (from a bounded sample), and one row per annulus with two numbers a pivot reach the driver: at most 128 x 64
rows, 17 MB.

Defined results: vectors that are NULL, empty, or hold a NULL, NaN or infinite component, NULL ids, and
vectors whose length is not the most common one (ties: the longer) take no part; rows equal in id and vector
count once, and of different vectors under one id the least in array order counts. Equal scores go to the
smaller id. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelflow.functions.scratch import stored
from parcelflow.llm import common

SCALE, K = 64, 20
SAMPLE = 2000
#: Least and most pivots, and annuli of a pivot.
LEAST, MOST = (16, 4), (128, 64)
BLOCK, QUERIES = 4096, 1024
#: Rows of query and run that are handed to Spark at once, and queries that are held against all annuli at once.
ROWS_AT_ONCE, QUERIES_AT_ONCE = 10_000, 128
WANTED = "rep long, vector array<long>, least double, run long, annulus array<long>"
FOUND = "rep long, score long, ids array<long>"


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """`vec_id, vector` of the vectors that take part: components floor(scale * x) as longs."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    taking = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.coalesce(finite, F.lit(False)))
    whole = taking.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vector"))
    lengths = whole.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return whole.where(F.size("vector") == (lengths.length if lengths else 0)).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def grouped(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: `rep` (its least id), `vector` and its k + 1 least `ids`."""
    first = Window.partitionBy("vector").orderBy("vec_id")
    least = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    return least.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


class Pivots:
    """Reference vectors in the space with one more component that gives every vector the norm `reach`."""

    def __init__(self, sample: np.ndarray, largest: float, count: int, rings: int):
        self.largest = largest
        points = self.lifted(sample)
        chosen = [0]
        nearest = self._between(points, points[:1])[:, 0]
        while len(chosen) < min(count, len(points)) and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, self._between(points, points[chosen[-1:]])[:, 0])
        self.points = points[chosen]
        pivot, distance = self.nearest(sample)
        steps = np.linspace(0, 1, rings + 1)[1:-1]
        self.edges = [np.quantile(distance[pivot == p], steps) if (pivot == p).any() else np.zeros(rings - 1) for p in range(len(self.points))]

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        v = vectors.astype(np.float64)
        return np.hstack([v, np.sqrt(np.clip(self.largest - (v**2).sum(axis=1), 0, None))[:, None]])

    @staticmethod
    def _between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Angles; a zero vector is at angle 0 from all."""
        lengths = np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :]
        return np.arccos(np.clip(np.where(lengths > 0, a @ b.T / np.where(lengths > 0, lengths, 1), 1), -1, 1))

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        return self._between(self.lifted(vectors), self.points)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distance = self.distances(vectors)
        pivot = distance.argmin(axis=1)
        return pivot, distance[np.arange(len(pivot)), pivot]

    def of_query(self, vectors: np.ndarray) -> np.ndarray:
        """Distances from queries, which have nothing in the added component."""
        v = vectors.astype(np.float64)
        return self._between(np.hstack([v, np.zeros((len(v), 1))]), self.points)

    def ring(self, pivot: np.ndarray, distance: np.ndarray) -> np.ndarray:
        return np.array([np.searchsorted(self.edges[p], d) for p, d in zip(pivot, distance, strict=True)], np.int64)

    def best_score(self, vectors: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """No vector at least at angle `bound` has a greater score, whatever rounding does to angles."""
        lengths = np.linalg.norm(vectors.astype(np.float64), axis=1) * np.sqrt(self.largest)
        return lengths[:, None] * np.cos(bound) + 1e-6 * (1 + lengths[:, None])


def extent(n: int) -> tuple[int, int]:
    """Pivots, and annuli of a pivot, for `n` vectors."""
    pivots = min(max(LEAST[0], int(n**0.5)), MOST[0])
    return pivots, min(max(LEAST[1], n // (32 * pivots)), MOST[1])


def build(vectors: DataFrame, k: int = K) -> tuple[DataFrame, Pivots | None]:
    """The index: distinct vectors with `annulus` (pivot * rings + ring) and `distance`, written as a table."""
    entries = stored(grouped(vectors, k), "topk-entries")
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    size = entries.agg(F.count(F.lit(1)).alias("n"), F.max(squares).alias("largest")).first()
    if not size.n:
        return entries, None
    drawn = entries.where(common.draw("rep", F.lit(3)) <= common.share_of(SAMPLE, size.n)).select("vector").toPandas()
    sample = np.stack(drawn["vector"]) if len(drawn) else np.array([entries.select("vector").first()[0]])
    pivots, rings = extent(size.n)
    found = Pivots(sample, size.largest, pivots, rings)

    def key(batches):
        for batch in batches:
            pivot, distance = found.nearest(np.stack(batch["vector"]))
            yield batch.assign(annulus=pivot * rings + found.ring(pivot, distance), distance=distance)

    schema = "rep long, vector array<long>, ids array<long>, annulus long, distance double"
    return stored(entries.select("rep", "vector", "ids").mapInPandas(key, schema), "topk-index"), found


class Directory:
    """The annuli in order with their sizes and distance ranges, and the run that each belongs to."""

    def __init__(self, index: DataFrame, pivots: Pivots):
        def ranges(batches):
            """Per annulus of a task: vectors, and least and greatest distance from every pivot."""
            sizes, least, greatest = {}, {}, {}
            for batch in batches:
                distance, annulus = pivots.distances(np.stack(batch["vector"])), batch["annulus"].to_numpy()
                order = np.argsort(annulus, kind="stable")
                keys, starts = np.unique(annulus[order], return_index=True)
                lows, highs = np.minimum.reduceat(distance[order], starts), np.maximum.reduceat(distance[order], starts)
                for key, size, low, high in zip(keys.tolist(), np.diff([*starts, len(order)]).tolist(), lows, highs, strict=True):
                    sizes[key] = sizes.get(key, 0) + size
                    least[key], greatest[key] = np.minimum(least.get(key, low), low), np.maximum(greatest.get(key, high), high)
            if sizes:
                yield pd.DataFrame({"annulus": list(sizes), "size": list(sizes.values()), "lo": pd.Series(list(least.values()), dtype=object), "hi": pd.Series(list(greatest.values()), dtype=object)})

        each = index.select("annulus", "vector").mapInPandas(ranges, "annulus long, size long, lo array<double>, hi array<double>")
        every = range(len(pivots.points))
        low, high = ([of(F.col(c)[p]) for p in every] for of, c in ((F.min, "lo"), (F.max, "hi")))
        found = each.groupBy("annulus").agg(F.sum("size").alias("size"), F.array(*low).alias("lo"), F.array(*high).alias("hi")).orderBy("annulus").toPandas()
        self.annuli, self.sizes = found["annulus"].to_numpy(), found["size"].to_numpy()
        self.lo, self.hi = np.stack(found["lo"]), np.stack(found["hi"])
        #: First annulus of each run, by position.
        self.starts, held = [0], 0
        for i, size in enumerate(self.sizes.tolist()):
            if held and held + size > BLOCK:
                self.starts.append(i)
                held = 0
            held += size
        self.ends = [*self.starts[1:], len(self.annuli)]

    def run_of_annulus(self) -> dict[int, int]:
        return {int(a): run for run, (i, j) in enumerate(zip(self.starts, self.ends, strict=True)) for a in self.annuli[i:j]}

    def run_sizes(self) -> list[int]:
        return np.add.reduceat(self.sizes, self.starts).tolist()

    def bounds(self, distances: np.ndarray) -> np.ndarray:
        """Least distance that anything in each annulus can have from queries at `distances` from the pivots."""
        bound = np.zeros((len(distances), len(self.annuli)))
        for p, d in enumerate(distances.T):
            np.maximum(bound, d[:, None] - self.hi[None, :, p], out=bound)
            np.maximum(bound, self.lo[None, :, p] - d[:, None], out=bound)
        return bound

    def first(self, bound: np.ndarray, k: int) -> np.ndarray:
        """Which annuli are those of least bound that together hold k vectors."""
        order = np.argsort(bound, axis=1, kind="stable")
        held = self.sizes[order]
        chosen = np.zeros(bound.shape, bool)
        np.put_along_axis(chosen, order, np.cumsum(held, axis=1) - held < k, axis=1)
        return chosen

    def by_run(self, batch: pd.DataFrame, chosen: np.ndarray) -> Iterator[pd.DataFrame]:
        """One row per query and run (type `WANTED`), with the chosen annuli of the run."""
        query, run = np.nonzero(np.logical_or.reduceat(chosen, self.starts, axis=1))
        for at in range(0, len(query), ROWS_AT_ONCE):
            q, r = query[at : at + ROWS_AT_ONCE], run[at : at + ROWS_AT_ONCE]
            lists = [self.annuli[self.starts[j] : self.ends[j]][chosen[i, self.starts[j] : self.ends[j]]] for i, j in zip(q, r, strict=True)]
            found = batch.iloc[q][["rep", "vector", "least"]]
            yield found.assign(run=r, annulus=pd.Series(lists, found.index, object))


def search(queries: DataFrame, index: DataFrame, pivots: Pivots, k: int = K) -> DataFrame:
    """`rep, vec_id, score`: for each query vector the k best entries, by score and then id. Queries have `rep` and `vector`."""
    directory = Directory(index, pivots)

    def parts(batches):
        for batch in batches:
            for at in range(0, len(batch), QUERIES_AT_ONCE):
                part = batch.iloc[at : at + QUERIES_AT_ONCE]
                vectors = np.stack(part["vector"])
                yield part, vectors, directory.bounds(pivots.of_query(vectors))

    def nearest(batches):
        """The annuli of least bound that together hold k vectors."""
        for batch, _, bound in parts(batches):
            yield from directory.by_run(batch.assign(least=np.nan), directory.first(bound, k))

    def others(batches):
        """The other annuli that can hold a vector at least as good as the k-th so far."""
        for batch, vectors, bound in parts(batches):
            least = batch["least"].to_numpy(float)
            hopeful = np.isnan(least)[:, None] | (pivots.best_score(vectors, bound) >= least[:, None])
            yield from directory.by_run(batch, ~directory.first(bound, k) & hopeful)

    start = queries.select("rep", "vector").mapInPandas(nearest, WANTED)
    seeds = stored(_expand(start, index, directory, pivots.largest, k), "topk-seeds")
    least = _best(seeds, k).groupBy("rep").agg(F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).alias("least"))
    rest = queries.join(least, "rep").select("rep", "vector", "least").mapInPandas(others, WANTED)
    found = _expand(rest, index, directory, pivots.largest, k)
    return _best(seeds.unionByName(found), k)


def _best(found: DataFrame, k: int) -> DataFrame:
    each = found.select("rep", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k).select("rep", "vec_id", "score")


def _expand(wanted: DataFrame, index: DataFrame, directory: Directory, largest: float, k: int) -> DataFrame:
    """The best entries of each wanted run for each query, block by block: `FOUND`."""
    wanted = stored(wanted, "topk-wanted")
    asked = {r.run: r.n for r in wanted.groupBy("run").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not asked:
        return index.sparkSession.createDataFrame([], FOUND)
    sizes = directory.run_sizes()
    run_of = {a: run for a, run in directory.run_of_annulus().items() if run in asked}

    def lookup(values: dict[int, int], key: str) -> Column:
        return F.element_at(F.create_map(*(F.lit(x).cast("long") for pair in values.items() for x in pair)), F.col(key))

    def spread(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), n - 1))

    def own(n: Column) -> Column:
        return F.pmod(F.xxhash64("rep", F.lit(5)), n)

    data_blocks = lookup({run: -(-sizes[run] // BLOCK) for run in asked}, "run")
    query_blocks = lookup({run: -(-n // QUERIES) for run, n in asked.items()}, "run")
    left = wanted.select("*", own(query_blocks).alias("query_block"), spread(data_blocks).alias("data_block"))
    data = index.where(F.col("annulus").isin(list(run_of))).select("rep", "vector", "ids", "annulus", lookup(run_of, "annulus").alias("run"))
    right = data.select("*", own(data_blocks).alias("data_block"), spread(query_blocks).alias("query_block"))

    def meet(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(entries):
            return pd.DataFrame({"rep": [], "score": [], "ids": []}, dtype=object)
        exact, lowest = (np.float64, -np.inf) if largest < 2**53 else (np.int64, np.iinfo(np.int64).min) if largest < 2**63 else (object, 0)
        a, b = np.stack(queries["vector"]).astype(exact), np.stack(entries["vector"]).astype(exact)
        scores, opened = np.full((len(a), len(b)), lowest, exact), np.zeros((len(a), len(b)), bool)
        asking, annulus = np.repeat(np.arange(len(a)), queries["annulus"].map(len)), np.concatenate(queries["annulus"].to_list())
        of_entry = entries["annulus"].to_numpy()
        for each in np.unique(of_entry):
            cells = np.ix_(asking[annulus == each], np.flatnonzero(of_entry == each))
            scores[cells] = a[cells[0][:, 0]] @ b[cells[1][0]].T
            opened[cells] = True
        floor = queries["least"].to_numpy(float)
        floor = np.where(np.isnan(floor), -np.inf, floor)
        if scores.shape[1] > k and exact is not object:
            floor = np.maximum(floor, np.partition(scores, -k, axis=1)[:, -k])
        query, entry = np.nonzero(opened & (scores >= floor[:, None]))
        score, rep = scores[query, entry], entries["rep"].to_numpy()[entry]
        order = np.lexsort((rep, -score.astype(np.float64 if exact is np.float64 else np.int64), query))
        query, entry, score = query[order], entry[order], score[order]
        starts = np.concatenate(([True], query[1:] != query[:-1])) if len(query) else np.zeros(0, bool)
        nth = np.arange(len(query)) - np.maximum.accumulate(np.where(starts, np.arange(len(query)), 0))
        kept = nth < k
        return pd.DataFrame({"rep": queries["rep"].to_numpy()[query[kept]], "score": score[kept].astype(np.int64), "ids": entries["ids"].to_numpy()[entry[kept]]})

    keys = ["run", "query_block", "data_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, FOUND)


def top_k(vectors: DataFrame, k: int = K, every: int = 20, scale: int = SCALE) -> DataFrame:
    """`query_id, rank, vec_id, score` for every row whose id is divisible by `every`, against all other rows.

    A query vector is searched once for its k + 1 best; each of its ids then leaves itself out.
    """
    rows = stored(quantised(vectors, scale), "topk-rows")
    index, pivots = build(rows, k)
    empty = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if pivots is None:
        return empty
    asking = rows.where(F.col("vec_id") % every == 0)
    asked = stored(asking.join(index.select("rep", "vector"), "vector").select(F.col("vec_id").cast("long").alias("query_id"), "rep"), "topk-asked")
    queries = stored(index.join(asked.select("rep").distinct(), "rep", "left_semi").select("rep", "vector"), "topk-queries")
    best = stored(search(queries, index, pivots, k + 1), "topk-best")
    each = asked.join(best, "rep").where(F.col("query_id") != F.col("vec_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
