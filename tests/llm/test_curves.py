"""Approximate neighbours over Hilbert curves against brute force."""

import itertools

import numpy as np
from parcelflow.llm import common, curves, queries

TABLE = "vec_id long, embedding array<double>, score int"


def brute(rows, k=20, every=20):
    """Best `k` of all rows for each query, by score and then id."""
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    found = {}
    for q in np.flatnonzero(ids % every == 0):
        scores = (vectors * vectors[q]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -scores)) if i != q][:k]
        found[int(ids[q])] = [(int(ids[i]), float(scores[i])) for i in order]
    return found


def by_query(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(found[r.query_id]) == r.rank
    return found


def recall(found, wanted):
    return sum(len({v for v, _ in found.get(q, [])} & {v for v, _ in best}) for q, best in wanted.items()) / sum(map(len, wanted.values()))


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], TABLE)


def clustered(n, seed=3):
    """Vectors of 32 components near a sheet of three degrees of freedom, of different lengths."""
    draw = np.random.default_rng(seed)
    flat = draw.normal(size=(n, 3)) @ draw.normal(size=(3, 32)) + draw.normal(size=(n, 32)) * 0.01
    return list(zip(range(n), flat, strict=True))


def test_recall_on_the_given_vectors(spark):
    rows = [tuple(r) for r in common.read(spark, "/root/testdata/sf0.01", "embeddings").select("vec_id", "embedding").collect()]
    found, wanted = by_query(queries.op11_hilbert_neighbours(spark, "/root/testdata/sf0.01").collect()), brute(rows)
    assert found.keys() == wanted.keys() and all(len(found[q]) == 20 for q in wanted)
    assert recall(found, wanted) >= 0.9
    vectors = {i: np.array(v, float) for i, v in rows}
    for q, best in found.items():
        assert best == sorted(best, key=lambda x: (-x[1], x[0])) and q not in dict(best)
        assert all(abs(score - vectors[q] @ vectors[v]) < 1e-12 for v, score in best)


def test_windows_are_small_where_the_data_has_structure(spark, monkeypatch):
    rows, seen, build = clustered(6000), [], curves.build
    monkeypatch.setattr(curves, "build", lambda *args, **kw: seen.append(build(*args, **kw)) or seen[-1])
    found, wanted = by_query(curves.nearest(frame(spark, rows)).collect()), brute(rows)
    assert recall(found, wanted) >= 0.9
    assert seen[0].share() < 0.3


def test_small_blocks_give_the_same_rows(spark, monkeypatch):
    vectors = frame(spark, clustered(700)).repartition(5)
    wanted = sorted(map(tuple, curves.nearest(vectors).collect()))
    monkeypatch.setattr(curves, "BLOCK_VALUES", 32 * 60)
    monkeypatch.setattr(curves, "PART", 10)
    monkeypatch.setattr(curves, "AT_ONCE", 7)
    assert sorted(map(tuple, curves.nearest(vectors).collect())) == wanted


def test_odd_rows(spark):
    rows = [
        (0, [1, 0, 0]), (20, [1, 0, 0]), (20, [1, 0, 0]), (1, [0, 1, 0]), (2, [1, 1, 0]), (3, [2, 0, 0]), (40, [-1, 0, 5e100]),
        (5, None), (6, []), (7, [1, None, 0]), (8, [float("nan"), 0, 0]), (9, [float("inf"), 0, 0]), (10, [0, 0, 0]), (60, [0, 0, 0]), (None, [1, 0, 0]), (11, [1, 2]), (12, [0.5, 0.5, 0]),
    ]
    taking = {0: [1, 0, 0], 20: [1, 0, 0], 1: [0, 1, 0], 2: [1, 1, 0], 3: [2, 0, 0], 40: [-1, 0, 5e100], 12: [0.5, 0.5, 0]}
    found = by_query(curves.nearest(frame(spark, rows)).collect())
    assert found == brute(list(taking.items()))
    assert found[0][:3] == [(3, 2.0), (2, 1.0), (20, 1.0)]
    assert curves.nearest(frame(spark, [])).count() == 0
    assert curves.nearest(frame(spark, [(20, [1, 1, 1])])).count() == 0


def test_one_vector_holds_a_third_of_the_rows(spark):
    """Its copies are one entry with their least ids; every one of them that asks gets its answer."""
    draw = np.random.default_rng(1)
    same = draw.normal(size=16)
    rows = [(i, same if i % 3 == 0 else v) for i, v in enumerate(draw.normal(size=(3000, 16)))]
    entries = curves.entries_of(curves.taking_part(frame(spark, rows)))
    assert entries.count() == 2001 and max(len(r.ids) for r in entries.collect()) == 21
    found, wanted = by_query(curves.nearest(frame(spark, rows)).collect()), brute(rows)
    assert recall(found, wanted) >= 0.9
    # all of them get the same answer, but for themselves
    others = {tuple(v for v, _ in found[q] if v % 3) for q in wanted if q % 3 == 0}
    shortest = min(others, key=len)
    assert all(len(found[q]) == 20 for q in wanted) and all(o[: len(shortest)] == shortest for o in others)


def test_hilbert_walks_through_neighbouring_cells():
    for dims, bits in ((2, 4), (3, 3), (4, 2), (5, 1)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        place = curves.hilbert(cells, bits)
        assert sorted(place.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()
