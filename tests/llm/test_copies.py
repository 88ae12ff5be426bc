"""Rows of very many copies, odd rows through all stages of the pipeline, and law and order of shards."""

import zlib
from collections import Counter

import corpus_pipeline
from cases import CLASHING, ROWS, docs
from parcelflow.llm import common, sharding
from pyspark.sql import functions as F


def test_three_hundred_million_copies_of_a_row(spark):
    """Counted, as no table of them is needed: every number from 0 once."""
    n = 300_000_000
    rows = spark.createDataFrame([("hot", n), ("one", 1), ("none", 0), ("run", common.RUN)], "key string, n long")
    found = common.spread(rows, "n", "nth").groupBy("key").agg(F.count(F.lit(1)).alias("count"), F.sum("nth").alias("sum"), F.max("nth").alias("max"), F.sum(F.col("nth") % 1000).alias("rest"))
    wanted = {k: (m, m * (m - 1) // 2, m - 1) for k, m in (("hot", n), ("one", 1), ("run", common.RUN))}
    assert {r.key: (r["count"], r["sum"], r["max"]) for r in found.collect()} == wanted


def test_shards_of_a_much_repeated_row(spark, monkeypatch):
    """With short runs: gapless slots, sizes one apart, and each copy once, whatever the runs."""
    rows = [(None, "", "en", "a", 0)] * 700 + [(i, f"text {i}", "en", "a", 0) for i in range(300)]
    frame = docs(spark, rows)
    whole = sorted(tuple(r) for r in sharding.shard(frame, 7).select("row_number", "doc_id", "shard", "slot").collect() if r.doc_id is not None)
    monkeypatch.setattr(common, "RUN", 64)
    found = sharding.shard(frame, 7).collect()
    assert sorted((r.row_number, r.doc_id, r.shard, r.slot) for r in found if r.doc_id is not None) == whole
    assert sorted(r.row_number for r in found) == list(range(1000))
    sizes = Counter(r.shard for r in found)
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in found if r.shard == s) == list(range(sizes[s])) for s in sizes)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter((i, len(t) + 16, zlib.crc32(t.encode())) for i, t, *_ in rows)


def test_odd_rows_through_every_stage(spark, tmp_path):
    """NULLs, repeats, empty texts and clashing columns: each stage returns the columns of documents, the last the pieces of what stayed."""
    folder = str(tmp_path / "sf")
    docs(spark, ROWS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(4, 1, 0), (7, 0, None), (None, None, 1), (4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    frame = common.read(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, frame, folder)
        assert after.columns == frame.columns and set(CLASHING) <= set(after.columns)
        after.write.parquet(str(tmp_path / name))
        kept = Counter((r.doc_id, r.text) for r in spark.read.parquet(str(tmp_path / name)).collect())
        assert set(kept) <= {(r.doc_id, r.text) for r in frame.collect()}, name
        if name in ("exact_dedup", "simhash_dedup"):
            assert max(kept.values()) == 1
        frame = spark.read.parquet(str(tmp_path / name))
    pieces = corpus_pipeline.STAGES[-1][1](spark, frame, folder).collect()
    assert Counter(p.doc_id for p in pieces if p.start == 0) == Counter(r.doc_id for r in frame.collect()) and pieces
    none = common.read(spark, folder, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0
