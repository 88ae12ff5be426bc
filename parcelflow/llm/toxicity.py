"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed character n-grams that a text has. Their log-count ratio is the logarithm of how
much more often toxic documents have them than others do. A logistic regression is fitted on the features
times their ratios, with the classes weighted to their real shares, and reads every whole text.

Training uses about `PER_CLASS` labelled documents a class, chosen by a hash of their id (the one bound of
this module), and one text of each, whatever number of rows has the id; of their features the `FEATURES` with the largest ratios are kept.

Defined results: a document with several labels counts as toxic if one is; NULL labels are left out. A text
that is NULL or has no letter has no features and scores the intercept. Without labels of both classes the
score is the share of toxic labels. Repeated rows score alike. An empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import common, ngrams

SIZES, BUCKETS = (3, 5), 1 << 18
PER_CLASS, FEATURES, SMOOTHING, RIDGE, STEPS = 2500, 30_000, 1.0, 1e-4, 300
THRESHOLD = 0.3


@dataclass
class Model:
    weights: np.ndarray
    intercept: float

    def score(self, text: str | None) -> float:
        z = self.intercept + float(self.weights[features(text)].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def features(text: str | None) -> np.ndarray:
    """The distinct buckets of a text's n-grams, sorted."""
    codes = ngrams.plain(text or "")
    found = [np.unique((ngrams.hashes(p, n) >> np.uint64(7 * i)).astype(np.uint32) & np.uint32(BUCKETS - 1)) for i, n in enumerate(SIZES) if len(codes) for p in ngrams.pieces(codes, n)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)


def labelled_sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """About `PER_CLASS` training documents a class as `toxic, text`, and the size of each class."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~common.held_out())
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, F.lit(common.share_of(PER_CLASS, counts.get(1, 0)))).otherwise(F.lit(common.share_of(PER_CLASS, counts.get(0, 0))))
    # about 2 * PER_CLASS ids of 12 bytes, whatever the size of the input
    chosen = F.broadcast(known.where(common.draw("doc_id", F.lit(9)) <= share))
    drawn = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "toxic", "text")
    return common.one_per_document(drawn, "doc_id").select("toxic", "text"), counts


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    sample, counts = labelled_sample(docs, labels)

    @F.pandas_udf("binary")
    def of_text(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).astype("<u4").tobytes() for t in texts])

    # a sample of bounded size: at most four bytes per distinct n-gram of some thousand documents
    rows = sample.select("toxic", of_text("text").alias("found")).toPandas()
    toxic = rows["toxic"].to_numpy().astype(bool)
    found = [np.frombuffer(x, "<u4") for x in rows["found"]]
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    weights = np.zeros(BUCKETS)
    if not toxic.any() or toxic.all():
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(weights, float(np.log(share / (1 - share))))
    ratio = log_count_ratios(found, toxic)
    kept = np.sort(np.argsort(-np.abs(ratio), kind="stable")[:FEATURES])
    chosen = np.full(BUCKETS, -1)
    chosen[kept] = np.arange(len(kept))
    columns = [chosen[x][chosen[x] >= 0] for x in found]
    balance = np.where(toxic, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    fitted, intercept = logistic(columns, ratio[kept], toxic.astype(float), balance)
    weights[kept] = fitted * ratio[kept]
    return Model(weights, intercept)


def log_count_ratios(found: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Log of the features' shares in toxic documents over those in others, from counts of documents."""

    def shares(of: bool) -> np.ndarray:
        count = np.full(BUCKETS, SMOOTHING)
        for x, is_toxic in zip(found, toxic, strict=True):
            if is_toxic == of:
                count[x] += 1
        return count / (np.sum(toxic == of) + 2 * SMOOTHING)

    return np.log(shares(True) / shares(False))


def logistic(columns: list[np.ndarray], scale: np.ndarray, y: np.ndarray, balance: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on 0/1 features times `scale`, by Nesterov's gradient steps."""
    lengths = np.array([len(c) for c in columns])
    row, column = np.repeat(np.arange(len(columns)), lengths), np.concatenate([*columns, np.zeros(0, int)]).astype(np.int64)
    value, total = scale[column], balance.sum()
    # bound of the curvature: a quarter of the largest squared row norm
    norms = np.bincount(row, value**2, len(columns)) + 1
    rate = 4 / max(np.average(norms, weights=balance) * 4, 1e-9)
    w, b = np.zeros(len(scale)), float(np.log(max((balance * y).sum(), 1e-9) / max((balance * (1 - y)).sum(), 1e-9)))
    ahead_w, ahead_b = w, b
    for step in range(STEPS):
        z = ahead_b + np.bincount(row, value * ahead_w[column], len(columns))
        error = balance * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / total
        new_w = ahead_w - rate * (np.bincount(column, value * error[row], len(scale)) + RIDGE * ahead_w)
        new_b = ahead_b - rate * error.sum()
        pull = step / (step + 3)
        ahead_w, ahead_b = new_w + pull * (new_w - w), new_b + pull * (new_b - b)
        w, b = new_w, new_b
    return w, b


def score(docs: DataFrame, model: Model):
    """Column with the score of `text`."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of_text(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([sent.value.score(t) for t in batch], dtype="float64")

    return of_text("text")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id, held_out, score, predicted` for every row."""
    scored = docs.select("doc_id", score(docs, learn(docs, labels)).alias("score"))
    return scored.select("doc_id", common.held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    return docs.where(score(docs, learn(docs, labels)) < THRESHOLD)
