"""Mixing domains to target weights by soft membership.

A naive Bayes classifier, trained on a labelled table, gives every document a posterior over the domains.
Nonnegative rates per document are then fitted so that the expected tokens of each domain meet its target, by
projected gradient descent on the least squares of the domains' token shares: from rates of 1, every step takes from a
document's rate its posterior times one number, the pull, per domain, and sets what falls below 0 to 0. Pulls are the
errors of the shares over the bound of the curvature, a step that never ascends, or, where that descends further, the errors
times a metric: the inverse of the posteriors' products summed over the rates that can move, in several step lengths. It
brings rare domains to their targets in a few steps. Steps go on until each share is within `TOLERANCE` of its target,
or none descends any more, or after `STEPS`, which only targets that no rates can meet were seen to need; what is left of such
targets is in `Fit.residual`, with a warning. A document is taken floor(rate) times, and once more with the rest as its chance.

Rates follow posteriors in units of 1/`UNITS`, rounded by largest remainders; what they are fitted to does not:
expected tokens are sums of unrounded posteriors. Documents of equal units have equal rates, so the fit
runs over distinct units with those sums: one pass over the corpus whatever the number of
steps, and a table of rates bounded by the number of unit vectors, written anew by every step. A step is two aggregations in
Spark; only sums per pair of domains come back. Rates of documents are worked out in place from the pulls of all steps.

All expressions are built-in functions. The model is one row of `BUCKETS` weight vectors, made by Spark and
put into the plan as a constant of that fixed size. Scoring happens in place: texts are not shuffled, and each is read whole.

Defined results: tokens are cut at spaces and line breaks; a NULL or empty text has 0 tokens and the prior as posterior. Labels that are NULL or of no
target domain are left out; without any label the posterior is uniform. Repeated rows get the same rate and
number of copies; chances are a hash of id and text. If no document has a token, all rates are 1. An empty
table gives an empty result. Extra columns are ignored, or kept by `mixed`.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.scratch import stored
from parcelflow.llm import common

BUCKETS, UNITS = 1 << 13, 64
#: The bound of the training sample: about so many labelled documents a domain.
PER_DOMAIN = 3000
TOLERANCE = 1e-4
#: Steps of the fit at most, step lengths tried at once, and the least share of the squares that a step must take away.
STEPS, HALVINGS, DESCENT = 100, 8, 1e-4
#: Target token shares of the registered query: languages, and documents labelled as of low quality.
TARGETS = {"en": 0.45, "fr": 0.20, "de": 0.15, "es": 0.15, "low": 0.05}


def domains_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table of the query: `doc_id, domain`, where the domain is the language, or `low`."""
    quality = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("label_quality"))
    known = docs.select("doc_id", "lang").join(quality, "doc_id")
    return known.select("doc_id", F.when(F.col("label_quality") == 0, "low").otherwise(F.col("lang")).alias("domain"))


def words(text: Column) -> Column:
    return F.filter(F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " "), lambda w: w != "")


def _features(found: Column) -> Column:
    """Buckets of the distinct words, and of how much the text repeats itself."""
    distinct = F.array_distinct(found)
    repeats = F.concat(F.lit("distinct share "), F.floor(20 * F.size(distinct) / F.greatest(F.size(found), F.lit(1))).cast("string"))
    return F.transform(F.array_append(distinct, repeats), lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def train(docs: DataFrame, labelled: DataFrame, domains: list[str]) -> DataFrame:
    """One row of JSON: `prior` (log share per domain) and `weights` (per bucket: log share of documents per domain)."""
    known = labelled.where(F.col("domain").isin(domains)).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    sizes = {r.domain: r["count"] for r in known.groupBy("domain").count().collect()}
    share = F.lit(-1)
    for domain, size in sizes.items():
        share = F.when(F.col("domain") == domain, F.lit(common.share_of(PER_DOMAIN, size))).otherwise(share)
    # about PER_DOMAIN ids a domain, whatever the size of the input
    chosen = F.broadcast(known.where(common.draw("doc_id", F.lit(11)) <= share))
    # written first: else a filter on the features, made for explode, is pushed below the join to all documents
    drawn = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "domain", "text")
    texts = stored(common.one_per_document(drawn, "doc_id").select("domain", "text"), "mixing-sample")
    sample = texts.select("domain", _features(words(common.whole_text())).alias("found"))
    counts = sample.select("domain", F.explode("found").alias("bucket")).groupBy("bucket").agg(*(F.sum((F.col("domain") == d).cast("double")).alias(f"n_{i}") for i, d in enumerate(domains)))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(stored(counts, "mixing-counts"), "bucket", "left").fillna(0.0)
    total = full.agg(*(F.sum(f"n_{i}").alias(f"t_{i}") for i in range(len(domains)))).first()
    log_share = F.array(*(F.round(F.log((F.col(f"n_{i}") + 0.1) / (total[i] + 0.1 * BUCKETS)), 3) for i in range(len(domains))))
    rows = full.select("bucket", log_share.alias("weight")).agg(F.transform(F.sort_array(F.collect_list(F.struct("bucket", "weight"))), lambda x: x["weight"]).alias("weights"))
    everyone = sum(sizes.values())
    prior = F.array(*(F.log(F.lit((sizes.get(d, 0) + 1) / (everyone + len(domains)))) for d in domains))
    return rows.select(F.to_json("weights").alias("weights"), F.to_json(prior).alias("prior"))


def with_units(docs: DataFrame, model: DataFrame, domains: list[str]) -> DataFrame:
    """`docs` as struct `doc`, with the row key, `tokens`, the posterior `shares` and its `units` (an array that sums to `UNITS`)."""
    row = model.first()
    weights, prior = F.from_json(F.lit(row.weights), "array<array<double>>"), F.from_json(F.lit(row.prior), "array<double>")
    seen = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), *common.row_key(), words(common.whole_text()).alias("found"))
    seen = seen.select("doc", *common.KEY, F.size("found").cast("long").alias("tokens"), _features(F.col("found")).alias("features"))
    seen = seen.select("doc", *common.KEY, "tokens", F.transform("features", lambda b: F.get(weights, b)).alias("features"))

    def evidence(i: int) -> Column:
        # the root of the number of words: words are not independent, and whole sums leave no doubt
        total = F.aggregate("features", F.lit(0.0), lambda s, w: s + F.get(w, F.lit(i)))
        return F.get(prior, F.lit(i)) + F.when(F.col("tokens") > 0, total / F.sqrt(F.size("features"))).otherwise(0.0)

    scored = seen.select("doc", *common.KEY, "tokens", F.array(*(evidence(i) for i in range(len(domains)))).alias("z"))
    scored = scored.withColumn("e", F.transform("z", lambda x: F.exp(x - F.array_max("z"))))
    scored = scored.withColumn("total", F.aggregate("e", F.lit(0.0), lambda s, x: s + x))
    scored = scored.withColumn("shares", F.transform("e", lambda x: x / F.col("total")))
    floors = scored.withColumn("low", F.transform("shares", lambda x: F.floor(x * UNITS).cast("int")))
    floors = floors.withColumn("over", F.zip_with("shares", "low", lambda x, n: x * UNITS - n))
    rest = F.lit(UNITS) - F.aggregate("low", F.lit(0), lambda s, x: s + x)
    # the units that are left go to the largest remainders
    rank = F.transform("over", lambda x, i: F.size(F.filter("over", lambda y, j: (y > x) | ((y == x) & (j < i)))))
    return floors.select("doc", *common.KEY, "tokens", "shares", F.zip_with("low", rank, lambda n, r: n + (r < rest).cast("int")).alias("units"))


class Fit:
    """`pulls`: per step, how much a whole posterior of each domain takes from a rate. `residual`: expected shares less targets."""

    def __init__(self, domains: int):
        self.pulls: list[list[float]] = []
        self.residual = [0.0] * domains

    def rate(self, units: str = "units") -> Column:
        rate = F.lit(1.0)
        for pull in self.pulls:
            rate = _moved(rate, pull, units)
        return rate


def _dot(pull: Sequence[float], units: str = "units") -> Column:
    return F.expr("(" + "+".join(f"{units}[{i}]*{float(x)!r}D" for i, x in enumerate(pull)) + f")/{UNITS}D")


def _moved(rate: Column, pull: Sequence[float], units: str = "units") -> Column:
    """The projected step."""
    return F.greatest(F.lit(0.0), rate - _dot(pull, units))


def fit(rows: DataFrame, targets: Mapping[str, float]) -> Fit:
    """Rates for `rows` (`tokens`, `units`, and `shares` unless units are exact) whose expected token shares meet `targets`; total tokens stay the same.

    A residual of `TOLERANCE` or more is warned of: it is left where no rates can meet the targets, or after `STEPS` steps.
    """
    domains = list(targets)
    n = len(domains)
    goal = np.array([targets[d] / sum(targets.values()) for d in domains])
    exact = [F.col("shares")[i] if "shares" in rows.columns else F.col("units")[i] / UNITS for i in range(n)]
    mass = [F.sum(F.col("tokens") * x).alias(f"m{i}") for i, x in enumerate(exact)]
    state = stored(rows.groupBy("units").agg(*mass).withColumn("rate", F.lit(1.0)), "mixing-posteriors")
    found = Fit(n)
    everything = sum(x or 0.0 for x in state.agg(*(F.sum(f"m{i}") for i in range(n))).first())
    if not everything:
        return found

    def shares(*pulls: np.ndarray) -> np.ndarray:
        sums = [F.sum(F.col(f"r{k}") * F.col(f"m{i}")) for k in range(len(pulls)) for i in range(n)]
        moved = state.select(*(f"m{i}" for i in range(n)), *(_moved(F.col("rate"), pull).alias(f"r{k}") for k, pull in enumerate(pulls)))
        return np.array(moved.agg(*sums).first(), float).reshape(len(pulls), n) / everything

    def products(of: DataFrame) -> np.ndarray:
        sums = [F.coalesce(F.sum(F.col(f"m{i}") * F.col("units")[j] / UNITS), F.lit(0.0)) for i in range(n) for j in range(n)]
        return np.array(of.agg(*sums).first(), float).reshape(n, n) / everything

    whole = products(state)
    # no rate depends on a domain without reach
    weight = np.divide(1.0, np.diag(whole), out=np.zeros(n), where=np.diag(whole) > 0)
    residual = shares(np.zeros(n))[0] - goal
    while max(abs(residual)) >= TOLERANCE and len(found.pulls) < STEPS:
        movable = state.where((F.col("rate") > 0) | (_dot(residual) < 0))
        quick = _inverse(products(movable)) @ residual
        # the last is plain projected gradient: the trace bounds the curvature
        tried = [quick / 2**k for k in range(HALVINGS)] + [weight * residual / n, residual / max(np.trace(whole), 1e-300)]
        residuals = shares(*tried) - goal
        squares = [r @ r for r in residuals]
        best = int(np.argmin(squares))
        if squares[best] >= (1 - DESCENT) * (residual @ residual):
            break
        state = stored(state.withColumn("rate", _moved(F.col("rate"), tried[best])), "mixing-rates")
        found.pulls.append(tried[best].tolist())
        residual = residuals[best]
    found.residual = residual.tolist()
    if max(abs(residual)) >= TOLERANCE:
        warnings.warn(f"targets not met; shares less targets: {dict(zip(domains, found.residual, strict=True))}", stacklevel=2)
    return found


def _inverse(products: np.ndarray) -> np.ndarray:
    """Pseudo-inverse, with domains of very different mass brought to one scale first."""
    diagonal = np.diag(products)
    scale = np.divide(1.0, np.sqrt(diagonal), out=np.zeros(len(diagonal)), where=diagonal > 0)
    return scale[:, None] * np.linalg.pinv(scale[:, None] * products * scale, rcond=1e-10) * scale


def copies(rate: Column, *of: str) -> Column:
    """floor(rate), and one more with the rest as its chance: a hash of the row key."""
    chance = F.pmod(F.xxhash64(*of, F.lit(13)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")).cast("long")


def rates(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float] = TARGETS) -> DataFrame:
    """`doc_id, tokens, domain, posterior, posteriors, rate, copies` for every row."""
    domains = list(targets)
    model = stored(train(docs, labelled, domains), "mixing-model")
    scored = with_units(docs.select("doc_id", "text"), model, domains).select("doc.doc_id", *common.KEY, "tokens", "shares", "units")
    rows = stored(scored, "mixing-rows")
    found = rows.withColumn("rate", fit(rows, targets).rate())
    names = F.array(*(F.lit(d) for d in domains))
    return found.select(
        "doc_id", "tokens",
        F.get(names, F.array_position("shares", F.array_max("shares")).cast("int") - 1).alias("domain"),
        (F.array_max("units") / UNITS).alias("posterior"),
        F.array_join(F.zip_with(names, "units", lambda d, u: F.concat(d, F.lit(":"), u.cast("string"))), ",").alias("posteriors"),
        "rate", copies(F.col("rate"), *common.KEY).alias("copies"),
    )


def mixed(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float] = TARGETS) -> DataFrame:
    """The documents, each as often as its rate says, with all their columns. Scored texts are written once."""
    domains = list(targets)
    model = stored(train(docs, labelled, domains), "mixing-model")
    rows = stored(with_units(docs, model, domains), "mixing-docs")
    taken = rows.withColumn("rate", fit(rows, targets).rate())
    times = taken.select("doc", copies(F.col("rate"), *common.KEY).alias("times"))
    return common.spread(times, "times", "nth").select("doc.*")
